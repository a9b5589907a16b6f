"""Telemetry-shaped tables derived from the generated test tables.

The analysed project reads vehicle recordings (ego, object, lane line, vehicle
status, intervals, tags, annotation files) that are not shipped.  These
fixtures derive tables of the same shape from the parquet test tables with
fixed formulas.  Each fixture is written once as SQL expression text and
rendered for Spark (``selectExpr``) or DuckDB (the oracle), so both sides
see identical inputs.  Work grows with the source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trajex.session import table_path


def rec(k: str) -> str:
    """Recording id for integer expression k: 20 recordings, valid dates."""
    return (f"concat('FH', cast(2000 + {k} % 20 as string), '_202203', "
            f"cast(10 + {k} % 20 as string), '_00')")


def tick(k: str) -> str:
    """Scene time in 0.04 s steps, never a rounding tie: 500 steps for every
    6,000 keys, so the scenes grow longer with the data, not denser."""
    return f"cast(({k} % 500) * 4 as double) / 100 + cast(floor({k} / 6000) as double) * 20"


def lane(side: int) -> list[str]:
    """One of the two lane lines of each track row: beside the position for
    every fourth key, far from it for the others."""
    y = f"cast(o_orderkey % 97 as double) / 8 + cast(o_orderkey % 7 - {3 - side} as double) / 16"
    away = "case when o_orderkey % 4 = 0 then 0 else 40 + o_orderkey % 3 end"
    x = "cast(o_orderkey % 1000 as double) / 8"
    return [f"{rec('o_custkey')} as recording_id", "cast(o_orderkey as double) / 8 as ptp_time",
            f"cast({side} as bigint) as TrackingID", f"{x} - 2|{x}|{x} + 2", f"{y} + {away}|{y} + {away}|{y} + {away} + 0.125"]


def _arr(d: str, *items: str) -> str:
    inner = ", ".join(items)
    return f"array({inner})" if d == "spark" else f"[{inner}]"


# Each fixture: (source table, [column expressions], where-clause or None).
def _defs(d: str) -> dict[str, tuple[str, list[str], str | None]]:
    # whole epoch seconds of a timestamp without zone; independent of the
    # session time zone in both engines
    epoch_s = ("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts)" if d == "spark"
               else "epoch_us(ts) // 1000000")
    polyline_y = (
        "transform(sequence(0, 63), k -> cast(k * label as double) / 50 "
        "+ cast(embedding[k] as double))" if d == "spark" else
        "list_transform(range(64), lambda k: cast(k * label as double) / 50 "
        "+ cast(embedding[k + 1] as double))")
    polyline_x = ("transform(sequence(0, 63), k -> cast(k as double))" if d == "spark"
                  else "list_transform(range(64), lambda k: cast(k as double))")
    return {
        # each supplier stands for 12 s of scene time of its recording, the next
        # one of the recording for 12 s from 10 s later
        "interval": ("supplier", [
            f"{rec('s_suppkey')} as recording_id",
            "cast(floor(s_suppkey / 20) * 1000 + s_suppkey % 20 * 30 + 1 as double) / 100 as start_time",
            "cast(floor(s_suppkey / 20) * 1000 + s_suppkey % 20 * 30 + 1201 as double) / 100 as end_time",
        ], None),
        # intervals of all kinds: open to one or both sides, years long, the
        # wrong way round, with NaN and null ends
        "odd_interval": ("supplier", [
            f"{rec('s_suppkey')} as recording_id", "s_suppkey as id",
            "case s_suppkey % 9 when 0 then cast('-Infinity' as double) when 1 then cast('NaN' as double) "
            "when 2 then cast(null as double) when 3 then -100000000 else cast(s_suppkey * 3 as double) end as start_time",
            "case s_suppkey % 9 when 4 then cast('Infinity' as double) when 5 then cast('NaN' as double) "
            "when 6 then cast(null as double) when 7 then cast(s_suppkey * 3 - 5 as double) "
            "when 3 then 100000000 else cast(s_suppkey * 3 + 7 as double) end as end_time",
        ], None),
        # a track with holes: NaN and null positions and signals
        "gap_track": ("orders", [
            f"{rec('o_custkey')} as recording_id",
            "cast(o_orderkey as double) / 8 as ptp_time",
            "case when o_orderkey % 13 = 0 then cast('NaN' as double) when o_orderkey % 29 = 0 then cast(null as double) "
            "else cast(o_orderkey % 1000 as double) / 8 end as PositionX",
            "cast(o_orderkey % 97 as double) / 8 as PositionY",
            "cast(o_orderkey % 11 as double) / 8 as PositionZ",
            "case when o_orderkey % 5 = 0 then cast('NaN' as double) when o_orderkey % 7 = 0 then cast(null as double) "
            "else cast((o_orderkey * 37) % 97 as double) / 1500 end as Yaw",
        ], None),
        "ego": ("orders", [
            f"{rec('o_custkey')} as recording_id",
            f"{tick('o_orderkey')} as ptp_time",
            "cast(o_custkey % 23 as double) as VelocityX",
            "cast(o_orderkey % 7 as double) as VelocityY",
            f"substring({rec('o_custkey')}, 1, 6) as vehicle",
        ], None),
        "object": ("lineitem", [
            f"{rec('l_suppkey')} as recording_id",
            f"{tick('l_orderkey')} as ptp_time",
            "l_partkey as TrackingID",
            "l_linenumber as MessageNumber",
            "l_quantity - 10 as VelocityX",
            "cast(l_linenumber as double) as VelocityY",
            "l_tax as VelocityZ",
            "cast(l_partkey % 50 as double) as PositionX",
            "cast(l_linenumber * 2 - 7 as double) as PositionY",
            f"substring({rec('l_suppkey')}, 1, 6) as vehicle",
        ], None),
        "status": ("lineitem", [
            f"{tick('l_orderkey')} as ptp_time_rounded",
            f"{rec('l_suppkey')} as recording_id",
            f"substring({rec('l_suppkey')}, 1, 6) as vehicle",
            "l_quantity as BrakePedalPosition",
            "case when l_linestatus = 'F' then 1 else 0 end as BrakeSwitch",
            "l_linenumber % 2 as BrakeLight_rqst",
            "l_discount as LateralAcceleration",
            "l_tax as LongitudinalAcceleration",
            "cast(l_partkey % 100 as double) as VehicleDirSAE_VehSpeed",
            "cast(l_partkey % 90 as double) as WheelBasedVehicleSpeed",
            "case when l_returnflag = 'R' then l_linenumber % 3 else 0 end as LaneChangeStatus",
            "cast(l_linenumber as double) / 100 as YawRate",
            "(l_discount - cast(5 as double) / 100) * 9 as SteeringWheelAngle",
            "l_orderkey as source_key",
        ], None),
        "track": ("orders", [
            f"{rec('o_custkey')} as recording_id",
            "cast(o_orderkey as double) / 8 as ptp_time",
            "cast((o_orderkey * 37) % 97 as double) / 1500 as Yaw",
            "cast(o_orderkey % 1000 as double) / 8 as PositionX",
            "cast(o_orderkey % 97 as double) / 8 as PositionY",
            "cast(o_orderkey % 11 as double) / 8 as PositionZ",
            "cast((o_orderkey * 13) % 41 - 20 as double) / 1000 as YawRate",
            "cast(o_orderkey % 9 as double) - 4 as VelocityX",
            "cast(o_orderkey % 31 as double) as VelocityY",
            "o_orderkey as MessageNumber",
        ], None),
        "signal": ("orders", [
            f"{rec('o_custkey')} as recording_id",
            "cast(o_orderkey as double) / 8 as ptp_time",
            "cast((o_orderkey * 37) % 97 as double) / 1500 as Yaw",
            "cast((o_orderkey * 13) % 41 - 20 as double) / 1000 as YawRate",
            "cast(o_orderkey % 1000 as double) / 8 as PositionX",
            "'ref' as source",
            "cast(null as double) as Unused",
            "7 as Version",
        ], None),
        # a supplier stands for 18.75 s of track time at every scale factor, so
        # the intervals reach to the end of the track whatever its length
        "track_interval": ("supplier", [
            f"{rec('s_suppkey')} as recording_id",
            "cast(s_suppkey as int) as id",
            "cast(s_suppkey * 75 as double) / 4 as start_time",
            "cast(s_suppkey * 75 as double) / 4 + 700 as end_time",
        ], None),
        **{f"lane_line_{name}": ("orders", [
            *lane(side)[:3], _arr(d, *lane(side)[3].split("|")) + " as BoundaryLineX", _arr(d, *lane(side)[4].split("|")) + " as BoundaryLineY",
        ], None) for name, side in (("a", 0), ("b", 1))},
        "polyline": ("embeddings", [
            "cast(label as string) as recording_id",
            "cast(vec_id % 20 as double) as ptp_time",
            "cast(floor(vec_id / 40) % 2 as bigint) as TrackingID",
            "vec_id as line_seq",
            f"{polyline_x} as BoundaryLineX",
            f"{polyline_y} as BoundaryLineY",
        ], None),
        "interval_list": ("supplier", [
            f"{rec('s_suppkey')} as recording_id",
            "concat('[[', cast(s_suppkey * 100 as string), '.5, ', "
            "cast(s_suppkey * 100 + 40 as string), '.25],[', "
            "cast(s_suppkey * 100 + 60 as string), '.0, ', "
            "cast(s_suppkey * 100 + 95 + s_suppkey % 3 as string), '.75]]') as intervals",
        ], None),
        # tags whose JSON differs from row to row: fields that only some rows
        # have, objects in objects, lists, nulls, no object at all
        "json_tag": ("events", [
            "event_id as tag_id",
            "case event_id % 6 when 0 then concat('{\"k\":', cast(event_id % 90 as string), ',\"who\":{\"id\":', cast(user_id as string), '}}') "
            "when 1 then concat('{\"who\":{\"id\":', cast(user_id as string), ',\"role\":{\"name\":\"', event_type, '\"}}}') "
            "when 2 then concat('{\"k\":', cast(event_id % 90 as string), ',\"marks\":[1,2,', cast(event_id % 5 as string), ']}') "
            "when 3 then '{\"k\":null}' when 4 then cast(null as string) else '{}' end as item",
        ], None),
        "tag": ("events", [
            "cast(user_id as string) as recording_id",
            "event_type as tag",
            f"{epoch_s} as start_time",
            f"{epoch_s} + cast(floor(value * 3600) as bigint) as end_time",
            "props",
            "event_id as tag_id",
        ], None),
        "annotation": ("conversations", [
            "concat('/data/FH', cast(2000 + conv_id % 20 as string), '_202203', "
            "cast(10 + conv_id % 20 as string), '/annot/a', cast(conv_id as string), '.txt') as path",
            "turn as line_no",
            "case when turn = 0 then (case when conv_id % 2 = 0 then 'MOIS' else 'AEBS' end) "
            "else (case (conv_id * 3 + turn) % 10 "
            "when 0 then '10:00:01: recording has started' "
            "when 1 then '10:00:09: recording has stopped' "
            "when 2 then 'result: ok' "
            "when 3 then 'result: nok' "
            "when 4 then 'target from right' "
            "when 5 then 'bike on left side' "
            "when 6 then 'pedestrian center' "
            "when 7 then 'follow bike' "
            "when 8 then 'speed 20 kph: 20' "
            "else 'distance 5 m: 5' end) || ' ' || replace(coalesce(text, ''), chr(10), ' ') end as line",
        ], None),
        "file_meta": ("orders", [
            f"{rec('o_custkey')} as recording_id",
            "cast(o_orderkey as double) as first_ptp_time",
            "cast(o_orderkey + o_custkey % 60 as double) as last_ptp_time",
            "case when o_custkey % 5 = 0 then cast(null as string) "
            "when o_custkey % 7 = 0 then '' "
            "else concat('f', cast(o_orderkey as string), '.parquet') end as filename_parquet",
            "o_orderkey as file_id",
        ], None),
        "gnss": ("customer", [
            f"{rec('c_custkey')} as recording_id",
            "case c_nationkey % 5 when 0 then 'Japan' when 1 then 'Brazil' "
            "when 2 then 'no country' else concat('Country ', cast(c_nationkey as string)) end as country",
            "c_acctbal / 200 + 40 as etrs89_latitude",
            "cast(c_custkey % 360 as double) / 10 - 10 as etrs89_longitude",
        ], None),
        "road_type": ("events", [
            "cast(user_id % 20 as string) as recording_id",
            "case event_type when 'click' then '[Road, Type, Motorway]' "
            "when 'view' then '[Road, Type, Primary highway]' "
            "when 'purchase' then '[Road, Type, Secondary highway]' "
            "when 'signup' then '[Road, Type, Urban]' else '[Road, Type, Rural]' end as tag_name_list",
            "ts as start_datetime",
            "ts + interval 10 minutes as end_datetime",
        ], None),
    }


FIXTURE_NAMES = list(_defs("spark"))


def fixture_sql(name: str) -> str:
    """DuckDB SELECT for a fixture over the registered test-table views."""
    src, cols, where = _defs("duckdb")[name]
    sql = f"SELECT {', '.join(cols)} FROM {src}"
    return sql + (f" WHERE {where}" if where else "")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    src, cols, where = _defs("spark")[name]
    df = spark.read.parquet(table_path(sf_dir, src))
    if where:
        df = df.where(where)
    return df.selectExpr(*cols)


# Convenience accessors --------------------------------------------------------

def intervals(spark, sf_dir): return load(spark, sf_dir, "interval")
def ego(spark, sf_dir): return load(spark, sf_dir, "ego")
def objects(spark, sf_dir): return load(spark, sf_dir, "object")
def status(spark, sf_dir): return load(spark, sf_dir, "status").drop("source_key")
def track(spark, sf_dir): return load(spark, sf_dir, "track")
def track_intervals(spark, sf_dir): return load(spark, sf_dir, "track_interval")
def polylines(spark, sf_dir): return load(spark, sf_dir, "polyline")
def interval_lists(spark, sf_dir): return load(spark, sf_dir, "interval_list")
def tags(spark, sf_dir): return load(spark, sf_dir, "tag")
def annotations(spark, sf_dir): return load(spark, sf_dir, "annotation")
def file_meta(spark, sf_dir): return load(spark, sf_dir, "file_meta")
def gnss(spark, sf_dir): return load(spark, sf_dir, "gnss")
def road_types(spark, sf_dir): return load(spark, sf_dir, "road_type")
def signals(spark, sf_dir): return load(spark, sf_dir, "signal")
def gap_track(spark, sf_dir): return load(spark, sf_dir, "gap_track")


def lane_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lane_line_a").unionByName(load(spark, sf_dir, "lane_line_b"))


LANE_LINE_SQL = "({a}) UNION ALL ({b})"


def lane_line_sql() -> str:
    return LANE_LINE_SQL.format(a=fixture_sql("lane_line_a"), b=fixture_sql("lane_line_b"))
