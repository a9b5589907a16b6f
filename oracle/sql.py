"""DuckDB SQL answers for the registered queries.

Fixtures come from the same expression text as the Spark side
(``trajex.sources.fixtures``); the operator logic is written here
independently in plain SQL, in the direct form (join then aggregate, chained
left joins, recursive walks) rather than the rewritten Spark plans.
"""

from __future__ import annotations

from trajex.sources.fixtures import fixture_sql, lane_line_sql

SQL: dict[str, str] = {}


def with_(body: str, **ctes: str) -> str:
    parts = ",\n".join(f"{k} AS ({v})" for k, v in ctes.items())
    return f"WITH {parts}\n{body}"


def fx(name: str) -> str:
    return fixture_sql(name)


# --- scene pipeline ----------------------------------------------------------------

SCENE = dict(
    iv=fx("interval"),
    ego_raw=fx("ego"),
    obj_raw=fx("object"),
    st_raw=fx("status"),
    ego=("SELECT e.recording_id, round(e.ptp_time, 1) AS ptp_time, e.VelocityX, e.VelocityY, "
         "e.vehicle, sqrt(pow(e.VelocityX, 2) + pow(e.VelocityY, 2)) AS Velocity "
         "FROM ego_raw e JOIN iv ON e.recording_id = iv.recording_id "
         "AND e.ptp_time >= iv.start_time AND e.ptp_time <= iv.end_time"),
    obj_hw=("SELECT o.recording_id, round(o.ptp_time, 1) AS ptp_time, o.TrackingID, o.MessageNumber, "
            "o.VelocityX, o.VelocityY, o.VelocityZ, o.PositionX, o.PositionY, o.vehicle "
            "FROM obj_raw o JOIN iv ON o.recording_id = iv.recording_id "
            "AND o.ptp_time >= iv.start_time AND o.ptp_time <= iv.end_time"),
    obj=("SELECT DISTINCT * FROM obj_hw WHERE abs(VelocityX) < 200 AND abs(VelocityY) < 200 "
         "AND abs(VelocityZ) < 200 AND VelocityX > -1 AND PositionY < 5 AND PositionY > -5 "
         "AND PositionX < 40"),
    st=("SELECT round(s.ptp_time_rounded, 1) AS ptp_time, s.recording_id, s.vehicle, "
        "s.BrakePedalPosition, s.BrakeSwitch, s.BrakeLight_rqst, s.LateralAcceleration, "
        "s.LongitudinalAcceleration, s.VehicleDirSAE_VehSpeed, s.WheelBasedVehicleSpeed, "
        "s.LaneChangeStatus, s.YawRate, s.SteeringWheelAngle "
        "FROM st_raw s JOIN iv ON s.recording_id = iv.recording_id "
        "AND s.ptp_time_rounded >= iv.start_time AND s.ptp_time_rounded <= iv.end_time"),
    lc=("SELECT DISTINCT ptp_time, recording_id, 1 AS status FROM st "
        "WHERE LaneChangeStatus <> 0 AND VehicleDirSAE_VehSpeed > 30"),
    eb=("SELECT DISTINCT ptp_time, recording_id, 2 AS status FROM st WHERE LaneChangeStatus = 0 "
        "AND BrakeSwitch <> 0 AND BrakePedalPosition > 15 AND VehicleDirSAE_VehSpeed > 30 "
        "AND BrakeLight_rqst <> 0"),
    tu=("SELECT DISTINCT ptp_time, recording_id, 3 AS status FROM st WHERE LaneChangeStatus = 0 "
        "AND abs(SteeringWheelAngle) > 0.4 AND VehicleDirSAE_VehSpeed > 60"),
    summary=("SELECT o.recording_id, o.ptp_time, count(*) AS count, avg(o.VelocityX) AS avg_v, "
             "avg(e.Velocity) AS ego_v FROM obj o JOIN ego e "
             "ON o.ptp_time = e.ptp_time AND o.recording_id = e.recording_id GROUP BY 1, 2"),
    cg=("SELECT DISTINCT ptp_time, recording_id, 4 AS status FROM summary "
        "WHERE count > 4 AND avg_v < 15 AND ego_v < 15"),
    final=("SELECT o.*, coalesce(cg.status, tu.status, eb.status, lc.status, 0) AS status FROM obj o "
           "LEFT JOIN lc ON o.ptp_time = lc.ptp_time AND o.recording_id = lc.recording_id "
           "LEFT JOIN eb ON o.ptp_time = eb.ptp_time AND o.recording_id = eb.recording_id "
           "LEFT JOIN tu ON o.ptp_time = tu.ptp_time AND o.recording_id = tu.recording_id "
           "LEFT JOIN cg ON o.ptp_time = cg.ptp_time AND o.recording_id = cg.recording_id"),
)


def scene(body: str) -> str:
    return with_(body, **SCENE)


SQL["highway_filter"] = scene(
    "SELECT recording_id, ptp_time, VelocityX, VelocityY, vehicle FROM ego")
SQL["time_grid"] = with_(
    "SELECT recording_id, TrackingID, MessageNumber, ptp_time, round(ptp_time, 1) AS ptp_time_grid "
    "FROM obj_raw", obj_raw=fx("object"))
SQL["ego_speed"] = with_(
    "SELECT recording_id, ptp_time, VelocityX, VelocityY, "
    "round(sqrt(pow(VelocityX, 2) + pow(VelocityY, 2)), 6) AS Velocity FROM ego_raw",
    ego_raw=fx("ego"))
SQL["object_roi"] = with_(
    "SELECT * FROM obj_raw WHERE abs(VelocityX) < 200 AND abs(VelocityY) < 200 "
    "AND abs(VelocityZ) < 200 AND VelocityX > -1 AND PositionY < 5 AND PositionY > -5 "
    "AND PositionX < 40", obj_raw=fx("object"))
SQL["object_dedup"] = scene("SELECT * FROM obj")
SQL["status_projection"] = with_(
    "SELECT ptp_time_rounded AS ptp_time, recording_id, vehicle, BrakePedalPosition, BrakeSwitch, "
    "BrakeLight_rqst, LateralAcceleration, LongitudinalAcceleration, VehicleDirSAE_VehSpeed, "
    "WheelBasedVehicleSpeed, LaneChangeStatus, YawRate, SteeringWheelAngle FROM st_raw",
    st_raw=fx("status"))
SQL["label_lane_change"] = scene("SELECT * FROM lc")
SQL["label_emergency_brake"] = scene("SELECT * FROM eb")
SQL["label_turning"] = scene("SELECT * FROM tu")
SQL["label_congestion"] = scene("SELECT * FROM cg")
SQL["scene_summary"] = scene(
    "SELECT recording_id, ptp_time, count, round(avg_v, 6) AS avg_v, round(ego_v, 6) AS ego_v "
    "FROM summary")
SQL["ego_object_join"] = scene(
    "SELECT o.*, e.VelocityY AS ego_VelocityY, e.vehicle AS ego_vehicle, "
    "round(e.Velocity, 6) AS Velocity FROM obj o JOIN ego e "
    "ON o.ptp_time = e.ptp_time AND o.recording_id = e.recording_id")
SQL["scenario_overlay"] = scene("SELECT * FROM final")
SQL["scenario_labels"] = scene("SELECT * FROM final")
SQL["scenario_labels_store"] = SQL["scenario_labels"]
SQL["interval_ends"] = with_(
    "SELECT t.recording_id, v.id, count(*) AS n, min(t.ptp_time) AS first, max(t.ptp_time) AS last FROM tr t JOIN iv v "
    "ON t.recording_id = v.recording_id AND t.ptp_time >= v.start_time AND t.ptp_time <= v.end_time "
    "WHERE NOT isnan(v.start_time) AND NOT isnan(v.end_time) GROUP BY t.recording_id, v.id",
    tr=fx("track"), iv=fx("odd_interval"))
SQL["speed_attach"] = scene(
    "SELECT f.*, st.VehicleDirSAE_VehSpeed FROM final f LEFT JOIN st "
    "ON f.ptp_time = st.ptp_time AND f.recording_id = st.recording_id")
SQL["rows_per_vehicle"] = scene("SELECT vehicle, count(*) AS count FROM ego GROUP BY vehicle")
SQL["label_counts"] = scene("SELECT status, count(*) AS count FROM final GROUP BY status")
SQL["labelled_total"] = scene(
    "SELECT count(*) FILTER (WHERE status <> 0) AS labelled_rows FROM final")


# --- sequence operators -----------------------------------------------------------------

def with_rec(body: str, **ctes: str) -> str:
    return "WITH RECURSIVE " + with_(body, **ctes)[len("WITH "):]


def _eq(a: str, b: str, cols: list[str]) -> str:
    return " AND ".join(f"{a}.{c} = {b}.{c}" for c in cols)


def scan_ctes(base: str, group: list[str], value: str, mn: int, mx: int, lo: float,
              hi: float | None, tol: float = 0.001, jump: int = 41, p: str = "s") -> dict:
    """Greedy yaw-return scan: every candidate pair by self-join, first hit
    per row, then the walk from row 0 as a recursive CTE."""
    g = ", ".join(group)
    hi_cond = f" AND abs(m.{value} - a.{value}) < {hi!r}" if hi is not None else ""
    mid = "((a.i + b.i) // 2 + ((a.i + b.i) % 2) * (((a.i + b.i) // 2) % 2))"
    return {
        f"{p}_g": (f"SELECT {g}, ptp_time, {value}, row_number() OVER "
                   f"(PARTITION BY {g} ORDER BY ptp_time) - 1 AS i FROM {base}"),
        f"{p}_cand": (f"SELECT {', '.join('a.' + c for c in group)}, a.i, b.i - a.i AS k, "
                      f"b.ptp_time AS tj FROM {p}_g a JOIN {p}_g b ON {_eq('a', 'b', group)} "
                      f"AND b.i BETWEEN a.i + 1 AND a.i + {mx} "
                      f"JOIN {p}_g m ON {_eq('a', 'm', group)} AND m.i = {mid} "
                      f"WHERE abs(b.{value} - a.{value}) <= {tol!r} "
                      f"AND abs(m.{value} - a.{value}) > {lo!r}{hi_cond}"),
        f"{p}_first": (f"SELECT {g}, i, min(k) AS k, arg_min(tj, k) AS tj FROM {p}_cand "
                       f"GROUP BY {g}, i"),
        f"{p}_steps": (f"SELECT {', '.join('x.' + c for c in group)}, x.i, x.ptp_time AS ti, f.k, f.tj, "
                       f"CASE WHEN f.k IS NULL THEN 1 WHEN f.k >= {mn} THEN {jump} ELSE 2 END AS step "
                       f"FROM {p}_g x LEFT JOIN {p}_first f ON {_eq('x', 'f', group)} AND x.i = f.i"),
        f"{p}_walk": (f"SELECT DISTINCT {g}, CAST(0 AS BIGINT) AS i FROM {p}_g UNION ALL "
                      f"SELECT {', '.join('w.' + c for c in group)}, w.i + st.step FROM {p}_walk w "
                      f"JOIN {p}_steps st ON {_eq('w', 'st', group)} AND st.i = w.i"),
        f"{p}_pairs": (f"SELECT {', '.join('st.' + c for c in group)}, st.i, st.i + st.k AS j, "
                       f"st.ti AS t_i, st.tj AS t_j FROM {p}_walk w JOIN {p}_steps st "
                       f"ON {_eq('w', 'st', group)} AND st.i = w.i WHERE st.step = {jump} "
                       f"AND st.k >= {mn}"),
    }


TRACK = dict(
    tr=fx("track"),
    ti=fx("track_interval"),
    tin=("SELECT t.*, v.id FROM tr t JOIN ti v ON t.recording_id = v.recording_id "
         "AND t.ptp_time >= v.start_time AND t.ptp_time <= v.end_time"),
)
TG = ["recording_id", "id"]


def stitch_ctes(src: str, group: list[str], p: str = "ps") -> dict:
    g = ", ".join(group)
    w = f"(PARTITION BY {g} ORDER BY ptp_time)"
    jump = (f"(row_no >= 2 AND (abs(PositionX - x1) > 20 OR abs(PositionY - y1) > 20))")
    run = f"OVER (PARTITION BY {g} ORDER BY row_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return {
        f"{p}0": (f"SELECT *, row_number() OVER {w} - 1 AS row_no, "
                  f"lag(PositionX, 1) OVER {w} AS x1, lag(PositionX, 2) OVER {w} AS x2, "
                  f"lag(PositionY, 1) OVER {w} AS y1, lag(PositionY, 2) OVER {w} AS y2, "
                  f"lag(PositionZ, 1) OVER {w} AS z1, lag(PositionZ, 2) OVER {w} AS z2 FROM {src}"),
        f"{p}1": (f"SELECT *, {jump} AS is_jump, "
                  f"CASE WHEN {jump} THEN x1 * 1.5 - x2 * 0.5 ELSE 0 END AS dx, "
                  f"CASE WHEN {jump} THEN y1 * 1.5 - y2 * 0.5 ELSE 0 END AS dy, "
                  f"CASE WHEN {jump} THEN z1 * 1.5 - z2 * 0.5 ELSE 0 END AS dz FROM {p}0"),
        f"{p}": (f"SELECT * REPLACE (PositionX + sum(dx) {run} AS PositionX, "
                 f"PositionY + sum(dy) {run} AS PositionY, PositionZ + sum(dz) {run} AS PositionZ) "
                 f"FROM {p}1"),
    }


def heading_ctes(src: str, group: list[str], p: str = "hd") -> dict:
    g = ", ".join(group)
    w = f"(PARTITION BY {g} ORDER BY row_no)"
    return {
        f"{p}0": (f"SELECT *, CASE WHEN row_no >= 5 THEN atan2(PositionY - lag(PositionY, 5) OVER {w}, "
                  f"PositionX - lag(PositionX, 5) OVER {w}) END AS angle0 FROM {src}"),
        f"{p}5": f"SELECT {g}, angle0 AS a5 FROM {p}0 WHERE row_no = 5",
        f"{p}": (f"SELECT x.*, CASE WHEN x.row_no < 5 THEN y.a5 ELSE x.angle0 END AS angle "
                 f"FROM {p}0 x LEFT JOIN {p}5 y ON {_eq('x', 'y', group)}"),
    }


def scan_sql(spec, value="Yaw", base="tin", pre: dict | None = None, select=None) -> str:
    mn, mx, lo, hi = spec
    ctes = dict(TRACK)
    ctes.update(pre or {})
    ctes.update(scan_ctes(base, TG, value, mn, mx, lo, hi))
    return with_rec(select or "SELECT * FROM s_pairs", **ctes)


SQL["lane_change_scan"] = scan_sql((40, 70, 0.015, 0.1))
SQL["lane_change_scan_b"] = scan_sql((40, 80, 0.013, 0.2))
SQL["long_manoeuvre_scan"] = scan_sql((100, 150, 0.015, None))
WINDOWS_A = ("SELECT *, round(t_i * 0.5 - 6.0 + t_j * 0.5, 6) AS lc_start, "
             "round(t_i * 0.5 + 6.0 + t_j * 0.5, 6) AS lc_end FROM s_pairs")
SQL["lane_change_windows"] = scan_sql((30, 70, 0.015, 0.1), select=WINDOWS_A)


def _two_scans(first, second, body: str) -> str:
    ctes = dict(TRACK)
    ctes.update(scan_ctes("tin", TG, "Yaw", *first, p="a"))
    ctes.update(scan_ctes("tin", TG, "Yaw", *second, p="b"))
    return with_rec(body, **ctes)


SQL["lane_change_refined"] = _two_scans(
    (40, 70, 0.015, 0.1), (100, 150, 0.015, None),
    "SELECT * FROM a_pairs s WHERE NOT EXISTS (SELECT 1 FROM b_pairs l WHERE "
    "l.recording_id = s.recording_id AND l.id = s.id AND l.t_i <= s.t_i AND l.t_j >= s.t_j)")
SQL["containment_anti"] = _two_scans(
    (30, 70, 0.015, 0.1), (100, 150, 0.015, None),
    "SELECT recording_id, id, i, j, round(lc_start, 6) AS lc_start, round(lc_end, 6) AS lc_end "
    "FROM (SELECT *, t_i * 0.5 - 6.0 + t_j * 0.5 AS lc_start, t_i * 0.5 + 6.0 + t_j * 0.5 AS lc_end "
    "FROM a_pairs) s WHERE NOT EXISTS (SELECT 1 FROM b_pairs l WHERE "
    "l.recording_id = s.recording_id AND l.id = s.id AND l.t_i <= s.lc_start AND l.t_j >= s.lc_end)")

_ST = stitch_ctes("tr", ["recording_id"])
SQL["position_stitch"] = with_(
    "SELECT recording_id, ptp_time, row_no, round(PositionX, 6) AS PositionX, "
    "round(PositionY, 6) AS PositionY, round(PositionZ, 6) AS PositionZ, is_jump FROM ps",
    tr=fx("track"), **_ST)
_X = "CASE WHEN isnan(PositionX) THEN NULL ELSE PositionX END"
_GAP = dict(
    g=f"SELECT recording_id, ptp_time, {_X} AS x, PositionX IS NULL OR isnan(PositionX) AS hole, PositionY AS y FROM gt",
    w=("SELECT *, row_number() OVER w - 1 AS row_no, lag(x) OVER w AS x1, lag(x, 2) OVER w AS x2, lag(y) OVER w AS y1, "
       "lag(y, 2) OVER w AS y2 FROM g WINDOW w AS (PARTITION BY recording_id ORDER BY ptp_time)"),
    m="SELECT *, row_no >= 2 AND (coalesce(abs(x - x1) > 20, false) OR coalesce(abs(y - y1) > 20, false)) AS is_jump FROM w",
    o=("SELECT *, CASE WHEN is_jump THEN coalesce(x1 * 1.5 - x2 * 0.5, 0) ELSE 0 END AS dx, CAST(is_jump AND (x1 IS NULL OR x2 IS NULL) AS INTEGER) AS lost, "
       "CASE WHEN is_jump THEN y1 * 1.5 - y2 * 0.5 ELSE 0 END AS dy FROM m"),
    r=("SELECT *, sum(dx) OVER w AS sx, sum(dy) OVER w AS sy, sum(lost) OVER w AS n_lost FROM o WINDOW w AS "
       "(PARTITION BY recording_id ORDER BY row_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"),
)
SQL["gap_stitch"] = with_(
    "SELECT recording_id, ptp_time, row_no, is_jump, round(y + sy, 6) AS PositionY, "
    "CASE WHEN n_lost = 0 AND NOT hole THEN round(x + sx, 6) END AS PositionX FROM r", gt=fx("gap_track"), **_GAP)
_HD = heading_ctes("(SELECT *, row_number() OVER (PARTITION BY recording_id ORDER BY ptp_time) - 1 "
                   "AS row_no FROM tr)", ["recording_id"])
SQL["heading"] = with_("SELECT recording_id, ptp_time, row_no, round(angle, 6) AS angle FROM hd",
                       tr=fx("track"), **_HD)
SQL["trajectory_pipeline"] = scan_sql((40, 70, 0.015, 0.1))
SQL["heading_scan"] = scan_sql(
    (45, 80, 0.01, 0.02), value="angle", base="hd",
    pre={**stitch_ctes("tin", TG), **heading_ctes("ps", TG)})

SQL["polyline_merge"] = with_(
    "SELECT recording_id, ptp_time, CAST(run_no AS BIGINT) AS run_no, any_value(TrackingID) AS TrackingID, "
    "min(line_seq) AS line_seq, CAST(sum(len(BoundaryLineX)) AS INTEGER) AS n_points, "
    "arg_max(BoundaryLineX[len(BoundaryLineX)], line_seq) AS x_last, "
    "round(sum(list_sum(BoundaryLineY)), 6) AS y_sum, "
    "round(arg_max(BoundaryLineY[len(BoundaryLineY)], line_seq), 6) AS y_last "
    "FROM runs GROUP BY recording_id, ptp_time, run_no",
    pl=fx("polyline"),
    marks=("SELECT *, coalesce(lag(TrackingID) OVER (PARTITION BY recording_id, ptp_time "
           "ORDER BY line_seq) <> TrackingID, true) AS new_run FROM pl"),
    runs=("SELECT *, sum(CAST(new_run AS INTEGER)) OVER (PARTITION BY recording_id, ptp_time "
          "ORDER BY line_seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_no FROM marks"),
)
SQL["pose_recentre"] = with_(
    "SELECT t.recording_id, t.ptp_time, round(t.PositionX - r.PositionX, 6) AS AdjustedPositionX, "
    "round(t.PositionY - r.PositionY, 6) AS AdjustedPositionY FROM tr t JOIN "
    "(SELECT t2.recording_id, t2.PositionX, t2.PositionY FROM tr t2 JOIN reft USING (recording_id) "
    "WHERE abs(t2.ptp_time - reft.ref_time) < 0.05 "
    "QUALIFY row_number() OVER (PARTITION BY t2.recording_id ORDER BY t2.ptp_time) = 1) r "
    "USING (recording_id)",
    tr=fx("track"),
    reft="SELECT recording_id, min(ptp_time) AS ref_time FROM tr WHERE ptp_time >= 100 GROUP BY 1",
)


# --- geometry ----------------------------------------------------------------------------

def d_len(x="BoundaryLineX", y="BoundaryLineY") -> str:
    n = f"least(len({x}), len({y}))"
    seg = f"sqrt(pow({x}[k + 1] - {x}[k], 2) + pow({y}[k + 1] - {y}[k], 2))"
    return (f"CASE WHEN {n} >= 2 THEN list_reduce(list_transform(range(1, {n}), lambda k: {seg}), "
            f"lambda a, b: a + b) ELSE CAST(0 AS DOUBLE) END")


def d_near(x: str, y: str, px: str, py: str, d: float) -> str:
    n = f"least(len({x}), len({y}))"
    ax, ay = f"{x}[k]", f"{y}[k]"
    vx, vy = f"({x}[k + 1] - {ax})", f"({y}[k + 1] - {ay})"
    wx, wy = f"({px} - {ax})", f"({py} - {ay})"
    ll = f"({vx} * {vx} + {vy} * {vy})"
    t = (f"(CASE WHEN {ll} = 0 THEN CAST(0 AS DOUBLE) ELSE greatest(CAST(0 AS DOUBLE), "
         f"least(CAST(1 AS DOUBLE), ({wx} * {vx} + {wy} * {vy}) / {ll})) END)")
    dist = f"sqrt(({wx} - {t} * {vx}) * ({wx} - {t} * {vx}) + ({wy} - {t} * {vy}) * ({wy} - {t} * {vy}))"
    return (f"CASE WHEN {n} < 2 THEN false ELSE "
            f"len(list_filter(range(1, {n}), lambda k: {dist} < {d!r})) > 0 END")


R2_CTES = dict(
    pl=fx("polyline"),
    pl_m=("SELECT *, least(len(BoundaryLineX), len(BoundaryLineY)) AS n, "
          "list_reduce(BoundaryLineX[1:least(len(BoundaryLineX), len(BoundaryLineY))], "
          "lambda a, b: a + b) / least(len(BoundaryLineX), len(BoundaryLineY)) AS mx, "
          "list_reduce(BoundaryLineY[1:least(len(BoundaryLineX), len(BoundaryLineY))], "
          "lambda a, b: a + b) / least(len(BoundaryLineX), len(BoundaryLineY)) AS my FROM pl"),
    pl_s=("SELECT *, "
          "list_reduce(list_transform(range(1, n + 1), lambda k: (BoundaryLineX[k] - mx) * "
          "(BoundaryLineX[k] - mx)), lambda a, b: a + b) AS sxx, "
          "list_reduce(list_transform(range(1, n + 1), lambda k: (BoundaryLineY[k] - my) * "
          "(BoundaryLineY[k] - my)), lambda a, b: a + b) AS syy, "
          "list_reduce(list_transform(range(1, n + 1), lambda k: (BoundaryLineX[k] - mx) * "
          "(BoundaryLineY[k] - my)), lambda a, b: a + b) AS sxy FROM pl_m"),
    pl_r2=(f"SELECT *, CASE WHEN n <= 2 THEN 1.0 WHEN syy = 0 THEN 1.0 WHEN sxx = 0 THEN 0.0 "
           f"ELSE sxy * sxy / (sxx * syy) END AS r2, {d_len()} AS length FROM pl_s"),
    scene=("SELECT recording_id, ptp_time, "
           "sum(CASE WHEN r2 > 0.97 THEN length ELSE 0 END) / nullif(sum(length), 0) AS share "
           "FROM pl_r2 GROUP BY recording_id, ptp_time"),
)

SQL["polyline_length"] = with_(
    f"SELECT recording_id, ptp_time, line_seq, round({d_len()}, 6) AS length FROM pl",
    pl=fx("polyline"))
SQL["polyline_straightness"] = with_(
    "SELECT recording_id, ptp_time, line_seq, round(r2, 6) AS r2 FROM pl_r2", **R2_CTES)
SQL["straight_scene"] = with_(
    "SELECT recording_id, ptp_time, round(share, 6) AS straight_share, "
    "coalesce(share > 0.6, false) AS is_straight FROM scene", **R2_CTES)
SQL["straight_times"] = with_(
    "SELECT recording_id, ptp_time FROM scene WHERE share > 0.6", **R2_CTES)
SQL["point_near_polyline"] = with_(
    "SELECT l.recording_id, l.ptp_time, l.TrackingID, "
    f"{d_near('l.BoundaryLineX', 'l.BoundaryLineY', 't.PositionX', 't.PositionY', 0.1)} AS near_01, "
    f"{d_near('l.BoundaryLineX', 'l.BoundaryLineY', 't.PositionX', 't.PositionY', 0.5)} AS near_05 "
    "FROM lanes l JOIN tr t ON l.recording_id = t.recording_id AND l.ptp_time = t.ptp_time",
    lanes=lane_line_sql(), tr=fx("track"))


def lane_change_sql(spec, pad: int, body: str) -> str:
    mn, mx, lo, hi = spec
    ctes = dict(tr=fx("track"), ti=fx("track_interval"), lanes=lane_line_sql())
    ctes["tin"] = ("SELECT t.*, v.id FROM tr t JOIN ti v ON t.recording_id = v.recording_id "
                   f"AND t.ptp_time >= v.start_time - {pad} AND t.ptp_time <= v.end_time + {pad}")
    ctes.update(scan_ctes("tin", TG, "Yaw", mn, mx, lo, hi))
    ctes["win"] = "SELECT *, t_i * 0.5 - 6.0 + t_j * 0.5 AS lc_start, t_i * 0.5 + 6.0 + t_j * 0.5 AS lc_end FROM s_pairs"
    ctes["firstego"] = ("SELECT w.recording_id, w.id, w.i, w.lc_start, w.lc_end, "
                        "arg_min(e.ptp_time, e.ptp_time) AS et, arg_min(e.PositionX, e.ptp_time) AS ex, "
                        "arg_min(e.PositionY, e.ptp_time) AS ey FROM win w JOIN tin e "
                        "ON e.recording_id = w.recording_id AND e.id = w.id "
                        "AND e.ptp_time >= w.lc_start AND e.ptp_time <= w.lc_end "
                        "GROUP BY w.recording_id, w.id, w.i, w.lc_start, w.lc_end")
    ctes["valid"] = ("SELECT f.recording_id, f.id, f.i, f.lc_start, f.lc_end FROM firstego f "
                     "JOIN ti v ON v.recording_id = f.recording_id AND v.id = f.id "
                     "JOIN lanes l ON l.recording_id = f.recording_id AND l.ptp_time = f.et "
                     "AND l.ptp_time >= v.start_time AND l.ptp_time <= v.end_time WHERE "
                     f"{d_near('l.BoundaryLineX', 'l.BoundaryLineY', 'f.ex', 'f.ey', 0.1)}")
    return with_rec(body, **ctes)


VALID_ROWS = ("SELECT recording_id, id, i, round(lc_start, 6) AS lc_start, "
              "round(lc_end, 6) AS lc_end FROM valid")
EXPORT = ("SELECT recording_id, id, CAST(count(*) AS INTEGER) AS n_windows, '[' || string_agg('(' || "
          "CAST(lc_start AS VARCHAR) || ', ' || CAST(lc_end AS VARCHAR) || ')', ', ' "
          "ORDER BY lc_start, lc_end) || ']' AS lc FROM valid GROUP BY recording_id, id")
SQL["lane_change_validate"] = lane_change_sql((30, 70, 0.015, 0.1), 0, VALID_ROWS)
SQL["lane_change_pipeline"] = lane_change_sql((30, 70, 0.015, 0.1), 0, EXPORT)
SQL["lane_change_pipeline_padded"] = lane_change_sql((40, 80, 0.013, 0.2), 10, VALID_ROWS)
SQL["lane_change_export"] = lane_change_sql(
    (30, 70, 0.015, 0.1), 0, f"SELECT recording_id, lc FROM ({EXPORT})")

SQL["boundary_cross_any"] = with_(
    "SELECT v.recording_id, v.id, coalesce(h.crossed, false) AS crossed FROM "
    "(SELECT DISTINCT recording_id, id FROM ti) v LEFT JOIN hit h "
    "ON h.recording_id = v.recording_id AND h.id = v.id",
    tr=fx("track"), ti=fx("track_interval"), lanes=lane_line_sql(),
    e=("SELECT t.recording_id, v.id, t.ptp_time, t.PositionX, t.PositionY FROM tr t JOIN ti v "
       "ON t.recording_id = v.recording_id AND t.ptp_time BETWEEN v.start_time AND v.end_time"),
    l=("SELECT ln.*, v.id FROM lanes ln JOIN ti v ON ln.recording_id = v.recording_id "
       "AND ln.ptp_time BETWEEN v.start_time AND v.end_time"),
    hit=("SELECT DISTINCT e.recording_id, e.id, true AS crossed FROM e JOIN l "
         "ON e.recording_id = l.recording_id AND e.id = l.id AND l.ptp_time > e.ptp_time WHERE "
         f"{d_near('l.BoundaryLineX', 'l.BoundaryLineY', 'e.PositionX', 'e.PositionY', 0.5)}"),
)


# --- statistics and remaining filters ------------------------------------------------------

SQL["signal_quantiles"] = with_(
    "SELECT recording_id, quantile_disc(Yaw, 0.25) AS q25, quantile_disc(Yaw, 0.75) AS q75 "
    "FROM tr GROUP BY recording_id", tr=fx("track"))
SQL["signal_quantiles_default"] = with_(
    "SELECT recording_id, count(Yaw) AS n, true AS q25_within, true AS q75_within FROM tr GROUP BY recording_id",
    tr=fx("track"))
SQL["sketch_quantiles"] = with_(
    "SELECT substring(recording_id, 6, 1) AS fleet, count(*) AS n, min(PositionX) AS least, max(PositionX) AS greatest, "
    "true AS q25_within, true AS q75_within, true AS distinct_within FROM tr GROUP BY 1", tr=fx("track"))
_KNOWN = dict(gt=fx("gap_track"),
              k=("SELECT recording_id, CASE WHEN NOT isnan(Yaw) THEN Yaw END AS Yaw, "
                 "CASE WHEN NOT isnan(PositionX) THEN PositionX END AS PositionX FROM gt"))
SQL["gap_statistics"] = with_(
    "SELECT recording_id, quantile_disc(Yaw, 0.25) AS q25, quantile_disc(Yaw, 0.75) AS q75, max(Yaw) AS max_Yaw, min(Yaw) AS min_Yaw, "
    "max(PositionX) AS max_PositionX, min(PositionX) AS min_PositionX, count(DISTINCT Yaw) AS n_Yaw, "
    "count(DISTINCT PositionX) AS n_PositionX FROM k GROUP BY recording_id", **_KNOWN)
SQL["signal_extent"] = with_(
    "SELECT recording_id, max(Yaw) AS max_Yaw, min(Yaw) AS min_Yaw, max(YawRate) AS max_YawRate, "
    "min(YawRate) AS min_YawRate, max(VelocityY) AS max_VelocityY, min(VelocityY) AS min_VelocityY "
    "FROM tr GROUP BY recording_id", tr=fx("track"))
SQL["distinct_counts"] = with_(
    "SELECT count(DISTINCT recording_id) AS n_recording_id, count(DISTINCT country) AS n_country "
    "FROM g", g=fx("gnss"))
SQL["distinct_values"] = with_("SELECT DISTINCT tag_name_list FROM rt", rt=fx("road_type"))
SQL["recorded_hours"] = with_(
    "SELECT coalesce(sum(last_ptp_time - first_ptp_time), 0) AS total_seconds, "
    "round(coalesce(sum(last_ptp_time - first_ptp_time), 0) / 3600, 6) AS hours FROM fm "
    "WHERE first_ptp_time IS NOT NULL AND last_ptp_time IS NOT NULL "
    "AND filename_parquet IS NOT NULL AND filename_parquet <> ''", fm=fx("file_meta"))
IL = dict(
    il=fx("interval_list"),
    ilp=("SELECT recording_id, from_json(intervals, '[[\"DOUBLE\"]]') AS lst FROM il"),
    ilx=("SELECT recording_id, generate_subscripts(lst, 1) - 1 AS pos, unnest(lst) AS pr FROM ilp"),
    ile="SELECT recording_id, CAST(pos AS INTEGER) AS pos, pr[1] AS start_time, pr[2] AS end_time FROM ilx",
)
SQL["interval_list_explode"] = with_("SELECT * FROM ile", **IL)
SQL["highway_hours"] = with_(
    "SELECT round(sum(end_time - start_time), 6) AS total_seconds, "
    "round(sum(end_time - start_time) / 3600, 6) AS hours FROM ile", **IL)


def hist_sql(col: str, bins: int, **source: str) -> str:
    return with_(
        f"SELECT bin, lo + (hi - lo) * bin / {bins} AS bin_lo, "
        f"lo + (hi - lo) * (bin + 1) / {bins} AS bin_hi, count(*) AS count FROM "
        f"(SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor(({col} - lo) * {bins} / (hi - lo)), "
        f"{bins - 1}) END AS INTEGER) AS bin, lo, hi FROM tr, ext WHERE {col} IS NOT NULL) "
        f"GROUP BY bin, lo, hi",
        **source, ext=f"SELECT min({col}) AS lo, max({col}) AS hi FROM tr")


def density_sql(v: str, **source: str) -> str:
    return with_(
        "SELECT CAST(g AS INTEGER) AS g, round(lo + (hi - lo) * g / 199, 6) AS x, "
        "round(sum(exp(pow((lo + (hi - lo) * g / 199 - v) / bw, 2) * -0.5)) "
        "* (1 / sqrt(2 * pi())) / (bw * n), 6) AS density "
        "FROM v, grid, mom GROUP BY g, lo, hi, bw, n",
        **source, v=v,
        m0="SELECT count(*) AS n, stddev_samp(v) AS sd, min(v) AS vmin, max(v) AS vmax FROM v",
        mom=("SELECT n, sd * pow(CAST(n AS DOUBLE), -0.2) AS bw, vmin - sd * pow(CAST(n AS DOUBLE), -0.2) * 3 AS lo, "
             "vmax + sd * pow(CAST(n AS DOUBLE), -0.2) * 3 AS hi FROM m0"),
        grid="SELECT range AS g FROM range(200)",
    )


SQL["signal_histogram"] = hist_sql("YawRate", 20, tr=fx("track"))
SQL["signal_histogram_fine"] = hist_sql("PositionX", 10000, tr=fx("track"))
SQL["signal_density"] = density_sql("SELECT CAST(YawRate AS DOUBLE) AS v FROM tr WHERE abs(YawRate) > 0.005 AND YawRate IS NOT NULL", tr=fx("track"))
SQL["gap_histogram"] = hist_sql("PositionX", 20, **{**_KNOWN, "tr": "SELECT * FROM k"})
SQL["gap_density"] = density_sql("SELECT Yaw AS v FROM k WHERE Yaw IS NOT NULL", **_KNOWN)
SQL["geo_centre"] = with_(
    "SELECT round(median(etrs89_latitude), 6) AS centre_lat, "
    "round(median(etrs89_longitude), 6) AS centre_lon FROM g", g=fx("gnss"))
SQL["geo_density"] = with_(
    "SELECT floor(etrs89_latitude / 1.0)::BIGINT AS cell_lat, floor(etrs89_longitude / 1.0)::BIGINT AS cell_lon, "
    "count(*) AS count FROM g GROUP BY 1, 2", g=fx("gnss"))
SQL["epoch_convert"] = with_(
    "SELECT recording_id, ptp_time, strftime(make_timestamp(CAST(round(ptp_time * 1000000) AS BIGINT)), "
    "'%Y-%m-%d %H:%M:%S.%g') AS ts_text, "
    "CAST(round(ptp_time * 1000000) AS BIGINT) / 1000000.0 AS back FROM tr", tr=fx("track"))
SQL["drop_constant_columns"] = with_(
    "SELECT recording_id, ptp_time, Yaw, YawRate, PositionX, Unused FROM s", s=fx("signal"))
HIGHWAY_TAGS = ("('[Road, Type, Primary highway]', '[Road, Type, Secondary highway]', "
                "'[Road, Type, Motorway]')")
SQL["road_type_filter"] = with_(
    f"SELECT * FROM rt WHERE tag_name_list IN {HIGHWAY_TAGS}", rt=fx("road_type"))
SQL["highway_times"] = with_(
    f"SELECT DISTINCT recording_id, start_datetime, end_datetime FROM rt "
    f"WHERE tag_name_list IN {HIGHWAY_TAGS} ORDER BY recording_id, start_datetime", rt=fx("road_type"))
SQL["country_split"] = with_(
    "SELECT recording_id, country, CASE WHEN country = 'Japan' THEN 'japan' "
    "WHEN country = 'Brazil' THEN 'brazil' ELSE 'europe' END AS country_group, etrs89_latitude "
    "FROM g WHERE country <> 'no country'", g=fx("gnss"))
SQL["odd_motion"] = with_("SELECT * FROM tr WHERE VelocityY > 15 AND abs(VelocityX) < 2",
                          tr=fx("track"))
SQL["yaw_rate_filter"] = with_(
    "SELECT recording_id, ptp_time, YawRate FROM tr WHERE abs(YawRate) > 0.005", tr=fx("track"))
SQL["interval_pad"] = with_(
    "SELECT recording_id, id, start_time - 10 AS start_time, end_time + 10 AS end_time FROM ti",
    ti=fx("track_interval"))
SQL["time_slice"] = with_("SELECT * FROM tr WHERE ptp_time BETWEEN 100 AND 900", tr=fx("track"))
SQL["time_slice_text"] = SQL["time_slice"]
SQL["first_rows"] = with_("SELECT * FROM tr ORDER BY ptp_time, recording_id LIMIT 10",
                          tr=fx("track"))


# --- tables, metadata, tags, sources ------------------------------------------------------

NKEYS = ("SELECT n_nationkey AS key_no, n_regionkey AS region, concat('FH', cast(2000 + n_nationkey % 20 as string), "
         "'_202203', cast(10 + n_nationkey % 20 as string), '_00') AS recording_id FROM nation")
FIXED_DATE = "2024/01/01_00:00:00"

SQL["key_lookup"] = with_(
    "SELECT f.* FROM fm f JOIN k ON f.recording_id IS NOT DISTINCT FROM k.recording_id "
    "AND f.filename_parquet IS NOT DISTINCT FROM k.filename_parquet",
    fm=fx("file_meta"), nk=NKEYS,
    k=("SELECT recording_id, CASE WHEN region < 3 THEN NULL ELSE '' END AS filename_parquet FROM nk"))
SQL["key_exists"] = with_(
    "SELECT k.key_no, k.recording_id, k.filename_parquet, EXISTS (SELECT 1 FROM fm f WHERE "
    "f.recording_id IS NOT DISTINCT FROM k.recording_id AND f.filename_parquet IS NOT DISTINCT FROM "
    "k.filename_parquet) AS \"exists\" FROM k",
    fm=fx("file_meta"), nk=NKEYS,
    k=("SELECT key_no, CASE WHEN region = 2 THEN concat('missing_', cast(key_no AS VARCHAR)) "
       "ELSE recording_id END AS recording_id, CAST(NULL AS VARCHAR) AS filename_parquet FROM nk"))
SQL["key_exists_own"] = with_(
    "SELECT file_id, recording_id, filename_parquet, true AS \"exists\" FROM fm WHERE file_id % 2 = 0", fm=fx("file_meta"))
NEW_ROWS = ("SELECT recording_id, CAST(key_no AS DOUBLE) AS first_ptp_time, "
            "CAST(key_no + 5 AS DOUBLE) AS last_ptp_time, concat('new_', cast(key_no AS VARCHAR), "
            "'.parquet') AS filename_parquet, -key_no - 1 AS file_id FROM nk")
SQL["replace_rows"] = with_(
    f"SELECT *, '{FIXED_DATE}' AS write_date FROM fm WHERE recording_id NOT IN "
    f"(SELECT recording_id FROM nk WHERE region = 0) "
    f"UNION ALL SELECT *, '{FIXED_DATE}' AS write_date FROM nr",
    fm=fx("file_meta"), nk=NKEYS, nr=NEW_ROWS)
SQL["replace_in_store"] = with_(
    f"SELECT *, '{FIXED_DATE}' AS write_date FROM fm WHERE recording_id NOT IN "
    f"(SELECT recording_id FROM nk WHERE region = 0) "
    f"UNION ALL SELECT *, '{FIXED_DATE}' AS write_date FROM nr WHERE file_id > -15",
    fm=fx("file_meta"), nk=NKEYS, nr=NEW_ROWS)
SQL["update_in_store"] = with_(
    f"SELECT recording_id, first_ptp_time, CASE WHEN filename_parquet = '' THEN 0.0 ELSE last_ptp_time END AS last_ptp_time, "
    f"CASE WHEN filename_parquet = '' THEN 'unnamed' ELSE filename_parquet END AS filename_parquet, file_id, '{FIXED_DATE}' AS write_date FROM fm",
    fm=fx("file_meta"))
SQL["update_by_key"] = with_(
    "SELECT recording_id, first_ptp_time, CASE WHEN hit THEN 0.0 ELSE last_ptp_time END AS last_ptp_time, "
    "CASE WHEN hit THEN 'updated.parquet' ELSE filename_parquet END AS filename_parquet, file_id FROM "
    "(SELECT *, recording_id IN (SELECT recording_id FROM nk WHERE region = 1) AS hit FROM fm)",
    fm=fx("file_meta"), nk=NKEYS)
SQL["table_scan"] = "SELECT * FROM orders"
SQL["table_write_roundtrip"] = with_(f"SELECT *, '{FIXED_DATE}' AS write_to_db_date FROM fm",
                                     fm=fx("file_meta"))
SQL["metadata_outer_union"] = with_(
    "SELECT recording_id, first_ptp_time, file_id, CAST(NULL AS VARCHAR) AS country FROM fm "
    "UNION ALL SELECT recording_id, NULL, NULL, country FROM g",
    fm=fx("file_meta"), g=fx("gnss"))


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


AFTER = _strip("regexp_extract(line, '^.*:([^:]*)$', 1)")
BEFORE = _strip("CASE WHEN contains(line, ':') THEN regexp_extract(line, '^(.*):[^:]*$', 1) ELSE line END")
LOW = "lower(line)"
PED = f"(contains({LOW}, 'pedestrian') OR (contains({LOW}, 'ped') AND NOT contains({LOW}, 'stopped')))"
M = "func = 'MOIS'"
RULES = [
    (10, "start_recording", BEFORE, f"contains({LOW}, 'recording has started')"),
    (11, "stop_recording", BEFORE, f"contains({LOW}, 'recording has stopped')"),
    (50, "target_type", "'bike'", f"{M} AND (contains({LOW}, 'bike') OR {PED})"),
    (60, "target_type", "'pedestrian'", f"{M} AND {PED}"),
    (70, "scenario", "'crossing'", f"{M} AND contains({LOW}, 'target') AND contains({LOW}, 'right')"),
    (71, "side", "'right'", f"{M} AND contains({LOW}, 'right')"),
    (80, "scenario", "'crossing'", f"{M} AND contains({LOW}, 'target') AND contains({LOW}, 'left')"),
    (81, "side", "'left'", f"{M} AND contains({LOW}, 'left')"),
    (90, "scenario", "'longitudinal'", f"{M} AND contains({LOW}, 'center')"),
    (91, "side", "'center'", f"{M} AND contains({LOW}, 'center')"),
    (92, "target_type", "'bike'", f"{M} AND contains({LOW}, 'center')"),
    (100, "scenario", "'longitudinal'", f"{M} AND contains({LOW}, 'follow bike')"),
    (101, "target_type", "'bike'", f"{M} AND contains({LOW}, 'follow bike')"),
    (110, "target_speed", AFTER, f"{M} AND contains({LOW}, 'kph') AND contains(line, ':')"),
    (111, "scenario", "'crossing'", f"{M} AND contains({LOW}, 'kph')"),
    (120, "target_distance", AFTER, f"{M} AND contains({LOW}, ' m') AND contains(line, ':')"),
    (121, "scenario", "'crossing'", f"{M} AND contains({LOW}, ' m')"),
]
ANN = dict(
    ann=fx("annotation"),
    f0="SELECT path, arg_min(line, line_no) AS l0 FROM ann GROUP BY path",
    ln=f"SELECT a.*, {_strip('f0.l0')} AS func FROM ann a JOIN f0 USING (path)",
    cand=" UNION ALL ".join(
        f"SELECT path, line_no * 1000 + {r} AS o, '{f}' AS f, {v} AS v FROM ln WHERE {c}"
        for r, f, v, c in RULES),
    fields=("SELECT path, " + ", ".join(
        f"arg_max(v, o) FILTER (WHERE f = '{f}') AS {f}" for f in
        ["start_recording", "stop_recording", "target_type", "scenario", "side", "target_speed",
         "target_distance"]) + " FROM cand GROUP BY path"),
    files=(f"SELECT path, any_value(func) AS test_function, string_agg({AFTER}, ', ' ORDER BY line_no) "
           f"FILTER (WHERE contains({LOW}, 'ok') AND contains(line, ':')) AS pf, "
           f"string_agg(line, ' ' ORDER BY line_no) AS full_annotation FROM ln GROUP BY path"),
    parsed=("SELECT string_split(files.path, '/')[-3] || '_00' AS recording_id, "
            "files.path AS annotation_filename, test_function, 'JPT4' AS test_activity, scenario, side, "
            "target_type, target_speed, target_distance, CASE WHEN pf <> '' THEN pf END AS \"pass/fail\", "
            "start_recording, stop_recording, full_annotation FROM files LEFT JOIN fields USING (path)"),
)
SQL["annotation_parse"] = with_("SELECT * FROM parsed", **ANN)
SQL["metadata_build"] = with_(
    "SELECT *, string_split(recording_id, '_')[1] AS vehicle_id, "
    "CAST(strptime(string_split(recording_id, '_')[2], '%Y%m%d') AS DATE) AS test_date, "
    "'1: body, 2: chassis' AS channel_dbc_mapping FROM parsed "
    "QUALIFY row_number() OVER (PARTITION BY recording_id ORDER BY annotation_filename) = 1", **ANN)
SQL["recording_id_parts"] = with_(
    "SELECT recording_id, string_split(recording_id, '_')[1] AS vehicle_id, "
    "CAST(strptime(string_split(recording_id, '_')[2], '%Y%m%d') AS DATE) AS test_date "
    "FROM (SELECT DISTINCT recording_id FROM fm)", fm=fx("file_meta"))
SQL["path_recording_id"] = with_(
    "SELECT path, string_split(path, '/')[-3] || '_00' AS recording_id FROM (SELECT DISTINCT path FROM ann)",
    ann=fx("annotation"))
SQL["tag_filter"] = with_("SELECT * FROM tg WHERE tag IN ('click', 'view')", tg=fx("tag"))
SQL["tag_page"] = with_("SELECT * FROM tg ORDER BY tag_id LIMIT 5000 OFFSET 5000", tg=fx("tag"))
SQL["tag_page_next"] = with_("SELECT * FROM tg WHERE tag_id > 1000 ORDER BY tag_id LIMIT 5000", tg=fx("tag"))
SQL["tag_ranked_page"] = with_("SELECT * FROM tg ORDER BY start_time, tag_id LIMIT 700 OFFSET 900", tg=fx("tag"))
SQL["tag_json_flatten"] = with_(
    "SELECT tag_id, CAST(json_extract(item, '$.k') AS BIGINT) AS k, CAST(json_extract(item, '$.marks') AS VARCHAR) AS marks, "
    "CAST(json_extract(item, '$.who.id') AS BIGINT) AS \"who.id\", json_extract_string(item, '$.who.role.name') AS \"who.role.name\" FROM jt",
    jt=fx("json_tag"))
SQL["tag_flatten"] = with_(
    "SELECT recording_id, tag, start_time, end_time, "
    "CAST(json_extract(props, '$.k') AS INTEGER) AS \"props.k\", tag_id FROM tg", tg=fx("tag"))
SQL["tag_overlap"] = with_(
    "SELECT recording_id, CAST(min(s) AS DOUBLE) AS start_time, CAST(max(e) AS DOUBLE) AS end_time "
    "FROM isl GROUP BY recording_id, grp",
    tg=fx("tag"),
    t="SELECT * FROM tg WHERE tag IN ('click', 'view', 'error')",
    ev=("SELECT recording_id, tag, start_time AS t, 1 AS d FROM t UNION ALL "
        "SELECT recording_id, tag, end_time AS t, -1 AS d FROM t"),
    b=("SELECT recording_id, t, sum(CASE WHEN tag = 'click' THEN d ELSE 0 END) AS d0, "
       "sum(CASE WHEN tag = 'view' THEN d ELSE 0 END) AS d1, "
       "sum(CASE WHEN tag = 'error' THEN d ELSE 0 END) AS d2 FROM ev GROUP BY recording_id, t"),
    c=("SELECT recording_id, t, sum(d0) OVER w AS c0, sum(d1) OVER w AS c1, sum(d2) OVER w AS c2, "
       "lead(t) OVER (PARTITION BY recording_id ORDER BY t) AS nt FROM b "
       "WINDOW w AS (PARTITION BY recording_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"),
    pieces="SELECT recording_id, t AS s, nt AS e FROM c WHERE c0 > 0 AND c1 > 0 AND c2 = 0 AND nt IS NOT NULL",
    mk=("SELECT *, CASE WHEN lag(e) OVER (PARTITION BY recording_id ORDER BY s) = s THEN 0 ELSE 1 END "
        "AS new_isl FROM pieces"),
    isl=("SELECT *, sum(new_isl) OVER (PARTITION BY recording_id ORDER BY s "
         "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM mk"),
)
SQL["scan_recording"] = with_("SELECT * FROM tr", tr=fx("track"))
SQL["scan_one_recording"] = with_(
    "SELECT * FROM tr WHERE recording_id = (SELECT min(recording_id) FROM tr)", tr=fx("track"))
SQL["table_append_history"] = with_(
    " UNION ALL ".join(f"SELECT *, '{FIXED_DATE}' AS write_to_db_date, '{part}' AS part FROM fm"
                       for part in ("table", "table", "history", "history")), fm=fx("file_meta"))
SQL["lane_change_csv"] = SQL["lane_change_export"]
SQL["csv_signal_scan"] = with_("SELECT * FROM tr", tr=fx("track"))
SQL["interval_load"] = with_("SELECT * FROM iv", iv=fx("interval"))
_R2_OLD = dict(R2_CTES)
_R2_OLD["scene"] = R2_CTES["scene"].replace("r2 > 0.97", "r2 > 0.94")
SQL["straight_scene_old"] = with_(
    "SELECT recording_id, ptp_time, round(share, 6) AS straight_share, "
    "coalesce(share > 0.5, false) AS is_straight FROM scene", **_R2_OLD)
