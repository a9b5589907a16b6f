"""Tag queries (T4, T5, O3, X7), re-aimed from an HTTP tag service to
DataFrames of tags (recording_id, tag, start_time, end_time, ...)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajex.operators.sequence import CHUNK_ROWS, _chunk_prefix, chunk_rows, join_groups
from trajex.schema import TAG_PAGE_SIZE
from trajex.session import materialize

ISIN_MAX = 1000
TYPE_NAME = re.compile(r"[A-Z_]+(?:\([0-9, ]+\))?")


def _restrict(df: DataFrame, col: str, values: list | None) -> DataFrame:
    if not values:
        return df
    if len(values) <= ISIN_MAX:
        return df.where(F.col(col).isin(*values))
    keys = df.sparkSession.createDataFrame([(v,) for v in values], [col])
    return df.join(keys, col, "left_semi").select(*df.columns)


def tag_filter(tags: DataFrame, names: list[str] | None = None,
               recordings: list[str] | None = None, types: list[str] | None = None,
               sub_types: list[str] | None = None) -> DataFrame:
    """T4: tags with one of ``names``, on one of ``recordings``, of one of
    ``types`` and of one of ``sub_types`` (columns ``type`` and ``sub_type``);
    all that are given must hold, and none means every tag."""
    for col, values in (("tag", names), ("recording_id", recordings), ("type", types), ("sub_type", sub_types)):
        tags = _restrict(tags, col, values)
    return tags


def tag_page(tags: DataFrame, offset: int, limit: int = TAG_PAGE_SIZE,
             order: tuple[str, ...] = ("tag_id",)) -> DataFrame:
    """O3: one page of tags in a total order.  Every task keeps offset + limit
    rows; for deep pages see ``write_ranked`` and ``ranked_page``."""
    return tags.orderBy(*order).offset(offset).limit(limit)


def tag_page_after(tags: DataFrame, last: tuple, limit: int = TAG_PAGE_SIZE,
                   order: tuple[str, ...] = ("tag_id",)) -> DataFrame:
    """O3 by key: the page after the row whose ``order`` values are ``last``
    (empty: the first page).  Null values come before all others, as in
    ``tag_page``.  Earlier rows are filtered out, so any page costs each task at
    most ``limit`` rows."""
    if last:
        after = F.lit(False)
        for col, value in reversed(list(zip(order, last, strict=True))):
            c = F.col(col)
            more, same = (c.isNotNull(), c.isNull()) if value is None else (c > F.lit(value), c == F.lit(value))
            after = F.coalesce(more, F.lit(False)) | (F.coalesce(same, F.lit(False)) & after)
        tags = tags.where(after)
    return tags.orderBy(*order).limit(limit)


def write_ranked(tags: DataFrame, path: str, order: tuple[str, ...] = ("tag_id",), ranges: int | None = None) -> None:
    """O3 index: tags in ranges of the order, a folder ``_range=<n>`` each, with
    each row's place ``_rank`` in its range, under ``path``/rows; and the
    number of rows before each range under ``path``/ranges.  Rows equal in
    ``order`` keep one arbitrary order from then on and may stand in several
    ranges."""
    spark = tags.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = "_tie"
    dealt = tags.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(n, *order, tie).sortWithinPartitions(*order, tie)
    at = F.monotonically_increasing_id()  # the partition, and the place in it
    ranked = dealt.drop(tie).withColumn("_range", F.shiftright(at, 33)).withColumn("_rank", at.bitwiseAND(F.lit((1 << 33) - 1)))
    ranked.write.mode("errorifexists").partitionBy("_range").parquet(f"{path}/rows")
    stored = spark.read.schema(ranked.schema).parquet(f"{path}/rows")
    before = F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))  # a row a range
    sizes = stored.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.coalesce(before, F.lit(0)))
    sizes.coalesce(1).write.mode("errorifexists").parquet(f"{path}/ranges")


def ranked_page(spark: SparkSession, path: str, offset: int, limit: int = TAG_PAGE_SIZE) -> DataFrame:
    """O3 by rank: the page of an index.  The few rows of its ranges say which
    folders hold it; only these are read, and in them only the page's rows."""
    rows = spark.read.parquet(f"{path}/rows")
    sizes = spark.read.parquet(f"{path}/ranges").where((F.col("before") < offset + limit) & (F.col("before") + F.col("n") > offset))
    held = sorted((r["_range"], r["before"]) for r in sizes.collect())  # the ranges of one page
    page = F.lit(False)
    for number, before in held:
        page = page | ((F.col("_range") == number) & F.col("_rank").between(offset - before, offset + limit - 1 - before))
    found = rows.where(F.col("_range").isin([number for number, _ in held])).where(page)
    return found.orderBy("_range", "_rank").drop("_range", "_rank")


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested struct columns to flat columns named by their path
    (``a.b.c``), like ``json_normalize``."""
    def walk(field: T.StructField, path: list[str]):
        if isinstance(field.dataType, T.StructType):
            for sub in field.dataType.fields:
                yield from walk(sub, path + [sub.name])
        else:
            yield path
    cols = []
    for f in df.schema.fields:
        for path in walk(f, [f.name]):
            ref = F.col(".".join(f"`{p}`" for p in path))
            cols.append(ref.alias(sep.join(path)))
    return df.select(*cols)


def tag_flatten(tags: DataFrame, json_col: str, schema: str | T.StructType) -> DataFrame:
    """Parse a JSON column with a declared schema and flatten it."""
    return flatten(tags.withColumn(json_col, F.from_json(F.col(json_col), schema)))


def _type_of(told: str) -> tuple[T.DataType, str]:
    """A Spark type from the text that ``schema_of_variant_agg`` gives, and the
    text after it.  Values that are only ever null are strings."""
    for name, open_ in (("OBJECT<", T.StructType), ("ARRAY<", T.ArrayType)):
        if told.startswith(name):
            rest = told[len(name):]
            if open_ is T.ArrayType:
                element, rest = _type_of(rest)
                return T.ArrayType(element), rest[1:]
            fields = []
            while not rest.startswith(">"):
                if rest.startswith("`"):
                    end = 1
                    while rest[end] != "`" or rest[end:end + 2] == "``":
                        end += 2 if rest[end] == "`" else 1
                    key, rest = rest[1:end].replace("``", "`"), rest[end + 1:].lstrip()
                else:
                    key, rest = rest.split(":", 1)[0], ":" + rest.split(":", 1)[1]
                kind, rest = _type_of(rest[1:].lstrip())
                fields.append(T.StructField(key.strip(), kind))
                rest = rest[1:].lstrip() if rest.startswith(",") else rest
            return T.StructType(fields), rest[1:]
    simple = TYPE_NAME.match(told)[0]
    kind = T.StringType() if simple in ("VOID", "VARIANT") else T.DataType.fromDDL(simple)
    return kind, told[len(simple):]


def found_schema(df: DataFrame, json_col: str) -> T.DataType | None:
    """The schema of a JSON column over all its rows: every field that some
    row has, with the type that holds all its values (text where they differ
    in kind).  One aggregation; only the schema comes to the driver.  None if
    no row has a value."""
    value = F.try_parse_json(F.col(json_col))
    told = df.agg(F.schema_of_variant_agg(value)).first()[0]
    return None if told in (None, "VOID") else _type_of(told)[0]


def json_flatten(df: DataFrame, json_col: str) -> DataFrame:
    """X7 with the columns that the data have, as ``json_normalize`` finds them:
    a column ``a.b.c`` for every path to a value in any row, null in rows
    without it.  Lists stay lists.  Text that is no JSON counts as null.  A
    column whose rows hold no objects is parsed but stays one column."""
    schema = found_schema(df, json_col)
    if schema is None:
        return df
    if not isinstance(schema, T.StructType):
        return df.withColumn(json_col, F.from_json(F.concat(F.lit('{"v":'), F.col(json_col), F.lit("}")), T.StructType([T.StructField("v", schema)]))["v"])
    inside = flatten(df.select(*[F.col(f"`{c}`") for c in df.columns if c != json_col], F.from_json(F.col(json_col), schema).alias("_json")))
    return inside.toDF(*(c.removeprefix("_json.") for c in inside.columns))


def tag_overlap(tags: DataFrame, include: list[str], exclude: list[str] = (),
                recordings: list[str] | None = None, chunk: int = CHUNK_ROWS) -> DataFrame:
    """T5: per recording, the time covered by every ``include`` tag and by
    no ``exclude`` tag, as merged half-open pieces [start, end).

    A sweep: each tag adds +1 at its start and -1 at its end for its name;
    boundaries are cut into chunks per recording and the coverage per name is a
    running sum over a chunk plus the chunk prefix.  A boundary starts a kept
    run when the condition turns true there and ends one when it turns false;
    transitions alternate.  A name in both lists can never hold: no pieces.

    A null end is an open end: the tag covers everything from its start, and a
    run that never ends has a null end_time.  Tags without a start, and tags
    that end at or before their start, cover nothing."""
    names = list(dict.fromkeys([*include, *exclude]))
    start, end = F.col("start_time").cast("double"), F.col("end_time").cast("double")
    t = tag_filter(tags, names, recordings).select("recording_id", "tag", start.alias("start"), end.alias("end")) \
        .where("start IS NOT NULL AND (end IS NULL OR end > start)")
    ev = t.select("recording_id", "tag", F.explode(F.array(
        F.struct(F.col("start").alias("t"), F.lit(1).alias("d")),
        F.struct(F.col("end").alias("t"), F.lit(-1).alias("d")))).alias("e")) \
        .select("recording_id", "tag", "e.*").where("t IS NOT NULL")
    dcols = [f"_d{k}" for k in range(len(names))]
    b = ev.groupBy("recording_id", "t").agg(*[
        F.sum(F.when(F.col("tag") == n, F.col("d")).otherwise(0)).alias(c) for n, c in zip(names, dcols)])
    b = materialize(b, "tag_bounds")
    chunk = max(chunk, 2)
    w = Window.partitionBy("recording_id", "_c").orderBy("_i")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    h = materialize(chunk_rows(b, ["recording_id"], ["t"], chunk, behind=1), "tag_chunks")
    pre = _chunk_prefix(h, ["recording_id"], dcols)
    h = join_groups(h, pre, ["recording_id", "_c"], "left")
    for c in dcols:
        # prefix of earlier chunks plus the running sum of owned deltas; on
        # the halo row (last row of the previous chunk) this is the prefix
        # itself, i.e. its own coverage
        own_sum = F.sum(F.when(F.col("_own"), F.col(c)).otherwise(0)).over(run)
        h = h.withColumn(f"_cov{c}", F.coalesce(F.col(f"_pre_{c}"), F.lit(0)) + own_sum)
    cov = dict(zip(names, (F.col(f"_cov{c}") for c in dcols)))
    cond = F.lit(True)
    for n in include:
        cond = cond & (cov[n] > 0)
    for n in exclude:
        cond = cond & (cov[n] == 0)
    h = h.withColumn("_p", cond)
    h = h.withColumn("_prev_p", F.when(F.col("_i") == 0, F.lit(False)).otherwise(F.lag("_p").over(w))).where("_own")
    # transitions alternate start, end, start, ...: a start is paired with the
    # next transition of its chunk, the last one of a chunk with the first of
    # the next chunk that has any
    tr = materialize(h.where(F.col("_p") != F.col("_prev_p")).select("recording_id", "_c", "t", "_p"), "tag_flags")
    firsts = tr.groupBy("recording_id", "_c").agg(F.min("t").alias("_first"))
    firsts = firsts.select("recording_id", "_c", F.lead("_first").over(Window.partitionBy("recording_id").orderBy("_c")).alias("_later"))
    nxt = F.lead("t").over(Window.partitionBy("recording_id", "_c").orderBy("t"))
    pairs = join_groups(tr.withColumn("_next", nxt), firsts, ["recording_id", "_c"]).where("_p")
    pairs = pairs.select("recording_id", F.col("t").alias("start_time"), F.coalesce("_next", "_later").alias("end_time"))
    # outside every excluded tag is no run of its own
    return pairs if include else pairs.where("end_time IS NOT NULL")


TERM = re.compile(r"\s*(not\s+)?'([^']*)'\s*(?:(and)(?=[\s'])|$)", re.I)


def overlap_terms(query: str) -> tuple[list[str], list[str]]:
    """T5: the include and exclude names of a query text such as
    ``'A' and 'B'`` or ``'A' and not 'B'``."""
    include, exclude, at, more = [], [], 0, True
    while more:
        m = TERM.match(query, at)
        if not m:
            raise ValueError(f"cannot read the tag query at {at}: {query!r}")
        (exclude if m[1] else include).append(m[2])
        at, more = m.end(), bool(m[3])
    return include, exclude


def tag_overlap_query(tags: DataFrame, query: str, recordings: list[str] | None = None) -> DataFrame:
    """T5 with the condition as text."""
    return tag_overlap(tags, *overlap_terms(query), recordings=recordings)
