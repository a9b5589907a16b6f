"""Mixing sources to target weights, with DataFrame functions only.

The words of a source's documents, laid end to end in a pseudorandom document
order, are packed into blocks of ``BLOCK`` words.  A source's target says how
many words the mix takes from it: whole passes over all blocks, then one part
of a pass; its quota is the number of draws of a block that this takes.

The mix is written in ``SHARDS`` output shards of equal numbers of slots.  Each
slot of a shard draws its source, with odds by the quotas, so the counts of the
sources in a shard are a multinomial draw.  The counts decide which of a
source's draws go to which shard: the first count to one shard, the next to
another, in a pseudorandom order of the shards.  Over all shards a source may
be drawn a little too often or too seldom (by about the square root of its
quota); slots of draws beyond a source's quota go to the sources that lack
some, so totals meet the targets on small inputs too.

A source's draws are numbered 0, 1, 2, ... in each pass; a pseudorandom
permutation of the block numbers, keyed by source and pass, says which block a
draw gets, so a block is drawn once a pass and no order has to be stored or
sorted.  The last draw takes only the words still missing, so a source's total
is its target to the word.  Blocks join the documents' pieces by source and
block number.

The permutation is a swap-or-not network: in each round a number may change
places with its mirror image about a round key, by one bit of a hash that both
share.  Every round undoes itself, so the inverse is the rounds backwards.

Null texts have size 0; documents of size 0 are in no block and taken 0 times.
The null source is a source of its own.  Repeated rows are separate documents.
The plan depends on ids, sizes and sources only, so reruns agree; null ids are
told apart by a hash of their texts.  Columns of any name pass through
``mixed_documents``.  An empty table gives an empty mix.

One-task windows run over one row per source, or per source and shard;
document rows are spread over ``BUCKETS`` groups per source, so a hot source is
many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajex.llm.common import row_key, safe_names, small_join, stage, whole_rows

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: Most times a word is taken.
CAP = 3
#: Words in a block, groups of documents per source, slots generated per task
#: row, permutation rounds, output shards, least cells of the sources' ranges.
BLOCK, BUCKETS, CHUNK, ROUNDS, SHARDS, CELLS = 128, 4096, 16384, 12, 64, 4096


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """From (source, source_size) the target words of each source.  Weights
    repeat over the sources in code point order, null last; no target is above
    ``cap`` times the source's size, and what that leaves is shared by weight
    among the others.  Sources ordered by cap over weight reach their cap one
    after the other, so prefix sums give the common level at once."""
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    by_ratio = Window.orderBy("ratio", "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (sizes.withColumn("place", place)
              .withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)),
                                                 ((F.col("place") - 1) % len(weights) + 1).cast("int")))
              .withColumn("most", F.col("source_size") * cap)
              .withColumn("ratio", F.col("most") / F.col("weight")))
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levels = ranked.withColumn("level", rest / open_weight)
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "place", "level"))).over(everything)["level"]
    return levels.withColumn("target", F.least(F.col("most").cast("double"), level * F.col("weight"))) \
        .select("source", "place", "source_size", "target")


def round_keys(seed: int, place: Column, turn: Column, blocks: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), lambda r: F.struct(
        r.alias("r"), F.pmod(F.xxhash64(F.lit(seed), place, turn, r), blocks).alias("key")))


def permute(x: Column, keys: Column, blocks: Column) -> Column:
    """The permutation of 0 .. blocks - 1 that the round keys define."""
    def one(value, key):
        mirror = F.pmod(key["key"] - value, blocks)
        bit = F.xxhash64(key["r"], key["key"], F.greatest(value, mirror)).bitwiseAND(F.lit(1))
        return F.when(bit == 1, mirror).otherwise(value)
    return F.aggregate(keys, x.cast("long"), one)


def passes_of(targets: DataFrame, block: int = BLOCK, seed: int = 42) -> DataFrame:
    """One row per source and pass: place, turn, blocks, ``slots`` (draws the
    pass has), words, and what the permutation needs."""
    blocks, words = F.col("blocks"), F.col("words")
    return (
        targets.filter("source_size > 0")
        .withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
        .withColumn("quota", F.round("target").cast("long"))
        .withColumn("turn", F.explode(F.sequence(F.lit(0), F.expr("quota div source_size").cast("int"))))
        .withColumn("words", F.least(F.col("source_size"), F.col("quota") - F.col("turn") * F.col("source_size")))
        .filter("words > 0")
        .withColumn("keys", round_keys(seed, F.col("place"), F.col("turn"), blocks))
        .withColumn("short", F.col("blocks") * block - F.col("source_size"))  # words the last block lacks
        .withColumn("short_at", permute(blocks - 1, F.reverse("keys"), blocks))
        .withColumn("slots", F.least(blocks, F.ceil((words + F.col("short")) / block).cast("long")))
        .select("place", "turn", "blocks", "words", "keys", "short", "short_at", "slots"))


def generated(rows: DataFrame, keys: list[str], count: Column, name: str) -> DataFrame:
    """Each row once for every number from 0 to ``count`` - 1, as ``name``.
    The rows are few, what they generate is not: chunks go to a stated number
    of tasks."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = rows.withColumn("__count", count).filter("__count > 0").withColumn("__chunk", F.explode(F.expr(f"sequence(0L, (__count - 1) div {CHUNK})")))
    return (chunks.repartition(tasks, *keys, "__chunk")
            .withColumn(name, F.explode(F.expr(f"sequence(__chunk * {CHUNK}, least(__count, (__chunk + 1) * {CHUNK}) - 1)"))).drop("__count", "__chunk"))


def drawn_counts(quotas: DataFrame, shards: int = SHARDS, seed: int = 42) -> DataFrame:
    """(shard, place, n): how many slots of each shard draw each source.  The
    sources lie end to end on the numbers below the sum of their quotas; a
    slot's number is a hash, and a join on cells of the numbers finds the
    source whose range holds it."""
    spark = quotas.sparkSession
    upto = F.sum("quota").over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    ranges = stage(quotas.withColumn("hi", upto).select("place", (F.col("hi") - F.col("quota")).alias("lo"), "hi"), "ranges")
    size = ranges.agg(F.max("hi").alias("n"), F.count("*").alias("sources")).first()
    n = size["n"] or 0
    if not n:
        return spark.createDataFrame([], "shard long, place int, n long")
    width = -(-n // max(CELLS, size["sources"]))
    covered = ranges.withColumn("cell", F.explode(F.expr(f"sequence(lo div {width}, (hi - 1) div {width})")))
    length = F.lit(n // shards) + (F.col("shard") < n % shards).cast("long")
    told = F.pmod(F.xxhash64(F.lit(seed + 1), "shard", "position"), F.lit(n))
    slots = generated(spark.range(shards).withColumnRenamed("id", "shard"), ["shard"], length, "position").withColumn("number", told)
    slots = slots.select("shard", "number", F.expr(f"number div {width}").alias("cell"))
    found = small_join(slots, covered, "cell", "inner").filter("number >= lo AND number < hi")
    return found.groupBy("shard", "place").agg(F.count("*").alias("n"))


def shard_ranges(passes: DataFrame, shards: int = SHARDS, seed: int = 42) -> DataFrame:
    """(place, shard, start, n): the draws of each source that go to each
    shard.  They cover every draw of a source once."""
    quotas = passes.groupBy("place").agg(F.sum("slots").alias("quota"))
    drawn = stage(drawn_counts(quotas, shards, seed), "drawn-counts")
    quotas = stage(quotas.join(drawn.groupBy("place").agg(F.sum("n").alias("drawn")), "place", "left")
                   .select("place", "quota", F.coalesce("drawn", F.lit(0).cast("long")).alias("drawn")), "quotas")
    zero, earlier = F.lit(0).cast("long"), Window.rowsBetween(Window.unboundedPreceding, -1)
    by_source = earlier.partitionBy("place").orderBy(F.xxhash64(F.lit(seed + 2), "place", "shard"), "shard")
    laid = small_join(drawn.withColumn("start", F.coalesce(F.sum("n").over(by_source), zero)), quotas, "place", "inner")
    fits = F.least(F.col("n"), F.greatest(zero, F.col("quota") - F.col("start")))
    laid = stage(laid.select("place", "shard", "start", fits.alias("n"), (F.col("n") - fits).alias("over")), "laid")

    def units(rows: DataFrame, count: str, keys: list[str]) -> DataFrame:
        """Each row once for each of its ``count`` units, numbered throughout."""
        base = F.coalesce(F.sum(count).over(earlier.orderBy(*keys)), zero)
        return generated(rows.filter(F.col(count) > 0).withColumn("base", base), keys, F.col(count), "unit") \
            .withColumn("unit", F.col("base") + F.col("unit"))

    free = units(laid.select("place", "shard", "over"), "over", ["shard", "place"]).select("unit", "shard")
    lacking = units(quotas.withColumn("lack", F.col("quota") - F.col("drawn")), "lack", ["place"]).select("unit", "place", "drawn")
    given = free.join(lacking.hint("merge"), "unit").groupBy("place", "drawn", "shard").agg(F.count("*").alias("n"))
    given = given.withColumn("start", F.col("drawn") + F.coalesce(F.sum("n").over(earlier.partitionBy("place").orderBy("shard")), zero))
    return laid.filter("n > 0").select("place", "shard", "start", "n").unionByName(given.select("place", "shard", "start", "n"))


def slots(targets: DataFrame, block: int = BLOCK, shards: int = SHARDS, seed: int = 42) -> DataFrame:
    """One row per draw: place (of the source), turn (pass), slot (in the
    pass), index (of the block), take (words from the block's start), shard."""
    passes = stage(passes_of(targets, block, seed), "passes")
    ranges = stage(shard_ranges(passes, shards, seed), "shard-ranges")
    first = F.col("turn") * F.col("blocks")  # the pass's first draw
    lo, hi = F.greatest(F.col("start"), first), F.least(F.col("start") + F.col("n"), first + F.col("slots"))
    parts = small_join(ranges, passes, "place", "inner").withColumn("from", lo - first).withColumn("count", hi - lo)
    slot, blocks = F.col("slot"), F.col("blocks")
    before = slot * block - F.when(slot > F.col("short_at"), F.col("short")).otherwise(0)
    length = block - F.when(slot == F.col("short_at"), F.col("short")).otherwise(0)
    each = generated(parts, ["place", "turn", "shard", "start"], F.col("count"), "slot").withColumn("slot", F.col("from") + slot)
    return (each.select("place", "turn", "slot", permute(slot, F.col("keys"), blocks).alias("index"),
                        F.least(length, F.col("words") - before).alias("take"), F.col("shard").cast("int").alias("shard"))
            .filter("take > 0"))


def sized(df: DataFrame, id_column: str, column: str, source_column: str, more: tuple = ()) -> DataFrame:
    """id, source, place-independent source key, size and a row number; staged,
    as every later step starts from it."""
    source = F.col(f"`{source_column}`")
    return df.select(
        F.col(f"`{id_column}`").alias("id"), source.alias("source"),
        F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("null")).alias("source_key"),
        F.coalesce(F.regexp_count(F.col(f"`{column}`"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.when(F.col(f"`{id_column}`").isNull(), F.xxhash64(F.col(f"`{column}`"))).alias("h"),  # tells rows without an id apart
        F.monotonically_increasing_id().alias("row"), *more)


def targets_of(rows: DataFrame, weights=WEIGHTS) -> DataFrame:
    sizes = rows.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    return stage(source_targets(sizes, weights).withColumn(
        "source_key", F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("null"))), "targets")


def pieces(rows: DataFrame, targets: DataFrame, block: int = BLOCK, seed: int = 42) -> DataFrame:
    """Where the documents lie: one row per document and block, with the
    document's words ``lo`` to ``hi`` inside the block and ``at``, its first
    word there.  Offsets are prefix sums over groups of documents, then inside
    each group."""
    dealt = rows.filter("size > 0").select("id", "row", "source_key", "size", "h",
                                           F.pmod(F.xxhash64(F.lit(seed), "id", "h"), F.lit(BUCKETS)).alias("bucket"))
    running = Window.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    starts = dealt.groupBy("source_key", "bucket").agg(F.sum("size").alias("size")).select(
        "source_key", "bucket",
        F.coalesce(F.sum("size").over(running.partitionBy("source_key").orderBy("bucket")), zero).alias("start"))
    inside = F.coalesce(F.sum("size").over(running.partitionBy("source_key", "bucket").orderBy("id", "size", "h", "row")), zero)
    laid = (dealt.withColumn("inside", inside).join(starts, ["source_key", "bucket"])
            .withColumn("offset", F.col("start") + F.col("inside")))
    laid = small_join(laid, targets.select("source_key", "place"), "source_key", "inner")
    spread = laid.select("place", "row", "size", "offset", F.explode(
        F.expr(f"sequence(offset div {block}, (offset + size - 1) div {block})")).alias("index"))
    lo = F.greatest(zero, F.col("offset") - F.col("index") * block)
    return spread.select(
        "place", "index", "row", lo.alias("lo"),
        F.least(F.lit(block).cast("long"), F.col("offset") + F.col("size") - F.col("index") * block).alias("hi"),
        (F.col("index") * block + lo - F.col("offset")).alias("at"))


def draws(rows: DataFrame, targets: DataFrame, block: int = BLOCK, seed: int = 42, shards: int = SHARDS) -> DataFrame:
    """One row per document piece and draw of its block: row, source's place,
    turn, slot, shard, lo (place in the block), at and words (from the
    document's word ``at`` on)."""
    # both sides grow with the input, though the slots come from few rows: never broadcast
    joined = pieces(rows, targets, block, seed).join(slots(targets, block, shards, seed).hint("merge"), ["place", "index"])
    return joined.withColumn("words", F.least("hi", "take") - F.col("lo")).filter("words > 0") \
        .select("row", "place", "turn", "slot", "shard", "lo", "at", "words")


def mix(df: DataFrame, id_column: str = "doc_id", column: str = "text", source_column: str = "source",
        weights=WEIGHTS, block: int = BLOCK, seed: int = 42) -> DataFrame:
    """One row per document: id, size, source_size, target (its source's),
    taken (words the mix takes from it, repeats counted) and n_shards (output
    shards they go to)."""
    rows = stage(sized(df, id_column, column, source_column), "sizes")
    targets = targets_of(rows, weights)
    taken = draws(rows, targets, block, seed).groupBy("row").agg(
        F.sum("words").alias("taken"), F.bit_count(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("shard")))).alias("n_shards"))
    full = small_join(rows.join(taken, "row", "left"), targets.select("source_key", "source_size", "target"), "source_key", "inner")
    return full.select(F.col("id").alias(id_column), "size", "source_size", "target",
                       F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), F.coalesce("n_shards", F.lit(0)).cast("long").alias("n_shards"))


def cut_words(text: Column, cuts: Column, told) -> Column:
    """``told(words, cut)`` for every one of the ``cuts``, with the words of a
    text, which are found once."""
    found = F.transform(F.array(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), lambda words: F.transform(cuts, lambda c: told(words, c)))
    return F.element_at(found, 1)


def some(words: Column, cut: Column) -> Column:
    """The words of a cut."""
    return F.slice(words, (cut["at"] + 1).cast("int"), cut["words"].cast("int"))


def mixed_blocks(df: DataFrame, id_column: str = "doc_id", column: str = "text", source_column: str = "source",
                 weights=WEIGHTS, block: int = BLOCK, seed: int = 42, shards: int = SHARDS) -> DataFrame:
    """The mix as packed blocks: shard, source, turn, slot, n_words and text,
    the block's words joined by spaces.  Every block has ``block`` words but a
    source's last one and the last draw of its last pass."""
    safe, name, _ = safe_names(df)
    key = row_key(safe)
    rows = stage(sized(safe, name[id_column], name[column], name[source_column], (key.alias("key"),)), "sizes")
    targets = targets_of(rows, weights)
    taken = draws(rows, targets, block, seed, shards)
    cuts = taken.groupBy("row").agg(F.collect_list(F.struct("place", "turn", "slot", "shard", "lo", "at", "words")).alias("cuts"))
    decided = rows.select("row", "key").join(cuts, "row").drop("row")
    texts = whole_rows(safe.select(F.col(name[column]).alias("text"), key.alias("k")), F.col("k"), rows, decided)
    cut = cut_words(F.col("text"), F.col("cuts"), lambda words, c: F.struct(
        c["place"].alias("place"), c["turn"].alias("turn"), c["slot"].alias("slot"), c["shard"].alias("shard"), c["lo"].alias("lo"),
        c["words"].alias("n"), F.array_join(some(words, c), " ").alias("part")))
    each = texts.select(F.explode(cut).alias("c")).select("c.*")
    # at most ``block`` pieces meet in a block
    packed = each.groupBy("shard", "place", "turn", "slot").agg(
        F.sum("n").alias("n_words"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("lo", "part"))), lambda p: p["part"]), " ").alias("text"))
    return small_join(packed, targets.select("place", "source"), "place", "inner").select("shard", "source", "turn", "slot", "n_words", "text")


def mixed_documents(df: DataFrame, id_column: str = "doc_id", column: str = "text", source_column: str = "source",
                    weights=WEIGHTS, block: int = BLOCK, seed: int = 42, length_column: str | None = "n_chars") -> DataFrame:
    """The mix as documents: for each pass a document with the words taken in
    it, the text unchanged where that is all of them, else its words joined by
    spaces.  All other columns stay; ``length_column`` is brought up to date.
    Documents the mix takes no word of are absent."""
    safe, name, back = safe_names(df)
    key = row_key(safe)
    rows = stage(sized(safe, name[id_column], name[column], name[source_column], (key.alias("key"),)), "sizes")
    targets = targets_of(rows, weights)
    ranges = draws(rows, targets, block, seed).groupBy("row", "turn").agg(
        F.sum("words").alias("taken"), F.sort_array(F.collect_list(F.struct("at", "words"))).alias("ranges"))
    decided = rows.select("row", "key", "size").join(ranges, "row").drop("row")
    mixed = whole_rows(safe, key, rows, decided)
    whole = F.col(name[column])
    mixed = mixed.withColumn("now", F.when(
        F.col("taken") < F.col("size"), F.array_join(F.flatten(cut_words(whole, F.col("ranges"), some)), " ")).otherwise(whole))
    length = name.get(length_column)
    if length:
        mixed = mixed.withColumn(length, F.length("now").cast(safe.schema[length].dataType))
    return mixed.withColumn(name[column], F.col("now")).select(*back)


def op6(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
