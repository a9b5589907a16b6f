"""SimHash near-duplicates by tiled exact comparison.

Fingerprints: one bit per hash bit, 1 if it is set in over half of the hashes
of the text's word shingles.  Each distinct fingerprint is compared once.

Tiles: fingerprints with the same population counts in each of four 16-bit
parts form a tile.  Two fingerprints within ``radius`` bits have population
counts that differ by at most ``radius`` in sum over the parts, so all other
pairs of tiles are skipped without loss.  A fingerprint visits the tiles it may
have partners in; inside a tile numpy compares blocks by exclusive-or and bit
counts.  A large tile is split into pieces of about ``PIECE`` fingerprints at
home in it, and its visitors into parts of about as many; each piece meets each
part in a group of its own.  So memory and the work of a group stay bounded, and
of all ways to cut the same work into groups square ones copy the fewest rows:
a fingerprint goes to one group for every ``PIECE`` fingerprints on the other
side.  A tile gives only the edges of a spanning forest of its links, never all
pairs; components keep every link.

Null and empty texts have no shingles and fingerprint zero, which links like
any other.  Texts with fewer words than a shingle have one shingle, the whole
sequence.  Null ids take part in groups but never name them; of rows with equal
smallest ids one represents the group.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajex.llm.common import append_columns, long, row_key, safe_names, ship_package, stage, whole_rows
from trajex.llm.components import spanning

SHINGLE, RADIUS = 3, 3
PARTS, PART_BITS = 4, 16
BASE = PART_BITS + 1
#: Fingerprints in a piece of a tile and in a part of its visitors, and sides of
#: the blocks compared at once.
PIECE, SIDE, ACROSS = 1 << 19, 512, 4096
#: Hashes whose bits are unpacked at once.
HASHES = 1 << 16


def fingerprint(value: bytes, shingle: int = SHINGLE) -> int:
    """64-bit fingerprint, as an unsigned integer, of A-Z lower-cased words."""
    words = value.lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False)) if len(words) > shingle else [b" ".join(words)]
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), HASHES):
        block = hashes[at:at + HASHES].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(df: DataFrame, column: str = "text", shingle: int = SHINGLE, to: str = "fp") -> DataFrame:
    """Adds the fingerprint as a signed long of the same bits."""
    def make():
        def run(texts):
            found = np.array([fingerprint(x or b"", shingle) for x in texts], np.uint64)
            return [found.view(np.int64).tolist()]
        return run
    return append_columns(df, [column], make, [long(to)], as_bytes=True)


def part_counts(fp: Column) -> list[Column]:
    return [F.bit_count(F.shiftrightunsigned(fp, PART_BITS * k).bitwiseAND(F.lit((1 << PART_BITS) - 1))) for k in range(PARTS)]


def neighbour_steps(radius: int) -> list[tuple[int, ...]]:
    """Differences of part counts to the tiles after a tile, in tile order,
    that may hold partners.  Both tiles of a pair meet once."""
    spans = product(range(-radius, radius + 1), repeat=PARTS)
    return [s for s in spans if sum(map(abs, s)) <= radius and s > (0,) * PARTS]


def near_pairs(left: np.ndarray, right: np.ndarray, radius: int):
    """Pairs (values of left, values of right) within radius, block by block."""
    for i in range(0, len(left), SIDE):
        a = left[i:i + SIDE]
        for j in range(0, len(right), ACROSS):
            b = right[j:j + ACROSS]
            x, y = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= radius)
            if len(x):
                yield a[x], b[y]


class Forest:
    """Edges reduced to stars, from each value to the smallest one it is
    linked with, whenever there are many."""

    def __init__(self):
        self.a, self.b, self.held = [], [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.a.append(a)
        self.b.append(b)
        self.held += len(a)
        if self.held > 2_000_000:
            self.shrink()

    def shrink(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.a:
            return np.empty(0, np.uint64), np.empty(0, np.uint64)
        a, b = np.concatenate(self.a), np.concatenate(self.b)
        values, index = np.unique(np.concatenate([a, b]), return_inverse=True)
        x, y = index[:len(a)], index[len(a):]
        label = np.arange(len(values))
        while len(x):
            low = np.minimum(label[x], label[y])
            np.minimum.at(label, label[x], low)
            np.minimum.at(label, label[y], low)
            while True:
                further = label[label]
                if np.array_equal(further, label):
                    break
                label = further
            open_ = label[x] != label[y]
            x, y = x[open_], y[open_]
        far = label != np.arange(len(values))
        self.a, self.b = [values[far]], [values[label[far]]]
        self.held = int(far.sum())
        return self.a[0], self.b[0]


def links(fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (fp) whose components are
    those of all links within ``radius`` bits."""
    ship_package(fingerprints.sparkSession)
    piece = PIECE
    counts = part_counts(F.col("fp"))

    def number(parts: list[Column]) -> Column:
        total = F.lit(0)
        for k, part in enumerate(parts):
            total = total + part * BASE ** k
        return total

    fps = stage(fingerprints.select("fp", F.array(*counts).alias("counts"), number(counts).cast("int").alias("tile")), "fingerprints")
    steps = F.array(*(F.array(*map(F.lit, s)) for s in neighbour_steps(radius)))
    to = [F.col("counts")[k] + F.col("step")[k] for k in range(PARTS)]
    fits = F.lit(True)
    for part in to:
        fits = fits & part.between(0, PART_BITS)

    def visiting(rows: DataFrame) -> DataFrame:
        """Rows with the ``tile`` of every step instead of their own."""
        return rows.drop("tile").withColumn("step", F.explode(steps)).filter(fits).withColumn("tile", number(to).cast("int")).drop("step", "counts")

    # at most BASE ** PARTS = 83,521 rows of a few numbers, whatever the input
    sizes = stage(fps.groupBy("tile").agg(F.first("counts").alias("counts"), F.count("*").alias("n")), "tiles")
    guests = visiting(sizes).groupBy("tile").agg(F.sum("n").alias("guests"))

    def cut(n) -> Column:
        return F.greatest(F.lit(1), F.ceil(n / piece)).cast("int")

    tiles = F.broadcast(stage(sizes.join(guests, "tile", "left").select(
        "tile", cut(F.col("n")).alias("pieces"), cut(F.coalesce("guests", F.lit(0)) + F.when(F.col("n") > piece, F.col("n")).otherwise(0)).alias("parts")), "tiles"))
    own = F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")
    part = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("parts")).cast("int")
    visits = (visiting(fps).join(tiles, "tile").withColumn("part", part)
              .select("tile", F.explode(F.expr("sequence(0, pieces - 1)")).alias("piece"), "part", "fp", F.lit(1).alias("visit")))
    homes = fps.join(tiles, "tile").withColumn("own", own).withColumn("part", part)
    # at home in every part of the own piece; a visitor of the later pieces
    settled = homes.select("tile", F.col("own").alias("piece"), F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), "fp", F.lit(0).alias("visit"))
    later = homes.filter("own + 1 < pieces").select("tile", F.explode(F.expr("sequence(own + 1, pieces - 1)")).alias("piece"), "part", "fp", F.lit(1).alias("visit"))

    def compare(batches):
        key, group = None, None
        for batch in batches:
            tile, piece, part, fp, visit = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(5))
            fp = fp.astype(np.int64).view(np.uint64)
            cuts = (np.flatnonzero((tile[1:] != tile[:-1]) | (piece[1:] != piece[:-1]) | (part[1:] != part[:-1])) + 1).tolist()
            for begin, end in zip([0, *cuts], [*cuts, len(fp)], strict=True):
                if begin == end:
                    continue
                if key != (tile[begin], piece[begin], part[begin]):
                    if group:
                        yield from group.edges()
                    # pairs at home are compared in the first part only
                    key, group = (tile[begin], piece[begin], part[begin]), TileGroup(radius, part[begin] == 0)
                split = begin + int(np.searchsorted(visit[begin:end], 1))  # homes come first
                group.settle(fp[begin:split])
                group.receive(fp[split:end])
        if group:
            yield from group.edges()

    at = ("tile", "piece", "part")
    return (settled.unionByName(later).unionByName(visits).repartition(*at).sortWithinPartitions(*at, "visit")
            .mapInArrow(compare, "a long, b long"))


class TileGroup:
    """One piece of a tile: the fingerprints at home in it, then a stream of
    visitors, each compared with all of them."""

    def __init__(self, radius: int, inside: bool = True):
        self.radius, self.inside, self.parts, self.home, self.forest = radius, inside, [], None, Forest()

    def settle(self, fps: np.ndarray) -> None:
        if len(fps):
            self.parts.append(fps)

    def _close(self) -> None:
        if self.home is None:
            self.home = np.concatenate(self.parts) if self.parts else np.empty(0, np.uint64)
            for a, b in near_pairs(self.home, self.home, self.radius) if self.inside else ():
                once = a < b
                self.forest.add(a[once], b[once])

    def receive(self, fps: np.ndarray) -> None:
        if len(fps):
            self._close()
            for a, b in near_pairs(fps, self.home, self.radius):
                self.forest.add(a, b)

    def edges(self):
        self._close()
        a, b = self.forest.shrink()
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def near_groups(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Per distinct fingerprint of ``rows`` (id, row, fp) the component's first
    row as a struct (no_id, id, row)."""
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row"))
    distinct = stage(rows.groupBy("fp").agg(first.alias("first")), "distinct-fingerprints")
    roots = spanning(links(distinct.select("fp"), radius))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "first", F.coalesce("root", "fp").alias("root"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return rooted.select("fp", "root").join(firsts, "root").select("fp", "first")


def near_duplicates(df: DataFrame, id_column: str = "doc_id", column: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id
    (smallest id that links reach)."""
    marked = with_fingerprint(df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{column}`").alias("__text")), "__text", shingle)
    rows = stage(marked.select("id", F.monotonically_increasing_id().alias("row"), "fp"), "simhash")
    return rows.join(near_groups(rows, radius), "fp").select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.id").alias("component_id"))


def deduplicate(df: DataFrame, id_column: str = "doc_id", column: str = "text", shingle: int = SHINGLE,
                radius: int = RADIUS) -> DataFrame:
    """The first row of each component, with all its columns: the one with the
    smallest id (a null id is larger than all), of equal ids the one with the
    smallest digest of all its columns, so reruns agree."""
    safe, name, back = safe_names(df)
    key = row_key(safe)
    light = safe.select(F.col(name[id_column]).alias("id"), key.alias("row"), F.col(name[column]).alias("__text"))
    rows = stage(with_fingerprint(light, "__text", shingle).select("id", "row", "fp"), "simhash")
    firsts = near_groups(rows, radius).select(F.col("first.row").alias("key")).distinct()
    return whole_rows(safe, key, rows.select(F.col("row").alias("key")), firsts).select(*back)


def op8(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
