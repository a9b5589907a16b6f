"""Ranked lexical search by norm buckets.

A document's impact vector has a number for each of its terms; a query's score
of a document is the inner product of the query's term weights with the
document's impacts.  Only terms of the queries count, so vectors are kept over
these alone.

Vectors are ordered by length.  Across the cluster they fall into ``CLASSES``,
from the longest vectors down; classes are searched in turn, and what the best
results so far ask of a score bounds what the next class must reach.  By the
Cauchy-Schwarz inequality a vector shorter than the smallest of these bounds
over the length of its query is in no result, so a class's short end is
filtered out before a task sees it.  Inside a task the vectors come longest
first in buckets of ``BUCKET``; a query leaves a bucket, and with it all later
ones, as soon as its length times the bucket's longest is below its bound.
Inside a bucket the query's largest coordinates bound a document's: a
coordinate must lie in the region that a vector of the wanted cosine can have,
and the sum over these coordinates plus the Cauchy-Schwarz bound of the rest
must reach the query's bound.  What survives is scored exactly in 64-bit
integers.  Bounds are in doubles and are widened by ``SLACK``, so rounding
loses nothing; documents that only equal a bound stay, as their ids decide.

Both sides of the inner product take the square root of a term's weight, which
keeps frequent terms from making all vectors alike; the scores are unchanged.

Terms are maximal runs of ASCII digits, letters (A-Z lower-cased) and all
characters beyond ASCII.  Null and empty texts have no terms; they are in no
result and count neither in N nor in L.  Queries without a term that some
document holds have no rows.  Equal scores are ordered by id, null ids last;
repeated rows are separate documents.  Empty tables give empty results.
Queries are handled in blocks of at most ``QUERY_BYTES`` of text (or a single
longer query): a block's terms and weights are what tasks get by broadcast.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajex.llm.common import append_columns, stage, table
from trajex.session import ship_package

#: Results of a query, and bytes of query text in a block.
TOP, QUERY_BYTES = 10, 32 << 20
#: Shares of the vectors, longest first, after which a new class begins.
CLASSES = (0.01, 0.1)
#: Vectors in a bucket, coordinates that are bounded, and the widening of bounds.
BUCKET, FOCUS, SLACK = 4096, 6, 1e-9
#: Parameters of the impact, in thousandths and hundredths: k1 + 1 over tf + k1 * (1 - b + b * n / mean).
SCALE, TF_SCALE, LENGTH_SCALE, B = 1_000_000_000, 1000, 8, 75

#: Lower-cases A-Z; ASCII characters but digits and letters are blank.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Bytes of a text whose terms are counted at once.
BLOCK = 1 << 20


def count_terms(value: bytes, known: dict[bytes, int] | None = None) -> tuple[int, Counter]:
    """Number of terms with repeats, and the counts of the terms (of the
    ``known`` ones by their numbers)."""
    clean, at, n, held = value.translate(TABLE), 0, 0, Counter()
    while at < len(clean):
        stop = clean.find(b" ", at + BLOCK)
        stop = len(clean) if stop < 0 else stop
        words = clean[at:stop].split()
        n, at = n + len(words), stop
        held.update(words if known is None else filter(None, map(known.get, words)))
    return n, held


def query_blocks(queries: DataFrame, id_column: str, column: str, most: int = QUERY_BYTES):
    """The queries as lists of (id, text), each of at most ``most`` bytes of
    text or one query.  Rows come to the driver a partition at a time."""
    held, size = [], 0
    for row in queries.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{column}`").cast("string").alias("t")).toLocalIterator():
        more = len((row["t"] or "").encode())
        if held and size + more > most:
            yield held
            held, size = [], 0
        held.append((row["id"], row["t"] or ""))
        size += more
    if held:
        yield held


class Queries:
    """Term counts of a block of queries over numbered terms (from 1)."""

    def __init__(self, rows: list[tuple]):
        self.ids, self.terms, self.counts = [], {}, []
        for identifier, value in rows:
            _, held = count_terms(value.encode())
            self.ids.append(identifier)
            self.counts.append({self.terms.setdefault(t, len(self.terms) + 1): c for t, c in held.items()})

    def weigh(self, documents: int, frequency: dict[int, int]) -> None:
        """Weights of the terms, from how many documents hold each; terms that
        no document holds or that weigh nothing are dropped."""
        self.weight = np.zeros(len(self.terms) + 1, np.int64)
        for term, df in frequency.items():
            self.weight[term] = math.floor(1000 * math.log((2.0 * documents + 2) / (2.0 * df + 1)))
        self.root = np.sqrt(self.weight.astype(float))
        self.queries = []
        for counts in self.counts:
            terms = np.array([t for t in counts if self.weight[t] > 0], np.int64)
            c = np.array([counts[t] for t in terms], np.int64)
            q = c * self.root[terms]
            order = np.argsort(-q, kind="stable")
            self.queries.append((terms[order], (c * self.weight[terms])[order], q[order], float(np.sqrt((q * q).sum()))))
        self.lengths = np.array([q[3] for q in self.queries])


def term_counts(df: DataFrame, terms: dict[bytes, int], id_column: str, column: str) -> DataFrame:
    """(id, n, terms, tfs): the number of terms of each text, and its counts
    of the numbered ``terms``."""
    shared = df.sparkSession.sparkContext.broadcast(terms)  # a block of queries holds them

    def make():
        known = shared.value

        def count(texts):
            out = ([], [], [])
            for value in texts:
                n, held = count_terms(value or b"", known)
                out[0].append(n)
                out[1].append(list(held))
                out[2].append(list(held.values()))
            return out
        return count

    fields = [T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.LongType()))]
    light = df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{column}`").cast("string").alias("t"))
    return append_columns(light, ["t"], make, fields, as_bytes=True).drop("t")


def vectors(counted: DataFrame, documents: int, length: int, weight: np.ndarray) -> DataFrame:
    """(id, terms, impacts, norm) of the documents with a weighed term; the
    norm has each impact times the square root of its term's weight."""
    m = F.lit(100 - B) + F.call_function("div", F.lit(B) * F.col("n") * F.lit(documents), F.lit(length))
    impacts = F.transform("tfs", lambda tf: F.call_function("div", tf * SCALE, tf * TF_SCALE + F.col("m") * LENGTH_SCALE))
    shared = counted.sparkSession.sparkContext.broadcast(weight)  # a number a term of the block

    def make():
        weight = shared.value.astype(float)

        def norms(lists, numbers):
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            rows = np.repeat(np.arange(len(lists)), sizes)
            terms = np.concatenate([np.asarray(x, np.int64) for x in lists]) if len(lists) else np.empty(0, np.int64)
            values = np.concatenate([np.asarray(x, float) for x in numbers]) if len(lists) else np.empty(0)
            return [np.sqrt(np.bincount(rows, values * values * weight[terms], len(lists)))]
        return norms

    told = counted.filter(F.size("terms") > 0).withColumn("m", m.cast("long")).select("id", "terms", impacts.alias("impacts"))
    return append_columns(told, ["terms", "impacts"], make, [T.StructField("norm", T.DoubleType())]).filter("norm > 0")


class Best:
    """The highest scores of one query so far, with their ids."""

    def __init__(self, top: int):
        self.top, self.scores, self.ids, self.none = top, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        """``none`` marks null ids, which come last among equal scores."""
        scores, ids, none = (np.concatenate(p) for p in ((self.scores, scores), (self.ids, ids), (self.none, none)))
        kept = np.lexsort((ids, none, -scores))[:self.top]
        self.scores, self.ids, self.none = scores[kept], ids[kept], none[kept]

    def bound(self) -> int:
        """The score that a further result must reach."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1


class Bucket:
    """Some vectors, longest first, with the places of each term in them."""

    def __init__(self, ids, none, norms, sizes, terms, impacts, root):
        self.ids, self.none, self.norms = ids, none, norms
        self.start = np.concatenate([[0], np.cumsum(sizes)])
        self.terms, self.impacts = terms, impacts
        rows = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(terms, kind="stable")
        self.by_term, self.rows, self.values = terms[order], rows[order], impacts[order] * root[terms[order]]

    def coordinates(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = np.searchsorted(self.by_term, [term, term + 1])
        return self.rows[a:b], self.values[a:b]

    def survivors(self, query: tuple, bound: int) -> np.ndarray:
        """Rows that the bounds cannot rule out."""
        terms, _, q, length = query
        norms, n = self.norms, int(np.searchsorted(-self.norms, -bound * (1 - SLACK) / length, "right"))
        if not n:
            return np.empty(0, np.int64)
        cosine = np.minimum(bound * (1 - SLACK) / (length * norms[:n]), 1.0)  # that a vector of this length needs
        alive, partial, used, rest = np.ones(n, bool), np.zeros(n), np.zeros(n), length * length
        for term, value in zip(terms[:FOCUS], q[:FOCUS], strict=True):
            rows, values = self.coordinates(term)
            rows, values = (x[:np.searchsorted(rows, n)] for x in (rows, values))  # rows go up within a term
            own = np.zeros(n)
            own[rows] = values
            share = min(value / length, 1.0)
            middle, reach = share * cosine, np.sqrt((1 - share * share) * (1 - cosine * cosine))
            at = own / norms[:n]
            alive &= at >= middle - reach - 1e-7
            alive &= (at <= middle + reach + 1e-7) | (cosine <= share)
            partial += value * own
            used += own * own
            rest -= value * value
        left = np.sqrt(np.maximum(norms[:n] ** 2 * (1 + SLACK) - used, 0.0)) * math.sqrt(max(rest, 0.0) + length * length * SLACK)
        return np.flatnonzero(alive & (partial + left >= bound * (1 - SLACK)))

    def scores(self, rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores of rows; ``weights`` has the query's number of each term."""
        sizes = self.start[rows + 1] - self.start[rows]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes) + np.repeat(self.start[rows], sizes)
        return np.add.reduceat(weights[self.terms[places]] * self.impacts[places], ends - sizes)


def search_class(found: DataFrame, queries, bounds: np.ndarray, top: int) -> DataFrame:
    """(query, id, score): of each task the ``top`` best vectors of each
    query, among those that reach the query's bound."""
    spark = found.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast((queries.queries, queries.root, bounds))
    terms = len(queries.weight)

    def run(batches):
        told, root, bounds = shared.value
        lengths = np.array([q[3] for q in told])
        best = [Best(top) for _ in told]
        open_ = [k for k, q in enumerate(told) if len(q[0])]
        for batch in batches:
            for at in range(0, batch.num_rows, BUCKET):
                part = batch.slice(at, BUCKET)
                norms = part.column(3).to_numpy()
                # vectors come longest first: what a bucket's longest can't reach, no later one can
                open_ = [k for k in open_ if lengths[k] * norms[0] >= max(bounds[k], best[k].bound()) * (1 - SLACK)]
                if not open_:
                    break
                lists, numbers = part.column(1), part.column(2)
                ids = part.column(0)
                bucket = Bucket(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), norms,
                                lists.value_lengths().to_numpy().astype(np.int64), lists.flatten().to_numpy().astype(np.int64), numbers.flatten().to_numpy(), root)
                weights = np.zeros(terms, np.int64)
                for k in open_:
                    bound = max(int(bounds[k]), best[k].bound())
                    rows = bucket.survivors(told[k], bound)
                    if len(rows):
                        weights[told[k][0]] = told[k][1]
                        scores = bucket.scores(rows, weights)
                        weights[told[k][0]] = 0
                        good = scores >= bound
                        best[k].add(scores[good], bucket.ids[rows[good]], bucket.none[rows[good]])
        for k, b in enumerate(best):
            if len(b.scores):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b.scores), k), pa.int64()), pa.array(b.ids, pa.int64(), mask=b.none),
                                                  pa.array(b.scores, pa.int64())], names=["query", "id", "score"])

    return found.sortWithinPartitions(F.desc("norm")).select("id", "terms", "impacts", "norm").mapInArrow(run, "query long, id long, score long")


def best_of(results: DataFrame, top: int) -> DataFrame:
    """The ``top`` rows of each query with their rank; tasks keep no more than
    ``top`` rows of a query before the shuffle."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return results.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def search_block(df: DataFrame, rows: list[tuple], id_column: str, column: str, top: int) -> DataFrame | None:
    """(query, id, score, rank) for one block of queries; ``query`` is the
    place in ``rows``.  None if no document holds a term."""
    queries = Queries(rows)
    counted = stage(term_counts(df, queries.terms, id_column, column), "term-counts")
    totals = counted.agg(F.sum((F.col("n") > 0).cast("long")).alias("N"), F.sum("n").alias("L")).first()
    if not totals["L"]:
        return None
    frequency = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    queries.weigh(totals["N"], {r["term"]: r["df"] for r in frequency.collect()})  # at most the block's terms
    found = vectors(counted, totals["N"], totals["L"], queries.weight)
    edges = found.agg(F.percentile_approx("norm", [1 - c for c in CLASSES], 1000).alias("e")).first()["e"]
    if not edges:
        return None
    number = F.lit(0)
    for edge in edges:
        number = number + (F.col("norm") < edge).cast("int")
    path_class = stage(found.withColumn("class", number), "vectors", by="class")
    results, bounds = None, np.ones(len(rows), np.int64)
    for k in range(len(edges) + 1):
        least = min((b * (1 - SLACK) / q for b, q in zip(bounds, queries.lengths, strict=True) if q > 0), default=math.inf)
        part = path_class.filter((F.col("class") == k) & (F.col("norm") >= float(least)))
        new = search_class(part, queries, bounds, top)
        results = stage(best_of(new if results is None else results.drop("rank").unionByName(new), top), "search-results")
        for r in results.filter(F.col("rank") == top).collect():  # at most a row a query of the block
            bounds[r["query"]] = r["score"]
    return results


def search(df: DataFrame, queries: DataFrame, id_column: str = "doc_id", column: str = "text", query_id: str = "item_id",
           query_column: str = "text", top: int = TOP, block: int = QUERY_BYTES) -> DataFrame:
    """(query_id, rank, id_column, score): the ``top`` documents of each query
    with a score above 0, best first.  Ids of documents are whole numbers."""
    spark, out = df.sparkSession, None
    kind = queries.schema[query_id].dataType
    schema = T.StructType([T.StructField(query_id, kind), T.StructField("rank", T.IntegerType()), T.StructField(id_column, T.LongType()), T.StructField("score", T.LongType())])
    for rows in query_blocks(queries, query_id, query_column, block):
        found = search_block(df, rows, id_column, column, top)
        if found is None:
            continue
        names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(rows)], T.StructType([T.StructField("query", T.LongType()), T.StructField(query_id, kind)]))
        part = found.join(F.broadcast(names), "query").select(query_id, F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_column), "score")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def op11(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))


_CLEAN = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP11_SQL = f"""
WITH words AS (SELECT doc_id, unnest({_CLEAN}) AS term FROM documents),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf) AS n FROM tfs GROUP BY doc_id),
totals AS (SELECT count(*) AS N_all, sum(n)::BIGINT AS L_all FROM lengths),
items AS (SELECT item_id, unnest({_CLEAN}) AS term FROM benchmark),
asked AS (SELECT item_id, term, count(*) AS c FROM items GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * N_all + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w
            FROM tfs, totals GROUP BY term, N_all),
impacts AS (SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n::BIGINT * N_all) // L_all))) AS impact
            FROM tfs JOIN lengths USING (doc_id), totals),
scores AS (SELECT item_id, doc_id, sum(c * w * impact)::BIGINT AS score
           FROM asked JOIN weights USING (term) JOIN impacts USING (term) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""
