"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  Each sentence gets a probability from a
linear model over its words and word beginnings; the document's probability is
the noisy-or of its sentences.  Document labels train the sentence model
through the noisy-or, so it learns which sentences offend and can point at
them.

The model is fitted on a bounded sample: at most ``SAMPLE`` labelled documents,
half of them toxic if there are enough, chosen by a hash of their id.  Tasks
turn their whole texts into numbers of features per sentence; the driver gets
these numbers only, at most ``ROOM`` of them (4 bytes each on arrival, about 40
while the model is fitted), half for each kind.  A label goes with a whole text
only: a text whose numbers no longer fit is passed over, not cut.  Statistics of
the labels (how rare toxic documents are) cover all training labels.  Scoring
reads every whole text.

Null and empty texts are one empty sentence and get the model's lowest base
score.  Without labels of both kinds every score is 0.  Of several labels of a
document any toxic one counts; null labels and null ids are not trained on.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajex.llm.common import WordCache, append_columns, bounded_sample, hash_share, stage

SAMPLE, ROOM = 4000, 10_000_000
DIMENSIONS = 1 << 18
#: Lengths of the word beginnings that are features.
BEGINNINGS = (3, 4, 5)
ROUNDS, RATE, DECAY = 120, 0.2, 1e-5
#: Features in fewer training documents are left out.
LEAST_DOCUMENTS = 3
THRESHOLD = 0.7

SENTENCE = re.compile(r"[.!?\n]+")
WORD = re.compile(r"\w+")


def word_features(word: str) -> list[int]:
    """Numbers of a word's features: itself and its beginnings."""
    names = [f"={word}"] + [f"^{word[:k]}" for k in BEGINNINGS if len(word) > k]
    return [zlib.crc32(n.encode("utf-8", "replace")) % DIMENSIONS for n in names]


def sentences(value: str) -> list[tuple[int, int]]:
    """Spans of a text's sentences that have a word; one empty span if none."""
    spans, begin = [], 0
    for stop in SENTENCE.finditer(value):
        spans.append((begin, stop.start()))
        begin = stop.end()
    spans.append((begin, len(value)))
    return [(a, b) for a, b in spans if WORD.search(value, a, b)] or [(0, 0)]


class Model:
    """Weights of hashed features and a bias."""

    def __init__(self, weights: np.ndarray, bias: float, trained: bool = True):
        self.weights, self.bias, self.trained = weights, bias, trained

    def scorer(self):
        """value -> logits of its sentences."""
        weights, bias = self.weights, self.bias
        words = WordCache(lambda w: float(weights[word_features(w)].sum()), 32 << 20)

        def score(value: str) -> np.ndarray:
            lowered = value.lower()
            if len(lowered) != len(value):  # spans must hold for the text itself
                lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
            return np.array([bias + sum(map(words.__getitem__, set(WORD.findall(lowered, a, b)))) for a, b in sentences(value)])
        return score


def noisy_or(logits: np.ndarray) -> float:
    """1 minus the product of the sentences' chances of being harmless."""
    return float(-np.expm1(-np.logaddexp(0, logits).sum()))


def sentence_features(value: str, known) -> tuple[list[int], list[int]]:
    """Numbers of features in each sentence of a text, and the features, one
    sentence after the other; ``known`` gives a word's features."""
    sizes, found = [], []
    lowered = value.lower()
    for a, b in sentences(lowered):
        before = len(found)
        for word in set(WORD.findall(lowered, a, b)):
            found += known[word]
        sizes.append(len(found) - before)
    return sizes, found


def with_features(df: DataFrame, column: str) -> DataFrame:
    """Adds ``sizes`` and ``features`` of each text."""
    def make():
        known = WordCache(word_features, size=lambda v: 200)

        def run(texts):
            pairs = [sentence_features(x or "", known) for x in texts]
            return [np.array(p[0], np.int32) for p in pairs], [np.array(p[1], np.int32) for p in pairs]
        return run

    numbers = T.ArrayType(T.IntegerType())
    return append_columns(df, [column], make, [T.StructField("sizes", numbers), T.StructField("features", numbers)])


def train(texts: list[str], labels: list[int], rate: float | None = None) -> Model:
    """``train_features`` on texts."""
    known = WordCache(word_features, size=lambda v: 200)
    pairs = [sentence_features(x, known) for x in texts]
    sizes, feature = (np.array([v for p in pairs for v in p[k]], np.int32) for k in (0, 1))
    return train_features(sizes, feature, np.array([len(p[0]) for p in pairs], np.int64), np.array(labels, float), rate)


def train_features(sizes: np.ndarray, feature: np.ndarray, counts: np.ndarray, y: np.ndarray, rate: float | None = None) -> Model:
    """Full-batch Adam on the noisy-or likelihood.  ``sizes``: features of each
    sentence, ``feature``: their numbers, ``counts``: sentences of each document,
    ``y``: the documents' labels.  ``rate``: share of toxic documents among all
    training labels; the sample's classes are weighted back to it halfway (by
    square roots), which keeps the rare class learnable."""
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(DIMENSIONS, np.float32), -40.0, trained=False)
    of_sentence = np.repeat(np.arange(len(y)), counts)
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    documents = np.zeros(DIMENSIONS, np.int64)
    ends = np.cumsum(np.bincount(of_sentence, sizes, len(y))).astype(np.int64).tolist()
    for begin, end in zip([0, *ends[:-1]], ends, strict=True):
        documents[np.unique(feature[begin:end])] += 1
    often = documents >= LEAST_DOCUMENTS
    held = often[feature]
    feature, owner = feature[held], owner[held]
    used = np.flatnonzero(often)
    feature = np.searchsorted(used, feature).astype(np.int32)

    sample_rate = y.mean()
    rate = sample_rate if rate is None else min(max(rate, 1e-4), 1 - 1e-4)
    weight = np.where(y == 1, np.sqrt(rate / sample_rate), np.sqrt((1 - rate) / (1 - sample_rate)))
    weight /= weight.mean()
    w, bias = np.zeros(len(used)), -5.0
    m, v, mb, vb = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    for step in range(1, ROUNDS + 1):
        z = bias + np.bincount(owner, w[feature], minlength=len(of_sentence))
        harmless = np.bincount(of_sentence, -np.logaddexp(0, z), minlength=len(y))  # log of 1 - P
        p = -np.expm1(np.minimum(harmless, -1e-9))
        pull = np.where(y == 1, -(1 - p) / p, 1.0) * weight
        g = pull[of_sentence] / (1 + np.exp(-z)) / len(y)
        gw, gb = np.bincount(feature, g[owner], minlength=len(used)) + DECAY * w, g.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        fix = np.sqrt(1 - 0.99 ** step) / (1 - 0.9 ** step) * RATE
        w -= fix * m / (np.sqrt(v) + 1e-9)
        bias -= fix * mb / (np.sqrt(vb) + 1e-9)
    weights = np.zeros(DIMENSIONS, np.float32)
    weights[used] = w
    return Model(weights, float(bias))


def held_out(identifier: Column) -> Column:
    return F.crc32(identifier.cast("string").cast("binary")) % 3 == 1


def passed_over(sizes: list[tuple], room: int) -> list:
    """Of (id, kind, size) in the order of choice the ids whose texts do not fit
    into what is left of their kind's half of the room."""
    left, over = {0: room // 2, 1: room // 2}, []
    for identifier, kind, size in sizes:
        if size > left[kind]:
            over.append(identifier)
        else:
            left[kind] -= size
    return over


def fit(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", column: str = "text", label: str = "toxic",
        sample: int = SAMPLE) -> Model:
    """Trains on labelled documents outside the held-out third.  Only numbers of
    the bounded sample's features come to the driver."""
    known = (labels.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y"))
             .dropna().filter(~held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y")))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect() if r["y"] in (0, 1)}  # two rows
    if len(counts) < 2:
        return train([], [])
    chosen = bounded_sample(known.filter("y = 1"), "id", counts[1], sample // 2).unionByName(
        bounded_sample(known.filter("y = 0"), "id", counts[0], sample - sample // 2))
    texts = df.select(F.col(f"`{id_column}`").alias("id"), F.coalesce(F.col(f"`{column}`"), F.lit("")).alias("t"))
    # of repeated ids the smallest text stands for the document
    one = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("t").alias("t"), F.first("y").alias("y"))
    held = stage(with_features(one, "t").drop("t").withColumn("n", F.size("features").cast("long")), "toxicity-sample")
    sizes = held.select("id", "y", "n").orderBy(hash_share(F.col("id"), 7), "id").collect()  # at most ``sample`` rows
    over = passed_over([tuple(r) for r in sizes], ROOM)
    rows = (held.filter(~F.col("id").isin(over)) if over else held).orderBy("id").select("y", "sizes", "features").toArrow()
    lists = [rows.column(c).combine_chunks() for c in ("sizes", "features")]
    numbers = [np.asarray(x.flatten().to_numpy(zero_copy_only=False), np.int32) for x in lists]
    return train_features(*numbers, lists[0].value_lengths().to_numpy().astype(np.int64), rows.column("y").to_numpy().astype(float),
                          counts[1] / (counts[0] + counts[1]))


def score(df: DataFrame, model: Model, column: str = "text") -> DataFrame:
    """Adds ``score`` (0 to 1) and ``worst``, the sentence with the highest
    probability as (begin, end) in code points and its probability."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # 1 MB, whatever the input

    def make():
        model = shared.value
        logits = model.scorer()

        def run(texts):
            scores, worst = [], []
            for value in texts:
                z = logits(value or "") if model.trained else np.array([-np.inf])
                scores.append(noisy_or(z))
                k = int(z.argmax())
                begin, end = sentences(value or "")[k] if model.trained else (0, 0)
                worst.append({"begin": begin, "end": end, "probability": float(1 / (1 + np.exp(-z[k])))})
            return scores, worst
        return run

    span = T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType()),
                         T.StructField("probability", T.DoubleType())])
    return append_columns(df, [column], make, [T.StructField("score", T.DoubleType()), T.StructField("worst", span)])


def op9(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
    scored = score(docs, model)
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
