"""Quality rules with tokeniser fertility.

Base measures count words, symbols, repeated lines and repeated word windows.
A public subword vocabulary with byte fallback adds three measures: characters
per token, the share of byte-fallback tokens, and the entropy of the tokens as
a share of its largest value.  Text that a tokeniser finds as ordinary as other
text of its language lies near the language's median; a document outside the
language's band is rejected.

Bands come from all different texts that pass the base rules, so copies have
one vote: median plus or minus
``WIDTH`` robust deviations, at least the ``LEAST`` margin, per language and
length class (half a doubling of the word count, since longer texts repeat more
of their tokens).  A class with fewer than ``ENOUGH`` such texts takes the
classes around it as far as needed, to the whole language; their values are
moved along the language's line over the classes.  A language with fewer texts
in all uses its script in the same way, a script with fewer the whole table,
and a table with fewer its band over all it has: no document that passes the
base rules goes without a band.

Null texts have no words and fail the base rules.  Empty tables give empty
results.  Words are what ``[^\\x20\\x09-\\x0D]+`` matches.
"""

from __future__ import annotations

import hashlib
import math
import unicodedata

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajex.llm.common import WordCache, append_columns, long, small_join, stage, text, worker_tool

SYMBOLS = b"#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MEASURES = ("chars_per_token", "byte_share", "entropy")
#: Robust deviations and least margins of a band, by measure.
WIDTH = 5.0
LEAST = {"chars_per_token": 0.15, "byte_share": 0.1, "entropy": 0.06}
ENOUGH = 30
DIGITS = 3
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words covered by a window of words that occurs more than once."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    key = ids[:n]
    for k in range(1, window):
        # numbers of pairs stay below the count of windows, so products fit
        if k > 1:
            key = np.unique(key, return_inverse=True)[1]
        key = key * len(numbers) + ids[k:n + k]
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    covered = np.zeros(len(words), bool)
    for k in range(window):
        covered[k:n + k] |= twice
    return int(covered.sum())


def duplicate_lines(value: bytes) -> int:
    lines = [line for line in value.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def script_of(value: str) -> str:
    """Script of most letters, by the first word of their Unicode names; found
    on the distinct characters with their counts."""
    totals: dict[str, int] = {}
    for char in set(value):
        if char.isalpha():
            name = "LATIN" if char < "ɐ" else unicodedata.name(char, "OTHER").split()[0]
            totals[name] = totals.get(name, 0) + value.count(char)
    return max(sorted(totals), key=totals.__getitem__) if totals else "NONE"


class Fertility:
    """Token numbers of words under a subword vocabulary with byte fallback.
    Its pieces never cross white space, so words are tokenised one by one."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.vocab_size()
        self.is_byte = np.fromiter(map(self.model.is_byte, range(size)), bool, size)
        self.words = WordCache(self._word)

    def _word(self, word: bytes) -> bytes:
        return np.array(self.model.encode(word.decode()), "<u2").tobytes()

    def measure(self, words: list[bytes], chars: int) -> tuple[float, float, float]:
        """Characters per token, share of byte tokens, entropy over its largest
        value; zeros without words."""
        ids = np.frombuffer(b"".join(map(self.words.__getitem__, words)), "<u2")
        if not len(ids):
            return 0.0, 0.0, 0.0
        kinds, counts = np.unique(ids, return_counts=True)
        share = counts / len(ids)
        most = math.log(len(ids))
        entropy = float(-(share * np.log(share)).sum()) / most if most else 0.0
        return chars / len(ids), float(counts[self.is_byte[kinds]].sum()) / len(ids), entropy


def measures(df: DataFrame, path: str, column: str = "text") -> DataFrame:
    """Adds the counts, the three measures, base_failed, script and __digest,
    which copies in the sense of ``exact_dedup`` share."""
    def make():
        tool = worker_tool(("fertility", path), lambda: Fertility(path))

        def run(texts):
            rows = []
            for value in texts:
                value = value or ""
                data = value.encode()
                words = data.split()  # on ASCII white space only, as bytes
                chars = len(value) - sum(map(value.count, SPACES))
                repeat = repeated_words(words)
                failed = len(words) < 50 or 100 * repeat > 50 * len(words)
                symbols = len(data) - len(data.translate(None, SYMBOLS))
                rows.append((len(words), chars, symbols, duplicate_lines(data), repeat, failed,
                             *tool.measure(words, chars), script_of(value), hashlib.sha256(data.lower()).digest()))
            return list(zip(*rows, strict=True)) if rows else [[]] * 11
        return run

    double = [T.StructField(m, T.DoubleType()) for m in MEASURES]
    fields = [long(c) for c in COUNTS] + [T.StructField("base_failed", T.BooleanType()), *double, text("script"),
              T.StructField("__digest", T.BinaryType())]
    return append_columns(df, [column], make, fields)


def different(measured: DataFrame, by: list[str]) -> DataFrame:
    """The measures of the texts that pass the base rules, copies once a group.
    Copies that differ in case can differ in their measures: the smallest hash
    of the measures decides."""
    good = measured.filter(~F.col("base_failed")).dropna(subset=by)
    one = F.min(F.struct(F.xxhash64(*MEASURES), *MEASURES)).alias("one")
    return good.groupBy(*by, "__digest").agg(one).select(*by, *(f"one.{m}" for m in MEASURES))


def windows(classes: DataFrame, by: str, last: bool) -> DataFrame:
    """From the support ``n`` and the medians of each length class of a group:
    rows (group, class, ``from``), the classes that the class's band is taken
    from, with the shift of each measure between the two.

    A class takes the classes up to the smallest distance that gives it
    ``ENOUGH`` texts.  A group with fewer texts in all has no rows, or with
    ``last`` takes what it has.  The shift follows the line through the medians
    of the group's classes, each with the weight of its texts."""
    x, n = F.col("__size"), F.col("n")
    total, wx, wxx = F.sum(n), F.sum(n * x), F.sum(n * x * x)
    flat = total * wxx - wx * wx
    lines = classes.groupBy(by).agg(*(
        F.when(flat > 0, (total * F.sum(n * x * F.col(f"mid_{m}")) - wx * F.sum(n * F.col(f"mid_{m}"))) / flat)
        .otherwise(0.0).alias(f"slope_{m}") for m in MEASURES))
    away = F.abs(F.col("from") - x)
    near = classes.select(by, F.col("__size").alias("from"), "n")
    pairs = classes.select(by, "__size").join(near, by).withColumn("away", away)
    one = Window.partitionBy(by, "__size")  # at most the classes of a group
    pairs = pairs.withColumn("within", F.sum("n").over(one.orderBy("away").rangeBetween(Window.unboundedPreceding, 0)))
    radius = F.min(F.when(F.col("within") >= ENOUGH, F.col("away"))).over(one)
    radius = F.coalesce(radius, F.max("away").over(one)) if last else radius
    pairs = pairs.withColumn("radius", radius).filter(F.col("away") <= F.col("radius"))
    return pairs.join(lines, by).select(by, "__size", "from", *(
        (F.col(f"slope_{m}") * (x - F.col("from"))).alias(f"shift_{m}") for m in MEASURES))


def bands(texts: DataFrame, by: str, last: bool = False) -> DataFrame:
    """Per group and length class, by measure, the median and the median
    distance from it over the class's window of different ``texts``, of values
    rounded to ``DIGITS``: counts of at most some thousand values, which merge
    exactly."""
    classes = stage(texts.groupBy(by, "__size").agg(
        F.count("*").alias("n"), *(F.percentile(F.round(m, DIGITS), 0.5).alias(f"mid_{m}") for m in MEASURES)), "classes")
    window = stage(windows(classes, by, last), "windows")
    near = small_join(texts.withColumnRenamed("__size", "from"), window, [by, "from"], "inner").select(
        by, "__size", *((F.col(m) + F.col(f"shift_{m}")).alias(m) for m in MEASURES))
    medians = stage(near.groupBy(by, "__size").agg(
        *(F.percentile(F.round(m, DIGITS), 0.5).alias(f"mid_{m}") for m in MEASURES)), "medians")
    away = {m: F.abs(F.col(m) - F.col(f"mid_{m}")) for m in MEASURES}
    return small_join(near, medians, [by, "__size"], "inner").groupBy(by, "__size").agg(
        *(F.first(f"mid_{m}").alias(f"mid_{m}") for m in MEASURES),
        *(F.percentile(F.round(away[m], DIGITS), 0.5).alias(f"dev_{m}") for m in MEASURES))


def inside(measure: str, prefix: str = "") -> Column:
    margin = F.greatest(F.lit(LEAST[measure]), WIDTH * 1.4826 * F.col(f"{prefix}dev_{measure}"))
    away = F.col(measure) - F.col(f"{prefix}mid_{measure}")
    if measure == "byte_share":  # few byte tokens are no fault
        return away <= margin
    return F.abs(away) <= margin


def judge(df: DataFrame, path: str, column: str = "text", language: str | None = "lang", keep_text: bool = True) -> DataFrame:
    """Adds the measures and ``kept`` to the rows of ``df``.  The measured rows
    are written once (without the text unless ``keep_text``); the bands come
    from them.  Languages are compared as they
    are written; a null language uses its script's bands."""
    lang = F.col(f"`{language}`").cast("string") if language else F.lit(None).cast("string")
    size = F.round(2 * F.log2(F.greatest(F.col("n_words"), F.lit(1)))).cast("int")
    measured = measures(df, path, column).withColumn("__lang", lang).withColumn("__size", size)
    rows = stage(measured if keep_text else measured.drop(column), "measures")
    told = stage(different(rows, ["__lang", "__size"]), "different")
    every = stage(different(rows, ["script", "__size"]).withColumn("__all", F.lit(0)), "different")
    names = [f"{p}_{m}" for p in ("mid", "dev") for m in MEASURES]
    judged, verdict = rows.withColumn("__all", F.lit(0)), {m: [] for m in MEASURES}
    for texts, by, prefix in ((told, "__lang", "lang_"), (every, "script", "script_"), (every, "__all", "all_")):
        found = stage(bands(texts, by, by == "__all").select(by, "__size", *(F.col(c).alias(prefix + c) for c in names)), "bands")
        judged = small_join(judged, found, [by, "__size"])
        for m in MEASURES:
            verdict[m].append(inside(m, prefix))
    kept = ~F.col("base_failed")
    for m in MEASURES:
        kept = kept & F.coalesce(*verdict[m])
    extra = ["__lang", "__size", "__digest", "__all", *(p + c for p in ("lang_", "script_", "all_") for c in names)]
    return judged.withColumn("kept", kept).drop(*extra)


def op7(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    found = judge(docs, public_tokenizers.path("piece_bpe_32k.model"), keep_text=False)
    return found.select("doc_id", *COUNTS, "base_failed", "kept", *MEASURES, "script")
