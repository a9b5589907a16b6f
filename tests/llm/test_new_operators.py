"""Ranked search, importance resampling and sharding against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trajex.llm import resampling, search, sharding

WORDS = "alpha Beta GAMMA delta ça ñandú straße 東京 don't 12345 x the the the of".split()
DOCS = "doc_id long, text string, lang string, source string"


def documents(seed, n, most=60):
    rng = random.Random(seed)
    rows = [(k, " ".join(rng.choices(WORDS, k=rng.randint(0, most))) + rng.choice(("", "\n", " !-")), rng.choice(["en", "de", None]), f"s{rng.randint(0, 5)}")
            for k in range(n)]
    rows += [(n, None, "en", None), (n + 1, "", None, "s1"), (n + 2, " \t\n ", "en", "s1"), (None, "alpha beta", "en", "s1"), (n + 3, "--- \x00 ", "xx", "s2")]
    rows += [rows[4]] * 5  # repeated rows
    rows += [(n + 10 + k, "copy of alpha " * 30, "en", f"s{k % 6}") for k in range(n // 3)]  # a large group of copies
    rows.append((n + 5000, "long " + " ".join(rng.choices(WORDS, k=60_000)), "en", "s0"))
    return rows


# ---- search ---------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(docs, items, top=10):
    tfs = [Counter(terms(t)) for _, t in docs]
    n_of = [sum(c.values()) for c in tfs]
    n_all, length = sum(n > 0 for n in n_of), sum(n_of)
    df = Counter(t for c in tfs for t in c)
    out = []
    for item, text in items:
        scored = []
        for (i, _), c, n in zip(docs, tfs, n_of):
            m = 25 + (75 * n * n_all) // length if length else 0
            s = sum(q * math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                    for t, q in Counter(terms(text)).items() if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(scored)[:top])]
    return out


@pytest.mark.parametrize("bucket,block", [(4096, 1 << 20), (7, 40)])
def test_search_equals_brute_force(spark, monkeypatch, bucket, block):
    monkeypatch.setattr(search, "BUCKET", bucket)
    docs = [r[:2] for r in documents(1, 200)]
    rng = random.Random(2)
    items = [(k, " ".join(rng.choices(WORDS, k=rng.randint(1, 12)))) for k in range(25)] + [(90, None), (91, ""), (92, "unknown words"), (93, "東京 東京 the")]
    got = search.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string"), block=block)
    want = brute_search(docs, items)
    assert sorted(map(str, map(tuple, got.select("item_id", "rank", "doc_id", "score").collect()))) == sorted(map(str, want))


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    blank = spark.createDataFrame([(1, None), (2, "--")], "doc_id long, text string")
    docs = spark.createDataFrame([(1, "alpha", "x")], "doc_id long, text string, score string")
    assert search.search(none, items).count() == search.search(blank, items).count() == 0
    assert search.search(docs, items.where("false")).count() == 0
    assert search.search(docs, items).collect() == [(1, 1, 1, search.search(docs, items).first().score)]


def test_bounds_lose_no_vector():
    """Every row whose exact score reaches the bound survives the bucket's bounds."""
    rng = np.random.default_rng(3)
    lost = kept = 0
    for _ in range(300):
        size, vocabulary = int(rng.integers(1, 40)), 30
        root = np.sqrt(rng.integers(0, 5000, vocabulary + 1).astype(float))
        sizes = rng.integers(1, 12, size)
        parts = [np.sort(rng.choice(vocabulary, s, replace=False) + 1) for s in sizes]
        values = [rng.integers(1, 1_000_000, s) for s in sizes]
        norms = np.array([np.sqrt((v.astype(float) ** 2 * root[t] ** 2).sum()) for t, v in zip(parts, values)])
        order = np.argsort(-norms)
        bucket = search.Bucket(np.arange(size), np.zeros(size, bool), norms[order], sizes[order], np.concatenate([parts[k] for k in order]),
                               np.concatenate([values[k] for k in order]), root)
        t = rng.choice(vocabulary, int(rng.integers(1, 10)), replace=False) + 1
        q = rng.integers(1, 4, len(t)) * root[t]
        by = np.argsort(-q)
        t, q = t[by], q[by]
        scores = np.array([sum(q[t == x][0] * root[x] * y for x, y in zip(parts[k], values[k]) if x in t) for k in order])
        length = float(np.sqrt((q * q).sum()))
        if length and scores.max() > 1:
            bound = int(rng.choice(scores[scores > 0])) if rng.random() < 0.8 else 1
            found = set(bucket.survivors((t, None, q, length), max(bound, 1)).tolist())
            need = set(np.flatnonzero(scores >= max(bound, 1)).tolist())
            lost += len(need - found)
            kept += len(found) < size
    assert lost == 0 and kept > 50


# ---- resampling -----------------------------------------------------------

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall((text or "").encode().lower())
    return words, [*words, *(a + b" " + b for a, b in zip(words, words[1:]))]


def brute_draw(docs, target):
    bucket = lambda f: zlib.crc32(f) % 10000
    s, t = Counter(bucket(f) for _, x in docs for f in features(x)[1]), Counter(bucket(f) for x in target for f in features(x)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + 10000) / ((s[b] + 1) * (sum(t.values()) + 10000))))
    rows = []
    for i, x in docs:
        words, f = features(x)
        weight = sum(gain(bucket(v)) for v in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= 20))
    order = sorted((k for k, r in enumerate(rows) if r[4]), key=lambda k: (-rows[k][3], rows[k][0] is None, rows[k][0] or 0))
    drawn = {k: place + 1 for place, k in enumerate(order[:25 * len(order) // 100])}
    return [(*r[:4], drawn.get(k)) for k, r in enumerate(rows)]


@pytest.mark.parametrize("block", [1 << 20, 9])
def test_resampling_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(resampling.word_blocks, "__defaults__", (2, block))
    docs, target = [r[:2] for r in documents(4, 300)], ["alpha delta the the", None, "", "ñandú of of of x"]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    gain = resampling.fit(df, spark.createDataFrame([(t,) for t in target], "text string"))
    got = resampling.ranked(df, gain).select("id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_draw(docs, target)))


def test_longer_runs_and_block_borders():
    rng = random.Random(5)
    for _ in range(60):
        text = " ".join(rng.choices(["a", "bb", "ccc", "é"], k=rng.randint(0, 40))).encode()
        words = text.split()
        for run in (1, 2, 3):
            want = Counter(zlib.crc32(b" ".join(words[i:i + k])) for k in range(1, run + 1) for i in range(len(words) - k + 1))
            got, n = Counter(), 0
            for part, carried in resampling.word_blocks(text, run, rng.randint(1, 30)):
                got.update(resampling.checksums(part, carried, run))
                n += len(part) - carried
            assert got == want and n == len(words)


def test_drawn_rows_keep_their_columns(spark):
    rows = [(k, f"{'alpha ' * 25} w{k % 7}", k, "z") for k in range(100)] + [(3, f"{'alpha ' * 25} w3", 3, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, rank long, `__key` string")
    target = spark.createDataFrame([("alpha w3",)], "text string")
    drawn = resampling.resample(df, target)
    assert drawn.columns == df.columns and drawn.count() == 25 and set(map(tuple, drawn.collect())) <= set(rows)
    empty = df.where("false")
    assert resampling.resample(empty, target).count() == 0 and resampling.resample(df, target.where("false")).count() == 25


# ---- sharding -------------------------------------------------------------

def brute_tree(points, shards, dims):
    """Plain recursion: points (weight, h, cells) to shards."""
    out = {}

    def split(keys, first, k):
        if k == 1 or not keys:
            out.update(dict.fromkeys(keys, first))
            return
        widths = [(max(points[p][2][d] for p in keys) - min(points[p][2][d] for p in keys), -d) for d in range(dims)]
        dim = -max(widths)[1]
        groups = {}
        for p in keys:
            groups.setdefault((points[p][2][dim], points[p][1]), []).append(p)
        goal, before = sum(points[p][0] for p in keys) * ((k // 2) / k), 0
        left = []
        for at in sorted(groups):
            size = sum(points[p][0] for p in groups[at])
            if before + size >= goal:
                if 2 * (goal - before) > size:
                    left += groups[at]
                break
            left += groups[at]
            before += size
        split(left, first, k // 2)
        split([p for p in keys if p not in set(left)], first + k // 2, k - k // 2)
    split(list(points), 0, shards)
    return out


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
def test_tree_equals_plain_recursion(spark, shards):
    rows = documents(6, 150)
    df = spark.createDataFrame(rows, DOCS)
    _, found = sharding.points(sharding.sized_rows(df, "doc_id", "text", ["lang", "source"], None), shards)
    got = {(bytes(r.digest), r.part): r.shard for r in sharding.tree(found, shards).collect()}
    points = {(bytes(r.digest), r.part): (r.weight, r.h, (r.d0, r.d1, r.d2)) for r in found.collect()}
    assert got == brute_tree(points, shards, 3)


def test_shards_hold_near_equal_bytes_and_whole_groups(spark):
    rng = random.Random(8)
    rows = [(k, " ".join(rng.choices(WORDS, k=rng.randint(1, 80))), rng.choice(["en", "fr"]), f"s{k % 9}") for k in range(4000)]
    rows += [(5000 + k, rows[k % 50][1], "xx", "t") for k in range(300)]  # small groups, other metadata
    rows += [(9000 + k, "the one text that a third of all rows hold " * 4, "en", f"s{k % 9}") for k in range(2200)]
    df = spark.createDataFrame(rows, DOCS)
    got = sharding.assign(df, shards=10).collect()
    text = {r[0]: r[1] for r in rows}
    assert len(got) == len(rows)
    sizes, slots, where = Counter(), {}, {}
    for r in got:
        data = text[r.id].encode()
        assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
        sizes[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
        where.setdefault(text[r.id], set()).add(r.shard)
    assert set(sizes) == set(range(10)) and max(sizes.values()) < 1.06 * min(sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sum(len(s) > 1 for s in where.values()) <= 1  # only the group that no shard could hold


def test_shards_of_nulls_empties_and_repeats(spark, tmp_path):
    rows = documents(7, 60)
    df = spark.createDataFrame(rows, DOCS).withColumn("shard", F.lit("mine")).withColumn("num", F.when(F.col("doc_id") > 30, float("nan")).otherwise(1.5))
    got = sharding.assign(df, dimensions=["lang", "source", "num"], shards=6).collect()
    assert sorted(str(r.id) for r in got) == sorted(str(r[0]) for r in rows)
    assert sum(r.size for r in got) == sum(len((r[1] or "").encode()) + 16 for r in rows)
    assert sharding.assign(df.where("false"), shards=6).count() == 0
    same = spark.createDataFrame([(1, "x", "en", "s")] * 500, DOCS)  # one row, many times
    sizes = Counter(r.shard for r in sharding.assign(same, shards=4).collect())
    assert sum(sizes.values()) == 500 and max(sizes.values()) < 180
    path = str(tmp_path / "shards")
    plain = spark.createDataFrame(rows, DOCS).withColumn("n_words", F.lit(1))
    sharding.write_shards(plain, path, target_bytes=4000, dimensions=["lang"])
    back = spark.read.parquet(path)
    assert sorted(map(str, back.drop("shard").collect())) == sorted(map(str, plain.collect()))
    assert back.select("shard").distinct().count() > 10
