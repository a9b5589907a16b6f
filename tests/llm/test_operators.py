"""Corpus operators against brute force, round trips and edge cases."""

import hashlib
import random
import re
import struct

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from trajex.llm import bpe, components, exact_dedup, html_extract, mixing, pii, quality, simhash, token_counts, toxicity, warc
from trajex.llm.html_tree import parse

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = "alpha beta gamma delta ça ñandú straße 東京 don't 12345 x".split()
#: Nulls, empties, spaces, repeated rows, equal ids, clashing names, a long text.
ROWS = [(1, "A b C", "n"), (2, "a B c", "m"), (2, "a B c", "m"), (3, None, None), (4, "", "x"), (None, "zz top", "y"),
        (None, "zz top", "y"), (7, " \t\n ", "z"), (8, "ÀB ", "q"), (9, "àb ", "q"), (10, " ".join(WORDS * 4000), "long")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, n_tokens string")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def texts(seed, n):
    rng = random.Random(seed)
    return [" ".join(rng.choices(WORDS, k=rng.randint(0, 40))) + rng.choice(("", "\n", "  !")) for _ in range(n)]


# ---- tokenisers -----------------------------------------------------------

def test_bpe_equals_tiktoken_and_round_trips(spark, docs):
    coded = bpe.encode(docs, MULTI, public_tokenizers.PATTERN)
    assert coded.columns.count("n_tokens") == 1  # the clashing column gave way
    rows = coded.collect()
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(MULTI), special_tokens={})
    for r in rows:
        want = theirs.encode_ordinary(r.text or "")
        assert list(r.token_ids) == want and r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(want)}I", *want)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    back = bpe.decode(coded.drop("text"), MULTI).collect()
    assert sorted(r.text for r in back) == sorted(r.text or "" for r in rows)


def test_prefix_table_appends_and_edits():
    merges = bpe.Merges(bpe.read_ranks(MULTI))
    rng = random.Random(4)
    for value in texts(1, 60):
        data = value.encode()
        table = bpe.PrefixTable(merges, data[:7])
        table.append(data[7:])
        assert table.tokens() == bpe.PrefixTable(merges, data).tokens()
        a = rng.randint(0, len(data))
        b = min(len(data), a + rng.randint(0, 5))
        new = rng.choice((b"", b"q", b" the", b"\xff"))
        table.edit(a, b, new)
        assert table.tokens() == bpe.PrefixTable(merges, data[:a] + new + data[b:]).tokens()
    long = bpe.PrefixTable(merges, ("".join(WORDS) * 500).encode())
    assert long.edit(100, 101, b"z") < 200  # only near the edit


@pytest.mark.parametrize("continuation", [b"", b"##"])
def test_longest_match_counts(continuation):
    rng = random.Random(2)
    for _ in range(60):
        pieces = {bytes(rng.choices(b"abc", k=rng.randint(1, 4))) for _ in range(8)}
        vocabulary = pieces | {continuation + p for p in rng.sample(sorted(pieces), 4)}
        starts = {p for p in vocabulary if not continuation or not p.startswith(continuation)}
        inner = {p[len(continuation):] for p in vocabulary if p.startswith(continuation)} if continuation else starts
        count = token_counts.LongestMatch(vocabulary, continuation).count
        for _ in range(60):
            word = bytes(rng.choices(b"abcd" if rng.random() < 0.1 else b"abc", k=rng.randint(0, 12)))
            at = n = 0
            while at < len(word):
                allowed = starts if at == 0 else inner
                size = max((k for k in range(1, len(word) - at + 1) if word[at:at + k] in allowed), default=0)
                if not size:
                    n = 1
                    break
                at, n = at + size, n + 1
            assert count(word) == n, (vocabulary, word)


def test_token_counts_of_nulls_and_empty_tables(docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = token_counts.token_counts(docs, path, public_tokenizers.PATTERN).collect()
    assert all(r.n_tokens == r.n_words == 0 for r in rows if not r.text)
    assert all(r.n_tokens >= r.n_words > 0 for r in rows if r.text)
    assert token_counts.token_counts(empty, path, public_tokenizers.PATTERN).count() == 0


# ---- duplicates -----------------------------------------------------------

def brute_exact(rows):
    norm = lambda t: (t or "").encode().lower()
    return sorted(((i, max((j for j, u, *_ in rows if norm(u) == norm(t) and j is not None), default=None),
                    sum(norm(u) == norm(t) for _, u, *_ in rows), hashlib.sha256(norm(t)).hexdigest()) for i, t, *_ in rows), key=str)


@pytest.mark.parametrize("counters", [1, 2, 1024])
def test_exact_groups(docs, counters):
    rows = exact_dedup.exact_groups(docs, counters=counters).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=str) == brute_exact(ROWS)
    kept = [r.text_sha256 for r in rows if r.kept]
    assert len(kept) == len(set(kept)) == len({r.text_sha256 for r in rows})
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)
    stay = exact_dedup.deduplicate(docs, counters=counters)
    assert stay.columns == docs.columns and stay.count() == len(kept)


def test_misra_gries_holds_every_heavy_value(spark):
    values = ["hot"] * 500 + ["warm"] * 200 + [f"v{k}" for k in range(300)]
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "d string").repartition(7)
    found = {r.d for r in exact_dedup.misra_gries(df, "d", 5).collect()}
    assert {"hot", "warm"} <= found and len(found) <= 5


def test_components_of_paths_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (-5, 200), (200, -5)]
    found = {r.node: r.root for r in components.spanning(spark.createDataFrame(edges, "a long, b long")).collect()}
    groups = {}
    for node, root in found.items():
        groups.setdefault(root, set()).add(node)
    assert sorted(map(sorted, groups.values())) == [[-5, 200], list(range(41)), list(range(100, 160))]
    assert components.spanning(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_simhash_groups_equal_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(None if rng.random() < 0.03 else k, t) for k, t in enumerate(texts(5, 150))]
    for k in range(60):  # near copies: one word at the end of a longer text differs
        rows.append((1000 + k, " ".join(WORDS * 40) + f" w{k}"))
    rows += [(5000, None), (5001, ""), (5001, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    prints = [brute_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    first = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in set(group)}
    want = sorted(((r[0], f"{p:016x}", first[g]) for r, p, g in zip(rows, prints, group)), key=str)
    for piece in (simhash.PIECE, 3):  # pieces of a tile give the same groups
        monkeypatch.setattr(simhash, "PIECE", piece)
        assert sorted(map(tuple, simhash.near_duplicates(df).collect()), key=str) == want
    assert simhash.deduplicate(df).count() == len(set(group))


def test_forest_keeps_components():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 300, 200, np.uint64), rng.integers(0, 300, 200, np.uint64)
    forest = simhash.Forest()
    forest.add(a, b)
    x, y = forest.shrink()

    def groups(pairs):
        label = {}
        for p, q in pairs:
            u, v = label.setdefault(p, p), label.setdefault(q, q)
            label = {k: u if w == v else w for k, w in label.items()}
        return {frozenset(k for k in label if label[k] == w) for w in label.values()} - {frozenset([k]) for k in label}
    assert groups(zip(a.tolist(), b.tolist())) == groups(zip(x.tolist(), y.tolist()))


# ---- mixing ---------------------------------------------------------------

def water_fill(sizes, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    target, free = {}, set(order)
    while True:
        rest = sum(sizes.values()) - sum(target.values())
        share = {s: rest * w[s] / sum(w[t] for t in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        target |= {s: 3 * sizes[s] for s in over}
        free -= over


def test_mix_meets_targets(spark):
    rng = random.Random(9)
    rows = [(k if k % 17 else None, " ".join(["w"] * rng.randint(0, 400)) if k % 11 else None, s)
            for k, s in enumerate(rng.choices(["b", "a", "é", None, "z", "tiny"], [30, 3, 9, 4, 20, 1], k=400))]
    rows += [rows[5]] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((i or -1, len((t or "").split())) for i, t, _ in rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = water_fill(sizes)
    for s in sizes:
        mine = [r for r in got if r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s])]
        assert mine and sum(r.taken for r in mine) == round(want[s])
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(df.repartition(5)).collect()))
    mixed = mixing.mixed_documents(df.withColumn("n_chars", F.length("text")))
    assert mixed.filter("n_chars <> length(text)").count() == 0
    assert sum(len(r.text.split()) for r in mixed.collect()) == sum(r.taken for r in got)


def test_draws_of_the_shards_decide_the_slots(spark):
    rng = random.Random(19)
    rows = [(k, " ".join(["w"] * rng.randint(1, 300)), s) for k, s in enumerate(rng.choices(["a", "b", "c", None], [60, 20, 10, 1], k=700))]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = mixing.sized(df, "doc_id", "text", "source")
    targets = mixing.targets_of(sizes)
    passes = mixing.passes_of(targets, 16)
    quota = {r.place: r.quota for r in passes.groupBy("place").agg(F.sum("slots").alias("quota")).collect()}
    drawn = mixing.drawn_counts(passes.groupBy("place").agg(F.sum("slots").alias("quota")), 8).collect()
    n = sum(quota.values())
    per_shard = {}
    for r in drawn:
        per_shard.setdefault(r.shard, {})[r.place] = r.n
    assert sorted(sum(c.values()) for c in per_shard.values()) == sorted(n // 8 + (k < n % 8) for k in range(8))
    # a multinomial draw: counts scatter about their mean as they should
    chi = sum((per_shard[s].get(p, 0) - q / 8) ** 2 / (q / 8 * (1 - q / n)) for s in per_shard for p, q in quota.items() if 0 < q < n)
    assert 0.3 < chi / (8 * len(quota)) < 2.5
    slots = mixing.slots(targets, 16, 8).collect()
    assert sorted((r.place, r.turn, r.slot) for r in slots) == sorted({(r.place, r.turn, r.slot) for r in slots})
    got, indexes = {}, {}
    for r in slots:
        got.setdefault(r.shard, {}).setdefault(r.place, 0)
        got[r.shard][r.place] += 1
        indexes.setdefault((r.place, r.turn), []).append(r.index)
    assert all(len(x) == len(set(x)) for x in indexes.values())  # a block once a pass
    # shards stay equal, and differ from the draw only by what meets the quotas
    assert sum(sum(c.values()) for c in got.values()) <= n
    moved = sum(max(0, sum(per_shard[s].get(p, 0) for s in per_shard) - q) for p, q in quota.items())
    differs = sum(abs(got[s].get(p, 0) - per_shard[s].get(p, 0)) for s in per_shard for p in quota)
    assert differs <= 2 * moved + len(quota) * 2
    blocks = mixing.mixed_blocks(df, block=16, shards=8)
    held = blocks.collect()
    assert {(r.shard, r.turn, r.slot) for r in held} == {(r.shard, r.turn, r.slot) for r in slots}
    assert sum(r.n_words for r in held) == sum(r.taken for r in mixing.mix(df, block=16).collect())
    assert all(len(r.text.split()) == r.n_words <= 16 for r in held)


def test_permutation_and_its_inverse(spark):
    for n in (1, 2, 7, 100):
        df = spark.range(n).withColumn("keys", mixing.round_keys(42, F.lit(3), F.lit(0), F.lit(n)))
        there = df.withColumn("to", mixing.permute(F.col("id"), F.col("keys"), F.lit(n)))
        rows = there.withColumn("back", mixing.permute(F.col("to"), F.reverse("keys"), F.lit(n))).collect()
        assert sorted(r.to for r in rows) == list(range(n)) and all(r.back == r.id for r in rows)


# ---- quality --------------------------------------------------------------

def brute_quality(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines, dup = [], 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.append(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_quality_base_measures(spark):
    rng = random.Random(8)
    values = [None, "", "a\x1cb\x85c\xa0d e", "x y z x y z\nx y z\n x y z\n\nx y z"] + [
        "\n".join(" ".join(rng.choices("ab c# |d é".split(), k=rng.randint(0, 6))) for _ in range(rng.randint(0, 20))) for _ in range(80)]
    df = spark.createDataFrame([(k, t, "en" if k % 3 else None) for k, t in enumerate(values)], "doc_id long, text string, lang string")
    rows = quality.judge(df, public_tokenizers.path("piece_bpe_32k.model")).collect()
    assert len(rows) == len(values)
    for r in rows:
        want = brute_quality(values[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_quality_bands_reject_odd_text_only(spark):
    rng = random.Random(6)
    syllables = "the an ing ed re th on er st".split()
    good = [" ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(200)) for _ in range(150)]
    odd = [" ".join("".join(chr(rng.randint(0x2500, 0x25ff)) for _ in range(3)) for _ in range(200)) for _ in range(5)]
    df = spark.createDataFrame([(k, t, "en") for k, t in enumerate(good + odd)], "doc_id long, text string, lang string")
    kept = {r.doc_id for r in quality.judge(df, public_tokenizers.path("piece_bpe_32k.model")).filter("kept").collect()}
    assert kept == set(range(150))


def test_quality_bands_give_copies_one_vote(spark):
    rng = random.Random(12)
    syllables = "the an ing ed re th on er st".split()
    good = [" ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(200)) for _ in range(60)]
    junk = " ".join("".join(chr(rng.randint(0x2500, 0x25ff)) for _ in range(3)) for _ in range(199)) + " end"
    copies = [junk, junk.replace("end", "End")] * 45  # 60 % of the cell, as exact dedup sees copies
    df = spark.createDataFrame([(k, t, "en") for k, t in enumerate(good + copies)], "doc_id long, text string, lang string")
    kept = {r.doc_id for r in quality.judge(df, public_tokenizers.path("piece_bpe_32k.model")).filter("kept").collect()}
    assert kept == set(range(60))


@pytest.mark.parametrize("short", [150, 12])
def test_quality_bands_cover_thin_classes(spark, short):
    """Long texts whose class has one good and one odd document, a language of
    one document, and a table with fewer documents than a band wants."""
    rng = random.Random(14)
    syllables = "the an ing ed re th on er st".split()
    good = [" ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n))
            for n in [rng.randint(60, 900) for _ in range(short)] + [2500]]
    odd = [" ".join("".join(chr(rng.randint(0x2500, 0x25ff)) for _ in range(3)) for _ in range(n)) for n in (2500, 100, 300)]
    rows = [(k, t, "en" if k < short + 2 else ["xx", None][k % 2]) for k, t in enumerate(good + odd)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    judged = quality.judge(df, public_tokenizers.path("piece_bpe_32k.model")).collect()
    assert not any(r.base_failed for r in judged) and {r.doc_id for r in judged if r.kept} == set(range(short + 1))


def test_fertility_tokenises_words_like_whole_texts():
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    tool, model = quality.Fertility(path), sentencepiece.SentencePieceProcessor(model_file=path)
    for value in texts(11, 40):
        ids = np.frombuffer(b"".join(tool.words[w] for w in value.encode().split()), "<u2").tolist()
        assert ids == model.encode(" ".join(value.split()))


# ---- personal data --------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(t):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(d):
        return sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(reversed(d))) % 10 == 0
    return ([("email", *m.span()) for m in EMAIL.finditer(t)]
            + [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
            + [("card", *m.span()) for m in CARD.finditer(t) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
            + [("phone", *m.span()) for m in PHONE.finditer(t) if 8 <= len(digits(m[0])) <= 15])


def test_base_spans_equal_the_patterns():
    rng = random.Random(0)
    for _ in range(20_000):
        t = "".join(rng.choices("a.b@1-2 +()3.4%_@c..d\n9", k=rng.randint(0, 40)))
        assert [(k, *s) for k in pii.KINDS for s in pii.BASE[k](t)] == brute_spans(t)
    card = "4539 1488 0343 6467"
    for t in (card, card + "1", "é" + card, "+49 (30) 1234-567", "1.2.3.4.5.6.7.8", "999.1.1.1 1.1.1.1", "4" * 5000 + "@" * 50):
        assert [(k, *s) for k in pii.KINDS for s in pii.BASE[k](t)] == brute_spans(t)


def test_pii_keeps_base_spans_and_adds_some(spark):
    rng = random.Random(1)
    rows = [(k, f"call phone +1 (212) 555-{rng.randint(1000, 9999)} or mail a{k}@x{k}.com from host 10.0.{k % 200}.7") for k in range(80)]
    rows += [(100 + k, f"my phone (415) 555-{rng.randint(1000, 9999)} now") for k in range(20)] + [(200, None), (201, ""), (201, "")]
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    for r in found:
        assert [(c.kind, c.begin, c.end) for c in r.found if c.base] == brute_spans(r.text or "")
    assert sum(not c.base for r in found for c in r.found) >= 20  # numbers without a plus sign


# ---- toxicity -------------------------------------------------------------

def test_toxicity_learns_sentences(spark):
    rng = random.Random(5)
    calm = "sea road hill tree stone water light house bread paper".split()
    rows = []
    for k in range(600):
        sentences = [" ".join(rng.choices(calm, k=8)) for _ in range(rng.randint(1, 12))]
        bad = k % 5 == 0
        if bad:
            sentences.insert(rng.randint(0, len(sentences)), "you are a " + rng.choice(("vilish", "vilest", "grubber")) + " thing")
        rows.append((k, ". ".join(sentences) + ".", int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    extra = spark.createDataFrame([(None, "x"), (9999, None), (9999, None)], "doc_id long, text string")
    model = toxicity.fit(df, df.select("doc_id", "toxic"))
    scored = toxicity.score(df.select("doc_id", "text").unionByName(extra), model).collect()
    assert len(scored) == 603 and all(0 <= r.score <= 1 for r in scored)
    truth = {r[0]: r[2] for r in rows}
    held = {r.id for r in spark.range(600).filter(toxicity.held_out(F.col("id"))).collect()}
    right = [(r.score >= 0.7) == truth[r.doc_id] for r in scored if r.doc_id in held]
    assert np.mean(right) > 0.97
    for r in scored:
        if r.doc_id in held and truth[r.doc_id] and r.score >= 0.7:
            assert "you are" in r.text[r.worst.begin:r.worst.end]
    none = toxicity.fit(df, df.select("doc_id", "toxic").filter("toxic = 0"))
    assert {r.score for r in toxicity.score(df.select("text"), none).collect()} == {0.0}


def test_toxicity_trains_on_whole_texts(spark, monkeypatch):
    rng = random.Random(15)
    calm = "sea road hill tree stone water light house bread paper".split()
    rows = []
    for k in range(150):
        sentences = [" ".join(rng.choices(calm, k=500)) for _ in range(9)]  # over 20,000 characters
        rows.append((k, ". ".join([*sentences, "you are a grubber thing" if k % 3 == 0 else "a calm day"]) + ".", int(k % 3 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    assert min(len(r[1]) for r in rows) > 20_000
    seen = []
    train = toxicity.train_features
    monkeypatch.setattr(toxicity, "train_features", lambda sizes, f, n, y, rate: seen.append((n, y, len(f))) or train(sizes, f, n, y, rate))
    scored = toxicity.score(df, toxicity.fit(df, df.select("doc_id", "toxic"))).collect()
    assert np.mean([(r.score >= 0.7) == r.toxic for r in scored]) > 0.97
    assert set(seen[0][0].tolist()) == {10}  # every sentence of every text
    monkeypatch.setattr(toxicity, "ROOM", seen[0][2] // 4)  # fewer rows, none of them cut
    toxicity.fit(df, df.select("doc_id", "toxic"))
    assert len(seen[1][1]) < len(seen[0][1]) / 2 and set(seen[1][0].tolist()) == {10} and 0 < seen[1][1].mean() < 1
    assert toxicity.passed_over([("a", 1, 9), ("b", 1, 5), ("c", 0, 3), ("d", 1, 4)], 18) == ["b", "d"]


# ---- pages and archives ---------------------------------------------------

def test_tree_reader_of_broken_pages():
    tree = parse('<ul><li>a<li><p>b</ul>x &amp;<p>y <i>z<div class="q">t<a href=">">l</a></div><!-- n -->u &am<scr')
    assert [t for t in tree.text if t] == ["a", "b", "x &", "y z", "tl", "u &am"]
    assert [t for t in parse("<script>a</b><p>c").text if t] == []
    assert parse("").text == [""] and parse("<").text[-1] == "<"


def test_tree_reader_takes_linear_time():
    import time
    for page in ("<div>" * 200_000, "<b>" * 200_000 + "</i>" * 100_000, "<a><div>" * 100_000, "<li><p>x" * 100_000, "<table><tr><td>" * 60_000):
        began = time.process_time()
        tree = parse(page)
        assert time.process_time() - began < 6
        assert tree.end[0] == len(tree.tag)
    kinds = parse("<div><a href=x><p>in</p></a> out</div><h1><b>x<h2>y</h2>")
    assert [(t, n) for t, n in zip(kinds.text, kinds.links) if t] == [("in", 2), ("out", 0), ("x", 0), ("y", 0)]


def test_hidden_elements_and_long_heads(spark):
    """Words come from whole pages, also behind a long script; hidden parts are told apart."""
    paragraphs = texts(23, 40)
    long_head = "<script>" + "x();" * 50_000 + "</script>"
    pages = [(k, f"<html><head>{long_head}</head><body><p>{p} number{k}</p></body></html>") for k, p in enumerate(paragraphs)]
    blocks, words = html_extract.sampled(spark.createDataFrame(pages, "page_id long, html string"), "html")
    assert len(blocks) == len(set(blocks)) >= 40 and "number3" in words
    assert html_extract.own_bits("div", "class=x hidden=") & html_extract.BIT_HIDDEN
    assert html_extract.own_bits("div", "style=color:red; display: none") & html_extract.BIT_HIDDEN
    assert not html_extract.own_bits("div", "class=hidden") & html_extract.BIT_HIDDEN


def test_html_extraction_on_other_layouts(spark):
    paragraphs = [p for p in texts(21, 60) if p.strip()]
    pages = [f"<body><nav><a href=x>m</a></nav><article><p>{p}</p><p>{q}</p></article></body>" for p, q in zip(paragraphs, paragraphs[1:])]
    words = sorted({w for p in paragraphs for w in p.split()})
    model = html_extract.train(paragraphs, words, layouts=250)
    hits = wants = takes = 0
    for tree in html_extract.training_trees(paragraphs, words, 60, seed=77):
        marks = html_extract.labels(tree)
        want = {k for k, t in enumerate(tree.tag) if t == "#text" and marks[k] == 1}
        got = set(html_extract.decode(tree, model.predict(html_extract.features([tree]))))
        hits, wants, takes = hits + len(want & got), wants + len(want), takes + len(got)
    assert hits / wants > 0.95 and hits / takes > 0.95
    df = spark.createDataFrame([(1, None, "old"), (2, "", None), (3, pages[0], "t")], "page_id long, html string, text string")
    rows = {r.page_id: r.text for r in html_extract.extract(df, model).collect()}
    assert rows[1] == rows[2] == "" and isinstance(rows[3], str)


def test_decoding_is_consistent():
    tree = parse("<div><p>a</p><p>b</p><p>c</p></div><div><p>d</p></div>")
    odds = np.zeros(len(tree.tag))
    for k, t in enumerate(tree.tag):
        if t == "#text":
            odds[k] = {"a": 2, "b": -0.5, "c": 2, "d": -3}[tree.text[k]]
    # a doubtful block goes with its container rather than against it
    assert [tree.text[k] for k in html_extract.decode(tree, odds)] == ["a", "b", "c"]


def test_warc_round_trip(spark, tmp_path):
    body = "<p>" + "x" * 200
    rows = [(5, "http://a/", body), (2, "http://b/\r\nX: y", body), (2, "http://b/2", body), (9, None, "short"), (10, "u", "short"),
            (11, "v", None), (None, "w", body), (12, "z", "é" * 50)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = str(tmp_path / "archive")
    warc.write_archive(df, path, "page_id", "html", "url")
    assert spark.read.parquet(path + "/payloads").count() == 4
    records = warc.read_records(spark, path).collect()
    assert len(records) == len(rows)
    kinds = {}
    for r in records:
        head, rest = bytes(r.record).split(b"\r\n\r\n", 1)
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert len(rest) == int(fields[b"Content-Length"]) + 4 and rest.endswith(b"\r\n\r\n")
        assert fields[b"WARC-Payload-Digest"] == b"sha256:" + hashlib.sha256(bytes(r.payload)).hexdigest().encode()
        kinds.setdefault(r.record_id, []).append(fields[b"WARC-Type"])
        if fields[b"WARC-Type"] == b"revisit":
            assert fields[b"WARC-Refers-To"] == b"<urn:record:2>"
    assert sorted(kinds["<urn:record:2>"]) == [b"response", b"revisit"] and kinds["<urn:record:5>"] == [b"revisit"]
    assert kinds["<urn:record:9>"] == kinds["<urn:record:10>"] == kinds["<urn:record:11>"] == kinds["<urn:record:12>"] == [b"response"]


def test_empty_tables(spark, empty, tmp_path):
    assert bpe.encode(empty, MULTI, public_tokenizers.PATTERN).count() == 0
    assert exact_dedup.exact_groups(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
    assert quality.judge(empty, public_tokenizers.path("piece_bpe_32k.model")).count() == 0
    assert pii.find(empty).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(empty, toxicity.fit(empty, labels)).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_extract.extract(pages, html_extract.fit(pages, sample=5)).count() == 0
    warc.write_archive(pages, str(tmp_path / "none"), "page_id", "html", "url")
    assert warc.read_records(spark, str(tmp_path / "none")).count() == 0


# ---- queries and pipeline -------------------------------------------------

def test_queries_with_sql_match(spark, sf_small):
    import duckdb

    from trajex.llm.queries import QUERIES, SQL
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.sql(f"create view {t} as from '{sf_small}/{t}.parquet'")
    for name, sql in SQL.items():
        found, want = QUERIES[name](spark, sf_small), con.sql(sql)
        columns = sorted(found.columns)
        assert columns == sorted(want.columns)
        rows = lambda xs: sorted(map(str, xs))
        assert rows(tuple(r) for r in found.select(*columns).collect()) == rows(want.select(*columns).fetchall())


def test_pipeline_stages_follow_their_operators(spark, sf_small):
    import corpus_pipeline as C
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns, seen = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    kept = C.quality_rules(spark, docs, sf_small)
    assert kept.columns == columns
    judged = {r.doc_id for r in quality.judge(docs, public_tokenizers.path("piece_bpe_32k.model")).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == judged
    unique = C.exact_duplicates(spark, kept, sf_small)
    best = {}
    for i in judged:
        key = seen[i].encode().lower()
        best[key] = max(best.get(key, i), i)
    assert {r.doc_id for r in unique.collect()} == set(best.values())
    apart = C.near_duplicates(spark, unique, sf_small)
    want = {r.component_id for r in simhash.near_duplicates(unique).collect()}
    assert {r.doc_id for r in apart.collect()} == want
    mixed = C.source_mix(spark, apart, sf_small)
    taken = {r.doc_id: r.taken for r in mixing.mix(apart).collect()}
    words = {}
    for r in mixed.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(re.findall(mixing.WORD, r.text))
    assert words == {i: n for i, n in taken.items() if n}
    coded = C.byte_bpe(spark, mixed, sf_small)
    assert coded.count() == mixed.count()
