"""Spans that weak supervision adds, against planted ones."""

import random
from collections import Counter

import pyarrow.parquet as pq

from trajex.llm import pii


def planted(rng, docs):
    """Puts right and wrong spans of the wider formats into half of the texts;
    returns (document, kind, begin, end, right)."""
    def name():
        return "".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 8)))

    def number(prefix, n, valid=True):
        d = prefix + "".join(str(rng.randint(0, 9)) for _ in range(n - len(prefix) - 1))
        return next(d + str(k) for k in range(10) if pii.luhn(d + str(k)) == valid)

    def split(d, sign, sizes):
        parts, at = [], 0
        for n in sizes:
            parts.append(d[at:at + n])
            at += n
        return sign.join(parts)
    fours, amex, r = (4, 4, 4, 4), (4, 6, 5), rng.randint
    good = {"email": [lambda: f"{name()} at {name()} dot com", lambda: f"{name()}[at]{name()}.org", lambda: f"{name()} (at) {name()} (dot) de"],
            "ip": [lambda: ":".join(f"{r(0, 65535):x}" for _ in range(8))],
            "card": [lambda: split(number("4", 16), ".", fours), lambda: split(number("37", 15), rng.choice("- "), amex), lambda: number("34", 15)],
            "phone": [lambda: f"({r(200, 989)}) 555-{r(1000, 9999)}", lambda: f"{r(200, 989)}-555-{r(1000, 9999)}", lambda: f"1 {r(200, 989)} 555 {r(1000, 9999)}"]}
    bad = {"email": [lambda: f"look at {name()}.{name()} now", lambda: f"meet me at {name()} dot"],
           "ip": [lambda: f"{r(300, 900)}.{r(1, 9)}.{r(1, 9)}.{r(300, 999)}"],
           "card": [lambda: split(number("9", 16, False), ".", fours)], "phone": [lambda: f"{r(100, 199)}-{r(100, 999)}-{r(1000, 9999)}"]}
    truth = []
    for d, text in enumerate(docs):
        if rng.random() < 0.5:
            kind, right = rng.choice(pii.KINDS), rng.random() < 0.6
            span = rng.choice((good if right else bad)[kind])()
            words = sorted(pii.FOR[kind]) if right and rng.random() < 0.6 else sorted(pii.AGAINST[kind]) if not right and rng.random() < 0.4 else ["and"]
            word, at = rng.choice(words), text.find(" ", rng.randint(0, max(0, len(text) - 1)))
            at = len(text) if at < 0 else at
            docs[d] = f"{text[:at]} {word} {span} {text[at:]}"
            begin = at + len(word) + 2
            truth.append((d, kind, begin, begin + len(span), right))
    return truth


def test_added_spans_find_planted_ones():
    rng = random.Random(3)
    docs = [t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()]
    truth = planted(rng, docs)
    found = [list(pii.candidates(t)) for t in docs]
    counted = {}
    for (kind, votes, features), n in Counter((c[0], c[4], c[5]) for cs in found for c in cs).items():
        counted.setdefault(kind, []).append((votes, features, n))
    yes = pii.verdicts(counted)
    for kind in pii.KINDS:
        right = {(d, b, e) for d, k, b, e, ok in truth if k == kind and ok}
        added = {(d, c[1], c[2]) for d, cs in enumerate(found) for c in cs if c[0] == kind and not c[3] and yes[c[0], c[4], c[5]]}
        hits = lambda a, b: a[0] == b[0] and a[1] <= b[1] + 1 and a[2] >= b[2] - 1
        recall = sum(any(hits(a, p) for a in added) for p in right) / len(right)
        precision = sum(any(hits(a, p) for p in right) for a in added) / len(added)
        assert len(right) > 50 and recall > 0.95 and precision > 0.9, (kind, recall, precision)


def test_long_runs_take_linear_time():
    import time
    for text in ("look at " + "A" * 1_000_000, "A" * 1_000_000 + "@", "x at " + "a-" * 400_000, "@" * 300_000, "a dot b at " * 90_000):
        began = time.process_time()
        list(pii.candidates(text))
        assert time.process_time() - began < 5
