"""Personal data by weak supervision.

Base spans are what fixed patterns and checks say; they always stay.  Around
them the method looks at wider candidates (numbers without a plus sign, cards
in other groupings, addresses written out in words, ...).  Labelers vote on
each candidate: patterns, checks, gazetteers and the words around it; a labeler
may abstain.  Expectation-maximisation over the vote patterns of all documents
estimates the labelers' reliabilities without any truth, and the resulting
probabilities train a final span classifier on the candidates' features.  Every
candidate it accepts that overlaps no base span of its kind is added.

What leaves the tasks for the driver is counts of vote and feature patterns:
at most 3 ** labelers * 2 ** features per kind, whatever the input.

Null texts count as empty: no spans, the digest of no bytes.  Offsets are code
points, ends exclusive.  Documents map one to one to result rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajex.llm.common import append_columns, long, stage, text

KINDS = ("email", "ip", "card", "phone")

# ---- base spans -----------------------------------------------------------

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")


def emails(value: str):
    """An address begins where the run of local characters before an @ begins,
    or where the last address ended; each @ is looked at once."""
    done, at = 0, value.find("@")
    while at >= 0:
        domain = DOMAIN.match(value, at + 1)
        begin = at
        if domain:
            while begin > done and value[begin - 1] in LOCAL:
                begin -= 1
        if begin < at:
            done = domain.end()
            yield begin, done
        at = value.find("@", max(at + 1, done))


def addresses(value: str):
    """Four numbers joined by points.  In a longer run of numbers each four in
    turn are a match, whether they pass the check or not."""
    for run in DOTTED.finditer(value):
        parts, at = run[0].split("."), run.start()
        for k in range(0, len(parts) - 3, 4):
            group = parts[k:k + 4]
            size = sum(map(len, group)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in group):
                yield at, at + size
            at += size + 1


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if k % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def cards(value: str):
    for m in DIGITS.finditer(value):
        if m.end() - m.start() <= 40:
            digits = NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(value: str):
    for m in PHONE.finditer(value):
        if 8 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
            yield m.span()


BASE = {"email": emails, "ip": addresses, "card": cards, "phone": phones}

# ---- candidates, votes and features ---------------------------------------

#: Signs between the parts of an address that may be written out in words.
AT = re.compile(r" ?\[at\] ?| ?\(at\) ?| at |@")
WIDE_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:(?: ?\[dot\] ?| ?\(dot\) ?| dot |\.)[A-Za-z0-9-]+)+")


def wider_emails(value: str):
    """Addresses around each sign for "at": the domain that follows it, and the
    run of local characters before it from a letter or digit on.  No character
    is looked at twice from the same side, however long a run without a sign."""
    done = 0
    for sign in AT.finditer(value):
        if sign.start() < done:
            continue
        domain = WIDE_DOMAIN.match(value, sign.end())
        if domain:
            begin = sign.start()
            while begin > done and value[begin - 1] in LOCAL:
                begin -= 1
            while begin < sign.start() and not value[begin].isalnum():
                begin += 1
            if begin < sign.start():
                done = domain.end()
                yield begin, done


#: Wider patterns of the other kinds.  All are bounded in length.
WIDER = {
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])|(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[ .-]?[0-9]{4}){2}[ .-]?[0-9]{1,7}(?![0-9])|(?<![0-9])3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+.-])(?:\+?[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)|[0-9]{3})[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"),
}
#: What a text must hold for the wider pattern to be worth a look.
HINT = {"email": re.compile(r"@| at |[\[(]at[\])]"), "ip": re.compile(r"[0-9]\.[0-9]|:[0-9A-Fa-f]+:"),
        "card": re.compile(r"[0-9]{4}"), "phone": re.compile(r"[0-9]{4}")}
#: Gazetteers: name endings of addresses, first numbers of private or local
#: networks and of card makers, telephone area code rules.
TOP_LEVEL = frozenset("com org net edu gov io info biz de fr es uk us eu it nl ch at be pt br mx ca au jp cn ru in".split())
CARD_MAKER = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6(?:011|5)")
#: Words before a span that speak for its kind, and words that speak against,
#: in English, German, French and Spanish.
FOR = {"email": "mail email e-mail contact write reach courriel correo kontakt kontakta adresse schreiben ecrire escribe address",
       "ip": "ip ipv address server host from adresse direccion serveur servidor client gateway login",
       "card": "card visa mastercard amex credit debit pay payment carte karte kreditkarte tarjeta bancaire zahlung pago",
       "phone": "phone tel call telephone mobile cell fax appel appelez telefon telefono handy anrufen rufnummer llamar movil portable"}
AGAINST = {"email": "example sample beispiel exemple ejemplo", "ip": "version release v section chapter kapitel chapitre seccion abschnitt build",
           "card": "isbn order invoice id serial account part bestellung rechnung commande facture pedido factura nummer",
           "phone": "isbn order invoice id serial version bestellung rechnung commande facture pedido factura"}
FOR, AGAINST = ({k: frozenset(v.split()) for k, v in d.items()} for d in (FOR, AGAINST))
WORD = re.compile(r"[A-Za-z-]+")
#: Code points before a span that the context labelers read.
NEAR = 48
VOTES, FEATURES = 4, 5


def votes_and_features(kind: str, value: str, begin: int, end: int, base: bool) -> tuple[str, str]:
    """Votes of the labelers (pattern, check, gazetteer, context) as + for yes,
    - for no, 0 for no vote; features as 0 and 1."""
    span = value[begin:end]
    digits = NOT_DIGIT.sub("", span)
    around = [w.lower() for w in WORD.findall(value, max(0, begin - NEAR), begin)][-4:]
    pattern = "+" if base else "0"
    if kind == "email":
        ending = re.split(r"[^A-Za-z0-9-]+", span)[-1].lower()
        check = "+" if "@" in span else "-" if " at " in span and " dot " not in span else "0"
        known = "+" if ending in TOP_LEVEL else "-"
    elif kind == "ip":
        parts = span.split(".") if "." in span else []
        check = "+" if not parts or all(int(p) <= 255 for p in parts) else "-"
        known = "-" if parts and int(parts[0]) in (0, 1, 2, 3) and max(map(int, parts)) < 30 else "0"
    elif kind == "card":
        check = "+" if luhn(digits) and 13 <= len(digits) <= 19 else "-"
        known = "+" if CARD_MAKER.match(digits) else "-"
    else:
        check = "+" if 10 <= len(digits) <= 15 else "-"
        area = digits[-10:-7]
        known = "-" if len(area) == 3 and area[0] in "01" else "+" if "(" in span or "+" in span else "0"
    speaks = bool(FOR[kind] & set(around)) - bool(AGAINST[kind] & set(around))
    context = "0+-"[speaks]
    left, right = value[begin - 1:begin], value[end:end + 1]
    features = (base, any(c in span for c in " ()[]"), left == "" or left.isspace(), right == "" or not right.isalnum(), speaks > 0)
    return pattern + check + known + context, "".join("01"[bool(f)] for f in features)


def candidates(value: str):
    """All base spans and the wider candidates that overlap none of their
    kind: (kind, begin, end, base, votes, features), by kind and begin."""
    for kind in KINDS:
        base = list(BASE[kind](value))
        found = [(b, e, True) for b, e in base]
        if HINT[kind].search(value):
            k = 0
            for begin, end in wider_emails(value) if kind == "email" else (m.span() for m in WIDER[kind].finditer(value)):
                while k < len(base) and base[k][1] <= begin:
                    k += 1
                if k == len(base) or base[k][0] >= end:
                    found.append((begin, end, False))
        for begin, end, is_base in sorted(found):
            yield (kind, begin, end, is_base, *votes_and_features(kind, value, begin, end, is_base))


# ---- reliabilities and classifier -----------------------------------------

def estimate(patterns: dict[str, int], rounds: int = 50) -> dict[str, float]:
    """Probability that a candidate is true by its vote pattern.  Two-class
    expectation-maximisation; each labeler has for either class a rate of yes,
    no and no vote.  Starts from the majority of the votes; Laplace counts keep
    rates off 0 and 1."""
    keys = sorted(patterns)
    n = np.array([patterns[k] for k in keys], float)
    votes = np.array([["+-0".index(c) for c in k] for k in keys])
    lean = (votes == 0).sum(1) - (votes == 1).sum(1)
    p = 1 / (1 + np.exp(-1.5 * lean))
    for _ in range(rounds):
        log = np.zeros((2, len(keys)))
        for c, q in enumerate((1 - p, p)):
            log[c] = np.log((n * q).sum() + 1) - np.log(n.sum() + 2)
            for j in range(votes.shape[1]):
                rate = np.bincount(votes[:, j], n * q, minlength=3) + 1
                log[c] += np.log(rate / rate.sum())[votes[:, j]]
        p = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
    # the two classes are named by the votes, not by their order
    if (n * p * lean).sum() / max((n * p).sum(), 1e-9) < (n * (1 - p) * lean).sum() / max((n * (1 - p)).sum(), 1e-9):
        p = 1 - p
    return dict(zip(keys, p.tolist(), strict=True))


def inputs(votes: str, features: str) -> list[float]:
    return [1.0, *(float(c == "+") for c in votes), *(float(c == "-") for c in votes), *(float(c) for c in features)]


def classify(counted: list[tuple[str, str, int]], truth: dict[str, float], rounds: int = 300) -> dict[tuple[str, str], float]:
    """Logistic regression on votes and features, trained on the estimated
    probabilities; returns its probability for each pattern seen."""
    x = np.array([inputs(v, f) for v, f, _ in counted])
    y = np.array([truth[v] for v, _, _ in counted])
    n = np.array([c for _, _, c in counted], float)
    n /= n.sum()
    w = np.zeros(x.shape[1])
    for _ in range(rounds):  # Newton steps with a ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (p - y)) + 1e-3 * w
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return {(v, f): float(q) for (v, f, _), q in zip(counted, p, strict=True)}


CANDIDATE = T.StructType([T.StructField("kind", T.StringType()), T.StructField("begin", T.IntegerType()),
                          T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType()),
                          T.StructField("votes", T.StringType()), T.StructField("features", T.StringType())])


def with_candidates(df: DataFrame, column: str = "text", to: str = "candidates") -> DataFrame:
    def make():
        names = CANDIDATE.fieldNames()
        return lambda texts: [[[dict(zip(names, c, strict=True)) for c in candidates(x or "")] for x in texts]]
    return append_columns(df, [column], make, [T.StructField(to, T.ArrayType(CANDIDATE))])


def verdicts(counted: dict[str, list[tuple[str, str, int]]], threshold: float = 0.5) -> dict[tuple[str, str, str], bool]:
    """The classifier's verdict on each (kind, votes, features), from the counts
    of (votes, features) of each kind's candidates."""
    found = {}
    for kind, rows in counted.items():
        totals: dict[str, int] = {}
        for votes, _, n in rows:
            totals[votes] = totals.get(votes, 0) + n
        for (votes, features), p in classify(sorted(rows), estimate(totals)).items():
            found[kind, votes, features] = p >= threshold
    return found


def accepted(df: DataFrame, column: str = "candidates", threshold: float = 0.5) -> dict[tuple[str, str, str], bool]:
    """``verdicts`` from counts over all candidates of ``df``."""
    one = df.select(F.explode(column).alias("c")).groupBy("c.kind", "c.votes", "c.features").agg(F.count("*").alias("n"))
    counted: dict[str, list] = {}
    for r in one.collect():  # at most 4 * 3 ** VOTES * 2 ** FEATURES rows
        counted.setdefault(r["kind"], []).append((r["votes"], r["features"], r["n"]))
    return verdicts(counted, threshold)


def find(df: DataFrame, column: str = "text", keep_text: bool = True) -> DataFrame:
    """Adds ``found``: array of (kind, begin, end, base), by kind as listed,
    then begin.  Candidates are extracted once and written (without the text
    unless ``keep_text``); the verdicts come from their counts over all
    documents."""
    marked = with_candidates(df, column, "__candidates")
    rows = stage(marked if keep_text else marked.drop(column), "pii")
    yes = [f"{k}:{v}:{f}" for (k, v, f), good in sorted(accepted(rows, "__candidates").items()) if good]
    keys = F.array(*map(F.lit, yes)).cast("array<string>")
    chosen = F.filter("__candidates", lambda c: c["base"] | F.array_contains(keys, F.concat_ws(":", c["kind"], c["votes"], c["features"])))
    slim = F.transform(chosen, lambda c: F.struct(c["kind"], c["begin"], c["end"], c["base"]))
    return rows.withColumn("found", slim).drop("__candidates")


def op3(spark, sf_dir: str) -> DataFrame:
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), keep_text=False)

    def joined(spans):
        return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", c["kind"], c["begin"], c["end"])), ",")

    def number(kind: str):
        return F.size(F.filter(base, lambda c: c["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda c: c["base"])
    counts = [number(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined("found").alias("spans"))
