"""Byte-level BPE by prefix dynamic programming.

For each byte prefix of a piece there is exactly one token that can be the last
token of the prefix's encoding.  ``PrefixTable`` finds it from the earlier
prefixes: among the tokens that end at this byte, the one whose pair with the
last token of the rest stays apart under the merges.  The stored prefixes make
appending exact (only new bytes are worked on) and let an edit re-encode only
the bytes around it.

Nulls count as empty texts: no tokens, the digests of no bytes.  Texts of any
length are encoded whole; the work is linear in the length of a piece.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajex.llm.common import WordCache, append_columns, long, text, worker_tool

NO_LIMIT = 1 << 40
#: Bytes of a piece whose table is kept for other pieces, and bytes of a half of
#: the caches of pieces and of such tables; pairs of tokens that are known apart.
HEAD, PIECES, HEADS, PAIRS = 6, 32 << 20, 6 << 20, 250_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Merges:
    """What the ranks say about pairs of tokens, and the automaton that tells
    which tokens end at a byte."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks), default=0)
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        #: The two tokens that a token's last merge joined; itself if none.
        self.left, self.right = list(range(len(self.tokens))), list(range(len(self.tokens)))
        self.known: dict[int, bool] = {}
        made = bytearray(len(self.tokens))  # tokens that merging their own bytes gives
        for rank, token in enumerate(self.tokens):
            made[rank] = len(token) == 1
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut], NO_LIMIT), ranks.get(token[cut:], NO_LIMIT)
                if a < rank and b < rank and made[a] and made[b] and self._apart(a, b, rank):
                    self.left[rank], self.right[rank], made[rank] = a, b, 1
                    break
        self._automaton(made)

    def _automaton(self, made: bytearray) -> None:
        """States are the prefixes of tokens; ``ends`` has for each state the
        tokens that are its suffixes, longest first, as (length, token)."""
        self.step, self.back, own, parents = {}, [0], [None], []
        for rank, token in enumerate(self.tokens):
            state = 0
            for byte in token if made[rank] else b"":
                after = self.step.get(state << 8 | byte)
                if after is None:
                    after = self.step[state << 8 | byte] = len(own)
                    own.append(None)
                    self.back.append(0)
                    parents.append((state, byte))
                state = after
            if state:
                own[state] = (len(token), rank)
        depth = [0] * len(own)
        for state, (parent, _) in enumerate(parents, 1):
            depth[state] = depth[parent] + 1
        self.ends: list[tuple] = [()] * len(own)
        for state in sorted(range(1, len(own)), key=depth.__getitem__):
            parent, byte = parents[state - 1]
            self.back[state] = self.next(self.back[parent], byte) if parent else 0
            self.ends[state] = ((own[state],) if own[state] else ()) + self.ends[self.back[state]]

    def next(self, state: int, byte: int) -> int:
        get, after = self.step.get, self.step.get(state << 8 | byte)
        while after is None:
            if not state:
                return 0
            state = self.back[state]
            after = get(state << 8 | byte)
        return after

    def _apart(self, a: int, b: int, limit: int = NO_LIMIT) -> bool:
        """Whether no merge of a rank below ``limit`` crosses the border of a
        and b: undoes their last merges, youngest first, and looks each time
        whether the two tokens at the border would have merged before."""
        tokens, ranks, left, right = self.tokens, self.ranks, self.left, self.right
        while True:
            joined = ranks.get(tokens[a] + tokens[b])
            if joined is not None and joined < limit:
                return False
            whole_a, whole_b = right[a] == a, left[b] == b
            if whole_a and whole_b:
                return True
            if whole_b or (a > b and not whole_a):
                limit, a = a, right[a]
            else:
                limit, b = b + 1, left[b]

    def apart(self, a: int, b: int) -> bool:
        if len(self.known) >= PAIRS:
            self.known.clear()
        found = self.known[a << 32 | b] = self._apart(a, b)
        return found


    def extend(self, more: bytes, last: list[int], state: int, states: list[int] | None = None) -> int:
        """Appends the last tokens of the prefixes that ``more`` adds; ``state``
        is the automaton's after the bytes so far.  Returns the new state and
        appends each one to ``states`` if given."""
        known, apart, ends, back, get = self.known.get, self.apart, self.ends, self.back, self.step.get
        at = len(last)
        for byte in more:
            at += 1
            after = get(state << 8 | byte)
            while after is None:
                if not state:
                    raise ValueError("a byte has no token")
                state = back[state]
                after = get(state << 8 | byte)
            state = after
            if states is not None:
                states.append(state)
            for length, token in ends[state]:
                if length == at:
                    last.append(token)
                    break
                before = last[at - length - 1]
                fits = known(before << 32 | token)
                if fits or (fits is None and apart(before, token)):
                    last.append(token)
                    break
            else:
                raise ValueError("a byte has no token")
        return state

    def split(self, last: list[int]) -> list[int]:
        """The encoding that a table of last tokens stands for."""
        found, tokens, at = [], self.tokens, len(last)
        while at:
            token = last[at - 1]
            found.append(token)
            at -= len(tokens[token])
        found.reverse()
        return found


class PrefixTable:
    """Last token of each prefix of one piece of bytes."""

    def __init__(self, merges: Merges, piece: bytes = b""):
        self.merges, self.piece, self.last, self.states = merges, b"", [], []
        self.append(piece)

    def append(self, more: bytes) -> None:
        self.piece += more
        self._extend(len(self.piece))

    def _extend(self, upto: int) -> None:
        state = self.states[-1] if self.states else 0
        self.merges.extend(self.piece[len(self.last):upto], self.last, state, self.states)

    def edit(self, begin: int, end: int, new: bytes) -> int:
        """Puts ``new`` in place of bytes begin to end; returns how many
        prefixes were worked out anew.  Prefixes before the edit stay.  After
        it, once as many last tokens and states as the longest token has bytes
        agree with the old ones, the rest of the old ones hold too."""
        old, states, rest = self.last, self.states, len(self.piece) - end
        self.piece = self.piece[:begin] + new + self.piece[end:]
        self.last, self.states, same, upto = old[:begin], states[:begin], 0, begin
        while upto < len(self.piece):
            upto += 1
            self._extend(upto)
            was = len(old) - (len(self.piece) - upto) - 1
            agrees = upto > len(self.piece) - rest and old[was] == self.last[-1] and states[was] == self.states[-1]
            same = same + 1 if agrees else 0
            if same >= self.merges.longest:
                self.last += old[was + 1:]
                self.states += states[was + 1:]
                break
        return upto - begin

    def tokens(self) -> list[int]:
        return self.merges.split(self.last)


class Encoder:
    """Splits texts by a pattern and encodes each match separately.  A match
    that is a token as a whole is that token."""

    def __init__(self, merges: Merges, pattern: str):
        self.merges, self.split = merges, regex.compile(pattern).findall
        self.pieces = WordCache(self._piece, PIECES)
        self.heads = WordCache(self._head, HEADS, size=lambda table: 200 + 8 * len(table[0]))

    def _head(self, head: bytes) -> tuple[list[int], int]:
        last: list[int] = []
        return last, self.merges.extend(head, last, 0)

    def _piece(self, word: str) -> bytes:
        piece = word.encode()
        token = self.merges.ranks.get(piece)
        if token is not None:
            return struct.pack("<I", token)
        # words with the same beginning share its table and append to it
        last, state = self.heads[piece[:HEAD]]
        last = last.copy()
        self.merges.extend(piece[HEAD:], last, state)
        ids = self.merges.split(last)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, value: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.pieces.__getitem__, self.split(value)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.merges.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encoder(path: str, pattern: str) -> Encoder:
    """One encoder per Python worker, kept across its tasks."""
    return worker_tool(("bpe", path, pattern), lambda: Encoder(Merges(read_ranks(path)), pattern))


def encode(df: DataFrame, path: str, pattern: str, column: str = "text", ids: bool = True) -> DataFrame:
    """Adds n_tokens, ids_sha256, decoded_sha256 and, with ``ids``, token_ids
    (array of int).  Decoding runs on the encoded ids.  Null texts count as
    empty; input columns of these names give way; rows map one to one, so
    repeated rows and empty tables need nothing special."""
    def make():
        coder = encoder(path, pattern)

        def run(texts):
            out = ([], [], [], [])
            for value in texts:
                coded = coder.encode(value or "")
                out[0].append(len(coded) // 4)
                out[1].append(hashlib.sha256(coded).hexdigest())
                out[2].append(hashlib.sha256(coder.decode(coded)).hexdigest())
                if ids:
                    out[3].append(np.frombuffer(coded, "<i4"))
            return out[:3 + ids]
        return run

    fields = [long("n_tokens"), text("ids_sha256"), text("decoded_sha256")]
    if ids:
        fields.append(T.StructField("token_ids", T.ArrayType(T.IntegerType())))
    return append_columns(df, [column], make, fields)


def decode(df: DataFrame, path: str, column: str = "token_ids", to: str = "text") -> DataFrame:
    """Texts of token id arrays; a null array gives a null text, bytes that are
    not UTF-8 (ids cut inside a character) give U+FFFD."""
    def make():
        tokens = encoder(path, ".").merges.tokens
        return lambda lists: [[None if x is None else b"".join(tokens[i] for i in x).decode("utf-8", "replace")
                               for x in lists]]
    return append_columns(df, [column], make, [text(to)])


def op5(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = encode(docs, path, public_tokenizers.PATTERN, ids=False)
    return coded.select(F.col("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")
