"""Token counts by a linear longest-match automaton.

The vocabulary's trie gets failure links: where a word leaves the trie, the
link says in which state the remaining bytes go on, and a precomputed number
says how many greedy word pieces were finished on the way.  Counting needs no
pieces and looks at each byte a constant number of times.

Words that cannot be split count as one unknown piece.  Null texts count as
empty: no words, no tokens.
"""

from __future__ import annotations

import base64
import json
from collections import deque
from collections.abc import Iterable

import regex
from pyspark.sql import DataFrame

from trajex.llm.common import WordCache, append_columns, long, worker_tool

START, NONE = 0, -1


class LongestMatch:
    """Automaton over a vocabulary of byte strings.  With ``continuation``
    (such as ``b"##"``) tokens with that prefix match inside words only and
    others at the start of words only; without, all tokens match everywhere."""

    def __init__(self, vocabulary: Iterable[bytes], continuation: bytes = b""):
        self.step: dict[int, int] = {}
        self.fail, self.popped, token = [NONE], [0], [False]
        children: list[list[tuple[int, int]]] = [[]]

        def walk(node: int, path: bytes) -> int:
            for byte in path:
                after = self.step.get(node << 8 | byte)
                if after is None:
                    after = self.step[node << 8 | byte] = len(self.fail)
                    self.fail.append(NONE)
                    self.popped.append(0)
                    token.append(False)
                    children.append([])
                    children[node].append((byte, after))
                node = after
            return node

        # the root of continuing pieces hangs below no byte of its own
        self.inside = START
        if continuation:
            self.inside = len(self.fail)
            self.fail.append(NONE)
            self.popped.append(0)
            token.append(False)
            children.append([])
        for piece in vocabulary:
            inner = continuation and piece.startswith(continuation)
            path = piece[len(continuation):] if inner else piece
            if path:
                token[walk(self.inside if inner else START, path)] = True
        queue = deque(dict.fromkeys((START, self.inside)))
        while queue:
            node = queue.popleft()
            for byte, child in children[node]:
                if token[child]:
                    self.fail[child], self.popped[child] = self.inside, 1
                else:
                    to, pops = self.fail[node], self.popped[node]
                    while to != NONE and to << 8 | byte not in self.step:
                        pops += self.popped[to]
                        to = self.fail[to]
                    if to != NONE:
                        self.fail[child], self.popped[child] = self.step[to << 8 | byte], pops
                queue.append(child)

    def count(self, word: bytes) -> int:
        """Number of greedy longest-match pieces; 1 for a word without any."""
        if not word:
            return 0
        step, fail, popped, node, pieces = self.step, self.fail, self.popped, START, 0
        for byte in word:
            after = step.get(node << 8 | byte)
            while after is None:
                if fail[node] == NONE:
                    return 1
                pieces += popped[node]
                node = fail[node]
                after = step.get(node << 8 | byte)
            node = after
        while node != self.inside:
            if fail[node] == NONE:
                return 1
            pieces += popped[node]
            node = fail[node]
        return pieces


def read_vocabulary(path: str) -> list[bytes]:
    """Tokens of a rank file (base64 per line) or of a JSON file that maps
    tokens to ids."""
    with open(path, "rb") as file:
        if path.endswith(".json"):
            return [token.encode() for token in json.load(file)]
        return [base64.b64decode(line.split()[0]) for line in file if line.strip()]


def token_counts(df: DataFrame, path: str, pattern: str, continuation: bytes = b"", column: str = "text") -> DataFrame:
    """Adds n_words (matches of ``pattern``) and n_tokens (longest-match pieces
    of all words).  Null and empty texts give zeros; input columns of these
    names give way; rows map one to one."""
    def make():
        def tool():
            count = LongestMatch(read_vocabulary(path), continuation).count
            return regex.compile(pattern).findall, WordCache(lambda word: count(word.encode()))

        split, pieces = worker_tool(("token counts", path, pattern, continuation), tool)

        def run(texts):
            words, tokens = [], []
            for value in texts:
                found = split(value or "")
                words.append(len(found))
                tokens.append(sum(map(pieces.__getitem__, found)))
            return words, tokens
        return run

    return append_columns(df, [column], make, [long("n_words"), long("n_tokens")])


def op1(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    counted = token_counts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return counted.select("doc_id", "n_words", "n_tokens")
