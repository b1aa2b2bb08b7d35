"""Token counts by a linear longest-match automaton: no piece is ever built, only counted."""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import clear_batches, table, texts


def byte_alphabet() -> dict[str, int]:
    """Character that stands for each byte in byte-level vocabularies: printable Latin-1 as itself, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def vocabulary(path: str) -> list[bytes]:
    """Pieces of a byte-level tokenizer file, as bytes; every single byte is one of them."""
    back = byte_alphabet()
    with open(path) as f:
        model = json.load(f)["model"]
    return [bytes(back[c] for c in piece) for piece in model["vocab"] if all(c in back for c in piece)]


class Automaton:
    """Vocabulary trie with failure links and, for each node, how many pieces following its link pops.

    A piece's own node links to the root and pops one piece; any other node links to where the greedy matching of
    its string ends up, having popped the pieces before that. Each byte of a word is read once.
    """

    def __init__(self, pieces: list[bytes]):
        self.next: list[dict[int, int]] = [{}]
        final = [False]
        for p in pieces:
            u = 0
            for c in p:
                if c not in self.next[u]:
                    self.next[u][c] = len(self.next)
                    self.next.append({})
                    final.append(False)
                u = self.next[u][c]
            final[u] = u != 0
        self.link, self.pops = [-1] * len(final), [0] * len(final)
        queue = deque([0])
        while queue:
            u = queue.popleft()
            for c, v in self.next[u].items():
                queue.append(v)
                if final[v]:
                    self.link[v], self.pops[v] = 0, 1
                    continue
                z, n = self.link[u], self.pops[u]
                while z >= 0 and c not in self.next[z]:
                    n += self.pops[z]
                    z = self.link[z]
                if z >= 0:
                    self.link[v], self.pops[v] = self.next[z][c], n

    def count(self, word: bytes) -> int:
        """Pieces of the greedy longest-match segmentation, or 1 (the unknown piece) when there is none."""
        step, link, pops = self.next, self.link, self.pops
        u = n = 0
        for c in word:
            while c not in step[u]:
                n += pops[u]
                u = link[u]
                if u < 0:
                    return 1
            u = step[u][c]
        while u > 0:
            n += pops[u]
            u = link[u]
        return n if u == 0 else 1


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    return Automaton(vocabulary(path))


class _Counts(dict):
    def __init__(self, path: str, limit: int = 300_000):
        super().__init__()
        self.machine, self.limit = automaton(path), limit

    def __missing__(self, word: bytes) -> int:
        n = self.machine.count(b" " + word)
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[word] = n
        return n


def token_counts(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, n_words, n_tokens, max_word_tokens for each row of docs (doc_id, text).

    Words are runs of characters other than ASCII white space, each read after a space, in greedy longest pieces of
    a byte-level vocabulary. Null and empty texts count 0. Repeated rows and null ids are kept; an empty table gives
    no row; other columns are dropped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(vocabulary_path)
        for batch in batches:
            rows = []
            for t in texts(batch.column("text")):
                words = t.split()
                c = np.fromiter(map(counts.__getitem__, words), np.int64, len(words))
                rows.append((len(words), int(c.sum()), int(c.max(initial=0))))
            yield pa.record_batch([batch.column("doc_id"), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3))], ["doc_id", "n_words", "n_tokens", "max_word_tokens"])

    return clear_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))).mapInArrow(run, "doc_id long, n_words long, n_tokens long, max_word_tokens long")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
