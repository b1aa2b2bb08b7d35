"""Benchmark decontamination by latent semantic retrieval.

Documents are read as overlapping passages. The terms are the words of the benchmark, hashed to a fixed number of
dimensions; their weights come from the document frequencies over all documents. A randomised decomposition of the
passages' weighted term matrix A, of which only A^T (A R) for a random R is summed over the cluster, gives the latent
space, one for the whole benchmark. Passages near a benchmark item by cosine are candidates; a candidate counts when the
longest common subsequence of words covers enough of the item and of its answer, the item's last words. So reworded
copies are found, and chance neighbours are not. The items are the query set: blocks of them meet all passages.

Runs of words that a document shares with an item are candidates too, whatever the cosine: four words, or the whole of a
shorter item. So an item that is there word for word is always found.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import clear_batches, table, texts

#: ASCII characters other than letters and digits separate words.
_SPACE = bytes(b if b >= 128 or chr(b).isalnum() else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    if not text.isascii():
        text = text.decode("utf-8", "replace").lower().encode()
    return text.lower().translate(_SPACE).split()


class _Terms(dict):
    def __missing__(self, word: bytes) -> int:
        return -1

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


@dataclass(frozen=True)
class Settings:
    """window and stride of passages, in words; rank of the latent space; least cosine of a candidate; least share of
    the item's words in common order, with and without the answer's; least share of the answer's words; share of the
    documents above which a word is no term, unless it is one of the `rarest` words of an item;
    items of fewer than least_words words have to be there word for word; dimensions that terms are hashed to; most items
    and characters of a block of the benchmark, on average."""

    window: int = 48
    stride: int = 24
    rank: int = 192
    extra: int = 16
    cosine: float = 0.35
    reworded: float = 0.6
    verbatim: float = 0.8
    answer: float = 0.5
    common: float = 0.01
    rarest: int = 6
    least_words: int = 8
    dimensions: int = 1 << 16
    block_items: int = 4000
    block_chars: int = 16 << 20


def lcs(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    place: dict[bytes, int] = {}
    for i, w in enumerate(a):
        place[w] = place.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for w in b:
        m = place.get(w, 0)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def passages(terms: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Places of known terms in a text's windows: (window number, place), from windows of `window` words each `stride`."""
    at = np.flatnonzero(terms >= 0)
    n_windows = 1 + max(0, -(-(len(terms) - s.window) // s.stride))
    last = np.minimum(at // s.stride, n_windows - 1)
    first = np.maximum(0, (at - s.window) // s.stride + 1)
    n = last - first + 1
    keep = n > 0
    at, first, n = at[keep], first[keep], n[keep]
    ends = np.cumsum(n)
    window = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(ends - n, n)
    return window, np.repeat(at, n)


def _matrix(lists: list[np.ndarray], weight: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weighted term matrix of the passages of some texts: row starts, terms and values; and (text, window) of the rows."""
    owner, wins, terms = [], [], []
    for i, t in enumerate(lists):
        w, at = passages(t, s)
        wins.append(w)
        terms.append(t[at])
        owner.append(np.full(len(w), i))
    if not wins:
        return np.empty(0, np.int64), np.empty(0, np.int32), np.empty((0, 2), np.int64)
    owner, wins, terms = np.concatenate(owner), np.concatenate(wins), np.concatenate(terms)
    keep = weight[terms] > 0
    owner, wins, terms = owner[keep], wins[keep], terms[keep]
    o = np.lexsort((wins, owner))
    owner, wins, terms = owner[o], wins[o], terms[o]
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (wins[1:] != wins[:-1])])) if len(wins) else np.empty(0, np.int64)
    return new, terms, np.stack([owner[new], wins[new]], axis=1)


#: Words of a shared run that makes a candidate, and an odd factor of its rolling hash.
RUN, _FACTOR = 4, np.uint64(0x9E3779B97F4A7C15)


def _runs(terms: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of runs of n known terms, and their hashes."""
    if len(terms) < n:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at = np.flatnonzero(np.logical_and.reduce([terms[k : len(terms) - n + 1 + k] >= 0 for k in range(n)]))
    h = np.zeros(len(at), np.uint64)
    for k in range(n):
        h = (h ^ terms[at + k].astype(np.uint64)) * _FACTOR
        h ^= h >> np.uint64(29)
    return at, h


class RunIndex:
    """Items by the hashes of their runs of words: of items that have to be there word for word the first run alone."""

    def __init__(self, lists: list[np.ndarray], s: Settings):
        found: dict[int, dict[int, set[int]]] = {}
        for i, x in enumerate(lists):
            n = min(RUN, len(x))
            _, h = _runs(x, n)
            for v in h[:1].tolist() if len(x) < s.least_words else h.tolist():
                found.setdefault(n, {}).setdefault(v, set()).add(i)
        self.items = found
        self.keys = {n: np.array(sorted(d), np.uint64) for n, d in found.items()}

    def candidates(self, terms: np.ndarray) -> dict[int, list[int]]:
        """Items that share a run with a text, and the places of the runs in it."""
        out: dict[int, list[int]] = {}
        for n, keys in self.keys.items():
            at, h = _runs(terms, n)
            hit = np.flatnonzero(keys[np.minimum(np.searchsorted(keys, h), len(keys) - 1)] == h)
            for p, v in zip(at[hit].tolist(), h[hit].tolist(), strict=True):
                for i in self.items[n][v]:
                    out.setdefault(i, []).append(p)
        return out


def _stretches(places: list[int], n: int) -> Iterator[tuple[int, int]]:
    """Stretches of a text around ascending places, as wide as check_pair() looks for an item of n words."""
    wide = max(n + 2, math.ceil(1.3 * n))
    start, end = places[0] - wide, places[0] + wide
    for p in places[1:]:
        if p - wide > end:
            yield max(0, start), end
            start = p - wide
        end = p + wide
    yield max(0, start), end


def _batches(bodies: list[bytes], limit: int = 2 << 20) -> Iterator[tuple[int, int]]:
    start, n = 0, 0
    for i, x in enumerate(bodies):
        if i > start and n + len(x) > limit:
            yield start, i
            start, n = i, 0
        n += len(x)
    if bodies:
        yield start, len(bodies)


def document_frequencies(spark: SparkSession, docs: DataFrame, vocabulary: dict[bytes, int], n_terms: int) -> np.ndarray:
    """Documents that hold each term; a row for each term reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, count = _Terms(vocabulary), np.zeros(n_terms, np.int64)
        for batch in batches:
            for t in texts(batch.column("text")):
                x = terms.of(words_of(t))
                count[np.unique(x[x >= 0])] += 1
        at = np.flatnonzero(count)
        yield pa.record_batch([pa.array(at), pa.array(count[at])], ["term", "n"])

    out = np.zeros(n_terms, np.int64)
    counted = clear_batches(docs.select("text")).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for r in counted.toLocalIterator():
        out[r["term"]] = r["n"]
    return out


def latent_space(spark: SparkSession, docs: DataFrame, vocabulary: dict[bytes, int], weight: np.ndarray, blocks: Iterator[list[np.ndarray]], s: Settings, seed: int = 5) -> np.ndarray:
    """Leading right singular vectors of the passages' matrix (terms by rank).

    With R random, Z = A^T A R is summed by pieces of terms; the decomposition of Z (R^T Z)^(-1/2) is that of A on
    the space that R spans. The items themselves are passages too.
    """
    width = min(s.rank + s.extra, len(weight))
    piece = 256

    def random() -> np.ndarray:
        return np.random.default_rng(seed).standard_normal((len(weight), width)).astype(np.float32)

    def add(z: np.ndarray, r: np.ndarray, lists: list[np.ndarray]) -> None:
        new, terms, _ = _matrix(lists, weight, s)
        if not len(new):
            return
        value = weight[terms]
        size = np.diff(np.append(new, len(terms)))
        row = np.repeat(np.arange(len(new)), size)
        norm = np.sqrt(np.add.reduceat(value**2, new))
        value = (value / norm[row]).astype(np.float32)
        for lo in range(0, len(new), 4096):  # some passages at a time, so that memory is bounded
            hi = min(len(new), lo + 4096)
            x = slice(new[lo], new[hi] if hi < len(new) else len(terms))
            y = np.add.reduceat(r[terms[x]] * value[x, None], new[lo:hi] - new[lo])
            o = np.argsort(terms[x], kind="stable")
            t = terms[x][o]
            at = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            z[t[at]] += np.add.reduceat(y[row[x][o] - lo] * value[x][o][:, None], at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, r, z = _Terms(vocabulary), random(), np.zeros((len(weight), width), np.float32)
        for batch in batches:
            bodies = texts(batch.column("text"))
            for i, j in _batches(bodies):
                add(z, r, [terms.of(words_of(b)) for b in bodies[i:j]])
        used = [k for k in range(0, len(z), piece) if z[k : k + piece].any()]
        yield pa.record_batch([pa.array(used, pa.int64()), pa.array([z[k : k + piece].tobytes() for k in used], pa.binary())], ["piece", "z"])

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        z = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in pdf["z"])
        return pd.DataFrame({"piece": [pdf["piece"].iloc[0]], "z": [z.astype(np.float32).tobytes()]})

    z = np.zeros((len(weight), width), np.float32)
    r = random()
    for items in blocks:
        add(z, r, items)
    parts = clear_batches(docs.select("text")).mapInArrow(run, "piece long, z binary")
    # Partial sums by task groups first, so that no reducer takes a piece from every task.
    parts = parts.withColumn("part", F.spark_partition_id() % 64)
    parts = parts.groupBy("piece", "part").applyInPandas(total, "piece long, z binary").groupBy("piece").applyInPandas(total, "piece long, z binary")
    for k, x in parts.toLocalIterator():
        z[k : k + piece] += np.frombuffer(x, np.float32).reshape(-1, width)
    c = (r.T @ z).astype(np.float64)
    e, q = np.linalg.eigh((c + c.T) / 2)
    good = e > e[-1] * 1e-6 if e[-1] > 0 else np.zeros(len(e), bool)
    if not good.any():
        return np.zeros((len(weight), 1), np.float32)
    u, _, _ = np.linalg.svd(z.astype(np.float64) @ (q[:, good] / np.sqrt(e[good])), full_matrices=False)
    return u[:, : s.rank].astype(np.float32)


def _vectors(new: np.ndarray, terms: np.ndarray, weight: np.ndarray, space: np.ndarray) -> np.ndarray:
    v = np.add.reduceat(space[terms] * weight[terms][:, None].astype(np.float32), new)
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(norm > 0, norm, 1)


def check_pair(item: list[bytes], body: list[bytes], s: Settings) -> float:
    """Share of the item's words found in order in some stretch of body; 0 when it or the answer's share is too low."""
    n = len(item)
    if n < s.least_words:  # too short to be told by a share of its words
        return float(any(body[i : i + n] == item for i in range(len(body) - n + 1)))
    span, best = max(n + 2, math.ceil(1.3 * n)), 0.0
    have, bound = Counter(body), 0
    for w, k in Counter(item).items():
        bound += min(k, have[w])
    if bound < s.reworded * n:  # no order of the words can reach it
        return 0.0
    step = max(1, n // 6)
    answer = item[-max(3, n // 5) :]
    for at in range(0, max(1, len(body) - span + step), step):
        part = body[at : at + span]
        share = lcs(item, part) / n
        if share > best and (share >= s.verbatim or (share >= s.reworded and lcs(answer, part) / len(answer) >= s.answer)):
            best = share
    return best


def find_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Each row of docs (doc_id, text) with leaked, items (ids of the benchmark items found, ascending) and best_share, and
    text_hash, the row's xxhash64 of text.

    Null and empty texts hold no item; items of no word, or null, are never found. Items that repeat are all
    reported. Repeated rows and null ids are kept; an empty table on either side gives rows without leaks, or none.
    Other columns are dropped. The benchmark is the query set: the driver and every task hold its distinct words, at most
    `dimensions` numbers for each of rank + extra vectors, and one block of items at a time (an item is never cut, so a
    block holds the longest one whole). How items fall into blocks changes no result.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    count, chars = items.agg(F.count(F.lit(1)), F.sum(F.length("text"))).first()
    n_blocks = max(1, -(-count // settings.block_items), -(-(chars or 0) // settings.block_chars))

    def blocks() -> Iterator[list[tuple[int, list[bytes]]]]:
        for k in range(n_blocks):
            rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == k).collect()
            worded = [(i, words_of(t)) for i, t in sorted((r[0], r[1].encode()) for r in rows)]
            yield [(i, w) for i, w in worded if w]

    n_docs, out = docs.count(), None
    model = _fit(spark, docs, blocks, n_docs, settings)
    for block in blocks():
        found = _search(spark, docs, block, model, settings)
        out = found if out is None else out.union(found)
    if n_blocks > 1:  # a row of a document for each block: put together by the row's content
        out = out.groupBy("doc_id", "row").agg(F.array_sort(F.flatten(F.collect_list("items"))).alias("items"), F.max("best_share").alias("best_share"), (F.count(F.lit(1)) / n_blocks).cast("int").alias("_n"))
        out = out.withColumn("_n", F.explode(F.array_repeat(F.lit(0), F.col("_n")))).drop("_n")
        out = out.withColumn("items", F.array_distinct("items"))
    return out.select("doc_id", (F.size("items") > 0).alias("leaked"), "items", "best_share", F.col("row").alias("text_hash"))


def _fit(spark: SparkSession, docs: DataFrame, blocks: Callable, n_docs: int, s: Settings) -> tuple | None:
    """Vocabulary, weights and latent space of the whole benchmark; None without words."""
    words = {w for block in blocks() for _, ws in block for w in ws}
    if not words:
        return None
    # Words by hashed dimension, and the dimensions that occur numbered anew.
    place = {w: xxhash.xxh3_64_intdigest(w) % s.dimensions for w in sorted(words)}
    number = {d: k for k, d in enumerate(sorted(set(place.values())))}
    vocabulary = {w: number[d] for w, d in place.items()}
    df = document_frequencies(spark, docs, vocabulary, len(number))
    lists = lambda block: [_Terms(vocabulary).of(w) for _, w in block]
    # An item keeps terms even when all its words are common, as those of a passage that leaked everywhere are.
    kept = df <= max(1, s.common * n_docs)
    for block in blocks():
        for x in map(np.unique, lists(block)):
            x = x[df[x] > 0]  # words of no document tell nothing
            kept[x[np.argsort(df[x], kind="stable")[: s.rarest]]] = True
    weight = np.where(kept, np.maximum(np.log((1 + n_docs) / (1 + df)), 0.05), 0.0)
    space = latent_space(spark, docs, vocabulary, weight, map(lists, blocks()), s)
    return vocabulary, weight, space


def _search(spark: SparkSession, docs: DataFrame, worded: list[tuple[int, list[bytes]]], fitted: tuple | None, s: Settings) -> DataFrame:
    model = None
    if fitted and worded:
        vocabulary, weight, space = fitted
        lists = [_Terms(vocabulary).of(w) for _, w in worded]
        index = RunIndex(lists, s)
        # An item is one passage, however long.
        longest = max(len(x) for x in lists)
        new, terms, rows = _matrix(lists, weight, Settings(window=longest, stride=longest))
        queries = _vectors(new, terms, weight, space) if len(new) else np.zeros((0, space.shape[1]), np.float32)
        model = (vocabulary, weight, space, queries, [worded[int(r)] for r in rows[:, 0]], index, worded)
    shipped = spark.sparkContext.broadcast(model)  # the size that find_leaks() states

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for batch in batches:
            bodies = texts(batch.column("text"))
            hits: list[dict[int, float]] = [{} for _ in bodies]
            for i, j in _batches(bodies) if m else ():
                vocabulary, weight, space, queries, worded, index, all_items = m
                terms = _Terms(vocabulary)
                words = [words_of(b) for b in bodies[i:j]]
                lists = [terms.of(w) for w in words]
                for doc, x in enumerate(lists):
                    for q, places in index.candidates(x).items():
                        item_id, item = all_items[q]
                        for start, end in _stretches(sorted(places), len(item)):
                            share = check_pair(item, words[doc][start:end], s)
                            if share > hits[i + doc].get(item_id, 0.0):
                                hits[i + doc][item_id] = share
                new, at, rows = _matrix(lists, weight, s)
                for lo in range(0, len(new), 4096):
                    hi = min(len(new), lo + 4096)
                    x = slice(new[lo], new[hi] if hi < len(new) else len(at))
                    near = _vectors(new[lo:hi] - new[lo], at[x], weight, space) @ queries.T
                    around, longest = -1, max((len(w) for _, w in worded), default=0)
                    for r, q in zip(*(x.tolist() for x in np.nonzero(near >= s.cosine)), strict=True):
                        item_id, item = worded[q]
                        if r != around:
                            around, doc, start = r, int(rows[lo + r, 0]), int(rows[lo + r, 1]) * s.stride
                            nearby = set(words[doc][max(0, start - longest) : start + s.window + longest])
                        if sum(map(nearby.__contains__, item)) < s.reworded * len(item):  # no order of words can reach it
                            continue
                        body = words[doc][max(0, start - len(item)) : start + s.window + len(item)]
                        share = check_pair(item, body, s)
                        if share > hits[i + doc].get(item_id, 0.0):
                            hits[i + doc][item_id] = share
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("row"), pa.array([sorted(h) for h in hits], pa.list_(pa.int64())), pa.array([max(h.values(), default=0.0) for h in hits])],
                ["doc_id", "row", "items", "best_share"],
            )

    return clear_batches(docs.withColumn("row", F.xxhash64("text"))).mapInArrow(run, "doc_id long, row long, items array<long>, best_share double")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
