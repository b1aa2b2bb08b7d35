"""Near-duplicate detection with min-max hashing.

Under each hash permutation both the least and the greatest value are kept, so half as many permutations give
the same number of signature values; bands of the signature are the candidate buckets. Links are confirmed on
full shingle sets. Within a bucket the most typical member (its bands are the most shared) is the pivot, and
all members are compared with it: no pairs of a bucket are listed. Buckets that still hold members of two or
more components are then compared exactly, tile by tile, and only spanning links leave a tile.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordHashes, clear_batches, cut, forget, mix, table, texts
from .components import components

ROWS = 5
_MUL = np.uint64(0x9E3779B97F4A7C15)


def bands_for(threshold: float, rows: int = ROWS, missed: float = 1e-6) -> int:
    """Bands needed so that a pair at the threshold shares none with a probability of `missed` at most; even."""
    b = math.ceil(math.log(missed) / math.log(1 - threshold**rows))
    return b + b % 2


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def shingle_set(words: list[bytes], hashes: WordHashes, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; fewer words are one shingle, no words none."""
    if not words:
        return np.empty(0, np.uint64)
    h = hashes.of(words)
    if len(h) < size:
        x = np.uint64(len(h))
        with np.errstate(over="ignore"):
            for v in h:
                x = x * _MUL + v
        return mix(np.array([x], np.uint64))
    n = len(h) - size + 1
    x = h[:n].copy()
    for j in range(1, size):
        x = x * _MUL + h[j : j + n]
    return np.unique(mix(x))


def permutations(n: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, n, dtype=np.uint64)


def signatures(sets: list[np.ndarray], n_values: int) -> np.ndarray:
    """One row per non-empty set: least and greatest value under each of n_values / 2 permutations."""
    flat = np.concatenate(sets)
    at = np.cumsum([0] + [len(s) for s in sets[:-1]])
    a, b = permutations(n_values // 2)
    out = np.empty((len(sets), n_values), np.uint64)
    for i in range(n_values // 2):
        x = flat * a[i] + b[i]
        out[:, 2 * i] = np.minimum.reduceat(x, at)
        out[:, 2 * i + 1] = np.maximum.reduceat(x, at)
    return out


def band_hashes(sig: np.ndarray, bands: int, rows: int = ROWS) -> np.ndarray:
    out = np.empty((len(sig), bands), np.uint64)
    for j in range(bands):
        x = np.full(len(sig), j + 1, np.uint64)
        for k in range(rows):
            x = mix(x * _MUL + sig[:, j * rows + k])
        out[:, j] = x
    return out.view(np.int64)


def sketch(docs: DataFrame, bands: int, size: int) -> DataFrame:
    """(doc_id, text, text_hash) to (doc_id, text_hash, key, n_shingles, bands); key names the exact word sequence, null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            ids, prints, bodies = batch.column("doc_id"), batch.column("text_hash"), texts(batch.column("text"))
            done = 0
            while done < len(bodies):  # pieces of a bounded number of bytes
                end, n = done, 0
                while end < len(bodies) and (end == done or n + len(bodies[end]) < 4 << 20):
                    n += len(bodies[end])
                    end += 1
                part = [words_of(t) for t in bodies[done:end]]
                sets = [shingle_set(w, hashes, size) for w in part]
                full = [i for i, s in enumerate(sets) if len(s)]
                lists: list = [None] * len(part)
                if full:
                    bh = band_hashes(signatures([sets[i] for i in full], bands * ROWS), bands)
                    for k, i in enumerate(full):
                        lists[i] = bh[k]
                keys = [hashlib.md5(b" ".join(w)).digest() if w else None for w in part]
                yield pa.record_batch(
                    [ids.slice(done, end - done), prints.slice(done, end - done), pa.array(keys, pa.binary()), pa.array([len(s) for s in sets], pa.int64()), pa.array(lists, pa.list_(pa.int64()))],
                    ["doc_id", "text_hash", "key", "n_shingles", "bands"],
                )
                done = end

    d = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return clear_batches(d).mapInArrow(run, "doc_id long, text_hash long, key binary, n_shingles long, bands array<long>")


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


class _Sets:
    """Shingle sets of the last texts seen, by key."""

    def __init__(self, size: int, limit: int = 512):
        self.size, self.limit, self.hashes, self.kept = size, limit, WordHashes(), {}

    def of(self, key: bytes, text: bytes) -> np.ndarray:
        if key not in self.kept:
            if len(self.kept) >= self.limit:
                self.kept.clear()
            self.kept[key] = shingle_set(words_of(text), self.hashes, self.size)
        return self.kept[key]


def confirm(pairs: DataFrame, percent: int, size: int) -> DataFrame:
    """(a, b, text_a, text_b) to the links (a, b) whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets(size)
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            ta, tb = texts(batch.column("text_a")), texts(batch.column("text_b"))
            keep = [_linked(sets.of(a[i], ta[i]), sets.of(b[i], tb[i]), percent) for i in range(len(a))]
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return clear_batches(pairs.select("a", "b", "text_a", "text_b"), 500).mapInArrow(run, "a binary, b binary")


def _tile(percent: int, size: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """Links between different components among a tile's members; a pair already joined here is not tried."""
        hashes = WordHashes()
        sets = [shingle_set(words_of((t or "").encode()), hashes, size) for t in pdf["text"]]
        keys, labels, side = pdf["key"].tolist(), pdf["label"].tolist(), pdf["side"].tolist()
        sizes = np.array([len(s) for s in sets])
        root = {x: x for x in labels}

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        sig = signatures(sets, 128)
        out = []
        for i in range(len(keys)):
            close = (sig[i] == sig[i + 1 :]).mean(axis=1) > percent / 100 - 0.3  # over seven deviations below
            fits = (100 * np.minimum(sizes[i], sizes[i + 1 :]) >= percent * np.maximum(sizes[i], sizes[i + 1 :])) & close
            for j in np.flatnonzero(fits) + i + 1:
                if (side[i] == 3 or side[i] | side[j] == 3) and find(labels[i]) != find(labels[j]) and _linked(sets[i], sets[j], percent):
                    root[find(labels[i])] = find(labels[j])
                    out.append((keys[i], keys[j]))
        return pd.DataFrame(out, columns=["a", "b"])

    return run


def near_duplicates(spark: SparkSession, docs: DataFrame, percent: int = 80, size: int = 5, tile: int = 400) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept, text_hash, component_key), one for each row of docs (doc_id, text).

    Documents whose sets of `size`-word shingles (A-Z lower-cased) have 100 * intersection >= percent * union are
    linked; component_id is the least doc_id of the connected component. Null and empty texts, and texts of white
    space alone, have no shingle and are linked with nothing. A row with a null doc_id counts in its class, but
    its kept is null, as is component_id where a class has no id at all. Repeated rows give repeated results; an
    empty table gives none. text_hash is the row's xxhash64 of text, and
    component_key tells components apart also where ids repeat; it is null without shingles. Columns other than doc_id and text are not read.
    """
    bands = bands_for(percent / 100)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = cut(spark, sketch(docs, bands, size), "sketch")
    # One node for each distinct word sequence: copies are never compared with one another.
    nodes = rows.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.first("bands").alias("bands"))
    nodes = cut(spark, nodes, "nodes")
    banded = nodes.select("key", "n", F.explode("bands").alias("bh"))
    shared = banded.groupBy("bh").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    banded = cut(spark, banded.join(shared, "bh"), "banded")
    typical = banded.groupBy("key").agg(F.sum("c").alias("score"))
    scored = banded.join(typical, "key")
    pivot = scored.groupBy("bh").agg(F.max_by(F.struct(F.col("key").alias("p"), F.col("n").alias("pn")), F.struct("score", "key")).alias("x")).select("bh", "x.p", "x.pn")
    pivot = cut(spark, pivot, "pivot")  # apart from the join, so that the join can split a hot bucket
    pairs = banded.join(pivot, "bh").where(F.col("key") != F.col("p")).where(100 * F.least("n", "pn") >= percent * F.greatest("n", "pn"))
    pairs = cut(spark, pairs.select(F.col("key").alias("a"), F.col("p").alias("b")).distinct(), "pairs")

    # Text of the nodes that are in some pair or shared bucket.
    wanted = nodes.join(banded.select("key").distinct(), "key", "left_semi").select("key", "rep")
    lower = rows.where("key is not null").select("doc_id", "key").join(wanted, "key").where(F.col("doc_id").eqNullSafe(F.col("rep"))).select("doc_id", "key")
    bodies = _bodies(spark, docs, lower, size)
    ta, tb = bodies.select(F.col("key").alias("a"), F.col("text").alias("text_a")), bodies.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    links = cut(spark, confirm(pairs.join(ta, "a").join(tb, "b"), percent, size), "links")
    first = cut(spark, components(spark, links), "components")

    # Second round: buckets whose members are still in several components.
    members = banded.join(first.withColumnRenamed("node", "key"), "key", "left").select("bh", "key", "c", F.coalesce("component", "key").alias("label"))
    mixed = members.groupBy("bh").agg(
        F.min("label").alias("l0"), F.max("label").alias("l1"), F.count(F.lit(1)).alias("m"),
        F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("print"),
    ).where("m > 2 and l0 <> l1")
    mixed = mixed.groupBy("print", "m").agg(F.min("bh").alias("bh")).select("bh", F.ceil(F.col("m") / tile).cast("int").alias("t"))
    open_rows = members.join(mixed, "bh").withColumn("mine", F.pmod(F.xxhash64("key"), F.col("t")).cast("int"))
    tiles = open_rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("t") - 1))).select(
        "bh", "key", "label", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"),
        # Which of the tile's two sides a member is on; 3 when both are the same.
        F.when(F.col("mine") == F.col("other"), 3).when(F.col("mine") < F.col("other"), 1).otherwise(2).alias("side"),
    )
    more = tiles.join(bodies, "key").select("bh", "x", "y", "key", "label", "side", "text").groupBy("bh", "x", "y").applyInPandas(_tile(percent, size), "a binary, b binary")
    more = cut(spark, more.distinct(), "more")
    merged = first if more.isEmpty() else components(spark, links.union(more))
    forget(spark, banded, pivot, pairs, bodies)
    labelled = nodes.select("key", "rep").join(merged.withColumnRenamed("node", "key"), "key", "left").select("key", "rep", F.coalesce("component", "key").alias("label"))
    named = cut(spark, labelled.groupBy("label").agg(F.min("rep").alias("component_id")), "named")  # apart from the join
    by_key = labelled.join(named, "label").select("key", "component_id", F.col("label").alias("component_key"))
    out = rows.select("doc_id", "text_hash", "key", "n_shingles").join(by_key, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"), "text_hash", "component_key")


def _bodies(spark: SparkSession, docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(key, text) of one row for each wanted (doc_id, key); the key is checked, as ids may repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_pylist()
            keep = [hashlib.md5(b" ".join(words_of(t))).digest() == k for t, k in zip(texts(batch.column("text")), keys, strict=True)]
            yield batch.select(["key", "text"]).filter(pa.array(keep, pa.bool_()))

    w = wanted.distinct().withColumnRenamed("doc_id", "w_id")
    found = docs.join(w, F.col("doc_id").eqNullSafe(F.col("w_id"))).select("key", "text")
    checked = clear_batches(found).mapInArrow(run, "key binary, text string")
    return cut(spark, checked.dropDuplicates(["key"]), "bodies")


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "documents"), percent=85).drop("text_hash", "component_key")


#: DuckDB SQL for op4_minhash_near_dedup.
OP4_SQL = """
with recursive t as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
s as (select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
  else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) end) as g from t),
c as (select g, len(g) as n, min(doc_id) as rep from (select doc_id, list_sort(g) as g from s) group by g),
u as (select rep, n, unnest(g) as x from c),
f as (select x from u group by x having count(*) > 1),
v as (select u.* from u join f using (x)),
p as (select a.rep as a, b.rep as b from v a join v b on a.x = b.x and a.rep < b.rep
  and 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  group by a.rep, b.rep, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
e as (select a, b from p union all select b, a from p),
r as (select rep as node, rep as label from c where n > 0 union select e.b, r.label from r join e on r.node = e.a),
l as (select node, min(label) as label from r group by node)
select s.doc_id, len(s.g)::bigint as n_shingles, case when len(s.g) = 0 then s.doc_id else l.label end as component_id,
  s.doc_id = (case when len(s.g) = 0 then s.doc_id else l.label end) as kept
from (select doc_id, list_sort(g) as g from s) s join c on s.g = c.g left join l on l.node = c.rep
"""
