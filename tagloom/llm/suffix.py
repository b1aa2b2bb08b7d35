"""Removal of repeated byte strings by merging Burrows-Wheeler transforms of shards.

Two equal strings of `length` bytes choose the same anchor: the leftmost least of their k-gram hashes. So the strings
around one anchor value form a collection of their own, aligned at the anchor, and only anchors that two or more
distinct contexts share are looked at further.

* A shard is what one task holds of a collection. Its transform is built column by column from the right: column p holds
  the bytes at place p in the order of the suffixes that start at p + 1, and stably sorting that order by them gives the
  order of the suffixes at p. No suffix is compared with another.
* The shards of a collection are merged by refining their interleave: at each column every shard hands out its next
  bytes in its own order, and the interleave is stably sorted by them. The common prefix of neighbours is one more than
  the least one between them a column before. Where it reaches `length` the neighbours' interval is a repeated string.
* A collection too large for one task is split by a longer string that all its strings of one class of starts share;
  classes are halved until a collection fits, or until a class is a single start and so all its strings are equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import clear_batches, cut, forget, mix, n_shuffle, table, texts

GRAM = 32
_TABLE = np.random.default_rng(11).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LEVEL = np.random.default_rng(12).integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MUL = np.uint64(0x9E3779B97F4A7C15)


def string_hashes(buf: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """64-bit hashes of all strings of each size, powers of two in ascending order, by doubling."""
    h, size, level, out = _TABLE[buf], 1, 0, []
    while True:
        if size in sizes:
            out.append(mix(h))
            if size == sizes[-1]:
                return out
        h = h[:-size] * _LEVEL[level] + (h[size:] ^ (h[size:] >> np.uint64(31)))
        size, level = 2 * size, level + 1


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each window of `width`."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(docs: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Anchor of every window of `length` bytes, by runs of windows with the same anchor:

    document, anchor offset, first and last window start, anchor hash, and a hash of the context, which is the bytes
    that the run's windows span and the anchor's place in them.
    """
    none = tuple(np.empty(0, np.int64) for _ in range(4)) + (np.empty(0, np.uint64),) * 2
    buf = np.frombuffer(b"".join(docs), np.uint8)
    size = np.array([len(d) for d in docs], np.int64)
    first = np.cumsum(size) - size
    if len(buf) < length:
        return none
    block = 1 << (length.bit_length() - 1)
    h, wide = string_hashes(buf, (GRAM, block))
    low = np.uint64(0xFFFFFFFF)
    packed = (h & ~low) | np.arange(len(h), dtype=np.uint64)  # equal values: the leftmost is least
    at = (_least(packed, length - GRAM + 1) & low).astype(np.int64)  # by window start
    doc = np.repeat(np.arange(len(docs)), size)[: len(at)]
    start = np.arange(len(at))
    ok = start + length <= (first + size)[doc]
    start, at, doc = start[ok], at[ok], doc[ok]
    if not len(start):
        return none
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1) | (doc[1:] != doc[:-1])]))
    last = np.append(new[1:], len(start)) - 1
    d, a, lo, hi = doc[new], at[new], start[new], start[last]
    # Blocks of a fixed size that cover the context: the hash of those, its size and the anchor's place.
    c = mix((a - lo).astype(np.uint64) * _MUL + (hi - lo).astype(np.uint64))
    for k in range(-(-2 * length // block)):
        c = mix(c * _MUL + wide[np.minimum(lo + k * block, hi + length - block)])
    return d, a - first[d], lo - first[d], hi - first[d], h[a], c


def _segments(text: bytes, length: int, step: int = 2 << 20) -> Iterator[tuple[int, bytes]]:
    """A long text in pieces that overlap, so that each window start is in exactly one of them."""
    for s in range(0, max(1, len(text) - length + 1), step):
        yield s, text[s : s + step + length - 1]


def find_anchors(docs: DataFrame, length: int) -> DataFrame:
    """(key, doc_id, text) to one row per document: its size and the arrays of its anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, keys, ids = texts(batch.column("text")), batch.column("key"), batch.column("doc_id")
            i = 0
            while i < len(bodies):
                pieces, j, n = [], i, 0
                while j < len(bodies) and (j == i or n + len(bodies[j]) <= 2 << 20):
                    pieces += [(j, s, t) for s, t in _segments(bodies[j], length)]
                    n += len(bodies[j])
                    j += 1
                got: list[list[tuple]] = [[] for _ in range(i, j)]
                k = 0
                while k < len(pieces):  # pieces of one long text go one by one
                    e, n = k, 0
                    while e < len(pieces) and (e == k or n + len(pieces[e][2]) <= 2 << 20):
                        n += len(pieces[e][2])
                        e += 1
                    part = pieces[k:e]
                    d, pos, lo, hi, h, c = anchors([t for _, _, t in part], length)
                    cuts = np.searchsorted(d, np.arange(len(part) + 1))
                    for m, (doc, s, _) in enumerate(part):
                        x = slice(cuts[m], cuts[m + 1])
                        if cuts[m] < cuts[m + 1]:
                            got[doc - i].append((pos[x] + s, lo[x] + s, hi[x] + s, h[x].view(np.int64), c[x].view(np.int64)))
                    k = e
                cols: list[list] = [[np.concatenate(x) for x in zip(*g, strict=True)] if g else [[]] * 5 for g in got]
                yield pa.record_batch(
                    [keys.slice(i, j - i), ids.slice(i, j - i), pa.array([len(b) for b in bodies[i:j]], pa.int64()), *(pa.array([c[m] for c in cols], pa.list_(pa.int64() if m > 2 else pa.int32())) for m in range(5))],
                    ["key", "doc_id", "n_bytes", "pos", "lo", "hi", "h", "c"],
                )
                i = j

    return clear_batches(docs.select("key", "doc_id", "text")).mapInArrow(run, "key binary, doc_id long, n_bytes long, pos array<int>, lo array<int>, hi array<int>, h array<long>, c array<long>")


_ROW = "g long, h long, c long, off int, n int, body binary"
_KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())


def _record(rows: list[tuple], kinds: tuple, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * len(kinds), kinds, strict=True)], names)


def take_bodies(wanted: DataFrame, length: int) -> DataFrame:
    """(text, a) with a the contexts to take from text: rows (g, h, c, off, n, body), g being the collection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (a["h"], a["h"], a["c"], a["pos"] - a["lo"], a["hi"] - a["lo"] + 1, text[a["lo"] : a["hi"] + length])
                for text, list_ in zip(texts(batch.column("text")), batch.column("a").to_pylist(), strict=True)
                for a in list_
            ]
            yield _record(rows, _KINDS, ["g", "h", "c", "off", "n", "body"])

    return clear_batches(wanted.select("text", "a"), 500).mapInArrow(run, _ROW)


def halve(rows: DataFrame, length: int) -> DataFrame:
    """Rows of collections too large, with the class (low, high) of starts they are split by, to rows of both its halves.

    A class holds the windows that start low .. high - 1 bytes before the anchor; all of them cover the bytes from `low`
    before it to `length - high + 1` after, whose hash (g, g2) names the new collection.
    """
    names = ["g", "g2", "h", "c", "off", "n", "body", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for h, c, off, n, body, low, high in zip(*(batch.column(x).to_pylist() for x in names[2:]), strict=True):
                middle = (low + high) // 2
                for a, b in ((low, middle), (middle, high)):
                    if max(a, off - n + 1) <= min(b - 1, off):
                        core = hashlib.blake2b(body[off - a : off + length - b + 1], digest_size=16, salt=a.to_bytes(4, "big") + b.to_bytes(4, "big")).digest()
                        rows.append((int.from_bytes(core[:8], "big", signed=True), int.from_bytes(core[8:], "big", signed=True), h, c, off, n, body, a, b))
            yield _record(rows, (pa.int64(), *_KINDS, pa.int32(), pa.int32()), names)

    return clear_batches(rows, 4000).mapInArrow(run, "g long, g2 long, h long, c long, off int, n int, body binary, low int, high int")


def _symbols(rows: list[tuple], length: int) -> tuple[np.ndarray, int]:
    """Bytes of rows (.., off, n, body) by column and row, from the last column to the first; -1 where a row has none.

    The columns are aligned at the anchors; also the number of columns from the anchor on, at most `length`.
    """
    right = min(length, max(len(r[-1]) - r[-3] for r in rows))
    left = max(r[-3] for r in rows)
    out = np.full((len(rows), left + right), -1, np.int16)
    for i, r in enumerate(rows):
        off, x = r[-3], np.frombuffer(r[-1], np.uint8)
        x = x[: off + right]
        first = right - (len(x) - off)  # the column of its last byte
        out[i, first : first + len(x)] = x[::-1]
    return np.ascontiguousarray(out.T), right


def transform(symbols: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The transforms of shards, side by side: each column in the order of the suffixes that start one place further on."""
    at, out, key = np.arange(symbols.shape[1]), np.empty_like(symbols), group * 257
    for p, column in enumerate(symbols):
        out[p] = column[at]
        at = at[np.argsort(key + out[p], kind="stable")]
    return out


def _least_between(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least of x[lo .. hi] for each pair of places, from tables of doubling widths."""
    size = hi - lo + 1
    out = np.empty(len(lo), x.dtype)
    level, width = x, 1
    while True:
        mine = np.flatnonzero((size >= width) & (size < 2 * width))
        out[mine] = np.minimum(level[lo[mine]], level[hi[mine] - width + 1])
        if not len(size) or 2 * width > size.max():
            return out
        level, width = np.minimum(level[:-width], level[width:]), 2 * width


def merge(shards: list[tuple[int, np.ndarray, int]], context: np.ndarray, length: int, far: int) -> np.ndarray:
    """Merge shards, (collection, transform, columns from the anchor on), of which those of one collection are together.

    Returns a boolean matrix by row (the shards' rows one after another) and j < far: whether the `length` bytes that
    start j before the anchor are repeated in its collection, in another `context` (a number for each row).
    """
    sizes = [t.shape[1] for _, t, _ in shards]
    total, right = sum(sizes), max(r for *_, r in shards)
    left = max(t.shape[0] - r for _, t, r in shards)
    columns = np.full((left + right, total), -1, np.int16)
    start = 0
    for (_, t, r), k in zip(shards, sizes, strict=True):
        columns[right - r : right - r + len(t), start : start + k] = t
        start += k
    group = np.repeat(np.cumsum([1] + [a[0] != b[0] for a, b in zip(shards, shards[1:], strict=False)]) - 1, sizes)
    copies = len(np.unique(context)) < total
    z = np.repeat(np.arange(len(shards)), sizes)  # the interleave: shards in the order of all suffixes
    row = np.arange(total)
    common = np.zeros(total, np.int16)  # prefix that each suffix has in common with the one before it
    repeated = np.zeros((total, far), bool)
    byte = np.empty(total, np.int16)
    for p, column in enumerate(columns):
        byte[np.argsort(z, kind="stable")] = column  # every shard hands out its bytes in its own order
        o = np.argsort(group * 257 + byte, kind="stable")  # collections are together already, and stay where they are
        z, row, mine = z[o], row[o], byte[o]
        same = np.flatnonzero((mine[1:] == mine[:-1]) & (mine[1:] >= 0) & (group[1:] == group[:-1])) + 1
        before, common = common, np.zeros(total, np.int16)
        common[same] = np.minimum(_least_between(before, o[same - 1] + 1, o[same]) + 1, length)
        if p >= right - 1 and p - right + 1 < far:
            equal = common >= length
            if copies:  # an interval of one context alone is no repeat
                first = np.flatnonzero(~equal)
                span = np.diff(np.append(first, total))
                equal &= np.repeat(np.minimum.reduceat(context[row], first) != np.maximum.reduceat(context[row], first), span)
            hit = np.flatnonzero(equal)
            repeated[row[hit], p - right + 1] = repeated[row[hit - 1], p - right + 1] = True
    return repeated


_SHARD = "g long, h array<long>, c array<long>, off array<int>, n array<int>, right int, wide boolean, columns binary"


def build_shards(rows: DataFrame, length: int, many: int = 8192) -> DataFrame:
    """Rows (g, h, c, off, n, body) to the transforms of shards, which are what some `many` rows have of a collection."""
    kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32(), pa.bool_(), pa.binary())

    def flush(held: dict[int, dict[tuple, tuple]]) -> pa.RecordBatch:
        groups = [list(distinct.values()) for distinct in held.values()]  # repeated input rows bring the same context again
        rows = list(chain.from_iterable(groups))
        symbols, right = _symbols(rows, length)
        made = transform(symbols, np.repeat(np.arange(len(groups)), [len(x) for x in groups]))
        out, start = [], 0
        for g, mine in zip(held, groups, strict=True):
            h, c, off, n, body = zip(*mine, strict=True)
            r = min(length, max(len(b) - o for b, o in zip(body, off, strict=True)))
            t = made[right - r : right + max(off), start : start + len(mine)]
            wide = bool((t < 0).any())
            out.append((g, h, c, off, n, r, wide, (t if wide else t.astype(np.uint8)).tobytes()))
            start += len(mine)
        return _record(out, kinds, ["g", "h", "c", "off", "n", "right", "wide", "columns"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict[tuple, tuple]] = {}
        count = 0
        for batch in batches:
            for g, *r in zip(*(batch.column(x).to_pylist() for x in ("g", "h", "c", "off", "n", "body")), strict=True):
                held.setdefault(g, {})[r[0], r[1]] = tuple(r)
                count += 1
                if count >= many:
                    yield flush(held)
                    held, count = {}, 0
        if held:
            yield flush(held)

    return clear_batches(rows.select("g", "h", "c", "off", "n", "body"), 4000).mapInArrow(run, _SHARD)


def merge_shards(shards: DataFrame, length: int, many: int = 8192) -> DataFrame:
    """Shards in the order of their collections within each partition, to (h, c, runs) of the contexts with repeats."""

    def flush(held: list[tuple]) -> pa.RecordBatch:
        parts = [(g, np.frombuffer(x, np.int16 if wide else np.uint8).reshape(-1, len(h)), right) for g, h, _, _, _, right, wide, x in held]
        off = np.concatenate([r[3] for r in held])
        number: dict[tuple, int] = {}
        context = np.array([number.setdefault((r[0], *x), len(number)) for r in held for x in zip(r[1], r[2], strict=True)])
        bits = merge(parts, context, length, int(off.max()) + 1)
        rows, i = [], 0
        for _, h, c, o, n, *_ in held:
            for k in range(len(h)):
                mine = bits[i, : o[k] + 1][::-1]  # by start in the context
                if mine.any():
                    rows.append((h[k], c[k], _runs(mine[: n[k]])))
                i += 1
        return _record(rows, (pa.int64(), pa.int64(), pa.list_(pa.int32())), ["h", "c", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count = 0
        for batch in batches:
            for r in zip(*(batch.column(x).to_pylist() for x in ("g", "h", "c", "off", "n", "right", "wide", "columns")), strict=True):
                if count >= many and r[0] != held[-1][0]:
                    yield flush(held)
                    held, count = [], 0
                held.append(r)
                count += len(r[1])
        if held:
            yield flush(held)

    return clear_batches(shards, 500).mapInArrow(run, "h long, c long, runs array<int>")


def _runs(bits: np.ndarray) -> list[int]:
    """Starts and ends of the true runs, one after another."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], bits.astype(np.int8), [0]])))
    return edge.tolist()


def repeated_spans(spark: SparkSession, docs: DataFrame, length: int, shard_rows: int = 1000) -> tuple[DataFrame, DataFrame]:
    """For docs (doc_id, key, text) with key a digest of the text: classes (key, copies) and spans (key, hits).

    hits are the repeated windows of a class by context: lo, and starts and ends of runs of window starts after it.
    """
    found = cut(spark, find_anchors(docs, length), "anchors")
    cols = ("n_bytes", "pos", "lo", "hi", "h", "c")
    classes = found.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), *[F.first(x).alias(x) for x in cols])
    classes = cut(spark, classes.withColumn("id", F.monotonically_increasing_id()), "classes")  # ids are fixed by writing them
    forget(spark, found)
    each = classes.select("id", F.explode(F.arrays_zip("h", "c", "pos", "lo", "hi")).alias("a")).select("id", "a.*")
    shared = classes.select(F.explode("h").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("h")
    shared = cut(spark, shared, "shared")  # apart from the join, so that the join can split a hot anchor
    members = cut(spark, each.join(shared, "h"), "members")
    # One representative for each distinct context. Anchors with one context have nothing to compare.
    forget(spark, shared)
    contexts = cut(spark, members.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "pos", "lo", "hi")).alias("at")), "contexts")
    sizes = contexts.groupBy("h").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    sizes = cut(spark, sizes, "sizes")  # again apart from the join
    ask = contexts.join(sizes, "h").groupBy("at.id").agg(F.collect_list(F.struct("h", "c", "at.pos", "at.lo", "at.hi")).alias("a"))
    ask = cut(spark, ask.join(classes.select("id", "rep", F.col("key").alias("k")), "id").select("rep", "k", "a"), "asked")
    bodies = docs.join(ask, (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("rep"))).select("text", "a")
    rows = cut(spark, take_bodies(bodies, length), "bodies")
    forget(spark, ask)
    large = sizes.where(F.col("rows") > shard_rows).select(F.col("h").alias("g"))
    fit, equal, used = [rows.join(large, "g", "left_anti")], [], [rows, sizes]
    rest = rows.join(large, "g", "left_semi").withColumns({"low": F.lit(0), "high": F.lit(length - GRAM + 1)})
    while not rest.isEmpty():
        split = cut(spark, halve(rest, length), "split")
        found = cut(spark, split.groupBy("g", "g2").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("h", "c")).alias("_a"), F.max(F.struct("h", "c")).alias("_z")).where("_a <> _z").drop("_a", "_z"), "found")
        used += [split, found]
        split = split.join(found, ["g", "g2"])
        fit.append(split.where(F.col("_n") <= shard_rows).select("g", "h", "c", "off", "n", "body"))
        rest = split.where(F.col("_n") > shard_rows).drop("_n")
        start = F.col("off") - F.col("low")  # a class of one start: all its strings are equal
        equal.append(rest.where("high - low = 1").select("h", "c", F.array(start, start + 1).alias("runs")))
        rest = rest.where("high - low > 1").drop("g", "g2")
    # Shards are built where the rows lie, so that transforms are what is shuffled.
    shards = build_shards(reduce(DataFrame.union, fit), length)
    dealt = shards.repartition(n_shuffle(spark), "g").sortWithinPartitions("g")
    merged = cut(spark, reduce(DataFrame.union, equal, merge_shards(dealt, length)), "merged")
    forget(spark, *used)
    # A context at two places: all its windows are repeated.
    whole = contexts.where("n > 1").select("h", "c", F.array(F.lit(0), F.col("at.hi") - F.col("at.lo") + 1).alias("runs"))
    hits = merged.union(whole).where(F.size("runs") > 0)
    hits = cut(spark, hits.groupBy("h", "c").agg(F.flatten(F.collect_list("runs")).alias("runs")), "hits")
    spans = members.join(hits, ["h", "c"]).groupBy("id").agg(F.collect_list(F.struct("lo", "runs")).alias("hits"))
    spans = cut(spark, spans.join(classes.select("id", "key"), "id").select("key", "hits"), "spans")
    forget(spark, members, contexts, merged, hits)
    return classes.select("key", "copies"), spans


def remove_repeats(spark: SparkSession, docs: DataFrame, length: int = 200) -> DataFrame:
    """Each row of docs (doc_id, text) with n_bytes, spans (starts and ends of what is removed) and the text left over.

    A byte is removed when it is covered by a `length`-byte string that also starts anywhere else, in the same
    document or another; strings are judged on the input and never cross documents. Null and empty texts lose
    nothing and have no bytes. Repeated rows are copies of one another, so all bytes of those of `length` bytes or
    more go. Rows with a null doc_id take part like any others. An empty table gives no row. Other columns are dropped.
    The left-over bytes may cut characters, so they are binary.
    """
    d = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    d = d.withColumn("key", F.unhex(F.md5("text")))
    classes, hits = repeated_spans(spark, d, length)
    copied = classes.where("copies > 1").select("key", F.lit(True).alias("copied"))
    extra = hits.join(copied, "key", "full_outer").select("key", F.when(F.col("copied"), F.lit(None)).otherwise(F.col("hits")).alias("hits"), F.coalesce("copied", F.lit(False)).alias("copied"))
    rows = d.join(extra, "key", "left").select("doc_id", "text", "hits", F.coalesce("copied", F.lit(False)).alias("copied"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, hits, copied = texts(batch.column("text")), batch.column("hits").to_pylist(), batch.column("copied").to_pylist()
            spans, left = [], []
            for b, h, c in zip(bodies, hits, copied, strict=True):
                if c:
                    s = [0, len(b)] if len(b) >= length else []
                elif h:
                    gone = np.zeros(len(b) + 1, np.int32)
                    for x in h:
                        r = np.array(x["runs"]).reshape(-1, 2) + x["lo"]
                        np.add.at(gone, r[:, 0], 1)
                        np.add.at(gone, r[:, 1] - 1 + length, -1)
                    s = _runs(np.cumsum(gone)[:-1] > 0)
                else:
                    s = []
                spans.append(s)
                left.append(b"".join(b[x:y] for x, y in zip([0, *s[1::2]], [*s[::2], len(b)], strict=True)))
            yield pa.record_batch([batch.column("doc_id"), pa.array([len(b) for b in bodies], pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(left, pa.binary())], ["doc_id", "n_bytes", "spans", "left"])

    return clear_batches(rows).mapInArrow(run, "doc_id long, n_bytes long, spans array<long>, left binary")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = remove_repeats(spark, table(spark, sf_dir, "documents"), 200)
    return d.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("left")).cast("long").alias("n_removed"), (F.size("spans") / 2).cast("long").alias("n_spans"), F.sha2("left", 256).alias("kept_sha256"))
