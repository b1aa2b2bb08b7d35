"""Scoring by prediction by partial matching over byte contexts, beside a word unigram score.

The model is a byte-context trie kept as counts of (context, next byte) for contexts of 0 to ORDER bytes, counted
over all training documents. A byte is coded in the longest context that was seen; a context's escape estimate is
the number of its distinct bytes (method C), and bytes that a longer context offered are excluded from the shorter
ones. Blocks of documents send their distinct grams and words to buckets by context. What the blocks of a part send to
a bucket is merged by one task, then the sums of some parts by another, and so on; so a bucket's last task holds its
distinct grams once, however many documents have them. It works out their code lengths, which go back to the parts,
where each block gets those of what it sent. What is gathered grows with the input.
Only the contexts of one byte and none, at most 65,792 counts, go to all tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordHashes, crc_mod, cut, forget, n_shuffle, table, texts

ORDER = 5
EDGE = 0xFF  # never part of UTF-8: stands before the first byte and after the last
_WORDS, _GRAMS, _LOW, _TOTALS = range(4)
#: A word key that no 64-bit word hash is likely to have: the end of a document.
END = np.uint64(0x656E646F66646F63)
_MUL = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.uint64(8)


def pack(x: np.ndarray, sorted_keys: bool = False) -> bytes:
    """Compressed bytes of an array; sorted keys as their differences."""
    if sorted_keys and len(x):
        x = np.concatenate([x[:1], x[1:] - x[:-1]])
    return zstandard.ZstdCompressor(level=1).compress(x.tobytes())


def unpack(b: bytes, dtype, sorted_keys: bool = False) -> np.ndarray:
    x = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype)
    return np.cumsum(x, dtype=dtype) if sorted_keys else x


def merge(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not len(keys):
        return keys, counts
    o = np.argsort(keys)
    keys, counts = keys[o], counts[o]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.add.reduceat(counts, at)


def grams(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of ORDER + 1 bytes, one for each byte and end, as the last byte's context and itself; and each document's start."""
    pad, end = bytes([EDGE]) * ORDER, bytes([EDGE])
    buf = np.frombuffer(b"".join(x for d in docs for x in (pad, d, end)) or b"", np.uint8)
    size = np.array([len(d) + ORDER + 1 for d in docs], np.int64)
    code = np.zeros(len(buf), np.uint64)
    for k in range(ORDER + 1):
        code[k:] |= buf[: len(buf) - k].astype(np.uint64) << np.uint64(8 * k)
    keep = np.ones(len(buf), bool)
    first = np.cumsum(size) - size
    for k in range(ORDER):
        keep[first + k] = False
    return code[keep], np.cumsum(size - ORDER) - (size - ORDER)


def _mask(n_bytes: int) -> np.uint64:
    return np.uint64((1 << 8 * n_bytes) - 1)


def _pieces(bodies: list[bytes], limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    start, n = 0, 0
    for i, x in enumerate(bodies):
        if i > start and n + len(x) > limit:
            yield start, i
            start, n = i, 0
        n += len(x)
    if bodies:
        yield start, len(bodies)


def _distinct(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return merge(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))


def _contents(bodies: list[bytes], train: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Distinct words and longest grams of all texts, with their counts in the training texts."""
    hashes, words, codes = WordHashes(), [], []
    for is_train in (1, 0):
        mine = [b for b, t in zip(bodies, train, strict=True) if t == is_train]
        for i, j in _pieces(mine):
            part = mine[i:j]
            w, n = np.unique(np.concatenate([*(hashes.of(b.lower().split()) for b in part), np.full(len(part), END)]), return_counts=True)
            words.append((w, n * is_train))
            c, n = np.unique(grams(part)[0], return_counts=True)
            codes.append((c, n * is_train))
    return _distinct(words), _distinct(codes)


def _bucket(kind: int, keys: np.ndarray, n: int) -> np.ndarray:
    """Words by their hash; grams by their context's last two bytes, so that a bucket has all contexts of two or more
    bytes that its grams can fall back to."""
    by = keys if kind == _WORDS else (keys >> _BYTE) & _mask(2)
    return (((by + np.uint64(1)) * _MUL) >> np.uint64(33)) % np.uint64(n)


def _split(kind: int, keys: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places of its keys, ascending)."""
    b = _bucket(kind, keys, n).astype(np.int64)
    o = np.argsort(b, kind="stable")
    ends = np.searchsorted(b[o], np.arange(n + 1))
    for k in range(n):
        if ends[k] < ends[k + 1]:
            yield k, o[ends[k] : ends[k + 1]]


ASKED = "bucket int, kind int, block int, keys binary, counts binary"
_ASKED = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)


def _ask(n: int):
    def run(t: pa.Table) -> pa.Table:
        """Of one block: its distinct words and grams, with what its training documents count of them."""
        block, train = t.column("block")[0].as_py(), np.array(t.column("train").to_pylist(), np.int64)
        rows = []
        for kind, (keys, counts) in zip((_WORDS, _GRAMS), _contents(texts(t.column("text").combine_chunks()), train), strict=True):
            for bucket, at in _split(kind, keys, n):
                rows.append((bucket, kind, block, pack(keys[at], True), pack(counts[at].astype(np.uint32))))
            if kind == _GRAMS:
                low = np.bincount((keys & _mask(2)).astype(np.int64), counts, 1 << 16).astype(np.int64)
                rows.append((-1, _LOW, block, b"", pack(low)))
        return _rows(rows, _ASKED)

    return run


def _add_low(t: pa.Table) -> pa.Table:
    low = sum(unpack(x, np.int64) for x in t.column("counts").to_pylist())
    return pa.table({"part": pa.array([t.column("part")[0].as_py()], pa.int32()), "counts": pa.array([pack(low)], pa.binary())})


_SUMS = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def _add(t: pa.Table) -> pa.Table:
    """Of one bucket and part: the distinct words and grams that its rows hold, and the sums of their counts."""
    out = []
    for kind in (_WORDS, _GRAMS):
        mine = [(k, c) for x, k, c in zip(*(t.column(c).to_pylist() for c in ("kind", "keys", "counts")), strict=True) if x == kind]
        if mine:
            keys, counts = _distinct([(unpack(k, np.uint64, True), unpack(c, np.uint32).astype(np.int64)) for k, c in mine])
            out.append((t.column("bucket")[0].as_py(), kind, t.column("part")[0].as_py(), pack(keys, True), pack(counts.astype(np.uint32))))
    return _rows(out, _SUMS)


_SOLVED = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()), ("values", pa.binary())])


def _solve(low: np.ndarray):
    def run(t: pa.Table) -> pa.Table:
        """Of one bucket with all its sums: the counts of its words and the code lengths of its grams."""
        out = []
        for bucket, kind, k, c in zip(*(t.column(c).to_pylist() for c in ("bucket", "kind", "keys", "counts")), strict=True):
            keys, counts = unpack(k, np.uint64, True), unpack(c, np.uint32).astype(np.int64)
            if kind == _WORDS:
                values = counts.astype(np.uint32)
                out.append((bucket, _TOTALS, b"", np.array([counts.sum(), (counts > 0).sum()], np.int64).tobytes()))
            else:
                seen = counts > 0
                values = Model(keys[seen], counts[seen], low).log10(keys).astype(np.float32)
            out.append((bucket, kind, k, pack(values)))
        return _rows(out, _SOLVED)

    return run


_ANSWERS = pa.schema([("block", pa.int32()), ("kind", pa.int32()), ("bucket", pa.int32()), ("values", pa.binary())])


def _answer(asked: pa.Table, solved: pa.Table) -> pa.Table:
    """Of one bucket and part: the values of what each block sent, in its own order."""
    out, known = [], {}
    for kind, k, v in zip(*(solved.column(c).to_pylist() for c in ("kind", "keys", "values")), strict=True):
        known[kind] = unpack(k, np.uint64, True), unpack(v, np.uint32 if kind == _WORDS else np.float32)
    for bucket, kind, block, k in zip(*(asked.column(c).to_pylist() for c in ("bucket", "kind", "block", "keys")), strict=True):
        keys, values = known[kind]
        out.append((block, kind, bucket, pack(values[np.searchsorted(keys, unpack(k, np.uint64, True))])))
    return _rows(out, _ANSWERS)


class Model:
    """A part of the trie: training grams of the longest order with their counts, closed under falling back to contexts
    of two bytes, and the counts of all pairs of bytes for the contexts of one byte and none."""

    def __init__(self, code: np.ndarray, count: np.ndarray, low: np.ndarray):
        self.order: list = [None] * (ORDER + 1)
        pairs = np.flatnonzero(low).astype(np.uint64)
        singles = low.reshape(256, 256).sum(axis=0)
        levels = {1: (pairs, low[pairs.astype(np.int64)]), 0: (np.flatnonzero(singles).astype(np.uint64), singles[singles > 0])}
        for j in range(ORDER, 1, -1):
            code, count = merge(code & _mask(j + 1), count)
            levels[j] = (code, count)
        for j in range(ORDER + 1):
            k, c = levels[j][0], levels[j][1].astype(np.float64)
            ctx = k >> _BYTE
            at = np.flatnonzero(np.concatenate([[True], ctx[1:] != ctx[:-1]])) if len(k) else np.empty(0, np.int64)
            n = np.add.reduceat(c, at) if len(at) else np.empty(0)
            d = np.diff(np.append(at, len(k))).astype(np.float64)
            x = np.zeros(len(at))
            if j and len(k):
                # What the context's own bytes weigh one order down, to be excluded there.
                below, weight = self.order[j - 1][:2]
                x = np.add.reduceat(weight[np.searchsorted(below, k & _mask(j))], at)
            self.order[j] = (k, c, ctx[at], n, d, x)

    def log10(self, code: np.ndarray) -> np.ndarray:
        """log10 probability of each gram's last byte after its context."""
        p, left = np.zeros(len(code)), np.arange(len(code))
        out_n, out_d = np.zeros(len(code)), np.zeros(len(code))
        for j in range(ORDER, -1, -1):
            k, c, ctx, n, d, x = self.order[j]
            mine = code[left] & _mask(j + 1)
            if not len(ctx):
                continue
            at = np.minimum(np.searchsorted(ctx, mine >> _BYTE), len(ctx) - 1)
            seen = ctx[at] == mine >> _BYTE
            total, kinds = np.where(seen, n[at] - out_n[left], 0), np.where(seen, d[at] - out_d[left], 0)
            e = np.minimum(np.searchsorted(k, mine), len(k) - 1)
            hit = seen & (k[e] == mine)
            useful = kinds > 0
            with np.errstate(divide="ignore", invalid="ignore"):
                step = np.where(hit, np.log10(c[e] / (total + kinds)), np.where(useful, np.log10(kinds / (total + kinds)), 0.0))
            p[left] += step
            out_n[left], out_d[left] = np.where(seen, x[at], out_n[left]), np.where(seen, d[at], out_d[left])
            left = left[~hit]
        p[left] -= np.log10(256 - out_d[left])
        return p


def lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """values of wanted keys, all of which are present in the sorted keys: a hash table, then a search for the clashes."""
    bits = max(4, int(np.ceil(np.log2(len(keys) + 1))) + 2)
    shift = np.uint64(64 - bits)
    slots = np.zeros(1 << bits, np.int32)
    slots[(keys * _MUL) >> shift] = np.arange(len(keys), dtype=np.int32)
    at = slots[(wanted * _MUL) >> shift]
    odd = np.flatnonzero(keys[at] != wanted)
    at[odd] = np.searchsorted(keys, wanted[odd])
    return values[at]


_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def _score(total: int, distinct: int, n: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _SCORED.empty_table()
        ids, train, bodies = docs.column("doc_id").to_pylist(), np.array(docs.column("train").to_pylist(), np.int64), texts(docs.column("text").combine_chunks())
        (words, _), (codes, _) = _contents(bodies, train)
        got = {(k, b): v for k, b, v in zip(*(answers.column(c).to_pylist() for c in ("kind", "bucket", "values")), strict=True)}
        counts, lengths = np.zeros(len(words)), np.zeros(len(codes))
        for kind, keys, out, dtype in ((_WORDS, words, counts, np.uint32), (_GRAMS, codes, lengths, np.float32)):
            for bucket, at in _split(kind, keys, n):
                out[at] = unpack(got[kind, bucket], dtype)
        hashes, floor = WordHashes(), np.log10(1 / (total + distinct + 1))
        word_score, word_known = np.log10(counts + 1) + floor, (counts > 0).astype(np.float64)
        out = []
        for lo, hi in _pieces(bodies):
            part = bodies[lo:hi]
            lists = [np.append(hashes.of(b.lower().split()), END) for b in part]
            at = lookup(words, np.arange(len(words)), np.concatenate(lists))
            first = np.cumsum([0] + [len(x) for x in lists[:-1]])
            code, start = grams(part)
            out.append(
                pa.record_batch(
                    [
                        pa.array(ids[lo:hi], pa.int64()),
                        pa.array(train[lo:hi] == 0),
                        pa.array([len(x) for x in lists], pa.int64()),
                        pa.array(np.add.reduceat(word_known[at], first).astype(np.int64)),
                        pa.array(np.add.reduceat(word_score[at], first)),
                        pa.array(np.add.reduceat(lookup(codes, lengths, code), start)),
                    ],
                    schema=_SCORED,
                )
            )
        return pa.Table.from_batches(out, _SCORED)

    return run


def score(spark: SparkSession, docs: DataFrame, train: F.Column, block_bytes: int = 16 << 20, width: int = 64) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of docs (doc_id, text).

    Rows where `train` is true are learned from; null counts as false, so a row is held out when its fold is unknown. Null and empty texts are scored as the end
    alone. Words are told apart by 64-bit hashes. Repeated rows are learned from and scored as often as they come;
    an empty table gives no row, and without training rows every byte has probability 1/256. Other columns are
    dropped. Blocks are a hash of the row, of about block_bytes of text each; a block holds a row of any length whole.
    Code lengths travel as 32-bit floats, so a score is exact to about seven digits.
    """
    d = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.coalesce(train, F.lit(False)).alias("train"))
    n_bytes = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n, n_blocks = n_shuffle(spark), max(n_shuffle(spark), -(-n_bytes // block_bytes))
    d = d.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int"))
    asked = cut(spark, d.groupBy("block").applyInArrow(_ask(n), ASKED), "asked")
    tables = [asked]
    low = asked.where(F.col("kind") == _LOW).withColumn("part", (F.col("block") % 256).cast("int"))
    for some in (256, 1):  # sums of sums, so that no task adds up more than a few hundred
        low = low.withColumn("part", (F.col("part") % some).cast("int")).groupBy("part").applyInArrow(_add_low, "part int, counts binary")
    found = low.select("counts").collect()
    pairs = unpack(found[0][0], np.int64) if found else np.zeros(1 << 16, np.int64)
    sent = asked.where(F.col("bucket") >= 0)
    # Sums of sums, `width` at a time, up to one row of each kind in each bucket.
    parts, sums = n_blocks, sent.withColumnRenamed("block", "part")
    while parts > 1 or len(tables) == 1:
        parts = -(-parts // width)
        sums = sums.withColumn("part", F.floor(F.col("part") / width).cast("int")).groupBy("bucket", "part").applyInArrow(_add, "bucket int, kind int, part int, keys binary, counts binary")
        sums = cut(spark, sums, "sums")
        tables.append(sums)
    solved = cut(spark, sums.groupBy("bucket").applyInArrow(_solve(pairs), "bucket int, kind int, keys binary, values binary"), "solved")
    # A bucket's values go to every part of some blocks that ask; the parts grow with the blocks, so both numbers stay low.
    wide = max(width, math.isqrt(n_blocks))
    here = solved.where(F.col("kind") != _TOTALS).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit((n_blocks - 1) // wide))))
    asking = sent.withColumn("part", F.floor(F.col("block") / wide).cast("int")).groupBy("bucket", "part")
    answers = cut(spark, asking.cogroup(here.groupBy("bucket", "part")).applyInArrow(_answer, "block int, kind int, bucket int, values binary"), "answers")
    # One row of two numbers for each bucket.
    found = [np.frombuffer(r["values"], np.int64) for r in solved.where(F.col("kind") == _TOTALS).select("values").collect()]
    total, distinct = (int(x) for x in np.sum(found, axis=0)) if found else (0, 0)
    forget(spark, *tables, solved)
    scored = d.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score(total, distinct, n), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark, table(spark, sf_dir, "documents"), crc_mod("doc_id", 7) != 2)
