"""Token-ID output: documents in doc_id order, or one given, to seekable zstandard files, one for each range partition."""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import clear_batches, cut, fresh_path, n_shuffle, table, texts
from .seekable import Reader, Writer
from .token_counts import byte_alphabet


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Words of printable ASCII, and of Latin letters, that the pre-tokens can be cut from by a plain pattern: no apostrophe
#: (contractions), no "<" (special tokens), no control characters or other white space.
_ASCII = re.compile(rb"[!-&(-;=-~]+")
_LATIN = re.compile("[!-&(-;=-~\u00a1-\u012f\u0131-\u024f]+")
_ASCII_PIECES = re.compile(rb"[a-z]+|[0-9]|[^a-z0-9]+")
_LATIN_PIECES = regex.compile(r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


class _Pieces(dict):
    """Ids of single pre-tokens in normal form: the model alone, on the characters that stand for their bytes."""

    def __init__(self, tokenizer, limit: int):
        super().__init__()
        self.model, self.limit = tokenizer.model, limit
        self.shown = {b: c for c, b in byte_alphabet().items()}

    def __missing__(self, piece: bytes) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        text = piece.decode() if piece.isascii() else piece.decode("latin-1").translate(self.shown)
        out = self[piece] = np.array([t.id for t in self.model.tokenize(text)], "<u4").tobytes()
        return out


class WordEncoder(dict):
    """Ids of words, as little-endian u32 bytes; texts are encoded word by word, each distinct word once.

    Right for tokenizers that lower-case, drop white space and cut at letters, digits and the rest, as the pre-tokens
    then never hold white space and the normaliser never joins characters across it. Words of Latin letters share the
    ids of their lower-case pre-tokens, of which more are kept, as they recur more; all others are encoded whole. Both
    stores are emptied when they are full.
    """

    def __init__(self, path: str, limit: int = 150_000, pieces: int = 400_000):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pieces, self.limit = _Pieces(self.tokenizer, pieces), limit

    def __missing__(self, word: bytes) -> bytes:
        get = self.pieces.__getitem__
        if _ASCII.fullmatch(word):
            out = b"".join(map(get, _ASCII_PIECES.findall(word.lower())))
        elif _LATIN.fullmatch(text := word.decode()):
            out = b"".join([get(p.encode()) for p in _LATIN_PIECES.findall(text.lower())])
        else:
            out = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[word] = out
        return out

    def encode(self, docs: list[bytes]) -> list[bytes]:
        get = self.__getitem__
        return [b"".join(map(get, d.split())) for d in docs]


class TextEncoder:
    """Ids of whole texts, for tokenizers of any form."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)

    def encode(self, docs: list[bytes]) -> list[bytes]:
        return [np.array(self.tokenizer.encode(d.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes() for d in docs]


#: The form of tokenizers whose texts can be encoded word by word.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def by_words(path: str) -> bool:
    """Whether a tokenizer has the form that WordEncoder is right for."""
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    steps = (d.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}]
    split = steps[0].get("type") == "Split" and steps[0].get("pattern") == {"Regex": _SPLIT} and steps[0].get("behavior") == "Removed" and steps[0].get("invert") is True
    level = len(steps) == 2 and steps[1].get("type") == "ByteLevel" and not steps[1].get("add_prefix_space") and steps[1].get("use_regex") is False
    plain = d["model"].get("type") == "BPE" and not d["model"].get("dropout") and not d.get("truncation") and not d.get("padding")
    added = all("<" in t["content"] and not any(t[k] for k in ("lstrip", "rstrip", "single_word", "normalized")) for t in d.get("added_tokens", []))
    return d.get("normalizer") == _NORMALIZER and split and level and plain and added


@lru_cache(maxsize=1)
def encoder(path: str) -> WordEncoder | TextEncoder:
    """One for each worker process, so that tasks share what is known."""
    return WordEncoder(path) if by_words(path) else TextEncoder(path)


def _pieces(items: list[bytes], limit: int = 8 << 20) -> Iterator[slice]:
    """Consecutive slices of about `limit` bytes."""
    start, n = 0, 0
    for i, x in enumerate(items):
        if i > start and n + len(x) > limit:
            yield slice(start, i)
            start, n = i, 0
        n += len(x)
    if start < len(items):
        yield slice(start, len(items))


def write_tokens(spark: SparkSession, docs: DataFrame, folder: str, tokenizer: str, end_id: int, frame_bytes: int = 1 << 18, order: str | None = None) -> DataFrame:
    """Encode and write docs (doc_id, text); the manifest (shard, path, n_docs, n_tokens, n_bytes, start) is returned.

    Shards are ranges of doc_id, so their order is document order; equal ids are ordered by xxhash64 of text, and then by
    text. With `order`, a column of docs without ties, they are ranges of it. A shard is written under a name of its own
    and then renamed, so a task that is run again replaces it by the same bytes; what lost tasks have left is removed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, writer, end = TaskContext.get().partitionId(), None, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                words = encoder(tokenizer)
                fs, base = FileSystem.from_uri(folder)
                fs.create_dir(base, recursive=True)
                part = f"{base}/.{shard:06d}-{uuid.uuid4().hex}"
                out = fs.open_output_stream(part)
                writer = Writer(out, frame_bytes)
            ids, bodies = batch.column("doc_id").to_pylist(), texts(batch.column("text"))
            for s in _pieces(bodies):
                for doc_id, x in zip(ids[s], words.encode(bodies[s]), strict=True):
                    writer.add(doc_id, x + end)
        if writer is not None:
            writer.close()
            out.close()
            fs.move(part, f"{base}/{shard:06d}.tok")
            yield pa.record_batch(
                [pa.array([x]) for x in (shard, f"{folder}/{shard:06d}.tok", writer.n_docs, writer.n_tokens, writer.n_bytes)], ["shard", "path", "n_docs", "n_tokens", "n_bytes"]
            )

    d = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *([F.col(order).alias("_at")] if order else []))
    if order:
        d = d.repartitionByRange(n_shuffle(spark), "_at").sortWithinPartitions("_at")
    else:
        d = d.withColumn("_at", F.xxhash64("text"))
        d = d.repartitionByRange(n_shuffle(spark), "doc_id", "_at").sortWithinPartitions("doc_id", "_at", "text")
    made = clear_batches(d.select("doc_id", "text")).mapInArrow(run, "shard long, path string, n_docs long, n_tokens long, n_bytes long")
    # One row for each file, so the driver holds a few numbers for each file and no more.
    rows, start = [], 0
    for r in sorted(cut(spark, made, "manifest").collect()):
        rows.append((*r, start))
        start += r["n_tokens"]
    remove_parts(spark, folder)
    schema = T.StructType([T.StructField(c, T.StringType() if c == "path" else T.LongType()) for c in ("shard", "path", "n_docs", "n_tokens", "n_bytes", "start")])
    return spark.createDataFrame(rows, schema)


def remove_parts(spark: SparkSession, folder: str) -> None:
    """Delete the files that tasks did not live to rename."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for f in fs.listStatus(path) if fs.exists(path) else ():
        if f.getPath().getName().startswith("."):
            fs.delete(f.getPath(), False)


def read_tokens(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Every document of the files: (doc_id, start, n_tokens, ids_crc32, shard)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = FileSystem.from_uri(row["path"])
                with fs.open_input_file(path) as f:
                    reader, start = Reader(f, f.size()), row["start"]
                    for k in range(len(reader.table)):
                        docs = reader.frame(k)
                        n = np.array([len(x) // 4 for _, x in docs], np.int64)
                        yield pa.record_batch(
                            [pa.array([d for d, _ in docs], pa.int64()), pa.array(start + np.cumsum(n) - n), pa.array(n), pa.array([zlib.crc32(x) for _, x in docs], pa.int64()), pa.array([row["shard"]] * len(docs), pa.int64())],
                            ["doc_id", "start", "n_tokens", "ids_crc32", "shard"],
                        )
                        start += int(n.sum())

    files = manifest.repartition(n_shuffle(spark), "shard").select("shard", "path", "start")
    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, shard long")


def token_output(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Write docs (doc_id, text) as token files and return, read from them, one row for each document.

    doc_id, start (tokens of all documents before it), n_tokens (with the end id), ids_crc32. Null text is an empty
    text: the end id alone. Null doc_ids come first. Repeated rows are written as often as they come. An empty table
    gives no file and no row. Other columns are not read.
    """
    folder = folder or fresh_path(spark, "tokens")
    return read_tokens(spark, write_tokens(spark, docs, folder, tokenizer or tokenizer_path(), end_id)).drop("shard")


def ordered_token_output(spark: SparkSession, docs: DataFrame, order: str, tokenizer: str | None = None, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """token_output() with files in the order of `order`, a column of docs without ties; adds file_start.

    file_start is the number of tokens before the document in the files, so it follows `order`; start still counts
    those of the documents of lesser doc_id (of equal ids, of those earlier in the files).
    """
    folder = folder or fresh_path(spark, "tokens")
    d = read_tokens(spark, write_tokens(spark, docs, folder, tokenizer or tokenizer_path(), end_id, order=order)).drop("shard").withColumnRenamed("start", "file_start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column("n_tokens").to_numpy()
            at = start + np.cumsum(n) - n
            start += int(n.sum())
            yield pa.record_batch([*batch.columns, pa.array(at, pa.int64()), pa.array([part] * len(n), pa.int64())], [*batch.schema.names, "_start", "_part"])

    d = d.repartitionByRange(n_shuffle(spark), "doc_id", "file_start").sortWithinPartitions("doc_id", "file_start")
    d = cut(spark, d.mapInArrow(run, "doc_id long, file_start long, n_tokens long, ids_crc32 long, _start long, _part long"), "starts")
    # One row for each partition.
    rows, start = [], 0
    for part, n in sorted(tuple(r) for r in d.groupBy("_part").agg(F.sum("n_tokens")).collect()):
        rows.append((part, start))
        start += n
    before = spark.createDataFrame(rows, "_part long, _before long")
    return d.join(F.broadcast(before), "_part").select("doc_id", (F.col("_before") + F.col("_start")).alias("start"), "n_tokens", "ids_crc32", "file_start")


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(spark, table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
