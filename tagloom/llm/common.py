"""Helpers shared by the text operators: table access, lineage cuts in the shared folder, word splitting."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space that separates words; bytes.split() splits on the same six characters.
WS = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a local session, whose
    executors are in the driver, gets a temporary folder; a cluster has to name one."""
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
        d = "file://" + tempfile.mkdtemp(prefix="tagloom-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def fresh_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


#: Shuffle files of a query are removed when it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(spark: SparkSession, df: DataFrame, tag: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: a lineage cut that outlives executors.

    The step's shuffle files go with its end, as nothing reads them after the write.
    """
    path, before = fresh_path(spark, tag), spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def forget(spark: SparkSession, *dfs: DataFrame) -> None:
    """Delete the tables of cut() that no later step reads."""
    for df in dfs:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.cut_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_names(taken: list[str], *wanted: str) -> list[str]:
    """Names like the wanted ones that are not taken, in any case of letters."""
    used, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def n_shuffle(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def clear_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """Bound Arrow batches by rows and bytes, so that long texts cannot fill a worker."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return df


def crc_mod(col: str, m: int) -> F.Column:
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(m)


def texts(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [x or b"" for x in col.cast(pa.large_binary()).to_pylist()]


class WordHashes(dict):
    """Word bytes to 64-bit hash; emptied when it holds too many words, so its memory stays bounded."""

    LIMIT = 250_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))
