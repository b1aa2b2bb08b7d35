"""Change files as a stream: each micro-batch applies the unbroken run of next sequences to the state."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..engine import Engine
from ..sources.files import change_files, next_files
from ..sources.xml import read_change_files
from . import state as rs


def apply_next(spark: SparkSession, engine: Engine, folder: str, max_files: int = 10, attempts: int = 1, sleep: Callable[[float], None] = time.sleep) -> int | None:
    """Apply the files that follow the state's sequence, max_files in one version, and return the last sequence.

    Files come in any order of time: those after a gap wait for the missing one. A failed step is tried again, after
    longer and longer waits. The state file is written after each version.
    """
    while True:
        last = engine.load().last_seq
        run = next_files(change_files(spark, folder), last, max_files)
        if not run:
            return last
        rs.retry(lambda: engine.apply(read_change_files(spark, {f.path: f.seq for f in run})), attempts, sleep)  # noqa: B023
        rs.save(spark, engine.state_dir, rs.Replication(run[-1].seq, run[-1].time.isoformat(), folder))


def stream_changes(spark: SparkSession, engine: Engine, folder: str, checkpoint: str, max_files: int = 10, once: bool = False, attempts: int = 1) -> StreamingQuery:
    """Follow a folder of change files. A new file is what starts a micro-batch; what is applied is worked out from the
    folder and the engine's saved state, so a repeated micro-batch is harmless, and so are files that come late.
    max_files is how many files are committed together."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").load(folder)

    def apply(batch: DataFrame, batch_id: int) -> None:
        apply_next(spark, engine, folder, max_files, attempts)

    w = files.select("path").writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply)
    return (w.trigger(availableNow=True) if once else w).start()
