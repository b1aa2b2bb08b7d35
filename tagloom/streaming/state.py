"""Replication state: the last sequence applied, where to start after an import, and waiting between attempts."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass
from datetime import UTC, datetime, timedelta

from pyspark.sql import SparkSession

#: First and longest wait between attempts, in seconds.
FIRST_WAIT, LONGEST_WAIT = 2.0, 300.0


@dataclass(frozen=True)
class Replication:
    seq: int
    time: str
    url: str = ""


def save(spark: SparkSession, folder: str, state: Replication) -> None:
    """Write last.state.json by a rename, in any store that Spark reaches."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/last.state.json")
    part = jvm.org.apache.hadoop.fs.Path(f"{folder}/.last.state.json")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(part, True)
    out.write(bytearray(json.dumps(asdict(state)).encode()))
    out.close()
    fs.delete(path, False)
    fs.rename(part, path)


def load(spark: SparkSession, folder: str) -> Replication | None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/last.state.json")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    return Replication(**json.loads("\n".join(r[0] for r in spark.read.text(path.toString()).collect())))


def start_sequence(current: int, current_time: datetime, data_time: datetime, interval: timedelta, before: timedelta) -> int:
    """The sequence to start from so that nothing since data_time, less a safety margin, is missed."""
    steps = lambda d: math.ceil(d / interval)
    return current - steps(current_time - data_time) - steps(before)


def after_import(header: dict, files: list, interval: timedelta, before: timedelta) -> Replication | None:
    """Where changes start for an import: at the sequence in the file's header, or at one reckoned from its time and from
    the newest change file; None when the header has neither."""
    if header.get("sequence") is not None:
        return Replication(header["sequence"], "", header.get("url") or "")
    if header.get("timestamp") is None or not files:
        return None
    data, newest = datetime.fromtimestamp(header["timestamp"], UTC), max(files)
    return Replication(start_sequence(newest.seq, newest.time, data, interval, before), data.isoformat())


def waits(first: float = FIRST_WAIT, longest: float = LONGEST_WAIT) -> Iterator[float]:
    """Waits between attempts, each twice the one before."""
    w = first
    while True:
        yield w
        w = min(w * 2, longest)


def retry(f: Callable[[], object], attempts: int, sleep: Callable[[float], None]) -> object:
    """Call f until it succeeds, waiting in between; the last error is raised."""
    for n, w in zip(range(attempts), waits(), strict=False):
        try:
            return f()
        except Exception:
            if n + 1 == attempts:
                raise
            sleep(w)
    return None
