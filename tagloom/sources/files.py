"""Files by the store that they are in, as Spark names them, and the sequences that their names give."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import SparkSession


@dataclass(frozen=True, order=True)
class ChangeFile:
    seq: int
    path: str
    time: datetime


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme; without one it is in Spark's default store, as Spark's own readers have it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return re.sub("^file:/+", "file:///", out)


def listed(spark: SparkSession, pattern: str) -> list[tuple[str, datetime]]:
    """(path, time of modification) of the files that a path or pattern names, or that lie in a folder, in order of names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, out = list(fs.globStatus(p) or ()), []
    while found:
        f = found.pop()
        if f.isDirectory():
            found += [x for x in fs.listStatus(f.getPath()) if not x.getPath().getName().startswith((".", "_"))]
        else:
            out.append((f.getPath().toString(), datetime.fromtimestamp(f.getModificationTime() / 1000, UTC)))
    return sorted(out)


def sequence_of(path: str) -> int:
    """The number of a change file: that of its name and the two folders above when all three are three digits, else the
    last number in its name; 0 without one."""
    *folders, name = path.rstrip("/").split("/")[-3:]
    stem = name.split(".")[0]
    parts = [*folders, stem]
    if len(parts) == 3 and all(re.fullmatch(r"\d{3}", x) for x in parts):
        return int("".join(parts))
    numbers = re.findall(r"\d+", stem)
    return int(numbers[-1]) if numbers else 0


def change_files(spark: SparkSession, folder: str) -> list[ChangeFile]:
    """The change files of a folder and those below it, by sequence."""
    return sorted(ChangeFile(sequence_of(p), p, t) for p, t in listed(spark, folder) if ".osc" in p.rsplit("/", 1)[-1])


def next_files(files: list[ChangeFile], last_seq: int | None, most: int) -> list[ChangeFile]:
    """The unbroken run of files that follows the last sequence, or that starts at the least one; at most `most`.

    Files after a gap wait until the missing one is there.
    """
    out: list[ChangeFile] = []
    for f in files:
        if last_seq is not None and f.seq <= last_seq:
            continue
        if last_seq is not None and f.seq != last_seq + 1 or len(out) == most:
            break
        out.append(f)
        last_seq = f.seq
    return out
