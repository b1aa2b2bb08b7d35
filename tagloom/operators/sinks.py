"""Where rows go: Parquet tables under schema folders, with rotation between them, and tile files."""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import ewkb_hex

DEFAULT_PREFIX = "osm_"


def table_prefix(option: str | None) -> str:
    """Prefix of table names: the default, none for NONE, and always with an underscore at its end."""
    if option is None or option == "":
        return DEFAULT_PREFIX
    if option == "NONE":
        return ""
    return option if option.endswith("_") else option + "_"


def merge_last(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Appending to stored elements: a new row replaces the one of the same id."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def spatial_order(df: DataFrame, lon: Column, lat: Column, partitions: int) -> DataFrame:
    """Rows clustered along a space-filling curve, so that Parquet statistics prune boxes: 16 bits of lon and lat, interleaved."""

    def spread(v: Column) -> Column:
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask).cast("long"))
        return v

    cell = lambda v, low, high: F.floor(F.least(F.greatest((v - low) / (high - low), F.lit(0.0)), F.lit(1.0)) * 65535).cast("long")
    code = F.shiftleft(spread(cell(lon, -180.0, 180.0)), 1).bitwiseOR(spread(cell(lat, -90.0, 90.0)))
    return df.withColumn("_z", code).repartitionByRange(partitions, "_z").sortWithinPartitions("_z").drop("_z")


class Sink:
    """A way to store tables."""

    def write(self, name: str, df: DataFrame, mode: str = "overwrite") -> None:
        raise NotImplementedError

    def hold(self, name: str, df: DataFrame) -> DataFrame:
        """A step that several tables read, stored where the sink can store it."""
        return df

    def release(self) -> None:
        """Drop the steps held."""


class NullSink(Sink):
    """Computes rows and drops them."""

    def write(self, name: str, df: DataFrame, mode: str = "overwrite") -> None:
        df.write.format("noop").mode("overwrite").save()


class ParquetSink(Sink):
    """Tables as folders root/schema/prefix_name. Schemas are rotated by renaming folders."""

    def __init__(self, spark: SparkSession, root: str, prefix: str | None = None, schema: str = "import", production: str = "public", backup: str = "backup", hex_geometry: int | None = None):
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), table_prefix(prefix)
        self.schema, self.production, self.backup, self.hex_geometry = schema, production, backup, hex_geometry

    def _path(self, schema: str, name: str = ""):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{schema}" + (f"/{self.prefix}{name}" if name else ""))
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str, schema: str | None = None) -> str:
        return self._path(schema or self.schema, name)[0].toString()

    def exists(self, name: str, schema: str | None = None) -> bool:
        p, fs = self._path(schema or self.schema, name)
        return fs.exists(p)

    def write(self, name: str, df: DataFrame, mode: str = "overwrite") -> None:
        if self.hex_geometry is not None:
            df = df.withColumns({f.name: ewkb_hex(F.col(f.name), self.hex_geometry) for f in df.schema if f.dataType.simpleString() == "binary"})
        df.write.mode(mode).parquet(self.path(name))

    def read(self, name: str, schema: str | None = None) -> DataFrame:
        return self.spark.read.parquet(self.path(name, schema))

    def _step(self, name: str) -> str:
        return f"{self.root}/{self.schema}/_steps/{name}"

    def hold(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(self._step(name))
        return self.spark.read.schema(df.schema).parquet(self._step(name))

    def release(self) -> None:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._step("x")).getParent()
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def _move(self, names: list[str], source: str, target: str, backup: str | None) -> None:
        """Move tables from source to target; what is there goes to backup. Tables missing in the source are skipped."""
        for name in names:
            src, fs = self._path(source, name)
            if not fs.exists(src):
                continue
            dst, _ = self._path(target, name)
            if backup is not None and fs.exists(dst):
                old, _ = self._path(backup, name)
                fs.delete(old, True)
                fs.mkdirs(old.getParent())
                fs.rename(dst, old)
            fs.delete(dst, True)
            fs.mkdirs(dst.getParent())
            fs.rename(src, dst)

    def deploy(self, names: list[str]) -> None:
        """Import tables go to production, production tables to backup."""
        self._move(names, self.schema, self.production, self.backup)

    def revert(self, names: list[str]) -> None:
        """Production tables go back to import, backup tables to production."""
        self._move(names, self.production, self.schema, None)
        self._move(names, self.backup, self.production, None)

    def remove_backup(self, names: list[str]) -> None:
        for name in names:
            p, fs = self._path(self.backup, name)
            fs.delete(p, True)


SINKS: dict[str, Callable[..., Sink]] = {"parquet": ParquetSink, "null": lambda *a, **k: NullSink()}


def open_sink(kind: str, *args, **options) -> Sink:
    if kind not in SINKS:
        raise ValueError(f"unknown sink {kind}")
    return SINKS[kind](*args, **options)


class Router:
    """Rows to tables by name; an unknown name is an error."""

    def __init__(self, sink: Sink, names: list[str]):
        self.sink, self.names = sink, set(names)

    def write(self, tables: dict[str, DataFrame], mode: str = "overwrite") -> None:
        for name, df in tables.items():
            if name not in self.names:
                raise KeyError(f"unknown table {name}")
            self.sink.write(name, df, mode)


def write_tiles(tiles: DataFrame, folder: str, now: datetime | None = None) -> str | None:
    """z/x/y lines to folder/YYYYMMDD/HHMMSS.mmm.tiles on the driver, by an atomic rename; nothing for no tiles.

    Lines stream to the file, so the driver holds one partition of tiles at a time.
    """
    now = now or datetime.now(UTC)
    rows = tiles.select("z", "x", "y").distinct().orderBy("z", "x", "y").toLocalIterator()
    first = next(rows, None)
    if first is None:
        return None
    day = os.path.join(folder, now.strftime("%Y%m%d"))
    os.makedirs(day, exist_ok=True)
    path = os.path.join(day, now.strftime("%H%M%S.") + f"{now.microsecond // 1000:03d}.tiles")
    with open(path + "~", "w") as f:
        f.write("%d/%d/%d\n" % tuple(first))
        f.writelines("%d/%d/%d\n" % tuple(r) for r in rows)
    os.rename(path + "~", path)
    return path
