"""The engine: read elements, build and generalise tables, apply changes, deploy, look up."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import kernel
from .operators import changes as ch
from .operators import lookup as lk
from .operators.generalize import base_table, build_order, generalize, generalize_one
from .operators.limit import Limit
from .operators.sinks import ParquetSink, Router, write_tiles
from .operators.tables import Elements, TableBuilder, prepare
from .plans.mapping import Mapping
from .sources import pbf, xml


@dataclass
class Engine:
    """One mapping over one store. state_dir holds numbered versions of elements and rows for applying changes."""

    spark: SparkSession
    mapping: Mapping
    srid: int = 3857
    limit_path: str | None = None
    limit_buffer: float = 0.0
    state_dir: str | None = None
    tiles_dir: str | None = None
    tiles_zoom: int = 14
    limit: Limit | None = None
    last_seq: int | None = field(default=None, init=False)

    def __post_init__(self):
        if self.srid not in (3857, 4326):
            raise ValueError("srid must be 3857 or 4326")
        if not 6 <= self.tiles_zoom <= 18:
            self.tiles_zoom = 14
        kernel.register(self.spark)
        if self.limit is None and self.limit_path:
            self.limit = Limit.load(self.spark, self.limit_path, self.srid, self.limit_buffer)
        self.builder = TableBuilder(self.spark, self.mapping, self.srid, self.limit)

    @staticmethod
    def open(spark: SparkSession, mapping_path: str | Path, **options) -> Engine:
        return Engine(spark, Mapping.load(mapping_path), **options)

    # --- reading ---

    def read(self, path: str) -> Elements:
        """Elements of a .pbf or XML file, as reading keeps them: filtered tags, storage precision, near the limit."""
        source = pbf if path.endswith(".pbf") else xml
        return prepare(Elements(**source.read_elements(self.spark, path)), self.mapping, self.limit if self.limit_buffer else None)

    def append(self, old: Elements, new: Elements) -> Elements:
        """Elements of several files; the later one wins."""
        from .operators.sinks import merge_last

        return Elements(*(merge_last(getattr(old, k), getattr(new, k)) for k in ("nodes", "ways", "relations", "coords")))

    # --- tables ---

    def tables(self, elements: Elements) -> dict[str, DataFrame]:
        return self.builder.build(elements)

    def generalize(self, tables: dict[str, DataFrame], chained: bool = True) -> dict[str, DataFrame]:
        return generalize(self.mapping, tables, chained)

    def write(self, sink: ParquetSink, elements: Elements) -> None:
        """Build and store all tables, then the generalised ones from what was stored.

        Steps that several tables read are stored beside them while the tables are built, so that ways are resolved once.
        """
        names = [*self.mapping.tables, *self.mapping.generalized]
        router = Router(sink, names)
        router.write(self.builder.build(elements, sink.hold))
        stored = {n: sink.read(n) for n in self.mapping.tables}
        for g in build_order(self.mapping):
            router.write({g.name: generalize_one(stored[g.source], base_table(self.mapping, g.name), g)})
            stored[g.name] = sink.read(g.name)
        sink.release()

    # --- changes ---

    def _version_path(self, version: int, name: str) -> str:
        return f"{self.state_dir}/v{version:08d}/{name}"

    def _versions(self) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.state_dir)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        done = lambda p: fs.exists(jvm.org.apache.hadoop.fs.Path(p, "complete"))
        return sorted(int(s.getPath().getName()[1:]) for s in fs.listStatus(root) if s.getPath().getName().startswith("v") and done(s.getPath()))

    def save(self, state: ch.State, stored: set[str] = frozenset()) -> int:
        """Store a state as the next version, but for parts that are there already; it counts once its marker is written."""
        version = (self._versions() or [0])[-1] + 1
        e = state.elements
        for name, df in {"nodes": e.nodes, "ways": e.ways, "relations": e.relations, "coords": e.coords, **{f"table_{n}": t for n, t in state.tables.items()}}.items():
            if name not in stored:
                df.write.mode("overwrite").parquet(self._version_path(version, name))
        self.spark.createDataFrame([(state.last_seq,)], "last_seq bigint").coalesce(1).write.mode("overwrite").parquet(self._version_path(version, "complete"))
        return version

    def load(self, version: int | None = None) -> ch.State:
        version = version or self._versions()[-1]
        read = lambda name: self.spark.read.parquet(self._version_path(version, name))
        elements = Elements(read("nodes"), read("ways"), read("relations"), read("coords"))
        return ch.State(elements, {n: read(f"table_{n}") for n in [*self.mapping.tables, *self.mapping.generalized]}, read("complete").first()[0])

    def start(self, elements: Elements, last_seq: int | None = None) -> int:
        """The first version; changes follow from last_seq on, or from whatever comes first."""
        state = ch.initial_state(self.builder, elements)
        state.last_seq = last_seq
        return self.save(state)

    def apply(self, changes: DataFrame, force: bool = False, keep: int = 2) -> int:
        """Apply changes to the last version and store the next one; older versions than `keep` are removed.

        The tiles of what was affected, before and after, go to tiles_dir.
        """
        old = self.load()
        if ch.after_sequence(changes, old.last_seq, force).isEmpty():
            return self._versions()[-1]
        following, stored = self._versions()[-1] + 1, set()

        def cut(name: str, df: DataFrame) -> DataFrame:
            df.write.mode("overwrite").parquet(self._version_path(following, name))
            stored.add(name)
            return self.spark.read.schema(df.schema).parquet(self._version_path(following, name))

        new, ids = ch.apply_changes(self.builder, old, changes, force, cut=cut)
        version = self.save(new, stored)
        if self.tiles_dir:
            stored = self.load(version)
            tiles = ch.stale_tiles(self.builder, old.elements, ids, self.tiles_zoom).union(ch.stale_tiles(self.builder, stored.elements, ids, self.tiles_zoom))
            write_tiles(tiles, self.tiles_dir)
        jvm = self.spark.sparkContext._jvm
        for v in self._versions()[:-keep]:
            p = jvm.org.apache.hadoop.fs.Path(f"{self.state_dir}/v{v:08d}")
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        return version

    def current_tables(self) -> dict[str, DataFrame]:
        """Rows of the last version, generalised tables among them, without their origins."""
        return {n: df.drop("_kind", "_eid") for n, df in self.load().tables.items()}

    # --- lookups ---

    def lookup(self, elements: Elements, kind: str, ids: list[int], full: bool = False, deps: bool = False) -> DataFrame:
        return lk.lookup(self.spark, elements, kind, ids, full, deps)


def optimize(df: DataFrame, partitions: int) -> DataFrame:
    """Cluster rows of a table with a geometry along a space-filling curve of the middle of their boxes."""
    from .operators.sinks import spatial_order

    name = next(f.name for f in df.schema if f.dataType.simpleString() == "binary")
    b = kernel.bounds(F.col(name))
    x, y = (F.get(b, F.lit(0)) + F.get(b, F.lit(2))) / 2, (F.get(b, F.lit(1)) + F.get(b, F.lit(3))) / 2
    return spatial_order(df, x / 111319.49, y / 222638.98, partitions)
