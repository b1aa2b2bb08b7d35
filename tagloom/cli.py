"""Command line: import, diff, run, optimize and lookup.

    python -m tagloom.cli import --mapping m.yml --store /data --state-dir /state --read a.pbf --write --deploy
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from . import config
from .engine import Engine, optimize
from .operators.sinks import ParquetSink
from .operators.tables import Elements
from .plans.mapping import Mapping
from .sources import pbf
from .sources.files import change_files, qualified, sequence_of
from .sources.xml import read_changes
from .streaming import state as rs
from .streaming.stream import stream_changes


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tagloom", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--config")
    for name in ("store", "mapping", "state-dir", "limit-to", "expire-tiles-dir", "replication-interval", "diff-state-before", "schema-import", "schema-production", "schema-backup", "prefix"):
        common.add_argument(f"--{name}")
    common.add_argument("--srid", type=int)
    common.add_argument("--limit-to-buffer", type=float)
    common.add_argument("--expire-tiles-zoom", type=int)
    i = sub.add_parser("import", parents=[common])
    i.add_argument("--read")
    i.add_argument("--changes", help="folder of change files, to reckon from it where changes start")
    for name in ("write", "diff", "deploy", "revert", "remove-backup", "append", "overwrite"):
        i.add_argument(f"--{name}", action="store_true")
    d = sub.add_parser("diff", parents=[common])
    d.add_argument("files", nargs="+")
    d.add_argument("--force", action="store_true")
    r = sub.add_parser("run", parents=[common])
    r.add_argument("folder")
    r.add_argument("--once", action="store_true")
    r.add_argument("--commit-latest", type=int, default=10, metavar="N", help="change files that are committed together")
    r.add_argument("--attempts", type=int, default=8)
    z = sub.add_parser("optimize", parents=[common])
    z.add_argument("--partitions", type=int, default=64)
    q = sub.add_parser("lookup", parents=[common])
    q.add_argument("kind", choices=("node", "way", "relation"))
    q.add_argument("ids", nargs="+", type=int)
    q.add_argument("--full", action="store_true")
    q.add_argument("--deps", action="store_true")
    return p


def rename(spark: SparkSession, source: str, target: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(path(target), True)
    fs.rename(path(source), path(target))


def publish(engine: Engine, sink: ParquetSink, names: list[str]) -> None:
    """Store the tables of the last version and put them in place."""
    for name, df in engine.current_tables().items():
        sink.write(name, df)
    sink.deploy(names)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    o = config.load(a.config, vars(a))
    spark = spark or SparkSession.builder.appName("tagloom").getOrCreate()
    engine = Engine(spark, Mapping.load(o.mapping), o.srid, o.limit_to or None, o.limit_to_buffer, o.state_dir, o.expire_tiles_dir or None, o.expire_tiles_zoom)
    sink = ParquetSink(spark, o.store, o.prefix or None, o.schema_import, o.schema_production, o.schema_backup)
    names = [*engine.mapping.tables, *engine.mapping.generalized]
    cache = f"{o.state_dir}/elements"
    stored = lambda: Elements(*(spark.read.parquet(f"{cache}/{k}") for k in ("nodes", "ways", "relations", "coords")))
    if a.command == "import":
        config.check_import(a.read, a.write, a.deploy, a.revert, a.remove_backup, a.append, a.overwrite)
        if a.read:
            e = engine.read(a.read)
            if a.append:
                e = engine.append(stored(), e)
            fresh = f"{cache}-new" if a.append else cache
            for k in ("nodes", "ways", "relations", "coords"):
                getattr(e, k).write.mode("overwrite" if a.overwrite or a.append else "errorifexists").parquet(f"{fresh}/{k}")
            if a.append:
                rename(spark, fresh, cache)
        if a.write:
            engine.write(sink, stored())
        if a.diff:
            header = pbf.read_header(qualified(spark, a.read)) if a.read and a.read.endswith(".pbf") else {}
            at = rs.after_import(header, change_files(spark, a.changes) if a.changes else [], o.replication_interval, o.diff_state_before)
            engine.start(stored(), at and at.seq)
            if at:
                rs.save(spark, o.state_dir, at)
        if a.deploy:
            sink.deploy(names)
        if a.revert:
            sink.revert(names)
        if a.remove_backup:
            sink.remove_backup(names)
    elif a.command == "diff":
        for f in a.files:
            engine.apply(read_changes(spark, f, sequence_of(f)), a.force)
        publish(engine, sink, names)
    elif a.command == "run":
        stream_changes(spark, engine, a.folder, f"{o.state_dir}/stream", a.commit_latest, a.once, a.attempts).awaitTermination()
        publish(engine, sink, names)
    elif a.command == "optimize":
        for name in names:
            if sink.exists(name, o.schema_production) and "binary" in dict(sink.read(name, o.schema_production).dtypes).values():
                sink.write(name, optimize(sink.read(name, o.schema_production), a.partitions))
                sink.deploy([name])
    else:
        e = engine.load().elements if engine._versions() else stored()
        for r in engine.lookup(e, a.kind, a.ids, a.full, a.deps).toLocalIterator():
            print(r["json"] or "null")
    return 0


if __name__ == "__main__":
    sys.exit(main())
