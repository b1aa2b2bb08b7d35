"""Element XML and gzip or plain change XML."""

from __future__ import annotations

import gzip
from collections.abc import Iterator
from io import BytesIO
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import listed
from .schema import CHANGES, MEMBER_TYPES

_TAG = "tag array<struct<_k:string,_v:string>>"


def _tags() -> Column:
    """The last value of a repeated key counts."""
    pairs = F.coalesce(F.col("tag"), F.expr("cast(array() as array<struct<_k:string,_v:string>>)"))
    keys = F.array_distinct(F.transform(pairs, lambda t: t["_k"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(pairs, lambda t: t["_k"] == k), -1)["_v"]))


def read_elements(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """nodes, ways and relations of element XML; the row tags split large files between tasks."""
    read = lambda tag, schema: spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)
    nodes = read("node", f"_id bigint, _lon double, _lat double, {_TAG}")
    ways = read("way", f"_id bigint, nd array<struct<_ref:bigint>>, {_TAG}")
    relations = read("relation", f"_id bigint, member array<struct<_type:string,_ref:bigint,_role:string>>, {_TAG}")
    empty = F.expr("cast(array() as array<bigint>)")
    code = F.create_map(*[F.lit(x) for kv in MEMBER_TYPES.items() for x in kv])
    members = F.transform("member", lambda m: F.struct(F.try_element_at(code, m["_type"]).cast("tinyint").alias("type"), m["_ref"].alias("ref"), F.coalesce(m["_role"], F.lit("")).alias("role")))
    return {
        "nodes": nodes.select(F.col("_id").alias("id"), F.col("_lon").alias("lon"), F.col("_lat").alias("lat"), _tags().alias("tags")),
        "ways": ways.select(F.col("_id").alias("id"), F.coalesce(F.transform("nd", lambda n: n["_ref"]), empty).alias("refs"), _tags().alias("tags")),
        "relations": relations.select(F.col("_id").alias("id"), F.coalesce(members, F.expr("cast(array() as array<struct<type:tinyint,ref:bigint,role:string>>)")).alias("members"), _tags().alias("tags")),
    }


def parse_changes(data: bytes, seq: int) -> list[tuple]:
    """Change XML, gzip or plain, to rows in document order."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    rows, action = [], None
    for event, e in ElementTree.iterparse(BytesIO(data), events=("start", "end")):
        if event == "start":
            if e.tag in ("create", "modify", "delete"):
                action = e.tag
        elif e.tag in MEMBER_TYPES and action:
            number = lambda k: float(e.get(k)) if e.get(k) is not None else None  # noqa: B023, E731
            tags = {t.get("k"): t.get("v") for t in e.iter("tag")}
            refs = [int(n.get("ref")) for n in e.iter("nd")] if e.tag == "way" else None
            members = [(MEMBER_TYPES[m.get("type")], int(m.get("ref")), m.get("role") or "") for m in e.iter("member")] if e.tag == "relation" else None
            rows.append((seq, len(rows), action, e.tag, int(e.get("id")), number("lon"), number("lat"), refs, members, tags))
            e.clear()
    return rows


def changes_of(files: DataFrame, seqs: dict[str, int]) -> DataFrame:
    """Rows of change files (path, content), one task for each file; seqs gives the sequence of each path."""
    names = ["seq", "ord", "action", "kind", "id", "lon", "lat", "refs", "members", "tags"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                yield pd.DataFrame(parse_changes(content, seqs[path]), columns=names)

    return files.select("path", "content").mapInPandas(run, CHANGES)


def read_changes(spark: SparkSession, paths: str | list[str], first_seq: int = 0) -> DataFrame:
    """Change files to one table; seq follows the order of the paths, and of names where one of them is a pattern or a
    folder; ord is the order in each file."""
    found = [p for x in ([paths] if isinstance(paths, str) else paths) for p, _ in listed(spark, x)]
    if not found:
        raise FileNotFoundError(f"no change file at {paths}")
    return read_change_files(spark, {p: first_seq + i for i, p in enumerate(dict.fromkeys(found))})


def read_change_files(spark: SparkSession, seqs: dict[str, int]) -> DataFrame:
    """Change files of known sequences. Files are read by Spark, one task for each, and parsed there."""
    return changes_of(spark.read.format("binaryFile").load(list(seqs)), seqs)
