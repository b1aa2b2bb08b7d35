"""PBF element files: blobs are found by their headers, and each task decodes some of them.

A small reader of the protocol-buffer wire format is enough for the few messages used; nothing is generated.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .files import qualified
from .schema import MEMBER

SCHEMA = f"kind string, id bigint, lon double, lat double, refs array<bigint>, members array<{MEMBER}>, tags map<string,string>"


def varint(b: bytes, i: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        x = b[i]
        i += 1
        out |= (x & 0x7F) << shift
        if x < 0x80:
            return out, i
        shift += 7


def signed(n: int) -> int:
    """Zigzag to signed."""
    return (n >> 1) ^ -(n & 1)


def fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a message; values are integers or bytes."""
    i = 0
    while i < len(b):
        key, i = varint(b, i)
        kind = key & 7
        if kind == 0:
            v, i = varint(b, i)
        elif kind == 2:
            n, i = varint(b, i)
            v, i = b[i : i + n], i + n
        elif kind == 1:
            v, i = b[i : i + 8], i + 8
        elif kind == 5:
            v, i = b[i : i + 4], i + 4
        else:
            raise ValueError(f"wire type {kind} is not known")
        yield key >> 3, v


def packed(b: bytes, delta: bool = False, zigzag: bool = False) -> list[int]:
    out, i, last = [], 0, 0
    while i < len(b):
        v, i = varint(b, i)
        v = signed(v) if zigzag else v
        last = last + v if delta else v
        out.append(last)
    return out


def message(b: bytes) -> dict[int, list]:
    out: dict[int, list] = {}
    for k, v in fields(b):
        out.setdefault(k, []).append(v)
    return out


def int64(n: int) -> int:
    return n - (1 << 64) if n >= 1 << 63 else n


def blobs(stream) -> Iterator[tuple[str, int, int]]:
    """(type, offset, size) of the blobs of a file, reading headers alone."""
    at = 0
    while True:
        stream.seek(at)
        head = stream.read(4)
        if len(head) < 4:
            return
        n = struct.unpack(">I", head)[0]
        m = message(stream.read(n))
        size = m[3][0]
        yield m[1][0].decode(), at + 4 + n, size
        at += 4 + n + size


def inflate(b: bytes) -> bytes:
    m = message(b)
    if 1 in m:
        return m[1][0]
    if 3 in m:
        return zlib.decompress(m[3][0])
    raise ValueError("the blob is packed in a way that is not supported")


def header(b: bytes) -> dict:
    """Required features and the replication time stamp (seconds), sequence and url, where given."""
    m = message(inflate(b))
    text = lambda k: [x.decode() for x in m.get(k, [])]
    return {"required": text(4), "timestamp": m.get(32, [None])[0], "sequence": m.get(33, [None])[0], "url": (text(34) or [None])[0]}


def elements(b: bytes) -> Iterator[tuple]:
    """Rows of SCHEMA of one data blob."""
    block = message(inflate(b))
    strings = [x.decode("utf-8", "replace") for x in message(block[1][0]).get(1, [])]
    step, lat0, lon0 = block.get(17, [100])[0], int64(block.get(19, [0])[0]), int64(block.get(20, [0])[0])
    degrees = lambda base, v: 1e-9 * (base + step * v)
    tags = lambda m: {strings[k]: strings[v] for k, v in zip(packed(b"".join(m.get(2, []))), packed(b"".join(m.get(3, []))), strict=True)}
    for group in block.get(2, []):
        for k, v in fields(group):
            m = message(v)
            if k == 1:
                yield "node", signed(m[1][0]), degrees(lon0, signed(m[9][0])), degrees(lat0, signed(m[8][0])), None, None, tags(m)
            elif k == 2:
                ids, lats, lons = (packed(b"".join(m.get(f, [])), True, True) for f in (1, 8, 9))
                kv, at = packed(b"".join(m.get(10, []))), 0
                for i, id_ in enumerate(ids):
                    own = {}
                    while at < len(kv) and kv[at]:
                        own[strings[kv[at]]] = strings[kv[at + 1]]
                        at += 2
                    at += 1
                    yield "node", id_, degrees(lon0, lons[i]), degrees(lat0, lats[i]), None, None, own
            elif k == 3:
                yield "way", int64(m[1][0]), None, None, packed(b"".join(m.get(8, [])), True, True), None, tags(m)
            elif k == 4:
                roles, refs, kinds = packed(b"".join(m.get(8, []))), packed(b"".join(m.get(9, [])), True, True), packed(b"".join(m.get(10, [])))
                yield "relation", int64(m[1][0]), None, None, None, [(t, r, strings[s]) for t, r, s in zip(kinds, refs, roles, strict=True)], tags(m)


def _open(path: str):
    from pyarrow.fs import FileSystem, LocalFileSystem

    fs, p = FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (LocalFileSystem(), path)
    return fs.open_input_file(p)


def read_header(path: str) -> dict:
    """Header of a file given by its local path or by one with a scheme."""
    with _open(path) as f:
        for kind, at, n in blobs(f):
            if kind == "OSMHeader":
                f.seek(at)
                return header(f.read(n))
    raise ValueError("no header blob")


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.bytes = options["path"], int(options.get("partition_bytes", 16 << 20))

    def partitions(self):
        """Neighbouring data blobs up to partition_bytes together."""
        out, now, size = [], [], 0
        with _open(self.path) as f:
            for kind, at, n in blobs(f):
                if kind != "OSMData":
                    continue
                if now and size + n > self.bytes:
                    out.append(InputPartition(now))
                    now, size = [], 0
                now.append((at, n))
                size += n
        return out + [InputPartition(now)] if now or not out else out

    def read(self, partition):
        with _open(self.path) as f:
            for at, n in partition.value:
                f.seek(at)
                rows = list(elements(f.read(n)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], pa.string()),
                        pa.array([r[1] for r in rows], pa.int64()),
                        pa.array([r[2] for r in rows], pa.float64()),
                        pa.array([r[3] for r in rows], pa.float64()),
                        pa.array([r[4] for r in rows], pa.list_(pa.int64())),
                        pa.array([None if r[5] is None else [{"type": t, "ref": x, "role": s} for t, x, s in r[5]] for r in rows], pa.list_(pa.struct([("type", pa.int8()), ("ref", pa.int64()), ("role", pa.string())]))),
                        pa.array([list(r[6].items()) for r in rows], pa.map_(pa.string(), pa.string())),
                    ],
                    ["kind", "id", "lon", "lat", "refs", "members", "tags"],
                )


class PbfSource(DataSource):
    """spark.read.format("tagloom_pbf").load(path), once registered."""

    @classmethod
    def name(cls):
        return "tagloom_pbf"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)


def read_elements(spark: SparkSession, path: str, partition_bytes: int = 16 << 20) -> dict[str, DataFrame]:
    """nodes, ways and relations of a PBF file."""
    spark.dataSource.register(PbfSource)
    d = spark.read.format("tagloom_pbf").option("partition_bytes", partition_bytes).load(qualified(spark, path))
    part = lambda kind, *cols: d.where(F.col("kind") == kind).select("id", *cols, "tags")
    return {"nodes": part("node", "lon", "lat"), "ways": part("way", "refs"), "relations": part("relation", "members")}


# --- writing, for exports and tests ---


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = b""
    while n > 0x7F:
        out += bytes([n & 0x7F | 0x80])
        n >>= 7
    return out + bytes([n])


def _field(k: int, v: int | bytes) -> bytes:
    return _varint(k << 3) + _varint(v) if isinstance(v, int) else _varint(k << 3 | 2) + _varint(len(v)) + v


def _zigzag(n: int) -> int:
    return (n << 1) ^ (n >> 63)


def _deltas(values: list[int]) -> bytes:
    return b"".join(_varint(_zigzag(b - a)) for a, b in zip([0, *values[:-1]], values, strict=True))


def encode_block(rows: list[tuple]) -> bytes:
    """A data block of rows of SCHEMA: nodes densely packed, ways and relations as they are."""
    index: dict[str, int] = {"": 0}
    of = lambda s: index.setdefault(s, len(index))
    nano = lambda v: round(v * 1e7)
    tags = lambda t: _field(2, b"".join(_varint(of(k)) for k in t)) + _field(3, b"".join(_varint(of(v)) for v in t.values()))
    groups = b""
    nodes = [r for r in rows if r[0] == "node"]
    if nodes:
        kv = b"".join(b"".join(_varint(of(k)) + _varint(of(v)) for k, v in r[6].items()) + b"\0" for r in nodes)
        dense = _field(1, _deltas([r[1] for r in nodes])) + _field(8, _deltas([nano(r[3]) for r in nodes])) + _field(9, _deltas([nano(r[2]) for r in nodes])) + _field(10, kv)
        groups += _field(2, _field(2, dense))
    for r in rows:
        if r[0] == "way":
            groups += _field(2, _field(3, _field(1, r[1]) + tags(r[6]) + _field(8, _deltas(r[4]))))
        elif r[0] == "relation":
            m = r[5]
            body = _field(8, b"".join(_varint(of(x[2])) for x in m)) + _field(9, _deltas([x[1] for x in m])) + _field(10, b"".join(_varint(x[0]) for x in m))
            groups += _field(2, _field(4, _field(1, r[1]) + tags(r[6]) + body))
    strings = b"".join(_field(1, s.encode()) for s in index)
    return _field(1, strings) + groups


def encode_file(blocks: list[bytes], timestamp: int | None = None) -> bytes:
    head = _field(4, b"OsmSchema-V0.6") + _field(4, b"DenseNodes") + (_field(32, timestamp) if timestamp is not None else b"")
    out = b""
    for kind, data in [(b"OSMHeader", head), *((b"OSMData", b) for b in blocks)]:
        blob = _field(2, len(data)) + _field(3, zlib.compress(data))
        h = _field(1, kind) + _field(3, len(blob))
        out += struct.pack(">I", len(h)) + h + blob
    return out
