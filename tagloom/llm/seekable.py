"""Token-id files: independent zstandard frames with a trailing seek table.

A file is a row of zstandard frames in the public seekable layout. Each data frame holds some documents:

    u32 document count n | u8[n] id is null | i64[n] doc_id | u32[n] token count | u32[...] ids, little-endian

After the data frames come two skippable frames: a document index (for each frame: null flag, first doc_id and
document count) and the seek table (for each frame: compressed size, plain size, low half of the XXH64 of the
plain bytes). When documents are in ascending doc_id order, nulls first, a reader finds the frames of a document
in the index and decompresses those alone; in a file of another order, which the index marks beside the null flag,
it has to go through all frames.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import xxhash
import zstandard

#: Fixed values of the seekable format, and the skippable frame used for the document index.
SEEK_MAGIC, SKIP_SEEK, SKIP_INDEX = 0x8F92EAB1, 0x184D2A5E, 0x184D2A50
NULL_ID = -(2**63)
#: Bits of the index's flag byte: the frame's first doc_id is null; the file's doc_ids are not in ascending order.
NULL_FIRST, UNORDERED = 1, 2


class Writer:
    """Appends (doc_id, ids as little-endian u32 bytes) to a binary stream; close() writes index and seek table."""

    def __init__(self, out, frame_bytes: int = 1 << 18, level: int = 3):
        self.out, self.limit = out, frame_bytes
        self.zip = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.table, self.index, self.docs, self.held = [], [], [], 0
        self.last, self.ordered = NULL_ID, True
        self.n_docs = self.n_tokens = self.n_bytes = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        key = NULL_ID if doc_id is None else doc_id
        self.ordered, self.last = self.ordered and key >= self.last, key
        self.docs.append((doc_id, ids))
        self.held += len(ids) + 13
        self.n_docs += 1
        self.n_tokens += len(ids) // 4
        if self.held >= self.limit:
            self._flush()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.n_bytes += len(data)

    def _flush(self) -> None:
        if not self.docs:
            return
        n = len(self.docs)
        ids = np.array([NULL_ID if d is None else d for d, _ in self.docs], "<i8")
        plain = b"".join(
            [struct.pack("<I", n), bytes(d is None for d, _ in self.docs), ids.tobytes(), np.array([len(x) // 4 for _, x in self.docs], "<u4").tobytes(), *(x for _, x in self.docs)]
        )
        packed = self.zip.compress(plain)
        self._put(packed)
        self.table.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.index.append((self.docs[0][0] is None, int(ids[0]), n))
        self.docs, self.held = [], 0

    def close(self) -> None:
        self._flush()
        mark = 0 if self.ordered else UNORDERED
        index = b"".join(struct.pack("<BqI", null * NULL_FIRST | mark, first, n) for null, first, n in self.index)
        self._put(struct.pack("<II", SKIP_INDEX, len(index)) + index)
        seek = b"".join(struct.pack("<III", *x) for x in self.table) + struct.pack("<IBI", len(self.table), 0x80, SEEK_MAGIC)
        self._put(struct.pack("<II", SKIP_SEEK, len(seek)) + seek)


class Reader:
    """Reads a file of Writer from any object with seek(offset), read(n) and a known size."""

    def __init__(self, stream, size: int):
        self.stream, self.size = stream, size
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or not flags & 0x80:
            raise ValueError("no seek table")
        start = size - 9 - 12 * n
        self.table = np.frombuffer(self._at(start, 12 * n), "<u4").reshape(n, 3)
        self.offsets = np.concatenate([[0], np.cumsum(self.table[:, 0], dtype=np.int64)]).astype(np.int64)
        skip, length = struct.unpack("<II", self._at(int(self.offsets[-1]), 8))
        if skip != SKIP_INDEX or length != 13 * n:
            raise ValueError("no document index")
        index = list(struct.iter_unpack("<BqI", self._at(int(self.offsets[-1]) + 8, length)))
        self.index = [(bool(flags & NULL_FIRST), first, n) for flags, first, n in index]
        self.ordered = not any(flags & UNORDERED for flags, _, _ in index)
        self.unzip = zstandard.ZstdDecompressor()

    def _at(self, offset: int, n: int) -> bytes:
        self.stream.seek(offset)
        data = self.stream.read(n)
        if len(data) != n:
            raise ValueError("the file is cut short")
        return data

    def frame(self, k: int) -> list[tuple[int | None, bytes]]:
        """The documents of frame k; raises ValueError when its checksum does not match."""
        size, plain_size, check = map(int, self.table[k])
        try:
            plain = self.unzip.decompress(self._at(int(self.offsets[k]), size), max_output_size=plain_size)
        except zstandard.ZstdError as e:
            raise ValueError(f"frame {k} is damaged") from e
        if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} is damaged")
        n = struct.unpack_from("<I", plain)[0]
        null = plain[4 : 4 + n]
        ids = np.frombuffer(plain, "<i8", n, 4 + n)
        ends = 4 * np.cumsum(np.frombuffer(plain, "<u4", n, 4 + 9 * n), dtype=np.int64) + 4 + 13 * n
        starts = np.concatenate([[4 + 13 * n], ends[:-1]])
        return [(None if null[i] else int(ids[i]), plain[int(starts[i]) : int(ends[i])]) for i in range(n)]

    def documents(self) -> Iterator[tuple[int | None, bytes]]:
        for k in range(len(self.table)):
            yield from self.frame(k)

    def frames_of(self, doc_id: int) -> list[int]:
        """Frames that may hold doc_id: those whose range of first ids covers it, or all of a file of another order."""
        if not self.ordered:
            return list(range(len(self.index)))
        firsts = np.array([NULL_ID if null else first for null, first, _ in self.index], np.int64)
        lo = max(0, int(np.searchsorted(firsts, doc_id, "left")) - 1)
        hi = int(np.searchsorted(firsts, doc_id, "right"))
        return list(range(lo, hi))

    def find(self, doc_id: int) -> list[bytes]:
        """The token bytes of every document with this id; decompresses only the frames that may hold it."""
        return [x for k in self.frames_of(doc_id) for d, x in self.frame(k) if d == doc_id]
