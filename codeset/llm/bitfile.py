"""Files of token ids in as few bits each as the vocabulary needs.

Layout, little-endian: magic, width and ids per block; the blocks, each of
``BLOCK_IDS`` ids (the last one shorter); then the byte offset of each block
and of the end, the documents' first ids and the end, their keys and null
flags; a trailer with the sizes and the magic.  As blocks begin at whole
bytes, a range of ids is read by seeking to its blocks.
"""

from __future__ import annotations

import struct

import numpy as np
from pyarrow import fs

MAGIC = b"BITIDS01"
HEADER = struct.Struct("<8sII")
TRAILER = struct.Struct("<QQQQ8s")
BLOCK_IDS = 1 << 16  # a multiple of 8, so that blocks fill whole bytes


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and inner path of a folder all tasks reach."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def bits_needed(size: int) -> int:
    """Bits of the largest id of a vocabulary."""
    return max(1, (size - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def unpack(data: bytes, width: int, count: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", count).astype("<u4")
    raw = np.frombuffer(data, np.uint8)
    bits = np.unpackbits(raw, count=count * width, bitorder="little")
    scale = np.left_shift(np.uint32(1), np.arange(width, dtype=np.uint32))
    return (bits.reshape(count, width) * scale).sum(1, dtype=np.uint32).astype("<u4")


class Writer:
    """Takes the ids of documents in order and writes full blocks as they come."""

    def __init__(self, path: str, width: int):
        store, inner = open_store(path)
        self.file, self.width = store.open_output_stream(inner), width
        self.file.write(HEADER.pack(MAGIC, width, BLOCK_IDS))
        self.offsets, self.waiting = [HEADER.size], np.zeros(0, np.uint32)
        self.keys, self.nulls, self.starts = [], [], [np.zeros(1, np.uint64)]
        self.count = 0

    def add(self, ids: np.ndarray, bounds: np.ndarray, keys, nulls) -> None:
        """``bounds`` cuts ``ids`` into the documents of ``keys``."""
        if ids.size and int(ids.max()) >> self.width:
            raise ValueError(f"an id needs more than {self.width} bits")
        self.starts.append((bounds[1:] + self.count).astype(np.uint64))
        self.keys.append(np.asarray(keys, np.int64))
        self.nulls.append(np.asarray(nulls, np.uint8))
        self.count += len(ids)
        self.waiting = np.concatenate([self.waiting, ids])
        full = len(self.waiting) // BLOCK_IDS * BLOCK_IDS
        for at in range(0, full, BLOCK_IDS):
            self.block(self.waiting[at : at + BLOCK_IDS])
        self.waiting = self.waiting[full:]

    def block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.width)
        self.file.write(data)
        self.offsets.append(self.offsets[-1] + len(data))

    def close(self) -> None:
        if len(self.waiting):
            self.block(self.waiting)
        starts = np.concatenate(self.starts)
        self.file.write(np.array(self.offsets, "<u8").tobytes())
        self.file.write(starts.astype("<u8").tobytes())
        for part, kind in ((self.keys, "<i8"), (self.nulls, "u1")):
            self.file.write(np.concatenate([np.zeros(0, kind), *part]).astype(kind).tobytes())
        sizes = (self.offsets[-1], len(self.offsets) - 1, len(starts) - 1, self.count)
        self.file.write(TRAILER.pack(*sizes, MAGIC))
        self.file.close()


class Reader:
    """Random access to the ids of a file."""

    def __init__(self, path: str):
        store, inner = open_store(path)
        self.file = store.open_input_file(inner)
        end = self.file.size() - TRAILER.size
        footer, blocks, docs, self.count, magic = TRAILER.unpack(
            self.file.read_at(TRAILER.size, end)
        )
        first, self.width, self.block_ids = HEADER.unpack(self.file.read_at(HEADER.size, 0))
        if magic != MAGIC or first != MAGIC:
            raise ValueError(f"{path} is not a whole file of token ids")
        index = self.file.read_at(end - footer, footer)
        cuts = np.cumsum([0, 8 * (blocks + 1), 8 * (docs + 1), 8 * docs, docs])
        parts = [index[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        self.offsets = np.frombuffer(parts[0], "<u8").astype(np.int64)
        self.starts = np.frombuffer(parts[1], "<u8").astype(np.int64)
        self.keys = np.frombuffer(parts[2], "<i8")
        self.nulls = np.frombuffer(parts[3], "u1").astype(bool)

    def ids(self, begin: int, end: int) -> np.ndarray:
        """The ids from ``begin`` up to ``end``, from the blocks that hold them."""
        if begin >= end:
            return np.zeros(0, "<u4")
        low, high = begin // self.block_ids, -(-end // self.block_ids)
        first, last = int(self.offsets[low]), int(self.offsets[high])
        data = self.file.read_at(last - first, first)
        held = min(high * self.block_ids, self.count) - low * self.block_ids
        ids = unpack(data, self.width, held)
        return ids[begin - low * self.block_ids : end - low * self.block_ids]

    def document(self, number: int) -> np.ndarray:
        return self.ids(int(self.starts[number]), int(self.starts[number + 1]))

    def close(self) -> None:
        self.file.close()
