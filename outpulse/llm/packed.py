"""Messages between document parts and hash shards.

A part is a group of documents of bounded bytes, chosen by hash. Parts and
shards exchange sorted key lists as one binary value per (part, shard): gaps
between neighbours, split into byte planes, so that Spark's shuffle moves few
bytes a key and no row per word. A list never has more keys than its part has
words; with many parts and shards it shrinks to single keys.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_BYTES = 8 << 20


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts; one narrow pass."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(text).cast("long")), F.lit(0))).first()[0]


def part_count(total_bytes: int, part_bytes: int = PART_BYTES) -> int:
    return max(1, math.ceil(total_bytes / part_bytes))


def part_of(parts: int, *columns: str) -> Column:
    """Part of a row, the same in every rerun. Equal rows share a part; rows with ids of their own spread."""
    return F.pmod(F.xxhash64(*columns), F.lit(parts).cast("long")).cast("int")


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending uint64 keys as byte planes of their gaps; the first byte is the number of planes."""
    gaps = np.diff(keys, prepend=np.zeros(1, np.uint64))
    planes = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    return bytes([planes]) + gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()


def unpack_sorted(value: bytes) -> np.ndarray:
    planes = value[0]
    raw = np.frombuffer(value, np.uint8, offset=1).reshape(planes, -1)
    full = np.zeros((raw.shape[1], 8), np.uint8)
    full[:, :planes] = raw.T
    return np.cumsum(full.view("<u8").ravel(), dtype=np.uint64)


def pack_flags(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unpack_flags(value: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(value, np.uint8), count=n).astype(bool)


def shard_runs(keys: np.ndarray, key_bits: int, shard_bits: int) -> list[tuple[int, int, int]]:
    """(shard, from, to) of the runs of ascending keys that share their top bits."""
    if not len(keys):
        return []
    shards = keys >> np.uint64(key_bits - shard_bits)
    cuts = np.flatnonzero(np.diff(shards)) + 1
    edges = [0, *cuts.tolist(), len(keys)]
    return [(int(shards[a]), a, b) for a, b in zip(edges, edges[1:], strict=False)]


def column(table: pa.Table, name: str) -> list:
    return table.column(name).to_pylist()
