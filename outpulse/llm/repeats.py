"""Removal of passages that occur more than once, behind a count-min sketch of all windows.

Method. Documents are dealt by hash into parts of bounded bytes. Pass one:
every part counts its windows in a count-min sketch of its own (two rows, as
many cells as the corpus has bytes, times four), kept sparse; cell ranges are
merged over parts by sums, and a part learns which of its cells hold two or
more. Such a count is never too small, so a window of which a cell holds one
occurs once. Pass two: only windows whose cells all hold two or more are
grouped exactly, by 96 bits of two independent hashes. Pass three marks the
words of windows that occur twice or more.

The three passes read one shuffle of the texts. A window that occurs anywhere
in a part is sent once by that part, so a passage in a third of all documents
costs one key per part, and nothing is capped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outpulse.llm.packed import (
    PART_BYTES,
    column,
    pack_flags,
    pack_sorted,
    part_count,
    part_of,
    shard_runs,
    text_bytes,
    unpack_flags,
    unpack_sorted,
)
from outpulse.llm.words import Words, slices, windows

ROWS = 2
CELLS_PER_BYTE = 4
_MESSAGE = "slot long, part int, n int, cells binary, twice binary, tail binary"
_REPLY = "part int, slot long, flags binary"


def _windows(texts: pa.Table, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Both 64-bit keys of every window of a part."""
    keys = ([], [])
    for piece in slices(texts, "text"):
        words = Words(piece.column("text"))
        hashes = words.hashes()
        for kind in range(ROWS):
            keys[kind].append(windows(hashes, words.row, length, kind)[1])
    return tuple(np.concatenate(k) if k else np.zeros(0, np.uint64) for k in keys)


def _messages(part: int, row: int, keys: np.ndarray, key_bits: int, shard_bits: int, twice: np.ndarray,
              tail: np.ndarray | None = None) -> Iterator[tuple]:
    for shard, a, b in shard_runs(keys, key_bits, shard_bits):
        yield (
            (row << shard_bits) + shard, part, b - a, pack_sorted(keys[a:b]), pack_flags(twice[a:b]),
            tail[a:b].astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() if tail is not None else b"",
        )


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * len(schema),
                                                    schema.types, strict=True)], schema=schema)


_MESSAGE_ARROW = pa.schema([("slot", pa.int64()), ("part", pa.int32()), ("n", pa.int32()),
                            ("cells", pa.binary()), ("twice", pa.binary()), ("tail", pa.binary())])
_REPLY_ARROW = pa.schema([("part", pa.int32()), ("slot", pa.int64()), ("flags", pa.binary())])


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = 35,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``docs``' rows as (id, n_words, n_removed, kept): texts without the words of repeated windows.

    A window is ``length`` consecutive words (runs of bytes that are not ASCII
    white space) of one row; it is repeated if its words also start anywhere
    else, same row included. ``kept`` joins the other words by one space. Null
    and empty texts have no words; texts shorter than a window lose nothing;
    equal rows count as different documents, so both lose what they share. One
    row per input row; other columns of ``docs`` are not read.
    """
    docs = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("text"))
    total = text_bytes(docs)
    parts = part_count(total, part_bytes)
    shard_bits = max(0, math.ceil(math.log2(parts)))
    cell_bits = max(10, shard_bits, math.ceil(math.log2(max(1, CELLS_PER_BYTE * total))))
    dealt = docs.withColumn("part", part_of(parts, "_id", "text"))
    # Twice the shards, as few keys of a part reach the exact grouping.
    exact_bits = max(0, shard_bits - 1)

    def cells(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.unique(keys >> np.uint64(64 - cell_bits), return_inverse=True, return_counts=True)

    def sketch(key: tuple, texts: pa.Table) -> pa.Table:
        part, rows = key[0].as_py(), []
        for row, keys in enumerate(_windows(texts, length)):
            found, _, n = cells(keys)
            rows += _messages(part, row, found, cell_bits, shard_bits, n > 1)
        return _table(rows, _MESSAGE_ARROW)

    def merge(key: tuple, messages: pa.Table) -> pa.Table:
        sizes = column(messages, "n")
        found = np.concatenate([unpack_sorted(c) for c in column(messages, "cells")])
        n = np.concatenate([unpack_flags(t, k) for t, k in zip(column(messages, "twice"), sizes, strict=True)])
        _, place = np.unique(found, return_inverse=True)
        repeated = (np.bincount(place, n + 1.0) >= 2)[place]
        flags = [pack_flags(f) for f in np.split(repeated, np.cumsum(sizes)[:-1])]
        return pa.table([messages.column("part"), messages.column("slot"), pa.array(flags, pa.binary())],
                        schema=_REPLY_ARROW)

    def candidates(key: tuple, texts: pa.Table, replies: pa.Table) -> pa.Table:
        part, both = key[0].as_py(), _windows(texts, length)
        flags = dict(zip(column(replies, "slot"), column(replies, "flags"), strict=True))
        open_ = np.ones(len(both[0]), dtype=bool)
        for row, keys in enumerate(both):
            found, place, _ = cells(keys)
            repeated = np.zeros(len(found), dtype=bool)
            for shard, a, b in shard_runs(found, cell_bits, shard_bits):
                repeated[a:b] = unpack_flags(flags[(row << shard_bits) + shard], b - a)
            open_ &= repeated[place]
        head, tail = both[0][open_], both[1][open_] >> np.uint64(32)
        order = np.lexsort((tail, head))
        head, tail = head[order], tail[order]
        first = np.ones(len(head), dtype=bool)
        first[1:] = (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])
        n = np.diff(np.append(np.flatnonzero(first), len(head)))
        return _table(list(_messages(part, 0, head[first], 64, exact_bits, n > 1, tail[first])), _MESSAGE_ARROW)

    def exact(key: tuple, messages: pa.Table) -> pa.Table:
        sizes = column(messages, "n")
        heads = [unpack_sorted(c) for c in column(messages, "cells")]
        tails = [np.frombuffer(t, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel() for t in column(messages, "tail")]
        twice = [unpack_flags(t, k) for t, k in zip(column(messages, "twice"), sizes, strict=True)]
        head, tail, n = np.concatenate(heads), np.concatenate(tails), np.concatenate(twice) + 1
        order = np.lexsort((tail, head))
        h, t = head[order], tail[order]
        first = np.ones(len(h), dtype=bool)
        first[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
        group = np.cumsum(first) - 1
        repeated = np.empty(len(h), dtype=bool)
        repeated[order] = (np.bincount(group, n[order]) >= 2)[group]
        rows = []
        for part, h, t, keep in zip(column(messages, "part"), heads, tails, np.split(repeated, np.cumsum(sizes)[:-1]),
                                    strict=True):
            if keep.any():
                planes = t[keep].astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
                rows.append((0, part, int(keep.sum()), pack_sorted(h[keep]), b"", planes))
        return _table(rows, _MESSAGE_ARROW)

    def cut(key: tuple, texts: pa.Table, repeated: pa.Table) -> pa.Table:
        heads = [unpack_sorted(c) for c in column(repeated, "cells")]
        tails = [np.frombuffer(t, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel() for t in column(repeated, "tail")]
        head = np.concatenate(heads) if heads else np.zeros(0, np.uint64)
        tail = np.concatenate(tails) if tails else np.zeros(0, np.uint32)
        order = np.lexsort((tail, head))
        head, tail = head[order], tail[order]
        out = []
        for piece in slices(texts, "text"):
            words = Words(piece.column("text"))
            out.append(_kept(piece, words, _marked(words, head, tail, length)))
        return pa.concat_tables(out)

    sketches = dealt.groupBy("part").applyInArrow(sketch, _MESSAGE)
    replies = sketches.groupBy("slot").applyInArrow(merge, _REPLY)
    found = dealt.groupBy("part").cogroup(replies.groupBy("part")).applyInArrow(candidates, _MESSAGE)
    repeated = found.groupBy("slot").applyInArrow(exact, _MESSAGE)
    id_type = docs.schema["_id"].dataType.simpleString()
    kept = dealt.groupBy("part").cogroup(repeated.groupBy("part")).applyInArrow(
        cut, f"_id {id_type}, n_words long, n_removed long, kept string"
    )
    return kept.withColumnRenamed("_id", id_column)


def _marked(words: Words, head: np.ndarray, tail: np.ndarray, length: int) -> np.ndarray:
    """Which words lie in a window whose keys are among the sorted (head, tail) pairs."""
    marked = np.zeros(len(words.start) + 1, dtype=np.int64)
    if len(head):
        hashes = words.hashes()
        at, first = windows(hashes, words.row, length, 0)
        hit = np.flatnonzero(head[np.minimum(np.searchsorted(head, first), len(head) - 1)] == first)
        if len(hit):
            second = (windows(hashes, words.row, length, 1)[1][hit] >> np.uint64(32)).astype(np.uint32)
            place, left = np.searchsorted(head, first[hit]), np.ones(len(hit), dtype=bool)
            same = np.zeros(len(hit), dtype=bool)
            while left.any():  # almost always one step: heads that differ in the tail follow one another
                inside = place < len(head)
                here = np.minimum(place, len(head) - 1)
                left &= inside & (head[here] == first[hit])
                same |= left & (tail[here] == second)
                place = place + 1
                left &= ~same
            at = at[hit[same]]
            np.add.at(marked, at, 1)
            np.add.at(marked, at + length, -1)
    return np.cumsum(marked[:-1]) > 0


def _kept(rows: pa.Table, words: Words, removed: np.ndarray) -> pa.Table:
    """Texts of the words that stay, one space between two of them."""
    keep = np.flatnonzero(~removed)
    start, end, row = words.start[keep], words.end[keep], words.row[keep]
    edge = np.zeros(len(words.data) + 1, dtype=np.int8)
    edge[start] += 1
    edge[end] -= 1
    stay = np.cumsum(edge[:-1], dtype=np.int8) > 0
    more = np.flatnonzero(row[1:] == row[:-1])
    data = words.data.copy()
    data[end[more]] = 0x20
    stay[end[more]] = True
    offsets = np.concatenate(([0], np.cumsum(stay)))[words.offsets]
    texts = pa.Array.from_buffers(pa.large_string(), words.rows, [None, pa.py_buffer(offsets.astype(np.int64)),
                                                                  pa.py_buffer(data[stay])])
    n = np.bincount(words.row, minlength=words.rows)
    gone = np.bincount(words.row[removed], minlength=words.rows)
    ids = rows.column("_id")
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    return pa.table({"_id": ids, "n_words": n.astype(np.int64), "n_removed": gone.astype(np.int64),
                     "kept": texts.cast(pa.string())})
