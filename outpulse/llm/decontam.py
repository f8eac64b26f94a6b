"""Benchmark decontamination by spaced-seed hashing and substitution-tolerant verification.

A fixed mask of selected and ignored token positions slides over test and
training texts; the selected tokens are hashed, so a seed hits although ignored
tokens differ. Training hashes pass a Bloom filter of the test hashes inside the
scan, so only rows with possible hits leave it; those are joined by hash. Every
hit fixes an alignment, of which the whole overlap is measured, mismatches
allowed.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outpulse.llm.words import Words, mix, slices
from outpulse.session import store

# The masks; 1 selects a position. Chosen so that every overlap with an item of ``SPAN`` words or more that is
# reported has a placement of one of them whose selected words are all equal (the tests try all replacements).
MASKS = ("11101111", "111010001011", "11000110111", "101111011", "111101000011", "100010110111", "11110111")
SPAN = max(map(len, MASKS))
#: Equal words that make an overlap, or four of five of a shorter item; and what a differing word takes away,
#: so that at least four of five words of a reported overlap are equal.
OVERLAP, PENALTY = 13, 4
#: Pairs of places of one seed up to which their differences are listed one by one.
PAIRS = 256
#: Bits of the Bloom filter for each test hash, and at most: 2^28 bits are 32 MB whatever the test set.
BLOOM_BITS, BLOOM_MOST, PROBES = 64, 1 << 28, 6


def seeds(hashes: np.ndarray, row: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """First places and hashes of all placements of a mask inside one row."""
    n, span = len(hashes), len(mask)
    if n < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(row[: n - span + 1] == row[span - 1 :])
    total = np.zeros(n - span + 1, np.uint64)
    for j in (j for j, c in enumerate(mask) if c == "1"):
        total += hashes[j : n - span + 1 + j] * np.uint64(2 * hash_factor(j) + 1)
    return at, mix(total[at], int(mask, 2))


def hash_factor(j: int) -> int:
    return (0x9E3779B97F4A7C15 * (2 * j + 3)) >> 1 & (2**62 - 1)


def masks_for(short: list[int]) -> list[tuple[str, int]]:
    """Masks and the length of the items they are for: the fixed ones for items of ``SPAN`` words or more (0), others for shorter.

    A shorter item is cut into blocks, and a mask leaves out as many of them as
    words may differ, so whichever words differ, one mask selects none of them.
    """
    out = {(mask, 0): None for mask in MASKS}
    for n in sorted(short):
        differ = n - needed(n)
        blocks = 1 if differ == 0 else 3 if differ == 1 and n > 5 else 5
        for gone in itertools.combinations(range(blocks), differ):
            out["".join("0" if j * blocks // n in gone else "1" for j in range(n)).strip("0"), n] = None
    return [*out]


def _probes(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for i in range(PROBES):
        yield mix(hashes, 100 + i) & np.uint64(bits - 1)


def _bloom_part(bits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for at in _probes(batch.column("h").to_numpy().view(np.uint64), bits):
                np.bitwise_or.at(table, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        yield pa.RecordBatch.from_pydict({"bits": [table.tobytes()]})

    return run


def _tokens(texts: pa.Array) -> tuple[Words, np.ndarray]:
    words = Words(texts, alnum=True, lower=True)
    return words, mix(words.hashes(), 31)


def _test_side(masks: list[tuple[str, int]]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                words, hashes = _tokens(piece.column("text"))
                per_row, ids, bounds = words.per_row(), piece.column("iid").to_numpy(), words.bounds()
                for mask, n in masks:
                    at, found = seeds(hashes, words.row, mask)
                    meant = per_row[words.row[at]] == n if n else per_row[words.row[at]] >= SPAN
                    at, found = at[meant], found[meant]
                    row = words.row[at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), int(mask, 2), np.int32)), pa.array(found.view(np.int64)), pa.array(ids[row]),
                         pa.array((at - bounds[row]).astype(np.int32))], ["mask", "h", "iid", "item_pos"],
                    )

    return run


def _train_side(masks: list[tuple[str, int]], table: np.ndarray) -> Callable:
    bits, patterns = len(table) * 8, sorted({mask for mask, _ in masks})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                words, hashes = _tokens(piece.column("text"))
                bounds, hits = words.bounds(), []
                for mask in patterns:
                    at, found = seeds(hashes, words.row, mask)
                    for i in range(PROBES):
                        probe = mix(found, 100 + i) & np.uint64(bits - 1)
                        good = (table[(probe >> np.uint64(3)).astype(np.int64)] >> (probe & np.uint64(7)).astype(np.uint8)) & 1 > 0
                        at, found = at[good], found[good]
                    hits.append((np.full(len(at), int(mask, 2), np.int32), found.view(np.int64), at))
                number, found, at = (np.concatenate(c) for c in zip(*hits, strict=True))
                order = np.lexsort((at, found, number, words.row[at]))
                number, found, at = number[order], found[order], at[order]
                row, place = words.row[at], (at - bounds[words.row[at]]).astype(np.int32)
                # One entry for every seed of a text, with all its places.
                same = (row[1:] == row[:-1]) & (number[1:] == number[:-1]) & (found[1:] == found[:-1])
                first = np.flatnonzero(np.append(True, ~same)[: len(at)])
                places = pa.ListArray.from_arrays(pa.array(np.append(first, len(at)).astype(np.int32)), pa.array(place))
                rows = np.unique(row)
                edges = pa.array(np.append(np.searchsorted(row[first], rows), len(first)).astype(np.int32))
                tokens = [hashes[bounds[r] : bounds[r + 1]].tobytes() for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id").take(pa.array(rows)), piece.column("rid").take(pa.array(rows)), pa.array(tokens, pa.binary()),
                     *[pa.ListArray.from_arrays(edges, c) for c in (pa.array(number[first]), pa.array(found[first]), places)]],
                    ["doc_id", "rid", "tokens", "mask", "h", "pos"],
                )

    return run


def distinct_shifts(places: np.ndarray, item_places: np.ndarray) -> np.ndarray:
    """All differences of a place and an item place, each once; memory is that of the span, not of the pairs."""
    few, many, sign = (item_places, places, 1) if len(item_places) <= len(places) else (places, item_places, -1)
    low = int(places.min()) - int(item_places.max())
    there = np.zeros(int(places.max()) - int(item_places.min()) - low + 1, bool)
    for place in few:
        there[sign * (many - place) - low] = True
    return np.flatnonzero(there) + low


def _many_shifts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            one = batch.slice(at, 1)
            places, items = (one.column(c)[0].values.to_numpy() for c in ("pos", "item_pos"))
            shifts = pa.array([distinct_shifts(places, items).astype(np.int32)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([one.column("rid"), one.column("iid"), shifts], ["rid", "iid", "shifts"])


def needed(item_words: int) -> int:
    """Equal words from which an overlap with an item of so many words is reported."""
    return min(OVERLAP, (PENALTY * item_words + PENALTY) // (PENALTY + 1))


def _aligned(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, np.ndarray, np.ndarray]:
    """First item word beside the text, equal words from there, and the running score before each and after the last."""
    a, b = max(0, -shift), min(len(item), len(doc) - shift)
    same = doc[a + shift : b + shift] == item[a:b]
    return a, same, np.concatenate(([0], np.cumsum(np.where(same, 1, -PENALTY))))


def best_overlap(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
    """(equal words, first, end) in the item of the best segment, if the item's word 0 lies on the text's word ``shift``."""
    a, same, total = _aligned(doc, item, shift)
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total - low))
    first = int(np.argmin(total[: end + 1]))
    return int(same[first:end].sum()), a + first, a + end


def whole_overlap(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
    """Like :func:`best_overlap`, of the segment with most equal words among those with four of five equal."""
    a, same, total = _aligned(doc, item, shift)
    equal = np.concatenate(([0], np.cumsum(same)))
    # The widest segment up to each end whose score is not below 0 starts where the lowest score so far first is as low.
    first = np.searchsorted(-np.minimum.accumulate(total), -total)
    end = int(np.argmax(equal - equal[first]))
    start = int(first[end])
    start += int(np.argmax(same[start:end])) if end > start else 0
    return int(equal[end] - equal[start]), a + start, a + end


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep, out = [], []
        cols = [batch.column(c).to_pylist() for c in ("tokens", "item", "shifts")]
        for i, (doc, item, shifts) in enumerate(zip(*cols, strict=True)):
            doc, item = np.frombuffer(doc, np.uint64), np.frombuffer(item, np.uint64)
            found = max((*whole_overlap(doc, item, s), s) for s in shifts)
            if found[0] >= needed(len(item)):
                keep.append(i)
                out.append((found[0], len(item), found[1], found[2], found[1] + found[3]))
        rows = batch.select(["doc_id", "rid", "item_id"]).take(pa.array(keep, pa.int64()))
        for name, values in zip(("matched", "item_words", "item_from", "item_to", "doc_from"), zip(*out, strict=True) if out else [[]] * 5, strict=True):
            rows = rows.append_column(name, pa.array(values, pa.int64()))
        yield rows


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Overlaps of ``docs`` (doc_id, text) with ``benchmark`` items (item_id, text): one row per row of ``docs`` and item.

    (doc_id, rid, item_id, matched, item_words, item_from, item_to, doc_from):
    the largest overlap in words; ``matched`` words are equal, 13 at least or
    four of five of a shorter item, and at least four of five of the overlap.
    Words are runs of letters, digits and non-ASCII characters, A-Z in lower case. Items with the same
    words are one item, named by the smallest id. Null and empty texts on
    either side overlap nothing. Equal rows of ``docs`` give equal results, once.
    An empty benchmark gives no rows.

    The masks leave a hit in every such overlap, whichever words are replaced.
    """
    items = benchmark.where("text IS NOT NULL").select("item_id", "text")
    item_type, doc_type = (df.schema[c].dataType.simpleString() for df, c in ((benchmark, "item_id"), (docs, "doc_id")))

    def item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                words, hashes = _tokens(piece.column("text"))
                bounds = words.bounds()
                tokens = [hashes[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([piece.column("item_id"), piece.column("text"), pa.array(tokens, pa.binary())], ["item_id", "text", "item"])

    items = items.mapInArrow(item_words, f"item_id {item_type}, text string, item binary").where("length(item) > 0")
    items = items.groupBy("item").agg(F.min("item_id").alias("item_id"), F.min("text").alias("text"))
    items = store(items.select(F.xxhash64("item").alias("iid"), "item_id", "item", "text"), "decontam-items")
    words = F.length("item") / 8
    short = [int(r.n) for r in items.where(words < SPAN).select(words.alias("n")).distinct().collect()]
    masks = masks_for(short)
    tests = store(items.mapInArrow(_test_side(masks), "mask int, h long, iid long, item_pos int"), "decontam-seeds")
    bits = min(BLOOM_MOST, 1 << max(10, math.ceil(math.log2(max(1, BLOOM_BITS * tests.count())))))
    table = np.zeros(bits // 8, np.uint8)
    for part in tests.select("h").coalesce(16).mapInArrow(_bloom_part(bits), "bits binary").toLocalIterator():
        table |= np.frombuffer(part.bits, np.uint8)

    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("rid"), "text")
    found = f"doc_id {doc_type}, rid long, tokens binary, mask array<int>, h array<long>, pos array<array<int>>"
    hit = store(rows.mapInArrow(_train_side(masks, table), found), "decontam-hits")
    spots = hit.select("rid", F.explode(F.arrays_zip("mask", "h", "pos")).alias("s")).select("rid", "s.*")
    placed = tests.groupBy("mask", "h", "iid").agg(F.collect_list("item_pos").alias("item_pos"))
    met = spots.join(placed, ["mask", "h"]).select("rid", "iid", "pos", "item_pos")
    # Seeds that stand in a text and in an item again and again give few shifts from many pairs.
    often = F.size("pos").cast("long") * F.size("item_pos") > PAIRS
    each = F.flatten(F.transform("pos", lambda p: F.transform("item_pos", lambda q: p - q)))
    few = met.where(~often).select("rid", "iid", each.alias("shifts"))
    many = met.where(often).mapInArrow(_many_shifts, "rid long, iid long, shifts array<int>")
    both = few.unionByName(many).groupBy("rid", "iid").agg(F.flatten(F.collect_list("shifts")).alias("shifts"))
    shifts = both.select("rid", "iid", F.array_distinct("shifts").alias("shifts"))
    texts = hit.select("doc_id", "rid", "tokens").dropDuplicates(["rid"])
    pairs = shifts.join(items.select("iid", "item_id", "item"), "iid").join(texts, "rid")
    return pairs.select("doc_id", "rid", "item_id", "tokens", "item", "shifts").mapInArrow(
        _verify, f"doc_id {doc_type}, rid long, item_id {item_type}, matched long, item_words long, item_from long, item_to long, doc_from long"
    )
