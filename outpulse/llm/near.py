"""Near-duplicate groups of documents by ProbMinHash, banding and exact verification.

Weighted shingles (``length`` words, weight = count) arrive as Poisson
processes whose rate is their weight. Every arrival picks one of the
signature's slots; a slot keeps the shingle that came first. A shingle leaves
the race once its time exceeds the latest slot's (early termination). Two
texts agree in a slot with probability J_P, the probability Jaccard
similarity. Bands of the signature name buckets; pairs are verified by exact
J_P on whole texts.

No bucket is paired with itself in full. First, every bucket's members are
compared with its centre only, the member that shares most buckets with
others. Connected components of those links settle almost all buckets. A
bucket that still spans several components is not done: its members are dealt
into bins of bounded size, and bins that meet in a bucket are compared as a
tile, across components, by signature and then exactly. No pair leaves a tile
but links, and no link between components is lost to the star.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outpulse.llm.words import Words, mix, slices, windows
from outpulse.session import store

LENGTH = 5
SIMILARITY = 0.8
#: A pair at similarity 0.8 shares no band with probability (1 - 0.8^5)^32 = 3e-6.
SLOTS, BAND = 160, 5
#: Signature agreement that lets a pair through to the exact check, 4.5 standard deviations below 0.8.
AGREE = 106
#: Texts on either side of a tile in which components are compared.
BIN = 256
_BYTES = 2


def shingles(words: Words, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, count) of all shingles, by row and key. A text of fewer words is one shingle."""
    hashes, per_row = words.hashes(), words.per_row()
    at, key = windows(hashes, words.row, length)
    rows, keys = [words.row[at]], [key]
    for n in range(1, length):
        short = per_row[words.row] == n
        if short.any():
            row = words.row[short]
            at, key = windows(hashes[short], row, n)
            rows.append(row[at])
            keys.append(mix(key, n))
    row, key = np.concatenate(rows), np.concatenate(keys)
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    first = np.ones(len(key), dtype=bool)
    first[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    starts = np.flatnonzero(first)
    return row[starts], key[starts], np.diff(np.append(starts, len(key))).astype(np.float64)


def signatures(row: np.ndarray, key: np.ndarray, weight: np.ndarray, rows: int, slots: int = SLOTS) -> np.ndarray:
    """Winning keys (rows x slots); zeros for rows without shingles. Scaling a row's weights changes nothing."""
    first = np.full(rows * slots, np.inf)
    out = np.zeros(rows * slots, dtype=np.uint64)
    latest = np.full(rows, np.inf)
    time = np.zeros(len(key))
    alone = np.bincount(row, minlength=rows) == 1
    for r, k in zip(row[alone[row]], key[alone[row]], strict=True):
        out[r * slots : (r + 1) * slots] = k
    live = ~alone[row]
    row, key, weight, time = row[live], key[live], weight[live], time[live]
    arrival = 0
    while len(key):
        arrival += 1
        draw = mix(key, arrival)
        time = time - np.log1p(-((draw >> np.uint64(11)).astype(np.float64) * 2.0**-53)) / weight
        pick = (((mix(draw, 5) >> np.uint64(32)) * np.uint64(slots)) >> np.uint64(32)).astype(np.int64)
        slot = row * slots + pick
        better = np.flatnonzero(time < first[slot])
        np.minimum.at(first, slot[better], time[better])
        won = better[time[better] == first[slot[better]]]
        out[slot[won]] = key[won]
        seen = np.flatnonzero(np.bincount(row, minlength=rows))
        latest[seen] = first.reshape(rows, slots)[seen].max(axis=1)
        live = time < latest[row]
        row, key, weight, time = row[live], key[live], weight[live], time[live]
    return out.reshape(rows, slots)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact J_P of two weighted sets, each as (ascending keys, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    x, y = a[1][i], b[1][j]
    if not len(x):
        return 0.0
    order = np.argsort(y / x)
    x, y = x[order], y[order]
    left = a[1].sum() - x.sum() + np.cumsum(x)
    right = b[1].sum() - np.cumsum(y)
    return float((1 / (left / x + right / y)).sum())


_SIGNED = "doc_id {}, rid long, node binary, sig binary"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text"):
            words = Words(piece.column("text"))
            found = signatures(*shingles(words), piece.num_rows)
            short = (mix(found, 3) >> np.uint64(64 - 8 * _BYTES)).astype("<u2")
            full = words.per_row() > 0
            sigs = pa.array([s.tobytes() if ok else None for s, ok in zip(short, full, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("rid"), piece.column("node"), sigs], ["doc_id", "rid", "node", "sig"]
            )


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).sum(axis=-1)


def _sig_rows(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), "<u2").reshape(len(values), SLOTS)


def _promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            left, right = (_sig_rows(batch.column(c).to_pylist()) for c in ("sig_a", "sig_b"))
            yield batch.select(["a", "b"]).filter(pa.array(_agreement(left, right) >= AGREE))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text_a"):
            sides = []
            for name in ("text_a", "text_b"):
                row, key, weight = shingles(Words(piece.column(name)))
                edges = np.searchsorted(row, np.arange(piece.num_rows + 1))
                sides.append([(key[i:j], weight[i:j]) for i, j in zip(edges, edges[1:], strict=False)])
            score = [probability_jaccard(a, b) for a, b in zip(*sides, strict=True)]
            piece = piece.select(["a", "b"]).append_column("score", pa.array(score, pa.float64()))
            yield piece.filter(pa.array([s >= SIMILARITY - 1e-12 for s in score]))


def _settled(key: tuple, tile: pa.Table) -> pa.Table:
    """Links between components inside a bin or between two, likeliest first; what the tile has joined is left out."""
    lo, hi = key[0].as_py(), key[1].as_py()
    node, comp, bin_ = (tile.column(c).to_pylist() for c in ("node", "comp", "bin"))
    sig, kind = _sig_rows(tile.column("sig").to_pylist()), np.unique(np.array(comp, dtype=object), return_inverse=True)[1]
    bin_ = np.array(bin_, np.int64)
    left, right, close = np.flatnonzero(bin_ == lo), np.flatnonzero(bin_ == hi), []
    for x in left:
        others = right[(kind[right] != kind[x]) & ((lo != hi) | (right > x))]
        agree = _agreement(sig[others], sig[x])
        close += [(-n, int(x), int(y)) for y, n in zip(others[agree >= AGREE], agree[agree >= AGREE].tolist(), strict=True)]
    row, keys, weight = shingles(Words(tile.column("text")))
    edges = np.searchsorted(row, np.arange(tile.num_rows + 1))
    sets = [(keys[i:j], weight[i:j]) for i, j in zip(edges, edges[1:], strict=False)]
    plain = [w.max(initial=1) == 1 for _, w in sets]
    root = list(range(int(kind.max()) + 1))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for _, x, y in sorted(close):
        p, q = find(kind[x]), find(kind[y])
        if p == q:
            continue
        if plain[x] and plain[y]:
            (few, _), (many, _) = sorted((sets[x], sets[y]), key=lambda s: len(s[0]))
            if len(few) < (SIMILARITY - 1e-9) * len(many):
                continue
            same = (many[np.minimum(np.searchsorted(many, few), len(many) - 1)] == few).sum()
            score = float(same / (len(few) + len(many) - same))
        else:
            score = probability_jaccard(sets[x], sets[y])
        if score >= SIMILARITY - 1e-12:
            root[p] = q
            out.append((min(node[x], node[y]), max(node[x], node[y]), score))
    a, b, score = zip(*out, strict=True) if out else ([], [], [])
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary()), "score": pa.array(score, pa.float64())})


def components(links: DataFrame) -> DataFrame:
    """(node, comp): smallest node of each node's connected component, for nodes with a link.

    Smallest labels move over links and then along labels, so distances
    shrink by more than half a round. Each round is a written table.
    """
    edges = store(links.select("a", "b").union(links.select("b", "a")).distinct(), "near-edges")
    labels = store(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                   .select("node", F.least("node", "m").alias("comp")), "near-labels")
    while True:
        nearest = (
            edges.join(labels.withColumnsRenamed({"node": "b", "comp": "m"}), "b").groupBy(F.col("a").alias("node"))
            .agg(F.min("m").alias("m"))
        )
        step = labels.join(nearest, "node").select("node", F.col("comp").alias("old"), F.least("comp", "m").alias("comp"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        step = step.join(jump, "comp", "left").select(
            "node", "old", F.least("comp", F.coalesce("far", "comp")).alias("comp")
        )
        labels = store(step, "near-labels")
        if labels.where(F.col("old") != F.col("comp")).isEmpty():
            return labels.select("node", "comp")


def _bands() -> Column:
    width = BAND * _BYTES
    keys = [F.xxhash64(F.lit(i), F.substring("sig", i * width + 1, width)) for i in range(SLOTS // BAND)]
    return F.explode(F.array(*keys))


def near_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: (doc_id, rid, class_id, group_id, group_size, score, keeper).

    ``class_id`` is the smallest doc_id with exactly the same text,
    ``group_id`` the smallest doc_id of the near-duplicate group, the connected
    component of pairs with J_P of 0.8 or more over weighted 5-word shingles;
    ``group_size`` counts its rows; ``score`` is the largest similarity to
    another text among the links that were verified (null without one). A text
    of one to four words is one shingle. Texts without words (null, empty, only
    white space) are near nothing, but equal ones are copies; null counts as
    empty. Equal rows are members like others. A null doc_id stays null and
    never names a group if the group has another. ``rid`` hashes doc_id and text, ``keeper``
    is the rid of the group's first row. Reads doc_id and text only.
    """
    node = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("rid"), node.alias("node"), "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    signed = store(rows.mapInArrow(_sign, _SIGNED.format(id_type)), "near-signed")
    nodes = store(
        signed.groupBy("node").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "rid")).alias("first"),
                                   F.count("*").alias("copies"), F.min("sig").alias("sig")), "near-nodes",
    )

    banded = nodes.where("sig IS NOT NULL").select("node", _bands().alias("key"))
    counts = banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = store(banded.join(counts, "key"), "near-shared")
    central = shared.groupBy("node").agg(F.sum("n").alias("c"))
    centre = shared.join(central, "node").groupBy("key").agg(F.max(F.struct("c", "node")).alias("top"))
    star = (
        shared.join(centre.select("key", F.col("top.node").alias("b")), "key")
        .where(F.col("node") != F.col("b"))
        .select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
    )

    open_nodes = nodes.join(shared.select("node").distinct(), "node", "left_semi").select("node", "first.rid")
    texts = store(rows.select("rid", "text").join(open_nodes, "rid").dropDuplicates(["node"]).select("node", "text"), "near-texts")
    sigs = nodes.select("node", "sig")

    def promising(pairs: DataFrame) -> DataFrame:
        left = sigs.withColumnsRenamed({"node": "a", "sig": "sig_a"})
        right = sigs.withColumnsRenamed({"node": "b", "sig": "sig_b"})
        return pairs.join(left, "a").join(right, "b").mapInArrow(_promising, "a binary, b binary")

    def verified(pairs: DataFrame) -> DataFrame:
        left = texts.withColumnsRenamed({"node": "a", "text": "text_a"})
        right = texts.withColumnsRenamed({"node": "b", "text": "text_b"})
        return pairs.join(left, "a").join(right, "b").mapInArrow(_verified, "a binary, b binary, score double")

    links = store(verified(promising(star)), "near-links")
    comps = components(links)

    member = shared.join(comps, "node", "left").select("key", "n", "node", F.coalesce("comp", "node").alias("comp"))
    spans = member.groupBy("key").agg(F.min("comp").alias("first"), F.max("comp").alias("last")).where("first <> last")
    member = member.join(spans.select("key", "first"), "key")
    bins = member.groupBy("node", "comp").agg(F.min("first").alias("first"))
    wide = bins.groupBy("first").agg(F.ceil(F.count("*") / BIN).cast("long").alias("bins"))
    bins = bins.join(wide, "first").select(
        "node", "comp", F.xxhash64("first", F.pmod(F.xxhash64("node"), F.col("bins"))).alias("bin")
    )
    bins = store(bins, "near-bins")
    present = member.select("key", "node").join(bins.select("node", "bin"), "node").select("key", "bin").distinct()
    meet = present.select("key", F.col("bin").alias("lo")).join(present.select("key", F.col("bin").alias("hi")), "key")
    meet = meet.where("lo <= hi").select("lo", "hi").distinct()
    in_tile = meet.select("lo", "hi", F.col("lo").alias("bin")).union(meet.select("lo", "hi", F.col("hi").alias("bin"))).distinct()
    tiles = in_tile.join(bins.join(sigs, "node").join(texts, "node"), "bin").select("lo", "hi", "bin", "node", "comp", "sig", "text")
    more = store(tiles.groupBy("lo", "hi").applyInArrow(_settled, "a binary, b binary, score double"), "near-more")
    if not more.isEmpty():
        links = links.union(more)
        comps = components(links)

    best = links.select("a", "score").union(links.select("b", "score")).groupBy(F.col("a").alias("node")).agg(F.max("score").alias("score"))
    whole = nodes.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    groups = whole.groupBy("comp").agg(F.min("first").alias("top"), F.sum("copies").alias("group_size"))
    named = whole.join(groups, "comp").join(best, "node", "left").select(
        "node", F.col("first.doc_id").alias("class_id"), F.col("top.doc_id").alias("group_id"), "group_size", "score",
        F.col("top.rid").alias("keeper"),
    )
    return signed.select("doc_id", "rid", "node").join(named, "node").drop("node")


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of every near-duplicate group: its smallest doc_id, one of equal rows. All columns stay."""
    first = near_groups(docs).where("rid = keeper").select(F.col("rid").alias("_rid")).distinct()
    rows = docs.withColumn("_rid", F.xxhash64("doc_id", "text")).join(first, "_rid", "left_semi")
    place = F.row_number().over(Window.partitionBy("_rid").orderBy("doc_id"))
    return rows.withColumn("_place", place).where("_place = 1").select(*docs.columns)
