"""Nearest neighbours by a forest of random-projection trees behind one shared priority queue.

The trees are fitted on a bounded sample, then every row is filed in one leaf
of every tree. A query walks all trees through a single queue ordered by the
chance that a neighbour at the distance seen so far lies in a subtree, and
stops once the chance that all trees missed it is small enough: few leaves for
a query with close neighbours, many for one without. Found leaves are joined
with the filed rows in blocks of bounded size, where the exact cosine ranks
them.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from outpulse.session import store

TREES = 8
#: Rows of the sample that the trees are fitted on, and its smallest leaf.
SAMPLE, SAMPLE_LEAF = 32_768, 8
LEAF = 64
BLOCK = 2048
#: Filed rows of neighbouring leaves that are searched together.
BUNDLE = 8192
#: Queries of one task that walks the trees.
WALKS = 128
#: Chance of a missed neighbour at which a query stops, and widening of its distance.
MISS, WIDER = 1e-3, 1.3
SEED = 5


class Forest(NamedTuple):
    """Nodes of all trees: a negative child is leaf ``-child - 1``."""

    normal: np.ndarray
    offset: np.ndarray
    left: np.ndarray
    right: np.ndarray
    roots: np.ndarray


def grow(sample: np.ndarray, leaf: int, trees: int = TREES) -> Forest:
    """Trees of random hyperplanes at the median of the sample's projections."""
    draw = np.random.default_rng(SEED)
    normals, offsets, children, roots, leaves = [], [], [], [], 0

    def split(rows: np.ndarray) -> int:
        nonlocal leaves
        if len(rows) > leaf:
            normal = draw.normal(size=sample.shape[1])
            normal = (normal / np.linalg.norm(normal)).astype(np.float32)
            at = sample[rows] @ normal.astype(float)
            offset = float(np.median(at))
            low, high = rows[at <= offset], rows[at > offset]
            if len(low) and len(high):
                me = len(normals)
                normals.append(normal)
                offsets.append(offset)
                children.append([0, 0])
                children[me][:] = split(low), split(high)
                return me
        leaves += 1
        return -leaves

    for _ in range(trees):
        roots.append(split(np.arange(len(sample))))
    children = np.array(children, np.int64).reshape(-1, 2)
    normals = np.array(normals, np.float32).reshape(len(normals), sample.shape[1])
    return Forest(normals, np.array(offsets), children[:, 0], children[:, 1], np.array(roots))


def leaves_of(forest: Forest, unit: np.ndarray) -> np.ndarray:
    """(rows x trees): the leaf of every row in every tree."""
    out = np.empty((len(unit), len(forest.roots)), np.int64)
    for tree, root in enumerate(forest.roots):
        node = np.full(len(unit), root)
        while (inner := np.flatnonzero(node >= 0)).size:
            at = node[inner]
            side = np.einsum("ij,ij->i", unit[inner], forest.normal[at]) <= forest.offset[at]
            node[inner] = np.where(side, forest.left[at], forest.right[at])
        out[:, tree] = -node - 1
    return out


def _cost(z: float) -> float:
    return -math.log(max(1e-300, 0.5 * math.erfc(-z / math.sqrt(2))))


def search(forest: Forest, unit: np.ndarray, distance: float, miss: float = MISS) -> list[int]:
    """Leaves of all trees for one query, most promising first, from one queue."""
    margin = (forest.normal @ unit - forest.offset) / max(WIDER * distance / math.sqrt(len(unit)), 1e-9)
    queue = [(0.0, tree, int(root)) for tree, root in enumerate(forest.roots)]
    heapq.heapify(queue)
    rest, found = [1.0] * len(queue), []
    while queue and math.prod(rest) > miss:
        cost, tree, node = heapq.heappop(queue)
        if node < 0:
            found.append(-node - 1)
            rest[tree] = max(1e-9, rest[tree] - math.exp(-cost))
        else:
            z = float(margin[node])
            heapq.heappush(queue, (cost + _cost(-z), tree, int(forest.left[node])))
            heapq.heappush(queue, (cost + _cost(z), tree, int(forest.right[node])))
    return found


def _matrix(column: pa.Array | pa.ChunkedArray, rows: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(rows, -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row; the same two vectors always give the same double."""
    a, b = a / np.abs(a).max(axis=1, keepdims=True), b / np.abs(b).max(axis=1, keepdims=True)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _filed(forest: Forest) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = leaves_of(forest, _unit(_matrix(batch.column("v"), batch.num_rows)))
                at = np.repeat(np.arange(batch.num_rows), leaf.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf.ravel()), *[batch.column(c).take(pa.array(at)) for c in ("cid", "first", "v")]], ["leaf", "cid", "first", "v"]
                )

    return run


def _asked(forest: Forest, bundle: np.ndarray, more: bool) -> Callable:
    """Rows (cid, v, bundle, leaves): the leaves to search for each query, by bundle.

    First each tree's own leaf, then, knowing the worst of the best scores
    found there (``worst``), those of the shared queue.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _unit(_matrix(batch.column("v"), batch.num_rows))
            found = [sorted(set(f)) for f in leaves_of(forest, unit).tolist()]
            if more:
                known = np.asarray(batch.column("worst").to_pylist(), float)
                found = [
                    sorted(set(search(forest, u, math.sqrt(max(0.0, 2 - 2 * w)))) - set(f))
                    for u, w, f in zip(unit, known, found, strict=True)
                ]
            at, where, lists = [], [], []
            for i, leaves in enumerate(found):
                own = bundle[leaves] if leaves else bundle[:0]
                for number in np.unique(own).tolist():
                    at.append(i)
                    where.append(number)
                    lists.append(np.array(leaves)[own == number].tolist())
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(at) for c in ("cid", "v")], pa.array(where, pa.int64()), pa.array(lists, pa.list_(pa.int64()))],
                ["cid", "v", "bundle", "leaves"],
            )

    return run


_PAIR = pa.schema([("cid", pa.string()), ("other", pa.string()), ("first", pa.int64()), ("score", pa.float64())])


def _rank(k: int) -> Callable:
    def run(key: tuple, filed: pa.Table, asked: pa.Table) -> pa.Table:
        if not filed.num_rows or not asked.num_rows:
            return _PAIR.empty_table()
        x, q = _matrix(filed.column("v"), filed.num_rows), _matrix(asked.column("v"), asked.num_rows)
        ux, uq = _unit(x), _unit(q)
        leaf = filed.column("leaf").to_numpy()
        order = np.argsort(leaf, kind="stable")
        members = dict(zip(*_groups(leaf[order], order), strict=True))
        lists = asked.column("leaves").combine_chunks()
        wanted = lists.flatten().to_numpy()
        query = np.repeat(np.arange(len(q)), np.diff(lists.offsets.to_numpy()))
        place = np.argsort(wanted, kind="stable")
        rows, cols = [], []
        for number, spots in zip(*_groups(wanted[place], query[place]), strict=True):
            if number in members:
                inside = members[number]
                rough = uq[spots] @ ux[inside].T
                width = min(k, len(inside))
                near = np.argpartition(-rough, width - 1, axis=1)[:, :width]
                rows.append(np.repeat(spots, width))
                cols.append(inside[near.ravel()])
        if not rows:
            return _PAIR.empty_table()
        row, col = np.concatenate(rows), np.concatenate(cols)
        found = pa.table({"cid": asked.column("cid").take(pa.array(row)), "other": filed.column("cid").take(pa.array(col)),
                          "first": filed.column("first").take(pa.array(col)), "score": cosines(q[row], x[col])})
        frame = found.to_pandas().drop_duplicates(["cid", "other"])
        frame = frame.sort_values(["cid", "score", "first"], ascending=[True, False, True]).groupby("cid").head(k)
        return pa.Table.from_pandas(frame, schema=_PAIR, preserve_index=False)

    return run


def _groups(keys: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Runs of equal ascending keys, and the values of each."""
    cuts = np.flatnonzero(np.diff(keys)) + 1
    return keys[np.concatenate(([0], cuts))].tolist(), np.split(values, cuts)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found rows of ``vectors`` for each row of ``queries``.

    Both are (vec_id, embedding). A row with the query's own id is no
    candidate. Left out are null ids, null and zero vectors, vectors with null
    or non-finite components, and vectors not of the most common length. Equal
    rows count once; equal vectors are searched once and all named, smaller ids
    first, as are other ties. With fewer candidates than ``k`` all are returned.

    The index is approximate: recall of the true ``k`` is above 0.9 on vectors
    as unstructured as random ones (see the tests), and near 1 where neighbours
    are close. Leaves larger than a block are searched block by block.
    """
    spark = vectors.sparkSession
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall("embedding", lambda x: x == 0)

    def valid(df: DataFrame) -> DataFrame:
        df = df.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(~bad & ~zero)
        return df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))

    cid = F.md5(F.col("v").cast("string").cast("binary")).alias("cid")
    rows = valid(vectors)
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if size is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("v") == size.n).select("vec_id", "v", cid)
    asked = valid(queries).where(F.size("v") == size.n).select(F.col("vec_id").alias("query_id"), "v", cid).distinct()

    # Of equal vectors only the k + 1 smallest ids can be among the nearest k.
    place = F.dense_rank().over(Window.partitionBy("cid").orderBy("vec_id"))
    few = rows.withColumn("place", place).where(F.col("place") <= k + 1)
    classes = store(few.groupBy("cid").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"), F.first("v").alias("v")), "ann-classes")
    n = classes.count()
    chance = F.pmod(F.xxhash64("cid"), F.lit(1 << 30).cast("long")) < int((1 << 30) * min(1.0, SAMPLE / max(n, 1)))
    sample = _unit(np.array([r.v for r in classes.where(chance).select("v").orderBy("v").collect()] or [r.v for r in classes.select("v").limit(1).collect()], float))
    forest = grow(sample, max(SAMPLE_LEAF, round(LEAF * len(sample) / max(n, 1))))

    named = classes.select("cid", F.col("ids")[0].alias("first"), "v")
    filed = store(named.mapInArrow(_filed(forest), "leaf long, cid string, first long, v array<double>"), "ann-filed")
    # Leaves are as many as the sample allows, whatever the input.
    sizes = {r.leaf: r.n for r in filed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    bundle, blocks, held = np.zeros(max(sizes) + 1, np.int64), [1], 0
    for leaf, rows_in in sorted(sizes.items()):
        if held and held + rows_in > BUNDLE:
            blocks.append(1)
            held = 0
        held += rows_in
        bundle[leaf], blocks[-1] = len(blocks) - 1, math.ceil(held / BUNDLE)
    dealt_leaves = spark.createDataFrame([(leaf, int(bundle[leaf]), blocks[bundle[leaf]]) for leaf in sizes], "leaf long, bundle long, a int")
    wanted = store(asked.select("cid", "v").dropDuplicates(["cid"]), "ann-queries")

    def ranked(probes: DataFrame) -> DataFrame:
        probes = store(probes, "ann-probes")
        widths = probes.groupBy("bundle").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("b"))
        cut = dealt_leaves.select("bundle", "a").distinct().join(widths, "bundle")
        block = {c: F.pmod(F.xxhash64("cid"), F.col(c).cast("long")).cast("int") for c in ("a", "b")}
        left = (
            filed.join(dealt_leaves.select("leaf", "bundle"), "leaf").join(cut, "bundle").withColumn("i", block["a"])
            .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("b") - 1))).select("bundle", "i", "j", "leaf", "cid", "first", "v")
        )
        right = (
            probes.join(cut, "bundle").withColumn("j", block["b"])
            .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("a") - 1))).select("bundle", "i", "j", "cid", "v", "leaves")
        )
        keys = ["bundle", "i", "j"]
        pairs = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_rank(k + 1), "cid string, other string, first long, score double")
        best = F.row_number().over(Window.partitionBy("cid").orderBy(F.desc("score"), "first", "other"))
        return pairs.distinct().withColumn("p", best).where(F.col("p") <= k + 1).drop("p")

    probe = "cid string, v array<double>, bundle long, leaves array<long>"
    first = store(ranked(wanted.mapInArrow(_asked(forest, bundle, more=False), probe)), "ann-first")
    worst = first.groupBy("cid").agg(F.when(F.count("*") > k, F.min("score")).otherwise(F.lit(-1.0)).alias("worst"))
    # The walks through the trees are the only long step per query, so they get tasks of their own.
    walks = wanted.join(worst, "cid").repartition(math.ceil(wanted.count() / WALKS) or 1)
    more = ranked(walks.mapInArrow(_asked(forest, bundle, more=True), probe))

    best = F.row_number().over(Window.partitionBy("cid").orderBy(F.desc("score"), "first", "other"))
    found = first.union(more).distinct().withColumn("p", best).where(F.col("p") <= k + 1)
    found = found.join(classes.select(F.col("cid").alias("other"), F.explode("ids").alias("vec_id")), "other")
    top = F.row_number().over(Window.partitionBy("cid").orderBy(F.desc("score"), "vec_id"))
    found = found.withColumn("p", top).where(F.col("p") <= k + 1).drop("p", "other", "first")
    final = Window.partitionBy("query_id", "cid").orderBy(F.desc("score"), "vec_id")
    return (
        asked.select("query_id", "cid").join(found, "cid").where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
