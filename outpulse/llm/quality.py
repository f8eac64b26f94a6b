"""Quality scores: random Fourier features, ridge by partition-summed normal equations, isotonic calibration.

Document statistics become random Fourier features, whose inner products
approximate a Gaussian kernel. Every partition of the labelled rows sums its
share of the normal equations; the sums, of fixed size, are added up in Spark
and solved on the driver. Scores of labelled rows kept out of that fit are
counted in fixed bins, and an isotonic step function over the bins turns
scores into chances.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outpulse.llm.words import Words, slices, windows
from outpulse.session import store

FEATURES = 256
BANDWIDTH = 2.0
RIDGE = 1e-3
SEED = 7
BINS = 2000
KEEP = 0.7

_UPPER, _LOWER_CASE, _DIGIT, _PUNCT, _HIGH = (np.zeros(256, dtype=bool) for _ in range(5))
_UPPER[65:91] = _LOWER_CASE[97:123] = _DIGIT[48:58] = _HIGH[128:] = True
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def _distinct(row: np.ndarray, key: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of every row, and the count of its most frequent key."""
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    first = np.ones(len(key), dtype=bool)
    first[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    at = np.flatnonzero(first)
    most = np.zeros(rows)
    np.maximum.at(most, row[at], np.diff(np.append(at, len(key))))
    return np.bincount(row[at], minlength=rows), most


def statistics(texts: pa.Array) -> np.ndarray:
    """(rows x statistics) of whole texts. A text without words has zeros."""
    words = Words(texts)
    n, rows, row, data = words.per_row().astype(float), words.rows, words.row, words.data
    some = np.maximum(n, 1)
    byte_row = np.repeat(np.arange(rows), np.diff(words.offsets))
    size = np.maximum(np.diff(words.offsets), 1).astype(float)

    def per_row(values: np.ndarray) -> np.ndarray:
        return np.bincount(row, values, minlength=rows) / some

    def share(kind: np.ndarray) -> np.ndarray:
        return np.bincount(byte_row[kind[data]], minlength=rows) / size

    length = (words.end - words.start).astype(float)
    mean = per_row(length)
    spread = np.sqrt(np.maximum(per_row(length**2) - mean**2, 0))
    initial, last = data[words.start] if len(row) else data[:0], data[words.end - 1] if len(row) else data[:0]
    before = data[np.maximum(words.end - 2, words.start)] if len(row) else data[:0]
    hashes = words.hashes()
    kinds, most = _distinct(row, hashes, rows)
    same = np.zeros(len(row), dtype=bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    at, key = windows(hashes, row, 4)
    runs, _ = _distinct(row[at], key, rows)
    n_runs = np.maximum(np.bincount(row[at], minlength=rows), 1)
    line = np.cumsum(np.concatenate(([0], data == 10)))[words.start] if len(row) else np.zeros(0, np.int64)
    lines, _ = _distinct(row, line.astype(np.uint64), rows)
    top = np.zeros(rows)
    np.maximum.at(top, row, length)
    return np.column_stack([
        np.log1p(n), np.log1p(mean), np.log1p(spread), np.log1p(top),
        per_row(_UPPER[initial]), per_row(_PUNCT[last]), per_row(_PUNCT[last] & _PUNCT[before]), per_row(same),
        kinds / some, np.log1p(n / np.maximum(kinds, 1)), most / some, runs / n_runs, np.log1p(n / np.maximum(lines, 1)),
        share(_UPPER), share(_LOWER_CASE), share(_DIGIT), share(_PUNCT), share(_HIGH),
    ])


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text"):
            x = statistics(piece.column("text"))
            values = pa.ListArray.from_arrays(
                np.arange(0, x.size + 1, max(1, x.shape[1]), dtype=np.int32), pa.array(x.ravel(), pa.float64())
            )
            rest = [piece.column(c) for c in piece.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*rest, values], [*[c for c in piece.schema.names if c != "text"], "x"])


def fold(column: str) -> Column:
    """crc32 of the id as text, mod 4; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % 4


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    chances: np.ndarray


def _projection(n: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(SEED)
    return draw.normal(size=(n, FEATURES)) / (BANDWIDTH * np.sqrt(n)), draw.uniform(0, 2 * np.pi, FEATURES)


def fourier(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features and a constant; statistics are cut at eight standard deviations."""
    w, b = _projection(x.shape[1])
    z = np.clip((x - mean) / scale, -8, 8) @ w + b
    return np.column_stack([np.cos(z) * np.sqrt(2 / FEATURES), np.ones(len(x))])


def _rows(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    values = batch.column("x")
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return values.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _partial(mean: np.ndarray, scale: np.ndarray) -> Callable:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zz, zy, n = 0.0, 0.0, 0
        for batch in batches:
            if batch.num_rows:
                z = fourier(_rows(batch), mean, scale)
                zz, zy, n = zz + z.T @ z, zy + z.T @ batch.column("y").to_numpy(), n + len(z)
        if n:
            yield pa.RecordBatch.from_pydict({"zz": [zz.tobytes()], "zy": [zy.tobytes()], "n": [n]})

    return sums


def _add(key: tuple, parts: pa.Table) -> pa.Table:
    total = {c: sum(np.frombuffer(v) for v in parts.column(c).to_pylist()).tobytes() for c in ("zz", "zy")}
    return pa.table({"zz": [total["zz"]], "zy": [total["zy"]], "n": [sum(parts.column("n").to_pylist())]})


_SUMS = "zz binary, zy binary, n long"


def pool(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Isotonic regression by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for v, w in zip(values, weights, strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def _raw(model: Model, x: np.ndarray) -> np.ndarray:
    return fourier(x, model.mean, model.scale) @ model.weights


def _binned(model: Model) -> Callable:
    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = np.clip((_raw(model, _rows(batch)) + 0.5) * (BINS / 2), 0, BINS - 1).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("y")], ["bin", "y"])

    return bins


def fit(measured: DataFrame, labels: DataFrame) -> Model | None:
    """A model from (doc_id, x) and (doc_id, quality), or None without labels.

    Only rows whose :func:`fold` is not 2 are learnt from: folds 0 and 1 fit
    the ridge, fold 3 the calibration. Several labels of a doc_id count by
    their mean. What reaches the driver has a fixed size.
    """
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("y"))
    rows = store(measured.where(fold("doc_id") != 2).join(known, "doc_id").select(fold("doc_id").alias("fold"), "x", "y"), "quality-train")
    moments = [f(F.col("x")[i]) for i in range(len(_names())) for f in (F.avg, F.stddev_pop)]
    first = rows.agg(F.count("*"), *moments).first()
    if not first[0]:
        return None
    mean, scale = np.array(first[1::2], float), np.array(first[2::2], float)
    scale = np.where(scale > 1e-9, scale, 1.0)

    parts = rows.where("fold <> 3").select("x", "y").mapInArrow(_partial(mean, scale), _SUMS)
    spread = parts.withColumn("g", F.spark_partition_id() % 16).groupBy("g").applyInArrow(_add, _SUMS)
    sums = spread.withColumn("g", F.lit(0)).groupBy("g").applyInArrow(_add, _SUMS).collect()
    if not sums:
        zz, zy, n = np.zeros((FEATURES + 1) ** 2), np.zeros(FEATURES + 1), 1
    else:
        zz, zy, n = np.frombuffer(sums[0].zz), np.frombuffer(sums[0].zy), sums[0].n
    zz = zz.reshape(FEATURES + 1, -1)
    weights = np.linalg.solve(zz + RIDGE * n * np.eye(len(zy)) / FEATURES, zy)
    model = Model(mean, scale, weights, np.zeros(0), np.zeros(0))

    held = rows.where("fold = 3").select("x", "y")
    counts = held.mapInArrow(_binned(model), "bin long, y double").groupBy("bin").agg(F.avg("y").alias("y"), F.count("*").alias("n"))
    counts = sorted(counts.collect())
    if not counts:
        return model._replace(knots=np.array([0.0, 1.0]), chances=np.array([0.0, 1.0]))
    at, y, n = (np.array(c, float) for c in zip(*counts, strict=True))
    return model._replace(knots=(at + 0.5) * (2 / BINS) - 0.5, chances=pool(y, n))


def _names() -> range:
    return range(statistics(pa.array(["a"])).shape[1])


def measure(docs: DataFrame) -> DataFrame:
    """``docs``' columns but ``text``, and the statistics ``x``."""
    return docs.mapInArrow(_measure, ", ".join(f"`{c}` {t}" for c, t in docs.dtypes if c != "text") + ", x array<double>")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text).

    ``score`` is the chance of quality 1 from the text alone; null texts count
    as empty, and empty texts are scored like others. Equal texts have equal
    scores. Without any usable label every score is 1: nothing speaks against
    a text. ``held_out`` is fold 2, whose labels are never read.
    """
    measured = store(measure(docs.select("doc_id", "text")), "quality-measured")
    return score(measured, fit(measured, labels)).withColumns(
        {"held_out": fold("doc_id") == 2, "predicted": (F.col("score") >= KEEP).cast("int")}
    )


def score(measured: DataFrame, model: Model | None) -> DataFrame:
    """``measured`` with ``x`` replaced by the calibrated ``score``."""
    kept = [c for c in measured.columns if c != "x"]
    if model is None:
        return measured.select(*kept, F.lit(1.0).alias("score"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = np.clip(np.interp(_raw(model, _rows(batch)), model.knots, model.chances), 0, 1)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(found)], [*kept, "score"])

    return measured.mapInArrow(apply, ", ".join(f"`{c}` {t}" for c, t in measured.dtypes if c != "x") + ", score double")


def accepted(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs``' rows whose text the model does not reject, all columns as they are; one pass, no shuffle."""
    if model is None:
        return docs

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                raw = _raw(model, statistics(piece.column("text")))
                yield piece.filter(pa.array(np.interp(raw, model.knots, model.chances) >= KEEP))

    return docs.mapInArrow(choose, docs.schema)
