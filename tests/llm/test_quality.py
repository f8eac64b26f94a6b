import random
import zlib
from collections import Counter

import numpy as np
from odd_rows import nothing, odd  # noqa: F401

from outpulse.llm import quality

LABELS = "doc_id LONG, quality INT, text STRING"


def corpus(spark):
    draw, rows, labels = random.Random(6), [], []
    for i in range(1500):
        good = i % 4 != 0
        w = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 8))) for _ in range(draw.randint(20, 120))]
        text = " ".join(w) if good else draw.choice([" ".join(x.upper() + "!!" for x in w), " ".join(w[:3] * 30), "$$$ ".join(w)])
        rows.append((i, text))
        labels.append((i, int(good), "x"))
    return spark.createDataFrame(rows, "doc_id LONG, text STRING"), spark.createDataFrame(labels, LABELS), dict((a, b) for a, b, _ in labels)


def test_held_out_accuracy_and_odd_rows(spark, odd):
    docs, labels, truth = corpus(spark)
    both = docs.union(odd[0].select(F_id(), "text"))
    got = quality.classify(both, labels.union(spark.createDataFrame([(3, None, "x"), (None, 1, "x"), (99_999, 0, "x"), (4, 0, "y")], LABELS))).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in both.collect())
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 200 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    measured = quality.measure(docs)
    model = quality.fit(measured, labels)
    kept = quality.accepted(docs, model)
    assert kept.schema == docs.schema
    wanted = {r.doc_id for r in quality.score(measured, model).where("score >= 0.7").collect()}
    assert {r.doc_id for r in kept.collect()} == wanted


def F_id():
    from pyspark.sql import functions as F

    return (F.col("doc_id") + 100_000).alias("doc_id")


def test_held_out_labels_are_never_read(spark):
    docs, labels, _ = corpus(spark)
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    one, two = ({r.doc_id: r.score for r in quality.classify(docs, x).collect()} for x in (labels, flipped))
    assert max(abs(one[i] - two[i]) for i in one) < 1e-9


def test_pool_equals_definition():
    draw = np.random.default_rng(2)
    for _ in range(20):
        y, w = draw.normal(size=12), draw.uniform(0.5, 2, 12)
        want = [max(min(np.average(y[a : b + 1], weights=w[a : b + 1]) for b in range(i, 12)) for a in range(i + 1)) for i in range(12)]
        assert np.allclose(quality.pool(y, w), want)


def test_no_labels_and_no_rows(spark, odd, nothing):
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in quality.classify(odd[0], none).collect()} == {1.0}
    assert quality.classify(nothing, corpus(spark)[1]).collect() == []
    few = spark.createDataFrame([(0, 1, ""), (1, 0, "")], LABELS)
    assert quality.classify(odd[0], few).count() == odd[0].count()


def test_model_equals_plain_normal_equations(spark):
    """Moments, partition sums, ridge and calibration against one numpy program over all rows at once."""
    docs, labels, truth = corpus(spark)
    measured = quality.measure(docs.repartition(7))
    model = quality.fit(measured, labels)
    rows = {r.doc_id: (r.x, zlib.crc32(str(r.doc_id).encode()) % 4) for r in measured.collect()}
    learnt = [(x, truth[i], k) for i, (x, k) in sorted(rows.items()) if k != 2]
    x = np.array([r[0] for r in learnt])
    y, k = np.array([r[1] for r in learnt], float), np.array([r[2] for r in learnt])
    mean, scale = x.mean(0), np.where(x.std(0) > 1e-9, x.std(0), 1.0)
    assert np.allclose(model.mean, mean) and np.allclose(model.scale, scale)

    draw = np.random.default_rng(quality.SEED)
    w = draw.normal(size=(x.shape[1], quality.FEATURES)) / (quality.BANDWIDTH * np.sqrt(x.shape[1]))
    b = draw.uniform(0, 2 * np.pi, quality.FEATURES)
    z = np.sqrt(2 / quality.FEATURES) * np.cos(np.clip((x - mean) / scale, -8, 8) @ w + b)
    z = np.hstack([z, np.ones((len(z), 1))])
    fit = z[k != 3]
    ridge = quality.RIDGE * len(fit) / quality.FEATURES
    weights = np.linalg.lstsq(np.vstack([fit, np.sqrt(ridge) * np.eye(z.shape[1])]), np.append(y[k != 3], np.zeros(z.shape[1])), rcond=None)[0]
    assert np.allclose(z @ model.weights, z @ weights, atol=1e-6)

    held = z[k == 3] @ model.weights
    bins = np.clip((held + 0.5) * (quality.BINS / 2), 0, quality.BINS - 1).astype(int)
    used = np.unique(bins)
    means, counts = np.array([y[k == 3][bins == u].mean() for u in used]), np.array([(bins == u).sum() for u in used])
    assert np.allclose(model.chances, quality.pool(means, counts)) and np.allclose(model.knots, (used + 0.5) * (2 / quality.BINS) - 0.5)


def test_features_approximate_the_gaussian_kernel():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(40, 18))
    z = quality.fourier(x, np.zeros(18), np.ones(18))[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * quality.BANDWIDTH**2 * 18))
    assert np.abs(z @ z.T - exact).mean() < 3 / np.sqrt(quality.FEATURES)


def test_repeated_rows_and_ties_score_alike(spark):
    docs, labels, _ = corpus(spark)
    twice = docs.unionByName(docs).unionByName(docs.limit(50).withColumn("doc_id", docs.doc_id + 50_000))
    scores = {}
    for r in quality.classify(twice, labels).join(twice.distinct(), "doc_id").select("text", "score").collect():
        scores.setdefault(r.text, set()).add(r.score)
    assert all(len(s) == 1 for s in scores.values())
