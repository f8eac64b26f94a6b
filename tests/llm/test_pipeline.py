"""Stages against brute force over their own inputs, the registry, and the rule that nothing else imports the package."""

import re
from collections import Counter
from pathlib import Path

import pytest
from odd_rows import nothing, odd, words  # noqa: F401
from oracle import compare, connect
from test_near import brute_groups
from test_scans import base

import __spark_entry__
import corpus_pipeline
from outpulse.llm import quality, secrets
from outpulse.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registered():
    names = __spark_entry__.queries()
    for n in range(1, 11):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and set(SQL) <= set(QUERIES) <= set(names)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF), QUERIES[name], SQL[name], SF)[0] == ""


def test_nothing_else_imports_the_package():
    root = Path(corpus_pipeline.__file__).parent
    for path in (root / "outpulse").rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"\bllm\b|corpus_pipeline", path.read_text()), path


def test_stages_on_odd_rows_and_on_nothing(spark, odd, nothing):
    docs, rows = odd
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns[:5] == COLUMNS and stage(spark, nothing.select(*COLUMNS), SF).collect() == [], name
        assert out.count() <= len(rows)


def test_each_stage_equals_brute_force_on_its_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    texts = lambda df: {r.doc_id: r.text for r in df.collect()}

    scored = {r.doc_id for r in quality.classify(docs, labels).where("predicted = 1").collect()}
    good = stages["quality classifier"](spark, docs, SF)
    assert set(texts(good)) == scored

    rows = [(r.doc_id, r.text) for r in good.collect()]
    alone = stages["MinHash near-dedup"](spark, good, SF)
    assert set(texts(alone)) == {min(g) for g in brute_groups(rows)}

    grams = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = re.findall(r"[a-z0-9\u0080-\U0010ffff]+", r.text.lower())
        grams |= {tuple(w[i : i + 13]) for i in range(len(w) - 12)}
    kept = texts(stages["benchmark decontamination"](spark, alone, SF))
    for key, text in texts(alone).items():
        w = re.findall(r"[a-z0-9\u0080-\U0010ffff]+", text.lower())
        assert (key in kept) != any(tuple(w[i : i + 13]) in grams for i in range(len(w) - 12))

    clean = stages["secret scans"](spark, alone, SF).collect()
    before = texts(alone)
    assert len(clean) == len(before)
    for r in clean:
        assert r.text == secrets.redacted(before[r.doc_id]) and not base(r.text) and r.n_chars == len(r.text)
        assert r.text == before[r.doc_id] or base(before[r.doc_id])

    mixed = stages["mixing sources to target weights"](spark, alone, SF).collect()
    by_source, size = Counter(), Counter()
    for r in mixed:
        by_source[r.source] += r.copies * len(words(r.text))
    for r in alone.collect():
        size[r.source] += len(words(r.text))
    weight = {s: 1 + i % 3 for i, s in enumerate(sorted(size))}
    share = {s: sum(size.values()) * w / sum(weight.values()) for s, w in weight.items()}
    if all(share[s] <= 3 * size[s] for s in size):
        longest = max(len(words(r.text)) for r in alone.collect())
        assert all(abs(by_source[s] - share[s]) <= longest for s in size)
    assert all(1 <= r.copies <= 3 for r in mixed)


def test_run_gives_the_stages_rows(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == [*COLUMNS, "copies"] and 0 < out.count() < 200
