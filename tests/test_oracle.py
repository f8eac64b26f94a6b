"""Every registered query against its SQL twin, and the shape of its plan."""

import re
from pathlib import Path

import pytest
from conftest import plan_of
from oracle import compare, connect

import __spark_entry__ as entry_module
from outpulse.catalog import QUERIES, SQL


SF = "/root/testdata/sf0.001"
# Scorers.
PYTHON = {"score_posts", "opportunities", "digest_opportunities", "payload_opportunities", "agg_run_counts"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    frames = []

    def run(session, sf):
        frames.append(QUERIES[name](session, sf))
        return frames[-1]

    problem, _ = compare(spark, con, run, SQL.get(name), SF)
    assert problem == ""
    plan = plan_of(frames[0])
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "MapInPandas" not in plan
    assert ("ArrowEvalPython" in plan) <= (name in PYTHON)


def test_names():
    assert SQL.keys() == QUERIES.keys()


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_library_collects_nothing_unbounded():
    """Driver reads are single rows, or lists that were limited or counted before."""
    allowed = {
        "operators/keyed.py": 2,  # largest group, size check
        "operators/mentions.py": 5,  # size of a phrase table, a list of checked size, counts by kind, anchor widths, shard sizes
        "operators/outreach.py": 1,  # rows and failures of a scoring job
        "sources/firsts.py": 1,  # last filed day
        "sources/ledger.py": 2,  # last run
        "sources/archive.py": 2,  # date span of a batch, count of a finished batch
        "sources/seen.py": 1,  # bucket numbers of a batch, 256 at most
        "plans/digests.py": 1,  # largest digest
    }
    root = Path(entry_module.__file__).parent / "outpulse"
    for path in root.rglob("*.py"):
        if path.parent.name in ("catalog", "llm"):
            continue
        found = len(re.findall(r"(?<!\bF)\.(?:collect|first|toPandas|toLocalIterator|take|head)\(", path.read_text()))
        assert found == allowed.get(str(path.relative_to(root)), 0), path
