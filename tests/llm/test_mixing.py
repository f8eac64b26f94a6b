import duckdb
import pytest
from odd_rows import nothing, odd, words  # noqa: F401
from pyspark.sql import functions as F

from outpulse.llm import mixing


def test_odd_rows_against_sql(odd):
    docs, rows = odd
    con = duckdb.connect()
    con.execute("CREATE TABLE docs (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO docs VALUES (?, ?, ?)", [r for r in rows if "\x00" not in (r[1] or "")])
    want = con.execute("WITH " + mixing.MIX_SQL.format(docs="docs", seed="mix")
                       + " SELECT doc_id, size, source_size, target, copies, size * copies FROM mixed").fetchall()
    clean = docs.where("text IS NULL OR instr(text, chr(0)) = 0")
    got = [tuple(r) for r in mixing.mix(clean).collect()]
    order = lambda r: tuple(str(x) for x in r)
    assert sorted(map(order, got)) == sorted(map(order, want))
    # Columns named like those of the plan stay as they are; ``copies`` is the operator's own.
    clash = {c: F.lit(f"own {c}") for c in ("target", "cut", "whole", "last", "source_size", "h", "copies")}
    mixed = mixing.mixed(clean.withColumns(clash))
    assert mixed.columns == [c for c in clean.withColumns(clash).columns if c != "copies"] + ["copies"]
    assert {tuple(r) for r in mixed.select("target", "cut", "whole", "last", "source_size").distinct().collect()} == {
        ("own target", "own cut", "own whole", "own last", "own source_size")}
    assert sorted((str(r.doc_id), r.copies) for r in mixed.collect()) == sorted((str(r[0]), r[4]) for r in want if r[4])


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 1000}, {"a": 5, "b": 0, "c": 7, None: 1}, {"a": 1}])
def test_targets(spark, sizes):
    rows = [(s, n) for s, n in sizes.items()]
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(rows, "source STRING, size LONG")).collect()}
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    want, free, left = {}, set(names), float(sum(sizes.values()))
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            break
        want |= {s: 3.0 * sizes[s] for s in over}
        free, left = free - over, left - sum(3.0 * sizes[s] for s in over)
    want |= share
    assert got == pytest.approx(want)


def test_taken_words_come_near_the_target(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 50)), "abc"[i % 3]) for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING")).collect()
    source = {r[0]: r[2] for r in rows}
    for s in "abc":
        own = [r for r in got if source[r.doc_id] == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 25 and all(r.taken <= 3 * r.size for r in own)
        assert all(r.size == len(words(rows[r.doc_id][1])) for r in own)


def test_empty_table(nothing):
    assert mixing.mix(nothing).collect() == [] and mixing.mixed(nothing.drop("copies")).collect() == []
