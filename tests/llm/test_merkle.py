import hashlib
import zlib

from odd_rows import SF, nothing, odd  # noqa: F401
from pyspark.sql import functions as F

from outpulse.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    return h(*[field(v) for v in (doc_id, source, lang, n_chars, text)])


def tree(leaves):
    """The root and, for every leaf, the (left, right) digests on its way."""
    ways, levels = [[] for _ in leaves], [leaves]
    at = list(range(len(leaves)))
    while len(levels[-1]) > 1:
        level = levels[-1]
        for i, p in enumerate(at):
            other = level[p ^ 1] if p ^ 1 < len(level) else ""
            ways[i].append((other, "") if p & 1 else ("", other))
            at[i] = p // 2
        levels.append([h(*level[i : i + 2]) for i in range(0, len(level), 2)])
    return levels[-1][0], ways


def manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf_of(*r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    found = {g: sorted(groups[g], key=lambda x: x[:3]) for g in names}
    lower = {g: tree([x[2] for x in found[g]]) for g in names}
    root, upper = tree([lower[g][0] for g in names])
    out = []
    for g, over in zip(names, upper, strict=True):
        for (_, _, leaf, r), way in zip(found[g], lower[g][1], strict=True):
            way = way + over
            node = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                node = leaf_of(r[0], r[1], r[2], r[3] + 1, r[4])
            for left, right in way:
                node = h(left, node, right)
            out.append((r[0], leaf, lower[g][0], root, h(*[a + b for a, b in way]), node, node == root))
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def checked(docs):
    found = merkle.verify(docs)
    assert found.columns == COLUMNS
    return sorted(map(tuple, found.collect()), key=repr)


def test_odd_rows(odd):
    docs = odd[0].withColumn("lang", F.when(F.col("doc_id") % 5 == 0, "").when(F.col("doc_id") % 3 == 0, "é").when(F.col("doc_id") % 7 != 1, "en"))
    docs = docs.withColumns({"g": F.lit("x"), "pos": F.lit(1), "leaf": F.lit("clash"), "path": F.lit(0), "changed": F.lit("c")})
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert checked(docs) == sorted(manifest(rows), key=repr)


def test_block_bounds(spark):
    """Groups that fill blocks exactly, by one less and by one more."""
    rows = [(i, "s", f"l{n}", i % 3 or None, f"t{i}") for n in (1, 2, 255, 256, 257, 513, 1281) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id LONG, source STRING, lang STRING, n_chars LONG, text STRING").repartition(5)
    assert checked(docs) == sorted(manifest(rows), key=repr)


def test_many_groups_and_tiers(spark, monkeypatch):
    """Small blocks give several tiers, below and above the subroots."""
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "BLOCK", 4)
    rows = [(i, None, f"l{i % 23}" if i % 23 else None, i, "") for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id LONG, source STRING, lang STRING, n_chars LONG, text STRING").repartition(3)
    assert checked(docs) == sorted(manifest(rows), key=repr)


def test_repeated_rows_and_empty(spark, nothing):
    rows = [(None, None, None, None, None)] * 300 + [(7, "s", "en", 1, "t")] * 5
    docs = spark.createDataFrame(rows, "doc_id LONG, source STRING, lang STRING, n_chars LONG, text STRING").repartition(4)
    assert checked(docs) == sorted(manifest(rows), key=repr)
    assert checked(nothing) == []


def test_every_change_is_found(spark):
    """All rows with a number fail once it is changed; no leaf or sibling reaches the executors' Python."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = merkle.verify(docs, F.lit(True))
    assert found.where("verified").count() == docs.where("n_chars IS NULL").count()
    assert "Python" not in found._jdf.queryExecution().toString()
