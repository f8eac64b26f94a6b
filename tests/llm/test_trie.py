import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from outpulse.llm import trie

SCHEMA = "conv_id LONG, turn LONG, role STRING, text STRING, pos INT, key STRING, n LONG, a INT, e INT"


def symbol(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def ordered(rows):
    """conv_id -> turns in order, from (conv_id, turn, role, text)."""
    found = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            found[c].append((turn is not None, turn or 0, symbol(role or "", text or ""), role or "", text or ""))
    return {c: [t[3:] for t in sorted(ts)] for c, ts in found.items()}


def spliced(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = tuple(convs.get(c - c % 100, [])[:h] + own[h:])
    return out


def nodes(convs):
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                children[turns[: d - 1]].add(turns[:d])
        ends[turns].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for path in members:
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(members[path]) - 1) * len(path[-1][1]) if path else 0
    return sorted(
        (min(m), len(path), min(members[path[:-1]]) if path else -1, len(m), len(children[path]), leaves[path], saved[path],
         hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest())
        for path, m in members.items()
    )


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash", 2, 3, 4) for r in rows], SCHEMA).repartition(5)


def found(lists):
    return sorted(tuple(-1 if v is None else v for v in r) for r in trie.trie(lists).collect())


def test_spliced_odd_turns(spark):
    """Null and tied turns, null roles and texts, absent and short heads, conversations left without turns."""
    draw = random.Random(5)
    texts = [None, "", "a", "b", "ü" * 50, "word " * 20_000]
    rows = [(c, draw.choice([None, 0, 1, 2, 2, 3, 9]), draw.choice(["user", "assistant", None]), draw.choice(texts))
            for c in [*range(0, 30), *range(100, 140), *range(305, 330), 777] for _ in range(draw.randint(1, 8))]
    rows += rows[:9] + [(None, 0, "user", "no id"), (None, None, None, None)] * 3
    convs = spliced(ordered(rows))
    assert () in convs.values()
    lists = trie.with_shared_heads(trie.turn_lists(frame(spark, rows)))
    assert found(lists) == nodes(convs)


@pytest.mark.parametrize("hot", [False, True])
def test_batches_split_edges(spark, hot):
    """Few symbols and long ways: later batches cut edges of earlier ones at many depths; ``hot`` adds a third of equal ones."""
    draw = random.Random(11)
    convs = {}
    for c in range(700):
        base = convs[draw.randrange(c)][: draw.randint(0, 40)] if c and draw.random() < 0.8 else ()
        convs[c] = (base + tuple(("user", draw.choice("ab") * draw.randint(1, 2)) for _ in range(draw.randint(0, 12))))[:70]
    if hot:
        convs |= {c: convs[5] for c in range(1000, 1350)} | {c: convs[5][:3] for c in range(2000, 2050)}
    rows = [(c, i, *t) for c, ts in convs.items() for i, t in enumerate(ts)]
    present = {c for c, *_ in rows}
    lists = trie.turn_lists(frame(spark, rows))
    assert found(lists) == nodes({c: ts for c, ts in convs.items() if c in present})


def test_located_exit_nodes(spark):
    """The binary search ends at the deepest node on the way, for conversations that are in the trie and for others."""
    draw = random.Random(2)
    all_convs = {c: tuple(("u", draw.choice("ab")) for _ in range(draw.randint(1, 30))) for c in range(400)}
    rows = [(c, i, *t) for c, ts in all_convs.items() for i, t in enumerate(ts)]
    chains = trie.prefixes(trie.turn_lists(frame(spark, rows)))
    built = trie.build(chains.where("conv_id < 250"))
    inside = {all_convs[c] for c in range(250)}
    prefixes = {ts[:d] for ts in inside for d in range(len(ts) + 1)}
    explicit = {p for p in prefixes if p in inside or p == () or len({q for q in (p + (("u", x),) for x in "ab") if q in prefixes}) > 1}
    got = {r.conv_id: r for r in trie.locate(chains, built, 5).collect()}
    for c, ts in all_convs.items():
        along = max(d for d in range(len(ts) + 1) if ts[:d] in prefixes)
        deepest = max(d for d in range(along + 1) if ts[:d] in explicit)
        assert (got[c].a, got[c].shared) == (deepest, along), c
        assert (got[c].edge is not None) == (along > deepest)


def test_large_groups_of_ends(spark, monkeypatch):
    """Ids of a group that spans chunks, batches and partitions give the digest of the whole list."""
    ends = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(b"k")).otherwise(F.col("id").cast("string").cast("binary")).alias("key"), F.col("id").alias("conv_id"))
    got = {bytes(r.key): r.ends for r in trie.end_digests(ends).collect()}
    assert len(got) == 20_001
    assert got[b"k"] == hashlib.sha256(",".join(str(i) for i in range(0, 30_000, 3)).encode()).hexdigest()
    assert got[b"7"] == hashlib.sha256(b"7").hexdigest()


def test_empty(spark):
    lists = trie.with_shared_heads(trie.turn_lists(frame(spark, [(None, 0, "user", "x")])))
    assert found(lists) == []
