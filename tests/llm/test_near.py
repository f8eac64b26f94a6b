import random
from collections import Counter

import numpy as np
import pyarrow as pa
from odd_rows import nothing, odd, words  # noqa: F401

from outpulse.llm import near
from outpulse.llm.words import Words


def bags(text):
    w = words(text)
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def exact(a, b):
    if max(a.values()) == max(b.values()) == 1:
        return len(a.keys() & b.keys()) / len(a.keys() | b.keys())
    return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in a.keys() | b.keys()) for i in a.keys() & b.keys())


def brute_groups(rows):
    bag, root = [bags(t) for _, t, *_ in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = (rows[i][1] or "") == (rows[j][1] or "")
            if same or (bag[i] and bag[j] and bag[i].keys() & bag[j].keys() and exact(bag[i], bag[j]) >= 0.8):
                root[find(i)] = find(j)
    out = {}
    for i in range(len(rows)):
        out.setdefault(find(i), []).append(rows[i][0])
    return Counter(tuple(sorted(g, key=str)) for g in out.values())


def grouped(found):
    out = {}
    for r in found:
        out.setdefault(r.keeper, []).append(r)
    for rows in out.values():
        ids = [r.doc_id for r in rows if r.doc_id is not None]
        assert {r.group_id for r in rows} == {min(ids, default=None)} and {r.group_size for r in rows} == {len(rows)}
    return Counter(tuple(sorted((r.doc_id for r in rows), key=str)) for rows in out.values())


def test_odd_rows(odd):
    docs, rows = odd
    assert grouped(near.near_groups(docs).collect()) == brute_groups(rows)
    kept = near.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == sum(brute_groups(rows).values())


def test_empty_table(nothing):
    assert near.near_groups(nothing).collect() == [] and near.keep_first(nothing).collect() == []


def test_chain_and_group_around_a_missing_centre(spark):
    """Copies that are near each other only through some of them, in a group larger than a tile."""
    draw = random.Random(5)
    base = [f"w{draw.randint(0, 9999)}" for _ in range(200)]
    rows = []
    for i in range(620):
        copy = list(base)
        for at in draw.sample(range(200), 4 if i % 3 else 2):
            copy[at] = f"v{draw.randint(0, 99999)}"
        rows.append((i, " ".join(copy)))
    chain = list(base[::-1])
    for i in range(8):
        rows.append((1000 + i, " ".join(chain)))
        for at in range(12 * i, 12 * i + 3):
            chain[at * 2] = f"c{i}{at}"
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    assert grouped(near.near_groups(docs).collect()) == brute_groups(rows)


def test_signature_estimates_probability_jaccard():
    a, b = "a b c d e f g h a b c d e f g h i j k l m n", "a b c d e f g h a b c d e i j k l m n o p q"
    row, key, weight = near.shingles(Words(pa.array([a, b, None, "one two"])))
    sig = near.signatures(row, key, weight, 4, slots=4096)
    assert abs((sig[0] == sig[1]).mean() - exact(bags(a), bags(b))) < 0.03
    assert not sig[2].any() and len(np.unique(sig[3])) == 1
    sets = [(key[row == r], weight[row == r]) for r in (0, 1)]
    assert abs(near.probability_jaccard(*sets) - exact(bags(a), bags(b))) < 1e-12
