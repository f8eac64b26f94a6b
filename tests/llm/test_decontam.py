import itertools
import math
import random
import time

import numpy as np
from odd_rows import lower, nothing, odd  # noqa: F401

from outpulse.llm import decontam


def tokens(text):
    import re

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def brute_best(doc, item):
    """Most equal words of any segment of any alignment whose running score never makes a shorter one better."""
    best = 0
    for shift in range(-len(item) + 1, len(doc)):
        same = [doc[i + shift] == item[i] if 0 <= i + shift < len(doc) else None for i in range(len(item))]
        same = [s for s in same if s is not None]
        score = top = n = 0
        for s in same:
            score = score + 1 if s else max(0, score - decontam.PENALTY)
            n = n + s if score else 0
            if score > top:
                top, best = score, max(best, n)
    return best


def test_substitutions_short_items_and_odd_rows(spark, odd):
    draw = random.Random(2)
    vocabulary = [f"w{i}" for i in range(500)]
    items = {i: [draw.choice(vocabulary) for _ in range(n)] for i, n in enumerate([15, 20, 40, 59, 5, 9])}
    benchmark = [(i, "  ".join(w).upper(), 1) for i, w in items.items()] + [(90, " ".join(items[0]), 1), (91, "", 1), (92, None, 1), (None, "!!", 1)]
    plants, hurt = [], {}
    for i, w in items.items():
        for k in range(6):
            copy = list(w)
            for at in draw.sample(range(len(w)), len(w) // 15 if k % 2 and len(w) > 10 else 0):
                copy[at] = "zz"
            text = [draw.choice(vocabulary) for _ in range(30)] + copy + [draw.choice(vocabulary) for _ in range(10)]
            plants.append((7000 + 10 * i + k, ", ".join(text)))
            hurt[7000 + 10 * i + k] = i
    plants.append((7900, " ".join(items[2][:12])))
    docs = odd[0].select("doc_id", "text").union(spark.createDataFrame(plants + plants[:1], "doc_id LONG, text STRING"))
    test = spark.createDataFrame(benchmark, "item_id LONG, text STRING, rid INT")
    got = decontam.contaminated(docs, test).collect()
    assert {(r.doc_id, r.item_id) for r in got} == set(hurt.items()) and len(got) == len(hurt)
    assert all(r.matched >= min(13, r.item_words) for r in got)
    by_id = dict(plants)
    for r in got:
        assert r.matched >= brute_best(tokens(by_id[r.doc_id]), items[r.item_id]) - decontam.PENALTY
        assert r.doc_from == 30 + r.item_from


def test_best_overlap_finds_the_best_segment():
    draw = random.Random(4)
    for _ in range(200):
        doc = np.array([draw.randint(0, 2) for _ in range(30)])
        item = np.array([draw.randint(0, 2) for _ in range(12)])
        shift = draw.randint(-5, 25)
        n, a, b = decontam.best_overlap(doc, item, shift)
        score = lambda x, y: sum(1 if doc[i + shift] == item[i] else -decontam.PENALTY for i in range(x, y))  # noqa: E731, B023
        spots = range(max(0, -shift), min(12, 30 - shift) + 1)
        assert score(a, b) == max(score(x, y) for x in spots for y in spots if x <= y)
        assert n == sum(doc[i + shift] == item[i] for i in range(a, b))


def seeded(equal, masks):
    """Whether a placement of a mask selects equal words only."""
    return any(all(equal[o + j] for j, c in enumerate(mask) if c == "1") for mask in masks for o in range(len(equal) - len(mask) + 1))


def test_masks_leave_a_hit_in_every_overlap_that_is_reported():
    for n in range(12, 21):
        for k in range(5):
            if n - k >= decontam.needed(n) and 5 * (n - k) >= 4 * n:
                for spots in itertools.combinations(range(n), k):
                    assert seeded([i not in spots for i in range(n)], decontam.MASKS), (n, spots)
    for period in range(5, 13):
        for at in range(period):
            assert seeded([i % period != at for i in range(40)], decontam.MASKS), (period, at)
    for n in range(1, 12):
        masks = [m for m, _ in decontam.masks_for([n])[len(decontam.MASKS) :]]
        assert all(m.count("1") >= min(n, 4) for m in masks)
        for spots in itertools.combinations(range(n), n - decontam.needed(n)):
            assert seeded([i not in spots for i in range(n)], masks), (n, spots)


def test_replaced_words_are_found(spark):
    draw = random.Random(6)
    items = {n: [f"w{n}x{i}" for i in range(n)] for n in (5, 7, 10, 11, 12, 15, 600)}
    plants, want = [], set()
    for n, words in items.items():
        every = [range(5, n, 6)] if n == 600 else itertools.combinations(range(n), n - decontam.needed(n))
        for spots in every:
            copy = ["zz" if i in spots else w for i, w in enumerate(words)]
            plants.append((len(plants), " ".join([draw.choice("abc") for _ in range(3)] + copy)))
            want.add((plants[-1][0], n))
    docs = spark.createDataFrame(plants, "doc_id LONG, text STRING")
    test = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id INT, text STRING")
    assert {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, test).collect()} == want


def test_whole_overlap_tolerates_replaced_words():
    for n in range(12, 21):
        item, need = np.arange(n), min(13, math.ceil(0.8 * n))
        for k in (1, 2):
            for spots in itertools.combinations(range(n), k):
                doc = np.concatenate((np.full(7, -1), item, np.full(5, -2)))
                doc[[7 + at for at in spots]] = -3
                got, first, end = decontam.whole_overlap(doc, item, 7)
                assert decontam.needed(n) == need
                assert got >= need and got == sum(at not in spots for at in range(first, end)) and 5 * got >= 4 * (end - first)


def test_whole_overlap_equals_all_segments():
    draw = random.Random(5)
    for _ in range(300):
        doc = np.array([draw.choice([0, 0, 0, 0, 1]) for _ in range(40)])
        item = np.array([draw.choice([0, 0, 0, 0, 1]) for _ in range(25)])
        shift = draw.randint(-10, 25)
        n, a, b = decontam.whole_overlap(doc, item, shift)
        same = {i: doc[i + shift] == item[i] for i in range(max(0, -shift), min(25, 40 - shift))}
        spots = [*same, max(same) + 1]
        every = [sum(same[i] for i in range(x, y)) for x in spots for y in spots if x <= y and 5 * sum(same[i] for i in range(x, y)) >= 4 * (y - x)]
        assert n == max(every) == sum(same[i] for i in range(a, b)) and 5 * n >= 4 * (b - a)


def test_empty_tables(spark, odd, nothing):
    none = spark.createDataFrame([], "item_id LONG, text STRING")
    some = spark.createDataFrame([(1, "a b c d e f g h i j k l m n o p")], "item_id LONG, text STRING")
    assert decontam.contaminated(odd[0], none).collect() == []
    assert decontam.contaminated(nothing, some).collect() == []


def test_distinct_shifts():
    draw = np.random.default_rng(3)
    for n, m in ((1, 1), (5, 60), (700, 40), (300, 900)):
        a, b = (np.unique(draw.integers(0, 3000, k)).astype(np.int32) for k in (n, m))
        assert decontam.distinct_shifts(a, b).tolist() == sorted({int(p) - int(q) for p in a for q in b})


def test_words_repeated_in_text_and_item(spark):
    """Pairs of places grow with the product of the repeats, shifts with their sum."""
    texts = [(1, "w " * 40_000), (2, "a b " * 3000 + "w " * 30), (3, "w " * 12), (4, "clean text of no overlap at all")]
    items = [(10, "w " * 200), (11, "a b " * 100), (12, "w " * 60 + "a b " * 20)]
    start = time.time()
    got = {(r.doc_id, r.item_id): r.matched for r in decontam.contaminated(
        spark.createDataFrame(texts, "doc_id LONG, text STRING"), spark.createDataFrame(items, "item_id LONG, text STRING")).collect()}
    assert got[1, 10] == 200 and got[2, 11] == 200 and got[2, 10] == 30
    for (doc, item), matched in got.items():
        words, own = dict(texts)[doc].split(), dict(items)[item].split()
        if len(words) < 7000:
            best = max(decontam.whole_overlap(*(np.array([hash(x) for x in t], np.int64) for t in (words, own)), s)[0] for s in range(-len(own) + 1, len(words)))
            assert matched == best
    assert (3, 10) not in got and not any(d == 4 for d, _ in got)
    assert time.time() - start < 60
