from collections import Counter

from odd_rows import nothing, odd, words  # noqa: F401

from outpulse.llm import repeats


def brute(rows, length):
    table = [words(t) for _, t, *_ in rows]
    counts = Counter(tuple(w[i : i + length]) for w in table for i in range(len(w) - length + 1))
    out = []
    for (key, *_), w in zip(rows, table, strict=True):
        gone = set()
        for i in range(len(w) - length + 1):
            if counts[tuple(w[i : i + length])] > 1:
                gone.update(range(i, i + length))
        out.append((key, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return Counter(out)


def test_equals_brute_force_over_many_parts(odd):
    docs, rows = odd
    for length in (35, 3):
        got = repeats.remove_repeats(docs, length=length, part_bytes=20_000)
        assert got.columns == ["doc_id", "n_words", "n_removed", "kept"]
        assert Counter(map(tuple, got.collect())) == brute(rows, length)


def test_empty_table(nothing):
    assert repeats.remove_repeats(nothing).collect() == []
