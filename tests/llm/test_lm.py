import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from odd_rows import lower, nothing, odd, words  # noqa: F401

from outpulse.llm import lattice, lm
from outpulse.llm.words import Words


@pytest.fixture(scope="module")
def vocabulary():
    return lattice.load(lm.MODEL)


@pytest.fixture(scope="module")
def pieces(vocabulary):
    model, found = sentencepiece.SentencePieceProcessor(model_file=lm.MODEL), {}
    for i in range(len(model)):
        if model.is_byte(i):
            found.setdefault(bytes([int(model.id_to_piece(i)[3:5], 16)]), []).append(i)
        elif np.isfinite(vocabulary.prior[i]) and not model.is_control(i):
            found.setdefault(model.id_to_piece(i).encode(), []).append(i)
    return found


def paths(word, pieces):
    """All segmentations as lists of ids."""
    if not word:
        return [[]]
    return [[i, *rest] for n in range(1, len(word) + 1) for i in pieces.get(word[:n], ()) for rest in paths(word[n:], pieces)]


def test_lattices_sum_all_segmentations(vocabulary, pieces):
    found = [w.encode() for w in ("the", "a", "é", "x9", "tion")]
    rows = lattice.Lattices(vocabulary, np.frombuffer(b"".join(found), np.uint8), np.array([len(w) for w in found]))
    total, counts = rows.forward(vocabulary.prior)[rows.last], np.arange(1.0, 6.0)
    expected = np.zeros(len(vocabulary.prior))
    for w, log, n in zip(found, total, counts, strict=True):
        every = paths("▁".encode() + w, pieces)
        weights = np.array([math.exp(sum(vocabulary.prior[i] for i in path)) for path in every])
        assert log == pytest.approx(math.log(weights.sum()))
        for path, share in zip(every, weights / weights.sum(), strict=True):
            for i in path:
                expected[i] += n * share
    assert np.allclose(rows.expected(vocabulary.prior, counts), expected)
    assert np.exp(vocabulary.prior).sum() == pytest.approx(1)


def test_scores_equal_brute_force(odd, vocabulary, pieces):
    docs, rows = odd
    got = lm.score(docs, part_bytes=30_000).collect()
    train, ends, table = Counter(), 0, []
    for key, t, *_ in rows:
        w, held = words(lower(t)), zlib.crc32(str(key if key is not None else "").encode()) % 10 == 0
        table.append((key, held, w))
        if not held:
            train.update(w)
            ends += 1
    n, kinds = sum(train.values()) + ends, len(train) + 1

    def forward(word, weights):
        text = "▁".encode() + word.encode()
        out = [1.0] + [0.0] * len(text)
        for j in range(1, len(text) + 1):
            out[j] = sum(out[i] * weights[p] for i in range(max(0, j - 48), j) for p in pieces.get(text[i:j], ()))
        return out[-1]

    short = [w for w in train if len(w) < 100]
    array = lattice.Lattices(vocabulary, np.frombuffer("".join(train).encode(), np.uint8), np.array([len(w.encode()) for w in train]))
    uses = array.expected(vocabulary.prior, np.array([float(c) for c in train.values()]))
    uses[vocabulary.end] += ends
    weights = (np.exp(vocabulary.prior) * len(uses) + uses) / (len(uses) + uses.sum())
    logs = {w: math.log10(forward(w, weights)) for w in short}
    want = []
    for key, held, w in table:
        base = sum(math.log10((train.get(x, 0) + 0.1) / (n + 0.1 * (kinds + 1))) for x in w) + math.log10((ends + 0.1) / (n + 0.1 * (kinds + 1)))
        known = sum(train.get(x, 0) > 0 for x in w) + 1
        score = None if any(len(x) >= 100 for x in w) else sum(logs.get(x) or math.log10(forward(x, weights)) for x in w) + math.log10(weights[vocabulary.end])
        want.append(((str(key), held, len(w) + 1, known, n), base, score))
    order = lambda r: (r[0], r[1])
    ours = sorted((((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens), r.base_score, r.score) for r in got), key=order)
    for a, b in zip(ours, sorted(want, key=order), strict=True):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1], rel=1e-9)
        assert b[2] is None or a[2] == pytest.approx(b[2], rel=1e-9)


def test_empty_table_and_no_training_rows(spark, nothing):
    assert lm.score(nothing).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    row = lm.score(spark.createDataFrame([(held, "only this")], "doc_id LONG, text STRING")).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 3, 0, 0) and row.score < 0


def test_counts_above_32_bits_are_sent_back(vocabulary):
    texts = Words(pa.array(["hot rare"]))
    hashes, place, _ = lm._distinct(texts)
    counts = np.where(texts.end[place] - texts.start[place] == 3, 3_000_000_000, 1)
    messages = pa.concat_tables([lm._messages(part, texts, hashes, place, counts, 0) for part in range(2)])
    answers = lm._answer(vocabulary, vocabulary.prior)((), messages)
    for sent in answers.column("counts").to_pylist():
        assert np.frombuffer(sent, lm._SUMMED).tolist() == (2 * counts).tolist()
