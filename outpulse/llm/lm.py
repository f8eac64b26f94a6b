"""Log-probabilities of texts: a subword lattice model beside a plain word model.

A text is its words, A-Z in lower case, and an end mark. The lattice model
gives a word the sum over all segmentations into pieces of an existing
vocabulary. The vocabulary's own scores weight the segmentations of the
training words; the expected uses of each piece, added up over the corpus and
smoothed by those scores, are the weights by which texts are scored.

Words are sent once per document part, not once per place: parts send their
distinct words to shards, a shard adds up counts and runs one lattice per
distinct word, and answers every part in the order it asked.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outpulse.llm.lattice import Lattices, Vocabulary, chunks, load
from outpulse.llm.packed import PART_BYTES, column, part_count, part_of, shard_runs, text_bytes
from outpulse.llm.words import _LOWER, Words, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_MESSAGE = pa.schema([("slot", pa.int64()), ("part", pa.int32()), ("words", pa.binary()), ("counts", pa.binary())])
#: Counts of one part fit 32 bits (part bytes bound them), those of the corpus do not.
_SUMMED = "<i8"
_MESSAGE_SQL = "slot long, part int, words binary, counts binary"


def fold(column_: str) -> Column:
    """crc32 of the id as text, mod 10; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column_).cast("string"), F.lit("")).cast("binary")) % 10


def _distinct(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, a place of each, and every word's number among them."""
    return np.unique(words.hashes(), return_index=True, return_inverse=True)


def _messages(part: int, words: Words, hashes: np.ndarray, place: np.ndarray, counts: np.ndarray, shard_bits: int) -> pa.Table:
    """One row per shard: the words in the order of their hashes, one space between two, and their counts."""
    lengths = words.end[place] - words.start[place]
    to = np.concatenate(([0], np.cumsum(lengths + 1)))
    out = np.full(to[-1], 0x20, np.uint8)
    shift = np.repeat(words.start[place] - to[:-1], lengths)
    spots = np.repeat(to[:-1] - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) + np.arange(lengths.sum())
    out[spots] = _LOWER[words.data[spots + shift]]
    counts = counts.astype("<u4")
    rows = [
        (shard, part, out[to[a] : to[b]].tobytes(), counts[a:b].tobytes())
        for shard, a, b in shard_runs(hashes, 64, shard_bits)
    ]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 4, _MESSAGE.types, strict=True)],
                    schema=_MESSAGE)


def _counter(shard_bits: int) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", PART_BYTES):
                words = Words(piece.column("text"), lower=True)
                hashes, place, number = _distinct(words)
                table = _messages(0, words, hashes, place, np.bincount(number, minlength=len(hashes)), shard_bits)
                yield from table.to_batches()

    return count


class _Asked:
    """Messages of one shard: distinct words with their summed counts, and who asked for which."""

    def __init__(self, messages: pa.Table):
        texts = messages.column("words").combine_chunks().cast(pa.large_binary()).cast(pa.large_string())
        self.words = Words(texts)
        _, place, self.number = _distinct(self.words)
        counts = np.frombuffer(b"".join(column(messages, "counts")), "<u4")
        self.counts = np.bincount(self.number, counts, minlength=len(place))
        self.start, self.length = self.words.start[place], (self.words.end - self.words.start)[place]

    def lattices(self, vocabulary: Vocabulary, used: np.ndarray) -> Iterator[tuple[np.ndarray, Lattices]]:
        used = used[np.argsort(self.length[used], kind="stable")]
        for a, b in chunks(self.length[used]):
            some = used[a:b]
            length = self.length[some]
            ends = np.cumsum(length)
            spots = np.repeat(self.start[some] - (ends - length), length) + np.arange(ends[-1])
            yield some, Lattices(vocabulary, self.words.data[spots], length)


def _expect(vocabulary: Vocabulary) -> Callable:
    def run(key: tuple, messages: pa.Table) -> pa.Table:
        asked, out = _Asked(messages), np.zeros(len(vocabulary.prior))
        for some, lattices in asked.lattices(vocabulary, np.arange(len(asked.counts))):
            out += lattices.expected(vocabulary.prior, asked.counts[some])
        return pa.table({"expected": [out.tobytes()], "tokens": [int(asked.counts.sum())], "kinds": [len(asked.counts)]})

    return run


def _answer(vocabulary: Vocabulary, weights: np.ndarray) -> Callable:
    def answer(key: tuple, messages: pa.Table) -> pa.Table:
        asked = _Asked(messages)
        logs = np.empty(len(asked.counts))
        for some, lattices in asked.lattices(vocabulary, np.arange(len(logs))):
            logs[some] = lattices.forward(weights)[lattices.last]
        counts, logs = asked.counts[asked.number].astype(_SUMMED), logs[asked.number]
        edges = np.concatenate(([0], np.cumsum([len(c) // 4 for c in column(messages, "counts")])))
        return pa.table([
            messages.column("part"), messages.column("slot"),
            pa.array([counts[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)], pa.binary()),
            pa.array([logs[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)], pa.binary()),
        ], names=["part", "slot", "counts", "logs"])

    return answer


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for all rows of a task: as many vectors as there are leave it as one."""
    out, tokens, kinds = None, 0, 0
    for batch in batches:
        for uses, n, k in zip(*(batch.column(c).to_pylist() for c in ("expected", "tokens", "kinds")), strict=True):
            vector = np.frombuffer(uses)
            out = vector.copy() if out is None else out + vector
            tokens, kinds = tokens + n, kinds + k
    if out is not None:
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary()), pa.array([tokens]), pa.array([kinds])], ["expected", "tokens", "kinds"])


_SUMS = "expected binary, tokens long, kinds long"


def score(docs: DataFrame, model: str = MODEL, part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs`` (doc_id, text).

    Learnt from rows whose :func:`fold` is not 0. ``base_score`` is the log10
    probability under word counts with 0.1 added, ``score`` that of the lattice
    model. A null text is empty: one token, the end. Equal rows count and are
    scored each. Words are told apart by 64-bit hashes. Without training rows
    all counts are 0 and the vocabulary's own weights score. ``model`` is a file
    on the driver; tasks get its trie, whose size the vocabulary bounds.
    """
    vocabulary = load(model)
    rows = docs.select("doc_id", F.col("text"), (fold("doc_id") == 0).alias("held_out"))
    parts = part_count(text_bytes(rows), part_bytes)
    shard_bits = max(0, math.ceil(math.log2(parts)))

    training = rows.where("NOT held_out")
    learnt = training.select("text").mapInArrow(_counter(shard_bits), _MESSAGE_SQL).groupBy("slot").applyInArrow(_expect(vocabulary), _SUMS)
    # A task sends one vector; between the tasks and the driver as many groups as each then has vectors.
    groups = math.isqrt(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))) + 1
    learnt = learnt.mapInArrow(_added, _SUMS).withColumn("g", F.spark_partition_id() % groups)
    learnt = learnt.repartition(groups, "g").drop("g").mapInArrow(_added, _SUMS).repartition(1).mapInArrow(_added, _SUMS).collect()
    ends = training.count()
    tokens = (learnt[0].tokens if learnt else 0) + ends
    kinds = (learnt[0].kinds if learnt else 0) + (ends > 0)
    uses = np.frombuffer(learnt[0].expected).copy() if learnt else np.zeros(len(vocabulary.prior))
    uses[vocabulary.end] += ends
    with np.errstate(divide="ignore"):
        weights = np.log(np.exp(vocabulary.prior) * len(uses) + uses) - np.log(len(uses) + uses.sum())
    base_all = math.log10(tokens + 0.1 * (kinds + 1))

    dealt = rows.withColumn("part", part_of(parts, "doc_id", "text"))

    def ask(key: tuple, texts: pa.Table) -> pa.Table:
        words = Words(texts.column("text"), lower=True)
        hashes, place, number = _distinct(words)
        learn = ~np.asarray(column(texts, "held_out"), bool)
        counts = np.bincount(number, learn[words.row], minlength=len(hashes))
        return _messages(key[0].as_py(), words, hashes, place, counts, shard_bits)

    def finish(key: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        words = Words(texts.column("text"), lower=True)
        _, _, number = _distinct(words)
        order = np.argsort(np.asarray(column(answers, "slot"), np.int64))
        joined = {c: b"".join(np.array(column(answers, c), dtype=object)[order]) for c in ("counts", "logs")}
        counts, logs = np.frombuffer(joined["counts"], _SUMMED)[number], np.frombuffer(joined["logs"])[number]
        n, row = words.rows, words.row
        tokens_ = words.per_row() + 1
        base = np.bincount(row, np.log10(counts + 0.1), minlength=n) + math.log10(ends + 0.1) - tokens_ * base_all
        full = (np.bincount(row, logs, minlength=n) + weights[vocabulary.end]) / math.log(10)
        known = np.bincount(row, counts > 0, minlength=n).astype(np.int64) + int(ends > 0)
        return pa.table({"doc_id": texts.column("doc_id"), "held_out": texts.column("held_out"), "n_tokens": tokens_.astype(np.int64),
                         "n_known": known, "train_tokens": np.full(n, tokens, np.int64), "base_score": base, "score": full})

    messages = dealt.groupBy("part").applyInArrow(ask, _MESSAGE_SQL)
    answers = messages.groupBy("slot").applyInArrow(_answer(vocabulary, weights), "part int, slot long, counts binary, logs binary")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(finish, out)
