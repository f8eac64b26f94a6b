"""Subword lattices: the probability of a word summed over all its segmentations."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Bytes of words whose lattices are built at once.
CHUNK = 1 << 20
_MARK = np.frombuffer("▁".encode(), np.uint8)


class Vocabulary(NamedTuple):
    """Pieces as a double-array trie over bytes: ``piece[node]`` is an id or -1.

    ``byte[b]`` is the id of the piece for byte ``b`` alone, ``end`` that of the
    end mark, ``prior`` the log weight of every id, normalised.
    """

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray
    byte: np.ndarray
    end: int
    prior: np.ndarray


def load(path: str) -> Vocabulary:
    """Vocabulary of a sentencepiece model. Merge ranks in place of log weights become weights by Zipf's law."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(len(model))
    score = np.array([model.get_score(i) for i in ids])
    plain = np.array([not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)) for i in ids])
    usual = plain & (score > -1e8)
    byte = np.zeros(256, np.int64)
    for i in ids:
        if model.is_byte(i):
            byte[int(model.id_to_piece(i)[3:5], 16)] = i
    if np.all(score[usual] == np.round(score[usual])):
        score = np.where(usual, -np.log(2 - score), -np.log(2.0 + len(score)))
    least = score[usual].min()
    score = np.where(usual, score, least)
    score[model.eos_id()] = np.median(score[usual])
    alive = usual.copy()
    alive[byte], alive[model.eos_id()] = True, True
    score = np.where(alive, score, -np.inf)
    prior = score - np.logaddexp.reduce(score)
    pieces = {model.id_to_piece(i).encode(): i for i in ids if usual[i]}
    return Vocabulary(*_trie(pieces), byte, model.eos_id(), prior)


def _trie(pieces: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    children: list[dict[int, int]] = [{}]
    ends: dict[int, int] = {}
    for text, i in pieces.items():
        node = 0
        for b in text:
            if b not in children[node]:
                children[node][b] = len(children)
                children.append({})
            node = children[node][b]
        ends[node] = i
    size = 4 * len(children) + 512
    base, check, piece = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int64)
    taken, draw, place = np.zeros(size, bool), np.random.default_rng(0), {0: 0}
    taken[0] = True
    for node in sorted(range(len(children)), key=lambda x: (x != 0, -len(children[x]))):
        keys = np.fromiter(children[node], np.int64, len(children[node]))
        if not len(keys):
            continue
        at = int(draw.integers(1, size - 256))
        while taken[at + keys].any():
            at = int(draw.integers(1, size - 256))
        taken[at + keys] = True
        place.update(zip(children[node].values(), (at + keys).tolist(), strict=True))
        base[node] = at  # by node for now
    by_node, base = base[: len(children)].copy(), np.zeros(size, np.int64)
    for node, kids in enumerate(children):
        here = place[node]
        base[here] = by_node[node]
        piece[here] = ends.get(node, -1)
        for kid in kids.values():
            check[place[kid]] = here
    return base, check, piece


class Lattices:
    """Lattices of many words, each with the word mark in front, on one array of nodes."""

    def __init__(self, vocabulary: Vocabulary, data: np.ndarray, lengths: np.ndarray):
        """``data`` holds the words' bytes one after another."""
        n = len(lengths)
        full = lengths + len(_MARK)
        starts = np.concatenate(([0], np.cumsum(full)))
        text = np.empty(starts[-1] + 1, np.uint8)
        text[-1] = 0
        inside = np.ones(starts[-1], bool)
        for i, b in enumerate(_MARK):
            text[starts[:-1] + i] = b
            inside[starts[:-1] + i] = False
        text[:-1][inside] = data
        word = np.repeat(np.arange(n), full)
        stop = starts[1:][word]
        place = np.arange(starts[-1])
        source, target, piece = [place], [place + 1], [vocabulary.byte[text[:-1]]]
        at, node, depth = place, np.zeros(len(place), np.int64), 0
        while len(at):
            step = vocabulary.base[node] + text[at + depth]
            good = (vocabulary.check[step] == node) & (at + depth < stop[at]) & (vocabulary.base[node] > 0)
            at, node = at[good], step[good]
            depth += 1
            hit = vocabulary.piece[node] >= 0
            source.append(at[hit])
            target.append(at[hit] + depth)
            piece.append(vocabulary.piece[node[hit]])
        source, target, piece = np.concatenate(source), np.concatenate(target), np.concatenate(piece)
        owner = word[source]
        level = target - starts[owner]
        order = np.argsort(level * (starts[-1] + n + 1) + target, kind="stable")
        owner, self.level, self.piece = owner[order], level[order], piece[order]
        self.source, self.target = source[order] + owner, target[order] + owner
        self.first = starts[:-1] + np.arange(n)
        self.last = starts[1:] + np.arange(n)
        self.nodes = int(starts[-1]) + n
        self.edges = np.searchsorted(self.level, np.arange(1, (int(self.level[-1]) if len(order) else 0) + 2))

    def forward(self, weights: np.ndarray) -> np.ndarray:
        """Log of the summed weights of all paths from the word's start to every node."""
        alpha = np.full(self.nodes, -np.inf)
        alpha[self.first] = 0
        for a, b in zip(self.edges, self.edges[1:], strict=False):
            target = self.target[a:b]
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(target)) + 1))
            alpha[target[cuts]] = np.logaddexp.reduceat(alpha[self.source[a:b]] + weights[self.piece[a:b]], cuts)
        return alpha

    def expected(self, weights: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of every piece over all segmentations, words weighted by ``counts``."""
        alpha = self.forward(weights)
        mass, out = np.zeros(self.nodes), np.zeros(len(weights))
        mass[self.last] = counts
        for a, b in zip(self.edges[-2::-1], self.edges[:0:-1], strict=False):
            source, target, piece = self.source[a:b], self.target[a:b], self.piece[a:b]
            share = np.exp(alpha[source] + weights[piece] - alpha[target]) * mass[target]
            np.add.at(mass, source, share)
            out += np.bincount(piece, share, minlength=len(out))
        return out


def chunks(lengths: np.ndarray, limit: int = CHUNK) -> list[tuple[int, int]]:
    """Runs of words of about ``limit`` bytes."""
    ends, out, lo = np.cumsum(lengths), [], 0
    while lo < len(lengths):
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + limit, side="right")))
        out.append((lo, hi))
        lo = hi
    return out
