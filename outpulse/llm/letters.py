"""A model of how words are spelt, to tell words that no list has from random letters."""

from __future__ import annotations

import functools
import math
import unicodedata
from collections import Counter

from outpulse.llm.ordinary import FRENCH, GERMAN, SPANISH, WORDS

#: Bits a letter up to which letters count as a word. Random letters cost 6.6 or more in 19 of 20 cases, long words 5.6 or less.
WORDLIKE = 5.8
_SMOOTH, _BACK = 0.3, 2.0


def plain(text: str) -> str:
    """Lower case without accents."""
    return "".join(c for c in unicodedata.normalize("NFD", text.lower().replace("ß", "ss")) if "a" <= c <= "z" or c == " ")


@functools.cache
def _counts() -> tuple[Counter, Counter, Counter]:
    """Pairs and triples of letters in the listed words, and how often a letter is followed."""
    pairs, triples, firsts = Counter(), Counter(), Counter()
    for word in set(plain(f"{WORDS} {GERMAN} {FRENCH} {SPANISH}").split()):
        pairs.update(word[i : i + 2] for i in range(len(word) - 1))
        firsts.update(word[:-1])
        triples.update(word[i : i + 3] for i in range(len(word) - 2))
    return pairs, triples, firsts


def bits(word: str) -> float:
    """Mean bits of a letter given the two before it, counts of two and three letters mixed."""
    pairs, triples, firsts = _counts()
    word, total = plain(word), 0.0
    for i in range(1, len(word)):
        chance = (pairs[word[i - 1 : i + 1]] + _SMOOTH) / (firsts[word[i - 1]] + 26 * _SMOOTH)
        if i > 1:
            chance = (triples[word[i - 2 : i + 1]] + _BACK * chance) / (pairs[word[i - 2 : i]] + _BACK)
        total -= math.log2(chance)
    return total / max(1, len(word) - 1)


def is_wordlike(word: str) -> bool:
    return bits(word) <= WORDLIKE
