"""License detection by ordered signature rules over normalised words.

A text is read as lower-case words (runs of letters, digits and non-ASCII
characters), joined by one space. Hundreds of regular expressions, written per
licence family from a few phrasings, run only where their keywords occur. A
detection inside another of the same or higher priority is suppressed.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outpulse.llm.words import Words, slices


class Rule(NamedTuple):
    label: str
    pattern: str
    keywords: tuple[str, ...]
    word: str
    priority: int
    confidence: float


# Label, name as a regular expression, its keywords (any of them), versions.
FAMILIES = (
    ("apache", r"apache(?: software)?(?: license| licence)?", ("apache",), ("1.0", "1.1", "2.0")),
    ("gpl", r"(?:gnu )?(?:gpl|general public licen[cs]e)", ("gpl", "general public licen"), ("1.0", "2.0", "3.0")),
    ("lgpl", r"(?:gnu )?(?:lgpl|(?:lesser|library) general public licen[cs]e)", ("lgpl", "general public licen"), ("2.0", "2.1", "3.0")),
    ("agpl", r"(?:gnu )?(?:agpl|affero general public licen[cs]e)", ("agpl", "affero general public"), ("1.0", "3.0")),
    ("gfdl", r"(?:gnu )?(?:gfdl|free documentation licen[cs]e)", ("gfdl", "free documentation licen"), ("1.1", "1.2", "1.3")),
    ("mpl", r"(?:mpl|mozilla public licen[cs]e)", ("mpl", "mozilla public"), ("1.0", "1.1", "2.0")),
    ("epl", r"(?:epl|eclipse public licen[cs]e)", ("epl", "eclipse public"), ("1.0", "2.0")),
    ("cddl", r"(?:cddl|common development and distribution licen[cs]e)", ("cddl", "common development and"), ("1.0", "1.1")),
    ("cpl", r"(?:cpl|common public licen[cs]e)", ("cpl", "common public"), ("1.0",)),
    ("eupl", r"(?:eupl|european union public licen[cs]e)", ("eupl", "european union public"), ("1.0", "1.1", "1.2")),
    ("osl", r"(?:osl|open software licen[cs]e)", ("osl", "open software licen"), ("1.0", "2.0", "2.1", "3.0")),
    ("afl", r"(?:afl|academic free licen[cs]e)", ("afl", "academic free"), ("2.0", "2.1", "3.0")),
    ("artistic", r"artistic licen[cs]e", ("artistic licen",), ("1.0", "2.0")),
    ("bsl", r"(?:bsl|boost software licen[cs]e)", ("bsl", "boost software"), ("1.0",)),
    ("busl", r"(?:busl|business source licen[cs]e)", ("busl", "business source"), ("1.0", "1.1")),
    ("ofl", r"(?:ofl|(?:sil )?open font licen[cs]e)", ("ofl", "open font"), ("1.0", "1.1")),
    ("odbl", r"(?:odbl|open (?:data commons open )?database licen[cs]e)", ("odbl", "database licen"), ("1.0",)),
    ("cecill", r"cecill(?: [abc])?(?: licen[cs]e)?", ("cecill",), ("1.0", "2.0", "2.1")),
    ("lppl", r"(?:lppl|latex project public licen[cs]e)", ("lppl", "latex project public"), ("1.0", "1.2", "1.3")),
    ("ms-pl", r"(?:ms pl|microsoft public licen[cs]e)", ("ms pl", "microsoft public"), ()),
    ("ms-rl", r"(?:ms rl|microsoft reciprocal licen[cs]e)", ("ms rl", "microsoft reciprocal"), ()),
    ("zlib", r"zlib(?: libpng)? licen[cs]e", ("zlib",), ()),
    ("isc", r"isc licen[cs]e", ("isc licen",), ()),
    ("mit", r"(?:mit|expat|x11) licen[cs]e", ("mit licen", "expat licen", "x11 licen"), ()),
    ("mit-0", r"mit (?:no attribution|0) licen[cs]e", ("mit no attribution", "mit 0"), ()),
    ("bsd-2", r"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: licen[cs]e)?", ("bsd",), ()),
    ("bsd-3", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: licen[cs]e)?", ("bsd",), ()),
    ("bsd-4", r"(?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[cs]e)?", ("bsd",), ()),
    ("0bsd", r"(?:0bsd|zero clause bsd)(?: licen[cs]e)?", ("bsd",), ()),
    ("bsd", r"bsd(?: style)? licen[cs]e", ("bsd",), ()),
    ("unlicense", r"unlicense", ("unlicense",), ()),
    ("wtfpl", r"(?:wtfpl|do what the f\w+ you want to public licen[cs]e)", ("wtfpl", "you want to public"), ()),
    ("python", r"(?:psf|python software foundation) licen[cs]e", ("psf licen", "python software foundation"), ("2.0",)),
    ("php", r"php licen[cs]e", ("php licen",), ("3.0", "3.01")),
    ("ruby", r"ruby licen[cs]e", ("ruby licen",), ()),
    ("openssl", r"openssl licen[cs]e", ("openssl",), ()),
    ("postgresql", r"postgresql licen[cs]e", ("postgresql",), ()),
    ("vim", r"vim licen[cs]e", ("vim licen",), ()),
    ("w3c", r"w3c (?:software (?:notice and )?)?licen[cs]e", ("w3c",), ()),
    ("ncsa", r"(?:university of illinois )?ncsa(?: open source)? licen[cs]e", ("ncsa",), ()),
    ("upl", r"(?:upl|universal permissive licen[cs]e)", ("upl", "universal permissive"), ("1.0",)),
    ("blueoak", r"blue oak model licen[cs]e", ("blue oak",), ("1.0",)),
    ("sspl", r"(?:sspl|server side public licen[cs]e)", ("sspl", "server side public"), ("1.0",)),
    ("elastic", r"elastic licen[cs]e", ("elastic licen",), ("1.0", "2.0")),
    ("cc0", r"(?:cc0|cc zero|creative commons zero)(?: licen[cs]e)?", ("cc0", "cc zero", "creative commons zero"), ("1.0",)),
    ("cc-by", r"(?:cc by|creative commons attribution)(?: international)?(?: licen[cs]e)?", ("cc by", "creative commons attribution"), ("2.0", "2.5", "3.0", "4.0")),
    ("cc-by-sa", r"(?:cc by sa|creative commons attribution share ?alike)(?: international)?(?: licen[cs]e)?", ("cc by", "creative commons attribution"), ("2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nd", r"(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s?)(?: international)?(?: licen[cs]e)?", ("cc by", "creative commons attribution"), ("2.0", "3.0", "4.0")),
    ("cc-by-nc", r"(?:cc by nc|creative commons attribution non ?commercial)(?: international)?(?: licen[cs]e)?", ("cc by", "creative commons attribution"), ("2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-sa", r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: international)?(?: licen[cs]e)?", ("cc by", "creative commons attribution"), ("2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-nd", r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s?)(?: international)?(?: licen[cs]e)?", ("cc by", "creative commons attribution"), ("2.0", "2.5", "3.0", "4.0")),
)

# Sentences that carry a licence or a notice without its name.
SENTENCES = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy", "hereby granted", 4, 0.95),
    ("bsd", r"redistribution and use in source and binary forms with or without modification", "redistribution", 4, 0.9),
    ("isc", r"permission to use copy modify and(?: or)? distribute this software", "permission to use", 4, 0.9),
    ("zlib", r"this software is provided as is without any express or implied warranty", "as is without any", 3, 0.7),
    ("gpl", r"this program is free software you can redistribute it and or modify it", "free software", 4, 0.9),
    ("public-domain", r"(?:released|dedicated|placed|is) (?:in|into|to) the public domain", "public domain", 3, 0.8),
    ("public-domain", r"public domain", "public domain", 1, 0.4),
    ("proprietary", r"all rights reserved", "all rights", 1, 0.4),
    ("proprietary", r"(?:proprietary and confidential|may not be reproduced without (?:prior )?(?:written )?permission)", "pro", 2, 0.6),
    ("copyright", r"copyright (?:c )?(?:19|20)\d\d", "copyright", 1, 0.3),
)

# Whole words of which every rule and every base phrase needs one at least.
ROOTS = (
    "license licence licensed released distributed available published spdx apache gpl lgpl agpl gfdl mpl epl cddl cpl eupl osl "
    "afl bsl busl ofl odbl cecill lppl ms bsd freebsd 0bsd unlicense wtfpl upl sspl cc0 cc creative redistribution permission "
    "provided redistribute domain rights reproduced proprietary copyright"
).split()
# Short names with the version glued on are words of their own: gplv3, lgpl2. Not apache2, which is mostly the web server.
_GLUED = {"gpl", "lgpl", "agpl", "gfdl", "mpl", "epl", "cddl", "cpl", "eupl", "osl", "afl", "bsl", "busl", "ofl", "odbl", "cecill", "lppl", "upl", "sspl"}
ROOTS += sorted({f"{label}{v}{number[0]}" for label, _, _, versions in FAMILIES if label in _GLUED for number in versions for v in ("", "v")})

# The base phrases and their labels.
PHRASES = ((b"mit license", "mit"), (b"apache license", "apache"), (b"general public license", "gpl"))


@functools.cache
def rules() -> tuple[Rule, ...]:
    """All rules, highest priority first: phrasings of every family and version, then whole sentences."""
    out = []
    for label, name, keywords, versions in FAMILIES:
        out.append(Rule(label, rf"\b{name}\b", keywords, "", 1, 0.5))
        out.append(Rule(label, rf"\b(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?{name}\b", keywords, "under", 2, 0.8))
        out.append(Rule(label, rf"\bspdx license identifier {label.replace('-', ' ')}\b", ("spdx",), "", 5, 1.0))
        for version in versions:
            major, _, minor = version.partition(".")
            number = rf"{major}(?: {minor})?" if minor == "0" else rf"{major} {minor}"
            full = f"{label}-{version}"
            gap = r"(?: (?:version |v ?)?|v ?|)" if label in _GLUED else r" (?:version |v ?)?"
            out.append(Rule(full, rf"\b{name}{gap}{number}\b(?! \d)", keywords, major, 3, 0.9))
            out.append(Rule(full, rf"\bspdx license identifier {label.replace('-', ' ')} {number}\b", ("spdx",), "", 6, 1.0))
            if label in ("gpl", "lgpl", "agpl", "gfdl"):
                later = rf"\b{name}(?: (?:(?:as published by the free software foundation )?(?:either )?)?(?:version |v ?)?|v ?|){number}(?: of the license)? or (?:\(?at your option\)? )?(?:any )?later"
                out.append(Rule(full + "-or-later", later, keywords, "later", 4, 0.95))
    out += [Rule(label, rf"\b{pattern}\b", (word,), "", priority, sure) for label, pattern, word, priority, sure in SENTENCES]
    return tuple(sorted(out, key=lambda r: (-r.priority, r.label, r.pattern)))


@functools.cache
def _compiled() -> tuple[tuple[int, Rule, re.Pattern[bytes], tuple[bytes, ...], bytes], ...]:
    return tuple(
        (i, r, re.compile(r.pattern.encode()), tuple(k.encode() for k in r.keywords), r.word.encode())
        for i, r in enumerate(rules())
    )


@functools.cache
def _roots() -> np.ndarray:
    return np.sort(Words(pa.array([" ".join(ROOTS)]), alnum=True, lower=True).hashes())


_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_BASE = tuple((re.compile(b"(?= " + phrase + b" )"), label) for phrase, label in PHRASES)


def detect(words: bytes) -> list[tuple[int, int, int, int]]:
    """(first word, word after the last, rule, priority) of the detections that stay, in order of place.

    ``words`` are joined by one space, with a space at both ends.
    """
    found = []
    for i, rule, pattern, keywords, word in _compiled():
        if any(k in words for k in keywords) and word in words:
            found += [(m.start(), -m.end(), -rule.priority, i) for m in pattern.finditer(words)]
    found.sort()
    furthest = {rule.priority: 0 for rule in rules()}
    kept = []
    for start, end, priority, i in found:
        if all(furthest[p] < -end for p in furthest if p >= -priority):
            kept.append((start, -end, i, -priority))
            furthest[-priority] = max(furthest[-priority], -end)
    places, spot, word = [], 0, 0
    for start, end, i, priority in kept:
        word += words.count(b" ", spot, start)
        spot = start
        places.append((word - 1, word + words.count(b" ", start, end), i, priority))
    return places


def _base(words: bytes) -> list[tuple[int, str]]:
    out = []
    for pattern, label in _BASE:
        word, spot = 0, 0
        for m in pattern.finditer(words):
            word += words.count(b" ", spot, m.start())
            spot = m.start()
            out.append((word, label))
    return sorted(out)


_FOUND = pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("label", pa.string()),
                             ("priority", pa.int32()), ("confidence", pa.float64())]))
_PLACES = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = rules()
    for batch in batches:
        for piece in slices(batch, "text"):
            words = Words(piece.column("text"), alnum=True, lower=True)
            offsets, opened = words.offsets, np.zeros(piece.num_rows, dtype=bool)
            opened[words.row[np.isin(words.hashes(), _roots())]] = True
            detections, base = [], []
            for row in range(piece.num_rows):
                if opened[row]:
                    text = words.data[offsets[row] : offsets[row + 1]].tobytes().lower()
                    text = b" " + b" ".join(_WORD.findall(text)) + b" "
                    detections.append([
                        {"first_word": x, "end_word": y, "label": table[i].label, "priority": p, "confidence": table[i].confidence}
                        for x, y, i, p in detect(text)
                    ])
                    base.append([{"word": w, "label": label} for w, label in _base(text)])
                else:
                    detections.append([])
                    base.append([])
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(words.per_row(), pa.int64()), pa.array(base, _PLACES), pa.array(detections, _FOUND)],
                ["doc_id", "n_words", "base", "detections"],
            )


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, base, detections) for every row of ``docs`` (doc_id, text); one pass, no shuffle.

    ``base`` lists all places of the base phrases (they may overlap),
    ``detections`` the rules' detections that no other detection of the same or
    higher priority contains; of equal intervals the higher priority stays,
    then the rule listed first. Null and empty texts have no words and no
    detections. Equal rows are scanned each; extra columns are not read.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = "array<struct<first_word: long, end_word: long, label: string, priority: int, confidence: double>>"
    return docs.select("doc_id", "text").mapInArrow(
        _scan, f"doc_id {id_type}, n_words long, base array<struct<word: long, label: string>>, detections {found}"
    )


def digest(scanned: DataFrame) -> DataFrame:
    """Counts, labels and a score per row: the chance that at least one detection is right, each by its confidence."""
    labels = F.array_sort(F.array_distinct(F.col("base.label")))
    every = F.array_sort(F.array_distinct(F.concat("base.label", "detections.label")))
    sure = F.aggregate("detections.confidence", F.lit(1.0), lambda acc, c: acc * (1 - c))
    sure = F.aggregate("base.label", sure, lambda acc, _: acc * 0.5)
    return scanned.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").alias("first_word"), F.array_max("base.word").alias("last_word"),
        F.array_join(labels, ",").alias("base_labels"), F.array_join(every, ",").alias("labels"), (1 - sure).alias("score"),
    )
