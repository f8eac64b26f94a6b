"""Secret detection: plain patterns, and strings that no dictionary explains.

Strings in a sensitive context (a word such as ``token`` or ``auth`` shortly
before) are compressed by Zstandard twice, with a raw dictionary of common
words and identifiers and the code around the string: once alone, once without the
string. The difference is what the string itself costs. A string that stays
about as long as it was, or costs many bytes, is not a word or a path. Its
own copies around it do not explain it. Strings made of words only, listed
ones or ones spelt like words, are names and not measured.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outpulse.llm.letters import is_wordlike
from outpulse.llm.ordinary import WORDS
from outpulse.llm.words import slices

KINDS = ("assign", "access", "hex", "novel")
CONTEXT = 256
#: Characters between a sensitive word and the string.
REACH = 40
#: Marginal bytes a character from which a string counts as incompressible.
NOVEL = 0.7
#: Marginal bytes from which a string counts whatever its length: long ones of few characters cost less each.
ENOUGH = 24
SHORTEST = 12
#: Letters from which spelling tells a word.
SPELT = 5

_ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_SENSITIVE = re.compile(
    r"(?ai)pass(?:word|wd|phrase)|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|authori[sz]ation|bearer|credential|signature"
)
_STRING = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)
_RUN = re.compile(r"[A-Za-z0-9]{%d,}" % SHORTEST)
_MARKS = ("pass", "pwd", "secret", "token", "key", "authori", "bearer", "credential", "signature")

# Identifiers of everyday code and configuration.
IDENTIFIERS = (
    "access_key account_id api_key application auth_token authorization base64 bearer certificate client_id client_secret "
    "config configuration connection_string container content_type cookie credential credentials database database_url "
    "default description development directory document element endpoint environment example exception expires filename "
    "function generate_token get_secret handler hostname identifier implementation import index information instance "
    "integer interface internal language localhost location manager message method module namespace networking number "
    "object options organization package parameter passphrase password permission placeholder private_key process "
    "production project properties protocol public_key readonly refresh_token registry repository request resource "
    "response return secret_key security server service session_id session_token settings signature source staging "
    "standard status string system template timestamp token_type undefined username validate variable version webhook "
    "your_api_key_here changeme xxxxxxxxxxxxxxxx 0123456789abcdef ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz"
)
_WORDS = frozenset(f"{WORDS} {IDENTIFIERS.replace('_', ' ')}".split())
_PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _around(text: str, start: int, end: int) -> str:
    """The text around the string, with blanks for its other places, so that no copy explains it."""
    found, size = text[start:end], end - start
    left, right = text[max(0, start - CONTEXT - size) : start], text[end : end + CONTEXT + size]
    for piece in sorted({found, *_RUN.findall(found)}, key=len, reverse=True):
        left, right = (side.replace(piece, " " * len(piece)) for side in (left, right))
    return left[-CONTEXT:] + right[:CONTEXT]


def marginal_bytes(text: str, start: int, end: int) -> int:
    """Compressed bytes that the string adds to nothing, given words, identifiers and the text around it."""
    around = _around(text, start, end)
    prime = zstandard.ZstdCompressionDict(f"{WORDS} {IDENTIFIERS} {around}".encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    squeeze = zstandard.ZstdCompressor(level=19, dict_data=prime, write_content_size=False, write_checksum=False).compress
    return len(squeeze(text[start:end].encode())) - len(squeeze(b""))


def is_name(found: str) -> bool:
    """Whether the string is words only, joined by marks or by capitals. Random letters are not, whatever their case.

    A word is listed, or has at least five letters in an order that words have
    in English, German, French or Spanish.
    """
    pieces = _PIECE.findall(found)
    known = all(p.lower() in _WORDS or (len(p) >= SPELT and is_wordlike(p)) for p in pieces)
    return known and not any(c.isdigit() for c in found)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the plain patterns, leftmost and not overlapping per kind."""
    low, spans = text.lower(), []
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    return spans + [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]


def novel_spans(text: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Incompressible strings in a sensitive context that no known span holds."""
    low, spans, done = text.lower(), [], 0
    if not any(mark in low for mark in _MARKS):
        return spans
    for word in _SENSITIVE.finditer(text):
        for head in _STRING.finditer(text, max(word.end(), done), word.end() + REACH + SHORTEST):
            if head.start() < done:
                continue
            start, end = _STRING.match(text, head.start()).span()
            done, found = end, text[start:end]
            if any(a <= start and end <= b for a, _, b in known):
                continue
            if not is_name(found) and marginal_bytes(text, start, end) >= min(NOVEL * (end - start), ENOUGH):
                spans.append((start, 3, end))
    return spans


def _line(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("from", pa.int64()), ("to", pa.int64())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text"):
            base, spans = [], []
            for text in piece.column("text").to_pylist():
                known = base_spans(text or "")
                base.append(sorted(known))
                spans.append(sorted(known + novel_spans(text or "", known)))
            digests = [hashlib.sha256(_line(b).encode()).hexdigest() for b in base]
            found = [[{"kind": KINDS[k], "from": s, "to": e} for s, k, e in row] for row in spans]
            keep = [c for c in piece.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[piece.column(c) for c in keep], pa.array(digests), pa.array(found, _FOUND)], [*keep, "base_sha256", "found"]
            )


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, base_sha256, found) for every row of ``docs`` (doc_id, text); one pass, no shuffle.

    ``found`` lists all spans by start, then kind, in code points, end
    exclusive; null and empty texts have none. Equal rows are scanned each;
    extra columns are not read.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _scan, f"doc_id {id_type}, base_sha256 string, found array<struct<kind: string, `from`: long, `to`: long>>"
    )


def digest(scanned: DataFrame) -> DataFrame:
    """Counts and joined spans of :func:`scan`'s rows, one row each, repeated ones too.

    A document without spans, null and empty ones included, has counts of 0
    and empty ``spans``. No rows give no rows.
    """
    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")

    line = F.transform("found", lambda x: F.concat_ws(":", x["kind"], x["from"].cast("string"), x["to"].cast("string")))
    return scanned.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]], "base_sha256", F.array_join(line, ",").alias("spans"),
        count("novel").alias("n_novel"),
    )


def redacted(text: str, mark: str = "<secret>") -> str:
    """The text with every span, overlapping ones as one, replaced by ``mark``."""
    known = base_spans(text)
    spans, out, at = sorted((s, e) for s, _, e in known + novel_spans(text, known)), [], 0
    while spans:
        start, end = spans.pop(0)
        while spans and spans[0][0] < end:
            end = max(end, spans.pop(0)[1])
        out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def _redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        place = batch.schema.get_field_index("text")
        for piece in slices(batch, "text"):
            texts = [None if t is None else redacted(t) for t in piece.column("text").to_pylist()]
            yield piece.set_column(place, "text", pa.array(texts, pa.string()))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets in ``text`` replaced; every row and column stays, null texts stay null."""
    return docs.mapInArrow(_redact, docs.schema)
