"""Text functions as Column expressions; all of them stay inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters the text trim removes (Unicode white space and separators).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
REMOVED_TEXTS = ("[removed]", "[deleted]")
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def ws_trim(text: Column) -> Column:
    """Strip all Unicode white space from both ends (plain ``trim`` knows spaces only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def has_text(text: Column) -> Column:
    """True when the value is neither NULL nor empty; never NULL itself."""
    return F.coalesce(text != "", F.lit(False))


def url_base(url: Column) -> Column:
    """URL up to the first ``?``, without trailing slashes; a fragment stays."""
    return F.rtrim(F.substring_index(url, "?", 1), F.lit("/"))


def url_segment(url: Column, marker: str = "/r/") -> Column:
    """Path segment that follows ``marker``; empty when the marker is absent."""
    after = F.split_part(url, F.lit(marker), F.lit(2))
    return F.split_part(after, F.lit("/"), F.lit(1))


def link_has(link: Column, parts=("reddit.com/r/", "/comments/")) -> Column:
    """True when the link contains every one of ``parts``."""
    found = F.lit(True)
    for part in parts:
        found = found & F.contains(link, F.lit(part))
    return found


def title_clean(title: Column, suffix: str = " - Reddit") -> Column:
    """Title without the site suffix, trimmed."""
    return ws_trim(F.replace(title, F.lit(suffix), F.lit("")))


def summary(text: Column, fallback: Column | None = None, size: int = 200) -> Column:
    """First ``size`` characters of the first non-empty value, trimmed; NULL if nothing is left."""
    empty = F.lit("")
    first = F.nullif(text, empty)
    chosen = F.coalesce(first, fallback, empty) if fallback is not None else F.coalesce(first, empty)
    return F.nullif(ws_trim(F.left(chosen, F.lit(size))), empty)


def snippet(text: Column, size: int = 140) -> Column:
    """Longer texts end in an ellipsis after ``size`` characters."""
    return F.when(F.length(text) > size, F.concat(F.left(text, F.lit(size)), F.lit("..."))).otherwise(text)


def label_tail(text: Column, size: int = 40) -> Column:
    """Labels above ``size`` characters keep their tail behind an ellipsis."""
    tail = F.concat(F.lit("..."), F.right(text, F.lit(size - 3)))
    return F.when(F.length(text) > size, tail).otherwise(text)


def body_fallback(body: Column, fallback: Column, size: int = 2000) -> Column:
    """Post body, or ``fallback`` when it is empty or was removed; cut at ``size`` characters."""
    own = F.coalesce(ws_trim(body), F.lit(""))
    usable = ~own.isin("", *REMOVED_TEXTS)
    return F.left(F.when(usable, own).otherwise(F.coalesce(fallback, F.lit(""))), F.lit(size))


def title_fallback(title: Column, path: Column) -> Column:
    """The path stands in for a title that was not set."""
    return F.when(title.eqNullSafe(F.lit("(not set)")), path).otherwise(title)


def strip_fence(text: Column) -> Column:
    """Content of a code-fenced reply without its ``json`` tag; other replies only trimmed."""
    fence = "```"
    bare = ws_trim(text)
    inner = F.split_part(bare, F.lit(fence), F.lit(2))
    untagged = F.when(F.startswith(inner, F.lit("json")), F.substring(inner, 5, 2**31 - 1)).otherwise(inner)
    return F.when(F.startswith(bare, F.lit(fence)), ws_trim(untagged)).otherwise(bare)


def plural(count: Column, suffix: str = "s") -> Column:
    """``suffix`` unless the count is one."""
    return F.when(count != 1, F.lit(suffix)).otherwise(F.lit(""))


def thousands(number: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_string("%,d", number.cast("bigint"))


def duration(seconds: Column) -> Column:
    """``135.9`` → ``2m 15s``; text that is no finite number comes back unchanged."""
    text = seconds.cast("string")
    whole = F.when(text.rlike(NUMBER), text.try_cast("double").try_cast("bigint"))
    rest = F.pmod(whole, F.lit(60).cast("bigint"))
    minutes = F.floor((whole - rest) / 60)
    shown = F.concat(minutes.cast("string"), F.lit("m "), rest.cast("string"), F.lit("s"))
    return F.coalesce(shown, text)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _one_decimal(size: Column) -> Column:
    """Non-negative double below 1e14 to tenths, rounded on its exact binary value, ties to even."""
    whole = F.floor(size)

    def rounded(scaled: Column) -> Column:
        # ``scaled`` is the fraction in units of 2**-52; what is below the unit decides ties only.
        fixed = F.floor(scaled)
        tenth = F.shiftright(fixed * 10, 52)
        rest = (fixed * 10).bitwiseAND(F.lit(2**52 - 1))
        distance = (rest - F.lit(2**51)).cast("double") + (scaled - fixed.cast("double")) * 10
        up = (distance > 0) | ((distance == 0) & (tenth % 2 == 1))
        return tenth + up.cast("bigint")

    tenths = whole * 10 + _let((size - whole.cast("double")) * F.lit(float(2**52)), rounded)
    return _let(tenths, lambda t: F.concat(F.floor(t / 10).cast("string"), F.lit("."), (t % 10).cast("string")))


def percent(fraction: Column) -> Column:
    """Fraction as a percentage with one decimal; text that is no number comes back unchanged.

    Rounding looks at the exact binary value, ties go to the even digit, so
    12.25 prints as ``12.2%``; the JVM formatter would round the shortest
    decimal form up.
    """
    special = ("nan", "inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")

    def shown(value: Column) -> Column:
        sign = F.when(value < 0, F.lit("-")).otherwise(F.lit(""))
        size = F.abs(value)
        return (
            F.when(F.isnan(value), F.lit("nan%"))
            .when(size == float("inf"), F.concat(sign, F.lit("inf%")))
            .when(size < 1e14, F.concat(sign, _let(size, _one_decimal), F.lit("%")))
            .when(value.isNotNull(), F.format_string("%.1f%%", value))
        )

    def parsed(text: Column) -> Column:
        number = text.rlike(NUMBER) | F.lower(ws_trim(text)).isin(*special)
        return F.coalesce(_let(F.when(number, text.try_cast("double")) * 100, shown), text)

    return _let(fraction.cast("string"), parsed)


def fill_template(template: str, values: Mapping[str, Column]) -> Column:
    """Template with ``{name}`` marks replaced by columns.

    The template is cut once on the driver, so a mark inside an inserted text
    is left alone.
    """
    pieces = []
    for n, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if n % 2 == 0:
            pieces.append(F.lit(piece))
        elif piece in values:
            pieces.append(F.coalesce(values[piece].cast("string"), F.lit("")))
        else:
            pieces.append(F.lit("{" + piece + "}"))
    return F.concat(*pieces)


def first_n(values: Column, n: int) -> Column:
    """The first ``n`` elements; a missing array is an empty one."""
    return F.slice(F.coalesce(values, F.array().cast("array<string>")), 1, n)


def folded(text: Column) -> Column:
    """Text for comparisons without regard to case."""
    return F.lower(text)


def clean_comments(comments: Column, size: int = 5) -> Column:
    """First ``size`` comments of ``array<struct<kind, body>>`` that still carry text."""
    kept = F.filter(
        comments,
        lambda c: (c["kind"] == "t1") & ~ws_trim(F.coalesce(c["body"], F.lit(""))).isin("", *REMOVED_TEXTS),
    )
    texts = F.transform(kept, lambda c: ws_trim(c["body"]))
    return first_n(texts, size)


def bullets(lines: Column, empty: str = "(no comments)") -> Column:
    """Array as a bulleted list, or a placeholder when it has no element."""
    joined = F.array_join(F.transform(lines, lambda c: F.concat(F.lit("- "), c)), "\n")
    return F.coalesce(F.nullif(joined, F.lit("")), F.lit(empty))
