"""Digests as tables: one row per line, then messages of bounded size.

A digest is the union of its sections. Lines carry sort columns and get their
number at the end, by a numbering that splits hot groups; messages gather a
bounded number of numbered lines.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outpulse.functions import dates as D
from outpulse.functions import text as X
from outpulse.operators import mentions as M
from outpulse.operators import web as WEB
from outpulse.operators.keyed import number_rows
from outpulse.operators.traffic import archive_links
from outpulse.session import store

# The line texts and headings of the digests further below are those of the messages.
MESSAGE_LINES = 500
# Bound of digests that are made of limited reports or of one reply.
SHORT = 1000
# Sort columns of a digest's lines; sections fill the ones they need.
ORDER = {"key": "bigint", "name": "string", **{f"key{n}": "bigint" for n in range(1, 7)}}


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def _bold(value: Column) -> Column:
    return _text("*", value, "*")


def _section(
    df: DataFrame, by: Sequence[str], section: int, lines: Sequence[Column], **order: Column
) -> DataFrame:
    """Lines of one section: each row yields ``lines`` in turn, rows are ordered by the ``ORDER`` columns given."""
    blank = {"bigint": F.lit(0), "string": F.lit("")}
    return df.select(
        *by,
        F.lit(section).alias("section"),
        *[order.get(name, blank[kind]).cast(kind).alias(name) for name, kind in ORDER.items()],
        F.posexplode(F.array(*lines)).alias("part", "line"),
    ).where(F.col("line").isNotNull())


def _number(sections: Sequence[DataFrame], by: Sequence[str], largest: int, **options) -> DataFrame:
    union = reduce(lambda a, b: a.unionByName(b), sections)
    order = [F.col(c) for c in ("section", *ORDER, "part", "line")]
    return number_rows(union, by, order, "line_no", largest=largest, **options).select(*by, "line_no", "line")


def _headed(df: DataFrame, heading: Sequence[str], first: Column, line: Column) -> list[Column]:
    """The line, preceded by the section's heading on its first row; an empty section has no heading."""
    return [*[F.when(first, F.lit(h)) for h in heading], line]


def messages(
    lines: DataFrame, by: Sequence[str], size: int = MESSAGE_LINES, name: str = "message"
) -> DataFrame:
    """Numbered lines joined to message texts of at most ``size`` lines.

    A digest up to that size is one message; longer ones continue in further
    parts, and the parts joined by newlines are the whole text.
    """
    part = F.floor((F.col("line_no") - 1) / size) + 1
    gathered = lines.groupBy(*by, part.alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("_lines")
    )
    return gathered.select(*by, "part", F.array_join(F.col("_lines.line"), "\n").alias(name))


def repo_digest(
    info: DataFrame,
    views: DataFrame,
    clones: DataFrame,
    referrers: DataFrame,
    paths: DataFrame,
    as_of: date,
    archive_base: str,
    title: str = "GitHub Stats",
    site: str = "https://github.com",
) -> DataFrame:
    """Repository digest: counters, look-back totals, popular referrers and paths in reply order.

    ``views`` and ``clones`` are totals per repository, ``referrers`` and
    ``paths`` are the replies' entries with their position ``pos``.
    """
    today = F.lit(as_of)
    by = ["repo"]

    def totals(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(*by, F.col("count").alias(f"{prefix}_n"), F.col("uniques").alias(f"{prefix}_u"))

    head = info.join(totals(views, "v"), by, "left").join(totals(clones, "c"), by, "left")

    def counted(label: str, prefix: str) -> Column:
        n, u = (X.thousands(F.coalesce(F.col(f"{prefix}_{c}"), F.lit(0))) for c in "nu")
        return _text(f"• {label}: *", n, "* (", u, " unique)")

    def entry(name: Column) -> Column:
        return _text("• ", name, ": ", X.thousands(F.col("views")), " views (", X.thousands(F.col("unique_visitors")),
                     " unique)")

    at, first = F.col("pos"), F.col("pos") == 0
    sections = [
        _section(
            head, by, 0,
            [
                _text(f"*{title} — ", F.date_format(today, D.LABEL), "*"),
                _text(f"_<{site}/", F.col("repo"), "|", F.col("repo"), ">_"),
                F.lit(""),
                F.lit("*Repository Overview*"),
                _text("• Stars: ", _bold(X.thousands(F.col("stars")))),
                _text("• Forks: ", _bold(X.thousands(F.col("forks")))),
                _text("• Watchers: ", _bold(X.thousands(F.col("watchers")))),
                _text("• Open Issues: ", _bold(X.thousands(F.col("open_issues")))),
                F.lit(""),
                F.lit("*Traffic — Last 14 Days*"),
                counted("Page Views", "v"),
                counted("Git Clones", "c"),
            ],
        ),
        _section(referrers, by, 1, _headed(referrers, ["", "*Top Referrers*"], first, entry(F.col("referrer"))), key=at),
        _section(paths, by, 2, _headed(paths, ["", "*Top Paths*"], first, entry(_text("`", F.col("path"), "`"))), key=at),
        _section(
            info, by, 3,
            [F.lit(""), _text("*CSV Archive (", D.archive_month(today), ")*"), archive_links(today, archive_base)],
        ),
    ]
    # A repository's lists come out of one reply row each, so its digest is short.
    return _number(sections, by, SHORT)


def web_digest(
    hits: DataFrame,
    date_range: tuple[date, date],
    label: str,
    title: str = "Google Analytics",
    gap: int = WEB.GAP,
    firsts: DataFrame | None = None,
) -> DataFrame:
    """Web analytics digest: overview, devices, sources, pages and countries of every property.

    The five reports come from one pass over the range's hits and are stored
    as one table of at most the reports' limits per property.
    """
    by = ["property_id"]
    whole = lambda c: X.thousands(F.col(c))
    first = F.col("place") == 1
    users = lambda name: _text("• ", name, ": ", whole("sessions"), " sessions (", whole("totalUsers"), " users)")

    wanted = {
        "overview": ([], None, 1),
        "devices": (["deviceCategory"], None, 10),
        "sources": (["sessionSource", "sessionMedium"], "sessions", 10),
        "pages": (["pagePath", "pageTitle"], "screenPageViews", 10),
        "countries": (["country"], "sessions", 5),
    }
    rows = store(WEB.reports(hits, wanted, date_range, gap, firsts), "web-reports")
    head, devices, sources, pages, countries = (rows.where(F.col("report") == name) for name in wanted)
    devices = devices.withColumn("shown", _text(F.col("deviceCategory"), ": ", whole("sessions")))
    # At most the report's ten rows per property.
    device_line = devices.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("deviceCategory", "shown"))).alias("_rows")
    )
    place = F.col("place")
    source = _text(F.col("sessionSource"), " / ", F.col("sessionMedium"))
    page = _text(
        "• `", F.col("pagePath"), "` — ", X.title_fallback(F.col("pageTitle"), F.col("pagePath")), ": ",
        whole("screenPageViews"), " views",
    )
    sections = [
        _section(
            head, by, 0,
            [
                F.lit(f"*{title} — {label}*"),
                _text("_Property ID: ", F.col("property_id"), "_"),
                F.lit(""),
                F.lit("*Overview*"),
                _text("• Sessions: ", _bold(whole("sessions"))),
                _text("• Total Users: ", _bold(whole("totalUsers"))),
                _text("• New Users: ", _bold(whole("newUsers"))),
                _text("• Page Views: ", _bold(whole("screenPageViews"))),
                _text("• Bounce Rate: ", _bold(X.percent(F.col("bounceRate")))),
                _text("• Avg Session Duration: ", _bold(X.duration(F.col("averageSessionDuration")))),
            ],
        ),
        _section(
            device_line, by, 1, [F.lit(""), _text("*Devices*  ", F.array_join(F.col("_rows.shown"), " · "))]
        ),
        _section(sources, by, 2, _headed(sources, ["", "*Top Traffic Sources*"], first, users(source)), key=place),
        _section(pages, by, 3, _headed(pages, ["", "*Top Pages*"], first, page), key=place),
        _section(countries, by, 4, _headed(countries, ["", "*Top Countries*"], first, users(F.col("country"))), key=place),
    ]
    return _number(sections, by, SHORT)


def mention_line(m: str = "", day: Column | None = None) -> Column:
    """One mention with its optional parts; absent or empty parts leave no trace. ``day`` is the date as shown."""
    col = lambda c: F.col(m + c)
    shown = lambda value, text: F.when(value, text).otherwise(F.lit(""))
    day = col("date").cast("string") if day is None else day
    return _text(
        "  ", M.sentiment_icon(col("sentiment")), " <", col("url"), "|", col("title"), ">",
        shown(X.has_text(col("subreddit")), _text(" [", col("subreddit"), "]")),
        shown(F.coalesce(col("score") != 0, F.lit(False)), _text(" ↑", col("score"))),
        shown(X.has_text(day), _text("  _", day, "_")),
    )


def summary_line(summary: Column) -> Column:
    """Indented snippet of a summary; NULL without one."""
    return F.when(X.has_text(summary), _text("    _", X.snippet(summary), "_"))


def mention_digest(
    mentions: DataFrame,
    keywords: Sequence[str],
    today: str,
    arrival: Sequence[str] = ("kw_rank", "src_rank", "hit_rank"),
    by: Sequence[str] = ("monitor",),
    tenants: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Mention digest: header counts, then keyword, source and item lines in keyword order.

    The header counts every mention; only configured keywords are listed.
    ``tenants`` names all monitors, so that one without mentions says so.
    """
    by = list(by)
    if "date_text" not in mentions.columns:
        mentions = mentions.withColumn("date_text", F.lit(None).cast("string"))
    mentions = store(mentions, "mentions")
    total = F.col("total")
    counts = M.sentiment_counts(mentions, by)
    headed = counts
    if tenants is not None:
        headed = tenants.select(*by).distinct().join(counts, by, "left").fillna(0)
    head = _section(
        headed, by, 0,
        [
            F.lit(f"*Web Mentions — {today}*"),
            _text(
                f"_keywords: {', '.join(keywords)} · ", total, " mention", X.plural(total), " · ",
                M.SENTIMENT_ICONS["positive"] + " ", F.col("positive"), "  ",
                M.SENTIMENT_ICONS["neutral"] + " ", F.col("neutral"), "  ",
                M.SENTIMENT_ICONS["negative"] + " ", F.col("negative"), "_",
            ),
            F.when(total == 0, F.lit("\nNo relevant mentions found today.")),
        ],
    )

    # A reply's date is shown as it was written.
    shown_day = F.coalesce(F.nullif(F.col("date_text"), F.lit("")), F.col("date").cast("string"))
    named = M.listed(
        mentions.withColumn("source", F.coalesce("source", F.lit("Other"))).withColumn(
            "keyword", F.coalesce("keyword", F.lit("unknown"))
        ),
        keywords,
    )
    rank, source, n = F.col("list_rank"), F.col("source"), F.col("n")
    per_source = named.groupBy(*by, "list_rank", "keyword", "source").agg(F.count("*").alias("n"))
    per_keyword = per_source.groupBy(*by, "list_rank", "keyword").agg(F.sum("n").alias("n"))
    # A keyword's line comes before its sources, a source's line before its items.
    keyword_lines = _section(
        per_keyword, by, 1, [_text("\n*", F.col("keyword"), "* — ", n, " mention", X.plural(n))],
        key=rank, key1=F.lit(0),
    )
    source_lines = _section(
        per_source, by, 1, [_text(M.source_icon(source), " *", source, "* (", n, ")")],
        key=rank, name=source, key1=F.lit(1),
    )
    places = {f"key{k}": F.col(c) for k, c in enumerate(arrival, 3)}
    item_lines = _section(
        named, by, 1, [mention_line(day=shown_day), summary_line(F.col("summary"))],
        key=rank, name=source, key1=F.lit(2), key2=M.source_order(source, F.col("score")), **places,
    )
    # At most two lines per item, one per source and one per keyword.
    largest = 4 * (counts.agg(F.max("total")).first()[0] or 0) + 2
    return _number([head, keyword_lines, source_lines, item_lines], by, largest, **options)


def opportunity_digest(
    results: DataFrame,
    runs: DataFrame,
    as_of: date,
    title: str = "Reddit Digest",
    by: Sequence[str] = ("campaign",),
    order_by: Sequence[str] = ("batch_pos", "kw_pos", "hit_pos"),
) -> DataFrame:
    """Opportunity digest: header with batches and count, then numbered items; one line for an empty run.

    ``runs`` is ``(*by, batches)`` with the run's batch numbers as an array,
    ``results`` are capped, so a run's digest is short.
    """
    by = list(by)
    today = as_of.strftime("%B %d, %Y")
    counts = results.groupBy(*by).agg(F.count("*").alias("found"))
    head = runs.join(counts, by, "left").withColumn("found", F.coalesce("found", F.lit(0)))
    batches = F.concat(F.lit("["), F.array_join(F.col("batches").cast("array<string>"), ", "), F.lit("]"))
    some = F.col("found") > 0
    head_lines = _section(
        head, by, 0,
        [
            F.when(some, _text(f"*{title} - {today}*\nBatches: ", batches, "  |  Posts found: *", F.col("found"), "*"))
            .otherwise(F.lit(f"{title} - {today}\nNo qualifying posts found today.")),
        ],
    )
    numbered = number_rows(results, by, [F.col(c) for c in order_by], "place", largest=SHORT)
    item = _text(
        "*", F.col("place"), ". ", F.col("title"), "*\n<", F.col("url"), "|View Post on Reddit>\n\n",
        "*Suggested Comment:*\n", F.col("suggested_comment"),
    )
    return _number([head_lines, _section(numbered, by, 1, [item], key=F.col("place"))], by, SHORT)


def digest_payload(text: DataFrame, by: Sequence[str], channel: str, name: str = "message") -> DataFrame:
    """Message texts as JSON payloads."""
    body = F.struct(F.lit(channel).alias("channel"), F.col(name).alias("text"), F.lit(True).alias("mrkdwn"))
    return text.select(*by, "part", F.to_json(body).alias("payload"))


def section_payload(
    lines: DataFrame, as_of: date, channel: str, title: str = "Reddit Digest", by: Sequence[str] = ("campaign",)
) -> DataFrame:
    """Lines of :func:`opportunity_digest` as one JSON payload per run.

    Header and items are sections, each followed by a divider, and a plain
    text stands in for them; a run without results is that text alone. A run's
    lines are capped, so a payload gathers a dozen at most.
    """
    ordered = F.sort_array(F.collect_list(F.struct("line_no", "line")))
    runs = lines.groupBy(*by).agg(F.transform(ordered, lambda x: x["line"]).alias("lines"))
    text_type = "struct<type: string, text: string>"
    divider = F.struct(F.lit("divider").alias("type"), F.lit(None).cast(text_type).alias("text"))
    blocks = F.flatten(F.transform("lines", lambda line: F.array(
        F.struct(F.lit("section").alias("type"), F.struct(F.lit("mrkdwn").alias("type"), line.alias("text")).cast(text_type).alias("text")),
        divider,
    )))
    some = F.size("lines") > 1
    plain = F.when(some, F.lit(f"{title} - {as_of:%B %d, %Y}")).otherwise(F.col("lines")[0])
    body = F.struct(F.lit(channel).alias("channel"), F.when(some, blocks).alias("blocks"), plain.alias("text"))
    return runs.select(*by, F.to_json(body).alias("payload"))


def write_digest(df: DataFrame, path: str) -> None:
    """Digest rows as a table of JSON lines."""
    df.write.mode("append").json(path)
