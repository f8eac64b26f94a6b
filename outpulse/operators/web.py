"""Web analytics: sessions and the dimension-by-metric report.

Hits of one user that fall into the same slot of the inactivity gap's length
always belong to one session. Hits are therefore folded to one row per user
and slot before anything is ordered; the windows that chain slots to sessions
see a user's slots, whose number depends on the time span and not on the
user's hits. A user with a third of all hits costs no more than a steady one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outpulse.functions import dates as D
from outpulse.operators.keyed import top_n_per
from outpulse.session import store

GAP = 1800
MARGIN_GAPS = 12
USER = ["property_id", "user_id"]

# Report dimension -> column; the first two belong to a session, the rest to a hit.
SESSION_DIMENSIONS = {"sessionSource": "session_source", "sessionMedium": "session_medium"}
HIT_DIMENSIONS = {
    "pagePath": "page_path",
    "pageTitle": "page_title",
    "country": "country",
    "deviceCategory": "device_category",
}
SESSION_METRICS = ("sessions", "bounceRate", "averageSessionDuration")
USER_METRICS = ("totalUsers", "newUsers")
HIT_METRICS = ("screenPageViews",)
RATES = ("bounceRate", "averageSessionDuration")


def in_range(ts: Column, start: date | Column, end: date | Column) -> Column:
    """Closed range of days, written as bounds on the timestamp so that scans can prune."""
    lo = start if isinstance(start, Column) else F.lit(start)
    hi = end if isinstance(end, Column) else F.lit(end)
    return (ts >= lo.cast("timestamp_ntz")) & (ts < F.date_add(hi, 1).cast("timestamp_ntz"))


def _slot(gap: int) -> Column:
    return F.floor(D.epoch_seconds(F.col("ts")) / gap)


def _fold(hits: DataFrame, gap: int, names: Sequence[str] = (), entry: bool = True, counted: Sequence[Column] = ()) -> DataFrame:
    """One row per user, slot and hit dimension with the bounds and number of its hits."""
    first = F.struct("ts", "event_id", "source", "medium")
    return hits.groupBy(*USER, _slot(gap).alias("slot"), *[F.col(HIT_DIMENSIONS[d]).alias(d) for d in names]).agg(
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.count("*").alias("slot_hits"),
        *([F.min(first).alias("entry")] if entry else []),
        *counted,
    )


def _chain(slots: DataFrame, gap: int) -> DataFrame:
    """Slots with ``starts`` and ``session_start``, and the totals and first hit of their session."""
    timeline = Window.partitionBy(*USER).orderBy("slot")
    previous = F.lag("last_ts").over(timeline)
    starts = previous.isNull() | (F.col("first_ts") > previous + F.make_dt_interval(secs=F.lit(gap)))
    chained = slots.withColumn("starts", starts).withColumn(
        "session_start", F.max(F.when(F.col("starts"), F.col("first_ts"))).over(timeline)
    )
    session = Window.partitionBy(*USER, "session_start")
    totals = {"session_hits": F.sum("slot_hits").over(session), "session_end": F.max("last_ts").over(session)}
    if "hits" in slots.columns:
        totals["session_inside"] = F.sum("hits").over(session)
    if "entry" in slots.columns:
        totals["_entry"] = F.max(F.when(F.col("starts"), F.col("entry"))).over(session)
    chained = chained.withColumns(totals)
    more = {"session_seconds": D.epoch_seconds(F.col("session_end")) - D.epoch_seconds(F.col("session_start"))}
    if "entry" in slots.columns:
        more |= {"session_source": F.col("_entry.source"), "session_medium": F.col("_entry.medium")}
    return chained.withColumns(more).drop("_entry")


def session_slots(hits: DataFrame, gap: int = GAP) -> DataFrame:
    """One row per user and slot of the whole history, with the session the slot belongs to.

    ``session_start`` names the session within its user; the session's totals
    and the source and medium of its first hit are repeated on its slots.
    A pause longer than ``gap`` seconds starts a new session.
    """
    slots = _fold(hits, gap).withColumn("user_first_ts", F.min("first_ts").over(Window.partitionBy(*USER)))
    return _chain(slots, gap).drop("session_end", "first_ts", "last_ts", "slot_hits", "entry")


def sessions(hits: DataFrame, gap: int = GAP) -> DataFrame:
    """One row per session."""
    return session_slots(hits, gap).where("starts").drop("slot", "starts")


def with_sessions(hits: DataFrame, gap: int = GAP) -> DataFrame:
    """Every hit with the attributes of its session."""
    slots = session_slots(hits, gap).drop("starts")
    return _join_slots(hits.withColumn("slot", _slot(gap)), slots).drop("slot")


def _same(right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """``right`` with renamed keys and the null-safe join on them: hits without a user are one unknown user of their property."""
    renamed = right.withColumnsRenamed({c: f"_{c}" for c in keys})
    return renamed, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys])


def _join_slots(df: DataFrame, slots: DataFrame) -> DataFrame:
    keys = [*USER, "slot"]
    right, same = _same(slots, keys)
    joined = df.join(right, same).drop(*[f"_{c}" for c in keys])
    return joined.select(*keys, *[c for c in df.columns if c not in keys], *[c for c in slots.columns if c not in keys])


def _counted(start: date, end: date) -> list[Column]:
    inside = in_range(F.col("ts"), start, end)
    return [
        F.count_if(inside).alias("hits"),
        F.count_if(inside & (F.col("event_type") == "view")).alias("views"),
    ]


def _at(epoch: int) -> Column:
    return F.lit((datetime(1970, 1, 1) + timedelta(seconds=epoch)).isoformat(sep=" ")).cast("timestamp_ntz")


def _between(hits: DataFrame, lo: int, hi: int) -> DataFrame:
    """Hits from epoch second ``lo`` to before ``hi``; the bounds reach the scan."""
    return hits.where((F.col("ts") >= _at(lo)) & (F.col("ts") < _at(hi)))


def _open_ends(slots: DataFrame, lo: int, hi: int, gap: int) -> DataFrame:
    """Users with a session in the range that hits before ``lo`` or from ``hi`` on may belong to."""
    back, ahead = F.col("session_start") < _at(lo + gap), F.col("session_end") >= _at(hi - gap)
    found = slots.where(F.col("starts") & (F.col("session_inside") > 0) & (back | ahead))
    return found.groupBy(*USER).agg(F.max(back).alias("back"), F.max(ahead).alias("ahead"))


def range_sessions(
    hits: DataFrame, date_range: tuple[date, date], gap: int = GAP, dimensions: Sequence[str] = (), entry: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Slots of every session with a hit in the range, whole sessions, and their hits folded by ``dimensions``.

    The days of the range and one on each side (or twelve times the gap, if
    that is more) are read. Sessions that may go
    on beyond what was read are extended: each further read is twice as wide
    and keeps only the users whose session is still open at that end, until
    there are none. All reads are bounds on ``ts``, so a report's cost follows
    its range, not the history. Both tables are stored and may hold other
    sessions, which have no hit in the range and do not begin there. Without
    hit dimensions they are one.
    """
    start, end = ((d - date(1970, 1, 1)).days * D.DAY for d in date_range)
    step = -(-max(D.DAY, MARGIN_GAPS * gap) // gap) * gap
    lo, hi = (start // gap) * gap - step, -(-(end + D.DAY) // gap) * gap + step
    names = [d for d in dimensions if d in HIT_DIMENSIONS]

    def folded(rows: DataFrame) -> DataFrame:
        found = _fold(rows, gap, names, entry, _counted(*date_range))
        return store(found, "range-hits") if names else found

    def slots_of(rows: DataFrame) -> DataFrame:
        return _merged(rows) if names else rows

    known = folded(_between(hits, lo, hi))
    slots = store(_chain(slots_of(known), gap), "range-slots")
    raw = ["first_ts", "last_ts", "slot_hits", "hits", "views", *(["entry"] if entry else [])]
    while not (ends := _open_ends(slots, lo, hi, gap)).isEmpty():
        ends = store(ends, "open-sessions")
        lower, upper = lo - step, hi + step
        sides = []
        for side, since, until in (("back", lower, lo), ("ahead", hi, upper)):
            users, same = _same(ends.where(side).select(*USER), USER)
            sides.append(_between(hits, since, until).join(users, same, "left_semi"))
        more = folded(sides[0].unionByName(sides[1]))
        known = known.unionByName(more) if names else known
        users, same = _same(ends.select(*USER), USER)
        reopened = slots.join(users, same, "left_semi").select(*USER, "slot", *raw).unionByName(slots_of(more))
        extended = store(_chain(reopened, gap), "range-slots")
        slots = slots.join(users, same, "left_anti").unionByName(extended)
        lo, hi, step = lower, upper, 2 * step
    return slots, known if names else slots


def _merged(folded: DataFrame) -> DataFrame:
    """Hits folded by dimensions as one row per user and slot."""
    return folded.groupBy(*USER, "slot").agg(
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("slot_hits").alias("slot_hits"),
        *([F.min("entry").alias("entry")] if "entry" in folded.columns else []),
        F.sum("hits").alias("hits"), F.sum("views").alias("views"),
    )


_REPORT_NAMES = {**SESSION_DIMENSIONS, **HIT_DIMENSIONS}


def _formulas(date_range: tuple[date, date], sessions_known: bool) -> dict[str, Column]:
    """Metrics over rows of (dimensions, user). The unknown user has sessions and views but is nobody to count."""
    active = (F.col("hits") > 0) & F.col("user_id").isNotNull()
    formulas = {"totalUsers": F.count_if(active), "screenPageViews": F.sum("views")}
    if sessions_known:
        per_session = lambda c: F.coalesce(F.try_divide(F.sum(c), F.sum("begun")), F.lit(0.0))
        formulas |= {
            "sessions": F.sum("begun"),
            "newUsers": F.count_if(active & F.coalesce("fresh", F.lit(False))),
            "bounceRate": per_session("bounced"),
            "averageSessionDuration": per_session("seconds"),
        }
    return formulas


def _per_user(sessioned, group: Sequence[str], date_range: tuple[date, date], firsts: DataFrame | None, once: Column) -> DataFrame:
    """Rows folded to (group, user); a session counts in the row where ``once`` holds.

    ``fresh`` says whether the user's first hit ever lies in the range.
    """
    begun = once & in_range(F.col("session_start"), *date_range)
    folded = sessioned.groupBy("property_id", *group, "user_id").agg(
        F.sum("hits").alias("hits"),
        F.sum("views").alias("views"),
        F.count_if(begun).alias("begun"),
        F.count_if(begun & (F.col("session_hits") == 1)).alias("bounced"),
        F.sum(F.when(begun, F.col("session_seconds")).otherwise(0)).alias("seconds"),
    )
    if firsts is None:
        return folded.withColumn("fresh", F.lit(False))
    fresh = firsts.where(in_range(F.col("first_ts"), *date_range)).select(*USER, F.lit(True).alias("fresh"))
    return folded.join(fresh, USER, "left")


def _checked(dimensions: Sequence[str], metrics: Sequence[str]) -> None:
    unknown = [d for d in dimensions if d not in _REPORT_NAMES]
    unknown += [m for m in metrics if m not in (*SESSION_METRICS, *USER_METRICS, *HIT_METRICS)]
    if unknown:
        raise ValueError(f"unknown dimensions or metrics: {unknown}")


def _session_totals() -> list[Column]:
    return [
        F.sum("hits").alias("hits"), F.sum("views").alias("views"),
        F.first("session_hits").alias("session_hits"), F.first("session_seconds").alias("session_seconds"),
    ]


def _joined(slots: DataFrame, folded: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Folded hits with the attributes of their session."""
    names = [d for d in dimensions if d in HIT_DIMENSIONS]
    attributes = ["session_start", "session_hits", "session_seconds", *[SESSION_DIMENSIONS[d] for d in dimensions if d in SESSION_DIMENSIONS]]
    joined = _join_slots(folded.select(*USER, "slot", *names, "hits", "views"), slots.select(*USER, "slot", *attributes))
    return _named(joined, dimensions)


def _named(slots: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    return slots.withColumnsRenamed({SESSION_DIMENSIONS[d]: d for d in dimensions if d in SESSION_DIMENSIONS})


def report(
    hits: DataFrame,
    dimensions: Sequence[str],
    metrics: Sequence[str],
    date_range: tuple[date, date],
    order_bys: Sequence[tuple[str, bool]] = (),
    limit: int = 10,
    gap: int = GAP,
    firsts: DataFrame | None = None,
) -> DataFrame:
    """Any dimensions by any metrics over a closed date range, per property.

    ``order_bys`` lists ``(metric, descending)``; the dimensions break ties.
    Session metrics count the sessions that began in the range, the other
    metrics the hits in the range; :func:`range_sessions` reads what that
    takes. Rows are folded to (dimensions, user, session), then (dimensions,
    user), then dimensions, so distinct counts are plain counts and every fold
    starts map-side. ``firsts`` is the table of :mod:`outpulse.sources.firsts`; new
    users, and the zero row of a property without data, are looked up there.
    Without it, all hits up to the end of the range are folded for it.
    """
    _checked(dimensions, metrics)
    needs_sessions = any(m in SESSION_METRICS or m == "newUsers" for m in metrics) or any(
        d in SESSION_DIMENSIONS for d in dimensions
    )
    if firsts is None and ("newUsers" in metrics or not dimensions):
        firsts = first_hits(_before(hits, date_range[1]))
    if needs_sessions:
        slots, folded = range_sessions(hits, date_range, gap, dimensions, entry=any(d in SESSION_DIMENSIONS for d in dimensions))
        if any(d in HIT_DIMENSIONS for d in dimensions):
            rows = _joined(slots, folded, dimensions).groupBy(*USER, *dimensions, "session_start").agg(*_session_totals())
            once = F.lit(True)
        else:
            rows, once = _named(slots, dimensions), F.col("starts")
        per_user = _per_user(rows, dimensions, date_range, firsts if "newUsers" in metrics else None, once)
    else:
        shown = [F.col(HIT_DIMENSIONS[d]).alias(d) for d in dimensions]
        inside = hits.where(in_range(F.col("ts"), *date_range))
        per_user = inside.groupBy("property_id", *shown, "user_id").agg(*_counted(*date_range))
    formulas = _formulas(date_range, needs_sessions)
    active = F.sum("hits") + (F.sum("begun") if needs_sessions else F.lit(0))
    rows = per_user.groupBy("property_id", *dimensions).agg(*[formulas[m].alias(m) for m in metrics], active.alias("_activity"))
    rows = rows.where(F.col("_activity") > 0).drop("_activity")
    if not dimensions:
        # A property without data keeps its zero row; a dimension value without data has no row.
        zeros = [F.coalesce(m, F.lit(0.0 if m in RATES else 0).cast(rows.schema[m].dataType)).alias(m) for m in metrics]
        return firsts.select("property_id").distinct().join(rows, "property_id", "left").select("property_id", *zeros)
    order = [F.desc(m) if desc else F.asc(m) for m, desc in order_bys]
    return top_n_per(rows, ["property_id"], [*order, *dimensions], limit)


def _before(hits: DataFrame, end: date) -> DataFrame:
    return hits.where(F.col("ts") < _at(((end - date(1970, 1, 1)).days + 1) * D.DAY))


def first_hits(hits: DataFrame) -> DataFrame:
    """(property_id, user_id, first_ts) of every user, the unknown one included."""
    return hits.groupBy(*USER).agg(F.min("ts").alias("first_ts"))


def reports(
    hits: DataFrame,
    wanted: Mapping[str, tuple[Sequence[str], str | None, int]],
    date_range: tuple[date, date],
    gap: int = GAP,
    firsts: DataFrame | None = None,
) -> DataFrame:
    """Several reports over one range from one pass, as one table.

    ``wanted`` maps a report's name to its dimensions, the metric its rows
    descend by (None: by dimensions) and its limit. Hits are read, folded and
    given their session once; grouping sets fold them for all reports together.
    Columns: property_id, report, all dimensions (null where the report lacks
    them), all metrics, and ``place``. Rows equal those of :func:`report`: a
    report of hit dimensions by a hit metric lists what was hit in the range,
    others also what only sessions that began there name; a report without
    dimensions has its zero rows.
    """
    every = list(dict.fromkeys(d for dimensions, _, _ in wanted.values() for d in dimensions))
    _checked(every, [m for _, m, _ in wanted.values() if m])
    firsts = store(first_hits(_before(hits, date_range[1])), "firsts") if firsts is None else firsts
    entry = any(d in SESSION_DIMENSIONS for d in every)
    joined = _joined(*range_sessions(hits, date_range, gap, every, entry), every)
    sets = [[*USER, "session_start", *dimensions] for dimensions, _, _ in wanted.values()]
    # A set's bits name the dimensions it leaves out, the first one highest.
    masks = {name: sum(1 << (len(every) - 1 - i) for i, d in enumerate(every) if d not in dimensions) for name, (dimensions, _, _) in wanted.items()}
    named = F.create_map(*[F.lit(x) for name, mask in masks.items() for x in (mask, name)])
    per_session = joined.groupingSets(sets, *USER, "session_start", *every).agg(F.grouping_id().alias("_set"), *_session_totals())
    per_user = _per_user(per_session, ["_set", *every], date_range, firsts, F.lit(True))
    plain = [masks[name] for name, (dimensions, _, _) in wanted.items() if not dimensions]
    if plain:
        # A property without data keeps its zero row: a user who did nothing.
        known = firsts.select("property_id").distinct().withColumns({"_set": F.lit(plain[0]).cast(per_user.schema["_set"].dataType), "fresh": F.lit(False)})
        nothing = {c: F.lit(0).cast("bigint") for c in ("hits", "views", "begun", "bounced", "seconds")}
        per_user = per_user.unionByName(known.withColumns(nothing), allowMissingColumns=True)
    formulas = _formulas(date_range, True)
    of_hits = F.col("_set").isin([masks[n] for n, (dims, _, _) in wanted.items() if dims and all(d in HIT_DIMENSIONS for d in dims) and wanted[n][1] in HIT_METRICS])
    active = F.sum("hits") + F.when(of_hits, 0).otherwise(F.sum("begun"))
    rows = per_user.groupBy("property_id", "_set", *every).agg(*[c.alias(m) for m, c in formulas.items()], active.alias("_activity"))
    shown = (F.col("_activity") > 0) | F.col("_set").isin(plain)
    rows = rows.where(shown).select("property_id", named[F.col("_set")].alias("report"), *every, *formulas)
    by = F.lit(None).cast("bigint")
    limit = F.lit(1)
    for name, (_, metric, most) in wanted.items():
        if metric:
            by = F.when(F.col("report") == name, F.col(metric)).otherwise(by)
        limit = F.when(F.col("report") == name, most).otherwise(limit)
    place = F.row_number().over(Window.partitionBy("property_id", "report").orderBy(by.desc(), *every))
    ranked = rows.withColumn("place", place).where(F.col("place") <= max(most for _, _, most in wanted.values()))
    return ranked.where(F.col("place") <= limit)


def overview(hits: DataFrame, date_range: tuple[date, date], **options) -> DataFrame:
    """The six headline metrics; zeros for a property without data in the range."""
    metrics = ["sessions", "totalUsers", "newUsers", "screenPageViews", "bounceRate", "averageSessionDuration"]
    return report(hits, [], metrics, date_range, limit=1, **options)


def top_pages(hits: DataFrame, date_range: tuple[date, date], limit: int = 10) -> DataFrame:
    """Pages by page views."""
    metrics = ["screenPageViews", "totalUsers"]
    return report(hits, ["pagePath", "pageTitle"], metrics, date_range, [("screenPageViews", True)], limit)


def top_sources(hits: DataFrame, date_range: tuple[date, date], limit: int = 10, **options) -> DataFrame:
    """Traffic sources by sessions."""
    dimensions, metrics = ["sessionSource", "sessionMedium"], ["sessions", "totalUsers"]
    return report(hits, dimensions, metrics, date_range, [("sessions", True)], limit, **options)


def top_countries(hits: DataFrame, date_range: tuple[date, date], limit: int = 5, **options) -> DataFrame:
    """Countries by sessions."""
    return report(hits, ["country"], ["sessions", "totalUsers"], date_range, [("sessions", True)], limit, **options)


def devices(hits: DataFrame, date_range: tuple[date, date], **options) -> DataFrame:
    """Sessions per device category."""
    return report(hits, ["deviceCategory"], ["sessions"], date_range, **options)
