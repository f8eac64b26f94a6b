"""Declared schemas: archive tables, landed API replies, mentions, posts and hits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


_TYPES = {"DATE": T.DateType(), "STRING": T.StringType(), "BIGINT": T.LongType()}


def _struct(ddl: str) -> T.StructType:
    """Schema of plain ``name TYPE`` columns; needs no running session."""
    columns = [column.split() for column in ddl.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns])


@dataclass(frozen=True)
class Archive:
    """One archived dataset: its columns in file order and its idempotence key."""

    kind: str
    ddl: str
    keys: tuple[str, ...]
    date: str

    @property
    def fields(self) -> list[str]:
        return _struct(self.ddl).fieldNames()

    @property
    def all_keys(self) -> list[str]:
        return ["repo", *self.keys]

    @property
    def schema(self) -> T.StructType:
        return _struct(f"repo STRING, {self.ddl}, archive_month STRING")


ARCHIVES = {
    a.kind: a
    for a in (
        Archive("views", "date DATE, views BIGINT, unique_visitors BIGINT", ("date",), "date"),
        Archive("clones", "date DATE, clones BIGINT, unique_cloners BIGINT", ("date",), "date"),
        Archive(
            "referrers",
            "fetched_date DATE, referrer STRING, views BIGINT, unique_visitors BIGINT",
            ("fetched_date", "referrer"),
            "fetched_date",
        ),
        Archive(
            "paths",
            "fetched_date DATE, path STRING, views BIGINT, unique_visitors BIGINT",
            ("fetched_date", "path"),
            "fetched_date",
        ),
        Archive(
            "repo_stats",
            "date DATE, stars BIGINT, forks BIGINT, watchers BIGINT, open_issues BIGINT",
            ("date",),
            "date",
        ),
    )
}

SEEN = _struct("url STRING, title STRING, date_seen DATE")

# Landed API replies (field names are the APIs' own).
_POINT = "ARRAY<STRUCT<timestamp: STRING, count: BIGINT, uniques: BIGINT>>"
TRAFFIC_JSON = {
    "views": f"count BIGINT, uniques BIGINT, views {_POINT}",
    "clones": f"count BIGINT, uniques BIGINT, clones {_POINT}",
}
POPULAR_JSON = {
    "referrers": "ARRAY<STRUCT<referrer: STRING, count: BIGINT, uniques: BIGINT>>",
    "paths": "ARRAY<STRUCT<path: STRING, count: BIGINT, uniques: BIGINT>>",
}
REPO_INFO_JSON = (
    "stargazers_count BIGINT, forks_count BIGINT, subscribers_count BIGINT, open_issues_count BIGINT"
)
LISTING_JSON = (
    "data STRUCT<children: ARRAY<STRUCT<data: STRUCT<"
    "created_utc: DOUBLE, title: STRING, permalink: STRING, selftext: STRING, url: STRING, "
    "subreddit_name_prefixed: STRING, subreddit: STRING, body: STRING, score: BIGINT>>>>"
)
SEARCH_JSON = "items ARRAY<STRUCT<link: STRING, title: STRING, snippet: STRING>>"
THREAD_POST_JSON = "data STRUCT<children: ARRAY<STRUCT<data: STRUCT<selftext: STRING>>>>"
THREAD_COMMENTS_JSON = "data STRUCT<children: ARRAY<STRUCT<kind: STRING, data: STRUCT<body: STRING>>>>"
REPLY_ARRAY_JSON = (
    "ARRAY<STRUCT<keyword: STRING, title: STRING, url: STRING, source: STRING, "
    "summary: STRING, sentiment: STRING, date: STRING>>"
)
REPLY_SCORE_JSON = "relevance_score DOUBLE, suggested_comment STRING"
