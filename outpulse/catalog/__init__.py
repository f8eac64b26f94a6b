"""Every registered query with its inputs and its SQL twin."""

from outpulse.catalog import (  # noqa: F401
    function_queries,
    mention_queries,
    outreach_queries,
    stream_queries,
    traffic_queries,
    web_queries,
)
from outpulse.catalog.registry import QUERIES, SQL  # noqa: F401
