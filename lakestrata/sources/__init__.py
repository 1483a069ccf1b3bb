"""Where rows come from: CSV feeds, catalog tables, the session itself."""

from lakestrata.sources.feeds import (
    Feed,
    add_fingerprint,
    feeds,
    read_feed,
    reject_rows,
    typed_rows,
    valid_rows,
)
from lakestrata.sources.tables import (
    read_months,
    read_table,
    register_views,
    require_table,
    session_info,
)

__all__ = [
    "Feed",
    "add_fingerprint",
    "feeds",
    "read_feed",
    "read_months",
    "read_table",
    "register_views",
    "reject_rows",
    "require_table",
    "session_info",
    "typed_rows",
    "valid_rows",
]
