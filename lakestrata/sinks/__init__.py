"""Where rows go: tables, CSV folders, the run log."""

from lakestrata.sinks.commits import (
    last_commit,
    merge_with_changes,
    net_changes_between,
    read_changes,
    state_at,
)
from lakestrata.sinks.csv import show_overview, write_csv, write_ordered_csv
from lakestrata.sinks.tables import append_run, append_table, last_event_ts, merge_table, replace_table

__all__ = [
    "append_run",
    "append_table",
    "last_commit",
    "last_event_ts",
    "merge_table",
    "merge_with_changes",
    "net_changes_between",
    "read_changes",
    "replace_table",
    "show_overview",
    "state_at",
    "write_csv",
    "write_ordered_csv",
]
