"""Relational operators: DataFrames in, DataFrame out."""

from lakestrata.operators.audit import audit_after
from lakestrata.operators.changes import change_set, incremental_since, net_changes
from lakestrata.operators.dedupe import assert_unique, latest_by
from lakestrata.operators.digests import content_differences, multiset_digest
from lakestrata.operators.distinct import distinct_counts, distinct_state, merge_states
from lakestrata.operators.history import scd2_apply, splice_versions, versions_of
from lakestrata.operators.joins import lookup, without_match
from lakestrata.operators.merge import upsert, upsert_stored
from lakestrata.operators.ordered import last_before, valid_at
from lakestrata.operators.ranking import rank_within
from lakestrata.operators.sequence import with_surrogate_key
from lakestrata.operators.staging import stage

__all__ = [
    "assert_unique",
    "audit_after",
    "change_set",
    "content_differences",
    "distinct_counts",
    "distinct_state",
    "incremental_since",
    "last_before",
    "latest_by",
    "lookup",
    "merge_states",
    "multiset_digest",
    "net_changes",
    "rank_within",
    "scd2_apply",
    "splice_versions",
    "stage",
    "upsert",
    "upsert_stored",
    "valid_at",
    "versions_of",
    "with_surrogate_key",
    "without_match",
]
