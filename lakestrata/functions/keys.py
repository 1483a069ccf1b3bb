"""Content fingerprints and salts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakestrata.values import KEY_DELIMITER, SHA_BITS


def fingerprint(*cells: str, null_token: str = "") -> Column:
    """SHA-256 over the text of the cells, each a column name or SQL expression.

    NULL and the empty string give the same key by default; another
    ``null_token`` keeps them apart, at the price of keys that do not compare
    with those already stored.
    """
    return F.sha2(content_text(*cells, null_token=null_token), SHA_BITS)


def content_text(*cells: str, null_token: str = "") -> Column:
    """The text of the cells that ``fingerprint`` digests."""
    texts = ", ".join(f"coalesce(CAST({cell} AS STRING), '{null_token}')" for cell in cells)
    return F.expr(f"concat_ws('{KEY_DELIMITER}', {texts})")


def salted(needs_salt: str, spread_by: str, slots: int) -> Column:
    """A slot 0..slots-1 for rows that need spreading, 0 for all others."""
    return F.expr(
        f"CAST(IF({needs_salt}, pmod(xxhash64({spread_by}), {slots}), 0) AS INT)"
    )
