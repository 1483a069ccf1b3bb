"""Cleaning rules of the customer dimension, as SQL expressions."""

from __future__ import annotations

from lakestrata.values import (
    IMPUTED_EMAIL_PREFIX,
    IMPUTED_EMAIL_SUFFIX,
    UNKNOWN_CITY,
    UNKNOWN_NAME,
    UNKNOWN_STATE,
)


def is_blank(column: str) -> str:
    return f"({column} IS NULL OR trim({column}) = '')"


def _or_default(column: str, default: str) -> str:
    """The trimmed cell, or a default where nothing but blanks is left."""
    return f"IF({is_blank(column)}, {default}, trim({column}))"


def customer_cleaning() -> dict[str, str]:
    """Output column -> expression over the raw customer columns.

    A missing name becomes "Unknown" but a blank one stays blank, and the full
    name is built from the raw parts: these rules are visible in the data.
    """
    imputed = (
        f"'{IMPUTED_EMAIL_PREFIX}' || CAST(customer_id AS STRING) || '{IMPUTED_EMAIL_SUFFIX}'"
    )
    return {
        "first_name": f"trim(coalesce(first_name, '{UNKNOWN_NAME}'))",
        "last_name": f"trim(coalesce(last_name, '{UNKNOWN_NAME}'))",
        "customer_name": "trim(concat(coalesce(first_name, ''), ' ', coalesce(last_name, '')))",
        "email": _or_default("email", imputed),
        "email_raw": "email",
        "city": _or_default("city", f"'{UNKNOWN_CITY}'"),
        "city_raw": "city",
        "state": _or_default("state", f"'{UNKNOWN_STATE}'"),
    }
