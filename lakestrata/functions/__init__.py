"""Column expressions; all of them built from native Spark functions."""

from lakestrata.functions.cleaning import customer_cleaning, is_blank
from lakestrata.functions.conversion import try_convert
from lakestrata.functions.keys import fingerprint, salted
from lakestrata.functions.money import money_sum, safe_ratio
from lakestrata.functions.times import instant, month_start

__all__ = [
    "customer_cleaning",
    "fingerprint",
    "instant",
    "is_blank",
    "money_sum",
    "month_start",
    "safe_ratio",
    "salted",
    "try_convert",
]
