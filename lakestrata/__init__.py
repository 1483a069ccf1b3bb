"""Layered retail analytics on plain Spark tables.

Raw feeds become fingerprinted bronze rows, bronze becomes silver dimensions,
a fact table and a quarantine, silver becomes gold marts.  Every operator takes
DataFrames and returns a DataFrame; writing is a separate step.
"""

__version__ = "0.1.0"
