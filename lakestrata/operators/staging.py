"""Written intermediate results."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame

from lakestrata.session import brief_shuffles, shared_folder


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a result once to the shared folder and go on from the files.

    Used where a plan reads the same expensive or order-dependent result more
    than once.  Unlike a cached or locally checkpointed DataFrame it survives
    lost executors, it is read with column pruning, and its true size is known
    to the planner.
    """
    path = _new_path(df, label)
    return _write_and_read(df, path)


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """A stage for the length of a block, for callers that finish their writes in it.

    Afterwards its files give way to an empty result, so that repeated loads do
    not fill the shared folder.
    """
    path = _new_path(df, label)
    try:
        yield _write_and_read(df, path)
    finally:
        nothing = df.sparkSession.createDataFrame([], df.schema)
        nothing.write.mode("overwrite").parquet(path)


def _new_path(df: DataFrame, label: str) -> str:
    return f"{shared_folder(df.sparkSession)}/stages/{label}-{uuid4().hex}"


def _write_and_read(df: DataFrame, path: str) -> DataFrame:
    with brief_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
