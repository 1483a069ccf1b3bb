"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

# Runtime settings the operators were designed for.  Shuffle partition counts
# and memory are the cluster's business: AQE coalesces and splits from there.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` to a session the caller already has."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("lakestrata")
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def side_by_side(
    spark: SparkSession, steps: Iterable[Callable[[], object]], at_once: int = 8
) -> None:
    """Run independent steps together and wait for all of them.

    Their Spark jobs share the cluster, so one's last tasks do not idle it.
    """
    with ThreadPoolExecutor(at_once) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    for step in running:
        step.result()


_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writing = {"lock": Lock(), "blocks": 0, "before": None}


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write in this block go when the write is done.

    Else they stay until the driver collects its garbage, and the disk holds those of
    many steps.  Blocks may overlap; the last to end puts the setting back.
    """
    with _writing["lock"]:
        if not _writing["blocks"]:
            _writing["before"] = spark.conf.get(_CLEAN_UP, None)
            spark.conf.set(_CLEAN_UP, "true")
        _writing["blocks"] += 1
    try:
        yield
    finally:
        with _writing["lock"]:
            _writing["blocks"] -= 1
            if not _writing["blocks"]:
                before = _writing["before"]
                spark.conf.unset(_CLEAN_UP) if before is None else spark.conf.set(_CLEAN_UP, before)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    On a cluster the setting has to be there: a folder of one machine would be
    lost with it.  Only a local session falls back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder all executors share"
            )
        folder = tempfile.mkdtemp(prefix="lakestrata-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")
