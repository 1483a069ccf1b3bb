import itertools
import tempfile

import pytest

from lakestrata.contracts import build_contracts, ensure_tables
from lakestrata.session import local_session

_prefixes = (f"t{n}_" for n in itertools.count(1))


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="lakestrata-tests-")
    session = local_session(
        4,
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": f"{folder}/warehouse",
            "spark.checkpoint.dir": f"{folder}/checkpoints",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def contracts(spark):
    """Fresh empty tables, in schemas of their own."""
    fresh = build_contracts(prefix=next(_prefixes))
    ensure_tables(spark, fresh)
    return fresh


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect


@pytest.fixture
def setting(spark):
    """Set session settings for one test."""
    before = {}

    def change(**values):
        for name, value in values.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture
def plan(capsys):
    def text(df, mode="formatted"):
        capsys.readouterr()
        df.explain(mode)
        return capsys.readouterr().out

    return text
