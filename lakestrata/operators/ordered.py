"""What stands before a row in its key's order, keys of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakestrata.operators.staging import stage


# Rows of one key that stay together: a key of more is cut by its order.
_CUT_ROWS = 2**18
_MOST_CUTS = 1000
# Rows sampled for each cut, of which one bounds it.
_SAMPLED = 32
# Slots that rows without a key are dealt over.
_LOOSE_SLOTS = 1024

_CUT = "_cut"


def with_cuts(
    df: DataFrame, key: str, order: Sequence[str], counted: DataFrame | None = None
) -> tuple[DataFrame, bool]:
    """Rows with ``_cut``, the part of its key's order that a row lies in, and whether
    any key is cut.

    Rows are counted per key.  Keys of very many are hot: their order is cut at places
    sampled from it, which are written once, and their cuts are numbered from 1; rows
    equal in key and order share one.  Other keys have the one cut 0.  Rows without a
    key are dealt out.  Counts and places come from ``counted``, rows that cost less to
    read and hold those of ``df``, or from ``df`` itself.
    """
    place = F.struct(*order)
    counted = df if counted is None else counted
    hot = (
        counted.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_hot"))
        .agg(F.count("*").alias("_rows"))
        .filter(F.col("_rows") > _CUT_ROWS)
        .select("_hot", F.greatest(F.lit(_CUT_ROWS), F.col("_rows") / _MOST_CUTS).alias("_each"))
    )
    sampled = (
        counted.join(F.broadcast(hot), F.col(key) == F.col("_hot"))
        .filter(F.rand(1) < F.lit(_SAMPLED) / F.col("_each"))
        .groupBy("_hot")
        .agg(F.sort_array(F.collect_list(place)).alias("_sample"))
    )
    bounds = F.filter("_sample", lambda _, k: k % _SAMPLED == _SAMPLED - 1)
    cuts = stage(sampled.select("_hot", F.array_distinct(bounds).alias("_bounds")), "cuts")
    cut = not cuts.isEmpty()
    number = F.lit(0)
    if cut:
        df = df.join(F.broadcast(cuts), F.col(key) == F.col("_hot"), "left")
        ahead = F.size(F.filter("_bounds", lambda bound: bound <= place))
        number = F.when(F.col("_bounds").isNull(), 0).otherwise(ahead + 1)
    loose = -F.pmod(F.xxhash64(*order), F.lit(_LOOSE_SLOTS)).cast("int")
    placed = df.withColumn(_CUT, F.when(F.col(key).isNull(), loose).otherwise(number))
    return placed.drop("_hot", "_bounds"), cut


def last_before(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    name: str,
    descending: bool = False,
    cut: bool | None = None,
) -> DataFrame:
    """``name``: the last ``value`` that is not null in the rows of the same key in
    front of a row, in the order of the columns ``order``; null where there is none.

    The rows of a key meet by one shuffle; a hot key is cut by its order, so no task
    has it whole.  A cut looks inside itself first; what it lacks, it takes from the
    cuts before: one edge row for each cut.  Among rows equal in key and order any may
    count as the first.  Rows without a key have nothing before them.

    ``cut`` is what ``with_cuts`` said of the rows, by the same key and order; their
    cuts then stay, and steps that follow each other share a shuffle.  Without it the
    rows are written once and cut here.
    """
    if cut is None:
        columns = [c for c in df.columns if c != name]
        placed, cut = with_cuts(stage(df.select(*columns), "ordered"), key, order)
        found = last_before(placed, key, order, value, name, descending, cut)
        return found.select(*columns, name)
    sides = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    inside = Window.partitionBy(key, _CUT).orderBy(*sides)
    ahead = Window.unboundedPreceding, -1
    latest = F.last(value, ignorenulls=True).over(inside.rowsBetween(*ahead))
    found = df.withColumn(name, F.when(F.col(key).isNotNull(), latest))
    if not cut:
        return found
    last = "min_by" if descending else "max_by"
    place = f"struct({', '.join(order)})"
    edges = (
        df.filter(F.col(_CUT) > 0)
        .groupBy(F.col(key).alias("_of"), F.col(_CUT).alias("_into"))
        .agg(F.expr(f"{last}({value}, {place}) FILTER (WHERE {value} IS NOT NULL)").alias("_edge"))
    )
    number = F.col("_into").desc() if descending else F.col("_into").asc()
    over = Window.partitionBy("_of").orderBy(number).rowsBetween(*ahead)
    carried = edges.select(
        "_of", "_into", F.last("_edge", ignorenulls=True).over(over).alias("_carried")
    )
    matches = (F.col(key) == F.col("_of")) & (F.col(_CUT) == F.col("_into"))
    return (
        found.join(F.broadcast(carried), matches, "left")
        .withColumn(name, F.coalesce(name, "_carried"))
        .drop("_of", "_into", "_carried")
    )


def valid_at(
    facts: DataFrame,
    key: str,
    at: str,
    versions: DataFrame,
    columns: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> DataFrame:
    """Facts with ``columns`` of the version of their key that is valid at their time.

    A version is valid from ``valid_from``, included, to ``valid_to``, excluded; of
    one key versions do not overlap.  Versions and facts are put in one order by key
    and time, and each fact takes the last version in front of it: no join by range,
    and a key of very many facts is cut by time.  Facts without a key, and those at
    whose time no version holds, get nulls.  Facts are written once.
    """
    facts = stage(facts, "facts")
    taken = F.struct(F.col(valid_to).alias("_valid_to"), *columns)
    nothing = F.lit(None).cast(versions.select(taken.alias("v")).schema["v"].dataType)
    starts = versions.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"),
        F.col(valid_from).alias("_at"),
        F.lit(0).alias("_kind"),
        taken.alias("_version"),
        F.lit(None).cast(facts.select(F.struct("*").alias("f")).schema["f"].dataType).alias("_fact"),
    )
    asked = facts.select(
        F.col(key).alias("_key"),
        F.col(at).alias("_at"),
        F.lit(1).alias("_kind"),
        nothing.alias("_version"),
        F.struct("*").alias("_fact"),
    )
    keyed = starts.unionByName(asked.filter("_key IS NOT NULL AND _at IS NOT NULL"))
    order = ["_at", "_kind"]
    placed, cut = with_cuts(keyed, "_key", order)
    found = last_before(placed, "_key", order, "_version", "_found", cut=cut).filter("_kind = 1")
    holds = F.col("_found._valid_to").isNull() | (F.col("_at") < F.col("_found._valid_to"))
    answered = found.select(
        "_fact.*", *[F.when(holds, F.col(f"_found.{c}")).alias(c) for c in columns]
    )
    loose = asked.filter("_key IS NULL OR _at IS NULL").select(
        "_fact.*", *[F.col(f"_version.{c}").alias(c) for c in columns]
    )
    return answered.unionByName(loose)
