"""Deduplication that keeps the same row on every run.

Of the rows with equal keys the smallest is kept, comparing the other columns from left to
right with nulls first. Both forms cut a key to one row per task before the shuffle, so a
key that holds a large part of the table does not end up in one task with all its copies.
``without_copies_late`` keeps the same rows, but moves keys in place of rows.
"""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplake.operators.ranking import first_per_group
from shoplake.sources.session import scratch_dir

COPIES = "copies"
REPEATED = 500_000  # keys that are broadcast at most


def without_copies(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key."""
    return first_per_group(df, keys, [F.asc(c) for c in df.columns if c not in keys])


def without_copies_late(df: DataFrame, keys: Sequence[str], most: int = REPEATED) -> DataFrame:
    """The same rows, for sources that are cheap to read again, such as stored columns.

    A first job moves nothing but keys and finds those that several rows have. Rows of other keys
    then stay where they are read; only the rows of repeated keys, which are told by a broadcast
    of these keys, are moved and compared. Null keys are equal to each other. With more than
    ``most`` repeated keys this gives ``without_copies``.
    """
    prefix = max(df.columns, key=len)  # so that no name is one of the frame's
    names = [f"{prefix}_{i}" for i in range(len(keys))]
    counts = df.groupBy(*[F.col(key).alias(name) for key, name in zip(keys, names)])
    counts = counts.agg(F.count(F.lit(1)).alias(COPIES)).filter(F.col(COPIES) > 1).select(*names)
    path = scratch_dir(df.sparkSession)
    counts.write.parquet(path)
    repeated = df.sparkSession.read.schema(counts.schema).parquet(path)
    if repeated.count() > most:
        return without_copies(df, keys)
    same = reduce(and_, [F.col(key).eqNullSafe(F.col(name)) for key, name in zip(keys, names)])
    single = df.join(F.broadcast(repeated), same, "left_anti")
    several = df.join(F.broadcast(repeated), same, "left_semi")
    return single.unionByName(without_copies(several, keys))


def keep_first(df: DataFrame, keys: Sequence[str], tallies: Sequence[Column] = ()) -> DataFrame:
    """The same rows, plus how many copies there were and any further aggregates over them.

    Costs more than ``without_copies``, as Spark sorts to find a smallest struct; still less
    than a second pass over the source to count it.
    """
    rest = [name for name in df.columns if name not in keys]
    grouped = df.groupBy(*keys).agg(
        F.min(F.struct(*rest)).alias("first"), F.count(F.lit(1)).alias(COPIES), *tallies
    )
    extra = grouped.columns[len(keys) + 1 :]
    kept = [F.col(name) if name in keys else F.col(f"first.{name}") for name in df.columns]
    return grouped.select(*kept, *extra)
