"""Running totals over keys that may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize

SLICE = "slice"
# Stored bytes that a task of a sort or window gets; rows in memory take several times that.
TASK_BYTES = 16 << 20


def tasks_for(written: DataFrame) -> int:
    """How many tasks a shuffle of a written table takes, by the size of its files.

    Left alone, Spark merges narrow, well compressed rows into tasks that have to spill.
    """
    size = int(str(written._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(written.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))


def sliced(df: DataFrame, keys: list[str], order: list[str], label: str) -> DataFrame:
    """Write ``df`` in even slices along ``keys`` and ``order``, numbered in that order.

    Spark samples the rows to find the cuts, so the slices are even whatever
    the keys look like: a key with a third of all rows gets a third of the
    slices. The table is written because the cuts of another run may differ.
    """
    ranged = df.repartitionByRange(*keys, *order)
    return materialize(ranged.withColumn(SLICE, F.spark_partition_id()), label)


def opening_balances(
    df: DataFrame,
    keys: list[str],
    values: dict[str, Column],
    totals: dict[str, str] | None = None,
) -> DataFrame:
    """What each key had summed up before each of its slices, as ``<name>_before``.

    The sums per (key, slice) combine map-side, so the window below sees one
    row per slice of a key and never the detail rows. The result is partitioned
    by key: a join hands that on, and all of a key's slices would meet in one task
    again, so partition it by key and slice. ``totals`` names columns for a value's sum
    over all of the key's slices.
    """
    per_slice = df.groupBy(*keys, SLICE).agg(*[F.sum(v).alias(n) for n, v in values.items()])
    whole = W.partitionBy(*keys)
    earlier = whole.orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    return per_slice.select(
        *keys,
        SLICE,
        *[
            F.coalesce(F.sum(n).over(earlier), F.lit(0)).cast("bigint").alias(f"{n}_before")
            for n in values
        ],
        *[F.sum(n).over(whole).alias(name) for n, name in (totals or {}).items()],
    )


def running_within(
    df: DataFrame, keys: list[str], order: list[str], values: dict[str, Column]
) -> DataFrame:
    """Add ``<name>_running`` to sliced rows that carry their ``<name>_before``."""
    so_far = (
        W.partitionBy(*keys, SLICE).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return df.withColumns(
        {f"{n}_running": F.col(f"{n}_before") + F.sum(v).over(so_far) for n, v in values.items()}
    )


def running_totals(
    df: DataFrame, keys: list[str], order: list[str], values: dict[str, Column], label: str
) -> DataFrame:
    """``df`` with the running total of every value per key."""
    rows = sliced(df, keys, order, label)
    opening = opening_balances(rows, keys, values).repartition(*keys, SLICE)
    return running_within(rows.join(opening, [*keys, SLICE]), keys, order, values)
