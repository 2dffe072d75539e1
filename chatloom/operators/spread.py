"""Joining a dimension when some of its keys hold very many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# A key is heavy when it has more than this part of the rows, so fewer keys are than parts.
PARTS = 64


def beyond_broadcast(dimension: DataFrame) -> bool:
    """Whether Spark, by what it knows of the size, would not broadcast the frame.

    Of a written table it knows the size of the files.
    """
    plan = dimension._jdf.queryExecution().optimizedPlan()
    size = int(str(plan.stats().sizeInBytes()))
    return size > dimension.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def heavy_keys(rows: DataFrame, key: str, parts: int = PARTS) -> list:
    """The keys, NULL aside, that more than one in ``parts`` rows has: fewer than ``parts``.

    Rows are counted before the shuffle, which has a row per key and task.
    """
    counts = materialize(rows.groupBy(key).agg(F.count("*").alias("rows")), "key-counts")
    total = counts.agg(F.sum("rows").alias("total")).first().total or 0
    over = F.col(key).isNotNull() & (F.col("rows") * parts > total)
    return [row[key] for row in counts.where(over).collect()]


def spread_join(rows: DataFrame, dimension: DataFrame, key: str, parts: int = PARTS) -> DataFrame:
    """Left join with a dimension of unique keys, however many rows have one of them.

    The rows of heavy keys stay where they are and meet the heavy keys' few rows of the
    dimension, which are broadcast; rows without a key, which match nothing, stay with
    them. Only the rest is shuffled, and none of its keys has more than one in ``parts`` of all
    rows. ``rows`` is read three times and should be a written table. A key that the
    dimension lacks gives NULLs.
    """
    heavy = heavy_keys(rows, key, parts)
    staying = F.col(key).isNull() | F.col(key).isin(heavy)
    few = F.broadcast(dimension.where(F.col(key).isin(heavy)))
    near = rows.where(staying).join(few, key, "left")
    far = rows.where(~staying).join(dimension, key, "left")
    return near.unionByName(far)
