"""Finding a few keys in a large table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .spread import beyond_broadcast


def within_span(table: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows of ``table`` whose key lies between the lowest and highest wanted key.

    Ids begin with the date and files are sorted by them, so this filter, which
    reaches the Parquet statistics, leaves a daily load little to read. A key
    outside the span cannot match. ``wanted`` should be a written table.
    """
    span = wanted.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
    if span.low is None:
        return table.where(F.lit(False))
    return table.where(F.col(key).between(span.low, span.high))


def matching(table: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows of ``table`` whose key is among the wanted ones."""
    return within_span(table, key, wanted).join(wanted.select(key), key, "left_semi")


def maybe_repeated(df: DataFrame, *keys: str) -> DataFrame:
    """The rows of ``df`` that may share their ``keys`` with another row, or all rows.

    Eight bytes a row are shuffled, a hash of the keys, and without a map-side step, since
    keys that should be unique have nothing to combine. Only hashes that several rows have
    are kept. As a rule there are none; a few are broadcast to find their rows. The caller
    compares the keys themselves.
    """
    hashed = df.select(F.xxhash64(*keys).alias("key_hash")).repartition("key_hash")
    counts = hashed.groupBy("key_hash").agg(F.count("*").alias("rows"))
    shared = materialize(counts.where("rows > 1").select("key_hash"), "shared-hashes")
    if shared.isEmpty():
        return df.limit(0)
    if beyond_broadcast(shared):
        return df
    return df.join(F.broadcast(shared), F.xxhash64(*keys) == F.col("key_hash"), "left_semi")
