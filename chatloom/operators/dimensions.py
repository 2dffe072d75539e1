"""The four dimensions and how a refresh merges into them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.attributes import agent_name, calendar_columns, support_team
from ..schemas import (
    ASSIGNED,
    DIM_AGENT,
    DIM_DATE,
    DIM_RESOLUTION_TYPE,
    DIM_SURVEY_RESPONSE,
    RESOLUTION_TYPES,
    STARTED,
    SURVEY_RESPONSES,
    conform,
)


def resolution_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(RESOLUTION_TYPES), DIM_RESOLUTION_TYPE)


def survey_responses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SURVEY_RESPONSES), DIM_SURVEY_RESPONSE)


def dates_of(events: DataFrame) -> DataFrame:
    """Calendar rows for the start dates of all chats, open ones too."""
    days = events.where(F.col("event_type") == STARTED).select(
        F.col("event_timestamp").cast("date").alias("day")
    )
    return days.distinct().select(*calendar_columns(F.col("day")))


def agents_of(events: DataFrame) -> DataFrame:
    """Name and team of every agent that was ever assigned."""
    agents = events.where(
        (F.col("event_type") == ASSIGNED) & F.col("agent_id").isNotNull()
    ).select("agent_id")
    agent = F.col("agent_id")
    return agents.distinct().select(
        "agent_id",
        agent_name(agent).alias("agent_name"),
        support_team(agent).alias("support_team"),
    )


def merge_dates(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Insert if absent: a date that exists stays as it is."""
    if old is None:
        return conform(new, DIM_DATE)
    added = new.join(old.select("date_key"), "date_key", "left_anti")
    return conform(old, DIM_DATE).unionByName(conform(added, DIM_DATE))


def merge_agents(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Upsert: new attributes win, keys and agents no longer seen stay."""
    if old is None:
        keyed = new.withColumn("agent_key", F.monotonically_increasing_id() + 1)
        return conform(keyed, DIM_AGENT)
    highest = old.agg(F.coalesce(F.max("agent_key"), F.lit(0)).alias("highest")).scalar()
    merged = (
        old.alias("old")
        .join(new.alias("new"), "agent_id", "full_outer")
        .select(
            "agent_id",
            "agent_key",
            *[
                F.coalesce(F.col(f"new.{name}"), F.col(f"old.{name}")).alias(name)
                for name in ("agent_name", "support_team")
            ],
        )
    )
    return conform(with_fresh_keys(merged, "agent_key", highest), DIM_AGENT)


def with_fresh_keys(df: DataFrame, key: str, highest: Column) -> DataFrame:
    """Fill NULL keys with values above ``highest``.

    Like an identity column the keys are unique and may have gaps; numbering
    needs neither a shuffle nor a global sort.
    """
    return df.withColumn(
        key, F.coalesce(F.col(key), highest + 1 + F.monotonically_increasing_id())
    )
