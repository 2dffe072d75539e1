"""Derived attributes of dates, agents and surveys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import CLOSURES, EVENT_TYPES


def date_key(day: Column) -> Column:
    """YYYYMMDD as an integer."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.day(day)).cast("int")


def calendar_columns(day: Column) -> list[Column]:
    """Columns of the date dimension; Monday is 1 and Sunday 7."""
    iso_day = F.extract(F.lit("DAYOFWEEK_ISO"), day)
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        iso_day.cast("smallint").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.month(day).cast("smallint").alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).cast("smallint").alias("quarter_number"),
        F.year(day).cast("smallint").alias("year_number"),
        iso_day.isin(6, 7).alias("is_weekend"),
    ]


# Agent labels and the support teams by agent number.
def agent_name(agent_id: Column) -> Column:
    return F.concat(F.lit("Agent "), agent_id.cast("string"))


def support_team(agent_id: Column) -> Column:
    team = agent_id % 3
    return (
        F.when(team == 0, "Billing Support")
        .when(team == 1, "Account Support")
        .otherwise("Technical Support")
    )


def event_kind(event_type: Column) -> Column:
    """Position of the type in the vocabulary, 0 for anything else.

    A small integer keeps the grouped aggregates on fixed-width buffers, which
    is what lets Spark use hash aggregation for them.
    """
    branch = F.when(event_type == EVENT_TYPES[0], 1)
    for position, name in enumerate(EVENT_TYPES[1:], start=2):
        branch = branch.when(event_type == name, position)
    return branch.otherwise(0)


def kind_of(name: str) -> int:
    return EVENT_TYPES.index(name) + 1


CLOSURE_KINDS = tuple(kind_of(name) for name in CLOSURES)

