"""Replacing source dates in the raw layer.

Loading a date first deletes the events that fall on it, and the surveys of
their chats, then adds the delivery. A run over several dates does that once
per date, in order. Here the whole run is one set of joins: every row has a
position in the run (-1 for rows that were there before), and it is deleted by
the delivery of its own date when that comes later.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EVENT_DATE = "event_date"
INGESTION_DATE = "ingestion_date"


def replace_key(replace_by: str) -> Column:
    """The date of an event that decides which delivery replaces it."""
    if replace_by == EVENT_DATE:
        return F.col("event_timestamp").cast("date")
    if replace_by == INGESTION_DATE:
        return F.col("ingestion_date")
    raise ValueError(f"replace_by must be {EVENT_DATE!r} or {INGESTION_DATE!r}")


def _positions(like: DataFrame, dates: Sequence[date], date_name: str, name: str) -> DataFrame:
    """The run's dates with their places; its size is that of the given list."""
    rows = [(day, place) for place, day in enumerate(dates)]
    return F.broadcast(like.sparkSession.createDataFrame(rows, f"{date_name} date, {name} int"))


@dataclass(frozen=True)
class Replacement:
    """What a run does to the raw layer. Event frames carry no helper columns."""

    deleted_events: DataFrame
    kept_events: DataFrame
    new_events: DataFrame
    deleted_chats: DataFrame
    kept_surveys: DataFrame
    deleted_surveys: DataFrame
    new_surveys: DataFrame

    @property
    def events(self) -> DataFrame:
        return self.kept_events.unionByName(self.new_events)

    @property
    def surveys(self) -> DataFrame:
        return self.kept_surveys.unionByName(self.new_surveys)


def any_overtaken(events: DataFrame, dates: Sequence[date], replace_by: str = EVENT_DATE) -> bool:
    """Whether a later delivery of the run deletes a row of an earlier one.

    Only the rows' dates are read, and the driver gets their distinct pairs.
    """
    places = {day: place for place, day in enumerate(dates)}
    pairs = events.select("source_date", replace_key(replace_by).alias("replaced_on")).distinct()
    return any(
        places.get(row.replaced_on, -1) > places[row.source_date]
        for row in pairs.where(F.col("source_date").isin(*dates)).collect()
    )


def replace_dates(
    old_events: DataFrame,
    old_surveys: DataFrame,
    events: DataFrame,
    surveys: DataFrame,
    dates: Sequence[date],
    replace_by: str = EVENT_DATE,
    overtakes: bool = True,
    settle: Callable[[DataFrame], DataFrame] = lambda chats: chats,
) -> Replacement:
    """Apply the deliveries of ``dates``; ``events`` and ``surveys`` carry ``source_date``.

    A date without rows still deletes what was there. Extra columns of the old
    frames are kept in the frames derived from them. ``overtakes`` is false if it is known
    that no delivery deletes rows of an earlier one (``any_overtaken``); ``settle`` may
    write the deleted chats, which several frames read.
    """
    key = replace_key(replace_by)
    # Stored events have the date as a partition column; with a literal list
    # only the partitions concerned are read.
    stored_key = F.col(replace_by) if replace_by in old_events.columns else key
    in_run = F.coalesce(stored_key.isin(*dates), F.lit(False))
    replaced = old_events.where(in_run)
    kept_events = old_events.where(~in_run)

    source_place = _positions(events, dates, "source_date", "place")
    key_place = _positions(events, dates, "replaced_on", "replaced_at")
    # Places are joined only where a chat's last deletion is looked for. Every pass over the
    # new events would join them again, and in a run of ascending dates, or one that overtakes
    # nothing, a row's dates tell as much.
    delivered = events.where(F.col("source_date").isin(*dates))
    deleted_from = replaced.withColumn("replaced_on", stored_key).join(key_place, "replaced_on")
    deleted_from = deleted_from.select("chat_id", "replaced_at")
    new_events = delivered
    if overtakes:
        placed = (
            events.join(source_place, "source_date")
            .withColumn("replaced_on", key)
            .join(key_place, "replaced_on", "left")
        )
        overtaken = F.coalesce(F.col("replaced_at") > F.col("place"), F.lit(False))
        lost = placed.where(overtaken).select("chat_id", "replaced_at")
        deleted_from = deleted_from.unionByName(lost)
        if all(earlier < later for earlier, later in pairwise(dates)):
            later_in_run = (key > F.col("source_date")) & key.isin(*dates)
            new_events = delivered.where(~F.coalesce(later_in_run, F.lit(False)))
        else:
            new_events = placed.where(~overtaken)
    new_events = new_events.select(
        "source_date", *(name for name in events.columns if name != "source_date")
    )

    deleted_chats = deleted_from.groupBy("chat_id").agg(F.max("replaced_at").alias("deleted_at"))
    deleted_chats = settle(deleted_chats)
    kept_surveys = old_surveys.join(deleted_chats, "chat_id", "left_anti")
    deleted_surveys = old_surveys.join(deleted_chats, "chat_id", "left_semi")
    new_surveys = (
        surveys.join(source_place, "source_date")
        .join(deleted_chats, "chat_id", "left")
        .where(F.col("deleted_at").isNull() | (F.col("deleted_at") <= F.col("place")))
        .drop("place", "deleted_at")
    )
    return Replacement(
        replaced,
        kept_events,
        new_events,
        deleted_chats,
        kept_surveys.select(*old_surveys.columns),
        deleted_surveys.select(*old_surveys.columns),
        new_surveys.select(*surveys.columns),
    )
