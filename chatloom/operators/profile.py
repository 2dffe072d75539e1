"""One row per chat: everything the rules and the mart need, in one grouping.

The aggregates all have fixed-width buffers, so Spark hashes instead of
sorting, and they combine map-side, so a chat of any size reaches the reducer
as one row per map task. Surveys enter the same grouping as extra rows, which
replaces a join on the chat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.attributes import CLOSURE_KINDS, event_kind, kind_of
from ..schemas import (
    AGENT_ACTIVITY,
    AGENT_REPLY,
    ASSIGNED,
    CLOSED_BY_SYSTEM,
    CUSTOMER_REPLY,
    PUSHED,
    QUEUED,
    STARTED,
)

# What one survey row says: (response code, satisfied flag). A skipped survey
# keeps the flag of the input it should not have. Position 0 is an input
# outside the vocabulary.
SURVEY_STATES: tuple[tuple[str, bool | None], ...] = (
    ("skipped", None),
    ("skipped", True),
    ("skipped", False),
    ("no_response", None),
    ("satisfied", True),
    ("dissatisfied", False),
)


def survey_state(skipped: Column, customer_input: Column) -> Column:
    satisfied, dissatisfied = customer_input == "satisfied", customer_input == "dissatisfied"
    return (
        F.when(skipped, F.when(satisfied, 2).when(dissatisfied, 3).otherwise(1))
        .when(customer_input.isNull(), 4)
        .when(satisfied, 5)
        .when(dissatisfied, 6)
        .otherwise(0)
    )


def state_column(position: int) -> str:
    return f"surveys_in_state_{position}"


def _event_rows(events: DataFrame) -> DataFrame:
    return events.select(
        "chat_id",
        "agent_id",
        event_kind(F.col("event_type")).alias("kind"),
        (F.col("event_type").isNull() | F.col("event_timestamp").isNull()).alias("unclear"),
        "event_timestamp",
        "ingestion_date",
    )


def chat_profile(events: DataFrame, surveys: DataFrame | None = None) -> DataFrame:
    """Counts and milestones per chat; survey counts when ``surveys`` is given.

    A chat that only has surveys appears with ``events`` = 0.
    """
    rows = _event_rows(events)
    survey_counts: list[Column] = []
    if surveys is not None:
        states = surveys.select(
            "chat_id",
            survey_state(F.col("survey_skipped"), F.col("customer_input")).alias("state"),
        )
        rows = rows.unionByName(states, allowMissingColumns=True)
        survey_counts = [
            F.count("state").alias("surveys"),
            *[
                F.count_if(F.col("state") == position).alias(state_column(position))
                for position in range(1, len(SURVEY_STATES) + 1)
            ],
        ]

    kind, moment, agent = F.col("kind"), F.col("event_timestamp"), F.col("agent_id")

    def is_(name: str) -> Column:
        return kind == kind_of(name)

    closing = kind.isin(*CLOSURE_KINDS)
    active = kind.isin(*[kind_of(name) for name in AGENT_ACTIVITY])
    assigned = is_(ASSIGNED)
    return rows.groupBy("chat_id").agg(
        F.count("kind").alias("events"),
        F.count_if(is_(STARTED)).alias("starts"),
        F.count_if(is_(QUEUED)).alias("queue_entries"),
        F.count_if(assigned).alias("assignments"),
        F.count_if(closing).alias("closures"),
        F.count_if(is_(AGENT_REPLY)).cast("int").alias("agent_response_count"),
        F.count_if(is_(CUSTOMER_REPLY)).cast("int").alias("customer_response_count"),
        F.count_if(is_(CLOSED_BY_SYSTEM)).alias("system_closures"),
        F.coalesce(F.bool_or(is_(PUSHED)), F.lit(False)).alias("pushed_due_to_inactivity"),
        F.min(moment).alias("first_event_at"),
        F.max(moment).alias("last_event_at"),
        F.min(F.when(is_(STARTED), moment)).alias("started_at"),
        F.min(F.when(is_(QUEUED), moment)).alias("entered_queue_at"),
        F.min(F.when(assigned, moment)).alias("assigned_at"),
        F.min(F.when(assigned & agent.isNotNull(), moment)).alias("agent_known_at"),
        F.min(F.when(is_(AGENT_REPLY), moment)).alias("first_agent_response_at"),
        F.min(F.when(active, moment)).alias("first_activity_at"),
        F.min(F.when(closing, moment)).alias("closed_at"),
        F.max(F.when(is_(PUSHED), moment)).alias("last_push_at"),
        F.min(F.when(is_(CLOSED_BY_SYSTEM), moment)).alias("first_system_closure_at"),
        F.max(F.when(is_(CLOSED_BY_SYSTEM), moment)).alias("last_system_closure_at"),
        F.max(F.when(closing, kind)).alias("closing_kind"),
        F.max(F.when(assigned, agent)).alias("assigned_agent_id"),
        F.min(agent).alias("lowest_agent_id"),
        F.max(agent).alias("highest_agent_id"),
        F.max("ingestion_date").alias("ingestion_date"),
        F.min(F.when(~is_(STARTED), moment)).alias("first_other_at"),
        F.max(F.when(closing, moment)).alias("last_closure_at"),
        F.max(F.when(~closing, moment)).alias("last_other_at"),
        F.coalesce(F.bool_or("unclear"), F.lit(False)).alias("unclear"),
        F.coalesce(F.bool_or((assigned | active) & agent.isNull()), F.lit(False)).alias("agentless"),
        *survey_counts,
    )


def chat_ends(events: DataFrame) -> DataFrame:
    """First and last event type per chat by (event_timestamp, event_id).

    Comparing structs needs sort-based aggregation, so this stays apart from
    the profile, and only chats that the profile can't decide come here.
    """
    placed = F.struct("event_timestamp", "event_id", "event_type")
    closing = event_kind(F.col("event_type")).isin(*CLOSURE_KINDS)
    return (
        events.groupBy("chat_id")
        .agg(
            F.min(placed).alias("first"),
            F.max(placed).alias("last"),
            F.count_if(closing).alias("closures"),
        )
        .select(
            "chat_id",
            F.col("first.event_type").alias("first_type"),
            F.col("last.event_type").alias("last_type"),
            "closures",
        )
    )
