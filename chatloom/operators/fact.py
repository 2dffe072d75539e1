"""The fact table: one row per closed chat with its survey."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.attributes import date_key, kind_of
from ..functions.numeric import seconds_between
from ..schemas import CLOSURES, FACT_CHAT_RESOLUTION, FIRST_RESPONSE_SLA, RESOLUTION_SLA, conform
from ..session import materialize
from .dimensions import with_fresh_keys
from .profile import SURVEY_STATES, state_column
from .spread import beyond_broadcast, spread_join

ROLLUP_COLUMNS = (
    "chat_id",
    "started_at",
    "entered_queue_at",
    "assigned_at",
    "first_agent_response_at",
    "closed_at",
    "resolution_code",
    "assigned_agent_id",
    "ingestion_date",
    "agent_response_count",
    "customer_response_count",
    "pushed_due_to_inactivity",
)


def _closure_name(kind: Column) -> Column:
    branch = F.when(kind == kind_of(CLOSURES[0]), CLOSURES[0])
    for name in CLOSURES[1:]:
        branch = branch.when(kind == kind_of(name), name)
    return branch


def chat_rollup(profile: DataFrame) -> DataFrame:
    """Milestones and counts of chats with exactly one closure."""
    return (
        profile.where(F.col("closures") == 1)
        .withColumn("resolution_code", _closure_name(F.col("closing_kind")))
        .select(*ROLLUP_COLUMNS)
    )


def fact_source(profile: DataFrame) -> DataFrame:
    """Fact rows with natural keys, from a profile that includes surveys.

    A chat has one row per distinct survey state and ``source_rows`` says how
    many surveys are behind it. After the gate that is always one row and 1;
    before it, repeated surveys show up as a count and not as copied rows.
    """
    closed = profile.where(F.col("closures") == 1)
    states = F.array(
        *[
            F.struct(
                F.lit(code).alias("response_code"),
                F.lit(flag).cast("boolean").alias("satisfied_flag"),
                F.col(state_column(position)).alias("source_rows"),
            )
            for position, (code, flag) in enumerate(SURVEY_STATES, start=1)
        ]
    )
    answered = F.filter(states, lambda state: state["source_rows"] > 0)
    queued, assigned = F.col("entered_queue_at"), F.col("assigned_at")
    replied, started, closed_at = (
        F.col("first_agent_response_at"),
        F.col("started_at"),
        F.col("closed_at"),
    )
    return (
        closed.withColumn("resolution_code", _closure_name(F.col("closing_kind")))
        .select(*ROLLUP_COLUMNS, F.inline(answered))
        .select(
            "chat_id",
            date_key(started.cast("date")).alias("date_key"),
            F.col("assigned_agent_id").alias("agent_id"),
            "resolution_code",
            "response_code",
            "started_at",
            "entered_queue_at",
            "assigned_at",
            "first_agent_response_at",
            "closed_at",
            "ingestion_date",
            seconds_between(queued, assigned).alias("queue_wait_seconds"),
            seconds_between(assigned, replied).alias("first_response_seconds"),
            seconds_between(started, closed_at).alias("resolution_seconds"),
            "agent_response_count",
            "customer_response_count",
            "pushed_due_to_inactivity",
            (replied - assigned <= F.expr(FIRST_RESPONSE_SLA)).alias("first_response_sla_met"),
            (closed_at - started <= F.expr(RESOLUTION_SLA)).alias("resolution_sla_met"),
            "satisfied_flag",
            "source_rows",
        )
    )


def with_dimension_keys(
    source: DataFrame,
    dim_agent: DataFrame,
    dim_resolution_type: DataFrame,
    dim_survey_response: DataFrame,
) -> DataFrame:
    """Replace natural keys by surrogate keys; unassigned chats keep a NULL agent.

    The two seeded dimensions have three and four rows and are broadcast. The
    agent dimension, a written table, grows: Spark broadcasts it by its size, and
    beyond that chats of busy agents and without any stay out of the shuffle.
    """
    agents = dim_agent.select("agent_key", "agent_id")
    coded = source.join(
        F.broadcast(dim_resolution_type.select("resolution_type_key", "resolution_code")), "resolution_code"
    ).join(F.broadcast(dim_survey_response.select("survey_response_key", "response_code")), "response_code")
    if beyond_broadcast(agents):
        keyed = spread_join(materialize(coded, "coded-fact"), agents, "agent_id")
    else:
        keyed = coded.join(agents, "agent_id", "left")
    return keyed.drop("resolution_code", "response_code", "agent_id")


def synchronise(
    old_fact: DataFrame | None, keyed_source: DataFrame, highest_key: int | None = None
) -> DataFrame:
    """The fact after a refresh: stale chats gone, others inserted or updated.

    A chat that was there keeps its ``chat_fact_key``; new keys start above
    ``highest_key``, or above those of ``old_fact`` when it is not given. Rows are clustered by
    date and chat first and numbered last, with no shuffle after that: a task
    that is run again cannot hand out a number another task has used.
    """
    clustering = ["date_key", "chat_id"]
    if old_fact is None:
        fresh = keyed_source.repartitionByRange(*clustering).withColumn(
            "chat_fact_key", F.monotonically_increasing_id() + 1
        )
        return conform(fresh, FACT_CHAT_RESOLUTION)
    highest = (
        F.lit(highest_key)
        if highest_key is not None
        else old_fact.agg(F.coalesce(F.max("chat_fact_key"), F.lit(0)).alias("highest")).scalar()
    )
    matched = keyed_source.join(old_fact.select("chat_id", "chat_fact_key"), "chat_id", "left")
    numbered = with_fresh_keys(matched.repartitionByRange(*clustering), "chat_fact_key", highest)
    return conform(numbered, FACT_CHAT_RESOLUTION)


def stale_chats(old_fact: DataFrame, source: DataFrame) -> DataFrame:
    """Fact rows whose chat is no longer in the source."""
    return old_fact.join(source.select("chat_id"), "chat_id", "left_anti")
