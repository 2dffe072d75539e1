"""Rules over the events of a chat (V rules) and the delivery contract (P rules).

Every rule returns ``(rule_id, entity_id)`` with one row per chat, or per
agent for the capacity rule. No rule sorts the events of a chat: each is
rewritten as a grouped aggregate that combines map-side, or groups on a key
finer than the chat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import (
    AGENT_ACTIVITY,
    ASSIGNED,
    CLOSED_BY_SYSTEM,
    CLOSURES,
    INACTIVITY_DELAY,
    MAX_OPEN_CHATS_PER_AGENT,
    PUSHED,
    STARTED,
)
from ..session import materialize
from .constraints import violations
from .lookup import maybe_repeated
from .profile import chat_ends, chat_profile
from .running import running_totals
from .spread import beyond_broadcast


def event_profile_rules() -> dict[str, Column]:
    """Rules that the counts and milestones of a chat decide."""
    c = F.col
    present = c("events") > 0
    # An event after the first closure exists exactly when the last event is later.
    after_closure = c("last_event_at") > c("closed_at")
    another_agent = c("lowest_agent_id") != c("highest_agent_id")
    first_assignment_names_agent = c("agent_known_at") == c("assigned_at")
    unassigned_activity = c("first_activity_at").isNotNull() & (
        c("assigned_at").isNull() | (c("first_activity_at") <= c("assigned_at"))
    )
    delay = F.expr(INACTIVITY_DELAY)
    off_time = (
        c("last_push_at").isNull()
        | (c("first_system_closure_at") - c("last_push_at") != delay)
        | (c("last_system_closure_at") - c("last_push_at") != delay)
    )
    return {
        "V1": present & (c("starts") != 1),
        "V4": c("assignments") > 1,
        "V5": another_agent,
        "V8": c("closures") > 1,
        "V9": after_closure,
        "P1": present & (c("queue_entries") != 1),
        "P2": c("entered_queue_at") <= c("first_event_at"),
        "P3": c("assigned_at") <= c("entered_queue_at"),
        "P4": first_assignment_names_agent & another_agent,
        "P5": unassigned_activity,
        "P7": (c("system_closures") > 0) & off_time,
    }


def survey_profile_rules() -> dict[str, Column]:
    """Rules on closures and surveys together."""
    closures, surveys = F.col("closures"), F.col("surveys")
    without_survey = (closures > 0) & (surveys == 0)
    without_closure = (closures == 0) & (surveys > 0)
    return {
        "V10a": without_survey,
        "V10b": without_closure,
        "P9": without_survey | without_closure | (surveys > 1),
    }


def _tied_ends() -> Column:
    """Chats whose first or last event is one of several at the same moment, or that
    have an event without a type or time: their ends depend on the event ids."""
    at_start = F.col("started_at") == F.col("first_other_at")
    at_end = F.col("last_closure_at") == F.col("last_other_at")
    return F.coalesce(F.col("unclear") | at_start | at_end, F.col("unclear"))


def ends_rules() -> dict[str, Column]:
    """Rules on the first and the last event, where the moments alone decide."""
    c = F.col
    late_start = (c("events") > 0) & (
        c("started_at").isNull() | (c("first_other_at") < c("started_at"))
    )
    open_end = (c("closures") != 1) | (c("last_other_at") > c("last_closure_at"))
    decided = ~_tied_ends()
    return {"V2": decided & late_start, "P6": decided & (c("events") > 0) & open_end}


def tied_ends(events: DataFrame, profile: DataFrame) -> DataFrame:
    """First and last event types of the chats that their moments don't decide.

    Such chats are rare: without any the events are not read, as the condition on
    them is known before.
    """
    chats = profile.where(_tied_ends()).select(F.col("chat_id").alias("tied"))
    some = events.where(chats.exists())
    return chat_ends(some.join(chats, F.col("chat_id").eqNullSafe(F.col("tied")), "left_semi"))


def tied_ends_rules() -> dict[str, Column]:
    """The same rules on first and last event types."""
    return {
        "V2": F.col("first_type") != STARTED,
        "P6": (F.col("closures") != 1) | ~F.col("last_type").isin(*CLOSURES),
    }


def _settled_activity() -> Column:
    """Chats whose counts and milestones decide V6 and V7: all that an agent did was done by
    one and the same, and there is no system closure, or one with the last push an hour
    before it."""
    c = F.col
    one_agent = ~c("agentless") & c("lowest_agent_id").eqNullSafe(c("highest_agent_id"))
    on_time = (c("system_closures") == 1) & (
        c("first_system_closure_at") - c("last_push_at") == F.expr(INACTIVITY_DELAY)
    )
    return one_agent & ((c("system_closures") == 0) | F.coalesce(on_time, F.lit(False)))


def activity_rules() -> dict[str, Column]:
    """V6 where the milestones of a chat decide it; V7 holds there."""
    active, assigned = F.col("first_activity_at"), F.col("assigned_at")
    unassigned = active.isNotNull() & (assigned.isNull() | (assigned >= active))
    return {"V6": _settled_activity() & unassigned}


def unsettled_activity(events: DataFrame, profile: DataFrame) -> DataFrame | None:
    """The events of the chats whose milestones don't decide V6 or V7; None if such chats
    are too many to be broadcast. ``profile`` should be a written table."""
    chats = profile.where(~_settled_activity()).select(F.col("chat_id").alias("unsettled"))
    if chats.isEmpty():
        return events.limit(0)
    chats = materialize(chats, "unsettled-chats")
    if beyond_broadcast(chats):
        return None
    same = F.col("chat_id").eqNullSafe(F.col("unsettled"))
    return events.join(F.broadcast(chats), same, "left_semi")


def equal_timestamps(events: DataFrame) -> DataFrame:
    """V3: timestamps of a chat strictly increase.

    Sorted timestamps fail to increase exactly where two are equal, so it is
    enough to group on (chat, timestamp), which also spreads a large chat.
    """
    shared = (
        events.groupBy("chat_id", "event_timestamp")
        .agg(F.count("*").alias("rows"))
        .where((F.col("rows") > 1) & F.col("event_timestamp").isNotNull())
    )
    return violations("V3", shared.select("chat_id").distinct(), "chat_id")


def activity_and_pushes(events: DataFrame, *rules: str) -> DataFrame:
    """V6: agent activity follows an assignment of the same agent. V7: a system
    closure has a push exactly one hour before it.

    The earliest activity of a (chat, agent) is the hardest to satisfy, so two
    minima replace the NOT EXISTS join; NULL agents form a group that no
    assignment can satisfy. For V7 closures and pushes meet on the moment of the
    push. Both are one pass over the events and one grouping; only the rules
    asked for contribute rows.
    """
    event_type, moment = F.col("event_type"), F.col("event_timestamp")
    closing = event_type == CLOSED_BY_SYSTEM
    nothing = F.lit(None).cast("timestamp_ntz")

    def part(rule: str, agent: Column, pushed_at: Column, assigned: Column, active: Column):
        return F.struct(
            F.lit(rule).alias("rule_id"),
            agent.alias("agent_id"),
            pushed_at.alias("pushed_at"),
            assigned.alias("assigned_at"),
            active.alias("first_activity_at"),
        )

    assigning = event_type == ASSIGNED
    of_agent = part(
        "V6",
        F.col("agent_id"),
        nothing,
        F.when(assigning, moment),
        F.when(~assigning, moment),
    )
    expected_push = F.when(closing, moment - F.expr(INACTIVITY_DELAY)).otherwise(moment)
    of_push = part("V7", F.lit(None).cast("int"), expected_push, nothing, nothing)
    wanted = {
        "V6": F.when(event_type.isin(ASSIGNED, *AGENT_ACTIVITY), of_agent),
        "V7": F.when(event_type.isin(CLOSED_BY_SYSTEM, PUSHED), of_push),
    }
    types = {"V6": [ASSIGNED, *AGENT_ACTIVITY], "V7": [CLOSED_BY_SYSTEM, PUSHED]}
    read = sorted({name for rule in rules for name in types[rule]})
    rows = events.where(event_type.isin(*read)).select(
        "chat_id",
        closing.alias("closing"),
        F.inline(F.array_compact(F.array(*[wanted[rule] for rule in rules]))),
    )
    grouped = rows.groupBy("chat_id", "rule_id", "agent_id", "pushed_at").agg(
        F.min("assigned_at").alias("assigned_at"),
        F.min("first_activity_at").alias("first_activity_at"),
        F.count_if("closing").alias("closures"),
        F.count_if(~F.col("closing")).alias("pushes"),
    )
    unassigned = F.col("first_activity_at").isNotNull() & (
        F.col("agent_id").isNull()
        | F.col("assigned_at").isNull()
        | (F.col("assigned_at") >= F.col("first_activity_at"))
    )
    unpushed = (F.col("closures") > 0) & (F.col("pushes") == 0)
    broken = grouped.where(F.when(F.col("rule_id") == "V6", unassigned).otherwise(unpushed))
    return broken.select("rule_id", F.col("chat_id").alias("entity_id")).distinct()


def suspected_ties(events: DataFrame) -> DataFrame:
    """The events that V3 has to compare: those that may share chat and moment with another."""
    return maybe_repeated(
        events.select("chat_id", "event_timestamp").where("event_timestamp IS NOT NULL"),
        "chat_id",
        "event_timestamp",
    )


def agent_load(profile: DataFrame, keys: tuple[str, ...] = ("agent_id",)) -> DataFrame:
    """Open chats per agent after each moment at which the number changes.

    With the delivery date among ``keys`` each delivery counts on its own.

    A chat counts from its assignment to its closure, an open chat for good.
    Changes at one moment are netted first: closings count before assignments,
    so within a moment the highest value is the last one.
    """
    assigned = profile.where(F.col("assigned_agent_id").isNotNull())
    changes = assigned.select(
        "ingestion_date",
        F.col("assigned_agent_id").alias("agent_id"),
        F.inline(
            F.array(
                F.struct(F.col("assigned_at").alias("moment"), F.lit(1).alias("change")),
                F.struct(F.col("closed_at").alias("moment"), F.lit(-1).alias("change")),
            )
        ),
    ).where(F.col("moment").isNotNull())
    net = changes.groupBy(*keys, "moment").agg(F.sum("change").alias("change"))
    return running_totals(
        net, list(keys), ["moment"], {"change": F.col("change")}, "agent-load"
    ).select(*keys, "moment", F.col("change_running").alias("open_chats"))


def agents_over_capacity(
    profile: DataFrame,
    capacity: int = MAX_OPEN_CHATS_PER_AGENT,
    keys: tuple[str, ...] = ("agent_id",),
) -> DataFrame:
    """P8: agents with too many open chats, when first, and the peak."""
    return (
        agent_load(profile, keys)
        .groupBy(*keys)
        .agg(
            F.min(F.when(F.col("open_chats") > capacity, F.col("moment"))).alias("first_breach_at"),
            F.max("open_chats").alias("peak_open_chats"),
        )
        .where(F.col("first_breach_at").isNotNull())
    )


def chat_rule(rule_id: str, events: DataFrame, surveys: DataFrame) -> DataFrame:
    """One V or P rule on its own; Spark prunes the aggregates it does not use."""
    if rule_id == "V3":
        return equal_timestamps(events)
    if rule_id in ("V6", "V7"):
        return activity_and_pushes(events, rule_id)
    if rule_id == "P8":
        return violations("P8", agents_over_capacity(chat_profile(events)), "agent_id")
    if rule_id in (ends := ends_rules()):
        profile = chat_profile(events)
        found = violations(rule_id, profile.where(ends[rule_id]), "chat_id")
        tied = tied_ends(events, profile).where(tied_ends_rules()[rule_id])
        return found.unionByName(violations(rule_id, tied, "chat_id"))
    if rule_id in (own := event_profile_rules()):
        return violations(rule_id, chat_profile(events).where(own[rule_id]), "chat_id")
    joint = survey_profile_rules()[rule_id]
    return violations(rule_id, chat_profile(events, surveys).where(joint), "chat_id")
