"""The quality gate: all rules in one frame, and the first broken one raised."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import constraints, sequence
from .constraints import broken_rules, violations
from .profile import chat_profile

# Rules in the order in which they are reported, with messages.
SOURCE_GATE = {
    "V1": "Chat {} must contain exactly one chat_started event.",
    "V2": "Chat {} does not start with chat_started.",
    "V3": "Chat {} does not have strictly increasing timestamps.",
    "V4": "Chat {} contains an agent reassignment.",
    "V5": "Chat {} contains more than one agent_id.",
    "V6": "Chat {} contains agent activity without its preceding assignment.",
    "V7": "Chat {} system closure is not exactly one hour after inactivity push.",
    "V8": "Chat {} contains more than one closure event.",
    "V9": "Chat {} contains events after closure.",
    "V10a": "Chat {} does not have a one-to-one closed-chat survey relationship.",
    "V10b": "Chat {} does not have a one-to-one closed-chat survey relationship.",
}
DELIVERY_CONTRACT = {
    "K1": "event_id {} is not unique",
    "K3": "event {} has an invalid event type",
    "V2": "{} does not begin with chat_started",
    "V1": "{} has an invalid number of starts",
    "V3": "{} event timestamps are not strictly increasing",
    "P1": "{} must enter the queue exactly once",
    "P2": "{} enters queue before chat_started",
    "V4": "{} has an agent reassignment",
    "P3": "{} is assigned before entering the queue",
    "K4": "event {} breaks the agent_id rule of its type",
    "P4": "{} uses more than one agent_id",
    "P5": "{} has agent activity before assignment",
    "P6": "{} must end with one closure",
    "P7": "{} inactivity closure is not one hour after push",
    "P8": "Agent {} exceeds the open-chat capacity",
    "K5": "survey_id {} is not unique",
    "P9": "{}: every closed chat must have exactly one survey",
    "K8": "{}: skipped surveys cannot contain customer_input",
    "K7": "{}: unexpected customer_input value",
}
LOAD_CONSTRAINTS = {
    "K1": "event_id {} is missing or repeated",
    "K2": "event {} lacks a required field",
    "K3": "event {} has an unknown event type",
    "K4": "event {} breaks the agent_id rule of its type",
    "K5": "survey_id {} is missing or repeated",
    "K6": "chat {} has several surveys, or a survey lacks a required field",
    "K7": "chat {} has an unknown customer_input",
    "K8": "chat {} has a skipped survey with customer_input",
}


LOG_CONSTRAINTS = {"K9": "batch log row {} lacks a field"}
MART_CONSTRAINTS = {
    "K10": "dimension key {} is missing or repeated",
    "K11": "chat {} has several fact rows",
    "K12": "chat {} has a key that its dimension lacks",
    "K13": "chat {} lacks a required field of the fact",
    "K14": "chat {} has a negative duration",
}


class GateError(ValueError):
    """A rule is broken; the message names one entity."""

    def __init__(self, rule_id: str, entity_id: str | None, message: str):
        super().__init__(message)
        self.rule_id = rule_id
        self.entity_id = entity_id


def require(violations: DataFrame, messages: dict[str, str]) -> None:
    """Raise ``GateError`` for the first of the broken rules.

    At most one row per rule reaches the driver.
    """
    found = violations.groupBy("rule_id").agg(F.min("entity_id").alias("entity_id")).collect()
    entities = {row.rule_id: row.entity_id for row in found}
    for rule_id, message in messages.items():
        if rule_id in entities:
            raise GateError(rule_id, entities[rule_id], message.format(entities[rule_id]))


@dataclass(frozen=True)
class Gate:
    """A set of rules in reporting order, over one delivery or the whole raw layer.

    With ``per_delivery`` the rules that span chats hold within each delivery:
    open chats (P8) and event ids (K1) of one ingestion date don't count for
    another, nor do survey ids (K5), if the surveys carry ``source_date``.
    """

    messages: dict[str, str]
    per_delivery: bool = False

    def violations(
        self, events: DataFrame, surveys: DataFrame, profile: DataFrame | None = None
    ) -> DataFrame:
        """All ``(rule_id, entity_id)``; pass ``profile`` when it is already written."""
        wanted = set(self.messages)
        if profile is None:
            # Several rules read it: written once, computed once.
            profile = materialize(chat_profile(events, surveys), "gate-profile")
        parts: list[DataFrame] = []

        def rules(catalog: dict) -> dict:
            return {rule: test for rule, test in catalog.items() if rule in wanted}

        on_profile = rules(sequence.event_profile_rules()) | rules(sequence.survey_profile_rules())
        on_profile |= rules(sequence.ends_rules())
        on_activity = [rule for rule in ("V6", "V7") if rule in wanted]
        active = events
        if on_activity:
            unsettled = sequence.unsettled_activity(events, profile)
            if unsettled is not None:
                active = unsettled
                on_profile |= rules(sequence.activity_rules())
        on_ends = rules(sequence.tied_ends_rules())
        on_events = rules(constraints.event_row_rules())
        on_surveys = rules(constraints.survey_row_rules())
        if on_profile:
            parts.append(broken_rules(profile, on_profile, "chat_id"))
        if on_ends:
            parts.append(broken_rules(sequence.tied_ends(events, profile), on_ends, "chat_id"))
        if on_events:
            parts.append(broken_rules(events, on_events, "event_id"))
        if on_surveys:
            entity = F.coalesce("chat_id", "survey_id")
            parts.append(broken_rules(surveys, on_surveys, entity))
        if "K1" in wanted:
            by = ["ingestion_date"] if self.per_delivery else []
            parts.append(constraints.event_ids(events, by))
        if "K5" in wanted:
            dated = self.per_delivery and "source_date" in surveys.columns
            parts.append(constraints.survey_ids(surveys, ["source_date"] if dated else []))
        if "K6" in wanted:
            several = profile.where((F.col("surveys") > 1) & F.col("chat_id").isNotNull())
            parts.append(violations("K6", several, "chat_id"))
        if "V3" in wanted:
            parts.append(sequence.equal_timestamps(sequence.suspected_ties(events)))
        if on_activity:
            parts.append(sequence.activity_and_pushes(active, *on_activity))
        if "P8" in wanted:
            keys = ("ingestion_date", "agent_id") if self.per_delivery else ("agent_id",)
            over = sequence.agents_over_capacity(profile, keys=keys)
            parts.append(violations("P8", over.select("agent_id").distinct(), "agent_id"))
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
        return found

    def summary(
        self, events: DataFrame, surveys: DataFrame, profile: DataFrame | None = None
    ) -> DataFrame:
        """Per broken rule the number of violations and the smallest entity."""
        return (
            self.violations(events, surveys, profile)
            .groupBy("rule_id")
            .agg(F.count("*").alias("violations"), F.min("entity_id").alias("entity_id"))
        )

    def first_failure(self, summary: DataFrame) -> DataFrame:
        """The summary row of the rule that comes first; empty when all hold."""
        ranks = F.create_map(
            *[F.lit(item) for pair in zip(self.messages, range(len(self.messages))) for item in pair]
        )
        return summary.orderBy(ranks[F.col("rule_id")]).limit(1)

    def check(
        self, events: DataFrame, surveys: DataFrame, profile: DataFrame | None = None
    ) -> None:
        """Raise ``GateError`` for the first broken rule.

        At most one row per rule reaches the driver.
        """
        require(self.violations(events, surveys, profile), self.messages)


source_gate = Gate(SOURCE_GATE)
delivery_contract = Gate(DELIVERY_CONTRACT)
# For several deliveries at once, each checked as its sender did.
deliveries_contract = Gate(DELIVERY_CONTRACT, per_delivery=True)
load_constraints = Gate(LOAD_CONSTRAINTS)
