"""Row and key constraints (K rules) as frames of violations.

Every rule returns ``(rule_id, entity_id)``. As with a CHECK constraint, a
condition that comes out NULL passes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import (
    DIM_AGENT,
    DIM_DATE,
    FACT_CHAT_RESOLUTION,
    SURVEY_INPUTS,
    WITH_AGENT,
    WITHOUT_AGENT,
)


def violations(rule_id: str, df: DataFrame, entity: Column | str) -> DataFrame:
    column = F.col(entity) if isinstance(entity, str) else entity
    return df.select(F.lit(rule_id).alias("rule_id"), column.cast("string").alias("entity_id"))


def repeated(df: DataFrame, key: str, within: Sequence[str] = ()) -> DataFrame:
    """Values of ``key`` on more than one row (of one group ``within``), and NULL
    if any row has it."""
    counts = df.groupBy(key, *within).agg(F.count("*").alias("rows"))
    return counts.where((F.col("rows") > 1) | F.col(key).isNull())


def _listed(values: Sequence[str]) -> str:
    return ", ".join(f"'{value}'" for value in values)


def _present(*columns: str) -> str:
    return " AND ".join(f"{name} IS NOT NULL" for name in columns)


def event_checks(
    without_agent: Sequence[str] = WITHOUT_AGENT,
    with_agent: Sequence[str] = WITH_AGENT,
    either: Sequence[str] = (),
) -> dict[str, str]:
    """What one event row must meet on its own, for a vocabulary of event types.

    Types ``either`` come with and without an agent.
    """
    free, bound = _listed(without_agent), _listed(with_agent)
    return {
        "K2": _present("chat_id", "event_type", "event_timestamp", "ingestion_date"),
        "K3": f"event_type IN ({_listed([*without_agent, *with_agent, *either])})",
        "K4": f"NOT ((event_type IN ({free}) AND agent_id IS NOT NULL)"
        f" OR (event_type IN ({bound}) AND agent_id IS NULL))",
    }


def survey_checks(answers: Sequence[str] = SURVEY_INPUTS) -> dict[str, str]:
    """What one survey row must meet on its own."""
    return {
        "K6": _present("chat_id", "survey_skipped"),
        "K7": f"customer_input IN ({_listed(answers)})",
        "K8": "NOT (survey_skipped AND customer_input IS NOT NULL)",
    }


def breaking(checks: dict[str, str]) -> dict[str, Column]:
    """When a row breaks each of the checks."""
    return {name: ~F.expr(condition) for name, condition in checks.items()}


def event_row_rules() -> dict[str, Column]:
    """Conditions that one event row can break on its own."""
    return breaking(event_checks())


def survey_row_rules() -> dict[str, Column]:
    """Conditions that one survey row can break on its own."""
    return breaking(survey_checks())


def broken_rules(df: DataFrame, rules: dict[str, Column], entity: Column | str) -> DataFrame:
    """One row per broken rule and input row, in a single pass over ``df``.

    Rows that break none, as a rule all, are dropped before any list is made of them.
    """
    column = F.col(entity) if isinstance(entity, str) else entity
    broken = F.array_compact(F.array(*[F.when(c, F.lit(rule)) for rule, c in rules.items()]))
    some = reduce(Column.__or__, rules.values(), F.lit(False))
    return df.where(some).select(
        F.explode(broken).alias("rule_id"), column.cast("string").alias("entity_id")
    )


def event_rows(events: DataFrame, only: str | None = None) -> DataFrame:
    rules = event_row_rules()
    if only:
        return violations(only, events.where(rules[only]), "event_id")
    return broken_rules(events, rules, "event_id")


def survey_rows(surveys: DataFrame, only: str | None = None) -> DataFrame:
    rules = survey_row_rules()
    entity = F.coalesce("chat_id", "survey_id")
    if only:
        return violations(only, surveys.where(rules[only]), entity)
    return broken_rules(surveys, rules, entity)


def event_ids(events: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    return violations("K1", repeated(events, "event_id", within), "event_id")


def survey_ids(surveys: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    return violations("K5", repeated(surveys, "survey_id", within), "survey_id")


def survey_chats(surveys: DataFrame) -> DataFrame:
    """K6: one survey per chat; a missing chat or skip flag counts too."""
    several = repeated(surveys, "chat_id").where(F.col("chat_id").isNotNull())
    return violations("K6", several, "chat_id").unionByName(survey_rows(surveys, "K6"))


def batch_log_fields(batch_log: DataFrame) -> DataFrame:
    """K9: every field of the batch log is set."""
    missing = F.lit(False)
    for name in ("batch_id", "source_date", "source_chat_count", "source_event_count", "loaded_at"):
        missing = missing | F.col(name).isNull()
    return violations("K9", batch_log.where(missing), F.coalesce("batch_id", F.lit("no batch_id")))


def dimension_keys(dimension: DataFrame, *natural_keys: str) -> DataFrame:
    """K10: the natural keys of a dimension are unique and not NULL."""
    found = None
    for key in natural_keys:
        part = violations(
            "K10", repeated(dimension, key), F.concat_ws(" ", F.lit(key), F.col(key).cast("string"))
        )
        found = part if found is None else found.unionByName(part)
    return found


def fact_chats(fact_source: DataFrame) -> DataFrame:
    """K11: one fact row per chat."""
    several = (
        fact_source.groupBy("chat_id")
        .agg(F.sum("source_rows").alias("rows"))
        .where(F.col("rows") > 1)
    )
    return violations("K11", several, "chat_id")


def foreign_key(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """K12: a key that is set must exist in the dimension."""
    orphans = fact.where(F.col(key).isNotNull()).join(dimension.select(key), key, "left_anti")
    return violations("K12", orphans, "chat_id")


def fact_row_rules() -> dict[str, Column]:
    """K13, K14 on fact rows in natural-key form (before surrogate keys)."""
    lookups = {"agent_key", "resolution_type_key", "survey_response_key", "chat_fact_key"}
    missing = F.lit(False)
    for field in FACT_CHAT_RESOLUTION.fields:
        if not field.nullable and field.name not in lookups:
            missing = missing | F.col(field.name).isNull()
    negative = F.lit(False)
    for name in ("queue_wait_seconds", "first_response_seconds", "resolution_seconds"):
        negative = negative | (F.col(name) < 0)
    return {"K13": missing, "K14": negative}


def fact_rows(fact_source: DataFrame, only: str | None = None) -> DataFrame:
    rules = fact_row_rules()
    if only:
        found = violations(only, fact_source.where(rules[only]), "chat_id")
    else:
        found = broken_rules(fact_source, rules, "chat_id")
    return found.distinct()


NATURAL_KEYS = {
    "dim_date": DIM_DATE.fieldNames()[:2],
    "dim_agent": DIM_AGENT.fieldNames()[1:2],
    "dim_resolution_type": ["resolution_code"],
    "dim_survey_response": ["response_code"],
}
