"""Every operator as a query over the tables of one data folder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.attributes import date_key
from ..operators import constraints, dimensions, sequence
from ..operators.fact import (
    chat_rollup,
    fact_source,
    stale_chats,
    synchronise,
    with_dimension_keys,
)
from ..operators.gate import delivery_contract, source_gate
from ..operators.profile import chat_profile
from ..operators.replacement import EVENT_DATE, INGESTION_DATE, Replacement, replace_dates
from ..operators.spread import spread_join
from ..schemas import DIM_DATE
from ..session import materialize, scratch_root
from ..sources.deliveries import read_deliveries, write_deliveries
from ..sources.order_chats import (
    EVENT_COLUMNS,
    SURVEY_COLUMNS,
    ChatLog,
    chat_log,
    defective_chat_log,
    delivered_events,
    delivered_surveys,
    four_hours_late,
    tasks_for_lines,
)
from ..sources.raw_layer import batch_counts
from . import reports, stateful
from .batch import run_totals, select_dates
from .mart import Mart, build_mart, natural_fact

Query = Callable[[SparkSession, str], DataFrame]

RELOADED = date(1997, 2, 1)
YEAR_WITHDRAWN = 1997

_marts: dict[tuple[str, str], Mart] = {}


def mart_of(spark: SparkSession, sf_dir: str) -> Mart:
    """The mart of the derived log, built and written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _marts:
        log = chat_log(spark, sf_dir)
        _marts[key] = build_mart(log.events, log.surveys).materialized("mart")
    return _marts[key]


# Raw layer


def chat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_log(spark, sf_dir).events


def surveys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_log(spark, sf_dir).surveys


def event_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_log(spark, sf_dir).events.orderBy("event_timestamp", "event_id")


def jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly deliveries written as JSON Lines in one job, and read back."""
    log = chat_log(spark, sf_dir)
    month = F.trunc("source_date", "month")
    root = f"{scratch_root(spark)}/jsonl-{hashlib.sha256(sf_dir.encode()).hexdigest()[:12]}"
    write_deliveries(
        delivered_events(log).withColumn("source_date", month),
        delivered_surveys(log).withColumn("source_date", month),
        root,
        compression="gzip",
        tasks=tasks_for_lines(log),
    )
    return read_deliveries(spark, root).events


def _reload(spark: SparkSession, sf_dir: str, replace_by: str) -> Replacement:
    log = four_hours_late(chat_log(spark, sf_dir))
    events, answers = delivered_events(log), delivered_surveys(log)
    delivery = F.col("source_date") == F.lit(RELOADED)
    return replace_dates(
        log.events,
        log.surveys,
        events.where(delivery),
        answers.where(delivery),
        [RELOADED],
        replace_by,
    )


def _events_after_reload(replace_by: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        change = _reload(spark, sf_dir, replace_by)
        return change.kept_events.unionByName(change.new_events.select(*EVENT_COLUMNS))

    return query


def _surveys_after_reload(replace_by: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        change = _reload(spark, sf_dir, replace_by)
        return change.kept_surveys.unionByName(change.new_surveys.select(*SURVEY_COLUMNS))

    return query


def batch_log_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = chat_log(spark, sf_dir)
    runs = log.events.select(F.col("ingestion_date").alias("source_date")).distinct()
    return batch_counts(delivered_events(log), delivered_surveys(log), runs)


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_totals(batch_log_counts(spark, sf_dir))


def date_range_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of every selected date, also of dates without any."""
    dates = select_dates(start=date(1997, 1, 1), end=date(1998, 12, 31))
    selected = spark.createDataFrame([(day,) for day in dates], "source_date date")
    log = chat_log(spark, sf_dir)
    counts = (
        log.events.where(F.col("ingestion_date").between(dates[0], dates[-1]))
        .groupBy(F.col("ingestion_date").alias("source_date"))
        .agg(F.count("*").alias("events"))
    )
    return selected.join(counts, "source_date", "left").na.fill(0, ["events"])


def schema_evolution_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows written before the queue columns existed, with later ones."""
    fact = natural_fact(mart_of(spark, sf_dir))
    is_early = F.year("started_at") < 1998
    early = fact.where(is_early).select("chat_id", "started_at")
    later = fact.where(~is_early).select(
        "chat_id", "started_at", "entered_queue_at", "queue_wait_seconds"
    )
    return early.unionByName(later, allowMissingColumns=True)


# Rules, on the log with defects


def _k(rule: Callable[[DataFrame], DataFrame], surveys_only: bool = False) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        log = defective_chat_log(spark, sf_dir)
        return rule(log.surveys if surveys_only else log.events)

    return query


def _on_dirty_fact(rule: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        log = defective_chat_log(spark, sf_dir)
        return rule(fact_source(chat_profile(log.events, log.surveys)))

    return query


def k09(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch log in which the load times of one day of each month are missing."""
    day = F.col("source_date")
    log = batch_log_counts(spark, sf_dir).select(
        date_key(day).cast("bigint").alias("batch_id"),
        "source_date",
        "source_chat_count",
        "source_event_count",
        F.when(F.day(day) != 13, F.to_timestamp_ltz(day)).alias("loaded_at"),
    )
    return constraints.batch_log_fields(log)


def k10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An agent dimension that has every fourth agent twice."""
    agents = dim_agent(spark, sf_dir)
    twice = agents.unionByName(agents.where(F.col("agent_id") % 4 == 0))
    return constraints.dimension_keys(twice, "agent_id")


def k12(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = mart_of(spark, sf_dir)
    reduced = mart.dim_agent.where(F.col("agent_id") != 1005)
    return constraints.foreign_key(mart.fact_chat_resolution, reduced, "agent_key")


def _sequence_rule(rule_id: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        log = defective_chat_log(spark, sf_dir)
        return sequence.chat_rule(rule_id, log.events, log.surveys)

    return query


def gate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = defective_chat_log(spark, sf_dir)
    return source_gate.summary(log.events, log.surveys)


def gate_first_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_gate.first_failure(gate_summary(spark, sf_dir))


def contract_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = defective_chat_log(spark, sf_dir)
    return delivery_contract.summary(log.events, log.surveys)


def p08_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.agents_over_capacity(chat_profile(chat_log(spark, sf_dir).events))


def p08_per_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capacity within each delivery, as its sender checks it."""
    profile = chat_profile(stateful.within_days(four_hours_late(chat_log(spark, sf_dir))).events)
    return sequence.agents_over_capacity(profile, keys=("ingestion_date", "agent_id"))


# Mart


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dates_of(chat_log(spark, sf_dir).events)


def dim_agent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.agents_of(chat_log(spark, sf_dir).events)


def dim_resolution_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every resolution type with the chats that have it."""
    mart = mart_of(spark, sf_dir)
    used = mart.fact_chat_resolution.groupBy("resolution_type_key").agg(F.count("*").alias("chats"))
    return (
        mart.dim_resolution_type.join(used, "resolution_type_key", "left")
        .na.fill(0, ["chats"])
        .drop("resolution_type_key")
    )


def dim_survey_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every survey response with the chats that have it."""
    mart = mart_of(spark, sf_dir)
    used = mart.fact_chat_resolution.groupBy("survey_response_key").agg(F.count("*").alias("chats"))
    return (
        mart.dim_survey_response.join(used, "survey_response_key", "left")
        .na.fill(0, ["chats"])
        .drop("survey_response_key")
    )


def dim_agent_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New attributes replace old ones; an agent no longer seen stays."""
    rows = [(place, agent, "Old", "Old") for place, agent in enumerate([*range(1001, 1007), 1999])]
    old = spark.createDataFrame(
        rows, "agent_key bigint, agent_id int, agent_name string, support_team string"
    )
    return dimensions.merge_agents(old, dim_agent(spark, sf_dir)).drop("agent_key")


def dim_date_insert_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old dates stay as they were, whether or not they come again."""
    days = [date(1995, 1, 1), date(1900, 1, 1)]
    rows = [
        (int(day.strftime("%Y%m%d")), day, 1, "Old", 1, "Old", 1, day.year, False) for day in days
    ]
    merged = dimensions.merge_dates(spark.createDataFrame(rows, DIM_DATE), dim_date(spark, sf_dir))
    return merged.select("date_key", "full_date", "day_name")


def rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_rollup(chat_profile(chat_log(spark, sf_dir).events))


def fact_chat_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = chat_log(spark, sf_dir)
    return fact_source(chat_profile(log.events, log.surveys)).drop("source_rows")


def _without_a_year(log: ChatLog) -> ChatLog:
    """The log after every delivery of one year has been withdrawn."""
    events = log.numbered_events.where(F.year("ingestion_date") != YEAR_WITHDRAWN)
    left = events.where(F.col("event_type") == "chat_started").select("chat_id")
    return ChatLog(events, log.numbered_surveys.join(left, "chat_id", "left_semi"))


def fact_with_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fact row with its agent, joined as with a dimension too large to broadcast.

    With twelve parts about half of the agents are heavy.
    """
    mart = mart_of(spark, sf_dir)
    rows = mart.fact_chat_resolution.select("chat_id", "agent_key")
    agents = mart.dim_agent.select("agent_key", "agent_id", "agent_name", "support_team")
    return spread_join(rows, agents, "agent_key", parts=12).drop("agent_key")


def _sync(spark: SparkSession, sf_dir: str) -> tuple[Mart, DataFrame]:
    mart = mart_of(spark, sf_dir)
    log = _without_a_year(chat_log(spark, sf_dir))
    source = fact_source(chat_profile(log.events, log.surveys))
    keyed = with_dimension_keys(
        source, mart.dim_agent, mart.dim_resolution_type, mart.dim_survey_response
    )
    return mart, keyed


def fact_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after a refresh in which a year's chats have gone."""
    mart, keyed = _sync(spark, sf_dir)
    return natural_fact(
        Mart(
            mart.dim_date,
            mart.dim_agent,
            mart.dim_resolution_type,
            mart.dim_survey_response,
            synchronise(mart.fact_chat_resolution, keyed),
        )
    )


def fact_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact rows that such a refresh deletes."""
    mart, keyed = _sync(spark, sf_dir)
    return stale_chats(mart.fact_chat_resolution, keyed).select("chat_id")


def fact_keys_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of the remaining chats keep their key over the refresh: all."""
    mart, keyed = _sync(spark, sf_dir)
    after = synchronise(mart.fact_chat_resolution, keyed).select(
        "chat_id", F.col("chat_fact_key").alias("key_after")
    )
    before = mart.fact_chat_resolution.select("chat_id", "chat_fact_key")
    return (
        before.join(after, "chat_id")
        .groupBy((F.col("chat_fact_key") == F.col("key_after")).alias("same_key"))
        .agg(F.count("*").alias("chats"))
    )


# Reports


def _report(function: Callable[..., DataFrame], **arguments) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(mart_of(spark, sf_dir), **arguments)

    return query


def chat_detail_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [f"Agent {number}" for number in range(1001, 1013) if number != 1003]
    return reports.chat_detail(
        mart_of(spark, sf_dir),
        date_range=(date(1996, 1, 1), date(1998, 12, 31)),
        support_team=["Billing Support", "Account Support"],
        agent_name=names,
    )


def chats_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    detail = reports.chat_detail(mart_of(spark, sf_dir))
    return reports.chats_like(detail, "chat_1997%").select("chat_id", "chat_date")


def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.reconciliation(chat_log(spark, sf_dir).events, mart_of(spark, sf_dir))


def kpi_daily_from_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily figures straight from the raw events, without a written mart.

    The fact needs no keys of its own here, so it is not numbered either.
    """
    log = chat_log(spark, sf_dir)
    source = fact_source(chat_profile(log.events, log.surveys))
    agents = materialize(dimensions.merge_agents(None, dimensions.agents_of(log.events)), "agents")
    resolutions = dimensions.resolution_types(spark)
    responses = dimensions.survey_responses(spark)
    dates = dimensions.merge_dates(None, dimensions.dates_of(log.events))
    keyed = with_dimension_keys(source, agents, resolutions, responses)
    return reports.kpi_daily(Mart(dates, agents, resolutions, responses, keyed))


def catalog() -> dict[str, Query]:
    sequence_rules = {
        f"{rule[0].lower()}{int(rule[1:].rstrip('ab')):02d}{rule[1:].lstrip('0123456789')}": rule
        for rule in (
            *("V1", "V2", "V3", "V4", "V5", "V6", "V7", "V8", "V9", "V10a", "V10b"),
            *("P1", "P2", "P3", "P4", "P5", "P6", "P7", "P9"),
        )
    }
    return {
        "chat_events": chat_events,
        "surveys": surveys,
        "event_order": event_order,
        "jsonl_round_trip": jsonl_round_trip,
        "replace_by_event_date": _events_after_reload(EVENT_DATE),
        "replace_by_ingestion_date": _events_after_reload(INGESTION_DATE),
        "replace_surveys_by_event_date": _surveys_after_reload(EVENT_DATE),
        "replace_surveys_by_ingestion_date": _surveys_after_reload(INGESTION_DATE),
        "batch_log_counts": batch_log_counts,
        "run_totals": totals,
        "date_range_select": date_range_select,
        "schema_evolution_union": schema_evolution_union,
        "k01": _k(constraints.event_ids),
        "k02": _k(lambda events: constraints.event_rows(events, "K2")),
        "k03": _k(lambda events: constraints.event_rows(events, "K3")),
        "k04": _k(lambda events: constraints.event_rows(events, "K4")),
        "k05": _k(constraints.survey_ids, surveys_only=True),
        "k06": _k(constraints.survey_chats, surveys_only=True),
        "k07": _k(lambda answers: constraints.survey_rows(answers, "K7"), surveys_only=True),
        "k08": _k(lambda answers: constraints.survey_rows(answers, "K8"), surveys_only=True),
        "k11": _on_dirty_fact(constraints.fact_chats),
        "k12": k12,
        "k13": _on_dirty_fact(lambda fact: constraints.fact_rows(fact, "K13")),
        "k14": _on_dirty_fact(lambda fact: constraints.fact_rows(fact, "K14")),
        **{name: _sequence_rule(rule) for name, rule in sequence_rules.items()},
        "p08_capacity": p08_capacity,
        "gate_summary": gate_summary,
        "gate_first_failure": gate_first_failure,
        "contract_summary": contract_summary,
        "dim_date": dim_date,
        "dim_agent": dim_agent,
        "dim_resolution_type": dim_resolution_type,
        "dim_survey_response": dim_survey_response,
        "dim_agent_upsert": dim_agent_upsert,
        "dim_date_insert_absent": dim_date_insert_absent,
        "chat_rollup": rollup,
        "fact_chat_resolution": fact_chat_resolution,
        "fact_with_agents": fact_with_agents,
        "fact_sync": fact_sync,
        "fact_stale": fact_stale,
        "fact_keys_stable": fact_keys_stable,
        "chat_detail": _report(reports.chat_detail),
        "chat_detail_filtered": chat_detail_filtered,
        "chats_like": chats_like,
        "kpi_daily": _report(reports.kpi_daily),
        "kpi_daily_from_raw": kpi_daily_from_raw,
        "agent_performance": _report(reports.agent_performance),
        "d01_resolved_chats": _report(reports.resolved_chats),
        "d02_average_queue_wait": _report(reports.average_queue_wait),
        "d03_average_first_response": _report(reports.average_first_response),
        "d04_resolution_sla": _report(reports.resolution_sla),
        "d05_csat": _report(reports.csat),
        "d06_resolved_by_team": _report(reports.resolved_by_team),
        "d07_daily_volume": _report(reports.daily_volume),
        "d08_closure_reasons": _report(reports.closure_reasons),
        "d09_agent_ranking": _report(reports.agent_ranking),
        "d10_first_response_sla": _report(reports.first_response_sla),
        "d10_team_averages": _report(reports.team_averages),
        "d11_readiness": _report(reports.readiness),
        "d12_reconciliation": reconciliation,
        "k09": k09,
        "k10": k10,
        "p08_per_delivery": p08_per_delivery,
        **stateful.catalog(),
    }
