"""The three reporting views and the questions asked of them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numeric import average_minutes, average_minutes_of, minutes, percentage
from ..schemas import UNASSIGNED
from .mart import Mart


def _dated_fact(
    mart: Mart,
    *date_columns: str,
    date_range: tuple[date, date] | None = None,
) -> DataFrame:
    """Fact rows with columns of their start date; a range prunes date partitions."""
    dates = mart.dim_date
    if date_range:
        dates = dates.where(F.col("full_date").between(*date_range))
    return mart.fact_chat_resolution.join(
        dates.select("date_key", F.col("full_date").alias("chat_date"), *date_columns), "date_key"
    )


def _matching(
    df: DataFrame, support_team: Sequence[str] | None, agent_name: Sequence[str] | None
) -> DataFrame:
    if support_team:
        df = df.where(F.col("support_team").isin(*support_team))
    if agent_name:
        df = df.where(F.col("agent_name").isin(*agent_name))
    return df


def chat_detail(
    mart: Mart,
    date_range: tuple[date, date] | None = None,
    support_team: Sequence[str] | None = None,
    agent_name: Sequence[str] | None = None,
) -> DataFrame:
    """One readable row per closed chat, with the dashboard's three filters."""
    agents = mart.dim_agent.select("agent_key", "agent_id", "agent_name", "support_team")
    rows = (
        _dated_fact(
            mart, "day_name", "month_name", "quarter_number", "year_number", date_range=date_range
        )
        .join(agents, "agent_key", "left")
        .join(mart.dim_resolution_type, "resolution_type_key")
        .join(mart.dim_survey_response, "survey_response_key")
    )

    def or_unassigned(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(UNASSIGNED)).alias(name)

    detail = rows.select(
        "chat_id",
        "chat_date",
        "day_name",
        "month_name",
        "quarter_number",
        "year_number",
        or_unassigned("agent_id"),
        or_unassigned("agent_name"),
        or_unassigned("support_team"),
        "resolution_label",
        F.col("response_label").alias("survey_response"),
        "started_at",
        "entered_queue_at",
        "assigned_at",
        "first_agent_response_at",
        "closed_at",
        "queue_wait_seconds",
        minutes(F.col("queue_wait_seconds")).alias("queue_wait_minutes"),
        "first_response_seconds",
        minutes(F.col("first_response_seconds")).alias("first_response_minutes"),
        "resolution_seconds",
        minutes(F.col("resolution_seconds")).alias("resolution_minutes"),
        "agent_response_count",
        "customer_response_count",
        "pushed_due_to_inactivity",
        "first_response_sla_met",
        "resolution_sla_met",
        "satisfied_flag",
    )
    return _matching(detail, support_team, agent_name)


def _first_response_sla() -> Column:
    met = F.col("first_response_sla_met")
    return percentage(F.count_if(met), F.count(met))


def _csat() -> Column:
    satisfied = F.col("satisfied_flag")
    return percentage(F.count_if(satisfied), F.count(satisfied))


def kpi_daily(
    mart: Mart,
    date_range: tuple[date, date] | None = None,
    support_team: Sequence[str] | None = None,
) -> DataFrame:
    """Key figures per start date and support team."""
    teams = mart.dim_agent.select("agent_key", "support_team")
    rows = (
        _dated_fact(mart, date_range=date_range)
        .join(teams, "agent_key", "left")
        .withColumn("support_team", F.coalesce("support_team", F.lit(UNASSIGNED)))
    )
    rows = _matching(rows, support_team, None)
    everyone = F.count("*")
    return rows.groupBy("chat_date", "support_team").agg(
        everyone.alias("resolved_chats"),
        F.count_if(F.col("agent_key").isNull()).alias("unassigned_chats"),
        F.count("first_agent_response_at").alias("responded_chats"),
        average_minutes(F.col("queue_wait_seconds")).alias("avg_queue_wait_minutes"),
        average_minutes(F.col("first_response_seconds")).alias("avg_first_response_minutes"),
        average_minutes(F.col("resolution_seconds")).alias("avg_resolution_minutes"),
        _first_response_sla().alias("first_response_sla_pct"),
        percentage(F.count_if("resolution_sla_met"), everyone).alias("resolution_sla_pct"),
        percentage(F.count("satisfied_flag"), everyone).alias("survey_response_rate_pct"),
        _csat().alias("csat_pct"),
        F.count_if("pushed_due_to_inactivity").alias("inactivity_closures"),
    )


def agent_performance(
    mart: Mart,
    date_range: tuple[date, date] | None = None,
    support_team: Sequence[str] | None = None,
    agent_name: Sequence[str] | None = None,
) -> DataFrame:
    """Key figures per start date and agent; unassigned chats are left out."""
    agents = mart.dim_agent.select("agent_key", "agent_id", "agent_name", "support_team")
    rows = _matching(
        _dated_fact(mart, date_range=date_range).join(agents, "agent_key"),
        support_team,
        agent_name,
    )
    return rows.groupBy("chat_date", "agent_id", "agent_name", "support_team").agg(
        F.count("*").alias("resolved_chats"),
        average_minutes(F.col("queue_wait_seconds")).alias("avg_queue_wait_minutes"),
        average_minutes(F.col("first_response_seconds")).alias("avg_first_response_minutes"),
        average_minutes(F.col("resolution_seconds")).alias("avg_resolution_minutes"),
        _first_response_sla().alias("first_response_sla_pct"),
        _csat().alias("csat_pct"),
    )


# Dashboard questions. Those on averages and rates read the detail rows: the
# daily figures lack the weights needed to average them again.


def resolved_chats(mart: Mart) -> DataFrame:
    return kpi_daily(mart).agg(F.sum("resolved_chats").alias("resolved_chats"))


def average_queue_wait(mart: Mart) -> DataFrame:
    return mart.fact_chat_resolution.agg(
        average_minutes(F.col("queue_wait_seconds")).alias("avg_queue_wait_minutes")
    )


def average_first_response(mart: Mart) -> DataFrame:
    return mart.fact_chat_resolution.agg(
        average_minutes(F.col("first_response_seconds")).alias("avg_first_response_minutes")
    )


def resolution_sla(mart: Mart) -> DataFrame:
    return mart.fact_chat_resolution.agg(
        percentage(F.count_if("resolution_sla_met"), F.count("*")).alias("resolution_sla_pct")
    )


def csat(mart: Mart) -> DataFrame:
    return mart.fact_chat_resolution.agg(_csat().alias("csat_pct"))


def resolved_by_team(mart: Mart) -> DataFrame:
    return kpi_daily(mart).groupBy("support_team").agg(
        F.sum("resolved_chats").alias("resolved_chats")
    )


def daily_volume(mart: Mart) -> DataFrame:
    return kpi_daily(mart).groupBy("chat_date").agg(F.sum("resolved_chats").alias("resolved_chats"))


def closure_reasons(mart: Mart) -> DataFrame:
    # Counted on the key first: the label then joins three rows.
    counts = mart.fact_chat_resolution.groupBy("resolution_type_key").agg(
        F.count("*").alias("chats")
    )
    return counts.join(mart.dim_resolution_type, "resolution_type_key").select(
        "resolution_label", "chats"
    )


def agent_ranking(mart: Mart, date_range: tuple[date, date] | None = None) -> DataFrame:
    """Agents per day by resolved chats; the lower agent id wins a tie."""
    by_volume = W.partitionBy("chat_date").orderBy(F.desc("resolved_chats"), "agent_id")
    return agent_performance(mart, date_range).withColumn("agent_rank", F.rank().over(by_volume))


def first_response_sla(mart: Mart) -> DataFrame:
    """First-response SLA as one tile, per day and per team.

    Flags are counted once per (day, team); the three grains sum those counts.
    """
    teams = mart.dim_agent.select("agent_key", "support_team")
    met = F.col("first_response_sla_met")
    counts = (
        _dated_fact(mart)
        .join(teams, "agent_key", "left")
        .groupBy("chat_date", F.coalesce("support_team", F.lit(UNASSIGNED)).alias("support_team"))
        .agg(F.count_if(met).alias("met"), F.count(met).alias("measured"))
    )
    grains = F.array(
        F.struct(F.lit("tile").alias("grain"), F.lit("all").alias("label")),
        F.struct(F.lit("day").alias("grain"), F.col("chat_date").cast("string").alias("label")),
        F.struct(F.lit("team").alias("grain"), F.col("support_team").alias("label")),
    )
    return (
        counts.select("met", "measured", F.inline(grains))
        .groupBy("grain", "label")
        .agg(percentage(F.sum("met"), F.sum("measured")).alias("first_response_sla_pct"))
    )


def team_averages(mart: Mart) -> DataFrame:
    """Weighted averages per team, from totals and counts per day and team."""
    teams = mart.dim_agent.select("agent_key", "support_team")
    measures = ("queue_wait", "first_response", "resolution")
    totals = (
        _dated_fact(mart)
        .join(teams, "agent_key", "left")
        .groupBy("chat_date", F.coalesce("support_team", F.lit(UNASSIGNED)).alias("support_team"))
        .agg(
            *[F.sum(F.col(f"{m}_seconds").cast("bigint")).alias(f"{m}_total") for m in measures],
            *[F.count(f"{m}_seconds").alias(f"{m}_rows") for m in measures],
        )
    )
    return totals.groupBy("support_team").agg(
        *[
            average_minutes_of(F.sum(f"{m}_total"), F.sum(f"{m}_rows")).alias(f"avg_{m}_minutes")
            for m in measures
        ]
    )


def readiness(mart: Mart) -> DataFrame:
    """Row counts that show whether the reports can be served."""
    facts = mart.fact_chat_resolution.agg(F.count("*").alias("fact_rows"))
    kpis = kpi_daily(mart).agg(F.count("*").alias("kpi_rows"))
    return facts.select("fact_rows", kpis.scalar().alias("kpi_rows"))


def reconciliation(events: DataFrame, mart: Mart) -> DataFrame:
    """Per delivery date: raw events, fact coverage and report rows."""
    day = F.col("source_date")
    raw = events.groupBy(F.col("ingestion_date").alias("source_date")).agg(
        F.count("*").alias("raw_events")
    )
    prefix = F.substring("chat_id", 1, len("chat_YYYYMMDD_"))
    facts = (
        mart.fact_chat_resolution.groupBy(prefix.alias("chat_prefix"))
        .agg(
            F.count("*").alias("fact_rows"),
            F.count("entered_queue_at").alias("queue_entries"),
            F.count("assigned_at").alias("assigned_chats"),
            F.count("queue_wait_seconds").alias("queue_waits"),
            F.min("queue_wait_seconds").alias("shortest_queue_wait_seconds"),
        )
    )
    kpis = kpi_daily(mart).groupBy(F.col("chat_date").alias("source_date")).agg(
        F.count("*").alias("kpi_rows"), F.count("avg_queue_wait_minutes").alias("kpi_queue_rows")
    )
    agents = agent_performance(mart).groupBy(F.col("chat_date").alias("source_date")).agg(
        F.count("*").alias("agent_rows"),
        F.count("avg_queue_wait_minutes").alias("agent_queue_rows"),
    )
    return (
        raw.withColumn(
            "chat_prefix", F.concat(F.lit("chat_"), F.date_format(day, "yyyyMMdd"), F.lit("_"))
        )
        .join(facts, "chat_prefix", "left")
        .join(kpis, "source_date", "left")
        .join(agents, "source_date", "left")
        .drop("chat_prefix")
    )


def chats_like(detail: DataFrame, pattern: str) -> DataFrame:
    """Chats whose id matches a LIKE pattern, where ``_`` stands for any character."""
    return detail.where(F.col("chat_id").like(pattern))


def register_report_views(mart: Mart) -> None:
    """Expose the three reports to ``spark.sql``."""
    chat_detail(mart).createOrReplaceTempView("v_tableau_chat_detail")
    kpi_daily(mart).createOrReplaceTempView("v_chat_kpi_summary_daily")
    agent_performance(mart).createOrReplaceTempView("v_agent_performance_daily")
