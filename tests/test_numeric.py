"""Exact rounding and inclusive service levels."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from chatloom.functions.attributes import calendar_columns
from chatloom.functions.numeric import minutes, percentage, rounded_ratio, seconds_between
from chatloom.operators.fact import fact_source
from chatloom.operators.profile import chat_profile
from chatloom.plans import reports
from chatloom.plans.mart import build_mart

from .helpers import abandoned_chat, at, event_frame, frames, ordinary_chat


@pytest.mark.parametrize(
    "numerator, denominator, expected",
    [(5, 2, 3), (-5, 2, -3), (4, 3, 1), (-4, 3, -1), (0, 7, 0), (1, 0, None), (None, 3, None)],
)
def test_rounded_ratio(spark, numerator, denominator, expected):
    row = spark.createDataFrame([(numerator, denominator)], "n bigint, d bigint")
    assert row.select(rounded_ratio(F.col("n"), F.col("d"))).first()[0] == expected


@pytest.mark.parametrize(
    "seconds, expected", [(63, 1.05), (-63, -1.05), (59, 0.98), (3, 0.05), (None, None)]
)
def test_minutes(spark, seconds, expected):
    row = spark.createDataFrame([(seconds,)], "s int")
    assert row.select(minutes(F.col("s"))).first()[0] == expected


def test_percentage_of_nothing_is_null(spark):
    row = spark.createDataFrame([(0, 0), (1, 3), (1, 8)], "n bigint, d bigint")
    assert [r[0] for r in row.select(percentage(F.col("n"), F.col("d"))).collect()] == [
        None,
        33.33,
        12.5,
    ]


@pytest.mark.parametrize(
    "micros, expected",
    [(300_500_000, 301), (300_499_999, 300), (-500_000, -1), (-499_999, 0), (300_400_000, 300)],
)
def test_seconds_round_half_away_from_zero(spark, micros, expected):
    start = at("08:00:00")
    row = spark.createDataFrame(
        [(start, start + timedelta(microseconds=micros))], "a timestamp_ntz, b timestamp_ntz"
    )
    assert row.select(seconds_between(F.col("a"), F.col("b"))).first()[0] == expected


def _fact(spark, **chat):
    events, survey = ordinary_chat("chat_a", at("08:00:00"), **chat)
    return fact_source(chat_profile(*frames(spark, (events, survey)))).first()


@pytest.mark.parametrize(
    "reply, seconds, met", [(300, 300, True), (300.4, 300, False), (299.6, 300, True)]
)
def test_first_response_level_uses_the_exact_interval(spark, reply, seconds, met):
    fact = _fact(spark, first_reply=reply)
    assert (fact.first_response_seconds, fact.first_response_sla_met) == (seconds, met)


@pytest.mark.parametrize("total, met", [(3600, True), (3600.000001, False)])
def test_resolution_level_includes_its_bound(spark, total, met):
    fact = _fact(spark, total=total)
    assert (fact.resolution_seconds, fact.resolution_sla_met) == (3600, met)


def test_exact_half_of_an_average(spark):
    # Waits of 589 s and 590 s: the mean is 9.825 minutes.
    chats = [
        ordinary_chat(f"chat_{wait}", at("08:00:00"), wait=wait, total=2000) for wait in (589, 590)
    ]
    mart = build_mart(*frames(spark, *chats))
    assert reports.average_queue_wait(mart).first()[0] == 9.83


def test_team_without_measures_keeps_its_counts(spark):
    mart = build_mart(*frames(spark, abandoned_chat("chat_x", at("09:00:00"))))
    kpi = reports.kpi_daily(mart).first()
    assert (kpi.support_team, kpi.resolved_chats, kpi.unassigned_chats) == ("Unassigned", 1, 1)
    assert kpi.avg_queue_wait_minutes is None
    assert kpi.first_response_sla_pct is None
    assert kpi.csat_pct is None
    assert kpi.survey_response_rate_pct == 0.0
    assert reports.agent_performance(mart).count() == 0


def test_sunday_is_day_seven(spark):
    day = spark.sql("SELECT DATE '2026-05-03' AS day").select(*calendar_columns(F.col("day")))
    row = day.first()
    assert (row.day_of_week, row.day_name, row.is_weekend) == (7, "Sunday", True)
    assert (row.date_key, row.month_name, row.quarter_number) == (20260503, "May", 2)


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata", "UTC"])
def test_session_zone_does_not_matter(spark, zone):
    """The chat spans the hour that New York skips on 2024-03-10."""
    start = at("01:30:00").replace(year=2024, month=3, day=10)
    chat = ordinary_chat("chat_dst", start, total=7200, wait=1800, first_reply=400)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        events, answers = frames(spark, chat)
        fact = fact_source(chat_profile(events, answers)).first()
        assert fact.resolution_seconds == 7200
        assert fact.queue_wait_seconds == 1800
        assert fact.date_key == 20240310
        assert fact.resolution_sla_met is False
        assert event_frame(spark, chat[0]).count() == 6
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
