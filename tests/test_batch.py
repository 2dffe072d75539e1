"""The batch run: dates, gate, refresh, publish."""

from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chatloom.operators.gate import GateError
from chatloom.operators.replacement import INGESTION_DATE
from chatloom.plans import reports
from chatloom.plans.batch import RunTotals, pending_chats, refresh, refresh_touched, run_batch, select_dates
from chatloom.plans.mart import (
    build_mart,
    current_version,
    load_mart,
    natural_fact,
    register_views,
)
from chatloom.schemas import ASSIGNED, CUSTOMER_REPLY, FACT_CHAT_RESOLUTION
from chatloom.session import scratch_root
from chatloom.sources.deliveries import read_deliveries
from chatloom.sources.raw_layer import RawLayer

from .helpers import DAY, abandoned_chat, at, events_of, frames, ordinary_chat, rows_of
from .test_raw_layer import NEXT, day_chats, delivered, midnight_chat

TODAY = date(2026, 5, 25)


@pytest.mark.parametrize(
    "arguments, first, last, count",
    [
        ({}, TODAY, TODAY, 1),
        ({"day": DAY}, DAY, DAY, 1),
        ({"last_days": 30, "day": DAY}, date(2026, 4, 26), TODAY, 30),
        ({"start": DAY, "end": TODAY, "day": NEXT}, DAY, TODAY, 25),
        ({"start": DAY}, TODAY, TODAY, 1),
        ({"end": DAY, "day": NEXT}, NEXT, NEXT, 1),
        ({"start": NEXT, "end": DAY}, None, None, 0),
    ],
)
def test_select_dates(arguments, first, last, count):
    dates = select_dates(today=TODAY, **arguments)
    assert len(dates) == count
    if dates:
        assert (dates[0], dates[-1]) == (first, last)
        assert dates == sorted(dates)


def run(spark, root, deliveries, **options):
    return run_batch(spark, str(root), *delivered(spark, deliveries), list(deliveries), **options)


def mart_at(spark, root):
    return load_mart(spark, f"{root}/mart")


def fact_rows(mart):
    return rows_of(natural_fact(mart).select(sorted(natural_fact(mart).columns)))


def test_run_from_delivery_to_reports(spark, tmp_path):
    chats = {
        DAY: [*day_chats(DAY, 5), abandoned_chat("chat_x", at("11:00:00"))],
        NEXT: day_chats(NEXT, 3),
    }
    totals = run(spark, tmp_path, chats, backup_root=str(tmp_path / "backup"))
    assert totals == RunTotals(2, 5 * 6 + 3 + 3 * 6, 9)
    mart = mart_at(spark, tmp_path)
    assert mart.fact_chat_resolution.count() == 9
    measured = mart.fact_chat_resolution.agg(
        F.count("entered_queue_at"), F.count("assigned_at"), F.count("queue_wait_seconds"), F.min("queue_wait_seconds")
    ).first()
    assert tuple(measured) == (9, 8, 8, 63)
    assert reports.chat_detail(mart).count() == 9
    assert rows_of(reports.daily_volume(mart)) == [(DAY, 6), (NEXT, 3)]
    assert rows_of(reports.agent_ranking(mart), "chat_date", "agent_rank") == [(DAY, 1), (NEXT, 1)]
    assert read_deliveries(spark, str(tmp_path / "backup")).surveys.count() == 9


def test_backup_of_one_day(spark, tmp_path):
    run(spark, tmp_path, {DAY: day_chats(DAY, 2)}, backup_root=str(tmp_path / "backup"))
    folder = tmp_path / "backup" / "chat_logs" / f"source_date={DAY.isoformat()}"
    assert folder.is_dir()
    assert read_deliveries(spark, str(tmp_path / "backup"), [DAY]).events.count() == 12


def test_a_run_leaves_no_intermediate_tables(spark, tmp_path):
    scratch = Path(scratch_root(spark))
    before = set(scratch.iterdir()) if scratch.exists() else set()
    run(spark, tmp_path, {DAY: day_chats(DAY, 2)})
    run(spark, tmp_path, {NEXT: day_chats(NEXT, 2)})
    assert {path for path in scratch.iterdir()} == before


def test_no_backup_unless_asked(spark, tmp_path):
    run(spark, tmp_path, {DAY: day_chats(DAY, 1)})
    assert sorted(p.name for p in tmp_path.iterdir()) == ["mart", "raw"]


def test_empty_run_still_refreshes(spark, tmp_path):
    run(spark, tmp_path, {DAY: day_chats(DAY, 2)})
    before = current_version(spark, f"{tmp_path}/mart")
    events, surveys = delivered(spark, {DAY: []})
    assert run_batch(spark, str(tmp_path), events, surveys, [], full_refresh=True) == RunTotals(0, 0, 0)
    assert current_version(spark, f"{tmp_path}/mart") == before + 1
    assert mart_at(spark, tmp_path).fact_chat_resolution.count() == 2


@pytest.mark.parametrize("full", [True, False])
def test_failed_gate_leaves_the_mart(spark, tmp_path, full):
    run(spark, tmp_path, {DAY: day_chats(DAY, 2)})
    before = fact_rows(mart_at(spark, tmp_path))
    chat_events, survey = ordinary_chat("chat_bad", at("09:00:00", NEXT))
    late = events_of("chat_bad_2", [(CUSTOMER_REPLY, at("09:00:00", NEXT), None)], NEXT)
    with pytest.raises(GateError, match="chat_bad_2 must contain exactly one chat_started"):
        run(spark, tmp_path, {NEXT: [(chat_events, survey), (late, None)]}, full_refresh=full)
    raw = RawLayer(spark, f"{tmp_path}/raw")
    assert raw.events().where(F.col("ingestion_date") == NEXT).count() == 7
    assert fact_rows(mart_at(spark, tmp_path)) == before
    # A corrected delivery repairs the date, and the refresh then covers both loads.
    run(spark, tmp_path, {NEXT: [(chat_events, survey)]}, full_refresh=full)
    assert mart_at(spark, tmp_path).fact_chat_resolution.count() == 3


def test_refresh_twice_changes_nothing(spark, tmp_path):
    run(spark, tmp_path, {DAY: day_chats(DAY, 4)})
    raw, mart_root = RawLayer(spark, f"{tmp_path}/raw"), f"{tmp_path}/mart"
    before = {
        name: rows_of(getattr(load_mart(spark, mart_root), name))
        for name in ("dim_date", "dim_agent", "fact_chat_resolution")
    }
    refresh(raw, mart_root)
    refresh_touched(raw, mart_root)
    after = load_mart(spark, mart_root)
    for name, rows in before.items():
        assert rows_of(getattr(after, name)) == rows


def test_touched_refresh_equals_a_full_one(spark, tmp_path):
    """Reloads with fewer, moved and midnight chats; keys stay where chats stay."""
    first = {
        DAY: [*day_chats(DAY, 4), midnight_chat("chat_late", DAY)],
        NEXT: [*day_chats(NEXT, 3), abandoned_chat("chat_x", at("11:00:00", NEXT))],
        NEXT + timedelta(days=1): day_chats(NEXT + timedelta(days=1), 2),
    }
    run(spark, tmp_path, first, replace_by=INGESTION_DATE)
    keys = dict(rows_of(mart_at(spark, tmp_path).fact_chat_resolution, "chat_id", "chat_fact_key"))
    new_agent = ordinary_chat("chat_new_agent", at("15:00:00", NEXT), agent=1077)
    second = {
        NEXT: [*day_chats(NEXT, 1), new_agent],
        NEXT + timedelta(days=1): [],
    }
    run(spark, tmp_path, second, replace_by=INGESTION_DATE)
    raw = RawLayer(spark, f"{tmp_path}/raw")
    touched = mart_at(spark, tmp_path)
    rebuilt = build_mart(raw.events(), raw.surveys(), touched)
    assert fact_rows(touched) == fact_rows(rebuilt)
    assert rows_of(touched.dim_agent) == rows_of(rebuilt.dim_agent)
    # Dates are never deleted, not even those without any chat left.
    assert rows_of(touched.dim_date) == rows_of(rebuilt.dim_date)
    assert touched.dim_date.count() == 3
    after = dict(rows_of(touched.fact_chat_resolution, "chat_id", "chat_fact_key"))
    assert len(set(after.values())) == len(after) == 7
    for chat_id in after.keys() & keys.keys():
        assert after[chat_id] == keys[chat_id]
    assert set(after) - set(keys) == {"chat_new_agent"}
    assert after["chat_new_agent"] > max(keys.values())
    assert pending_chats(raw, f"{tmp_path}/mart").count() == 0


def test_chat_that_loses_its_closure_leaves_the_fact(spark, tmp_path):
    """By event date the next day's load cuts a midnight chat off."""
    run(spark, tmp_path, {DAY: [midnight_chat("chat_late", DAY), *day_chats(DAY, 1)]})
    assert mart_at(spark, tmp_path).fact_chat_resolution.count() == 2
    run(spark, tmp_path, {NEXT: day_chats(NEXT, 1)})
    chats = rows_of(mart_at(spark, tmp_path).fact_chat_resolution, "chat_id")
    assert ("chat_late",) not in chats and len(chats) == 2


def test_unassigned_chats_keep_a_null_agent(spark):
    chats = [abandoned_chat("chat_x", at("11:00:00")), ordinary_chat("chat_y", at("12:00:00"))]
    mart = build_mart(*frames(spark, *chats))
    assert rows_of(natural_fact(mart), "chat_id", "agent_id") == [("chat_x", None), ("chat_y", 1001)]
    detail = reports.chat_detail(mart).where("chat_id = 'chat_x'").first()
    assert (detail.agent_id, detail.agent_name, detail.support_team) == ("Unassigned",) * 3


def test_open_chats_reach_the_date_dimension_only(spark, tmp_path):
    events, _ = ordinary_chat("chat_open", at("09:00:00"))
    run(spark, tmp_path, {DAY: [(events[:-1], None)]})
    mart = mart_at(spark, tmp_path)
    assert mart.fact_chat_resolution.count() == 0
    assert rows_of(mart.dim_date, "full_date") == [(DAY,)]
    assert events[2][3] == ASSIGNED and rows_of(mart.dim_agent, "agent_id") == [(1001,)]


def test_views_answer_sql(spark):
    mart = build_mart(*frames(spark, *day_chats(DAY, 3)))
    register_views(mart)
    reports.register_report_views(mart)
    reports.register_report_views(mart)
    got = spark.sql(
        """SELECT d.support_team, SUM(k.resolved_chats) AS chats FROM v_chat_kpi_summary_daily k
        JOIN (SELECT DISTINCT support_team FROM v_tableau_chat_detail) d USING (support_team) GROUP BY ALL"""
    )
    assert rows_of(got) == [("Technical Support", 3)]
    assert spark.sql("SELECT * FROM v_agent_performance_daily").count() == 1
    assert spark.table("fact_chat_resolution").count() == 3


def test_fact_files_from_before_the_queue_columns(spark, tmp_path):
    """Older files lack later columns; they read as NULL."""
    mart = build_mart(*frames(spark, *day_chats(DAY, 2)))
    new_columns = ["entered_queue_at", "queue_wait_seconds"]
    path = str(tmp_path / "fact")
    mart.fact_chat_resolution.drop(*new_columns).write.parquet(path)
    mart.fact_chat_resolution.write.mode("append").parquet(path)
    fact = spark.read.schema(FACT_CHAT_RESOLUTION).parquet(path)
    assert fact.count() == 4
    assert fact.where("queue_wait_seconds IS NULL AND entered_queue_at IS NULL").count() == 2
