"""Enforced mart constraints, all-or-nothing refreshes, stored rejects, one backup layout."""

import json
import shutil
from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from chatloom.operators.fact import fact_source
from chatloom.operators.gate import GateError, deliveries_contract, delivery_contract, require
from chatloom.operators.gate import MART_CONSTRAINTS
from chatloom.operators.profile import chat_profile
from chatloom.plans.batch import mart_violations, refresh, refresh_touched
from chatloom.plans.mart import (
    build_mart,
    current_version,
    dimensions_path,
    drop_old_versions,
    load_mart,
    published,
)
from chatloom.schemas import AGENT_REPLY, ASSIGNED, CLOSED_BY_AGENT, QUEUED, STARTED
from chatloom.sources.deliveries import read_deliveries
from chatloom.sources.raw_layer import RawLayer

from .helpers import (
    DAY,
    at,
    dying_at,
    event_frame,
    events_of,
    frames,
    ordinary_chat,
    rows_of,
    survey_of,
)
from .test_batch import fact_rows, mart_at, run
from .test_raw_layer import NEXT, day_chats, delivered


def hasty_chat(chat_id, day):
    """Assigned before it entered the queue: passes the gate, not the mart."""
    moments = ["09:00:00", "09:00:10", "09:04:10", "09:05:00", "09:10:00"]
    kinds = [STARTED, ASSIGNED, QUEUED, AGENT_REPLY, CLOSED_BY_AGENT]
    agents = [None, 1001, None, 1001, 1001]
    steps = [(k, at(m, day), a) for k, m, a in zip(kinds, moments, agents)]
    return events_of(chat_id, steps, day), survey_of(chat_id)


def test_negative_duration_is_refused_and_the_mart_stays(spark, tmp_path):
    run(spark, tmp_path, {DAY: day_chats(DAY, 2)})
    before, version = fact_rows(mart_at(spark, tmp_path)), current_version(spark, f"{tmp_path}/mart")
    with pytest.raises(GateError) as refused:
        run(spark, tmp_path, {NEXT: [hasty_chat("chat_hasty", NEXT)]})
    assert (refused.value.rule_id, refused.value.entity_id) == ("K14", "chat_hasty")
    with pytest.raises(GateError, match="negative duration"):
        refresh(RawLayer(spark, f"{tmp_path}/raw"), f"{tmp_path}/mart")
    assert fact_rows(mart_at(spark, tmp_path)) == before
    assert current_version(spark, f"{tmp_path}/mart") == version


def test_broken_keys_are_refused(spark):
    events, surveys = frames(spark, *day_chats(DAY, 3))
    mart = build_mart(events, surveys).materialized("t")
    source = fact_source(chat_profile(events, surveys))

    def broken(rows=source, **changed):
        with pytest.raises(GateError) as refused:
            require(mart_violations(rows, replace(mart, **changed)), MART_CONSTRAINTS)
        return refused.value.rule_id

    require(mart_violations(source, mart), MART_CONSTRAINTS)
    assert broken(dim_agent=mart.dim_agent.union(mart.dim_agent)) == "K10"
    assert broken(dim_date=mart.dim_date.union(mart.dim_date)) == "K10"
    assert broken(source.union(source)) == "K11"
    fact = mart.fact_chat_resolution
    assert broken(fact_chat_resolution=fact.withColumn("agent_key", F.lit(99).cast("bigint"))) == "K12"
    assert broken(fact_chat_resolution=fact.withColumn("date_key", F.lit(19000101))) == "K12"
    assert broken(source.withColumn("closed_at", F.lit(None).cast("timestamp_ntz"))) == "K13"


def test_a_refresh_that_dies_anywhere_changes_nothing_and_can_be_repeated(
    spark, tmp_path, monkeypatch
):
    run(spark, tmp_path, {DAY: day_chats(DAY, 2), NEXT: day_chats(NEXT, 2)})
    raw, root = RawLayer(spark, f"{tmp_path}/raw"), f"{tmp_path}/mart"
    before = fact_rows(load_mart(spark, root))
    keys = dict(rows_of(load_mart(spark, root).fact_chat_resolution, "chat_id", "chat_fact_key"))
    later = ordinary_chat("chat_later", at("15:00:00", NEXT), agent=1077)
    raw.load(*delivered(spark, {NEXT: [*day_chats(NEXT, 1), later]}), [NEXT], "ingestion_date")
    # Four dimensions, the fact, then the commit.
    for step in (1, 5, 6):
        with dying_at(monkeypatch, root, step), pytest.raises(OSError, match="died"):
            refresh_touched(raw, root)
        assert fact_rows(load_mart(spark, root)) == before
        assert load_mart(spark, root).dim_date.count() == 2
    refresh_touched(raw, root)
    mart = load_mart(spark, root)
    after = dict(rows_of(mart.fact_chat_resolution, "chat_id", "chat_fact_key"))
    assert len(after) == 4 and len(set(after.values())) == 4
    assert all(keys[chat] == key for chat, key in after.items() if chat in keys)
    rebuilt = build_mart(raw.events(), raw.surveys(), mart)
    assert fact_rows(mart) == fact_rows(rebuilt)
    drop_old_versions(spark, root, keep=1)
    assert fact_rows(load_mart(spark, root)) == fact_rows(rebuilt)
    # A table that a published version lost is an error, not an empty one.
    state = published(spark, root).state
    shutil.rmtree(f"{dimensions_path(root, state)}/dim_agent")
    with pytest.raises(AnalysisException):
        load_mart(spark, root).dim_agent.count()


def test_backups_add_up_and_are_replaced_by_date(spark, tmp_path):
    backup, third = str(tmp_path / "backup"), NEXT + timedelta(days=1)
    run(spark, tmp_path, {DAY: day_chats(DAY, 2), NEXT: day_chats(NEXT, 2)}, backup_root=backup)
    run(spark, tmp_path, {third: day_chats(third, 1)}, backup_root=backup)
    run(spark, tmp_path, {NEXT: day_chats(NEXT, 1), third: []}, backup_root=backup)
    got = read_deliveries(spark, backup)
    per_day = rows_of(got.surveys.groupBy("source_date").count())
    assert per_day == [(DAY, 2), (NEXT, 1)]
    assert rows_of(got.events.groupBy("source_date").count()) == [(DAY, 12), (NEXT, 6)]
    # A date in both layouts is an error.
    foreign = tmp_path / "backup" / DAY.isoformat()
    foreign.mkdir()
    (foreign / "surveys.jsonl").write_text("")
    with pytest.raises(ValueError, match="both layouts"):
        read_deliveries(spark, backup)


def test_only_one_object_a_line_is_accepted_and_rejects_are_kept(spark, tmp_path):
    day = tmp_path / "in" / DAY.isoformat()
    day.mkdir(parents=True)
    good = json.dumps(
        {
            "agent_id": None, "chat_id": "chat {1}", "event_id": 'e"1}', "event_type": STARTED,
            "event_timestamp": "2026-05-01 08:00:00", "ingestion_date": "2026-05-01",
        }
    )
    bad = [good + good, f"[{good}]", "null", good[:-2], good + " x", "{" + good + "}", "1", '"s"']
    long = good[:-1] + ', "more": "' + 'x\\"' * 50_000 + '"}'
    (day / "chat_logs.jsonl").write_text("\n".join([good, *bad, f"  {good} ", "", long]) + "\n")
    got = read_deliveries(spark, str(tmp_path / "in"))
    assert got.events.count() == 3
    assert sorted(r.line for r in got.rejects.collect()) == sorted(bad)
    raw = RawLayer(spark, f"{tmp_path}/raw")
    raw.store_rejects(got.rejects, [DAY])
    raw.store_rejects(got.rejects, [DAY])
    assert raw.rejects().count() == len(bad)
    raw.store_rejects(got.rejects.limit(0), [DAY])
    assert raw.rejects().count() == 0


def test_deliveries_are_checked_each_on_its_own(spark):
    """Two open chats a day: no day has three, both together do."""
    rows = []
    for day in (DAY, NEXT):
        for name in ("a", "b"):
            chat = f"chat_{day.day}_{name}"
            events, _ = ordinary_chat(chat, at(f"0{8 + ord(name) - 97}:00:00", day))
            rows += events[:3]
    events = event_frame(spark, rows)
    surveys = frames(spark, *day_chats(DAY, 1))[1].limit(0)

    def over(gate):
        return gate.summary(events, surveys).where("rule_id = 'P8'").count()

    assert over(delivery_contract) == 1
    assert over(deliveries_contract) == 0
