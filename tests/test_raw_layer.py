"""Replace-by-date loads, against loading one date after the other."""

import random
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chatloom.operators.gate import GateError
from chatloom.operators.replacement import EVENT_DATE, INGESTION_DATE, replace_dates
from chatloom.schemas import CLOSED_BY_CUSTOMER, CUSTOMER_REPLY, QUEUED, STARTED
from chatloom.sources.deliveries import REJECTS
from chatloom.sources.raw_layer import RawLayer

from .helpers import (
    DAY,
    at,
    dying_at,
    event_frame,
    events_of,
    ordinary_chat,
    rows_of,
    survey_frame,
    survey_of,
)

NEXT = DAY + timedelta(days=1)


def delivered(spark, deliveries):
    """Frames with ``source_date`` from ``{date: [(events, survey), ...]}``."""
    events = [(*row, day) for day, chats in deliveries.items() for rows, _ in chats for row in rows]
    surveys = [(*s, day) for day, chats in deliveries.items() for _, s in chats if s is not None]
    event_schema = "event_id string, chat_id string, agent_id int, event_type string, event_timestamp timestamp_ntz, ingestion_date date, source_date date"
    survey_schema = "survey_id string, chat_id string, survey_skipped boolean, customer_input string, source_date date"
    return spark.createDataFrame(events, event_schema), spark.createDataFrame(surveys, survey_schema)


def day_chats(day: date, count: int, tag: str = ""):
    start = datetime.combine(day, datetime.min.time()) + timedelta(hours=9)
    return [
        ordinary_chat(f"chat_{day:%Y%m%d}_{tag}{i}", start + timedelta(minutes=30 * i))
        for i in range(count)
    ]


def midnight_chat(name: str, day: date):
    start = datetime.combine(day, datetime.min.time()) + timedelta(hours=23, minutes=50)
    return ordinary_chat(name, start, total=1800, ingestion_date=day)


def sequential(old_events, old_surveys, deliveries, replace_by):
    """Load date after date: delete the date's surveys and events, then insert."""
    place = 4 if replace_by == EVENT_DATE else 5
    events, surveys = list(old_events), list(old_surveys)
    for day, chats in deliveries.items():

        def falls_on(row, day=day):
            value = row[place]
            return (value.date() if isinstance(value, datetime) else value) == day

        chats_of_day = {row[1] for row in events if falls_on(row)}
        surveys = [row for row in surveys if row[1] not in chats_of_day]
        events = [row for row in events if not falls_on(row)]
        events += [row for rows, _ in chats for row in rows]
        surveys += [s for _, s in chats if s is not None]
    return sorted(events, key=repr), sorted(surveys, key=repr)


@pytest.mark.parametrize("replace_by", [EVENT_DATE, INGESTION_DATE])
@pytest.mark.parametrize("seed", range(4))
def test_one_pass_equals_loading_in_order(spark, replace_by, seed):
    """Random events over a few dates, delivered in a random order of dates."""
    chance = random.Random(seed)
    dates = [DAY + timedelta(days=i) for i in range(5)]

    def chat(name, delivery):
        moments = sorted(
            datetime.combine(chance.choice(dates), datetime.min.time())
            + timedelta(seconds=chance.randrange(86400))
            for _ in range(chance.randint(1, 4))
        )
        rows = events_of(name, [(CUSTOMER_REPLY, moment, None) for moment in moments], delivery)
        return rows, survey_of(name) if chance.random() < 0.8 else None

    old = [chat(f"old_{i}", chance.choice(dates)) for i in range(30)]
    run = chance.sample(dates, 3)
    deliveries = {day: [chat(f"new_{day}_{i}", day) for i in range(12)] for day in run}
    # Chats that are delivered again, under the same id.
    deliveries[run[0]] += [chat(f"old_{i}", run[0]) for i in range(5)]
    old_events = [row for rows, _ in old for row in rows]
    old_surveys = [s for _, s in old if s is not None]
    change = replace_dates(
        event_frame(spark, old_events),
        survey_frame(spark, old_surveys),
        *delivered(spark, deliveries),
        run,
        replace_by,
    )
    got = (
        rows_of(change.kept_events.unionByName(change.new_events.drop("source_date"))),
        rows_of(change.kept_surveys.unionByName(change.new_surveys.drop("source_date"))),
    )
    assert got == sequential(old_events, old_surveys, deliveries, replace_by)


def _contents(raw):
    return rows_of(raw.events()), rows_of(raw.surveys())


def test_load_and_reload(spark, tmp_path):
    raw = RawLayer(spark, str(tmp_path))
    first = {DAY: day_chats(DAY, 4), NEXT: day_chats(NEXT, 3)}
    log = raw.load(*delivered(spark, first), [DAY, NEXT])
    assert rows_of(log, "batch_id", "source_date", "source_chat_count", "source_event_count") == [
        (1, DAY, 4, 24),
        (2, NEXT, 3, 18),
    ]
    before = _contents(raw)
    assert (len(before[0]), len(before[1])) == (42, 7)

    raw.load(*delivered(spark, first), [DAY, NEXT])
    assert _contents(raw) == before

    fewer = {DAY: day_chats(DAY, 2)}
    raw.load(*delivered(spark, fewer), [DAY])
    assert len(raw.events().where(F.col("ingestion_date") == DAY).collect()) == 12
    assert raw.surveys().count() == 5
    assert rows_of(raw.batch_log(), "batch_id") == [(i,) for i in range(1, 6)]


def test_empty_delivery_deletes_the_date(spark, tmp_path):
    raw = RawLayer(spark, str(tmp_path))
    raw.load(*delivered(spark, {DAY: day_chats(DAY, 3), NEXT: day_chats(NEXT, 2)}), [DAY, NEXT])
    nothing = delivered(spark, {DAY: []})
    raw.load(*nothing, [DAY])
    assert {row.ingestion_date for row in raw.events().collect()} == {NEXT}
    assert raw.surveys().count() == 2
    last = raw.batch_log().orderBy(F.desc("batch_id")).first()
    assert (last.source_date, last.source_chat_count, last.source_event_count) == (DAY, 0, 0)


def test_next_day_takes_the_tail_of_a_midnight_chat(spark, tmp_path):
    """By event date, loading D+1 deletes D's events after midnight and the survey."""
    raw = RawLayer(spark, str(tmp_path))
    chat = midnight_chat("chat_late", DAY)
    raw.load(*delivered(spark, {DAY: [chat, *day_chats(DAY, 1)]}), [DAY])
    assert raw.events().where("chat_id = 'chat_late'").count() == 6
    raw.load(*delivered(spark, {NEXT: day_chats(NEXT, 1)}), [NEXT])
    left = raw.events().where("chat_id = 'chat_late'")
    assert {row.event_timestamp.date() for row in left.collect()} == {DAY}
    assert raw.surveys().where("chat_id = 'chat_late'").count() == 0


def test_reloading_a_date_collides_with_its_own_tail(spark, tmp_path):
    raw = RawLayer(spark, str(tmp_path))
    delivery = {DAY: [midnight_chat("chat_late", DAY)]}
    raw.load(*delivered(spark, delivery), [DAY])
    before = _contents(raw)
    with pytest.raises(GateError) as raised:
        raw.load(*delivered(spark, delivery), [DAY])
    assert raised.value.rule_id == "K1"
    assert _contents(raw) == before
    assert raw.batch_log().count() == 1


def test_replacing_by_ingestion_date_is_safe_at_midnight(spark, tmp_path):
    raw = RawLayer(spark, str(tmp_path))
    delivery = {DAY: [midnight_chat("chat_late", DAY)]}
    raw.load(*delivered(spark, delivery), [DAY], INGESTION_DATE)
    before = _contents(raw)
    raw.load(*delivered(spark, delivery), [DAY], INGESTION_DATE)
    raw.load(*delivered(spark, {NEXT: day_chats(NEXT, 1)}), [NEXT], INGESTION_DATE)
    assert rows_of(raw.events().where("chat_id = 'chat_late'")) == before[0]


@pytest.mark.parametrize("replace_by", [EVENT_DATE, INGESTION_DATE])
def test_a_load_that_died_changes_nothing_and_can_be_repeated(
    spark, tmp_path, monkeypatch, replace_by
):
    """Fewer and new chats replace a day that has a chat over midnight; the load dies
    at each of its writes in turn: events, surveys, rejects, chats, log, commit."""
    late = midnight_chat("chat_late", DAY - timedelta(days=1))
    first = delivered(spark, {DAY: [late, *day_chats(DAY, 3)], NEXT: day_chats(NEXT, 1)})
    again = midnight_chat("chat_again", DAY)
    second = delivered(spark, {DAY: [*day_chats(DAY, 1), *day_chats(DAY, 2, "new"), again]})
    rejects = spark.createDataFrame([(DAY, "chat_logs", "{")], REJECTS)
    whole, died = RawLayer(spark, f"{tmp_path}/whole"), RawLayer(spark, f"{tmp_path}/died")
    for raw in (whole, died):
        raw.load(*first, [DAY, NEXT], replace_by)
    whole.load(*second, [DAY], replace_by, rejects)
    before, log = _contents(died), rows_of(died.batch_log())
    for step in range(1, 7):
        with dying_at(monkeypatch, died.root, step), pytest.raises(OSError, match="died"):
            died.load(*second, [DAY], replace_by, rejects)
        assert _contents(died) == before and rows_of(died.batch_log()) == log
        assert died.rejects().count() == 0
    died.load(*second, [DAY], replace_by, rejects)
    assert _contents(died) == _contents(whole)
    assert rows_of(died.batch_log(), "batch_id") == [(1,), (2,), (3,)]
    assert died.rejects().count() == 1
    died.drop_unused(keep=1)
    assert _contents(died) == _contents(whole)
    assert len(list((tmp_path / "died" / "chat_events").iterdir())) == 2


@pytest.mark.parametrize(
    "broken, rule",
    [
        ([("e1", "c", None, "other", at("09:00:00"), DAY)], "K3"),
        ([("e1", "c", 1001, STARTED, at("09:00:00"), DAY)], "K4"),
        ([("e1", "c", None, STARTED, at("09:00:00"), None)], "K2"),
        ([("e1", "c", None, STARTED, at("09:00:00"), DAY), ("e1", "c", None, QUEUED, at("09:00:01"), DAY)], "K1"),
    ],
)
def test_broken_rows_are_not_loaded(spark, tmp_path, broken, rule):
    raw = RawLayer(spark, str(tmp_path))
    with pytest.raises(GateError) as raised:
        raw.load(*delivered(spark, {DAY: [(broken, None)]}), [DAY])
    assert raised.value.rule_id == rule
    assert raw.events().count() == 0


def test_second_survey_of_a_chat_is_refused(spark, tmp_path):
    raw = RawLayer(spark, str(tmp_path))
    raw.load(*delivered(spark, {DAY: day_chats(DAY, 1)}), [DAY])
    chat_id = f"chat_{DAY:%Y%m%d}_0"
    again = events_of("chat_new", [(STARTED, at("09:00:00", NEXT), None), (CLOSED_BY_CUSTOMER, at("09:01:00", NEXT), None)], NEXT)
    other = ("survey_other", chat_id, False, None)
    with pytest.raises(GateError) as raised:
        raw.load(*delivered(spark, {NEXT: [(again, other)]}), [NEXT])
    assert raised.value.rule_id == "K6"


@pytest.mark.parametrize("replace_by", [EVENT_DATE, INGESTION_DATE])
def test_replaced_dates_prune_partitions(spark, tmp_path, replace_by):
    raw = RawLayer(spark, str(tmp_path))
    chats = delivered(spark, {DAY: day_chats(DAY, 2), NEXT: day_chats(NEXT, 2)})
    raw.load(*chats, [DAY, NEXT])
    change = replace_dates(raw.stored_events(), raw.stored_surveys(), *chats, [DAY], replace_by)
    plan = change.deleted_events._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    assert replace_by in filters and "2026-05-01" in filters
    assert change.deleted_events.count() == 12
