"""Loads and refreshes that meet, tables that are lost, and what a daily run reads."""

import re
import shutil
from datetime import date, timedelta

import pytest
from pyspark.errors import AnalysisException

from chatloom.operators.replacement import INGESTION_DATE
from chatloom.plans import batch
from chatloom.plans.batch import pending_chats, refresh, refresh_touched
from chatloom.plans.mart import build_mart, current_version, load_mart, natural_fact, published
from chatloom.sources import raw_layer
from chatloom.sources.commits import (
    CommitConflict,
    Commits,
    MissingTable,
    spans_of,
    touches,
)
from chatloom.sources.folders import names_in, write_once
from chatloom.sources.raw_layer import RawLayer

from .helpers import DAY, at, ordinary_chat, rows_of
from .test_batch import fact_rows, mart_at, run
from .test_raw_layer import NEXT, day_chats, delivered

FAR = date(2027, 1, 5)


def load(raw, deliveries):
    return raw.load(*delivered(raw.spark, deliveries), list(deliveries), INGESTION_DATE)


def equals_rebuilt(raw, mart_root):
    mart = load_mart(raw.spark, mart_root)
    return fact_rows(mart) == fact_rows(build_mart(raw.events(), raw.surveys(), mart))


@pytest.fixture
def started(spark, tmp_path):
    run(spark, tmp_path, {DAY: day_chats(DAY, 2), NEXT: day_chats(NEXT, 2)}, replace_by=INGESTION_DATE)
    return RawLayer(spark, f"{tmp_path}/raw"), f"{tmp_path}/mart"


def test_a_file_is_created_once(spark, tmp_path):
    path = f"{tmp_path}/folder/one.json"
    assert write_once(spark, path, "first")
    assert not write_once(spark, path, "second")
    assert (tmp_path / "folder" / "one.json").read_text() == "first"
    assert [n for n in names_in(spark, f"{tmp_path}/folder") if not n.endswith(".crc")] == ["one.json"]


def interleaved(monkeypatch, step, other):
    """Call ``other`` once, before the ``step``-th call among the parts of a refresh."""
    calls, done = [], []
    for name in ("matching", "chat_profile", "synchronise", "mart_violations", "publish_mart"):
        part = getattr(batch, name)

        def wrapped(*args, part=part, **options):
            calls.append(part)
            if len(calls) == step and not done:
                done.append(step)
                other()
            return part(*args, **options)

        monkeypatch.setattr(batch, name, wrapped)
    return done


@pytest.mark.parametrize(
    "way, step", [(refresh_touched, 1), (refresh_touched, 3), (refresh_touched, 7), (refresh, 3)]
)
def test_a_load_during_a_refresh_is_not_lost(spark, started, monkeypatch, step, way):
    raw, root = started
    load(raw, {NEXT: [*day_chats(NEXT, 1), ordinary_chat("chat_one", at("15:00:00", NEXT))]})
    late = {DAY: [*day_chats(DAY, 1), ordinary_chat("chat_meanwhile", at("15:00:00"))]}
    with monkeypatch.context() as patch:
        done = interleaved(patch, step, lambda: load(raw, late))
        way(raw, root)
    assert done
    chats = {c for (c,) in rows_of(load_mart(spark, root).fact_chat_resolution, "chat_id")}
    assert "chat_one" in chats and "chat_meanwhile" not in chats
    assert ("chat_meanwhile",) in rows_of(pending_chats(raw, root))
    refresh_touched(raw, root)
    assert equals_rebuilt(raw, root)
    assert pending_chats(raw, root).count() == 0


@pytest.mark.parametrize("step", [1, 7])
def test_two_refreshes_make_two_versions(spark, started, monkeypatch, step):
    """The second starts and ends inside the first; the first begins again."""
    raw, root = started
    version = current_version(spark, root)
    load(raw, {NEXT: [*day_chats(NEXT, 1), ordinary_chat("chat_one", at("15:00:00", NEXT))]})
    with monkeypatch.context() as patch:
        done = interleaved(patch, step, lambda: refresh_touched(raw, root))
        refresh_touched(raw, root)
    assert done
    assert current_version(spark, root) == version + 2
    assert equals_rebuilt(raw, root)
    keys = rows_of(load_mart(spark, root).fact_chat_resolution, "chat_fact_key")
    assert len(set(keys)) == len(keys) == 4


def test_a_refresh_that_is_always_overtaken_raises(started, monkeypatch):
    raw, root = started
    load(raw, {NEXT: day_chats(NEXT, 1)})

    def overtaken(self, number, state):
        raise CommitConflict("another one")

    with monkeypatch.context() as patch:
        patch.setattr(Commits, "add", overtaken)
        with pytest.raises(CommitConflict):
            refresh_touched(raw, root)
    refresh_touched(raw, root)
    assert equals_rebuilt(raw, root)


def test_of_two_loads_at_once_one_raises(spark, started, monkeypatch):
    raw, _ = started
    before = rows_of(raw.events())
    third = NEXT + timedelta(days=1)
    inner, asked = [], raw_layer.summaries

    def meanwhile(*args):
        if not inner:
            inner.append(third)
            load(raw, {third: day_chats(third, 1)})
        return asked(*args)

    with monkeypatch.context() as patch:
        patch.setattr(raw_layer, "summaries", meanwhile)
        with pytest.raises(CommitConflict):
            load(raw, {NEXT: day_chats(NEXT, 1)})
    days = {row.ingestion_date for row in raw.events().collect()}
    assert days == {DAY, NEXT, third} and raw.events().count() == len(before) + 6
    load(raw, {NEXT: day_chats(NEXT, 1)})
    assert raw.events().count() == len(before)
    assert rows_of(raw.batch_log(), "batch_id") == [(1,), (2,), (3,), (4,)]


def test_a_pinned_layer_does_not_change(started):
    raw, _ = started
    pinned = raw.pinned()
    before = rows_of(pinned.events()), rows_of(pinned.surveys())
    load(raw, {NEXT: [], DAY: day_chats(DAY, 1)})
    assert (rows_of(pinned.events()), rows_of(pinned.surveys())) == before
    assert raw.events().count() == 6


def test_creating_twice_is_nothing_and_missing_is_not_empty(spark, tmp_path):
    raw = RawLayer(spark, f"{tmp_path}/raw")
    with pytest.raises(MissingTable, match="no raw layer"):
        raw.events()
    raw.create()
    assert raw.events().count() == raw.surveys().count() == raw.batch_log().count() == 0
    number = raw.commit_number()
    raw.create()
    assert raw.commit_number() == number
    load(raw, {DAY: day_chats(DAY, 1)})
    raw.create()
    assert raw.events().count() == 6


@pytest.mark.parametrize("lost", ["chat_events", "surveys", "commits"])
def test_a_lost_raw_table_stops_every_refresh(spark, started, tmp_path, lost):
    raw, root = started
    before = fact_rows(load_mart(spark, root))
    load(raw, {NEXT: day_chats(NEXT, 1)})
    shutil.rmtree(f"{raw.root}/{lost}")
    for way in (refresh, refresh_touched):
        with pytest.raises((AnalysisException, MissingTable)):
            way(raw, root)
    if lost == "commits":
        with pytest.raises(MissingTable, match="commits are lost"):
            load(raw, {NEXT: day_chats(NEXT, 1)})
    assert fact_rows(load_mart(spark, root)) == before


def test_a_lost_raw_layer_stops_the_refresh(spark, started, tmp_path):
    raw, root = started
    shutil.rmtree(raw.root)
    with pytest.raises(MissingTable, match="behind"):
        run(spark, tmp_path, {}, full_refresh=True)
    assert mart_at(spark, tmp_path).fact_chat_resolution.count() == 4


def test_lost_versions_do_not_restart_the_keys(spark, started):
    raw, root = started
    shutil.rmtree(f"{root}/versions")
    for way in (refresh, refresh_touched):
        with pytest.raises(MissingTable, match="commits are lost"):
            way(raw, root)
    with pytest.raises(MissingTable):
        load_mart(spark, root)


def test_spans():
    parts = [{"id": ["b", "d"]}, {"id": ["c", "f"]}, {"id": ["x", "x"]}, {"id": [None, None]}]
    assert spans_of(parts, "id") == [("b", "f"), ("x", "x")]
    assert touches({"id": ["f", "g"]}, "id", [("b", "f"), ("x", "x")])
    assert not touches({"id": ["g", "w"]}, "id", [("b", "f"), ("x", "x")])
    assert not touches({"id": [None, None]}, "id", [("b", "f")])


def scanned_days(df, name="ingestion_date"):
    """The days in the paths of the files that a frame reads."""
    return {re.search(rf"{name}=([^/]+)", path).group(1) for path in df.inputFiles()}


def test_ids_of_two_distant_dates_are_looked_up_in_their_partitions(spark, tmp_path):
    """The new ids span the whole history, yet no day in between is opened."""
    days = [DAY + timedelta(days=i) for i in range(6)] + [FAR]
    raw = RawLayer(spark, f"{tmp_path}/raw")
    for day in days:
        load(raw, {day: day_chats(day, 2)})
    # Between the ids that these days have already.
    new = {days[0]: day_chats(days[0], 1, "0_f"), FAR: day_chats(FAR, 1, "0_f")}
    events, _ = delivered(spark, new)
    from pyspark.sql import functions as F

    rows = events.withColumn("event_date", F.col("event_timestamp").cast("date"))
    parts = raw_layer.summaries(rows, ["ingestion_date", "event_date"], ["event_id", "chat_id"])
    stored = raw.table("chat_events")
    kept = raw._kept_events(stored, [], parts)
    assert scanned_days(kept) == {days[0].isoformat(), FAR.isoformat()}
    # A load that replaces these days has nothing left to look up.
    replaced = raw_layer._replaced(stored, [days[0], FAR], INGESTION_DATE)
    assert raw._kept_events(stored, replaced, parts).inputFiles() == []


def test_a_refresh_of_two_distant_dates_opens_no_other(spark, tmp_path, monkeypatch):
    days = [DAY + timedelta(days=i) for i in range(5)] + [FAR]
    run(spark, tmp_path, {day: day_chats(day, 2) for day in days}, replace_by=INGESTION_DATE)
    raw, root = RawLayer(spark, f"{tmp_path}/raw"), f"{tmp_path}/mart"
    load(raw, {DAY: day_chats(DAY, 1)})
    load(raw, {FAR: [*day_chats(FAR, 2), ordinary_chat(f"chat_{FAR:%Y%m%d}_z", at("15:00:00", FAR))]})
    read, table_read = [], raw_layer.StoredTable.read

    def noted(self, names=None):
        frame = table_read(self, names)
        read.append((self.path.rsplit("/", 1)[1], set(frame.inputFiles())))
        return frame

    monkeypatch.setattr(raw_layer.StoredTable, "read", noted)
    matched = batch.matching
    opened = {"chat_events": set(), "surveys": set(), "fact_chat_resolution": set()}

    def matching(table, key, wanted):
        for name, files in opened.items():
            files.update(f for f in table.inputFiles() if f"/{name}/" in f)
        return matched(table, key, wanted)

    monkeypatch.setattr(batch, "matching", matching)
    highest = published(spark, root).highest_key
    refresh_touched(raw, root)
    both = {DAY.isoformat(), FAR.isoformat()}
    assert {re.search("ingestion_date=([^/]+)", f).group(1) for f in opened["chat_events"]} == both
    assert {re.search("source_date=([^/]+)", f).group(1) for f in opened["surveys"]} == both
    facts = {re.search("date_key=([^/]+)", f).group(1) for f in opened["fact_chat_resolution"]}
    assert facts == {d.replace("-", "") for d in both}
    assert equals_rebuilt(raw, root)
    last = published(spark, root)
    keys = dict(rows_of(natural_keys(last.mart()), "chat_id", "chat_fact_key"))
    assert keys[f"chat_{FAR:%Y%m%d}_z"] > highest and last.highest_key == max(keys.values())
    assert sum(s["rows"] for f in last.state["dates"].values() for s in f.values()) == len(keys) == 12


def natural_keys(mart):
    return mart.fact_chat_resolution


def test_keys_go_on_above_those_of_chats_that_are_gone(spark, tmp_path):
    run(spark, tmp_path, {DAY: day_chats(DAY, 1), NEXT: day_chats(NEXT, 3)}, replace_by=INGESTION_DATE)
    highest = published(spark, f"{tmp_path}/mart").highest_key
    run(spark, tmp_path, {NEXT: []}, replace_by=INGESTION_DATE)
    run(spark, tmp_path, {FAR: day_chats(FAR, 1)}, replace_by=INGESTION_DATE)
    keys = dict(rows_of(mart_at(spark, tmp_path).fact_chat_resolution, "chat_id", "chat_fact_key"))
    assert keys[f"chat_{FAR:%Y%m%d}_0"] > highest
    assert len(fact_rows(mart_at(spark, tmp_path))) == 2
    assert natural_fact(mart_at(spark, tmp_path)).count() == 2
