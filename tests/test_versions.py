"""Tables whose columns and checks change between loads."""

import json
import os
import shutil

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.operators.constraints import event_checks, survey_checks
from chatloom.operators.gate import GateError
from chatloom.operators.replacement import INGESTION_DATE
from chatloom.plans.batch import run_batch
from chatloom.plans.mart import load_mart
from chatloom.schemas import CUSTOMER_REPLY, WITHOUT_AGENT
from chatloom.sources import raw_layer
from chatloom.sources.commits import CommitConflict, Commits
from chatloom.sources.deliveries import read_deliveries, write_deliveries
from chatloom.sources.raw_layer import RawLayer

from .helpers import DAY, rows_of
from .test_raw_layer import NEXT, day_chats, delivered

CHANNEL = T.StructField("channel", T.StringType())
NOTE = "customer_left_note"
WITH_NOTES = event_checks(without_agent=[*WITHOUT_AGENT, NOTE])


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("versions") / "raw"
    raw = RawLayer(spark, str(root))
    raw.load(*delivered(spark, {DAY: day_chats(DAY, 2)}), [DAY], INGESTION_DATE)
    return root


@pytest.fixture
def raw(spark, tmp_path, loaded):
    shutil.copytree(loaded, tmp_path / "raw")
    return RawLayer(spark, f"{tmp_path}/raw")


def with_notes(spark, deliveries, channel="web"):
    events, surveys = delivered(spark, deliveries)
    kind = F.when(F.col("event_type") == CUSTOMER_REPLY, NOTE).otherwise(F.col("event_type"))
    return events.withColumns({"event_type": kind, "channel": F.lit(channel)}), surveys


def opened(monkeypatch):
    """The folders that changes of a table read, step by step."""
    seen = []
    only = raw_layer.only_folders

    def noted(table, folders):
        seen.append(set(folders))
        return only(table, folders)

    monkeypatch.setattr(raw_layer, "only_folders", noted)
    return seen


def test_older_rows_have_null_in_an_added_column(spark, raw):
    raw.change_table("chat_events", [CHANNEL], WITH_NOTES)
    raw.load(*with_notes(spark, {NEXT: day_chats(NEXT, 1)}), [NEXT], INGESTION_DATE)
    found = raw.rows_by_version("chat_events").groupBy("ingestion_date", "channel", "version").count()
    assert rows_of(found) == [(DAY, None, 1, 12), (NEXT, "web", 2, 6)]
    log = {row.version: row for row in raw.schema_log("chat_events").collect()}
    assert [log[v].rows for v in (1, 2)] == [12, 6]
    assert log[2].columns == [*log[1].columns, "channel"]
    assert NOTE in log[2].checks["K3"] and NOTE not in log[1].checks["K3"]
    assert raw.events().columns == raw_layer.CHAT_EVENTS.fieldNames()
    assert raw.stored_events().count() == 18


def test_a_reloaded_date_moves_to_the_new_version(spark, raw):
    raw.change_table("chat_events", [CHANNEL], WITH_NOTES)
    raw.load(*with_notes(spark, {DAY: day_chats(DAY, 1)}), [DAY], INGESTION_DATE)
    assert rows_of(raw.rows_by_version("chat_events").select("version", "channel").distinct()) == [
        (2, "web")
    ]


def test_new_rows_must_meet_the_checks_in_force(spark, raw):
    late = with_notes(spark, {NEXT: day_chats(NEXT, 1)})
    with pytest.raises(GateError) as broken:
        raw.load(*late, [NEXT], INGESTION_DATE)
    assert broken.value.rule_id == "K3"
    raw.change_table("chat_events", checks={"K3": WITH_NOTES["K3"], "few": "chat_id LIKE 'chat_20260501%'"})
    with pytest.raises(GateError, match="breaks the check few") as broken:
        raw.load(*late, [NEXT], INGESTION_DATE)
    assert broken.value.rule_id == "few"


def test_a_change_that_stored_rows_break_is_refused(spark, raw):
    number, state = raw.commit_number(), raw.state()
    fewer = [kind for kind in WITHOUT_AGENT if kind != CUSTOMER_REPLY]
    with pytest.raises(GateError) as broken:
        raw.change_table("chat_events", [CHANNEL], event_checks(without_agent=fewer))
    assert broken.value.rule_id == "K3" and broken.value.entity_id.startswith("chat_2026")
    with pytest.raises(GateError) as broken:
        raw.change_table("surveys", checks=survey_checks(["dissatisfied"]))
    assert broken.value.rule_id == "K7"
    assert (raw.commit_number(), raw.state()) == (number, state)


def test_a_condition_that_comes_out_null_passes(raw):
    raw.change_table("chat_events", checks={"agents": "agent_id > 1000"})
    assert "agents" in raw.state()["versions"]["chat_events"][-1]["checks"]


def test_what_is_in_force_makes_no_commit(raw):
    raw.change_table("chat_events", [CHANNEL], WITH_NOTES)
    number = raw.commit_number()
    raw.change_table("chat_events", [CHANNEL], WITH_NOTES)
    raw.change_table("chat_events")
    assert raw.commit_number() == number


def test_only_rows_that_may_break_a_check_are_read(spark, raw, monkeypatch):
    first = set(raw.state()["written"]["chat_events"])
    raw.change_table("chat_events", checks=WITH_NOTES)
    raw.load(*delivered(spark, {NEXT: day_chats(NEXT, 1)}), [NEXT], INGESTION_DATE)
    second = set(raw.state()["written"]["chat_events"]) - first
    seen = opened(monkeypatch)
    # The first rows met this one when they came, the second ones never did.
    raw.change_table("chat_events", checks=event_checks())
    assert seen == [second]
    # All rows have met the wider one; a dropped one needs no look.
    raw.change_table("chat_events", checks=WITH_NOTES)
    raw.change_table("chat_events", checks={"K4": None})
    assert seen == [second]
    # A check that was dropped doesn't hold for what came meanwhile.
    raw.load(*delivered(spark, {NEXT: day_chats(NEXT, 2)}), [NEXT], INGESTION_DATE)
    third = set(raw.state()["written"]["chat_events"]) - first - second
    raw.change_table("chat_events", checks={"K4": WITH_NOTES["K4"]})
    assert seen == [second, third]


def test_surveys_that_are_written_again_keep_their_columns(spark, raw):
    raw.change_table("surveys", [CHANNEL])
    events, surveys = delivered(spark, {NEXT: day_chats(NEXT, 3)})
    raw.load(events, surveys.withColumn("channel", F.lit("phone")), [NEXT], INGESTION_DATE)
    # One chat's events are deleted by its date, the survey lies under another date.
    again, _ = delivered(spark, {NEXT: day_chats(NEXT, 1, "x")})
    raw.load(again, surveys.limit(0), [NEXT], INGESTION_DATE)
    kept = raw.stored_surveys()
    assert rows_of(kept.select("channel").distinct()) == [(None,)]
    assert kept.count() == 2


def test_impossible_columns_and_checks(raw):
    number = raw.commit_number()
    whole = T.StructField("channel", T.StringType(), nullable=False)
    for column in (whole, T.StructField("Load", T.IntegerType()), T.StructField("CHAT_ID", T.LongType())):
        with pytest.raises(ValueError):
            raw.change_table("chat_events", [column])
    for checks in ({"no name": "TRUE"}, {"x{}": "TRUE"}):
        with pytest.raises(ValueError):
            raw.change_table("chat_events", checks=checks)
    for condition in ("nowhere > 1", "agent_id + 1"):
        with pytest.raises(AnalysisException):
            raw.change_table("chat_events", checks={"odd": condition})
    with pytest.raises(ValueError):
        raw.change_table("batch_log", [CHANNEL])
    assert raw.commit_number() == number


def test_a_load_and_a_change_that_meet(spark, raw, monkeypatch):
    add = Commits.add

    def late(self, number, state):
        with monkeypatch.context() as patch:
            patch.setattr(Commits, "add", add)
            raw.load(*delivered(spark, {NEXT: day_chats(NEXT, 1)}), [NEXT], INGESTION_DATE)
        add(self, number, state)

    with monkeypatch.context() as patch:
        patch.setattr(Commits, "add", late)
        with pytest.raises(CommitConflict):
            raw.change_table("chat_events", [CHANNEL])
    assert raw.events().count() == 18 and "channel" not in raw.stored_events().columns


def test_a_state_from_before_there_were_versions(spark, raw):
    folder, name = os.path.split(raw.commits.path(raw.commit_number()))
    state = raw.state()
    del state["versions"], state["under"]
    for entry in os.listdir(folder):
        if name in entry:
            os.remove(f"{folder}/{entry}")
    with open(f"{folder}/{name}", "w") as file:
        json.dump(state, file)
    raw.change_table("chat_events", [CHANNEL], WITH_NOTES)
    raw.load(*with_notes(spark, {NEXT: day_chats(NEXT, 1)}), [NEXT], INGESTION_DATE)
    assert [row.rows for row in raw.schema_log("chat_events").orderBy("version").collect()] == [12, 6]


def test_a_batch_run_over_deliveries_with_the_new_column(spark, tmp_path):
    root = f"{tmp_path}/warehouse"
    run_batch(spark, root, *delivered(spark, {DAY: day_chats(DAY, 2)}), [DAY], INGESTION_DATE)
    raw = RawLayer(spark, f"{root}/raw")
    raw.change_table("chat_events", [CHANNEL])
    events, surveys = delivered(spark, {NEXT: day_chats(NEXT, 1)})
    write_deliveries(events.withColumn("channel", F.lit("web")), surveys, f"{tmp_path}/in", [NEXT])
    got = read_deliveries(
        spark, f"{tmp_path}/in", event_schema=raw.delivery_schema("chat_events")
    )
    run_batch(spark, root, got.events, got.surveys, [NEXT], INGESTION_DATE, f"{tmp_path}/backup")
    assert rows_of(raw.stored_events().groupBy("channel").count()) == [("web", 6), (None, 12)]
    backup = read_deliveries(
        spark, f"{tmp_path}/backup", event_schema=raw.delivery_schema("chat_events")
    )
    assert rows_of(backup.events.select("channel").distinct()) == [("web",)]
    assert load_mart(spark, f"{root}/mart").fact_chat_resolution.count() == 3


def test_versions_of_an_empty_table(spark, tmp_path):
    raw = RawLayer(spark, f"{tmp_path}/raw")
    raw.create()
    raw.change_table("chat_events", [CHANNEL], WITH_NOTES)
    assert raw.rows_by_version("chat_events").columns[-2:] == ["channel", "version"]
    assert raw.rows_by_version("chat_events").count() == 0
