"""JSON Lines deliveries."""

import gzip
import json
from datetime import date

from pyspark.sql import functions as F

from chatloom.schemas import CLOSED_BY_CUSTOMER
from chatloom.sources.deliveries import (
    REJECTS,
    is_one_object,
    read_deliveries,
    write_deliveries,
    write_delivery,
)
from chatloom.sources.raw_layer import RawLayer

from .helpers import DAY, abandoned_chat, at, frames, ordinary_chat, rows_of


def _chats():
    return [
        ordinary_chat("chat_2", at("08:00:00.250000"), first_reply=60.5),
        ordinary_chat("chat_1", at("08:30:00"), ending=CLOSED_BY_CUSTOMER, answer=None),
        abandoned_chat("chat_3", at("07:00:00")),
    ]


def _lines(folder):
    parts = sorted(folder.glob("part-*"))
    return [json.loads(line) for part in parts for line in part.read_text().splitlines()]


def test_round_trip_of_one_day(spark, tmp_path):
    events, answers = frames(spark, *_chats())
    write_delivery(events, answers, str(tmp_path), DAY)
    back = read_deliveries(spark, str(tmp_path), [DAY])
    assert rows_of(back.events.drop("source_date")) == rows_of(events)
    assert rows_of(back.surveys.drop("source_date")) == rows_of(answers)
    assert [r.source_date for r in back.events.select("source_date").distinct().collect()] == [DAY]
    assert back.rejects.count() == 0


def test_written_lines(spark, tmp_path):
    events, answers = frames(spark, *_chats())
    write_delivery(events, answers, str(tmp_path), DAY)
    lines = _lines(tmp_path / "chat_logs" / f"source_date={DAY.isoformat()}")
    assert all(list(line) == sorted(line) for line in lines)
    moments = [(line["event_timestamp"], line["event_id"]) for line in lines]
    assert moments == sorted(moments)
    assert lines[0]["agent_id"] is None
    assert lines[0]["ingestion_date"] == "2026-05-01"
    assert lines[0]["event_timestamp"].startswith("2026-05-01 07:00:00")
    surveys = _lines(tmp_path / "surveys" / f"source_date={DAY.isoformat()}")
    assert any(line["customer_input"] is None for line in surveys)


def test_single_files_and_corrupt_lines(spark, tmp_path):
    """Files as another producer writes them, with lines that do not fit."""
    day = tmp_path / "2026-05-01"
    day.mkdir()
    good = {
        "agent_id": None, "chat_id": "chat_1", "event_id": "e1", "event_timestamp": "2026-05-01 08:00:00",
        "event_type": "chat_started", "ingestion_date": "2026-05-01",
    }
    fraction = {**good, "event_id": "e2", "event_timestamp": "2026-05-01 08:00:00.250000"}
    bad_agent = {**good, "event_id": "e3", "agent_id": "somebody"}
    bad_time = {**good, "event_id": "e4", "event_timestamp": "yesterday"}
    lines = [json.dumps(row) for row in (good, fraction, bad_agent, bad_time)] + ["{not json"]
    (day / "chat_logs.jsonl").write_text("\n".join(lines) + "\n")
    survey = {"chat_id": "chat_1", "customer_input": None, "survey_id": "s1", "survey_skipped": True}
    (day / "surveys.jsonl").write_text(json.dumps(survey) + "\n")
    got = read_deliveries(spark, str(tmp_path))
    assert rows_of(got.events, "event_id", "event_timestamp") == [
        ("e1", at("08:00:00")),
        ("e2", at("08:00:00.250000")),
    ]
    assert rows_of(got.surveys) == [("s1", "chat_1", True, None, DAY)]
    rejected = got.rejects.collect()
    assert {row.source for row in rejected} == {"chat_logs"}
    assert sorted(row.line for row in rejected) == sorted(lines[2:])


def test_many_days_in_one_job(spark, tmp_path):
    events, answers = frames(spark, *_chats())
    day = F.when(F.col("chat_id") == "chat_3", date(2026, 5, 2)).otherwise(DAY)
    events, answers = events.withColumn("source_date", day), answers.withColumn("source_date", day)
    write_deliveries(events, answers, str(tmp_path))
    back = read_deliveries(spark, str(tmp_path))
    assert rows_of(back.events) == rows_of(events)
    assert rows_of(back.surveys) == rows_of(answers)
    one = read_deliveries(spark, str(tmp_path), [date(2026, 5, 2)])
    assert rows_of(one.surveys, "chat_id") == [("chat_3",)]


def test_missing_days_are_empty(spark, tmp_path):
    got = read_deliveries(spark, str(tmp_path), [DAY])
    assert got.events.count() == got.surveys.count() == got.rejects.count() == 0
    assert "source_date" in got.events.columns


def test_rejects_say_why_and_where(spark, tmp_path):
    day = tmp_path / DAY.isoformat()
    day.mkdir()
    good = {"survey_id": "s1", "chat_id": "c}\"{1", "survey_skipped": True, "customer_input": None}
    unfit = {**good, "survey_skipped": "perhaps", "customer_input": {"a": "}"}}
    expected = {
        json.dumps({**good, "survey_skipped": "perhaps"}): "survey_skipped",
        json.dumps(good) * 2: "not one object",
        "[]": "not one object",
        '{"survey_id" "s1"}': "not JSON",
        '{"survey_id": "s1", "chat_id": 1 2}': "not JSON",
        json.dumps(unfit): "not one object",
    }
    (day / "surveys.jsonl").write_text("\n".join([json.dumps(good), *expected]) + "\n")
    got = read_deliveries(spark, str(tmp_path))
    assert got.surveys.count() == 1
    assert {row.line: row.reason for row in got.rejects.collect()} == expected
    files = {row.file for row in got.rejects.collect()}
    assert len(files) == 1 and files.pop().endswith(f"{DAY.isoformat()}/surveys.jsonl")


def test_stored_rejects_keep_reasons_and_take_lines_without(spark, tmp_path):
    raw = RawLayer(spark, f"{tmp_path}/raw")
    plain = spark.createDataFrame([(DAY, "surveys", "{")], REJECTS)
    raw.store_rejects(plain, [DAY])
    assert rows_of(raw.rejects()) == [(DAY, "surveys", "{", None, None)]
    explained = plain.withColumns({"file": F.lit("f"), "reason": F.lit("not JSON")})
    raw.store_rejects(explained, [DAY])
    assert rows_of(raw.rejects()) == [(DAY, "surveys", "{", "f", "not JSON")]


def test_compressed_deliveries_in_many_tasks_read_back(spark, tmp_path):
    """The rows, their order within a date's files and the outcomes are those of plain ones."""
    events, answers = frames(spark, *_chats())
    day = F.lit(DAY)
    events, answers = events.withColumn("source_date", day), answers.withColumn("source_date", day)
    write_deliveries(events, answers, f"{tmp_path}/plain", [DAY])
    write_deliveries(events, answers, f"{tmp_path}/packed", [DAY], compression="gzip", tasks=4)
    parts = sorted((tmp_path / "packed" / "chat_logs" / f"source_date={DAY}").glob("part-*"))
    assert len(parts) > 1 and all(p.name.endswith(".gz") for p in parts)
    lines = "".join(gzip.decompress(p.read_bytes()).decode() for p in parts)
    (plain,) = (tmp_path / "plain" / "chat_logs" / f"source_date={DAY}").glob("part-*")
    assert lines == plain.read_text()
    got = [read_deliveries(spark, f"{tmp_path}/{name}") for name in ("plain", "packed")]
    assert rows_of(got[0].events) == rows_of(got[1].events)
    assert rows_of(got[0].surveys) == rows_of(got[1].surveys)
    counts = got[1].outcomes.groupBy("source", "rejected").count()
    want = [("chat_logs", False, events.count()), ("surveys", False, answers.count())]
    assert rows_of(counts) == sorted(want, key=repr)


def test_one_object_with_and_without_braces_in_strings(spark):
    lines = ['{"a":1}', '{"a":"}"}', '{"a":"{"}', '{}{}', '{"a":{}}', ' {"a":1} ', "[]", "{", "}", '{"a":"\\"}"}', '"{"}']
    found = spark.createDataFrame([(x,) for x in lines], "line string").select(is_one_object(F.col("line")))
    assert [r[0] for r in found.collect()] == [True, True, True, False, False, True, False, False, False, True, False]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_line_is_parsed_once(spark, tmp_path):
    """A filter on the parsed row must not parse it a second time, nor its date per line."""
    write_delivery(*frames(spark, *_chats()), str(tmp_path), DAY)
    got = read_deliveries(spark, str(tmp_path))
    for frame in (got.events, got.surveys):
        assert plan_of(frame).count("from_json(") == 1
        assert "regexp_extract" not in plan_of(frame)


def test_both_layouts_and_an_empty_folder_in_one_reading(spark, tmp_path):
    for folder in ("chat_logs/source_date=2026-05-01", "2026-05-02", "chat_logs/source_date=2026-05-03"):
        (tmp_path / folder).mkdir(parents=True)
    line = '{"event_id":"%s","event_timestamp":"2026-05-01 08:00:00"}\n'
    (tmp_path / "chat_logs/source_date=2026-05-01/a.json").write_text(line % "a" + "[]\n")
    (tmp_path / "2026-05-02/chat_logs.jsonl").write_text(line % "b" + " \nnull\n")
    got = read_deliveries(spark, str(tmp_path))
    days = {(r.event_id, str(r.source_date)) for r in got.events.collect()}
    assert days == {("a", "2026-05-01"), ("b", "2026-05-02")}
    rejects = {(r.line, str(r.source_date), r.file.rsplit("/", 1)[1]) for r in got.rejects.collect()}
    assert rejects == {("[]", "2026-05-01", "a.json"), ("null", "2026-05-02", "chat_logs.jsonl")}
    only_empty = read_deliveries(spark, str(tmp_path), [date(2026, 5, 3)])
    assert only_empty.events.collect() == [] and only_empty.rejects.collect() == []
