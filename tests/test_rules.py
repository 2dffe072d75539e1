"""Rules on hand-made frames, the gate's order and its messages."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chatloom.operators import constraints, dimensions, sequence
from chatloom.operators.gate import (
    GateError,
    delivery_contract,
    load_constraints,
    source_gate,
)
from chatloom.operators.profile import chat_profile
from chatloom.schemas import (
    AGENT_REPLY,
    ASSIGNED,
    BATCH_LOG,
    CLOSED_BY_AGENT,
    CLOSED_BY_CUSTOMER,
    CLOSED_BY_SYSTEM,
    CUSTOMER_REPLY,
    PUSHED,
    QUEUED,
    STARTED,
)

from .helpers import (
    DAY,
    abandoned_chat,
    at,
    event_frame,
    events_of,
    frames,
    ordinary_chat,
    rows_of,
    survey_frame,
    survey_of,
)


def broken(spark, gate, steps, answer=("satisfied", False), extra_events=()):
    rows = [*events_of("chat_bad", steps), *extra_events]
    answers = [] if answer is None else [survey_of("chat_bad", *answer)]
    found = gate.violations(event_frame(spark, rows), survey_frame(spark, answers))
    return {row.rule_id for row in found.collect()}


def test_valid_chats_break_nothing(spark):
    chats = [
        ordinary_chat("chat_1", at("08:00:00")),
        ordinary_chat("chat_2", at("08:30:00"), ending=CLOSED_BY_CUSTOMER, answer=None),
        ordinary_chat("chat_3", at("09:00:00"), ending=CLOSED_BY_SYSTEM, total=5000),
        abandoned_chat("chat_4", at("10:00:00")),
    ]
    events, answers = frames(spark, *chats)
    for gate in (source_gate, delivery_contract, load_constraints):
        assert gate.violations(events, answers).count() == 0
        gate.check(events, answers)


START = (STARTED, at("08:00:00"), None)
QUEUE = (QUEUED, at("08:00:01"), None)
ASSIGN = (ASSIGNED, at("08:01:00"), 1001)
REPLY = (AGENT_REPLY, at("08:02:00"), 1001)
CLOSE = (CLOSED_BY_AGENT, at("08:10:00"), 1001)


@pytest.mark.parametrize(
    "steps, rules",
    [
        ([QUEUE, ASSIGN, REPLY, CLOSE], {"V1", "V2"}),
        ([START, (STARTED, at("08:00:30"), None), CLOSE], {"V1", "V6"}),
        ([START, QUEUE, ASSIGN, (AGENT_REPLY, at("08:01:00"), 1001), CLOSE], {"V3", "V6"}),
        ([START, QUEUE, ASSIGN, (ASSIGNED, at("08:01:30"), 1001), CLOSE], {"V4"}),
        ([START, QUEUE, ASSIGN, (ASSIGNED, at("08:01:30"), 1002), CLOSE], {"V4", "V5"}),
        ([START, QUEUE, ASSIGN, (AGENT_REPLY, at("08:02:00"), 1002), CLOSE], {"V5", "V6"}),
        ([START, QUEUE, ASSIGN, (AGENT_REPLY, at("08:02:00"), None), CLOSE], {"V6"}),
        ([START, QUEUE, (AGENT_REPLY, at("08:00:30"), 1001), ASSIGN, CLOSE], {"V6"}),
        ([START, QUEUE, ASSIGN, CLOSE, (CLOSED_BY_CUSTOMER, at("08:11:00"), None)], {"V8", "V9"}),
        ([START, QUEUE, ASSIGN, CLOSE, (CUSTOMER_REPLY, at("08:11:00"), None)], {"V9"}),
        ([START, QUEUE, ASSIGN, (CLOSED_BY_SYSTEM, at("09:30:00"), None)], {"V7"}),
        (
            [START, QUEUE, ASSIGN, (PUSHED, at("08:30:00"), 1001), (CLOSED_BY_SYSTEM, at("09:30:01"), None)],
            {"V7"},
        ),
        ([START, QUEUE, ASSIGN], {"V10b"}),
    ],
)
def test_source_gate(spark, steps, rules):
    assert broken(spark, source_gate, steps) == rules


def test_closed_chat_needs_a_survey(spark):
    assert broken(spark, source_gate, [START, QUEUE, ASSIGN, CLOSE], answer=None) == {"V10a"}


def test_equal_timestamps_are_ordered_by_event_id(spark):
    """A start that shares its timestamp is first or not by its event id."""
    moment = at("08:00:00")
    late_id = ("z", "chat_bad", None, STARTED, moment, DAY)
    early_id = ("a", "chat_bad", None, STARTED, moment, DAY)
    other = ("m", "chat_bad", None, QUEUED, moment, DAY)
    for start, expected in ((late_id, ["chat_bad"]), (early_id, [])):
        found = sequence.chat_rule("V2", event_frame(spark, [start, other]), survey_frame(spark, []))
        assert [row.entity_id for row in found.collect()] == expected


def test_last_event_by_event_id(spark):
    moment = at("08:10:00")
    close = ("b", "chat_bad", None, CLOSED_BY_CUSTOMER, moment, DAY)
    for other_id, expected in (("a", []), ("c", ["chat_bad"])):
        rows = [close, (other_id, "chat_bad", None, CUSTOMER_REPLY, moment, DAY)]
        found = sequence.chat_rule("P6", event_frame(spark, rows), survey_frame(spark, []))
        assert [row.entity_id for row in found.collect()] == expected


@pytest.mark.parametrize(
    "steps, rules",
    [
        ([START, CLOSE], {"P1", "P5"}),
        ([START, (QUEUED, at("08:00:00"), None), ASSIGN, CLOSE], {"P2", "V3"}),
        ([START, ASSIGN, (QUEUED, at("08:05:00"), None), CLOSE], {"P3"}),
        ([START, QUEUE, ASSIGN, (CUSTOMER_REPLY, at("08:02:00"), 1002), CLOSE], {"K4", "P4"}),
        ([START, QUEUE, ASSIGN, REPLY], {"P6", "P9"}),
        ([START, QUEUE, ASSIGN, CLOSE, (CUSTOMER_REPLY, at("08:11:00"), None)], {"P6"}),
        (
            [
                START, QUEUE, ASSIGN,
                (PUSHED, at("08:30:00"), 1001), (PUSHED, at("08:30:10"), 1001),
                (CLOSED_BY_SYSTEM, at("09:30:00"), None),
            ],
            {"P7"},
        ),
        ([START, QUEUE, ASSIGN, ("bot_responded", at("08:02:00"), None), CLOSE], {"K3"}),
    ],
)
def test_delivery_contract(spark, steps, rules):
    assert broken(spark, delivery_contract, steps) == rules


@pytest.mark.parametrize(
    "row, rules",
    [
        (("e1", None, None, STARTED, at("08:00:00"), DAY), {"K2"}),
        (("e1", "c", None, None, at("08:00:00"), DAY), {"K2"}),
        (("e1", "c", None, STARTED, None, DAY), {"K2"}),
        (("e1", "c", None, STARTED, at("08:00:00"), None), {"K2"}),
        ((None, "c", None, STARTED, at("08:00:00"), DAY), {"K1"}),
        (("e1", "c", 1001, STARTED, at("08:00:00"), DAY), {"K4"}),
        (("e1", "c", None, ASSIGNED, at("08:00:00"), DAY), {"K4"}),
        (("e1", "c", None, "other", at("08:00:00"), DAY), {"K3"}),
    ],
)
def test_event_constraints(spark, row, rules):
    found = load_constraints.violations(event_frame(spark, [row]), survey_frame(spark, []))
    assert {r.rule_id for r in found.collect()} == rules


@pytest.mark.parametrize(
    "row, rules",
    [
        ((None, "c", False, None), {"K5"}),
        (("s", None, False, None), {"K6"}),
        (("s", "c", None, None), {"K6"}),
        (("s", "c", False, "maybe"), {"K7"}),
        (("s", "c", True, "satisfied"), {"K8"}),
        (("s", "c", True, None), set()),
    ],
)
def test_survey_constraints(spark, row, rules):
    found = load_constraints.violations(event_frame(spark, []), survey_frame(spark, [row]))
    assert {r.rule_id for r in found.collect()} == rules


def test_repeated_ids(spark):
    events, survey = ordinary_chat("chat_1", at("08:00:00"))
    found = load_constraints.violations(
        event_frame(spark, [*events, events[1]]), survey_frame(spark, [survey, survey])
    )
    assert rows_of(found) == [
        ("K1", "chat_1_event_02"),
        ("K5", "survey_chat_1"),
        ("K6", "chat_1"),
    ]


def test_batch_log_fields(spark):
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in BATCH_LOG.fields)
    rows = [(1, DAY, 1, 2, datetime(2026, 5, 1)), (2, DAY, None, 2, datetime(2026, 5, 1))]
    found = constraints.batch_log_fields(spark.createDataFrame(rows, schema))
    assert rows_of(found) == [("K9", "2")]


def test_dimension_keys(spark):
    agents = spark.createDataFrame(
        [(1, 1001), (2, 1001), (3, 1002), (4, None)], "agent_key bigint, agent_id int"
    )
    found = constraints.dimension_keys(agents, *constraints.NATURAL_KEYS["dim_agent"])
    assert rows_of(found) == [("K10", "agent_id 1001"), ("K10", "agent_id")]
    clean = dimensions.resolution_types(spark)
    assert constraints.dimension_keys(clean, "resolution_code").count() == 0


def test_foreign_key_ignores_null(spark):
    fact = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "chat_id string, agent_key bigint")
    dimension = spark.createDataFrame([(1,)], "agent_key bigint")
    assert rows_of(constraints.foreign_key(fact, dimension, "agent_key")) == [("K12", "b")]


def test_gate_reports_the_first_rule_and_the_smallest_chat(spark):
    rows = [
        *events_of("chat_c", [START, QUEUE, ASSIGN, CLOSE, (CUSTOMER_REPLY, at("08:11:00"), None)]),
        *events_of("chat_b", [START, QUEUE, ASSIGN, (ASSIGNED, at("08:01:30"), 1001), CLOSE]),
        *events_of("chat_a", [START, QUEUE, ASSIGN, (ASSIGNED, at("08:01:30"), 1001), CLOSE]),
    ]
    answers = [survey_of(f"chat_{name}") for name in "abc"]
    events, surveys = event_frame(spark, rows), survey_frame(spark, answers)
    with pytest.raises(GateError, match="^Chat chat_a contains an agent reassignment.$") as raised:
        source_gate.check(events, surveys)
    assert (raised.value.rule_id, raised.value.entity_id) == ("V4", "chat_a")
    first = source_gate.first_failure(source_gate.summary(events, surveys)).first()
    assert (first.rule_id, first.entity_id, first.violations) == ("V4", "chat_a", 2)


def _capacity(spark, *chats):
    events, _ = frames(spark, *chats)
    return rows_of(sequence.agents_over_capacity(chat_profile(events)))


def test_capacity(spark):
    start = at("08:00:00")

    def chat(name, minute, total=1200):
        return ordinary_chat(name, start + timedelta(minutes=minute), total=total)

    assert _capacity(spark, chat("a", 0), chat("b", 1)) == []
    third = chat("c", 2)
    moment = start + timedelta(minutes=2, seconds=64)
    assert _capacity(spark, chat("a", 0), chat("b", 1), third) == [(1001, moment, 3)]


def test_capacity_counts_closings_first_on_a_tie(spark):
    """The third chat is assigned in the very moment at which the first closes."""
    start = at("08:00:00")
    first = ordinary_chat("a", start, total=364)
    second = ordinary_chat("b", start + timedelta(minutes=1))
    third = ordinary_chat("c", start + timedelta(minutes=5))
    assert first[0][-1][4] == third[0][2][4]
    assert _capacity(spark, first, second, third) == []


def test_capacity_over_midnight_and_hours(spark):
    """Chats opened in earlier hours still count; an open chat counts for good."""
    evening = at("22:30:00")
    open_chat = (ordinary_chat("a", evening)[0][:-1], None)
    long_chat = ordinary_chat("b", evening + timedelta(minutes=10), total=4 * 3600)
    next_day = ordinary_chat("c", evening + timedelta(hours=3))
    found = _capacity(spark, open_chat, long_chat, next_day)
    assert found == [(1001, next_day[0][2][4], 3)]


def test_dates_and_agents_merge(spark):
    events, _ = frames(spark, ordinary_chat("a", at("08:00:00"), agent=1002))
    agents = dimensions.merge_agents(None, dimensions.agents_of(events))
    assert rows_of(agents, "agent_id", "agent_name", "support_team") == [
        (1002, "Agent 1002", "Billing Support")
    ]
    more, _ = frames(
        spark,
        ordinary_chat("b", at("09:00:00"), agent=1003),
        ordinary_chat("c", at("09:00:00"), agent=1004),
    )
    merged = dimensions.merge_agents(agents, dimensions.agents_of(more))
    assert merged.select("agent_key").distinct().count() == 3
    kept = merged.where(F.col("agent_id") == 1002).first().agent_key
    assert kept == agents.first().agent_key
    assert merged.agg(F.min("agent_key")).first()[0] == kept
