"""Small hand-made chats."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrameWriter

from chatloom.schemas import (
    AGENT_REPLY,
    ASSIGNED,
    CHAT_EVENTS,
    CLOSED_BY_AGENT,
    CLOSED_BY_CUSTOMER,
    CLOSED_BY_SYSTEM,
    CUSTOMER_REPLY,
    PUSHED,
    QUEUED,
    STARTED,
    SURVEYS,
)
from chatloom.sources.commits import Commits

DAY = date(2026, 5, 1)


def at(text: str, day: date = DAY) -> datetime:
    return datetime.fromisoformat(f"{day.isoformat()} {text}")


def events_of(chat_id: str, steps, ingestion_date: date = DAY):
    """Event rows from ``(event_type, moment, agent_id)`` steps, numbered in order."""
    return [
        (f"{chat_id}_event_{place:02d}", chat_id, agent, kind, moment, ingestion_date)
        for place, (kind, moment, agent) in enumerate(steps, start=1)
    ]


def survey_of(chat_id: str, answer: str | None = "satisfied", skipped: bool = False):
    return (f"survey_{chat_id}", chat_id, skipped, answer)


def ordinary_chat(
    chat_id: str,
    start: datetime,
    agent: int = 1001,
    wait: float = 63,
    first_reply: float = 60,
    total: float = 1200,
    ending: str = CLOSED_BY_AGENT,
    answer: str | None = "satisfied",
    ingestion_date: date | None = None,
):
    """A valid closed chat: its events and its survey."""

    def after(seconds: float) -> datetime:
        return start + timedelta(seconds=seconds)

    queued = after(1)
    assigned = queued + timedelta(seconds=wait)
    steps = [
        (STARTED, start, None),
        (QUEUED, queued, None),
        (ASSIGNED, assigned, agent),
        (AGENT_REPLY, assigned + timedelta(seconds=first_reply), agent),
        (CUSTOMER_REPLY, assigned + timedelta(seconds=first_reply + 10), None),
    ]
    end = after(total)
    if ending == CLOSED_BY_SYSTEM:
        steps.append((PUSHED, end - timedelta(hours=1), agent))
    steps.append((ending, end, agent if ending == CLOSED_BY_AGENT else None))
    day = ingestion_date or start.date()
    return events_of(chat_id, steps, day), survey_of(chat_id, answer)


def abandoned_chat(chat_id: str, start: datetime, waited: float = 200):
    steps = [
        (STARTED, start, None),
        (QUEUED, start + timedelta(seconds=1), None),
        (CLOSED_BY_CUSTOMER, start + timedelta(seconds=waited), None),
    ]
    return events_of(chat_id, steps, start.date()), survey_of(chat_id, None)


def event_frame(spark, rows):
    return spark.createDataFrame(rows, CHAT_EVENTS)


def survey_frame(spark, rows):
    return spark.createDataFrame(rows, SURVEYS)


def frames(spark, *chats):
    """Event and survey frames of chats given as ``(events, survey)``."""
    events = [row for rows, _ in chats for row in rows]
    answers = [survey for _, survey in chats if survey is not None]
    return event_frame(spark, events), survey_frame(spark, answers)


def rows_of(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=repr)


@contextmanager
def dying_at(monkeypatch, root: str, step: int):
    """The ``step``-th table written or commit made below ``root`` raises instead."""
    seen = []
    write, add = DataFrameWriter.parquet, Commits.add

    def counted(path):
        if path.startswith(str(root)):
            seen.append(path)
            if len(seen) == step:
                raise OSError("the job died")

    def writing(self, path, *args, **options):
        counted(path)
        return write(self, path, *args, **options)

    def adding(self, number, state):
        counted(self.folder)
        return add(self, number, state)

    with monkeypatch.context() as patch:
        patch.setattr(DataFrameWriter, "parquet", writing)
        patch.setattr(Commits, "add", adding)
        yield
