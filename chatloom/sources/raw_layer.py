"""The raw layer: partitioned Parquet tables with replace-by-date loads.

Events lie under ``ingestion_date`` and ``event_date`` and surveys under their
``source_date``. A load writes the partitions of its dates into folders of its own
and then commits once for events, surveys, rejects, batch log and touched chats
together: readers see all of it or nothing.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import constraints
from ..operators.gate import LOAD_CONSTRAINTS, LOG_CONSTRAINTS, require
from ..operators.lookup import matching, maybe_repeated
from ..operators.replacement import EVENT_DATE, Replacement, any_overtaken, replace_dates
from ..schemas import BATCH_LOG, CHAT_EVENTS, SURVEYS, conform
from ..session import COMPRESSION, materialize
from . import versions
from .commits import (
    Commits,
    MissingTable,
    Span,
    StoredTable,
    fresh_folder,
    spans_of,
    summaries,
)
from .deliveries import EXPLAINED_REJECTS
from .folders import delete_folder, names_in

STORED_EVENTS = T.StructType([*CHAT_EVENTS.fields, T.StructField("event_date", T.DateType())])
STORED_SURVEYS = T.StructType([*SURVEYS.fields, T.StructField("source_date", T.DateType())])
CHAT_IDS = T.StructType([T.StructField("chat_id", T.StringType())])

# Of every table: schema, partition columns, order of the rows, summarised ids.
TABLES = {
    "chat_events": (
        STORED_EVENTS,
        ["ingestion_date", "event_date"],
        ["chat_id", "event_timestamp"],
        ["event_id", "chat_id"],
    ),
    "surveys": (STORED_SURVEYS, ["source_date"], ["chat_id"], ["survey_id", "chat_id"]),
    "rejects": (EXPLAINED_REJECTS, ["source_date"], ["source"], []),
    "batch_log": (BATCH_LOG, [], ["batch_id"], []),
    "touched_chats": (CHAT_IDS, [], ["chat_id"], []),
}
# The checks of the first version: rules K2-K4 and K6-K8.
CHECKS = {"chat_events": constraints.event_checks(), "surveys": constraints.survey_checks()}
# What deliveries and tables need for themselves.
TAKEN_NAMES = ("load", "source_date", "event_date", "place", "replaced_on", "replaced_at", "version")
FIRST_STATE = {
    "parts": {name: {} for name in TABLES},
    "written": {name: {} for name in TABLES},
    "versions": {
        name: [versions.entry(schema, CHECKS.get(name, {}), commit=1)]
        for name, (schema, *_) in TABLES.items()
    },
    "under": {name: {} for name in TABLES},
    "last_batch_id": 0,
    "touched": [],
}


def row_violations(name: str, rows: DataFrame, checks: dict[str, str]) -> DataFrame:
    """The checks that rows of a table break; events are named by id, surveys by chat."""
    entity = "event_id" if name == "chat_events" else F.coalesce("chat_id", "survey_id")
    return constraints.broken_rules(rows, constraints.breaking(checks), entity)


def messages_of(checks: dict[str, str]) -> dict[str, str]:
    """The messages of the load's rules and of checks that tables were given."""
    own = {name: f"{{}} breaks the check {name}" for name in checks if name not in LOAD_CONSTRAINTS}
    return {**LOAD_CONSTRAINTS, **own}


def load_violations(
    change: Replacement, event_checks: dict[str, str], survey_checks: dict[str, str]
) -> DataFrame:
    """Rules K1-K8, and the table's other checks, for the rows a load adds, also against
    the rows it keeps.

    Rows already stored passed the same rules when they came, or when a check was
    changed, so only their ids are read, to look for the new ones among them.
    """
    events, surveys = change.new_events, change.new_surveys

    def taken(kept: DataFrame, new: DataFrame, key: str) -> DataFrame:
        # The span of the new keys is asked for only if there is something to look up in.
        return kept.select(key) if kept.isEmpty() else matching(kept.select(key), key, new)

    def repeated(rows: DataFrame, key: str) -> DataFrame:
        ids = rows.select(key)
        suspects = maybe_repeated(ids, key).unionByName(ids.where(F.col(key).isNull()))
        return constraints.repeated(suspects, key)

    return (
        row_violations("chat_events", events, event_checks)
        .unionByName(constraints.violations("K1", repeated(events, "event_id"), "event_id"))
        .unionByName(row_violations("surveys", surveys, survey_checks))
        .unionByName(constraints.violations("K5", repeated(surveys, "survey_id"), "survey_id"))
        .unionByName(
            constraints.violations(
                "K6", repeated(surveys, "chat_id").where("chat_id IS NOT NULL"), "chat_id"
            )
        )
        .unionByName(
            constraints.violations("K1", taken(change.kept_events, events, "event_id"), "event_id")
        )
        .unionByName(
            constraints.violations("K5", taken(change.kept_surveys, surveys, "survey_id"), "survey_id")
        )
        .unionByName(
            constraints.violations("K6", taken(change.kept_surveys, surveys, "chat_id"), "chat_id")
        )
    )


@dataclass(frozen=True)
class RawLayer:
    """The raw layer in a folder, as of its last commit or, pinned, of one of them."""

    spark: SparkSession
    root: str
    at: int | None = None

    @property
    def commits(self) -> Commits:
        return Commits(self.spark, f"{self.root}/commits")

    def create(self) -> None:
        """Make an empty raw layer unless there is one."""
        if not self.commits.last():
            self.commits.require_none(self.root, TABLES)
            self.commits.add(1, FIRST_STATE)

    def commit_number(self) -> int:
        number = self.at or self.commits.last()
        if not number:
            self.commits.require_none(self.root, TABLES)
            raise MissingTable(f"no raw layer has been created in {self.root}")
        return number

    def pinned(self) -> RawLayer:
        """This layer as it is now, whatever is committed later."""
        return replace(self, at=self.commit_number())

    def state(self) -> dict:
        return self.commits.read(self.commit_number())

    def table(self, name: str, state: dict | None = None) -> StoredTable:
        state = state or self.state()
        return StoredTable(
            self.spark,
            f"{self.root}/{name}",
            versions.schema_of(_versions(state, name)[-1]),
            TABLES[name][1],
            state["parts"][name],
            state["written"][name],
        )

    def stored_events(self) -> DataFrame:
        return self.table("chat_events").read()

    def stored_surveys(self) -> DataFrame:
        return self.table("surveys").read()

    def events(self) -> DataFrame:
        return self.stored_events().select(*CHAT_EVENTS.fieldNames())

    def surveys(self) -> DataFrame:
        return self.stored_surveys().select(*SURVEYS.fieldNames())

    def batch_log(self) -> DataFrame:
        return self.table("batch_log").read()

    def rejects(self) -> DataFrame:
        """Lines of the deliveries loaded last for each date that did not parse, and why."""
        return self.table("rejects").read()

    def touched_since(self, commit: int) -> tuple[DataFrame, list[Span]]:
        """Chats that commits after ``commit`` have touched, and spans they lie in."""
        state = self.state()
        later = [t for t in state["touched"] if t["commit"] > commit]
        own = self.table("touched_chats", state)
        kept = {"": {t["folder"]: {} for t in later}}
        chats = replace_parts(own, kept).read().distinct()
        return chats, spans_of(({"chat_id": span} for t in later for span in t["spans"]), "chat_id")

    def events_of(self, spans: list[Span]) -> DataFrame:
        """Events of the partitions that may hold chats within the spans."""
        own = self.table("chat_events")
        return own.read(own.holding("chat_id", spans)).select(*CHAT_EVENTS.fieldNames())

    def surveys_of(self, spans: list[Span]) -> DataFrame:
        own = self.table("surveys")
        return own.read(own.holding("chat_id", spans)).select(*SURVEYS.fieldNames())

    def delivered(self, rows: DataFrame, name: str) -> DataFrame:
        """Delivered rows in the columns that the table has now, with their source date."""
        return conform_delivery(rows, self.table(name).schema)

    def delivery_schema(self, name: str) -> T.StructType:
        """The columns that deliveries have for the table as it is now."""
        return T.StructType(delivered_fields(self.table(name).schema))

    def change_table(
        self,
        name: str,
        add: Sequence[T.StructField] = (),
        checks: dict[str, str | None] | None = None,
    ) -> None:
        """Give ``chat_events`` or ``surveys`` further columns and other checks, in one commit.

        Rows stored before have NULL in an added column, so it must be nullable.
        ``checks`` has a new condition for every check that is replaced or added, and
        None for one that is dropped; a condition that comes out NULL passes. Stored rows
        are tested against a new condition unless they have met the very same one since
        they were written. A row that breaks it raises ``GateError`` and nothing changes.
        What is in force already is no change and makes no commit.
        """
        if name not in CHECKS:
            raise ValueError(f"{name} has no versions")
        number = self.commit_number()
        before = self.commits.read(number)
        known = _versions(before, name)
        schema = versions.with_columns(versions.schema_of(known[-1]), add, TAKEN_NAMES)
        now = versions.with_checks(known[-1]["checks"], checks or {})
        entry = versions.entry(schema, now, number + 1)
        if versions.same(entry, known[-1]):
            return
        stored = replace(self.table(name, before), schema=schema)
        # Also without rows a condition must be one over the table's columns.
        for condition in now.values():
            stored.read([]).where(condition)
        under = before.get("under", {}).get(name, {})
        folders = {f for part in stored.parts.values() for f in part}
        for unmet, own in versions.unproven(now, known, under, folders):
            rows = only_folders(stored, own).read()
            require(row_violations(name, rows, unmet), messages_of(unmet))
        state = _copy(before)
        state["versions"] = {n: _versions(before, n) for n in TABLES}
        state["versions"][name] = [*known, entry]
        self.commits.add(number + 1, state)

    def rows_by_version(self, name: str) -> DataFrame:
        """The rows of a table with the ``version`` they were written under, from 1."""
        state = self.state()
        stored, under = self.table(name, state), state.get("under", {}).get(name, {})
        by_version: dict[int, set[str]] = {0: set()}
        for folder in {f for part in stored.parts.values() for f in part}:
            by_version.setdefault(under.get(folder, 0), set()).add(folder)
        frames = [
            only_folders(stored, own).read().withColumn("version", F.lit(place + 1))
            for place, own in sorted(by_version.items())
        ]
        return reduce(DataFrame.unionByName, frames)

    def schema_log(self, name: str) -> DataFrame:
        """Every version of a table: its commit, columns, checks, and stored rows."""
        state = self.state()
        under, rows = state.get("under", {}).get(name, {}), Counter()
        for part in state["parts"][name].values():
            for folder, summary in part.items():
                rows[under.get(folder, 0)] += summary.get("rows", 0)
        log = [
            (place + 1, v["commit"], versions.schema_of(v).fieldNames(), v["checks"], rows[place])
            for place, v in enumerate(_versions(state, name))
        ]
        return self.spark.createDataFrame(
            log,
            "version int, commit bigint, columns array<string>, checks map<string, string>, rows bigint",
        )

    def store_rejects(self, rejects: DataFrame, dates: Sequence[date]) -> None:
        """Replace the rejected lines of ``dates``."""
        self.create()
        number = self.commit_number()
        state = _copy(self.commits.read(number))
        self._put_rejects(state, fresh_folder(), rejects, dates)
        self.commits.add(number + 1, state)

    def load(
        self,
        events: DataFrame,
        surveys: DataFrame,
        dates: Sequence[date],
        replace_by: str = EVENT_DATE,
        rejects: DataFrame | None = None,
        written: bool = False,
    ) -> DataFrame:
        """Load the deliveries of ``dates`` and return their batch log rows.

        Nothing changes when a rule K1-K8 is broken, when the load dies, or when
        another one commits first, which raises ``CommitConflict``; in each case the
        load can be repeated. Stored ids are looked up only in partitions whose
        spans of ids meet those of the new rows, date by date. The delivered rows are
        written once and read from there, unless they come from ``written`` tables.
        """
        if len(set(dates)) != len(dates):
            raise ValueError("a date may occur once per run")
        self.create()
        number = self.commit_number()
        before = self.commits.read(number)
        stored = {name: self.table(name, before) for name in ("chat_events", "surveys")}
        events = conform_delivery(events, stored["chat_events"].schema)
        surveys = conform_delivery(surveys, stored["surveys"].schema)
        events = events.where(F.col("source_date").isin(*dates))
        if not written:
            events = materialize(events, "load-delivered")
        survey_columns = stored["surveys"].schema.fieldNames()
        replaced = _replaced(stored["chat_events"], dates, replace_by)
        overtakes = any_overtaken(events, dates, replace_by)
        deletes = bool(replaced) or overtakes
        change = replace_dates(
            stored["chat_events"].read(replaced), stored["surveys"].read([]),
            events, surveys, dates, replace_by, overtakes,
            lambda chats: materialize(chats, "load-deleted-chats") if deletes else chats,
        )
        # Only the run's few dates are joined to these, so they aren't written once more.
        new_events = change.new_events.withColumn(
            "event_date", F.col("event_timestamp").cast("date")
        )
        deleted_chats, new_surveys = change.deleted_chats, change.new_surveys
        if deletes or not written:
            new_surveys = materialize(new_surveys, "load-surveys")
        event_parts = summaries(new_events, ["ingestion_date", "event_date"], ["event_id", "chat_id"])
        survey_parts = summaries(new_surveys, ["source_date"], ["survey_id", "chat_id"])

        old = stored["chat_events"].summaries_of(replaced)
        deleted_spans = spans_of([*old, *event_parts.values()], "chat_id")
        kept_events = self._kept_events(stored["chat_events"], replaced, event_parts)
        meeting = stored["surveys"].holding("chat_id", deleted_spans)
        losing = self._losing(stored["surveys"], meeting, deleted_chats)
        staged = Replacement(
            change.deleted_events,
            kept_events,
            new_events,
            deleted_chats,
            self._kept_surveys(stored["surveys"], survey_parts, deleted_chats),
            matching(stored["surveys"].read(meeting), "chat_id", deleted_chats),
            new_surveys,
        )
        checks = {name: _versions(before, name)[-1]["checks"] for name in stored}
        require(
            load_violations(staged, checks["chat_events"], checks["surveys"]),
            messages_of({**checks["chat_events"], **checks["surveys"]}),
        )
        self._require_dates(new_surveys, dates)

        state, folder = _copy(before), fresh_folder()
        for name in replaced:
            del state["parts"]["chat_events"][name]
        self._put(state, folder, "chat_events", new_events, event_parts)
        rewritten = stored["surveys"].read(losing).join(deleted_chats, "chat_id", "left_anti")
        rewritten = rewritten.select(*survey_columns).unionByName(new_surveys.select(*survey_columns))
        if losing:
            rewritten = materialize(rewritten, "load-rewritten-surveys")
            survey_parts = summaries(rewritten, ["source_date"], ["survey_id", "chat_id"])
        for name in losing:
            del state["parts"]["surveys"][name]
        self._put(state, folder, "surveys", rewritten, survey_parts)
        if rejects is not None:
            self._put_rejects(state, folder, rejects, dates)
        touched = self._touched_chats(staged)
        self._put(state, folder, "touched_chats", touched, {"": {}})
        spans = spans_of([*old, *event_parts.values(), *survey_parts.values()], "chat_id")
        state["touched"].append({"commit": number + 1, "folder": folder, "spans": spans})
        log = self._put_batch_log(state, folder, events, surveys, dates)
        self.commits.add(number + 1, state)
        return log

    def _kept_events(
        self, stored: StoredTable, replaced: list[str], new: dict[str, dict]
    ) -> DataFrame:
        """Stored events that stay and may share an id with a new one."""
        kept = [name for name in stored.parts if name not in replaced]
        return stored.read(stored.holding("event_id", spans_of(new.values(), "event_id"), kept))

    def _kept_surveys(
        self, stored: StoredTable, new: dict[str, dict], deleted_chats: DataFrame
    ) -> DataFrame:
        """Stored surveys that stay and may share an id or a chat with a new one."""
        names = {
            name
            for key in ("survey_id", "chat_id")
            for name in stored.holding(key, spans_of(new.values(), key))
        }
        rows = stored.read(sorted(names))
        return rows.join(deleted_chats, "chat_id", "left_anti").select(*rows.columns)

    def _losing(
        self, stored: StoredTable, names: list[str], deleted_chats: DataFrame
    ) -> list[str]:
        """The partitions, of these, that lose a survey: at most one row per date."""
        if not names:
            return []
        gone = matching(stored.read(names), "chat_id", deleted_chats)
        return sorted(str(day) for (day,) in gone.select("source_date").distinct().collect())

    def _require_dates(self, new_surveys: DataFrame, dates: Sequence[date]) -> None:
        """Surveys are stored per delivery, so each must name one of the run's dates."""
        stray = new_surveys.where(~F.coalesce(F.col("source_date").isin(*dates), F.lit(False)))
        if not stray.isEmpty():
            raise ValueError("a survey belongs to no date of the run")

    def _touched_chats(self, staged: Replacement) -> DataFrame:
        return (
            staged.deleted_chats.select("chat_id")
            .unionByName(staged.new_events.select("chat_id"))
            .unionByName(staged.new_surveys.select("chat_id"))
            .distinct()
        )

    def _put(
        self, state: dict, folder: str, name: str, rows: DataFrame, parts: dict[str, dict]
    ) -> None:
        """Write rows into their own folder and enter their partitions into ``state``.

        Rows are clustered by partition, chat and time.
        """
        if not parts:
            return
        _, partition, order, _ = TABLES[name]
        known = _versions(state, name)
        rows = rows.select(*versions.schema_of(known[-1]).fieldNames())
        if partition:
            rows = rows.repartitionByRange(*partition, *order)
            rows = rows.sortWithinPartitions(*partition, *order)
        rows.write.mode("errorifexists").option("compression", COMPRESSION).partitionBy(
            *partition
        ).parquet(f"{self.root}/{name}/load={folder}")
        for part, summary in parts.items():
            state["parts"][name].setdefault(part, {})[folder] = summary
        state["written"][name][folder] = len(parts)
        state.setdefault("under", {}).setdefault(name, {})[folder] = len(known) - 1

    def _put_rejects(
        self, state: dict, folder: str, rejects: DataFrame, dates: Sequence[date]
    ) -> None:
        rows = conform(rejects, versions.schema_of(_versions(state, "rejects")[-1]))
        rows = rows.where(F.col("source_date").isin(*dates))
        for day in dates:
            state["parts"]["rejects"].pop(str(day), None)
        self._put(state, folder, "rejects", rows, summaries(rows, ["source_date"], []))

    def _put_batch_log(
        self, state: dict, folder: str, events: DataFrame, surveys: DataFrame, dates: Sequence[date]
    ) -> DataFrame:
        last = state["last_batch_id"]
        rows = [(last + place, day) for place, day in enumerate(dates, start=1)]
        runs = self.spark.createDataFrame(rows, "batch_id bigint, source_date date")
        log = materialize(
            conform(
                batch_counts(events, surveys, runs).withColumn("loaded_at", F.current_timestamp()),
                BATCH_LOG,
            ),
            "load-log",
        )
        require(constraints.batch_log_fields(log), LOG_CONSTRAINTS)
        self._put(state, folder, "batch_log", log.coalesce(1), {"": {}} if rows else {})
        state["last_batch_id"] = last + len(rows)
        return log

    def drop_unused(self, keep: int = 2) -> None:
        """Delete commits before the last ``keep`` and folders that no kept one reads.

        No load may be running and readers must have moved on; what a load that died
        has left goes as well.
        """
        last = self.commits.last()
        states = [self.commits.read(n) for n in range(max(1, last - keep + 1), last + 1)]
        for name in TABLES:
            used = {f for s in states for p in s["parts"][name].values() for f in p}
            for entry in names_in(self.spark, f"{self.root}/{name}"):
                if entry.removeprefix("load=") not in used:
                    delete_folder(self.spark, f"{self.root}/{name}/{entry}")
        for number in range(1, last - keep + 1):
            delete_folder(self.spark, self.commits.path(number))


def replace_parts(table: StoredTable, parts: dict[str, dict[str, dict]]) -> StoredTable:
    return replace(table, parts={name: own for name, own in parts.items() if own})


def only_folders(table: StoredTable, folders: set[str]) -> StoredTable:
    """The table with no rows but those of some folders."""
    parts = {
        name: {folder: summary for folder, summary in own.items() if folder in folders}
        for name, own in table.parts.items()
    }
    return replace_parts(table, parts)


def _versions(state: dict, name: str) -> list[dict]:
    """The versions of a table; a state from before there were any has the first."""
    return state.get("versions", FIRST_STATE["versions"])[name]


def _copy(state: dict) -> dict:
    return json.loads(json.dumps(state))


def _replaced(stored: StoredTable, dates: Sequence[date], replace_by: str) -> list[str]:
    """Partitions of the dates that a run replaces."""
    place = 1 if replace_by == EVENT_DATE else 0
    days = {str(day) for day in dates}
    return [name for name in stored.parts if name.split("/")[place] in days]


def conform_delivery(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Delivered rows in the table's types, with their source date."""
    typed = T.StructType([*delivered_fields(schema), T.StructField("source_date", T.DateType())])
    return conform(df, typed)


def delivered_fields(schema: T.StructType) -> list[T.StructField]:
    """The columns of a table that its deliveries bring."""
    return [field for field in schema.fields if field.name not in ("event_date", "source_date")]


def batch_counts(events: DataFrame, surveys: DataFrame, runs: DataFrame) -> DataFrame:
    """Delivered surveys and events per source date; 0 for an empty delivery."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("source_date").agg(F.count("*").cast("int").alias(name))

    return (
        runs.join(counted(surveys, "source_chat_count"), "source_date", "left")
        .join(counted(events, "source_event_count"), "source_date", "left")
        .na.fill(0, ["source_chat_count", "source_event_count"])
    )
