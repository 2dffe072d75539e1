"""The batch run: choose dates, load, check, refresh the mart."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import constraints, dimensions
from ..operators.fact import fact_source, synchronise, with_dimension_keys
from ..operators.gate import MART_CONSTRAINTS, require, source_gate
from ..operators.lookup import matching
from ..operators.profile import chat_profile
from ..operators.replacement import EVENT_DATE
from ..session import materialize, scratch_scope
from ..sources.commits import CommitConflict, MissingTable
from ..sources.deliveries import write_deliveries
from ..sources.raw_layer import RawLayer
from .mart import Mart, Published, build_mart, publish_mart, published

# How often a refresh that another one overtakes is tried in all.
REFRESH_ATTEMPTS = 3


def select_dates(
    last_days: int | None = None,
    start: date | None = None,
    end: date | None = None,
    day: date | None = None,
    today: date | None = None,
) -> list[date]:
    """Dates of a run: the last N days, else a closed range, else one day, else today.

    A range needs both ends; a reversed one selects nothing.
    """
    today = today or date.today()
    if last_days:
        return [today - timedelta(days=back) for back in range(last_days - 1, -1, -1)]
    if start and end:
        return [start + timedelta(days=step) for step in range((end - start).days + 1)]
    return [day or today]


@dataclass(frozen=True)
class RunTotals:
    days: int
    events: int
    surveys: int


def run_totals(batch_log: DataFrame) -> DataFrame:
    return batch_log.agg(
        F.count("*").alias("days"),
        F.coalesce(F.sum("source_event_count"), F.lit(0)).alias("events"),
        F.coalesce(F.sum("source_chat_count"), F.lit(0)).alias("surveys"),
    )


def mart_violations(source: DataFrame, mart: Mart) -> DataFrame:
    """Rules K10-K14 on what a refresh is about to publish.

    ``source`` has the new fact rows with natural keys, ``mart`` the merged
    dimensions and the new fact rows with their keys.
    """
    found = constraints.fact_chats(source).unionByName(constraints.fact_rows(source))
    for name, keys in constraints.NATURAL_KEYS.items():
        found = found.unionByName(constraints.dimension_keys(getattr(mart, name), *keys))
    for dimension, key in (
        (mart.dim_date, "date_key"),
        (mart.dim_agent, "agent_key"),
        (mart.dim_resolution_type, "resolution_type_key"),
        (mart.dim_survey_response, "survey_response_key"),
    ):
        orphans = constraints.foreign_key(mart.fact_chat_resolution, dimension, key)
        found = found.unionByName(orphans)
    return found


def _last_consistent(raw: RawLayer, mart_root: str) -> Published | None:
    """The mart published last; a raw layer older than what it shows has lost commits."""
    old = published(raw.spark, mart_root)
    if old is not None and old.raw_commit > raw.commit_number():
        raise MissingTable(f"{raw.root} is behind {mart_root}: commits of loads are lost")
    return old


def pending_chats(raw: RawLayer, mart_root: str) -> DataFrame:
    """Chats that loads have touched since the mart was refreshed last."""
    old = published(raw.spark, mart_root)
    return raw.touched_since(old.raw_commit if old else 0)[0]


def _unless_overtaken(attempt: Callable[[RawLayer, str], None], raw: RawLayer, root: str) -> None:
    """Run a refresh; one that another refresh overtook starts again from its result."""
    for left in reversed(range(REFRESH_ATTEMPTS)):
        try:
            return attempt(raw.pinned(), root)
        except CommitConflict:
            if not left:
                raise


def refresh(raw: RawLayer, mart_root: str) -> None:
    """Check the whole raw layer and rebuild the mart from it.

    The profile is written once; gate and fact both read it. A broken rule of
    the gate or of the mart raises before anything is published. Rows that a load
    adds meanwhile are left to the next refresh, which finds them pending.
    """
    _unless_overtaken(_refresh_all, raw, mart_root)


def _refresh_all(raw: RawLayer, mart_root: str) -> None:
    last = _last_consistent(raw, mart_root)
    events, surveys = raw.events(), raw.surveys()
    profile = materialize(chat_profile(events, surveys), "profile")
    source_gate.check(events, surveys, profile)
    old, highest = (last.mart(), last.highest_key) if last else (None, None)
    mart = build_mart(events, surveys, old, profile, highest).materialized("refreshed")
    require(mart_violations(fact_source(profile), mart), MART_CONSTRAINTS)
    publish_mart(mart, mart_root, last, raw.commit_number())


def refresh_touched(raw: RawLayer, mart_root: str) -> None:
    """Check and recompute only the chats that loads have touched.

    All rules of the gate concern single chats and the other chats passed
    before, so the result equals a full refresh. Only the date partitions in
    which a touched chat was or now is are written anew, in a new version that
    takes the others over from the versions before. What is read is bounded by the
    spans of the touched chats: partitions of events, surveys and fact whose spans
    they don't meet are not opened, and the highest key comes from the version.
    """
    _unless_overtaken(_refresh_touched, raw, mart_root)


def _refresh_touched(raw: RawLayer, mart_root: str) -> None:
    last = _last_consistent(raw, mart_root)
    if last is None:
        return _refresh_all(raw, mart_root)
    old = last.mart()
    touched, spans = raw.touched_since(last.raw_commit)
    touched = materialize(touched, "touched")
    # The touched chats' rows are read out once.
    events = materialize(matching(raw.events_of(spans), "chat_id", touched), "touched-events")
    surveys = materialize(matching(raw.surveys_of(spans), "chat_id", touched), "touched-surveys")
    profile = materialize(chat_profile(events, surveys), "touched-profile")
    source_gate.check(events, surveys, profile)

    dim_date = materialize(
        dimensions.merge_dates(old.dim_date, dimensions.dates_of(events)), "dim-date"
    )
    dim_agent = materialize(
        dimensions.merge_agents(old.dim_agent, dimensions.agents_of(events)), "dim-agent"
    )
    keyed = with_dimension_keys(
        fact_source(profile), dim_agent, old.dim_resolution_type, old.dim_survey_response
    )
    fact = last.fact_table()
    former = matching(fact.read(fact.holding("chat_id", spans)), "chat_id", touched)
    former = materialize(former, "touched-fact")
    fresh = materialize(synchronise(former, keyed, last.highest_key), "fresh-fact")
    changed = Mart(dim_date, dim_agent, old.dim_resolution_type, old.dim_survey_response, fresh)
    require(mart_violations(fact_source(profile), changed), MART_CONSTRAINTS)

    def days(df: DataFrame) -> set[str]:
        return {str(row.date_key) for row in df.select("date_key").distinct().collect()}

    rewritten = days(former) | days(fresh)
    staged = (
        fact.read(sorted(rewritten & fact.parts.keys()))
        .join(touched, "chat_id", "left_anti")
        .select(*fact.schema.fieldNames())
        .unionByName(fresh)
        .repartitionByRange("date_key", "chat_id")
    )
    kept = [day for day in fact.parts if day not in rewritten]
    changed = replace(changed, fact_chat_resolution=staged)
    publish_mart(changed, mart_root, last, raw.commit_number(), kept)


def run_batch(
    spark: SparkSession,
    root: str,
    events: DataFrame,
    surveys: DataFrame,
    dates: Sequence[date],
    replace_by: str = EVENT_DATE,
    backup_root: str | None = None,
    full_refresh: bool = False,
    rejects: DataFrame | None = None,
    written: bool = False,
) -> RunTotals:
    """Load the deliveries of ``dates``, then check and refresh once.

    ``events`` and ``surveys`` carry ``source_date``; they are parsed once and
    read from the written result after that, unless they are plain selections from
    ``written`` tables already. With ``backup_root`` the deliveries
    of these dates replace their backups. ``rejects`` are the lines that did not
    parse; they are kept with the raw layer. The raw load stays when the gate
    fails; the mart then keeps its former state.
    """
    raw = RawLayer(spark, f"{root}/raw")
    raw.create()
    wanted = F.col("source_date").isin(*dates)
    totals = RunTotals(0, 0, 0)
    with scratch_scope(spark):
        if dates:
            events = raw.delivered(events.where(wanted), "chat_events")
            surveys = raw.delivered(surveys.where(wanted), "surveys")
            if not written:
                events = materialize(events, "delivered-events")
                surveys = materialize(surveys, "delivered-surveys")
            if backup_root:
                write_deliveries(events, surveys, backup_root, dates)
            log = raw.load(events, surveys, dates, replace_by, rejects, written=True)
            totals = RunTotals(**run_totals(log).first().asDict())
        if full_refresh:
            refresh(raw, f"{root}/mart")
        else:
            refresh_touched(raw, f"{root}/mart")
    return totals
