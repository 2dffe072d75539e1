"""The star schema: building, publishing and reading it."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import dimensions
from ..operators.fact import fact_source, synchronise, with_dimension_keys
from ..operators.profile import chat_profile
from ..schemas import (
    DIM_AGENT,
    DIM_DATE,
    DIM_RESOLUTION_TYPE,
    DIM_SURVEY_RESPONSE,
    FACT_CHAT_RESOLUTION,
)
from ..session import COMPRESSION, materialize
from .daily_sums import DAILY_SUMS, daily_sums
from ..sources.commits import Commits, StoredTable, fresh_folder, summaries
from ..sources.folders import delete_folder, names_in

FACT = "fact_chat_resolution"
SUMS = "daily_sums"


@dataclass(frozen=True)
class Mart:
    dim_date: DataFrame
    dim_agent: DataFrame
    dim_resolution_type: DataFrame
    dim_survey_response: DataFrame
    fact_chat_resolution: DataFrame

    def materialized(self, label: str) -> Mart:
        """The same mart read back from the scratch folder.

        Written tables have known sizes, so joins with small dimensions are
        planned as broadcasts from the start.
        """
        return Mart(
            **{f.name: materialize(getattr(self, f.name), f"{label}-{f.name}") for f in fields(Mart)}
        )


SCHEMAS = {
    "dim_date": DIM_DATE,
    "dim_agent": DIM_AGENT,
    "dim_resolution_type": DIM_RESOLUTION_TYPE,
    "dim_survey_response": DIM_SURVEY_RESPONSE,
    FACT: FACT_CHAT_RESOLUTION,
}


def build_mart(
    events: DataFrame,
    surveys: DataFrame,
    old: Mart | None = None,
    profile: DataFrame | None = None,
    highest_key: int | None = None,
) -> Mart:
    """Dimensions and fact for the whole raw layer, keeping the keys of ``old``.

    The raw layer must have passed the gate. Pass ``profile`` when it is
    already written, and ``highest_key`` when the old fact's is known.
    """
    spark = events.sparkSession
    profile = chat_profile(events, surveys) if profile is None else profile
    agents = dimensions.merge_agents(old and old.dim_agent, dimensions.agents_of(events))
    # Fresh agent keys depend on the layout of the job that numbers them, so
    # they are written once and every reader takes them from there.
    agents = materialize(agents, "dim-agent")
    resolutions = dimensions.resolution_types(spark)
    responses = dimensions.survey_responses(spark)
    keyed = with_dimension_keys(fact_source(profile), agents, resolutions, responses)
    return Mart(
        dim_date=dimensions.merge_dates(old and old.dim_date, dimensions.dates_of(events)),
        dim_agent=agents,
        dim_resolution_type=resolutions,
        dim_survey_response=responses,
        fact_chat_resolution=synchronise(old and old.fact_chat_resolution, keyed, highest_key),
    )


def natural_fact(mart: Mart) -> DataFrame:
    """Fact rows with natural keys in place of the surrogate ones."""
    return (
        mart.fact_chat_resolution.join(mart.dim_agent.select("agent_key", "agent_id"), "agent_key", "left")
        .join(
            mart.dim_resolution_type.select("resolution_type_key", "resolution_code"),
            "resolution_type_key",
        )
        .join(
            mart.dim_survey_response.select("survey_response_key", "response_code"),
            "survey_response_key",
        )
        .drop("chat_fact_key", "agent_key", "resolution_type_key", "survey_response_key")
    )


def _versions(spark: SparkSession, root: str) -> Commits:
    return Commits(spark, f"{root}/versions")


def current_version(spark: SparkSession, root: str) -> int | None:
    """The version published last, None before the first one.

    Versions that are gone while tables of theirs remain are an error: a mart
    that began anew would hand out keys a second time.
    """
    commits = _versions(spark, root)
    number = commits.last()
    if not number:
        commits.require_none(root, ["dimensions", FACT, SUMS])
    return number or None


@dataclass(frozen=True)
class Published:
    """A version of the mart and what its commit says of it.

    ``highest_key`` is the highest ``chat_fact_key`` handed out so far, and
    ``raw_commit`` the commit of the raw layer that the version shows: loads up to
    it are consumed.
    """

    spark: SparkSession
    root: str
    number: int
    state: dict

    @property
    def highest_key(self) -> int:
        return self.state["highest_key"]

    @property
    def raw_commit(self) -> int:
        return self.state["raw_commit"]

    def _by_date(self, name: str, schema: T.StructType) -> StoredTable:
        return StoredTable(
            self.spark,
            f"{self.root}/{name}",
            schema,
            ["date_key"],
            self.state["dates"],
            self.state["written"],
        )

    def fact_table(self) -> StoredTable:
        return self._by_date(FACT, FACT_CHAT_RESOLUTION)

    def daily_sums(self) -> DataFrame:
        """The sums of every date, each written with the date's fact rows."""
        return self._by_date(SUMS, DAILY_SUMS).read()

    def mart(self) -> Mart:
        base = dimensions_path(self.root, self.state)
        tables = {
            name: _strict(self.spark, f"{base}/{name}", schema)
            for name, schema in SCHEMAS.items()
            if name != FACT
        }
        return Mart(**tables, **{FACT: self.fact_table().read()})


def dimensions_path(root: str, state: dict) -> str:
    return f"{root}/dimensions/load={state['folder']}"


def _strict(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table that a published version must have: a missing one is an error."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def published(spark: SparkSession, root: str, number: int | None = None) -> Published | None:
    """The version published last, or that of a number; None if there is none yet."""
    number = number or current_version(spark, root)
    if number is None:
        return None
    return Published(spark, root, number, _versions(spark, root).read(number))


def load_mart(spark: SparkSession, root: str) -> Mart | None:
    """The mart that was published last, or None if there is none yet."""
    last = published(spark, root)
    return None if last is None else last.mart()


def publish_mart(
    mart: Mart, root: str, old: Published | None, raw_commit: int, kept: list[str] | None = None
) -> int:
    """Publish the dimensions and the fact rows of ``mart`` as the version after ``old``.

    ``kept`` are dates of the fact that stay as earlier versions wrote them; the
    mart's fact has the rows of all others. Rows go into folders of this call's
    own; then one commit makes them the current version and the loads up to
    ``raw_commit`` consumed. A job that dies before leaves the former version
    current, and ``CommitConflict`` tells that another refresh came first.
    """
    spark = mart.fact_chat_resolution.sparkSession
    folder = fresh_folder()
    state = {"folder": folder, "raw_commit": raw_commit}
    for name in SCHEMAS:
        if name != FACT:
            getattr(mart, name).write.mode("errorifexists").parquet(
                f"{dimensions_path(root, state)}/{name}"
            )
    path = f"{root}/{FACT}/load={folder}"
    mart.fact_chat_resolution.write.mode("errorifexists").option(
        "compression", COMPRESSION
    ).partitionBy("date_key").parquet(path)
    rows = _strict(spark, path, FACT_CHAT_RESOLUTION)
    daily_sums(rows).repartition("date_key").write.mode("errorifexists").partitionBy(
        "date_key"
    ).parquet(f"{root}/{SUMS}/load={folder}")
    own = summaries(rows, ["date_key"], ["chat_id", "chat_fact_key"])
    before = old.state if old else {"dates": {}, "written": {}, "highest_key": 0}
    state["dates"] = {day: before["dates"][day] for day in kept or []}
    state["dates"] |= {day: {folder: summary} for day, summary in own.items()}
    used = {f for folders in state["dates"].values() for f in folders}
    written = {**before["written"], folder: len(own)}
    state["written"] = {f: many for f, many in written.items() if f in used}
    highest = (summary["chat_fact_key"][1] for summary in own.values())
    state["highest_key"] = max([before["highest_key"], *highest])
    number = old.number + 1 if old else 1
    _versions(spark, root).add(number, state)
    return number


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete what only versions before the last ``keep`` use, and what refreshes that
    died have left; readers must have moved on and no refresh may be running."""
    current = current_version(spark, root)
    if current is None:
        return
    commits = _versions(spark, root)
    states = [commits.read(n) for n in range(max(1, current - keep + 1), current + 1)]
    dimensions_ = {state["folder"] for state in states}
    used = {folder for s in states for folders in s["dates"].values() for folder in folders}
    for entry in names_in(spark, f"{root}/dimensions"):
        if entry.removeprefix("load=") not in dimensions_:
            delete_folder(spark, f"{root}/dimensions/{entry}")
    for table in (FACT, SUMS):
        for entry in names_in(spark, f"{root}/{table}"):
            if entry.removeprefix("load=") not in used:
                delete_folder(spark, f"{root}/{table}/{entry}")
    for number in range(1, current - keep + 1):
        delete_folder(spark, commits.path(number))


def register_views(mart: Mart) -> None:
    """Expose the mart tables to ``spark.sql`` under their names."""
    for f in fields(Mart):
        getattr(mart, f.name).createOrReplaceTempView(f.name)
