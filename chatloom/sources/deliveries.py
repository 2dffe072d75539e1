"""JSON Lines deliveries of chat events and surveys.

Deliveries are written as ``<root>/{chat_logs,surveys}/source_date=YYYY-MM-DD``,
whether a run has one date or many. Other producers deliver a day as
``<root>/YYYY-MM-DD/{chat_logs,surveys}.jsonl``, a file or a folder of files;
the reader takes that too, but never both for one date.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CHAT_EVENTS, SURVEYS
from .folders import delete_folder, names_in

# Text formats of a delivery.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
DATE_FORMAT = "yyyy-MM-dd"
CORRUPT = "corrupt_record"
PARSING = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "timestampNTZFormat": TIMESTAMP_FORMAT,
    "dateFormat": DATE_FORMAT,
}
# Lines are written and read once; the usual level takes several times as long for little.
FAST_GZIP = ("zlib.compress.level", "BEST_SPEED")
NOT_ONE_OBJECT, NOT_JSON = "not one object", "not JSON"

EVENTS_NAME, SURVEYS_NAME = "chat_logs", "surveys"

REJECTS = T.StructType(
    [
        T.StructField("source_date", T.DateType()),
        T.StructField("source", T.StringType()),
        T.StructField("line", T.StringType()),
    ]
)
# With the file that the line came from, and why it was rejected.
EXPLAINED_REJECTS = T.StructType(
    [*REJECTS.fields, T.StructField("file", T.StringType()), T.StructField("reason", T.StringType())]
)


@dataclass(frozen=True)
class Deliveries:
    """Typed rows with their ``source_date``, and the lines that did not parse.

    ``outcomes`` has a row per line, accepted or rejected, for counts in one reading.
    """

    events: DataFrame
    surveys: DataFrame
    rejects: DataFrame
    outcomes: DataFrame


def _replace_days(
    rows: DataFrame,
    order: list[str],
    path: str,
    dates: Sequence[date],
    compression: str,
    tasks: int | None,
) -> None:
    """Write the rows of ``dates`` over what these dates had, and over nothing else."""
    names = sorted(name for name in rows.columns if name != "source_date")
    spark, there = rows.sparkSession, names_in(rows.sparkSession, path)
    before = [day for day in dates if f"source_date={day.isoformat()}" in there]
    many = () if tasks is None else (tasks,)
    in_order = rows.repartitionByRange(*many, *order).sortWithinPartitions(*order)
    (
        in_order.select("source_date", *names)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .option("compression", compression)
        .option(*FAST_GZIP)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .option("dateFormat", DATE_FORMAT)
        .partitionBy("source_date")
        .json(path)
    )
    # A dynamic overwrite leaves a date alone that gets no row.
    if before:
        dated = rows.select("source_date").where(F.col("source_date").isin(*before))
        filled = {row.source_date for row in dated.distinct().collect()}
        for day in before:
            if day not in filled:
                delete_folder(spark, f"{path}/source_date={day.isoformat()}")


def write_deliveries(
    events: DataFrame,
    surveys: DataFrame,
    root: str,
    dates: Sequence[date] | None = None,
    compression: str = "none",
    tasks: int | None = None,
) -> None:
    """Write the deliveries of ``dates``, or of all dates that the frames have.

    Both frames carry ``source_date``. Events are ordered by time, keys sorted and
    NULLs written out. Earlier deliveries of these dates are replaced, also by
    empty ones; other dates stay as they are. The reader takes compressed files too.
    ``tasks`` sort and write the rows; left alone, Spark chooses by what it shuffles, which
    is far smaller than the rows are when sorted.
    """
    if dates is not None:
        wanted = F.col("source_date").isin(*dates)
        events, surveys = events.where(wanted), surveys.where(wanted)
    by_time = ["source_date", "event_timestamp", "event_id"]
    how = (dates or [], compression, tasks)
    _replace_days(events, by_time, f"{root}/{EVENTS_NAME}", *how)
    _replace_days(surveys, ["source_date", "chat_id"], f"{root}/{SURVEYS_NAME}", *how)


def write_delivery(events: DataFrame, surveys: DataFrame, root: str, source_date: date) -> None:
    """Write one day's delivery; the frames may lack ``source_date``."""
    day = F.lit(source_date)
    write_deliveries(
        events.withColumn("source_date", day),
        surveys.withColumn("source_date", day),
        root,
        [source_date],
    )


def _delivered(spark: SparkSession, root: str, name: str) -> dict[date, str]:
    """Folder or file of every delivered date: one listing of each layout's parent."""
    found: dict[date, str] = {}
    for entry in names_in(spark, f"{root}/{name}"):
        if day := re.fullmatch(r"source_date=(\d{4}-\d{2}-\d{2})", entry):
            found[date.fromisoformat(day[1])] = f"{root}/{name}/{entry}"
    for entry in names_in(spark, root):
        if re.fullmatch(r"\d{4}-\d{2}-\d{2}", entry):
            if f"{name}.jsonl" not in names_in(spark, f"{root}/{entry}"):
                continue
            day = date.fromisoformat(entry)
            if day in found:
                raise ValueError(f"{name} of {day} is delivered in both layouts under {root}")
            found[day] = f"{root}/{entry}/{name}.jsonl"
    return found


def is_one_object(line: Column) -> Column:
    """Whether a line has exactly one pair of braces outside of strings, around it all.

    The records are flat, so that is one JSON object and nothing beside it. Strings
    go first, by a pattern without nested repetition, so long lines are safe. A line whose
    only braces are its first and last character needs one look.
    """
    plain = line.rlike(r"\A\{[^{}]*+\}\z")
    bare = F.regexp_replace(line, r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', "")
    return F.when(plain, True).otherwise(bare.rlike(r"^\s*\{[^{}]*\}\s*$"))


def _parsed(line: Column, fields: Sequence[T.StructField]) -> Column:
    corrupt = T.StructField(CORRUPT, T.StringType())
    return F.from_json(line, T.StructType([*fields, corrupt]), PARSING)


def reason_of(line: Column, schema: T.StructType) -> Column:
    """Why a line was rejected: it isn't one object, isn't JSON, or the names of the
    fields that don't fit their types.

    Each field is parsed on its own, so this is for lines that are known to be rejected.
    """

    def unfit(*fields: T.StructField) -> Column:
        return _parsed(line, fields)[CORRUPT].isNotNull()

    named = [F.when(unfit(field), F.lit(field.name)) for field in schema.fields]
    absent = T.StructField("_" + "_".join(schema.fieldNames()), T.StringType())
    return (
        F.when(~is_one_object(line), NOT_ONE_OBJECT)
        .when(unfit(absent), NOT_JSON)
        .otherwise(F.concat_ws(",", *named))
    )


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines with the ``source_date`` and the file that they came from.

    Where the folder is named for its date, that is one value per file and costs a line
    nothing; elsewhere the date is found in the path of every line.
    """
    own_folder = re.compile(r"(.*)/source_date=[^/]*")
    file = F.col("_metadata.file_path").alias("file")
    parts = []
    for base in sorted({found[1] for path in paths if (found := own_folder.fullmatch(path))}):
        own = [path for path in paths if (found := own_folder.fullmatch(path)) and found[1] == base]
        rows = spark.read.option("basePath", base).text(own)
        # Without a file there is no partition either.
        day = F.col("source_date") if "source_date" in rows.columns else F.lit(None)
        parts.append(rows.select("value", day.cast("date").alias("source_date"), file))
    others = [path for path in paths if not own_folder.fullmatch(path)]
    if others:
        day = F.regexp_extract(F.col("_metadata.file_path"), r".*(\d{4}-\d{2}-\d{2})/", 1)
        rows = spark.read.text(others)
        parts.append(rows.select("value", F.to_date(day, DATE_FORMAT).alias("source_date"), file))
    return reduce(DataFrame.unionByName, parts)


def _read(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Parsed rows with ``corrupt_record`` set where the line does not fit.

    Lines are read as text and parsed whole. The JSON source parses only the
    columns a query uses, so a line could be good or bad depending on the query;
    and it takes the first object of a line that has several.
    """
    if not paths:
        nothing = T.StructType(
            [
                *schema.fields,
                T.StructField(CORRUPT, T.StringType()),
                T.StructField("source_date", T.DateType()),
                T.StructField("file", T.StringType()),
            ]
        )
        return spark.createDataFrame([], nothing)
    line = F.col("value")
    # A filter on the result would be moved below a projection and parse every line again;
    # it stays above a generator.
    once = F.struct(
        _parsed(line, schema.fields).alias("row"),
        F.when(~is_one_object(line), line).alias("broken"),
    )
    return (
        _lines(spark, paths)
        .where(F.trim("value") != "")
        .select("source_date", "file", F.inline(F.array(once)))
        .select(
            *[F.col(f"row.{name}") for name in schema.fieldNames()],
            F.coalesce("broken", f"row.{CORRUPT}").alias(CORRUPT),
            "source_date",
            "file",
        )
    )


def read_deliveries(
    spark: SparkSession,
    root: str,
    dates: Iterable[date] | None = None,
    event_schema: T.StructType = CHAT_EVENTS,
    survey_schema: T.StructType = SURVEYS,
) -> Deliveries:
    """Read the deliveries of ``dates``, or of all days.

    A table with further columns passes its ``RawLayer.delivery_schema``.

    A line that does not fit the schema, or is anything but one object, is
    rejected as a whole: it would otherwise load with its bad field silently
    NULL, or lose what follows the first object. A reject has its line, file and reason.
    """
    wanted = None if dates is None else set(dates)

    def paths(name: str) -> list[str]:
        found = _delivered(spark, root, name)
        return [path for day, path in sorted(found.items()) if wanted is None or day in wanted]

    events = _read(spark, paths(EVENTS_NAME), event_schema)
    surveys = _read(spark, paths(SURVEYS_NAME), survey_schema)

    def rejected(df: DataFrame, name: str, schema: T.StructType) -> DataFrame:
        return df.where(F.col(CORRUPT).isNotNull()).select(
            "source_date",
            F.lit(name).alias("source"),
            F.col(CORRUPT).alias("line"),
            "file",
            reason_of(F.col(CORRUPT), schema).alias("reason"),
        )

    def accepted(df: DataFrame) -> DataFrame:
        return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT, "file")

    def outcome(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            "source_date",
            F.lit(name).alias("source"),
            F.col(CORRUPT).isNotNull().alias("rejected"),
        )

    return Deliveries(
        accepted(events),
        accepted(surveys),
        rejected(events, EVENTS_NAME, event_schema).unionByName(
            rejected(surveys, SURVEYS_NAME, survey_schema)
        ),
        outcome(events, EVENTS_NAME).unionByName(outcome(surveys, SURVEYS_NAME)),
    )
