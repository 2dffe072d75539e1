"""Table schemas and the fixed vocabulary of the chat log."""

from __future__ import annotations

from pyspark.sql import types as T

# Event vocabulary.
STARTED = "chat_started"
QUEUED = "chat_entered_queue"
ASSIGNED = "agent_assignment"
AGENT_REPLY = "agent_responded"
CUSTOMER_REPLY = "customer_responded"
CLOSED_BY_AGENT = "chat_closed_by_agent"
CLOSED_BY_CUSTOMER = "customer_closed_chat"
PUSHED = "chat_pushed_to_queue_due_inactivity"
CLOSED_BY_SYSTEM = "system_closed_chat_after_inactivity"

EVENT_TYPES = (
    STARTED,
    QUEUED,
    ASSIGNED,
    AGENT_REPLY,
    CUSTOMER_REPLY,
    CLOSED_BY_AGENT,
    CLOSED_BY_CUSTOMER,
    PUSHED,
    CLOSED_BY_SYSTEM,
)
WITHOUT_AGENT = (STARTED, QUEUED, CUSTOMER_REPLY, CLOSED_BY_CUSTOMER, CLOSED_BY_SYSTEM)
WITH_AGENT = (ASSIGNED, AGENT_REPLY, CLOSED_BY_AGENT, PUSHED)
AGENT_ACTIVITY = (AGENT_REPLY, CLOSED_BY_AGENT, PUSHED)
CLOSURES = (CLOSED_BY_AGENT, CLOSED_BY_CUSTOMER, CLOSED_BY_SYSTEM)
SURVEY_INPUTS = ("satisfied", "dissatisfied")

# Seed rows of the two small dimensions.
RESOLUTION_TYPES = (
    (1, CLOSED_BY_AGENT, "Closed by Agent"),
    (2, CLOSED_BY_CUSTOMER, "Closed by Customer"),
    (3, CLOSED_BY_SYSTEM, "System Closed After Inactivity"),
)
SURVEY_RESPONSES = (
    (1, "satisfied", "Satisfied", True),
    (2, "dissatisfied", "Dissatisfied", True),
    (3, "no_response", "No Response", False),
    (4, "skipped", "Skipped", False),
)

# Service levels, capacity and the inactivity delay.
FIRST_RESPONSE_SLA = "INTERVAL '5' MINUTE"
RESOLUTION_SLA = "INTERVAL '60' MINUTE"
INACTIVITY_DELAY = "INTERVAL '1' HOUR"
MAX_OPEN_CHATS_PER_AGENT = 2
UNASSIGNED = "Unassigned"


def _fields(*columns: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(*column) for column in columns])


CHAT_EVENTS = _fields(
    ("event_id", T.StringType(), True),
    ("chat_id", T.StringType(), True),
    ("agent_id", T.IntegerType(), True),
    ("event_type", T.StringType(), True),
    ("event_timestamp", T.TimestampNTZType(), True),
    ("ingestion_date", T.DateType(), True),
)
SURVEYS = _fields(
    ("survey_id", T.StringType(), True),
    ("chat_id", T.StringType(), True),
    ("survey_skipped", T.BooleanType(), True),
    ("customer_input", T.StringType(), True),
)
BATCH_LOG = _fields(
    ("batch_id", T.LongType(), False),
    ("source_date", T.DateType(), False),
    ("source_chat_count", T.IntegerType(), False),
    ("source_event_count", T.IntegerType(), False),
    ("loaded_at", T.TimestampType(), False),
)
DIM_DATE = _fields(
    ("date_key", T.IntegerType(), False),
    ("full_date", T.DateType(), False),
    ("day_of_week", T.ShortType(), False),
    ("day_name", T.StringType(), False),
    ("month_number", T.ShortType(), False),
    ("month_name", T.StringType(), False),
    ("quarter_number", T.ShortType(), False),
    ("year_number", T.ShortType(), False),
    ("is_weekend", T.BooleanType(), False),
)
DIM_AGENT = _fields(
    ("agent_key", T.LongType(), False),
    ("agent_id", T.IntegerType(), False),
    ("agent_name", T.StringType(), False),
    ("support_team", T.StringType(), False),
)
DIM_RESOLUTION_TYPE = _fields(
    ("resolution_type_key", T.IntegerType(), False),
    ("resolution_code", T.StringType(), False),
    ("resolution_label", T.StringType(), False),
)
DIM_SURVEY_RESPONSE = _fields(
    ("survey_response_key", T.IntegerType(), False),
    ("response_code", T.StringType(), False),
    ("response_label", T.StringType(), False),
    ("is_answered", T.BooleanType(), False),
)
FACT_CHAT_RESOLUTION = _fields(
    ("chat_fact_key", T.LongType(), False),
    ("chat_id", T.StringType(), False),
    ("date_key", T.IntegerType(), False),
    ("agent_key", T.LongType(), True),
    ("resolution_type_key", T.IntegerType(), False),
    ("survey_response_key", T.IntegerType(), False),
    ("started_at", T.TimestampNTZType(), False),
    ("entered_queue_at", T.TimestampNTZType(), True),
    ("assigned_at", T.TimestampNTZType(), True),
    ("first_agent_response_at", T.TimestampNTZType(), True),
    ("closed_at", T.TimestampNTZType(), False),
    ("ingestion_date", T.DateType(), False),
    ("queue_wait_seconds", T.IntegerType(), True),
    ("first_response_seconds", T.IntegerType(), True),
    ("resolution_seconds", T.IntegerType(), False),
    ("agent_response_count", T.IntegerType(), False),
    ("customer_response_count", T.IntegerType(), False),
    ("pushed_due_to_inactivity", T.BooleanType(), False),
    ("first_response_sla_met", T.BooleanType(), True),
    ("resolution_sla_met", T.BooleanType(), False),
    ("satisfied_flag", T.BooleanType(), True),
)


def conform(df, schema: T.StructType):
    """Select and cast ``df`` to ``schema``; columns it lacks become NULL."""
    from pyspark.sql import functions as F

    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
