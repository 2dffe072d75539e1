"""One DuckDB statement per registered query.

Rules are written with window functions over the events of a chat and with set
operations, on purpose unlike the grouped aggregates of the Spark side.
"""

from __future__ import annotations

from .fixture_sql import with_fixture

_SECONDS = "CAST((epoch_us({b})-epoch_us({a})+500000)//1000000 AS INT)"


def _seconds(a: str, b: str) -> str:
    return _SECONDS.format(a=a, b=b)


def _avg_minutes(x: str) -> str:
    return f"CAST((200*CAST(SUM({x}) AS BIGINT)+60*COUNT({x}))//NULLIF(120*COUNT({x}),0) AS DOUBLE)/100"


def _minutes(x: str) -> str:
    return f"CAST((200*CAST({x} AS BIGINT)+60)//120 AS DOUBLE)/100"


def _pct(n: str, d: str) -> str:
    return f"CAST((20000*({n})+({d}))//NULLIF(2*({d}),0) AS DOUBLE)/100"


def _moment(event_type: str, pick: str = "MIN") -> str:
    return f"{pick}(CASE WHEN event_type='{event_type}' THEN event_timestamp END)"


def _times(event_type: str) -> str:
    return f"SUM(CASE WHEN event_type='{event_type}' THEN 1 ELSE 0 END)"


_CLOSINGS = "SUM(CASE WHEN event_type IN CLOSURES THEN 1 ELSE 0 END)"
_CLOSED_AT = "MIN(CASE WHEN event_type IN CLOSURES THEN event_timestamp END)"


def _rollup(events: str) -> str:
    return f"""
milestones AS (
 SELECT chat_id, {_CLOSINGS} AS closings, {_CLOSED_AT} AS closed_at,
  {_moment('chat_started')} AS started_at, {_moment('chat_entered_queue')} AS entered_queue_at,
  {_moment('agent_assignment')} AS assigned_at, {_moment('agent_responded')} AS first_agent_response_at,
  MAX(CASE WHEN event_type IN CLOSURES THEN event_type END) AS resolution_code,
  MAX(CASE WHEN event_type='agent_assignment' THEN agent_id END) AS assigned_agent_id,
  CAST({_times('agent_responded')} AS INT) AS agent_response_count,
  CAST({_times('customer_responded')} AS INT) AS customer_response_count,
  {_times('chat_pushed_to_queue_due_inactivity')}>0 AS pushed_due_to_inactivity,
  MAX(ingestion_date) AS ingestion_date
 FROM {events} GROUP BY chat_id),
rollup AS (SELECT * EXCLUDE (closings) FROM milestones WHERE closings=1)"""


def _fact(events: str, surveys: str) -> str:
    return (
        _rollup(events)
        + f""",
fact AS (
 SELECT r.chat_id,
  CAST(year(started_at)*10000+month(started_at)*100+day(started_at) AS INT) AS date_key,
  assigned_agent_id AS agent_id, resolution_code,
  CASE WHEN survey_skipped THEN 'skipped' ELSE COALESCE(customer_input,'no_response') END AS response_code,
  started_at, entered_queue_at, assigned_at, first_agent_response_at, closed_at, ingestion_date,
  {_seconds('entered_queue_at', 'assigned_at')} AS queue_wait_seconds,
  {_seconds('assigned_at', 'first_agent_response_at')} AS first_response_seconds,
  {_seconds('started_at', 'closed_at')} AS resolution_seconds,
  agent_response_count, customer_response_count, pushed_due_to_inactivity,
  first_agent_response_at - assigned_at <= INTERVAL '5 minutes' AS first_response_sla_met,
  closed_at - started_at <= INTERVAL '60 minutes' AS resolution_sla_met,
  CASE WHEN customer_input IN ('satisfied','dissatisfied') THEN customer_input='satisfied' END AS satisfied_flag
 FROM rollup r JOIN {surveys} s ON s.chat_id=r.chat_id
 WHERE survey_skipped OR customer_input IS NULL OR customer_input IN ('satisfied','dissatisfied'))"""
    )


_DIMS = """
dim_date AS (
 SELECT DISTINCT CAST(year(d)*10000+month(d)*100+day(d) AS INT) AS date_key, d AS full_date,
  CAST(isodow(d) AS SMALLINT) AS day_of_week, dayname(d) AS day_name,
  CAST(month(d) AS SMALLINT) AS month_number, monthname(d) AS month_name,
  CAST(quarter(d) AS SMALLINT) AS quarter_number, CAST(year(d) AS SMALLINT) AS year_number,
  isodow(d) IN (6,7) AS is_weekend
 FROM (SELECT CAST(event_timestamp AS DATE) AS d FROM clean WHERE event_type='chat_started')),
teams AS (SELECT * FROM (VALUES (0,'Billing Support'),(1,'Account Support'),(2,'Technical Support')) v(residue,support_team)),
dim_agent AS (
 SELECT agent_id, concat('Agent ', CAST(agent_id AS VARCHAR)) AS agent_name, support_team
 FROM (SELECT DISTINCT agent_id FROM clean WHERE event_type='agent_assignment') JOIN teams ON residue=agent_id%3),
dim_resolution_type AS (
 SELECT * FROM (VALUES ('chat_closed_by_agent','Closed by Agent'),('customer_closed_chat','Closed by Customer'),
  ('system_closed_chat_after_inactivity','System Closed After Inactivity')) v(resolution_code,resolution_label)),
dim_survey_response AS (
 SELECT * FROM (VALUES ('satisfied','Satisfied',TRUE),('dissatisfied','Dissatisfied',TRUE),
  ('no_response','No Response',FALSE),('skipped','Skipped',FALSE)) v(response_code,response_label,is_answered))"""

_REPORTS = f"""
detail AS (
 SELECT f.chat_id, d.full_date AS chat_date, day_name, month_name, quarter_number, year_number,
  COALESCE(CAST(a.agent_id AS VARCHAR),'Unassigned') AS agent_id, COALESCE(agent_name,'Unassigned') AS agent_name,
  COALESCE(support_team,'Unassigned') AS support_team, resolution_label, response_label AS survey_response,
  started_at, entered_queue_at, assigned_at, first_agent_response_at, closed_at,
  queue_wait_seconds, {_minutes('queue_wait_seconds')} AS queue_wait_minutes,
  first_response_seconds, {_minutes('first_response_seconds')} AS first_response_minutes,
  resolution_seconds, {_minutes('resolution_seconds')} AS resolution_minutes,
  agent_response_count, customer_response_count, pushed_due_to_inactivity,
  first_response_sla_met, resolution_sla_met, satisfied_flag
 FROM fact f JOIN dim_date d USING (date_key) LEFT JOIN dim_agent a ON a.agent_id=f.agent_id
 JOIN dim_resolution_type USING (resolution_code) JOIN dim_survey_response USING (response_code)),
kpi AS (
 SELECT chat_date, support_team, COUNT(*) AS resolved_chats,
  CAST(COUNT_IF(agent_id='Unassigned') AS BIGINT) AS unassigned_chats,
  COUNT(first_agent_response_at) AS responded_chats,
  {_avg_minutes('queue_wait_seconds')} AS avg_queue_wait_minutes,
  {_avg_minutes('first_response_seconds')} AS avg_first_response_minutes,
  {_avg_minutes('resolution_seconds')} AS avg_resolution_minutes,
  {_pct('COUNT_IF(first_response_sla_met)', 'COUNT(first_response_sla_met)')} AS first_response_sla_pct,
  {_pct('COUNT_IF(resolution_sla_met)', 'COUNT(*)')} AS resolution_sla_pct,
  {_pct('COUNT(satisfied_flag)', 'COUNT(*)')} AS survey_response_rate_pct,
  {_pct('COUNT_IF(satisfied_flag)', 'COUNT(satisfied_flag)')} AS csat_pct,
  CAST(COUNT_IF(pushed_due_to_inactivity) AS BIGINT) AS inactivity_closures
 FROM detail GROUP BY chat_date, support_team),
agent_days AS (
 SELECT chat_date, CAST(agent_id AS INT) AS agent_id, agent_name, support_team, COUNT(*) AS resolved_chats,
  {_avg_minutes('queue_wait_seconds')} AS avg_queue_wait_minutes,
  {_avg_minutes('first_response_seconds')} AS avg_first_response_minutes,
  {_avg_minutes('resolution_seconds')} AS avg_resolution_minutes,
  {_pct('COUNT_IF(first_response_sla_met)', 'COUNT(first_response_sla_met)')} AS first_response_sla_pct,
  {_pct('COUNT_IF(satisfied_flag)', 'COUNT(satisfied_flag)')} AS csat_pct
 FROM detail WHERE agent_id<>'Unassigned' GROUP BY chat_date, agent_id, agent_name, support_team)"""

_EVENT_COLUMNS = "event_id, chat_id, agent_id, event_type, event_timestamp, ingestion_date"
_SURVEY_COLUMNS = "survey_id, chat_id, survey_skipped, customer_input"
_RELOADED = "DATE '1997-02-01'"

_CLEAN_FACT = _fact("clean", "sv")
_DIRTY_FACT = _fact("dirty", "dsv")


def _reports(body: str) -> str:
    return with_fixture(body, _CLEAN_FACT, _DIMS, _REPORTS)


def _reports_after_runs(body: str) -> str:
    late_dims = _DIMS.replace("FROM clean ", "FROM packed ")
    return with_fixture(body, "late", _RUNS, _fact("after", "after_sv"), late_dims, _REPORTS)


def _rule(rule: str, entity: str, source: str) -> str:
    return f"SELECT '{rule}' AS rule_id, CAST({entity} AS VARCHAR) AS entity_id FROM {source}"


_ACTIVITY = "('agent_responded','chat_closed_by_agent','chat_pushed_to_queue_due_inactivity')"
_NO_AGENT = "('chat_started','chat_entered_queue','customer_responded','customer_closed_chat','system_closed_chat_after_inactivity')"
_AGENT = "('agent_assignment','agent_responded','chat_closed_by_agent','chat_pushed_to_queue_due_inactivity')"

# Every event with what its whole chat looks like.
_SEEN = f"""
seen AS (
 SELECT *,
  ROW_NUMBER() OVER (PARTITION BY chat_id ORDER BY event_timestamp, event_id) AS place,
  ROW_NUMBER() OVER (PARTITION BY chat_id ORDER BY event_timestamp DESC, event_id DESC) AS place_from_end,
  COUNT(*) OVER (PARTITION BY chat_id, event_timestamp) AS at_this_moment,
  {_times('chat_started')} OVER chat AS starts,
  {_times('chat_entered_queue')} OVER chat AS queue_entries,
  {_times('agent_assignment')} OVER chat AS assignments,
  {_CLOSINGS} OVER chat AS closings,
  {_CLOSED_AT} OVER chat AS closed_at,
  {_moment('chat_entered_queue')} OVER chat AS queued_at,
  {_moment('agent_assignment')} OVER chat AS assigned_at,
  {_moment('chat_pushed_to_queue_due_inactivity', 'MAX')} OVER chat AS last_push_at,
  {_moment('agent_assignment')} OVER (PARTITION BY chat_id, agent_id) AS same_agent_assigned_at,
  FIRST_VALUE(agent_id) OVER (PARTITION BY chat_id ORDER BY CASE WHEN event_type='agent_assignment' THEN 0 ELSE 1 END, event_timestamp, event_id) AS first_agent_id,
  MIN(agent_id) OVER chat AS lowest_agent_id, MAX(agent_id) OVER chat AS highest_agent_id
 FROM dirty WINDOW chat AS (PARTITION BY chat_id))"""


def _chats(rule: str, condition: str) -> str:
    """Chats with an event in ``seen`` that meets the condition."""
    return _rule(rule, "chat_id", f"seen WHERE {condition} GROUP BY chat_id")


_CLOSED = "SELECT chat_id FROM dirty WHERE event_type IN CLOSURES"
_SURVEYED = "SELECT chat_id FROM dsv"

_RULES = {
    "k01": _rule("K1", "event_id", "dirty GROUP BY event_id HAVING COUNT(*)>1 OR event_id IS NULL"),
    "k02": _rule("K2", "event_id", "dirty WHERE chat_id IS NULL OR event_type IS NULL OR event_timestamp IS NULL OR ingestion_date IS NULL"),
    "k03": _rule("K3", "event_id", f"dirty WHERE event_type NOT IN {_NO_AGENT} AND event_type NOT IN {_AGENT}"),
    "k04": _rule("K4", "event_id", f"dirty WHERE CASE WHEN agent_id IS NULL THEN event_type IN {_AGENT} ELSE event_type IN {_NO_AGENT} END"),
    "k05": _rule("K5", "survey_id", "dsv GROUP BY survey_id HAVING COUNT(*)>1 OR survey_id IS NULL"),
    "k06": _rule("K6", "chat_id", "dsv WHERE chat_id IS NOT NULL GROUP BY chat_id HAVING COUNT(*)>1")
    + " UNION ALL "
    + _rule("K6", "COALESCE(chat_id, survey_id)", "dsv WHERE chat_id IS NULL OR survey_skipped IS NULL"),
    "k07": _rule("K7", "chat_id", "dsv WHERE customer_input NOT IN ('satisfied','dissatisfied')"),
    "k08": _rule("K8", "chat_id", "dsv WHERE survey_skipped AND customer_input IS NOT NULL"),
    "v01": _chats("V1", "starts<>1"),
    "v02": _chats("V2", "place=1 AND event_type<>'chat_started'"),
    "v03": _chats("V3", "at_this_moment>1"),
    "v04": _chats("V4", "assignments>1"),
    "v05": _chats("V5", "lowest_agent_id<highest_agent_id"),
    "v06": _chats("V6", f"event_type IN {_ACTIVITY} AND COALESCE(agent_id IS NULL OR same_agent_assigned_at>=event_timestamp, TRUE)"),
    "v07": _rule("V7", "closed_chat", """(SELECT DISTINCT chat_id AS closed_chat FROM (
 SELECT chat_id, event_timestamp - INTERVAL '1 hour' AS moment FROM dirty WHERE event_type='system_closed_chat_after_inactivity'
 EXCEPT SELECT chat_id, event_timestamp FROM dirty WHERE event_type='chat_pushed_to_queue_due_inactivity'))"""),
    "v08": _chats("V8", "closings>1"),
    "v09": _chats("V9", "event_timestamp>closed_at"),
    "v10a": _rule("V10a", "chat_id", f"({_CLOSED} EXCEPT {_SURVEYED})"),
    "v10b": _rule("V10b", "chat_id", f"({_SURVEYED} EXCEPT {_CLOSED})"),
    "p01": _chats("P1", "queue_entries<>1"),
    "p02": _chats("P2", "place=1 AND queued_at<=event_timestamp"),
    "p03": _chats("P3", "assigned_at<=queued_at"),
    "p04": _chats("P4", "assignments>0 AND agent_id<>first_agent_id"),
    "p05": _chats("P5", f"event_type IN {_ACTIVITY} AND COALESCE(event_timestamp<=assigned_at, TRUE)"),
    "p06": _chats("P6", "closings<>1 OR (place_from_end=1 AND event_type NOT IN CLOSURES)"),
    "p07": _chats("P7", "event_type='system_closed_chat_after_inactivity' AND COALESCE(event_timestamp<>last_push_at + INTERVAL '1 hour', TRUE)"),
    "p09": _rule("P9", "chat_id", f"""(({_CLOSED} EXCEPT {_SURVEYED}) UNION ({_SURVEYED} EXCEPT {_CLOSED})
 UNION SELECT chat_id FROM dsv GROUP BY chat_id HAVING COUNT(*)>1)"""),
}

_GATE_ORDER = ("v01", "v02", "v03", "v04", "v05", "v06", "v07", "v08", "v09", "v10a", "v10b")
_CONTRACT_RULES = ("k01", "k03", "v02", "v01", "v03", "p01", "p02", "v04", "p03", "k04", "p04", "p05", "p06", "p07", "p08", "k05", "p09", "k08", "k07")

def _capacity(events: str, by: str = "") -> str:
    return f"""
assigned AS (
 SELECT chat_id, MAX(CASE WHEN event_type='agent_assignment' THEN agent_id END) AS agent_id,
  {_moment('agent_assignment')} AS assigned_at, {_CLOSED_AT} AS closed_at, MAX(ingestion_date) AS ingestion_date
 FROM {events} GROUP BY chat_id),
changes AS (
 SELECT ingestion_date, agent_id, assigned_at AS moment, 1 AS change FROM assigned WHERE agent_id IS NOT NULL
 UNION ALL SELECT ingestion_date, agent_id, closed_at, -1 FROM assigned WHERE agent_id IS NOT NULL AND closed_at IS NOT NULL),
load AS (
 SELECT ingestion_date, agent_id, moment, SUM(change) OVER (PARTITION BY {by}agent_id ORDER BY moment, change ROWS UNBOUNDED PRECEDING) AS open_chats FROM changes)"""


_RULES["p08"] = _rule("P8", "agent_id", "load GROUP BY agent_id HAVING MAX(open_chats)>2")


def _all_rules(names: tuple[str, ...], counted: str) -> str:
    union = "\n UNION ALL ".join(f"SELECT * FROM ({_RULES[name]})" for name in names)
    return f"SELECT rule_id, COUNT(*) AS violations{counted} FROM ({union}) GROUP BY rule_id"


def _replaced(by: str) -> str:
    key = {"event_date": "CAST(event_timestamp AS DATE)", "ingestion_date": "ingestion_date"}[by]
    return f"""
old_chats AS (SELECT DISTINCT chat_id FROM late WHERE {key}={_RELOADED}),
delivered AS (SELECT * FROM late WHERE ingestion_date={_RELOADED}),
events_after AS (SELECT * FROM late WHERE {key}<>{_RELOADED} UNION ALL SELECT * FROM delivered),
surveys_after AS (SELECT * FROM sv WHERE chat_id NOT IN (SELECT chat_id FROM old_chats)
 UNION ALL SELECT * FROM sv WHERE chat_id IN (SELECT chat_id FROM delivered))"""


def _after_reload(body: str, by: str) -> str:
    return with_fixture(body, "late", _replaced(by))


_DELIVERED = """
days AS (SELECT DISTINCT ingestion_date AS source_date FROM clean),
delivered_events AS (SELECT ingestion_date AS source_date, CAST(COUNT(*) AS INT) AS source_event_count FROM clean GROUP BY ingestion_date),
delivered_surveys AS (SELECT ingestion_date AS source_date, CAST(COUNT(*) AS INT) AS source_chat_count
 FROM sv JOIN clean USING (chat_id) WHERE event_type='chat_started' GROUP BY ingestion_date),
batch_log AS (SELECT source_date, COALESCE(source_chat_count,0) AS source_chat_count, source_event_count
 FROM delivered_events LEFT JOIN delivered_surveys USING (source_date))"""

_OLD_EVENTS = "old_clean AS (SELECT * FROM clean WHERE year(ingestion_date)<>1997), old_sv AS (SELECT * FROM sv WHERE chat_id IN (SELECT chat_id FROM old_clean))"
_OLD_FACT = _fact("old_clean", "old_sv")
_SLA = _pct("COUNT_IF(first_response_sla_met)", "COUNT(first_response_sla_met)")


_AGAIN = "DATE '1997-02-01'"
_BACKED_UP = f"""
months AS (SELECT *, CAST(date_trunc('month', ingestion_date) AS DATE) AS source_date FROM clean),
moved AS (SELECT *, CAST(date_trunc('month', ingestion_date) AS DATE) AS source_date FROM late),
dated AS (SELECT sv.*, source_date FROM sv JOIN months USING (chat_id) WHERE event_type='chat_started')"""
_SHAPED = """
shaped AS (SELECT *, CAST(date_trunc('month', ingestion_date) AS DATE) AS source_date, n%97 IN (1,2,3,4) AS bad FROM clean)"""
_PACKED = """
packed AS (SELECT event_id, n, chat_id, agent_id, event_type,
  event_timestamp + to_days(CAST(date_diff('day', ingestion_date, DATE '1997-01-01' + CAST(n%60 AS INT)) AS INT)) AS event_timestamp,
  CAST(DATE '1997-01-01' + CAST(n%60 AS INT) AS DATE) AS ingestion_date FROM late)"""
_RUNS = f"""{_PACKED},
after AS (SELECT * FROM packed WHERE ingestion_date<>{_AGAIN} OR n%2=0),
after_sv AS (SELECT * FROM sv WHERE chat_id IN (SELECT chat_id FROM after))"""
# By event date the load of the next day cuts off what lies behind midnight.
_EVENT_DATE_RUNS = f"""{_PACKED},
cut AS (SELECT * FROM packed WHERE CAST(event_timestamp AS DATE)=ingestion_date AND ingestion_date<>{_AGAIN}),
again AS (SELECT * FROM packed WHERE ingestion_date={_AGAIN} AND n%2=0),
after AS (SELECT * FROM cut UNION ALL SELECT * FROM again),
after_sv AS (SELECT * FROM sv WHERE chat_id IN (SELECT chat_id FROM again) OR (chat_id IN (SELECT chat_id FROM cut)
  AND chat_id NOT IN (SELECT chat_id FROM packed WHERE CAST(event_timestamp AS DATE)<>ingestion_date)))"""
_CHANGED = f"""{_PACKED},
versions AS (SELECT *, CASE WHEN ingestion_date>={_AGAIN} OR ingestion_date=DATE '1997-01-10' THEN 2 ELSE 1 END AS version FROM packed),
changed AS (SELECT event_id, chat_id, agent_id,
  CASE WHEN version=2 AND n%7=0 AND event_type='customer_responded' THEN 'customer_left_note' ELSE event_type END AS event_type,
  event_timestamp, ingestion_date, CASE WHEN version=2 THEN CASE n%3 WHEN 0 THEN 'web' WHEN 1 THEN 'phone' END END AS channel, version FROM versions)"""
_WITHDRAWN = f"""{_PACKED},
one_less AS (SELECT * FROM packed WHERE (ingestion_date<>{_AGAIN} OR n%2=0) AND ingestion_date<>DATE '1997-01-10'),
one_less_sv AS (SELECT * FROM sv WHERE chat_id IN (SELECT chat_id FROM one_less))"""
_LOGGED = f"""{_PACKED},
days AS (SELECT CAST(unnest(generate_series(MIN(ingestion_date), MAX(ingestion_date)+1, INTERVAL 1 DAY)) AS DATE) AS source_date FROM packed),
starts AS (SELECT chat_id, n, ingestion_date AS source_date FROM packed WHERE event_type='chat_started'),
counted AS (SELECT source_date, COUNT(*) AS events, COUNT(*) FILTER (n%2=0) AS half_events
 FROM packed JOIN (SELECT chat_id, source_date FROM starts) USING (chat_id) GROUP BY source_date),
answered AS (SELECT source_date, COUNT(*) AS chats, COUNT(*) FILTER (sv.n%2=0) AS half_chats
 FROM sv JOIN (SELECT chat_id, source_date FROM starts) USING (chat_id) GROUP BY source_date),
logged AS (SELECT ROW_NUMBER() OVER (ORDER BY source_date) AS batch_id, source_date, chats, events, half_chats, half_events
 FROM days LEFT JOIN counted USING (source_date) LEFT JOIN answered USING (source_date))"""


def statements() -> dict[str, str]:
    sql = {
        "k09": with_fixture(
            _rule("K9", "STR(year(source_date)*10000+month(source_date)*100+day(source_date))", "batch_log WHERE day(source_date)=13"),
            _DELIVERED,
        ),
        "k10": _reports("SELECT 'K10' AS rule_id, concat('agent_id ', STR(agent_id)) AS entity_id FROM dim_agent WHERE agent_id%4=0"),
        "p08_per_delivery": with_fixture(
            """SELECT ingestion_date, agent_id, MIN(moment) FILTER (WHERE open_chats>2) AS first_breach_at, CAST(MAX(open_chats) AS BIGINT) AS peak_open_chats
 FROM load GROUP BY ALL HAVING MAX(open_chats)>2""",
            "late",
            _PACKED,
            _capacity("packed", "ingestion_date, "),
        ),
        "backup_after_two_runs": with_fixture(
            f"SELECT {_EVENT_COLUMNS}, source_date FROM months WHERE source_date<>{_AGAIN} UNION ALL SELECT {_EVENT_COLUMNS}, source_date FROM moved WHERE source_date={_AGAIN}",
            "late",
            _BACKED_UP,
        ),
        "backup_surveys": with_fixture(
            f"SELECT {_SURVEY_COLUMNS}, source_date FROM dated WHERE source_date<>{_AGAIN} OR NOT survey_skipped",
            "late",
            _BACKED_UP,
        ),
        "rejected_lines": with_fixture(
            "SELECT source_date, COUNT(*) FILTER (WHERE NOT bad) AS accepted, COUNT(*) FILTER (WHERE bad) AS rejected FROM shaped GROUP BY source_date",
            _SHAPED,
        ),
        "reject_reasons": with_fixture(
            """SELECT source_date, CASE n%97 WHEN 1 THEN 'not one object' WHEN 2 THEN 'not JSON' WHEN 3 THEN 'event_timestamp' ELSE 'agent_id,ingestion_date' END AS reason,
 COUNT(*) AS lines, COUNT(*) AS in_its_file FROM shaped WHERE bad GROUP BY ALL""",
            _SHAPED,
        ),
        "raw_after_runs": with_fixture(f"SELECT {_EVENT_COLUMNS} FROM after", "late", _RUNS),
        "surveys_after_runs": with_fixture(f"SELECT {_SURVEY_COLUMNS} FROM after_sv", "late", _RUNS),
        "raw_after_event_date_runs": with_fixture(
            f"SELECT {_EVENT_COLUMNS} FROM after", "late", _EVENT_DATE_RUNS
        ),
        "surveys_after_event_date_runs": with_fixture(
            f"SELECT {_SURVEY_COLUMNS} FROM after_sv", "late", _EVENT_DATE_RUNS
        ),
        "batch_log_after_runs": with_fixture(
            f"""SELECT batch_id, source_date, CAST(COALESCE(chats,0) AS INT) AS source_chat_count, CAST(COALESCE(events,0) AS INT) AS source_event_count, TRUE AS loaded FROM logged
 UNION ALL SELECT (SELECT MAX(batch_id) FROM logged)+1, source_date, CAST(COALESCE(half_chats,0) AS INT), CAST(COALESCE(half_events,0) AS INT), TRUE FROM logged WHERE source_date={_AGAIN}""",
            "late",
            _LOGGED,
        ),
        "raw_after_failed_load": with_fixture(
            """SELECT 'failed' AS stage, ingestion_date, COUNT(*) AS events, COUNT(DISTINCT chat_id) AS chats FROM packed GROUP BY ALL
 UNION ALL SELECT 'reloaded', ingestion_date, COUNT(*), COUNT(DISTINCT chat_id) FROM after GROUP BY ALL""",
            "late",
            _RUNS,
        ),
        "mart_after_reload": with_fixture("SELECT * FROM fact", "late", _RUNS, _fact("after", "after_sv")),
        "mart_after_full_refresh": with_fixture(
            "SELECT * FROM fact", "late", _EVENT_DATE_RUNS, _fact("after", "after_sv")
        ),
        "mart_after_two_refreshes": with_fixture(
            """SELECT *, 'first' AS stage FROM fact UNION ALL SELECT *, 'second' FROM fact WHERE ingestion_date<>DATE '1997-02-20'""",
            "late",
            _WITHDRAWN,
            _fact("one_less", "one_less_sv"),
        ),
        "raw_after_schema_change": with_fixture(
            f"SELECT {_EVENT_COLUMNS}, channel, version FROM changed", "late", _CHANGED
        ),
        "schema_log_after_change": with_fixture(
            """SELECT version, concat('event_id,chat_id,agent_id,event_type,event_timestamp,ingestion_date,event_date', CASE WHEN version=2 THEN ',channel' ELSE '' END) AS columns,
 version=2 AS takes_notes, COUNT(*) AS rows FROM changed GROUP BY version""",
            "late",
            _CHANGED,
        ),
        "kpi_after_reload": _reports_after_runs("SELECT * FROM kpi"),
        "agent_performance_after_reload": _reports_after_runs("SELECT * FROM agent_days"),
        "chat_events": with_fixture(f"SELECT {_EVENT_COLUMNS} FROM clean"),
        "surveys": with_fixture(f"SELECT {_SURVEY_COLUMNS} FROM sv"),
        "event_order": with_fixture(
            f"SELECT {_EVENT_COLUMNS} FROM clean ORDER BY event_timestamp, event_id"
        ),
        "jsonl_round_trip": with_fixture(
            f"SELECT {_EVENT_COLUMNS}, CAST(date_trunc('month', ingestion_date) AS DATE) AS source_date FROM clean"
        ),
        "replace_by_event_date": _after_reload(
            f"SELECT {_EVENT_COLUMNS} FROM events_after", "event_date"
        ),
        "replace_by_ingestion_date": _after_reload(
            f"SELECT {_EVENT_COLUMNS} FROM events_after", "ingestion_date"
        ),
        "replace_surveys_by_event_date": _after_reload(
            f"SELECT {_SURVEY_COLUMNS} FROM surveys_after", "event_date"
        ),
        "replace_surveys_by_ingestion_date": _after_reload(
            f"SELECT {_SURVEY_COLUMNS} FROM surveys_after", "ingestion_date"
        ),
        "batch_log_counts": with_fixture("SELECT * FROM batch_log", _DELIVERED),
        "run_totals": with_fixture(
            """SELECT COUNT(*) AS days, CAST(SUM(source_event_count) AS BIGINT) AS events,
 CAST(SUM(source_chat_count) AS BIGINT) AS surveys FROM batch_log""",
            _DELIVERED,
        ),
        "date_range_select": with_fixture(
            """SELECT CAST(d AS DATE) AS source_date, COUNT(event_id) AS events
 FROM (SELECT unnest(generate_series(DATE '1997-01-01', DATE '1998-12-31', INTERVAL 1 DAY)) AS d)
 LEFT JOIN clean ON ingestion_date=CAST(d AS DATE) GROUP BY d"""
        ),
        "schema_evolution_union": with_fixture(
            f"""SELECT chat_id, started_at, CASE WHEN year(started_at)<1998 THEN NULL ELSE entered_queue_at END AS entered_queue_at,
 CASE WHEN year(started_at)<1998 THEN NULL ELSE queue_wait_seconds END AS queue_wait_seconds FROM fact""",
            _CLEAN_FACT,
        ),
        "k11": with_fixture(
            _rule("K11", "chat_id", "fact GROUP BY chat_id HAVING COUNT(*)>1"), "dirty", _DIRTY_FACT
        ),
        "k12": with_fixture(_rule("K12", "chat_id", "fact WHERE agent_id=1005"), _CLEAN_FACT),
        "k13": with_fixture(
            "SELECT DISTINCT 'K13' AS rule_id, chat_id AS entity_id FROM fact WHERE date_key IS NULL OR started_at IS NULL OR resolution_seconds IS NULL"
            " OR closed_at IS NULL OR ingestion_date IS NULL OR resolution_sla_met IS NULL",
            "dirty",
            _DIRTY_FACT,
        ),
        "k14": with_fixture(
            "SELECT DISTINCT 'K14' AS rule_id, chat_id AS entity_id FROM fact WHERE assigned_at<entered_queue_at - INTERVAL '500000 microseconds'"
            " OR first_agent_response_at<assigned_at - INTERVAL '500000 microseconds' OR closed_at<started_at - INTERVAL '500000 microseconds'",
            "dirty",
            _DIRTY_FACT,
        ),
        "gate_summary": with_fixture(
            _all_rules(_GATE_ORDER, ", MIN(entity_id) AS entity_id"), "dirty", _SEEN
        ),
        "gate_first_failure": with_fixture(
            f"SELECT * FROM ({_all_rules(_GATE_ORDER, ', MIN(entity_id) AS entity_id')}) WHERE rule_id='V1'",
            "dirty",
            _SEEN,
        ),
        "contract_summary": with_fixture(
            _all_rules(_CONTRACT_RULES, ", MIN(entity_id) AS entity_id"), "dirty", _SEEN, _capacity("dirty")
        ),
        "p08_capacity": with_fixture(
            """SELECT agent_id, MIN(moment) FILTER (WHERE open_chats>2) AS first_breach_at, CAST(MAX(open_chats) AS BIGINT) AS peak_open_chats
 FROM load GROUP BY agent_id HAVING MAX(open_chats)>2""",
            _capacity("clean"),
        ),
        "dim_date": _reports("SELECT * FROM dim_date"),
        "dim_agent": _reports("SELECT * FROM dim_agent"),
        "dim_resolution_type": _reports(
            """SELECT resolution_code, resolution_label, COUNT(chat_id) AS chats FROM dim_resolution_type
 LEFT JOIN fact USING (resolution_code) GROUP BY ALL"""
        ),
        "dim_survey_response": _reports(
            """SELECT response_code, response_label, is_answered, COUNT(chat_id) AS chats FROM dim_survey_response
 LEFT JOIN fact USING (response_code) GROUP BY ALL"""
        ),
        "dim_agent_upsert": _reports(
            "SELECT agent_id, agent_name, support_team FROM dim_agent UNION ALL SELECT 1999, 'Old', 'Old'"
        ),
        "dim_date_insert_absent": _reports(
            """SELECT date_key, full_date, day_name FROM dim_date WHERE date_key<>19950101
 UNION ALL SELECT 19950101, DATE '1995-01-01', 'Old' UNION ALL SELECT 19000101, DATE '1900-01-01', 'Old'"""
        ),
        "chat_rollup": with_fixture("SELECT * FROM rollup", _rollup("clean")),
        "fact_chat_resolution": with_fixture("SELECT * FROM fact", _CLEAN_FACT),
        "fact_with_agents": _reports(
            "SELECT chat_id, agent_id, agent_name, support_team FROM fact LEFT JOIN dim_agent USING (agent_id)"
        ),
        "fact_sync": with_fixture("SELECT * FROM fact", _OLD_EVENTS, _OLD_FACT),
        "fact_stale": with_fixture(
            "SELECT chat_id FROM fact WHERE year(ingestion_date)=1997", _CLEAN_FACT
        ),
        "fact_keys_stable": with_fixture(
            "SELECT TRUE AS same_key, COUNT(*) AS chats FROM fact WHERE year(ingestion_date)<>1997",
            _CLEAN_FACT,
        ),
        "chat_detail": _reports("SELECT * FROM detail"),
        "chat_detail_filtered": _reports(
            """SELECT * FROM detail WHERE chat_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
 AND support_team IN ('Billing Support','Account Support') AND agent_name<>'Agent 1003'"""
        ),
        "chats_like": _reports("SELECT chat_id, chat_date FROM detail WHERE chat_id LIKE 'chat_1997%'"),
        "kpi_daily": _reports("SELECT * FROM kpi"),
        "kpi_daily_from_raw": _reports("SELECT * FROM kpi"),
        "agent_performance": _reports("SELECT * FROM agent_days"),
        "d01_resolved_chats": _reports(
            "SELECT CAST(SUM(resolved_chats) AS BIGINT) AS resolved_chats FROM kpi"
        ),
        "d02_average_queue_wait": _reports(
            f"SELECT {_avg_minutes('queue_wait_seconds')} AS avg_queue_wait_minutes FROM detail"
        ),
        "d03_average_first_response": _reports(
            f"SELECT {_avg_minutes('first_response_seconds')} AS avg_first_response_minutes FROM detail"
        ),
        "d04_resolution_sla": _reports(
            f"SELECT {_pct('COUNT_IF(resolution_sla_met)', 'COUNT(*)')} AS resolution_sla_pct FROM detail"
        ),
        "d05_csat": _reports(
            f"SELECT {_pct('COUNT_IF(satisfied_flag)', 'COUNT(satisfied_flag)')} AS csat_pct FROM detail"
        ),
        "d06_resolved_by_team": _reports(
            "SELECT support_team, CAST(SUM(resolved_chats) AS BIGINT) AS resolved_chats FROM kpi GROUP BY support_team"
        ),
        "d07_daily_volume": _reports(
            "SELECT chat_date, CAST(SUM(resolved_chats) AS BIGINT) AS resolved_chats FROM kpi GROUP BY chat_date"
        ),
        "d08_closure_reasons": _reports(
            "SELECT resolution_label, COUNT(*) AS chats FROM detail GROUP BY resolution_label"
        ),
        "d09_agent_ranking": _reports(
            "SELECT *, CAST(RANK() OVER (PARTITION BY chat_date ORDER BY resolved_chats DESC, agent_id) AS INT) AS agent_rank FROM agent_days"
        ),
        "d10_first_response_sla": _reports(
            f"""SELECT 'tile' AS grain, 'all' AS label, {_SLA} AS first_response_sla_pct FROM detail
 UNION ALL SELECT 'day', CAST(chat_date AS VARCHAR), {_SLA} FROM detail GROUP BY chat_date
 UNION ALL SELECT 'team', support_team, {_SLA} FROM detail GROUP BY support_team"""
        ),
        "d10_team_averages": _reports(
            f"""SELECT support_team, {_avg_minutes('queue_wait_seconds')} AS avg_queue_wait_minutes,
 {_avg_minutes('first_response_seconds')} AS avg_first_response_minutes,
 {_avg_minutes('resolution_seconds')} AS avg_resolution_minutes FROM detail GROUP BY support_team"""
        ),
        "d11_readiness": _reports(
            "SELECT (SELECT COUNT(*) FROM fact) AS fact_rows, (SELECT COUNT(*) FROM kpi) AS kpi_rows"
        ),
        "d12_reconciliation": _reports(
            """SELECT source_date, raw_events, fact_rows, queue_entries, assigned_chats, queue_waits, shortest_queue_wait_seconds,
  kpi_rows, kpi_queue_rows, agent_rows, agent_queue_rows
 FROM (SELECT ingestion_date AS source_date, COUNT(*) AS raw_events FROM clean GROUP BY ingestion_date)
 LEFT JOIN (SELECT CAST(started_at AS DATE) AS source_date, COUNT(*) AS fact_rows, COUNT(entered_queue_at) AS queue_entries,
  COUNT(assigned_at) AS assigned_chats, COUNT(queue_wait_seconds) AS queue_waits, MIN(queue_wait_seconds) AS shortest_queue_wait_seconds
  FROM fact GROUP BY CAST(started_at AS DATE)) USING (source_date)
 LEFT JOIN (SELECT chat_date AS source_date, COUNT(*) AS kpi_rows, COUNT(avg_queue_wait_minutes) AS kpi_queue_rows FROM kpi GROUP BY chat_date) USING (source_date)
 LEFT JOIN (SELECT chat_date AS source_date, COUNT(*) AS agent_rows, COUNT(avg_queue_wait_minutes) AS agent_queue_rows FROM agent_days GROUP BY chat_date) USING (source_date)"""
        ),
    }
    alone = {name: body for name, body in _RULES.items() if name != "p08"}
    sql.update({name: with_fixture(body, "dirty", _SEEN) for name, body in alone.items()})
    return sql
