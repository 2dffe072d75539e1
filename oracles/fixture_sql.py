"""The derived chat log as DuckDB common table expressions (FIXTURES.md, section 3)."""

from __future__ import annotations

import re

_DERIVATION = """
spine AS (
 SELECT o_orderkey AS n, o_custkey, o_orderstatus, o_orderdate,
  concat('chat_', STR(year(o_orderdate)*10000+month(o_orderdate)*100+day(o_orderdate)), '_', PAD(o_orderkey,8)) AS chat_id,
  ADD_US(o_orderdate, (28800+(o_orderkey*7919)%43200)*1000000) AS started_at,
  CAST(1001+o_custkey%12 AS INT) AS agent_id,
  CASE WHEN o_orderkey%25=7 THEN 'abandoned' WHEN o_orderkey%25=3 THEN 'open'
       WHEN o_orderstatus='O' THEN 'customer'
       WHEN o_orderstatus='P' AND o_orderkey%5<2 THEN 'system' ELSE 'agent' END AS kind
 FROM orders),
spine2 AS (
 SELECT *, ADD_US(started_at, 1000000) AS queued_at,
  CASE WHEN kind<>'abandoned' THEN ADD_US(started_at, (2+(o_custkey*31)%900)*1000000+(o_custkey%4)*250000) END AS assigned_at
 FROM spine),
msg0 AS (
 SELECT s.n, s.chat_id, s.agent_id, s.assigned_at, s.started_at, l_suppkey,
  SUM((20+l_partkey%400)*1000000+(l_suppkey%4)*250000) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber,l_partkey,l_suppkey,l_shipdate,l_quantity,l_extendedprice ROWS UNBOUNDED PRECEDING) AS off_us
 FROM spine2 s JOIN lineitem ON l_orderkey=s.n WHERE s.kind<>'abandoned'),
last AS (SELECT n AS ln, CAST(MAX(off_us) AS BIGINT) AS off_us FROM msg0 GROUP BY n),
spine3 AS (
 SELECT s.*, CASE WHEN kind='abandoned' THEN ADD_US(queued_at, (120+n%780)*1000000)
   WHEN kind IN ('agent','customer') THEN ADD_US(assigned_at, COALESCE(off_us,0)+(30+n%570)*1000000)
   WHEN kind='system' THEN ADD_US(assigned_at, COALESCE(off_us,0)+(3720+n%780)*1000000) END AS closed_at,
   CASE WHEN kind='system' THEN ADD_US(assigned_at, COALESCE(off_us,0)+(120+n%780)*1000000) END AS pushed_at
 FROM spine2 s LEFT JOIN last ON ln=n),
ev AS (
 SELECT n,chat_id,CAST(NULL AS INT) AS agent_id,'chat_started' AS event_type,started_at AS event_timestamp,started_at AS s0 FROM spine3
 UNION ALL SELECT n,chat_id,NULL,'chat_entered_queue',queued_at,started_at FROM spine3
 UNION ALL SELECT n,chat_id,agent_id,'agent_assignment',assigned_at,started_at FROM spine3 WHERE assigned_at IS NOT NULL
 UNION ALL SELECT n,chat_id,CASE WHEN l_suppkey%2=0 THEN agent_id END,CASE WHEN l_suppkey%2=0 THEN 'agent_responded' ELSE 'customer_responded' END,ADD_US(assigned_at, CAST(off_us AS BIGINT)),started_at FROM msg0
 UNION ALL SELECT n,chat_id,agent_id,'chat_pushed_to_queue_due_inactivity',pushed_at,started_at FROM spine3 WHERE pushed_at IS NOT NULL
 UNION ALL SELECT n,chat_id,CASE WHEN kind='agent' THEN agent_id END,CASE kind WHEN 'agent' THEN 'chat_closed_by_agent' WHEN 'system' THEN 'system_closed_chat_after_inactivity' ELSE 'customer_closed_chat' END,closed_at,started_at FROM spine3 WHERE closed_at IS NOT NULL),
numbered AS (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY chat_id ORDER BY event_timestamp) AS nr FROM ev),
clean AS (
 SELECT concat(chat_id,'_event_',PAD(nr,2)) AS event_id, n, chat_id,agent_id,event_type,event_timestamp,CAST(s0 AS DATE) AS ingestion_date FROM numbered),
sv AS (
 SELECT concat('survey_',chat_id) AS survey_id, n, chat_id, (n*13+o_custkey)%100<12 AS survey_skipped,
  CASE WHEN (n*13+o_custkey)%100<12 THEN NULL WHEN (n*17+o_custkey)%10<7 THEN 'satisfied' WHEN (n*17+o_custkey)%10<9 THEN 'dissatisfied' END AS customer_input
 FROM spine3 WHERE closed_at IS NOT NULL)"""

_DEFECTS = """
dirty AS (
 SELECT event_id,n,chat_id,
   CASE WHEN n%101=4 AND event_type='agent_responded' THEN agent_id+1 WHEN n%101=13 AND event_type='customer_responded' THEN 1001 ELSE agent_id END AS agent_id,
   CASE WHEN n%101=12 AND event_type='customer_responded' THEN 'bot_responded' ELSE event_type END AS event_type,
   CASE WHEN n%101=17 AND event_type='chat_entered_queue' THEN ADD_US(event_timestamp, 902000000) WHEN n%101=2 AND event_type='chat_started' THEN ADD_US(event_timestamp, 1000000)
        WHEN event_type='system_closed_chat_after_inactivity' AND n%53=6 THEN ADD_US(event_timestamp, 1000000) ELSE event_timestamp END AS event_timestamp,
   CASE WHEN n%101=19 AND event_type='customer_responded' THEN NULL ELSE ingestion_date END AS ingestion_date
 FROM clean WHERE NOT (n%101=1 AND event_type='chat_started') AND NOT (n%101=5 AND event_type='agent_assignment')
 UNION ALL SELECT concat(event_id,'x'),n,chat_id,agent_id+1,event_type,ADD_US(event_timestamp, 1000000),ingestion_date FROM clean WHERE n%101=3 AND event_type='agent_assignment'
 UNION ALL SELECT concat(event_id,'x'),n,chat_id,NULL,'customer_closed_chat',ADD_US(event_timestamp, 300000000),ingestion_date FROM clean WHERE n%101=7 AND event_type IN CLOSURES
 UNION ALL SELECT concat(event_id,'x'),n,chat_id,NULL,'customer_responded',ADD_US(event_timestamp, 60000000),ingestion_date FROM clean WHERE n%101=8 AND event_type IN CLOSURES
 UNION ALL SELECT event_id,n,chat_id,agent_id,event_type,event_timestamp,ingestion_date FROM clean WHERE n%101=11 AND event_type='chat_entered_queue'
 UNION ALL SELECT concat(event_id,'x'),n,chat_id,agent_id,event_type,ADD_US(event_timestamp, 10000000),ingestion_date FROM clean WHERE n%53=7 AND event_type='chat_pushed_to_queue_due_inactivity'),
dsv AS (
 SELECT survey_id,n,chat_id,CASE WHEN n%101=14 THEN TRUE ELSE survey_skipped END AS survey_skipped, CASE WHEN n%101=14 THEN 'satisfied' WHEN n%101=16 THEN 'maybe' ELSE customer_input END AS customer_input FROM sv WHERE n%101<>9
 UNION ALL SELECT survey_id,n,chat_id,survey_skipped,customer_input FROM sv WHERE n%101=15
 UNION ALL SELECT concat('survey_',chat_id),n,chat_id,FALSE,'satisfied' FROM spine3 WHERE kind='open' AND n%50=3)"""

_LATE = """
late AS (
 SELECT event_id, n, chat_id, agent_id, event_type, ADD_US(event_timestamp, 14400000000) AS event_timestamp, ingestion_date FROM clean)"""

_CLOSURES = "('chat_closed_by_agent','customer_closed_chat','system_closed_chat_after_inactivity')"


def _call(name: str, text: str, render) -> str:
    """Expand ``name(a, b)`` calls, innermost parentheses respected."""
    out, at = "", 0
    for match in re.finditer(rf"\b{name}\(", text):
        if match.start() < at:
            continue
        depth, end, splits = 1, match.end(), []
        while depth:
            char = text[end]
            depth += {"(": 1, ")": -1}.get(char, 0)
            if char == "," and depth == 1:
                splits.append(end)
            end += 1
        bounds = [match.end() - 1, *splits, end - 1]
        args = [text[a + 1 : b].strip() for a, b in zip(bounds, bounds[1:])]
        out += text[at : match.start()] + render(*args)
        at = end
    return out + text[at:]


def expand(text: str) -> str:
    """Write the shorthands ADD_US, PAD, STR and CLOSURES out as DuckDB SQL."""
    text = _call("ADD_US", text, lambda t, k: f"({t} + to_microseconds({k}))")
    text = _call(
        "PAD", text, lambda x, w: f"lpad(CAST({x} AS VARCHAR), CAST(greatest({w}, length(CAST({x} AS VARCHAR))) AS INT), '0')"
    )
    text = _call("STR", text, lambda x: f"CAST({x} AS VARCHAR)")
    return re.sub(r"\bCLOSURES\b", _CLOSURES, text)


def with_fixture(body: str, *ctes: str) -> str:
    """``body`` after the derivation and the named or literal further CTEs."""
    named = {"dirty": _DEFECTS, "late": _LATE}
    parts = [_DERIVATION, *[named.get(cte, cte) for cte in ctes]]
    return expand("WITH" + ",".join(parts) + "\n" + body)
