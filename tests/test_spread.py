"""The join with a dimension when one key has a third of the rows."""

import re

import pytest
from pyspark.sql import functions as F

from chatloom.operators.spread import beyond_broadcast, heavy_keys, spread_join
from chatloom.plans.mart import build_mart
from chatloom.session import materialize

from .helpers import abandoned_chat, at, frames, ordinary_chat, rows_of
from .test_scale import plan_of

ROWS = 3_000_000


@pytest.fixture
def without_broadcast(spark):
    own = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in own}
    for name, value in own.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def chats(spark, rows):
    """A third with one agent, a sixth with none, the others with 5,000 agents."""
    place = F.col("id")
    agent = F.when(place % 3 == 0, 1).when(place % 6 == 1, F.lit(None)).otherwise(place % 5000 + 2)
    return spark.range(0, rows, 1, 8).select(place, agent.cast("int").alias("agent_id"))


def agents(spark):
    """Agent 7 is missing; 6,000 has no chat."""
    known = spark.range(1, 6001).where("id <> 7")
    return known.select((F.col("id") * 10).alias("agent_key"), F.col("id").cast("int").alias("agent_id"))


def largest_part(df):
    sizes = df.groupBy(F.spark_partition_id().alias("part")).count()
    return sizes.agg(F.max("count")).first()[0]


def test_no_task_has_over_a_fifth_of_the_rows(spark, without_broadcast):
    rows, dimension = materialize(chats(spark, ROWS), "chats"), materialize(agents(spark), "agents")
    assert heavy_keys(rows, "agent_id") == [1]
    assert largest_part(rows.join(dimension, "agent_id", "left")) >= ROWS // 3
    assert largest_part(spread_join(rows, dimension, "agent_id")) < ROWS // 5


def test_the_heavy_and_the_keyless_stay_out_of_the_shuffle(spark, without_broadcast):
    rows, dimension = materialize(chats(spark, 30_000), "chats"), materialize(agents(spark), "agents")
    joined = spread_join(rows, dimension, "agent_id")
    assert "BroadcastHashJoin" in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
    # Filters on the key reach the scans.
    pushed = re.findall(r"PushedFilters: \[(.*?)\], Read", joined._jdf.queryExecution().toString())
    assert any({"Not(EqualTo(agent_id,1))", "IsNotNull(agent_id)"} <= set(p.split(", ")) for p in pushed)


def test_equals_the_plain_join(spark, without_broadcast):
    rows, dimension = chats(spark, 3000), agents(spark)
    plain = rows_of(rows.join(dimension, "agent_id", "left"), "id", "agent_id", "agent_key")
    for parts in (1, 2, 64, 100_000):
        got = spread_join(rows, dimension, "agent_id", parts)
        assert rows_of(got, "id", "agent_id", "agent_key") == plain
        assert len(heavy_keys(rows, "agent_id", parts)) < parts


def test_empty_sides(spark):
    rows, dimension = chats(spark, 30), agents(spark)
    assert spread_join(rows.limit(0), dimension, "agent_id").count() == 0
    nothing = spread_join(rows, dimension.limit(0), "agent_id")
    assert nothing.count() == 30 and nothing.where("agent_key IS NOT NULL").isEmpty()
    keyless = rows.where("agent_id IS NULL")
    assert spread_join(keyless, dimension, "agent_id").count() == 5


def test_the_fact_spreads_a_large_dimension_only(spark, without_broadcast):
    some = [ordinary_chat(f"chat_{i}", at(f"{8 + i:02d}:00:00"), agent=1001 + i % 2) for i in range(6)]
    events, surveys = frames(spark, *some, abandoned_chat("chat_x", at("07:00:00")))
    spread = build_mart(events, surveys)
    assert beyond_broadcast(spread.dim_agent)
    spread_rows = rows_of(spread.fact_chat_resolution.drop("chat_fact_key"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    plain = build_mart(events, surveys)
    assert not beyond_broadcast(plain.dim_agent)
    assert rows_of(plain.fact_chat_resolution.drop("chat_fact_key")) == spread_rows
