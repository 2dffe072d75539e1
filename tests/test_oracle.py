"""Every registered query against its DuckDB counterpart, over whole tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from chatloom.plans.registry import catalog
from oracles.statements import statements

SF_DIR = "/root/testdata/sf0.001"
QUERIES = catalog()
STATEMENTS = statements()

# Violations the defects are built to cause at this scale (FIXTURES.md).
EXPECTED_COUNTS = {
    "v01": 15, "v02": 15, "v03": 30, "v04": 14, "v05": 37, "v06": 25, "v07": 5, "v08": 15,
    "v09": 31, "v10a": 15, "v10b": 30, "k01": 15, "k02": 22, "k03": 29, "k04": 24, "k05": 14,
    "k06": 14, "k07": 14, "k08": 14, "k11": 14, "k13": 14, "k14": 14, "p01": 15, "p02": 30,
    "p03": 15, "p04": 37, "p05": 14, "p06": 91, "p07": 9, "p09": 59, "p08_capacity": 11,
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(STATEMENTS)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(STATEMENTS) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_duckdb(spark, duck, name):
    ours = QUERIES[name](spark, SF_DIR).toArrow()
    theirs = duck.sql(STATEMENTS[name]).to_arrow_table()
    columns = sorted(theirs.column_names)
    assert sorted(ours.column_names) == columns
    ours, theirs = ours.select(columns), theirs.select(columns)
    assert [str(f.type) for f in ours.schema] == [str(f.type) for f in theirs.schema]
    assert ours.num_rows == theirs.num_rows > 0
    duck.register("ours", ours)
    duck.register("theirs", theirs)
    for one, other in (("ours", "theirs"), ("theirs", "ours")):
        extra = duck.sql(f"SELECT * FROM {one} EXCEPT ALL SELECT * FROM {other}").fetchall()
        assert not extra, f"{len(extra)} rows only in {one}, as {extra[:3]}"
    if name in EXPECTED_COUNTS:
        assert ours.num_rows == EXPECTED_COUNTS[name]


def test_entry(spark):
    assert entry_module.entry(spark).columns[:2] == ["chat_date", "support_team"]
