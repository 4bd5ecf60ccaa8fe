"""Every registered query against its DuckDB counterpart."""

from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from brookmart.oracle import oracles
from brookmart.queries import QUERIES
from tests.conftest import SF

# The smallest tables have no sales on the day that these look at.
SALES = {"gmv_day", "gmv_by_brand_day", "sales_by_province_day", "gmv_payload",
         "brand_chart_payload", "province_chart_payload"}
LARGER = "/root/testdata/sf0.01"

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "int": "INTEGER", "boolean": "BOOLEAN",
         "double": "DOUBLE"}


@pytest.fixture(scope="module")
def ducks():
    cons = {}
    for folder in (SF, LARGER):
        cons[folder] = duckdb.connect()
        for t in TABLES:
            cons[folder].execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return cons


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


def test_same_keys():
    assert set(QUERIES) == set(oracles())
    assert set(QUERIES) <= set(entry.queries()) and set(oracles()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, ducks, name):
    folder = LARGER if name in SALES else SF
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    oracle = ducks[folder].sql(oracles()[name])
    assert columns == sorted(oracle.columns)
    kinds = dict(zip(oracle.columns, map(str, oracle.types)))
    for c, kind in df.dtypes:
        assert TYPES.get(kind, kind.upper().replace(",", ",")) == kinds[c].replace(", ", ","), c
    got = ordered(df.select(*[f"`{c}`" for c in columns]).collect())
    want = ordered(oracle.select(*[f'"{c}"' for c in columns]).fetchall())
    assert got == want
    assert got or name not in SALES


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_parses_what_it_needs(spark, sf_dir):
    """Visitors a day take the device and the time of each record and nothing else."""
    plan = plan_of(QUERIES["daily_uv_count"](spark, sf_dir))
    # Once where the test records are made, not again where they are read.
    assert plan.count("StructField(displays,") == 1 and plan.count("StructField(page,") == 1


def test_payment_join_runs_once(spark, sf_dir):
    plan = plan_of(QUERIES["product_stats"](spark, sf_dir))
    assert plan.count("Join Inner") == 1


def test_day_filter_reaches_the_scans(spark, sf_dir):
    plan = QUERIES["sales_by_province_day"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(o_orderdate,2000-06-11" in plan
    assert "GreaterThanOrEqual(l_shipdate,2000-05-12" in plan


def test_entry(spark):
    row = entry.entry(spark).first()
    assert row.pv_ct >= 0 and not isinstance(row.pv_ct, Decimal)
