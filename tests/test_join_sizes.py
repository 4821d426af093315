"""Joins with tables that grow by explode: no static broadcast, whatever the session's threshold."""

import os

import pytest
from oracle_check import digest
from pyspark.sql import functions as F

from recordforge.plans.catalog import ORACLE, QUERIES

#: the geography and the wages join of the salary comparison
KEYS = ("worksite_county", "area")


@pytest.fixture(scope="module")
def small_sf(spark, tmp_path_factory):
    """Forty customers with twenty orders each: by its estimate every table is small enough to broadcast."""
    root = str(tmp_path_factory.mktemp("sizes"))
    spark.range(1, 41).select(F.col("id").alias("c_custkey")).coalesce(1).write.parquet(os.path.join(root, "customer.parquet"))
    spark.range(1, 801).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 40 + 1).alias("o_custkey"),
        (F.col("id") * 997 % 400_000 + 1000).cast("double").alias("o_totalprice"),
    ).coalesce(1).write.parquet(os.path.join(root, "orders.parquet"))
    return root


@pytest.fixture()
def default_broadcasts(spark):
    """The thresholds of a session that sets none."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, str(10 * 1024 * 1024))
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("key", ["salaries_through_sql", "salary_comparison", "salary_comparison_sorted", "salary_delta_by_occupation", "salary_delta_by_occupation_sorted"])
def test_wages_and_geography_are_never_broadcast(spark, small_sf, default_broadcasts, key):
    import duckdb

    df = QUERIES[key](spark, small_sf)
    rows = [tuple(r) for r in df.collect()]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and rows
    for first in KEYS:
        assert f"SortMergeJoin [{first}#" in plan and f"BroadcastHashJoin [{first}#" not in plan, plan[:3000]
    con = duckdb.connect()
    for name in ("orders", "customer"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{small_sf}/{name}.parquet/*.parquet')")
    rel = con.sql(ORACLE[key])
    assert digest(df.columns, rows)[0] == digest(rel.columns, rel.fetchall())[0]
