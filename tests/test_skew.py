"""Hot keys in the registered plans: adaptive execution splits them, and the rows stay those of the SQL."""

import os

import pytest
from oracle_check import digest, duck_conn
from pyspark.sql import functions as F
from rf_testdata import SF_SMALL

from recordforge.operators.link import hot_keys, join_hot_keys_apart, spread_join
from recordforge.plans import tables as t
from recordforge.plans.catalog import ORACLE, QUERIES

HOT_CUSTOMER = 79  # employer CUSTOMER 26 of CITY 1, registered in CA


@pytest.fixture(scope="module")
def hot_sf(spark, tmp_path_factory):
    """The small tables with 60 % of the orders and nearly all customer rows on one customer."""
    root = str(tmp_path_factory.mktemp("hot"))
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 5 < 3, F.lit(HOT_CUSTOMER).cast("long")).otherwise(F.col("o_custkey"))) \
        .coalesce(1).write.parquet(os.path.join(root, "orders.parquet"))
    customer = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    copies = customer.where(F.col("c_custkey") == HOT_CUSTOMER).crossJoin(spark.range(20_000)).drop("id")
    customer.unionByName(copies).coalesce(1).write.parquet(os.path.join(root, "customer.parquet"))
    return root


@pytest.fixture()
def shuffled_joins(spark):
    """No broadcasts, small partitions: what a large input meets."""
    conf = {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def rows_of(df):
    return digest(df.columns, [tuple(r) for r in df.collect()])[0]


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["job_link_employer", "application_link_employer", "tech_jobs", "tech_employer_age", "job_rejects"])
def test_registered_plans_split_a_hot_key(spark, hot_sf, shuffled_joins, key):
    df = QUERIES[key](spark, hot_sf)
    got = rows_of(df)
    assert "SortMergeJoin(skew=true)" in final_plan(df), final_plan(df)[:3000]
    rel = duck_conn_of(hot_sf).sql(ORACLE[key])
    assert got == digest(rel.columns, rel.fetchall())[0]


def duck_conn_of(root):
    import duckdb

    con = duckdb.connect()
    for name in ("orders", "customer"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{root}/{name}.parquet/*.parquet')")
    return con


def test_hot_unlinked_key_is_split_and_rows_add_up(spark, hot_sf, shuffled_joins):
    staged = t.job_temp(spark, hot_sf)
    employers = t.employer(spark, hot_sf).where("employer_name != 'CUSTOMER 26'")
    links = t.attach_employer(staged, employers)
    everything = links.collect()
    assert "SortMergeJoin(skew=true)" in final_plan(links)
    n = len(everything)
    unlinked = t.link_rejects(links)
    assert n == staged.count() == t.linked_rows(links).count() + unlinked.count()
    hot = unlinked.where("reject_reason = 'no employer with this name and city' and employer_name like 'CUSTOMER 26%'").count()
    assert hot > n / 2


def test_hot_keys_apart_from_a_bucketed_side(spark, hot_sf, shuffled_joins, scratch):
    from recordforge import schemas
    from recordforge.sources.sinks import write_bucketed_table
    try:
        employers = write_bucketed_table(spark, t.employer(spark, hot_sf), "rf_test_hot_employer", os.path.join(scratch, "e"),
                                         t.EMPLOYER_KEY, 4, schemas.EMPLOYER)
        staged = t.job_temp(spark, hot_sf)
        links = t.attach_employer(staged, employers, hot_limit=16)
        assert rows_of(links) == rows_of(t.attach_employer(staged, t.employer(spark, hot_sf)))
        text = final_plan(links)
        assert "BroadcastHashJoin" in text and "SelectedBucketsCount: 4 out of 4" in text
        keyed = t.with_link_key(staged)
        assert hot_keys(keyed, t.EMPLOYER_KEY, 16) == [("CUSTOMER 26", "CITY 1")]
    finally:
        spark.sql("DROP TABLE IF EXISTS rf_test_hot_employer")


def test_hot_keys_are_few_whatever_the_input(spark):
    df = spark.range(1000).selectExpr("cast(id % 10 as string) as k", "id").unionByName(
        spark.range(50).selectExpr("cast(null as string) as k", "id"))
    assert len(hot_keys(df, ["k"], 10)) == 0 and len(hot_keys(df, ["k"], 11)) == 10
    right = spark.createDataFrame([(str(i), i * 7) for i in range(0, 12, 2)], "k string, v int")
    for how in ("inner", "left"):
        plain = rows_of(df.join(right, "k", how))
        assert rows_of(join_hot_keys_apart(df, right, ["k"], how, 11)) == plain
        assert rows_of(join_hot_keys_apart(df, right, ["k"], how, 10)) == plain
        assert rows_of(spread_join(df, right, ["k"], how)) == plain
