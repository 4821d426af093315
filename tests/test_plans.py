"""Plan shape and whole-result properties."""

import os

from pyspark.sql import functions as F

import __spark_entry__ as entry
from rf_testdata import SF_SMALL
from recordforge.plans.catalog import QUERIES
from recordforge.operators import staging as stg
from recordforge.plans import tables as t
from recordforge.sources import fixtures as fx


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_any_plan(spark):
    for key, q in QUERIES.items():  # the optional training-data queries run Arrow-batched helpers
        text = plan_text(q(spark, SF_SMALL))
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text, key


def test_scans_prune_columns(spark):
    text = plan_text(entry.queries()["employer_staging"](spark, SF_SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint" in text
    assert "o_orderpriority" not in text and "o_orderstatus" not in text


def test_dedup_combines_before_shuffle(spark):
    text = plan_text(t.employer(spark, SF_SMALL))
    assert "partial_min_by" in text


def test_one_row_per_employer_key(spark):
    emp = t.employer(spark, SF_SMALL)
    assert emp.groupBy("employer_name", "employer_city").count().filter("count > 1").count() == 0
    assert emp.select("employer_id").distinct().count() == emp.count()


def test_link_never_adds_rows(spark):
    job = t.job(spark, SF_SMALL)
    assert job.count() <= t.job_temp(spark, SF_SMALL).count()


def test_union_all_count(spark):
    y = fx.yearly_applications(spark, SF_SMALL)
    apps = stg.application_rows(y)
    assert apps.count() == sum(df.filter(stg.valid_employer()).count() for df in y.values())


def test_accepted_plus_rejected(spark):
    temp = t.employer_temp(spark, SF_SMALL)
    assert t.employer_repaired(spark, SF_SMALL).count() + t.employer_rejects(spark, SF_SMALL).count() == temp.count()


def test_report_sums_to_labelled_rows(spark):
    labelled = t.employer_age_label(spark, SF_SMALL).filter(F.col("age_label").isNotNull()).count()
    total = t.employer_age_report(spark, SF_SMALL).agg(F.sum("employer_count")).first()[0]
    assert total == labelled


def test_same_result_any_shuffle_width(spark):
    from oracle_check import digest
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        res = []
        for n in ("1", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            df = t.employer(spark, SF_SMALL)
            res.append(digest(df.columns, [tuple(r) for r in df.collect()])[0])
        assert res[0] == res[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_nulls_spread_in_left_join(spark):
    from recordforge.operators.link import left_join_spread_nulls
    left = spark.createDataFrame([(i, None if i % 2 else f"n{i % 3}") for i in range(40)], "id int, k string")
    right = spark.createDataFrame([("n0", 1), ("n1", 2)], "k2 string, v int")
    out = left_join_spread_nulls(left, right, ["k"], ["k2"])
    assert out.count() == 40
    assert out.filter(F.col("v").isNotNull()).count() == len([i for i in range(40) if i % 2 == 0 and i % 3 < 2])


def test_partitioned_write_prunes(spark, scratch):
    from recordforge.sources.sinks import write_partitioned
    path = os.path.join(scratch, "wages")
    write_partitioned(t.wages(spark, SF_SMALL), path, ["year"], ["area"])
    df = spark.read.parquet(path).filter(F.col("year") == 2016)
    assert "PartitionFilters: [isnotnull(year" in plan_text(df)
    assert df.count() == t.wages(spark, SF_SMALL).filter(F.col("year") == 2016).count()


def test_table_sinks(spark, scratch):
    import pytest

    from recordforge import schemas
    from recordforge.sources.sinks import overwrite_existing, write_table
    path = os.path.join(scratch, "employer")
    write_table(t.employer(spark, SF_SMALL), path, schemas.EMPLOYER)
    back = spark.read.parquet(path)
    assert back.schema == schemas.EMPLOYER
    with pytest.raises(ValueError):
        overwrite_existing(spark, back, "rf_missing_table_xyz")


def test_salted_link_equals_plain_link(spark):
    from oracle_check import digest
    from recordforge.operators.link import link_to_first
    # one hot key holding most of the left rows
    left = spark.createDataFrame([(i, "HOT" if i % 3 else f"K{i % 7}") for i in range(300)], "id int, k string")
    right = spark.createDataFrame([("HOT", "e1"), ("K0", "e2"), ("K3", "e3"), ("K3", "e0")], "k string, eid string")
    plain = link_to_first(left, right, ["k"], "eid")
    salted = link_to_first(left, right, ["k"], "eid", salt_buckets=8)
    assert digest(plain.columns, [tuple(r) for r in plain.collect()]) == digest(salted.columns, [tuple(r) for r in salted.collect()])
    assert plain.filter("k = 'K3'").select("eid").distinct().first()[0] == "e0"


def test_small_join_side_broadcast_on_measured_size(spark):
    """Static planning never broadcasts (threshold -1); AQE does, once the side is measured."""
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    df = t.salary_comparison(spark, SF_SMALL)
    df.collect()  # executes this DataFrame's own plan (small at this scale)
    final = plan_text(df)
    assert "isFinalPlan=true" in final
    assert "BroadcastHashJoin" in final


def test_sized_conf():
    from recordforge.session import sized_conf
    tb = 1024 ** 4
    conf = sized_conf(100 * tb, shuffle_ratio=0.5, cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 50 * 4096       # 50 TB / 256 MB
    assert conf["spark.sql.autoBroadcastJoinThreshold"] == "-1"
    assert int(sized_conf(10 ** 6, cores=8)["spark.sql.shuffle.partitions"]) == 16


def test_attorney_join_match_state_option(spark):
    y = fx.yearly_applications(spark, SF_SMALL)
    loose = stg.application_staging(y)
    strict = stg.application_staging(y, match_state=True)
    assert strict.count() == stg.application_rows(y).count()
    assert loose.count() >= strict.count()
    assert strict.select("case_number").distinct().count() == strict.count()


def test_salted_job_link_on_real_pipeline(spark):
    from oracle_check import digest
    from recordforge.operators.link import link_to_first
    jobs = t.job_repaired(t.with_link_key(t.job_temp(spark, SF_SMALL)))
    emp = t.employer(spark, SF_SMALL).select("employer_id", *t.EMPLOYER_KEY)
    plain = link_to_first(jobs, emp, t.EMPLOYER_KEY, "employer_id", right_unique=True).select(*t.JOB_OUTPUT)
    salted = link_to_first(jobs, emp, t.EMPLOYER_KEY, "employer_id", right_unique=True, salt_buckets=16).select(*t.JOB_OUTPUT)
    assert digest(plain.columns, [tuple(r) for r in plain.collect()]) == digest(salted.columns, [tuple(r) for r in salted.collect()])


def test_checkpoint_dir_comes_from_the_session(spark):
    from recordforge.session import ensure_checkpoint_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    path = ensure_checkpoint_dir(spark)
    assert path
    if configured:
        assert path == configured
    assert spark.sparkContext.getCheckpointDir()


def test_aqe_splits_hot_key_in_link(spark):
    """J4 with one key holding half the left rows: AQE's skew join splits that partition."""
    from oracle_check import digest
    from recordforge.operators.link import link_to_first
    conf = {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        left = spark.range(20000).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 'HOT' ELSE concat('K', id % 500) END AS k",
                                             "repeat('x', 20) AS pad")
        right = spark.range(500).selectExpr("concat('K', id) AS k", "concat('E', id) AS eid").unionByName(
            spark.createDataFrame([("HOT", "E-hot")], "k string, eid string"))
        out = link_to_first(left, right, ["k"], "eid", right_unique=True)
        rows = [tuple(r) for r in out.collect()]
        final = plan_text(out)
        assert "skew=true" in final, final[:2000]
        assert len(rows) == 20000
        plain = left.join(right, "k")
        assert digest(out.columns, rows) == digest(plain.columns, [tuple(r) for r in plain.collect()])
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_cluster_session_needs_a_shared_checkpoint_dir(monkeypatch):
    import pytest

    from recordforge import session

    class FakeContext:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class FakeConf:
        def get(self, key, default=None):
            return default

    class FakeSession:
        sparkContext = FakeContext()
        conf = FakeConf()

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(FakeSession())


def test_results_follow_the_files_present_now(spark, scratch):
    import shutil

    for name in ("orders", "customer"):
        os.makedirs(os.path.join(scratch, f"{name}.parquet"))
        shutil.copy(f"{SF_SMALL}/{name}.parquet", os.path.join(scratch, f"{name}.parquet", "a.parquet"))
    before = QUERIES["valid_applications"](spark, scratch).count()
    shutil.copy(f"{SF_SMALL}/orders.parquet", os.path.join(scratch, "orders.parquet", "b.parquet"))
    assert QUERIES["valid_applications"](spark, scratch).count() == 2 * before > 0


def test_missing_registry_and_missing_column_raise(spark):
    import pytest

    from recordforge import schemas
    from recordforge.operators.registrations import merge_registrations

    with pytest.raises(ValueError):
        merge_registrations({})
    with pytest.raises(ValueError):
        schemas.conform(spark.createDataFrame([("x",)], "case_number string"), schemas.NEW_JOB)


def test_rounding_is_one_step_and_takes_large_values(spark):
    from recordforge.functions.text import round_half_up

    got = [r[0] for r in spark.createDataFrame([(2.0049999996,), (1e15 + 0.5,), (1.005,), (None,)], "x double").select(round_half_up("x")).collect()]
    assert got == [2.0, 1e15 + 0.5, 1.01, None]
