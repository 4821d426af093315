"""The table writer end to end: every target written, counts equal to the query plans."""

import os

import pytest

from rf_testdata import SF_SMALL
from recordforge.plans import pipeline
from recordforge.plans import tables as t
from recordforge.sources import fixtures as fx


@pytest.mark.parametrize("buckets", [0, 4])
def test_build_all(spark, scratch, buckets):
    out, audit = os.path.join(scratch, "out"), os.path.join(scratch, "audit")
    table = f"rf_test_regs_{buckets}"
    spark.sql(f"CREATE TABLE {table} (corporation_id string, corporation_name string, corporation_city string, "
              f"corporation_state string, registration_date date) USING parquet LOCATION '{os.path.join(scratch, table)}'")
    spark.sql(f"INSERT INTO {table} VALUES ('old', 'old', 'old', 'XX', null)")
    paths = pipeline.build_all(spark, SF_SMALL, out, audit_dir=audit, as_of=t.AS_OF, employer_buckets=buckets,
                               employer_table=f"rf_test_emp_{buckets}", registrations_table=table)
    from oracle_check import digest

    def rows(df):
        cols = sorted(df.columns)
        return digest(cols, [tuple(r) for r in df.select(*cols).collect()])

    plans = {"employer_temp": t.employer_temp, "job_temp": t.job_temp, "application_temp": t.application_temp, "attorney": t.attorney,
             "employer": t.employer, "job": t.job, "application": t.application, "registrations_merged": t.registrations_merged,
             "registrations_cleaned": t.registrations_cleaned, "wages": t.wages, "geography": t.geography,
             "employer_rejects": t.employer_rejects, "job_rejects": t.job_rejects, "application_rejects": t.application_rejects,
             "registration_rejects": t.registration_rejects, "employer_age_report": t.employer_age_report,
             "salary_delta_by_occupation": t.salary_delta_by_occupation}
    assert set(plans) == set(paths)
    written = {n: spark.read.parquet(p) for n, p in paths.items()}
    for n, plan in plans.items():
        if buckets and n not in ("employer", "job", "application"):  # the others do not depend on it
            continue
        expected = plan(spark, SF_SMALL)
        if n in ("wages", "geography"):  # a folder name is read back as int
            written[n] = written[n].withColumn("year", written[n]["year"].cast("long"))
        assert rows(written[n]) == rows(expected), n
    assert rows(spark.table(table)) == rows(written["registrations_cleaned"])
    # nothing vanishes: kept and rejected add up
    n = {k: df.count() for k, df in written.items()}
    assert n["job"] + n["job_rejects"] == n["job_temp"]
    assert n["application"] + n["application_rejects"] == n["application_temp"]
    assert n["registrations_cleaned"] + n["registration_rejects"] == n["registrations_merged"]
    runs = os.listdir(audit)
    assert len(runs) == 1 and set(os.listdir(os.path.join(audit, runs[0]))) == set(paths)
    spark.sql(f"DROP TABLE {table}")


def test_build_sample_with_current_date(spark, scratch):
    paths = pipeline.build_all(spark, SF_SMALL, os.path.join(scratch, "out"), sample_rows=50)
    for n in ("employer_temp", "job_temp", "application_temp"):
        assert spark.read.parquet(paths[n]).count() == 50


def test_split_extract_files(spark, scratch):
    src = os.path.join(scratch, "lines")
    fx.extract_lines(spark, SF_SMALL).write.text(src)
    paths = pipeline.split_extract_files(spark, src, os.path.join(scratch, "split"))
    n_lines = spark.read.text(src).count()
    accepted = spark.read.parquet(paths["application"]).count()
    rejected = spark.read.parquet(paths["rejects"]).count()
    assert accepted + rejected == n_lines and rejected > 0


def test_bucketed_employer_is_not_shuffled_again(spark, scratch):
    from recordforge import schemas
    from recordforge.sources.sinks import write_bucketed_table
    old = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")   # force a shuffled join
    try:
        emp = write_bucketed_table(spark, t.employer(spark, SF_SMALL), "rf_test_employer_bucketed",
                                   os.path.join(scratch, "employer"), t.EMPLOYER_KEY, 4, schemas.EMPLOYER)
        job = t.job(spark, SF_SMALL, emp)
        plan = job._jdf.queryExecution().executedPlan().toString()
        scan = [line for line in plan.split("\n") if "rf_test_employer_bucketed" in line or "SelectedBucketsCount" in line]
        assert any("SelectedBucketsCount: 4 out of 4" in line for line in scan), plan[:3000]
        # exactly one side of the link is shuffled on the link key
        assert plan.count("Exchange hashpartitioning(employer_name") == 1
        assert job.count() == t.job(spark, SF_SMALL).count()
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS rf_test_employer_bucketed")
