"""Sources by path pattern, SQL texts over views, inserts, clustering, table replacement, origins of rejects."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from rf_testdata import SF_SMALL

from oracle_check import digest
from recordforge import schemas
from recordforge.operators import staging as stg
from recordforge.operators.registrations import SPECS_BY_STATE
from recordforge.plans import pipeline
from recordforge.plans import tables as t
from recordforge.plans.views import source
from recordforge.sources import fixtures as fx
from recordforge.sources import sinks
from recordforge.sources.yearly import check_drift, find_yearly, read_yearly


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    cols = sorted(df.columns)
    return digest(cols, [tuple(r) for r in df.select(*cols).collect()])[0]


# ---- one pass over shared sources

@pytest.mark.parametrize("plan,table,scans", [
    (t.employer_temp, "orders", 1), (t.job_temp, "orders", 1), (t.attorney, "orders", 1), (t.application_temp, "orders", 2),
    (t.wages, "customer", 1), (t.geography, "customer", 1),
    (t.registrations_merged, "customer", 7),       # ten registries in one pass, three kept in two tables each
    (t.employer_age_report, "orders", 2), (t.employer_age_report, "customer", 7),
])
def test_scans_of_a_shared_source(spark, plan, table, scans):
    text = plan_text(plan(spark, SF_SMALL))
    assert sum(f"/{table}.parquet" in line for line in text.split("\n") if "FileScan" in line) == scans


def test_one_pass_equals_a_union_of_tables(spark):
    tables = fx.yearly_applications(spark, SF_SMALL)
    shared = fx.shared_applications(spark, SF_SMALL)
    for build in (stg.employer_staging, stg.job_staging, stg.attorney_dim, stg.application_staging):
        assert rows_of(build(tables)) == rows_of(build(shared))
    from recordforge.operators.registrations import merge_registrations
    assert rows_of(merge_registrations(fx.registry_sources(spark, SF_SMALL))) == rows_of(t.registrations_merged(spark, SF_SMALL))


# ---- S4: tables by a path pattern

def write_years(spark, root):
    for year, table in fx.yearly_applications(spark, SF_SMALL).items():
        table.repartition(2).write.parquet(f"{root}/H1B_Applications_{year}")
    return f"{root}/H1B_Applications_*"


def test_new_year_is_read_without_a_change(spark, scratch):
    pattern = write_years(spark, scratch)
    assert sorted(find_yearly(spark, pattern)) == [2015, 2016, 2017, 2018]
    assert rows_of(stg.attorney_dim(read_yearly(spark, pattern))) == rows_of(t.attorney(spark, SF_SMALL))
    fresh = (fx.yearly_applications(spark, SF_SMALL)[2017]
             .withColumns({"agent_attorney_name": F.lit("NEW ATTORNEY"), "case_submitted": F.lit(None).cast("date"),
                           "decision_date": F.lit(None).cast("date"), "new_column": F.lit(1),
                           "employment_start_date": F.to_date("employment_start_date"), "employment_end_date": F.to_date("employment_end_date")}))
    fresh.write.parquet(f"{scratch}/H1B_Applications_2019.parquet")
    yearly = read_yearly(spark, pattern)
    assert sorted(yearly) == [2015, 2016, 2017, 2018, 2019]
    for columns, rules in stg.STAGED:
        check_drift(yearly, columns, rules)
    assert stg.attorney_dim(yearly).where("attorney_name = 'NEW ATTORNEY'").count() > 0
    assert stg.job_staging(yearly).count() >= t.job_temp(spark, SF_SMALL).count()
    paths = pipeline.build_all(spark, SF_SMALL, f"{scratch}/out", sample_rows=20, applications=pattern)
    assert spark.read.parquet(paths["attorney"]).where("attorney_name = 'NEW ATTORNEY'").count() > 0


def test_drift_and_bad_names_raise(spark, scratch):
    pattern = write_years(spark, scratch)
    table = fx.yearly_applications(spark, SF_SMALL)[2017]
    table.withColumnRenamed("agent_attorney_city", "attorney_town").write.parquet(f"{scratch}/H1B_Applications_2019")
    attorney = stg.STAGED[-1]
    with pytest.raises(ValueError, match="2019.*agent_attorney_city"):
        read_yearly(spark, pattern, *attorney)
    table.withColumn("willful_violator", F.lit("no")).write.parquet(f"{scratch}/H1B_Applications_2019_b")
    with pytest.raises(ValueError, match="no year"):
        find_yearly(spark, pattern)
    with pytest.raises(ValueError, match="2017.*willful_violator is string"):
        check_drift({2017: spark.read.parquet(f"{scratch}/H1B_Applications_2019_b")}, *stg.STAGED[0])
    table.write.parquet(f"{scratch}/more/H1B_Applications_2017")
    with pytest.raises(ValueError, match="two tables of 2017"):
        find_yearly(spark, f"{scratch}/{{,more/}}H1B_Applications_201[5-8]")


# ---- S3, S12: SQL text over named views

def test_query_text_is_pruned_to_its_scan(spark):
    df = source(spark, SF_SMALL, "SELECT area, county FROM geography WHERE area > 100 AND year = 2016")
    text = plan_text(df)
    assert "ReadSchema: struct<c_custkey:bigint>" in text
    assert df.count() == t.geography(spark, SF_SMALL).where("area > 100 and year = 2016").count() > 0
    scan = source(spark, SF_SMALL, "SELECT case_number FROM application")
    assert "o_totalprice" not in plan_text(scan).split("ReadSchema")[-1]


def test_only_named_views_are_defined(spark):
    spark.catalog.dropTempView("employer")
    source(spark, SF_SMALL, "SELECT count(*) FROM v_tech_employer_13_states")
    assert not spark.catalog.tableExists("employer") and spark.catalog.tableExists("v_tech_employer_13_states")
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        source(spark, SF_SMALL, "SELECT 1 FROM no_such_table")


# ---- S11: inserts

def files_of(path, part):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/{part}/*.parquet")}


def test_insert_of_a_year_leaves_the_others_alone(spark, scratch):
    path = f"{scratch}/wages"
    for year in fx.YEARS:
        pipeline.insert_wages(spark, fx.yearly_wages(spark, SF_SMALL).table(year), year, path)
    assert rows_of(spark.read.schema(schemas.WAGES).parquet(path)) == rows_of(t.wages(spark, SF_SMALL))
    before = files_of(path, "year=201[5-8]")
    fifth = fx.yearly_wages(spark, SF_SMALL).table(2018)
    for _ in range(2):  # run again: no duplicate
        pipeline.insert_wages(spark, fifth, 2019, path)
        back = spark.read.parquet(path)
        assert back.where("year = 2019").count() == fifth.count()
        assert back.count() == t.wages(spark, SF_SMALL).count() + fifth.count()
    assert files_of(path, "year=201[5-8]") == before


def test_insert_of_registries_and_geography(spark, scratch):
    sources = fx.registry_sources(spark, SF_SMALL)
    path = f"{scratch}/registrations"
    for state in ("GA", "MN", "CA", "GA"):
        pipeline.insert_registry(spark, SPECS_BY_STATE[state], sources, path)
    merged = t.registrations_merged(spark, SF_SMALL).where("corporation_state in ('GA', 'MN', 'CA')")
    assert rows_of(spark.read.schema(schemas.REGISTRATIONS).parquet(path)) == rows_of(merged)
    path = f"{scratch}/geography"
    for year in fx.YEARS:
        pipeline.insert_geography(spark, fx.yearly_geography(spark, SF_SMALL).table(year), year, path)
    assert rows_of(spark.read.schema(schemas.GEOGRAPHY).parquet(path)) == rows_of(t.geography(spark, SF_SMALL))


# ---- S10: clustering

def ranges(path, column):
    out = []
    for f in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.to_arrow_schema().get_field_index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        out.append((f, min(s.min for s in stats), max(s.max for s in stats)))
    return out


def test_files_hold_ranges_that_prune(spark, scratch):
    wages = t.wages(spark, SF_SMALL)
    sinks.write_partitioned(wages, f"{scratch}/w", ["year"], ["area", "soc_code"], files=12)
    files = ranges(f"{scratch}/w", "area")
    assert len(files) >= 12
    wanted = 77
    hit = [f for f, low, high in files if low <= wanted <= high]
    assert len(hit) <= 2 * len(fx.YEARS) < len(files)  # one file a year, or two where a range ends at the value
    back = spark.read.parquet(f"{scratch}/w").where(F.col("area") == wanted)
    holding = {r[0] for r in back.select(F.input_file_name()).distinct().collect()}
    assert {os.path.basename(f) for f in holding} <= {os.path.basename(f) for f in hit}
    assert "PushedFilters: [IsNotNull(area), EqualTo(area,77)]" in plan_text(back)
    assert back.count() == wages.where("area = 77").count()


def test_a_hot_value_is_cut_over_several_files(spark, scratch):
    hot = spark.range(5000).selectExpr("cast(1 as bigint) as year", "cast(if(id < 4000, 7, id) as bigint) as area", "id as n")
    sinks.write_partitioned(hot, f"{scratch}/h", ["year"], ["area"], files=10)
    assert sum(low <= 7 <= high for _, low, high in ranges(f"{scratch}/h", "area")) >= 6
    assert spark.read.parquet(f"{scratch}/h").count() == 5000


# ---- S9: replacement of catalog tables

def test_failed_replacement_keeps_the_old_table(spark, scratch):
    name, path = "rf_test_replaced", f"{scratch}/tables"
    try:
        first = sinks.replace_table(spark, t.wages(spark, SF_SMALL), name, path, schemas.WAGES, ["year"], ["area"])
        want = rows_of(t.wages(spark, SF_SMALL))
        assert rows_of(first.select(*schemas.WAGES.names)) == want
        failing = t.wages(spark, SF_SMALL).withColumn("annual_salary", F.when(F.col("area") == 77, F.raise_error(F.lit("task fails")).cast("double")).otherwise(F.col("annual_salary")))
        with pytest.raises(Exception, match="task fails"):
            sinks.replace_table(spark, failing, name, path, schemas.WAGES, ["year"])
        assert len(os.listdir(path)) == 1
        assert rows_of(spark.table(name).select(*schemas.WAGES.names)) == want
        assert not spark.catalog.tableExists(f"{name}__building")
        # other columns, read from the table it replaces
        smaller = sinks.replace_table(spark, spark.table(name).where("year = 2016").select("area", "soc_code"), name, path)
        assert smaller.columns == ["area", "soc_code"] and smaller.count() == t.wages(spark, SF_SMALL).where("year = 2016").count()
        # a run that stopped between the renames
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}__last")
        again = sinks.replace_table(spark, spark.range(3).toDF("x"), name, path)
        assert again.count() == 3 and len(os.listdir(path)) == 1 and not spark.catalog.tableExists(f"{name}__last")
    finally:
        for suffix in ("", "__last", "__building"):
            spark.sql(f"DROP TABLE IF EXISTS {name}{suffix}")


# ---- A4, A5: exact means

def test_means_do_not_depend_on_the_spread_of_rows(spark):
    from recordforge.plans import analytics as va
    rows = spark.range(20000).selectExpr(
        "'a' as soc_code", "cast(id % 3 as string) as soc_name", "cast(id * 0.1 + 1e9 * (id % 2) as double) as h1b_job_salary",
        "cast(if(id % 7 = 0, null, id / 3.0) as double) as national_average_salary")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    seen = set()
    try:
        for n in (1, 7, 200):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            seen.add(tuple(sorted(map(tuple, va.salary_delta_by_occupation(rows.repartition(n)).collect()))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert len(seen) == 1
    pairs = spark.createDataFrame([("x", "x", 1.0, 1.01), ("x", "x", 1.01, 1.0), ("y", "y", 0.005, None), ("z", "z", -0.005, 0.0)],
                                  "soc_code string, soc_name string, h1b_job_salary double, national_average_salary double")
    got = {r[0]: tuple(r)[2:] for r in va.salary_delta_by_occupation(pairs).collect()}
    assert got == {"x": (1.01, 1.01, 0.0), "y": (0.01, None, None), "z": (-0.01, 0.0, -0.01)}


# ---- S1, S2: where a reject stands

def test_rejects_name_their_file_and_line(spark, scratch):
    lines = [r["value"] for r in fx.extract_lines(spark, SF_SMALL).orderBy("value").collect()]
    os.makedirs(f"{scratch}/in")
    for k in range(2):
        with open(f"{scratch}/in/part{k}.txt", "w") as f:
            f.write("\n".join(["CASE_NUMBER\tX", *lines[k::2]]) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")  # many splits a file
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        paths = pipeline.split_extract_files(spark, f"{scratch}/in", f"{scratch}/out")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    found = spark.read.parquet(paths["rejects"]).collect()
    assert len(found) == sum(len(x.strip().split("\t")) < 41 for x in lines) > 5
    text = {name: open(f"{scratch}/in/{name}").read().split("\n") for name in ("part0.txt", "part1.txt")}
    for r in found:
        assert text[os.path.basename(r["source_file"])][r["source_line"] - 1] == r["line"]
