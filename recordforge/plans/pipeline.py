"""Write every target table, in dependency order.

Every table is written once and read back by the steps that use it (short lineage: a lost
executor re-runs only the step at hand).  The output folder must be shared storage on a cluster.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge import schemas
from recordforge.operators import staging as stg
from recordforge.operators.extract import split_extract
from recordforge.operators.registrations import RegistrySpec, clean_registrations, registration_rejects, registry_branch
from recordforge.operators.repair import repair_employers
from recordforge.plans import analytics as va
from recordforge.plans import tables as t
from recordforge.operators.wages import geography_of_year, wages_of_year
from recordforge.sources.sinks import (audit_stage, insert_partitions, overwrite_existing, run_id, write_bucketed_table, write_partitioned,
                                       write_table)
from recordforge.sources.text_source import read_extract_lines, with_line_numbers
from recordforge.sources.yearly import check_drift, read_yearly


def build_all(spark: SparkSession, sf_dir: str, out_dir: str, audit_dir: str | None = None,
              as_of: dt.date | None = None, employer_buckets: int = 0, employer_table: str = "employer_bucketed",
              sample_rows: int | None = None, registrations_table: str | None = None,
              applications: str | None = None) -> dict[str, str]:
    """Build the staged, cleaned and linked tables, their rejects and the two reports.

    Every staged table is written once and read back by its consumers.  Ages are taken at ``as_of``, by default the
    current date.  ``employer_buckets=N`` writes Employer as a catalog table bucketed by its link key
    (name, city), so the job and the application links read it without shuffling it again.
    ``sample_rows=N`` cleans and links only the first N rows of every staged table (a development run).
    ``registrations_table`` names an existing catalog table whose rows the cleaned registrations replace.
    ``applications`` is a path pattern of yearly application tables to read instead of those derived from
    ``sf_dir``.  Jobs and applications are joined with Employer once each: the join's rows, linked or not, are written
    under ``_links`` and both the table and its rejects are read from there.
    With ``audit_dir`` every stage is also written there as JSON.
    """
    out = out_dir.rstrip("/")
    run = run_id()
    paths: dict[str, str] = {}

    def put(name: str, df: DataFrame, schema=None, partition_by: list[str] | None = None, sort_by: list[str] | None = None) -> DataFrame:
        paths[name] = f"{out}/{name}"
        if partition_by:
            write_partitioned(df, paths[name], partition_by, sort_by)
        else:
            write_table(df, paths[name], schema)
        written = spark.read.parquet(paths[name])
        audit_stage(written, audit_dir, run, name)
        return written

    def stage(name: str, df: DataFrame, order: list[str]) -> DataFrame:
        return put(name, df if sample_rows is None else stg.sample_rows(df, sample_rows, order))

    def link(name: str, staged: DataFrame, employers: DataFrame) -> tuple[DataFrame, DataFrame]:
        links = t.attach_employer(staged, employers, hot_limit=4 * employer_buckets)
        tagged = links.withColumn("linked", F.col("employer_id").isNotNull().cast("int"))
        path = f"{out}/_links/{name}"
        tagged.write.mode("overwrite").partitionBy("linked").parquet(path)
        back = spark.read.schema(tagged.schema).parquet(path)
        return back.filter("linked = 1").drop("linked"), back.filter("linked = 0").drop("linked")

    yearly = t.yearly(spark, sf_dir)
    if applications is not None:
        yearly = read_yearly(spark, applications)
        for columns, rules in stg.STAGED:
            check_drift(yearly, columns, rules)
    employer_temp = stage("employer_temp", stg.employer_staging(yearly), ["employer_name", "employer_id"])
    attorney = put("attorney", stg.attorney_dim(yearly), schemas.ATTORNEY)
    job_temp = stage("job_temp", stg.job_staging(yearly), ["job_title", "job_id"])
    application_temp = stage("application_temp", stg.application_staging(yearly, attorney), ["case_number", "attorney_id"])

    put("employer_rejects", repair_employers(employer_temp)[1])
    if employer_buckets > 0:
        paths["employer"] = f"{out}/employer"
        employer = write_bucketed_table(spark, t.build_employer(employer_temp), employer_table, paths["employer"],
                                        t.EMPLOYER_KEY, employer_buckets, schemas.EMPLOYER)
        audit_stage(employer, audit_dir, run, "employer")
    else:
        employer = put("employer", t.build_employer(employer_temp), schemas.EMPLOYER)
    linked, unlinked = link("job", job_temp, employer)
    job = put("job", t.job_repaired(t.linked_rows(linked)).select(*t.JOB_OUTPUT), schemas.JOB)
    put("job_rejects", t.link_rejects(unlinked))
    linked, unlinked = link("application", application_temp, employer)
    put("application", t.linked_rows(linked).select(*t.APPLICATION_OUTPUT), schemas.APPLICATION)
    put("application_rejects", t.link_rejects(unlinked))

    merged = put("registrations_merged", t.registrations_merged(spark, sf_dir), partition_by=["corporation_state"])
    regs = put("registrations_cleaned", clean_registrations(merged), partition_by=["corporation_state"])
    put("registration_rejects", registration_rejects(merged))
    if registrations_table:
        overwrite_existing(spark, regs, registrations_table, schemas.REGISTRATIONS)
    wages = put("wages", t.wages(spark, sf_dir), partition_by=["year"], sort_by=["area", "soc_code"])
    geography = put("geography", t.geography(spark, sf_dir), partition_by=["year"], sort_by=["area"])

    tech = va.tech_jobs(job)
    tech_ids = tech.select("employer_id").distinct()  # an existence test needs an id once
    ages = va.tech_employer_age(va.tech_employers_13_states(employer, tech_ids), regs, as_of)
    put("employer_age_report", va.employer_age_report(va.employer_age_label(ages)))
    put("salary_delta_by_occupation", va.salary_delta_by_occupation(va.salary_comparison(tech, geography, wages)))
    return paths


def insert_wages(spark: SparkSession, table: DataFrame, year: int, path: str) -> None:
    """One year's wage table goes into the merged table at ``path``; run again, it replaces that year only."""
    insert_partitions(wages_of_year(table, year), path, ["year"], ["area", "soc_code"], schemas.WAGES)


def insert_geography(spark: SparkSession, table: DataFrame, year: int, path: str) -> None:
    insert_partitions(geography_of_year(table, year), path, ["year"], ["area"], schemas.GEOGRAPHY)


def insert_registry(spark: SparkSession, spec: RegistrySpec, sources: dict[str, DataFrame], path: str) -> None:
    """One state's registry goes into the merged registrations at ``path``; run again, it replaces that state only."""
    insert_partitions(registry_branch(spec, sources), path, ["corporation_state"], ["corporation_id"], schemas.REGISTRATIONS)


def split_extract_files(spark: SparkSession, input_paths: str | list[str], out_dir: str) -> dict[str, str]:
    """Split extract files into New_Application / New_Job / New_Employer / New_Attorney (+ rejects).

    Every reject names its file and its line there (``source_file``, ``source_line``).
    """
    lines = read_extract_lines(spark, input_paths, origin=True)
    return write_extract(lines, out_dir, lambda rejects: with_line_numbers(rejects, spark, input_paths))


def write_extract(lines: DataFrame, out_dir: str, name_rejects: Callable[[DataFrame], DataFrame] = lambda rejects: rejects) -> dict[str, str]:
    parts = split_extract(lines, persist=True)
    parts["rejects"] = name_rejects(parts["rejects"])
    out = out_dir.rstrip("/")
    targets = {
        "application": schemas.NEW_APPLICATION, "job": schemas.NEW_JOB,
        "employer": schemas.NEW_EMPLOYER, "attorney": schemas.NEW_ATTORNEY, "rejects": None,
    }
    paths = {}
    try:
        for name, schema in targets.items():
            paths[name] = f"{out}/{name}"
            write_table(parts[name], paths[name], schema)
    finally:
        parts["parsed"].unpersist()
    return paths
