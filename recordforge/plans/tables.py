"""End-to-end table builds: each function returns the lazy plan of one target table.

Every plan starts from the input adapters (``sources.fixtures``), so its work grows with
the driver's tables.  ``pipeline.build_all`` writes them in dependency order; here they
are composed without intermediate writes so Catalyst sees (and prunes) the whole plan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge.functions.text import normalize_org_name
from recordforge.operators import staging as stg
from recordforge.operators.dedup import first_per_key
from recordforge.operators.link import join_hot_keys_apart, link_to_first, spread_join
from recordforge.operators.registrations import clean_registrations, merge_registrations, registration_rejects as rejected_registrations
from recordforge.operators.repair import (
    link_city,
    repair_employers,
    repair_soc,
    repair_wage_fields,
    repair_worksite,
)
from recordforge.operators.wages import merge_geography, merge_wages
from recordforge.plans import analytics as va
from recordforge.sources import fixtures as fx

AS_OF = dt.date(2018, 12, 31)
EMPLOYER_KEY = ["employer_name", "employer_city"]

JOB_OUTPUT = (
    "job_id", "employer_id", "employment_start_year", "employment_start_date", "employment_end_date", "job_title",
    "wage_rate_of_pay_from", "wage_rate_of_pay_to", "wage_unit_of_pay", "worksite_city", "worksite_county",
    "worksite_state", "worksite_postal_code", "soc_code", "soc_name", "total_workers", "full_time_position",
    "prevailing_wage", "pw_unit_of_pay", "pw_source", "pw_source_year", "pw_source_other",
)
APPLICATION_OUTPUT = ("case_number", "case_status", "case_submitted", "decision_date", "visa_class", "employer_id", "attorney_id")


def yearly(spark: SparkSession, sf: str) -> stg.Yearly:
    return fx.shared_applications(spark, sf)


# -- staging -----------------------------------------------------------------------------

def employer_temp(spark: SparkSession, sf: str) -> DataFrame:
    return stg.employer_staging(yearly(spark, sf))


def job_temp(spark: SparkSession, sf: str) -> DataFrame:
    return stg.job_staging(yearly(spark, sf))


def attorney(spark: SparkSession, sf: str) -> DataFrame:
    return stg.attorney_dim(yearly(spark, sf))


def application_temp(spark: SparkSession, sf: str) -> DataFrame:
    y = yearly(spark, sf)
    return stg.application_staging(y, stg.attorney_dim(y))


# -- employers -----------------------------------------------------------------------------

def employer_repaired(spark: SparkSession, sf: str) -> DataFrame:
    return repair_employers(employer_temp(spark, sf))[0]


def employer_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return repair_employers(employer_temp(spark, sf))[1]


def employer(spark: SparkSession, sf: str) -> DataFrame:
    """Employer: repaired rows, one per (name, city), the smallest employer_id winning."""
    return build_employer(stg.employer_staging(yearly(spark, sf), distinct=False))


def build_employer(staged: DataFrame) -> DataFrame:
    """Employer from staged rows, repeated or not: equal rows have equal ids, and one row per key stays."""
    return first_per_key(repair_employers(staged)[0], EMPLOYER_KEY, "employer_id")


# -- jobs and applications -----------------------------------------------------------------

def with_link_key(df: DataFrame) -> DataFrame:
    """D1 + D3 on the employer name and city of a job or application; rows without a city go."""
    return df.withColumns({
        "employer_name": normalize_org_name(F.col("employer_name")),
        "employer_city": link_city(F.col("employer_city"), F.col("employer_state")),
    }).filter(F.col("employer_city").isNotNull())


NO_CITY = "no city after repair"
NO_EMPLOYER = "no employer with this name and city"


def attach_employer(staged: DataFrame, employers: DataFrame, hot_limit: int = 0) -> DataFrame:
    """Every staged job or application with its employer's id, or a reason why it has none.

    One left join gives the linked and the unlinked rows.  Columns: the staged ones, ``link_name`` and ``link_city``
    (the repaired key), ``employer_id``, ``reject_reason``.  Rows without a city match nothing and are spread over all tasks; a hot key
    is split, linked or not.  ``hot_limit=N`` is for employers bucketed by their key: they are not
    shuffled, and jobs of a key with more than one N-th of all rows are joined apart.
    """
    name, city = "link_name", "link_city"
    keyed = staged.withColumns({name: normalize_org_name(F.col("employer_name")),
                                city: link_city(F.col("employer_city"), F.col("employer_state"))})
    by_key = employers.select("employer_id", F.col("employer_name").alias(name), F.col("employer_city").alias(city))
    if hot_limit:
        linked = join_hot_keys_apart(keyed, by_key, [name, city], "left", hot_limit)
    else:
        linked = spread_join(keyed, by_key, [name, city], "left")
    return linked.withColumn("reject_reason", F.when(F.col(city).isNull(), NO_CITY).when(F.col("employer_id").isNull(), NO_EMPLOYER))


def link_rejects(links: DataFrame) -> DataFrame:
    """The jobs or applications of ``attach_employer`` that get no employer, as they came, with a reason."""
    return links.filter(F.col("employer_id").isNull()).drop("link_name", "link_city", "employer_id")


def linked_rows(links: DataFrame) -> DataFrame:
    """The jobs or applications of ``attach_employer`` that have an employer, under their repaired key."""
    return links.filter(F.col("employer_id").isNotNull()).withColumns(
        {"employer_name": F.col("link_name"), "employer_city": F.col("link_city")}).drop("link_name", "link_city", "reject_reason")


def job_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return link_rejects(attach_employer(job_temp(spark, sf), employer(spark, sf)))


def application_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return link_rejects(attach_employer(application_temp(spark, sf), employer(spark, sf)))


def job_repaired(jobs: DataFrame) -> DataFrame:
    """D4-D6 plus the start year (they read job columns only, so they run before the join)."""
    jobs = jobs.withColumn("employment_start_year", F.year("employment_start_date").cast("bigint"))
    return repair_wage_fields(repair_soc(repair_worksite(jobs)))


def job(spark: SparkSession, sf: str, employers: DataFrame | None = None, staged: DataFrame | None = None) -> DataFrame:
    """Job: cleaned jobs linked to their employer's id."""
    emp = (employers if employers is not None else employer(spark, sf)).select("employer_id", *EMPLOYER_KEY)
    jobs = job_repaired(with_link_key(staged if staged is not None else job_temp(spark, sf)))
    # an Employer computed here comes out of an aggregate by the link key, a given one out of a written table
    return link_to_first(jobs, emp, EMPLOYER_KEY, "employer_id", right_unique=True, spread=employers is None).select(*JOB_OUTPUT)


def application(spark: SparkSession, sf: str, employers: DataFrame | None = None, staged: DataFrame | None = None) -> DataFrame:
    """Application: applications linked to their employer's id."""
    emp = (employers if employers is not None else employer(spark, sf)).select("employer_id", *EMPLOYER_KEY)
    apps = with_link_key(staged if staged is not None else application_temp(spark, sf))
    return link_to_first(apps, emp, EMPLOYER_KEY, "employer_id", right_unique=True, spread=employers is None).select(*APPLICATION_OUTPUT)


# -- registrations, wages, geography -------------------------------------------------------

def registrations_merged(spark: SparkSession, sf: str) -> DataFrame:
    return merge_registrations(fx.two_part_registries(spark, sf), shared=fx.shared_registries(spark, sf))


def registrations_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return clean_registrations(registrations_merged(spark, sf))


def registration_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return rejected_registrations(registrations_merged(spark, sf))


def wages(spark: SparkSession, sf: str) -> DataFrame:
    return merge_wages(fx.yearly_wages(spark, sf))


def geography(spark: SparkSession, sf: str) -> DataFrame:
    return merge_geography(fx.yearly_geography(spark, sf))


# -- views -----------------------------------------------------------------------------------

def tech_jobs(spark: SparkSession, sf: str) -> DataFrame:
    return va.tech_jobs(job(spark, sf))


def tech_job_keys(spark: SparkSession, sf: str) -> DataFrame:
    """(employer_name, employer_city) pairs of repaired job rows with a tech occupation.

    Distinct before the semi join: an existence test needs a key once, and the aggregate combines a
    hot employer's rows before the shuffle.
    """
    jobs = job_repaired(with_link_key(job_temp(spark, sf)))
    return va.tech_jobs(jobs).select(*EMPLOYER_KEY).distinct()


def tech_employers(spark: SparkSession, sf: str) -> DataFrame:
    """V2 with the Employer plan used once.

    A Job row carries employer_id exactly when its (name, city) has an Employer row, and
    Employer is unique on (name, city) and on employer_id.  So "employer has a tech job"
    equals "employer's (name, city) is the link key of a repaired tech job row": one
    semi join on the link key, no second Employer plan and no job-employer join.
    """
    return va.tech_employers_13_states_by_key(employer(spark, sf), tech_job_keys(spark, sf), EMPLOYER_KEY)


def tech_employer_age(spark: SparkSession, sf: str, as_of: dt.date = AS_OF) -> DataFrame:
    return va.tech_employer_age(tech_employers(spark, sf), registrations_cleaned(spark, sf), as_of)


def employer_age_label(spark: SparkSession, sf: str, as_of: dt.date = AS_OF) -> DataFrame:
    return va.employer_age_label(tech_employer_age(spark, sf, as_of))


def employer_age_report(spark: SparkSession, sf: str, as_of: dt.date = AS_OF) -> DataFrame:
    return va.employer_age_report(employer_age_label(spark, sf, as_of))


def salary_comparison(spark: SparkSession, sf: str) -> DataFrame:
    return va.salary_comparison(tech_jobs(spark, sf), geography(spark, sf), wages(spark, sf))


def salary_delta_by_occupation(spark: SparkSession, sf: str) -> DataFrame:
    return va.salary_delta_by_occupation(salary_comparison(spark, sf))
