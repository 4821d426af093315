"""Analytics views V1-V7 as composable DataFrame functions.

Views are functions, composed lazily into one Catalyst plan.  ORDER BY inside a view has no
meaning for its consumers, so sorting happens only at the presentation edge
(``present_*`` helpers).
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordforge.functions.exact import exact_sum, mean_difference, rounded_quotient
from recordforge.functions.text import round_half_up, year_boundaries_between
from recordforge.operators.link import spread_join

# The keyword patterns of a technology occupation, the one exclusion, the
# 13 states with registries, and the age brackets.
TECH_KEYWORDS = (
    "COMPUTER", "SOFTWARE", "DEVELOPER", "NETWORK", "DATABASE", "DATA", "APPLICATIONS",
    "TECHNOLOGY", " TECH ", "APPS", "PROGRAMMER", "SOLUTION ARCHITECT",
)
TECH_EXCLUDED = "ELECTRONICS ENGINEERS, EXCEPT COMPUTER"
REGISTRY_STATES = ("AZ", "CA", "CO", "CT", "GA", "MA", "MN", "MO", "NC", "NY", "OH", "VA", "WA")
AGE_BRACKETS = ((0, 2, "Ages 0-2"), (3, 7, "Ages 3-7"), (8, 12, "Ages 8-12"), (13, 17, "Ages 13-17"))
AGE_OPEN_BRACKET = (18, "Ages 18+")


def is_tech_occupation(soc_name: Column) -> Column:
    """Any keyword (case-sensitive substring) and not the excluded occupation.

    One regex alternation of the literal keywords matches exactly when one of the
    ``LIKE '%kw%'`` tests would, and references the column once: when Catalyst pushes
    the filter below the repair projections it inlines the column's expression per
    reference, and twelve copies overflow the generated-code size limit.
    """
    pattern = "|".join(re.escape(kw) for kw in TECH_KEYWORDS)
    return soc_name.rlike(pattern) & (soc_name != TECH_EXCLUDED)


def tech_jobs(job: DataFrame) -> DataFrame:
    """V1 v_Tech_Job."""
    return job.filter(is_tech_occupation(F.col("soc_name")))


def tech_employers_13_states(employer: DataFrame, tech_job: DataFrame, employer_unique: bool = True) -> DataFrame:
    """V2: employers in the 13 states that have at least one tech job.

    A left-semi join is the existence test; it never multiplies employer rows.  Employer
    rows are unique (one per name and city, distinct ids), so DISTINCT e.* adds nothing;
    pass ``employer_unique=False`` for an input without that guarantee.
    """
    e = employer.filter(F.col("employer_state").isin(*REGISTRY_STATES))
    out = e.join(tech_job.select("employer_id"), on="employer_id", how="left_semi")
    return out if employer_unique else out.distinct()


def tech_employers_13_states_by_key(employer: DataFrame, tech_job_keys: DataFrame, keys: list[str]) -> DataFrame:
    """V2 when the tech jobs are known by their employer link key instead of employer_id."""
    e = employer.filter(F.col("employer_state").isin(*REGISTRY_STATES))
    return e.join(tech_job_keys, on=keys, how="left_semi").select(*employer.columns)


def tech_employer_age(tech_employers: DataFrame, registrations: DataFrame, as_of: dt.date | Column | None = None) -> DataFrame:
    """V3: employer name, state, registration date and age in years (boundaries crossed)."""
    asof = F.current_date() if as_of is None else (as_of if isinstance(as_of, Column) else F.lit(as_of))
    e = tech_employers.select("employer_name", "employer_state").distinct()
    r = registrations.select(
        F.col("corporation_name").alias("employer_name"),
        F.col("corporation_state").alias("employer_state"),
        "registration_date",
    )
    # the names are distinct by the join key already; a name with very many registrations can still be split
    joined = spread_join(r, e, ["employer_name", "employer_state"])
    return joined.select(
        "employer_name", "employer_state", "registration_date",
        year_boundaries_between(F.col("registration_date"), asof).alias("employer_age"),
    ).distinct()


def age_label(age: Column) -> Column:
    out = F.when(age >= AGE_OPEN_BRACKET[0], F.lit(AGE_OPEN_BRACKET[1]))
    for lo, hi, label in reversed(AGE_BRACKETS):
        out = F.when(age.between(lo, hi), F.lit(label)).otherwise(out)
    return out


def employer_age_label(ages: DataFrame) -> DataFrame:
    """V4: add the age bracket (null for a negative or missing age)."""
    return ages.withColumn("age_label", age_label(F.col("employer_age")))


def employer_age_report(labelled: DataFrame) -> DataFrame:
    """V5: number of employers per age bracket and state."""
    return (
        labelled.filter(F.col("age_label").isNotNull())
        .groupBy("age_label", "employer_state")
        .agg(F.count(F.lit(1)).alias("employer_count"))
    )


def salary_comparison(tech_job: DataFrame, geography: DataFrame, wages: DataFrame) -> DataFrame:
    """V6: each tech job's offered wage against the area's average for its occupation and year.

    Geography and wages grow with the areas, and Spark's size estimate does not count the rows that an explode adds:
    it may broadcast millions of them through the driver.  The merge hints keep both joins shuffled in any session.
    """
    j = computed_once(tech_job.filter(F.col("wage_rate_of_pay_from").isNotNull()).select(
        "job_id", "worksite_county", "worksite_state", "soc_code", "soc_name",
        "employment_start_year", "employment_start_date", "wage_rate_of_pay_from",
    ))
    g = geography.select(
        F.col("county").alias("worksite_county"), F.col("state").alias("worksite_state"),
        F.col("year").alias("employment_start_year"), "area", F.col("state"),
    )
    w = wages.select(
        "area", F.col("year").alias("employment_start_year"), "soc_code", "annual_salary",
    )
    jg = j.join(g.hint("merge"), on=["worksite_county", "worksite_state", "employment_start_year"], how="inner")
    jgw = jg.join(w.hint("merge"), on=["area", "employment_start_year", "soc_code"], how="inner")
    job_pay, avg_pay = F.col("wage_rate_of_pay_from"), F.col("annual_salary")
    return jgw.select(
        "job_id", "worksite_county", "state", "soc_code", "soc_name",
        F.col("employment_start_year").alias("year"), "employment_start_date",
        job_pay.alias("h1b_job_salary"),
        avg_pay.alias("national_average_salary"),
        F.when(avg_pay > job_pay, "NATIONAL_SALARY_GREATER")
        .when(job_pay > avg_pay, "JOB_SALARY_GREATER")
        .otherwise("EQUAL_SALARY").alias("salary_label"),
        F.when(avg_pay > job_pay, round_half_up(avg_pay - job_pay))
        .when(job_pay > avg_pay, round_half_up(job_pay - avg_pay))
        .otherwise(F.lit(0.0)).alias("salary_delta"),
    )


def computed_once(df: DataFrame) -> DataFrame:
    """Emit the rows through a one-row ``inline``, so each column is computed once.

    The join keys of the comparison are repaired values (long expressions).  Catalyst would
    push the inferred ``IS NOT NULL`` filters on them below the repairs by inlining each
    key's expression into the filter, evaluating it twice and, on long derivations,
    overflowing the generated-code size limit.  Filters are not pushed below a generator.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def salary_delta_by_occupation(comparison: DataFrame) -> DataFrame:
    """V7: average offered and average national pay per occupation, and their difference.

    Sums are exact, so the result is the same however the rows are spread.
    """
    offered, usual = F.col("h1b_job_salary"), F.col("national_average_salary")
    sums = comparison.groupBy("soc_code", "soc_name").agg(
        exact_sum(offered).alias("_s1"), F.count(offered).alias("_n1"), exact_sum(usual).alias("_s2"), F.count(usual).alias("_n2"))
    s1, n1, s2, n2 = (F.col(c) for c in ("_s1", "_n1", "_s2", "_n2"))
    return sums.select(
        "soc_code", "soc_name",
        rounded_quotient(s1, n1).alias("h1b_job_pay"),
        rounded_quotient(s2, n2).alias("national_average_pay"),
        mean_difference(s1, n1, s2, n2).alias("h1b_minus_national_delta"),
    )


def present_tech_jobs(jobs: DataFrame) -> DataFrame:
    """O1: tech jobs by occupation code (job id breaks ties)."""
    return jobs.orderBy("soc_code", "job_id")


def present_employer_ages(ages: DataFrame) -> DataFrame:
    """O1: employers by name and state (registration date breaks ties)."""
    return ages.orderBy("employer_name", "employer_state", "registration_date")


def present_salary_comparison(comparison: DataFrame) -> DataFrame:
    """O1: the comparison ordered by delta, largest first (job id breaks ties)."""
    return comparison.orderBy(F.col("salary_delta").desc(), F.col("job_id"))


def present_salary_delta(deltas: DataFrame) -> DataFrame:
    """O1: occupations by difference, largest first (code and name break ties)."""
    return deltas.orderBy(F.col("h1b_minus_national_delta").desc(), "soc_code", "soc_name")


def present_age_report(report: DataFrame) -> DataFrame:
    return report.orderBy("age_label", "employer_state")
