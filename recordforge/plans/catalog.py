"""The query catalog: one Spark plan and one oracle statement per SURVEY §2 key.

Each Spark entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole
input tables.  Column names and types match the oracle statement of the same key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge.functions import text as tx
from recordforge.operators import staging as stg
from recordforge.operators.extract import (
    parse_lines,
    split_extract,
    typed_records,
    wide_records,
)
from recordforge.operators.registrations import ct_city, registry_branch, SPECS_BY_STATE
from recordforge.operators.repair import link_city, repair_soc, repair_wage_fields, repair_worksite
from recordforge.plans import analytics as va
from recordforge.plans import oracle_sql as o
from recordforge.plans import tables as t
from recordforge.plans.views import source
from recordforge.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]


# -- small per-operator queries ------------------------------------------------------------

def q_normalize_employer_name(spark, sf):
    a = fx.applications_base(spark, sf).filter(F.col("employer_name").isNotNull())
    return a.select("case_number", "employer_name", tx.normalize_org_name(F.col("employer_name")).alias("clean_name"))


def q_normalize_corporation_name(spark, sf):
    r = fx.registrations_base(spark, sf)
    return r.select(F.col("c").alias("corporation_id"), F.col("name").alias("corporation_name"),
                    tx.normalize_org_name(F.col("name"), upper=True).alias("clean_name"))


def q_digit_checks(spark, sf):
    a = fx.applications_base(spark, sf).filter(F.col("employer_city").isNotNull())
    city = tx.strip(F.replace(F.col("employer_city"), F.lit(","), F.lit("")))
    return a.select("case_number", "employer_city",
                    tx.is_all_digits(city).alias("city_is_digits"),
                    tx.starts_with_digit(city).alias("city_starts_with_digit"))


def q_safe_casts(spark, sf):
    """F4-F7 over all four yearly tables: each year casts the fields it stores as text."""
    def text(name, cast):
        return lambda c: cast(c(name))

    wages = {"wage_from": lambda c: c("wage_rate_of_pay_from")}
    case = {"case_submitted": text("case_submitted", tx.safe_date)}
    rules = {
        2018: {"wage_from": text("wage_rate_of_pay_from", tx.safe_double), "prevailing_wage": text("prevailing_wage", tx.safe_double),
               "full_time_position": text("full_time_position", tx.safe_bool)},
        2017: {**wages, **case},
        2016: {**wages, **case, "full_time_position": text("full_time_position", tx.safe_bool)},
        2015: {**case, "wage_from": text("wage_rate_of_pay", stg.wage_range_from)},
    }
    return stg.aligned_union(t.yearly(spark, sf), ("case_number", "wage_from", "prevailing_wage", "full_time_position", "case_submitted"), rules)


def q_wage_range_split(spark, sf):
    a = t.yearly(spark, sf).table(2015)
    w = F.col("wage_rate_of_pay")
    return a.select("case_number", w, stg.wage_range_from(w).alias("wage_rate_of_pay_from"),
                    stg.wage_range_to(w).alias("wage_rate_of_pay_to"))


def q_staging_align_years(spark, sf):
    y = t.yearly(spark, sf)
    return stg.aligned_union(y, stg.JOB_COLUMNS, stg.JOB_ALIGN, None, stg.JOB_TYPES, tag_year=True).select(
        "source_year", "employer_name", "employer_city", "employment_start_date", "wage_rate_of_pay_from",
        "wage_rate_of_pay_to", "full_time_position", "prevailing_wage", "pw_source", "pw_source_year", "pw_source_other",
    )


def q_valid_applications(spark, sf):
    return stg.aligned_union(t.yearly(spark, sf), ("case_number", "employer_name", "employer_city"), {}, stg.valid_employer, tag_year=True)


def q_distinct_employers(spark, sf):
    return stg.aligned_union(t.yearly(spark, sf), ("employer_name", "employer_city", "employer_state"), {}).distinct()


def q_surrogate_keys(spark, sf):
    """Key uniqueness of every staged table: rows and distinct ids must be equal."""
    def stats(name, df, key):
        return df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                      F.count_distinct(F.col(key)).alias("distinct_ids"))
    return (stats("employer_temp", t.employer_temp(spark, sf), "employer_id")
            .unionByName(stats("job_temp", t.job_temp(spark, sf), "job_id"))
            .unionByName(stats("attorney", t.attorney(spark, sf), "attorney_id")))


def q_job_start_year(spark, sf):
    return t.job_temp(spark, sf).select(
        "job_id", "employment_start_date", F.year("employment_start_date").cast("bigint").alias("employment_start_year"))


def q_link_city_clean(spark, sf):
    j = t.job_temp(spark, sf)
    return j.select("job_id", "employer_city", "employer_state",
                    link_city(F.col("employer_city"), F.col("employer_state")).alias("link_city"))


_WORKSITE = ("job_id", "worksite_city", "worksite_county", "worksite_state", "worksite_postal_code")


def q_worksite_repair(spark, sf):
    return repair_worksite(t.job_temp(spark, sf)).select(*_WORKSITE)


def q_soc_repair(spark, sf):
    return repair_soc(t.job_temp(spark, sf)).select("job_id", "soc_code", "soc_name")


def q_wage_field_repair(spark, sf):
    return repair_wage_fields(t.job_temp(spark, sf)).select(
        "job_id", "prevailing_wage", "pw_unit_of_pay", "wage_rate_of_pay_to")


def q_registrations_join_on_filters(spark, sf):
    return registry_branch(SPECS_BY_STATE["GA"], fx.two_part_registries(spark, sf))


def q_registrations_join_distinct(spark, sf):
    src = fx.two_part_registries(spark, sf)
    return registry_branch(SPECS_BY_STATE["MN"], src).unionByName(registry_branch(SPECS_BY_STATE["MO"], src))


def q_ct_city_extract(spark, sf):
    ct = fx.shared_registries(spark, sf).table("CT")
    return ct.select(F.col("business_id").cast("string").alias("corporation_id"), "business_address",
                     ct_city(F.col("business_address")).alias("city_part"))


def q_application_attorney_left_join(spark, sf):
    from recordforge.operators.link import left_join_spread_nulls
    y = t.yearly(spark, sf)
    apps = stg.application_rows(y).select("case_number", "agent_attorney_name", "agent_attorney_city")
    return left_join_spread_nulls(apps, stg.attorney_dim(y), ["agent_attorney_name", "agent_attorney_city"],
                                  ["attorney_name", "attorney_city"]).select(
        "case_number", "agent_attorney_name", "agent_attorney_city", "attorney_id", "attorney_state")


def _extract(spark, sf):
    return split_extract(fx.extract_lines(spark, sf))


def q_tsv_parse(spark, sf):
    parsed = parse_lines(fx.extract_lines(spark, sf))
    return typed_records(wide_records(parsed)).select(*TSV_PARSE_COLUMNS)


TSV_PARSE_COLUMNS = ("field_count", "case_number", "employer_name", "case_submitted", "h1b_dependent",
                     "wage_unit_of_pay", "worksite_postal_code", "original_cert_date")


def q_top_rows_by_name(spark, sf):
    """The first 100 staged employers by name (employer_id breaks ties: a total order)."""
    return stg.sample_rows(t.employer_temp(spark, sf), 100, ["employer_name", "employer_id"])


#: A text over two of the named views
SALARIES_SQL = """
WITH paid AS (SELECT year, count(*) AS wages_of_year FROM all_industries_wages WHERE annual_salary IS NOT NULL GROUP BY year)
SELECT c.state, c.year, count(*) AS jobs, count_if(c.salary_label = 'JOB_SALARY_GREATER') AS above, first(p.wages_of_year) AS wages_of_year
FROM v_tech_job_salary_comparison c JOIN paid p ON p.year = c.year
GROUP BY c.state, c.year
"""


QUERIES: dict[str, Query] = {
    # flagship and views
    "employer_age_report": t.employer_age_report,
    "employer_age_label": t.employer_age_label,
    "tech_employer_age": t.tech_employer_age,
    "tech_employers_13_states": t.tech_employers,
    "tech_jobs": t.tech_jobs,
    "salary_comparison": t.salary_comparison,
    "salary_comparison_sorted": lambda s, d: va.present_salary_comparison(t.salary_comparison(s, d)),
    "salary_delta_by_occupation": t.salary_delta_by_occupation,
    "employer_age_report_sorted": lambda s, d: va.present_age_report(t.employer_age_report(s, d)),
    "salary_delta_by_occupation_sorted": lambda s, d: va.present_salary_delta(t.salary_delta_by_occupation(s, d)),
    "tech_jobs_sorted": lambda s, d: va.present_tech_jobs(t.tech_jobs(s, d)),
    "tech_employer_age_sorted": lambda s, d: va.present_employer_ages(t.tech_employer_age(s, d)),
    "salaries_through_sql": lambda s, d: source(s, d, SALARIES_SQL),
    # staging
    "staging_align_years": q_staging_align_years,
    "valid_applications": q_valid_applications,
    "distinct_employers": q_distinct_employers,
    "employer_staging": t.employer_temp,
    "job_staging": t.job_temp,
    "attorney_dim": t.attorney,
    "application_staging": t.application_temp,
    "application_attorney_left_join": q_application_attorney_left_join,
    "surrogate_keys": q_surrogate_keys,
    "top_rows_by_name": q_top_rows_by_name,
    # employers
    "employer_repair": t.employer_repaired,
    "employer_rejects": t.employer_rejects,
    "employer_dedup": t.employer,
    # jobs and applications
    "job_start_year": q_job_start_year,
    "link_city_clean": q_link_city_clean,
    "worksite_repair": q_worksite_repair,
    "soc_repair": q_soc_repair,
    "wage_field_repair": q_wage_field_repair,
    "job_rejects": t.job_rejects,
    "application_rejects": t.application_rejects,
    "job_link_employer": t.job,
    "application_link_employer": t.application,
    # registrations, wages
    "registrations_merge": t.registrations_merged,
    "registrations_join_on_filters": q_registrations_join_on_filters,
    "registrations_join_distinct": q_registrations_join_distinct,
    "clean_registrations": t.registrations_cleaned,
    "registration_rejects": t.registration_rejects,
    "ct_city_extract": q_ct_city_extract,
    "wages_merge": t.wages,
    "geography_merge": t.geography,
    # column functions
    "normalize_employer_name": q_normalize_employer_name,
    "normalize_corporation_name": q_normalize_corporation_name,
    "digit_checks": q_digit_checks,
    "safe_casts": q_safe_casts,
    "wage_range_split": q_wage_range_split,
    # wide extract
    "tsv_parse": q_tsv_parse,
    "tsv_rejects": lambda s, d: _extract(s, d)["rejects"],
    "tsv_split_application": lambda s, d: _extract(s, d)["application"],
    "tsv_split_job": lambda s, d: _extract(s, d)["job"],
    "tsv_split_employer": lambda s, d: _extract(s, d)["employer"],
    "tsv_split_attorney": lambda s, d: _extract(s, d)["attorney"],
}


def _oracle() -> dict[str, str]:
    s = o.sql
    cities = o.strip("replace(employer_city, ',', '')")
    w15 = "wage_rate_of_pay"
    return {
        "tsv_parse": s("tsv_typed", f"SELECT {', '.join(TSV_PARSE_COLUMNS)} FROM tsv_typed"),
        "tsv_rejects": s("tsv_rejects"),
        "tsv_split_application": s("tsv_typed", f"SELECT {o.EXTRACT_TABLES['application']} FROM tsv_typed"),
        "tsv_split_job": s("tsv_typed", f"SELECT {o.EXTRACT_TABLES['job']} FROM tsv_typed"),
        "tsv_split_employer": s("tsv_typed", f"SELECT {o.EXTRACT_TABLES['employer']} FROM tsv_typed"),
        "tsv_split_attorney": s("tsv_typed", f"SELECT {o.EXTRACT_TABLES['attorney']} FROM tsv_typed"),
        "employer_age_report": s("tech_employer_age_report"),
        "employer_age_label": s("tech_employer_age_label"),
        "tech_employer_age": s("tech_employer_age"),
        "tech_employers_13_states": s("tech_employer_13"),
        "tech_jobs": s("tech_job"),
        "salary_comparison": s("salary_comparison"),
        "salary_comparison_sorted": s("salary_comparison", "SELECT * FROM salary_comparison ORDER BY salary_delta DESC, job_id"),
        "salary_delta_by_occupation": s("salary_delta_by_occupation"),
        "staging_align_years": _align_years_sql(),
        "valid_applications": o.with_ctes(list(o.YEARS), " UNION ALL ".join(
            f"SELECT case_number, employer_name, employer_city, CAST({y[-4:]} AS BIGINT) AS source_year FROM {y} "
            f"WHERE {o.VALID}" for y in o.YEARS)),
        "distinct_employers": o.with_ctes(list(o.YEARS), " UNION ".join(
            f"SELECT employer_name, employer_city, employer_state FROM {y}" for y in o.YEARS)),
        "employer_staging": s("employer_temp"),
        "job_staging": s("job_temp"),
        "attorney_dim": s("attorney"),
        "application_staging": s("application_temp"),
        "application_attorney_left_join": s("application_attorney", """
            SELECT case_number, agent_attorney_name, agent_attorney_city, attorney_id, attorney_state FROM application_attorney"""),
        "surrogate_keys": o.with_ctes(["employer_temp", "job_temp", "attorney"], """
            SELECT 'employer_temp' AS table_name, COUNT(*) AS row_count, COUNT(DISTINCT employer_id) AS distinct_ids FROM employer_temp
            UNION ALL SELECT 'job_temp', COUNT(*), COUNT(DISTINCT job_id) FROM job_temp
            UNION ALL SELECT 'attorney', COUNT(*), COUNT(DISTINCT attorney_id) FROM attorney"""),
        "top_rows_by_name": s("employer_temp", "SELECT * FROM employer_temp ORDER BY employer_name, employer_id LIMIT 100"),
        "employer_repair": s("employer_repaired"),
        "employer_rejects": s("employer_rejects"),
        "employer_dedup": s("employer"),
        "job_start_year": s("job_temp", "SELECT job_id, employment_start_date, year(employment_start_date) AS employment_start_year FROM job_temp"),
        "link_city_clean": s("job_temp", f"SELECT job_id, employer_city, employer_state, {o.link_city_sql('employer_city', 'employer_state')} AS link_city FROM job_temp"),
        "worksite_repair": o.with_ctes(["job_temp"], """
            SELECT job_id, worksite_city, worksite_county, worksite_state, worksite_postal_code FROM job_ws5""",
            extra=[(n, o.CTES[n][0].replace("FROM job_keyed", "FROM job_temp")) for n in ("job_ws1",)]
            + [(n, o.CTES[n][0]) for n in ("job_ws2", "job_ws3", "job_ws4", "job_ws5")]),
        "soc_repair": s("job_temp", f"""
            SELECT job_id,
              CASE WHEN soc_code IS NOT NULL AND soc_name IS NOT NULL
                   THEN replace(CASE WHEN {o.lead('soc_name')} THEN soc_name ELSE soc_code END, '.00', '') ELSE soc_code END AS soc_code,
              CASE WHEN soc_code IS NOT NULL AND soc_name IS NOT NULL AND {o.lead('soc_name')} THEN soc_code ELSE soc_name END AS soc_name
            FROM job_temp"""),
        "wage_field_repair": s("job_temp", f"""
            SELECT job_id,
              coalesce({o.wage_in_unit('pw_unit_of_pay')}, prevailing_wage) AS prevailing_wage,
              CASE WHEN {o.wage_in_unit('pw_unit_of_pay')} IS NULL THEN pw_unit_of_pay END AS pw_unit_of_pay,
              CASE WHEN wage_rate_of_pay_to = 0 THEN NULL ELSE wage_rate_of_pay_to END AS wage_rate_of_pay_to
            FROM job_temp"""),
        "job_rejects": s("job_rejects"),
        "application_rejects": s("application_rejects"),
        "registration_rejects": s("reg_rejects"),
        "employer_age_report_sorted": s("tech_employer_age_report",
                                        "SELECT * FROM tech_employer_age_report ORDER BY age_label, employer_state"),
        "tech_jobs_sorted": s("tech_job", "SELECT * FROM tech_job ORDER BY soc_code, job_id"),
        "tech_employer_age_sorted": s("tech_employer_age",
                                      "SELECT * FROM tech_employer_age ORDER BY employer_name, employer_state, registration_date"),
        "salaries_through_sql": o.with_ctes(["salary_comparison", "wages"], """
            SELECT sc.state, sc.year, count(*) AS jobs, count(*) FILTER (WHERE sc.salary_label = 'JOB_SALARY_GREATER') AS above,
                   (SELECT count(*) FROM wages a WHERE a.year = sc.year AND a.annual_salary IS NOT NULL) AS wages_of_year
            FROM salary_comparison sc GROUP BY sc.state, sc.year"""),
        "salary_delta_by_occupation_sorted": s("salary_delta_by_occupation", """
            SELECT * FROM salary_delta_by_occupation ORDER BY h1b_minus_national_delta DESC, soc_code, soc_name"""),
        "job_link_employer": s("job"),
        "application_link_employer": s("application"),
        "registrations_merge": s("reg_merged"),
        "registrations_join_on_filters": s("reg_merged", "SELECT * FROM reg_merged WHERE corporation_state = 'GA'"),
        "registrations_join_distinct": s("reg_merged", "SELECT * FROM reg_merged WHERE corporation_state IN ('MN', 'MO')"),
        "clean_registrations": s("reg_cleaned"),
        "ct_city_extract": o.with_ctes(["corp"], f"""
            SELECT CAST(c AS VARCHAR) AS corporation_id, address AS business_address, {o.rsplit2_sql('address')} AS city_part
            FROM corp WHERE state = 'CT'"""),
        "wages_merge": s("wages"),
        "geography_merge": s("geography"),
        "normalize_employer_name": o.with_ctes(["apps"], f"""
            SELECT case_number, employer_name, {o.norm('employer_name')} AS clean_name FROM apps WHERE employer_name IS NOT NULL"""),
        "normalize_corporation_name": o.with_ctes(["corp"], f"""
            SELECT c AS corporation_id, name AS corporation_name, {o.norm('name', upper=True)} AS clean_name FROM corp"""),
        "digit_checks": o.with_ctes(["apps"], f"""
            SELECT case_number, employer_city, {o.digits(cities)} AS city_is_digits, {o.lead(cities)} AS city_starts_with_digit
            FROM apps WHERE employer_city IS NOT NULL"""),
        "safe_casts": o.with_ctes(list(o.YEARS), f"""
            SELECT case_number, {o.safe_double('wage_rate_of_pay_from')} AS wage_from, {o.safe_double('prevailing_wage')} AS prevailing_wage,
                   {o.safe_bool('full_time_position')} AS full_time_position, case_submitted FROM apps_2018
            UNION ALL
            SELECT case_number, wage_rate_of_pay_from, prevailing_wage, full_time_position,
                   {o.safe_date('case_submitted')} FROM apps_2017
            UNION ALL
            SELECT case_number, wage_rate_of_pay_from, prevailing_wage, {o.safe_bool('full_time_position')},
                   {o.safe_date('case_submitted')} FROM apps_2016
            UNION ALL
            SELECT case_number,
                   CASE WHEN strpos(wage_rate_of_pay, '-') > 0 THEN {o.safe_double(o.strip("substr(wage_rate_of_pay, 1, strpos(wage_rate_of_pay, '-') - 1)"))} END,
                   prevailing_wage, full_time_position, {o.safe_date('case_submitted')} FROM apps_2015"""),
        "wage_range_split": o.with_ctes(["apps_2015"], f"""
            SELECT case_number, {w15},
              CASE WHEN strpos({w15}, '-') > 0 THEN {o.safe_double(o.strip(f"substr({w15}, 1, strpos({w15}, '-') - 1)"))} END AS wage_rate_of_pay_from,
              {o.safe_double(o.strip(f"substr({w15}, strpos({w15}, '-') + 1)"))} AS wage_rate_of_pay_to
            FROM apps_2015"""),
    }


def _align_years_sql() -> str:
    body = """SELECT CAST(source_year AS BIGINT) AS source_year, employer_name, employer_city, employment_start_date,
                     wage_rate_of_pay_from, wage_rate_of_pay_to, full_time_position, prevailing_wage, pw_source,
                     pw_source_year, pw_source_other FROM job_rows_tagged"""
    rows_sql = o.CTES["job_rows"][0]
    # the same alignment as job_rows, without the row filter, tagged with the source year
    branches = rows_sql.split("UNION ALL")
    tagged = []
    for branch, year in zip(branches, (2018, 2017, 2016, 2015)):
        b = branch.strip()
        b = b[: b.rindex("WHERE")].strip()
        b = b.replace("SELECT ", f"SELECT {year} AS source_year, ", 1)
        tagged.append(b)
    return o.with_ctes(list(o.YEARS), body, extra=[("job_rows_tagged", "\nUNION ALL\n".join(tagged))])


ORACLE: dict[str, str] = _oracle()
