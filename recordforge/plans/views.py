"""Named tables and views, read through SQL text.

A query text may name any table or view of ``VIEWS``; only those it names are defined (a plan, nothing
runs), so reading one table does not plan the others.  Catalyst sees through a view:
filters and columns of the text reach the scans below it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from recordforge.plans import tables as t

Build = Callable[[SparkSession, str], DataFrame]

VIEWS: Mapping[str, Build] = {
    "employer_temp": t.employer_temp,
    "job_temp": t.job_temp,
    "attorney": t.attorney,
    "application_temp": t.application_temp,
    "employer": t.employer,
    "job": t.job,
    "application": t.application,
    "corporate_registrations_merged": t.registrations_merged,
    "corporate_registrations_cleaned": t.registrations_cleaned,
    "all_industries_wages": t.wages,
    "geography": t.geography,
    "v_tech_job": t.tech_jobs,
    "v_tech_employer_13_states": t.tech_employers,
    "v_tech_employer_age": t.tech_employer_age,
    "v_tech_employer_age_label": t.employer_age_label,
    "v_tech_employer_age_label_report": t.employer_age_report,
    "v_tech_job_salary_comparison": t.salary_comparison,
    "v_tech_job_salary_delta_by_occupation": t.salary_delta_by_occupation,
}


def source(spark: SparkSession, sf_dir: str, query: str, views: Mapping[str, Build] = VIEWS) -> DataFrame:
    """The rows of a SQL text over the named tables and views.

    The views whose names stand in the text are defined as temporary views of the session, following ``sf_dir``.  A
    name that is neither in ``views`` nor in the session's catalog raises when the text is read.
    """
    for name, build in views.items():
        if re.search(rf"\b{name}\b", query, re.IGNORECASE):
            build(spark, sf_dir).createOrReplaceTempView(name)
    return spark.sql(query)
