"""Wide tab-separated extract: parse once, route short lines to rejects, split into 4 entities.

S2 + D8 + F21-F23.  A line is stripped of surrounding whitespace and split on tabs; fields
0-40 are required, 41-51 optional (null when the line is shorter).  Stripping matters:
trailing empty fields disappear with the trailing tabs, so they read as null, not ''.

The four entity frames are projections of one parsed frame; when all four are written
together, persist the parsed frame (``split_extract(..., persist=True)``) so the text is
read and split once.  Persisted blocks lost with an executor are recomputed from the
lineage (a plain text scan), so no checkpoint is needed here.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordforge.functions.text import (
    WHITESPACE,
    normalize_org_name,
    number_without_commas,
    parse_us_date,
    yes_flag,
)

# The positional field names of the extract, in file order (0-51).
EXTRACT_FIELDS = (
    "case_number", "case_status", "case_submitted", "decision_date", "visa_class",
    "employment_start_date", "employment_end_date", "employer_name", "employer_business_dba",
    "employer_address", "employer_city", "employer_state", "employer_postal_code", "employer_country",
    "employer_province", "employer_phone", "employer_phone_ext", "agent_representing_employer",
    "agent_attorney_name", "agent_attorney_city", "agent_attorney_state", "job_title", "soc_code",
    "soc_name", "naics_code", "total_workers", "new_employment", "continued_employment",
    "change_previous_employment", "new_concurrent_emp", "change_employer", "amended_petition",
    "full_time_position", "prevailing_wage", "pw_unit_of_pay", "pw_wage_level", "pw_source",
    "pw_source_year", "pw_source_other", "wage_rate_of_pay_from", "wage_rate_of_pay_to",
    "wage_unit_of_pay", "h1b_dependent", "willful_violator", "support_h1b", "labor_con_agree",
    "public_disclosure_location", "worksite_city", "worksite_county", "worksite_state",
    "worksite_postal_code", "original_cert_date",
)
REQUIRED_FIELDS = 41

APPLICATION_FIELDS = (
    "case_number", "case_status", "case_submitted", "decision_date", "visa_class", "employer_name",
    "employer_city", "employer_state", "agent_representing_employer", "agent_attorney_name",
    "agent_attorney_city", "agent_attorney_state",
)
JOB_FIELDS = (
    "employment_start_date", "employment_end_date", "job_title", "soc_code", "soc_name", "total_workers",
    "full_time_position", "prevailing_wage", "pw_unit_of_pay", "pw_source", "pw_source_year", "pw_source_other",
    "wage_rate_of_pay_from", "wage_rate_of_pay_to", "wage_unit_of_pay", "worksite_city", "worksite_county",
    "worksite_state", "worksite_postal_code", "employer_name", "employer_city", "employer_state",
)
EMPLOYER_FIELDS = (
    "employer_name", "employer_address", "employer_city", "employer_state", "employer_postal_code",
    "employer_country", "employer_province", "employer_phone", "h1b_dependent", "willful_violator",
)
ATTORNEY_FIELDS = ("agent_representing_employer", "agent_attorney_name", "agent_attorney_city", "agent_attorney_state")


def parse_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Strip and split every line; keeps the text, the field array, the field count and the lines' other columns (their origin).

    The split array comes out of a one-element ``explode``: Catalyst pushes the later
    field-count filters below projections by inlining the projected expression, which would
    evaluate the line (and whatever produced it) once more per filter; it does not push a
    filter on a generated column below its generator, so each line is split exactly once.
    """
    fields = F.split(F.btrim(F.col(value_col), F.lit(WHITESPACE)), F.lit("\t"), -1)
    others = [c for c in lines.columns if c != value_col]
    return lines.select(F.col(value_col).alias("line"), *others, F.explode(F.array(fields)).alias("fields")).withColumn(
        "field_count", F.size("fields"))


def rejects(parsed: DataFrame) -> DataFrame:
    """Lines with fewer than the 41 required fields (the reference stops on them), and where they came from if that is known."""
    others = [c for c in parsed.columns if c not in ("line", "fields", "field_count")]
    return parsed.filter(F.col("field_count") < REQUIRED_FIELDS).select(
        "line", "field_count", F.lit("fewer than 41 fields").alias("reject_reason"), *others)


def wide_records(parsed: DataFrame) -> DataFrame:
    """Accepted lines as one column per positional field (null past the end of a short line)."""
    ok = parsed.filter(F.col("field_count") >= REQUIRED_FIELDS)
    return ok.select("field_count", *[F.get(F.col("fields"), i).alias(n) for i, n in enumerate(EXTRACT_FIELDS)])


def _whole_number(col: Column) -> Column:
    return F.when(col.rlike(r"\A\s*[-+]?[0-9]+\s*\z"), col.try_cast("bigint"))


def typed_records(wide: DataFrame) -> DataFrame:
    """Typed fields shared by the four entities (dates, numbers, flags, normalised name)."""
    c = F.col
    return wide.withColumns({
        "employer_name": normalize_org_name(c("employer_name")),
        "case_submitted": parse_us_date(c("case_submitted")),
        "decision_date": parse_us_date(c("decision_date")),
        "employment_start_date": parse_us_date(c("employment_start_date")),
        "employment_end_date": parse_us_date(c("employment_end_date")),
        "total_workers": _whole_number(c("total_workers")),
        "full_time_position": yes_flag(c("full_time_position")),
        "prevailing_wage": number_without_commas(c("prevailing_wage")),
        "wage_rate_of_pay_from": number_without_commas(c("wage_rate_of_pay_from")),
        "wage_rate_of_pay_to": number_without_commas(c("wage_rate_of_pay_to")),
        "h1b_dependent": yes_flag(c("h1b_dependent")),
        "willful_violator": yes_flag(c("willful_violator")),
    })


def split_extract(lines: DataFrame, value_col: str = "value", persist: bool = False) -> dict[str, DataFrame]:
    """{'application', 'job', 'employer', 'attorney', 'rejects'} from one parse of the lines.

    The parsed frame itself is returned under 'parsed' (unpersist it after writing).
    """
    parsed = parse_lines(lines, value_col)
    if persist:
        parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
    typed = typed_records(wide_records(parsed))
    return {
        "application": typed.select(*APPLICATION_FIELDS),
        "job": typed.select(*JOB_FIELDS),
        "employer": typed.select(*EMPLOYER_FIELDS),
        "attorney": typed.select(*ATTORNEY_FIELDS),
        "rejects": rejects(parsed),
        "parsed": parsed,
    }
