"""Staging: align the yearly application tables and build the temp tables.

* ``align``             P1: per-year select of canonical columns (renames, casts, splits)
* ``employer_staging``  U1 + F1: distinct employers over the years, with a surrogate key
* ``job_staging``       U1 + F1: distinct jobs over the years, with a surrogate key
* ``attorney_dim``      S4 + A1 + F1: distinct attorneys over all years
* ``application_staging`` U2 + J3: applications of all years with their attorney id

Branch-level DISTINCTs under a UNION DISTINCT are redundant; one ``distinct`` after the
union is written instead (its partial aggregation runs before the shuffle).

The yearly tables come as a mapping of year to frame (``YearlyTables`` of ``sources.yearly`` reads them by a path
pattern), or as ``SharedTables``: rows of one frame, which is then read once for all years.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordforge.functions.text import safe_bool, safe_date, safe_double, strip, text_key
from recordforge.operators.branches import Accessor, SharedTables, one_pass

Yearly = Mapping[int, DataFrame] | SharedTables
Rules = Mapping[int, Mapping[str, Callable[[Accessor], Column]]]

EMPLOYER_COLUMNS = (
    "employer_name", "employer_address", "employer_city", "employer_state", "employer_postal_code",
    "employer_country", "employer_province", "employer_phone", "h1b_dependent", "willful_violator",
)
JOB_COLUMNS = (
    "employer_name", "employer_city", "employer_state", "employment_start_date", "employment_end_date",
    "job_title", "wage_rate_of_pay_from", "wage_rate_of_pay_to", "wage_unit_of_pay", "worksite_city",
    "worksite_county", "worksite_state", "worksite_postal_code", "soc_code", "soc_name", "total_workers",
    "full_time_position", "prevailing_wage", "pw_unit_of_pay", "pw_source", "pw_source_year", "pw_source_other",
)
JOB_TYPES = {
    "employment_start_date": "date", "employment_end_date": "date", "wage_rate_of_pay_from": "double",
    "wage_rate_of_pay_to": "double", "total_workers": "bigint", "full_time_position": "boolean",
    "prevailing_wage": "double",
}
APPLICATION_COLUMNS = (
    "case_number", "case_status", "case_submitted", "decision_date", "visa_class",
    "employer_name", "employer_city", "employer_state",
)


def sample_rows(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """The first ``n`` rows in a total order (add a unique column to ``order_by``).

    A development sample of an input; Spark plans it as a top-k (each task keeps its best n
    rows, one task merges them), never a full sort.
    """
    return df.orderBy(*order_by).limit(n)


def valid_employer(c: Accessor = F.col) -> Column:
    """The junk-name guard used by every staging statement."""
    return c("employer_name").isNotNull() & (c("employer_name") != "1") & c("employer_city").isNotNull()


def wage_range_from(text: Column) -> Column:
    """the part before the first '-' of a 'from - to' text; null when there is no dash."""
    pos = F.instr(text, "-")
    return F.when(pos > 0, safe_double(strip(F.substring(text, F.lit(1), pos - 1))))


def wage_range_to(text: Column) -> Column:
    """the part after the first '-'; the whole text when there is no dash."""
    pos = F.instr(text, "-")
    return safe_double(strip(F.substring(text, pos + 1, F.length(text))))


def h1b_flag_from_letter(col: Column) -> Column:
    return F.when(col == "N", F.lit(False)).when(col == "Y", F.lit(True))


# Per-year column mappings.  Anything not listed is taken by name.
EMPLOYER_ALIGN: Rules = {
    2018: {
        "employer_phone": lambda c: c("employer_phone").cast("string"),
        "h1b_dependent": lambda c: h1b_flag_from_letter(c("h1b_dependent")),
    },
    2015: {
        "employer_address": lambda c: F.concat(c("employer_address1"), F.lit(" "), c("employer_address2")),
    },
}

JOB_ALIGN: Rules = {
    2018: {
        "wage_rate_of_pay_from": lambda c: safe_double(c("wage_rate_of_pay_from")),
        "full_time_position": lambda c: safe_bool(c("full_time_position")),
        "prevailing_wage": lambda c: safe_double(c("prevailing_wage")),
        "pw_source_year": lambda c: c("pw_source_year").cast("string"),
    },
    2017: {
        "employment_start_date": lambda c: c("employment_start_date").cast("date"),
        "employment_end_date": lambda c: c("employment_end_date").cast("date"),
    },
    2016: {
        "employment_start_date": lambda c: c("employment_start_date").cast("date"),
        "employment_end_date": lambda c: c("employment_end_date").cast("date"),
        "full_time_position": lambda c: safe_bool(c("full_time_position")),
        "pw_source": lambda c: c("pw_wage_source"),
        "pw_source_year": lambda c: c("pw_wage_source_year"),
        "pw_source_other": lambda c: c("pw_wage_source_other"),
    },
    2015: {
        "employment_start_date": lambda c: c("employment_start_date").cast("date"),
        "employment_end_date": lambda c: c("employment_end_date").cast("date"),
        "wage_rate_of_pay_from": lambda c: wage_range_from(c("wage_rate_of_pay")),
        "wage_rate_of_pay_to": lambda c: wage_range_to(c("wage_rate_of_pay")),
        "pw_source_year": lambda c: c("pw_wage_source_year").cast("string"),
    },
}

APPLICATION_ALIGN: Rules = {
    y: {
        "case_submitted": lambda c: safe_date(c("case_submitted")),
        "decision_date": lambda c: safe_date(c("decision_date")),
    }
    for y in (2015, 2016, 2017)
}


#: columns and types every yearly table must give after its rules, per staging table (``sources.yearly.check_drift``)
STAGED: tuple[tuple[Mapping[str, str], Rules], ...] = (
    ({**dict.fromkeys(EMPLOYER_COLUMNS, "string"), "h1b_dependent": "boolean", "willful_violator": "boolean"}, EMPLOYER_ALIGN),
    ({**dict.fromkeys(JOB_COLUMNS, "string"), **JOB_TYPES}, JOB_ALIGN),
    ({**dict.fromkeys(APPLICATION_COLUMNS, "string"), "case_submitted": "date", "decision_date": "date"}, APPLICATION_ALIGN),
    (dict.fromkeys(("agent_attorney_name", "agent_attorney_city", "agent_attorney_state"), "string"), {}),
)


def _aligned(c: Accessor, year: int, columns: tuple[str, ...], mapping: Rules, types: Mapping[str, str] | None) -> list[Column]:
    rules = mapping.get(year, {})
    out = []
    for name in columns:
        col = rules[name](c) if name in rules else c(name)
        if types and name in types:
            col = col.cast(types[name])
        out.append(col.alias(name))
    return out


def align(df: DataFrame, year: int, columns: tuple[str, ...], mapping: Rules, types: Mapping[str, str] | None = None) -> DataFrame:
    """Select the canonical columns of one yearly table (renames/casts from ``mapping``)."""
    return df.select(*_aligned(F.col, year, columns, mapping, types))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def aligned_union(yearly: Yearly, columns: tuple[str, ...], mapping: Rules, row_filter: Callable[[Accessor], Column] | None = None,
                  types: Mapping[str, str] | None = None, tag_year: bool = False) -> DataFrame:
    """Filter each yearly table, align it, and UNION ALL the results (years newest first).

    Tables that share their rows are read in one pass.
    """
    def columns_of(c: Accessor, year: int) -> list[Column]:
        tag = [F.lit(year).cast("bigint").alias("source_year")] if tag_year else []
        return [*_aligned(c, year, columns, mapping, types), *tag]

    years = sorted(yearly, reverse=True)
    if isinstance(yearly, SharedTables):
        branches = []
        for year in years:
            c, condition = yearly.accessor(year), yearly.where[year]
            branches.append((condition if row_filter is None else condition & row_filter(c), columns_of(c, year)))
        return one_pass(yearly.rows, branches)
    frames = []
    for year in years:
        df = yearly[year] if row_filter is None else yearly[year].filter(row_filter(F.col))
        frames.append(df.select(*columns_of(F.col, year)))
    return union_all(frames)


def employer_staging(yearly: Yearly, distinct: bool = True) -> DataFrame:
    """Employer_Temp: distinct valid employers of all years plus ``employer_id``.

    The id is a function of the row, so a consumer that keeps one row per id anyway may take the
    rows with their repeats (``distinct=False``) and save a shuffle.
    """
    rows = aligned_union(yearly, EMPLOYER_COLUMNS, EMPLOYER_ALIGN, valid_employer)
    rows = rows.distinct() if distinct else rows
    return rows.select(text_key(list(EMPLOYER_COLUMNS)).alias("employer_id"), *EMPLOYER_COLUMNS)


def job_rows(yearly: Yearly) -> DataFrame:
    """Valid job rows of all years, aligned (UNION ALL, before the distinct)."""
    def complete(c: Accessor) -> Column:
        return (valid_employer(c) & c("employment_start_date").isNotNull() & c("employment_end_date").isNotNull()
                & c("job_title").isNotNull())

    return aligned_union(yearly, JOB_COLUMNS, JOB_ALIGN, complete, JOB_TYPES)


def job_staging(yearly: Yearly) -> DataFrame:
    """Job_Temp: distinct valid jobs of all years plus ``job_id``."""
    rows = job_rows(yearly).distinct()
    return rows.select(text_key(list(JOB_COLUMNS), {k: v for k, v in JOB_TYPES.items()}).alias("job_id"), *JOB_COLUMNS)


def attorney_dim(yearly: Yearly) -> DataFrame:
    """Attorney: distinct (name, city, state) of all years, for applications with a valid employer."""
    def named(c: Accessor) -> Column:
        return (c("agent_attorney_name").isNotNull() & c("agent_attorney_city").isNotNull()
                & c("agent_attorney_state").isNotNull() & valid_employer(c))

    rules = {
        "attorney_name": lambda c: c("agent_attorney_name"),
        "attorney_city": lambda c: c("agent_attorney_city"),
        "attorney_state": lambda c: c("agent_attorney_state"),
    }
    rows = aligned_union(yearly, tuple(rules), {y: rules for y in yearly}, named).distinct()
    return rows.select(text_key(list(rules)).alias("attorney_id"), *rules)


def application_rows(yearly: Yearly) -> DataFrame:
    """Valid applications of all years, aligned, keeping the attorney name and city for the join."""
    cols = APPLICATION_COLUMNS + ("agent_attorney_name", "agent_attorney_city", "agent_attorney_state")
    return aligned_union(yearly, cols, APPLICATION_ALIGN, valid_employer, {"case_submitted": "date", "decision_date": "date"})


def application_staging(yearly: Yearly, attorneys: DataFrame | None = None,
                        match_state: bool = False) -> DataFrame:
    """Application_Temp: UNION ALL of the years, LEFT JOIN Attorney on (name, city).

    Attorney is unique on (name, city, state), so joining on two of the three columns
    repeats an application once per state its attorney's name and city occur with, as the
    reference does.  ``match_state=True`` joins on all three: one row per application.
    """
    from recordforge.operators.link import left_join_spread_nulls

    apps = application_rows(yearly)
    att = attorneys if attorneys is not None else attorney_dim(yearly)
    lk, rk = ["agent_attorney_name", "agent_attorney_city"], ["attorney_name", "attorney_city"]
    if match_state:
        lk, rk = lk + ["agent_attorney_state"], rk + ["attorney_state"]
    joined = left_join_spread_nulls(apps, att.select("attorney_id", *rk), lk, rk)
    return joined.select(*APPLICATION_COLUMNS, "attorney_id")
