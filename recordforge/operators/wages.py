"""Wage statistics and geography: annualise (D10) and merge the yearly tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordforge.functions.text import round_half_up
from recordforge.operators.staging import Yearly, align, aligned_union

HOURS_PER_DAY = 8
DAYS_PER_YEAR = 365
HOURLY_BELOW = 300
ANNUAL_ABOVE = 15000
WAGE_COLUMNS = ("area", "year", "soc_code", "annual_salary")
GEOGRAPHY_COLUMNS = ("area", "year", "state", "county")


def annualize_wage(avg: Column, hours: int = HOURS_PER_DAY, days: int = DAYS_PER_YEAR) -> Column:
    """An average under 300 is hourly, over 15000 is annual, anything between is null."""
    return (
        F.when(avg < HOURLY_BELOW, round_half_up(avg * hours * days))
        .when(avg > ANNUAL_ABOVE, round_half_up(avg))
        .otherwise(F.lit(None).cast("double"))
    )


def _wage_rules(year: int) -> dict:
    return {
        "area": lambda c: c("Area").cast("bigint"),
        "year": lambda c: F.lit(year).cast("bigint"),
        "soc_code": lambda c: c("SocCode"),
        "annual_salary": lambda c: annualize_wage(c("Average").cast("double")),
    }


def _geography_rules(year: int) -> dict:
    return {
        "area": lambda c: c("Area").cast("bigint"),
        "year": lambda c: F.lit(year).cast("bigint"),
        "state": lambda c: c("StateAb"),
        "county": lambda c: c("CountyTownName"),
    }


def wages_of_year(table: DataFrame, year: int) -> DataFrame:
    """One year's wage table in the merged shape."""
    return align(table, year, WAGE_COLUMNS, {year: _wage_rules(year)})


def geography_of_year(table: DataFrame, year: int) -> DataFrame:
    """One year's geography table in the merged shape."""
    return align(table, year, GEOGRAPHY_COLUMNS, {year: _geography_rules(year)})


def merge_wages(yearly: Yearly) -> DataFrame:
    """All_Industries_Wages(area, year, soc_code, annual_salary) from the yearly tables."""
    return aligned_union(yearly, WAGE_COLUMNS, {y: _wage_rules(y) for y in yearly})


def merge_geography(yearly: Yearly) -> DataFrame:
    """Geography(area, year, state, county) from the yearly tables."""
    return aligned_union(yearly, GEOGRAPHY_COLUMNS, {y: _geography_rules(y) for y in yearly})
