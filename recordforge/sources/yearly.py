"""Yearly tables found by a path pattern.

``read_yearly(spark, "/in/H1B_Applications_*")`` finds every table that matches, takes the year from its
name, and returns ``{year: frame}``.  A table of a new year is read without a change of code: columns are taken by
name unless the staging rules have one for that year.  ``check_drift`` compares what the rules make of each
year's table with the types staging needs, before anything is read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge.operators.staging import Rules, align

#: the table's path up to the part that ends in _<year>, with or without a file suffix
TABLE_OF_YEAR = r"^(.*_([0-9]{4})(?:\.[A-Za-z]+)?)(?:/[^/]*)?$"


def find_yearly(spark: SparkSession, pattern: str) -> dict[int, str]:
    """Year -> path of its table, of all tables the pattern matches.  File contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(pattern).select("path")
    found = (files.select("path", F.regexp_extract("path", TABLE_OF_YEAR, 1).alias("table"), F.regexp_extract("path", TABLE_OF_YEAR, 2).alias("year"))
             .groupBy("table", "year").agg(F.min("path").alias("path")).collect())  # one row per table
    unnamed = sorted(r["path"] for r in found if not r["year"])
    if unnamed:
        raise ValueError(f"no year in the name of {unnamed[0]}")
    tables: dict[int, str] = {}
    for r in sorted(found):
        if int(r["year"]) in tables:
            raise ValueError(f"two tables of {r['year']}: {tables[int(r['year'])]}, {r['table']}")
        tables[int(r["year"])] = r["table"]
    return tables


def check_drift(yearly: Mapping[int, DataFrame], columns: Mapping[str, str], mapping: Rules) -> None:
    """Raise for a table that lacks a column staging needs, or has it with another type than ``columns`` says.

    Types are those after the year's rules.  Columns staging does not ask for may come and go.
    """
    for year, table in sorted(yearly.items()):
        for name, wanted in columns.items():
            try:
                found = align(table, year, (name,), mapping).schema[name].dataType.simpleString()
            except AnalysisException as e:
                raise ValueError(f"applications of {year}: no column for {name}; add a rule for the year ({e.getCondition()})") from e
            if found != wanted:
                raise ValueError(f"applications of {year}: {name} is {found}, not {wanted}; add a rule for the year")


def read_yearly(spark: SparkSession, pattern: str, columns: Mapping[str, str] | None = None, mapping: Rules | None = None) -> dict[int, DataFrame]:
    """The yearly tables a path pattern matches, by year; checked for drift if ``columns`` are given."""
    yearly = {year: spark.read.parquet(path) for year, path in find_yearly(spark, pattern).items()}
    if columns:
        check_drift(yearly, columns, mapping or {})
    return yearly
