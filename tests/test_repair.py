"""Golden cases for the repair operators (FIXTURES.md §2: D2, D3, D4, D5, D6, D7) and the age label."""

import datetime as dt

from pyspark.sql import functions as F

from recordforge.operators.registrations import clean_registrations
from recordforge.operators.repair import (
    link_city,
    repair_employers,
    repair_soc,
    repair_wage_fields,
    repair_worksite,
)
from recordforge.plans.analytics import age_label

USA = "UNITED STATES OF AMERICA"
EMP_SCHEMA = ("employer_id string, employer_name string, employer_address string, employer_city string, "
              "employer_state string, employer_postal_code string, employer_country string, "
              "employer_province string, employer_phone string, h1b_dependent boolean, willful_violator boolean")


def test_employer_repair_golden(spark):
    # id, city, address, state, province, postal, phone, country
    cases = [
        ("1", "AUSTIN,", "1 A ST", "TX", None, "78701", "5125551212.0", USA),
        ("2", "78701", "1 A ST", "TX", None, None, None, USA),
        ("3", "78701", "1 A ST", "AUSTIN", None, "TX", None, USA),
        ("4", "12 MAIN ST", "X", "AUSTIN", None, "TX", None, USA),
        ("5", "DALLAS", "X", "AUSTIN", None, "78701", None, USA),
        ("6", "AUSTIN", "X", "TX", None, "CA", None, USA),
        ("7", "AUSTIN", "X", "TX", USA, None, "512.0555", "78701"),
        ("8", "AUSTIN", "X", "TX", None, "12", None, None),
    ]
    rows = [(i, "ACME INC", addr, city, st, post, country, prov, phone, None, None)
            for i, city, addr, st, prov, post, phone, country in cases]
    df = spark.createDataFrame(rows, EMP_SCHEMA)
    ok, rejected = repair_employers(df)
    got = {r.employer_id: (r.employer_city, r.employer_address, r.employer_state, r.employer_province,
                           r.employer_postal_code, r.employer_phone, r.employer_country) for r in ok.collect()}
    assert got["1"] == ("AUSTIN", "1 A ST", "TX", None, "78701", "5125551212", USA)
    assert "2" not in got
    assert got["3"] == ("AUSTIN", "1 A ST", None, None, "78701", None, USA)
    assert got["4"] == ("AUSTIN", "12 MAIN ST", "TX", None, None, None, USA)
    assert got["5"] == ("AUSTIN", "X", None, None, "78701", None, USA)
    assert got["6"] == ("AUSTIN", "X", "CA", None, None, None, USA)
    assert got["7"] == ("AUSTIN", "X", "TX", None, "78701", "512555", USA)
    assert got["8"] == ("AUSTIN", "X", "TX", None, "12", None, None)
    assert [r.employer_id for r in rejected.collect()] == ["2"]
    assert ok.count() + rejected.count() == df.count()


def test_worksite_repair_golden(spark):
    cases = [
        ("1", "AUSTIN", "TRAVIS COUNTY", "TX", "78701", ("AUSTIN", "TRAVIS", "TX", "78701")),
        ("2", "A", "AUSTIN", "TRAVIS COUNTY", "TX", ("AUSTIN", "TRAVIS", "TX", None)),
        ("3", "NYC", "NEW YORK COUNTY", "NEW YORK", "10001", ("NYC", None, "NEW YORK", "10001")),
        ("4", "A", "123", "TX", "78701", ("A", None, "TX", "78701")),
        ("5", "A", "TRAVIS COUNTY", "TX", None, ("A", "TRAVIS COUNTY", "TX", None)),
        ("6", "A", None, "TX", "78701", ("A", None, "TX", "78701")),
        ("7", "A", "AUSTIN", None, "TX", ("AUSTIN", None, "TX", None)),
    ]
    df = spark.createDataFrame([c[:5] for c in cases], "job_id string, worksite_city string, worksite_county string, "
                               "worksite_state string, worksite_postal_code string")
    got = {r.job_id: (r.worksite_city, r.worksite_county, r.worksite_state, r.worksite_postal_code)
           for r in repair_worksite(df).collect()}
    for c in cases:
        assert got[c[0]] == c[5], c


def test_soc_and_wage_repair(spark):
    df = spark.createDataFrame([
        ("1", "SOFTWARE DEVELOPERS", "15-1132.00", "Year", 1.0, 0.0),
        ("2", "15-1132.00", None, "65000", 1.0, 5.0),
        ("3", None, None, "65,000.", 1.0, None),
        ("4", None, None, "2080 HRS", 1.0, None),
    ], "job_id string, soc_code string, soc_name string, pw_unit_of_pay string, prevailing_wage double, "
       "wage_rate_of_pay_to double")
    got = {r.job_id: r for r in repair_wage_fields(repair_soc(df)).collect()}
    assert (got["1"].soc_code, got["1"].soc_name) == ("15-1132", "SOFTWARE DEVELOPERS")
    assert (got["2"].soc_code, got["2"].soc_name) == ("15-1132.00", None)
    assert got["1"].wage_rate_of_pay_to is None and got["2"].wage_rate_of_pay_to == 5.0
    assert (got["2"].pw_unit_of_pay, got["2"].prevailing_wage) == (None, 65000.0)
    assert (got["1"].pw_unit_of_pay, got["1"].prevailing_wage) == ("Year", 1.0)
    assert (got["3"].pw_unit_of_pay, got["3"].prevailing_wage) == (None, 65000.0)
    assert (got["4"].pw_unit_of_pay, got["4"].prevailing_wage) == ("2080 HRS", 1.0)


def test_link_city(spark):
    df = spark.createDataFrame([("AUSTIN, ", "TX"), ("12 MAIN", "AUSTIN"), ("12 MAIN", "TX"), (" , ", "DALLAS"),
                                ("78701", None)], "c string, s string")
    got = [r.x for r in df.select(link_city(F.col("c"), F.col("s")).alias("x")).collect()]
    assert got == ["AUSTIN", "AUSTIN", None, "DALLAS", None]


def test_clean_registrations_golden(spark):
    rows = [
        ("1", "12 MAIN ST, HARTFORD, CT, 06101", "CT", "HARTFORD"),
        ("2", "APT 4, 12 MAIN ST, HARTFORD, CT, 06101", "CT", "HARTFORD"),
        ("3", "HARTFORD, CT, 06101", "CT", "CT"),
        ("4", "Denver, CO", "CO", "DENVER"),
        ("5", "denver ", "CO", "DENVER"),
        ("6", "A, B, C", "CO", "A, B, C"),
        ("7", "5", "CO", "5"),
        ("8", "   ", "CO", ""),
        ("9", "80202", "CO", None),
        ("10", "12 Main", "CO", None),
        ("11", "CO", "CO", None),
        ("12", "", "CO", None),
    ]
    df = spark.createDataFrame([(i, "Acme, Inc.", c, s, dt.date(2000, 1, 1)) for i, c, s, _ in rows],
                               "corporation_id string, corporation_name string, corporation_city string, "
                               "corporation_state string, registration_date date")
    got = {r.corporation_id: (r.corporation_city, r.corporation_name) for r in clean_registrations(df).collect()}
    for i, _, _, expected in rows:
        if expected is None:
            assert i not in got, i
        else:
            assert got[i] == (expected, "ACME"), i


def test_age_label(spark):
    df = spark.createDataFrame([(a,) for a in [-1, 0, 2, 3, 7, 8, 12, 13, 17, 18, None]], "a bigint")
    got = [r.l for r in df.select(age_label(F.col("a")).alias("l")).collect()]
    assert got == [None, "Ages 0-2", "Ages 0-2", "Ages 3-7", "Ages 3-7", "Ages 8-12", "Ages 8-12",
                   "Ages 13-17", "Ages 13-17", "Ages 18+", None]
