"""Golden cases for the column functions (FIXTURES.md §2)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from recordforge.functions import text as tx
from recordforge.operators.registrations import ct_city
from recordforge.operators.staging import wage_range_from, wage_range_to
from recordforge.operators.wages import annualize_wage


def one_col(spark, values, type_="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {type_}")


NAMES = [
    ("ACME, INC.", "ACME", "ACME"),
    ("FOO (USA) CORPORATION", "FOO USA", "FOO USA"),
    ("BAR INCORPORATED", "BARORPORATED", "BARORPORATED"),
    ("&QUOT;BAZ&QUOT; L.L.C.", "BAZ", "BAZ"),
    ("X PCS LPX", "XSX", "XSX"),
    ("A CORPORATIONS", "AS", "AS"),
    (" L LLCTD", "", ""),
    ("acme inc", "acme inc", "ACME"),
    ("O'NEIL/SONS LTD", "ONEILSONS", "ONEILSONS"),
    ("INC", "INC", "INC"),
]


def test_normalize_org_name(spark):
    df = one_col(spark, [n for n, _, _ in NAMES])
    rows = df.select("x", tx.normalize_org_name("x").alias("a"), tx.normalize_org_name("x", upper=True).alias("u")).collect()
    got = {r.x: (r.a, r.u) for r in rows}
    for name, plain, upper in NAMES:
        assert got[name] == (plain, upper), name


def test_normalize_never_lengthens_and_removes_punctuation(spark):
    from hypothesis import given, settings, strategies as st

    alphabet = st.sampled_from(list("AB .,()/'\"&QUOTINCLPRD"))

    @settings(max_examples=25, deadline=None)
    @given(st.lists(st.text(alphabet, max_size=20), min_size=1, max_size=20))
    def check(values):
        rows = one_col(spark, values).select("x", tx.normalize_org_name("x").alias("n")).collect()
        for r in rows:
            assert len(r.n) <= len(r.x)
            assert not any(ch in r.n for ch in ".,()/'\"")

    check()


def test_wage_range_split(spark):
    df = one_col(spark, ["60000 - 70000", "60000 -", "60000", "x - 5"])
    rows = df.select("x", wage_range_from(F.col("x")).alias("f"), wage_range_to(F.col("x")).alias("t")).collect()
    got = {r.x: (r.f, r.t) for r in rows}
    assert got == {"60000 - 70000": (60000.0, 70000.0), "60000 -": (60000.0, None),
                   "60000": (None, 60000.0), "x - 5": (None, 5.0)}


def test_safe_casts(spark):
    df = one_col(spark, ["true", "TRUE", "false", "Y", "1", "t", "12d", " 5 ", "1.5", "2018-1-2", "2015", "2018-02-30"])
    rows = df.select("x", tx.safe_bool("x").alias("b"), tx.safe_double("x").alias("d"), tx.safe_date("x").alias("dt")).collect()
    got = {r.x: (r.b, r.d, r.dt) for r in rows}
    assert got["true"][0] is True and got["TRUE"][0] is True and got["false"][0] is False
    assert got["Y"][0] is None and got["1"][0] is None and got["t"][0] is None
    assert got["12d"][1] is None and got[" 5 "][1] == 5.0 and got["1.5"][1] == 1.5
    assert got["2018-1-2"][2] == dt.date(2018, 1, 2)
    assert got["2015"][2] is None and got["2018-02-30"][2] is None


def test_digit_checks(spark):
    df = one_col(spark, ["12345", "12 MAIN", "MAIN", "", "7\n"])
    rows = df.select("x", tx.is_all_digits("x").alias("d"), tx.starts_with_digit("x").alias("s")).collect()
    got = {r.x: (r.d, r.s) for r in rows}
    assert got == {"12345": (True, True), "12 MAIN": (False, True), "MAIN": (False, False), "": (False, False),
                   "7\n": (False, True)}


def test_ct_city(spark):
    df = one_col(spark, ["12 MAIN ST, HARTFORD, CT, 06101", "APT 4, 12 MAIN ST, HARTFORD, CT, 06101",
                         "HARTFORD, CT, 06101", "A, B", "A"])
    got = {r.x: r.c for r in df.select("x", ct_city(F.col("x")).alias("c")).collect()}
    assert got["12 MAIN ST, HARTFORD, CT, 06101"] == " HARTFORD"
    assert got["APT 4, 12 MAIN ST, HARTFORD, CT, 06101"] == " HARTFORD"
    assert got["HARTFORD, CT, 06101"] == " CT"
    assert got["A, B"] == " B"
    assert got["A"] is None


@pytest.mark.parametrize("avg,expected", [(25.0, 73000.0), (299.999, 875997.08), (300.0, None), (15000.0, None),
                                          (15000.014, 15000.01), (None, None)])
def test_annualize(spark, avg, expected):
    df = spark.createDataFrame([(avg,)], "a double")
    assert df.select(annualize_wage(F.col("a")).alias("y")).first().y == expected


def test_year_boundaries_and_round(spark):
    df = spark.createDataFrame([(dt.date(2017, 12, 31), dt.date(2018, 1, 1), 1.005)], "a date, b date, x double")
    r = df.select(tx.year_boundaries_between("a", "b").alias("y"), tx.round_half_up("x").alias("r")).first()
    assert r.y == 1 and r.r == 1.01


def test_text_key_is_stable(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", None, 1.0), ("a", "", 1.0)], "p string, q string, w double")
    keys = [r.k for r in df.select(tx.text_key(["p", "q", "w"], {"w": "double"}).alias("k")).collect()]
    assert keys[0] == keys[1] and keys[0] != keys[2]


def test_text_key_tells_different_rows_apart(spark):
    rows = [("a", None, 1.0), ("a", "\\N", 1.0), ("a", "N", 1.0), ("a\x1fb", "c", 1.0), ("a", "b\x1fc", 1.0), ("a1:b", "", 1.0),
            ("a", "1:b", 1.0), ("a", "", 1.0), ("a", "", 1.0 + 1e-12), ("a", "", float("nan")), ("a", "", None), ("a", "", 1e35),
            ("a", "", float("inf"))]
    df = spark.createDataFrame(rows, "p string, q string, w double")
    assert df.select(tx.text_key(["p", "q", "w"], {"w": "double"}).alias("k")).distinct().count() == len(rows)
    zeros = spark.createDataFrame([("a", "", 0.0), ("a", "", -0.0)], "p string, q string, w double")  # equal for DISTINCT
    assert zeros.select(tx.text_key(["p", "q", "w"], {"w": "double"}).alias("k")).distinct().count() == 1


def test_normalize_whole_word_option(spark):
    df = one_col(spark, ["BAR INCORPORATED", "ACME, INC.", "X PCS LPX", "FOO CORP", "A LTD/B"])
    got = [r.n for r in df.select(tx.normalize_org_name("x", whole_word=True).alias("n")).collect()]
    # punctuation goes first, so "A LTD/B" becomes "A LTDB", where " LTD" is not a whole word
    assert got == ["BAR INCORPORATED", "ACME", "X PCS LPX", "FOO", "A LTDB"]
