"""Repair operators on random rows: properties that follow from the rules, whatever the row.

Expected values for chosen rows are in ``test_repair.py``.
"""

import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from recordforge.operators.registrations import clean_registrations, registration_rejects
from recordforge.operators.repair import link_city, repair_employers, repair_soc, repair_wage_fields, repair_worksite

USA = "UNITED STATES OF AMERICA"
pieces = st.sampled_from(["", " ", ",", "1", "78701", "12 MAIN", "AUSTIN", "TX", "CT", "12", ".0", "AB",
                          " COUNTY", "KING", "15-1132.00", USA, "SOFTWARE", " , ", "0"])
text = st.lists(pieces, min_size=0, max_size=3).map("".join)
maybe = st.one_of(st.none(), text)
SETTINGS = settings(max_examples=25, deadline=None)
EMPLOYER = ("employer_id string, employer_name string, employer_address string, employer_city string, employer_state string, "
            "employer_postal_code string, employer_country string, employer_province string, employer_phone string, "
            "h1b_dependent boolean, willful_violator boolean")


@SETTINGS
@given(st.lists(st.tuples(maybe, text, maybe, maybe, maybe, maybe, maybe), min_size=1, max_size=12))
def test_employer_repair(spark, rows):
    df = spark.createDataFrame([(str(i), "N", *r, None, None) for i, r in enumerate(rows)], EMPLOYER)
    ok, rejected = (x.collect() for x in repair_employers(df))
    came = {r.employer_id: r for r in df.collect()}
    assert sorted(r.employer_id for r in ok + rejected) == sorted(came)
    for r in rejected:  # as it came, so that it can be mended and replayed
        assert r.asDict() == {**came[r.employer_id].asDict(), "reject_reason": "no city after repair"}
        assert len(r.employer_state or "") <= 2
    for r in ok:
        before = came[r.employer_id]
        long_state = len(before.employer_state or "") > 2
        assert r.employer_city and (r.employer_city == before.employer_state if long_state else not r.employer_city[0].isdigit())
        assert len(r.employer_state or "") <= 2
        assert not (r.employer_country or "").isdigit() and r.employer_province != USA
        assert r.employer_province in (None, before.employer_province)
        if before.employer_province == USA:
            assert r.employer_country == USA
        # every value stands in some field of the row it came from
        had = {v for v in before.asDict().values() if v is not None}
        had |= {v.replace(",", "").strip() for v in had} | {v.replace(".0", "") for v in had}
        assert {v for v in r.asDict().values() if v is not None} <= had


@SETTINGS
@given(st.lists(st.tuples(maybe, text, maybe, maybe, maybe, maybe, maybe), min_size=1, max_size=12))
def test_commas_around_a_city_change_nothing(spark, rows):
    def repaired(mark):
        data = [(str(i), "N", r[0], mark(r[1]), *r[2:], None, None) for i, r in enumerate(rows)]
        return sorted(repair_employers(spark.createDataFrame(data, EMPLOYER))[0].collect(), key=lambda r: r.employer_id)

    assert repaired(lambda c: c) == repaired(lambda c: f" ,{c}, ")


@SETTINGS
@given(st.lists(st.tuples(maybe, maybe, maybe, maybe), min_size=1, max_size=12))
def test_worksite_repair(spark, rows):
    df = spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)],
                               "job_id string, worksite_city string, worksite_county string, worksite_state string, "
                               "worksite_postal_code string")
    for r in repair_worksite(df).collect():
        city, county, state, postal = rows[int(r.job_id)]
        got = (r.worksite_city, r.worksite_county, r.worksite_state, r.worksite_postal_code)
        if not postal:
            assert got == (city, county, state, postal)
            continue
        assert got[3] in (None, postal) and (got[3] is None or got[3][0].isdigit())
        assert got[2] == (state if got[3] else postal) and got[0] == (city if got[3] else county)
        assert got[1] is None or not (got[1].isdigit() or got[1] == got[2])


@SETTINGS
@given(st.lists(st.tuples(maybe, maybe, maybe, st.sampled_from([None, 0.0, 5.0])), min_size=1, max_size=12))
def test_soc_and_wage_repair(spark, rows):
    df = spark.createDataFrame([(str(i), c, n, u, 1.0, t) for i, (c, n, u, t) in enumerate(rows)],
                               "job_id string, soc_code string, soc_name string, pw_unit_of_pay string, "
                               "prevailing_wage double, wage_rate_of_pay_to double")
    for r in repair_wage_fields(repair_soc(df)).collect():
        code, name, unit, to = rows[int(r.job_id)]
        if code is None or name is None:
            assert (r.soc_code, r.soc_name) == (code, name)
        else:
            assert sorted([r.soc_code, r.soc_name.replace(".00", "")]) == sorted([code.replace(".00", ""), name.replace(".00", "")])
            assert not r.soc_name[:1].isdigit() or name[:1].isdigit()
        assert r.prevailing_wage is not None  # a wage is replaced or kept, never lost
        assert r.pw_unit_of_pay in (None, unit) and (r.pw_unit_of_pay == unit or unit[0].isdigit())
        assert r.pw_unit_of_pay is None or r.prevailing_wage == 1.0
        assert r.wage_rate_of_pay_to == (to or None)


@SETTINGS
@given(st.lists(st.tuples(maybe, maybe), min_size=1, max_size=12))
def test_link_city(spark, rows):
    df = spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)], "id string, c string, s string")
    marked = F.concat(F.lit(","), F.col("c"), F.lit(" ,"))
    for r in df.select("id", link_city(F.col("c"), F.col("s")).alias("x"), link_city(marked, F.col("s")).alias("y")).collect():
        city, state = rows[int(r.id)]
        assert r.x == r.y
        if r.x is None:
            assert state is None or len(state) <= 2
        else:
            assert r.x == state or (r.x and not r.x[0].isdigit() and "," not in r.x and r.x in city.replace(",", ""))


@SETTINGS
@given(st.lists(st.tuples(text, st.sampled_from(["CT", "CO", "AUSTIN"])), min_size=1, max_size=12))
def test_clean_registrations(spark, rows):
    df = spark.createDataFrame([(str(i), "Acme", c, s, dt.date(2000, 1, 1)) for i, (c, s) in enumerate(rows)],
                               "corporation_id string, corporation_name string, corporation_city string, "
                               "corporation_state string, registration_date date")
    kept, rejected = clean_registrations(df).collect(), registration_rejects(df).collect()
    assert sorted(r.corporation_id for r in kept + rejected) == sorted(str(i) for i in range(len(rows)))
    for r in rejected:
        assert (r.corporation_city, r.corporation_state) == rows[int(r.corporation_id)]
    for r in kept:
        city, state = rows[int(r.corporation_id)]
        assert r.corporation_city in city.upper() and r.corporation_city == r.corporation_city.strip()
        assert r.corporation_city.count(",") != 1 or len(city) == 1
        if state == "CT":
            assert "," in city
        elif len(city) > 1:
            assert not city[0].isdigit() and city != state
