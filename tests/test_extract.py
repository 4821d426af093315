"""Wide extract: header drop (S1), ragged parse (S2), the four-entity split (D8) and the stream."""

import datetime as dt
import os
import uuid

from recordforge.operators.extract import EXTRACT_FIELDS, split_extract
from recordforge.sources.text_source import read_extract_lines


def make_line(n_fields, **over):
    vals = {name: "" for name in EXTRACT_FIELDS}
    vals.update(case_number="I-1", case_status="CERTIFIED", case_submitted="1/2/2018", decision_date="01/02/2022",
                visa_class="H-1B", employment_start_date="1/2/2018", employment_end_date="1/2/2021",
                employer_name="ACME, INC.", employer_city="AUSTIN", prevailing_wage="65,000.00",
                wage_rate_of_pay_from="abc", wage_rate_of_pay_to="70,000", full_time_position="Yes",
                total_workers="3", h1b_dependent="Y", worksite_postal_code="78701", original_cert_date="x")
    vals.update(over)
    return "\t".join(vals[n] for n in EXTRACT_FIELDS[:n_fields])


def test_split_golden(spark, scratch):
    path = os.path.join(scratch, "extract.tsv")
    header = "\t".join(n.upper() for n in EXTRACT_FIELDS)
    with open(path, "w") as f:
        f.write(header + "\n")
        f.write(make_line(40, case_number="SHORT") + "\n")
        f.write(make_line(41, case_number="MIN", full_time_position="N") + "\n")
        f.write(make_line(52, case_number="FULL") + "  \n")
    parts = split_extract(read_extract_lines(spark, path))
    assert [r.field_count for r in parts["rejects"].collect()] == [40]
    apps = {r.case_number: r for r in parts["application"].collect()}
    assert set(apps) == {"MIN", "FULL"}
    assert apps["FULL"].case_submitted == dt.date(2018, 1, 2) and apps["FULL"].decision_date == dt.date(2022, 1, 2)
    assert apps["FULL"].employer_name == "ACME"
    jobs = parts["job"].collect()
    full = [j for j in jobs if j.wage_unit_of_pay is not None or j.worksite_postal_code == "78701"]
    assert len(full) == 1 and full[0].worksite_postal_code == "78701"
    for j in jobs:
        assert j.prevailing_wage == 65000.0 and j.wage_rate_of_pay_from is None and j.wage_rate_of_pay_to == 70000.0
        assert j.total_workers == 3
    assert sorted(j.full_time_position for j in jobs) == [False, True]
    emps = parts["employer"].collect()
    assert sorted(e.h1b_dependent for e in emps) == [False, True]   # optional field absent -> false


def test_strip_drops_trailing_empty_fields(spark, scratch):
    path = os.path.join(scratch, "extract.tsv")
    with open(path, "w") as f:
        f.write(make_line(52, worksite_county="", worksite_state="TX", worksite_postal_code="", original_cert_date="") + "\n")
    job = split_extract(read_extract_lines(spark, path))["job"].first()
    assert job.worksite_postal_code is None and job.worksite_state == "TX" and job.worksite_county == ""


def test_stream_available_now(spark, scratch):
    from recordforge.streaming.extract_stream import start_extract_stream

    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    with open(os.path.join(landing, "a.tsv"), "w") as f:
        f.write(make_line(52, case_number="S1") + "\n" + make_line(30) + "\n")
    out = os.path.join(scratch, "out")
    def run():
        start_extract_stream(spark, landing, out, query_name=f"t_stream_{uuid.uuid4().hex[:12]}",
                             available_now=True).awaitTermination(120)
        return [spark.read.parquet(os.path.join(out, n)).count() for n in ("application", "rejects")]

    assert run() == [1, 1]
    assert run() == [1, 1]  # a restart, also under another name, adds nothing
    with open(os.path.join(landing, "b.tsv"), "w") as f:
        f.write(make_line(52, case_number="S2") + "\n")
    assert run() == [2, 1]
