"""Every queries() key against its DuckDB oracle statement, on the smallest driver tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402
from rf_testdata import SF_SMALL  # noqa: E402
from oracle_check import digest, duck_conn, SPARK_TO_DUCK  # noqa: E402

from recordforge.plans.catalog import ORACLE, QUERIES  # noqa: E402

KEYS = sorted(entry.oracle_sql())


def test_every_key_has_an_oracle():
    # the optional training-data queries have brute-force tests of their own where SQL cannot express them
    assert set(ORACLE) == set(QUERIES) <= set(entry.queries())
    assert len(QUERIES) >= 46


@pytest.fixture(scope="module")
def con():
    return duck_conn(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    sdf = entry.queries()[key](spark, SF_SMALL)
    s_cols = sdf.columns
    s_types = [SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields]
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(entry.oracle_sql()[key])
    d_rows = rel.fetchall()
    assert sorted(zip(s_cols, s_types)) == sorted(zip(rel.columns, [str(t) for t in rel.types]))
    assert len(s_rows) == len(d_rows)
    assert digest(s_cols, s_rows)[0] == digest(rel.columns, d_rows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["age_label", "employer_state", "employer_count"]
    assert df.count() > 0
