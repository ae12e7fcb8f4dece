from __future__ import annotations

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from attrition.functions.features import row_features
from attrition.plans import catalog, oracles
from attrition.schemas import FEATURES
from compare import database, difference

ROOT = os.path.dirname(os.path.abspath(entry.__file__))
SMALL = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return database(SMALL)


def test_every_oracle_has_a_query(spark):
    assert set(ORACLES) <= set(entry.queries())
    assert set(oracles.oracle_sql()) == set(catalog.queries())
    assert catalog.ROW_FEATURE_NAMES == [f for f in FEATURES if f in row_features()]


def test_queries_are_listed_without_a_session():
    script = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", script], cwd=ROOT, capture_output=True, text=True)
    assert done.stdout.split() == [str(len(entry.queries())), str(len(ORACLES))], done.stderr


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    assert difference(entry.queries()[name](spark, SMALL), db, ORACLES[name]) is None


def test_flagship(spark):
    assert sum(r.n_rows for r in entry.entry(spark).collect()) == 66
