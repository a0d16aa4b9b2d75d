"""Registered corpus queries against their SQL, and the plans of those that must stay native."""

import os
import re

import oracle
import pytest

from palate.llm.queries import ORACLES, QUERIES

DATA = os.environ.get("PALATE_TESTDATA", "/root/testdata")
FOLDER = f"{DATA}/sf{os.environ.get('PALATE_SF', '0.001')}"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    rows, problems = oracle.compare(QUERIES[name](spark, FOLDER), oracle.connect(FOLDER), ORACLES[name])
    assert rows and not problems


def test_every_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES if n != "pipeline") == list(range(1, 14))


@pytest.mark.parametrize("name", ["op4_mixing", "op6_quality_rules"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
