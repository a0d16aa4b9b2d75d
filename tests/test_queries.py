"""Every registered query against its SQL, and the shape of the plans."""

import os
import re

import oracle
import pytest
from fixtures import DATA
from pyspark.sql import functions as F

import __spark_entry__ as contract
from palate.plans import registry

FOLDER = str(DATA / f"sf{os.environ.get('PALATE_SF', '0.001')}")

QUERIES, SQL = registry.QUERIES, registry.ORACLES


#: Columns that own a ranked list.
OWNERS = ("userId", "movieId", "queryId")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    if name in SQL:
        _, problems = oracle.compare(df, duck, SQL[name])
        assert not problems
    else:
        rows = df.collect()
        assert rows
        ranked = {}
        for r in rows if "rank" in df.columns and df.columns[0] in OWNERS else []:
            assert r["rank"] is not None
            ranked.setdefault(r[0], []).append(r["rank"])
        assert all(sorted(x) == list(range(1, len(x) + 1)) for x in ranked.values())


def test_every_sql_belongs_to_a_query():
    assert SQL.keys() <= QUERIES.keys()


def test_entry(spark):
    assert contract.entry(spark).count() == 50


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_products_and_no_row_udfs(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scan_reads_only_what_is_needed(spark):
    plan = plan_of(QUERIES["item_stats"](spark, FOLDER))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert sorted(schemas) == ["l_orderkey:bigint,l_partkey:bigint,l_quantity:double", "o_orderkey:bigint"]


def test_user_filter_reaches_the_scan(spark):
    from palate.sources.sales import SalesTables

    mine = SalesTables(spark, FOLDER).ratings().where(F.col("userId") == 5)
    assert "EqualTo(o_custkey,5)" in plan_of(mine)


@pytest.mark.parametrize("name", ["recent_ratings", "popular_by_genre", "coldstart_cosine"])
def test_ranks_are_cut_before_the_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert re.search(r"WindowGroupLimit .*Partial", plan)


def test_global_lists_use_a_bounded_sort(spark):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["weighted_popularity"](spark, FOLDER))
