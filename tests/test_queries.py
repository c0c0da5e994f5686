"""Every registered query against its SQL, and the shape of the plans that matter."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
import compare  # noqa: E402
from tamis.operators import dimension, marts  # noqa: E402
from tamis.plans import catalogue, tables  # noqa: E402


@pytest.fixture(scope="module")
def con(small):
    return compare.connect(small)


# A few queries state exact figures of the sf0.01 tables.
@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_matches_sql(spark, con, small, name):
    ok, message, _ = compare.compare(spark, con, name, small)
    assert ok, message


def test_every_query_has_a_check():
    assert set(catalogue.ORACLE) == set(catalogue.QUERIES) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "part_offres_pct" in df.columns


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["mart_market_kpis", "mart_by_region", "mart_salary_analysis"])
def test_marts_need_no_expand_and_no_python(spark, small, name):
    plan = executed(entry.queries()[name](spark, small))
    assert "Expand" not in plan and "Python" not in plan and "CartesianProduct" not in plan


def test_scans_are_pruned(spark, small):
    plan = executed(entry.queries()["scan_parquet"](spark, small))
    assert "EqualTo(l_returnflag,R)" in plan
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in plan


def test_enrichment_does_not_shuffle(spark, small):
    from tamis.operators import enrichment

    stored = tables.stored(spark, small, "offers", lambda: tables.offers(spark, small))
    assert "Exchange" not in executed(enrichment.enrich(stored))


def test_large_aggregation_stays_hash_based(spark, small):
    plan = executed(marts.market_kpis(tables.combined(spark, small)))
    # Only origins, a row per category combination, are aggregated by sorting.
    assert plan.count("HashAggregate") >= 4
    assert not [x for x in plan.splitlines() if "SortAggregate" in x and "_mask" in x]


@pytest.mark.parametrize("name", ["raw_gate", "load_contract", "skip_if_loaded", "key_validity"])
def test_gates_do_not_sort_rows(spark, small, name):
    plan = executed(entry.queries()[name](spark, small))
    assert "HashAggregate" in plan and " Sort [" not in plan


def test_no_job_runs_while_a_join_is_built(spark, small):
    offers = tables.enriched(spark, small)
    seen = spark.sparkContext.statusTracker().getJobIdsForGroup()
    dimension.attach_area(offers, dimension.preset_reference(spark))
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == seen
