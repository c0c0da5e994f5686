import pytest
from pyspark.sql import functions as F

from tamis.operators import identity


def made(spark, n=20_000):
    return spark.range(n).selectExpr("id", "id * 0.5 as v", "concat('t', id % 7) as t", "array(id, null) as l")


def changes(source, target, **options):
    return {r.id: r.statut for r in identity.changed_rows(source, target, "id", **options).collect()}


def test_one_changed_row_is_found_in_one_bucket(spark):
    source = made(spark)
    target = source.withColumn("v", F.when(F.col("id") == 77, F.lit(None)).otherwise(F.col("v")))
    assert changes(source, target) == {"77": "different"}
    found = identity.differing_buckets(source, target, "id").collect()
    assert len(found) == 1 and 0 < found[0]["lignes_source"] == found[0]["lignes_cible"] < 40
    assert changes(source, target, columns=["id", "t"]) == {}


def test_equal_tables_end_after_the_buckets(spark):
    source = made(spark)
    out = identity.changed_rows(source, source.repartition(3), "id", buckets=64)
    assert out.collect() == []
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # No bucket differs, so neither table is read again: nothing of the second level is left in the plan that ran.
    assert "isFinalPlan=true" in final and "EmptyRelation" in final and "ShuffleQueryStage" not in final


def test_added_missing_moved_and_repeated_rows(spark):
    rows = lambda values: spark.createDataFrame(values, "id long, v string")
    source = rows([(1, "a"), (2, "b"), (3, "c"), (4, "x"), (4, "y"), (5, "d"), (None, "n")])
    target = rows([(1, "b"), (2, "a"), (4, "y"), (4, "x"), (5, "d"), (5, "d"), (6, None), (None, "m")])
    for buckets in (1, 8):
        assert changes(source, target, buckets=buckets) == {
            "1": "different", "2": "different", "3": "absent", "5": "different", "6": "en_trop"}
    assert changes(source.limit(0), target.limit(0)) == {}
    assert set(changes(source, target.limit(0)).values()) == {"absent"}


def test_without_the_id_among_the_columns_it_still_counts(spark):
    source, target = (spark.createDataFrame(v, "id long, v string") for v in ([(1, "a"), (2, "b")], [(1, "b"), (2, "a")]))
    assert changes(source, target, columns=["v"], buckets=1) == {"1": "different", "2": "different"}


def test_agrees_with_the_comparison_of_all_rows(spark):
    source = made(spark, 3000)
    target = source.filter("id % 11 <> 3").withColumn("t", F.when(F.col("id") % 13 == 5, "other").otherwise(F.col("t")))
    target = target.unionByName(source.limit(40).withColumn("id", F.col("id") + 10_000))
    want = {r.id: r.statut for r in identity.compare_rows(source, target, "id").collect() if r.statut != "identique"}
    assert changes(source, target, buckets=100) == want and len(want) > 500


def test_buckets_are_bounded(spark):
    with pytest.raises(ValueError, match="buckets"):
        identity.changed_rows(made(spark, 1), made(spark, 1), "id", buckets=1 << 20)
