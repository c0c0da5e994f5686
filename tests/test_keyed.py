import pytest
from pyspark.sql import functions as F

from tamis.operators.checks import ContractError
from tamis.session import scratch_path
from tamis.sources import keyed, runs
from tamis.sources.keyed import KeyedTable


def rows(spark, values, schema="k long, name string, seq long, v string"):
    return spark.createDataFrame(values, schema)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def folders(df):
    return {f.rsplit("/", 2)[1] for f in df.inputFiles()}


def test_greatest_order_stays_and_stored_keys_are_unique(spark):
    table = KeyedTable(spark, scratch_path(spark, "k"), ["k", "name"], ["seq"], buckets=4)
    assert table.upsert(rows(spark, [(1, "a", 5, "x"), (1, "a", 7, "y"), (None, "a", 1, "n"), (2, None, 1, "m")])) == 1
    table.upsert(rows(spark, [(1, "a", 6, "late"), (None, "a", 2, "n2"), (3, "c", None, None)]))
    want = [(1, "a", 7, "y"), (2, None, 1, "m"), (3, "c", None, None), (None, "a", 2, "n2")]
    assert found(table.read()) == sorted(want, key=str)
    stored = [folder for own in table.state()[2].values() for _, folder in own]
    raw = spark.read.schema(table.read().schema).parquet(*stored)
    assert raw.groupBy("k", "name").count().filter("count > 1").isEmpty() and raw.count() == 4


def test_equal_order_goes_to_the_later_write_and_ties_do_not_depend_on_partitions(spark):
    table = KeyedTable(spark, scratch_path(spark, "k"), ["k"], buckets=2)
    table.append(rows(spark, [(1, "z", 9, "old")]))
    table.append(rows(spark, [(1, "a", 1, "new"), (1, "a", 1, "mew")]).repartition(2))
    assert found(table.read()) == [(1, "a", 1, "new")]
    assert table.compact() == 3 and found(table.read()) == [(1, "a", 1, "new")]
    assert all(len(own) == 1 for own in table.state()[2].values())
    assert table.compact() == 3  # nothing to merge


def test_a_write_reads_only_the_buckets_of_its_rows(spark, monkeypatch):
    table = KeyedTable(spark, scratch_path(spark, "k"), ["k"], ["seq"], buckets=8)
    table.upsert(spark.range(1000).selectExpr("id as k", "'a' as name", "1L as seq", "'v' as v"))
    before, read = table.state()[2], []
    load = KeyedTable._load
    monkeypatch.setattr(KeyedTable, "_load", lambda self, paths, schema: read.extend(paths) or load(self, paths, schema))
    change = rows(spark, [(17, "b", 2, "w")])
    bucket = table._bucketed(change).first()[keyed.BUCKET]
    table.upsert(change)
    assert {p for p in read if p in [f for own in before.values() for _, f in own]} == {before[bucket][0][1]}
    after = table.state()[2]
    assert {b for b in after if after[b] != before[b]} == {bucket}
    read.clear()
    table.append(change)
    assert read == []
    assert folders(table.read([bucket])) == {f"{keyed.BUCKET}={bucket}"}
    assert table.read().count() == 1000 and table.read().filter("seq = 2").count() == 1
    # Buckets of one folder are read as they are; only the others are reduced.
    plan = table.read()._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan and plan.count("Relation") == 3


def race(monkeypatch, loser, winner):
    """Lets ``winner`` publish just before the first publication of ``loser``."""
    publish, done = keyed._publish, []

    def late(spark, root, version, content):
        if not done:
            done.append(True)
            winner()
        return publish(spark, root, version, content)

    monkeypatch.setattr(keyed, "_publish", late)
    return loser()


def test_of_two_writers_both_are_kept(spark, monkeypatch):
    table = KeyedTable(spark, scratch_path(spark, "k"), ["k"], ["seq"], buckets=2)
    table.upsert(rows(spark, [(i, "a", 1, "v") for i in range(20)]))
    got = race(monkeypatch, lambda: table.upsert(rows(spark, [(1, "l", 3, "loser"), (2, "l", 2, "loser"), (90, "l", 1, "loser")])),
               lambda: table.upsert(rows(spark, [(1, "w", 2, "winner"), (2, "w", 3, "winner"), (91, "w", 1, "winner")])))
    assert got == 3
    held = {r.k: r.v for r in table.read().collect()}
    assert (held[1], held[2], held[90], held[91], len(held)) == ("loser", "winner", "loser", "winner", 22)


def test_rows_added_during_compaction_stay(spark, monkeypatch):
    table = KeyedTable(spark, scratch_path(spark, "k"), ["k"], buckets=1)
    for v in ("a", "b"):
        table.append(rows(spark, [(1, v, 1, v), (ord(v), v, 1, v)]))
    race(monkeypatch, table.compact, lambda: table.append(rows(spark, [(1, "c", 1, "c")])))
    assert [len(own) for own in table.state()[2].values()] == [2]
    assert {r.k: r.v for r in table.read().collect()} == {1: "c", 97: "a", 98: "b"}


def test_columns_are_added_and_types_kept(spark):
    table = KeyedTable(spark, scratch_path(spark, "k"), ["k"], buckets=2)
    table.append(rows(spark, [(1, "a", 1, "v"), (2, "a", 1, "v")]))
    table.upsert(spark.createDataFrame([(1, 2.5)], "k long, more double"))
    assert found(table.read()) == [(1, None, None, None, 2.5), (2, "a", 1, "v", None)]
    with pytest.raises(ContractError, match="another type.*name"):
        table.append(spark.createDataFrame([(1, 2)], "k long, name long"))
    with pytest.raises(ContractError, match="reserved"):
        table.append(spark.createDataFrame([(1, 2)], "k long, _bucket long"))
    with pytest.raises(ContractError, match="made with"):
        KeyedTable(spark, table.root, ["k"], buckets=3).read()


def test_empty_writes_and_tables(spark):
    table = KeyedTable(spark, scratch_path(spark, "k"), ["k"], buckets=2)
    with pytest.raises(ContractError, match="nothing was written"):
        table.read()
    assert table.upsert(rows(spark, [])) == 0 and table.append(rows(spark, [])) == 0 and table.compact() == 0
    table.append(rows(spark, [(1, "a", 1, "v")]))
    assert table.upsert(rows(spark, [])) == 1 and found(table.read([7])) == []


def test_stored_metrics_and_runs(spark):
    metrics = runs.metric_table(spark, scratch_path(spark, "m"), buckets=2)
    schema = "pipeline_run_id long, layer string, metric_name string, metric_unit string, metric_value double, source_task_id string, sequence long"
    runs.store_metrics(metrics, spark.createDataFrame([(1, " raw", "rows ", "Count", 5.0, "t", 1)], schema))
    runs.store_metrics(metrics, spark.createDataFrame([(1, "RAW", "rows", "count", 6.0, "t", 2)], schema))
    with pytest.raises(ContractError, match="count: 1, layer: 1"):
        runs.store_metrics(metrics, spark.createDataFrame(
            [(1, "RAW", "rows", "count", 6.5, "t", 3), (1, "GOLD", "rows", "count", 6.0, "t", 3)], schema))
    assert [(r.layer, r.metric_name, r.metric_value) for r in metrics.read().collect()] == [("RAW", "rows", 6.0)]
    audit = runs.audit_table(spark, scratch_path(spark, "a"), buckets=2)
    events = spark.createDataFrame([(1, 2, "SUCCESS", "2024-01-02"), (1, 1, "STARTED", "2024-01-01"), (2, 3, "FAILED", None)],
                                   "run_id long, sequence long, status string, at string")
    events = events.select("run_id", "sequence", "status", F.to_timestamp("at").alias("started_at"))
    for sequence in (2, 1, 3):
        audit.append(events.filter(F.col("sequence") == sequence))
    assert found(audit.read()) == found(runs.audit_state(events).select("run_id", "sequence", "status", "started_at"))
