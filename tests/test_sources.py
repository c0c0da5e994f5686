from concurrent.futures import ThreadPoolExecutor
from threading import Lock

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tamis.operators import marts
from tamis.operators.checks import ContractError
from tamis.plans import catalogue, tables
from tamis.session import scratch_path
from tamis.sources import files, lake, runs, snapshot


def write(tmp_path, name, text):
    target = tmp_path / name
    target.write_text(text, encoding="utf-8")
    return str(target)


def test_json_batch_keeps_records_as_they_are(spark, tmp_path):
    path = write(tmp_path, "b.json", '[\n  {"id": "é", "z": 1, "a": {"b": [1, null]}},\n  {"id": "2"}\n]\n')
    got = [(r.position, r.record) for r in files.read_json_batch(spark, path).collect()]
    assert got == [(0, '{"id":"é","z":1,"a":{"b":[1,null]}}'), (1, '{"id":"2"}')]


@pytest.mark.parametrize("text", ['{"id": "1"}', '[{"id": "1"}', '[{"id": "1"}][{"id": "2"}]', "[{]"])
def test_bad_batches_fail(spark, tmp_path, text):
    path = write(tmp_path, "b.json", text)
    # Spark hands some failures of the JSON parser over unconverted.
    with pytest.raises((PySparkException, Py4JJavaError)):
        files.read_json_batch(spark, path).collect()


def test_json_lines(spark, tmp_path):
    path = write(tmp_path, "b.jsonl", '{"id": "1"}\n\n{"id": "2"}\n')
    records = files.read_json_batch(spark, path, lines=True)
    assert records.count() == 2
    checks = {r.controle: r.violations for r in files.batch_checks(records, spark.createDataFrame([(3,)], "nombre_declare long")).collect()}
    assert checks == {"lot_vide": 0, "ecart_nombre_declare": 1}
    bad = write(tmp_path, "bad.jsonl", '{"id": "1"} x\n')
    with pytest.raises(PySparkException):
        files.read_json_batch(spark, bad, lines=True).collect()


def test_csv_codes_stay_text(spark, tmp_path):
    path = write(tmp_path, "d.csv", "DEP,REG,LIBELLE\n01,84,Ain\n2A,94,Corse-du-Sud\n")
    assert [r.DEP for r in files.read_csv(spark, path, ["DEP", "REG"]).collect()] == ["01", "2A"]
    with pytest.raises(ContractError, match="NOM"):
        files.read_csv(spark, path, ["NOM"])


CONTRACT = {"layer": "silver", "batch_id": "b", "processing_run_id": "r", "schema_version": "2.0.0", "parent": "p"}


def test_write_once_reuses_and_refuses(spark):
    root, df = scratch_path(spark, "once"), spark.range(10)
    assert lake.write_once(df, root, CONTRACT, "id")[0] == lake.CREATED
    outcome, stored = lake.write_once(spark.range(99), root, CONTRACT, "id")
    assert (outcome, stored.count()) == (lake.REUSED, 10)
    with pytest.raises(ContractError, match="parent"):
        lake.write_once(df, root, {**CONTRACT, "parent": "q"}, "id")
    spark.range(1).write.mode("append").parquet(lake.artefact_path(root, CONTRACT))
    with pytest.raises(ContractError, match="row_count"):
        lake.write_once(df, root, CONTRACT, "id")


def load(spark, n, run):
    return spark.range(n).withColumns({"batch_id": F.lit("b"), "processing_run_id": F.lit(run),
                                       "silver_schema_version": F.lit("2.0.0")})


def test_snapshot_keeps_the_old_version_when_a_load_is_bad(spark):
    root = scratch_path(spark, "snap")
    assert snapshot.current(spark, root) is None
    snapshot.replace(load(spark, 5, "r1"), root, "id")
    bad = load(spark, 3, "r2").unionByName(load(spark, 3, "r2"))
    with pytest.raises(ContractError, match="cles_dupliquees=3"):
        snapshot.replace(bad, root, "id")
    with pytest.raises(ContractError, match="table_vide"):
        snapshot.replace(load(spark, 0, "r2"), root, "id")
    assert snapshot.current(spark, root).agg(F.max("processing_run_id")).first()[0] == "r1"
    snapshot.replace(load(spark, 7, "r3").withColumn("x", F.lit(1)), root, "id")
    snapshot.replace(load(spark, 8, "r4"), root, "id")
    now = snapshot.current(spark, root)
    assert now.count() == 8 and "x" in now.columns and now.filter("x is not null").count() == 0


def test_partitions_are_pruned(spark):
    path = scratch_path(spark, "lake")
    df = spark.range(100).select("id", F.lit("d1").alias("ingestion_date"),
                                 F.concat(F.lit("b"), F.col("id") % 3).alias("batch_id"), F.lit("r").alias("processing_run_id"))
    lake.write_layer(df, path)
    one = lake.read_layer(spark, path, batch_id="b1")
    assert one.count() == 33
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan


def events(spark, rows):
    return spark.createDataFrame(
        rows, "dag_id string, dag_run_id string, sequence int, kind string, at string, failed_task_id string, "
        "error_message string").withColumn("at", F.to_timestamp("at"))


def test_run_state(spark):
    rows = [("d", "1", 1, "RUNNING", "2024-01-01 10:00:00", None, None),
            ("d", "1", 2, "FAILED", "2024-01-01 10:05:00", "dbt_build", "boom"),
            ("d", "1", 3, "RUNNING", "2024-01-01 11:00:00", None, None),
            ("d", "2", 1, "RUNNING", "2024-01-01 10:00:00", None, None),
            ("d", "2", 2, "SUCCESS", "2024-01-01 10:00:30", None, None),
            ("d", "3", 1, "RUNNING", "2024-01-01 10:00:00", None, None),
            ("d", "3", 2, "FAILED", "2024-01-01 10:01:00", "dbt_build", "boom")]
    got = {r.dag_run_id: r for r in runs.run_state(events(spark, rows)).collect()}
    assert (got["1"].status, str(got["1"].started_at.minute), got["1"].finished_at, got["1"].error_message) == (
        "RUNNING", "0", None, None)
    assert (got["2"].status, got["2"].duration_seconds, got["2"].dbt_status) == ("SUCCESS", 30.0, "SUCCESS")
    assert (got["3"].status, got["3"].dbt_status, got["3"].failed_task_id) == ("FAILED", "FAILED", "dbt_build")


def test_metrics_are_checked_and_replaced(spark):
    rows = [(1, 1, " raw ", "row_count", "Count", 5.0, "t"), (1, 2, "RAW", "row_count", "count", 6.0, "t"),
            (1, 3, "RAW", "x", "count", -1.0, "t"), (1, 4, "RAW", "x", "count", 1.5, "t"),
            (1, 5, "GOLD", "x", "count", 1.0, "t"), (1, 6, "DBT", "ok", "boolean", 2.0, "t"),
            (1, 7, "DBT", "p", "percent", 100.5, "t"), (1, 8, "DBT", "p", "percent", None, "t")]
    df = spark.createDataFrame(rows, "pipeline_run_id int, sequence int, layer string, metric_name string, "
                                     "metric_unit string, metric_value double, source_task_id string")
    assert {r.controle: r.violations for r in runs.metric_checks(df).collect()} == {
        "count": 2, "layer": 1, "boolean": 1, "percent": 1, "metric_value": 1}
    assert [(r.layer, r.metric_value) for r in runs.metric_state(df).collect()] == [("RAW", 6.0)]


def test_lost_manifest_is_written_again(spark, tmp_path):
    contract = {"layer": "l", "batch_id": "b", "processing_run_id": "r", "schema_version": "1", "parent": "p",
                "parent_hash": lake.content_hash(spark.range(3))}
    path = lake.artefact_path(str(tmp_path), contract)
    spark.range(3).write.parquet(path)  # a run that died before its manifest
    outcome, stored = lake.write_once(spark.range(3), str(tmp_path), contract, "id")
    assert outcome == lake.REUSED and stored.count() == 3
    assert lake.write_once(spark.range(3), str(tmp_path), contract, "id")[0] == lake.REUSED
    with pytest.raises(ContractError):
        lake.write_once(spark.range(3), str(tmp_path), contract | {"parent_hash": "other"}, "id")
    assert lake.content_hash(spark.range(3).repartition(3)) == contract["parent_hash"] != lake.content_hash(spark.range(4))


def test_a_load_that_loses_the_race_comes_after_the_winner(spark, tmp_path, monkeypatch):
    root, real, raced = str(tmp_path), snapshot._claim, []
    snapshot.replace(load(spark, 2, "r0"), root, "id")

    def claim(session, path, content):
        if not raced:  # between this load's reading of the log and its own publication
            raced.append(path)
            snapshot.replace(load(spark, 3, "r1").withColumn("x", F.lit(1)), root, "id")
        return real(session, path, content)

    monkeypatch.setattr(snapshot, "_claim", claim)
    mine = snapshot.replace(load(spark, 4, "r2").withColumn("y", F.lit(2)), root, "id")
    now = snapshot.current(spark, root)
    assert snapshot.current_version(spark, root)[0] == 3 and [v for v, _ in snapshot._versions(spark, root)] == [3, 2, 1]
    assert now.agg(F.count("*"), F.count("x"), F.count("y"), F.max("processing_run_id")).first()[:] == (4, 0, 4, "r2")
    assert mine.inputFiles() == now.inputFiles()
    won = spark.read.text(snapshot._number_path(root, 2)).first()["value"]
    assert spark.read.parquet(won).agg(F.count("x"), F.max("processing_run_id")).first()[:] == (3, "r1")


def test_loads_at_the_same_time_all_publish(spark, tmp_path, monkeypatch):
    root, real, one = str(tmp_path), snapshot._claim, Lock()

    def claim(*args):  # a local file system looks and makes in two steps
        with one:
            return real(*args)

    monkeypatch.setattr(snapshot, "_claim", claim)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: snapshot.replace(load(spark, i + 1, f"r{i}"), root, "id"), range(4)))
    assert [v for v, _ in snapshot._versions(spark, root)] == [4, 3, 2, 1]
    paths = {spark.read.text(snapshot._number_path(root, v)).first()["value"] for v in range(1, 5)}
    assert sorted(spark.read.parquet(p).count() for p in paths) == [1, 2, 3, 4]


def test_a_writer_that_died_while_publishing_is_passed_over(spark, tmp_path):
    root = str(tmp_path)
    snapshot.replace(load(spark, 2, "r1"), root, "id")
    snapshot._claim(spark, snapshot._number_path(root, 2), "")
    assert snapshot.current_version(spark, root)[0] == 1
    snapshot.replace(load(spark, 3, "r2"), root, "id")
    assert snapshot.current_version(spark, root)[0] == 3 and snapshot.current(spark, root).count() == 3


def test_few_splits_are_dealt_over_the_cores(spark, tmp_path):
    path = str(tmp_path / "events.parquet")
    spark.range(100).coalesce(1).write.parquet(path)
    before = spark.conf.get(tables.INPUT_PARTITIONS)
    spark.conf.unset(tables.INPUT_PARTITIONS)
    try:
        dealt = tables.spread(spark.read.parquet(path))
        assert dealt.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and dealt.count() == 100
        many = spark.range(100).repartition(100)
        assert tables.spread(many) is many
    finally:
        spark.conf.set(tables.INPUT_PARTITIONS, before)


def test_load_checks_parse_no_record_again(spark, small):
    matrix = catalogue.QUERIES["load_check_matrix"](spark, small)
    plan = matrix._jdf.queryExecution().optimizedPlan().toString()
    assert "parse_json" not in plan.lower() and "parsejson" not in plan.lower() and matrix.count() == 31


def test_stored_states_take_one_shuffle(spark, tmp_path):
    rows = [(str(i % 50), "a" if i % 3 else "b", i % 2 == 0) for i in range(200)] + [(None, "a", True), (None, "a", False)]
    offers = spark.createDataFrame(rows, "id_offre string, famille_metier_data string, f boolean").withColumns({
        **{c: F.lit(1.0) for c in marts.MEANS.values()}, **{c: F.lit("x") for c in marts.LINEAGE.values()}})
    wanted = [marts.Measure("f", F.col("f"))]
    dealt = marts.combine(offers, wanted, pay=False, buckets=marts.buckets_of(spark))
    plan = dealt.states.repartition(marts.buckets_of(spark), "id_offre")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    plain = marts.combine(offers, wanted, pay=False).states.collect()
    kept = marts.store(dealt, str(tmp_path)).states.collect()
    assert sorted(map(str, kept)) == sorted(map(str, plain)) and len(plain) == 101
