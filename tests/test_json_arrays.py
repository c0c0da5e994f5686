"""Array files read by byte ranges against the whole file."""

import datetime as dt
import json
import random

import pytest
from pyspark.errors import PySparkException

from tamis.plans import catalogue
from tamis.sources import files


def write(path, text):
    path.write_text(text, encoding="utf-8", newline="")
    return str(path)


def records(count, seed=1):
    rng = random.Random(seed)
    odd = ['a "quoted" [text] {here}', "comma, and ] end", "back\\slash \\\" \\", "é x", "", "line\nbreak\ttab"]
    return [{"id": i, "text": rng.choice(odd), "list": [[], {}, rng.choice(odd), [1, [2, {"k": "]"}]]][: rng.randint(0, 4)],
             "nested": {"a": {"b": rng.choice(odd)}}, "empty": {}, "n": rng.choice([None, True, 1.5])} for i in range(count)]


def read(spark, path):
    rows = files.read_json_array(spark, path).collect()
    return {(r.fichier.rsplit("/", 1)[1], r.position): json.loads(r.record) for r in rows}


@pytest.fixture
def ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("layout", ["indent", "line", "mixed", "single", "leading"])
def test_split_equals_whole(spark, tmp_path, ranges, layout):
    data = records(200)
    text = {"indent": json.dumps(data, indent=2), "line": "[" + ",\n".join(map(json.dumps, data)) + "]\n",
            "mixed": "\n [" + "}, {".join(json.dumps(d, indent=1)[1:-1] for d in data).join(["{", "}"]) + "\r\n]\n\n",
            "single": json.dumps(data), "leading": "[" + "\n,".join(map(json.dumps, data)) + "\n]"}[layout]
    write(tmp_path / "one.json", text)
    write(tmp_path / "two.json", json.dumps(["x", 1, None, [], [3, 4], {"a": []}], indent=2, ensure_ascii=False))
    got = read(spark, str(tmp_path))
    assert {k: v for (f, k), v in got.items() if f == "one.json"} == dict(enumerate(data))
    assert {k: v for (f, k), v in got.items() if f == "two.json"} == dict(enumerate(["x", 1, None, [], [3, 4], {"a": []}]))
    if layout != "single":
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 4


def test_same_records_as_the_whole_text_reader(spark, tmp_path, ranges):
    path = write(tmp_path / "a.json", json.dumps(records(80, 3), indent=2))
    whole = files.read_json_batch(spark, path)
    split = files.read_json_array(spark, path)
    canonical = "position", "to_json(parse_json(record)) as record"
    assert sorted(whole.selectExpr(*canonical).collect()) == sorted(split.selectExpr(*canonical).collect())


def test_empty_lists(spark, tmp_path):
    for k, text in enumerate(["[]", " [ \n ] ", "[\n\n]\n"]):
        assert read(spark, write(tmp_path / f"{k}.json", text)) == {}


@pytest.mark.parametrize("text", ['{"a": 1}', "[1, 2", "[1, 2]]", "[1] x", "x [1]", "[1, , 2]", "[1, 2,]", '["a\nb"]', "[{]}", '["a]', "", "1"])
def test_bad_files_fail(spark, tmp_path, text):
    path = write(tmp_path / "bad.json", text)
    if not text:
        assert read(spark, path) == {}  # no lines at all
        return
    with pytest.raises(PySparkException):
        read(spark, path)


@pytest.fixture
def sorted_joins(spark):
    """As on large tables: no broadcast, and shuffles of several partitions that are merged by size."""
    own = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
           "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
           "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["scan_json_batch", "scan_json_array_split"])
def test_derived_batches_are_one_file_each(spark, tmp_path, sorted_joins, name):
    rows = [(i, dt.datetime(2024, 1, 1), i % 7, "view", 1.0, "{}") for i in range(0, 60_000, 20)]
    rows += [rows[0], rows[250], rows[-1], (None, dt.datetime(2024, 1, 1), 1, "view", 1.0, "{}")]  # repeated ends of batches
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(
        str(tmp_path / "events.parquet"))
    found = catalogue.QUERIES[name](spark, str(tmp_path)).collect()
    assert sorted(int(r.id) for r in found) == sorted(r[0] for r in rows if r[0] is not None)
