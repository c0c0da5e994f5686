import random

import numpy as np
import pyarrow as pa
import pytest

from tamis.llm import suffix_dedup


def plain(texts, length=100):
    """Marks of removed bytes, by looking up every string."""
    seen, out = set(), {}
    for i, text in texts:
        raw = (text or "").encode()
        mark = np.zeros(len(raw), bool)
        for s in range(len(raw) - length + 1):
            string = raw[s:s + length]
            if string in seen:
                mark[s:s + length] = True
            seen.add(string)
        out[i] = mark
    return out


def check(docs, texts, **options):
    length = options.get("length", 100)
    expected = plain(sorted(texts), length)
    got = suffix_dedup.remove_repeats(docs, **options).collect()
    for r in got:
        raw, mark = (r.text or "").encode(), expected[r.doc_id]
        assert r.repeats.n_bytes == len(raw)
        assert r.repeats.kept == bytes(np.frombuffer(raw, np.uint8)[~mark]), r.doc_id
        edges = np.flatnonzero(np.diff(np.concatenate(([0], mark.astype(int), [0]))))
        assert [(s.first, s.last) for s in r.repeats.spans] == list(zip(edges[::2], edges[1::2]))
    assert len(got) == len(texts)


def test_tables_match_brute_force(spark, small, rows):
    check(spark.read.parquet(f"{small}/documents.parquet"), rows)


@pytest.mark.parametrize("batches,crowd", [(1, 99), (2, 2), (7, 99), (4, 5)])
def test_batches_and_levels_agree(make, batches, crowd):
    rng = random.Random(9)
    passages = ["".join(rng.choice("abcdé \n") for _ in range(rng.randint(20, 90))) for _ in range(12)]
    texts = [(i, "".join(rng.choice(passages)[rng.randint(0, 9):] for _ in range(rng.randint(0, 6)))) for i in range(50)]
    texts += [(50, "z" * 500), (51, "ab" * 300), (52, "z" * 99), (53, "z" * 100), (54, None)]
    check(make(texts), texts, length=40, batches=batches, crowd=crowd)


def test_index_merges_equal_levels(spark):
    index = suffix_dedup.Index(spark, 40)
    sizes = []
    for k in range(6):
        index.add(spark.createDataFrame([(k, f"text number {k} " * 20)], "o long, t string"))
        sizes.append([size for size, _ in index.levels])
    assert sizes == [[1], [1, 1], [2, 1], [2, 1, 1], [4, 1], [4, 1, 1]]


def test_last_batch_makes_no_level(spark):
    index = suffix_dedup.Index(spark, 40)
    for k in range(3):
        index.add(spark.createDataFrame([(k, "the same text, all of it, again and again, " * 4)], "o long, t string"), last=k == 2)
    assert [size for size, _ in index.levels] == [1, 1]  # not even merged
    assert {r.o for r in index.found("r").select("o").collect()} >= {1, 2}
    assert index.read(*index.results).filter("o = 2").isEmpty()


def test_texts_are_shuffled_once(spark, tmp_path):
    passage = " ".join(f"w{i}" for i in range(60))
    texts = [(i, f"{'x' * (i % 9)} head {i * i} {passage[i % 50:]} tail {i ** 3}") for i in range(60)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.read.parquet(f"{tmp_path}/docs")
        found = suffix_dedup.remove_repeats(docs)
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("FileScan parquet [doc_id") == 1, plan
        check(docs, texts)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_every_string_has_one_anchor():
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab ") for _ in range(n)) for n in (0, 99, 100, 101, 700, 3, 150)]
    found = suffix_dedup.anchors(pa.array(texts, pa.large_string()), 100)
    covered = sorted((t, s) for t, lo, hi in zip(found["text"], found["lo"], found["hi"]) for s in range(lo, hi + 1))
    assert covered == [(t, s) for t, text in enumerate(texts) for s in range(len(text) - 99)]


def test_sliding_min():
    values = np.array(random.Random(1).choices(range(1000), k=300), np.uint64)
    assert suffix_dedup.sliding_min(values, 7).tolist() == [min(values[i:i + 7]) for i in range(294)]


def test_odd_rows(odd, make, none):
    got = suffix_dedup.remove_repeats(odd, length=20).collect()
    assert len(got) == odd.count()
    by_text = {}
    for r in got:
        by_text.setdefault((r.doc_id, r.text), set()).add(tuple(r.repeats.spans))
    assert all(len(s) == 1 for s in by_text.values())  # repeated rows are one document
    assert by_text[4, "same text here, twice."] == {()} and by_text[5, "same text here, twice."] != {()}
    assert suffix_dedup.remove_repeats(none).collect() == []
    assert suffix_dedup.remove_repeats(make([(1, "short"), (2, None)])).select("repeats.kept").collect()[0][0] is not None
