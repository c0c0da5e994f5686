"""Near copies against all pairs of shingle sets."""

from fractions import Fraction

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_matches import plain as plain_matches

from tamis.llm import near_copies, set_groups
from tamis.llm.common import written


def plain_shingles(text, words=5):
    tokens = (text or "").encode().lower().split()
    return {tuple(tokens[i:i + words]) for i in range(max(1, len(tokens) - words + 1))} if tokens else set()


def plain_first(rows, least=Fraction(4, 5)):
    """Smallest ids of the groups of linked rows, by comparing all that have a shingle in common."""
    sets, root, holders = {i: plain_shingles(t) for i, t in rows}, {i: i for i, _ in rows}, {}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, own in sets.items():
        for gram in own:
            holders.setdefault(gram, []).append(i)
    pairs = {(a, b) for held in holders.values() for b in held for a in held if a < b}
    empty = [i for i, own in sets.items() if not own]
    for a, b in [*pairs, *zip(empty, empty[1:])]:
        if len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
            low, high = sorted((top(a), top(b)))
            root[high] = low
    return sorted(i for i in root if root[i] == i)


def changed(words, places):
    return " ".join(f"other{i}" if i in places else w for i, w in enumerate(words))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_groups_match_all_pairs(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    assert sorted(r.id for r in near_copies.first_of_copies(docs).collect()) == plain_first(rows)


def test_stage_looks_at_shingles(spark, make, small):
    words = [f"w{i * i % 9973}" for i in range(300)]
    texts = [(k * 100 + j, " ".join(f"{w}of{k}" for w in changed(words, places).split()))
             for k in range(20) for j, places in enumerate(((), (50, 120, 200), (3, 40, 90, 160, 230, 280, 20, 60, 110, 140)))]
    kept = sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, make(texts), small).collect())
    assert kept == plain_first(texts) == sorted(k * 100 + j for k in range(20) for j in (0, 2))


def test_pairs_without_a_common_band(spark, make, small):
    """Texts with 40 of 50 shingles in common whose MinHash bands all differ are linked like others."""
    texts = []
    for k in (2453, 4550, 1):  # the last one shares a band
        words = [f"w{i}of{k}" for i in range(49)]
        texts += [(2 * k, " ".join(words)), (2 * k + 1, " ".join([*words[:24], f"other{k}", *words[25:]]))]
    keys = near_copies.band_keys(*set_groups.shingle_sets(pa.array([t for _, t in texts])))
    assert [bool((keys[j] == keys[j + 1]).any()) for j in (0, 2, 4)] == [False, False, True]
    kept = corpus_pipeline.drop_near_duplicates(spark, make(texts), small)
    assert sorted(r.doc_id for r in kept.collect()) == plain_first(texts) == [2, 4906, 9100]


def test_large_cells_and_chains():
    rng = np.random.RandomState(1)
    base = np.unique(rng.randint(0, 2**62, 200, dtype=np.int64).astype(np.uint64))
    sets = [np.unique(np.concatenate([base[4 * k:], rng.randint(0, 2**62, 4 * k, dtype=np.int64).astype(np.uint64)]))
            for k in range(30)]
    sets.append(np.unique(rng.randint(0, 2**62, 180, dtype=np.int64).astype(np.uint64)))
    rows = pa.record_batch({"cell": [1] * 31 + [2] * 2, "node": [*range(31), 40, 41],
                            "found": [s.tobytes() for s in [*sets, sets[30], sets[30]]]})
    got = [p for b in set_groups.links(Fraction(4, 5))(iter([rows.slice(0, 7), rows.slice(7)]))
           for p in zip(b["a"].to_pylist(), b["b"].to_pylist())]
    share = lambda a, b: len(np.intersect1d(sets[a], sets[b])) / len(np.union1d(sets[a], sets[b]))
    assert (40, 41) in got
    assert all(share(a, b) >= 0.8 for a, b in got if b < 40) and all(30 not in p for p in got)
    linked = {0}
    for a, b in sorted(got):
        linked |= {a, b} if linked & {a, b} else set()
    assert {k for k in range(30) if any(share(k, j) >= 0.8 for j in range(30) if j != k)} <= linked | {40, 41}


@pytest.mark.parametrize("members", [2, 3])
def test_cells_of_several_groups(make, monkeypatch, members):
    """Two clusters in the same cells: what is not linked along the chain of groups is found between groups."""
    monkeypatch.setattr(near_copies, "grouped", lambda rows: set_groups.grouped(rows, members=members))
    rng = np.random.RandomState(2)
    words = [f"w{i}" for i in range(200)]
    texts = [(k, " ".join(changed(words, set(rng.choice(200, 2, replace=False).tolist())).split() + [f"x{k}"] * (k % 3))) for k in range(24)]
    assert sorted(r.id for r in near_copies.first_of_copies(make(texts)).collect()) == plain_first(texts)


def test_traffic_follows_the_input(spark, make, monkeypatch):
    """A group of near copies sends its sets about once, however many bands its members share."""
    sent = []
    monkeypatch.setattr(near_copies, "links_inside", lambda groups, sets, least: (
        sent.append(groups.count()), set_groups.links_inside(groups, sets, least))[1])
    words = [f"w{i * i % 9973}" for i in range(400)]
    texts = [(k, " ".join(changed(words, {k, 399 - k}).split())) for k in range(40)]
    assert sorted(r.id for r in near_copies.first_of_copies(make(texts)).collect()) == plain_first(texts) == [0]
    assert sum(sent) <= 5 * len(texts)  # of 20 bands


@pytest.mark.parametrize("members", [3, 64])
def test_links_between_groups_follow_components(make, monkeypatch, members):
    """Near copies and some less similar texts in the same cells: pairs of groups send no links of texts that are linked."""
    plain, sent = set_groups.grouped, []
    monkeypatch.setattr(near_copies, "grouped", lambda rows: plain(rows, members=3))
    monkeypatch.setattr(set_groups, "grouped", lambda rows, *near: plain(rows, *near, members=members))
    monkeypatch.setattr(near_copies, "links_between", lambda *given: (
        links := written(set_groups.links_between(*given), "test-links"), sent.append((given[0].count(), links.count())))[0])
    words = [f"w{i * i % 9973}" for i in range(300)]
    texts = [(k, " ".join([*words, f"one{k}"])) for k in range(60)]
    texts += [(100 + k, " ".join(f"more{k}of{i}" if i % 33 == 5 + 3 * k else w for i, w in enumerate(words))) for k in range(9)]
    assert sorted(r.id for r in near_copies.first_of_copies(make(texts)).collect()) == plain_first(texts) == [0, *range(100, 109)]
    (pairs, links), = sent
    assert 0 < pairs and links <= 5


def test_links_between_components():
    """A link is a pair of components, found once in a pair of groups, also by a group and itself."""
    own = np.arange(20, dtype=np.uint64)
    sets = [own, own[1:], own[5:], own[6:]]
    group = lambda names, sets: (names, np.array([len(s) for s in sets]), np.unique(np.concatenate(sets)),
                                 np.searchsorted(np.unique(np.concatenate(sets)), np.concatenate(sets)))
    least = Fraction(4, 5)
    assert set_groups.between(group([1, 1], sets[:2]), group([1, 1], sets[:2]), least) == []
    assert set_groups.between(group([1, 1], sets[:2]), group([2, 2], sets[:2]), least) == [(1, 2)]
    assert set_groups.between(group([1, 2], sets[:2]), group([1, 2], sets[:2]), least) == [(1, 2)]
    assert set_groups.between(group([1, 3], [sets[0], sets[2]]), group([1, 3], [sets[0], sets[2]]), least) == []
    assert set_groups.between(group([1, 2], [sets[0], sets[3]]), group([2, 4], [sets[3], sets[2]]), least) == [(2, 4)]


def test_texts_that_stay_are_not_shuffled(spark, make, small):
    """Whatever the size of the list of copies: without broadcast joins most texts keep their partition."""
    texts = [(k, " ".join(f"w{i}of{k if k % 10 else 0}" for i in range(30))) for k in range(2000)]
    docs = written(make(texts).repartition(8), "test-texts")
    at = lambda rows: {r.doc_id: r.p for r in rows.select("doc_id", F.spark_partition_id().alias("p")).collect()}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        there, kept = at(docs), at(corpus_pipeline.drop_near_duplicates(spark, docs, small))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(kept) == sorted(k for k in range(2000) if k % 10 or not k)
    assert sum(there[k] == p for k, p in kept.items()) > 0.8 * len(kept)


def test_rows_without(spark):
    rows = spark.range(0, 3000, 1, 4).selectExpr("id as __page", "id as id", "id % 700 as `a.key`", "'x' as map", "id as __GONE")
    ids = spark.range(0, 700, 3)
    got = sorted(tuple(r) for r in set_groups.rows_without(rows, ids, "a.key").collect())
    assert got == sorted(tuple(r) for r in rows.collect() if r["a.key"] % 3)
    assert set_groups.rows_without(rows, ids.limit(0), "a.key").count() == 3000
    assert set_groups.rows_without(rows, spark.range(700), "a.key").collect() == []


def test_odd_rows(odd, none):
    kept = near_copies.first_of_copies(odd.filter("doc_id is not null and doc_id <> 4"))
    assert sorted(r.id for r in kept.collect()) == [-3, 1, 5, 6, 7]
    assert near_copies.first_of_copies(none).collect() == []


def test_all_stages_after_it(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    held = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = held[name] = written(stage(spark, docs, small), "test-stage")
    good = sorted((r.doc_id, r.text) for r in held["quality"].collect())
    assert sorted(r.doc_id for r in held["near_duplicates"].collect()) == plain_first(good)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    cut = held["repeated_passages"].collect()
    assert all(r.n_chars == len(r.text) for r in cut)
    clean = {r.doc_id for r in held["decontamination"].collect()}
    assert clean == {r.doc_id for r in cut if not plain_matches(r.text, items)[1]}
    drawn = held["mixing"].collect()
    assert {r.doc_id for r in drawn} <= clean and all(r.copies > 0 for r in drawn)
