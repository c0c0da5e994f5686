"""The Jaccard join against all pairs that have a shingle in common."""

import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from tamis.llm import jaccard_join, queries, set_groups


def plain_shingles(text, words=5):
    tokens = (text or "").encode().lower().split()
    return {tuple(tokens[i:i + words]) for i in range(max(1, len(tokens) - words + 1))} if tokens else set()


def plain_join(rows, words=5, least=Fraction(4, 5)):
    """(size, smallest linked key) of every key of (key, text)."""
    sets, root, holders = {i: plain_shingles(t, words) for i, t in rows}, {i: i for i, _ in rows}, {}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sorted(sets):
        for k, n in Counter(k for gram in sets[i] for k in holders.get(gram, ())).items():
            if n >= least * (len(sets[i]) + len(sets[k]) - n):
                low, high = sorted((top(i), top(k)))
                root[high] = low
        for gram in sets[i]:
            holders.setdefault(gram, []).append(i)
    return {i: (len(sets[i]), top(i)) for i in sets}


def joined(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_matches_all_pairs(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert joined(queries.op13_jaccard_join(spark, folder)) == plain_join(rows)


def copies(seed, many):
    """Chains of near copies, pairs just below and at the limit, and frequent passages in unlike texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    base = [" ".join(rng.choices(words, k=rng.choice([3, 8, 30, 90]))) for _ in range(many)]
    rows = []
    for text in base:
        rows.append(text)
        for _ in range(rng.choice([0, 0, 1, 4])):
            tokens = text.split()
            for _ in range(rng.choice([0, 1, 2, 3])):
                at = rng.randrange(len(tokens))
                tokens[at:at + rng.choice([0, 1])] = [rng.choice(words)]
            text = " ".join(tokens)
            rows.append(text)
    passage = " ".join(rng.choices(words, k=25))
    rows += [f"{' '.join(rng.choices(words, k=rng.choice([2, 4, 40])))} {passage}" for _ in range(many)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed,members,frequent,side", [(1, 64, 64, 1024), (2, 2, 1, 1024), (4, 1, 2, 8)])
def test_links_between_groups(make, monkeypatch, seed, members, frequent, side):
    monkeypatch.setattr(jaccard_join, "SIDE", side)
    monkeypatch.setattr(jaccard_join, "grouped", lambda rows, *near: set_groups.grouped(rows, *near, members=members))
    rows = copies(seed, 60)
    assert joined(jaccard_join.similar(make(rows), frequent=frequent)) == plain_join(rows)


def test_other_share_and_width(make):
    rows = copies(3, 25)
    assert joined(jaccard_join.similar(make(rows), words=2, least=0.6)) == plain_join(rows, 2, Fraction(3, 5))


def test_odd_rows(odd, none):
    got = jaccard_join.similar(odd).collect()
    assert len(got) == odd.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.n_shingles, r.component_id))
    assert by[1] == {(0, 1)} and by[2] == {(0, 2)} and by[3] == {(0, 3)} and by[7] == {(1, 7)} and by[-3] == {(1, -3)}
    assert by[5] == {(1, 4)} and by[4] == {(1, 4), (3, 4)} or by[4] == {(1, 4), (2, 4)}
    assert by[None] == {(1, None), (0, None)}
    assert jaccard_join.similar(none).collect() == []


def test_cells_of_the_same_members_are_taken_once(spark):
    cells = [(1, 10), (1, 11), (2, 11), (2, 10), (3, 10), (3, 11), (3, 12), (4, 13), (5, 10), (5, 12)]
    got = jaccard_join.distinct_cells(spark.createDataFrame(cells, "cell long, node long")).collect()
    by = {}
    for r in got:
        by.setdefault(r.cell, set()).add(r.node)
    assert by == {1: {10, 11}, 3: {10, 11, 12}, 5: {10, 12}}


def test_links_of_texts_are_those_of_sets(spark):
    rows = copies(5, 20)
    texts = spark.createDataFrame(rows, "id long, text string")
    cells = spark.createDataFrame([(i % 7, i) for i, _ in rows] + [(10 + i % 3, i) for i, _ in rows], "cell long, node long")
    sets = set_groups.sets_of(texts, cells, 5, True)
    links = [sorted((r.a, r.b) for r in found.collect()) for found in (
        set_groups.links_inside(cells, sets, Fraction(4, 5)), set_groups.links_of_texts(cells, texts, 5, True, Fraction(4, 5)),
        set_groups.links_of_texts(cells, texts.unionByName(texts), 5, False, Fraction(4, 5)))]
    assert links[0] and links[0] == links[1] == links[2]


def test_sets_of_a_batch():
    rng = random.Random(6)
    texts = ["".join(rng.choice("aB \n\té\x0b") for _ in range(rng.randint(0, 40))) for _ in range(300)] + ["", " ", "A a"]
    found, offsets = set_groups.shingle_sets(pa.array(texts, pa.large_string()), 3)
    known = {}
    for text, a, b in zip(texts, offsets[:-1], offsets[1:]):
        own = plain_shingles(text, 3)
        assert b - a == len(own) and known.setdefault(frozenset(own), found[a:b].tolist()) == found[a:b].tolist()


def test_repeated_tokens_across_batches():
    rng = random.Random(7)
    t = sorted(rng.choices(range(40), k=60))
    cuts = sorted(rng.sample(range(60), 12))
    rows = pa.record_batch({"t": pa.array(t, pa.int64()), "id": pa.array(range(60), pa.int64())})
    parts = [rows.slice(a, b - a) for a, b in zip([0, *cuts], [*cuts, 60])]
    got = [i for batch in jaccard_join.repeated(iter(parts)) for i in batch.column("id").to_pylist()]
    assert got == [i for i in range(60) if t.count(t[i]) > 1]


def test_closed_groups_and_open_ones():
    own = np.arange(10, dtype=np.uint64)
    group = lambda node, *sets: ([node + k for k in range(len(sets))], np.array([len(s) for s in sets]), np.unique(np.concatenate(sets)),
                                 np.searchsorted(np.unique(np.concatenate(sets)), np.concatenate(sets)))
    assert set_groups.between(group(1, own), group(50, own[1:], own[:3]), Fraction(4, 5)) == [(1, 50)]
    assert set_groups.between(group(1, own), group(50, own[:5], own[5:]), Fraction(4, 5)) == []


@pytest.mark.parametrize("most", [15, 26])
def test_map_of_ids_loses_none(spark, most):
    rows = spark.range(0, 200000, 1, 4).selectExpr("id", "cast(id as string) as text")
    ids = spark.range(0, 200000, 7)
    left = {r.id for r in set_groups.marked_rows(rows, ids, most).collect()}
    assert left >= {r.id for r in ids.collect()} and (len(left) < 45000 or most == 15)
    assert set_groups.marked_rows(rows, ids.limit(0)).collect() == []


def test_signatures_lose_no_link():
    rng = random.Random(9)
    share = Fraction(4, 5)
    closed = 0
    for _ in range(300):
        base = np.array(rng.sample(range(1 << 62), 60), np.uint64)
        groups = []
        for _ in range(2):
            sets = [np.unique(np.concatenate([base[:rng.randint(20, 60)], np.array(rng.sample(range(1 << 62), rng.randint(0, 20)), np.uint64)]))
                    for _ in range(rng.randint(1, 3))]
            groups.append(sets)
        linked = any(len(np.intersect1d(a, b)) >= share * len(np.union1d(a, b)) for a in groups[0] for b in groups[1])
        may = set_groups.may_link(*(([len(s) for s in sets], [set_groups.signature(s) for s in sets]) for sets in groups), share)
        assert may or not linked
        closed += not may
    assert closed > 50
