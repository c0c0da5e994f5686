import hashlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tamis.llm import fingerprints, simhash_dedup
from tamis.llm.components import components


def plain_fingerprint(text, words=3):
    tokens = (text or "").encode().lower().split()
    grams = [b" ".join(tokens[i:i + words]) for i in range(max(1, len(tokens) - words + 1))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(values, radius):
    """Smallest id reachable, by comparing all."""
    ids = sorted(values)
    best = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if bin(values[a] ^ values[b]).count("1") <= radius and best[b] < best[a]:
                    best[a], changed = best[b], True
    return best


def test_groups_match_brute_force(spark, small, rows):
    got = simhash_dedup.near_duplicates(spark.read.parquet(f"{small}/documents.parquet")).collect()
    values = {i: plain_fingerprint(t) for i, t in rows}
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == values
    assert {r.doc_id: r.component_id for r in got} == plain_components(values, 3)


@pytest.mark.parametrize("radius,crowd", [(3, 4096), (3, 3), (5, 4096), (1, 4096), (0, 4096), (2, 2)])
def test_all_links_are_found(spark, radius, crowd):
    rng = np.random.RandomState(radius)
    centres = rng.randint(0, 2**63 - 1, 12, dtype=np.int64).astype(np.uint64) * np.uint64(2)
    values = set()
    for c in centres:
        for _ in range(10):
            v = int(c)
            for bit in rng.choice(64, rng.randint(0, 5), replace=False):
                v ^= 1 << int(bit)
            values.add(v)
    values = sorted(values)
    fps = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    found = simhash_dedup.grouped(simhash_dedup.cells(fps, radius // 2 + 1), radius, crowd)
    edges = found.filter("b is not null")
    crowded = found.filter("b is null").select(F.col("a").alias("fp")).distinct()
    edges = edges.unionByName(simhash_dedup.grouped(simhash_dedup.dealt_anew(crowded, radius), radius, 16 ** radius))
    number = {int(np.uint64(v).view(np.int64)): k for k, v in enumerate(values)}
    linked = {k: {k} for k in number.values()}
    for r in edges.collect():
        assert bin(values[number[r.a]] ^ values[number[r.b]]).count("1") <= radius
        merged = linked[number[r.a]] | linked[number[r.b]]
        for k in merged:
            linked[k] = merged
    assert {k: min(v) for k, v in linked.items()} == plain_components(dict(enumerate(values)), radius)


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(0, 40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    edges = spark.createDataFrame(path + star + [(200, 200), (7, 6)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}}
    assert components(edges.filter("a < 0")).count() == 0


def test_odd_rows(odd, none):
    got = simhash_dedup.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    zero = [r for r in got if r.doc_id in (1, 2, 3)]
    assert {r.fingerprint for r in zero} == {"0" * 16} and {r.component_id for r in zero} == {1}
    assert {r.component_id for r in got if r.doc_id == 5} == {4}
    assert simhash_dedup.near_duplicates(none).collect() == []
    lonely = simhash_dedup.near_duplicates(odd.filter("text = 'no id here'")).first()
    assert lonely.doc_id is None and lonely.component_id is None


def test_long_text_is_read_whole():
    text = " ".join(f"w{i * i % 9973}" for i in range(150_000))
    assert int.from_bytes(simhash_dedup.fingerprint(text.encode()), "big") == plain_fingerprint(text)


def edited(pairs):
    order = sorted(pairs, key=lambda p: -p[0])
    out = {}
    for (i, text), (_, following) in zip(order, order[1:] + order[:1]):
        cut = len(text) // 3
        out[i] = text[:len(text) - cut] + following[:cut]
    return out


def test_native_fingerprints(spark, small, rows):
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(spark.read.parquet(f"{small}/documents.parquet")).collect()}
    texts, changed = dict(rows), edited(rows)
    assert set(got) == set(texts)
    for i, r in got.items():
        assert r.n_chars == len(texts[i])
        assert r.edited_sha256 == hashlib.sha256(changed[i].encode()).hexdigest()
    by_text = {}
    for i, text in texts.items():
        assert by_text.setdefault(text, got[i].fp) == got[i].fp
    order = sorted(texts, reverse=True)
    assert all(got[a].next_fp == got[b].fp for a, b in zip(order, order[1:] + order[:1]))
    near = np.mean([bin((r.fp ^ r.edited_fp) & (2**64 - 1)).count("1") for r in got.values()])
    far = np.mean([bin((r.fp ^ r.next_fp) & (2**64 - 1)).count("1") for r in got.values()])
    assert near < 20 and 28 < far < 36


def test_native_plan_has_no_python(spark, small):
    from tamis.llm import mixing

    docs = spark.read.parquet(f"{small}/documents.parquet")
    for df in (fingerprints.fingerprints(docs), fingerprints.edited_fingerprints(docs), mixing.mix(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_native_odd_rows(make, odd, none):
    got = fingerprints.edited_fingerprints(odd).collect()
    assert len(got) == odd.count() and {r.fp for r in got if r.n_chars == 0} == {0}
    assert fingerprints.edited_fingerprints(none).collect() == []
    one = fingerprints.edited_fingerprints(make([(9, "abcdef")])).collect()[0]
    assert one.fp == one.next_fp and one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()


def test_search_finds_all_within_radius(spark):
    rng = np.random.RandomState(5)
    base = [int(x) for x in rng.randint(0, 2**62, 40, dtype=np.int64)]
    values = sorted({v ^ sum(1 << int(b) for b in rng.choice(63, k, replace=False)) for v in base for k in range(6)})
    fps = spark.createDataFrame([(v,) for v in values + values[:9]], "fp long")
    for radius in (1, 3):
        got = sorted((r["query"], r["fp"]) for r in fingerprints.within(fps, fps, radius).collect())
        assert got == sorted((a, b) for a in values for b in values if bin(a ^ b).count("1") <= radius)


def test_search_counts_copies_and_names_them(spark, make, tmp_path):
    from tamis.llm import queries

    text = " ".join(f"word{i * i % 997} stays" for i in range(200))
    texts = {k: text for k in (20, 21, 22)} | {40: text.upper().replace(" ", "  "), 60: "nothing like the others here", 61: "one more"}
    texts |= {80: text + " end", 81: text + " end"}
    make(list(texts.items())).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op4_fingerprints(spark, str(tmp_path)).collect()}
    bits = {i: int(r.fingerprint, 16) for i, r in got.items()}
    assert bits[20] == bits[40]
    apart = {i: {j: bin(a ^ b).count("1") for j, b in bits.items()} for i, a in bits.items()}
    assert {i: r.n_near for i, r in got.items()} == {
        i: sum(d <= 3 for d in apart[i].values()) - 1 if i % 20 == 0 else None for i in texts}
    assert got[20].n_near >= 3 and got[60].n_near == 0

    rows = fingerprints.fingerprints(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    pairs = {(r.query_id, r.near_id): (r.distance, r.documents) for r in fingerprints.near_classes(rows.filter("doc_id % 20 = 0"), rows).collect()}
    first = {i: min(j for j in texts if bits[j] == bits[i]) for i in texts}
    assert pairs == {(first[i], first[j]): (apart[i][j], sum(bits[k] == bits[j] for k in texts))
                     for i in texts if any(bits[k] == bits[i] and k % 20 == 0 for k in texts) for j in texts if apart[i][j] <= 3}
