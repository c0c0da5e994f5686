import collections
import random

from tamis.llm import mixing


def reshared(sizes, weights, share, most):
    """Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), set(order), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * sizes[s]]
        if not over:
            out.update({s: left * weight[s] / total for s in free})
            break
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            free.discard(s)
    return out


def check(rows, weights=(5, 2, 1), share=1.5, most=2.0):
    sizes, taken, largest = collections.Counter(), collections.Counter(), collections.Counter()
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        assert 0 <= r.taken <= most * r.size and r.taken == r.copies * r.size
    goal = reshared(sizes, weights, share, most)
    for r in rows:
        assert abs(r.target - goal[r.source]) < 1e-6 * max(1, goal[r.source]) and r.source_size == sizes[r.source]
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= largest[s] / 2 + 1e-6


def test_targets_are_met(spark, small):
    check(mixing.mix(spark.read.parquet(f"{small}/documents.parquet")).collect())


def test_one_source_holds_most(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(0, 40), "hot" if i % 3 else f"s{i % 7}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    check(got)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(docs.repartition(5)).collect()))
    other = mixing.mix(docs, seed=18).collect()
    assert sorted(map(tuple, got)) != sorted(map(tuple, other))


def test_weights_and_shares(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for weights, share, most in (((1.0,), 0.5, 1.0), ((9.0, 1.0), 1.0, 3.0), ((3.0, 2.0, 1.0, 7.0), 1.9, 2.0)):
        check(mixing.mix(docs, weights, share, most).collect(), weights, share, most)


def test_inclusion_follows_the_odds(spark):
    """Over many seeds a document is drawn as often as its source's share asks."""
    docs = spark.createDataFrame([(i, "one two three four", "a" if i < 40 else "b") for i in range(80)],
                                 "doc_id long, text string, source string")
    drawn = collections.Counter()
    for seed in range(12):
        for r in mixing.mix(docs, (3.0, 1.0), 0.5, 1.0, seed).collect():
            drawn[r.source] += r.copies
    assert abs(drawn["a"] / (12 * 40) - 0.75) < 0.02 and abs(drawn["b"] / (12 * 40) - 0.25) < 0.02


def test_odd_rows(odd, none, spark):
    got = mixing.mix(odd).collect()
    assert len(got) == odd.count()
    check(got)
    assert mixing.mix(none).collect() == []
    empty = mixing.mix(odd.filter("coalesce(trim(text), '') = ''")).collect()
    assert {r.taken for r in empty} == {0}
    nulls = spark.createDataFrame([(1, "a b", None), (2, "c", "z"), (3, "d e f", None)], "doc_id long, text string, source string")
    check(mixing.mix(nulls).collect())
