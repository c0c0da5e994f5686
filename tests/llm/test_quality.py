import duckdb

from tamis.llm import quality

GOOD = "The house of the king is old and it was built by the people of that town. They came from far away."


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    gold = dict(duckdb.sql("select doc_id, quality from '/root/testdata/sf0.01/labels.parquet'").fetchall())
    scores = {r.doc_id: r.quality_score for r in quality.classify(docs).collect()}
    kept = {i: scores[i] >= quality.THRESHOLD for i in gold}
    clean = [kept[i] for i in gold if gold[i]]
    junk = [not kept[i] for i in gold if not gold[i]]
    assert sum(clean) / len(clean) >= 0.98 and sum(junk) / len(junk) >= 0.85


def test_label_model_recovers_accuracies():
    import numpy as np

    rng = np.random.RandomState(3)
    n = len(quality.LABELLERS)
    truth = rng.rand(20000) < 0.7
    right = np.array([0.95, 0.9, 0.85, 0.8, 0.75, 0.9, 0.8, 0.7])
    counts = {}
    for good in truth:
        code = 0
        for k in range(n):
            speaks, correct = rng.rand() < 0.6, rng.rand() < right[k]
            code += (1 if not speaks else 2 if good == correct else 0) * 3 ** k
        counts[code] = counts.get(code, 0) + 1
    _, accuracy = quality.label_model(counts)
    assert max(abs(a - b) for a, b in zip(accuracy.values(), right)) < 0.05


def test_odd_rows(odd, none):
    got = quality.classify(odd).collect()
    assert len(got) == odd.count() and all(0 <= r.quality_score <= 1 for r in got)
    empty = {r.quality_score for r in got if not (r.text or "").strip()}
    assert len(empty) == 1
    assert quality.classify(none).count() == 0
    assert quality.keep_good(odd).columns == odd.columns


def test_profile_counts_whole_texts():
    assert quality.profile("")["words"] == 0
    assert quality.profile("A A A b")["echo"] == 0.5
    junk = quality.votes_of(quality.pattern("Wher. " * 40))
    assert junk[list(quality.LABELLERS).index("few_echoes")] == 0
    assert 0 not in quality.votes_of(quality.pattern(GOOD))
