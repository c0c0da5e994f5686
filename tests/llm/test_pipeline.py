"""The pipeline against the plain versions of its stages."""

import corpus_pipeline
from test_lines import LONG
from test_matches import plain as plain_matches
from test_near_copies import plain_first

from tamis.llm import quality
from tamis.llm.common import table, written


def stage(spark, name, docs, sf_dir):
    return written(dict(corpus_pipeline.STAGES)[name](spark, docs, sf_dir), "test-stage")


def test_stages_match_brute_force(spark, small):
    docs = table(spark, small, "documents")
    columns = docs.columns
    good = stage(spark, "quality", docs, small)
    scores = quality.classify(docs).select("doc_id", "quality_score").collect()
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in scores if r.quality_score >= quality.THRESHOLD}

    apart = stage(spark, "near_duplicates", good, small)
    rows = sorted((r.doc_id, r.text) for r in good.collect())
    assert sorted(r.doc_id for r in apart.collect()) == plain_first(rows)

    cut = stage(spark, "repeated_passages", apart, small)
    assert cut.columns == columns and all(r.n_chars == len(r.text) for r in cut.collect())

    clean = stage(spark, "decontamination", cut, small)
    items = [(r.item_id, r.text) for r in table(spark, small, "benchmark").collect()]
    assert {r.doc_id for r in clean.collect()} == {
        r.doc_id for r in cut.collect() if not plain_matches(r.text, items)[1]}
    assert good.columns == apart.columns == clean.columns == columns

    drawn = stage(spark, "mixing", clean, small).collect()
    assert {r.doc_id for r in drawn} <= {r.doc_id for r in clean.collect()} and all(r.copies > 0 for r in drawn)
    assert sorted(map(tuple, drawn)) == sorted(map(tuple, corpus_pipeline.run(spark, small).collect()))


def test_decisions_take_effect(spark, make, tmp_path):
    filler = [" ".join(f"the {k}of{i} and to" for i in range(40)) + "." for k in range(6)]
    item = " ".join(f"secret{i}" for i in range(12))
    docs = make([(0, f"{filler[0]}\n{LONG}"), (1, f"{filler[1]}\n{LONG}"), (2, f"{filler[2]} {item}"), (3, filler[3]),
                 (4, filler[3]), (5, filler[4])])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    apart = stage(spark, "near_duplicates", docs, str(tmp_path))
    assert sorted(r.doc_id for r in apart.collect()) == [0, 1, 2, 3, 5] and apart.columns == docs.columns
    cut = stage(spark, "repeated_passages", apart, str(tmp_path))
    assert {r.doc_id: "w29" in r.text for r in cut.collect()} == {0: True, 1: False, 2: False, 3: False, 5: False}
    clean = stage(spark, "decontamination", cut, str(tmp_path))
    assert sorted(r.doc_id for r in clean.collect()) == [0, 1, 3, 5]
    assert stage(spark, "mixing", clean, str(tmp_path)).count() > 0


def test_odd_rows(spark, odd, none, small):
    for docs in (odd, none):
        for name, _ in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = stage(spark, name, docs, small)
            assert name == "mixing" or docs.columns == columns
