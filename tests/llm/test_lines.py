from pyspark.sql import functions as F

from tamis.llm import line_dedup

LONG = "This paragraph is long enough to be a passage. " + " ".join(f"w{i}" for i in range(30)) + "."


def repeats(docs, **options):
    return line_dedup.remove_repeats(docs, **options).select("doc_id", "text", "size", "repeats").collect()


def test_earliest_stays_and_offsets_hold(make):
    texts = {3: f"Ça commence ici.\n{LONG}\nend of three", 1: f"head one\n{LONG}", 2: f"é {LONG}\n\ntail"}
    got = {r.doc_id: r for r in repeats(make(list(texts.items())))}
    assert got[1].repeats.text == texts[1] and got[1].repeats.spans == []
    for i in (2, 3):
        r = got[i].repeats
        assert "w29" not in r.text and r.removed_chars == sum(s.length for s in r.spans)
        left = texts[i]
        for s in reversed(r.spans):
            left = left[:s.start] + left[s.start + s.length:]
        assert left == r.text
    assert got[3].repeats.text.startswith("Ça commence ici.\n") and got[3].repeats.text.endswith("end of three")


def test_passage_inside_a_paragraph(make):
    got = repeats(make([(1, f"One sentence that has more than eight words in it. {LONG}"),
                        (2, f"Some other sentence that has more than eight words too. {LONG} And more to come.")]))
    second = next(r for r in got if r.doc_id == 2)
    assert "w29" not in second.repeats.text and second.repeats.text.startswith("Some other")


def test_every_later_unit_goes(make):
    got = repeats(make([(1, "The end.\nmore"), (2, "The end.\nless")]))
    assert [r.repeats.text for r in sorted(got, key=lambda r: r.doc_id)] == ["The end.\nmore", "less"]
    got = repeats(make([(1, "The end.\nmore"), (2, "The end.\nless")]), min_words=30)
    assert all(r.repeats.spans == [] for r in got)


def test_no_unit_is_left_twice(spark, small, rows):
    left = line_dedup.remove_repeats(spark.read.parquet(f"{small}/documents.parquet")).select("doc_id", "repeats.spans", "text")
    seen, spans = set(), {r.doc_id: {(s.start, s.length) for s in r.spans} for r in left.collect()}
    for i, text in rows:
        gone, expected = [], []
        for start, end, words in line_dedup.units(text.encode()):
            key = b" ".join(words).lower()
            if words and key in seen:
                gone.append((len(text.encode()[:start].decode()), len(text.encode()[:end].decode())))
            seen.add(key)
        for start, end in gone:
            if expected and sum(expected[-1]) == start:
                expected[-1] = (expected[-1][0], end - expected[-1][0])
            else:
                expected.append((start, end - start))
        assert spans[i] == set(expected)


def test_normalised_and_within_a_document(make):
    got = repeats(make([(1, f"{LONG}\n{LONG.upper().replace(' ', '  ')}\nend")]))[0]
    assert got.repeats.text == f"{LONG}\nend"


def test_odd_rows(odd, none):
    got = line_dedup.remove_repeats(odd).select("doc_id", "text", "repeats.*").collect()
    assert len(got) == odd.count()
    assert repeats(none) == []
    nulls = line_dedup.remove_repeats(odd.filter("doc_id = 1")).select("repeats.text").first()
    assert nulls.text is None
    same = line_dedup.remove_repeats(odd.filter("doc_id = 4"), min_words=1).filter("text like 'same%'")
    assert [r.n for r in same.select(F.size("repeats.spans").alias("n")).collect()] == [0, 0]


def test_whole_lines_of_any_length(spark, make):
    texts = {1: "Share this page\nA first text of its own. Yes it is.\nAll rights reserved. See the terms.\n",
             2: "Something else here.\nshare  this page\nAll rights reserved. See the terms.\nAnd more. Yes it is. So we say.",
             3: "See the terms.\nYes it is. No more than that."}
    got = {r.doc_id: r.repeats for r in repeats(make(list(texts.items())), min_words=15, whole_lines=True)}
    assert got[1].spans == [] and got[1].text == texts[1]
    assert got[2].text == "Something else here.\nAnd more. Yes it is. So we say." and len(got[2].spans) == 1
    assert got[3].text == "Yes it is. No more than that."
    for i, r in got.items():
        left = texts[i]
        for s in reversed(r.spans):
            left = left[:s.start] + left[s.start + s.length:]
        assert left == r.text and r.removed_chars == len(texts[i]) - len(left)
    import corpus_pipeline

    kept = {r.doc_id: r.text for r in corpus_pipeline.cut_repeats(spark, make(list(texts.items())), "").collect()}
    assert kept == {i: r.text for i, r in got.items()}


def test_texts_are_cut_once(spark, small):
    import corpus_pipeline

    cut = corpus_pipeline.cut_repeats(spark, spark.read.parquet(f"{small}/documents.parquet"), small)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1, plan


def test_whole_lines_before_blanks_and_carriage_returns(make):
    got = {r.doc_id: r.repeats.text for r in repeats(make([
        (1, "All rights are reserved.\r\nOne text here.\r\n"), (2, "Two texts here. \nAll rights are reserved. \nThree more.")]),
        min_words=15, whole_lines=True)}
    assert got[1].startswith("All rights are reserved.") and got[2].split() == "Two texts here. Three more.".split()
