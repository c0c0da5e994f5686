import random
import re

from tamis.llm import decontaminate, licenses

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def plain(text, items, window=10):
    w, hit, found = words(text), set(), set()
    for name, item in items:
        iw = words(item)
        size = min(window, len(iw))
        grams = {tuple(iw[i:i + size]) for i in range(len(iw) - size + 1)} if size else set()
        for i in range(len(w) - size + 1):
            if tuple(w[i:i + size]) in grams:
                hit.update(range(i, i + size))
                found.add(str(name))
    return len(w), len(hit), sorted(found)


def run(spark, docs, items, **options):
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = {}
    for r in decontaminate.find_matches(docs, bench, **options).collect():
        out.setdefault((r.doc_id, r.text), r.found)
    return out


def cases():
    rng = random.Random(4)
    vocabulary = ["a", "b", "c", "d", "é1"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 16)))) for i in range(25)]
    items += [(100, "Zwölf, Boxkämpfer! jagen"), (101, None), (102, "..."), (103, items[3][1])]
    docs = []
    for i in range(60):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        if i % 4 == 0:
            text += words(items[i % 25][1])
        docs.append((i, rng.choice([" ", "-", "\n"]).join(text)))
    return docs + [(60, "x zwölf boxkämpfer JAGEN y"), (61, None), (62, "")], items


def test_matches_brute_force(spark, make):
    docs, items = cases()
    for options in ({}, {"block_bytes": 150}):
        got = run(spark, make(docs), items, **options)
        for i, text in docs:
            f = got[i, text]
            assert (f.n_words, sum(h.last - h.first for h in f.hits), f.items) == plain(text, items), (i, options)


def test_longest_match_and_place(spark, make):
    item = " ".join(f"w{i}" for i in range(30))
    doc = "x y z " + " ".join(f"w{i}" for i in range(5, 27)) + " tail"
    f = run(spark, make([(1, doc)]), [(7, item)])[1, doc]
    best = f.longest[0]
    assert (best.item_id, best.item_word, best.doc_word, best.n_words) == ("7", 5, 3, 22)


def test_words_end_with_their_text(spark, make):
    docs = [(1, "one two"), (2, "three four"), (3, "one two three four")]
    got = run(spark, make(docs).coalesce(1), [(1, "two three")])
    assert [got[d].items for d in docs] == [[], [], ["1"]]


def test_removal_keeps_columns(spark, make):
    docs = make([(1, "clean words only"), (2, "has the secret item text inside")])
    kept = decontaminate.without_matches(docs, spark.createDataFrame([(1, "the secret item text")], "item_id long, text string"))
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]


def test_odd_rows(spark, odd, none):
    items = [(1, "same text here")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_matches(odd, bench).collect()
    assert len(got) == odd.count()
    assert {r.doc_id for r in got if r.found.hits} == {4, 5} and sum(bool(r.found.hits) for r in got) == 3
    assert decontaminate.find_matches(none, bench).collect() == []
    assert all(r.found.hits == [] for r in decontaminate.find_matches(odd, bench.limit(0)).collect())


def shingles(text):
    w = words(text)
    return [" ".join(w[i:i + 5]) for i in range(len(w) - 4)]


def test_license_scan_matches_brute_force(spark, small, rows):
    got = licenses.find_licenses(spark.read.parquet(f"{small}/documents.parquet")).collect()
    known = {n: set(shingles(t)) for n, t in licenses.TEMPLATES.items()}
    texts = dict(rows)
    for r in got:
        s = shingles(texts[r.doc_id])
        expected = sorted(n for n, t in known.items() if t & set(s) and max(
            len(set(s[i:i + len(t) + len(t) // 4 + 1]) & t) / len(t) for i in range(len(s))) >= 0.8)
        assert sorted(x.license for x in r.licenses) == expected


def test_edited_license_is_found(make):
    text = licenses.TEMPLATES["MIT"].split()
    text[20:22] = ["of", "that"]
    filler = " ".join(f"f{i}" for i in range(777))
    docs = make([(1, f"{filler} {' '.join(text)} {filler}"), (2, " ".join(text[:30])), (3, "MIT"), (4, None)])
    got = {r.doc_id: [x.license for x in r.licenses] for r in licenses.find_licenses(docs).collect()}
    assert got == {1: ["MIT"], 2: [], 3: [], 4: []}
    found = licenses.find_licenses(docs).filter("doc_id = 1").first().licenses[0]
    assert found.first_word == 777 and 0.8 <= found.containment < 1


def test_license_odd_rows(odd, none):
    assert licenses.find_licenses(odd).count() == odd.count()
    assert licenses.find_licenses(none).collect() == []
    assert all(r.licenses == [] for r in licenses.find_licenses(odd, {}).collect())
    assert licenses.bands_for(0.8, 0.9999) == 27
