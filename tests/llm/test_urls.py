import math

from tamis.llm import url_filter

RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"))


def judged(spark, urls, outcomes=(), **options):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    known = spark.createDataFrame(list(outcomes), "url string, bad int")
    return {r.page_id: r for r in url_filter.judge(pages, known, **options).collect()}


def test_parts_and_rules(spark):
    urls = ["HTTP://WWW.Example.com/en/a?x#y", "http://a.example.com/en/", "http://example.com/fr", "no scheme", None, "",
            "x://É.COM", "http://notcom", "http://h.com/a://b/c"]
    got = judged(spark, urls, rules=RULES)
    assert (got[0].host, got[0].path, got[0].rule, got[0].verdict) == ("www.example.com", "/en/a", "www.example.com/en/", "allow")
    assert (got[1].rule, got[1].verdict) == ("example.com/en/", "block")
    assert (got[2].rule, got[2].verdict) == ("com/", "allow")
    assert [(got[i].host, got[i].path, got[i].rule) for i in (3, 4, 5)] == [("", "", None)] * 3
    assert (got[6].host, got[6].path, got[6].rule) == ("É.com", "", None)  # an empty path begins with no rule's
    assert got[7].rule is None and got[8].path == "/a://b/c"


def test_reputation_shrinks_towards_parents(spark):
    bad = [(f"http://a{i}.spam.org/x", 1) for i in range(20) for _ in range(5)]
    good = [(f"http://h{i}.fine.net/x", 0) for i in range(20) for _ in range(5)]
    one = [("http://one.mixed.net/", 1)]
    got = judged(spark, ["http://new.spam.org/y", "http://h1.fine.net/y", "http://one.mixed.net/", "http://a0.spam.org/"],
                 bad + good + one, limit=0.5)
    assert [got[i].verdict for i in range(4)] == ["block", "allow", "allow", "block"]
    assert got[0].n_labelled == 0 and got[2].n_bad == 1 and got[2].bad_share < 1
    assert all(g.bound <= g.bad_share for g in got.values())


def test_posterior_of_one_level_is_beta_binomial(spark):
    got = judged(spark, ["http://a.b.c/"], [("http://a.b.c/", 1), ("http://a.b.c/", 0)])[0]
    # One host shows no spread between siblings, so the prior weighs as much as it may: a thousand pages.
    assert got.bad_share == 0.5 and math.isclose(got.bound, 0.5 - 1.645 * math.sqrt(0.25 / (2 + 1000 + 1)), abs_tol=1e-6)


def test_empty_tables(spark):
    assert judged(spark, []) == {}
    assert judged(spark, ["http://a.b/"])[0].verdict == "allow"


def test_levels(spark):
    hosts = spark.createDataFrame([("a.b.co.uk",), ("co.uk",), ("x",), ("",), ("a.b.c",)], "host string")
    got = {r.host: (r.domain, r.suffix) for r in url_filter.with_levels(hosts).collect()}
    assert got == {"a.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "uk"), "x": ("x", "x"), "": ("", ""), "a.b.c": ("b.c", "c")}
