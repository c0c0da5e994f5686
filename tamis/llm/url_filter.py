"""Url filter by empirical-Bayes reputation of hosts, with explicit rules on top.

Labelled outcomes (bad or not) are counted per host. A host's share of bad pages is shrunk towards that of its registered
domain, the domain's towards that of its suffix, and the suffix's towards the overall share: at each level the parent's
posterior mean m and a precision k make the prior Beta(k m, k (1 - m)). k comes from the data, by the moments of the
beta-binomial: with r = 1 / (k + 1), Var(bad) = n m (1 - m) (1 + (n - 1) r).

A host is blocked if the lower bound of its posterior, mean - z * standard deviation, exceeds ``limit``. Hosts without
outcomes inherit their domain's posterior, which is wide, and so are blocked only under a domain that is bad for sure.

Only counts per host travel; the pages meet the table of hosts in one join, in which Spark may split a frequent host.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Suffixes of two labels under which names are registered; any other host has its last label as suffix.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "or.jp", "ne.jp",
                      "com.br", "com.cn", "co.in", "co.kr", "co.nz", "co.za", "com.mx", "com.tr", "com.tw")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case; empty if there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def with_levels(hosts: DataFrame) -> DataFrame:
    """Adds ``labels``, ``domain`` and ``suffix``; a host of one label is its own domain and suffix."""
    labels = F.split("host", r"\.")
    last_two = F.array_join(F.slice("labels", F.greatest(F.size("labels") - 1, F.lit(1)), F.lit(2)), ".")
    long = last_two.isin(*TWO_LABEL_SUFFIXES) & (F.size("labels") > 2)
    kept = F.when(long, F.lit(2)).otherwise(F.lit(1))
    start = F.greatest(F.size("labels") - kept + 1, F.lit(1))
    return hosts.withColumn("labels", labels).withColumns({
        "suffix": F.array_join(F.slice("labels", start, F.lit(2)), "."),
        "domain": F.array_join(F.slice("labels", F.greatest(start - 1, F.lit(1)), F.lit(3)), "."),
    })


def shrink(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Posterior ``mean`` and ``precision`` of every child (``n``, ``bad``) under its parent's mean."""
    prior = parents.select(F.col(key), F.col("mean").alias("prior"))
    joined = children.join(prior, key, "left")
    spread = F.pow(F.col("bad") - F.col("n") * F.col("prior"), 2) / (F.col("prior") * (1 - F.col("prior"))) - F.col("n")
    moments = joined.agg(F.sum(spread).alias("over"), F.sum(F.col("n") * (F.col("n") - 1)).alias("pairs"))
    # Between one and a thousand pages' worth of prior; a thousand where the data show no spread at all.
    r = F.when(F.col("pairs") > 0, F.col("over") / F.col("pairs")).otherwise(F.lit(0.0))
    r = F.least(F.greatest(r, F.lit(1.0 / 1001)), F.lit(0.5))
    strength = moments.select((1 / r - 1).alias("strength"))
    out = joined.crossJoin(F.broadcast(strength))  # one row
    precision = F.col("n") + F.col("strength")
    mean = (F.col("bad") + F.col("strength") * F.col("prior")) / precision
    return out.withColumns({"mean": mean, "precision": precision}).drop("prior", "strength")


def reputation(hosts: DataFrame, outcomes: DataFrame, z: float, limit: float) -> DataFrame:
    """Hosts with ``n, bad, mean, bound, bad_host`` from outcomes (``host``, ``bad`` as 0/1 or null)."""
    counted = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.sum("bad").alias("bad"))
    zero = {"n": 0, "bad": 0}
    hosts = with_levels(hosts.join(counted, "host", "left").na.fill(zero))
    totals = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = hosts.groupBy("domain", "suffix").agg(*totals)
    suffixes = domains.groupBy("suffix").agg(*totals)
    # One page of each kind more than counted keeps the overall share off 0 and 1.
    overall = suffixes.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + 1.0) / (F.coalesce(F.sum("n"), F.lit(0)) + 2.0)).alias("mean"))
    roots = suffixes.select("suffix").crossJoin(F.broadcast(overall))  # one row
    suffixes = shrink(suffixes, roots, "suffix")
    domains = shrink(domains, suffixes, "suffix")
    hosts = shrink(hosts, domains, "domain")
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("precision") + 1))
    hosts = hosts.withColumn("bound", F.col("mean") - F.lit(float(z)) * deviation)
    return hosts.withColumn("bad_host", F.col("bound") > F.lit(float(limit)))


def judge(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] = (), z: float = 1.645,
    limit: float = 0.5, id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, n_labelled, n_bad, bad_share, bound`` for every row of ``pages``.

    ``outcomes`` has ``url`` and ``bad`` (1, 0, or null for not known). ``rules`` are (verdict, host, path): a rule fits
    its host and all subdomains if the path starts with its own; the longest that fits decides, else the reputation.
    Urls that are null or lack ``://`` have an empty host and path and are judged as one host of that name. Repeated
    rows are judged one by one, and null ids stay. An empty table gives no rows; without outcomes nothing is blocked.
    """
    spark = pages.sparkSession
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    hosts = rows.select("host").distinct()
    known = outcomes.select(host_of(F.col("url")).alias("host"), F.col("bad").cast("long").alias("bad"))
    hosts = reputation(hosts, known, z, limit)

    listed = [(h, p, h + p, v) for v, h, p in rules]
    rule_table = spark.createDataFrame(listed, "rule_host string, rule_path string, rule string, verdict string")
    parents = F.transform(
        F.sequence(F.lit(1), F.size("labels")), lambda i: F.array_join(F.slice("labels", i, F.size("labels")), "."))
    named = hosts.select("host", F.explode(parents).alias("rule_host")).join(rule_table, "rule_host")
    # At most one entry per rule, whatever the number of pages.
    named = named.groupBy("host").agg(F.collect_list(F.struct(
        F.length("rule").alias("size"), "rule", "rule_path", "verdict")).alias("rules"))
    hosts = hosts.join(named, "host", "left").select(
        "host", "rules", "bad_host", "bound", F.col("n").alias("n_labelled"), F.col("bad").alias("n_bad"),
        F.col("mean").alias("bad_share"))

    out = rows.join(hosts, "host", "left")
    fitting = F.filter("rules", lambda r: F.col("path").startswith(r["rule_path"]))
    out = out.withColumn("fits", F.array_max(fitting))
    by_method = F.when(F.col("bad_host"), F.lit("block")).otherwise(F.lit("allow"))
    return out.select(
        "page_id", "host", "path", F.col("fits.rule").alias("rule"),
        F.coalesce(F.col("fits.verdict"), by_method).alias("verdict"),
        "n_labelled", "n_bad", F.round("bad_share", 6).alias("bad_share"), F.round("bound", 6).alias("bound"),
    )
