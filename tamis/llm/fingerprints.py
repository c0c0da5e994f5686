"""SimHash fingerprints and search within a Hamming radius (built-in functions only).

Terms are pairs of neighbouring words; a term weighs more the longer its words are, since short words are the common
ones. Every term votes with its weight on the 64 bits of its hash. Votes are counted two bits to a long: a term's bits
are spread to the upper and lower half of 32 longs, so that 32 plain sums count all 64 bits and the aggregation stays
hash-based with fixed-width buffers. A bit is set if it has more than half of the weight.

The search deals the bits to ``radius + 3`` blocks. Fingerprints within the radius agree in at least three blocks, so
each choice of three blocks makes a table whose key is those blocks, and a search joins on the key. A pair that agrees
in several tables is taken in the first of them only, and is tested exactly in the join itself.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamis.llm.common import SPACE, text_hash, written

BITS = 64


def signed(x: int) -> Column:
    """Literal with the bits of an unsigned 64-bit number."""
    return F.lit(x - (1 << 64) if x >> 63 else x).cast("long")


def votes(texts: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """``keys`` and ``fp``, the fingerprint as a long; a text without words has none of its bits set."""
    words = F.array_remove(F.split(F.lower(F.col(text_col)), SPACE + "+"), "")
    listed = texts.select(*keys, words.alias("__a"))
    listed = listed.select(*keys, "__a", F.slice("__a", F.lit(2), F.greatest(F.size("__a"), F.lit(1))).alias("__b"))
    terms = listed.select(*keys, F.explode_outer(F.arrays_zip("__a", "__b")).alias("__t"))
    first, second = F.col("__t.__a"), F.col("__t.__b")
    weight = sum(F.least(F.coalesce(F.length(word), F.lit(0)), F.lit(7)) for word in (first, second)).cast("long")
    terms = terms.select(*keys, F.xxhash64(first, second).alias("__h"), weight.alias("__w"))
    ones = signed(0x0000000100000001)
    sums = [F.sum("__w").alias("__total")]
    for j in range(BITS // 2):
        two = F.shiftrightunsigned("__h", 2 * j).bitwiseAND(F.lit(3).cast("long"))
        lanes = two.bitwiseOR(F.shiftleft(two, 31)).bitwiseAND(ones)
        sums.append(F.sum(lanes * F.col("__w")).alias(f"__s{j}"))
    counted = terms.groupBy(*keys).agg(*sums)
    bits = []
    for j in range(BITS // 2):
        low = F.col(f"__s{j}").bitwiseAND(signed(0xFFFFFFFF))
        high = F.shiftrightunsigned(f"__s{j}", 32)
        for at, count in ((2 * j, low), (2 * j + 1, high)):
            bits.append(F.when(count * 2 > F.col("__total"), signed(1 << at)).otherwise(signed(0)))
    return counted.select(*keys, reduce(Column.bitwiseOR, bits).alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` per row, with a null text taken as empty; repeated rows give one row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    return votes(rows.withColumn("__x", text_hash(F.col("__text"))), ["doc_id", "__x"], "__text").drop("__x")


def blocks(count: int) -> list[int]:
    """Masks of ``count`` blocks of nearly equal width."""
    edges = [BITS * k // count for k in range(count + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges[:-1], edges[1:])]


def within(queries: DataFrame, fps: DataFrame, radius: int = 3) -> DataFrame:
    """``query, fp``: all fingerprints of ``fps`` at most ``radius`` bits from each distinct one of ``queries``."""
    parts = blocks(radius + 3)
    kept = [sum(chosen) for chosen in combinations(parts, 3)]

    def keyed(df: DataFrame, name: str) -> DataFrame:
        tables = F.array(*(F.struct(F.lit(t).alias("table"), F.col("fp").bitwiseAND(signed(m)).alias("key"))
                           for t, m in enumerate(kept)))
        return df.select("fp").distinct().select(F.col("fp").alias(name), F.explode(tables).alias("__at")).select(
            name, F.col("__at.table").alias("table"), F.col("__at.key").alias("key"))

    left, right = keyed(queries, "query"), keyed(fps, "fp")
    apart = left["query"].bitwiseXOR(right["fp"])
    # The first table in which the two agree.
    first = F.coalesce(*(F.when(apart.bitwiseAND(signed(m)) == 0, F.lit(t)) for t, m in enumerate(kept)))
    met = (left["table"] == right["table"]) & (left["key"] == right["key"])
    close = (F.bit_count(apart) <= radius) & (first == left["table"])
    # Exploded sides are larger than their statistics say, so neither may be broadcast.
    return left.join(right.hint("merge"), met & close).select("query", "fp")


def near_classes(asked: DataFrame, fps: DataFrame, radius: int = 3) -> DataFrame:
    """``query, query_id, fp, near_id, distance, documents``: what ``within`` finds, by classes of equal fingerprints.

    Both tables have ``doc_id`` and ``fp``. A class goes by its smallest id; ``documents`` counts the rows of the found one.
    A class finds itself at distance 0, so copies are its own members and pairs of them are never listed.
    """
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("near_id"), F.count("*").alias("documents"))
    own = classes.select(F.col("fp").alias("query"), F.col("near_id").alias("query_id"))
    found = within(asked, fps, radius).join(classes, "fp").join(own, "query")
    return found.select("query", "query_id", "fp", "near_id",
                        F.bit_count(F.col("query").bitwiseXOR(F.col("fp"))).alias("distance"), "documents")


def in_order(rows: DataFrame) -> DataFrame:
    """Each key (``o``, ``x``) with the next in ascending order (``next_o``, ``next_x``); the last one leads to the first.

    Keys are sorted by ranges; within a range a window finds the next, and only the first key of each range is needed
    to go on to the following one.
    """
    ranged = rows.select("o", "x").repartitionByRange("o", "x").withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "key-ranges")
    key = F.struct("o", "x")
    heads = ranged.groupBy("part").agg(F.min(key).alias("head"))
    first = heads.agg(F.min("head").alias("first"))  # one row
    after = heads.select("part", F.lead("head").over(W.orderBy("part")).alias("after"))  # one row per range
    out = ranged.withColumn("inside", F.lead(key).over(W.partitionBy("part").orderBy("o", "x")))
    out = out.join(after, "part").crossJoin(F.broadcast(first))
    following = F.coalesce("inside", "after", "first")
    return out.select("o", "x", following["o"].alias("next_o"), following["x"].alias("next_x"))


def edited_fingerprints(
    docs: DataFrame, share: int = 3, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Fingerprints of every text, of its edited form, and of the next document (by descending id; the last one's next
    is the first): ``doc_id, n_chars, edited_sha256, fp, edited_fp, next_fp``.

    The edit replaces the last n_chars // ``share`` code points by the first as many (or all) of the next document. Null
    texts are empty, null ids come last. Rows that repeat id and text are one document to their neighbours and come out
    as often as they went in; rows that share an id alone are ordered by a hash of their texts. An empty table gives no
    rows; a single document is its own next.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    # The complement turns the order around without overflow.
    order = F.coalesce(F.bitwise_not(F.col(id_col).cast("long")), F.lit((1 << 63) - 1))
    texts = docs.select(order.alias("o"), text_hash(text).alias("x"), text.alias("t"))
    keys = docs.select(F.col(id_col).alias("doc_id"), order.alias("o"), text_hash(text).alias("x"),
                       F.length(text).cast("long").alias("n_chars"))
    keys = keys.groupBy("o", "x").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_chars").alias("n_chars"), F.count("*").alias("copies"))
    keys = written(keys, "document-keys")
    if not keys.filter("copies > 1").isEmpty():
        texts = texts.dropDuplicates(["o", "x"])

    pairs = in_order(keys).join(keys.select("o", "x", "n_chars"), ["o", "x"])
    wanted = pairs.select(F.col("next_o").alias("o"), F.col("next_x").alias("x"), F.col("o").alias("to_o"),
                          F.col("x").alias("to_x"), F.floor(F.col("n_chars") / share).cast("int").alias("cut"))
    # A document sends its first code points to the one before it; whole texts are shuffled once.
    heads = texts.join(wanted, ["o", "x"]).select(
        F.col("to_o").alias("o"), F.col("to_x").alias("x"), F.col("o").alias("next_o"), F.col("x").alias("next_x"),
        F.expr("left(t, cut)").alias("head"), "cut")
    edited = texts.join(heads, ["o", "x"]).withColumn(
        "e", F.concat(F.expr("left(t, length(t) - cut)"), F.col("head")))
    carried = ["o", "x", "next_o", "next_x", "edited_sha256"]
    both = edited.withColumn("edited_sha256", F.sha2("e", 256)).select(*carried, F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("t").alias("text")),
        F.struct(F.lit(1).alias("kind"), F.col("e").alias("text")))).alias("v"))
    found = votes(both.select(*carried, "v.kind", "v.text"), [*carried, "kind"], "text")
    found = found.groupBy(*carried).agg(
        F.max(F.when(F.col("kind") == 0, F.col("fp"))).alias("fp"),
        F.max(F.when(F.col("kind") == 1, F.col("fp"))).alias("edited_fp"))
    found = written(found, "fingerprints")
    following = found.select(F.col("o").alias("next_o"), F.col("x").alias("next_x"), F.col("fp").alias("next_fp"))
    out = found.join(following, ["next_o", "next_x"]).join(keys, ["o", "x"])
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return out.select("doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "next_fp")
