"""Exact similarity join of word shingle sets by a token-group matrix.

Texts with equal sets are one class. Classes are dealt to groups of similar sets: neighbours by their smallest hashes, cut
into bounded groups, and linked inside. The matrix says which token occurs in which group, as the union of its members. A
group is opened for the sets of another one only if the bounds on their overlap allow a link: by the matrix, then by bit maps
of the unions. Then the sets are compared by all tokens.

Of a set with n tokens only a prefix enters the matrix. All sets are ordered alike, frequent tokens last. A link needs
ceil(share * n) tokens in common, so among the first n - ceil(share * n) + l tokens of both sets there must be l common
ones, with l a tenth of n. Two groups that have fewer prefix tokens in common, or no members of fitting sizes, stay closed.
Tokens that occur in only one set, or only in sets already linked to each other, cannot lead to a new link and leave the
matrix. Frequencies only order tokens; they come from counts in a fixed number of cells, which every size of corpus fills
alike, and any order is exact.

A token that leads to few groups pairs them by a join, whose rows are bounded by a multiple of the matrix. The members of
groups with a more frequent one are dealt to cells of bounded size and held against each other by bit maps in place; only
pairs that may be similar are sent. A pair that shares a frequent token is found there, any other by its rare ones.

Groups come from three smallest hashes in turn. The second and third only add links, so that large groups of near copies are
one component before groups are compared with each other, which then need not be.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamis.llm.common import numbered, release, written
from tamis.llm.components import components
from tamis.llm.set_groups import (
    batches_of_sets, digest, grouped, likely_in_cells, links_between, links_of_texts, marked_rows, minima, odd, set_signatures, sets_of)

CELLS_BITS, BLOCKS = 20, 64
ORDERS = 3
SHARED = 10  # one in so many tokens must be met in both prefixes
FREQUENT = 64  # groups of a token whose members are compared in place
SIDE = 1024  # rows on a side of such a comparison, about
_FACTORS = odd(ORDERS, 20240913)
DESCRIBED = "id long, n int, d1 long, d2 long, m0 long, m1 long, m2 long, block int, counts binary"


def described(words: int):
    """Size, digest and smallest hashes of every text's set, and at the end of a task its counts of tokens by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << CELLS_BITS, np.int64)
        for batch in batches:
            for ids, found, offsets in batches_of_sets(batch, words):
                counts += np.bincount((found >> np.uint64(64 - CELLS_BITS)).astype(np.int64), minlength=1 << CELLS_BITS)
                pair = np.frombuffer(b"".join(digest(found[a:b]) for a, b in zip(offsets[:-1], offsets[1:])), np.int64).reshape(-1, 2)
                low = minima(found, offsets, _FACTORS).view(np.int64)
                yield pa.record_batch({
                    "id": ids, "n": pa.array(np.diff(offsets).astype(np.int32)), "d1": pa.array(np.ascontiguousarray(pair[:, 0])),
                    "d2": pa.array(np.ascontiguousarray(pair[:, 1])), **{f"m{k}": pa.array(low[k]) for k in range(ORDERS)},
                    "block": pa.nulls(len(ids), pa.int32()), "counts": pa.nulls(len(ids), pa.binary())})
        if counts.any():
            own = [part.tobytes() for part in np.minimum(counts, 2**32 - 1).astype(np.uint32).reshape(BLOCKS, -1)]
            yield pa.record_batch({
                **{k: pa.nulls(BLOCKS, pa.int32() if k == "n" else pa.int64()) for k in ("id", "n", "d1", "d2", "m0", "m1", "m2")},
                "block": pa.array(range(BLOCKS), pa.int32()), "counts": pa.array(own, pa.binary())})

    return run


def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A byte per cell of each block: half powers of two of its count."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
            total[block] = total.get(block, 0) + np.frombuffer(counts, np.uint32).astype(np.int64)
    if total:
        ranks = [np.floor(2 * np.log2(np.maximum(v, 1))).astype(np.uint8).tobytes() for v in total.values()]
        yield pa.record_batch({"block": pa.array(list(total), pa.int32()), "ranks": pa.array(ranks, pa.binary())})


def common_least(n, least: Fraction) -> np.ndarray:
    """Tokens that a set of n must have in common with a similar one."""
    return -(-n * least.numerator // least.denominator)


def must_meet(n):
    return -(-n // SHARED)


def prefixes(words: int, least: Fraction, ranks: np.ndarray):
    """Rows ``t, id`` of the prefix tokens of every set; equal sets of a task are sent once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for ids, found, offsets in batches_of_sets(batch, words):
                n = np.diff(offsets)
                new = np.zeros(len(n), bool)
                for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
                    key = digest(found[a:b])
                    if b > a and key not in seen:
                        seen.add(key)
                        new[k] = True
                text = np.repeat(np.arange(len(n)), n)
                m = new[text]
                tokens, text = found[m], text[m]
                order = np.lexsort((tokens, ranks[(tokens >> np.uint64(64 - CELLS_BITS)).astype(np.int64)], text))
                tokens, text = tokens[order], text[order]
                own = np.where(new, n, 0)
                place = np.arange(len(tokens)) - (np.cumsum(own) - own)[text]
                keep = place < (own - common_least(own, least) + must_meet(own))[text]
                yield pa.record_batch({"t": pa.array(tokens[keep].view(np.int64)), "id": ids.take(pa.array(text[keep]))})
        release()

    return run


def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows ``t, id``, sorted by t, whose token has another row; keeps one row."""
    held = None
    for batch in batches:
        t, ids = np.asarray(batch.column("t")), np.asarray(batch.column("id"))
        if not len(t):
            continue
        carried = 0
        if held is not None:
            carried, t, ids = 1, np.append(held[0], t), np.append(held[1], ids)
        same = t[1:] == t[:-1]
        keep = np.append(False, same) | np.append(same, False)
        if carried and held[2]:
            keep[0] = False  # sent before
        last_sent = bool(keep[-1]) or bool(carried and len(t) == 1 and held[2])
        held = (t[-1], ids[-1], last_sent)
        yield pa.record_batch({"t": pa.array(t[keep]), "id": pa.array(ids[keep])})


def distinct_cells(rows: DataFrame) -> DataFrame:
    """The rows ``cell, node`` of cells of several members; of cells with the same members only one."""
    cells = rows.groupBy("cell").agg(
        F.count("*").alias("k"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit("again"))).alias("y"))
    cells = cells.filter("k > 1").groupBy("k", "x", "y").agg(F.min("cell").alias("cell"))
    return rows.join(cells.select("cell"), "cell", "left_semi")


def linked_classes(
    texts: DataFrame, words: int, bound: Fraction, unique: bool, linked: DataFrame | None = None, frequent: int = FREQUENT,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of rows ``id, text``: each id with its size ``n``, each with its class ``node``, and ``node, root`` of all links.

    A class is the texts of one set that is not empty, named by its smallest id. ``linked`` has ``node, root`` of classes that
    are linked already, however found, instead of the groups' own links; what it lacks is found.
    """
    rows = written(texts.mapInArrow(described(words), DESCRIBED), "described")
    counts = rows.filter("block is not null").select("block", "counts").repartition(BLOCKS, "block")
    ranks = np.zeros((BLOCKS, (1 << CELLS_BITS) // BLOCKS), np.uint8)
    for r in counts.mapInArrow(ranked, "block int, ranks binary").collect():  # a byte for each of the fixed cells
        ranks[r["block"]] = np.frombuffer(r["ranks"], np.uint8)
    ranks = ranks.ravel()
    rows = rows.filter("block is null").drop("block", "counts").dropDuplicates(["id"])

    full = rows.filter("n > 0")
    classes = written(full.groupBy("d1", "d2").agg(F.min("id").alias("node"), *(
        F.min(c).alias(c) for c in ("n", "m0", "m1", "m2"))), "classes")
    groups = []
    for k in range(ORDERS if linked is None else 1):
        near = classes.select(F.col(f"m{k}").alias("key"), F.col(f"m{(k + 1) % ORDERS}").alias("near"), "node", "n")
        groups.append(written(grouped(near, "near"), "groups"))
    if linked is None:
        several = reduce(DataFrame.unionByName, (
            dealt.select(F.xxhash64(F.lit(k), "key", "first").alias("cell"), "node") for k, dealt in enumerate(groups)))
        several = written(distinct_cells(several), "cells")
        linked = components(written(links_of_texts(several, texts, words, unique, bound), "links"))
    root = written(linked.select(F.col("node").alias("member"), "root"), "roots")

    # What a group holds of one component: these are the groups that are met and opened.
    dealt = groups[0].filter("own").select("key", "first", F.col("node").alias("member_of"))
    known = rows.select("id", "d1", "d2", "n").filter("n > 0").join(classes.select("d1", "d2", "node"), ["d1", "d2"])
    known = known.join(root, known["node"] == root["member"], "left").join(dealt, known["node"] == dealt["member_of"])
    known = known.withColumn("c", F.coalesce("root", "node"))
    known = written(known.select("id", "node", "n", "c", F.xxhash64("key", "first", "c").alias("g")), "known")

    sent = texts.mapInArrow(prefixes(words, bound, ranks), "t long, id long")
    sent = written(sent.repartition("t").sortWithinPartitions("t").mapInArrow(repeated, "t long, id long"), "tokens")
    # One shuffle by token serves the rows of the matrix and what is known of each token; a window spills what does not fit.
    matrix = sent.join(known, "id").select("t", "g", "n", "c").repartition("t").groupBy("t", "g").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("c").alias("c"))
    of_token = Window.partitionBy("t")
    matrix = matrix.withColumns({
        "x": F.min("c").over(of_token), "y": F.max("c").over(of_token), "f": F.count("*").over(of_token)}).filter("x < y")
    open_tokens = written(matrix.drop("x", "y"), "matrix")
    if open_tokens.isEmpty():  # no token of two components
        return rows, known, root.select(F.col("member").alias("node"), "root")
    matrix = open_tokens.filter(F.col("f") <= frequent)
    one, two = ([F.col(k).alias(f"{side}_{k}") for k in ("g", "lo", "hi", "c")] for side in ("a", "b"))
    fits = (F.col("a_hi") * bound.denominator >= F.col("b_lo") * bound.numerator) & (
        F.col("b_hi") * bound.denominator >= F.col("a_lo") * bound.numerator)
    met = matrix.select("t", *one).join(matrix.select("t", *two), "t").filter((F.col("a_c") < F.col("b_c")) & fits)
    smallest = F.min(F.least("a_lo", "b_lo"))
    pairs = met.groupBy(F.col("a_g").alias("a"), F.col("b_g").alias("b")).agg(F.count("*").alias("met"), smallest.alias("lo"))
    pairs = written(pairs.filter(F.col("met") >= F.ceil(F.col("lo") / SHARED)).select("a", "b"), "group-pairs")

    # Tokens of many groups: their members meet in cells of bounded size and are held against each other by bit maps.
    often = open_tokens.filter(F.col("f") > frequent).select("t", F.ceil(F.col("f") / SIDE).cast("int").alias("k")).distinct()
    often = written(often, "frequent-tokens")
    rows_of = marked_rows(sent.select(F.col("t").alias("id"), F.col("id").alias("row")), often.select(F.col("t").alias("id")))
    often = rows_of.select(F.col("id").alias("t"), F.col("row").alias("id")).join(often, "t").join(known, "id").select(
        "t", "k", "node", "n", "c", "g").dropDuplicates(["t", "node"])
    often = written(often, "frequent")

    asked = pairs.select(F.col("a").alias("cell")).unionByName(pairs.select(F.col("b").alias("cell")))
    asked = asked.unionByName(often.select(F.col("g").alias("cell"))).distinct()
    members = known.filter(F.col("id") == F.col("node")).select(F.col("g").alias("cell"), "node", F.col("c").alias("root")).join(asked, "cell", "left_semi")
    members = written(members, "opened")
    sets = sets_of(texts, members, words, unique)
    bits = sets.join(often.select("node").distinct(), "node", "left_semi").mapInArrow(set_signatures, "node long, bits binary")
    half = F.pmod(F.xxhash64("node"), F.col("k"))
    cells = often.withColumn("i", half).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    cells = cells.join(bits, "node").select(
        "t", F.least("i", "j").cast("int").alias("low"), F.greatest("i", "j").cast("int").alias("high"),
        F.col("i").cast("int").alias("half"), "n", "c", "g", "bits")
    cells = cells.repartition("t", "low", "high").sortWithinPartitions("t", "low", "high")
    pairs = pairs.unionByName(cells.mapInArrow(likely_in_cells(bound), "a long, b long")).distinct()
    found = links_between(pairs, members, sets, bound)
    return rows, known, components(root.select(F.col("member").alias("a"), F.col("root").alias("b")).unionByName(found))


def similar(
    docs: DataFrame, words: int = 5, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT,
) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per input row.

    Rows are linked if the sets of their shingles have a share of ``least`` or more of their union in common; ``component_id``
    is the smallest id that links lead to, the row's own included. Null and empty texts and texts without words have no
    shingles and are linked with nothing. Null ids come last and never name a component that has another id; rows that share
    an id are told apart by their texts, and rows that repeat id and text are linked like others. An empty table gives no
    rows. Other columns are not looked at.
    """
    bound = Fraction(least).limit_denominator(10**6)
    placed, unique = numbered(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text", "id")
    texts = placed.select("id", F.coalesce("text", F.lit("")).alias("text"))
    rows, known, roots = linked_classes(texts, words, bound, unique, frequent=frequent)
    label = known.select("id", "node").join(roots, "node", "left").select("id", F.coalesce("root", "node").alias("root"))
    label = written(label, "labels")

    # Numbers order ids, but a component is named by an id itself.
    ids = placed.select("id", "doc_id").join(rows.select("id", F.col("n").cast("long").alias("n_shingles")), "id")
    ids = written(ids.join(label, "id", "left").withColumn("root", F.coalesce("root", "id")), "rooted")
    names = written(ids.groupBy("root").agg(F.min("doc_id").alias("component_id")), "component-names")
    return ids.join(names, "root").select("doc_id", "n_shingles", "component_id")
