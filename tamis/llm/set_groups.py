"""Sets of word shingles, and links inside and between bounded groups of sets.

Words are what ASCII white space separates, A-Z in lower case; a shingle is so many words in a row, a text of fewer words is
one shingle. Sets hold 64-bit hashes of shingles. A group is a bounded number of sets that one task can hold; any dealing of
sets to groups is right, since groups are compared with each other as well as inside.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import Rolling, byte_view, free, mix, pieces, release, written

PIECE = 1 << 18
MEMBERS, TOKENS = 64, 1 << 17  # of a group; one larger set is a group of its own
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_RANDOM = np.random.RandomState(20240911)


def odd(count: int, seed: int) -> np.ndarray:
    """Fixed odd 64-bit factors."""
    values = np.random.RandomState(seed).randint(0, 2**63 - 1, count, dtype=np.int64)
    return values.astype(np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: pa.Array, words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and the n + 1 offsets."""
    data, bounds = byte_view(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    ink = ~_SPACE[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[bounds] = True
    first = ink & (np.concatenate(([True], ~ink[:-1])) | begins[:-1])
    last = ink & (np.concatenate((~ink[1:], [True])) | begins[1:])
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    word = Rolling(_LOWER[data]).of(start, end)
    text = np.searchsorted(bounds, start, side="right") - 1
    count = np.bincount(text, minlength=len(texts))
    factors = odd(words, 20240912)
    total = np.zeros(len(word), np.uint64)
    for k in range(min(words, len(word))):
        total[:len(word) - k] += word[k:] * factors[k]
    inside = np.zeros(len(word), bool)
    if len(word) >= words:
        inside[:len(word) - words + 1] = text[words - 1:] == text[:len(word) - words + 1]
    hashes, owner = [mix(total[inside] + np.uint64(words))], [text[inside]]
    offset = np.cumsum(count) - count
    for size in range(1, words):  # texts of fewer words
        short = np.flatnonzero(count == size)
        if len(short):
            parts = sum(word[offset[short] + k] * factors[k] for k in range(size))
            hashes.append(mix(parts + np.uint64(size)))
            owner.append(short)
    found, text = np.concatenate(hashes), np.concatenate(owner)
    order = np.lexsort((found, text))
    found, text = found[order], text[order]
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    found, text = found[keep], text[keep]
    return found, np.concatenate(([0], np.cumsum(np.bincount(text, minlength=len(texts))))).astype(np.int64)


def batches_of_sets(batch: pa.RecordBatch, words: int, size: int = PIECE) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Ids, hashes and offsets of the texts of a batch ``id, text``, some at a time."""
    done = 0
    for piece in pieces(batch.column("text"), size):
        ids = batch.column("id").slice(done, len(piece))
        done += len(piece)
        yield (ids, *shingle_sets(piece, words))


def digest(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def minima(found: np.ndarray, offsets: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Smallest hash of each set under each factor, a row per factor; the largest number for empty sets."""
    out = np.full((len(factors), len(offsets) - 1), np.iinfo(np.uint64).max, np.uint64)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        for k, factor in enumerate(factors):
            out[k, full] = np.minimum.reduceat(mix(found * factor), offsets[full])
    return out


def whole_sets(words: int):
    """Of rows ``id, text``: ``node`` and its set as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, found, offsets in batches_of_sets(batch, words):
                raw = [found[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.record_batch({"node": ids, "found": pa.array(raw, pa.binary())})
        release()

    return run


def sets_by_cell(words: int):
    """Of rows ``id, text, cells``: ``cell, node, found``, the set once for every cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for ids, found, offsets in batches_of_sets(batch, words):
                cells = batch.column("cells").slice(done, len(ids))
                done += len(ids)
                raw = pa.array([found[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])], pa.binary())
                row = pa.array(np.repeat(np.arange(len(ids)), np.asarray(cells.value_lengths())))
                yield pa.record_batch({"cell": cells.flatten(), "node": ids.take(row), "found": raw.take(row)})
        release()

    return run


MAP_BITS = 26  # of the map of asked ids at most: 8 MB


def marked_rows(rows: DataFrame, ids: DataFrame, most: int = MAP_BITS) -> DataFrame:
    """The rows whose ``id`` may be among the distinct ``id`` of ``ids``: all that are, and few others.

    A bit map by hash with sixteen bits an id, up to a fixed size, is broadcast; a larger one lets more others through.
    """
    bits = 1 << min(most, max(15, (16 * ids.count()).bit_length()))
    h = F.pmod(F.xxhash64("id"), F.lit(bits).cast("long"))
    page, place = F.shiftright(h, 15), h.bitwiseAND(F.lit(32767).cast("long"))
    maps = ids.groupBy(page.alias("page")).agg(F.bitmap_construct_agg(place).alias("map"))
    byte = F.conv(F.hex(F.expr("substring(map, cast(place div 8 as int) + 1, 1)")), 16, 10).cast("int")
    met = rows.withColumns({"page": page, "place": place}).join(F.broadcast(maps), "page")
    hit = F.expr("shiftright(byte, cast(place % 8 as int)) & 1 = 1")
    return met.withColumn("byte", byte).filter(hit).drop("page", "place", "map", "byte")


def rows_without(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose long ``key`` is not among the distinct ``id`` of ``ids``.

    Rows that a bit map as in ``marked_rows`` does not mark are not shuffled, whatever the size of ``ids``.
    """
    bits = 1 << min(MAP_BITS, max(15, (16 * ids.count()).bit_length()))
    page, bitmap, gone = (free(name, rows.columns) for name in ("__page", "__map", "__gone"))

    def at(column: str) -> tuple[F.Column, F.Column]:
        h = F.pmod(F.xxhash64(F.col(f"`{column}`")), F.lit(bits).cast("long"))
        return F.shiftright(h, 15), h.bitwiseAND(F.lit(32767).cast("long"))

    here, place = at("id")
    maps = ids.groupBy(here.alias(page)).agg(F.bitmap_construct_agg(place).alias(bitmap))
    here, place = at(key)
    byte = F.conv(F.hex(F.substring(F.col(bitmap), F.shiftright(place, 3).cast("int") + 1, 1)), 16, 10).cast("long")
    marked = F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), place.bitwiseAND(F.lit(7).cast("long"))).cast("long")) != 0, F.lit(False))
    met = rows.join(F.broadcast(maps), here == F.col(page), "left")
    # An anti join would be pushed below the filter.
    asked = met.filter(marked).join(ids.select(F.col("id").alias(gone)), F.col(f"`{key}`") == F.col(gone), "left").filter(F.col(gone).isNull())
    own = [F.col(f"`{c}`") for c in rows.columns]
    return met.filter(~marked).select(*own).unionByName(asked.select(*own))


def sets_of(texts: DataFrame, nodes: DataFrame, words: int, unique: bool) -> DataFrame:
    """``node, found`` of the rows ``id, text`` whose id is in ``nodes``, written; rows of one id have the same text."""
    ids = written(nodes.select(F.col("node").alias("id")).distinct(), "asked")
    # Other texts are not shuffled; a semi join would be pushed below the filter.
    asked = marked_rows(texts, ids).join(ids, "id")
    asked = asked if unique else asked.dropDuplicates(["id"])
    return written(asked.mapInArrow(whole_sets(words), "node long, found binary"), "shingle-sets")


def cut(members: int, tokens: int):
    """Groups of rows ``key, node, n`` sorted by key: ``key, first, node, own``.

    A key's rows are cut into groups of at most so many members and hashes, named by their first own member. A group after
    another of its key also gets that one's last member (``own`` is false), so that a chain leads through all of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = first = before = None
        count = size = 0
        for batch in batches:
            out = []
            for here, node, n in zip(*(batch.column(k).to_pylist() for k in ("key", "node", "n"))):
                if here != key or count >= members or size + n > tokens:
                    if here == key:
                        out.append((here, node, before, False))
                    key, first, count, size = here, node, 0, 0
                out.append((key, first, node, True))
                count, size, before = count + 1, size + n, node
            columns = list(zip(*out)) if out else [[], [], [], []]
            yield pa.record_batch({"key": pa.array(columns[0], pa.int64()), "first": pa.array(columns[1], pa.int64()),
                                   "node": pa.array(columns[2], pa.int64()), "own": pa.array(columns[3], pa.bool_())})

    return run


def grouped(rows: DataFrame, *near: str, members: int = MEMBERS, tokens: int = TOKENS) -> DataFrame:
    """``key, first, node, own`` from ``key, node, n``; dealt by ranges, so that no task holds a frequent key alone."""
    order = ["key", *near, "node"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "node", "n")
    return ranged.mapInArrow(cut(members, tokens), "key long, first long, node long, own boolean")


def spanning(values: np.ndarray, sizes: np.ndarray, least: Fraction) -> list[tuple[int, int]]:
    """A forest over the links of a group, as places; ``values`` are the sets one after the other.

    Each set is compared only with those not reached yet.
    """
    starts = np.cumsum(sizes) - sizes
    left, out = np.arange(len(sizes)), []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            own = values[starts[at]:starts[at] + sizes[at]]
            # Sets of too different sizes cannot have enough in common.
            fit = np.minimum(sizes[left], sizes[at]) * least.denominator >= np.maximum(sizes[left], sizes[at]) * least.numerator
            near, some = np.zeros(len(left), bool), np.flatnonzero(fit & (sizes[left] > 0))
            if len(some) and len(own):
                nodes = left[some]
                others = np.concatenate([values[starts[k]:starts[k] + sizes[k]] for k in nodes])
                hit = own[np.minimum(np.searchsorted(own, others), len(own) - 1)] == others
                both = np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes[nodes]) - sizes[nodes])
                near[some] = both * least.denominator >= (sizes[nodes] + sizes[at] - both) * least.numerator
            reached, left = left[near], left[~near]
            out.extend((int(at), int(k)) for k in reached)
            queue.extend(reached.tolist())
    return out


def links(least: Fraction):
    """Of rows ``cell, node, found`` sorted by cell: linked nodes ``a, b``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, nodes, held = None, [], []

        def close() -> Iterator[pa.RecordBatch]:
            if len(nodes) > 1:
                values = np.frombuffer(b"".join(held), np.uint64)
                pairs = spanning(values, np.array([len(h) // 8 for h in held], np.int64), least)
                if pairs:
                    a, b = (pa.array([nodes[p[k]] for p in pairs], pa.int64()) for k in range(2))
                    yield pa.record_batch({"a": a, "b": b})

        for batch in batches:
            for here, node, found in zip(*(batch.column(k) for k in ("cell", "node", "found"))):
                if here.as_py() != cell:
                    yield from close()
                    cell, nodes, held = here.as_py(), [], []
                nodes.append(node.as_py())
                held.append(found.as_py())
        yield from close()
        release()

    return run


def with_sets(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """The columns of ``groups`` (``cell, node, ...``) and ``found`` of the members; sets of other nodes are not shuffled."""
    ids = written(groups.select(F.col("node").alias("id")).distinct(), "asked")
    own = marked_rows(sets.withColumnRenamed("node", "id"), ids).withColumnRenamed("id", "node")
    return groups.join(own, "node").select(*groups.columns, "found")


def links_inside(groups: DataFrame, sets: DataFrame, least: Fraction) -> DataFrame:
    """Links ``a, b`` within the groups ``cell, node`` that have several members."""
    met = with_sets(groups, sets)
    met = met.repartition("cell").sortWithinPartitions("cell", "node")
    return met.mapInArrow(links(least), "a long, b long")


def links_of_texts(groups: DataFrame, texts: DataFrame, words: int, unique: bool, least: Fraction) -> DataFrame:
    """As ``links_inside``, with sets made from the rows ``id, text`` once and sent to their groups right away.

    A node is in few groups, so its list of them is short.
    """
    ids = written(groups.groupBy(F.col("node").alias("id")).agg(F.collect_list("cell").alias("cells")), "asked")
    asked = marked_rows(texts, ids).join(ids, "id")
    asked = asked if unique else asked.dropDuplicates(["id"])
    met = asked.select("id", "text", "cells").mapInArrow(sets_by_cell(words), "cell long, node long, found binary")
    met = met.repartition("cell").sortWithinPartitions("cell", "node")
    return met.mapInArrow(links(least), "a long, b long")


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per group from ``cell, root, found`` sorted by cell: the union of its sets, and each set as places in it."""
    cell, roots, held = None, [], []

    def close() -> Iterator[pa.RecordBatch]:
        if roots:
            values = np.frombuffer(b"".join(held), np.uint64)
            union, places = np.unique(values, return_inverse=True)
            yield pa.record_batch({
                "cell": pa.array([cell], pa.int64()), "roots": pa.array([roots], pa.list_(pa.int64())),
                "sizes": pa.array([[len(h) // 8 for h in held]], pa.list_(pa.int32())),
                "tokens": pa.array([union.tobytes()], pa.binary()),
                "places": pa.array([places.astype(np.int32).tobytes()], pa.binary())})

    for batch in batches:
        for here, root, found in zip(*(batch.column(k) for k in ("cell", "root", "found"))):
            if here.as_py() != cell:
                yield from close()
                cell, roots, held = here.as_py(), [], []
            roots.append(root.as_py())
            held.append(found.as_py())
    yield from close()


PACK = ("roots", "sizes", "tokens", "places")


def between(one: tuple, two: tuple, least: Fraction) -> list[tuple[int, int]]:
    """A forest over the links between two groups, given as names, sizes, tokens and places.

    Sets of one name are linked already, so only links between names are returned, and a set whose name is linked with all
    names of the other group is passed over. It is first held against the other group's union: what it shares with no
    member cannot be shared with one.
    """
    (names, sizes, tokens, places), (others, other_sizes, other_tokens, other_places) = one, two
    root, kinds = {n: n for n in (*names, *others)}, set(others)

    def top(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    at = np.searchsorted(other_tokens, tokens)
    known = other_tokens[np.minimum(at, len(other_tokens) - 1)] == tokens
    where = np.where(known, at, -1)  # place in the other union of each token
    ends = np.cumsum(other_sizes)
    out, start = [], 0
    for name, size in zip(names, sizes):
        start += size
        if all(top(k) == top(name) for k in kinds):
            continue
        own = where[places[start - size:start]]
        own = own[own >= 0]
        if len(own) * least.denominator < size * least.numerator:
            continue  # the bound: this group cannot hold a similar set
        mask = np.zeros(len(other_tokens), bool)
        mask[own] = True
        both = np.add.reduceat(mask[other_places].astype(np.int64), ends - other_sizes)
        for k in np.flatnonzero(both * least.denominator >= (size + other_sizes - both) * least.numerator):
            x, y = top(name), top(others[k])
            if x != y:
                root[x] = y
                out.append((name, others[k]))
    return out


def opened(least: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in range(batch.num_rows):
                groups = []
                for side in ("a", "b"):
                    names, sizes, tokens, places = (batch.column(f"{side}_{k}")[row] for k in PACK)
                    groups.append((names.as_py(), np.array(sizes.as_py(), np.int64), np.frombuffer(tokens.as_buffer(), np.uint64),
                                   np.frombuffer(places.as_buffer(), np.int32)))
                out.extend(between(*groups, least))
            yield pa.record_batch({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return run


def signature(found: np.ndarray) -> np.ndarray:
    """A bit map of a set by the low bits of its hashes, about eight bits a hash, as 64-bit words."""
    width = 1 << max(6, (8 * len(found) - 1).bit_length())
    marks = np.zeros(width, bool)
    marks[(found & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(marks, bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    while len(bits) > words:
        bits = bits[:len(bits) // 2] | bits[len(bits) // 2:]
    return bits


def may_link(one: tuple, two: tuple, least: Fraction) -> bool:
    """Whether sets of two groups may be similar, given their sizes and signatures.

    Every bit of a set that another's union lacks stands for a hash that no member of the other group has, which bounds what
    they can have in common.
    """
    words = min(len(b) for b in (*one[1], *two[1]))
    (sizes, maps), (others, other_maps) = ((np.array(n, np.int64), np.array([folded(b, words) for b in m])) for n, m in (one, two))
    union = np.bitwise_or.reduce(other_maps, axis=0)
    most = sizes - np.bitwise_count(maps & ~union).sum(axis=1, dtype=np.int64)
    for k in np.flatnonzero(most * least.denominator >= sizes * least.numerator):
        both = np.minimum(sizes[k] - np.bitwise_count(maps[k] & ~other_maps).sum(axis=1, dtype=np.int64),
                          others - np.bitwise_count(other_maps & ~maps[k]).sum(axis=1, dtype=np.int64))
        if (both * least.denominator >= (sizes[k] + others - both) * least.numerator).any():
            return True
    return False


def set_signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, bits`` of rows ``node, found``."""
    for batch in batches:
        bits = [signature(np.frombuffer(f.as_buffer(), np.uint64)).tobytes() for f in batch.column("found")]
        yield pa.record_batch({"node": batch.column("node"), "bits": pa.array(bits, pa.binary())})


def likely_members(rows: list[tuple], least: Fraction) -> list[tuple[int, int]]:
    """Groups ``(g, g)`` of rows ``(n, c, g, half, bits)`` of different components and halves (or of one) that may be similar.

    Rows are held against those of fitting size only, all at a time by their bit maps; nothing is sent for others.
    """
    rows = sorted(rows, key=lambda r: r[0])
    n, c, g, half = (np.array([r[k] for r in rows], np.int64) for k in range(4))
    maps = [np.frombuffer(r[4], np.uint64) for r in rows]
    widths, alone, out = np.array([len(m) for m in maps]), len(set(half.tolist())) == 1, set()
    for width in np.unique(widths):
        wide = np.flatnonzero((widths >= width) & (widths <= 2 * width))
        table = np.array([folded(maps[k], int(width)) for k in wide])
        for at in np.flatnonzero(widths[wide] == width):
            k = wide[at]
            end = at + 1 + np.searchsorted(n[wide[at + 1:]] * least.numerator, n[k] * least.denominator, side="right")
            other = np.arange(at + 1, end)
            other = other[(c[wide[other]] != c[k]) & (alone | (half[wide[other]] != half[k]))]
            both = np.minimum(n[k] - np.bitwise_count(table[at] & ~table[other]).sum(axis=1, dtype=np.int64),
                              n[wide[other]] - np.bitwise_count(table[other] & ~table[at]).sum(axis=1, dtype=np.int64))
            near = wide[other[both * least.denominator >= (n[k] + n[wide[other]] - both) * least.numerator]]
            out.update((min(int(g[k]), int(x)), max(int(g[k]), int(x))) for x in g[near] if x != g[k])
    return sorted(out)


def likely_in_cells(least: Fraction):
    """Pairs ``a, b`` of groups, from rows ``t, low, high, half, n, c, g, bits`` sorted by the first three."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []

        def close() -> Iterator[pa.RecordBatch]:
            pairs = likely_members(held, least) if held else []
            if pairs:
                yield pa.record_batch({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())})

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in ("t", "low", "high", "n", "c", "g", "half", "bits"))):
                if row[:3] != cell:
                    yield from close()
                    cell, held = row[:3], []
                held.append(row[3:])
        yield from close()

    return run


def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``cell, sizes, bits`` of packed groups."""
    for batch in batches:
        bits = []
        for sizes, tokens, places in zip(*(batch.column(k) for k in ("sizes", "tokens", "places"))):
            union = np.frombuffer(tokens.as_buffer(), np.uint64)
            own = np.split(np.frombuffer(places.as_buffer(), np.int32), np.cumsum(sizes.as_py())[:-1])
            bits.append([signature(union[o]).tobytes() for o in own])
        yield pa.record_batch({"cell": batch.column("cell"), "sizes": batch.column("sizes"), "bits": pa.array(bits, pa.list_(pa.binary()))})


def likely(least: Fraction):
    """The pairs whose groups may have a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for row in range(batch.num_rows):
                sides = []
                for side in ("a", "b"):
                    bits = [np.frombuffer(m.as_buffer(), np.uint64) for m in batch.column(f"{side}_bits")[row].values]
                    sides.append((batch.column(f"{side}_sizes")[row].as_py(), bits))
                keep.append(may_link(*sides, least))
            yield pa.record_batch({k: batch.column(k).filter(pa.array(keep, pa.bool_())) for k in ("a", "b")})

    return run


def with_groups(pairs: DataFrame, groups: DataFrame, names: tuple[str, ...]) -> DataFrame:
    for side in ("a", "b"):
        pairs = pairs.join(groups.select(F.col("cell").alias(side), *(F.col(k).alias(f"{side}_{k}") for k in names)), side)
    return pairs


def links_between(pairs: DataFrame, groups: DataFrame, sets: DataFrame, least: Fraction) -> DataFrame:
    """Links between the groups of each pair (``a, b``); ``groups`` has ``cell, node, root`` of all of them.

    Nodes of one root are linked already. A link is given as two roots, so a pair makes fewer links than it has roots.
    Pairs are first bounded by signatures, a byte or two a hash; only groups that may have a link are sent whole.
    """
    met = with_sets(groups, sets)
    packs = written(met.repartition("cell").sortWithinPartitions("cell", "node").mapInArrow(
        packed, "cell long, roots array<long>, sizes array<int>, tokens binary, places binary"), "packs")
    signs = written(packs.select("cell", "sizes", "tokens", "places").mapInArrow(
        signed, "cell long, sizes array<int>, bits array<binary>"), "signatures")
    pairs = written(with_groups(pairs, signs, ("sizes", "bits")).mapInArrow(likely(least), "a long, b long"), "likely-pairs")
    return with_groups(pairs, packs, PACK).mapInArrow(opened(least), "a long, b long")
