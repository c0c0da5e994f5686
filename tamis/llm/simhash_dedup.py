"""Near duplicates by SimHash, found through a segment-popcount embedding.

A 64-bit fingerprint is mapped to the bit counts of its 32 two-bit segments. Two fingerprints that differ in d bits have
count vectors at a Manhattan distance of d at most, so that distance is a lower bound. The segments are dealt to
parts = radius // 2 + 1 parts. Of two fingerprints within the radius, the count vectors of at least one part are at most
one step apart. The join is a range join on a grid: every fingerprint goes to the cell of its counts in each part and to
the cells one step up, so any two vectors within one step meet in a cell. What meets is tested by the Manhattan distance
of all segments and then exactly.

Only distinct fingerprints take part, so copies cost nothing. A cell of more than ``CROWD`` fingerprints (a large group
of near copies) is not compared in one piece: its members are dealt anew by keys that leave out ``radius`` of the 16 hex
digits, one row per choice. Fingerprints within the radius agree outside some choice, and at most 16 ** radius distinct
ones can share a key, so those groups are bounded whatever the input. All links are kept; inside a cell they are sent as
a spanning tree, never as all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import written
from tamis.llm.components import components

SEED = 42
CROWD = 1 << 16
CHUNK = 1 << 16


def fingerprint(text: bytes, words: int = 3) -> bytes:
    """Eight bytes, most significant bit first; all zero for a text without words.

    A-Z are lower-cased and words are what ASCII white space separates. A bit is set if over half of the XXH64 hashes
    of the shingles (``words`` words joined by blanks, or all words if there are fewer) have it.
    """
    tokens = text.lower().split()
    if not tokens:
        return bytes(8)
    line = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    width = min(words, len(tokens))
    starts, ends = np.concatenate(([0], ends[:-1] + 1))[:len(ends) - width + 1].tolist(), ends[width - 1:].tolist()
    votes, digest = np.zeros(64, np.int64), xxhash.xxh64_digest
    for at in range(0, len(starts), CHUNK):
        hashes = b"".join([digest(line[a:b], SEED) for a, b in zip(starts[at:at + CHUNK], ends[at:at + CHUNK])])
        votes += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(votes * 2 > len(starts)).tobytes()


def fingerprint_column(text: Column, words: int = 3) -> Column:
    """The fingerprint as a long."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        found = b"".join(fingerprint(t.as_buffer().to_pybytes(), words) for t in texts.cast(pa.large_binary()))
        return pa.array(np.frombuffer(found, ">u8").astype(np.uint64).view(np.int64))

    return of(F.coalesce(text, F.lit("")))


def counts(fp: Column) -> Column:
    """Bit counts of the 32 two-bit segments, each in the segment's own two bits."""
    next_bit, low = F.shiftrightunsigned(fp, 1), F.lit(0x5555555555555555)
    both = fp.bitwiseAND(next_bit).bitwiseAND(low)
    return fp.bitwiseXOR(next_bit).bitwiseAND(low).bitwiseOR(F.shiftleft(both, 1))


def signed(x: int) -> Column:
    """Literal with the bits of an unsigned 64-bit number."""
    return F.lit(x - (1 << 64) if x >> 63 else x).cast("long")


def bounds(parts: int) -> list[tuple[int, int]]:
    edges = [32 * k // parts for k in range(parts + 1)]
    return list(zip(edges[:-1], edges[1:]))


def cells(fps: DataFrame, parts: int) -> DataFrame:
    """Rows ``part, cell, fp``: the own cell in every part, and the cells one step up."""
    vector = counts(F.col("fp"))
    placed = []
    for k, (first, last) in enumerate(bounds(parts)):
        mask = ((1 << 2 * (last - first)) - 1) << 2 * first
        own = vector.bitwiseAND(signed(mask))
        up = []
        for segment in range(first, last):
            # A count of two cannot rise; the step is a null there and is dropped.
            at = 2 * segment
            step = F.when(own.bitwiseAND(signed(1 << at)) != 0, signed(3 << at)).otherwise(signed(1 << at))
            up.append(F.when(own.bitwiseAND(signed(2 << at)) == 0, own.bitwiseXOR(step)))
        part = F.lit(k).alias("part")
        placed.append(F.array_compact(F.array(F.struct(part, own.alias("cell")), *(
            F.when(cell.isNotNull(), F.struct(part, cell.alias("cell"))) for cell in up))))
    return fps.select(F.explode(F.flatten(F.array(*placed))).alias("at"), "fp").select("at.part", "at.cell", "fp")


def segment_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Manhattan distance of the segments' bit counts: the lower bound that is tested first."""
    low = np.uint64(0x5555555555555555)
    a, b = a - ((a >> np.uint64(1)) & low), b - ((b >> np.uint64(1)) & low)
    total = np.zeros(len(a), np.int8)
    for shift in map(np.uint64, range(0, 64, 2)):
        one, two = ((x >> shift).astype(np.uint8) & np.uint8(3) for x in (a, b))
        total += np.abs(one.view(np.int8) - two.view(np.int8))
    return total


def spanning(members: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A forest over the links of a group: each fingerprint is compared only with those not reached yet."""
    left, out = np.unique(members), []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(left ^ at) <= radius
            if near.any():
                reached, left = left[near], left[~near]
                out.append((np.full(len(reached), at), reached))
                queue.extend(reached)
    return out


def links(radius: int, crowd: int):
    """Of rows sorted by cell: linked fingerprints (``a``, ``b``), and with null ``b`` the members of crowded cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def emit(part, cell, fp):
            new = np.concatenate(([True], (part[1:] != part[:-1]) | (cell[1:] != cell[:-1])))
            at = np.flatnonzero(new)
            sizes = np.diff(np.append(at, len(fp)))
            a, b, many = [], [], []
            for step in range(1, 8):  # small groups: neighbours in sorted order, at all steps
                ok = np.repeat(sizes <= 8, sizes)
                group = np.cumsum(new)
                first, second = fp[:-step], fp[step:]
                near = np.flatnonzero(ok[step:] & (group[step:] == group[:-step]) & (first != second))
                near = near[segment_distance(first[near], second[near]) <= radius]
                near = near[np.bitwise_count(first[near] ^ second[near]) <= radius]
                a.append(first[near])
                b.append(second[near])
            for g in np.flatnonzero(sizes > 8):
                members = np.unique(fp[at[g]:at[g] + sizes[g]])
                if len(members) > crowd:
                    many.append(members)
                else:
                    for x, y in spanning(members, radius):
                        a.append(x)
                        b.append(y)
            a, b = np.concatenate(a), np.concatenate(b)
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
            yield pa.record_batch({"a": pa.array(pairs[:, 0].view(np.int64)), "b": pa.array(pairs[:, 1].view(np.int64))})
            if many:
                many = np.unique(np.concatenate(many))
                yield pa.record_batch({"a": pa.array(many.view(np.int64)), "b": pa.nulls(len(many), pa.int64())})

        rows = 0
        for batch in batches:
            held.append(tuple(np.asarray(batch.column(k)) for k in range(2)) + (np.asarray(batch.column(2)).view(np.uint64),))
            rows += batch.num_rows
            if rows < 1 << 17:
                continue
            part, cell, fp = (np.concatenate(x) for x in zip(*held))
            last = np.searchsorted((part == part[-1]) & (cell == cell[-1]), True)  # the last group may go on
            if last:
                yield from emit(part[:last], cell[:last], fp[:last])
            held, rows = [(part[last:], cell[last:], fp[last:])], len(fp) - last
            members = np.unique(fp[last:])
            if len(members) > crowd:  # sent at once; what stays marks the cell as crowded
                yield pa.record_batch({"a": pa.array(members.view(np.int64)), "b": pa.nulls(len(members), pa.int64())})
                rows = crowd + 1
                held = [(part[last:last + rows], cell[last:last + rows], members[:rows])]
        if rows:
            yield from emit(*(np.concatenate(x) for x in zip(*held)))

    return run


def grouped(rows: DataFrame, radius: int, crowd: int) -> DataFrame:
    rows = rows.repartition("part", "cell").sortWithinPartitions("part", "cell")
    return rows.mapInArrow(links(radius, crowd), "a long, b long")


def dealt_anew(fps: DataFrame, radius: int) -> DataFrame:
    """Rows ``part, cell, fp``: the fingerprint without each choice of ``radius`` hex digits."""
    masks = [sum(15 << 4 * k for k in chosen) for chosen in combinations(range(16), min(radius, 16))]
    kept = [((1 << 64) - 1) ^ m for m in masks]
    table = F.array(*(F.struct(F.lit(i).alias("part"), signed(m).alias("mask"))
                      for i, m in enumerate(kept)))
    return fps.select(F.explode(table).alias("at"), "fp").select(
        "at.part", F.col("fp").bitwiseAND(F.col("at.mask")).alias("cell"), "fp")


def near_duplicates(
    docs: DataFrame, words: int = 3, radius: int = 3, crowd: int = CROWD, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id``, one row per input row.

    ``component_id`` is the smallest id that links of at most ``radius`` differing bits lead to, the row's own included;
    null ids never become one unless the component has no other. Null and empty texts have fingerprint zero and are
    linked like any other. Repeated rows stay and share their component. An empty table gives no rows.
    """
    if not 0 <= radius <= 7:
        raise ValueError("the radius must be between 0 and 7 bits")
    rows = docs.select(F.col(id_col).alias("doc_id"), fingerprint_column(F.col(text_col), words).alias("fp"))
    rows = written(rows, "simhash")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    found = written(grouped(cells(distinct.select("fp"), radius // 2 + 1), radius, crowd), "simhash-links")
    edges = found.filter(F.col("b").isNotNull())
    crowded = found.filter(F.col("b").isNull()).select(F.col("a").alias("fp")).distinct()
    # Keys of the second deal hold at most 16 ** radius fingerprints, so its groups are compared as they are.
    edges = edges.unionByName(grouped(dealt_anew(crowded, radius), radius, 16 ** radius))
    roots = components(edges)
    roots = written(roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct(), "simhash-roots")
    members = distinct.join(roots, distinct["fp"] == roots["node"]).select("fp", "root", "first_id")
    smallest = members.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = members.join(smallest, "root").select("fp", F.col("component_id").alias("linked_id"))
    labels = distinct.join(linked, "fp", "left").select(
        "fp", F.coalesce("linked_id", "first_id").alias("component_id"))
    out = rows.join(labels, "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
