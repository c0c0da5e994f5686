"""Removal of repeated byte strings by a logarithmic family of suffix arrays.

Documents arrive in batches by id. A batch's suffixes are sorted by their beginning, the sorted batch is scanned along
with the levels of the index for strings of ``length`` bytes that occur earlier, and is added as a new level; levels of
equal size are merged into one of twice that size, so there are never more than a logarithm of the number of batches.

The arrays are sparse. Of every ``length`` consecutive bytes the ``GRAM``-byte gram with the smallest hash is the
anchor, which depends on those bytes alone, so equal strings have the same anchor at the same place, and only suffixes
at anchors are sorted: about one in forty. The strings that share an anchor are neighbours, and all of them together are
its context. An entry is (hash of the gram, hash of the context, document, first and last start). Sorting by gram and
context brings equal ones together:

* an entry whose context came earlier is removed as a whole, and is not indexed again;
* an anchor whose gram has several contexts (where a repetition begins or ends) goes to a second, exact step. Its context
  is cut from the text and sent to the others of its gram, and all but the earliest occurrence of each string are
  removed. Grams of more than ``CROWD`` contexts send hashes of their strings instead, spread by hash, so that no task
  holds a group of any size.

Equal contexts within a piece of a batch are combined before the shuffle, sorted rows are scanned as a stream that keeps
one row, and neither pairs nor lists of occurrences are made, so frequent passages cost no more than their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamis.llm.common import Rolling, byte_view, free, mix, numbered, pieces, written
from tamis.session import scratch_path

LENGTH, GRAM, BATCHES, CROWD = 100, 16, 4, 1 << 15
# ``at`` holds the first start, the number of further starts (18 bits) and the state (2 bits) of an entry.
ENTRY = "g long, c long, o long, at long"
FOUND = "kind string, g long, c long, o long, at long"
OLD, NEW, GONE = 0, 1, 2
CODEC = "zstd"  # of the written entries, which are most of what stays on disk
CUT = "struct<kept:binary,n_bytes:long,spans:array<struct<first:long,last:long>>>"
CUT_ARROW = pa.struct({"kept": pa.binary(), "n_bytes": pa.int64(),
                       "spans": pa.list_(pa.struct({"first": pa.int64(), "last": pa.int64()}))})


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` consecutive values, from running minima of blocks in both directions."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n - width + 1], forward[width - 1:n])


def anchors(texts: pa.Array, length: int) -> dict[str, np.ndarray]:
    """Entries of a piece: text number, gram, context, and the first and last start of the strings of each anchor."""
    data, bounds = byte_view(texts)
    empty = {k: np.zeros(0, np.int64) for k in ("text", "g", "c", "lo", "hi")}
    if len(data) < length:
        return empty
    roll = Rolling(data)
    places = np.arange(len(data) - GRAM + 1)
    grams = roll.of(places, places + GRAM)
    # Hash in the upper half, place in the lower: of equal hashes the leftmost is taken.
    packed = (grams & np.uint64(0xFFFFFFFF00000000)) | places.astype(np.uint64)
    anchor = (sliding_min(packed, length - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.zeros(len(anchor) + 1, np.int64)
    ends = np.maximum(bounds[1:] - length + 1, bounds[:-1])
    np.add.at(inside, np.minimum(bounds[:-1], len(anchor)), 1)
    np.add.at(inside, np.minimum(ends, len(anchor)), -1)
    inside = np.cumsum(inside[:-1]) > 0
    change = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])))
    # Two texts that follow each other share no anchor, but a text may start where another's strings end.
    change[bounds[:-1][bounds[:-1] < len(anchor)]] = True
    starts = np.flatnonzero(change)
    stops = np.append(starts[1:], len(anchor)) - 1
    keep = inside[starts]
    lo, hi = starts[keep], stops[keep]
    at = anchor[lo]
    context = roll.raw(lo, hi + length) + (at - lo).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    context = mix(context + (hi - lo).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    text = np.searchsorted(bounds, lo, side="right") - 1
    return {"text": text, "g": grams[at].view(np.int64), "c": context.view(np.int64), "lo": lo - bounds[text], "hi": hi - bounds[text]}


def pack(lo: np.ndarray, hi: np.ndarray, state) -> np.ndarray:
    return (lo.astype(np.int64) << 20) | ((hi - lo).astype(np.int64) << 2) | state


def unpack(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lo = at >> 20
    return lo, lo + ((at >> 2) & 0x3FFFF)


def entries(length: int):
    """Rows of ``ENTRY`` from rows (o, t). What a piece itself repeats is sent on as gone, spread by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for piece in pieces(batch.column("t")):
                ids = np.asarray(batch.column("o").slice(done, len(piece)))
                done += len(piece)
                found = anchors(piece, length)
                o = ids[found["text"]]
                order = np.lexsort((found["lo"], o, found["c"], found["g"]))
                g, c, o, lo, hi = (x[order] for x in (found["g"], found["c"], o, found["lo"], found["hi"]))
                again = np.zeros(len(g), bool)
                again[1:] = (g[1:] == g[:-1]) & (c[1:] == c[:-1])
                yield pa.record_batch({
                    "g": pa.array(np.where(again, o, g)), "c": pa.array(np.where(again, 0, c)), "o": pa.array(o),
                    "at": pa.array(pack(lo, hi, np.where(again, GONE, NEW)))})

    return run


def merge_scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of entries sorted by (g, c, o, at): r(emoved), i(ndex) rows for the new level, and anchors for the f(ine) step."""
    last_g = last_c = None  # of the row before
    heads = 0  # contexts of its gram so far
    pending = None  # the first of them, while it is the only one
    for batch in batches:
        g, c, o, at = (np.asarray(batch.column(k)) for k in ("g", "c", "o", "at"))
        m = (at & 3) == GONE
        out = [("r", None, None, o[m], at[m])]
        g, c, o, at = (x[~m] for x in (g, c, o, at))
        if len(g):
            new = (at & 3) == NEW
            same_g = np.concatenate(([last_g is not None and g[0] == last_g], g[1:] == g[:-1]))
            same_c = same_g & np.concatenate(([last_c is not None and c[0] == last_c], c[1:] == c[:-1]))
            m = same_c & new
            out.append(("r", None, None, o[m], at[m]))
            m = ~same_c & new
            out.append(("i", g[m], c[m], o[m], at[m] & ~3))
            group = np.cumsum(~same_g)  # 0 is the gram carried over
            count = np.bincount(group[~same_c], minlength=group[-1] + 1)
            if count[0] and heads == 1:
                out.append(("f", *pending))
            count[0] += heads if same_g[0] else 0
            m = ~same_c & (count[group] >= 2)
            out.append(("f", g[m], None, o[m], at[m] & ~3))
            heads, last_g, last_c = int(count[group[-1]]), g[-1], c[-1]
            if heads == 1 and (m := np.flatnonzero(~same_c & (group == group[-1]))).size:
                pending = (g[m], None, o[m], at[m] & ~3)
        for kind, g, c, o, at in out:
            if len(o):
                hashes = [pa.nulls(len(o), pa.int64()) if x is None else pa.array(x) for x in (g, c)]
                yield pa.record_batch([pa.array([kind] * len(o)), *hashes, pa.array(o), pa.array(at)],
                                      names=["kind", "g", "c", "o", "at"])


class Index:
    """Levels of the index, each a written table of entries; a new one is merged with its equals."""

    def __init__(self, spark, length: int = LENGTH):
        self.spark, self.length, self.levels, self.results = spark, length, [], []

    def add(self, batch: DataFrame, last: bool = False) -> None:
        """Scans a batch (``o``, ``t``) along with all levels and adds it to them; ids must exceed those before.

        The ``last`` batch is scanned alike but makes no level, since nothing is scanned along with it.
        """
        while not last and len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, one), (_, two) = self.levels.pop(), self.levels.pop()
            both = self.read(one, two).repartition("g").sortWithinPartitions("g", "c")
            self.levels.append((2 * size, self.write(both)))
        rows = batch.mapInArrow(entries(self.length), ENTRY)
        if self.levels:
            old = self.read(*(path for _, path in self.levels))
            rows = rows.unionByName(old)
        rows = rows.repartition("g").sortWithinPartitions("g", "c", "o", "at")
        path = scratch_path(self.spark, "suffix-scan")
        found = rows.mapInArrow(merge_scan, FOUND)
        if last:
            found = found.filter("kind != 'i'")
        found.write.option("compression", CODEC).partitionBy("kind").parquet(path)
        self.results.append(path)
        if not last:
            self.levels.append((1, path))

    def write(self, df: DataFrame) -> str:
        path = scratch_path(self.spark, "suffix-level")
        df.withColumn("kind", F.lit("i")).write.option("compression", CODEC).partitionBy("kind").parquet(path)
        return path

    def read(self, *paths: str, kind: str = "i") -> DataFrame:
        tables = [self.spark.read.schema(FOUND).parquet(path).filter(F.col("kind") == kind).drop("kind") for path in paths]
        return reduce(DataFrame.unionByName, tables)

    def found(self, kind: str) -> DataFrame:
        """Rows of all scans so far; several may name the same anchor."""
        return self.read(*self.results, kind=kind)


def listed(batch: pa.RecordBatch, text: str, number: str, places: str) -> Iterator[tuple]:
    """Per piece: the bytes, and for each listed anchor its gram, document, ``at``, and first and last start in them."""
    done = 0
    for piece in pieces(batch.column(text)):
        ids = np.asarray(batch.column(number).slice(done, len(piece)))
        lists = batch.column(places).slice(done, len(piece))
        done += len(piece)
        data, bounds = byte_view(piece)
        rows = np.repeat(np.arange(len(piece)), np.asarray(lists.value_lengths()))
        flat = lists.flatten()
        g, at = (np.asarray(flat.field(k)) for k in ("g", "at"))
        lo, hi = unpack(at)
        yield data, g, ids[rows], at, lo + bounds[rows], hi + bounds[rows]


def ranges(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all ranges one after the other, and the range of each."""
    which = np.repeat(np.arange(len(size)), size)
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + start[which], which


def contexts(length: int, *columns: str):
    """Rows (g, o, at, bytes) of the contexts of listed anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, g, o, at, lo, hi in listed(batch, *columns):
                size = hi - lo + length
                places, _ = ranges(lo, size)
                offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
                raw = pa.Array.from_buffers(pa.binary(), len(g), [None, pa.py_buffer(offsets), pa.py_buffer(data[places])])
                yield pa.record_batch({"g": pa.array(g), "o": pa.array(o), "at": pa.array(at), "bytes": raw})

    return run


def compare_contexts(length: int):
    """Ranges ``o, lo, hi`` of strings that occur earlier, from contexts sorted by (g, o, at)."""

    def resolve(batch: pa.RecordBatch) -> pa.RecordBatch:
        g, o, at = (np.asarray(batch.column(k)) for k in ("g", "o", "at"))
        data, bounds = byte_view(batch.column("bytes"))
        lo, hi = unpack(at)
        begin, which = ranges(bounds[:-1], hi - lo + 1)
        hashes = Rolling(data).of(begin, begin + length)
        # In order of rows, equal strings of a gram: the first in sorted order is the earliest.
        order = np.lexsort((np.arange(len(begin)), hashes, g[which]))
        again = np.zeros(len(begin), bool)
        sorted_g, sorted_w = g[which][order], hashes[order]
        again[order[1:]] = (sorted_g[1:] == sorted_g[:-1]) & (sorted_w[1:] == sorted_w[:-1])
        start = again & np.concatenate((np.ones(min(1, len(again)), bool), ~again[:-1] | (which[1:] != which[:-1])))
        stop = again & np.concatenate((~again[1:] | (which[1:] != which[:-1]), np.ones(min(1, len(again)), bool)))
        place = begin - bounds[:-1][which] + lo[which]
        return pa.record_batch({"o": pa.array(o[which[start]]), "lo": pa.array(place[start]), "hi": pa.array(place[stop])})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            # The last gram of a batch may go on; grams here have at most CROWD contexts.
            g = np.asarray(batch.column("g"))
            if not len(g):
                continue
            cut = int(np.flatnonzero(g == g[-1])[0])
            if held and (cut or np.asarray(held[0].column("g"))[0] != g[0]):
                first = int(np.flatnonzero(g != np.asarray(held[0].column("g"))[0])[0])
                held.append(batch.slice(0, max(first, cut)))
                yield resolve(pa.concat_batches(held))
                held = [batch.slice(max(first, cut))]
            elif cut:
                yield resolve(batch.slice(0, cut))
                held = [batch.slice(cut)]
            else:
                held.append(batch)
        if held:
            yield resolve(pa.concat_batches(held))

    return run


def strings(length: int, *columns: str):
    """Rows (w, g, o, s) of every string of listed anchors; what a piece itself repeats has the document for ``w``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, g, o, at, lo, hi in listed(batch, *columns):
                begin, which = ranges(lo, hi - lo + 1)
                w = Rolling(data).of(begin, begin + length).view(np.int64)
                g, o, s = g[which], o[which], begin - lo[which] + unpack(at)[0][which]
                order = np.lexsort((s, o, w, g))
                g, w, o, s = (x[order] for x in (g, w, o, s))
                again = np.zeros(len(g), bool)
                again[1:] = (g[1:] == g[:-1]) & (w[1:] == w[:-1])
                yield pa.record_batch({"w": pa.array(np.where(again, o, w)), "g": pa.array(g), "o": pa.array(o),
                                       "s": pa.array(s * 2 + again)})

    return run


def not_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``o, lo, hi`` of repeated strings, from rows of ``strings`` sorted by (w, g, o, s)."""
    last = None
    for batch in batches:
        w, g, o, s = (np.asarray(batch.column(k)) for k in ("w", "g", "o", "s"))
        gone = (s & 1) == 1
        m = ~gone
        own_w, own_g = w[m], g[m]
        if len(own_w):
            gone[m] = np.concatenate(([last == (own_w[0], own_g[0])], (own_w[1:] == own_w[:-1]) & (own_g[1:] == own_g[:-1])))
            last = (own_w[-1], own_g[-1])
        yield pa.record_batch({"o": pa.array(o[gone]), "lo": pa.array(s[gone] >> 1), "hi": pa.array(s[gone] >> 1)})


def cut(text: bytes, lo: np.ndarray, hi: np.ndarray) -> dict:
    """The text without the bytes [lo, hi) and the merged ranges."""
    order = np.argsort(lo, kind="stable")
    lo, reach = lo[order], np.maximum.accumulate(hi[order])
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(lo)), bool), lo[1:] > reach[:-1])))
    spans = list(zip(lo[first].tolist(), reach[np.append(first[1:], len(lo)) - 1].tolist())) if len(lo) else []
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at:a])
        at = b
    kept.append(text[at:])
    return {"kept": b"".join(kept), "n_bytes": len(text), "spans": [{"first": a, "last": b} for a, b in spans]}


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, batches: int = BATCHES, crowd: int = CROWD, id_col: str = "doc_id",
    text_col: str = "text", into: str = "repeats",
) -> DataFrame:
    """``docs`` with a column ``into``: the remaining bytes, the number of bytes, and the removed ranges.

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document of smaller id, or earlier
    in the same one. Null texts are empty; null ids come last. Rows that share an id are ordered by a hash of their
    texts, and rows that repeat id and text are one document. Strings may cut characters of several bytes, which is why
    what remains is binary. An empty table gives no rows. A column named like ``into`` is replaced, others stay whatever
    their names.
    """
    if length <= GRAM:
        raise ValueError(f"strings must be longer than {GRAM} bytes")
    own = [F.col(f"`{c}`") for c in docs.columns if c != into]
    number, owner, places, spans = (free(name, docs.columns) for name in ("__o", "__p", "__at", "__gone"))
    placed, unique = numbered(docs, id_col, text_col, number)
    # No number is null, but inner joins filter them and left ones do not; Spark shuffles texts once if both read the same rows.
    placed = placed.filter(F.col(number).isNotNull())
    work = placed if unique else placed.dropDuplicates([number])
    cuts = work.selectExpr(f"percentile_approx(`{number}`, array({', '.join(str(k / batches) for k in range(1, batches))})) as at"
                           ).first()["at"] if batches > 1 else []
    limits = [None, *sorted(set(cuts or [])), None]
    index = Index(docs.sparkSession, length)
    for low, high in zip(limits[:-1], limits[1:]):  # a fixed number of batches, whatever the input
        batch = work.select(F.col(number).alias("o"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
        if low is not None:
            batch = batch.filter(F.col("o") > low)
        if high is not None:
            batch = batch.filter(F.col("o") <= high)
        index.add(batch, last=high is None)

    # One shuffle by gram for both steps; a window spills groups that do not fit.
    fine = index.found("f").select("g", "o", "at").repartition("g").distinct()
    fine = fine.withColumn("many", F.count("*").over(Window.partitionBy("g")) > crowd)
    fine = written(fine, "suffix-fine")

    def anchored(which) -> DataFrame:
        # Lists are no longer than a document.
        lists = fine.filter(which).groupBy(F.col("o").alias(owner)).agg(F.collect_list(F.struct("g", "at")).alias(places))
        return work.join(lists, F.col(number) == F.col(owner))

    cut_from = anchored("not many").mapInArrow(contexts(length, text_col, number, places), "g long, o long, at long, bytes binary")
    found = cut_from.repartition("g").sortWithinPartitions("g", "o", "at").mapInArrow(
        compare_contexts(length), "o long, lo long, hi long")
    crowded = anchored("many").mapInArrow(strings(length, text_col, number, places), "w long, g long, o long, s long")
    found = found.unionByName(crowded.repartition("w").sortWithinPartitions("w", "g", "o", "s").mapInArrow(
        not_first, "o long, lo long, hi long"))
    first = F.shiftright("at", 20)
    gone = index.found("r").select(
        "o", first.alias("lo"), (first + F.shiftright("at", 2).bitwiseAND(F.lit(0x3FFFF).cast("long"))).alias("hi"))
    gone = gone.unionByName(found).groupBy(F.col("o").alias(owner)).agg(
        F.collect_list(F.struct("lo", "hi")).alias(spans))

    @F.arrow_udf(CUT)
    def without(batch: pa.Array, gone: pa.Array) -> pa.Array:
        out = []
        for text, own in zip(batch.cast(pa.large_binary()), gone):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            spans = own.values if own.is_valid else None
            lo, hi = (np.asarray(spans.field(k) if spans is not None else [], np.int64) for k in ("lo", "hi"))
            out.append(cut(raw, lo, hi + length))
        return pa.array(out, CUT_ARROW)

    out = placed.join(gone, F.col(number) == F.col(owner), "left")
    return out.select(*own, without(F.col(text_col), F.col(spans)).alias(into))
