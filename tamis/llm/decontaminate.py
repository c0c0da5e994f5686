"""Benchmark decontamination by suffix arrays over the training text.

Every batch of documents is a shard. Its words are numbered by the benchmark's vocabulary; a shard's suffix array sorts
the suffixes of its word sequence, and every suffix of every benchmark item is binary-searched in it, all of them at
once and one word deeper per step. That gives the places of each window of ``window`` words and the longest verbatim
match of each suffix. Before sorting, a shard is cut where two neighbouring words do not follow each other anywhere in
the benchmark, since no match runs across such a place; pieces shorter than the shortest window are left out. So nothing
is missed, and the array holds little more than what could match.

Documents are read once and not shuffled; a document with matches, however frequent its passages are, is handled in its
own shard. The benchmark is sent in blocks of at most ``block_bytes``: several blocks mean several passes, each written.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import Rolling, byte_view, free, pieces, written

MATCH = "struct<item_id:string,item_word:int,doc_word:int,n_words:int>"
FOUND = f"struct<n_words:long,hits:array<struct<first:int,last:int>>,items:array<string>,longest:array<{MATCH}>>"

FOUND_ARROW = pa.struct({
    "n_words": pa.int64(),
    "hits": pa.list_(pa.struct({"first": pa.int32(), "last": pa.int32()})),
    "items": pa.list_(pa.string()),
    "longest": pa.list_(pa.struct({
        "item_id": pa.string(), "item_word": pa.int32(), "doc_word": pa.int32(), "n_words": pa.int32()})),
})

# Words are runs of digits, letters and all characters beyond ASCII; A-Z are read as a-z.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True


@dataclass
class Words:
    """Words of several texts: hash of each, its text, and the first word of every text (and the end)."""

    hashes: np.ndarray
    text: np.ndarray
    first: np.ndarray


def split_words(texts: pa.Array) -> Words:
    data, offsets = byte_view(texts)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IN_WORD[data]
    starts = np.flatnonzero(inside[1:-1] & ~inside[:-2])
    ends = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    # A word ends where its text ends.
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    cuts = np.unique(cuts[inside[cuts] & inside[cuts + 1]])
    if len(cuts):
        starts, ends = np.sort(np.append(starts, cuts)), np.sort(np.append(ends, cuts))
    hashes = Rolling(_FOLD[data]).of(starts, ends)
    first = np.searchsorted(starts, offsets)
    return Words(hashes, np.searchsorted(offsets, starts, side="right") - 1, first)


class Benchmark:
    """Items as word numbers, with the word pairs that occur and the distinct windows."""

    def __init__(self, ids: list[str], texts: list[str], window: int):
        words = split_words(pa.array(texts, pa.large_string()))
        self.ids, self.window = ids, window
        self.vocabulary = np.unique(words.hashes)
        number = np.searchsorted(self.vocabulary, words.hashes).astype(np.int64)
        sizes = np.diff(words.first)
        self.size = sizes
        self.depth = int(sizes.max(initial=0))
        inner = words.text[1:] == words.text[:-1] if len(number) else np.zeros(0, bool)
        self.pairs = np.unique(number[:-1][inner] * len(self.vocabulary) + number[1:][inner])
        # Suffixes are rows of one padded table; items of fewer words than the window are their own window.
        self.words, self.first = number, words.first
        at = np.arange(len(number))
        self.item = words.text
        self.left = words.first[self.item + 1] - at
        self.need = np.minimum(window, sizes)[self.item]
        self.shortest = int(self.need.min(initial=window))


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Positions in order of their suffixes, compared over at least ``depth`` words, by prefix doubling."""
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64)
    step, order = 1, np.argsort(rank, kind="stable")
    while step < depth:
        following = np.zeros(len(rank), np.int64)
        following[:-step or None] = rank[step:] + 1 if step < len(rank) else 0
        key = rank * (len(rank) + 2) + following
        order = np.argsort(key, kind="stable")
        fresh = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1])))
        rank = np.empty_like(rank)
        rank[order] = fresh
        if fresh[-1] == len(rank) - 1:
            break
        step *= 2
    return order


def narrow(words, order, low, high, depth: int, wanted: np.ndarray, after: bool) -> np.ndarray:
    """First place in each [low, high) whose word at ``depth`` is not below (``after``: above) the wanted one."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) >> 1
        at = order[np.minimum(middle, len(order) - 1)] + depth
        word = words[np.minimum(at, len(words) - 1)]
        word = np.where(at < len(words), word, -1)
        up = open_ & ((word <= wanted) if after else (word < wanted))
        low = np.where(up, middle + 1, low)
        high = np.where(open_ & ~up, middle, high)


def search(words: np.ndarray, order: np.ndarray, bench: Benchmark) -> tuple[np.ndarray, np.ndarray]:
    """Per benchmark suffix: the interval of its window, and length and interval of its longest match."""
    n = len(bench.words)
    low, high = np.zeros(n, np.int64), np.full(n, len(order), np.int64)
    active = np.flatnonzero(bench.left >= bench.need)
    window = np.zeros((n, 2), np.int64)
    longest = np.zeros((n, 3), np.int64)
    depth = 0
    while len(active):
        wanted = bench.words[active + depth]
        start = narrow(words, order, low[active], high[active], depth, wanted, False)
        end = narrow(words, order, start, high[active], depth, wanted, True)
        depth += 1
        met = start < end
        active, start, end = active[met], start[met], end[met]
        low[active], high[active] = start, end
        full = depth == bench.need[active]
        window[active[full], 0], window[active[full], 1] = start[full], end[full]
        longest[active, 0], longest[active, 1], longest[active, 2] = depth, start, end
        active = active[bench.left[active] > depth]
    return window, longest


def spread(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the given ranges, with the number of the range of each."""
    sizes = end - start
    which = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(start, sizes), which


def shard_matches(texts: pa.Array, bench: Benchmark) -> list[dict]:
    """One record per text of a shard."""
    words = split_words(texts)
    counts = np.diff(words.first)
    out = [{"n_words": int(n), "hits": [], "items": [], "longest": []} for n in counts]
    if not len(bench.vocabulary) or not len(words.hashes):
        return out
    number = np.searchsorted(bench.vocabulary, words.hashes)
    number[number == len(bench.vocabulary)] = 0
    known = bench.vocabulary[number] == words.hashes
    linked = known[1:] & known[:-1] & (words.text[1:] == words.text[:-1])
    if len(bench.pairs):
        pair = number[:-1] * len(bench.vocabulary) + number[1:]
        at = np.minimum(np.searchsorted(bench.pairs, pair), len(bench.pairs) - 1)
        linked &= bench.pairs[at] == pair
    else:
        linked[:] = False
    # Pieces of neighbouring words that may belong to a match.
    begins = known & np.concatenate(([True], ~linked))
    stops = known & np.concatenate((~linked, [True]))
    begins, stops = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    long = stops - begins >= bench.shortest
    begins, stops = begins[long], stops[long]
    if not len(begins):
        return out
    # Kept words one after the other, with -1 behind each piece so that no match runs on.
    positions, piece = spread(begins, stops + 1)
    closing = positions == stops[piece]
    kept = np.where(closing, -1, number[np.minimum(positions, len(number) - 1)])
    order = suffix_array(kept, bench.depth)
    window, longest = search(kept, order, bench)

    hit = np.flatnonzero(window[:, 1] > window[:, 0])
    if not len(hit):
        return out
    # Items with the same window share its places: one range per distinct range and length.
    ranges, of = np.unique(np.stack([window[hit, 0], window[hit, 1], bench.need[hit]], 1), axis=0, return_inverse=True)
    of = of.ravel()
    places, which = spread(ranges[:, 0], ranges[:, 1])
    begin = positions[order[places]]
    docs = words.text[begin]
    begin, width = begin - words.first[docs], ranges[which, 2]
    by_range = [np.unique(bench.item[hit[of == r]]) for r in range(len(ranges))]
    for doc in np.unique(docs):
        mine = docs == doc
        spans = np.unique(np.stack([begin[mine], begin[mine] + width[mine]], 1), axis=0)
        reach = np.maximum.accumulate(spans[:, 1])
        cut = np.flatnonzero(np.concatenate(([True], spans[1:, 0] > reach[:-1])))
        last = np.append(reach[cut[1:] - 1], reach[-1])
        items = np.unique(np.concatenate([by_range[r] for r in np.unique(which[mine])]))
        out[doc]["hits"] = [{"first": int(a), "last": int(b)} for a, b in zip(spans[cut, 0], last)]
        out[doc]["items"] = sorted({bench.ids[i] for i in items})
    # The longest match of each item in each document, with one of its places.
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for suffix in hit[np.argsort(-longest[hit, 0], kind="stable")]:
        size, start, end = longest[suffix]
        begin = positions[order[start:end]]
        docs, one = np.unique(words.text[begin], return_index=True)
        for doc, at in zip(docs.tolist(), begin[one].tolist()):
            best.setdefault((doc, int(bench.item[suffix])), (int(size), at, int(suffix)))
    for (doc, item), (size, at, suffix) in sorted(best.items()):
        out[doc]["longest"].append({
            "item_id": bench.ids[item], "item_word": suffix - int(bench.first[item]),
            "doc_word": at - int(words.first[doc]), "n_words": size})
    return out


def merged(a: dict, b: dict) -> dict:
    """Findings of the same text for two blocks of the benchmark."""
    hits: list[dict] = []
    for span in sorted(a["hits"] + b["hits"], key=lambda s: (s["first"], s["last"])):
        if hits and span["first"] <= hits[-1]["last"]:
            hits[-1] = {"first": hits[-1]["first"], "last": max(hits[-1]["last"], span["last"])}
        else:
            hits.append(dict(span))
    return {"n_words": a["n_words"], "hits": hits, "items": sorted(set(a["items"]) | set(b["items"])),
            "longest": a["longest"] + b["longest"]}


def searched(text: Column, before: Column | None, block, window: int) -> Column:
    made: list[Benchmark] = []

    def run(batches: Iterator[tuple]) -> Iterator[pa.Array]:
        if not made:
            made.append(Benchmark(*block.value, window))
        for columns in batches:
            texts, old = (columns, None) if isinstance(columns, pa.Array) else columns
            found = [x for piece in pieces(texts) for x in shard_matches(piece, made[0])]
            if old is not None:
                found = [merged(a, b) for a, b in zip(old.to_pylist(), found)]
            yield pa.array(found, FOUND_ARROW)

    if before is None:
        def one(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            return run(batches)

        return F.arrow_udf(one, FOUND)(text)

    def two(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        return run(batches)

    return F.arrow_udf(two, FOUND)(text, before)


def find_matches(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 16 << 20, text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", into: str = "found",
) -> DataFrame:
    """``docs`` with a column ``into``: number of words, merged ranges of hit words, items with occurring windows, and
    the longest verbatim match of each such item.

    A null or empty text has no words and no hits; an item without words never matches; items that share an id count
    once; a null item id is the empty string. Repeated rows are judged one by one and ids of documents play no part. An
    empty benchmark hits nothing, and empty ``docs`` give no rows. A column named like ``into`` is replaced.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.coalesce(F.col(item_id_col).cast("string"), F.lit("")).alias("id"),
        F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + F.octet_length("id")), F.lit(0))).first()[0]
    count = max(1, -(-size // block_bytes))
    out, text = docs, F.coalesce(F.col(text_col), F.lit(""))
    for k in range(count):  # one block of the benchmark at a time; its size is bounded
        rows = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == k).collect() if count > 1 else items.collect()
        block = spark.sparkContext.broadcast(([r["id"] for r in rows], [r["text"] for r in rows]))
        out = out.withColumn(into, searched(text, F.col(into) if k else None, block, window))
        if k + 1 < count:
            out = written(out, "decontaminated")
    return out


def without_matches(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any hit, with their columns as they were."""
    name = free("found", docs.columns)
    found = find_matches(docs, benchmark, into=name, **options)
    return found.filter(F.size(F.col(name)["hits"]) == 0).drop(name)
