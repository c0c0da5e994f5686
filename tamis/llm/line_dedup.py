"""Removes repeated lines and paragraphs by their digests.

A text is cut into units: at line ends, and in long lines after every sentence of at least ``SENTENCE`` words, so that a
passage put into the middle of a paragraph still falls into the same units as elsewhere. Units are normalised (A-Z in
lower case, white space collapsed) and hashed. Digests are counted over all documents, and each one's earliest unit, by
document id and then by place, is kept. All others are removed. A caller may keep short ones: with ``min_words`` only runs
of so many words go, and with ``whole_lines`` besides it a line that occurred before goes whatever its length, so that the
minimum holds for sentences inside a line only. Offsets of what was removed refer to the original text.

Only digests travel. They are combined before the shuffle, and a very frequent unit is met in a join that Spark may
split. A document gets back the numbers of its own repeated units, never those of others.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import free, pieces, release, text_hash, written

SENTENCE = 3
_END = re.compile(rb"[.!?]+(?=[ \t\x0b\x0c\r])|\n")
REMOVED = "struct<text:string,units:int,removed_chars:long,spans:array<struct<start:long,length:long>>>"
REMOVED_ARROW = pa.struct({
    "text": pa.string(), "units": pa.int32(), "removed_chars": pa.int64(),
    "spans": pa.list_(pa.struct({"start": pa.int64(), "length": pa.int64()})),
})


def units(text: bytes) -> Iterator[tuple[int, int, list[bytes]]]:
    """Start, end and words of every unit; units cover the whole text, and all but the last have words."""
    start = last = 0
    words: list[bytes] = []
    for found in _END.finditer(text):
        piece = text[last:found.end()].split()
        last = found.end()
        words += piece
        if words and (len(piece) >= SENTENCE or text[last - 1] == 10):
            yield start, last, words
            start, words = last, []
    if start < len(text):
        words += text[last:].split()
        yield start, len(text), words


def digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words).lower(), digest_size=16).digest()


def lines(text: bytes, found: list[tuple[int, int, list[bytes]]]) -> Iterator[tuple[int, int]]:
    """First unit of every line and the first one after it.

    Blanks and the line end after a sentence belong to the next unit, which then begins a line.
    """
    first = 0
    for k, (_, end, _) in enumerate(found):
        after = text[end:found[k + 1][1]] if k + 1 < len(found) else b"\n"
        if text[end - 1] == 10 or b"\n" in after[:len(after) - len(after.lstrip())]:
            yield first, k + 1
            first = k + 1


def digests(text: bytes, line_words: int) -> list[tuple[int, bytes]]:
    """Number and digest of every unit with words; lines of several units and under ``line_words`` words have -1 - first."""
    found = list(units(text))
    own = [(k, digest(words)) for k, (_, _, words) in enumerate(found) if words]
    for first, after in lines(text, found) if line_words else ():
        words = [w for _, _, some in found[first:after] for w in some]
        if after - first > 1 and words and len(words) < line_words:
            own.append((-1 - first, digest(words)))
    return own


def unit_table(batches: Iterator[pa.RecordBatch], line_words: int = 0) -> Iterator[pa.RecordBatch]:
    """``o, x, unit, d1, d2`` for every unit with words, and for whole lines as ``digests`` numbers them."""
    import numpy as np

    for batch in batches:
        rows, keys, sums = [], [], []
        texts = batch.column("t").cast(pa.large_binary())
        for i, text in enumerate(texts):
            own = digests(text.as_buffer().to_pybytes(), line_words)
            rows.extend([i] * len(own))
            keys.extend(k for k, _ in own)
            sums.extend(d for _, d in own)
            if len(rows) > 1 << 17 or i + 1 == len(texts):
                pair = np.frombuffer(b"".join(sums), np.int64).reshape(-1, 2)
                at = pa.array(rows, pa.int32())
                yield pa.record_batch({
                    "o": batch.column("o").take(at), "x": batch.column("x").take(at), "unit": pa.array(keys, pa.int32()),
                    "d1": pa.array(np.ascontiguousarray(pair[:, 0])), "d2": pa.array(np.ascontiguousarray(pair[:, 1]))})
                rows, keys, sums = [], [], []
    release()


def cut_out(text: bytes, repeated: set[int], min_words: int, whole_lines: bool = False) -> dict:
    """The text without runs of repeated units, and where they were, in code points."""
    found = list(units(text))
    gone: set[int] = set()
    if whole_lines:
        for first, after in lines(text, found):
            if -1 - first in repeated or after - first == 1 and first in repeated:
                gone.update(range(first, after))
    run, run_words = [], 0
    for k in range(len(found) + 1):
        if k in repeated:
            run.append(k)
            run_words += len(found[k][2])
            continue
        if run and run_words >= min_words:
            gone.update(run)
        run, run_words = [], 0

    kept, spans, count, at = [], [], 0, 0
    for k, (start, end, words) in enumerate(found):
        raw = text[start:end]
        size = len(raw.decode("utf-8", "replace"))
        count += bool(words)
        if k not in gone:
            kept.append(raw)
        elif k - 1 in gone:
            spans[-1]["length"] += size
        else:
            spans.append({"start": at, "length": size})
        at += size
    return {"text": b"".join(kept).decode("utf-8", "replace"), "units": count,
            "removed_chars": sum(s["length"] for s in spans), "spans": spans}


def remove_repeats(
    docs: DataFrame, min_words: int = 1, id_col: str = "doc_id", text_col: str = "text", into: str = "repeats",
    whole_lines: bool = False,
) -> DataFrame:
    """``docs`` with a column ``into``: the remaining text, the number of units, and what was removed.

    A null text stays null and counts as empty. Null ids rank last. Rows that share an id rank alike, so none of them
    is earlier than the other at the same unit; rows that repeat id and text lose the same units. A document may become
    empty if all of it is repeated. An empty table gives no rows. A column named like ``into`` is replaced, others stay
    whatever their names.
    """

    @F.arrow_udf(REMOVED)
    def without(texts: pa.Array, repeated: pa.Array) -> pa.Array:
        parts, done = [pa.array([], REMOVED_ARROW)], 0
        for piece in pieces(texts.cast(pa.large_binary())):
            out = []
            for text, own in zip(piece, repeated.slice(done, len(piece))):
                found = cut_out(text.as_buffer().to_pybytes() if text.is_valid else b"", set(own.as_py() or ()), min_words, whole_lines)
                out.append(found if text.is_valid else found | {"text": None})
            done += len(piece)
            parts.append(pa.array(out, REMOVED_ARROW))
        release()
        return pa.concat_arrays(parts)

    # A filter on its result would be pushed below the projection and cut every text twice, in twice as many workers.
    without = without.asNondeterministic()

    order = F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1))
    keys = docs.select(order.alias("o"), text_hash(F.col(text_col)).alias("x"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    # A line of as many words whose units are all repeated goes anyway.
    line_words = min_words if whole_lines else 0
    listed = written(keys.mapInArrow(lambda batches: unit_table(batches, line_words), "o long, x long, unit int, d1 long, d2 long"), "units")
    # Document and place as one number, which an aggregation keeps in a buffer of fixed width.
    rank = F.col("o").cast("decimal(19,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.greatest("unit", -1 - F.col("unit"))
    ranked = listed.withColumn("rank", rank)
    first = ranked.groupBy("d1", "d2").agg(F.min("rank").alias("first"), F.count("*").alias("n")).filter("n > 1")
    # Written, so that the join reads two plain tables and Spark can split a frequent digest.
    first = written(first.select("d1", "d2", "first"), "repeated-units")
    later = ranked.join(first, ["d1", "d2"]).filter(F.col("rank") > F.col("first"))
    # As many numbers as the document has units.
    o, x, units = (free(name, docs.columns) for name in ("__o", "__x", "__units"))
    own = later.groupBy(F.col("o").alias(o), F.col("x").alias(x)).agg(F.collect_set("unit").alias(units))
    met = (order == F.col(o)) & (text_hash(F.col(text_col)) == F.col(x))
    out = docs.join(own, met, "left")
    return out.select(*(F.col(f"`{c}`") for c in docs.columns if c != into),
                      without(F.col(text_col), F.col(units)).alias(into))
