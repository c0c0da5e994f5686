"""Quality classifier from weak labels.

Overlapping heuristics vote good, bad or nothing on every document. A document's votes are one of 3 ** n patterns, so
the corpus is counted down to a table of patterns whose size does not depend on the data, and expectation-maximisation
on that table estimates how often each heuristic casts each vote on documents of either class, and the posterior of
every pattern. The posteriors of a bounded sample (``sample`` documents in expectation, chosen by a hash of their ids)
are the soft labels of a linear scorer over hashed features: words, their shapes, and word repetition. It scores every
document over its whole text, and those below ``threshold`` are rejected.

Counts cover all documents, nothing is shuffled but patterns, and the gold labels play no part; they are for tests.
"""

from __future__ import annotations

import operator
import re
from collections import Counter
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import free, release, text_hash

SAMPLE, SLOTS, THRESHOLD = 4000, 4096, 0.35  # below one half: a doubtful document is kept
# What a word looks like says more about quality than which word it is.
WORD_WEIGHT = 0.02
# Function words of the languages at hand; running text has them, lists and debris do not.
COMMON = frozenset((
    "the of and to in is that it for as with on by at from this be are was or "
    "de la le les des et en un une que du dans pour par sur est au qui pas "
    "el los las del y se con su para es al lo por una no "
    "der die das und zu den von mit ist im nicht ein eine auf für dem sich als"
).split())
_SYMBOLS = re.compile(r"[^\w\s.,;:'\"()\[\]/+@=?<>-]{2,}")

Profile = dict[str, float]


def profile(text: str) -> Profile:
    """Shares of words (0 to 1) with certain marks, and counts."""
    tokens = text.split()
    n = len(tokens)
    if not n:
        return {"words": 0}
    counts = Counter(tokens)
    return {
        "words": n,
        "upper": sum(map(str.isupper, tokens)) / n,
        "symbols": len(_SYMBOLS.findall(text)) / n,
        "bare": sum(c for t, c in counts.items() if len(t) < 4 and not any(map(str.isalnum, t))) / n,
        "echo": sum(map(operator.eq, tokens, tokens[1:])) / n,
        "runs": sum(map(lambda a, b, c: a == b == c, tokens, tokens[1:], tokens[2:])) / n,
        "common": sum(counts[w] for w in COMMON if w in counts) / n,
        "ends": sum(c for t, c in counts.items() if t[-1] in ".?") / n,
        "length": sum(map(len, tokens)) / n,
    }


def between(value: float, bad_below: float, good_from: float) -> int:
    return -1 if value < bad_below else 1 if value >= good_from else 0


# Each heuristic votes 1 (good), -1 (bad) or 0 (nothing).
LABELLERS: dict[str, Callable[[Profile], int]] = {
    "few_capitals": lambda p: 0 if p["words"] < 5 else between(-p["upper"], -0.4, -0.15),
    "few_symbols": lambda p: between(-p["symbols"], -0.15, -0.03),
    "few_bare_marks": lambda p: between(-p["bare"], -0.1, -0.03),
    "few_echoes": lambda p: 0 if p["words"] < 5 else between(-p["echo"], -0.15, -0.05),
    "few_runs": lambda p: 0 if p["words"] < 5 else between(-p["runs"], -0.1, -0.02),
    "common_words": lambda p: 0 if p["words"] < 20 else between(p["common"], 0.02, 0.08),
    "sentences": lambda p: 0 if p["words"] < 20 else between(p["ends"], 0.01, 0.03),
    "word_length": lambda p: -1 if not 2 <= p["length"] <= 14 else 0,
}


def pattern(text: str) -> int:
    """The votes as digits in base 3; a text without words has the votes of none but ``word_length``."""
    found = profile(text)
    votes = [vote(found) for vote in LABELLERS.values()] if found["words"] else [0] * (len(LABELLERS) - 1) + [-1]
    return sum((vote + 1) * 3 ** k for k, vote in enumerate(votes))


def pattern_column(text: Column) -> Column:
    @F.arrow_udf("int")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([pattern(t) for t in texts.to_pylist()], pa.int32())

    return of(F.coalesce(text, F.lit("")))


def votes_of(code: int) -> list[int]:
    return [code // 3 ** k % 3 for k in range(len(LABELLERS))]


def label_model(counts: dict[int, int], rounds: int = 200) -> tuple[dict[int, float], dict[str, float]]:
    """Posterior of being good per pattern, and the estimated accuracy of each heuristic on what it votes on."""
    if not counts:
        return {}, {}
    codes = sorted(counts)
    votes = np.array([votes_of(c) for c in codes])  # 0 bad, 1 nothing, 2 good
    weight = np.array([counts[c] for c in codes], float)
    # Pattern, heuristic, vote bad or good. Silence says nothing: what a heuristic is silent on, such as a short text,
    # is not more often of one class.
    onehot = np.eye(3)[votes][:, :, [0, 2]]
    # Start from heuristics that are right four times out of five, and three times surer of a defect than of its
    # absence; that fixes which class is which.
    net = (votes == 2).sum(axis=1) - 3.0 * (votes == 0).sum(axis=1)
    good = 1 / (1 + np.exp(-1.4 * net))
    for _ in range(rounds):
        by_class = []
        for share in (1 - good, good):
            mass = np.einsum("p,phv->hv", weight * share, onehot) + 1e-2 * weight.sum() ** 0.5
            by_class.append(mass / mass.sum(axis=1, keepdims=True))
        prior = np.clip((weight * good).sum() / weight.sum(), 1e-3, 1 - 1e-3)
        logs = [np.log(p) + np.einsum("phv,hv->p", onehot, np.log(m)) for p, m in zip((1 - prior, prior), by_class)]
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
        done = np.abs(new - good).max() < 1e-6
        good = new
        if done:
            break
    right = (weight[:, None] * (onehot[:, :, 1] * good[:, None] + onehot[:, :, 0] * (1 - good[:, None]))).sum(axis=0)
    cast = (weight[:, None] * onehot.sum(axis=2)).sum(axis=0)
    accuracy = {name: float(r / c) if c else 0.0 for name, r, c in zip(LABELLERS, right, cast)}
    return dict(zip(codes, good.tolist())), accuracy


_SHAPE = {**{c: "x" for c in map(chr, range(97, 123))}, **{c: "X" for c in map(chr, range(65, 91))}, **{c: "9" for c in "0123456789"}}


def slots(token: str) -> tuple[int, int]:
    """Hashed places of a word and of its shape; slots 0 and 1 are for repetition and for texts without words."""
    return short_slots(token) if len(token) <= 64 else whole_slots(token)  # long ones are not held


def whole_slots(token: str) -> tuple[int, int]:
    marks = (_SHAPE.get(c) or ("X" if c.isupper() else "x" if c.isalpha() else c) for c in token)
    shape: list[str] = []
    for mark in marks:
        if not shape or shape[-1] != mark:
            shape.append(mark)
    return tuple(2 + xxhash.xxh32_intdigest(kind + value) % (SLOTS - 2) for kind, value in (("w", token.lower()), ("s", "".join(shape))))


short_slots = lru_cache(maxsize=1 << 17)(whole_slots)


def features(text: str) -> np.ndarray:
    """Root of each slot's share of the words; for repetition the share itself."""
    tokens = text.split()
    if not tokens:
        out = np.zeros(SLOTS, np.float32)
        out[1] = 1
        return out
    counts = Counter(tokens)
    places = np.array([slots(t) for t in counts], np.int64).ravel()
    amounts = np.repeat(np.fromiter(counts.values(), float, len(counts)), 2)
    amounts[::2] *= WORD_WEIGHT
    out = np.bincount(places, amounts, SLOTS)
    out = np.sqrt(out / len(tokens))
    out[0] = sum(map(operator.eq, tokens, tokens[1:])) / len(tokens)  # one echo is no sign yet
    return out.astype(np.float32)


def sparse_features(text: Column) -> Column:
    kind = pa.struct({"at": pa.list_(pa.int32()), "value": pa.list_(pa.float32())})

    @F.arrow_udf("struct<at:array<int>,value:array<float>>")
    def of(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            found = features(text)
            at = np.flatnonzero(found)
            out.append({"at": at.astype(np.int32), "value": found[at]})
        release()
        return pa.array(out, kind)

    return of(F.coalesce(text, F.lit("")))


def train(rows: list[tuple[list[int], list[float]]], good: np.ndarray, rounds: int = 300, decay: float = 1e-4) -> np.ndarray:
    """Weights and, last, the offset of a logistic scorer on soft labels; both classes weigh the same."""
    x = np.zeros((len(rows), SLOTS + 1), np.float32)
    for row, (at, value) in zip(x, rows):
        row[at] = value
    x[:, SLOTS] = 1
    weights, pace = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)
    if not len(rows):
        return weights
    share = np.clip(good.mean(), 1e-3, 1 - 1e-3)
    importance = good / share + (1 - good) / (1 - share)
    importance /= importance.sum()
    for _ in range(rounds):  # accelerated gradient steps
        ahead = weights + 0.9 * pace
        miss = (1 / (1 + np.exp(-np.clip(x @ ahead.astype(np.float32), -30, 30))) - good) * importance
        pace = 0.9 * pace - 2.0 * (miss.astype(np.float32) @ x + decay * ahead)
        weights = weights + pace
    return weights


def score_column(text: Column, weights: np.ndarray) -> Column:
    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        raw = [float(features(t) @ weights[:SLOTS] + weights[SLOTS]) for t in texts.to_pylist()]
        release()
        return pa.array(1 / (1 + np.exp(-np.clip(np.array(raw, float), -50, 50))))

    return of(F.coalesce(text, F.lit("")))


def fit(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, dict, dict]:
    """Scorer weights, posteriors per pattern, and accuracies per heuristic."""
    text = F.col(text_col)
    patterns = docs.select(pattern_column(text).alias("votes")).groupBy("votes").count()
    counts = {r["votes"]: r["count"] for r in patterns.collect()}  # at most 3 ** 8 rows
    posterior, accuracy = label_model(counts)
    share = min(1.0, sample / max(1, sum(counts.values())))
    key = F.xxhash64(F.lit("quality"), F.col(id_col), text_hash(text))
    limit = int(share * 2**63)
    chosen = docs.select(key.alias("key"), text.alias("text"))
    chosen = chosen.filter(F.shiftrightunsigned("key", 1) < F.lit(limit)) if share < 1 else chosen
    rows = chosen.select("key", pattern_column(F.col("text")).alias("votes"), sparse_features(F.col("text")).alias("f"))
    rows = sorted(rows.collect(), key=lambda r: (r["key"], r["votes"]))  # bounded by ``sample``
    good = np.array([posterior[r["votes"]] for r in rows])
    return train([(r["f"]["at"], r["f"]["value"]) for r in rows], good), posterior, accuracy


def classify(
    docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
    into: str = "quality_score",
) -> DataFrame:
    """``docs`` with a column ``into``: the probability that the document is good.

    Null and empty texts share a feature of their own and get the same score. Repeated rows get the same score and count
    as often as they occur; null ids are fine. An empty table gives no rows. A column named like ``into`` is replaced.
    """
    weights = fit(docs, sample, id_col, text_col)[0]
    kept = [F.col(f"`{c}`") for c in docs.columns if c != into]
    return docs.select(*kept, score_column(F.col(text_col), weights).alias(into))


def keep_good(docs: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The documents that are not rejected, with their columns as they were."""
    name = free("quality_score", docs.columns)
    return classify(docs, into=name, **options).filter(F.col(name) >= threshold).drop(name)
