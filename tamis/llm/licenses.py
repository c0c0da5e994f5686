"""License scan: MinHash bands over overlapping text windows retrieve templates, shingle containment verifies them.

A text's five-word shingles are cut into blocks a quarter longer than the template, and two neighbouring blocks are a
window, so windows overlap by half and every occurrence of a template of S shingles lies in one of them. Template and
window are compared by MinHash with one value per band. If a window holds at least ``containment`` of a template, their
resemblance is at least J = c S / (2.5 S + (1 - c) S), and with b bands at least one agrees with probability
1 - (1 - J) ** b; b is set so that this is ``probability`` or more. Every retrieved pair is then verified exactly, on the
window and one block on either side.

Documents are read once, whole, and never shuffled. Templates are a parameter, a list of texts of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import Rolling, mix, pieces
from tamis.llm.decontaminate import split_words

SHINGLE, CONTAINMENT, PROBABILITY = 5, 0.8, 0.9999

# Notices as their licenses word them.
TEMPLATES = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "MIT line": "Released under the MIT License.",
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:"),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
        "KIND, either express or implied."),
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:"),
}

MATCHES = "array<struct<license:string,containment:double,first_word:int,n_words:int>>"
MATCHES_ARROW = pa.list_(pa.struct({
    "license": pa.string(), "containment": pa.float64(), "first_word": pa.int32(), "n_words": pa.int32()}))


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all shingles, the number of shingles before each text (and in all), and words per text.

    A text of fewer words than a shingle has none.
    """
    words = split_words(texts)
    counts = np.diff(words.first)
    of_text = np.maximum(counts - SHINGLE + 1, 0)
    first = np.concatenate(([0], np.cumsum(of_text)))
    starts = np.arange(first[-1]) + np.repeat(words.first[:-1] - first[:-1], of_text)
    return Rolling(words.hashes).of(starts, starts + SHINGLE), first, counts


def bands_for(containment: float, probability: float) -> int:
    resemblance = containment / (2.5 + 1 - containment)
    return math.ceil(math.log(1 - probability) / math.log(1 - resemblance))


class Templates:
    def __init__(self, texts: Mapping[str, str], containment: float, probability: float):
        self.names, self.containment = list(texts), containment
        hashes, first, words = shingles(pa.array([texts[n] for n in self.names], pa.large_string()))
        if len(words) and words.min() < SHINGLE:
            raise ValueError(f"a template needs at least {SHINGLE} words")
        self.hashes = [np.unique(hashes[a:b]) for a, b in zip(first[:-1], first[1:])]
        self.words = words
        bands = bands_for(containment, probability)
        # Products with odd numbers permute 64-bit values.
        self.factors = mix(np.arange(1, bands + 1, dtype=np.uint64)) | np.uint64(1)
        self.signatures = [(h[None, :] * self.factors[:, None]).min(axis=1) for h in self.hashes]
        self.by_block: dict[int, list[int]] = {}
        for t, (a, b) in enumerate(zip(first[:-1], first[1:])):
            self.by_block.setdefault(math.ceil(1.25 * (b - a)), []).append(t)


def block_starts(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start of every block and the text it belongs to."""
    per_text = -(-np.diff(first) // size)
    before = np.cumsum(per_text) - per_text
    text = np.repeat(np.arange(len(per_text)), per_text)
    return (np.arange(per_text.sum()) - before[text]) * size + first[text], text


def scan(texts: pa.Array, templates: Templates) -> list[list[dict]]:
    hashes, first, _ = shingles(texts)
    out: list[list[dict]] = [[] for _ in range(len(texts))]
    if not len(hashes):
        return out
    blocks = {size: block_starts(first, size) for size in templates.by_block}
    retrieved: set[tuple[int, int, int]] = set()
    for band, factor in enumerate(templates.factors):
        values = hashes * factor
        for size, members in templates.by_block.items():
            starts, text = blocks[size]
            lowest = np.minimum.reduceat(values, starts)
            window = lowest.copy()
            joined = text[1:] == text[:-1]
            window[:-1][joined] = np.minimum(lowest[:-1], lowest[1:])[joined]
            for t in members:
                for at in np.flatnonzero(window == templates.signatures[t][band]).tolist():
                    retrieved.add((t, size, at))
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    for t, size, at in sorted(retrieved):
        starts, text = blocks[size]
        doc = int(text[at])
        low, high = max(first[doc], starts[at] - size), min(first[doc + 1], starts[at] + 3 * size)
        region = hashes[low:high]
        hit = np.flatnonzero(np.isin(region, templates.hashes[t]))
        share = len(np.unique(region[hit])) / len(templates.hashes[t])
        if share >= templates.containment and share > best.get((doc, t), (0.0,))[0]:
            begin = int(low + hit[0] - first[doc])
            best[doc, t] = (share, begin, int(hit[-1] - hit[0]) + SHINGLE)
    for (doc, t), (share, begin, words) in sorted(best.items()):
        out[doc].append({"license": templates.names[t], "containment": share, "first_word": begin, "n_words": words})
    return out


def find_licenses(
    docs: DataFrame, texts: Mapping[str, str] | None = None, containment: float = CONTAINMENT,
    probability: float = PROBABILITY, text_col: str = "text", into: str = "licenses",
) -> DataFrame:
    """``docs`` with a column ``into``: per template found, its name, the share of its shingles, and where it is.

    Words are runs of digits, letters and characters beyond ASCII, in lower case. Null and empty texts and those of
    fewer than five words hold nothing. Of several occurrences the best is given, of equal ones the first. Repeated rows
    are judged one by one, ids play no part, and an empty table gives no rows. Without templates nothing is found.
    """
    known = Templates(TEMPLATES if texts is None else texts, containment, probability)

    @F.arrow_udf(MATCHES)
    def of(batch: pa.Array) -> pa.Array:
        return pa.array([x for piece in pieces(batch) for x in scan(piece, known)], MATCHES_ARROW)

    kept = [F.col(f"`{c}`") for c in docs.columns if c != into]
    return docs.select(*kept, of(F.coalesce(F.col(text_col), F.lit(""))).alias(into))
