"""Licence scan by patience alignment with licence templates.

Words that occur once in the text window and once in the template anchor the
alignment; the longest increasing subsequence of anchors is kept, and the gaps
between them are aligned in the same way, down to gaps without unique common
words, which a longest common subsequence aligns.  Coverage is the share of
template words aligned.

A document is only aligned with templates that it could cover well enough:
the multiset intersection of words bounds the coverage from above.  An
alignment at the threshold holds one of the template's positions that are rarest
in the document, if one more of them is taken than it may leave out; windows
around their occurrences (half a template of inserted words on each side) keep
an alignment local, so several copies and long documents do no harm.  One pass without
a shuffle; the templates are a fixed small list.

Defined cases: null and empty texts have no licence; equal coverages go to the
template listed first; extra columns are ignored.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureforge.llm.words import NON_ALNUM, Words, blocks

THRESHOLD = 0.8

# Licence notices and short licence texts.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3",
    "MIT notice": "Released under the MIT License",
    "All rights reserved": "All rights reserved",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
           "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
           "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
           "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
           "following conditions: The above copyright notice and this permission notice shall be included in all "
           "copies or substantial portions of the Software.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
           "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met: 1. Redistributions of source code must retain "
                    "the above copyright notice, this list of conditions and the following disclaimer. 2. "
                    "Redistributions in binary form must reproduce the above copyright notice, this list of "
                    "conditions and the following disclaimer in the documentation and/or other materials provided "
                    "with the distribution.",
    "Apache-2.0 header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                         "except in compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
                         "in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                         "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
                         "for the specific language governing permissions and limitations under the License.",
    "GPL-3.0 header": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                      "GNU General Public License as published by the Free Software Foundation, either version 3 of "
                      "the License, or (at your option) any later version.",
}


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of pairs (sorted by first) with rising seconds, by
    patience piles."""
    tops, last, back = [], [], {}
    for k, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        back[k] = last[pile - 1] if pile else None
        if pile == len(tops):
            tops.append(b)
            last.append(k)
        else:
            tops[pile], last[pile] = b, k
    out, k = [], last[-1] if last else None
    while k is not None:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def common_pairs(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Positions of a longest common subsequence."""
    best = np.zeros((len(a) + 1, len(b) + 1), np.int32)
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i, j] = best[i + 1, j + 1] + 1 if a[i] == b[j] else max(best[i + 1, j], best[i, j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1, j] >= best[i, j + 1]:
            i += 1
        else:
            j += 1
    return out


def patience(text: list[int], template: list[int], t0: int = 0, p0: int = 0) -> list[tuple[int, int]]:
    """Aligned (text, template) positions."""
    if not text or not template:
        return []
    n, m = Counter(text), Counter(template)
    place = {w: j for j, w in enumerate(template) if m[w] == 1}
    anchors = increasing([(i, place[w]) for i, w in enumerate(text) if n[w] == 1 and w in place])
    if not anchors:
        present = [i for i, w in enumerate(text) if w in m]
        return [(present[i] + t0, j + p0) for i, j in common_pairs([text[i] for i in present], template)]
    out, i, j = [], 0, 0
    for a, b in [*anchors, (len(text), len(template))]:
        out += patience(text[i:a], template[j:b], t0 + i, p0 + j)
        if a < len(text):
            out.append((t0 + a, p0 + b))
        i, j = a + 1, b + 1
    return out


def best_alignment(text: np.ndarray, template: list[int], threshold: float = THRESHOLD) -> tuple[int, int, int]:
    """Most template words aligned in any local window, with the first and last
    aligned text word; alignments under the threshold may be missed."""
    need, length = Counter(template), len(template)
    have = Counter(text[text > 0].tolist())
    least = math.ceil(threshold * length - 1e-9)
    slack = length // 2 + 2
    # An alignment at the threshold leaves out length - least positions, so it has one of any length - least + 1.
    rare = sorted(range(length), key=lambda j: (have[template[j]], j))[:length - least + 1]
    windows: list[tuple[int, int]] = []
    places = {w: np.flatnonzero(text == w).tolist() for w in {template[j] for j in rare} if have[w]}
    for a, b in sorted({(max(i - j - slack, 0), i + length - j + slack) for j in rare for i in places.get(template[j], ())}):
        if windows and a - windows[-1][0] <= slack // 2:
            windows[-1] = (windows[-1][0], max(b, windows[-1][1]))
        else:
            windows.append((a, b))
    best = (0, 0, 0)
    for a, b in windows:
        part = text[a:b].tolist()
        if sum((Counter(part) & need).values()) < max(best[0], least, 1):
            continue
        pairs = patience(part, template, a)
        found = (len(pairs), pairs[0][0], pairs[-1][0])
        if (found[0], found[1] - found[2]) > (best[0], best[1] - best[2]):
            best = found
            if best[0] == length == best[2] - best[1] + 1:
                break
    return best


class Catalogue:
    """Templates as word numbers (0 is any other word)."""

    def __init__(self, templates: dict[str, str]):
        words = Words(pa.array(list(templates.values()), pa.string()), True, NON_ALNUM)
        self.names = list(templates)
        self.vocabulary = words.distinct
        self.templates = [(words.index[a:b] + 1).tolist() for a, b in zip(words.first[:-1], words.first[1:])]
        self.need = np.array([np.bincount(t, minlength=len(self.vocabulary) + 1) for t in self.templates])

    def scan(self, column, threshold: float) -> tuple[np.ndarray, list[list[dict]]]:
        words = Words(column, True, NON_ALNUM)
        size = len(self.vocabulary) + 1
        known = pc.fill_null(pc.index_in(words.distinct, value_set=self.vocabulary), -1).to_numpy() + 1
        text = known[words.index] if len(words.index) else np.zeros(0, np.int64)
        at = np.flatnonzero(text)
        counts = np.bincount(words.doc_of()[at] * size + text[at], minlength=words.n_docs * size).reshape(-1, size)
        found: list[list[dict]] = [[] for _ in range(words.n_docs)]
        for k, template in enumerate(self.templates):
            possible = np.minimum(counts, self.need[k]).sum(axis=1) >= threshold * len(template)
            for d in np.flatnonzero(possible).tolist():
                n, first, last = best_alignment(text[words.first[d]:words.first[d + 1]], template,
                                                threshold)
                if n >= threshold * len(template):
                    found[d].append({"license": self.names[k], "coverage": n / len(template), "n_words": n,
                                     "first": first, "last": last})
        return words.counts(), found


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``n_words`` and ``licenses``: name, coverage, aligned words, first and
    last aligned text word of each template covered to ``threshold``."""
    catalogue = Catalogue(templates or TEMPLATES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("n_words", pa.int64()),
                                   ("first", pa.int64()), ("last", pa.int64())]))
        for batch in batches:
            for block in blocks(batch, "t"):
                n, found = catalogue.scan(block.column("t"), threshold)
                yield pa.RecordBatch.from_arrays([block.column("k"), pa.array(n), pa.array(found, kind)],
                                                 ["k", "n_words", "licenses"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t"))
            .mapInArrow(run, f"k {kind}, n_words long, licenses array<struct<license: string, coverage: double, "
                             "n_words: long, first: long, last: long>>").withColumnRenamed("k", id_col))
