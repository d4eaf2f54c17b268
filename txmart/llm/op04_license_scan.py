"""License scans: winnowed template fingerprints pick candidates, banded alignment decides.

Words are lower-cased (A-Z) runs of digits, letters and non-ASCII characters. Templates are
fingerprinted by winnowing: of every ``WINNOW`` consecutive ``GRAM``-word hashes the least is
kept, so any shared run of ``GRAM + WINNOW - 1`` words shares a fingerprint. The fingerprints
form one inverted index ``hash -> (template, place)``, broadcast with the templates after
their size is checked. A document looks all its gram hashes up in the index; hits of one
template on nearby diagonals are one candidate. Each candidate is aligned with the template
inside a band around its diagonal, and again on the words before and after what that matched
while they hold hits of the candidate: notices side by side share one. The share of template
words matched in order is the coverage, and the words from the first to the last match the
span, mapped to code points of the original text. Overlapping findings keep the one with more
matched words.

One Arrow map over the scan, no shuffle; memory is one batch and the index. Defined cases:
null or empty text: no match; a template shorter than a gram is its own fingerprint as a
whole; templates without words are ignored; equal templates: the first by name wins; repeated
rows and null ids give rows like any other; empty table: no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txmart.llm.common import U64, gram_hashes, record_batch, register, table, to_arrow_schema, word_hashes, word_spans

GRAM, WINNOW = 3, 3
BAND = 8
MIN_COVERAGE = 0.8
MAX_TEMPLATE_CHARS = 4 << 20

_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_BSD_ENDORSEMENT = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission. "
)
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED "
    "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

#: fixed values: public license notices by SPDX-like name, and with ``-text`` (MIT: ``-grant``)
#: clauses that only the body of that license has, or the whole of a short one. The sentence
#: that the BSD licenses share counts as BSD-3-Clause only where neither whole text matches.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software"
    ),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "Apache-2.0-text": (
        "Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, "
        "worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly "
        "display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form."
    ),
    "GPL-2.0-text": (
        "This License applies to any program or other work which contains a notice placed by the copyright holder saying it may be distributed "
        "under the terms of this General Public License. The \"Program\", below, refers to any such program or work, and a \"work based on the "
        "Program\" means either the Program or any derivative work under copyright law: that is to say, a work containing the Program or a portion "
        "of it, either verbatim or with modifications and/or translated into another language. (Hereinafter, translation is included without "
        "limitation in the term \"modification\".)"
    ),
    "GPL-3.0-text": (
        "the special requirements of the GNU Affero General Public License, section 13, concerning interaction through a network will apply to "
        "the combination as such."
    ),
    "LGPL-3.0-text": (
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public "
        "License, supplemented by the additional permissions listed below."
    ),
    "MPL-2.0-text": (
        "Each Contributor hereby grants You a world-wide, royalty-free, non-exclusive license: (a) under intellectual property rights (other than "
        "patent or trademark) Licensable by such Contributor to use, reproduce, make available, modify, display, perform, distribute, and "
        "otherwise exploit its Contributions, either on an unmodified basis, with Modifications, or as part of a Larger Work; "
        "and (b) under Patent Claims of such Contributor to make, use, sell, offer for sale, have made, import, and otherwise transfer either its "
        "Contributions or its Contributor Version."
    ),
    "BSD-2-Clause-text": _BSD_CONDITIONS + _BSD_DISCLAIMER,
    "BSD-3-Clause-text": _BSD_CONDITIONS + _BSD_ENDORSEMENT + _BSD_DISCLAIMER,
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

#: bytes to themselves, A-Z to a-z, any other ASCII byte to a blank
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def folded(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass").translate(_FOLD)


def winnow(grams: np.ndarray, window: int = WINNOW) -> np.ndarray:
    """Places of the (rightmost) least hash of every ``window`` consecutive ones."""
    size = min(window, len(grams))
    if not size:
        return np.zeros(0, dtype=np.int64)
    view = np.lib.stride_tricks.sliding_window_view(grams, size)
    return np.unique(size - 1 - view[:, ::-1].argmin(axis=1) + np.arange(len(view)))


class Index:
    """Templates as word hashes, and the sorted inverted index of their fingerprints."""

    def __init__(self, templates: Iterable[tuple[str, str]], gram: int = GRAM, window: int = WINNOW):
        self.names, self.words, self.gram = [], [], gram
        keys, owners, places = [], [], []
        for name, text in sorted(templates):
            words = word_hashes(folded(text))
            if not len(words) or any(np.array_equal(words, w) for w in self.words):
                continue
            grams = gram_hashes(words, min(gram, len(words)))
            spots = winnow(grams, window)
            keys.append(grams[spots])
            owners.append(np.full(len(spots), len(self.words)))
            places.append(spots)
            self.names.append(name)
            self.words.append(words)
        keys = np.concatenate(keys) if keys else np.zeros(0, dtype=U64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.owner = np.concatenate(owners)[order] if len(keys) else np.zeros(0, dtype=np.int64)
        self.place = np.concatenate(places)[order] if len(keys) else np.zeros(0, dtype=np.int64)
        self.sizes = sorted({min(gram, len(w)) for w in self.words})

    def hits(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        """(template, place in it, place in the document) of shared fingerprints."""
        out = []
        for size in self.sizes:
            grams = gram_hashes(words, size)
            lo, hi = np.searchsorted(self.keys, grams, "left"), np.searchsorted(self.keys, grams, "right")
            for at in np.flatnonzero(hi > lo):
                out += [(int(self.owner[i]), int(self.place[i]), int(at)) for i in range(lo[at], hi[at])]
        return sorted(set(out))


def candidates(hits: list[tuple[int, int, int]], band: int) -> list[tuple[int, int]]:
    """(template, diagonal) of groups of hits whose diagonals lie within the band."""
    out: list[tuple[int, int]] = []
    diagonals: dict[int, list[int]] = {}
    for owner, place, at in hits:
        diagonals.setdefault(owner, []).append(at - place)
    for owner, values in diagonals.items():
        group: list[int] = []
        for d in sorted(set(values)) + [None]:
            if group and (d is None or d - group[0] > band):
                out.append((owner, group[len(group) // 2]))
                group = []
            if d is not None:
                group.append(d)
    return out


def align(template: np.ndarray, words: np.ndarray, diagonal: int, band: int) -> list[int]:
    """Document places matched, in order, by the best alignment within the band: a match
    scores 2, a word left out on either side costs 1, document ends are free."""
    n, width = len(template), 2 * band + 1
    first = max(diagonal - band, 0)
    for j in (first + np.flatnonzero(words[first : max(diagonal + band + 1, 0)] == template[0])).tolist():
        if np.array_equal(words[j : j + n], template):  # no alignment scores more, and the table prefers the first
            return list(range(j, j + n))
    place = diagonal - band - 1 + np.arange(n + width)  # of the document's word before each cell, by template words used + offset
    inside = (place >= 0) & (place < len(words))
    line = np.zeros(n + width, dtype=words.dtype)
    line[inside] = words[place[inside]]
    rows = lambda x: np.lib.stride_tricks.sliding_window_view(x, width)
    gain = np.where((rows(line)[1:] == template[:, None]) & rows(inside)[1:], 2.0, -np.inf)
    open_ = rows((place >= -1) & (place < len(words)))
    offset = np.arange(width)
    score = np.where(open_[0], 0.0, -np.inf)
    move = np.zeros((n + 1, width), dtype=np.int8)  # 1 match, 2 skip template word, 3 skip document word, 0 start
    skip = np.full(width, -np.inf)
    for i in range(1, n + 1):
        match = score + gain[i - 1]
        skip[:-1] = score[1:] - 1
        best = np.maximum(match, skip)
        score = np.where(open_[i], np.maximum.accumulate(best + offset) - offset, -np.inf)
        move[i] = np.where(score > best, 3, np.where(skip > match, 2, 1))
    i, k = n, int(score.argmax())
    if score[k] == -np.inf:
        return []
    out = []
    while move[i, k]:
        how = move[i, k]
        if how == 1:
            out.append(diagonal - band + i + k - 1)
            i -= 1
        elif how == 2:
            i, k = i - 1, k + 1
        else:
            k -= 1
    return out[::-1]


def alignments(template: np.ndarray, words: np.ndarray, diagonal: int, band: int, spots: np.ndarray, gram: int) -> Iterator[list[int]]:
    """The best alignment within the band, then those of the words before and after it, as
    long as a hit of the band (``spots``: their places in the document, sorted) lies in them."""
    size = min(gram, len(template))
    todo = [(0, len(words))]
    while todo:
        lo, hi = todo.pop()
        if np.searchsorted(spots, lo) >= np.searchsorted(spots, hi - size, "right"):
            continue
        places = [lo + x for x in align(template, words[lo:hi], diagonal - lo, band)]
        if places:
            yield places
            todo += [(lo, places[0]), (places[-1] + 1, hi)]


def scan_text(index: Index, text: str | None, band: int = BAND, least: float = MIN_COVERAGE) -> list[tuple[int, int, str, float]]:
    """(start, end, name, coverage) of the licenses in a text, by start."""
    data = folded(text)
    words = word_hashes(data)
    found = []
    hits = index.hits(words)
    own: dict[int, np.ndarray] = {}  # template -> (diagonal, place) of its hits, by diagonal
    if hits:
        owner, place, at = np.array(hits, dtype=np.int64).T
        own = {o: np.array(sorted(zip((at - place)[owner == o].tolist(), at[owner == o].tolist()))) for o in np.unique(owner).tolist()}
    for owner, diagonal in candidates(hits, band):
        near = own[owner]
        a, b = np.searchsorted(near[:, 0], [diagonal - band, diagonal + band + 1])
        for places in alignments(index.words[owner], words, diagonal, band, np.sort(near[a:b, 1]), index.gram):
            if len(places) >= least * len(index.words[owner]):
                found.append((-len(places), -len(places) / len(index.words[owner]), places[0], places[-1], owner))
    if not found:
        return []
    taken, out = np.zeros(len(words), dtype=bool), []
    raw, start, end = word_spans(data)
    point = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))  # code points before each byte
    for _, share, first, last, owner in sorted(found):
        if not taken[first : last + 1].any():
            taken[first : last + 1] = True
            out.append((int(point[start[first]]), int(point[end[last]]), index.names[owner], round(-share, 4)))
    return sorted(out)


def scan(docs: DataFrame, templates: dict[str, str] | None = None, band: int = BAND, least: float = MIN_COVERAGE) -> DataFrame:
    """One row per document: ``doc_id`` and ``found``, structs ``start, end, license, coverage``."""
    templates = TEMPLATES if templates is None else templates
    if sum(map(len, templates.values())) > MAX_TEMPLATE_CHARS:
        raise ValueError(f"templates are broadcast only up to {MAX_TEMPLATE_CHARS} characters")
    shared = docs.sparkSession.sparkContext.broadcast(sorted(templates.items()))
    picked = docs.select("doc_id", F.col("text").alias("__text"))
    found = T._parse_datatype_string("found array<struct<start:long,end:long,license:string,coverage:double>>")
    schema = T.StructType(picked.schema.fields[:1] + found.fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(shared.value)
        names = ("start", "end", "license", "coverage")
        for b in batches:
            rows = [[dict(zip(names, x)) for x in scan_text(index, t, band, least)] for t in b.column("__text").to_pylist()]
            yield record_batch([b.column(0), rows], arrow)

    return picked.mapInArrow(run, schema)


@register("op4_license_scan")
def op4_license_scan(spark, sf_dir):
    """Every whole text of the documents against the default templates."""
    found = scan(table(spark, sf_dir, "documents"))
    span = lambda x: F.concat_ws(":", x["license"], x["start"].cast("string"), x["end"].cast("string"), x["coverage"].cast("string"))
    return found.select(
        "doc_id", F.size("found").cast("long").alias("n_matches"), F.array_join(F.array_sort(F.array_distinct(F.col("found.license"))), ",").alias("licenses"),
        F.array_join(F.transform("found", span), ",").alias("spans"),
    )
