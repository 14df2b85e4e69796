"""License scans: an exact containment join of text blocks with license templates.

Tokens are put in one global order, rarest in the corpus first. A block can contain a share ``threshold``
of a template only if it holds one of the template's first ``m - ceil(threshold * m) + 1`` tokens (prefix),
has enough known tokens at all (length), and enough tokens after the first shared one on both sides
(position). What passes is verified by counting the shared tokens. Blocks follow the size of the template.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbwatch.llm.common import add_by_shard, in_shards, small_batches, utf8, words_of

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Label, words that tell the license from others and must stand together in the block, and the text: notices as works
#: state them, and whole texts of short licenses. Fixed values.
TEMPLATES = (
    ("apache-2.0", "apache license", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0",
        "apache license",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ),
    ("bsd", "bsd license", "Released under the BSD License"),
    (
        "bsd",
        "source and binary forms",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
        "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
        "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
        "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    ("cc-by", "attribution 4 0 international", "Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "by nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "attribution noncommercial", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "by sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "attribution sharealike", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl", "gnu general public license", "This work is licensed under the GNU General Public License"),
    (
        "gpl",
        "gnu general public license",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details.",
    ),
    (
        "isc",
        "with or without fee",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES "
        "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
        "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE.",
    ),
    ("mit", "mit license", "Released under the MIT License"),
    ("mit", "mit license", "Licensed under the MIT License"),
    (
        "mit",
        "sublicense and or sell",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
        "SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("mpl-2.0", "mozilla public license", "subject to the terms of the Mozilla Public License"),
    (
        "mpl-2.0",
        "mozilla public license",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
)
FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.ArrayType(T.StringType())),
    T.StructField("labels", T.ArrayType(T.StringType())),
    T.StructField("score", T.DoubleType()),
]


Templates = Sequence[tuple[str, str, str]]
MIN_HALF = 8


def half_block(text: str) -> int:
    """Words of half a block for a template: the least power of two, 8 or more, that takes all its words."""
    n = len(words_of(text.encode()))
    return max(MIN_HALF, 1 << max(0, n - 1).bit_length())


def _template_words(templates: Templates) -> list[tuple[str, set[bytes], list[bytes], int]]:
    return [(label, set(words_of(text.encode())), words_of(needed.encode()), half_block(text)) for label, needed, text in templates]


def token_counts(documents: DataFrame, text: str, vocabulary: set[bytes], shard_bytes: int = 4_000_000) -> DataFrame:
    """How often each token of the vocabulary occurs in all texts, counted per partition before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {w: i + 1 for i, w in enumerate(sorted(vocabulary))}
        total = np.zeros(len(number) + 1, np.int64)
        for shard in in_shards(batches, "text", shard_bytes):
            for t in utf8(shard.column("text")):
                total += np.bincount([number.get(w, 0) for w in words_of(t or b"")], minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in number]), pa.array(total[1:])], ["token", "n"])

    small_batches(documents.sparkSession)
    counted = documents.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "token string, n long")
    return counted.groupBy("token").agg(F.sum("n").alias("n"))


def _places(ids: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Where the words of a phrase stand one after another."""
    n = len(ids) - len(phrase) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.logical_and.reduce([ids[i : i + n] == w for i, w in enumerate(phrase)]))


class Matcher:
    """Templates and phrases over token numbers in the global order; numbers start at 1, 0 is any other word."""

    def __init__(self, order: list[bytes], templates: Templates, phrases: Mapping[str, str], threshold: float):
        self.number = {w: i + 1 for i, w in enumerate(order)}
        self.phrases = [(np.array([self.number[w] for w in p.encode().split()]), v) for p, v in phrases.items()]
        self.templates: list[tuple[str, dict[int, int], int, np.ndarray]] = []
        self.by_token: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))  # half: token: templates
        for label, words, required, half in _template_words(templates):
            if not words.issuperset(required):
                raise ValueError(f"required words of {label!r} are missing from its text")
            tokens = sorted(self.number[w] for w in words)
            need = math.ceil(threshold * len(tokens) - 1e-9)
            for t in tokens[: len(tokens) - need + 1]:
                self.by_token[half][t].append(len(self.templates))
            place = {t: i for i, t in enumerate(tokens)}
            self.templates.append((label, place, need, np.array([self.number[w] for w in required])))
        self.by_token = {half: dict(lists) for half, lists in self.by_token.items()}
        self.in_prefix = {half: np.zeros(len(order) + 1, bool) for half in self.by_token}
        for half, lists in self.by_token.items():
            self.in_prefix[half][list(lists)] = True

    def bases(self, ids: np.ndarray) -> tuple[list[int], set[str]]:
        starts, labels = [], set()
        for words, label in self.phrases:
            at = _places(ids, words)
            starts += at.tolist()
            labels.update([label] if len(at) else [])
        return starts, labels

    def contained(self, ids: np.ndarray) -> dict[str, float]:
        """Template labels with their best containment over the blocks that reach the threshold."""
        best: dict[str, float] = {}
        for half, lists in self.by_token.items():
            candidates: dict[int, set[int]] = defaultdict(set)
            last = max(0, math.ceil(len(ids) / half) - 2)
            for at in np.flatnonzero(self.in_prefix[half][ids]).tolist():
                for b in range(max(0, at // half - 1), min(last, at // half) + 1):
                    candidates[b].update(lists[int(ids[at])])
            for b, templates in candidates.items():
                inside = ids[b * half : (b + 2) * half]
                held = np.unique(inside)
                held = held[held > 0].tolist()
                for label, place, need, required in (self.templates[i] for i in templates):
                    if len(held) < need:
                        continue
                    j = next(j for j, t in enumerate(held) if t in place)
                    if min(len(place) - place[held[j]], len(held) - j) < need:
                        continue
                    shared = sum(t in place for t in held)
                    if shared >= need and len(_places(inside, required)):
                        best[label] = max(best.get(label, 0.0), shared / len(place))
        return best


def scan_licenses(
    documents: DataFrame,
    text: str = "text",
    templates: Templates = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    threshold: float = 0.8,
    shard_bytes: int = 4_000_000,
) -> DataFrame:
    """``documents`` with places of fixed phrases, license labels and a score.

    For a template a text is covered by blocks of twice ``half_block`` words, each starting half a block after the one
    before, so a notice of up to half a block lies in one block whole, and words scattered beyond are no notice. A block
    has the label if it holds a share ``threshold`` of the template's different words and its required ones together,
    which tell it from licenses of like wording. Templates are a parameter of any length, not data; the tokens counted and
    sent to the executors are theirs alone. ``score`` is 1 with a phrase, else the best containment, else 0.

    Null is an empty text: no words, nothing found, positions null. Repeated rows are reported each; ties in
    token frequency are broken by the token. An empty table gives an empty result. Input columns named like a
    result are replaced.
    """
    words = _template_words(templates)
    vocabulary = set().union(*(w for _, w, _, _ in words), *(p.encode().split() for p in phrases))
    counts = {r.token.encode(): r.n for r in token_counts(documents, text, vocabulary, shard_bytes).collect()}
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    matcher = Matcher(order, templates, phrases, threshold)

    def compute(shard: pa.RecordBatch) -> list[pa.Array]:
        rows = []
        for t in utf8(shard.column(text)):
            found = words_of(t or b"")
            ids = np.fromiter((matcher.number.get(w, 0) for w in found), np.int64, len(found))
            starts, base = matcher.bases(ids)
            best = matcher.contained(ids)
            score = 1.0 if starts else max(best.values(), default=0.0)
            ends = (min(starts), max(starts)) if starts else (None, None)
            rows.append((len(ids), len(starts), *ends, sorted(base), sorted(base | set(best)), score))
        long, strings = pa.int64(), pa.list_(pa.string())
        kinds = (long, long, long, long, strings, strings, pa.float64())
        return [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]

    return add_by_shard(documents, text, FIELDS, compute, shard_bytes)
