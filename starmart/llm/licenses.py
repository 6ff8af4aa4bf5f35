"""License scans by winnowed fingerprints and banded alignment (operator 3).

Templates are cut into word grams, of which winnowing keeps the least hash of each window;
the fingerprints form an inverted index. All grams of a text are looked up there, so that a template
of three words is found too, and give candidates: a template and a stretch of the text. Those that
share enough words with their template are aligned with it word by word within a band around the
diagonal of the hits, and the alignment says how much of the template is there, and where. A find
within the span of a larger one, such as a license's name in its own notice, is part of that one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.llm.common import table

AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING '
    "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
)
MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    'software and associated documentation files (the "Software"), to deal in the Software '
    "without restriction, including without limitation the rights to use, copy, modify, "
    "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following "
    "conditions: The above copyright notice and this permission notice shall be included in "
    "all copies or substantial portions of the Software."
)
BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met: 1. Redistributions of source "
    "code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this "
    "list of conditions and the following disclaimer in the documentation and/or other materials "
    "provided with the distribution. "
)
BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR '
    "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY "
    "AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
    "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
    "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
    "POSSIBILITY OF SUCH DAMAGE."
)
#: Wordings of licenses, as they stand in files.
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "MIT-line": "Released under the MIT License.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "All-rights-reserved": "All rights reserved.",
    "MIT-grant": MIT_GRANT,
    "MIT": (
        f"{MIT_GRANT} {AS_IS} NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
        "License for the specific language governing permissions and limitations under the License."
    ),
    "GPL-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "General Public License for more details."
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."
    ),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License, or (at your option) any later version. This library is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "Lesser General Public License for more details."
    ),
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source "
        "code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer."
    ),
    "BSD-2-Clause": f"{BSD_CONDITIONS} {BSD_DISCLAIMER}",
    "BSD-3-Clause": (
        f"{BSD_CONDITIONS} 3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without "
        f"specific prior written permission. {BSD_DISCLAIMER}"
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR "
        "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
        "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
        "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event "
        "will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions: 1. The origin of this software must not be misrepresented; you must not claim "
        "that you wrote the original software. If you use this software in a product, an "
        "acknowledgment in the product documentation would be appreciated but is not required. 2. "
        "Altered source versions must be plainly marked as such, and must not be misrepresented as "
        "being the original software. 3. This notice may not be removed or altered from any source "
        "distribution."
    ),
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a "
        "copy of the software and accompanying documentation covered by this license (the "
        '"Software") to use, reproduce, display, distribute, execute, and transmit the Software, and '
        "to prepare derivative works of the Software, and to permit third-parties to whom the "
        "Software is furnished to do so, all subject to the following: The copyright notices in the "
        "Software and this entire statement, including the above license grant, this restriction and "
        "the following disclaimer, must be included in all copies of the Software, in whole or in "
        "part, and all derivative works of the Software, unless such copies or derivative works are "
        "solely in the form of machine-executable object code generated by a source language "
        f"processor. {AS_IS} TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR "
        "ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
        "USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to "
        "copy, modify, publish, use, compile, sell, or distribute this software, either in source "
        "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
        "means."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/."
    ),
    "CC-BY-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License."
    ),
    "CC-BY-SA-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License."
    ),
    "CC0-1.0": (
        "To the extent possible under law, the person who associated CC0 with this work has waived "
        "all copyright and related or neighboring rights to this work."
    ),
}
#: Words of a gram and grams of a window: any run of GRAM + WINNOW - 1 words of a template is found.
GRAM, WINNOW = 3, 2
#: Fingerprints that every task may hold; more templates are scanned for in parts, one scan each.
MAX_INDEX = 200_000
COVERAGE = 0.75
REMEMBERED = 1 << 18
ODD = np.uint64(0x9E3779B97F4A7C15)
WORD = re.compile(r"[^\W_]+")


class WordHashes(dict):
    """Hashes of words, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def grams_of(words: list[str], hashes: WordHashes) -> np.ndarray:
    n = len(words) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    one = np.array([hashes[w] for w in words], np.uint64)
    grams = one[:n].copy()
    for j in range(1, GRAM):
        grams *= ODD
        grams += one[j : j + n]
    return grams ^ (grams >> np.uint64(31))


def winnow(grams: np.ndarray) -> np.ndarray:
    """Places of the grams that winnowing keeps."""
    if len(grams) < WINNOW:
        return np.arange(len(grams))
    windows = np.lib.stride_tricks.sliding_window_view(grams, WINNOW)
    return np.unique(np.arange(len(windows)) + windows.argmin(axis=1))


def band_of(template: list[str]) -> int:
    return max(1, min(8, len(template) // 3))


def align(template: list[str], words: list[str], lead: int, reach: int) -> tuple[int, int, int]:
    """Most words of the template met in order within the band: count, first, stop.

    The template's word ``i`` may meet words ``i + lead`` to ``i + lead + reach``. A skipped
    or changed word costs a fraction of a match; ends of ``words`` are free.
    """
    none = (0.0, 0, -1, -1)
    above: dict[int, tuple] = {j: none for j in range(max(0, lead + reach) + 1)}
    for i, want in enumerate(template):
        row: dict[int, tuple] = {}
        for j in range(max(0, i + lead), min(len(words), i + lead + reach + 1) + 1):
            best = above.get(j, none)
            best = (best[0] - 0.3, *best[1:])
            if j > 0:
                if (left := row.get(j - 1)) is not None and left[0] - 0.3 > best[0]:
                    best = (left[0] - 0.3, *left[1:])
                score, n, first, _ = above.get(j - 1, none)
                if words[j - 1] == want:
                    step = (score + 1, n + 1, j - 1 if first < 0 else first, j)
                else:
                    step = (score - 0.3, n, first, above.get(j - 1, none)[3])
                if step[0] > best[0]:
                    best = step
            row[j] = best
        above = row
    score, n, first, stop = max(above.values(), default=none)
    return n, first, stop


class Find(NamedTuple):
    start_word: int
    end_word: int
    template: str
    matched_words: int
    coverage: float


class Index:
    """The winnowed fingerprints of some templates: where in which template each stands."""

    def __init__(self, templates: dict[str, list[str]]) -> None:
        self.names = sorted(templates)
        self.words = [templates[n] for n in self.names]
        self.bags = [Counter(w) for w in self.words]
        self.places: dict[int, list[tuple[int, int]]] = {}
        for t, words in enumerate(self.words):
            grams = grams_of(words, WordHashes())
            for at in winnow(grams):
                self.places.setdefault(int(grams[at]), []).append((t, int(at)))
        self.known = np.array(sorted(self.places), np.uint64)

    def stretches(self, grams: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Template, and first and last diagonal of a band around hits that lie close together.

        A band is cut when it is as wide as its template; the next one overlaps it.
        """
        near = np.minimum(np.searchsorted(self.known, grams), len(self.known) - 1)
        hit = np.flatnonzero(self.known[near] == grams)
        found = sorted((t, int(k) - at) for k in hit for t, at in self.places[int(grams[k])])
        k = 0
        while k < len(found):
            t, low = found[k]
            band, high = band_of(self.words[t]), low
            while k < len(found) and found[k][0] == t and found[k][1] - high <= band:
                if found[k][1] - low > len(self.words[t]):
                    break
                high = found[k][1]
                k += 1
            yield t, low - band, high + band

    def finds(self, words: list[str], hashes: WordHashes, coverage: float) -> list[Find]:
        """What stands in a text, without what lies within something larger."""
        found = []
        for t, low, high in self.stretches(grams_of(words, hashes)):
            wanted, start = self.words[t], max(0, low)
            part = words[start : high + len(wanted)]
            # no alignment meets more words than both have
            if (self.bags[t] & Counter(part)).total() < coverage * len(wanted):
                continue
            n, first, stop = align(wanted, part, min(0, low), high - low)
            if n >= coverage * len(wanted):
                share = n / len(wanted)
                found.append(Find(start + first, start + stop, self.names[t], n, share))
        return outermost(found)


def outermost(found: list[Find]) -> list[Find]:
    """Finds that lie within no other; of several over the same words the most complete stays."""
    kept, reach = [], -1
    for f in sorted(found, key=lambda f: (f.start_word, -f.end_word, -f.coverage, f.template)):
        if f.end_word > reach:
            kept.append(f)
            reach = f.end_word
    return kept


def parts_of(templates: dict[str, list[str]], most: int) -> list[dict[str, list[str]]]:
    """Templates dealt into indexes of at most ``most`` fingerprints, or of one template."""
    parts, room = [], 0
    for name in sorted(templates):
        size = len(winnow(grams_of(templates[name], WordHashes())))
        if not parts or size > room:
            parts.append({})
            room = most
        parts[-1][name] = templates[name]
        room -= size
    return parts


FOUND = (
    "doc_id bigint, text_key bigint, template string, start_word bigint, end_word bigint, "
    "matched_words bigint, coverage double"
)


def scan_part(docs: DataFrame, templates: dict[str, list[str]], coverage: float) -> DataFrame:
    """Finds of the templates of one index; a text is scanned where it is read."""
    index = Index(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            rows = [
                (i, f)
                for i, text in enumerate(batch.column(2).to_pylist())
                for f in index.finds(WORD.findall((text or "").lower()), hashes, coverage)
            ]
            at = pa.array([i for i, _ in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    batch.column(1).take(at),
                    pa.array([f.template for _, f in rows], pa.string()),
                    pa.array([f.start_word for _, f in rows], pa.int64()),
                    pa.array([f.end_word for _, f in rows], pa.int64()),
                    pa.array([f.matched_words for _, f in rows], pa.int64()),
                    pa.array([f.coverage for _, f in rows], pa.float64()),
                ],
                names=[c.split()[0] for c in FOUND.split(", ")],
            )

    texts = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("key"), "text")
    return texts.mapInArrow(run, FOUND)


def settled(found: DataFrame) -> DataFrame:
    """The outermost finds of each text over several parts; a repeated row keeps its own."""
    once = found.distinct()
    order = W.partitionBy("doc_id", "text_key").orderBy(
        "start_word", F.desc("end_word"), F.desc("coverage"), "template"
    )
    reach = F.max("end_word").over(order.rowsBetween(W.unboundedPreceding, -1))
    outer = once.withColumn("reach", reach).where("reach IS NULL OR end_word > reach")
    outer = outer.select(*[F.col(c).alias(f"_{c}") for c in found.columns])
    same = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in found.columns]
    )
    return found.join(outer, same, "left_semi")


def scan(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    coverage: float = COVERAGE,
    max_index: int = MAX_INDEX,
) -> DataFrame:
    """``doc_id, template, start_word, end_word, matched_words, coverage`` of each find.

    Words are runs of letters and digits without case; ``[start_word, end_word)`` counts
    them in the whole text. ``coverage`` is the share of the template's words that stand
    there in order. Several finds in one text are several rows, but a find within the span of
    another is none; of finds over the same words the one with the highest coverage, then the
    least name, stays. Rows repeated whole give theirs each. NULL, empty and blank texts give none,
    and templates of fewer than three words are not looked for. Only ``doc_id`` and ``text`` are
    read; a NULL ``doc_id`` stays NULL. Templates with more than ``max_index`` fingerprints are
    scanned for in parts.
    """
    texts = TEMPLATES if templates is None else templates
    wanted = {n: WORD.findall(t.lower()) for n, t in texts.items()}
    parts = parts_of({n: w for n, w in wanted.items() if len(w) >= GRAM}, max_index)
    if not parts:
        return docs.sparkSession.createDataFrame([], FOUND).drop("text_key")
    found = reduce(DataFrame.unionByName, [scan_part(docs, part, coverage) for part in parts])
    return (settled(found) if len(parts) > 1 else found).drop("text_key")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
