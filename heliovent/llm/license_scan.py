"""Licence texts and notices in documents, by Dice coefficient over word bigrams.

Every line, every paragraph (lines between empty ones) and every whole text is a passage. Passages and templates are normalised
to lower-case words of letters and digits and compared by their sets of word bigrams: 2 * common / (passage + template). A
template needs a size between least / (2 - least) and (2 - least) / least times the passage's, and a passage needs that share of
its bigrams in the templates' vocabulary, or it meets no template at all; so almost all passages end with a look-up.

Any other run of words, over lines and paragraphs, is a window. A window that reaches ``least`` has least / (2 - least) of the
template's bigrams, so only texts that hold as many are searched, and those exactly: a best window begins and ends with a
bigram of the template, and begins where that bigram stands last in it, so each end meets one start for each bigram of the
template. Of overlapping windows the best counts, and with it those whose common bigrams are for the greater part not in its
template. Where a passage that reaches ``least`` overlaps, a window of the same licence, or one no better and made of the same
bigrams, is no further find.

A document's licence is that of its best passage or window; ties go to the first in the alphabet. Null text: empty, no licence. A null
doc_id stays null; repeated rows are scanned each. Passages of fewer than two words have no bigram and match nothing. An empty
table gives an empty result.
"""

from __future__ import annotations

import pkgutil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliovent.llm.text import U64, column, gram_hashes, runs, slices, span_hashes, text_bytes



def _text(name: str) -> str:
    """A full licence text; AGPL-3.0 is written after GPL-3.0's terms."""
    return pkgutil.get_data("heliovent.llm", f"license_texts/{name}.txt").decode()


# fixed values: licences named in one-line identifiers, and the endings that their names have there
_PLAIN, _GNU = ("",), ("", "-only", "-or-later", "+")
_SPDX = {
    **dict.fromkeys(("0BSD", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "ISC", "MIT", "MPL-2.0", "Unlicense"), _PLAIN),
    **dict.fromkeys(("AGPL-3.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0"), _GNU),
}

# fixed values: notices and short licence texts (public wording); several may stand for one licence
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
        You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
        writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    ),
    (
        "BSD-2-Clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
        following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE
        COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
        CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
        LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED
        AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY
        WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is
        distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
        FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU
        General Public License along with this program. If not, see https://www.gnu.org/licenses/.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
        that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR
        DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT
        SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS
        OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH
        THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
        (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
        subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
        BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
        AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "BSD-3-Clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
        following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the
        copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without
        specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
        IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
        ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
        EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA,
        OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
        (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
        DAMAGE.""",
    ),
    (
        "0BSD",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE
        IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR
        ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
        ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "GPL-2.0",
        """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is
        distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
        FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU
        General Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor,
        Boston, MA 02110-1301 USA.""",
    ),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    (
        "LGPL-2.1",
        """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License
        as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library
        is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
        FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy of the
        GNU Lesser General Public License along with this library; if not, write to the Free Software Foundation, Inc., 51 Franklin Street,
        Fifth Floor, Boston, MA 02110-1301 USA""",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    (
        "LGPL-3.0",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License
        as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is
        distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
        FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy of the
        GNU Lesser General Public License along with this program. If not, see https://www.gnu.org/licenses/.""",
    ),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "AGPL-3.0",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License
        as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is
        distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
        FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should have received a copy of the
        GNU Affero General Public License along with this program. If not, see https://www.gnu.org/licenses/.""",
    ),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("Apache-2.0", "Licensed under the Apache License 2.0."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    (
        "BSL-1.0",
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying
        documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and
        to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to
        the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and
        the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the
        Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source
        language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
        THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT
        HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    ("GPL-2.0", "Licensed under the GNU General Public License v2.0."),
    ("GPL-3.0", "Licensed under the GNU General Public License v3.0."),
    ("ISC", "Licensed under the ISC License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "The MIT License (MIT)"),
    ("MPL-2.0", "Licensed under the Mozilla Public License 2.0."),
    *((name, f"SPDX-License-Identifier: {name}{suffix}") for name, suffixes in _SPDX.items() for suffix in suffixes),
    *((name, _text(name)) for name in ("AGPL-3.0", "Apache-2.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0")),
)

LEAST = 0.85
_CHAR = np.zeros(256, bool)
_CHAR[[*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", *range(0x80, 0x100)]] = True
_OUT = pa.schema([("doc_id", pa.int64()), ("n_passages", pa.int64()), ("license", pa.string()), ("dice", pa.float64()), ("licenses", pa.string())])


def _bigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all pairs of words in a row, and where each pair's first word begins."""
    starts, ends = runs(_CHAR[data], offsets)
    return gram_hashes(span_hashes(data, starts, ends, lower=True), 2), starts


class Templates:
    """Bigram sets of the templates, by size."""

    def __init__(self, templates: tuple[tuple[str, str], ...]):
        sets = []
        for name, text in templates:
            data, offsets = text_bytes(pa.array([text]))
            sets.append((name, np.unique(_bigrams(data, offsets)[0])))
        sets.sort(key=lambda x: (len(x[1]), x[0]))
        self.names, self.sets = [n for n, _ in sets], [s for _, s in sets]
        self.sizes = np.array([len(s) for s in self.sets])
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, U64), *self.sets]))
        self.places = [np.full(len(self.vocabulary), -1) for _ in sets]  # of the vocabulary in each set
        for place, own in zip(self.places, self.sets):
            place[np.searchsorted(self.vocabulary, own)] = np.arange(len(own))

    def best(self, passage: np.ndarray, least: float) -> tuple[int, float] | None:
        """Number and coefficient of the most similar template, among those whose size allows ``least``."""
        n = len(passage)
        low, high = np.searchsorted(self.sizes, [np.ceil(n * least / (2 - least) - 1e-9), np.floor(n * (2 - least) / least + 1e-9) + 1])
        found = None
        for i in range(low, high):
            dice = 2 * len(np.intersect1d(passage, self.sets[i], assume_unique=True)) / (n + int(self.sizes[i]))
            if dice >= least and (found is None or (-dice, self.names[i]) < (-found[1], self.names[found[0]])):
                found = i, dice
        return found


Find = tuple[float, int, int, int]  # coefficient, template, first and last bigram


def _best_windows(before: np.ndarray, place: np.ndarray, size: int, least: float) -> list[tuple[float, int, int]]:
    """Coefficient, first and last bigram of the best windows that do not overlap.

    ``before``: where each bigram of a text stands before (-1: nowhere); ``place``: its place in the template of ``size`` (-1: none).
    """
    last = np.full(size, -1)  # where each bigram of the template stood last; a window begins there
    common, all_ = np.zeros(size, np.int64), np.zeros(size, np.int64)
    at, found = 0, []
    for j in np.flatnonzero(place >= 0).tolist():
        if j > at:
            all_ += np.searchsorted(np.sort(before[at:j]), last)
        new = last > before[j]
        all_ += new
        common += new
        last[place[j]], all_[place[j]], common[place[j]] = j, 1, 1
        at = j + 1
        dice = np.where(last >= 0, 2 * common / (all_ + size), 0.0)
        if (top := dice.max()) >= least:
            found.append((float(top), int(last[dice == top].max()), j))
    out = []
    for top, a, b in sorted(found, key=lambda x: (-x[0], x[1], x[2])):
        if all(b < x or a > y for _, x, y in out):
            out.append((top, a, b))
    return out


def _windows(known: Templates, least: float, vocabulary: np.ndarray, grams: np.ndarray, doc: np.ndarray, passages: dict[int, list[Find]]) -> dict[int, list[Find]]:
    """Windows of each document that its passages leave to be found.

    ``vocabulary``: places of the bigrams in the vocabulary (-1: none); ``doc``: their documents, ascending; a pair across two counts with the first.
    """
    size = len(known.vocabulary)
    here = np.flatnonzero(vocabulary >= 0)
    pairs = np.unique(doc[here] * size + vocabulary[here])
    docs, words = pairs // max(size, 1), pairs % max(size, 1)
    to_search: dict[int, list[int]] = {}
    for t, place in enumerate(known.places):
        if n := int(known.sizes[t]):
            held = np.bincount(docs[place[words] >= 0])
            for d in np.flatnonzero(held >= n * least / (2 - least) - 1e-9).tolist():
                to_search.setdefault(d, []).append(t)
    out: dict[int, list[Find]] = {}
    for d, templates in to_search.items():
        begin, end = np.searchsorted(doc, [d, d + 1])
        order = np.argsort(grams[begin:end], kind="stable")
        same = np.flatnonzero(grams[begin:end][order][1:] == grams[begin:end][order][:-1])
        before = np.full(end - begin, -1)
        before[order[same + 1]] = order[same]
        own = vocabulary[begin:end]
        found = []
        for t in templates:
            place = np.where(own >= 0, known.places[t][own], -1)
            found += [(dice, t, begin + a, begin + b) for dice, a, b in _best_windows(before, place, int(known.sizes[t]), least)]

        def same_words(window: Find, other: Find) -> bool:
            """They overlap, and what the window shares with its template is for the greater part in the other's."""
            _, t, a, b = window
            if b < other[2] or a > other[3]:
                return False
            held = np.unique(vocabulary[a : b + 1])
            held = held[held >= 0]
            held = held[known.places[t][held] >= 0]
            return known.names[t] == known.names[other[1]] or 2 * int((known.places[other[1]][held] < 0).sum()) < len(held)

        best: list[Find] = []
        for window in sorted(found, key=lambda x: (-x[0], known.names[x[1]], x[2])):
            if not any(same_words(window, x) for x in best):
                best.append(window)
        for window in best:
            if not any((x[0] >= window[0] or known.names[x[1]] == known.names[window[1]]) and same_words(window, x) for x in passages.get(d, [])):
                out.setdefault(d, []).append(window)
    return out


def _passages(data: np.ndarray, offsets: np.ndarray):
    """Lines, paragraphs and texts as numbers of passages, for bytes in order: where each of a kind begins."""
    breaks = np.flatnonzero(data == 10) + 1
    lines = np.unique(np.r_[offsets, breaks])
    shown = np.r_[0, np.cumsum(~np.isin(data, np.frombuffer(b" \t\r\n\v\f", np.uint8)))]
    empty = np.diff(shown[np.minimum(np.r_[lines, len(data)], len(data))]) == 0
    paragraphs = np.unique(np.r_[offsets, lines[empty]])
    return lines, paragraphs, np.unique(offsets)


def _scan(templates: tuple[tuple[str, str], ...], least: float):
    def make(batches):
        known = Templates(templates)
        share = least / (2 - least)
        for batch in slices(batches):
            data, offsets = text_bytes(column(batch, "text"))
            grams, starts = _bigrams(data, offsets)
            at = np.minimum(np.searchsorted(known.vocabulary, grams), max(0, len(known.vocabulary) - 1))
            hit = known.vocabulary[at] == grams if len(known.vocabulary) else np.zeros(len(grams), bool)
            found: dict[tuple[int, int, int], Find] = {}
            for begins in _passages(data, offsets):
                passage = np.searchsorted(begins, starts, "right")
                inside = np.flatnonzero(passage[:-1] == passage[1:])
                of, own = passage[:-1][inside], hit[inside]
                ours = np.bincount(of[own], minlength=len(begins) + 1)[of] > 0
                of, own, inside = of[ours], own[ours], inside[ours]
                gram = grams[inside]
                order = np.lexsort((gram, of))
                fresh = np.ones(len(order), bool)
                fresh[1:] = (gram[order][1:] != gram[order][:-1]) | (of[order][1:] != of[order][:-1])
                order = order[fresh]
                new = np.flatnonzero(np.r_[len(order) > 0, np.diff(of[order]) > 0])
                hits = np.add.reduceat(own[order].astype(np.int64), new) if len(new) else new
                sizes = np.diff(np.r_[new, len(order)])
                for k in np.flatnonzero(hits >= share * sizes - 1e-9).tolist():
                    part = order[new[k] : new[k] + sizes[k]]
                    best = known.best(gram[part], least)
                    if best is None:
                        continue
                    first, last = inside[np.searchsorted(of, of[part[0]] + np.arange(2)) - np.arange(2)].tolist()
                    begin = int(begins[of[part[0]] - 1])
                    end = int(starts[inside[part.max()]])
                    doc = int(np.searchsorted(offsets, begin, "right")) - 1
                    was = found.get((doc, begin, end))
                    if was is None or best[1] > was[0]:
                        found[doc, begin, end] = best[1], best[0], first, last
            by_doc: dict[int, list[Find]] = {}
            for (doc, _, _), find in sorted(found.items()):
                by_doc.setdefault(doc, []).append(find)
            doc_of = np.searchsorted(offsets, starts, "right") - 1
            across = doc_of[:-1] != doc_of[1:]  # the last pair of each text holds a word of the next one
            vocabulary = np.where(hit & ~across, at, -1)
            for doc, more in _windows(known, least, vocabulary, grams, doc_of[:-1], by_doc).items():
                by_doc.setdefault(doc, []).extend(more)
            rows = []
            for i, id_ in enumerate(column(batch, "doc_id").to_pylist()):
                matches = by_doc.get(i, [])
                top = min(((-x[0], known.names[x[1]]) for x in matches), default=(0.0, None))
                rows.append({"doc_id": id_, "n_passages": len(matches), "license": top[1], "dice": abs(top[0]), "licenses": ",".join(sorted({known.names[x[1]] for x in matches}))})
            yield pa.RecordBatch.from_pylist(rows, schema=_OUT)

    return make


def scan_licenses(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """Compare the passages of every text with licence templates (name, text).

    Returns doc_id, n_passages (passages and windows that reach ``least`` with a template), license (of the best; null: none), dice (its
    coefficient, 0 without), licenses (all found, in the order of the alphabet, comma-joined).
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_scan(templates, least), "doc_id long, n_passages long, license string, dice double, licenses string")
