"""License scans: text compared to licence templates by the Dice coefficient
over word bigrams.

Texts and templates are normalised to lower-case words. Runs of consecutive
lines are compared first; in what these leave, windows of words are, so a
licence is found wherever it stands in a document, also within a line. Windows
begin and end at word pairs of the template. Templates whose size rules out the threshold for a run are pruned before any
bigram is compared.
"""

from __future__ import annotations

import bisect
import math
from collections import Counter
from itertools import accumulate

from pyspark.sql import DataFrame

from fleetlens.llm.common import map_rows, pick

# Parts that the notices of close siblings share.
GNU = (
    "This {0} is free software{3} you can redistribute it and/or modify it under the terms of the GNU {1} Public License as published by the Free Software Foundation, either version {2} of "
    "the License, or (at your option) any later version. This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} Public License for more details."
)
CC = "This work is licensed under a Creative Commons {} 4.0 International License."
BSD_DISCLAIMER = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, "
    "OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY "
    "OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
    "DAMAGE."
)

# Licence templates (an identifier and the text of its notice or
# licence, without copyright lines).
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain "
        "the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain "
        "the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of "
        "the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    (
        "LGPL-3.0-or-later",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
        "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("GPL-2.0-or-later", GNU.format("program", "General", "2", ";")),
    ("AGPL-3.0-or-later", GNU.format("program", "Affero General", "3", ":")),
    ("LGPL-2.1-or-later", GNU.format("library", "Lesser General", "2.1", ";")),
    ("CC-BY-ND-4.0", CC.format("Attribution-NoDerivatives")),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", CC.format("Attribution-NonCommercial-ShareAlike")),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", CC.format("Attribution-NonCommercial-NoDerivatives")),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
)

LEAST_WITHIN = 3  # bigrams of a template that is looked for within lines; a shorter one is no evidence there

# The BSD texts with their disclaimer.
TEMPLATES += tuple((name, text + BSD_DISCLAIMER) for name, text in TEMPLATES if name.startswith("BSD-"))

# Lower-case letters, digits and the dot stay, and all bytes beyond ASCII.
NORMAL = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() or b == 0x2E else 0x20 for b in range(256))


def normal_words(text: str) -> list[bytes]:
    """Lower-case words of letters, digits and inner dots."""
    return [w for x in text.lower().encode().translate(NORMAL).split() if (w := x.strip(b"."))]


def bigrams(words: list[bytes]) -> Counter:
    """Pairs of neighbours and how often each occurs; of a single word, the word alone."""
    return Counter(zip(words, words[1:]) if len(words) > 1 else [tuple(words)] * len(words))


def dice(a: Counter, b: Counter) -> float:
    """Twice the common bigrams over all, each as often as it occurs."""
    total = a.total() + b.total()
    return 2 * (a & b).total() / total if total else 0.0


class LicenseMatcher:
    """Templates by size, for runs whose Dice coefficient with one must reach ``threshold``."""

    def __init__(self, templates=TEMPLATES, threshold: float = 0.8):
        if not 0 < threshold <= 1:
            raise ValueError("the threshold must be above 0 and at most 1")
        self.threshold = threshold
        prepared = [(b.total(), i, name, b) for i, (name, text) in enumerate(templates) if (b := bigrams(normal_words(text)))]
        self.templates = sorted(prepared, key=lambda t: t[:2])
        self.sizes = [t[0] for t in self.templates]
        self.words = {w for *_, b in self.templates for pair in b for w in pair}
        self.holders: dict[tuple, list[int]] = {}  # of a bigram: the templates, by place in the sorted list
        for i, (size, _, _, b) in enumerate(self.templates):
            for pair in b if size >= LEAST_WITHIN else ():
                self.holders.setdefault(pair, []).append(i)
        self.ratio = (2 - threshold) / threshold  # 2 m / (n + b) >= t with m <= min(n, b) needs n / b within this, either way

    def best(self, words: list[bytes], known: int) -> tuple[float, str] | None:
        """(Dice coefficient, template's name) of the best template at or above
        the threshold, for words of which ``known`` occur in templates."""
        n = max(1, len(words) - 1)
        low, high = bisect.bisect_left(self.sizes, n / self.ratio - 1e-9), bisect.bisect_right(self.sizes, n * self.ratio + 1e-9)
        common = known - 1 if len(words) > 1 else known  # the most bigrams that can be in a template
        if low == high or 2 * common < self.threshold * (n + self.sizes[low]) - 1e-9:
            return None
        got, found = bigrams(words), None
        for _, listed, name, b in self.templates[low:high]:
            d = dice(got, b)
            if d >= self.threshold - 1e-12 and (found is None or (-d, listed) < found[:2]):
                found = (-d, listed, name)
        return None if found is None else (-found[0], found[2])

    def scan(self, text: str | None) -> list[tuple[int, int, float, str]]:
        """(first line, line after the last, Dice coefficient, name) of the runs
        of lines that match; the best are taken, then the shorter, then the
        earlier, and none that overlaps one taken."""
        if not text or not self.templates:
            return []
        lines = [(i, w) for i, x in enumerate(text.split("\n")) if (w := normal_words(x))]
        length = [0, *accumulate(len(w) for _, w in lines)]
        known = [0, *accumulate(sum(map(self.words.__contains__, w)) for _, w in lines)]
        largest, floor = self.sizes[-1] * self.ratio + 1e-9, self.threshold * (1 + 1 / self.ratio) / 2
        found = []
        for a in range(len(lines)):
            for e in range(a + 1, len(lines) + 1):
                n, k = length[e] - length[a], known[e] - known[a]
                if n - 1 > largest:
                    break
                if k < floor * (n - 1) - 1e-9:  # too few words of templates for any size
                    continue
                if (hit := self.best([w for _, line in lines[a:e] for w in line], k)) is not None:
                    found.append((lines[a][0], lines[e - 1][0] + 1, *hit))
        out: list[tuple[int, int, float, str]] = []
        for hit in sorted(found, key=lambda h: (-h[2], h[1] - h[0], h[0])):
            if all(hit[1] <= o[0] or hit[0] >= o[1] for o in out):
                out.append(hit)
        return sorted(out)


    def windows(self, words: list[bytes]) -> list[tuple[int, int, float, str]]:
        """(first word, word after the last, Dice coefficient, name) of the
        windows that match; the best are taken, then the shorter, then the
        earlier, and none that overlaps one taken."""
        at: dict[int, list[int]] = {}
        pairs = list(zip(words, words[1:]))
        for i, pair in enumerate(pairs):
            for t in self.holders.get(pair, ()):
                at.setdefault(t, []).append(i)
        found = []
        for t, places in at.items():
            size, listed, name, b = self.templates[t]
            least = math.ceil(self.threshold * (size / self.ratio + size) / 2 - 1e-9)  # common bigrams that any window needs
            longest = size * self.ratio + 1e-9
            for i in range(len(places) - least + 1):
                if places[i + least - 1] - places[i] + 1 > longest:
                    continue
                got: Counter = Counter()
                common = 0
                for j in range(i, len(places)):
                    n = places[j] - places[i] + 1
                    if n > longest:
                        break
                    pair = pairs[places[j]]
                    got[pair] += 1
                    common += got[pair] <= b[pair]
                    if 2 * common >= (self.threshold - 1e-12) * (n + size):
                        found.append((-2 * common / (n + size), n, places[i], listed, name))
        out, covered = [], bytearray(len(words))
        for d, n, a, _, name in sorted(found):
            if not any(covered[a : a + n + 1]):
                covered[a : a + n + 1] = b"\1" * (n + 1)
                out.append((a, a + n + 1, -d, name))
        return sorted(out)

    def find(self, text: str | None) -> list[tuple[int, int, float, str]]:
        """What ``scan`` finds, and the windows of words that match in the lines
        between, by their lines."""
        runs = self.scan(text)
        if not text or not self.holders:
            return runs
        out, words, of = list(runs), [], []
        taken = {i for a, e, *_ in runs for i in range(a, e)}
        lines = text.split("\n")
        for i in range(len(lines) + 1):
            if i < len(lines) and i not in taken:
                w = normal_words(lines[i])
                words += w
                of += [i] * len(w)
            elif words:
                out += [(of[a], of[e - 1] + 1, d, name) for a, e, d, name in self.windows(words)]
                words, of = [], []
        return sorted(out)


def scan_licenses(docs: DataFrame, templates=TEMPLATES, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, ``n_matches``, ``licenses`` (names found,
    distinct, in order, comma-joined; empty if none), ``best_dice`` (0 if none)
    and ``spans`` (``name:first line:line after the last``, comma-joined).

    A run of consecutive lines matches a template if the Dice coefficient of
    their word bigrams reaches ``threshold``; so does a window of words in the
    lines that no run takes, for templates of three bigrams or more. A null text counts as empty; null
    and repeated ids pass through; other columns are ignored. Templates are a
    parameter, (name, text) pairs; ties go to the one listed first.
    """
    given = tuple(templates)

    def make():
        matcher = LicenseMatcher(given, threshold)

        def f(c):
            got = [matcher.find(t) for t in c["text"]]
            return {
                "doc_id": c["doc_id"],
                "n_matches": [len(g) for g in got],
                "licenses": [",".join(sorted({h[3] for h in g})) for g in got],
                "best_dice": [max((h[2] for h in g), default=0.0) for g in got],
                "spans": [",".join(f"{h[3]}:{h[0]}:{h[1]}" for h in g) for g in got],
            }

        return f

    src = pick(docs, doc_id=id_col, text=text_col)
    kind = src.schema["doc_id"].dataType.simpleString()
    return map_rows(src, make, f"doc_id {kind}, n_matches long, licenses string, best_dice double, spans string").withColumnRenamed("doc_id", id_col)
