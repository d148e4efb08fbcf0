"""License scan by conditional compression (operator 2).

Licensing words are anchors: a candidate block reaches as many words to both sides of one as the
longest finding has, and blocks that overlap are one. Each block is compressed alone and with the
templates as zstandard raw-content dictionaries, but for templates of which the block lacks more
than ``ALLOWED`` of the words; templates are ranked by how many bytes they save. The best one is
confirmed by its exact wording: the block's words are aligned with the template's, and the words
that are missing or added are listed. If they are at most ``ALLOWED`` of the template's words, that
is a finding, or of the templates that fit there the one that agrees in more words; its words are
taken out and the rest of the block is searched again. Else the next best is tried. Templates that save
equally many bytes are tried in their order here.

Some words decide which license a text is: names, version numbers, NC, SA, ND and the like
(``DECIDING``). A text that lacks one of a template's, or has another one among its words, is no
finding of that template, however alike it is; ``2.0`` and ``v2`` are the number ``2``. A list of
conditions that goes on with one of ``FURTHER`` isn't the shorter license, and a notice that a
word of ``DENYING`` stands before in its sentence is none. ``after`` has the words that follow.

Only texts that hold a licensing word reach Python, the search is a scan without a shuffle, and a
worker remembers the findings of blocks it has met, so a notice that a third of all documents carry
is compressed once for each worker.

Null and empty texts have no findings. Long texts are searched whole: a long block is read in
windows that overlap by more than the longest template. Repeated rows are scanned each; an empty
table gives an empty result; further columns aren't read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from difflib import Match, SequenceMatcher

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pagemill.llm.common import table

# Public license notices, without copyright lines.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "MIT-full": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC-full": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-Clause-full": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "BSD-3-Clause-full": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "LGPL-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "EPL-2.0-header": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/.",
    "LGPL-3.0-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.",
    "AGPL-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "LGPL-2.1-notice": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-ND-4.0-notice": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-NC-4.0-long-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-NC-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "CC-BY-NC-ND-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "Apache-2.0-text": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    "GPL-2.0-text": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "GPL-3.0-text": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "LGPL-2.1-text": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "LGPL-3.0-text": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "AGPL-3.0-text": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "CC0-1.0-header": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty. You should have received a copy of the CC0 Public Domain Dedication along with this software. If not, see http://creativecommons.org/publicdomain/zero/1.0/.",
}
#: The BSD licenses differ in their conditions, each with or without the disclaimer.
CONDITIONS = TEMPLATES["BSD-2-Clause"]
ENDORSING, DISCLAIMER = TEMPLATES["BSD-3-Clause-full"].removeprefix(CONDITIONS).split(" THIS SOFTWARE IS ")
ADVERTISING = " All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization."
TEMPLATES["BSD-3-Clause"] = CONDITIONS + ENDORSING
TEMPLATES["BSD-4-Clause"] = CONDITIONS + ADVERTISING + ENDORSING
TEMPLATES["BSD-4-Clause-full"] = f"{TEMPLATES['BSD-4-Clause']} THIS SOFTWARE IS {DISCLAIMER}"

# Words that tell licenses apart, besides numbers.
DECIDING = frozenset("mit bsd isc apache lesser affero mozilla mpl eclipse cc cc0 commons attribution noncommercial sharealike noderivatives noderivs nc sa nd endorse advertising modified not never".split())
# Words of further conditions, and words that deny what follows them.
FURTHER = frozenset(["advertising", "endorse"])
DENYING = frozenset("not never no neither nor cannot isn't aren't wasn't weren't isn’t aren’t wasn’t weren’t".split())
#: Words behind a list of conditions in which a further one shows, and words before a notice in which it is denied.
FOLLOWING, BEFORE = 40, 3
#: Words of ``after``.
AFTER = 12
CUE = r"(?i)licen[cs]e|copyright|warrant|permission|redistribut|public[^\p{L}\p{N}]+domain|spdx|©"
#: Share of a template's words that may be missing or added.
ALLOWED = 0.2
#: Words of a block read together, and by how many two such windows overlap, at least.
WINDOW, OVERLAP = 1200, 320
#: Bytes, about, of findings that a worker remembers.
REMEMBERED = 20_000_000
LEVEL = 6

WORD = regex.compile(r"[\p{L}\p{N}]+(?:[.'’-][\p{L}\p{N}]+)*")
MARK = regex.compile(CUE)
NUMBER = regex.compile(r"v?(\d+(?:\.\d+)*?)(?:\.0)*")
BREAK = regex.compile(r"[.!?;:]|\n[^\p{L}\p{N}]*\n")


def reach_of(templates: dict[str, str]) -> int:
    """Words that a finding has at most."""
    return max((n + int(ALLOWED * n) for n in (len(WORD.findall(t)) for t in templates.values())), default=0)


REACH = reach_of(TEMPLATES)


def blocks_of(text: str, reach: int = REACH) -> Iterator[tuple[int, int]]:
    """Spans of the candidate blocks of a text: ``reach`` words to both sides of each cue."""
    cues = [m.start() for m in MARK.finditer(text)]
    if not cues:
        return
    places = [m.span() for m in WORD.finditer(text)]
    starts = [a for a, _ in places]
    first = last = None
    for cue in cues:
        at = max(0, bisect_right(starts, cue) - 1)
        low, high = max(0, at - reach), min(len(places), at + reach + 1)
        if first is not None and low > last:
            yield places[first][0], places[last - 1][1]
            first = None
        first, last = low if first is None else first, high
    if last:
        yield places[first][0], places[last - 1][1]


def deciding(words: list[str]) -> Counter:
    """The deciding words among ``words``, a compound's parts each for itself, and numbers without ``v`` and ``.0``."""
    out = Counter()
    for word in words:
        if number := NUMBER.fullmatch(word):
            out[number[1]] += 1
        else:
            out.update(part for part in word.split("-") if part in DECIDING)
    return out


class Template:
    """A template's words, how many may differ, and how long a run of them a finding has at least."""

    def __init__(self, name: str, text: str):
        self.name = name
        self.words = [w.lower() for w in WORD.findall(text)]
        self.counts = [*Counter(self.words).items()]
        self.further = FURTHER.difference(self.words) if "redistributions" in self.words else frozenset()
        self.allowed = int(ALLOWED * len(self.words) + 1e-9)
        self.run = -(-(len(self.words) - self.allowed) // (self.allowed + 1))
        given = zstandard.ZstdCompressionDict(" ".join(self.words).encode("utf-8"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        given.precompute_compress(level=LEVEL)
        self.compressor = zstandard.ZstdCompressor(dict_data=given)

    def possible(self, counts: Counter) -> bool:
        """Whether words with these counts lack few enough of the template's."""
        lacking = 0
        for word, n in self.counts:
            if (have := counts.get(word, 0)) < n:
                lacking += n - have
                if lacking > self.allowed:
                    return False
        return True

    @staticmethod
    def decided(missing: list[str], added: list[str], behind: list[str]) -> bool:
        """Whether no deciding word is missing, if not just behind in another form, and none but numbers, such as a list's, is added."""
        lost, new = deciding(missing) - deciding(behind), deciding(added)
        return not lost - new and not any(word in DECIDING for word in new - lost)

    def place(self, words: list[str]) -> tuple[int, int, list[str], list[str]] | None:
        """A place in ``words`` that fits: around the longest equal run, else before or after it."""
        parts = [(0, len(words))]
        while parts:
            a, b = parts.pop()
            part = words[a:b]
            if not self.possible(Counter(part)):
                continue
            core = SequenceMatcher(None, self.words, part, autojunk=False).find_longest_match()
            if core.size < max(1, self.run):
                continue
            i, j, missing, added = wording(self.words, part, core)
            if len(missing) + len(added) <= self.allowed and self.decided(missing, added, part[j : j + 1]) and self.further.isdisjoint(words[a + j : a + j + FOLLOWING]):
                return a + i, a + j, missing, added
            parts += [(a + core.b + core.size, b), (a, a + core.b)]
        return None


class Scanner:
    """The templates with their compressors, and the findings of blocks met so far."""

    def __init__(self, templates: dict[str, str]):
        self.alone = zstandard.ZstdCompressor(level=LEVEL)
        self.known = [t for t in (Template(*item) for item in templates.items()) if t.words]
        self.reach = reach_of(templates)
        self.overlap = max(OVERLAP, self.reach)
        self.size = max(WINDOW, 4 * self.overlap)
        self.met: dict[bytes, list] = {}
        self.held = 0

    def saved(self, words: list[str]) -> list[tuple[int, int]]:
        """(bytes saved, template) of those that can fit, the best first."""
        counts = Counter(words)
        able = [k for k, t in enumerate(self.known) if t.possible(counts)]
        if not able:
            return []
        data = " ".join(words).encode("utf-8")
        size = len(self.alone.compress(data))
        return sorted(((size - len(self.known[k].compressor.compress(data)), k) for k in able), key=lambda x: (-x[0], x[1]))

    def window(self, words: list[str]) -> list[tuple]:
        """Findings (name, saved, first word, last word, missing, added) in a list of words."""
        out, parts = [], [(0, len(words))]
        while parts:
            a, b = parts.pop()
            ranked = self.saved(words[a:b])
            for saved, k in ranked:
                if fit := self.known[k].place(words[a:b]):
                    saved, k, fit = self.best(words[a:b], ranked, saved, k, fit)
                    i, j = a + fit[0], a + fit[1]
                    out.append((self.known[k].name, saved, i, j, fit[2], fit[3]))
                    parts += [p for p in ((a, i), (j, b)) if p[1] > p[0]]
                    break
        return sorted(out, key=lambda f: f[2:4])

    def best(self, words: list[str], ranked: list[tuple[int, int]], saved: int, k: int, fit: tuple) -> tuple:
        """Of the templates that fit where ``fit`` is, the one that agrees in more words."""
        low, high = max(0, fit[0] - self.reach), fit[1] + self.reach
        near = words[low:high]
        agrees = lambda k, f: len(self.known[k].words) - 2 * len(f[2]) - len(f[3])
        for other_saved, other in ranked:
            if other != k and (there := self.known[other].place(near)):
                there = (low + there[0], low + there[1], *there[2:])
                if there[0] < fit[1] and fit[0] < there[1] and agrees(other, there) > agrees(k, fit):
                    saved, k, fit = other_saved, other, there
        return saved, k, fit

    def block(self, text: str) -> list[tuple]:
        """Findings (name, saved, start, end, missing, added, after) of a block, in characters."""
        key = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        if (known := self.met.get(key)) is not None:
            return known
        places = [m.span() for m in WORD.finditer(text)]
        words = [text[a:b].lower() for a, b in places]
        out, at = [], 0
        while at < len(words):
            last, after = at + self.size >= len(words), at + self.size - self.overlap
            for name, saved, i, j, missing, added in self.window(words[at : at + self.size]):
                if not last and at + i >= after:  # the next window has it whole
                    break
                if not denied(text, places, words, at + i):
                    out.append((name, saved, places[at + i][0], places[at + j - 1][1], missing, added, words[at + j : at + j + AFTER]))
                after = max(after, at + j)
            at = len(words) if last else after
        if self.held >= REMEMBERED:
            self.met.clear()
            self.held = 0
        self.held += 200 + sum(300 + sum(60 + len(w) for w in [*f[4], *f[5], *f[6]]) for f in out)
        self.met[key] = out
        return out


def denied(text: str, places: list[tuple[int, int]], words: list[str], at: int) -> bool:
    """Whether a denying word stands shortly before the word ``at``, in the same sentence."""
    for k in range(at - 1, max(-1, at - 1 - BEFORE), -1):
        if BREAK.search(text, places[k][1], places[k + 1][0]):
            return False
        if words[k] in DENYING:
            return True
    return False


def wording(template: list[str], words: list[str], core: Match) -> tuple[int, int, list[str], list[str]]:
    """First and last word (exclusive) of the template's place around the equal run ``core``, words missing and added."""
    slack = len(template) // 5 + 3
    low = max(0, core.b - core.a - slack)
    near = words[low : core.b - core.a + len(template) + slack]
    runs = [m for m in SequenceMatcher(None, template, near, autojunk=False).get_matching_blocks() if m.size]
    while len(runs) > 1 and runs[1].b - runs[0].b - runs[0].size > runs[0].size:  # costs more than it matches
        runs = runs[1:]
    while len(runs) > 1 and runs[-1].b - runs[-2].b - runs[-2].size > runs[-1].size:
        runs = runs[:-1]
    missing, added, i, j = [], [], 0, runs[0].b
    for m in runs:
        missing += template[i : m.a]
        added += near[j : m.b]
        i, j = m.a + m.size, m.b + m.size
    return low + runs[0].b, low + j, missing + template[i:], added


_scanners: dict[tuple, Scanner] = {}


def scan(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each finding: the id, license, exact, bytes_saved, start, end, missing, added, after.

    ``start`` and ``end`` are code points of the text; ``missing`` and ``added`` are the words in
    which the text differs from the template, ``exact`` says that there are none; ``after`` are
    the words that follow it in its block.
    """
    chosen = tuple((templates or TEMPLATES).items())
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").rlike(CUE))
    kind = to_arrow_type(docs.schema[id_col].dataType)
    words = pa.list_(pa.string())
    types = [kind, pa.string(), pa.bool_(), pa.int32(), pa.int64(), pa.int64(), words, words, words]
    names = ["id", "license", "exact", "bytes_saved", "start", "end", "missing", "added", "after"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if chosen not in _scanners:
            _scanners[chosen] = Scanner(dict(chosen))
        scanner = _scanners[chosen]
        for batch in batches:
            out = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for a, b in blocks_of(text, scanner.reach):
                    out += [(key, name, not missing and not added, saved, a + i, a + j, missing, added, after) for name, saved, i, j, missing, added, after in scanner.block(text[a:b])]
            columns = zip(*out, strict=True) if out else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    schema = f"id {docs.schema[id_col].dataType.simpleString()}, license string, exact boolean, bytes_saved int, start long, end long, missing array<string>, added array<string>, after array<string>"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: the license notices of all documents."""
    return scan(table(spark, sf_dir, "documents"))
