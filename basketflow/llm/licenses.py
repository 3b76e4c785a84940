"""License scans by patience alignment.

A license template is aligned with a text by anchoring on words that are
unique in both, keeping the longest increasing subsequence of anchors, and
aligning the gaps between anchors in the same way; runs of equal words next to
an anchor or at a gap's ends are taken as they stand.  Coverage is the share
of the template's words that are aligned.

Where to align: a match with coverage ``COVERAGE`` misses at most
``floor((1 - COVERAGE) * length)`` template words, so it holds one of any set of
one more; each occurrence of such words in the whole text proposes a window,
and windows that would start at about the same place are one.  A license that
occurs twice is therefore two windows, each with unique words.

A match also needs ``DENSITY``: aligned words over words between the first and
the last aligned one.  Coverage alone does not tell licenses of like wording
apart, so the words that name a license or its version (``KEYS``) must all be
aligned, with no other word of the text between them (``FILLERS`` aside).  A
match inside a longer match's span is dropped, and so is one that overlaps a
longer match of the same license.  Null and empty texts hold no license.

``-line`` names a license in one sentence, ``-text`` is a whole license, other
names are notices and grants.  The whole texts of the AGPL are not included.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from importlib.resources import files

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.llm.common import fresh, strings, with_fields

COVERAGE = 0.8
DENSITY = 0.6
SLACK = 0.25               # share of the template that a window is wider on either side
WORD = re.compile(r"[^\W_]+")
SPELLINGS = {"licence": "license", "licences": "licenses", "licenced": "licensed"}

# License notices and texts as their publishers give them.
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
    the following conditions are met: {a}Redistributions of source code must retain the above copyright notice, this
    list of conditions and the following disclaimer. {b}Redistributions in binary form must reproduce the above
    copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
    provided with the distribution. {more}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
    AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
    FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
    FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
    PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
    CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
    OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
    DAMAGE."""
_ADVERTISING = """All advertising materials mentioning features or use of this software must display the following
    acknowledgement: This product includes software developed by the copyright holder. """
_ENDORSE = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
    promote products derived from this software without specific prior written permission. """
_PERMISSION = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
    hereby granted"""
_ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
    SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE
    FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE,
    DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
    CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_GNU = """This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}
    General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
    option) any later version. This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
    without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}
    General Public License for more details."""
TEMPLATES = {
    "LGPL-2.1-line": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0-line": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0-line": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0-line": "Licensed under the Mozilla Public License, Version 2.0.",
    "BSD-line": "Released under the BSD License.",
    "BSD-2-Clause-line": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause-line": "Released under the BSD 3-Clause License.",
    "ISC-line": "Released under the ISC License.",
    "Unlicense-line": "Released under the Unlicense.",
    "CC0-1.0-line": "Licensed under CC0 1.0.",
    "CC-BY-ND-4.0-line": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0-line": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0-line": "Licensed under CC BY-NC-ND 4.0.",
    "LGPL": _GNU.format(work="library", kind="Lesser"),
    "AGPL": _GNU.format(work="program", kind="Affero"),
    "0BSD-text": f"{_PERMISSION}. {_ISC_DISCLAIMER}",
    "ISC-text": f"{_PERMISSION}, provided that the above copyright notice and this permission notice appear in all copies. "
                f"{_ISC_DISCLAIMER}",
    "BSD-2-Clause-text": _BSD.format(a="1. ", b="2. ", more=""),
    "BSD-3-Clause-text": _BSD.format(a="1. ", b="2. ", more="3. " + _ENDORSE),
    "BSD-4-Clause-text": _BSD.format(a="1. ", b="2. ", more="3. " + _ADVERTISING + "4. " + _ENDORSE),
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "MIT-line": "Released under the MIT License.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-line": "This work is licensed under the GNU General Public License, version 2.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-line": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-line": "Licensed under CC BY-SA 4.0.",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
        in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY
        KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies
        of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS
        OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
        AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR
        OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
        WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "BSD": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: Redistributions of source code must retain the above copyright notice,
        this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above
        copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution.""",
    "GPL": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
        your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT
        ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See
        the GNU General Public License for more details.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
}
WHOLE = ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "Unlicense")  # files
# Other wordings of the lines.
VARIANTS = [
    ("Apache-2.0-line", "Licensed under the Apache License, v2.0.", "apache license v2 0"),
    ("GPL-3.0-line", "This work is licensed under the GNU General Public License v3.", "gnu general public license v3"),
    ("GPL-2.0-line", "This work is licensed under the GNU General Public License v2.", "gnu general public license v2"),
]
# Words that tell a license from others of like wording, as they stand in the template.
KEYS = {
    "Apache-2.0-line": "apache license version 2 0", "MIT-line": "mit license",
    "GPL-3.0-line": "gnu general public license version 3", "GPL-2.0-line": "gnu general public license version 2",
    "CC-BY-NC-4.0-line": "cc by nc 4 0", "CC-BY-4.0-line": "cc by 4 0", "CC-BY-SA-4.0-line": "cc by sa 4 0",
    "LGPL-2.1-line": "gnu lesser general public license version 2 1",
    "LGPL-3.0-line": "gnu lesser general public license version 3",
    "AGPL-3.0-line": "gnu affero general public license version 3",
    "MPL-2.0-line": "mozilla public license version 2 0", "BSD-line": "bsd license",
    "BSD-2-Clause-line": "bsd 2 clause license", "BSD-3-Clause-line": "bsd 3 clause license", "ISC-line": "isc license",
    "Unlicense-line": "unlicense", "CC0-1.0-line": "cc0 1 0", "CC-BY-ND-4.0-line": "cc by nd 4 0",
    "CC-BY-NC-SA-4.0-line": "cc by nc sa 4 0", "CC-BY-NC-ND-4.0-line": "cc by nc nd 4 0",
    "Apache-2.0": "apache license version 2 0", "MIT": "shall be included in all copies", "ISC": "appear in all copies",
    "GPL": "gnu general public license", "LGPL": "gnu lesser general public license",
    "AGPL": "gnu affero general public license", "MPL-2.0": "mozilla public license v 2 0",
    "ISC-text": "appear in all copies", "BSD-3-Clause-text": "endorse or promote products",
    "BSD-4-Clause-text": "advertising materials mentioning features",
    "Apache-2.0-text": "apache license version 2 0", "GPL-2.0-text": "gnu general public license version 2",
    "GPL-3.0-text": "gnu general public license version 3",
    "LGPL-2.1-text": "gnu lesser general public license version 2 1",
    "LGPL-3.0-text": "gnu lesser general public license version 3",
    "MPL-2.0-text": "mozilla public license version 2 0",
}
FILLERS = frozenset(("version", "v", "ver"))      # may be missing or stand between the words of a key


def split_words(text: str) -> list[str]:
    return [SPELLINGS.get(w, w) for w in WORD.findall(text.lower())]


def increasing(values: list[int]) -> list[int]:
    """Positions of a longest strictly increasing subsequence (patience sorting)."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        back.append(at[k - 1] if k else -1)
        if k == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[k], at[k] = v, i
    out = []
    i = at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Patience alignment: pairs (position in ``a``, position in ``b``), increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1 and in_a.get(w) == 1}
        anchors = [(i, where[w]) for i, w in enumerate(a[a0:a1], a0) if w in where]
        anchors = [anchors[k] for k in increasing([j for _, j in anchors])]
        if not anchors:
            continue
        pa_, pb = a0, b0
        for i, j in anchors:
            out.append((i, j))
            todo.append((pa_, i, pb, j))
            pa_, pb = i + 1, j + 1
        todo.append((pa_, a1, pb, b1))
    return sorted(out)


@dataclass
class Template:
    name: str
    words: list[str]
    key: str = ""

    def __post_init__(self) -> None:
        key = self.key.split()
        at = next(i for i in range(len(self.words) + 1) if self.words[i:i + len(key)] == key)
        self.required = [i for i in range(at, at + len(key)) if self.words[i] not in FILLERS]
        self.missing = int((1 - COVERAGE) * len(self.words) + 1e-9)
        self.count = Counter(self.words)
        self.where: dict[str, list[int]] = defaultdict(list)
        for i, w in enumerate(self.words):
            self.where[w].append(i)

    def named(self, text: list[str], pairs: list[tuple[int, int]]) -> bool:
        """The key's words are aligned, with nothing but fillers between them."""
        if not self.required:
            return True
        to = {j: i for i, j in pairs}
        if any(j not in to for j in self.required):
            return False
        mine = {to[j] for j in self.required}
        return all(i in mine or text[i] in FILLERS for i in range(min(mine), max(mine)))

    def windows(self, places: dict[str, list[int]]) -> list[int]:
        """Places in the text where this template could start."""
        # rarest in the text first; the words that occur must number all but the missing ones
        order = sorted(self.count, key=lambda w: (len(places.get(w, ())) * self.count[w], w))
        absent = sum(self.count[w] for w in order if w not in places)
        if absent > self.missing:
            return []
        starts, taken = [], 0
        for w in order:
            starts += [p - t for p in places.get(w, ()) for t in self.where[w]]
            taken += self.count[w]
            if taken > self.missing:
                break
        slack = max(2, int(SLACK * len(self.words)))
        out: list[int] = []
        for s in sorted(starts):
            if not out or s > out[-1] + slack:
                out.append(s)
        return out


def scan(text: str | None, templates: list[Template]) -> list[tuple[str, float, int, int, int]]:
    """(license, coverage, aligned words, first word, last word) of every match, in text order."""
    words = split_words(text or "")
    present = set(words)
    todo = [t for t in templates if len(t.words) - t.missing <= len(words) and all(
        t.words[j] in present for j in t.required) and sum(t.count[w] for w in t.count if w not in present) <= t.missing]
    if not todo:
        return []
    wanted = {w for t in todo for w in t.count}
    places: dict[str, list[int]] = defaultdict(list)
    for i, w in enumerate(words):
        if w in wanted:
            places[w].append(i)
    found = []
    for t in todo:
        n = len(t.words)
        slack = max(2, int(SLACK * n))
        starts = t.windows(places)
        past = 0                                     # first word beyond this template's last match
        for s, following in zip(starts, [*starts[1:], len(words)], strict=True):
            lo, hi = max(0, s - slack), s + n + 3 * slack
            # up to its neighbours first: a window that holds two copies has no words that occur once
            for a, b in dict.fromkeys(((max(lo, past), min(hi, following)), (max(lo, past), hi), (lo, hi))):
                part = words[a:b]
                pairs = align(part, t.words)
                if len(pairs) < COVERAGE * n or not t.named(part, pairs):
                    continue
                first, last = a + pairs[0][0], a + pairs[-1][0]
                if len(pairs) >= DENSITY * (last - first + 1):
                    found.append((t.name, len(pairs) / n, len(pairs), first, last))
                    past = max(past, last + 1)
                    break
    kept: list[tuple[str, float, int, int, int]] = []
    for f in sorted(found, key=lambda f: (-f[2], -f[1], f[3], f[0])):     # longer matches first
        if not any(k[3] <= f[3] and f[4] <= k[4] or f[0] == k[0] and f[3] <= k[4] and k[3] <= f[4] for k in kept):
            kept.append(f)
    return sorted(kept, key=lambda f: f[3])


def load_templates(texts: dict[str, str] | None = None) -> list[Template]:
    """The given templates (without keys), or all of this module."""
    if texts is not None:
        return [Template(n, split_words(x)) for n, x in texts.items()]
    folder = files("basketflow.llm") / "license_texts"
    whole = {f"{n}-text": (folder / f"{n}.txt").read_text("utf-8") for n in WHOLE}
    return [Template(n, split_words(x), KEYS.get(n, "")) for n, x in (TEMPLATES | whole).items()] + \
        [Template(n, split_words(x), key) for n, x, key in VARIANTS]


MATCH = T.StructType([
    T.StructField("license", T.StringType()), T.StructField("coverage", T.DoubleType()),
    T.StructField("n_words", T.LongType()), T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType())])


def scan_licenses(df: DataFrame, text_col: str = "text", out_col: str = "licenses", texts: dict[str, str] | None = None,
                  keep_text: bool = True) -> DataFrame:
    """Add the array of license matches (word positions within the text)."""
    schema = with_fields(df.schema, [T.StructField(out_col, T.ArrayType(MATCH))], () if keep_text else (text_col,))
    carried = [n for n in schema.names if n != out_col]
    kind = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("n_words", pa.int64()),
                               ("first_word", pa.int64()), ("last_word", pa.int64())]))
    given = fresh(df, "text_in")
    templates = load_templates(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in MATCH.fields]
        for batch in batches:
            got = [[dict(zip(names, m, strict=True)) for m in scan(x, templates)]
                   for x in strings(batch.column(given))]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in carried] + [pa.array(got, kind)],
                                             names=schema.names)

    return df.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{text_col}`").cast("string").alias(given)) \
        .mapInArrow(run, schema)
