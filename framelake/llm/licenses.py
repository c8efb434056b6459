"""License scans by patience alignment.

A template is aligned to a text by the words that occur once in both: their longest increasing
subsequence anchors the alignment, and the gaps between anchors are aligned in the same way until a gap
has no such word; equal words at a gap's ends are matched first. Coverage is the share of the template's
words that are matched.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import work

#: Notices by which works declare a licence, and the texts of short licences, whole and up to
#: their disclaimers (-opening), with the licences that differ from them by a few words.
TEMPLATES = {
    "0bsd": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "agpl-3.0-line": "This work is licensed under the GNU Affero General Public License, version 3",
    "agpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "bsd-2-clause": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "bsd-2-clause-opening": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-3-clause": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "bsd-3-clause-opening": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-line": "Released under the BSD License",
    "cc-by-3.0": "Licensed under CC BY 3.0",
    "cc-by-4.0": "Licensed under CC BY 4.0",
    "cc-by-nc-3.0": "Licensed under CC BY-NC 3.0",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-nc-nd-3.0": "Licensed under CC BY-NC-ND 3.0",
    "cc-by-nc-nd-4.0": "Licensed under CC BY-NC-ND 4.0",
    "cc-by-nc-sa-3.0": "Licensed under CC BY-NC-SA 3.0",
    "cc-by-nc-sa-4.0": "Licensed under CC BY-NC-SA 4.0",
    "cc-by-nd-3.0": "Licensed under CC BY-ND 3.0",
    "cc-by-nd-4.0": "Licensed under CC BY-ND 4.0",
    "cc-by-sa-3.0": "Licensed under CC BY-SA 3.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "gpl-2.0-line": "This work is licensed under the GNU General Public License, version 2",
    "gpl-2.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version.",
    "gpl-2.0-only-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3",
    "gpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "isc": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "isc-opening": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "lgpl-2.0-notice": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version.",
    "lgpl-2.1-line": "This work is licensed under the GNU Lesser General Public License, version 2.1",
    "lgpl-2.1-notice": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version.",
    "lgpl-3.0-line": "This work is licensed under the GNU Lesser General Public License, version 3",
    "lgpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "mit": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "mit-0": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "mit-line": "Released under the MIT License",
    "mit-opening": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
}
#: Words that name a licence and its version. They must be matched side by side; | parts spellings.
NAMED = {
    "agpl-3.0-line": ("gnu affero general public license", "license version 3|license 3"),
    "agpl-3.0-notice": ("gnu affero general public license", "version 3"),
    "apache-2.0-line": ("apache license", "2.0"),
    "apache-2.0-notice": ("apache license", "2.0"),
    "bsd-3-clause": ("neither the name of",),
    "bsd-3-clause-opening": ("neither the name of",),
    "bsd-line": ("bsd",),
    "cc-by-3.0": ("cc by 3.0",),
    "cc-by-4.0": ("cc by 4.0",),
    "cc-by-nc-3.0": ("cc by nc 3.0",),
    "cc-by-nc-4.0": ("cc by nc 4.0",),
    "cc-by-nc-nd-3.0": ("cc by nc nd 3.0",),
    "cc-by-nc-nd-4.0": ("cc by nc nd 4.0",),
    "cc-by-nc-sa-3.0": ("cc by nc sa 3.0",),
    "cc-by-nc-sa-4.0": ("cc by nc sa 4.0",),
    "cc-by-nd-3.0": ("cc by nd 3.0",),
    "cc-by-nd-4.0": ("cc by nd 4.0",),
    "cc-by-sa-3.0": ("cc by sa 3.0",),
    "cc-by-sa-4.0": ("cc by sa 4.0",),
    "gpl-2.0-line": ("gnu general public license", "license version 2|license 2"),
    "gpl-2.0-notice": ("gnu general public license", "version 2"),
    "gpl-2.0-only-notice": ("gnu general public license version 2",),
    "gpl-3.0-line": ("gnu general public license", "license version 3|license 3"),
    "gpl-3.0-notice": ("gnu general public license", "version 3"),
    "isc": ("provided that the above copyright notice",),
    "isc-opening": ("provided that the above copyright notice",),
    "lgpl-2.0-notice": ("gnu library general public license", "version 2"),
    "lgpl-2.1-line": ("gnu lesser general public license", "license version 2.1|license 2.1"),
    "lgpl-2.1-notice": ("gnu lesser general public license", "version 2.1"),
    "lgpl-3.0-line": ("gnu lesser general public license", "license version 3|license 3"),
    "lgpl-3.0-notice": ("gnu lesser general public license", "version 3"),
    "mit": ("this permission notice",),
    "mit-line": ("mit",),
    "mit-opening": ("this permission notice",),
    "mpl-2.0": ("mozilla public license", "2.0"),
}

_WORD = re.compile(r"[^\W_]+(?:\.[^\W_]+)*")
_VERSION = re.compile(r"\bv(?=\d)|(?<=\d)(?:\.0)+(?!\w|\.\w)")


def words(text: str | None) -> list[str]:
    """Lower-case words of letters and digits; a full stop inside one, as in 2.1, belongs to it. Versions
    are spelled alike: v3 and 3.0 are 3."""
    return _WORD.findall(_VERSION.sub("", (text or "").lower()))


def longest_increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence: the classic piles of patience sorting."""
    tops, at, before = [], [], []
    for i, v in enumerate(values):
        p = bisect_left(tops, v)
        if p == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[p], at[p] = v, i
        before.append(at[p - 1] if p else -1)
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Matched places (text, template), increasing in both. Gaps wait on a list, so depth is no limit."""
    matched, gaps = [], [(0, len(text), 0, len(template))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and text[a0] == template[b0]:
            matched.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and text[a1 - 1] == template[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            matched.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once_b = {w: i for i, w in _once(template, b0, b1)}
        anchors = [(i, once_b[w]) for i, w in _once(text, a0, a1, once_b) if w in once_b]
        chosen = [anchors[k] for k in longest_increasing([b for _, b in anchors])]
        if not chosen:
            continue
        matched += chosen
        edges = [(a0 - 1, b0 - 1), *chosen, (a1, b1)]
        gaps += [(x + 1, p, y + 1, q) for (x, y), (p, q) in zip(edges, edges[1:], strict=False)]
    return sorted(matched)


def _once(found: list[str], start: int, end: int, among: dict[str, int] | None = None) -> list[tuple[int, str]]:
    """Places of the words that occur once between start and end, of those asked for."""
    place: dict[str, int] = {}
    for i in range(start, end):
        w = found[i]
        if among is None or w in among:
            place[w] = i if w not in place else -1
    return sorted((i, w) for w, i in place.items() if i >= 0)


@dataclass
class Template:
    name: str
    words: list[str]
    needed: frozenset[str]
    least: int
    named: tuple[list[list[str]], ...] = ()

    def is_named(self, text: list[str], got: list[tuple[int, int]]) -> bool:
        """Whether the matches hold the words that name the licence, side by side in the text."""
        held = {i for i, _ in got}
        return all(any(all(i + j in held and text[i + j] == w for j, w in enumerate(way)) for way in ways for i in held) for ways in self.named)


@lru_cache(maxsize=4)
def compiled(templates: tuple[tuple[str, str], ...], percent: int) -> list[Template]:
    """`needed`: words of which a text with that coverage has at least one. They make up more of the
    template than may go unmatched; words that few templates have are chosen first."""
    split = {name: words(text) for name, text in templates}
    spread = Counter(w for found in split.values() for w in set(found))
    out = []
    for name, found in split.items():
        counts, chosen, held = Counter(found), set(), 0
        least = -(-len(found) * percent // 100)
        may_miss = len(found) - least
        for w in sorted(counts, key=lambda w: (spread[w], -len(w), w)):
            if held > may_miss:
                break
            chosen.add(w)
            held += counts[w]
        out.append(Template(name, found, frozenset(chosen), least, _named(name) if (name, TEMPLATES.get(name)) in templates else ()))
    return out


def _named(name: str) -> tuple[list[list[str]], ...]:
    return tuple([words(way) for way in phrase.split("|")] for phrase in NAMED.get(name, ()))


def windows(text: list[str], template: Template) -> list[tuple[int, int]]:
    """Stretches of the text in which the template may stand: its length on both sides of each needed
    word, joined where they overlap. Every sufficient alignment that is no longer than twice the
    template lies in one."""
    out: list[list[int]] = []
    n = len(template.words)
    for i, w in enumerate(text):
        if w in template.needed:
            if out and i - n <= out[-1][1]:
                out[-1][1] = min(len(text), i + n + 1)
            else:
                out.append([max(0, i - n), min(len(text), i + n + 1)])
    return [(a, b) for a, b in out]


def trimmed(matched: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """The densest run of matches: ends that lie farther from the next match than the template is long go."""
    best: list[tuple[int, int]] = []
    run: list[tuple[int, int]] = []
    for m in matched:
        if run and m[0] - run[-1][0] > length:
            best = max(best, run, key=len)
            run = []
        run.append(m)
    return max(best, run, key=len)


def spans(text: list[str], t: Template, a: int, b: int) -> Iterator[tuple[int, int]]:
    """A window, and once and twice the template's length on both sides of each needed word in it, so that
    notices that stand more than once, whose words are then not unique, are found one by one. Left out
    are spans whose words, each counted as often as the template has it, are too few."""
    counts, n = Counter(t.words), len(t.words)
    if sum(min(m, counts[w]) for w, m in Counter(w for w in text[a:b] if w in counts).items()) < t.least:
        return
    yield a, b
    for reach in (n, 2 * n):
        if b - a <= 2 * n + 1:
            break
        held: Counter[str] = Counter()
        x = y = a
        usable = 0
        for i in range(a, b):
            if text[i] not in t.needed:
                continue
            while y < min(b, i + reach + 1):
                if (w := text[y]) in counts:
                    usable += held[w] < counts[w]
                    held[w] += 1
                y += 1
            while x < i - reach:
                if (w := text[x]) in counts:
                    held[w] -= 1
                    usable -= held[w] < counts[w]
                x += 1
            if usable >= t.least:
                yield x, y


def stretch(text: list[str], places: list[int], t: Template) -> list[tuple[int, int]]:
    """The alignment in these places of the text, drawn together: where one side of a gap holds as many
    matches as both, the other side's go."""

    def aligned(among: list[int]) -> list[tuple[int, int]]:
        return trimmed([(among[i], j) for i, j in align([text[i] for i in among], t.words)], len(t.words))

    got = aligned(places)
    closer = len(got) >= t.least
    while closer:
        closer = False
        gaps = sorted(((p, q) for (p, _), (q, _) in zip(got, got[1:], strict=False) if q - p > 1), key=lambda g: g[0] - g[1])
        for p, q in gaps:
            for side in ([i for i in places if i > p], [i for i in places if i < q]):
                if len(other := aligned(side)) >= len(got) and other[-1][0] - other[0][0] < got[-1][0] - got[0][0]:
                    got, places, closer = other, side, True
                    break
            if closer:
                break
    return got if len(got) >= t.least else []


def scan(text: str | None, templates: list[Template], percent: int) -> list[dict]:
    """The templates that a text covers to `percent` hundredths or more, each with its best stretch of words.

    Every sufficient stretch counts, however many a template has. They claim their matched words in turn:
    the one with more matched words first, or with as many of a shorter notice, so that another is but a
    part of it or goes beyond it. A stretch that lacks words thus claimed is aligned anew to the words that
    are left around it; one that does not name its licence counts for nothing. Different templates that match equally well share their words.
    """
    found = words(text)
    have = set(found)
    waiting: list[tuple[tuple[int, float], int, int, int, list[int], list[tuple[int, int]]]] = []
    claimed: dict[int, tuple[tuple[int, float], int]] = {}
    best: dict[int, dict] = {}

    def offer(k: int, places: list[int]) -> None:
        if got := stretch(found, places, templates[k]):
            n, first, last = len(templates[k].words), got[0][0], got[-1][0]
            around = [i for i in places if first - 2 * n <= i <= last + 2 * n]
            heapq.heappush(waiting, ((-len(got), -len(got) / n), last - first, first, k, around, got))

    for k, t in enumerate(templates):
        if have.isdisjoint(t.needed) or not all(any(have.issuperset(way) for way in ways) for ways in t.named):
            continue
        for a, b in windows(found, t):
            for x, y in spans(found, t, a, b):
                offer(k, list(range(x, y)))
    while waiting:
        score, _, first, k, places, got = heapq.heappop(waiting)
        gone = {i for i in places if i in claimed and (claimed[i][0] < score or claimed[i][1] == k)}
        if any(i in gone for i, _ in got):
            offer(k, [i for i in places if i not in gone])
            continue
        if not templates[k].is_named(found, got):
            continue
        for i, _ in got:
            claimed.setdefault(i, (score, k))
        offer(k, [i for i in places if i not in gone and not first <= i <= got[-1][0]])
        if k not in best:
            best[k] = {"license": templates[k].name, "coverage": -score[1], "matched": len(got), "first_word": first, "last_word": got[-1][0]}
    return [best[k] for k in sorted(best)]


FOUND = "array<struct<license:string,coverage:double,matched:int,first_word:int,last_word:int>>"


def scan_documents(documents: DataFrame, text: str = "text", out: str = "licenses", templates: dict[str, str] | None = None, percent: int = 80) -> DataFrame:
    """Adds the licences found in each whole text, in order of the templates' names; null and empty texts
    have none. Rows are independent: no shuffle. A column of that name is replaced."""
    given = tuple(sorted((templates or TEMPLATES).items()))
    @F.pandas_udf(FOUND)
    def find(texts: pd.Series) -> pd.Series:
        ready = compiled(given, percent)
        return texts.map(lambda t: scan(t, ready, percent), na_action=None)

    return documents.withColumn(out, find(F.col(text)))
