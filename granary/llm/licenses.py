"""License scans: matching statistics against a generalised suffix automaton of license templates, long matches chained into covered spans."""

from __future__ import annotations

import re
from bisect import bisect_left

from pyspark.sql import DataFrame

from granary.llm.common import arrow_map

#: Base phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Public license notices, as published.
TEMPLATES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "as-is-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "bsd-3-clause-endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-warranty": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "gpl-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "lgpl": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    "agpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "bsl-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: A match of so many words counts; matches at most so many words apart are chained; a label needs this share of its template, in the template's order.
SEED, GAP, COVERED = 6, 8, 0.5


def words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


class Automaton:
    """Generalised suffix automaton over word ids. A state's occurrences, (template, end), are those of the states below it in the tree of suffix links."""

    def __init__(self, texts: list[list[int]]):
        self.next, self.link, self.len, self.own = [{}], [-1], [0], [[]]
        for k, text in enumerate(texts):
            last = 0
            for i, c in enumerate(text):
                last = self._extend(last, c)
                self.own[last].append((k, i + 1))
        self.below: list[list[int]] = [[] for _ in self.len]
        for v in range(1, len(self.len)):
            self.below[self.link[v]].append(v)

    def ends(self, v: int) -> list[tuple[int, int]]:
        """All occurrences of the state's strings."""
        out, stack = [], [v]
        while stack:
            v = stack.pop()
            out += self.own[v]
            stack += self.below[v]
        return out

    def _new(self, length: int, nxt: dict, link: int) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.len.append(length)
        self.own.append([])
        return len(self.len) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        if self.len[q] == self.len[p] + 1:
            return q
        clone = self._new(self.len[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, self.next[last][c], c)
        cur, p = self._new(self.len[last] + 1, {}, 0), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p >= 0:
            self.link[cur] = self._split(p, self.next[p][c], c)
        return cur

    def statistics(self, ids: list[int]):
        """(state, length) of the longest suffix that occurs in a template, at each word."""
        v = n = 0
        for c in ids:
            while v and c not in self.next[v]:
                v = self.link[v]
                n = self.len[v]
            if c in self.next[v]:
                v, n = self.next[v][c], n + 1
            yield v, n


class Chain:
    """The longest chain of (place in the text, place in the template) that rises in both, by patience sorting, one point after the other."""

    def __init__(self):
        self.tails, self.at, self.points, self.back = [], [], [], []

    def add(self, point: tuple[int, int]) -> None:
        k = bisect_left(self.tails, point[1])
        self.tails[k : k + 1], self.at[k : k + 1] = [point[1]], [len(self.points)]
        self.points.append(point)
        self.back.append(self.at[k - 1] if k else -1)

    def best(self) -> list[tuple[int, int]]:
        out, i = [], self.at[-1] if self.at else -1
        while i >= 0:
            out.append(self.points[i])
            i = self.back[i]
        return out[::-1]


def spans(points: list[tuple[int, int]], size: int, covered: float, gap: int) -> list[tuple[int, int, float]]:
    """(first word, end word, share of the template) of the chains that cover enough. A chain ends where no match follows within ``gap`` words, where the template is complete, or, once it covers enough, where the template's first words come again; so time grows with the points."""
    out, now, last = [], Chain(), None

    def end():
        if now.tails and len(now.tails) >= covered * size:
            best = now.best()
            out.append((best[0][0], best[-1][0] + 1, len(best) / size))

    for i, t in sorted(set(points), key=lambda p: (p[0], -p[1])):
        again = t == 0 and len(now.tails) >= covered * size
        if last is not None and (i - last > gap + 1 or again or len(now.tails) == size and i > last):
            end()
            now = Chain()
        now.add((i, t))
        last = i
    end()
    return out


class Scanner:
    def __init__(self, templates: dict[str, str] = TEMPLATES):
        self.names, texts = sorted(templates), {k: words(v) for k, v in templates.items()}
        self.phrases = [(tuple(k.encode().split()), v) for k, v in PHRASES.items()]
        every = [texts[k] for k in self.names] + [list(p) for p, _ in self.phrases]
        self.ids = {w: i for i, w in enumerate(sorted({w for t in every for w in t}))}
        self.size = [len(texts[k]) for k in self.names]
        self.fsa = Automaton([[self.ids[w] for w in t] for t in every])
        self.starts: dict[int, list[tuple[list[int], str]]] = {}
        for p, label in self.phrases:
            self.starts.setdefault(self.ids[p[-1]], []).append(([self.ids[w] for w in p], label))

    def scan(self, text: str | None) -> dict:
        """Base places by the automaton's matches, spans [(label, first word, end word, covered share)] by chaining."""
        import numpy as np

        w = words(text)
        ids = np.fromiter(map(lambda x, get=self.ids.get: get(x, -1), w), np.int32, len(w))
        known = np.concatenate([[0], ids >= 0, [0]]).astype(np.int8)
        edge = np.flatnonzero(np.diff(known))
        base, points = [], {}
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if b - a < 2:
                continue
            run, best = ids[a:b].tolist(), []
            for i, (v, n) in enumerate(self.fsa.statistics(run)):
                for p, label in self.starts.get(run[i], ()):
                    if n >= len(p) and run[i + 1 - len(p) : i + 1] == p:
                        base.append((a + i + 1 - len(p), label))
                if n >= SEED:
                    best.append((i, n, v))
            for (i, n, v), (j, m, _) in zip(best, [*best[1:], (-1, 0, 0)]):
                if j == i + 1 and m == n + 1:  # a part of the next match
                    continue
                for k, end in self.fsa.ends(v):
                    if k < len(self.names):
                        points.setdefault(k, []).extend(zip(range(a + i + 1 - n, a + i + 1), range(end - n, end)))
        found = [(self.names[k], *x) for k, p in points.items() for x in spans(p, self.size[k], COVERED, GAP)]
        return {"n_words": len(w), "base": sorted(base), "spans": sorted(found)}


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans of docs (doc_id, text).

    score: the largest covered share of a template, 1 for a base phrase, 0 if nothing is found. Null or empty text: no words, null places, '' labels, 0. Equal rows: each. Row by row: no shuffle.
    """

    def make():
        s = Scanner(templates)

        def f(b):
            out = {k: [] for k in ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")}
            for i, t in zip(b["doc_id"], b["text"]):
                r = s.scan(t)
                at, labels = [x[0] for x in r["base"]], {x[1] for x in r["base"]}
                row = (i, r["n_words"], len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | {x[0] for x in r["spans"]})), 1.0 if at else min(1.0, max((x[3] for x in r["spans"]), default=0.0)), ",".join(f"{x[0]}:{x[1]}:{x[2]}" for x in r["spans"]))
                for k, v in zip(out, row):
                    out[k].append(v)
            return out

        return f

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), make, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans string")
