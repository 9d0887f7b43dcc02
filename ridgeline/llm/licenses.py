"""Licence scans with a generalised suffix automaton over the words of licence texts.

The automaton holds the phrases and the longer templates. Texts are streamed
through it word by word, which gives the matching statistics: at each word the
longest run ending there that occurs in any template. Phrases are read off the
suffix links of the state reached, and so are the matches that end there in a
template while a longer run goes on in another one. Matches maximal in their own
template are chained into covered spans, and a template counts when enough of it
is covered.

Only stretches whose neighbouring words also stand side by side in a template
are streamed: no match of two words or more lies outside them.

Null texts are empty. Texts without words, or without any licence, return one
row with no places and no spans. Repeated rows return repeated rows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import LOWER, Rolling, arrow_map, documents, joined

#: Phrases of the base labels (fixed values).
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

_MIT_RULE = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
_MIT_WARRANTY = "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD_RULE = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_WARRANTY = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_GNU = "{thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
_GNU_HOPE = "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."
_CC = "This work is licensed under a Creative Commons {name} International License"

#: Public licences and notices by label: whole texts of short licences, standard notices of long ones (fixed values).
TEMPLATES = (
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-3.0", f"{_GNU.format(thing='This program', name='General Public License', version='3')} {_GNU_HOPE.format(name='General Public License')}"),
    ("gpl-2.0", f"{_GNU.format(thing='This program', name='General Public License', version='2').replace('software:', 'software;')} {_GNU_HOPE.format(name='General Public License')} You should have received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."),
    ("agpl-3.0", f"{_GNU.format(thing='This program', name='Affero General Public License', version='3')} {_GNU_HOPE.format(name='Affero General Public License')}"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("lgpl-2.1", f"{_GNU.format(thing='This library', name='Lesser General Public License', version='2.1')} {_GNU_HOPE.format(name='Lesser General Public License').replace('program', 'library')}"),
    ("lgpl-3.0", f"{_GNU.format(thing='This program', name='Lesser General Public License', version='3')} {_GNU_HOPE.format(name='Lesser General Public License')}"),
    ("gfdl-1.3", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation; with no Invariant Sections, no Front-Cover Texts, and no Back-Cover Texts."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("mit", f"{_MIT_RULE} The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_MIT_WARRANTY}"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd-2-clause", f"{_BSD_RULE} {_BSD_WARRANTY}"),
    ("bsd-3-clause", f"{_BSD_RULE} {_BSD_NAMES} {_BSD_WARRANTY}"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("bsl-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so"),
    ("postgresql", "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies."),
    ("wtfpl", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("mpl-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the License); you may not use this file except in compliance with the License."),
    ("epl-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at"),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at"),
    ("cddl-1.0", "The contents of this file are subject to the terms of the Common Development and Distribution License (the License). You may not use this file except in compliance with the License."),
    ("eupl-1.2", "Licensed under the EUPL, Version 1.2 or as soon they will be approved by the European Commission subsequent versions of the EUPL (the Licence); You may not use this work except in compliance with the Licence."),
    ("artistic", "This is free software; you can redistribute it and/or modify it under the same terms as the Perl 5 programming language system itself."),
    ("ofl-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    ("odbl-1.0", "This database is made available under the Open Database License"),
    ("ms-pl", "This license governs use of the accompanying software. If you use the software, you accept this license. If you do not accept the license, do not use the software."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", _CC.format(name="Attribution 4.0")),
    ("cc-by-sa-4.0", _CC.format(name="Attribution-ShareAlike 4.0")),
    ("cc-by-nd-4.0", _CC.format(name="Attribution-NoDerivatives 4.0")),
    ("cc-by-nc-4.0", _CC.format(name="Attribution-NonCommercial 4.0")),
    ("cc-by-nc-sa-4.0", _CC.format(name="Attribution-NonCommercial-ShareAlike 4.0")),
    ("cc-by-nc-nd-4.0", _CC.format(name="Attribution-NonCommercial-NoDerivatives 4.0")),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
)

# Letters and digits after lower-casing, and every byte of other alphabets.
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True


def words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of the contract and the first word of each text (one more entry: the end)."""
    data, starts = joined(texts)
    data = LOWER[data]
    edge = np.diff(_WORD[data].astype(np.int8), prepend=0)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    hashes = Rolling(data).of(first, last) if len(first) else np.zeros(0, np.uint64)
    return hashes, np.searchsorted(first, starts)


class Automaton:
    """Generalised suffix automaton of token sequences, with the places of each state in every sequence."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.places: list[list[tuple[int, int]]] = [[]]
        for k, sequence in enumerate(sequences):
            last = 0
            for i, token in enumerate(sequence):
                last = self._extend(last, token)
                self.places[last].append((k, i))
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            self.places[self.link[state]] += self.places[state]
        self.places = [sorted(set(p)) for p in self.places]

    def _state(self, length: int, of: int | None = None) -> int:
        self.next.append(dict(self.next[of]) if of is not None else {})
        self.link.append(self.link[of] if of is not None else 0)
        self.length.append(length)
        self.places.append([])
        return len(self.link) - 1

    def _split(self, p: int, q: int, token: int) -> int:
        """The state of the longest string of p followed by token, split off q where q also holds longer ones."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, q)
        self.link[q] = copy
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, token: int) -> int:
        if token in self.next[last]:
            return self._split(last, self.next[last][token], token)
        new, p = self._state(self.length[last] + 1), last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = new
            p = self.link[p]
        if p >= 0:
            # Set only now: a split copies the link of the state it divides.
            self.link[new] = self._split(p, self.next[p][token], token)
        return new

    def stream(self, tokens: list[int]) -> list[tuple[int, int]]:
        """Matching statistics: (state, length) after each token."""
        out, state, n = [], 0, 0
        for token in tokens:
            while state and token not in self.next[state]:
                state = self.link[state]
                n = self.length[state]
            if token in self.next[state]:
                state, n = self.next[state][token], n + 1
            else:
                n = 0
            out.append((state, n))
        return out


class Index:
    """The automaton with its words, neighbour pairs and phrase states."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        self.entries = [*phrases, *((text, label) for label, text in templates)]
        self.n_phrases = len(phrases)
        hashed = [words([text])[0] for text, _ in self.entries]
        self.vocabulary = np.unique(np.concatenate(hashed))
        self.sequences = [np.searchsorted(self.vocabulary, h).tolist() for h in hashed]
        self.automaton = Automaton(self.sequences)
        n = len(self.vocabulary)
        self.pairs = np.unique([a * n + b for s in self.sequences for a, b in zip(s, s[1:], strict=False)])
        self.phrase_state: dict[int, list[int]] = {}
        for k in range(self.n_phrases):
            self.phrase_state.setdefault(self.automaton.stream(self.sequences[k])[-1][0], []).append(k)
        # Template places of each state and the word that follows there; and those that its suffix link has besides.
        a = self.automaton
        follow = lambda places: [(k, at, (*self.sequences[k], -1)[at + 1]) for k, at in sorted(places) if k >= self.n_phrases]
        self.ends = [follow(p) for p in a.places]
        self.above = [follow({*a.places[link]} - {*p}) if link > 0 else [] for p, link in zip(a.places, a.link, strict=True)]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def stretches(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Maximal runs of words whose neighbours stand side by side in a template."""
        if len(ids) < 2:
            return []
        pair = ids[:-1] * len(self.vocabulary) + ids[1:]
        near = (ids[:-1] >= 0) & (ids[1:] >= 0) & np.isin(pair, self.pairs)
        edge = np.diff(near.astype(np.int8), prepend=0, append=0)
        return list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) + 1).tolist(), strict=True))

    def scan(self, ids: np.ndarray, least: int, gap: int, share: float) -> tuple[list[tuple], list[tuple]]:
        """Phrase places (label, first, last) and template spans (label, first, last, covered, coverage) of one text."""
        places, matches, a = [], {}, self.automaton
        for start, end in self.stretches(ids):
            tokens = ids[start:end].tolist()
            stats = a.stream(tokens)
            for i, (state, n) in enumerate(stats):
                after = tokens[i + 1] if i + 1 < len(tokens) else None
                up, reach = state, n
                while up > 0:
                    for k in self.phrase_state.get(up, ()):
                        size = len(self.sequences[k])
                        if size <= reach:
                            places.append((self.entries[k][1], start + i - size + 1, start + i))
                    up = a.link[up]
                    reach = a.length[up]
                here, up, reach = self.ends[state], state, n
                while up > 0 and reach >= least:
                    for k, at, following in here:
                        if following != after:
                            matches.setdefault(k, []).append((start + i - reach + 1, start + i, at - reach + 1, at))
                    here, up = self.above[up], a.link[up]
                    reach = a.length[up]
        spans = sorted({span for k, found in matches.items() for span in self._chain(k, found, gap, share)}, key=lambda s: (s[1], s[0], s[2]))
        return sorted(set(places), key=lambda p: (p[1], p[0])), _best(spans)

    def _chain(self, k: int, found: list[tuple], gap: int, share: float) -> list[tuple]:
        """Chains of matches that go forward in text and template with small gaps in the text.

        Two matches may share words at a cut ("the" before it and after it): the
        later one counts without what it shares with the earlier one.
        """
        size, out = len(self.sequences[k]), []
        found = sorted(found)

        def shared(p: tuple, m: tuple) -> int | None:
            """Words of m that go to p in front of it; none if m adds nothing or lies too far off."""
            both = max(0, p[1] - m[0] + 1, p[3] - m[2] + 1)
            ahead = p[0] < m[0] and p[1] < m[1] and p[2] < m[2] and p[3] < m[3]
            return both if ahead and both <= m[1] - m[0] and m[0] + both <= p[1] + 1 + gap else None

        covered = [m[1] - m[0] + 1 for m in found]
        before = [-1] * len(found)
        for j, m in enumerate(found):
            own, i = covered[j], j - 1
            while i >= 0 and found[i][0] >= m[0] - size - gap:
                both = shared(found[i], m)
                if both is not None and covered[i] + own - both > covered[j]:
                    covered[j], before[j] = covered[i] + own - both, i
                i -= 1
        used = set()
        for j in sorted(range(len(found)), key=lambda j: (-covered[j], found[j])):
            chain, i = [], j
            while i >= 0 and i not in used:
                chain.append(i)
                i = before[i]
            total = sum(found[i][1] - found[i][0] + 1 for i in chain) - sum(shared(found[p], found[m]) for m, p in zip(chain, chain[1:]))
            if chain and total >= share * size:
                used.update(chain)
                out.append((self.entries[k][1], found[chain[-1]][0], found[j][1], total, total / size))
        return out


def _best(spans: list[tuple]) -> list[tuple]:
    """Spans (by first word) without those that a better one overlaps.

    Licences share sentences, so a text of one covers much of another. Better is
    one that covers as many words and more of its template; or, where a span
    leaves words out between its matches, one that covers more words and no less
    of its template. A notice that stands unbroken inside a longer one stays.
    """
    def better(t: tuple, s: tuple) -> bool:
        broken = s[2] - s[1] + 1 > s[3]
        return (t[4] > s[4] and t[3] >= s[3]) or (broken and t[4] >= s[4] and t[3] > s[3])

    open_, beaten = [], set()
    for i, s in enumerate(spans):
        open_ = [j for j in open_ if spans[j][2] >= s[1]]
        for j in open_:
            if better(spans[j], s):
                beaten.add(i)
            if better(s, spans[j]):
                beaten.add(j)
        open_.append(i)
    return [s for i, s in enumerate(spans) if i not in beaten]


@lru_cache(maxsize=4)
def _index(templates: tuple, phrases: tuple) -> Index:
    return Index(templates, phrases)


_PLACE = "array<struct<label:string,first:long,last:long>>"
_SPAN = "array<struct<label:string,first:long,last:long,covered:long,coverage:double>>"


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, least: int = 2, gap: int = 6, share: float = 0.75) -> DataFrame:
    """doc_id, n_words, phrase places and template spans of every text.

    ``least`` words make a match, ``gap`` words may stand between matches of a
    chain, ``share`` of a template's words must be covered. Counts words from 0.
    """
    templates, phrases = tuple(templates), tuple(phrases)

    def each(batch: pa.RecordBatch) -> dict[str, object]:
        index = _index(templates, phrases)
        hashes, starts = words(batch.column(1).to_pylist())
        ids = index.ids(hashes)
        found = [index.scan(ids[a:b], least, gap, share) for a, b in zip(starts[:-1], starts[1:], strict=True)]
        return {
            "doc_id": batch.column(0),
            "n_words": np.diff(starts),
            "places": [[dict(zip(("label", "first", "last"), x, strict=True)) for x in p] for p, _ in found],
            "spans": [[dict(zip(("label", "first", "last", "covered", "coverage"), x, strict=True)) for x in s] for _, s in found],
        }

    return arrow_map(documents(docs), each, f"doc_id long, n_words long, places {_PLACE}, spans {_SPAN}")


def digest(scanned: DataFrame) -> DataFrame:
    """The columns of the query: counts, first and last place, labels, and a score.

    The score is the best coverage of a template; a phrase halves what is missing
    to 1, so a phrase alone, which prose may hold as well, scores 0.5.
    """
    best = F.coalesce(F.array_max("spans.coverage"), F.lit(0.0))
    joined_labels = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.first").alias("first_word"),
        F.array_max("places.first").alias("last_word"),
        joined_labels(F.col("places.label")).alias("base_labels"),
        joined_labels(F.concat("places.label", "spans.label")).alias("labels"),
        F.when(F.size("places") > 0, 0.5 + best / 2).otherwise(best).alias("score"),
        "spans",
    )
