"""Licence scans by a positional index of rare words.

Templates are word sequences of known licences: whole texts and notices, and short phrases.  The index
maps each template word to its places.  Words are weighed by their inverse document frequency over
all documents.  A notice can only match a file that holds words of enough of its weight and all
words of its mandatory key phrase.  Of such a file the ``RARE`` highest-IDF words that the notice has are
looked up; each place of such a word in the file and in the notice gives a relative position
(file position minus notice position), and postings are intersected by it: where enough of these words
have relative positions within the notice's drift of each other, the key phrase must stand whole, and the
words before and after it are aligned in order (the common subsequence of most weight), so words put
in or left out cost their weight and not the match.  A phrase must stand whole: its rarest word
finds it, every place of that word is looked at and all its words are compared.

Words are runs of ASCII digits, letters (case folded) and non-ASCII bytes; signs of comments and line
breaks are none.  ``score`` is the largest share of a template's weight that a file matches, 1 for a
phrase that stands whole; 0 if there is none.  Null or empty text: no words, no labels, score 0.
Repeated rows give repeated rows with equal results (each counts in the document frequencies), ties
of weight go by template order, only doc_id and text are read, and an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltrail.llm import words

RARE = 12  # of a file's words that a notice has, the rarest that are looked up
AGREE = 0.5  # share of these that must have relative positions within the notice's drift
DRIFT = 0.2  # words that may be put in, as a share of a notice's words
MATCH = 0.8  # share of a notice's weight that must be matched
BETWEEN = np.zeros(256, dtype=bool)
BETWEEN[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key: str = ""  # the phrase of a notice that must stand whole
    base: bool = False


#: Phrases and labels of the base search.
PHRASES = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
)
#: The standard wording of public licence notices.
NOTICES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "with or without fee is hereby granted"),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3", "gnu general public license"),
    Template("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", "gnu general public license"),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mozilla public license"),
    Template("apache-2", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS", "required by applicable law or agreed to in writing"),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", "creative commons attribution"),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License", "attribution sharealike"),
    Template("proprietary", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form", "no part of this publication may be reproduced"),
)
#: Whole texts of short public licences, and the notices that long ones ask for.
TEXTS = (
    Template("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""", "permission is hereby granted free of charge"),
    Template("bsd-3-clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""", "neither the name of"),
    Template("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""", "with or without fee is hereby granted"),
    Template("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""", "altered source versions must be plainly marked"),
    Template("unlicense", """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""", "released into the public domain"),
    Template("apache-2", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""", "apache license version 2"),
    Template("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""", "gnu general public license"),
    Template("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.
This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.""", "gnu lesser general public license"),
    Template("agpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""", "gnu affero general public license"),
    Template("mpl-2", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at""", "mozilla public license"),
)
TEMPLATES = (*PHRASES, *NOTICES, *TEXTS)


def lower_words(texts: list[bytes]) -> words.Words:
    return words.split([t.lower() for t in texts], BETWEEN)


def vocabulary(templates: Sequence[Template]) -> list[bytes]:
    return sorted({x for t in templates for x in t.text.encode().lower().translate(bytes(32 if BETWEEN[b] else b for b in range(256))).split()})


def hashes_of(names: list[bytes]) -> np.ndarray:
    return lower_words(names).hashes()


def document_counts(docs: DataFrame, names: list[bytes]) -> tuple[int, dict[bytes, int]]:
    """(documents, documents that hold each word), over all documents: one partial count a batch."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = words.Table(hashes_of(names), np.arange(len(names)))
        total = np.zeros(len(names) + 1, dtype=np.int64)
        for _, texts in words.parts(batches, "text"):
            w = lower_words(texts)
            which = table.get(w.hashes())
            held = np.flatnonzero(which >= 0)
            pairs = np.unique(w.text_of[held] * np.int64(len(names)) + which[held])
            total[:-1] += np.bincount(pairs % len(names), minlength=len(names))
            total[-1] += len(texts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["word", "n"])

    rows = docs.select("text").mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()  # a row a template word
    n = {r["word"]: r["n"] for r in rows}
    return n.get(len(names), 0), {x: n.get(i, 0) for i, x in enumerate(names)}


def weights(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> dict[bytes, float]:
    """Inverse document frequency of each template word."""
    names = vocabulary(templates)
    total, counts = document_counts(docs, names)
    return {x: float(np.log((1 + total) / (1 + counts[x])) + 1e-6) for x in names}


def common(seq: np.ndarray, weight: np.ndarray, words_there: np.ndarray) -> float:
    """Weight of the heaviest common subsequence of a template's words and a file's."""
    best = np.zeros(len(words_there) + 1)
    for word, gain in zip(seq.tolist(), weight.tolist()):
        best[1:] = np.maximum(best[1:], best[:-1] + gain * (words_there == word))
        best = np.maximum.accumulate(best)
    return float(best[-1])


class Index:
    """Template word -> its places in templates."""

    def __init__(self, templates: Sequence[Template], idf: dict[bytes, float]):
        self.templates = list(templates)
        names = sorted(idf)
        self.table = words.Table(hashes_of(names), np.arange(len(names)))
        self.names = len(names)
        of = {x: i for i, x in enumerate(names)}
        spaces = bytes(32 if BETWEEN[b] else b for b in range(256))

        def ids(text: str) -> np.ndarray:
            return np.array([of[x] for x in text.encode().lower().translate(spaces).split()], dtype=np.int64)

        self.seqs = [ids(t.text) for t in templates]
        weight = np.array([idf[x] for x in names])
        self.weight = [weight[s] for s in self.seqs]
        self.keys: list[tuple[int, np.ndarray]] = []
        for t, s in zip(templates, self.seqs):
            key = ids(t.key)
            at = next((i for i in range(len(s) - len(key) + 1) if len(key) and (s[i:i + len(key)] == key).all()), -1)
            if t.key and at < 0:
                raise ValueError(f"the key phrase of {t.label} isn't in its template")
            self.keys.append((at, key))
        #: A phrase's rarest word -> [(phrase, place)].
        self.phrases: dict[int, list[tuple[int, int]]] = {}
        for k, s in enumerate(self.seqs):
            if not len(self.keys[k][1]):
                i = min(range(len(s)), key=lambda i: (-weight[s[i]], i))
                self.phrases.setdefault(int(s[i]), []).append((k, i))
        self.notices = [k for k in range(len(self.seqs)) if len(self.keys[k][1])]
        #: Of each notice: its words, rarest first; the places of each; its weight by word; its key's words.
        self.rarest = {k: sorted(set(self.seqs[k].tolist()), key=lambda x: (-weight[x], x)) for k in self.notices}
        self.places = {k: {x: np.flatnonzero(self.seqs[k] == x) for x in self.rarest[k]} for k in self.notices}
        self.by_word = np.zeros((self.names, len(self.notices)))
        self.by_key = np.zeros((self.names, len(self.notices)))
        for c, k in enumerate(self.notices):
            np.add.at(self.by_word[:, c], self.seqs[k], self.weight[k])
            self.by_key[self.keys[k][1], c] = 1

    def scan(self, texts: list[bytes]) -> list[dict]:
        w = lower_words(texts)
        which = self.table.get(w.hashes())
        found: list[list[tuple[int, int, float]]] = [[] for _ in texts]  # (template, start, score)
        text = w.text_of
        held = np.flatnonzero(which >= 0)
        for word, at in self.phrases.items():
            here = held[which[held] == word]
            for k, place in at:
                start = here - place
                s = self.seqs[k]
                stands = (start >= w.first[text[here]]) & (start + len(s) <= w.first[text[here] + 1])
                start = start[stands]
                for i, x in enumerate(s.tolist()):
                    start = start[which[start + i] == x]
                for b in start.tolist():
                    found[text[b]].append((k, b - int(w.first[text[b]]), 1.0))
        holds = np.zeros((len(texts), self.names))
        holds[text[held], which[held]] = 1
        enough = holds @ self.by_word >= (MATCH - 1e-9) * self.by_word.sum(axis=0)
        enough &= holds @ self.by_key > self.by_key.sum(axis=0) - 0.5
        for d, c in np.argwhere(enough).tolist():
            here = which[w.first[d]:w.first[d + 1]]
            found[d] += self.find(self.notices[c], here, holds[d])
        return [self.summary(f, int(n)) for f, n in zip(found, np.diff(w.first))]

    def find(self, k: int, here: np.ndarray, holds: np.ndarray) -> list[tuple[int, int, float]]:
        """(k, start, share of its weight) of each place of notice k in a file's words."""
        s, weight, (at, key) = self.seqs[k], self.weight[k], self.keys[k]
        drift = 4 + int(DRIFT * len(s))
        rare = [x for x in self.rarest[k] if holds[x]][:RARE]
        starts = [np.unique(np.flatnonzero(here == x)[:, None] - self.places[k][x]) for x in rare]
        every = np.unique(np.concatenate(starts))
        votes = sum((np.searchsorted(x, every + drift, "right") > np.searchsorted(x, every, "left")).astype(int) for x in starts)
        agreed = every[votes >= AGREE * min(RARE, len(self.rarest[k]))]
        stands = np.flatnonzero(here[:max(0, len(here) - len(key) + 1)] == key[0])
        for i, x in enumerate(key.tolist()):
            stands = stands[here[stands + i] == x]
        begin = stands - at
        stands = stands[np.searchsorted(agreed, begin + drift, "right") > np.searchsorted(agreed, begin - 2 * drift, "left")]
        total, out = weight.sum(), []
        for b in stands.tolist():
            before = here[max(0, b - at - drift):b]
            after = here[b + len(key):b - at + len(s) + drift]
            got = common(s[:at], weight[:at], before) + weight[at:at + len(key)].sum() + common(s[at + len(key):], weight[at + len(key):], after)
            if got >= MATCH * total:
                out.append((k, max(0, b - at), min(1.0, float(got / total))))
        return out

    def summary(self, found: list[tuple[int, int, float]], n_words: int) -> dict:
        base = [(k, s) for k, s, _ in found if self.templates[k].base]
        return {
            "n_words": n_words, "n_base": len(base), "first_word": min((s for _, s in base), default=None), "last_word": max((s for _, s in base), default=None),
            "base_labels": sorted({self.templates[k].label for k, _ in base}), "labels": sorted({self.templates[k].label for k, _, _ in found}), "score": max((x for _, _, x in found), default=0.0),
            "places": [{"label": self.templates[k].label, "word": s, "score": x} for k, s, x in sorted(found, key=lambda f: (f[1], f[0]))],
        }


RESULT = "struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,base_labels:array<string>,labels:array<string>,score:double,places:array<struct<label:string,word:bigint,score:double>>>"


def licenses(text: Column, idf: dict[bytes, float], templates: Sequence[Template] = TEMPLATES) -> Column:
    """struct of what each whole text holds: counts, labels, score, and every place of a template."""

    @F.arrow_udf(RESULT)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = Index(templates, idf)
        place = pa.struct([("label", pa.string()), ("word", pa.int64()), ("score", pa.float64())])
        kind = pa.struct([*((c, pa.int64()) for c in ("n_words", "n_base", "first_word", "last_word")), ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("score", pa.float64()), ("places", pa.list_(place))])
        for column in batches:
            out = []
            for _, texts in words.parts([pa.RecordBatch.from_arrays([column], ["t"])], "t"):
                out += index.scan(texts)
            yield pa.array(out, kind)

    return scan(text)


def scan_documents(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """doc_id and what its whole text holds; word weights are those of ``docs``."""
    idf = weights(docs, templates)
    return docs.select("doc_id", licenses(F.col("text"), idf, templates).alias("found")).select("doc_id", "found.*")


def digests(docs: DataFrame) -> DataFrame:
    found = scan_documents(docs)
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")
