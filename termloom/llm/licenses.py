"""License scans: text blocks that hold most of a license template's words.

An exact set-similarity join. Template words are ordered by how many documents have
them, over the whole corpus, rarest first. A block that holds a share t of a template
with n words lacks at most n - ceil(t n) of them, so it has one of the first
n - ceil(t n) + 1 words (prefix filter), has ceil(t n) words at least (length filter), and
from the first shared word on enough words are left (positional filter). Blocks that
pass are counted in full, and the words must stand near each other: in a long line the
words of a short notice meet by chance.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Phrases and the labels that they stand for.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Fixed values: (label, text) of notices as projects commonly print them, and the paragraphs of public license texts.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("mit", "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("isc", "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    ("isc", "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("bsd", "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("gpl", "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/"),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("lgpl", "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."),
    ("agpl", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License"),
    ("agpl", "You should have received a copy of the GNU Affero General Public License along with this program. If not, see https://www.gnu.org/licenses/"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("boost", "Distributed under the Boost Software License, Version 1.0. See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("rights-reserved", "All rights reserved"),
]


def words(text: str) -> list[str]:
    return WORD.findall(text.translate(UPPER))


@dataclass
class Templates:
    """Templates with their distinct words, rarest first, and the words' places in that order."""

    labels: list[str]
    ordered: list[list[str]]
    lengths: list[int]
    percent: int
    spread: int

    @classmethod
    def of(cls, templates: list[tuple[str, str]], counts: dict[str, int], percent: int, spread: int) -> Templates:
        rows = [(label, sorted(set(words(text)), key=lambda w: (counts.get(w, 0), w)), len(words(text))) for label, text in templates]
        rows = [row for row in rows if row[1]]
        return cls([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], percent, spread)

    def least(self, words: int) -> int:
        """The smallest number of words that is `percent` of so many; whole numbers, so no rounding moves the border."""
        return -(-self.percent * words // 100)

    def index(self) -> dict[str, list[tuple[int, int]]]:
        """word -> (template, place) for the words of the prefixes."""
        out: dict[str, list[tuple[int, int]]] = {}
        for k, own in enumerate(self.ordered):
            for place, w in enumerate(own[: len(own) - self.least(len(own)) + 1]):
                out.setdefault(w, []).append((k, place))
        return out

    def matches(self, block: list[str], index: dict[str, list[tuple[int, int]]]) -> list[tuple[int, float]]:
        """(template, share of its words) for all templates of which the block holds enough, near each other."""
        known = set(block)
        first: dict[int, int] = {}
        for w in known & index.keys():
            for k, place in index[w]:
                first[k] = min(place, first.get(k, place))
        out = []
        for k, place in sorted(first.items()):
            own = self.ordered[k]
            need = self.least(len(own))
            if len(known) >= need and len(own) - place >= need and sum(w in known for w in own) >= need:
                have = most_within(block, set(own), self.spread * self.lengths[k])
                if have >= need:
                    out.append((k, have / len(own)))
        return out


def most_within(block: list[str], own: set[str], span: int) -> int:
    """The most distinct words of `own` that stand within `span` words of the block, one after the other."""
    at = [(i, w) for i, w in enumerate(block) if w in own]
    inside: Counter = Counter()
    most = start = 0
    for i, w in at:
        inside[w] += 1
        while at[start][0] <= i - span:
            gone = at[start][1]
            inside[gone] -= 1
            if not inside[gone]:
                del inside[gone]
            start += 1
        most = max(most, len(inside))
    return most


def blocks(text: str) -> Iterator[str]:
    """Every line, and every run of lines without an empty one between them."""
    run: list[str] = []
    for line in [*text.split("\n"), ""]:
        if line.strip():
            run.append(line)
            yield line
        else:
            if len(run) > 1:
                yield "\n".join(run)
            run = []


def word_counts(docs: DataFrame, vocabulary: set[str], text_col: str = "text") -> dict[str, int]:
    """In how many rows each word of the templates stands; the rest of the corpus' words are not kept."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found.update(vocabulary.intersection(words(text or "")))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "word string, n long")
    return {r["word"]: r["n"] for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, percent: int = 80, spread: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks.

    n_base counts the places where a base phrase's words stand consecutively; first_word
    and last_word are the smallest and largest of their starts, else null. blocks lists
    (label, share, text) of every line or paragraph that holds at least `percent` of a
    hundred of a template's distinct words within a run of words of its own that is at most
    `spread` times as long as the template. labels are the base labels and those of the blocks,
    distinct, sorted, joined by commas; score is the largest share, 1 with a base
    phrase, 0 with neither. Null and empty texts have no words and empty labels; a very
    long text is read whole; repeated rows are scanned each; an empty table gives no
    rows. Templates are a parameter of bounded size, and a template without words is
    left out.
    """
    chosen = TEMPLATES if templates is None else templates
    vocabulary = {w for _, text in chosen for w in words(text)}
    own = Templates.of(chosen, word_counts(docs, vocabulary, text_col), percent, spread)
    index = own.index()
    phrases = [(p.split(), label) for p, label in BASE.items()]
    ends = {p[-1] for p, _ in phrases}
    fields = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
              ("blocks", pa.list_(pa.struct([("label", pa.string()), ("share", pa.float64()), ("text", pa.string())])))]

    def read(text: str) -> tuple:
        found = words(text)
        distinct = set(found)
        starts, base = [], set()
        if not ends.isdisjoint(distinct):
            for i, w in enumerate(found):
                if w in ends:
                    for phrase, label in phrases:
                        n = len(phrase)
                        if i + 1 >= n and found[i + 1 - n : i + 1] == phrase:
                            starts.append(i + 1 - n)
                            base.add(label)
        near = []
        if not index.keys().isdisjoint(distinct):
            for block in blocks(text):
                near += [(own.labels[k], have, block) for k, have in own.matches(words(block), index)]
        score = 1.0 if base else max((have for _, have, _ in near), default=0.0)
        return (len(found), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | {n[0] for n in near})), score,
                [{"label": label, "share": have, "text": block} for label, have, block in near])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [read(t or "") for t in batch.column(1).to_pylist()]
            columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True))], ["doc_id", *(n for n, _ in fields)])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(apply, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, n_base long, first_word long, last_word long, "
                                  "base_labels string, labels string, score double, blocks array<struct<label:string,share:double,text:string>>")
