"""Licence scan: sparse TF-IDF cosine to templates, then inheritance along directories.

Every file's text is cut into lines and into blocks (runs of non-blank lines); lines,
blocks and the whole text are compared with licence templates by the cosine of their
TF-IDF vectors. The vector space has a dimension for every word of the templates,
weighted ``1 + ln((1 + lines) / (1 + lines with the word))`` over all lines of the
corpus; all other words weigh 1, the least weight there is, and only lengthen a
vector. A line, block or text matches if its best template scores ``MIN_SCORE`` or more.

Templates of different licences may differ by one word ("version 2", "version 3"), so
licences whose scores are within ``NEAR`` of the best are told apart by the words that only
one of the two templates has: the weight of those words on which the text agrees with a template
(present in both or absent in both) minus the weight of the others, over the weight of all. A match
names the licence that leads every near one by ``MARGIN`` or more; if none does (a clause
that two licences share, a name without its version) it is ``AMBIGUOUS``.

A file's own licence is its best match that names a licence (ties: the licence's name), else
``AMBIGUOUS`` with the best score if it has matches, else null.

Files without a licence of their own take that of the nearest directory above that has a
licence file: one that is named like it, or whose whole text or first line matches (of several
in one directory one that names a licence, then the best score, then the smallest path, then the
licence's name). Only directories are joined with their ancestors; files are joined with their directory once. A directory that is above very many
others, or holds very many files, is joined without moving their rows (``common.join_one``).

Null texts have no licence of their own, null paths lie in no directory. Rows that
repeat a path are files of their own. Extra columns are left out, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from hourcast.llm.common import join_one, pick, prepare
from hourcast.sinks.util import materialize

MIN_SCORE = 0.7
#: Licences that score this much less than the best one are no rivals of it.
NEAR = 0.15
#: Lead on the telling words that names a licence; 1 is all of them, 0 as many as the rival.
MARGIN = 0.25
AMBIGUOUS = "ambiguous"
LICENSE_FILE = r"(?i)^(licen[cs]e|copying|notice|unlicense)([-._].*)?$"

#: SPDX identifiers and the names that texts use for them.
NAMES = {
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPLv3"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache 2.0 License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License"],
    "BSL-1.0": ["Boost Software License, Version 1.0"],
    "CC0-1.0": ["CC0 1.0 Universal Public Domain Dedication", "CC0 1.0"],
    "EPL-1.0": ["Eclipse Public License 1.0"],
    "EPL-2.0": ["Eclipse Public License 2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU GPL v2", "GPLv2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU GPL v3", "GPLv3"],
    "ISC": ["ISC License"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "GNU LGPL v2.1", "LGPLv2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU LGPL v3", "LGPLv3"],
    "MIT": ["MIT License"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0"],
    "Unlicense": ["Unlicense"],
    "Zlib": ["zlib License"],
}
#: The Creative Commons kinds and the word that follows each version.
CC_KINDS = {"BY": "Attribution", "BY-NC": "Attribution-NonCommercial", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
            "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-SA": "Attribution-ShareAlike"}
CC_VERSIONS = {"2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}

_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: ")
_BSD_CLAUSES = ("1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
                "conditions and the following disclaimer in the documentation and/or other materials provided with the "
                "distribution. ")
_BSD_THIRD = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
              "products derived from this software without specific prior written permission. ")
_BSD_DISCLAIMER = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
                   "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
                   "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
                   "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
                   "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
                   "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
                   "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: ")
_MIT_REST = ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
             "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
             "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
             "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
             "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
             "THE SOFTWARE.")
#: Public licence notices.
NOTICES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
    ],
    "BSD-2-Clause": [_BSD, _BSD + _BSD_CLAUSES + _BSD_DISCLAIMER],
    "BSD-3-Clause": [_BSD, _BSD + _BSD_CLAUSES + _BSD_THIRD + _BSD_DISCLAIMER],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "MIT": [_MIT, _MIT + _MIT_REST],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
        "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions:",
    ],
    "proprietary": ["All rights reserved."],
}
#: The GNU licences' names and versions, and their common notice.
GNU = {"AGPL-3.0": ("GNU Affero General Public License", "3"), "GPL-2.0": ("GNU General Public License", "2"),
       "GPL-3.0": ("GNU General Public License", "3"), "LGPL-2.1": ("GNU Lesser General Public License", "2.1"),
       "LGPL-3.0": ("GNU Lesser General Public License", "3")}
GNU_NOTICE = ("This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published "
              "by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.")


def templates() -> dict[str, list[str]]:
    """Licence texts by SPDX identifier: a line for each name and phrase, identifier lines, and the notices."""
    names = {k: [f"the {name}" for name in v] for k, v in NAMES.items()}
    for kind, words in CC_KINDS.items():
        for version, last in CC_VERSIONS.items():
            names[f"CC-{kind}-{version}"] = [f"CC {kind} {version}", f"a Creative Commons {words} {version} {last} License"]
    out: dict[str, list[str]] = {}
    for spdx, known in names.items():
        out[spdx] = [f"SPDX-License-Identifier: {spdx}"]
        for name in known:
            out[spdx] += [f"Licensed under {name}.", f"Released under {name}.", f"This work is licensed under {name}."]
    for spdx, (name, version) in GNU.items():
        out[spdx] += [f"SPDX-License-Identifier: {spdx}{form}" for form in ("-only", "-or-later")]
        out[spdx] += [f"{name} Version {version}", GNU_NOTICE.format(name=name, version=version)]
    for spdx, texts in NOTICES.items():
        out.setdefault(spdx, []).extend(texts)
    return out


TEMPLATES = templates()
#: Lines, blocks or texts that are compared at once.
STEP = 2048
#: Trimmed from both ends of a word.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”‘’"


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-case words of all texts, trimmed of punctuation, and the text each belongs to."""
    lists = pc.ascii_split_whitespace(pc.utf8_lower(texts.cast(pa.large_string())))
    words = pc.utf8_trim(lists.flatten(), characters=PUNCTUATION)
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    full = pc.greater(pc.binary_length(words), 0)
    return words.filter(full), owner[full.to_numpy(zero_copy_only=False)]


class Space:
    """The templates' words as dimensions."""

    def __init__(self, templates: dict[str, list[str]]) -> None:
        flat = [(name, t) for name in sorted(templates) for t in templates[name]]
        self.names = [n for n, _ in flat]
        self.texts = pa.array([t for _, t in flat], pa.string())
        self.words = pc.unique(_words(self.texts)[0])
        self._idf = self._target = self._has = None

    def vectors(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, word, count) of the templates' words that each text has, and the number of other words of each text."""
        words, owner = _words(texts)
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False)
        known, n = at >= 0, len(self.words)
        cell, count = np.unique(owner[known] * n + at[known], return_counts=True)
        return cell // n, cell % n, count, np.bincount(owner[~known], minlength=len(texts))

    def compare(self, texts: pa.Array, idf: np.ndarray, min_score: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Texts that match, the template that each is nearest to (-1: ambiguous), and their scores."""
        if self._idf is not idf:
            self._prepare(idf)
        text, word, count, others = self.vectors(texts)
        weight = count * idf[word]
        known = np.bincount(text, weight ** 2, minlength=len(texts))
        may = np.flatnonzero((known > 0) & (known >= 0.999 * min_score ** 2 * (known + others)))  # else no cosine gets there
        place = np.full(len(texts), -1)
        place[may] = np.arange(len(may))
        inside = place[text] >= 0
        vector = np.zeros((len(may), len(self.words)))
        vector[place[text[inside]], word[inside]] = weight[inside]
        score = vector @ self._target.T / np.sqrt(known + others)[may][:, None]
        top = score.max(axis=1) if len(may) else np.zeros(0)
        hit = np.flatnonzero(top >= min_score)
        best = np.array([self._name(vector[i] > 0, score[i], idf) for i in hit.tolist()], dtype=np.int64)
        return may[hit], best, top[hit]

    def _prepare(self, idf: np.ndarray) -> None:
        text, word, count, _ = self.vectors(self.texts)
        mine = np.zeros((len(self.texts), len(self.words)))
        mine[text, word] = count * idf[word]
        self._target = mine / np.sqrt((mine ** 2).sum(axis=1, keepdims=True))
        self._has, self._idf = mine > 0, idf

    def _name(self, has: np.ndarray, score: np.ndarray, idf: np.ndarray) -> int:
        """The template whose licence leads all near ones on the words that tell the two apart, or -1."""
        near: dict[str, int] = {}
        for t in np.flatnonzero(score >= score.max() - NEAR).tolist():
            name = self.names[t]
            if name not in near or score[t] > score[near[name]]:
                near[name] = t
        which = np.array(sorted(near.values(), key=lambda t: (-score[t], t)))
        for a in which.tolist():
            if (self._leads(has, a, which[which != a], idf) >= MARGIN).all():
                return a
        return -1

    def _leads(self, has: np.ndarray, a: int, rivals: np.ndarray, idf: np.ndarray) -> np.ndarray:
        """By how much the text is nearer to template ``a`` than to each rival, -1 to 1, on the words only one of the two has."""
        tell, weight = self._has[a] != self._has[rivals], idf ** 2
        total = tell @ weight
        return (tell @ np.where(has == self._has[a], weight, -weight)) / np.where(total > 0, total, 1)


def _lines(text: str) -> list[str]:
    return [x for x in text.split("\n") if x.strip()]


def _blocks(text: str) -> list[str]:
    return [x for x in re.split(r"\n[ \t\r]*\n", text) if "\n" in x.strip()]


def word_weights(df: DataFrame, space: Space, text_col: str = "text") -> np.ndarray:
    """Weights of the templates' words over all lines of ``df`` (one number a word reaches the driver)."""
    prepare(df.sparkSession)
    d = pick(df, text=text_col).where("text is not null")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, lines = np.zeros(len(space.words), dtype=np.int64), 0
        for batch in it:
            some = pa.array([x for t in batch.column("text").to_pylist() for x in _lines(t)], pa.string())
            lines += len(some)
            for i in range(0, len(some), STEP):
                seen += np.bincount(space.vectors(some.slice(i, STEP))[1], minlength=len(seen))
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(seen)), pa.int32()), pa.array([lines, *seen.tolist()], pa.int64())],
                                         names=["word", "n"])

    n = {r["word"]: r["n"] for r in d.mapInArrow(run, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()}
    seen = np.array([n.get(i, 0) for i in range(len(space.words))])
    return 1 + np.log((1 + n.get(-1, 0)) / (1 + seen))


def scan(df: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text",
         templates: dict[str, list[str]] | None = None, min_score: float = MIN_SCORE) -> DataFrame:
    """(id, path, own, score, opens, whole) per row: its licence, its match's score, and whether its first line or whole text match."""
    space = Space(templates or TEMPLATES)
    idf = word_weights(df, space, text_col)
    d = pick(df, id=id_col, path=path_col, text=text_col)
    id_type = d.schema["id"].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            segments, owner, role = [], [], []  # role: 0 first line, 1 line or block, 2 whole text
            for i, text in enumerate(batch.column("text").to_pylist()):
                for k, (kind, parts) in enumerate(((1, _lines(text or "")), (1, _blocks(text or "")), (2, [text or ""]))):
                    segments += parts
                    owner += [i] * len(parts)
                    role += [0 if not k and not j else kind for j in range(len(parts))]
            own, top = [None] * batch.num_rows, np.zeros(batch.num_rows)
            opens, whole = np.zeros(batch.num_rows, dtype=bool), np.zeros(batch.num_rows, dtype=bool)
            for i in range(0, len(segments), STEP):
                at, best, value = space.compare(pa.array(segments[i:i + STEP], pa.string()), idf, min_score)
                for s, t, v in zip((at + i).tolist(), best.tolist(), value.tolist(), strict=True):
                    k = owner[s]
                    opens[k] |= role[s] == 0
                    whole[k] |= role[s] == 2
                    name = space.names[t] if t >= 0 else AMBIGUOUS
                    if own[k] is None or (own[k] == AMBIGUOUS, -top[k], own[k]) > (t < 0, -v, name):
                        top[k], own[k] = v, name
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("path"), pa.array(own, pa.string()), pa.array(top), pa.array(opens), pa.array(whole)],
                names=["id", "path", "own", "score", "opens", "whole"])

    return d.mapInArrow(run, f"id {id_type}, path string, own string, score double, opens boolean, whole boolean")


def inherit(files: DataFrame, license_file: str = LICENSE_FILE) -> DataFrame:
    """Adds license, license_from and levels_up to ``scan``'s rows (0 levels: its own or its own directory's)."""
    files = files.withColumn("dir", F.regexp_replace(F.regexp_extract("path", r"^(.*/)?[^/]*$", 1), "/$", ""))
    files = materialize(files, "license_files")
    named = F.element_at(F.split("path", "/"), -1).rlike(license_file)
    best = F.min(F.struct((F.col("own") == AMBIGUOUS).alias("vague"), (-F.col("score")).alias("less"), "path", "own")).alias("best")  # pre-aggregated: a directory may be huge
    governing = (files.where("own is not null and path is not null").where(F.col("opens") | F.col("whole") | named)
                 .groupBy("dir").agg(best)
                 .select(F.col("dir").alias("above"), F.col("best.own").alias("license"), F.col("best.path").alias("license_from")))
    parts = F.split("dir", "/")
    dirs = files.where("path is not null").select("dir").distinct().withColumn("parts", parts)
    dirs = dirs.withColumn("levels", F.when(F.col("dir") == "", 0).otherwise(F.size("parts")))
    above = dirs.withColumn("up", F.explode(F.sequence(F.lit(0), F.col("levels")))).withColumn(
        "above", F.array_join(F.slice("parts", 1, F.col("levels") - F.col("up")), "/"))
    above = materialize(above.select("dir", "up", "above"), "ancestors")
    nearest = join_one(above, governing, "above").groupBy("dir").agg(F.min(F.struct("up", "license", "license_from")).alias("near"))
    out = join_one(files, nearest, "dir", "left")
    own = F.col("own").isNotNull()
    return out.select(
        "id", "path", "own", "score",
        F.when(own, F.col("own")).otherwise(F.col("near.license")).alias("license"),
        F.when(own, F.col("path")).otherwise(F.col("near.license_from")).alias("license_from"),
        F.when(own, F.lit(0)).otherwise(F.col("near.up")).cast("long").alias("levels_up"))
