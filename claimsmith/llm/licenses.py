"""Licence detection by sparse TF-IDF cosine, with directory inheritance.

The terms of a file are compared with notices and short licences, each in a
window of as many terms that slides over the whole file, so neither comment
marks nor the way lines are wrapped matter: the terms of the templates are
weighted by their document frequency over all files, terms outside the
templates count as the rarest, and the cosine of window and template is taken
over the few terms they share. A window must hold the terms that tell its
licence from others (version, "general", "lesser", "affero"). Long licences are compared
with the whole file by the term counts of their full texts
(``licence_terms.json``). A whole licence text decides first; otherwise a
file's licence is the SPDX expression it states, if that joins several
licences, or its best window's, if that reaches ``THRESHOLD``.

A licence file (by name, or by holding a whole licence and little else)
speaks for its directory, and a file without a licence of its
own inherits from the nearest directory above it that has one. That is done
with joins on paths: the different directories are expanded into their
ancestors, joined with the directories that licence files speak for, and the
longest match is joined back to the files.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsmith.llm.common import Scratch, Shared

THRESHOLD = 0.6
#: A file this similar to a licence's full text holds that licence and little else.
WHOLE, WHOLE_TERMS = 0.8, 50
#: A window of half as many terms again that is this close overrules the ones inside it.
CLOSE = 0.9
_GPL = ("This program is free software: you can redistribute it and/or modify it under the terms of the {0} as published by "
        "the Free Software Foundation, {1} This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {0} for "
        "more details.")
_LATER = "either version {} of the License, or (at your option) any later version."
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. {}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
        "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
        "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
        "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ENDORSE = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
            "products derived from this software without specific prior written permission. ")


def _gnu(kind: str, version: str) -> tuple[str, ...]:
    return (f"under the terms of the {kind} version {version} as published by the Free Software Foundation",
            _GPL.format(kind, _LATER.format(version)), _GPL.format(kind, f"version {version} of the License."))


def _short_gnu(kind: str, version: str) -> tuple[str, ...]:
    return f"Licensed under the GNU {kind} v{version}", f"Licensed under the {kind}v{version}"


#: Headers, grants and short licences by which public licences are named.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0",
                   "you may not use this file except in compliance with the Apache License Version 2.0",
                   "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
                   "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
                   "an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for "
                   "the specific language governing permissions and limitations under the License."),
    "MIT": ("Released under the MIT License", "Licensed under the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
            "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
            "SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
            "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
            "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
            "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2",
                *_short_gnu("GPL", "2"), *_gnu("GNU General Public License", "2")),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3",
                *_short_gnu("GPL", "3"), *_gnu("GNU General Public License", "3")),
    "LGPL-2.1": ("Licensed under the GNU Lesser General Public License, version 2.1",
                 *_short_gnu("LGPL", "2.1"), *_gnu("GNU Lesser General Public License", "2.1")),
    "LGPL-3.0": ("Licensed under the GNU Lesser General Public License, version 3",
                 *_short_gnu("LGPL", "3"), *_gnu("GNU Lesser General Public License", "3")),
    "AGPL-3.0": ("Licensed under the GNU Affero General Public License, version 3",
                 *_short_gnu("AGPL", "3"), *_gnu("GNU Affero General Public License", "3")),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License", _BSD.format("")),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted",
                     _BSD.format(_ENDORSE)),
    "BSL-1.0": ("Distributed under the Boost Software License, Version 1.0", "Licensed under the Boost Software License, Version 1.0"),
    "ISC": ("Licensed under the ISC License",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
            "PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES "
            "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
            "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
            "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
            "SOFTWARE."),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
                "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "EPL-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",),
    "Unlicense": ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
                  "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
                  "purpose, commercial or non-commercial, and by any means.",),
    "Zlib": ("This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable "
             "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
             "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
             "restrictions",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-NC-SA-4.0": ("Licensed under CC BY-NC-SA 4.0",
                        "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "CC0-1.0": ("Released under CC0 1.0", "dedicated to the public domain under CC0 1.0 Universal"),
}
TEMPLATES = {name: (*own, f"SPDX-License-Identifier: {name}") for name, own in TEMPLATES.items()}
#: Terms that a window must hold if its template does, besides those of the licence's name.
TELLING = frozenset("general lesser affero mozilla boost eclipse sharealike noncommercial noderivatives endorse unencumbered "
                    "v2 v3 gplv2 gplv3 lgplv2 lgplv3 agplv3".split())
#: Terms that a window must not hold unless its template does.
BARRING = frozenset("lesser lgpl affero agpl sharealike sa noncommercial nc noderivatives noderivs nd endorse".split())
FULL_TEXTS = Path(__file__).with_name("licence_terms.json")
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|unlicense)(\.[a-z]+)?$"

terms_of = re.compile(r"[a-z0-9]+").findall
_SPDX = re.compile(r"SPDX-License-Identifier:([^\r\n]*)")


def spdx_expression(text: str) -> str | None:
    """The first SPDX expression of a text that joins licences by OR or AND,
    with single spaces; None if no tag has one. It ends before the first word
    that cannot follow."""
    for line in _SPDX.findall(text):
        out: list[str] = []
        depth = 0
        for t in re.findall(r"[A-Za-z0-9.+-]+|[()]|\S", line):
            name_next = not out or out[-1] in ("OR", "AND", "WITH", "(")
            if t == "(" and name_next:
                depth += 1
            elif t == ")" and depth and not name_next:
                depth -= 1
            elif (t in ("OR", "AND", "WITH")) == name_next or not re.fullmatch(r"[A-Za-z0-9.+-]+", t):
                break
            out.append(t)
        if depth == 0 and out and out[-1] not in ("OR", "AND", "WITH") and {"OR", "AND"} & {*out}:
            return " ".join(out).replace("( ", "(").replace(" )", ")")
    return None


def full_texts() -> dict[str, dict[str, int]]:
    """Term counts of the long licences."""
    return json.loads(FULL_TEXTS.read_text())


class Matcher:
    """Templates and the weights of their terms."""

    def __init__(self, templates: dict[str, tuple[str, ...]], held_by: dict[str, int], files: int, threshold: float,
                 texts: dict[str, dict[str, int]] | None = None):
        texts = full_texts() if texts is None else texts
        self.threshold = threshold
        rare = lambda df: math.log((1 + files) / (1 + df)) + 1
        self.number = {t: i for i, t in enumerate(sorted({t for own in templates.values() for line in own
                                                          for t in terms_of(line.lower())}))}
        self.vocabulary = {*self.number, *(t for own in texts.values() for t in own)}
        self.idf = {t: rare(held_by.get(t, 0)) for t in self.vocabulary}
        self.outside = rare(0)
        self.templates = []
        for name in sorted(templates):
            for line in templates[name]:
                terms = terms_of(line.lower())
                v = self._unit(Counter(terms))
                own = {t for t in terms_of(name.lower()) if not t.isdigit() or "apache" not in v} - {"0"}
                self.templates.append((name, len(terms), v, (own | TELLING) & v.keys(), BARRING - v.keys()))
        self.weight = np.array([self.idf[t] for t in self.number])
        self.squares = np.zeros((len(self.templates), len(self.number)))
        for i, (_, _, v, _, _) in enumerate(self.templates):
            for t, x in v.items():
                self.squares[i, self.number[t]] = x * x
        self.whole = [(name, sum(texts[name].values()), self._unit(texts[name])) for name in sorted(texts)]

    def _unit(self, counts: dict[str, int]) -> dict[str, float]:
        v = {t: n * self.idf[t] for t, n in counts.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()}

    def _whole_text(self, terms: list[str]) -> tuple[str | None, float]:
        counts = Counter(terms)
        own = {t: n * self.idf[t] for t, n in counts.items() if t in self.vocabulary}
        held = sum(x * x for x in own.values())
        size = math.sqrt(held + sum((n * self.outside) ** 2 for t, n in counts.items() if t not in self.vocabulary))
        best: tuple[str | None, float] = (None, 0.0)
        if math.sqrt(held) < WHOLE * size:  # no text can do better
            return best
        for name, length, v in self.whole:
            if 2 * len(terms) < length:
                continue
            cosine = sum(x * v[t] for t, x in own.items() if t in v) / size
            if cosine > best[1] + 1e-12:
                best = name, cosine
        # The Affero licence is the GNU licence but for its title and one section.
        return ("AGPL-3.0" if best[0] == "GPL-3.0" and "affero" in terms[:12] else best[0], best[1])

    def _window(self, terms: list[str], ids: np.ndarray, k: int) -> tuple[float, int, int]:
        """The best cosine of a window with template k, its begin and end."""
        _, width, v, needs, bars = self.templates[k]
        width = min(width, len(terms))
        inside = (ids >= 0) & (self.squares[k][ids] > 0)
        weight = np.where(ids >= 0, self.weight[ids], self.outside)
        sums = lambda x: (c := np.concatenate([[0.0], np.cumsum(x)]))[width:] - c[:-width]
        # |x restricted to the template| is at most the sum of its weights, the others count at least once each.
        held, rest = sums(np.where(inside, weight, 0)) ** 2, sums(np.where(inside, 0, weight * weight))
        best = (0.0, 0, 0)
        counts: Counter[str] = Counter()
        dot = size = 0.0
        last = -2
        for i in np.flatnonzero(held + 1e-9 >= self.threshold**2 * (held + rest)).tolist():
            if i == last + 1:
                gone, new = terms[i - 1], [terms[i + width - 1]]
                w = self.idf[gone] if gone in self.number else self.outside
                size -= (2 * counts[gone] - 1) * w * w
                counts[gone] -= 1
                dot -= w * v.get(gone, 0.0)
            else:
                counts, dot, size, new = Counter(), 0.0, 0.0, terms[i:i + width]
            for t in new:
                w = self.idf[t] if t in self.number else self.outside
                size += (2 * counts[t] + 1) * w * w
                counts[t] += 1
                dot += w * v.get(t, 0.0)
            last = i
            cosine = dot / math.sqrt(size)
            if (cosine > best[0] + 1e-9 and cosine >= self.threshold - 1e-9 and all(counts[t] for t in needs)
                    and not any(counts[t] for t in bars)):
                best = (min(cosine, 1.0), i, i + width)
        return best

    def scan(self, text: str | None) -> tuple[str | None, float, bool]:
        """A text's licence and cosine, and whether it is a licence's text and
        little else. A window inside a longer, close match of another licence
        counts for nothing; equal cosines go to the longer window, then to
        the first name."""
        terms = terms_of((text or "").lower())
        if not terms:
            return None, 0.0, False
        if len(terms) >= WHOLE_TERMS:
            name, cosine = self._whole_text(terms)
            if cosine >= WHOLE:
                return name, cosine, True
        joined = spdx_expression(text or "")
        if joined:
            return joined, 1.0, False
        ids = np.array([self.number.get(t, -1) for t in terms], np.int64)
        present = np.zeros(len(self.number))
        present[ids[ids >= 0]] = 1
        # No window can do better than all that the text has of a template.
        possible = np.flatnonzero(self.squares @ present >= self.threshold**2 - 1e-9).tolist()
        found = [(self.templates[k][0], *self._window(terms, ids, k)) for k in possible]
        found = [f for f in found if f[1] > 0]
        found = [f for f in found if not any(
            g[0] != f[0] and g[1] >= CLOSE and g[2] <= f[2] and f[3] <= g[3] and g[3] - g[2] >= 1.5 * (f[3] - f[2]) for g in found)]
        if not found:
            return None, 0.0, False
        name, cosine, first, end = min(found, key=lambda f: (-round(f[1], 9), f[2] - f[3], f[0]))
        whole = any(f[0] == name and f[1] >= WHOLE and f[3] - f[2] >= max(WHOLE_TERMS, WHOLE * len(terms)) for f in found)
        return name, cosine, whole

    def text(self, text: str | None) -> tuple[str | None, float]:
        return self.scan(text)[:2]


def term_frequencies(files: DataFrame, vocabulary: set[str], text_col: str = "text") -> tuple[dict[str, int], int]:
    """In how many texts each template term occurs, and the number of texts;
    as many rows as the templates have terms reach the driver."""
    shared = Shared(files.sparkSession, vocabulary)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[str] = Counter()
        n = 0
        for frame in frames:
            for text in frame["text"]:
                held.update(shared.value.intersection(terms_of((text or "").lower())))
                n += 1
        yield pd.DataFrame({"term": ["", *held], "n": [n, *held.values()]})

    sums = files.select(F.col(text_col).alias("text")).mapInPandas(count, "term string, n bigint").groupBy("term").agg(F.sum("n"))
    found = dict(map(tuple, sums.collect()))
    return found, found.pop("", 0)


def licence_column(text: str, matcher: Shared) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([matcher.value.scan(t) for t in texts], columns=["licence", "score", "whole"])

    return F.pandas_udf(run, "struct<licence string, score double, whole boolean>")(F.col(text))


def directory_of(path: Column) -> Column:
    """The part before the last slash; '' for a bare name."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def ancestors(directory: Column) -> Column:
    """A directory and all above it, up to ''."""
    parts = F.filter(F.split(directory, "/"), lambda p: p != "")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def scan_licences(files: DataFrame, path: Column, is_licence_file: Column | None = None, text_col: str = "text",
                  keep: tuple[str, ...] = (), templates: dict[str, tuple[str, ...]] | None = None,
                  threshold: float = THRESHOLD) -> DataFrame:
    """(*keep, path, licence, origin, score, licensed_by): one row per file.

    ``origin`` is 'own', 'inherited' or 'none'; ``licensed_by`` the directory
    an inherited licence comes from, ``score`` the cosine of the file's best
    window or whole text, 0 below the threshold. Licence files are those named
    like one, unless ``is_licence_file`` (a condition that may use
    ``__words``, a text's number of words) says which, and all that hold a
    whole licence and little else; of several in one directory the best score counts, then the first
    name. Null texts have no licence of their own; files without a path
    inherit nothing. An empty table gives no rows. Repeated rows stay.
    """
    templates = TEMPLATES if templates is None else templates
    scratch = Scratch(files.sparkSession, "licences")
    vocabulary = Matcher(templates, {}, 0, threshold).vocabulary
    held_by, n = term_frequencies(files, vocabulary, text_col)
    matcher = Shared(files.sparkSession, Matcher(templates, held_by, n, threshold))
    kept = [F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)]
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"\S+")), F.lit(0))
    speaks = F.regexp_extract(path, r"[^/]*$", 0).rlike(LICENCE_FILE) if is_licence_file is None else is_licence_file
    scored, _ = scratch.write(files.withColumn("__words", words).select(
        *kept, path.alias("path"), F.coalesce(speaks, F.lit(False)).alias("speaks"), licence_column(text_col, matcher).alias("m"))
        .select(*[f"keep_{i}" for i in range(len(keep))], "path", (F.col("speaks") | F.col("m.whole")).alias("speaks"),
                "m.licence", "m.score", directory_of(F.col("path")).alias("directory")))
    best = F.min(F.struct(-F.col("score"), "licence"))  # the greatest score, then the first name
    spoken = (scored.where("speaks and licence is not null and directory is not null").groupBy("directory")
              .agg(best.alias("b")).select(F.col("directory").alias("above"), F.col("b.licence").alias("inherited")))
    asked = scored.where("licence is null and directory is not null").select("directory").distinct()
    heirs = (asked.select("directory", F.explode(ancestors(F.col("directory"))).alias("above")).join(spoken, "above")
             .groupBy("directory").agg(F.max(F.struct(F.length("above"), "above", "inherited")).alias("n"))
             .select(F.col("directory").alias("heir"), "n.above", "n.inherited"))
    joined = scored.join(heirs, (F.col("directory") == F.col("heir")) & F.col("licence").isNull(), "left")
    origin = F.when(F.col("licence").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none")
    return joined.select(*[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)], "path",
                         F.coalesce("licence", "inherited").alias("licence"), origin.alias("origin"), "score",
                         F.col("above").alias("licensed_by"))
