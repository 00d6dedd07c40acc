"""License scan: texts compared with licence notices and full licences by Dice coefficient, in DataFrame operations only.

A text is normalised as a whole, across its lines: lower case, words of letters and digits only.  Its word
bigrams, in order, are compared with each template's: a window of as many bigrams as the template has is scored by the
Dice coefficient of the two sets of bigrams, ``2 * shared / (|A| + |B|)``.  A licence is found wherever it stands: in a
comment's wrapped lines, behind a copyright line, or inside other text.

No more can be shared than the smaller set has, so a template of n distinct bigrams only reaches t in a window that
shares ``need = ceil(t * n / (2 - t))`` of them, and only in texts of at least as many bigrams.  That prunes in three steps:

* a text must hold one of any ``n - need + 1`` bigrams of a template: the longest ones, tested for all templates
  at once in a hash set.  Most texts end here;
* of what is left, a template's bigrams in the whole text must be ``need`` at least;
* windows are anchored: each occurrence of a template's bigram puts the window where the template would begin.

Texts are judged alone, so nothing is shuffled.

Defined results: null and empty texts and texts of fewer than two words match nothing.  A window is cut off at
the text's ends.  Names that several templates share are found once; the best score is that of the best window, ties by name.
Other columns are ignored; a repeated or null doc_id is a row like any other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ratio

THRESHOLD = "0.8"

#: The usual one-line notices of public licences.
TEMPLATES = {
    "AGPL-3.0": "This program is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Released under the ISC License.",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

_AS_IS_MIT = """The software is provided "as is", without warranty of any kind, express or implied, including but not limited
to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or
copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise,
arising from, out of or in connection with the software or the use or other dealings in the software."""

_AS_IS_BSD = """This software is provided by the copyright holders and contributors "as is" and any express or implied warranties,
including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed. In
no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or
consequential damages (including, but not limited to, procurement of substitute goods or services; loss of use, data, or
profits; or business interruption) however caused and on any theory of liability, whether in contract, strict liability, or
tort (including negligence or otherwise) arising in any way out of the use of this software, even if advised of the
possibility of such damage."""

_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. """

#: Full texts of licences, and the usual header of files under longer ones.
FULL_TEXTS = {
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions
and limitations under the License.""",
    "BSD-2-Clause": _BSD_2 + _AS_IS_BSD,
    "BSD-3-Clause": _BSD_2 + """3. Neither the name of the copyright holder nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written permission. """ + _AS_IS_BSD,
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. The software is provided
"as is" and the author disclaims all warranties with regard to this software including all implied warranties of
merchantability and fitness. In no event shall the author be liable for any special, direct, indirect, or consequential damages
or any damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other
tortious action, arising out of or in connection with the use or performance of this software.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
shall be included in all copies or substantial portions of the Software. """ + _AS_IS_MIT,
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def bigrams(w: Column) -> Column:
    """The bigrams of an array of words, in order."""
    pairs = F.transform(F.sequence(F.lit(1), F.size(w) - 1),
                        lambda i: F.concat_ws(" ", F.element_at(w, i), F.element_at(w, i + 1)))
    return F.when(F.size(w) > 1, pairs).otherwise(F.array().cast("array<string>"))


@dataclass(frozen=True)
class Template:
    """A licence text's distinct bigrams in the order of their first places, and how many a window must share."""

    name: str
    size: int                   # bigrams, repeated ones too
    marks: tuple[str, ...]
    places: tuple[int, ...]
    need: int

    @classmethod
    def of(cls, name: str, text: str, threshold: str) -> Template:
        import regex

        w = regex.findall(r"[\p{L}\p{N}]+", text.lower())
        first: dict[str, int] = {}
        for i, pair in enumerate(zip(w, w[1:])):
            first.setdefault(" ".join(pair), i)
        if not first:
            raise ValueError(f"a template needs two words or more: {text!r}")
        low, _ = size_bounds(len(first), threshold)
        return cls(name, len(w) - 1, tuple(first), tuple(first.values()), low)

    def anchors(self) -> list[str]:
        """Bigrams of which every window that reaches the threshold holds one."""
        return sorted(self.marks, key=lambda m: (-len(m), m))[:len(self.marks) - self.need + 1]

    def column(self) -> Column:
        return F.struct(F.lit(self.name).alias("name"), F.lit(self.size).alias("size"), F.lit(self.need).alias("need"),
                        F.array(*map(F.lit, self.marks)).alias("marks"), F.array(*map(F.lit, self.places)).alias("places"))


def templates(threshold: str = THRESHOLD, texts: dict[str, str] | None = None) -> list[Template]:
    given = sorted(texts.items()) if texts else [*sorted(TEMPLATES.items()), *sorted(FULL_TEXTS.items())]
    return [Template.of(name, text, threshold) for name, text in given]


def size_bounds(n: int, threshold: str) -> tuple[int, int]:
    """The sizes that a set may have to reach the threshold with one of ``n`` members."""
    num, den = ratio(threshold)
    return -(-num * n // (2 * den - num)), (2 * den - num) * n // num


def _best(b: Column, t: Column) -> Column:
    """The highest Dice coefficient of a template with the windows anchored on its bigrams, or null."""
    places = F.filter(F.sequence(F.lit(0), F.size(b) - 1), lambda i: F.array_contains(t["marks"], F.get(b, i)))
    # Where the template would begin, perhaps before the text does: there the window is cut off.
    lead = F.transform(
        places, lambda i: i - F.element_at(t["places"], F.array_position(t["marks"], F.get(b, i)).cast("int")))

    def dice(s: Column) -> Column:
        begin = F.greatest(F.lit(0), s)
        window = F.array_distinct(F.slice(b, begin + 1, F.greatest(F.lit(0), s + t["size"] - begin)))
        return 2.0 * F.size(F.array_intersect(window, t["marks"])) / (F.size(window) + F.size(t["marks"]))

    return F.array_max(F.transform(F.array_distinct(lead), dice))


def license_scan(docs: DataFrame, threshold: str = THRESHOLD, texts: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, n_words, n_matches, licenses, best_license, best_score) of every row of ``docs``.

    ``licenses``: the names found, sorted; ``n_matches``: how many.  ``texts`` replaces the templates: name to text.
    """
    marks = templates(threshold, texts)
    num, den = ratio(threshold)
    anchors = F.array(*map(F.lit, sorted({a for t in marks for a in t.anchors()})))
    listed = F.array(*[t.column() for t in marks])
    none = F.array().cast("array<struct<score:double,name:string>>")

    def found(b: Column) -> Column:
        each = F.transform(F.filter(listed, lambda t: (F.size(b) >= t["need"]) & (F.size(F.array_intersect(b, t["marks"])) >= t["need"])),
                           lambda t: F.struct(_best(b, t).alias("score"), t["name"].alias("name")))
        return F.filter(each, lambda m: m["score"] >= num / den)

    # one step per column: what a later step uses more than once is computed once
    rows = docs.select("doc_id", words(F.coalesce("text", F.lit(""))).alias("w"))
    rows = rows.select("doc_id", F.size("w").cast("long").alias("n_words"), bigrams(F.col("w")).alias("b"))
    rows = rows.select("doc_id", "n_words", F.when(F.arrays_overlap("b", anchors), found(F.col("b"))).otherwise(none).alias("found"))
    rows = rows.withColumn("names", F.array_sort(F.array_distinct(F.transform("found", lambda m: m["name"]))))
    rows = rows.withColumn("top", F.array_max(F.transform("found", lambda m: m["score"])))
    best = F.array_min(F.transform(F.filter("found", lambda m: m["score"] == F.col("top")), lambda m: m["name"]))
    return rows.select("doc_id", "n_words", F.size("names").cast("long").alias("n_matches"),
                       F.array_join("names", ",").alias("licenses"), best.alias("best_license"), F.col("top").alias("best_score"))
