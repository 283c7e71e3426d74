"""License scan: normalised text against license templates.

Units of a text are its lines, its paragraphs of several lines and, where it has
several paragraphs, the whole. A unit in lower case with everything but letters and
digits made a space is compared with every template by the Dice coefficient of their
sets of word bigrams. ``d`` or more needs a size between ``d / (2 - d)`` and
``(2 - d) / d`` of the template's: other templates are not looked at.

A cheap test comes first and loses nothing: a match shares so many of a template's
bigrams that it has one of the template's ``hints``, so a text (or unit) without any
hint can't match.

Cases: null and empty texts and units of one word match nothing; a unit's best template
is the one of highest coefficient, then of least name; repeated lines are units of
their own; rows with equal ids are scanned one by one; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._spark import table

DICE = 0.8

# Headers and statements as (license, name of the template, text).
HEADERS = (
    ("MIT", "mit-line", "Released under the MIT License."),
    ("MIT", "mit-line-2", "Licensed under the MIT License."),
    ("MIT", "mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "mit-notice", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "apache-line", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "apache-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "apache-warranty", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "gpl3-line", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "gpl3-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "gpl2-line", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "cc-by-nc-line", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "cc-by-nc-name", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "cc-by-line", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "cc-by-name", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "cc-by-sa-line", "Licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "bsd-conditions", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "isc-grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "mpl-header", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "unlicense", "This is free and unencumbered software released into the public domain."),
)

# Public license texts in full, without title and copyright line.
_MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
_MIT_NOTICE = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_MIT_WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_ISC_WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
_BSD_CONDITIONS = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_SOURCE = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_BINARY = "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_WARRANTY = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_ZLIB = "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."
_UNLICENSE = "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
_GPL_NOTICE = "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."

FULL_TEXTS = (
    ("MIT", "mit-text", f"{_MIT_GRANT} {_MIT_NOTICE} {_MIT_WARRANTY}"),
    ("MIT", "mit-warranty", _MIT_WARRANTY),
    ("ISC", "isc-text", f"{_ISC_GRANT} {_ISC_WARRANTY}"),
    ("ISC", "isc-warranty", _ISC_WARRANTY),
    ("BSD-2-Clause", "bsd2-text", f"{_BSD_CONDITIONS} {_BSD_SOURCE} {_BSD_BINARY} {_BSD_WARRANTY}"),
    ("BSD-3-Clause", "bsd3-text", f"{_BSD_CONDITIONS} {_BSD_SOURCE} {_BSD_BINARY} {_BSD_NAMES} {_BSD_WARRANTY}"),
    ("BSD-3-Clause", "bsd3-names", _BSD_NAMES),
    ("Zlib", "zlib-text", _ZLIB),
    ("Unlicense", "unlicense-opening", _UNLICENSE),
    ("GPL", "gpl-warranty", _GPL_NOTICE),
)
TEMPLATES = HEADERS + FULL_TEXTS


def bigrams_of(text: str) -> list[str]:
    words = re.sub(r"[\W_]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def hints(bigrams: list[str], dice: float = DICE) -> list[str]:
    """Regular expressions of which every match of the template has one, whatever it lacks.

    A match shares ``dice / (2 - dice)`` of the template's bigrams at least. Long words
    (those of licensing first) are taken until fewer bigrams without them remain, then
    whole bigrams.
    """
    need = dice / (2 - dice) * len(bigrams) - 1e-9
    left, chosen = set(bigrams), []
    words = {w for b in bigrams for w in b.split() if len(w) >= 7}
    for word in sorted(words, key=lambda w: ("licens" not in w, -len(w), w)):
        gone = {b for b in left if word in b.split()}
        if len(left) >= need and gone:
            chosen.append(re.escape(word))
            left -= gone
    for pair in sorted(left, key=lambda b: (-len(b), b)):
        if len(left) >= need:
            chosen.append(r"[^\p{L}\p{N}]+".join(map(re.escape, pair.split())))
            left.discard(pair)
    return chosen


def any_of(words: Iterable[str]) -> str:
    """Regular expression of ``words`` where a word begins, in lower case, grouped by their first letters.

    Normalised words begin behind what is no letter or digit, so behind no ASCII one.
    """
    by_letter: dict[str, list[str]] = {}
    for w in words:
        by_letter.setdefault(w[0], []).append(w[1:])
    return "(?<![a-z0-9])(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in sorted(by_letter.items())) + ")"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _bigrams(words: Column) -> Column:
    following = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), following, lambda a, b: F.concat_ws(" ", a, b))
    return F.when(F.size(words) > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, templates=TEMPLATES, *, dice: float = DICE) -> DataFrame:
    """Matches of documents (doc_id, text): unit, position (from 0, of its kind), license, template, dice."""
    spark = docs.sparkSession
    grams = {name: bigrams_of(text) for _, name, text in templates}
    license_of = {name: lic for lic, name, _ in templates}
    chosen = sorted({h for g in grams.values() for h in hints(g, dice)}, key=lambda h: (len(h), h))
    hint = any_of(h for i, h in enumerate(chosen) if not any(h.startswith(other) for other in chosen[:i]))
    index = spark.createDataFrame([(b, license_of[n], n, len(g)) for n, g in grams.items() for b in g], "bigram string, license string, template string, size int")
    likely = docs.select("doc_id", "text").where(F.lower("text").rlike(hint)).withColumn("row", F.monotonically_increasing_id())

    def units(kind: str, parts: Column) -> Column:
        return F.transform(parts, lambda x, i: F.struct(F.lit(kind).alias("unit"), i.cast("long").alias("position"), x.alias("part")))

    paragraphs = F.split("text", r"\n[ \t\r]*\n")
    every = F.concat(
        units("line", F.split("text", "\n")),
        F.filter(units("paragraph", paragraphs), lambda u: F.contains(u["part"], F.lit("\n"))),
        F.filter(units("text", F.array("text")), lambda u: F.size(paragraphs) > 1),
    )
    found = likely.select("doc_id", "row", F.explode(every).alias("u")).select("doc_id", "row", "u.*")
    words = found.where(F.lower("part").rlike(hint)).withColumn("words", F.split(normalised(F.col("part")), " ")).drop("part")
    shaped = words.withColumn("bigrams", _bigrams(F.col("words"))).withColumn("n", F.size("bigrams")).where("n > 0").drop("words")
    low, high = dice / (2 - dice) - 1e-9, (2 - dice) / dice + 1e-9  # bounds are inclusive whatever the rounding
    largest, least = max(map(len, grams.values())), min(map(len, grams.values()))
    shaped = shaped.where((F.col("n") >= low * least) & (F.col("n") <= high * largest))
    hits = shaped.withColumn("bigram", F.explode("bigrams")).drop("bigrams").join(index, "bigram")
    hits = hits.where((F.col("n") >= F.lit(low) * F.col("size")) & (F.col("n") <= F.lit(high) * F.col("size")))
    shared = hits.groupBy("row", "doc_id", "unit", "position", "n", "license", "template", "size").agg(F.count("*").alias("shared"))
    scored = shared.withColumn("dice", F.lit(2.0) * F.col("shared") / (F.col("n") + F.col("size"))).where(F.col("dice") >= dice)
    best = Window.partitionBy("row", "unit", "position").orderBy(F.desc("dice"), "template")
    return scored.withColumn("place", F.row_number().over(best)).where("place = 1").select("doc_id", "unit", "position", "license", "template", "dice")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    rows = ", ".join(f"('{b}', '{lic}', '{name}', {len(bigrams_of(text))})" for lic, name, text in TEMPLATES for b in bigrams_of(text))
    return rf"""
WITH templates(bigram, license, template, size) AS (VALUES {rows}),
docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents WHERE text IS NOT NULL),
paragraphs AS (SELECT r, doc_id, text, regexp_split_to_array(text, '\n[ \t\r]*\n') AS p FROM docs),
units AS (
  SELECT r, doc_id, 'line' AS unit, unnest(range(len(string_split(text, chr(10))))) AS position, unnest(string_split(text, chr(10))) AS part FROM docs
  UNION ALL SELECT * FROM (SELECT r, doc_id, 'paragraph', unnest(range(len(p))) AS position, unnest(p) AS part FROM paragraphs) WHERE contains(part, chr(10))
  UNION ALL SELECT r, doc_id, 'text', 0, text FROM paragraphs WHERE len(p) > 1),
words AS (SELECT r, doc_id, unit, position, string_split(trim(regexp_replace(lower(part), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS w FROM units),
bigrams AS (SELECT r, doc_id, unit, position, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM words WHERE len(w) > 1),
shared AS (SELECT r, doc_id, unit, position, n, license, template, size, count(*) AS k
  FROM (SELECT r, doc_id, unit, position, len(b) AS n, unnest(b) AS bigram FROM bigrams) JOIN templates USING (bigram) GROUP BY ALL),
ranked AS (SELECT *, 2.0 * k / (n + size) AS dice, row_number() OVER (PARTITION BY r, unit, position ORDER BY 2.0 * k / (n + size) DESC, template) AS place FROM shared)
SELECT doc_id, unit, CAST(position AS BIGINT) AS position, license, template, CAST(dice AS DOUBLE) AS dice FROM ranked WHERE place = 1 AND dice >= {DICE}
"""


QUERIES = {"op1_license_scan": op1_license_scan}
ORACLES = {"op1_license_scan": _sql()}
