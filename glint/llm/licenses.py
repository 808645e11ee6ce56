"""Licence scan: normalised text against licence templates by the Dice
coefficient over word bigrams.

DataFrame operations only. A document is compared as a whole, by blocks
(lines between blank lines), line by line, and by every run of its words,
whatever lines, blocks or sentences it spans. Dice counts bigrams with their
repetitions, so a unit of n words has n - 1 of them without building any,
and d(A, B) >= t needs t / (2 - t) * |B| <= |A| <= (2 - t) / t * |B|: units
whose size fits no template are dropped before their bigrams are made, and
a bigram only meets templates of a fitting size. The templates are a fixed
small table (broadcast); only bigrams that occur in a template leave the
task, already counted.

Runs. The best run begins and ends with a bigram of the template. From a
first one at word s, an occurrence counts if fewer than m of its bigram (m in
the template) lie between, so if the m-th one before it lies before s; the
j-th that counts, at word e, ends a run of Dice 2j / (e - s + 1 + |B|). So
the longest run of a template bounds the work from each start. Only documents
that hold t / (2 - t) of the template's bigrams at all are searched.

Defined cases: null and empty texts match nothing; a unit of one word has no
bigram and matches nothing; each row is scanned by itself, and rows that
share an id are reported together by their best match; ties go to the whole
text before blocks before lines before runs, then to the first."""

from __future__ import annotations

import re
from collections import Counter
from math import ceil, floor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The wording of licence statements and notices.
TEMPLATES = {
    "MIT statement": "Released under the MIT License.",
    "Apache-2.0 statement": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 statement": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 statement": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 statement": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0 statement": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MPL-2.0 notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
    "the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
    "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
    "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
    "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
    "SOFTWARE.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
    "this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "
    "\"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
    "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
    "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
    "in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
    "specific language governing permissions and limitations under the License.",
    "GPL-3.0 notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
    "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
    "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
    "License for more details. You should have received a copy of the GNU General Public License along with this program. "
    "If not, see https://www.gnu.org/licenses/.",
}

KINDS = ("whole", "block", "line", "run")  # in the order of ties


def _words(text: str) -> list[str]:
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def template_bigrams(templates: dict[str, str]) -> list[tuple[str, str, int, int]]:
    """(licence, bigram, its count, bigrams of the template)."""
    out = []
    for name, text in templates.items():
        w = _words(text)
        out += [(name, b, n, len(w) - 1) for b, n in Counter(f"{x} {y}" for x, y in zip(w, w[1:])).items()]
    return out


def bounds(size: int, least: float) -> tuple[int, int]:
    """Numbers of bigrams that a unit may have to reach `least`."""
    return ceil(least / (2 - least) * size - 1e-9), floor((2 - least) / least * size + 1e-9)


def _runs(clean: DataFrame, known: DataFrame, least: float) -> DataFrame:
    """The best run of words per row and licence: Dice >= `least`."""
    w = F.split(F.trim(F.regexp_replace("text", r"[ \n]+", " ")), " ")
    n = F.greatest(F.size("w") - 1, F.lit(0))
    grams = F.zip_with(F.slice("w", F.lit(1), n), F.slice("w", F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))
    gram = clean.select("doc_id", "row", w.alias("w")).select("doc_id", "row", F.posexplode(grams).alias("pos", "bigram"))
    met = gram.join(F.broadcast(known), "bigram")
    at = met.groupBy("doc_id", "row", "license", "size", "low", "high", "bigram", "m").agg(F.sort_array(F.collect_list("pos")).alias("at"))
    # each place with the one m before it
    back = F.transform("at", lambda x, i: F.struct(
        x.alias("pos"), F.when(i >= F.col("m"), F.get("at", i - F.col("m"))).otherwise(-1).alias("back")))
    hits = at.select("*", back.alias("hits"), F.least(F.size("at"), "m").alias("c")).groupBy(
        "doc_id", "row", "license", "size", "low", "high").agg(
        F.sum("c").alias("c"), F.sort_array(F.flatten(F.collect_list("hits"))).alias("hits")).where("c >= low")

    def ends(s, i):
        near = F.filter(F.slice("hits", i + 1, F.col("high")), lambda h: (h["pos"] < s["pos"] + F.col("high")) & (h["back"] < s["pos"]))
        return F.array_min(F.transform(near, lambda h, j: F.struct(
            (-2.0 * (j + 1) / (h["pos"] - s["pos"] + 1 + F.col("size"))).alias("d"), s["pos"].alias("pos"))))

    best = hits.select("doc_id", "license", F.array_min(F.transform("hits", ends)).alias("b"))
    return best.select(
        "doc_id", "license", (-F.col("b.d")).alias("dice"), F.lit(3).alias("kind"), F.col("b.pos").alias("pos")).where(F.col("dice") >= least)


def license_scan(
    docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document and licence with a unit of Dice >= `least`:
    doc_id, license, dice, kind, position (from 0, among the units of that
    kind; of a run, its first word)."""
    spark = docs.sparkSession
    rows = template_bigrams(TEMPLATES if templates is None else templates)
    known = spark.createDataFrame(
        [(*r, *bounds(r[3], least)) for r in rows], "license string, bigram string, m int, size int, low int, high int")
    ranges: list[list[int]] = []  # of sizes that fit any template, merged
    for low, high in sorted({bounds(r[3], least) for r in rows}):
        if ranges and low <= ranges[-1][1] + 1:
            ranges[-1][1] = max(high, ranges[-1][1])
        else:
            ranges.append([low, high])

    def fits(n):
        out = F.lit(False)
        for low, high in ranges:
            out = out | n.between(max(1, low), high)
        return out

    # lower case; everything but letters, digits and line ends is one space
    text = F.regexp_replace(F.lower(F.col(text_col)), r"[^\p{L}\p{N}\n]+", " ")
    text = F.regexp_replace(text, r" ?\n ?", "\n")
    clean = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), text.alias("text"))
    clean = clean.where("text is not null")

    def units(kind: int, parts):
        parts = F.filter(F.transform(parts, lambda x: F.trim(F.replace(x, F.lit("\n"), F.lit(" ")))), lambda x: x != "")
        sized = F.transform(parts, lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("pos"), x.alias("unit"),
            (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))).alias("n")))
        return F.filter(sized, lambda u: fits(u["n"]))

    every = F.concat(
        units(0, F.array("text")), units(1, F.split("text", r"\n\n+")), units(2, F.split("text", r"\n")))
    unit = clean.select("doc_id", "row", F.inline(every))
    # the words and the words one further, side by side: the text is split
    # outside the lambda
    w = F.split("unit", " ")
    grams = F.zip_with(
        F.slice(w, F.lit(1), F.col("n")), F.slice(w, F.lit(2), F.col("n")), lambda a, b: F.concat(a, F.lit(" "), b))
    gram = unit.select("doc_id", "row", "kind", "pos", "n", F.explode(grams).alias("bigram"))
    met = gram.join(F.broadcast(known), "bigram").where(F.col("n").between(F.col("low"), F.col("high")))
    common = met.groupBy("doc_id", "row", "kind", "pos", "n", "license", "size", "bigram").agg(
        F.least(F.count(F.lit(1)), F.first("m")).alias("c"))
    key = ["doc_id", "row", "kind", "pos", "n", "license", "size"]
    dice = common.groupBy(*key).agg(F.sum("c").alias("c")).withColumn(
        "dice", 2.0 * F.col("c") / (F.col("n") + F.col("size"))).where(F.col("dice") >= least)
    out = ["doc_id", "license", "dice", "kind", "pos"]
    dice = dice.select(*out).unionByName(_runs(clean, known, least).select(*out))
    best = F.min(F.struct((-F.col("dice")).alias("d"), "kind", "pos")).alias("b")
    return dice.groupBy("doc_id", "license").agg(best).select(
        "doc_id", "license", (-F.col("b.d")).alias("dice"),
        F.element_at(F.array(*map(F.lit, KINDS)), F.col("b.kind") + 1).alias("kind"),
        F.col("b.pos").cast("int").alias("position"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), least=0.8)


def _oracle(least: float = 0.8) -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in TEMPLATES.items())
    return rf"""
WITH raw(license, t) AS (VALUES {rows}),
tw AS (SELECT license, string_split(trim(regexp_replace(lower(t), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS w FROM raw),
tb AS (SELECT license, len(w) - 1 AS size, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS bigram FROM tw),
tc AS (SELECT license, size, bigram, count(*) AS m FROM tb GROUP BY ALL),
clean AS (
  SELECT doc_id, regexp_replace(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g'), ' ?\n ?', chr(10), 'g') AS t
  FROM documents WHERE text IS NOT NULL
), parts AS (
  SELECT doc_id, 0 AS kind, [t] AS p FROM clean
  UNION ALL SELECT doc_id, 1, regexp_split_to_array(t, '\n\n+') FROM clean
  UNION ALL SELECT doc_id, 2, string_split(t, chr(10)) FROM clean
), units AS (
  SELECT doc_id, kind, list_filter(list_transform(p, lambda x: trim(replace(x, chr(10), ' '))), lambda x: x <> '') AS p FROM parts
), unit AS (
  SELECT doc_id, kind, i - 1 AS pos, string_split(p[i], ' ') AS w
  FROM (SELECT doc_id, kind, p, unnest(range(1, len(p) + 1)) AS i FROM units)
), small AS (SELECT * FROM unit WHERE len(w) > 1 AND len(w) < 1000),
grams AS (
  SELECT doc_id, kind, pos, len(w) - 1 AS n, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS bigram FROM small
), gc AS (SELECT doc_id, kind, pos, n, bigram, count(*) AS k FROM grams GROUP BY ALL),
dice AS (
  SELECT doc_id, license, kind, pos, 2.0::DOUBLE * sum(least(k, m)) / (n + size) AS dice
  FROM gc JOIN tc USING (bigram) GROUP BY doc_id, license, kind, pos, n, size
), best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, license ORDER BY dice DESC, kind, pos) AS r FROM dice WHERE dice >= {least}
)
SELECT doc_id, license, dice, CASE kind WHEN 0 THEN 'whole' WHEN 1 THEN 'block' ELSE 'line' END AS kind,
       pos::INTEGER AS position
FROM best WHERE r = 1
"""


OP9_SQL = _oracle()
