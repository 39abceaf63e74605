"""Licence scan: sparse TF-IDF cosine to templates, then inheritance along
directories (native DataFrame functions).

A *passage* is a line, a block of neighbouring lines of one kind (comment lines, or
lines of text without a blank one between) or the whole text of a licence file.
Passages and templates are vectors of terms ``[a-z0-9]+``, weighted by term count
times idf over all texts; the best template by cosine is a match from
``threshold`` on.  Templates are a parameter: pairs of licence and text, any number
of texts per licence.

No word list decides what is compared.  Of a template's unit vector, the rarest
terms whose removal leaves a norm below the threshold are its *anchors*; a passage
without an anchor of any template cannot reach the threshold, and is skipped.  For
the others the weights of template terms give the dot products, and a norm of at
least those weights and 1 for any other term; where even that allows a match, the
terms are joined with the table of all idfs for the exact norm.

A file has the licence of its best passage; a file without one has that of the nearest
directory above it that holds a licence file with a match.  For that, only distinct
directories are joined with their ancestors, and files with their directory.

Defined results: a null or empty text has no passage; a null path is no file
(its row is returned without a licence), nor is a null file id, whose row can only
inherit; equal scores go to the smaller licence name; of several licence files in a
directory the best counts; repeated rows get the same answer each, and different
texts of one file id are compared one by one, the best counts.  An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm.common import staged, table

THRESHOLD = 0.5
#: Names of licence files, blank lines and the starts of comment lines (fixed values).
LICENCE_FILE = r"(?i)(^|/)(un)?(licen[sc]e|copying|notice)(\.[a-z]+)?$"
BLANK = r"^[ \t\r]*$"
COMMENT = r"^[ \t]*(#|//|/\*|\*|--|;|%|<!--)"

_GNU = ("This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} as published "
        "by the Free Software Foundation, {2}. This {0} is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "{1} for more details.")
_LATER = "either version {} of the License, or (at your option) any later version"
_AS_IS = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
          "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
          "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
          "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
          "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
          "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
          "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. ")
_BSD_3 = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
          "products derived from this software without specific prior written permission. ")
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction')
_MIT_REST = (", including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or "
             "sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
             "following conditions: The above copyright notice and this permission notice shall be included in all copies or "
             'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR '
             "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
             "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
             "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
             "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.")
_APACHE = ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
           "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0")
_UNLICENSE = "This is free and unencumbered software released into the public domain."
_CC = "This work is licensed under a Creative Commons {} International License."

#: Public licence notices, headers and texts by licence identifier.
TEMPLATES = (
    ("AGPL-3.0", "GNU Affero General Public License, version 3, 19 November 2007"),
    ("AGPL-3.0", _GNU.format("program", "Affero General Public License", _LATER.format(3))),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", _APACHE + " Unless required by applicable law or agreed to in writing, software distributed under the License "
     'is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the '
     "License for the specific language governing permissions and limitations under the License."),
    ("BSD-2-Clause", _BSD + _AS_IS),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "under the BSD 3-Clause License."),
    ("BSD-3-Clause", _BSD + _BSD_3 + _AS_IS),
    ("CC-BY-4.0", _CC.format("Attribution 4.0")),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", _CC.format("Attribution-NonCommercial 4.0")),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", _CC.format("Attribution-ShareAlike 4.0")),
    ("CC0-1.0", "Creative Commons CC0 1.0 Universal Public Domain Dedication"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
                "this work."),
    ("GPL-2.0", "GNU General Public License, version 2, June 1991"),
    ("GPL-2.0", _GNU.format("program", "General Public License", _LATER.format(2))),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU General Public License, version 3, 29 June 2007"),
    ("GPL-3.0", _GNU.format("program", "General Public License", _LATER.format(3))),
    ("ISC", _ISC),
    ("LGPL-2.1", "GNU Lesser General Public License, version 2.1, February 1999"),
    ("LGPL-2.1", _GNU.format("library", "Lesser General Public License", _LATER.format("2.1"))),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3, 29 June 2007"),
    ("LGPL-3.0", _GNU.format("library", "Lesser General Public License", _LATER.format(3))),
    ("MIT", "Released under the MIT License."),
    ("MIT", _MIT),
    ("MIT", _MIT + _MIT_REST),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", _UNLICENSE),
    ("Unlicense", _UNLICENSE + " Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, "
                  "either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by "
                  "any means."),
)


def terms_of(text: Column) -> Column:
    return F.array_remove(F.split(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "), " "), "")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, as a lambda variable."""
    return F.transform(F.array(value), body)[0]


def _kind(line: Column) -> Column:
    return F.when(line.rlike(BLANK), 0).when(line.rlike(COMMENT), 1).otherwise(2)


def _blocks(lines: Column) -> Column:
    """(place, passage) of the runs of at least two neighbouring lines of one
    kind, blank ones aside; place is the negative number of the first line."""
    def cut(lines: Column, kinds: Column, starts: Column) -> Column:
        after = lambda j: F.coalesce(F.get(starts, j + 1), F.size(lines) + 1)
        runs = F.transform(starts, lambda i, j: F.struct(i.alias("start"), (after(j) - i).alias("n")))
        runs = F.filter(runs, lambda r: (r["n"] > 1) & (F.get(kinds, r["start"] - 1) > 0))
        return F.transform(runs, lambda r: F.struct(
            (-r["start"]).alias("place"), F.array_join(F.slice(lines, r["start"], r["n"]), "\n").alias("passage")))

    def starts(kinds: Column) -> Column:
        return F.filter(F.sequence(F.lit(1), F.size(kinds)),
                        lambda i: (i == 1) | (F.get(kinds, i - 1) != F.get(kinds, i - 2)))

    return _let(lines, lambda ls: _let(F.transform(ls, _kind), lambda ks: _let(starts(ks), lambda ss: cut(ls, ks, ss))))


def passages(files: DataFrame, anchors: Sequence[str]) -> DataFrame:
    """(file, version, place, terms) of the passages of ``files`` (file, path,
    text) that hold one of ``anchors``: the whole text of a licence file at place
    0, lines at their number from 1, blocks at the negative number of their
    first line.  version tells the texts of one file id apart."""
    sought = F.array(*map(F.lit, anchors)).cast("array<string>")
    lines = F.transform(F.split("text", "\n"), lambda line, i: F.struct((i + 1).alias("place"), line.alias("passage")))
    whole = F.when(F.col("path").rlike(LICENCE_FILE), F.array(F.struct(F.lit(0).alias("place"), F.col("text").alias("passage"))))
    every = F.concat(F.coalesce(whole, F.array().cast("array<struct<place:int,passage:string>>")), lines,
                     _blocks(F.split("text", "\n")))
    return (
        files.where(F.col("path").isNotNull() & F.arrays_overlap(terms_of(F.col("text")), sought))
        .select("file", F.xxhash64("text").alias("version"), F.inline(every))
        .select("file", "version", "place", terms_of(F.col("passage")).alias("terms"))
        .where(F.arrays_overlap("terms", sought)))


def template_vectors(templates: Sequence[tuple[str, str]], df: DataFrame, total: int) -> DataFrame:
    """(template, licence, term, weight, v): the idf weight of every template term
    and its part of the unit vector.  Bounded by the templates."""
    spark = df.sparkSession
    rows = [(k, licence, text) for k, (licence, text) in enumerate(templates)]
    counted = spark.createDataFrame(rows, "template int, licence string, text string") \
        .select("template", "licence", F.explode(terms_of(F.col("text"))).alias("term")) \
        .groupBy("template", "licence", "term").agg(F.count(F.lit(1)).alias("tf"))
    size = Window.partitionBy("template")  # the terms of one template
    w = F.col("tf") * F.col("weight")
    return F.broadcast(counted).join(df, "term", "left") \
        .withColumn("weight", _weight(F.lit(total), F.coalesce("df", F.lit(0)))) \
        .select("template", "licence", "term", "weight", (w / F.sqrt(F.sum(w * w).over(size))).alias("v"))


def _weight(total: Column, df: Column) -> Column:
    return F.log((1.0 + total) / (1.0 + df)) + 1.0  # at least 1


def matches(files: DataFrame, threshold: float = THRESHOLD, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(file, place, licence, score) for passages of ``files`` (file, path, text)
    that match a template."""
    spark = files.sparkSession
    least = threshold - 1e-6  # scores are rounded to six places
    texts = files.where("text is not null")
    df = staged(texts.select(F.explode(F.array_distinct(terms_of(F.col("text")))).alias("term"))
                .groupBy("term").agg(F.count(F.lit(1)).alias("df")), "terms")
    total = texts.count()
    # the terms of the templates: bounded by the parameter
    vectors = template_vectors(templates, df, total).collect()
    vectors = spark.createDataFrame(vectors, "template int, licence string, term string, weight double, v double")
    rarer = Window.partitionBy("template").orderBy(F.desc("weight"), "term").rowsBetween(Window.unboundedPreceding, -1)
    rest = 1.0 - F.coalesce(F.sum(F.col("v") * F.col("v")).over(rarer), F.lit(0.0))
    anchors = vectors.select("term", rest.alias("rest")).where(F.col("rest") >= least * least).select("term").distinct()
    found = staged(passages(files, [r.term for r in anchors.collect()]), "passages")
    key = ["file", "version", "place"]
    counted = staged(found.select(*key, F.explode("terms").alias("term")).groupBy(*key, "term").agg(
        F.count(F.lit(1)).alias("tf")), "counts")
    known = vectors.groupBy("term").agg(F.first("weight").alias("weight"))  # one weight per term
    # a norm no larger than the true one: other terms weigh at least 1
    w = F.col("tf") * F.coalesce("weight", F.lit(1.0))
    floor = counted.join(F.broadcast(known), "term", "left").groupBy(*key).agg(F.sqrt(F.sum(w * w)).alias("floor"))
    dots = counted.join(F.broadcast(vectors), "term").groupBy(*key, "template", "licence").agg(
        F.sum(F.col("tf") * F.col("weight") * F.col("v")).alias("dot"))
    likely = staged(dots.join(floor, key).where(F.col("dot") >= least * F.col("floor")).drop("floor"), "likely")
    exact = counted.join(likely.select(*key).distinct(), key).join(df, "term")
    w = F.col("tf") * _weight(F.lit(total), F.col("df"))
    norms = exact.groupBy(*key).agg(F.sqrt(F.sum(w * w)).alias("norm"))
    scored = likely.join(norms, key).select(*key, "licence", F.round(F.col("dot") / F.col("norm"), 6).alias("score"))
    best = scored.groupBy(*key).agg(F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("b"))
    return best.select("file", "place", F.col("b.licence").alias("licence"), (-F.col("b.s")).alias("score")) \
        .where(F.col("score") >= threshold)


def _folder(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def licences(files: DataFrame, threshold: float = THRESHOLD,
             templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(file, licence, score, origin, directory) for every row of ``files``
    (file, path, text); origin is ``file``, ``notice``, ``inherited`` or
    ``none``, directory the one whose licence file is inherited."""
    files = files.select("file", "path", "text")
    matched = staged(matches(files, threshold, templates), "licences")
    own = matched.groupBy("file").agg(F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("b")) \
        .select("file", "b.licence", (-F.col("b.s")).alias("score"))
    places = files.select("file", "path", _folder(F.col("path")).alias("folder"),
                          F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False)).alias("whole"))
    given = places.where("whole").join(matched.select("file", "licence", "score"), "file") \
        .groupBy("folder").agg(F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("b")) \
        .select(F.col("folder").alias("above"), F.col("b.licence").alias("licence"), (-F.col("b.s")).alias("score"))
    steps = F.split("folder", "/")
    ancestors = places.where("folder is not null").select("folder").distinct().select(
        "folder", F.explode(F.transform(
            F.sequence(F.lit(0), F.size(steps)), lambda i: F.array_join(F.slice(steps, F.lit(1), i), "/"))).alias("above"))
    inherited = ancestors.join(given, "above").groupBy("folder").agg(
        F.max_by(F.struct("above", "licence", "score"), F.length("above")).alias("i"))
    return places.join(own, "file", "left").join(inherited, "folder", "left").select(
        "file", F.coalesce("licence", "i.licence").alias("licence"), F.coalesce("score", "i.score").alias("score"),
        F.when(F.col("licence").isNotNull(), F.when(F.col("whole"), "file").otherwise("notice"))
        .when(F.col("i").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(F.col("licence").isNull(), F.col("i.above")).alias("directory"))


#: Documents as files: a source is a tree with directories of 1000 and of 100
#: documents; in each, some documents stand as its licence file.
_PATH = ("concat_ws('/', coalesce(source, 'unknown'), concat('p', {k}), "
         "CASE WHEN doc_id % 100 = 0 THEN NULL ELSE concat('d', {h}) END, "
         "CASE WHEN doc_id % 20 = 0 THEN 'LICENSE' ELSE concat(doc_id, '.txt') END)")


def op8_license_scan(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    files = docs.select(F.col("doc_id").alias("file"), "text", F.expr(
        _PATH.format(k="doc_id div 1000", h="doc_id div 100 % 10")).alias("path"))
    return licences(files).withColumnRenamed("file", "doc_id")


def oracle_op8(threshold: float = THRESHOLD) -> str:
    """The same as DuckDB SQL."""
    path = _PATH.format(k="doc_id // 1000", h="doc_id // 100 % 10")
    terms = "list_filter(string_split(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')"
    values = ", ".join("({}, '{}', '{}')".format(k, a, b.replace("'", "''")) for k, (a, b) in enumerate(TEMPLATES))
    return f"""
WITH f AS (SELECT doc_id, text, {path} AS path FROM documents),
g AS (SELECT *, regexp_replace(path, '/?[^/]*$', '') AS folder, regexp_matches(path, '{LICENCE_FILE}') AS whole FROM f),
li AS (SELECT doc_id, i, line, CASE WHEN regexp_matches(line, '{BLANK}') THEN 0
                                    WHEN regexp_matches(line, '{COMMENT}') THEN 1 ELSE 2 END AS kind
       FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                    unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM g WHERE path IS NOT NULL)),
runs AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i)
                   - row_number() OVER (PARTITION BY doc_id, kind ORDER BY i) AS run FROM li),
l AS (SELECT doc_id, 0 AS place, text AS passage FROM g WHERE whole
      UNION ALL SELECT doc_id, i, line FROM li
      UNION ALL SELECT doc_id, -min(i), string_agg(line, chr(10) ORDER BY i) FROM runs WHERE kind > 0
                GROUP BY doc_id, kind, run HAVING count(*) > 1),
total AS (SELECT count(text) AS total FROM g),
idf AS (SELECT term, count(*) AS df FROM
         (SELECT unnest(list_distinct({terms.format('text')})) AS term FROM g) GROUP BY term),
t AS (SELECT doc_id, place, term, count(*) AS tf FROM
       (SELECT doc_id, place, unnest({terms.format('passage')}) AS term FROM l) GROUP BY ALL),
w AS (SELECT doc_id, place, t.term, tf * (ln((1.0 + total) / (1.0 + df)) + 1.0) AS w
      FROM t JOIN idf USING (term), total),
norm AS (SELECT doc_id, place, sqrt(sum(w * w)) AS norm FROM w GROUP BY ALL),
tp AS (SELECT template, licence, term, count(*) AS tf FROM
        (SELECT template, licence, unnest({terms.format('text')}) AS term
         FROM (VALUES {values}) AS v(template, licence, text)) GROUP BY ALL),
tv AS (SELECT template, licence, tp.term, tf * (ln((1.0 + total) / (1.0 + coalesce(df, 0))) + 1.0) AS v
       FROM tp LEFT JOIN idf USING (term), total),
tn AS (SELECT template, sqrt(sum(v * v)) AS norm FROM tv GROUP BY ALL),
s AS (SELECT w.doc_id, w.place, template, licence, round(sum(w.w * v / tn.norm) / any_value(norm.norm), 6) AS score
      FROM w JOIN tv USING (term) JOIN tn USING (template) JOIN norm USING (doc_id, place) GROUP BY ALL),
m AS (SELECT * FROM s WHERE score >= {threshold}
      QUALIFY row_number() OVER (PARTITION BY doc_id, place ORDER BY score DESC, licence) = 1),
own AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, licence, place) = 1),
given AS (SELECT folder AS above, licence, score FROM m JOIN g USING (doc_id) WHERE whole
          QUALIFY row_number() OVER (PARTITION BY folder ORDER BY score DESC, licence) = 1),
up AS (SELECT folder, above, licence, score FROM (SELECT DISTINCT folder FROM g) d JOIN given
         ON given.above = '' OR d.folder = given.above OR starts_with(d.folder, given.above || '/')
       QUALIFY row_number() OVER (PARTITION BY folder ORDER BY length(above) DESC) = 1)
SELECT g.doc_id, coalesce(own.licence, up.licence) AS licence, coalesce(own.score, up.score) AS score,
       CASE WHEN own.place IS NOT NULL AND whole THEN 'file' WHEN own.place IS NOT NULL THEN 'notice'
            WHEN up.above IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN own.place IS NULL THEN up.above END AS directory
FROM g LEFT JOIN own USING (doc_id) LEFT JOIN up USING (folder)
"""
