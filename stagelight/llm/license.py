"""Licence scans in DataFrame operations alone.

Every line of every text, every block of lines between blank lines, and the whole of a licence file (base name LICENSE,
LICENCE or COPYING) is a unit. Units are compared with licence templates - titles, header notices, SPDX lines, the
paragraphs of licence texts, and these texts whole - by the cosine of sparse TF-IDF vectors; a document frequency is the
number of distinct lines of documents that hold a term, over all documents. The best template of at least THRESHOLD among
a document's units is its own licence. A licence file gives its licence to its directory, and a document without one of its
own inherits from the nearest ancestor directory, by an equi-join of its ancestors' paths with the licensed directories.

Only units that can reach THRESHOLD become vectors (see telling: a bound that loses nothing), and equal units are compared
once, however many documents hold them. Directories are few rows next to documents; the join on them is left to adaptive
execution, which splits hot directories.

Defined cases: null text has no units; a null path has no ancestors; a null doc_id is kept as it is. Of several matching
units or templates the largest cosine (to six decimals) counts, then the licence that sorts first; of several licence files
in a directory, the one with the largest cosine, then the licence that sorts first. Very long texts, lines and blocks count
whole. Repeated rows each stay. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagelight.llm.common import cut, only

THRESHOLD = 0.5
LICENSE_FILE = r"(?i)^(licen[cs]e|copying)(\.[a-z]+)?$"

# Notices and paragraphs as their publishers word them.
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights "
    "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE "
    "ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
)
_APACHE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
    "specific language governing permissions and limitations under the License.",
)
_APACHE_FILE = (
    "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    "\"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document.",
    "\"Licensor\" shall mean the copyright owner or entity authorized by the copyright owner that is granting the License.",
)
_GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
)
_MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"), *[("Apache-2.0", x) for x in _APACHE], ("Apache-2.0", " ".join(_APACHE)), *[("Apache-2.0", x) for x in _APACHE_FILE], ("Apache-2.0", " ".join(_APACHE_FILE)),
    ("BSD-3-Clause", "BSD 3-Clause License"), ("BSD-3-Clause", "Released under the BSD 3-Clause License"), *[("BSD-3-Clause", x) for x in _BSD], ("BSD-3-Clause", " ".join(_BSD[:4])), ("BSD-3-Clause", " ".join(_BSD)),
    ("CC-BY-4.0", "This work is licensed under Creative Commons Attribution CC BY 4.0"), ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"), ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"), ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"), *[("GPL-3.0", x) for x in _GPL], ("GPL-3.0", " ".join(_GPL)),
    ("MIT", "Released under the MIT License"), *[("MIT", x) for x in _MIT], ("MIT", " ".join(_MIT)),
    ("MPL-2.0", "Subject to the terms of the Mozilla Public License, version 2.0"), ("MPL-2.0", "Mozilla Public License Version 2.0"), ("MPL-2.0", _MPL),
    ("Proprietary", "All rights reserved"), ("Proprietary", "Copyright all rights reserved, redistribution is not permitted"), ("Proprietary", "Confidential and proprietary, unauthorized copying is strictly prohibited"),
    *[(x, f"SPDX-License-Identifier: {x}") for x in ("Apache-2.0", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "GPL-3.0-only", "GPL-3.0-or-later", "MIT", "MPL-2.0")],
]
#: SPDX names of one licence
SAME = {"GPL-3.0-only": "GPL-3.0", "GPL-3.0-or-later": "GPL-3.0"}

#: What stands between terms, where spaces stand around the text. No repeated groups: their matching recurses in Java
BETWEEN = r"[.-]*[^a-z0-9.-][^a-z0-9]*"
BLANK = r"\n[ \t\r]*\n"


def terms(text: Column) -> Column:
    """Runs of letters, digits, dots and hyphens, lower-cased, without dots and hyphens at their ends."""
    return F.array_remove(F.split(F.concat(F.lit(" "), F.lower(text), F.lit(" ")), BETWEEN), "")


def plain_terms(text: str) -> list[str]:
    return [t for t in re.split(BETWEEN, f" {text.lower()} ") if t]


class Templates:
    """Vectors of the templates for the document frequencies df of their terms among n lines."""

    def __init__(self, df: dict[str, int], n: int, given: list[tuple[str, str]] = TEMPLATES):
        self.df, self.licenses = df, [SAME.get(x, x) for x, _ in given]
        self.vectors = [{t: c * (math.log((1 + n) / (1 + df.get(t, 0))) + 1) for t, c in Counter(plain_terms(text)).items()} for _, text in given]
        self.norms = [math.sqrt(sum(w * w for w in v.values())) for v in self.vectors]
        self.terms = sorted({t for v in self.vectors for t in v})

    def telling(self) -> list[str]:
        """Terms of which every unit has one that reaches THRESHOLD with any template. A unit whose only template terms are
        others has at most the cosine |v'| / |v| (Cauchy-Schwarz), v' being the template's vector on these; terms are left
        out, most frequent first, as long as that stays under THRESHOLD for all. So nothing is lost."""
        out: set[str] = set()
        room = [((THRESHOLD - 0.001) * n) ** 2 for n in self.norms]
        for t in sorted(self.terms, key=lambda t: (-self.df.get(t, 0), t)):
            takes = [v.get(t, 0.0) ** 2 for v in self.vectors]
            if all(x == 0 or x < r for x, r in zip(takes, room, strict=True)):
                room = [r - x for r, x in zip(room, takes, strict=True)]
                out.add(t)
        return sorted(set(self.terms) - out)


def pattern_of(words: list[str]) -> str:
    """A pattern for any of the words as a term; words with one beginning share it, so that few branches are tried."""

    def tails(some: list[str]) -> str:
        out, firsts = [], sorted({w[0] for w in some if w})
        for c in firsts:
            rest = [w[1:] for w in some if w[:1] == c]
            out.append(re.escape(c) + (tails(rest) if rest != [""] else ""))
        body = out[0] if len(out) == 1 and "" not in some else f"(?:{'|'.join(out)})"
        return body if "" not in some else f"{body}?+" if out else ""

    return rf"(?<![a-z0-9]){tails(words)}(?![a-z0-9])"


def scan(files: DataFrame) -> DataFrame:
    """files (doc_id, path, text) -> (doc_id, path, license, origin, score, directory)."""
    files = only(files, "doc_id", "path", "text")
    spark = files.sparkSession
    lines = F.array_distinct(F.transform(F.split("text", "\n"), lambda x: F.trim(x)))
    line = files.select(F.explode(lines).alias("line"))
    # the empty term counts the lines
    df = cut(line.select(F.explode(F.concat(F.array(F.lit("")), F.array_distinct(terms(F.col("line"))))).alias("t")).groupBy("t").agg(F.count("*").alias("df")))
    known = sorted({t for _, x in TEMPLATES for t in plain_terms(x)})
    few = {r["t"]: r["df"] for r in df.where(F.col("t").isin("", *known)).collect()}  # the templates' terms
    n = few.get("", 0)
    templates = Templates(few, n)
    some = pattern_of(templates.telling())
    # the one more pass over the texts; row numbers stay the same from here on
    blocks = F.filter(F.split("text", BLANK), lambda x: F.contains(x, F.lit("\n")))
    whole = F.when(_base("path").rlike(LICENSE_FILE), F.array("text")).otherwise(F.array().cast("array<string>"))
    units = F.array_distinct(F.filter(F.concat(lines, blocks, whole), lambda x: F.lower(x).rlike(some)))
    rows = cut(files.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "path", F.when(F.lower("text").rlike(some), units).alias("units")))
    # two hashes of 64 bits stand for a unit from here on
    unit = F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b"))
    found = rows.select("rid", "path", F.explode("units").alias("text")).withColumn("unit", unit)
    own = found.drop("text").join(best_templates(found.groupBy("unit").agg(F.first("text").alias("text")), df, templates, n), "unit")
    own = cut(own.groupBy("rid").agg(F.min("b").alias("b"), F.max("path").alias("path")).select("rid", "path", F.col("b.license").alias("license"), (-F.col("b.s")).alias("score")))
    return inherited(spark, rows, own)


def best_templates(units: DataFrame, df: DataFrame, templates: Templates, n: int) -> DataFrame:
    """units (unit, text) and document frequencies (t, df) among n lines -> (unit, b) with the best template of each unit
    that reaches THRESHOLD, as (s, license) where s is minus the cosine."""
    counted = units.select("unit", F.explode(terms(F.col("text"))).alias("t")).groupBy("unit", "t").agg(F.count("*").alias("tf"))
    weight = F.col("tf") * (F.log((1 + F.lit(n)) / (1 + F.col("df"))) + 1)
    places = [(t, [v.get(t, 0.0) / m for v, m in zip(templates.vectors, templates.norms, strict=True)]) for t in templates.terms]
    vectors = units.sparkSession.createDataFrame(places, "t string, v array<double>")
    # rows of terms in blocks are as many as in the text; the templates' terms are a fixed few hundred
    weighed = counted.join(df, "t", "left").select("unit", "t", weight.alias("w")).join(F.broadcast(vectors), "t", "left")
    dots = [F.sum(F.when(F.col("v").isNotNull(), F.col("w") * F.get("v", i))).alias(f"d{i}") for i in range(len(templates.licenses))]
    sums = weighed.groupBy("unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), *dots)
    each = F.array(*[F.struct((-F.round(F.coalesce(F.col(f"d{i}"), F.lit(0.0)) / F.col("norm"), 6)).alias("s"), F.lit(x).alias("license")) for i, x in enumerate(templates.licenses)])
    return sums.select("unit", F.array_min(each).alias("b")).where(F.col("b.s") <= -THRESHOLD)


def _base(path: str) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def inherited(spark, rows: DataFrame, own: DataFrame) -> DataFrame:
    """rows (rid, doc_id, path) and those with a licence (rid, path, license, score) -> the result of a scan."""
    directory = F.regexp_replace("path", "/?[^/]*$", "")
    licensed = own.where(_base("path").rlike(LICENSE_FILE)).groupBy(directory.alias("dir")).agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("b")).select("dir", F.col("b.license").alias("l"), (-F.col("b.s")).alias("s"))
    slim = rows.select("rid", "doc_id", "path").join(own.select("rid", "license", "score"), "rid", "left")
    parts = F.split("path", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    above = slim.where("license is null and path is not null").select("rid", F.explode(ancestors).alias("dir")).join(licensed, "dir")
    near = above.groupBy("rid").agg(F.max(F.struct(F.length("dir").alias("n"), "dir", "l", "s")).alias("a"))
    out = slim.join(near, "rid", "left")
    origin = F.when(F.col("license").isNotNull(), "own").when(F.col("a").isNotNull(), "inherited").otherwise("none")
    return out.select("doc_id", "path", F.coalesce("license", "a.l").alias("license"), origin.alias("origin"), F.coalesce("score", "a.s").alias("score"), F.when(F.col("license").isNull(), F.col("a.dir")).alias("directory"))


def files_of(documents: DataFrame) -> DataFrame:
    """The query's tree: source / thousands / hundreds / name; every tenth document is its directory's licence file."""
    id_ = F.col("doc_id")
    name = F.when(id_ % 10 == 0, F.concat(F.lit("LICENSE."), F.translate(id_.cast("string"), "0123456789", "abcdefghij"))).otherwise(F.concat(id_.cast("string"), F.lit(".txt")))
    return documents.select("doc_id", F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.expr("doc_id div 1000").cast("string"), F.expr("doc_id div 100").cast("string"), name).alias("path"), "text")


_QUOTED = [(SAME.get(x, x), t.replace("'", "''")) for x, t in TEMPLATES]
_T = ", ".join(f"({i}, '{k}', '{v}')" for i, (k, v) in enumerate(_QUOTED))
_TERMS = r"list_filter(list_transform(regexp_split_to_array(lower({0}), '[^a-z0-9.-]+'), lambda t: regexp_replace(t, '^[.-]+|[.-]+$', '', 'g')), lambda t: t <> '')"
ORACLE = rf"""
WITH files AS (
  SELECT doc_id, concat_ws('/', coalesce(source, 'unknown'), CAST(doc_id // 1000 AS VARCHAR), CAST(doc_id // 100 AS VARCHAR),
    CASE WHEN doc_id % 10 = 0 THEN 'LICENSE.' || translate(CAST(doc_id AS VARCHAR), '0123456789', 'abcdefghij') ELSE CAST(doc_id AS VARCHAR) || '.txt' END) AS path, text
  FROM documents
), lines AS (SELECT DISTINCT doc_id, trim(x, ' ') AS unit FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM files)),
n AS (SELECT count(*) AS n FROM lines),
df AS (SELECT t, count(*) AS df FROM (SELECT unnest(list_distinct({_TERMS.format("unit")})) AS t FROM lines) GROUP BY t),
units AS (
  SELECT doc_id, unit FROM lines
  UNION SELECT doc_id, x FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\n[ \t\r]*\n')) AS x FROM files) WHERE contains(x, chr(10))
  UNION SELECT doc_id, text FROM files WHERE regexp_matches(path, '/(licen[cs]e|copying)(\.[a-z]+)?$', 'i') AND text IS NOT NULL
), one AS (SELECT DISTINCT unit FROM units),
uw AS (
  SELECT unit, t, tf * (ln((1.0 + n.n) / (1 + coalesce(df.df, 0))) + 1) AS w
  FROM (SELECT unit, t, count(*) AS tf FROM (SELECT unit, unnest({_TERMS.format("unit")}) AS t FROM one) GROUP BY 1, 2) c LEFT JOIN df USING (t), n
), templates(i, license, line) AS (VALUES {_T}),
tw AS (
  SELECT i, license, t, tf * (ln((1.0 + n.n) / (1 + coalesce(df.df, 0))) + 1) AS v
  FROM (SELECT i, license, t, count(*) AS tf FROM (SELECT i, license, unnest({_TERMS.format("line")}) AS t FROM templates) GROUP BY 1, 2, 3) c LEFT JOIN df USING (t), n
), scored AS (
  SELECT unit, license, round(sum(w * v) / (max(nw) * max(nv)), 6) AS score
  FROM uw JOIN tw USING (t) JOIN (SELECT unit, sqrt(sum(w * w)) AS nw FROM uw GROUP BY 1) USING (unit)
  JOIN (SELECT i, sqrt(sum(v * v)) AS nv FROM tw GROUP BY 1) USING (i) GROUP BY unit, license, i
), own AS (
  SELECT doc_id, path, license, score FROM units JOIN scored USING (unit) JOIN files USING (doc_id) WHERE score >= {THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license) = 1
), licensed AS (
  SELECT regexp_replace(path, '/?[^/]*$', '') AS dir, license AS l, score AS s FROM own WHERE regexp_matches(path, '/(licen[cs]e|copying)(\.[a-z]+)?$', 'i')
  QUALIFY row_number() OVER (PARTITION BY regexp_replace(path, '/?[^/]*$', '') ORDER BY score DESC, license) = 1
), near AS (
  SELECT f.doc_id, dir, l, s FROM files f JOIN licensed d ON starts_with(f.path, d.dir || '/') WHERE f.doc_id NOT IN (SELECT doc_id FROM own)
  QUALIFY row_number() OVER (PARTITION BY f.doc_id ORDER BY length(dir) DESC) = 1
)
SELECT f.doc_id, f.path, coalesce(o.license, a.l) AS license, CASE WHEN o.doc_id IS NOT NULL THEN 'own' WHEN a.doc_id IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       coalesce(o.score, a.s) AS score, CASE WHEN o.doc_id IS NULL THEN a.dir END AS directory
FROM files f LEFT JOIN own o ON o.doc_id = f.doc_id LEFT JOIN near a ON a.doc_id = f.doc_id
"""
