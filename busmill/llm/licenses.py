"""License scans by diagonal voting, with DataFrame functions alone.

The hashes of all rolling word pairs and triples of a whole text are joined to the places that templates have them; a hit votes for
the diagonal, the text position less the template position, if its words are the template's too. A phrase stands where every pair of it votes for one diagonal.
A notice or a license text may be edited: its diagonals that lie within GAP of each other are merged, and it counts if the merged hits cover
at least COVER of its grams. Which grams are covered is kept as bits, PART of them to a number, so templates may be of any length.

Null and empty texts have no words and no labels, with score 0. A very long text is one row, whose hits alone are spread. Votes have no order, so ties decide
nothing. Repeated rows give one result each. A row is known by its id and its text's hash, so repeated ids with different texts are kept apart. Extra columns
are not read. An empty table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP, COVER, PART = 3, 0.75, 60

# The phrases of the contract.
PHRASES = [
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
]

# Sentences of published licenses and of the notices that name them.
NOTICES = [
    ("released under the mit license", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "apache"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]


# The texts of short licenses, and the notices that the long ones ask for.
TEXTS = [
    (
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction,
        including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do
        so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS",
        WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS
        OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE.""",
        "mit",
    ),
    (
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in
        all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
        AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
        OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
        "isc",
    ),
    (
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above
        copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
        in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
        BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
        INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
        CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
        POSSIBILITY OF SUCH DAMAGE.""",
        "bsd",
    ),
    (
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
        "apache",
    ),
    (
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License,
        or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
        PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see
        <https://www.gnu.org/licenses/>.""",
        "gpl",
    ),
    (
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
        "mpl",
    ),
    (
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
        compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
        interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt
        act of relinquishment in perpetuity of all present and future rights to this software under copyright law.""",
        "unlicense",
    ),
]


def template_words(text: str) -> list[str]:
    """As words_of, of a template, which is ASCII."""
    return re.findall("[a-z0-9]+", text.lower())


def grams() -> list[tuple[int, str, int, int, int, str]]:
    """(template, label, words a gram, place in the template, grams of the template, gram)."""
    out = []
    for t, (text, label) in enumerate(PHRASES + NOTICES + TEXTS):
        k, words = 2 if t < len(PHRASES) else 3, template_words(text)
        out += [(t, label, k, i, len(words) - k + 1, " ".join(words[i : i + k])) for i in range(len(words) - k + 1)]
    return out


def words_of(text: Column) -> Column:
    """The words of a text: letters and digits of ASCII, in lower case, and all other characters beyond ASCII."""
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def scan(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(places, results): every verified span as (doc_id, text_key, label, template, first_word, cover, phrase), and one row per row of
    docs as in the contract of `op5_license_scan`."""
    spark, wanted = docs.sparkSession, grams()
    templates = spark.createDataFrame(wanted, "template int, label string, k int, at int, grams int, gram string")
    by_size = F.when(F.col("k") == 2, F.xxhash64(*[F.split("gram", " ")[j] for j in range(2)])).otherwise(F.xxhash64(*[F.get(F.split("gram", " "), F.lit(j)) for j in range(3)]))
    templates = templates.withColumn("h", by_size)
    #: What no template has is left out before the join; the templates are a fixed table.
    hashes = {k: sorted({r.h for r in templates.where(F.col("k") == k).select("h").collect()}) for k in (2, 3)}
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text", F.length("text")).alias("text_key"), words_of(F.col("text").cast("string")).alias("w"))
    rows = rows.select("*", F.size("w").cast("long").alias("n_words"), *[F.expr(f"transform(w, (x, i) -> xxhash64(x{''.join(f', get(w, i + {j})' for j in range(1, k))}))").alias(f"h{k}") for k in (2, 3)])

    def hits(k: int) -> Column:
        gram = ", ".join(f"w[i + {j}]" for j in range(k))
        found = f"filter(sequence(0, greatest(n_words - {k}, 0)), i -> i <= n_words - {k} AND h{k}[i] IN ({', '.join(f'{h}L' for h in hashes[k])}))"
        return F.expr(f"transform({found}, i -> struct(cast(i AS long) AS place, {k} AS k, h{k}[i] AS h, concat_ws(' ', {gram}) AS words))")

    # The first element stands for the row itself; so rows without a hit stay, and equal rows are counted.
    none = F.expr("array(struct(cast(-1 AS long) AS place, 0 AS k, 0L AS h, '' AS words))")
    voted = (
        rows.select("doc_id", "text_key", "n_words", F.explode(F.concat(none, hits(2), hits(3))).alias("hit"))
        .select("doc_id", "text_key", "n_words", "hit.*")
        .join(F.broadcast(templates), ["k", "h"], "left")  # a fixed table of some thousand rows
        .where("gram IS NULL OR gram = words")
        .repartition("doc_id", "text_key", "n_words")
        .groupBy("doc_id", "text_key", "n_words", "template", "label", "grams", (F.col("place") - F.col("at")).alias("diagonal"), F.expr(f"at div {PART}").alias("part"))
        .agg(F.expr(f"bit_or(shiftleft(1L, at % {PART}))").alias("seen"), F.count(F.when(F.col("place") < 0, 1)).alias("copies"))
    )
    row = ["doc_id", "text_key", "n_words"]
    by = Window.partitionBy(*row, "template").orderBy("diagonal", "part")
    near = F.when(F.col("template") < len(PHRASES), 0).otherwise(GAP)
    merged = (
        voted.withColumn("new", F.when(F.col("diagonal") - F.lag("diagonal").over(by) <= near, 0).otherwise(1))
        .withColumn("island", F.sum("new").over(by))
        .groupBy(*row, "template", "label", "grams", "island", "part")
        .agg(F.expr("bit_count(bit_or(seen))").alias("covered"), F.min("diagonal").alias("first_word"), F.sum("copies").alias("copies"))
        .groupBy(*row, "template", "label", "grams", "island")
        .agg(F.sum("covered").alias("covered"), F.min("first_word").alias("first_word"), F.sum("copies").alias("copies"))
        .select(*row, "template", "label", "first_word", "copies", (F.col("covered") / F.col("grams")).alias("cover"), (F.col("template") < len(PHRASES)).alias("phrase"))
    )
    places = merged.where(F.col("template").isNotNull() & F.when(F.col("phrase"), F.col("cover") == 1).otherwise(F.col("cover") >= COVER))
    base = F.col("phrase") & (F.col("cover") == 1)
    found = base | (~F.col("phrase") & (F.col("cover") >= COVER))
    join = lambda c: F.concat_ws(",", F.array_sort(F.collect_set(F.when(c, F.col("label")))))
    results = (
        merged.groupBy(*row)
        .agg(
            F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("first_word"))).alias("first_word"), F.max(F.when(base, F.col("first_word"))).alias("last_word"),
            join(base).alias("base_labels"), join(found).alias("labels"), F.coalesce(F.max(F.when(base | ~F.col("phrase"), F.col("cover"))), F.lit(0.0)).alias("score"), F.max("copies").alias("copies"),
        )
        .withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
        .drop("copy", "copies", "text_key")
    )
    return places, results


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return scan(table(spark, sf_dir, "documents"))[1].select(*columns)


def _oracle() -> str:
    values = ", ".join(f"({t}, '{label}', {k}, {i}, {n}, '{g}')" for t, label, k, i, n, g in grams())
    return rf"""
WITH t(template, label, k, place, grams, gram) AS (VALUES {values}),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT r, w, unnest(range(len(w))) AS i FROM d),
g AS (SELECT r, i, 2 AS k, w[i + 1] || ' ' || w[i + 2] AS gram FROM p WHERE i + 2 <= len(w)
      UNION ALL SELECT r, i, 3, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] FROM p WHERE i + 3 <= len(w)),
v AS (SELECT r, template, label, grams, i - place AS diagonal, list(DISTINCT place) AS seen FROM g JOIN t USING (k, gram) GROUP BY ALL),
n AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) <= CASE WHEN template < {len(PHRASES)} THEN 0 ELSE {GAP} END THEN 0 ELSE 1 END AS new FROM v),
s AS (SELECT *, sum(new) OVER (PARTITION BY r, template ORDER BY diagonal) AS island FROM n),
m AS (SELECT r, template < {len(PHRASES)} AS phrase, label, min(diagonal) AS first_word, len(list_distinct(flatten(list(seen)))) / grams AS cover FROM s GROUP BY r, template, label, grams, island),
b AS (SELECT *, phrase AND cover = 1 AS base FROM m)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, count(*) FILTER (base) AS n_base, CAST(min(first_word) FILTER (base) AS BIGINT) AS first_word, CAST(max(first_word) FILTER (base) AS BIGINT) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base OR (NOT phrase AND cover >= {COVER})), '') AS labels,
  coalesce(max(cover) FILTER (base OR NOT phrase), 0.0) AS score
FROM d LEFT JOIN b USING (r) GROUP BY r, doc_id, w
"""


ORACLE = _oracle()
