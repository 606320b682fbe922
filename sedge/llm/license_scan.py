"""License scans by diagonal voting, in DataFrame operations alone.

Rolling grams of ``GRAM`` words are hashed; those whose hash a template has are taken out of each text's array,
and joined to the positions of the license templates that hold them (words are compared too, so a hash collision
can't vote).  A match votes for the diagonal document position - template position; a diagonal keeps the set
of template positions that voted.  Diagonals at most ``gap`` apart are merged, which bridges words put in or
left out, and a merged span is verified by the share of the template's words that it covers and by its length.
A diagonal that has all grams of a base phrase is a place of that phrase.

A text is split once and only matches go on: narrow rows, whose sets of positions are united before they are
shuffled.  Templates, from phrases to whole licenses, are a fixed list, so broadcasting them has a fixed size.

Defined cases: a null text counts as empty; a null id is kept; rows with equal id and text get equal
results each; an empty table gives an empty result; other columns are left out, so their names can't
clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import new_folder, written

#: Phrases whose exact places are counted.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Statements that the voting looks for as well, whole or with words changed.
STATEMENTS = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "creative commons attribution noncommercial": "cc-by-nc",
    "licensed under the gnu general public license version 3": "gpl-3",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "subject to the terms of the mozilla public license version 2 0": "mpl-2",
    "all rights reserved": "all-rights-reserved",
}
#: Whole licenses and notices, in lower case without punctuation.
TEXTS = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    "apache-2": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    "gpl-3": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details you should have received a copy of the gnu general public license along with this program if not see",
    "mpl-2": "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at",
}
GRAM = 3
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text: ASCII letters in lower case, digits, and everything beyond ASCII."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS, -1), "")


def template_rows(base: dict[str, str] = BASE, statements: dict[str, str] | None = None) -> list[tuple]:
    """(template, label, is base, words, position, gram) of every template position."""
    statements = STATEMENTS if statements is None else statements
    named = [*base.items(), *statements.items(), *((text, label) for label, text in TEXTS.items())]
    rows = []
    for k, (phrase, label) in enumerate(named):
        of = phrase.split(" ")
        if len(of) < GRAM:
            raise ValueError(f"a template has {GRAM} words at least")
        rows += [(k, label, k < len(base), len(of), i, " ".join(of[i : i + GRAM])) for i in range(len(of) - GRAM + 1)]
    return rows


def scan(df: DataFrame, base: dict[str, str] = BASE, statements: dict[str, str] | None = None, gap: int = 2, least: float = 0.8, longest: float = 1.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row."""
    spark = df.sparkSession
    templates = spark.createDataFrame(template_rows(base, statements), "template int, label string, is_base boolean, size int, at int, gram string").withColumn("hash", F.xxhash64("gram"))
    # some hundreds of hashes, as many as the fixed list has grams
    hashes = sorted(r.hash for r in templates.select("hash").distinct().collect())
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), words(F.col(text_col)).alias("w"))
    n = F.size("w")
    gram = lambda i: F.concat_ws(" ", *[F.get("w", i + k) for k in range(GRAM)])
    known = F.filter(F.transform(F.sequence(F.lit(0), n - GRAM), lambda i: F.struct(F.xxhash64(gram(i)).alias("hash"), i.alias("position"))), lambda x: x["hash"].isin(hashes))
    matches = F.transform(known, lambda x: F.struct(x["hash"].alias("hash"), gram(x["position"]).alias("words"), x["position"].alias("position")))
    found = rows.select("doc_id", "text_hash", n.cast("long").alias("n_words"), F.when(n >= GRAM, matches).alias("matches"))
    found = written(found, new_folder(spark, "licenses"))
    votes = (
        found.where(F.size("matches") > 0)
        .select("doc_id", "text_hash", F.inline("matches"))
        .join(F.broadcast(templates), "hash")
        .where(F.col("words") == F.col("gram"))
        .groupBy("doc_id", "text_hash", "template", "label", "is_base", "size", (F.col("position") - F.col("at")).alias("diagonal"))
        .agg(F.collect_set("at").alias("at"), F.min("position").alias("low"), F.max("position").alias("high"))
    )
    along = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    islands = votes.withColumn("new", F.when(F.col("diagonal") - F.lag("diagonal").over(along) <= gap, 0).otherwise(1)).withColumn("island", F.sum("new").over(along))
    full = F.col("is_base") & (F.size("at") == F.col("size") - GRAM + 1)
    spans = islands.groupBy("doc_id", "text_hash", "template", "label", "size", "island").agg(
        F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"),
        F.min("low").alias("low"),
        (F.max("high") + GRAM).alias("end"),
        F.sum(full.cast("long")).alias("places"),
        F.min(F.when(full, F.col("diagonal"))).alias("first"),
        F.max(F.when(full, F.col("diagonal"))).alias("last"),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("at", lambda a: F.sequence(a, a + GRAM - 1))))) / F.col("size")
    spans = spans.withColumn("covered", covered).withColumn("verified", (F.col("places") > 0) | (F.col("covered") >= least) & (F.col("end") - F.col("low") <= longest * F.col("size")))
    told = (
        spans.where("verified")
        .groupBy("doc_id", "text_hash")
        .agg(
            F.sum("places").alias("places"),
            F.min("first").cast("long").alias("first_word"),
            F.max("last").cast("long").alias("last_word"),
            F.array_join(F.sort_array(F.collect_set(F.when(F.col("places") > 0, F.col("label")))), ",").alias("base_labels"),
            F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
            F.max("covered").alias("covered"),
        )
    )
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.text_hash") == F.col("f.text_hash"))
    return found.drop("matches").alias("d").join(told.alias("f"), same, "left").select(
        F.col("d.doc_id").alias("doc_id"),
        "n_words",
        F.coalesce("places", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("covered", F.lit(0.0)).alias("score"),
    )


def oracle(words_sql: str, base: dict[str, str] = BASE, statements: dict[str, str] | None = None, gap: int = 2, least: float = 0.8, longest: float = 1.5) -> str:
    """The same scan of the table ``documents`` in DuckDB SQL."""
    values = ", ".join(f"({k}, '{label}', {str(is_base).lower()}, {size}, {at}, '{gram}')" for k, label, is_base, size, at, gram in template_rows(base, statements))
    more = "".join(f" || ' ' || w[i + {k}]" for k in range(1, GRAM))
    return f"""
WITH t(template, label, is_base, size, pos, g) AS (VALUES {values}),
d AS (SELECT doc_id, {words_sql} AS w FROM documents),
p AS (SELECT doc_id, CAST(i - 1 AS BIGINT) AS position, w[i]{more} AS g FROM d, range(1, greatest(len(w) - {GRAM - 2}, 1)) AS r(i)),
v AS (SELECT doc_id, template, label, is_base, size, position - pos AS diagonal, list(DISTINCT pos) AS ats, min(position) AS low, max(position) AS high
  FROM p JOIN t USING (g) GROUP BY ALL),
n AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) <= {gap} THEN 0 ELSE 1 END AS new FROM v),
i AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, template ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS island, is_base AND len(ats) = size - {GRAM - 1} AS whole FROM n),
s AS (SELECT doc_id, template, label, size, island, list_distinct(flatten(list(ats))) AS ats, min(low) AS low, max(high) + {GRAM} AS "end", sum(CAST(whole AS BIGINT)) AS places,
  min(CASE WHEN whole THEN diagonal END) AS first, max(CASE WHEN whole THEN diagonal END) AS last FROM i GROUP BY ALL),
c AS (SELECT *, CAST(len(list_distinct(flatten([range(a, a + {GRAM}) for a in ats]))) AS DOUBLE) / size AS covered FROM s),
f AS (SELECT doc_id, sum(places) AS places, min(first) AS first_word, max(last) AS last_word,
  string_agg(DISTINCT CASE WHEN places > 0 THEN label END, ',' ORDER BY CASE WHEN places > 0 THEN label END) AS base_labels,
  string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(covered) AS covered
  FROM c WHERE places > 0 OR covered >= {least} AND "end" - low <= {longest} * size GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(places, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(covered, 0.0::DOUBLE) AS score
FROM d LEFT JOIN f USING (doc_id)
"""
