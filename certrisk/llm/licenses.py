"""Licence notices in texts: Dice coefficient over the word bigrams of a unit and of a template.

Units are the lines of a text and the text as a whole, in lower case with every run of other
characters than a-z and 0-9 as one space. Two sets of a and b bigrams can reach a coefficient t only if
a >= b * t / (2 - t) and the reverse; so a unit meets only the templates of fitting sizes, through a join on size, and most units
meet none. The
templates are a fixed list, so that join is a broadcast; only matches are shuffled.

Defined results: a null or empty text has no licence; rows equal in ``doc_id`` and text get equal results;
of equally good templates of a unit the first by name counts; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Names and usual notices of licences.
TEMPLATES = (
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Use of this source code is governed by a BSD 2-Clause license."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD 3-Clause license."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def bigrams(words: Column) -> Column:
    """The distinct pairs of neighbouring words."""
    return F.array_distinct(F.zip_with(
        F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda a, b: F.concat_ws(" ", a, b)))


def template_table(docs: DataFrame, templates: tuple[tuple[str, str], ...], least: float) -> DataFrame:
    """``size, licence, pairs``: each template under every number of bigrams that can match it."""
    known = docs.sparkSession.createDataFrame(list(templates), "licence string, notice string")
    sized = known.select("licence", bigrams(F.split(normalised(F.col("notice")), " ")).alias("pairs"))
    n = F.size("pairs")
    return sized.withColumn("size", F.explode(F.sequence(
        F.ceil(n * least / (2 - least)).cast("int"), F.floor(n * (2 - least) / least).cast("int"))))


def licence_matches(
    docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = 0.8,
) -> DataFrame:
    """``doc_id, text_hash, unit, licence, score`` of the best template of each unit that reaches ``least``.

    ``unit`` is the number of the line from 1, or 0 for the whole text.
    """
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    units = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.posexplode(
        F.concat(F.array(F.when(F.contains(body, F.lit("\n")), body).otherwise("")), F.split(body, "\n"))).alias("unit", "line"))
    words = units.withColumn("words", F.split(normalised(F.col("line")), " "))
    fitting = words.filter(F.size("words") > 1).withColumn("own", bigrams(F.col("words"))).withColumn(
        "own_size", F.size("own"))
    known = template_table(docs, templates, least)
    both = fitting.join(F.broadcast(known), F.col("own_size") == F.col("size"))
    score = 2 * F.size(F.array_intersect("own", "pairs")) / (F.col("own_size") + F.size("pairs"))
    found = both.withColumn("score", score).filter(F.col("score") >= least)
    best = F.row_number().over(Window.partitionBy("doc_id", "text_hash", "unit").orderBy(F.desc("score"), "licence"))
    return found.select("doc_id", "text_hash", "unit", "licence", "score", best.alias("rank")).filter("rank = 1").drop("rank").distinct()


def licences(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, n_matches, licences, best_licence, best_score, places`` of every row of ``docs``."""
    found = licence_matches(docs, **options).groupBy("doc_id", "text_hash").agg(
        F.count("*").alias("n_matches"), F.array_join(F.sort_array(F.collect_set("licence")), ",").alias("licences"),
        F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("best"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("unit", "licence"))),
                                 lambda x: F.concat_ws(":", x["unit"], x["licence"])), ",").alias("places")).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "n_matches", "licences", "best", "places")
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    return rows.join(found, same, "left").select(
        "doc_id", F.coalesce("n_matches", F.lit(0)).alias("n_matches"), F.coalesce("licences", F.lit("")).alias("licences"),
        F.col("best.licence").alias("best_licence"), F.round(-F.col("best.s"), 6).alias("best_score"),
        F.coalesce("places", F.lit("")).alias("places"))
