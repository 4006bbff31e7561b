"""License scan by diagonal voting.

Every rolling hash of a text's word k-grams is joined to the places of the
templates' k-grams; the words themselves are compared with it. A place of the
template and a position of the text lie on a diagonal, their difference. All
places of a diagonal are gathered, diagonals a few words apart are merged, as
inserted and deleted words shift what follows, and a merged span counts if its
words cover enough of the template.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locusweave.llm.common import stored
from locusweave.llm.decontamination import doc_key, words_of
from locusweave.session import fits_broadcast

SHORT_GRAM, LONG_GRAM = 2, 4  # words in a gram of a phrase and of a notice
DRIFT = 8  # words that a merged diagonal may lie aside
COVER = 0.75  # share of a notice's words that a span must cover

BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # between words before they are lower-cased

# Phrases and labels of the contract.
PHRASES = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)

# Published wordings of licenses and license notices.
NOTICES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
            "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may "
               "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
               "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
            "Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
             "the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in "
            "binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
            "materials provided with the distribution."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
            "copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You "
            "can obtain one at http://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
                  "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
)


def _gram_hash(words: Column, at: Column, gram: int) -> Column:
    """Hash of the ``gram`` words from the 0-based place ``at`` on; of no use where they run past the end."""
    return F.xxhash64(F.lit(gram), *[F.get(words, at + i) for i in range(gram)])


def templates(spark: SparkSession, phrases: tuple = PHRASES, notices: tuple = NOTICES) -> DataFrame:
    """``template, label, base, words, gram``: ``gram`` is the template's number of words in a gram."""
    rows = [(i, label, base, text) for i, (label, text, base) in enumerate([(*p, True) for p in phrases] + [(*n, False) for n in notices])]
    return spark.createDataFrame(rows, "template int, label string, base boolean, text string").select(
        "template", "label", "base", words_of(F.col("text")).alias("words"), F.when(F.col("base"), SHORT_GRAM).otherwise(LONG_GRAM).alias("gram"))


def _template_grams(known: DataFrame) -> DataFrame:
    """``hash, template, base, size, gram, place, said``: one row per gram of a template."""
    place = F.col("place")
    hashes = F.when(F.col("base"), _gram_hash(F.col("words"), place, SHORT_GRAM)).otherwise(_gram_hash(F.col("words"), place, LONG_GRAM))
    placed = known.select("*", F.posexplode("words").alias("place", "word")).withColumn("hash", hashes)
    return placed.where(F.col("place") + F.col("gram") <= F.size("words")).select(
        "hash", "template", "base", F.size("words").alias("size"), "gram", "place", F.slice("words", F.col("place") + 1, F.col("gram")).alias("said"))


def diagonal_votes(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``key, template, base, size, gram, diagonal, places``: which places of a template each diagonal of a text has, equal in words."""
    texts = docs.select(doc_key().alias("key"), words_of(F.col("text")).alias("words"))
    at = F.col("position")
    placed = texts.select("key", "words", F.posexplode("words").alias("position", "word"))
    rolling = placed.select("key", "words", "position", F.explode(F.array(*[_gram_hash(F.col("words"), at, k) for k in (SHORT_GRAM, LONG_GRAM)])).alias("hash"))
    # The templates are fixed texts of a few hundred words.
    met = rolling.join(F.broadcast(_template_grams(known)), "hash")
    same = F.slice("words", F.col("position") + 1, F.col("gram")) == F.col("said")
    return met.where(same).groupBy("key", "template", "base", "size", "gram", (F.col("position") - F.col("place")).alias("diagonal")).agg(
        F.sort_array(F.collect_set("place")).alias("places"))


def license_spans(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``key, template, first, last, share``: spans of words, ends included, that hold a template, and the share of its words they cover.

    A phrase must stand whole. Of a notice at least ``COVER`` must stand on
    diagonals at most ``DRIFT`` apart; spans whose diagonals are no farther
    apart than that are one span.
    """
    votes = stored(diagonal_votes(docs, known))
    phrases = votes.where(F.col("base") & (F.size("places") == F.col("size") - F.col("gram") + 1)).select(
        "key", "template", F.col("diagonal").alias("first"), (F.col("diagonal") + F.col("size") - 1).alias("last"), F.lit(1.0).alias("share"))
    along = Window.partitionBy("key", "template").orderBy("diagonal")
    around = F.array_distinct(F.flatten(F.collect_list("places").over(along.rangeBetween(-DRIFT, DRIFT))))
    covered = F.array_distinct(F.flatten(F.transform(around, lambda p: F.sequence(p, p + LONG_GRAM - 1))))
    merged = votes.where(~F.col("base")).withColumn("share", F.size(covered) / F.col("size")).where(F.col("share") >= COVER)
    opens = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > DRIFT, F.lit(True)).cast("int")
    numbered = merged.withColumn("opens", opens).withColumn("span", F.sum("opens").over(along))
    notices = numbered.groupBy("key", "template", "span").agg(
        F.min(F.col("diagonal") + F.array_min("places")).alias("first"),
        F.max(F.col("diagonal") + F.array_max("places") + LONG_GRAM - 1).alias("last"), F.max("share").alias("share"))
    return phrases.unionByName(notices.drop("span"))


def scan_licenses(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``n_base`` counts the places of the base phrases, ``first_word`` and
    ``last_word`` are the smallest and the largest start among them, ``labels`` are the distinct
    labels of phrases and notices found, ``score`` is the largest share of a
    template covered in one place, 0 without any. Null and empty texts have no
    words and no labels; rows equal in id and text share their result, every row
    comes out, whole texts are read, and other columns are left out, whatever their names. An
    empty table gives no rows.
    """
    known = templates(docs.sparkSession) if known is None else known
    spans = license_spans(docs, known).join(F.broadcast(known.select("template", "label", "base")), "template")
    base_first = F.when(F.col("base"), F.col("first")).cast("long")
    joined = lambda labels: F.concat_ws(",", F.sort_array(labels))
    found = spans.groupBy("key").agg(
        F.count(base_first).alias("n_base"), F.min(base_first).alias("first_word"), F.max(base_first).alias("last_word"),
        joined(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base_labels"), joined(F.collect_set("label")).alias("labels"), F.max("share").alias("score"))
    found = stored(found)
    found = F.broadcast(found) if fits_broadcast(found) else found
    n_words = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), BREAKS), ""))
    rows = docs.select("doc_id", doc_key().alias("key"), n_words.cast("long").alias("n_words"))
    return rows.join(found, "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
