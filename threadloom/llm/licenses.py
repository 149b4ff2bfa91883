"""License scans by diagonal voting, in DataFrame operations only.

Every two neighbouring words of every document are hashed and joined with the same of
short license templates. A hit votes for the diagonal, document position minus template
position. Neighbouring diagonals, which inserted or missing words cause, are merged, and a
merged span counts when it has votes enough and enough of the template's words lie in pairs seen within a span
of about its length. Words are compared besides hashes, so a hit is never a hash collision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from threadloom.llm.common import ascii_words, ascii_words_sql

# Phrases whose places are counted word for word, and their labels.
BASE_PHRASES = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)
# Notices of public licenses, recognised with small changes too.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-notice", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "GNU Lesser General Public License"),
    ("cc-by-nc", "Licensed under CC BY-NC"),
    ("cc-by-notice", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

COVERAGE = 0.8  # of a template's words
MIN_VOTES = 3  # different pairs of a merged span; a template of fewer pairs needs all of them
SLACK = 2  # words by which neighbouring diagonals may differ


def _pair(a: Column, b: Column) -> Column:
    return F.struct(F.xxhash64(a, b).alias("hash"), a.alias("a"), b.alias("b"))


def _pairs(words: Column) -> Column:
    """All neighbouring word pairs in order."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), _pair)


def template_pairs(spark: SparkSession) -> DataFrame:
    """``hash, a, b, template, label, exact, at, pairs``: one row per word pair of a template.

    The row of two empty words matches the entry every document has besides its pairs.
    """
    rows = [(label, text, True) for label, text in BASE_PHRASES] + [(label, text, False) for label, text in TEMPLATES]
    listed = F.array(
        *[
            F.struct(
                F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(text).alias("text"), F.lit(exact).alias("exact")
            )
            for i, (label, text, exact) in enumerate(rows)
        ]
    )
    templates = spark.range(1).select(F.inline(listed)).withColumn("_words", ascii_words("text"))
    templates = templates.withColumn("_pairs", _pairs(F.col("_words")))
    real = templates.select(
        "template", "label", "exact", F.size("_pairs").alias("pairs"), F.posexplode("_pairs").alias("at", "pair")
    )
    none = spark.range(1).select(
        F.lit(-1).alias("template"),
        F.lit(None).cast("string").alias("label"),
        F.lit(False).alias("exact"),
        F.lit(0).alias("pairs"),
        F.lit(0).alias("at"),
        _pair(F.lit(""), F.lit("")).alias("pair"),
    )
    return real.unionByName(none).select("pair.*", "template", "label", "exact", "at", "pairs")


def scan_licenses(docs: DataFrame) -> DataFrame:
    """A row per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``n_base`` counts all places of the base phrases, ``first_word`` and ``last_word`` are their smallest
    and largest start. ``labels`` joins the base labels and those of recognised notices; ``score`` is the largest
    share of a template's words seen in one span. Null and empty texts have no words and no labels; null ids
    and repeated rows are scanned like any other; an empty table gives no rows.
    """
    templates = F.broadcast(template_pairs(docs.sparkSession))  # a few hundred rows, fixed
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("_row"), ascii_words("text").alias("_words"))
    every = F.concat(_pairs(F.col("_words")), F.array(_pair(F.lit(""), F.lit(""))))
    pairs = rows.select(
        "doc_id", "_row", F.size("_words").cast("long").alias("n_words"), F.posexplode(every).alias("_at", "_pair")
    ).select("doc_id", "_row", "n_words", "_at", "_pair.*")
    votes = (
        pairs.join(templates, ["hash", "a", "b"])
        .groupBy("_row", "doc_id", "n_words", "template", "label", "exact", "pairs", (F.col("_at") - F.col("at")).alias("diagonal"))
        # Bit i: the template's pair i has been seen; templates have at most 62 pairs.
        .agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("seen"), F.min("_at").alias("start"), F.max("_at").alias("end"))
    )
    along = Window.partitionBy("_row", "template").orderBy("diagonal")
    apart = F.col("exact") | (F.col("diagonal") - F.lag("diagonal").over(along) > SLACK)
    spans = (
        votes.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int"))
        .withColumn("_span", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("_row", "doc_id", "n_words", "template", "label", "exact", "pairs", "_span")
        .agg(F.bit_or("seen").alias("seen"), F.min("start").alias("start"), F.max("end").alias("end"))
        .withColumn("votes", F.bit_count("seen"))
        .withColumn("share", F.bit_count(F.col("seen").bitwiseOR(F.shiftleft("seen", 1))) / (F.col("pairs") + 1))
    )
    real = F.col("template") >= 0
    is_base = real & F.col("exact") & (F.col("votes") == F.col("pairs"))
    compact = F.col("end") - F.col("start") < F.col("pairs") + SLACK
    is_seen = real & ~F.col("exact") & compact & (F.col("votes") >= F.least(F.lit(MIN_VOTES), F.col("pairs")))
    is_notice = is_seen & (F.col("share") >= COVERAGE)
    start = F.col("start").cast("long")

    def joined(condition: Column) -> Column:
        return F.concat_ws(",", F.array_sort(F.collect_set(F.when(condition, F.col("label")))))

    return (
        spans.groupBy("_row", "doc_id", "n_words")
        .agg(
            F.count(F.when(is_base, 1)).alias("n_base"),
            F.min(F.when(is_base, start)).alias("first_word"),
            F.max(F.when(is_base, start)).alias("last_word"),
            joined(is_base).alias("base_labels"),
            joined(is_base | is_notice).alias("labels"),
            F.coalesce(F.max(F.when(is_base | is_seen, F.col("share"))), F.lit(0.0)).alias("score"),
        )
        .drop("_row")
    )


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle_sql() -> str:
    """The scan in DuckDB SQL, joining the words themselves instead of hashes."""
    rows = [(label, text, True) for label, text in BASE_PHRASES] + [(label, text, False) for label, text in TEMPLATES]
    values = ", ".join(f"({i}, {_sql_text(label)}, {_sql_text(text)}, {exact})" for i, (label, text, exact) in enumerate(rows))
    words = ascii_words_sql("text")
    return f"""
WITH templates(template, label, text, exact) AS (VALUES {values}),
template_words AS (SELECT template, label, exact, {words} AS w FROM templates),
template_pairs AS (
  SELECT template, label, exact, len(w) - 1 AS pairs, i - 1 AS tpos, w[i] AS a, w[i + 1] AS b
  FROM template_words, unnest(range(1, len(w))) AS r(i)),
rows_ AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM documents),
doc_pairs AS (SELECT rid, i - 1 AS pos, w[i] AS a, w[i + 1] AS b FROM rows_, unnest(range(1, len(w))) AS r(i)),
votes AS (
  SELECT rid, template, label, exact, pairs, pos - tpos AS diagonal, bit_or(1::BIGINT << tpos::INTEGER) AS hits, min(pos) AS first_, max(pos) AS last_
  FROM doc_pairs JOIN template_pairs USING (a, b) GROUP BY ALL),
marked AS (
  SELECT *, CASE WHEN exact OR diagonal - lag(diagonal) OVER v > {SLACK} OR lag(diagonal) OVER v IS NULL THEN 1 ELSE 0 END AS new_
  FROM votes WINDOW v AS (PARTITION BY rid, template ORDER BY diagonal)),
grouped AS (
  SELECT *, sum(new_) OVER (PARTITION BY rid, template ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS span FROM marked),
spans AS (
  SELECT rid, template, label, exact, pairs, span, bit_or(hits) AS hits, min(first_) AS first_, max(last_) AS last_
  FROM grouped GROUP BY rid, template, label, exact, pairs, span),
judged AS (
  SELECT *, exact AND bit_count(hits) = pairs AS is_base, bit_count(hits | (hits << 1))::DOUBLE / (pairs + 1) AS share,
         NOT exact AND last_ - first_ < pairs + {SLACK} AND bit_count(hits) >= least({MIN_VOTES}, pairs) AS is_seen FROM spans),
summed AS (
  SELECT rid, count(*) FILTER (is_base) AS n_base, min(first_) FILTER (is_base) AS first_word, max(first_) FILTER (is_base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base OR (is_seen AND share >= {COVERAGE})) AS labels,
         max(share) FILTER (is_base OR is_seen) AS score
  FROM judged GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM rows_ LEFT JOIN summed USING (rid)
"""
