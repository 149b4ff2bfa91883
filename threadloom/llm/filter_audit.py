"""How filters interact: what each removes at every place of every order.

Documents that repeat another's text are found by an existential self-join: a left-semi join on
hash, exact text and a smaller doc_id. Its ids are united with the ids that the other filters
mark, a document's marks become one bit combination, and the combinations of a part are
counted. Every order of the filters is then worked out from at most 32 counts a part.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.llm.common import BLANKS, one_label_per_document
from threadloom.sources.stages import cut_lineage, scratch_path

# The limits of the filters.
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_CAPITALS_PERCENT = 5
SIGNS = r"[#$%&*|]"
COPY = "E"
# A hash that more than 1 / HOT_SHARE of all rows have is hot; so at most HOT_SHARE hashes are.
HOT_SHARE = 2_048
SALTS = 64


def text_failures(text: Column) -> dict[str, Column]:
    """What fails filters A to D, each a condition on one (non-null) text."""
    words = F.filter(F.split(text, BLANKS), lambda w: w != "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * F.size(words),
        "C": 100 * capitals > MAX_CAPITALS_PERCENT * F.length(text),
        "D": text.rlike(SIGNS),
    }


def copies_of_smaller_ids(docs: DataFrame) -> DataFrame:
    """Rows of ``docs(doc_id, text, ...)`` whose text a smaller ``doc_id`` has too.

    Existence needs one witness per text, its smallest id, found by a combined minimum; so no group
    of copies is paired with itself. Hashes with a large share of all rows are dealt out by a salt, of
    which their one witness gets all. Null ids are never smaller nor have a smaller one.
    """
    rows = docs.withColumn("_hash", F.xxhash64("text"))
    groups = rows.groupBy("_hash", "text").agg(F.min("doc_id").alias("_least"), F.count(F.lit(1)).alias("_n"))
    # Written, so that the join below reads it as one exchange that adaptive execution can split.
    path = scratch_path(docs.sparkSession, "witnesses")
    groups.where("_n > 1 and _least is not null").write.parquet(path)
    witnesses = docs.sparkSession.read.parquet(path)
    total = docs.count()
    hot = witnesses.where(F.col("_n") * HOT_SHARE > total).select("_hash").distinct()
    hot = F.broadcast(hot.withColumn("_hot", F.lit(True)))  # at most HOT_SHARE rows, as counts add up to the total
    left = rows.join(hot, "_hash", "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).otherwise(0).cast("int")
    )
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    right = witnesses.join(hot, "_hash", "left").select(
        F.col("_hash").alias("_w_hash"), F.col("text").alias("_w_text"), "_least", F.explode(salts).alias("_w_salt")
    )
    smaller = (
        (F.col("_hash") == F.col("_w_hash"))
        & (F.col("_salt") == F.col("_w_salt"))
        & (F.col("text") == F.col("_w_text"))
        & (F.col("_least") < F.col("doc_id"))
    )
    return left.join(right, smaller, "left_semi").select(*docs.columns, "_hash")


def failure_combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, bits, documents, good, toxic``: how many documents of a part fail which filters.

    Bit i of ``bits`` is the i-th of filters A to E. ``good`` and ``toxic`` count documents labelled so.
    """
    rows = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("source", F.lit("")).alias("part")
    )
    failing = text_failures(F.col("text"))
    bits = sum((F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(failing.values())), F.lit(0))
    key = ["doc_id", "_hash", "part"]
    marked = rows.select("doc_id", F.xxhash64("text").alias("_hash"), "part", bits.alias("bits"), F.lit(1).alias("n"))
    copies = copies_of_smaller_ids(rows).select(*key, F.lit(1 << len(failing)).alias("bits"), F.lit(0).alias("n"))
    # Rows repeated with one id and text are one key that counts n times.
    documents = marked.union(copies).groupBy(*key).agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    quality = one_label_per_document(labels, "quality").withColumnRenamed("label", "_quality")
    toxic = one_label_per_document(labels, "toxic").withColumnRenamed("label", "_toxic")
    judged = quality.join(toxic, "doc_id", "full").select(F.col("doc_id").cast("string").alias("_id"), "_quality", "_toxic")
    # Documents without an id have no label; they get scattered keys instead of one shared null.
    own = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("no id "), F.col("_hash").cast("string")))
    return cut_lineage(
        documents.withColumn("_id", own)
        .join(judged, "_id", "left")
        .groupBy("part", "bits")
        .agg(
            F.sum("n").alias("documents"),
            F.sum(F.when(F.col("_quality") == 1, F.col("n")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("_toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"),
        )
    )


def orders_and_steps(letters: Sequence[str]) -> list[Column]:
    """Every step of every order: the order, the step from 1, its filter's bit and the bits of earlier ones."""
    rows = []
    for order in permutations(range(len(letters))):
        before = 0
        for step, i in enumerate(order, 1):
            rows.append(("".join(letters[j] for j in order), step, 1 << i, before))
            before |= 1 << i
    names = ("filter_order", "step", "_own", "_before")
    return [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)]) for row in rows]


def audit_orders(combinations: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """All orders and steps of a part from its ``bits, documents, good, toxic`` rows.

    A document counts for a filter's ``shapley`` once for each order in which it is the first
    of those that the document fails, an equal share of all orders for each of them.
    """
    counts = combinations.groupBy("part").agg(
        F.collect_list(F.struct("bits", "documents", "good", "toxic")).alias("_c")  # 2 ** filters at most
    )
    steps = counts.select("part", "_c", F.inline(F.array(*orders_and_steps(letters))))
    own, before = F.col("_own"), F.col("_before")

    def total(condition, value=lambda c: c["documents"]) -> Column:
        return F.aggregate(F.filter("_c", condition), F.lit(0).cast("long"), lambda a, c: a + value(c))

    fails = lambda c: c["bits"].bitwiseAND(own) != 0
    reached = lambda c: c["bits"].bitwiseAND(before) == 0
    removed = lambda c: fails(c) & reached(c)
    share = lambda c: c["documents"] * F.floor(F.lit(factorial(len(letters))) / F.bit_count(c["bits"]))
    return steps.select(
        "part",
        "filter_order",
        "step",
        total(lambda c: ~fails(c) & reached(c)).alias("kept"),
        total(removed).alias("removed"),
        total(lambda c: fails(c) & ~reached(c)).alias("redundant"),
        total(lambda c: c["bits"] == own).alias("unique_fails"),
        total(removed, lambda c: c["good"]).alias("good_lost"),
        total(removed, lambda c: c["toxic"]).alias("toxic_lost"),
        total(fails, share).alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per part (a ``source``; null: empty), order of filters A to E and step.

    A null text is an empty one. A document whose id is null never fails E and has no label; of
    repeated rows each counts, and equal ids are not smaller than each other. Repeated labels count by
    their mean, rounded half up, null ones not at all. An empty table gives no rows; other columns are not read.
    """
    return audit_orders(failure_combinations(docs, labels))


def oracle_sql() -> str:
    """The audit in DuckDB SQL, step by step over every order."""
    return rf"""
WITH rows_ AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part FROM documents),
split_ AS (SELECT *, list_filter(regexp_split_to_array(text, '{BLANKS}'), lambda w: w <> '') AS w,
                  min(doc_id) OVER (PARTITION BY text) < doc_id AS copied FROM rows_),
judged AS (SELECT doc_id, avg(quality) >= 0.5 AS good, avg(toxic) >= 0.5 AS toxic FROM labels GROUP BY doc_id),
marked AS (
  SELECT part, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic,
         concat(CASE WHEN len(w) < {MIN_WORDS} THEN 'A' END,
                CASE WHEN 100 * len(list_distinct(w)) < {MIN_DISTINCT_PERCENT} * len(w) THEN 'B' END,
                CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > {MAX_CAPITALS_PERCENT} * length(text) THEN 'C' END,
                CASE WHEN regexp_matches(text, '{SIGNS}') THEN 'D' END,
                CASE WHEN copied THEN 'E' END) AS failed
  FROM split_ LEFT JOIN judged USING (doc_id)),
letters(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE b.l <> a.l AND c.l NOT IN (a.l, b.l) AND d.l NOT IN (a.l, b.l, c.l) AND e.l NOT IN (a.l, b.l, c.l, d.l)),
steps AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS own, filter_order[1:step - 1] AS before
          FROM orders, range(1, 6) AS r(step)),
counted AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM marked GROUP BY ALL),
seen AS (
  SELECT part, filter_order, step, own, n, good, toxic, failed = own AS only_own, contains(failed, own) AS fails,
         length(translate(failed, before, '')) < length(failed) AS gone
  FROM counted, steps),
walked AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0) AS kept,
         coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS removed,
         coalesce(sum(n) FILTER (fails AND gone), 0) AS redundant,
         coalesce(sum(n) FILTER (only_own), 0) AS unique_fails,
         coalesce(sum(good) FILTER (fails AND NOT gone), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (fails AND NOT gone), 0) AS toxic_lost
  FROM seen GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM walked
"""
