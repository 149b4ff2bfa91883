"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

Every window of an item (some consecutive words) is a set of shingles at fixed places. A document
contains a window only if it has all of its shingles, so in any order of the shingles the first
``size - containment * size + 1`` of them are a necessary prefix: one, as containment is whole. Shingles are
ordered by rarity over all documents, so the join meets the rarest one of each window; a
window one of whose shingles no document has is dropped. A meeting gives the place of the window
(positional bound), which must lie within the document (length bound); its words are compared there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.llm.common import ascii_words, ascii_words_sql
from threadloom.sources.stages import scratch_path

WINDOW_WORDS = 10
SHINGLE_WORDS = 3
# Rows that may be broadcast: a benchmark's shingles and windows, and the places to compare.
BROADCAST_ROWS = 200_000
SALTS = 16
KEY = ("_none", "_id", "_text")


def row_key(text: str | Column = "text") -> list[Column]:
    """What tells rows apart, without nulls: rows of equal id and text give equal results."""
    return [
        F.col("doc_id").isNull().alias(KEY[0]),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias(KEY[1]),
        F.xxhash64(text).alias(KEY[2]),
    ]


def _shingles(words: Column, k: int) -> Column:
    """Hashes of all ``k`` consecutive words, in order; none of a shorter text."""
    hashes = F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + j) for j in range(1, k)]))
    return F.slice(hashes, F.lit(1), F.greatest(F.size(words) - (k - 1), F.lit(0)))


def _placed(words: Column, k: int, place: str) -> Column:
    """``k, <place>, shingle`` of all shingles."""
    return F.transform(_shingles(words, k), lambda h, i: F.struct(F.lit(k).alias("k"), i.alias(place), h.alias("shingle")))


def item_windows(items: DataFrame, window_words: int = WINDOW_WORDS) -> DataFrame:
    """``window, item_ids``: every different run of ``window_words`` words of an item, and whose it is.

    An item of fewer words, but not none, is one window.
    """
    worded = items.select(F.col("item_id"), ascii_words("text").alias("_words")).where(F.size("_words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("_words") - (window_words - 1), F.lit(1)))
    windows = worded.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("_words", i, window_words))).alias("window"))
    return windows.groupBy("window").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))


def _window_shingles(windows: DataFrame, shingle_words: int) -> DataFrame:
    """``window, item_ids, k, offset, shingle``: every shingle of every window; of all its words if they are fewer."""
    kinds = [
        F.when(
            (F.size("window") == k) if k < shingle_words else (F.size("window") >= k),
            _placed(F.col("window"), k, "offset"),
        )
        for k in range(1, shingle_words + 1)
    ]
    return windows.select("window", "item_ids", F.inline(F.coalesce(*kinds)))


def _document_shingles(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """``key, n_words, k, at, shingle``: the shingles of ``lengths`` words of every document."""
    kinds = [_placed(F.col("_words"), k, "at") for k in lengths]
    worded = docs.select(*row_key(), ascii_words("text").alias("_words"))
    return worded.select(*KEY, F.size("_words").alias("n_words"), F.inline(F.concat(*kinds) if len(kinds) > 1 else kinds[0]))


def _join_small(left: DataFrame, right: DataFrame, on: list[str], rows: int) -> DataFrame:
    """Join with a table of ``rows`` rows: broadcast if they are few, else with salted keys."""
    if rows <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), on)
    salted = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.withColumn("_salt", F.pmod(F.xxhash64("at", "_id"), F.lit(SALTS)).cast("int")).join(salted, [*on, "_salt"]).drop("_salt")


def window_places(docs: DataFrame, items: DataFrame, window_words: int = WINDOW_WORDS, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``key, places``: where windows can lie, per document, by the prefix join.

    ``places`` is a list of ``start, window, item_ids``. Documents without any are left out.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "windows")
    _window_shingles(item_windows(items, window_words), shingle_words).write.parquet(path)
    shingles = spark.read.parquet(path)
    known = shingles.select("k", "shingle").distinct()
    # How many shingles, and which lengths, are there: at most shingle_words rows.
    sizes = {r["k"]: r["n"] for r in known.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = sum(sizes.values())
    # Every shingle of every document that some item has, written once: both the order by rarity over
    # all documents and the join read it.
    path = scratch_path(spark, "shared-shingles")
    shared = _join_small(_document_shingles(docs, sorted(sizes) or [shingle_words]), known, ["k", "shingle"], rows)
    shared.write.parquet(path)
    shared = spark.read.parquet(path)
    rarity = shared.groupBy("k", "shingle").agg(F.count(F.lit(1)).alias("n"))
    ranked = shingles.join(rarity, ["k", "shingle"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    first = F.min(F.struct("n", "shingle", "offset", "k")).alias("first")
    prefixes = (
        ranked.groupBy("window", "item_ids").agg(first).where("first.n > 0")
        .select("first.k", "first.shingle", "first.offset", F.struct("window", "item_ids").alias("found"))
    )
    path = scratch_path(spark, "prefixes")
    prefixes.write.parquet(path)
    prefixes = spark.read.parquet(path)
    start = F.col("at") - F.col("offset")
    met = (
        _join_small(shared, prefixes, ["k", "shingle"], prefixes.count())
        .withColumn("start", start)
        .where((F.col("start") >= 0) & (F.col("start") + F.size("found.window") <= F.col("n_words")))
    )
    # Rows repeated with one id and text meet the same places.
    return met.groupBy(*KEY).agg(F.collect_set(F.struct("start", "found.window", "found.item_ids")).alias("places"))


def find_contamination(
    docs: DataFrame, items: DataFrame, window_words: int = WINDOW_WORDS, shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """``doc_id, n_words, n_hit, item_ids, spans`` for every row of ``docs``.

    ``n_hit`` counts the words inside occurring windows of ``items(item_id, text)``, ``spans`` lists these
    windows as ``start, length`` in order, and ``item_ids`` the different items that have one. Null texts have no words;
    null ids and repeated rows are searched like any other; items of null id take part but name nothing;
    an item listed twice counts once; items without words have no window. Empty tables of
    documents give no rows, of items no hits; other columns are not read.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "places")
    window_places(docs, items, window_words, shingle_words).write.parquet(path)
    places = spark.read.parquet(path)
    number = places.agg(F.coalesce(F.sum(F.size("places")), F.lit(0))).first()[0]
    if number <= BROADCAST_ROWS:
        places = F.broadcast(places)
    rows = docs.select("doc_id", *row_key(), ascii_words("text").alias("_words"))
    whole = F.filter("places", lambda p: F.slice("_words", p["start"] + 1, F.size(p["window"])) == p["window"])
    seen = rows.join(places, list(KEY), "left").select(
        "doc_id", F.size("_words").cast("long").alias("n_words"), F.coalesce(whole, F.array().cast(places.schema["places"].dataType)).alias("_seen")
    )
    spans = F.array_sort(
        F.array_distinct(F.transform("_seen", lambda p: F.struct(p["start"].alias("start"), F.size(p["window"]).alias("length"))))
    )
    zero = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).alias("end"))

    def cover(state: Column, span: Column) -> Column:
        end = span["start"] + span["length"]
        fresh = F.greatest(end - F.greatest(span["start"], state["end"]), F.lit(0))
        return F.struct((state["hit"] + fresh).cast("long").alias("hit"), F.greatest(state["end"], end).alias("end"))

    listed = F.array_sort(F.array_distinct(F.flatten(F.transform("_seen", lambda p: p["item_ids"]))))
    return seen.select("doc_id", "n_words", spans.alias("spans"), listed.alias("item_ids")).select(
        "doc_id", "n_words", F.aggregate("spans", zero, cover, lambda s: s["hit"]).alias("n_hit"), "item_ids", "spans"
    )


def oracle_sql() -> str:
    """The digest in DuckDB SQL: every run of words of every document against every window."""
    words = ascii_words_sql("text")
    return f"""
WITH items AS (SELECT item_id, {words} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least({WINDOW_WORDS}, len(w)) AS n, array_to_string(w[i:i + {WINDOW_WORDS} - 1], ' ') AS line
  FROM items, unnest(range(1, greatest(len(w) - {WINDOW_WORDS - 1}, 1) + 1)) AS r(i) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM windows),
docs AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM documents),
spots AS (
  SELECT rid, pos, n, array_to_string(w[pos:pos + n - 1], ' ') AS line
  FROM docs, lengths, unnest(range(1, len(w) - n + 2)) AS r(pos)),
hits AS (SELECT rid, pos, n, item_id FROM spots JOIN windows USING (n, line)),
covered AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT rid, pos, n FROM hits), unnest(range(pos, pos + n)) AS r(p) GROUP BY rid),
listed AS (
  SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM hits GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN covered USING (rid) LEFT JOIN listed USING (rid)
"""
