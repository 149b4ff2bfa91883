"""The registered corpus queries and, where SQL can express them, their twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.llm import decontamination, filter_audit, licenses, mixing, neighbours, packing, quality, runs, simhash, token_files, topk, toxicity, warc
from threadloom.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_register
def op9_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@_register
def op1_block_max_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search_top_k(read_table(spark, sf_dir, "documents"), F.col("doc_id") % 100 == 0)


ORACLES["op1_block_max_wand"] = topk.oracle_sql()

PACK_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
FILE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@_register
def op2_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), PACK_TOKENIZER)


@_register
def op3_deobfuscated_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@_register
def op4_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(read_table(spark, sf_dir, "pages"))


ORACLES["op4_warc_round_trip"] = f"""
WITH rows_ AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
digests AS (SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM rows_),
owned AS (SELECT *, CASE WHEN payload_bytes >= {warc.MIN_SHARED_BYTES}
                         THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS own FROM digests)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN own = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN own <> page_id THEN own END AS refers_to
FROM owned
"""


@_register
def op5_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@_register
def op6_simhash_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@_register
def op7_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


ORACLES["op7_license_diagonals"] = licenses.oracle_sql()


@_register
def op8_bit_packed_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digest(read_table(spark, sf_dir, "documents"), FILE_TOKENIZER)


@_register
def op10_soft_membership_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labelled = mixing.labelled_languages(docs, read_table(spark, sf_dir, "labels"))
    return mixing.mixing_rates(docs, labelled, mixing.LANGUAGE_TARGETS)


@_register
def op11_prefix_filtered_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marked documents as ids and digests."""
    found = decontamination.find_contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLES["op11_prefix_filtered_decontamination"] = decontamination.oracle_sql()


@_register
def op12_synchronised_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digest(runs.find_runs(runs.plant_repetitions(read_table(spark, sf_dir, "documents"))))


@_register
def op13_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


ORACLES["op13_filter_interactions"] = filter_audit.oracle_sql()
