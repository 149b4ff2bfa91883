"""What several corpus operators share: table access, label joins, hash samples."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

DOCUMENT_COLUMNS = ("doc_id", "text")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after lower-casing: ASCII but letters and digits


BLANKS = r"[\x20\x09-\x0D]+"


def ascii_words(text: str | Column) -> Column:
    """Words of letters, digits and all other than ASCII characters, A-Z lower-cased; none for null."""
    lowered = F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, WORD_BREAKS), lambda w: w != "")


def ascii_words_sql(text: str) -> str:
    """``ascii_words`` in DuckDB SQL."""
    lowered = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
    return f"list_filter(regexp_split_to_array({lowered}, '{WORD_BREAKS}'), lambda w: w <> '')"


def crc_bucket(id_col: str, buckets: int) -> Column:
    """crc32 of the id's text modulo ``buckets``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % buckets


def held_out(id_col: str, buckets: int, remainder: int) -> Column:
    """Rows whose labels may never be learnt from; a null id is not held out."""
    return F.coalesce(crc_bucket(id_col, buckets) == remainder, F.lit(False))


def one_label_per_document(labels: DataFrame, label: str) -> DataFrame:
    """``doc_id, label``: the mean of a document's labels, rounded half up; null labels are left out."""
    return (
        labels.select("doc_id", F.col(label).cast("double").alias("_label"))
        .where(F.col("doc_id").isNotNull() & F.col("_label").isNotNull())
        .groupBy("doc_id")
        .agg((F.avg("_label") >= 0.5).cast("int").alias("label"))
    )


def training_sample(
    docs: DataFrame, labels: DataFrame, label: str, fold: Column, max_rows: int, seed: int
) -> DataFrame:
    """``doc_id, text, label, _order``: about ``max_rows`` labelled rows outside the held-out fold.

    The bound is a fitting parameter only. Rows are chosen by a hash threshold on the id
    set from one count, so no row is sorted or collected to draw them, and the
    same table always gives the same sample.
    """
    usable = one_label_per_document(labels, label).where(~fold)
    total = usable.count()
    order = F.xxhash64(F.col("doc_id"), F.lit(seed))
    usable = usable.withColumn("_order", order)
    if total > max_rows:
        cut = int(-(2**63) + (max_rows / total) * 2**64)
        usable = usable.where(F.col("_order") < F.lit(cut).cast("long"))
    return docs.select("doc_id", "text").join(usable, "doc_id")


def text_bytes(texts: pa.Array, tail: str = "") -> tuple[np.ndarray, np.ndarray]:
    """All texts of a batch as one byte array and its row offsets; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if tail:
        texts = pc.binary_join_element_wise(texts, pa.scalar(tail, pa.large_string()), pa.scalar("", pa.large_string()))
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[starts[0] : starts[-1]], starts - starts[0]


def small_slices(texts: pa.Array, max_bytes: int = 1 << 20) -> Iterator[pa.Array]:
    """Consecutive slices of a batch of about ``max_bytes`` of text each; no text is cut.

    The arrays of a slice take up to 25 times its bytes (text statistics), in every worker of an executor.

    Keeps numpy work on a batch small however long the texts are. An empty batch gives itself.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes, dtype=np.int64) // max_bytes
    starts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        yield texts.slice(a, b - a)


def plain_texts(texts: pa.Array) -> list[str]:
    return ["" if t is None else t for t in texts.to_pylist()]
