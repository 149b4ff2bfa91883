"""Knowledge-base tables: chunks with vectors, stored as Parquet."""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from threadloom.functions.vectors import cosine_similarity
from threadloom.operators.ranking import zip_with_index
from threadloom.schemas import KB_CHUNKS


def kb_write(chunks: DataFrame, path: str) -> None:
    chunks.select(*KB_CHUNKS.fieldNames()).write.mode("errorifexists").parquet(path)


def kb_load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(KB_CHUNKS).parquet(path)


def kb_count(kb: DataFrame) -> DataFrame:
    return kb.agg(F.count("embedding").alias("vectors"))


def kb_dump(kb: DataFrame, query_vector: list[float], k: int | None = None) -> DataFrame:
    """Ranked text blocks for one query vector; by default the whole table."""
    query = F.array(*[F.lit(float(v)) for v in query_vector])
    scored = kb.where(F.col("embedding").isNotNull()).withColumn(
        "score", F.round(cosine_similarity(F.col("embedding"), query), 12)
    )
    order = [F.col("score").desc(), F.col("source").asc(), F.col("chunk_idx").asc()]
    if k is None:
        ranked = zip_with_index(scored, order, "rank").withColumn("rank", F.col("rank") + 1)
    else:
        # At most k rows reach this window.
        ranked = scored.orderBy(*order).limit(k).withColumn(
            "rank", F.row_number().over(Window.orderBy(*order)).cast("long")
        )
    return ranked.select(
        "rank",
        F.concat(
            F.lit("["),
            F.col("rank").cast("string"),
            F.lit("] Source: "),
            F.coalesce("source", F.lit("unknown")),
            F.lit("\n"),
            F.col("text"),
            F.lit("\n\n"),
        ).alias("block"),
    )


def save_dump(blocks: DataFrame, path: str) -> None:
    """Write blocks as text in rank order (one file per range of ranks)."""
    # The writer ends every value with the last of the block's two newlines.
    blocks.repartitionByRange("rank").sortWithinPartitions("rank").select(
        F.expr("left(block, length(block) - 1)").alias("block")
    ).write.mode("errorifexists").text(path)
