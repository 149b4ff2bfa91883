"""Whole-file documents and visited-URL lists."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.functions.text import strip_ws


def scan_text_docs(spark: SparkSession, path: str) -> DataFrame:
    """One row per UTF-8 file: ``source`` path and whole ``text``."""
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("source"), F.col("value").alias("text")
    )


def url_registry(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """The set of visited URLs."""
    return urls.select(strip_ws(F.col(url_col)).alias("url")).distinct()


def save_urls(urls: DataFrame, path: str) -> None:
    """One URL per line."""
    url_registry(urls).write.mode("errorifexists").text(path)


def load_urls(spark: SparkSession, path: str) -> DataFrame:
    return url_registry(spark.read.text(path), "value")
