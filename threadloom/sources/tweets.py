"""Message tables."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.schemas import TWEETS
from threadloom.sources.quoted_csv import read_quoted_csv


def scan_tweets(spark: SparkSession, path: str, bad_col: str | None = None) -> DataFrame:
    """Read message rows from CSV (quoted, multi-line texts) or Parquet.

    A CSV file is read by many tasks; ``bad_col`` keeps the text of records that do not fit.
    """
    if path.rstrip("/").endswith(".parquet"):
        rows = spark.read.schema(TWEETS).parquet(path)
        return rows.withColumn(bad_col, F.lit(None).cast("string")) if bad_col else rows
    return read_quoted_csv(spark, path, TWEETS, bad_col)


def write_tweets_csv(df: DataFrame, path: str) -> None:
    """CSV that ``scan_tweets`` reads back; only the empty text turns into NULL."""
    (
        df.select(*TWEETS.fieldNames())
        .write.mode("errorifexists")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
