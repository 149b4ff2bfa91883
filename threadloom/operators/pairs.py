"""Message filters, reply pairing and author tables."""

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.functions.text import mask_noise, normalize_masked, strip_user_prefix
from threadloom.functions.context import plain_prompt


def clean_tweets(df: DataFrame, text_col: str = "text", out: str = "cleaned_text") -> DataFrame:
    """Add the cleaned text, computed once per row.

    A filter on a projected column is pushed below the projection and repeats its
    expression there. The one-element explode keeps such a filter above the
    cleaning, while filters on other columns still reach the scan.
    """
    masked = df.withColumn("_masked", mask_noise(F.col(text_col)))
    cleaned = F.explode(F.array(normalize_masked(F.col("_masked"))))
    return masked.select(*df.columns, cleaned.alias(out))


def min_length_filter(df: DataFrame, min_len: int = 0, col: str = "cleaned_text") -> DataFrame:
    return df.where(F.length(col) > min_len)


def inbound_split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Customer rows and company rows; an unknown direction is neither."""
    return df.where(F.col("inbound")), df.where(~F.col("inbound"))


def company_filter(df: DataFrame, companies: list[str], col: str = "company") -> DataFrame:
    return df.where(F.col(col).isin(companies))


def semi_company(df: DataFrame, companies: DataFrame, col: str = "company") -> DataFrame:
    """Membership in a company table; Spark broadcasts it when its size allows."""
    return df.join(companies, col, "left_semi")


def company_ids(df: DataFrame) -> DataFrame:
    return df.where(~F.col("inbound")).select("author_id").distinct()


def top_active_authors(df: DataFrame, n: int = 20) -> DataFrame:
    return (
        df.groupBy("author_id")
        .agg(F.count(F.lit(1)).alias("messages"))
        .orderBy(F.desc("messages"), F.asc("author_id"))
        .limit(n)
    )


def reply_pairs(customers: DataFrame, companies: DataFrame, condition: Column | None = None):
    """Columns and join shared by the batch and streaming pairing."""
    matched = companies["in_response_to_tweet_id"] == customers["tweet_id"]
    if condition is not None:
        matched = matched & condition
    return customers.join(companies, matched, "inner")


def pair_replies(
    df: DataFrame, text_col: str = "cleaned_text", keep_ids: bool = False
) -> DataFrame:
    """Every customer message with every company reply to it.

    An equi-join on the message id: the customer side is unique, a message with
    very many replies is split over tasks by the adaptive skew join, and replies
    without a parent are dropped before the shuffle.
    """
    asked, answered = inbound_split(df)
    asked = asked.select("tweet_id", F.col(text_col).alias("input"))
    answered = answered.where(F.col("in_response_to_tweet_id").isNotNull()).select(
        F.col("tweet_id").alias("reply_id"),
        "in_response_to_tweet_id",
        F.col(text_col).alias("response"),
        F.col("author_id").alias("company"),
    )
    ids = ["tweet_id", "reply_id"] if keep_ids else []
    return reply_pairs(asked, answered).select(
        *ids, "input", "response", F.lit(True).alias("customer_input"), "company"
    )


def format_plain(pairs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Training rows without retrieval."""
    return pairs.select(
        *keep,
        plain_prompt(strip_user_prefix(F.col("input"))).alias("input_text"),
        strip_user_prefix(F.col("response")).alias("target_text"),
        "company",
    )
