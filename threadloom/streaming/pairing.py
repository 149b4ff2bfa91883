"""Reply pairing on two message streams."""

from pyspark.sql import DataFrame, functions as F

from threadloom.operators.pairs import inbound_split, reply_pairs


def stream_pair_replies(
    asked_stream: DataFrame,
    answered_stream: DataFrame,
    ts_col: str = "ts",
    text_col: str = "cleaned_text",
    delay: str = "1 day",
    wait: str = "7 days",
) -> DataFrame:
    """Stream-stream inner join of customer messages with replies at most ``wait`` later.

    Watermarks on both sides let Spark drop messages that can no longer be answered.
    """
    asked, _ = inbound_split(asked_stream)
    _, answered = inbound_split(answered_stream)
    asked = asked.select(
        "tweet_id", F.col(text_col).alias("input"), F.col(ts_col).alias("asked_at")
    ).withWatermark("asked_at", delay)
    answered = (
        answered.where(F.col("in_response_to_tweet_id").isNotNull())
        .select(
            F.col("tweet_id").alias("reply_id"),
            "in_response_to_tweet_id",
            F.col(text_col).alias("response"),
            F.col("author_id").alias("company"),
            F.col(ts_col).alias("answered_at"),
        )
        .withWatermark("answered_at", delay)
    )
    in_time = (answered["answered_at"] >= asked["asked_at"]) & (
        answered["answered_at"] <= asked["asked_at"] + F.expr(f"INTERVAL {wait}")
    )
    return reply_pairs(asked, answered, in_time).select(
        "tweet_id", "reply_id", "input", "response", F.lit(True).alias("customer_input"), "company"
    )
