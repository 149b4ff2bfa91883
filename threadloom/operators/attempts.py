"""Choosing among candidate answers."""

from pyspark.sql import Column, DataFrame, functions as F


def attempt_temperature(attempt: Column, start: float = 0.8) -> Column:
    return F.greatest(F.lit(0.3), F.lit(start) - attempt * 0.1)


def first_valid_attempt(
    attempts: DataFrame, keys: list[str], accepted: Column, response: str = "response"
) -> DataFrame:
    """Per message: the earliest accepted answer (NULL if none) and its attempt number.

    ``min_by`` combines before the shuffle, so only one row per message moves.
    """
    valid = F.when(accepted, F.col("attempt"))
    return attempts.groupBy(*keys).agg(
        F.min(valid).alias("attempt"),
        F.min_by(F.col(response), valid).alias("valid_response"),
        F.count(F.lit(1)).alias("attempts"),
    )
