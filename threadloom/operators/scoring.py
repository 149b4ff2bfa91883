"""Word tables, plausibility, sentiment and loss summaries."""

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.constants import WS
from threadloom.functions.text import frequency_words, tokens

# A word list with at most this many entries (about 200 MB hashed) is broadcast.
BROADCAST_WORDS = 4_000_000
LEXICON_ROWS = 1_000_000
NEGATORS = ("not", "no", "never", "cannot")


def word_frequency(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, n, zipf`` with zipf = log10(occurrences per billion words)."""
    words = (
        texts.select(F.explode(frequency_words(F.col(text_col))).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = words.agg(F.sum("n").alias("total")).scalar()
    return words.withColumn(
        "zipf", F.log10(F.col("n") / total * F.lit(1e9))
    )


def gibberish_gate(
    texts: DataFrame,
    frequencies: DataFrame,
    id_col: str,
    text_col: str = "text",
    min_zipf: float = 2.5,
) -> DataFrame:
    """Verdict per row: ``short``, ``no_words``, ``rare`` or ``ok``; rows of one id, or of none, are judged each.

    Only words at or above ``min_zipf`` take part in the join: a word that common
    has a share of at least 10**(min_zipf-9), so no corpus of any size has more
    than 10**(9-min_zipf) of them.
    """
    common = frequencies.where(F.col("zipf") >= min_zipf).select(
        "word", F.lit(1).alias("known")
    )
    sized = texts.select(
        id_col,
        F.monotonically_increasing_id().alias("_row"),
        F.size(
            F.filter(F.split(F.col(text_col), WS + "+"), lambda t: F.length(t) > 0)
        ).alias("n_tokens"),
        frequency_words(F.col(text_col)).alias("words"),
    )
    words = sized.select(id_col, "_row", "n_tokens", F.explode_outer("words").alias("word"))
    if 10 ** (9 - min_zipf) <= BROADCAST_WORDS:
        # The bounded list goes to the words; only sums per text are shuffled.
        common = F.broadcast(common)
    return (
        words.join(common, "word", "left")
        .groupBy("_row", id_col)
        .agg(
            F.first("n_tokens").alias("n_tokens"),
            F.count("word").alias("n_words"),
            F.count("known").alias("n_common"),
        )
        .withColumn("verdict", _verdict(F.col("n_tokens"), F.col("n_words"), F.col("n_common")))
        .drop("_row")
    )


def _verdict(n_tokens: Column, n_words: Column, n_common: Column) -> Column:
    return (
        F.when(n_tokens < 3, "short")
        .when(n_words == 0, "no_words")
        .when(n_common * 2 < n_words, "rare")
        .otherwise("ok")
    )


def sentiment(
    texts: DataFrame,
    lexicon: DataFrame,
    id_col: str,
    text_col: str = "text",
    negators: tuple[str, ...] = NEGATORS,
) -> DataFrame:
    """Mean lexicon polarity per row in [-1, 1]; a negator before a word turns it by -0.5.

    Rows of one id, or of none, are scored each.

    A lexicon of checked size is broadcast to the words, so only sums per text are
    shuffled. A larger one is joined to word counts per text.
    """
    located = texts.select(id_col, F.monotonically_increasing_id().alias("_row"), tokens(F.col(text_col)).alias("ws"))
    words = located.select(
        id_col,
        "_row",
        F.explode_outer(
            F.transform(
                F.col("ws"),
                lambda w, i: F.struct(
                    w.alias("word"),
                    F.coalesce(F.get(F.col("ws"), i - 1).isin(*negators), F.lit(False)).alias(
                        "negated"
                    ),
                ),
            )
        ).alias("t"),
    ).select(id_col, "_row", "t.word", "t.negated", F.lit(1).alias("n"))
    if lexicon.count() <= LEXICON_ROWS:
        hits = words.join(F.broadcast(lexicon), "word", "left")
    else:
        counted = words.groupBy("_row", id_col, "word", "negated").agg(F.count(F.lit(1)).alias("n"))
        hits = counted.join(lexicon, "word", "left")
    weight = F.when(F.col("negated"), F.lit(-0.5)).otherwise(F.lit(1.0)) * F.col("polarity")
    scored = hits.groupBy("_row", id_col).agg(
        F.coalesce(
            F.try_divide(
                F.sum(weight * F.col("n")),
                F.sum(F.when(F.col("polarity").isNotNull(), F.col("n"))),
            ),
            F.lit(0.0),
        ).alias("sentiment")
    )
    return scored.drop("_row")


def perplexity(
    losses: DataFrame, by: list[str], nll: str = "nll", weight: str | None = None
) -> DataFrame:
    """``exp`` of the mean loss per group, infinite from a mean loss of 100 on."""
    w = F.lit(1) if weight is None else F.col(weight)
    return (
        losses.groupBy(*by)
        .agg((F.sum(F.col(nll) * w) / F.sum(w)).alias("eval_loss"))
        .withColumn(
            "perplexity",
            F.when(F.col("eval_loss") < 100, F.exp("eval_loss")).otherwise(
                F.lit(float("inf"))
            ),
        )
    )
