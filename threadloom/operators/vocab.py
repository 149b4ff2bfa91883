"""Word vocabulary and token ids."""

from pyspark.sql import DataFrame, functions as F

from threadloom.functions.text import tokens
from threadloom.operators.ranking import zip_with_index
from threadloom.sources.stages import cut_lineage

PAD_ID = 0
EOS_ID = 1
OOV_ID = 2
FIRST_ID = 3
# So many of the most frequent tokens are broadcast (about 20 MB).
HEAD_TOKENS = 200_000
# A token that more than 1 / HOT_SHARE of all rows have is hot.
HOT_SHARE = 2_048


def build_vocab(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """``token, n, token_id``: dense ids by falling count, then token."""
    counted = (
        texts.select(F.explode(tokens(F.col(text_col))).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    indexed = zip_with_index(counted, [F.col("n").desc(), F.col("token").asc()], "token_id")
    return indexed.withColumn("token_id", (F.col("token_id") + FIRST_ID).cast("int"))


def tokenize_ids(
    texts: DataFrame,
    vocab: DataFrame,
    id_col: str,
    text_col: str = "text",
    out: str = "ids",
    max_ids: int | None = None,
) -> DataFrame:
    """Token ids per row in reading order; unknown tokens map to ``OOV_ID``.

    Rows of one id, or of none, are coded each. With ``max_ids`` only so many first tokens of a text are
    looked up. Ids rise with rarity, so the head of the vocabulary is its most frequent part
    and of known size: it is broadcast. Only the rare rest needs a shuffled join.
    """
    words = tokens(F.col(text_col))
    if max_ids is not None:
        words = F.slice(words, 1, max_ids)
    numbered = texts.select(id_col, F.monotonically_increasing_id().alias("_row"), words.alias("_words"))
    placed = numbered.select(id_col, "_row", F.posexplode_outer("_words").alias("pos", "token"))
    entries = vocab.select("token", "token_id")
    rare = F.col("token_id") >= FIRST_ID + HEAD_TOKENS
    coded = placed.join(F.broadcast(entries.where(~rare)), "token", "left")
    if entries.where(rare).limit(1).count():
        coded = _look_up_rare(coded, entries.where(rare), id_col)
    coded = coded.select(
        id_col,
        "_row",
        F.when(
            F.col("pos").isNotNull(),
            F.struct("pos", F.coalesce("token_id", F.lit(OOV_ID)).alias("code")),
        ).alias("t"),
    )
    gathered = coded.groupBy("_row", id_col).agg(
        F.transform(F.sort_array(F.collect_list("t")), lambda t: t["code"]).alias(out)
    )
    return gathered.drop("_row")


def _look_up_rare(coded: DataFrame, rare: DataFrame, id_col: str) -> DataFrame:
    """Fill in ids of rare tokens in two steps.

    Different unresolved tokens are counted and joined with the rare entries once. Those with a large
    share of all rows, known or not, are so few that they are broadcast; the others meet
    their ids in a join where no token is hot. Coded rows get scattered keys that match nothing.
    """
    coded = cut_lineage(coded)
    open_ones = coded.where("token is not null and token_id is null")
    counted = open_ones.groupBy("token").agg(F.count(F.lit(1)).alias("_n"))
    resolved = cut_lineage(
        counted.join(rare, "token", "left").select("token", "_n", F.coalesce("token_id", F.lit(OOV_ID)).alias("_rare_id"))
    )
    total = coded.count()
    is_hot = F.col("_n") * HOT_SHARE > total  # at most HOT_SHARE tokens
    hot = resolved.where(is_hot).select("token", F.col("_rare_id").alias("_hot_id"))
    known = F.coalesce("token_id", "_hot_id")
    partly = coded.join(F.broadcast(hot), "token", "left").withColumn("token_id", known).drop("_hot_id")
    key = F.when(F.col("token_id").isNull() & F.col("token").isNotNull(), F.concat(F.lit("t"), "token")).otherwise(
        F.concat(F.lit("d"), F.xxhash64("_row", "pos").cast("string"))
    )
    tail = resolved.where(~is_hot & (F.col("_rare_id") != OOV_ID)).select(
        F.concat(F.lit("t"), "token").alias("_key"), "_rare_id"
    )
    return (
        partly.withColumn("_key", key)
        .join(tail, "_key", "left")
        .select(id_col, "_row", "pos", F.coalesce("token_id", "_rare_id").alias("token_id"))
    )
