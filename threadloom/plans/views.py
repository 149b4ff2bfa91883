"""Views both engines derive from the given tables, in Spark and in SQL."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadloom.constants import CONTRACTIONS, EMOJI_TAGS, WORD, WS, WS_BODY
from threadloom.functions.text import MENTION, NOT_KEPT, URL
from threadloom.operators.ranking import topk_per_group

SEED = 42
COMPANIES = ["company_0", "company_1", "company_2", "company_9"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- messages ---------------------------------------------------------------
def tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv_id")
    return (
        table(spark, sf_dir, "conversations")
        .where(F.col("role") != "system")
        .select(
            (conv * TURN_KEYS + F.col("turn")).alias("tweet_id"),
            F.when(F.col("role") == "user", F.concat(F.lit("user_"), conv.cast("string")))
            .otherwise(F.concat(F.lit("company_"), (conv % 5).cast("string")))
            .alias("author_id"),
            (F.col("role") == "user").alias("inbound"),
            "text",
            F.when(F.col("turn") > 0, conv * TURN_KEYS + F.col("turn") - 1).alias(
                "in_response_to_tweet_id"
            ),
        )
    )


def noisy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with one of nine kinds of dirt each."""
    kind = (F.col("tweet_id") + F.expr(f"tweet_id div {TURN_KEYS}L")) % 9
    text = F.col("text")
    dirty = (
        F.when(kind == 0, text)
        .when(kind == 1, F.concat(F.lit("@Bob_1 "), text))
        .when(kind == 2, F.concat(text, F.lit(" see http://x.example/a?b=1 now")))
        .when(kind == 3, F.concat(F.lit("a &amp; b &quot;ok&quot; "), text))
        .when(kind == 4, F.concat(F.lit("I can't and he'd've go, won't. "), text))
        .when(kind == 5, F.concat(text, F.lit(" thanks ❤️")))
        .when(kind == 6, F.concat(F.lit("  wide   gap "), text))
        .when(kind == 7, F.lit("ok"))
    )
    return tweets(spark, sf_dir).withColumn("text", dirty)


TWEETS_SQL = """
tweets AS (
  SELECT conv_id * 4294967296 + turn AS tweet_id,
         CASE WHEN role = 'user' THEN concat('user_', CAST(conv_id AS VARCHAR))
              ELSE concat('company_', CAST(conv_id % 5 AS VARCHAR)) END AS author_id,
         role = 'user' AS inbound,
         text,
         CASE WHEN turn > 0 THEN conv_id * 4294967296 + turn - 1 END AS in_response_to_tweet_id
  FROM conversations WHERE role <> 'system'
)"""

NOISY_SQL = (
    TWEETS_SQL
    + """,
noisy AS (
  SELECT tweet_id, author_id, inbound, in_response_to_tweet_id,
    CASE CAST((tweet_id + (tweet_id // 4294967296)) % 9 AS INT)
      WHEN 0 THEN text
      WHEN 1 THEN concat('@Bob_1 ', text)
      WHEN 2 THEN concat(text, ' see http://x.example/a?b=1 now')
      WHEN 3 THEN concat('a &amp; b &quot;ok&quot; ', text)
      WHEN 4 THEN concat('I can''t and he''d''ve go, won''t. ', text)
      WHEN 5 THEN concat(text, ' thanks ❤️')
      WHEN 6 THEN concat('  wide   gap ', text)
      WHEN 7 THEN 'ok'
      ELSE NULL END AS text
  FROM tweets
)"""
)


# --- SQL text expressions ----------------------------------------------------
# Turns a conversation may have in a key made of both.
TURN_KEYS = 1 << 32


def q(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def sql_unescape(t: str) -> str:
    for name, char in (("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©")):
        t = f"replace({t}, '{name}', {q(char)})"
    return f"regexp_replace({t}, '&amp;?', '&', 'g')"


def sql_emoji(t: str) -> str:
    for emoji, tag in EMOJI_TAGS.items():
        t = f"replace({t}, {q(emoji)}, {q(tag)})"
    return t


def sql_re(t: str, pattern: str, by: str) -> str:
    return f"regexp_replace({t}, {q(pattern)}, {q(by)}, 'g')"


def sql_contractions(t: str) -> str:
    pattern = q("|".join(CONTRACTIONS))
    entries = ", ".join(f"{q(k)}: {q(v)}" for k, v in CONTRACTIONS.items())
    return (
        f"array_to_string(list_transform(list_zip(string_split_regex({t}, {pattern}), "
        f"regexp_extract_all({t}, {pattern})), "
        f"lambda z: concat(z[1], coalesce(MAP {{{entries}}}[z[2]], ''))), '')"
    )


def sql_squeeze(t: str) -> str:
    return f"trim({sql_re(t, WS + '+', ' ')})"


def sql_strip(t: str) -> str:
    return sql_re(t, rf"\A{WS}+|{WS}+\z", "")


def sql_user_prefix(t: str) -> str:
    return sql_re(t, r"(?i)\A(?:USER[:\-.," + WS_BODY + "]*)+", "")


CLEAN_CTE = (
    NOISY_SQL
    + f""",
masked AS (
  SELECT * EXCLUDE (text), {sql_re(sql_re(sql_emoji(sql_unescape("coalesce(text, '')")), URL, ""), MENTION, "[USER]")} AS m
  FROM noisy
),
expanded AS (SELECT *, {sql_contractions("m")} AS e FROM masked),
cleaned AS (
  SELECT tweet_id, author_id, inbound, in_response_to_tweet_id,
         {sql_squeeze(sql_re("e", NOT_KEPT, ""))} AS cleaned_text
  FROM expanded
)"""
)

PAIRS_CTE = (
    CLEAN_CTE
    + """,
kept AS (SELECT * FROM cleaned WHERE length(cleaned_text) > 10),
pairs AS (
  SELECT c.tweet_id, r.tweet_id AS reply_id, c.cleaned_text AS input,
         r.cleaned_text AS response, TRUE AS customer_input, r.author_id AS company
  FROM kept c JOIN kept r ON r.in_response_to_tweet_id = c.tweet_id
  WHERE c.inbound AND NOT r.inbound
)"""
)


def words_sql(t: str, minimum: int) -> str:
    """Whole tokens made of at least ``minimum`` a-z letters."""
    return (
        f"list_filter(regexp_extract_all(lower({t}), {q(WORD + '+')}), "
        f"lambda w: regexp_full_match(w, '[a-z]{{{minimum},}}'))"
    )


def tokens_sql(t: str) -> str:
    return f"regexp_extract_all(lower({t}), {q(WORD + '+')})"


# --- knowledge base, messages with vectors, contexts --------------------------
def kb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, one chunk each.

    The vector table is shorter than the documents, so document ``i`` takes vector ``i`` modulo their
    number, read backwards in every second round. A document that finds none stays, without a vector.
    """
    docs = table(spark, sf_dir, "documents")
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    count = F.greatest(vectors.agg(F.count(F.lit(1)).alias("n")).scalar(), F.lit(1))
    turned = F.expr("doc_id div _n") % 2 == 1
    return (
        docs.withColumn("_n", count)
        .withColumn("_vec", F.col("doc_id") % F.col("_n"))
        .join(vectors, F.col("_vec") == F.col("vec_id"), "left")
        .select(
            F.col("doc_id").alias("chunk_id"),
            "source",
            F.col("doc_id").cast("int").alias("chunk_idx"),
            "text",
            F.when(turned, F.reverse("embedding")).otherwise(F.col("embedding")).alias("embedding"),
        )
    )


KB_SQL = """
kb AS (
  SELECT doc_id AS chunk_id, source, CAST(doc_id AS INTEGER) AS chunk_idx, text,
         CASE WHEN (doc_id // n) % 2 = 1 THEN list_reverse(embedding) ELSE embedding END AS embedding
  FROM documents CROSS JOIN (SELECT greatest(count(*), 1) AS n FROM embeddings)
  LEFT JOIN embeddings ON doc_id % n = vec_id
)"""


def vectors_of(ids: DataFrame, spark: SparkSession, sf_dir: str, conv: Column, straight: Column):
    """Attach the conversation's vector, read backwards where ``straight`` is false."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ids.join(vectors, conv == F.col("vec_id"), "left").withColumn(
        "embedding",
        F.when(straight, F.col("embedding")).otherwise(F.reverse(F.col("embedding"))),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer turns as queries with a vector."""
    users = table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    return vectors_of(users, spark, sf_dir, F.col("conv_id"), F.col("turn") < 2).select(
        (F.col("conv_id") * TURN_KEYS + F.col("turn")).alias("query_id"),
        "conv_id",
        "turn",
        F.col("text").alias("message"),
        "embedding",
    )


MESSAGES_SQL = """
messages AS (
  SELECT conv_id * 4294967296 + turn AS query_id, conv_id, turn, text AS message,
         CASE WHEN turn < 2 THEN embedding ELSE list_reverse(embedding) END AS embedding
  FROM conversations LEFT JOIN embeddings ON conv_id = vec_id WHERE role = 'user'
)"""


def contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per conversation the first three support turns as ranked contexts, none without any."""
    turns = table(spark, sf_dir, "conversations")
    support = turns.where(F.col("role") == "assistant")
    ranked = (
        topk_per_group(support, ["conv_id"], [F.col("turn")], 3)
        .groupBy("conv_id")
        .agg(
            F.transform(
                F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda r: r["text"]
            ).alias("_found")
        )
    )
    none = F.array().cast("array<string>")
    return (
        turns.select("conv_id")
        .distinct()
        .join(ranked, "conv_id", "left")
        .select("conv_id", F.coalesce("_found", none).alias("contexts"))
    )


CONTEXTS_SQL = """
contexts AS (
  SELECT conv_id, coalesce(found, CAST([] AS VARCHAR[])) AS contexts
  FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN (
    SELECT conv_id, list(text ORDER BY turn) AS found
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn
          FROM conversations WHERE role = 'assistant')
    WHERE rn <= 3 GROUP BY conv_id) USING (conv_id)
)"""


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three candidate answers per support turn; some carry a citation."""
    rest = F.col("conv_id") % 3
    return (
        table(spark, sf_dir, "conversations")
        .where(F.col("role") == "assistant")
        .withColumn("attempt", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
        .select(
            "conv_id",
            "turn",
            "attempt",
            F.when(
                (rest < 2) & (F.col("attempt") >= rest), F.concat("text", F.lit(" [1]"))
            )
            .otherwise(F.col("text"))
            .alias("response"),
        )
    )


ATTEMPTS_SQL = """
attempts AS (
  SELECT conv_id, turn, a AS attempt,
         CASE WHEN conv_id % 3 < 2 AND a >= conv_id % 3 THEN concat(text, ' [1]') ELSE text END AS response
  FROM conversations CROSS JOIN (VALUES (0), (1), (2)) v(a) WHERE role = 'assistant'
)"""


def rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector read as an 8 x 8 gray image."""
    byte = lambda v: F.floor(
        (F.greatest(F.least(v.cast("double"), F.lit(1.0)), F.lit(-1.0)) + 1) * 127.5
    ).cast("int")
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("img/"), F.col("vec_id").cast("string"), F.lit(".png")).alias("origin"),
        F.lit(8).alias("height"),
        F.lit(8).alias("width"),
        F.lit(1).alias("nChannels"),
        F.lit(0).alias("mode"),
        F.unhex(
            F.array_join(
                F.transform("embedding", lambda v: F.lpad(F.hex(byte(v)), 2, "0")), ""
            )
        ).alias("data"),
    )


RASTERS_SQL = """
rasters AS (
  SELECT concat('img/', CAST(vec_id AS VARCHAR), '.png') AS origin,
         list_transform(embedding, lambda v:
           CAST(floor((greatest(least(CAST(v AS DOUBLE), 1.0), -1.0) + 1) * 127.5) AS INTEGER)) AS px
  FROM embeddings
)"""
