"""Registered queries: sampling, aggregates, word tables, language, token arrays."""

from pyspark.sql import functions as F

from threadloom.constants import MAX_TOKENS
from threadloom.functions.training import encode_examples
from threadloom.functions.context import plain_prompt
from threadloom.functions.text import frequency_words
from threadloom.operators import language, ranking, sampling, scoring, vocab
from threadloom.plans.registry import register
from threadloom.plans.text_queries import training_pairs
from threadloom.sources import stages
from threadloom.plans.views import (
    COMPANIES,
    PAIRS_CTE,
    SEED,
    TURN_KEYS,
    TWEETS_SQL,
    q,
    table,
    tokens_sql,
    tweets,
)

_HASH = f"md5(concat(CAST({{id}} AS VARCHAR), ':{SEED}'))"
_TWEET_HASH = _HASH.format(id="tweet_id")


# --- sampling ------------------------------------------------------------------
@register(
    "sample_n",
    f"WITH {TWEETS_SQL} SELECT * FROM tweets ORDER BY {_TWEET_HASH}, tweet_id LIMIT 200",
)
def sample_n_query(spark, d):
    return sampling.sample_n(tweets(spark, d), 200, SEED, "tweet_id")


@register(
    "shuffle_rows",
    f"""WITH {TWEETS_SQL} SELECT tweet_id, author_id,
        row_number() OVER (ORDER BY {_TWEET_HASH}, tweet_id) - 1 AS shuffle_idx FROM tweets""",
)
def shuffle_rows_query(spark, d):
    return sampling.shuffle_rows(tweets(spark, d), SEED, "tweet_id").select(
        "tweet_id", "author_id", "shuffle_idx"
    )


@register(
    "train_val_split",
    f"""WITH {TWEETS_SQL} SELECT tweet_id, CASE WHEN row_number() OVER (ORDER BY {_TWEET_HASH}, tweet_id)
        <= (count(*) OVER () + 4) // 5 THEN 'val' ELSE 'train' END AS split FROM tweets""",
)
def train_val_split_query(spark, d):
    return sampling.train_val_split(tweets(spark, d), SEED, "tweet_id").select("tweet_id", "split")


@register(
    "hash_split",
    f"""SELECT doc_id, CASE WHEN CAST(concat('0x', substring({_HASH.format(id="doc_id")}, 1, 8)) AS BIGINT)
        < {int(0.2 * (1 << 32))} THEN 'val' ELSE 'train' END AS split FROM documents""",
)
def hash_split_query(spark, d):
    return sampling.hash_split(table(spark, d, "documents"), SEED, "doc_id").select("doc_id", "split")


_LISTED = ", ".join(q(c) for c in COMPANIES)
_TOTAL = 160
_QUOTA_SQL = f"""WITH {PAIRS_CTE},
ranked AS (
  SELECT reply_id, company, row_number() OVER (PARTITION BY company
         ORDER BY {_HASH.format(id="reply_id")}, reply_id) AS rn
  FROM pairs WHERE company IN ({_LISTED})),
taken AS (SELECT reply_id, company FROM ranked WHERE rn <= {_TOTAL // len(COMPANIES)}),
extra AS (
  SELECT reply_id, company FROM (
    SELECT *, row_number() OVER (ORDER BY md5(concat(CAST(reply_id AS VARCHAR), ':{SEED}:extra')), reply_id) AS en
    FROM ranked WHERE rn > {_TOTAL // len(COMPANIES)})
  WHERE en <= {_TOTAL} - (SELECT count(*) FROM taken)),
both_parts AS (SELECT * FROM taken UNION ALL SELECT * FROM extra)
SELECT reply_id, company, row_number() OVER (
  ORDER BY md5(concat(CAST(reply_id AS VARCHAR), ':{SEED}:shuffle')), reply_id) - 1 AS sample_idx
FROM both_parts"""


@register("stratified_quota_sample", _QUOTA_SQL)
def stratified_quota_sample_query(spark, d):
    path = stages.scratch_path(spark, "pairs")
    pairs = stages.stage_or_load(spark, path, lambda: training_pairs(spark, d))
    return sampling.stratified_quota_sample(
        pairs.select("reply_id", "company"), "company", COMPANIES, _TOTAL, SEED, "reply_id"
    )


@register(
    "stratum_counts",
    f"""WITH {TWEETS_SQL}, wanted AS (SELECT unnest([{_LISTED}]) AS author_id)
    SELECT author_id, count(tweet_id) AS rows FROM wanted LEFT JOIN tweets USING (author_id) GROUP BY author_id""",
)
def stratum_counts_query(spark, d):
    return sampling.stratum_counts(tweets(spark, d), "author_id", COMPANIES)


@register(
    "unused_rows",
    f"""WITH {TWEETS_SQL} SELECT tweet_id, author_id FROM (SELECT *, row_number() OVER (
        ORDER BY {_TWEET_HASH}, tweet_id) AS rn FROM tweets) WHERE rn > 200""",
)
def unused_rows_query(spark, d):
    rows = tweets(spark, d)
    used = sampling.sample_n(rows, 200, SEED, "tweet_id")
    return sampling.unused_rows(rows, used, "tweet_id").select("tweet_id", "author_id")


@register(
    "concat_samples",
    f"""WITH {TWEETS_SQL} SELECT tweet_id, author_id FROM (SELECT *, row_number() OVER (
        PARTITION BY author_id ORDER BY {_TWEET_HASH}, tweet_id) AS rn FROM tweets
        WHERE author_id IN ({_LISTED})) WHERE rn <= 10""",
)
def concat_samples_query(spark, d):
    rows = tweets(spark, d)
    parts = [
        sampling.sample_n(rows.where(F.col("author_id") == c), 10, SEED, "tweet_id")
        for c in COMPANIES
    ]
    return sampling.concat_samples(parts).select("tweet_id", "author_id")


@register(
    "topk_per_query",
    f"""WITH {TWEETS_SQL} SELECT author_id, tweet_id, rank FROM (SELECT *, row_number() OVER (
        PARTITION BY author_id ORDER BY length(text) DESC, tweet_id) AS rank FROM tweets) WHERE rank <= 3""",
)
def topk_per_query_query(spark, d):
    longest = [F.length("text").desc(), F.col("tweet_id").asc()]
    return ranking.topk_per_group(tweets(spark, d), ["author_id"], longest, 3).select(
        "author_id", "tweet_id", "rank"
    )


# --- word tables -----------------------------------------------------------------
_WORDS_SQL = """words AS (
  SELECT word, count(*) AS n FROM (
    SELECT unnest(regexp_extract_all(lower(text), '[A-Za-z'']{3,}')) AS word FROM documents)
  GROUP BY word),
frequencies AS (
  SELECT word, n, log10(n / (SELECT sum(n) FROM words) * 1e9) AS zipf FROM words)"""


@register("word_frequency", f"WITH {_WORDS_SQL} SELECT word, n, round(zipf, 6) AS zipf FROM frequencies")
def word_frequency_query(spark, d):
    return scoring.word_frequency(table(spark, d, "documents")).withColumn(
        "zipf", F.round("zipf", 6)
    )


def gibberish_sql(source: str, id_col: str, min_zipf: float) -> str:
    """CTEs ``judged(id, n_tokens, n_words, n_common, verdict)`` over ``source(id, text)``."""
    return rf"""{_WORDS_SQL},
split_words AS (
  SELECT {id_col}, len(list_filter(string_split_regex(text, '[\s\x0B\x1c-\x1f\x{{85}}\p{{Z}}]+'), lambda t: length(t) > 0)) AS n_tokens,
         regexp_extract_all(lower(text), '[A-Za-z'']{{3,}}') AS ws FROM {source}),
counted AS (
  SELECT {id_col}, n_tokens, len(ws) AS n_words, coalesce(n_common, 0) AS n_common FROM split_words
  LEFT JOIN (SELECT {id_col}, count(*) AS n_common FROM
      (SELECT {id_col}, unnest(ws) AS word FROM split_words) JOIN frequencies USING (word)
      WHERE zipf >= {min_zipf} GROUP BY {id_col}) USING ({id_col})),
judged AS (
  SELECT *, CASE WHEN n_tokens < 3 THEN 'short' WHEN n_words = 0 THEN 'no_words'
         WHEN n_common * 2 < n_words THEN 'rare' ELSE 'ok' END AS verdict FROM counted)"""


@register(
    "gibberish_gate",
    f"""WITH items AS (SELECT conv_id * 4294967296 + turn AS item, text FROM conversations),
    {gibberish_sql("items", "item", 5.0)}
    SELECT item, n_words, CAST(n_common AS BIGINT) AS n_common, verdict FROM judged""",
)
def gibberish_gate_query(spark, d):
    items = table(spark, d, "conversations").select(
        (F.col("conv_id") * TURN_KEYS + F.col("turn")).alias("item"), "text"
    )
    frequencies = scoring.word_frequency(table(spark, d, "documents"))
    return scoring.gibberish_gate(items, frequencies, "item", min_zipf=5.0).select(
        "item", "n_words", "n_common", "verdict"
    )


_LEXICON_SQL = f"""lexicon AS (
  SELECT word, CASE WHEN substring(md5(word), 1, 1) IN ('0', '1', '2', '3', '4') THEN -0.5
                    WHEN substring(md5(word), 1, 1) BETWEEN '5' AND '9' OR substring(md5(word), 1, 1) = 'a' THEN 0.0
                    ELSE 0.5 END AS polarity
  FROM (SELECT unnest({tokens_sql("text")}) AS word FROM documents) GROUP BY word HAVING count(*) >= 50)"""


def lexicon(spark, d):
    """Frequent document words with a polarity fixed by their hash."""
    digit = F.substring(F.md5("word"), 1, 1)
    return (
        table(spark, d, "documents")
        .select(F.explode(scoring.tokens(F.col("text"))).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= 50)
        .select(
            "word",
            F.when(digit.isin("0", "1", "2", "3", "4"), -0.5)
            .when(digit.between("5", "9") | (digit == "a"), 0.0)
            .otherwise(0.5)
            .alias("polarity"),
        )
    )


@register(
    "sentiment",
    f"""WITH {_LEXICON_SQL},
    positioned AS (
      SELECT conv_id * 4294967296 + turn AS item, unnest(range(1, len(ws) + 1)) AS i, ws
      FROM (SELECT conv_id, turn, {tokens_sql("text")} AS ws FROM conversations)),
    hits AS (
      SELECT item, polarity * CASE WHEN i > 1 AND ws[i - 1] IN ('in', 'der', 'la', 'not') THEN -0.5 ELSE 1.0 END AS p
      FROM positioned JOIN lexicon ON lexicon.word = ws[i])
    SELECT conv_id * 4294967296 + turn AS item, round(coalesce(avg(p), 0.0), 6) AS sentiment
    FROM conversations LEFT JOIN hits ON hits.item = conv_id * 4294967296 + turn GROUP BY 1""",
)
def sentiment_query(spark, d):
    items = table(spark, d, "conversations").select(
        (F.col("conv_id") * TURN_KEYS + F.col("turn")).alias("item"), "text"
    )
    words = stages.cut_lineage(lexicon(spark, d))
    scored = scoring.sentiment(items, words, "item", negators=("in", "der", "la", "not"))
    return scored.withColumn("sentiment", F.round("sentiment", 6))


@register(
    "perplexity",
    f"""WITH {_WORDS_SQL}, per_lang AS (
      SELECT lang, word, count(*) AS n FROM (
        SELECT lang, unnest(regexp_extract_all(lower(text), '[A-Za-z'']{{3,}}')) AS word FROM documents)
      GROUP BY lang, word),
    losses AS (SELECT lang, sum(p.n * -ln(w.n / (SELECT sum(n) FROM words))) / sum(p.n) AS loss
      FROM per_lang p JOIN words w USING (word) GROUP BY lang)
    SELECT lang, round(loss, 6) AS eval_loss,
           round(CASE WHEN loss < 100 THEN exp(loss) ELSE CAST('inf' AS DOUBLE) END, 5) AS perplexity FROM losses""",
)
def perplexity_query(spark, d):
    """Unigram perplexity per language under the pooled word distribution."""
    docs = table(spark, d, "documents")
    words = scoring.word_frequency(docs)
    share = F.col("w.n") / words.agg(F.sum("n")).scalar()
    per_lang = (
        docs.select("lang", F.explode(frequency_words(F.col("text"))).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    losses = per_lang.alias("p").join(words.alias("w"), "word").select(
        "lang", F.col("p.n").alias("n"), (-F.ln(share)).alias("nll")
    )
    return scoring.perplexity(losses, ["lang"], weight="n").select(
        "lang",
        F.round("eval_loss", 6).alias("eval_loss"),
        F.round("perplexity", 5).alias("perplexity"),
    )


# --- language ------------------------------------------------------------------------
LANGUAGE_SQL = """grams AS (
  SELECT doc_id, lang, concat(cs[i], cs[i + 1], cs[i + 2]) AS gram
  FROM (SELECT doc_id, lang, cs, unnest(range(1, len(cs) - 1)) AS i
        FROM (SELECT doc_id, lang, string_split(lower(text), '') AS cs FROM documents))),
doc_grams AS (SELECT doc_id, gram, count(*) AS n FROM grams GROUP BY ALL),
lang_grams AS (SELECT lang, gram, count(*) AS n FROM grams GROUP BY ALL),
lang_totals AS (SELECT lang, sum(n) AS total FROM lang_grams GROUP BY lang),
profile AS (
  SELECT v.gram, t.lang, ln((coalesce(g.n, 0) + 1) / CAST(t.total + (SELECT count(DISTINCT gram) FROM grams) AS DOUBLE)) AS lp
  FROM (SELECT DISTINCT gram FROM lang_grams) v CROSS JOIN lang_totals t
  LEFT JOIN lang_grams g ON g.gram = v.gram AND g.lang = t.lang),
scores AS (SELECT doc_id, lang, round(sum(n * lp), 6) AS score FROM doc_grams JOIN profile USING (gram) GROUP BY ALL),
labelled AS (SELECT doc_id, arg_max(lang, (score, lang)) AS language FROM scores GROUP BY doc_id)"""


def detected_languages(spark, d):
    docs = table(spark, d, "documents")
    return language.fit_language_profiles(docs).predict(docs, "doc_id")


@register(
    "language_id",
    f"WITH {LANGUAGE_SQL} SELECT doc_id, language FROM documents LEFT JOIN labelled USING (doc_id)",
)
def language_id_query(spark, d):
    return detected_languages(spark, d)


@register(
    "english_filter",
    f"WITH {LANGUAGE_SQL} SELECT doc_id, text FROM documents JOIN labelled USING (doc_id) WHERE language = 'en'",
)
def english_filter_query(spark, d):
    docs = table(spark, d, "documents")
    return language.english_filter(docs.select("doc_id", "text"), language.fit_language_profiles(docs))


# --- vocabulary and arrays ----------------------------------------------------------------
VOCAB_SQL = f"""vocab AS (
  SELECT token, n, CAST(row_number() OVER (ORDER BY n DESC, token) + 2 AS INTEGER) AS token_id
  FROM (SELECT token, count(*) AS n FROM (SELECT unnest({tokens_sql("text")}) AS token FROM documents) GROUP BY token))"""


@register("build_vocab", f"WITH {VOCAB_SQL} SELECT token, n, token_id FROM vocab")
def build_vocab_query(spark, d):
    return vocab.build_vocab(table(spark, d, "documents")).select("token", "n", "token_id")


@register(
    "tokenize_ids",
    f"""WITH {VOCAB_SQL}, placed AS (
      SELECT conv_id * 4294967296 + turn AS item, ws[i] AS token, i FROM (
        SELECT conv_id, turn, ws, unnest(range(1, len(ws) + 1)) AS i
        FROM (SELECT conv_id, turn, {tokens_sql("text")} AS ws FROM conversations)))
    SELECT item, string_agg(CAST(coalesce(token_id, 2) AS VARCHAR), ' ' ORDER BY i) AS ids
    FROM placed LEFT JOIN vocab USING (token) GROUP BY item""",
)
def tokenize_ids_query(spark, d):
    items = table(spark, d, "conversations").select(
        (F.col("conv_id") * TURN_KEYS + F.col("turn")).alias("item"), "text"
    )
    words = vocab.build_vocab(table(spark, d, "documents"))
    return vocab.tokenize_ids(items, words, "item").select(
        "item", F.array_join("ids", " ").alias("ids")
    )


@register(
    "encode_examples",
    f"""WITH {TWEETS_SQL}, {VOCAB_SQL},
    pairs AS (SELECT r.tweet_id AS reply_id, concat('Customer: ', c.text, chr(10), 'Support:') AS input_text, r.text AS target_text
      FROM tweets c JOIN tweets r ON r.in_response_to_tweet_id = c.tweet_id WHERE c.inbound AND NOT r.inbound),
    texts AS (SELECT reply_id, 'i' AS part, {tokens_sql("input_text")} AS ws FROM pairs
      UNION ALL SELECT reply_id, 't', {tokens_sql("target_text")} FROM pairs),
    coded AS (SELECT reply_id, part, list(coalesce(token_id, 2) ORDER BY i) AS ids FROM (
        SELECT reply_id, part, ws[i] AS token, i FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM texts))
      LEFT JOIN vocab USING (token) GROUP BY reply_id, part),
    cut AS (SELECT reply_id, coalesce(a.ids, [])[1:512] AS src,
        list_append(coalesce(b.ids, []), 1)[1:512 - len(coalesce(a.ids, [])[1:512])] AS tgt
      FROM pairs LEFT JOIN (SELECT * FROM coded WHERE part = 'i') a USING (reply_id)
                 LEFT JOIN (SELECT * FROM coded WHERE part = 't') b USING (reply_id)),
    sized AS (SELECT *, 512 - len(src) - len(tgt) AS rest FROM cut)
    SELECT reply_id,
      array_to_string(list_concat(src, tgt, list_transform(range(rest), lambda x: 1)), ' ') AS input_ids,
      array_to_string(list_concat(list_transform(range(512 - rest), lambda x: 1), list_transform(range(rest), lambda x: 0)), ' ') AS attention_mask,
      array_to_string(list_concat(list_transform(range(len(src)), lambda x: -100), tgt, list_transform(range(rest), lambda x: -100)), ' ') AS labels
    FROM sized""",
)
def encode_examples_query(spark, d):
    from threadloom.operators.pairs import pair_replies

    pairs = pair_replies(tweets(spark, d), "text", keep_ids=True)
    words = vocab.build_vocab(table(spark, d, "documents"))
    # Both texts of a pair are looked up in one pass, keyed by pair and part.
    parts = pairs.select(
        F.explode(
            F.array(
                F.struct(
                    F.struct("reply_id", F.lit("i").alias("part")).alias("key"),
                    plain_prompt(F.col("input")).alias("text"),
                ),
                F.struct(
                    F.struct("reply_id", F.lit("t").alias("part")).alias("key"),
                    F.col("response").alias("text"),
                ),
            )
        ).alias("x")
    ).select("x.key", "x.text")
    ids = vocab.tokenize_ids(parts, words, "key", max_ids=MAX_TOKENS)
    sides = ids.groupBy("key.reply_id").agg(
        F.max_by("ids", F.when(F.col("key.part") == "i", 1)).alias("src"),
        F.max_by("ids", F.when(F.col("key.part") == "t", 1)).alias("tgt"),
    )
    encoded = sides.select(
        "reply_id", encode_examples(F.col("src"), F.col("tgt"), vocab.EOS_ID).alias("e")
    )
    return encoded.select(
        "reply_id",
        *[F.array_join(f"e.{c}", " ").alias(c) for c in ("input_ids", "attention_mask", "labels")],
    )
