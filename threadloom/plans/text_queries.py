"""Registered queries: sources, text cleaning, filters."""

from pyspark.sql import functions as F

from threadloom.constants import CONTEXT_CHARS, WORD_BODY
from threadloom.functions import answers, context, text as tx
from threadloom.operators import pairs as pr
from threadloom.operators.chunking import chunk_paragraphs, chunk_recursive
from threadloom.plans.registry import register
from threadloom.plans.views import (
    CLEAN_CTE,
    COMPANIES,
    CONTEXTS_SQL,
    NOISY_SQL,
    PAIRS_CTE,
    TURN_KEYS,
    TWEETS_SQL,
    attempts,
    ATTEMPTS_SQL,
    contexts,
    noisy,
    q,
    sql_contractions,
    sql_emoji,
    sql_re,
    sql_squeeze,
    sql_strip,
    sql_unescape,
    sql_user_prefix,
    table,
    tweets,
)
from threadloom.sources import documents as docs_io, stages
from threadloom.sources.tweets import scan_tweets, write_tweets_csv


# --- sources and stages --------------------------------------------------------
@register("scan_tweets", f"WITH {NOISY_SQL} SELECT * FROM noisy")
def scan_tweets_query(spark, d):
    path = stages.scratch_path(spark, "tweets")
    write_tweets_csv(noisy(spark, d), path)
    return scan_tweets(spark, path)


@register("write_stage", f"WITH {TWEETS_SQL} SELECT * FROM tweets WHERE NOT inbound")
def write_stage_query(spark, d):
    path = stages.scratch_path(spark, "support")
    stages.write_stage(tweets(spark, d).where(~F.col("inbound")), path)
    return spark.read.parquet(path)


@register("stage_or_load", f"WITH {TWEETS_SQL} SELECT * FROM tweets WHERE inbound")
def stage_or_load_query(spark, d):
    path = stages.scratch_path(spark, "customers")
    build = lambda: tweets(spark, d).where(F.col("inbound"))
    stages.stage_or_load(spark, path, build)
    return stages.stage_or_load(spark, path, build)


@register("scan_text_docs", "SELECT item_id, concat(text, chr(10)) AS text FROM benchmark")
def scan_text_docs_query(spark, d):
    path = stages.scratch_path(spark, "manuals")
    table(spark, d, "benchmark").select("item_id", "text").write.partitionBy("item_id").text(path)
    return docs_io.scan_text_docs(spark, path).select(
        F.regexp_extract("source", r"item_id=(\d+)", 1).cast("long").alias("item_id"), "text"
    )


@register("url_registry", f"SELECT DISTINCT {sql_strip('url')} AS url FROM pages")
def url_registry_query(spark, d):
    path = stages.scratch_path(spark, "urls")
    docs_io.save_urls(table(spark, d, "pages"), path)
    return docs_io.load_urls(spark, path)


@register("preview", f"WITH {TWEETS_SQL} SELECT * FROM tweets ORDER BY tweet_id LIMIT 5")
def preview_query(spark, d):
    return stages.preview(tweets(spark, d), ["tweet_id"], 5)


@register(
    "stage_counts",
    f"""WITH {PAIRS_CTE}
    SELECT 'raw' AS stage, count(*) AS rows FROM noisy
    UNION ALL SELECT 'kept', count(*) FROM kept
    UNION ALL SELECT 'pairs', count(*) FROM pairs""",
)
def stage_counts_query(spark, d):
    """Two stages are counted while the second is written, in one pass."""
    path = stages.scratch_path(spark, "kept")
    raw, raw_seen = stages.observe_stage(noisy(spark, d), "raw")
    kept, kept_seen = stages.observe_stage(pr.min_length_filter(pr.clean_tweets(raw), 10), "kept")
    stages.write_stage(kept, path)
    pairs = pr.pair_replies(spark.read.parquet(path))
    return stages.stage_counts(spark, {"raw": raw_seen, "kept": kept_seen, "pairs": pairs})


# --- text cleaning ---------------------------------------------------------------
@register("html_unescape", f"SELECT page_id, {sql_unescape('html')} AS html FROM pages")
def html_unescape_query(spark, d):
    return table(spark, d, "pages").select("page_id", tx.html_unescape(F.col("html")).alias("html"))


def _noisy_text(fn, out="out"):
    return lambda spark, d: noisy(spark, d).select("tweet_id", fn(F.col("text")).alias(out))


def _noisy_sql(expr: str) -> str:
    return f"WITH {NOISY_SQL} SELECT tweet_id, {expr} AS out FROM noisy"


register("emoji_to_tag", _noisy_sql(sql_emoji("text")))(_noisy_text(tx.emoji_to_tag))
register("strip_urls", _noisy_sql(sql_re("text", tx.URL, "")))(_noisy_text(tx.strip_urls))
register(
    "expand_contractions",
    _noisy_sql(f"CASE WHEN text IS NOT NULL THEN {sql_contractions('text')} END"),
)(_noisy_text(tx.expand_contractions))
register("squeeze_ws", _noisy_sql(sql_squeeze("text")))(_noisy_text(tx.squeeze_ws))


@register(
    "mask_mentions",
    f"SELECT doc_id, {sql_re('text', tx.MENTION, '[USER]')} AS out FROM documents",
)
def mask_mentions_query(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.mask_mentions(F.col("text")).alias("out"))


@register(
    "strip_special", f"SELECT doc_id, {sql_re('text', tx.NOT_KEPT, '')} AS out FROM documents"
)
def strip_special_query(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.strip_special(F.col("text")).alias("out"))


@register("clean_text", f"WITH {CLEAN_CTE} SELECT tweet_id, cleaned_text FROM cleaned")
def clean_text_query(spark, d):
    return pr.clean_tweets(noisy(spark, d)).select("tweet_id", "cleaned_text")


@register(
    "strip_user_prefix",
    f"WITH {CLEAN_CTE} SELECT tweet_id, {sql_user_prefix('cleaned_text')} AS out FROM cleaned",
)
def strip_user_prefix_query(spark, d):
    return pr.clean_tweets(noisy(spark, d)).select(
        "tweet_id", tx.strip_user_prefix(F.col("cleaned_text")).alias("out")
    )


@register(
    "dm_flag",
    "SELECT conv_id, turn, regexp_matches(CASE turn % 3 WHEN 0 THEN concat(text, ' Send a DM.') "
    "WHEN 1 THEN concat('dmx ', text) ELSE text END, "
    f"{q(rf'(?i)(?:^|[^{WORD_BODY}])(?:dm|direct message)(?:[^{WORD_BODY}]|$)')}) AS dm FROM conversations",
)
def dm_flag_query(spark, d):
    kind = F.col("turn") % 3
    text = (
        F.when(kind == 0, F.concat("text", F.lit(" Send a DM.")))
        .when(kind == 1, F.concat(F.lit("dmx "), "text"))
        .otherwise(F.col("text"))
    )
    return table(spark, d, "conversations").select("conv_id", "turn", tx.dm_flag(text).alias("dm"))


@register("truncate_text", f"SELECT doc_id, substring(text, 1, {CONTEXT_CHARS}) AS out FROM documents")
def truncate_text_query(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.truncate_text(F.col("text")).alias("out"))


@register(
    "contains_keyword",
    "SELECT doc_id, contains(lower(text), 'policy') OR contains(lower(text), 'the ') AS hit FROM documents",
)
def contains_keyword_query(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", tx.contains_keyword(F.col("text"), ["policy", "the "]).alias("hit")
    )


@register(
    "apply_edits",
    """SELECT conv_id, turn, CASE WHEN length(text) > 1000 THEN text ELSE
       concat('<', substring(text, 2, 2), 'yy', substring(text, 5, 4), '', substring(text, 12)) END AS out
       FROM conversations""",
)
def apply_edits_query(spark, d):
    """Edits table joined by id: replace one char twice, drop three, skip one."""
    turns = table(spark, d, "conversations")
    edit = lambda at, n, v: F.struct(
        F.lit(at).alias("start"), F.lit(n).alias("length"), F.lit(v).cast("string").alias("value")
    )
    edits = turns.select(
        "conv_id",
        "turn",
        F.explode(F.array(edit(0, 1, "<"), edit(6, 1, None), edit(3, 1, "yy"), edit(8, 3, ""))).alias("e"),
    )
    grouped = edits.groupBy("conv_id", "turn").agg(F.collect_list("e").alias("edits"))
    return turns.join(grouped, ["conv_id", "turn"], "left").select(
        "conv_id",
        "turn",
        F.when(F.col("edits").isNull(), F.col("text"))
        .otherwise(tx.apply_edits(F.col("text"), F.col("edits")))
        .alias("out"),
    )


# --- filters -----------------------------------------------------------------------
@register(
    "min_length_filter",
    f"WITH {CLEAN_CTE} SELECT tweet_id, cleaned_text FROM cleaned WHERE length(cleaned_text) > 10",
)
def min_length_filter_query(spark, d):
    return pr.min_length_filter(clean_text_query(spark, d), 10)


@register(
    "inbound_split",
    f"""WITH {TWEETS_SQL} SELECT tweet_id, author_id, 'customer' AS side FROM tweets WHERE inbound
        UNION ALL SELECT tweet_id, author_id, 'company' FROM tweets WHERE NOT inbound""",
)
def inbound_split_query(spark, d):
    asked, answered = pr.inbound_split(tweets(spark, d))
    tag = lambda df, s: df.select("tweet_id", "author_id", F.lit(s).alias("side"))
    return tag(asked, "customer").unionByName(tag(answered, "company"))


_LISTED = ", ".join(q(c) for c in COMPANIES)


@register(
    "company_filter",
    f"WITH {PAIRS_CTE} SELECT tweet_id, reply_id, company FROM pairs WHERE company IN ({_LISTED})",
)
def company_filter_query(spark, d):
    return pr.company_filter(training_pairs(spark, d), COMPANIES).select("tweet_id", "reply_id", "company")


@register(
    "semi_company",
    f"""WITH {PAIRS_CTE} SELECT tweet_id, reply_id, company FROM pairs
        WHERE company IN (SELECT author_id FROM tweets WHERE NOT inbound AND length(text) > 1500)""",
)
def semi_company_query(spark, d):
    wordy = (
        tweets(spark, d)
        .where(~F.col("inbound") & (F.length("text") > 1500))
        .select(F.col("author_id").alias("company"))
    )
    return pr.semi_company(training_pairs(spark, d), wordy).select("tweet_id", "reply_id", "company")


# --- pairing -------------------------------------------------------------------------
def training_pairs(spark, d, keep_ids: bool = True):
    """Cleaned, length-filtered and paired messages."""
    kept = pr.min_length_filter(pr.clean_tweets(noisy(spark, d)), 10)
    return pr.pair_replies(kept, keep_ids=keep_ids)


@register(
    "pair_replies",
    f"""WITH {TWEETS_SQL}
    SELECT c.text AS input, r.text AS response, TRUE AS customer_input, r.author_id AS company
    FROM tweets c JOIN tweets r ON r.in_response_to_tweet_id = c.tweet_id
    WHERE c.inbound AND NOT r.inbound""",
)
def pair_replies_query(spark, d):
    return pr.pair_replies(tweets(spark, d), "text")


@register(
    "training_rows",
    f"""WITH {PAIRS_CTE}
    SELECT concat('Customer: ', {sql_user_prefix("input")}, chr(10), 'Support:') AS input_text,
           {sql_user_prefix("response")} AS target_text, company
    FROM pairs""",
)
def training_rows_query(spark, d):
    """The flagship: training rows from raw noisy messages."""
    return pr.format_plain(training_pairs(spark, d, keep_ids=False))


@register("company_ids", f"WITH {TWEETS_SQL} SELECT DISTINCT author_id FROM tweets WHERE NOT inbound")
def company_ids_query(spark, d):
    return pr.company_ids(tweets(spark, d))


@register(
    "top_active_authors",
    f"""WITH {TWEETS_SQL} SELECT author_id, count(*) AS messages FROM tweets
        GROUP BY author_id ORDER BY messages DESC, author_id LIMIT 20""",
)
def top_active_authors_query(spark, d):
    return pr.top_active_authors(tweets(spark, d))


# --- chunking ------------------------------------------------------------------------
@register(
    "chunk_paragraphs",
    f"""WITH pieces AS (
      SELECT doc_id, list_filter(list_transform(string_split(replace(text, chr(10), concat(chr(10), chr(10))),
        concat(chr(10), chr(10))), lambda p: {sql_strip("p")}), lambda p: length(p) > 40) AS ps
      FROM documents)
    SELECT doc_id, CAST(i - 1 AS INTEGER) AS chunk_idx, ps[i] AS text
    FROM (SELECT doc_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM pieces)""",
)
def chunk_paragraphs_query(spark, d):
    spaced = table(spark, d, "documents").withColumn("text", F.replace("text", F.lit("\n"), F.lit("\n\n")))
    return chunk_paragraphs(spaced, ["doc_id"])


@register("chunk_recursive")
def chunk_recursive_query(spark, d):
    return chunk_recursive(table(spark, d, "documents"), ["doc_id", "source"])


# A text that fits one chunk is that chunk; of longer ones no word may be lost, no chunk may be too
# long and every chunk must stand in the text.
@register(
    "chunk_recursive_checks",
    f"""SELECT doc_id, TRUE AS short_enough, TRUE AS from_text, TRUE AS no_word_lost,
      CASE WHEN length(text) <= 1000 AND {sql_strip("text")} <> '' THEN md5({sql_strip("text")}) END AS only_chunk
      FROM documents""",
)
def chunk_recursive_checks_query(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    chunks = chunk_recursive(docs, ["doc_id"]).groupBy("doc_id").agg(F.collect_list("text").alias("chunks"))
    found = F.coalesce("chunks", F.array().cast("array<string>"))
    text = F.coalesce("text", F.lit(""))
    # A full stop before a blank may open the next chunk instead of ending its word.
    words = lambda t: F.filter(F.split(t, "[.]?[ \n]+|[.]$"), lambda w: ~w.isin("", "."))
    lost = F.array_except(words(text), F.flatten(F.transform(found, words)))
    alone = (F.length("text") <= 1000) & (F.size(found) == 1)
    return docs.join(chunks, "doc_id", "left").select(
        "doc_id",
        F.forall(found, lambda c: F.length(c) <= 1000).alias("short_enough"),
        F.forall(found, lambda c: F.contains(text, c)).alias("from_text"),
        (F.size(lost) == 0).alias("no_word_lost"),
        F.when(alone, F.md5(F.get(found, F.lit(0)))).alias("only_chunk"),
    )


# --- answer cleaning --------------------------------------------------------------------
_DIRTY = """CASE conv_id % 6
  WHEN 0 THEN concat('[user] ', text, ' -EmmaW')
  WHEN 1 THEN concat(text, ' ABC DEF GHI stop. Yes it is. And this one stays here! tail')
  WHEN 2 THEN concat('sooooooooo ', text, ' !!!!!!!')
  WHEN 3 THEN 'ok'
  WHEN 4 THEN NULL
  ELSE text END"""


def dirty_answers(spark, d):
    kind = F.col("conv_id") % 6
    text = F.col("text")
    return table(spark, d, "conversations").select(
        (F.col("conv_id") * TURN_KEYS + F.col("turn")).alias("answer_id"),
        F.when(kind == 0, F.concat(F.lit("[user] "), text, F.lit(" -EmmaW")))
        .when(kind == 1, F.concat(text, F.lit(" ABC DEF GHI stop. Yes it is. And this one stays here! tail")))
        .when(kind == 2, F.concat(F.lit("sooooooooo "), text, F.lit(" !!!!!!!")))
        .when(kind == 3, F.lit("ok"))
        .when(kind == 4, F.lit(None))
        .otherwise(text)
        .alias("text"),
    )


DIRTY_SQL = f"dirty AS (SELECT conv_id * 4294967296 + turn AS answer_id, {_DIRTY} AS text FROM conversations)"
_TAGLESS = sql_re("coalesce(text, '')", r"(?i)\[USER\]", "")


def sql_clean_v1(source: str) -> str:
    return f"""
bare AS (SELECT * EXCLUDE (text), {sql_re(sql_re(sql_strip(_TAGLESS), answers.SIGNATURE, ""),
    r"\b(?:[A-Z]{3,}" + answers.WS + r"+)+[A-Z]{3,}\b", "")} AS b FROM {source}),
sentences AS (SELECT *, list_filter(list_transform(regexp_extract_all(b, {q(answers.SENTENCE)}),
    lambda s: {sql_strip("s")}), lambda s: len(string_split({sql_squeeze("s")}, ' ')) > 3) AS ss FROM bare),
clean_v1 AS (SELECT * EXCLUDE (b, ss), {sql_squeeze(
    "CASE WHEN regexp_matches(b, '[.!?]') THEN array_to_string(ss, ' ') ELSE b END")} AS tidy FROM sentences)"""


@register(
    "clean_response_v1",
    f"""WITH {DIRTY_SQL}, {sql_clean_v1("dirty")}
    SELECT answer_id, CASE WHEN tidy <> '' THEN tidy ELSE {q(answers.ANSWER_TROUBLE)} END AS answer FROM clean_v1""",
)
def clean_response_v1_query(spark, d):
    return dirty_answers(spark, d).select(
        "answer_id", answers.clean_response_v1(F.col("text")).alias("answer")
    )


def sql_collapse(t: str) -> str:
    """Runs in these tables only ever repeat one of the listed characters."""
    for c in "o!-= .*#":
        t = sql_re(t, "[" + ("\\" if c in "-" else "") + c + "]{7,}", c)
    return t


@register(
    "collapse_repeats",
    f"WITH {DIRTY_SQL} SELECT answer_id, {sql_collapse('text')} AS out FROM dirty",
)
def collapse_repeats_query(spark, d):
    return dirty_answers(spark, d).select(
        "answer_id", answers.collapse_repeats(F.col("text")).alias("out")
    )


@register(
    "fix_mojibake",
    "SELECT doc_id, concat(text, ' café — it’s 😀 ok') AS out FROM documents",
)
def fix_mojibake_query(spark, d):
    broken = F.concat("text", F.lit(" cafÃ© â€” itâ€™s 😀 ok"))
    return table(spark, d, "documents").select("doc_id", answers.fix_mojibake(broken).alias("out"))


@register(
    "has_citation",
    f"WITH {ATTEMPTS_SQL} SELECT conv_id, turn, attempt, regexp_matches(response, {q(context.CITATION)}) AS cited FROM attempts",
)
def has_citation_query(spark, d):
    return attempts(spark, d).select(
        "conv_id", "turn", "attempt", context.has_citation(F.col("response")).alias("cited")
    )


@register(
    "meaningful_context_len",
    f"""WITH {CONTEXTS_SQL} SELECT conv_id,
        len(list_filter(contexts, lambda c: length({sql_strip("c")}) > 500)) > 0 AS meaningful FROM contexts""",
)
def meaningful_context_len_query(spark, d):
    return contexts(spark, d).select(
        "conv_id", context.meaningful_context_len(F.col("contexts"), 500).alias("meaningful")
    )


@register(
    "topn_contexts",
    f"WITH {CONTEXTS_SQL} SELECT conv_id, array_to_string(contexts[1:2], '|') AS heads FROM contexts",
)
def topn_contexts_query(spark, d):
    return contexts(spark, d).select(
        "conv_id", F.array_join(context.topn_contexts(F.col("contexts"), 2), "|").alias("heads")
    )
