"""Registered queries: knowledge base, similarity search, retrieved training rows."""

from pyspark.sql import functions as F

from threadloom.functions.vectors import cosine_similarity
from threadloom.operators import retrieval as rt
from threadloom.operators import knowledge
from threadloom.operators.chunking import chunk_paragraphs
from threadloom.operators.embedding import HashedEmbedder, embed_tfidf
from threadloom.plans.registry import register
from threadloom.plans.text_queries import training_pairs
from threadloom.plans.views import (
    KB_SQL,
    TURN_KEYS,
    MESSAGES_SQL,
    PAIRS_CTE,
    kb,
    messages,
    sql_strip,
    sql_user_prefix,
    table,
    tokens_sql,
    vectors_of,
)
from threadloom.constants import WORD
from threadloom.sources import kb as kb_io, stages


def sql_cosine(a: str, b: str) -> str:
    return f"round(list_cosine_similarity(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[])), 12)"


def sql_ranked(queries: str, query_id: str, chunks: str, chunk_id: str, name: str = "ranked") -> str:
    return f"""{name} AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS INTEGER) AS rank FROM (
    SELECT a.{query_id} AS query_id, b.{chunk_id} AS chunk_id, {sql_cosine("a.embedding", "b.embedding")} AS score
    FROM {queries} a CROSS JOIN {chunks} b))"""


_KB_RANKED = f"{KB_SQL}, {MESSAGES_SQL}, {sql_ranked('messages', 'query_id', 'kb', 'chunk_id')}"


# --- tables ---------------------------------------------------------------------
@register(
    "kb_load",
    f"""WITH {KB_SQL} SELECT source, chunk_idx, length(text) AS n_chars,
        round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS vector_sum FROM kb""",
)
def kb_load_query(spark, d):
    path = stages.scratch_path(spark, "kb")
    kb_io.kb_write(kb(spark, d), path)
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return kb_io.kb_load(spark, path).select(
        "source", "chunk_idx", F.length("text").alias("n_chars"), F.round(total, 6).alias("vector_sum")
    )


@register("kb_write", f"WITH {KB_SQL} SELECT source, chunk_idx, text FROM kb")
def kb_write_query(spark, d):
    path = stages.scratch_path(spark, "kb")
    kb_io.kb_write(kb(spark, d), path)
    return spark.read.parquet(path).select("source", "chunk_idx", "text")


@register("kb_count", f"WITH {KB_SQL} SELECT count(*) AS vectors FROM kb")
def kb_count_query(spark, d):
    return kb_io.kb_count(kb(spark, d))


def first_vector(spark, d):
    """The query vector: the one with the lowest id (a single row)."""
    return table(spark, d, "embeddings").agg(F.min_by("embedding", "vec_id")).first()[0]


@register(
    "kb_dump",
    f"""WITH {KB_SQL}, scored AS (SELECT *, {sql_cosine("embedding", "(SELECT arg_min(embedding, vec_id) FROM embeddings)")} AS score FROM kb),
    ranked AS (SELECT row_number() OVER (ORDER BY score DESC, source, chunk_idx) AS rank, source, text FROM scored)
    SELECT rank, concat('[', CAST(rank AS VARCHAR), '] Source: ', coalesce(source, 'unknown'), chr(10), text, chr(10), chr(10)) AS block
    FROM ranked""",
)
def kb_dump_query(spark, d):
    return kb_io.kb_dump(kb(spark, d), first_vector(spark, d), k=None)


# --- similarity -------------------------------------------------------------------
@register(
    "cosine_similarity",
    f"""SELECT a.vec_id, round({sql_cosine("a.embedding", "b.embedding")}, 6) AS similarity
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def cosine_similarity_query(spark, d):
    left = table(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("a"))
    right = table(spark, d, "embeddings").select(
        (F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b")
    )
    return left.join(right, "vec_id").select(
        "vec_id", F.round(cosine_similarity(F.col("a"), F.col("b")), 6).alias("similarity")
    )


@register(
    "knn_join",
    f"""WITH {sql_ranked("embeddings", "vec_id", "embeddings", "vec_id")}
    SELECT query_id, chunk_id, rank, round(score, 6) AS score FROM ranked WHERE rank <= 3""",
)
def knn_join_query(spark, d):
    vectors = table(spark, d, "embeddings")
    return rt.knn_join(vectors, vectors, 3, query_id="vec_id", chunk_id="vec_id").withColumn(
        "score", F.round("score", 6)
    )


@register(
    "retrieve_topk",
    f"""WITH {_KB_RANKED} SELECT query_id, rank, chunk_id, round(score, 6) AS score, text
    FROM ranked JOIN kb USING (chunk_id) WHERE rank <= 3""",
)
def retrieve_topk_query(spark, d):
    return rt.retrieve_topk(messages(spark, d), kb(spark, d), 3).withColumn(
        "score", F.round("score", 6)
    )


@register(
    "max_similarity",
    f"WITH {_KB_RANKED} SELECT query_id, round(max(score), 6) AS max_similarity FROM ranked GROUP BY query_id",
)
def max_similarity_query(spark, d):
    ranked = rt.knn_join(messages(spark, d), kb(spark, d), 3)
    return rt.max_similarity(ranked).withColumn("max_similarity", F.round("max_similarity", 6))


@register(
    "retrieve_fallback",
    f"""WITH {KB_SQL}, asked AS (SELECT doc_id, embedding FROM documents JOIN embeddings ON doc_id = vec_id),
    {sql_ranked("asked", "doc_id", "kb", "chunk_id")},
    stock AS (SELECT rank, chunk_id, score FROM ranked WHERE rank <= 3 AND query_id = (SELECT min(vec_id) FROM embeddings)),
    found AS (SELECT query_id, rank, chunk_id, score FROM ranked WHERE rank <= 3
      UNION ALL SELECT doc_id, rank, chunk_id, score FROM documents CROSS JOIN stock
      WHERE doc_id NOT IN (SELECT query_id FROM ranked))
    SELECT query_id, rank, chunk_id, round(score, 6) AS score, text FROM found JOIN kb USING (chunk_id)""",
)
def retrieve_fallback_query(spark, d):
    vectors = table(spark, d, "embeddings")
    base = kb(spark, d)
    asked = (
        table(spark, d, "documents")
        .select(F.col("doc_id").alias("query_id"))
        .join(vectors.select(F.col("vec_id").alias("query_id"), "embedding"), "query_id", "left")
    )
    ranked = rt.retrieve_topk(asked, base, 3)
    default = rt.retrieve_topk(
        vectors.agg(
            F.min("vec_id").alias("query_id"), F.min_by("embedding", "vec_id").alias("embedding")
        ),
        base,
        3,
    )
    return rt.retrieve_fallback(asked, ranked, default).withColumn("score", F.round("score", 6))


@register(
    "retrieve_best_gated",
    f"""WITH {_KB_RANKED} SELECT query_id, CASE WHEN score > 0.5 THEN chunk_id END AS chunk_id,
        round(score, 6) AS score, CASE WHEN score > 0.5 THEN text ELSE '' END AS context
    FROM ranked JOIN kb USING (chunk_id) WHERE rank = 1""",
)
def retrieve_best_gated_query(spark, d):
    return rt.retrieve_best_gated(messages(spark, d), kb(spark, d)).withColumn(
        "score", F.round("score", 6)
    )


# --- retrieved training rows ----------------------------------------------------------
_TRAIN_SQL = f"""WITH {PAIRS_CTE}, {KB_SQL},
asked AS (SELECT reply_id, CASE WHEN tweet_id % 4294967296 < 2 THEN embedding ELSE list_reverse(embedding) END AS embedding
  FROM pairs LEFT JOIN embeddings ON vec_id = tweet_id // 4294967296),
{sql_ranked("asked", "reply_id", "kb", "chunk_id")},
best AS (SELECT query_id, CASE WHEN score > 0.5 THEN text ELSE '' END AS context
  FROM ranked JOIN kb USING (chunk_id) WHERE rank = 1)
SELECT reply_id, concat(CASE WHEN context <> '' THEN concat('Context:', chr(10), context, chr(10), chr(10)) ELSE '' END,
         'Customer: ', {sql_user_prefix("input")}, chr(10), 'Support:') AS input_text,
       {sql_user_prefix("response")} AS target_text, company
FROM pairs JOIN asked USING (reply_id) LEFT JOIN best ON query_id = reply_id"""


def asked_pairs(spark, d):
    pairs = training_pairs(spark, d)
    return vectors_of(pairs, spark, d, F.expr(f"tweet_id div {TURN_KEYS}L"), F.col("tweet_id") % TURN_KEYS < 2)


@register("raft_training_rows", _TRAIN_SQL)
def raft_training_rows_query(spark, d):
    return rt.raft_training_rows(asked_pairs(spark, d), kb(spark, d), pair_id="reply_id")


# --- embedder ------------------------------------------------------------------------
@register(
    "embed_tfidf",
    f"""SELECT doc_id, 256 AS dims, CASE WHEN regexp_matches(text, '{WORD}') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS norm
    FROM documents""",
)
def embed_tfidf_query(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    embedded = embed_tfidf(docs).transform(docs)
    squares = F.aggregate(
        "embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")
    )
    return embedded.select(
        "doc_id", F.size("embedding").alias("dims"), F.round(F.sqrt(squares), 5).alias("norm")
    )


def sql_tfidf(texts: str, key: str, name: str, fitted: str, dims: int = 512) -> str:
    """CTEs: ``name`` holds ``key, bucket, w``, the unit weights of ``texts`` other than 0.

    ``fitted`` are the texts (``key, text``) that the model was fitted on.
    """

    def counted(source):
        return f"""(SELECT {key}, CAST(concat('0x', substring(md5(word), 1, 8)) AS BIGINT) % {dims} AS bucket, count(*) AS tf
      FROM (SELECT {key}, unnest({tokens_sql("text")}) AS word FROM {source}) GROUP BY ALL)"""

    return f"""{name}_idf AS (
      SELECT bucket, ln((n + 1.0::DOUBLE) / (coalesce(docs, 0) + 1)) AS idf
      FROM (SELECT unnest(range({dims})) AS bucket) CROSS JOIN (SELECT count(*) AS n FROM {fitted})
      LEFT JOIN (SELECT bucket, count(*) AS docs FROM {counted(fitted)} GROUP BY bucket) USING (bucket)),
    {name} AS (
      SELECT {key}, bucket, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS w
      FROM (SELECT {key}, bucket, tf * idf AS w FROM {counted(texts)} JOIN {name}_idf USING (bucket)) WHERE w <> 0)"""


@register(
    "embed_hashed_tfidf",
    f"""WITH texts AS (SELECT doc_id, text FROM documents), {sql_tfidf("texts", "doc_id", "weights", "texts")}
    SELECT doc_id, coalesce(found, CAST([] AS BIGINT[])) AS buckets, coalesce(ws, CAST([] AS DOUBLE[])) AS weights
    FROM documents LEFT JOIN (
      SELECT doc_id, list(bucket ORDER BY bucket) AS found, list(round(w, 6) ORDER BY bucket) AS ws
      FROM weights GROUP BY doc_id) USING (doc_id)""",
)
def embed_hashed_tfidf_query(spark, d):
    """Fitted on all documents, saved, loaded again: buckets and weights of every document."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    path = stages.scratch_path(spark, "embedder")
    HashedEmbedder.fit(docs).save(spark, path)
    vector = HashedEmbedder.load(spark, path).sparse(F.col("text"), "double")
    return docs.select("doc_id", vector.alias("v")).select(
        "doc_id",
        F.col("v.buckets").cast("array<long>").alias("buckets"),
        F.transform("v.weights", lambda w: F.round(w, 6)).alias("weights"),
    )


# --- knowledge base from texts ----------------------------------------------------------
def _spaced(spark, d):
    return table(spark, d, "documents").withColumn("text", F.replace("text", F.lit("\n"), F.lit("\n\n")))


def stored_documents(spark, d) -> str:
    """The path of a knowledge base: built from the English documents, then all are delivered."""
    path = stages.scratch_path(spark, "kb-texts")
    docs = _spaced(spark, d)
    knowledge.kb_build(docs.where(F.col("lang") == "en"), path, chunk_paragraphs)
    knowledge.kb_append(docs, path, chunk_paragraphs)
    return path


_STORED_SQL = f"""delivered AS (
      SELECT source, lang, replace(text, chr(10), concat(chr(10), chr(10))) AS text FROM documents WHERE text IS NOT NULL),
    stored AS (
      SELECT sha256(concat(coalesce(concat(CAST(length(source) AS VARCHAR), ':', source), '-:'), text)) AS doc_hash,
        source, text, bool_or(coalesce(lang = 'en', FALSE)) AS built
      FROM delivered GROUP BY source, text),
    pieces AS (
      SELECT doc_hash, source, built, list_filter(list_transform(string_split(text, concat(chr(10), chr(10))),
        lambda p: {sql_strip("p")}), lambda p: length(p) > 40) AS ps FROM stored),
    chunks AS (
      SELECT concat(doc_hash, ':', CAST(i - 1 AS VARCHAR)) AS chunk_id, doc_hash, source, built, CAST(i - 1 AS INTEGER) AS chunk_idx, ps[i] AS text
      FROM (SELECT *, unnest(range(1, len(ps) + 1)) AS i FROM pieces)),
    built AS (SELECT chunk_id, text FROM chunks WHERE built)"""


@register(
    "kb_from_texts",
    f"WITH {_STORED_SQL} SELECT doc_hash, source, chunk_idx, text FROM chunks",
)
def kb_from_texts_query(spark, d):
    """The chunks stored after a build and an incremental delivery."""
    chunks = knowledge.kb_chunks(spark, stored_documents(spark, d))
    return chunks.select("doc_hash", "source", "chunk_idx", "text")


@register(
    "kb_search_texts",
    f"""WITH {_STORED_SQL}, {sql_tfidf("chunks", "chunk_id", "stored_w", "built")},
    {MESSAGES_SQL}, asked AS (SELECT query_id AS chunk_id, message AS text FROM messages),
    {sql_tfidf("asked", "chunk_id", "asked_w", "built")},
    a AS (SELECT chunk_id AS query_id, bucket, CAST(CAST(w AS FLOAT) AS DOUBLE) AS w FROM asked_w),
    b AS (SELECT chunk_id, bucket, CAST(CAST(w AS FLOAT) AS DOUBLE) AS w FROM stored_w),
    scored AS (
      SELECT query_id, chunk_id, round(dot / any_value(p.n) / any_value(r.n), 12) AS score FROM (
        SELECT query_id, chunk_id, sum(a.w * b.w) AS dot FROM a JOIN b USING (bucket) GROUP BY ALL)
      JOIN (SELECT query_id, sqrt(sum(w * w)) AS n FROM a GROUP BY query_id) p USING (query_id)
      JOIN (SELECT chunk_id, sqrt(sum(w * w)) AS n FROM b GROUP BY chunk_id) r USING (chunk_id)
      GROUP BY query_id, chunk_id, dot),
    ranked AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS INTEGER) AS rank FROM scored WHERE score > 0)
    SELECT query_id, rank, chunk_id, round(score, 6) AS score, text FROM ranked JOIN chunks USING (chunk_id) WHERE rank <= 3""",
)
def kb_search_texts_query(spark, d):
    """Every customer turn against all chunks of the stored knowledge base."""
    asked = messages(spark, d).select("query_id", "message")
    return knowledge.kb_search(asked, stored_documents(spark, d)).withColumn("score", F.round("score", 6))
