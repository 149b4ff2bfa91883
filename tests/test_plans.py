"""What the physical plans must and must not contain."""

from pathlib import Path

from conftest import plan_of
from pyspark.sql import functions as F

from threadloom.functions import text as tx
from threadloom.operators import pairs, ranking, sampling
from threadloom.plans import views
from threadloom.plans.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_cleaning_uses_python_only_for_entities(spark):
    cleaned = plan_of(pairs.clean_tweets(views.noisy(spark, SF_DIR)))
    assert cleaned.count("ArrowEvalPython") == 2  # the tree and its detail entry
    rest = views.noisy(spark, SF_DIR).select(
        tx.squeeze_ws(tx.strip_special(tx.expand_contractions(tx.mask_mentions(tx.strip_urls(F.col("text"))))))
    )
    assert "Python" not in plan_of(rest)


def test_pairing_is_an_equi_join(spark):
    plan = plan_of(pairs.pair_replies(views.tweets(spark, SF_DIR), "text"))
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert "Join" in plan


def test_no_query_uses_a_cross_join(spark):
    skip = {"stream_chat_turns", "stream_chat_contexts", "stream_pair_replies"}  # already finished when returned
    for name in sorted(set(QUERIES) - skip):
        plan = plan_of(QUERIES[name](spark, SF_DIR))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_sampling_does_not_move_the_rows(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = plan_of(sampling.sample_n(df, 20, 1, "doc_id"))
    main = plan.split("===== Subqueries =====")[0]
    assert "Exchange" not in main and "Sort" not in main
    assert "ReadSchema: struct<doc_id:bigint>" in plan  # the cut reads ids only


def test_topk_is_cut_before_the_shuffle(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = plan_of(ranking.topk_per_group(df, ["source"], [F.col("doc_id")], 3))
    assert "WindowGroupLimit" in plan and plan.index("Partial") >= 0


def test_projection_reaches_the_scan(spark):
    plan = plan_of(QUERIES["top_active_authors"](spark, SF_DIR))
    assert "ReadSchema: struct<conv_id:bigint,role:string>" in plan
    assert "PushedFilters: [IsNotNull(role), Not(EqualTo(role,system))]" in plan


def test_answers_bind_their_intermediates(spark):
    from threadloom.plans.catalog import QUERIES

    plan = QUERIES["answer_route"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") <= 14 and plan.count("aggregate(") <= 6


def test_answer_route_of_conversations_over_a_hundred_turns(spark, tmp_path):
    # Turn 100 + t of one conversation is not turn t of the next.
    source = Path("/root/testdata/sf0.001")
    for path in source.glob("*.parquet"):
        if path.stem != "conversations":
            (tmp_path / path.name).symlink_to(path)
    talk = spark.read.parquet(str(source / "conversations.parquet"))
    later = F.when(F.col("conv_id") % 2 == 0, F.col("turn") + 100).otherwise(F.col("turn")).cast(talk.schema["turn"].dataType)
    talk.withColumn("turn", later).write.parquet(str(tmp_path / "conversations.parquet"))
    route = QUERIES["answer_route"]
    short = sorted(tuple(r) for r in route(spark, str(source)).collect())
    long = sorted((r.conv_id, r.turn % 100, r.route, r.answer) for r in route(spark, str(tmp_path)).collect())
    assert long == short
