"""Soft-membership mixing of documents to target domain weights, in DataFrame operations only.

A naive Bayes classifier fitted on a labelled table gives every document a posterior over
domains. Projected-gradient least squares then finds a rate of at least zero per document
such that the expected domain token totals, the sums of tokens x posterior x rate, match the targets.
All sums are Spark aggregates; the driver holds one number per domain (and pair of domains) and step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from threadloom.sources.stages import cut_lineage

VOCABULARY = 2_000
MAX_TRAIN = 20_000
SMOOTHING = 1.0
EVIDENCE_WORDS = 24  # longer texts count as this many words, so that posteriors stay soft
MAX_STEPS = 25
TOLERANCE = 1e-7

# The language mix of the registered query and of the pipeline.
LANGUAGE_TARGETS = {"de": 0.2, "en": 0.4, "es": 0.2, "fr": 0.2}


def labelled_languages(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, domain``: the language of the documents that the label table lists."""
    listed = labels.select("doc_id").where("doc_id is not null").distinct()
    return docs.select("doc_id", F.col("lang").alias("domain")).where("domain is not null").join(listed, "doc_id", "left_semi")


def _words(text: str | Column) -> Column:
    """Lower-case blank-separated words; none for null and blank texts."""
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s+"), lambda w: w != "")


@dataclass(frozen=True)
class DomainModel:
    """``word, weights``: log likelihoods of at most ``VOCABULARY`` words and one neutral entry ''."""

    domains: tuple[str, ...]
    prior: tuple[float, ...]
    words: DataFrame


def fit_domains(
    docs: DataFrame,
    labelled: DataFrame,
    domains: tuple[str, ...],
    max_train: int = MAX_TRAIN,
    vocabulary: int = VOCABULARY,
    seed: int = 10,
) -> DomainModel:
    """Multinomial naive Bayes from labelled documents.

    ``labelled(doc_id, domain)`` may list an id more than once (the smallest domain counts); domains
    outside ``domains`` are left out. About ``max_train`` of its rows, chosen by a hash threshold, are
    fitted; the vocabulary is the most frequent words among them.
    """
    rows = labelled.where(F.col("domain").isin(*domains) & F.col("doc_id").isNotNull())
    rows = rows.groupBy("doc_id").agg(F.min("domain").alias("domain"))
    total = rows.count()
    if total > max_train:
        cut = int(-(2**63) + (max_train / total) * 2**64)
        rows = rows.where(F.xxhash64("doc_id", F.lit(seed)) < F.lit(cut).cast("long"))
    train = docs.select("doc_id", "text").join(rows, "doc_id")
    seen = {r["domain"]: r["n"] for r in train.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = np.asarray([seen.get(d, 0) + SMOOTHING for d in domains], float)
    prior = np.log(prior / prior.sum())

    counts = [F.count(F.when(F.col("domain") == d, 1)).alias(f"n{i}") for i, d in enumerate(domains)]
    every = sum((F.col(f"n{i}") for i in range(len(domains))), F.lit(0))
    chosen = cut_lineage(
        train.select("domain", F.explode(_words("text")).alias("word"))
        .groupBy("word")
        .agg(*counts)
        .orderBy(every.desc(), "word")
        .limit(vocabulary)
    )
    sums = chosen.agg(*[F.coalesce(F.sum(f"n{i}"), F.lit(0)) for i in range(len(domains))], F.count(F.lit(1))).first()
    *totals, size = (float(x) for x in sums)
    weights = [
        F.log((F.col(f"n{i}") + SMOOTHING) / F.lit(totals[i] + SMOOTHING * max(size, 1.0))) for i in range(len(domains))
    ]
    neutral = docs.sparkSession.range(1).select(
        F.lit("").alias("word"), F.array(*[F.lit(0.0)] * len(domains)).alias("weights")
    )
    words = chosen.select("word", F.array(*weights).alias("weights")).unionByName(neutral)
    return DomainModel(tuple(domains), tuple(prior.tolist()), words)


def domain_posteriors(docs: DataFrame, model: DomainModel) -> DataFrame:
    """``doc_id, text_hash, tokens, posterior`` for every row of ``docs``.

    Every word of every text is looked up in the broadcast word table, whose size is a parameter
    of the fit; sums per row are combined before the shuffle. ``tokens`` counts the words of a text.
    """
    n = len(model.domains)
    one = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.monotonically_increasing_id().alias("_row"),
        _words("text").alias("_words"),
    ).select(
        "doc_id", "text_hash", "_row", F.size("_words").cast("long").alias("tokens"),
        # The neutral entry keeps rows without any known word.
        F.explode(F.concat(F.array(F.lit("")), "_words")).alias("word"),
    )
    hits = one.join(F.broadcast(model.words), "word")
    sums = hits.groupBy("_row", "doc_id", "text_hash", "tokens").agg(
        *[F.sum(F.col("weights")[i]).alias(f"_s{i}") for i in range(n)], (F.count(F.lit(1)) - 1).alias("_hits")
    )
    soft = F.least(F.lit(1.0), F.lit(float(EVIDENCE_WORDS)) / F.greatest(F.col("_hits"), F.lit(1)))
    scored = sums.select(
        "doc_id", "text_hash", "tokens",
        *[(F.lit(model.prior[i]) + F.col(f"_s{i}") * soft).alias(f"_z{i}") for i in range(n)],
    )
    # Of two or more domains the largest is found by greatest(), which wants two columns.
    top = F.greatest(*[F.col(f"_z{i}") for i in range(n)]) if n > 1 else F.col("_z0")
    shifted = scored.select("doc_id", "text_hash", "tokens", *[F.exp(F.col(f"_z{i}") - top).alias(f"_e{i}") for i in range(n)])
    whole = sum((F.col(f"_e{i}") for i in range(1, n)), F.col("_e0"))
    return shifted.select("doc_id", "text_hash", "tokens", F.array(*[F.col(f"_e{i}") / whole for i in range(n)]).alias("posterior"))


def _dot(posterior: Column, step: Column, n: int) -> Column:
    return sum((posterior[i] * step[i] for i in range(1, n)), posterior[0] * step[0])


def rate_after(steps: list[list[float]], n: int) -> Column:
    """A document's rate after the projected steps: from 1, minus posterior x step, never below 0."""
    rate = F.lit(1.0)
    if not steps:
        return rate
    taken = F.array(*[F.array(*[F.lit(float(v)) for v in step]) for step in steps])
    return F.aggregate(taken, rate, lambda r, s: F.greatest(F.lit(0.0), r - _dot(F.col("posterior"), s, n)))


def fit_rates(members: DataFrame, targets: list[float], max_steps: int = MAX_STEPS) -> list[list[float]]:
    """Steps in domain space that bring the expected token shares of ``members`` to ``targets``.

    The squared distance of shares to targets falls along its gradient, scaled by the
    inverse second moments of the documents still above zero; rates are projected to zero and
    above after every step. A rate is a function of a document's posterior and the steps,
    so no rate is stored between passes; a pass is one aggregation without a shuffle of rows. A
    step that does not help is halved. Domains that no document has keep a residual.
    """
    n = len(targets)
    goal = np.asarray(targets, float)
    goal = goal / goal.sum()
    p, tokens = [F.col("posterior")[i] for i in range(n)], F.col("tokens")

    def measure(steps: list[list[float]]) -> tuple[np.ndarray, np.ndarray, float]:
        rated = members.where("tokens > 0").withColumn("_rate", rate_after(steps, n))
        live = F.when(F.col("_rate") > 0, tokens)
        row = rated.agg(
            F.sum(tokens),
            *[F.sum(tokens * p[i] * F.col("_rate")) for i in range(n)],
            *[F.sum(live * p[i] * p[j]) for i in range(n) for j in range(n)],
        ).first()
        budget = float(row[0] or 0)
        shares = np.asarray([x or 0.0 for x in row[1 : n + 1]], float) / max(budget, 1.0)
        moments = np.asarray([x or 0.0 for x in row[n + 1 :]], float).reshape(n, n) / max(budget, 1.0)
        return shares - goal, moments, budget

    steps: list[list[float]] = []
    error, moments, budget = measure(steps)
    if not budget:
        return steps
    scale = 1.0
    while len(steps) < max_steps and np.abs(error).max() > TOLERANCE:
        ridge = 1e-6 * max(np.trace(moments), 1e-12) * np.eye(n)
        step = scale * np.linalg.solve(moments + ridge, error)
        new_error, new_moments, _ = measure([*steps, step.tolist()])
        gain = np.square(error).sum() - np.square(new_error).sum()
        if gain > 0:
            steps.append(step.tolist())
            error, moments, scale = new_error, new_moments, min(1.0, 2 * scale)
            if gain < 1e-16:
                break
        else:
            scale /= 2
            if scale < 1e-3:
                break
    return steps


def mixing_rates(
    docs: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float],
    max_train: int = MAX_TRAIN,
    seed: int = 10,
) -> DataFrame:
    """``doc_id, text_hash, tokens, p_<domain>.., rate, copies`` for every row of ``docs``.

    ``copies`` rounds the rate up or down by a fixed random number of the row, so that it equals the rate
    on average. A text without words has no tokens and keeps posteriors equal to the prior;
    null ids and repeated rows are rated like any other; with no labels at all the posterior is
    uniform; an empty table gives no rows. ``targets`` must name a domain at least.
    """
    if not targets:
        raise ValueError("no target domain is given")
    domains = tuple(sorted(targets))
    model = fit_domains(docs, labelled, domains, max_train=max_train, seed=seed)
    members = cut_lineage(domain_posteriors(docs, model))
    steps = fit_rates(members, [targets[d] for d in domains])
    luck = F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(seed)), F.lit(1 << 31)) / F.lit(float(1 << 31))
    return members.select(
        "doc_id",
        "text_hash",
        "tokens",
        *[F.col("posterior")[i].alias(f"p_{d}") for i, d in enumerate(domains)],
        rate_after(steps, len(domains)).alias("rate"),
    ).withColumn("copies", F.floor(F.col("rate") + luck).cast("int"))


def mix_documents(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], max_train: int = MAX_TRAIN) -> DataFrame:
    """Rows of ``docs`` as often as their mixing rate says, with all their columns."""
    rates = mixing_rates(docs, labelled, targets, max_train=max_train)
    # Equal rows have equal rates, so a key stands for all of them.
    chosen = (
        rates.where("copies > 0")
        .groupBy(F.col("doc_id").alias("_mix_id"), F.col("text_hash").alias("_mix_text"))
        .agg(F.max("copies").alias("_mix_copies"))
    )
    same = docs["doc_id"].eqNullSafe(F.col("_mix_id")) & (F.xxhash64(docs["text"]) == F.col("_mix_text"))
    columns = [docs[c] for c in docs.columns]
    return docs.join(chosen, same).select(*columns, F.explode(F.sequence(F.lit(1), "_mix_copies")).alias("_mix_n")).drop("_mix_n")
