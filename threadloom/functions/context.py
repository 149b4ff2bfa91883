"""Expressions over a message, its retrieved contexts and a candidate answer.

``contexts`` is always an ``array<string>`` in rank order.
"""

from pyspark.sql import Column, functions as F

from threadloom.constants import (
    CITE_TAIL,
    CONTEXT_GATE,
    GROUNDED_GATE,
    LONG_ANSWER_KEYWORDS,
    MEANINGFUL_CHARS,
    NO_CONTEXT,
    OPEN_PROMPT,
    OVERLAP_CONTEXTS,
    OVERLAP_MIN,
    OVERLAP_WORDS,
    RULES_PROMPT,
    SUPPORT_TAIL,
)
from threadloom.functions.text import contains_keyword, strip_ws, whole_words

CITATION = r"\[\p{Nd}+\]"


def has_citation(text: Column) -> Column:
    return F.coalesce(text.rlike(CITATION), F.lit(False))


def topn_contexts(contexts: Column, n: int) -> Column:
    return F.slice(contexts, 1, n)


def meaningful_context_len(contexts: Column, chars: int = MEANINGFUL_CHARS) -> Column:
    return F.coalesce(
        F.exists(contexts, lambda c: F.length(strip_ws(c)) > chars), F.lit(False)
    )


def context_relevance(contexts: Column, max_similarity: Column | None = None) -> Column:
    """Similarity decides where it is known, stripped length decides elsewhere."""
    by_length = meaningful_context_len(contexts)
    if max_similarity is None:
        return by_length
    return (F.size(F.coalesce(contexts, F.array())) > 0) & F.coalesce(
        max_similarity > CONTEXT_GATE, by_length
    )


def shared_words(response: Column, contexts: Column) -> Column:
    """Distinct 4-letter-plus words the answer shares with the head of the contexts."""
    heads = F.transform(
        topn_contexts(contexts, OVERLAP_CONTEXTS),
        lambda c: F.slice(whole_words(c, 4), 1, OVERLAP_WORDS),
    )
    return F.size(F.array_intersect(F.flatten(heads), whole_words(response, 4)))


def keyword_overlap(response: Column, contexts: Column) -> Column:
    return F.coalesce(shared_words(response, contexts) >= OVERLAP_MIN, F.lit(False))


def grounding_check(
    response: Column, contexts: Column, max_similarity: Column | None = None
) -> Column:
    supported = keyword_overlap(response, contexts)
    if max_similarity is not None:
        supported = F.coalesce(max_similarity >= GROUNDED_GATE, F.lit(False)) | supported
    has_any = F.coalesce(F.size(contexts) > 0, F.lit(False))
    return has_citation(response) & has_any & supported


def accept_answer(meaningful: Column, cited: Column, grounded: Column) -> Column:
    return ~meaningful | cited | grounded


def best_snippet(question: Column, contexts: Column) -> Column:
    """0-based index of the context sharing most words; the earliest wins ties."""
    wanted = F.array_distinct(whole_words(question, 3))
    scored = F.transform(
        contexts,
        lambda c, i: F.struct(
            F.size(F.array_intersect(wanted, whole_words(c, 3))).alias("score"),
            (-i).alias("back"),
        ),
    )
    return F.when(F.size(contexts) > 0, -F.array_max(scored)["back"])


def adaptive_k(message: Column, usual: int = 3, longer: int = 5) -> Column:
    return F.when(contains_keyword(message, LONG_ANSWER_KEYWORDS), longer).otherwise(usual)


def number_contexts(contexts: Column) -> Column:
    numbered = F.transform(
        contexts, lambda c, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), c)
    )
    return F.when(F.size(contexts) > 0, F.array_join(numbered, "\n\n")).otherwise(NO_CONTEXT)


def plain_prompt(message: Column) -> Column:
    return F.concat(F.lit("Customer: "), message, F.lit("\nSupport:"))


def context_prompt(message: Column, context: Column) -> Column:
    """Training prompt: the context block is left out when there is none."""
    block = F.when(
        F.coalesce(F.length(context), F.lit(0)) > 0,
        F.concat(F.lit("Context:\n"), context, F.lit("\n\n")),
    ).otherwise("")
    return F.concat(block, plain_prompt(message))


def build_prompt(
    message: Column,
    contexts: Column,
    meaningful: Column,
    history: Column | None = None,
) -> Column:
    """Answering prompt. With ``history`` the dialogue lines precede the message."""
    past = F.lit("") if history is None else F.concat(history, F.lit("\n"))
    turn = F.concat(past, F.lit("Customer: "), message, F.lit("\n"))
    grounded = F.concat(
        F.lit(RULES_PROMPT + "Context:\n"),
        number_contexts(contexts),
        F.lit("\n\n"),
        turn,
        F.lit(CITE_TAIL),
    )
    return F.when(meaningful, grounded).otherwise(
        F.concat(F.lit(OPEN_PROMPT), turn, F.lit(SUPPORT_TAIL))
    )
