"""Answer post-processing expressions."""

from pyspark.sql import Column, functions as F

from threadloom.constants import (
    ANSWER_NO_CONTEXT_V1,
    ANSWER_NO_CONTEXT_V2,
    ANSWER_NO_DETAIL,
    ANSWER_PREFIX,
    ANSWER_TROUBLE,
    ANSWER_UNCLEAR,
    CITE_MARK,
    SHIPPING_KEYWORDS,
    SHIPPING_LEAD,
    SHIPPING_METHODS,
    SUPPORT_TAIL,
    WORD,
    WORD_BODY,
    WS,
)
from threadloom.functions.context import best_snippet
from threadloom.functions.text import contains_keyword, squeeze_ws, strip_ws

USER_TAG = r"(?iu)\[USER\]"
SIGNATURE = f"{WS}*-[A-Z]{{2,}}{WORD}*"
SHOUTING = rf"(?<![{WORD_BODY}])(?:[A-Z]{{3,}}{WS}+)+[A-Z]{{3,}}(?![{WORD_BODY}])"
SENTENCE = "[^.!?]*[.!?]"
LIST_MARKER = r"\A(?:\p{Nd}+[).]?|[-*•])\z"
SHIPPING = (
    f"({'|'.join(SHIPPING_METHODS)}) Shipping{WS}+"
    r"(\p{Nd}+[–-]\p{Nd}+ business days)"
)
FALLBACK_MIN_CHARS = 20

# The characters windows-1252 shows for bytes 80 to 9F, and those bytes as Latin-1.
CP1252_CHARS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
CP1252_BYTES = CP1252_CHARS.encode("cp1252").decode("latin-1")
_CONT = r"[\x{80}-\x{BF}" + CP1252_CHARS + "]"
DAMAGED = (
    rf"(?:[\x{{C2}}-\x{{DF}}]{_CONT}|[\x{{E0}}-\x{{EF}}]{_CONT}{{2}}|[\x{{F0}}-\x{{F4}}]{_CONT}{{3}})+"
)


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def extract_reply(generated: Column, prompt: Column, first_line_only: bool = False) -> Column:
    """The reply part of a generated continuation of ``prompt``."""
    after_rule = F.substring_index(F.substring_index(generated, CITE_MARK, -1), ":", -1)
    reply = (
        F.when(generated.contains(CITE_MARK), after_rule)
        .when(generated.contains(SUPPORT_TAIL), F.substring_index(generated, SUPPORT_TAIL, -1))
        .otherwise(F.substring(generated, F.length(prompt) + 1, F.length(generated)))
    )
    reply = strip_ws(reply)
    return strip_ws(F.substring_index(reply, "\n", 1)) if first_line_only else reply


def collapse_repeats(text: Column) -> Column:
    """A character repeated seven times or more is kept once."""
    return F.regexp_replace(text, r"(.)\1{6,}", "$1")


def fix_mojibake(text: Column) -> Column:
    """Undo UTF-8 that was read as Latin-1 or windows-1252, run by run.

    A run of characters that spell UTF-8 bytes is replaced if the bytes are valid; the rest
    of the text, whatever it holds, stays.
    """

    def repaired(run: Column) -> Column:
        bytes_ = F.encode(F.translate(run, CP1252_CHARS, CP1252_BYTES), "ISO-8859-1")
        return bind(bytes_.cast("string"), lambda t: F.when(F.is_valid_utf8(t), t).otherwise(run))

    between = F.split(text, DAMAGED, -1)
    runs = F.regexp_extract_all(text, F.lit(DAMAGED), F.lit(0))
    pieces = F.zip_with(between, runs, lambda b, r: F.concat(b, F.coalesce(repaired(r), F.lit(""))))
    return F.array_join(pieces, "")


def strip_artifacts(text: Column) -> Column:
    """Drop user tags and agent signatures."""
    return F.regexp_replace(F.regexp_replace(text, USER_TAG, ""), SIGNATURE, "")


def clean_response_v1(text: Column) -> Column:
    bare = strip_ws(F.regexp_replace(F.coalesce(text, F.lit("")), USER_TAG, ""))
    bare = F.regexp_replace(F.regexp_replace(bare, SIGNATURE, ""), SHOUTING, "")
    sentences = F.transform(F.regexp_extract_all(bare, F.lit(SENTENCE), F.lit(0)), strip_ws)
    kept = F.filter(
        sentences, lambda s: F.size(F.split(squeeze_ws(s), " ")) > 3
    )
    body = F.when(bare.rlike("[.!?]"), F.array_join(kept, " ")).otherwise(bare)
    tidy = squeeze_ws(body)
    return F.when(F.length(tidy) > 0, tidy).otherwise(ANSWER_TROUBLE)


def normalize_response_v2(text: Column) -> Column:
    """The text part of the second cleaner, before the plausibility gate."""
    repaired = strip_ws(fix_mojibake(F.coalesce(text, F.lit(""))))
    return squeeze_ws(collapse_repeats(strip_artifacts(repaired)))


def gate_answer(text: Column, verdict: Column) -> Column:
    return (
        F.when(verdict == "short", ANSWER_TROUBLE)
        .when(verdict.isin("no_words", "rare"), ANSWER_UNCLEAR)
        .otherwise(text)
    )


def merged_lines(text: Column) -> Column:
    """Trimmed non-empty lines; a lone list marker is glued to the line after it."""
    lines = F.filter(
        F.transform(F.split(text, "\n"), strip_ws), lambda line: F.length(line) > 0
    )
    empty = F.array().cast("array<string>")
    start = F.struct(empty.alias("done"), F.lit(None).cast("string").alias("marker"))

    def step(acc, line):
        glued = F.struct(
            F.array_append(acc["done"], F.concat_ws(" ", acc["marker"], line)).alias("done"),
            F.lit(None).cast("string").alias("marker"),
        )
        held = F.struct(acc["done"].alias("done"), line.alias("marker"))
        return F.when(acc["marker"].isNull() & line.rlike(LIST_MARKER), held).otherwise(glued)

    return F.aggregate(
        lines,
        start,
        step,
        lambda acc: F.when(
            acc["marker"].isNotNull(), F.array_append(acc["done"], acc["marker"])
        ).otherwise(acc["done"]),
    )


def _lines_to_show(lines: Column, max_lines: int = 6, max_chars: int = 400) -> Column:
    taken = F.aggregate(
        lines,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("chars")),
        lambda acc, line: F.when((acc["n"] >= max_lines) | (acc["chars"] >= max_chars), acc).otherwise(
            F.struct(
                (acc["n"] + 1).alias("n"), (acc["chars"] + F.length(line)).alias("chars")
            )
        ),
    )
    return taken["n"]


def snippet_digest(lines: Column) -> Column:
    """Head of the merged lines: 6 lines or 400 chars, stretched to 8 lines if tiny."""
    longer = strip_ws(F.array_join(F.slice(lines, 1, 8), "\n"))

    def choose(shown: Column) -> Column:
        head = strip_ws(F.array_join(F.slice(lines, F.lit(1), shown), "\n"))
        more = F.size(lines) > shown
        return bind(head, lambda h: F.when((F.length(h) <= FALLBACK_MIN_CHARS) & more, longer).otherwise(h))

    return bind(_lines_to_show(lines), choose)


def fallback_answer_v2(question: Column, contexts: Column) -> Column:
    def cite(index: Column) -> Column:
        lines = merged_lines(F.try_element_at(contexts, index + 1))
        number = F.concat(F.lit(" ["), (index + 1).cast("string"), F.lit("]"))
        return bind(
            bind(lines, snippet_digest),
            lambda digest: F.when(
                F.length(digest) > FALLBACK_MIN_CHARS, F.concat(F.lit(ANSWER_PREFIX), digest, number)
            ).otherwise(ANSWER_NO_DETAIL),
        )

    none = F.coalesce(F.size(contexts), F.lit(0)) <= 0
    return F.when(none, ANSWER_NO_CONTEXT_V2).otherwise(bind(best_snippet(question, contexts), cite))


def fallback_answer_v1(contexts: Column) -> Column:
    parts = F.split(F.try_element_at(contexts, F.lit(1)), f"[.!?]{WS}+")
    digest = strip_ws(F.array_join(F.slice(parts, 1, 2), ". "))
    return (
        F.when(F.coalesce(F.size(contexts), F.lit(0)) <= 0, ANSWER_NO_CONTEXT_V1)
        .when(
            F.length(digest) > FALLBACK_MIN_CHARS,
            F.concat(F.lit(ANSWER_PREFIX), digest, F.lit(" [1]")),
        )
        .otherwise(ANSWER_NO_DETAIL)
    )


def shipping_times(question: Column, contexts: Column) -> Column:
    """Templated answer to delivery-time questions; NULL when nothing is quoted."""
    quoted = F.flatten(
        F.transform(
            contexts,
            lambda c: F.arrays_zip(
                F.regexp_extract_all(c, F.lit(SHIPPING), F.lit(1)).alias("method"),
                F.regexp_extract_all(c, F.lit(SHIPPING), F.lit(2)).alias("span"),
            ),
        )
    )

    def answer(quotes: Column) -> Column:
        sentences = F.transform(
            F.slice(quotes, 1, 3),
            lambda q: F.concat(
                q["method"], F.lit(" Shipping takes "), q["span"], F.lit(" [1].")
            ),
        )
        lead = F.concat(F.lit(SHIPPING_LEAD), F.array_join(sentences, " "))
        return F.when(F.size(quotes) > 0, lead)

    return F.when(contains_keyword(question, SHIPPING_KEYWORDS), bind(quoted, answer))


def answer_route(
    template: Column, valid: Column, fallback: Column, meaningful: Column, generic: str
) -> Column:
    """``struct<route, answer>``: template, then first valid attempt, then fallback or generic."""

    def route(name: str, answer: Column) -> Column:
        return F.struct(F.lit(name).alias("route"), answer.alias("answer"))

    return bind(
        template,
        lambda t: F.when(meaningful & t.isNotNull(), route("template", t))
        .when(valid.isNotNull(), route("model", valid))
        .when(meaningful, route("fallback", fallback))
        .otherwise(route("generic", F.lit(generic))),
    )
