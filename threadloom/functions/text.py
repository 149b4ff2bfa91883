"""Text-cleaning column expressions.

Everything except entity decoding is a built-in expression; the regexes spell
out Unicode classes because Java's shorthand classes are ASCII-only.
"""

import html
import re
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T

from threadloom.constants import (
    CONTEXT_CHARS,
    CONTRACTIONS,
    EMOJI_TAGS,
    NOT_WS,
    WORD,
    WORD_BODY,
    WS,
    WS_BODY,
    WS_CHARS,
)

URL = f"http{NOT_WS}+|www{NOT_WS}+"
MENTION = f"@{WORD}+"
NOT_KEPT = r"[^a-zA-Z0-9.!?,\-:'" + WS_BODY + "]+"
USER_PREFIX = r"(?iu)^(?:USER[:\-.," + WS_BODY + "]*)+"
DIRECT_MESSAGE = rf"(?iu)(?:^|[^{WORD_BODY}])(?:dm|direct message)(?:[^{WORD_BODY}]|$)"


# What Python's html.unescape may replace.
CHARACTER_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


@F.arrow_udf(T.ArrayType(T.StringType()))
def _decode_references(found: pa.Array) -> pa.Array:
    """Each different reference of a batch is decoded once; null lists stay null."""
    coded = found.flatten().dictionary_encode()
    decoded = pa.array([html.unescape(r) for r in coded.dictionary.to_pylist()], pa.string())
    ends = pc.cumulative_sum(pc.fill_null(pc.list_value_length(found), 0).cast(pa.int32()))
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
    return pa.ListArray.from_arrays(offsets, decoded.take(coded.indices), mask=found.is_null())


def html_unescape(text: Column) -> Column:
    """Decode entities; only the references travel to Python, however long the texts are."""
    pattern = F.lit(CHARACTER_REFERENCE)
    found = F.when(text.contains("&"), F.regexp_extract_all(text, pattern, F.lit(0)))
    between = F.split(text, CHARACTER_REFERENCE, -1)
    pieces = F.zip_with(between, _decode_references(found), lambda t, r: F.concat(t, F.coalesce(r, F.lit(""))))
    return F.coalesce(F.array_join(pieces, ""), text)


def emoji_to_tag(text: Column, tags: dict[str, str] = EMOJI_TAGS) -> Column:
    return reduce(
        lambda t, kv: F.replace(t, F.lit(kv[0]), F.lit(kv[1])), tags.items(), text
    )


def strip_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL, "")


def mask_mentions(text: Column) -> Column:
    return F.regexp_replace(text, MENTION, "[USER]")


def _alternation(table: dict[str, str]) -> str:
    """Keys in matching order; positions without an apostrophe near by fail at once."""
    keys = "|".join(re.escape(k) for k in table)
    heads = [k.split("'", 1)[0] for k in table if "'" in k]
    if len(heads) < len(table) or not all(h.isalpha() or not h for h in heads):
        return keys
    return rf"(?=\p{{L}}{{0,{max(map(len, heads))}}}')(?:{keys})"


def expand_contractions(text: Column, table: dict[str, str] = CONTRACTIONS) -> Column:
    """Single-pass dictionary replace: the first key that matches wins.

    Cut the text at the hits, look each hit up in a constant map, and zip gaps
    and replacements back together.
    """
    pattern = _alternation(table)
    entries = "\n".join(f"{k}\t{v}" for k, v in table.items())
    lookup = F.str_to_map(F.lit(entries), F.lit("\n"), F.lit("\t"))  # folded to a constant
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    joined = F.array_join(
        F.zip_with(
            gaps,
            hits,
            lambda gap, hit: F.concat(
                gap, F.coalesce(F.try_element_at(lookup, hit), F.lit(""))
            ),
        ),
        "",
    )
    if all("'" in key for key in table):
        return F.when(text.contains("'"), joined).otherwise(text)
    return joined


def strip_special(text: Column) -> Column:
    return F.regexp_replace(text, NOT_KEPT, "")


def squeeze_ws(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, f"{WS}+", " "))


def strip_ws(text: Column) -> Column:
    """Trim Unicode whitespace on both ends."""
    return F.btrim(text, F.lit(WS_CHARS))


def mask_noise(text: Column, tags: dict[str, str] = EMOJI_TAGS) -> Column:
    """First half of the cleaning chain; a missing text becomes the empty string."""
    decoded = html_unescape(F.coalesce(text, F.lit("")))
    return mask_mentions(strip_urls(emoji_to_tag(decoded, tags)))


def normalize_masked(masked: Column) -> Column:
    """Second half of the cleaning chain."""
    return squeeze_ws(strip_special(expand_contractions(masked)))


def clean_text(text: Column, tags: dict[str, str] = EMOJI_TAGS) -> Column:
    """The whole cleaning chain as one expression."""
    return normalize_masked(mask_noise(text, tags))


def strip_user_prefix(text: Column) -> Column:
    return F.regexp_replace(text, USER_PREFIX, "")


def dm_flag(text: Column) -> Column:
    return text.rlike(DIRECT_MESSAGE)


def truncate_text(text: Column, chars: int = CONTEXT_CHARS) -> Column:
    return F.substring(text, 1, chars)


def contains_keyword(text: Column, keywords) -> Column:
    lowered = F.lower(text)
    return reduce(lambda a, b: a | b, [lowered.contains(k) for k in keywords])


def apply_edits(text: Column, edits: Column, max_chars: int = 1000) -> Column:
    """Apply ``array<struct<start,length,value>>`` edits from last to first.

    ``start`` counts characters from 0; edits whose value is NULL are skipped and
    texts longer than ``max_chars`` are returned untouched.
    """
    usable = F.filter(F.coalesce(edits, F.array()), lambda e: e["value"].isNotNull())
    ordered = F.sort_array(usable, asc=False)
    patched = F.aggregate(
        ordered,
        text,
        lambda t, e: F.concat(
            F.substring(t, F.lit(1), e["start"]),
            e["value"],
            F.substring(t, e["start"] + e["length"] + 1, F.length(t)),
        ),
    )
    return F.when(F.length(text) > max_chars, text).otherwise(patched)


def whole_words(text: Column, minimum: int) -> Column:
    """Lower-cased a-z words of at least ``minimum`` letters, whole tokens only."""
    pattern = rf"(?<![{WORD_BODY}])[a-z]{{{minimum},}}(?![{WORD_BODY}])"
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def tokens(text: Column) -> Column:
    """Lower-cased runs of word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"{WORD}+"), F.lit(0))


def frequency_words(text: Column) -> Column:
    """Words as counted by the frequency table: letters and apostrophes, 3 or more."""
    return F.regexp_extract_all(F.lower(text), F.lit("[A-Za-z']{3,}"), F.lit(0))
