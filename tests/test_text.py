"""Golden rows for the text expressions; the truth is plain Python."""

import html
import re

from pyspark.sql import functions as F

from conftest import plan_of
from threadloom.constants import CONTRACTIONS
from threadloom.functions import answers, context, text as tx


def test_expand_contractions_single_pass(texts):
    cases = {
        "can't've": "cannot've",
        "he'd've go": "he would've go",
        "She's; she's Can't": "She is; she is Can't",
        "": "",
        "won’t": "won’t",
        "no apostrophe": "no apostrophe",
        "'cause y'all'd've sha'n't o'clock": None,
        "don'tdon't": None,
    }
    pattern = re.compile("|".join(map(re.escape, CONTRACTIONS)))
    wanted = [pattern.sub(lambda m: CONTRACTIONS[m.group()], t) for t in cases]
    for text, result in zip(cases, wanted):
        assert cases[text] in (None, result)
    assert texts(tx.expand_contractions, list(cases)) == wanted
    assert len(CONTRACTIONS) == 117


def test_html_unescape_matches_stdlib(texts):
    cases = ["&amp;lt; &notit; &#8217;", "plain", None, "&", "&#x41;&copy &hearts;&unknown;"]
    wanted = [None if c is None else html.unescape(c) for c in cases]
    assert wanted[0] == "&lt; ¬it; ’"
    assert texts(tx.html_unescape, cases) == wanted


def test_only_references_travel_to_python(spark, texts):
    odd = ["&amp" + "z" * 40 + ";&#10;&NewLine;\n&lt", "&#x1F600;&#0;&#xD800;&#99999999999;", "&&&;&#;&#x;&\x0bq; &é\U0001f600;", "a=1&b=2&copy=3", ""]
    assert texts(tx.html_unescape, odd) == [html.unescape(t) for t in odd]
    rows = spark.createDataFrame([("x" * 5000 + "&amp;y",)], "text string").select(tx.html_unescape(F.col("text")))
    sent = [line for line in plan_of(rows).splitlines() if line.startswith("Arguments: [_decode")]
    assert len(sent) == 1 and "regexp_extract_all" in sent[0], plan_of(rows)


def test_mentions_and_prefix(texts):
    assert texts(tx.mask_mentions, ["hi @Éric_1 a@b.com @²x @"]) == ["hi [USER] a[USER].com [USER] @"]
    assert texts(tx.strip_user_prefix, ["USER: user, Users are", None, "USER", "a USER"]) == [
        "s are",
        None,
        "",
        "a USER",
    ]


def test_emoji_needs_variation_selector(texts):
    assert texts(tx.emoji_to_tag, ["❤️ ❤ 🤷🙏"]) == ["[HEART] ❤ [SHRUG][THANKS]"]
    short = {"🤷": "[SHRUG]"}
    assert texts(lambda t: tx.emoji_to_tag(t, short), ["🤷🙏"]) == ["[SHRUG]🙏"]


def test_whitespace_is_unicode(texts):
    spaced = "a b c\x1cd　e​f  g\x85"
    assert texts(tx.squeeze_ws, [spaced]) == [" ".join(spaced.split())]
    assert texts(tx.strip_ws, ["　\x1f x y  "]) == ["x y"]


def test_urls(texts):
    cases = ["see http://a.b/c?d=1 now", "xwww.a.b", "https", "https://x"]
    wanted = [re.sub(r"http\S+|www\S+|https\S+", "", c) for c in cases]
    assert texts(tx.strip_urls, cases) == wanted


def plain_clean(text):
    """The cleaning rules written down once more, with Python's re and html."""
    if text is None:
        return ""
    text = html.unescape(text).replace("❤️", "[HEART]").replace("🤷", "[SHRUG]")
    text = re.sub(r"(?:http|www)\S+", "", text)
    text = re.sub(r"@\w+", "[USER]", text)
    text = re.sub("|".join(map(re.escape, CONTRACTIONS)), lambda m: CONTRACTIONS[m[0]], text)
    text = re.sub(r"[^\sa-zA-Z0-9.!?,\-:']", "", text)
    return " ".join(text.split())


def test_clean_text(texts):
    cases = [
        None,
        "",
        "@Bob_1 I can't &amp; he'd've ❤️ see http://x.y/z",
        "éà «bien» [x] 1:2 won't!",
        "&lt;b&gt; @É   www.x",
    ]
    assert texts(tx.clean_text, cases) == [plain_clean(c) for c in cases]
    assert texts(tx.clean_text, cases)[2] == "USER I cannot he would've HEART see"


def test_apply_edits(spark):
    rows = spark.createDataFrame(
        [
            ("hello wrld", [(6, 4, "world"), (0, 1, "H"), (2, 1, None)]),
            ("same", []),
            ("x" * 1001, [(0, 1, "y")]),
        ],
        "text string, edits array<struct<start:int,length:int,value:string>>",
    )
    got = [r[0] for r in rows.select(tx.apply_edits(F.col("text"), F.col("edits"))).collect()]
    assert got == ["Hello world", "same", "x" * 1001]


def test_dm_flag(texts):
    cases = ["DM us", "admin", "a Direct Message", "dm_x", "send dm"]
    assert texts(tx.dm_flag, cases) == [True, False, True, False, True]


def test_collapse_and_mojibake(texts):
    assert texts(answers.collapse_repeats, ["aaaaaaaab zzzzzz"]) == ["ab zzzzzz"]
    cases = ["Ã©", "é", "Ã© ’ it’s", "itâ€™s ðŸ˜€ Ã", "plain", None, "Ã", "Â«Ã¼ber 漢"]
    assert texts(answers.fix_mojibake, cases) == ["é", "é", "é ’ it’s", "it’s 😀 Ã", "plain", None, "Ã", "«über 漢"]


def test_merged_lines(texts):
    got = texts(answers.merged_lines, ["1.\nfirst step\n-\nitem\nplain\n2)", "-\n-\nx", "", "•"])
    assert got == [["1. first step", "- item", "plain", "2)"], ["- -", "x"], [], ["•"]]


def test_snippet_digest_limits(texts):
    run = lambda t: texts(lambda c: answers.snippet_digest(answers.merged_lines(c)), [t])[0]
    assert run("\n".join("abcdefgh")) == "\n".join("abcdefgh")  # 6 lines are tiny: up to 8
    assert run("\n".join(f"line number {i}" for i in range(9))).count("\n") == 5
    assert run("x" * 400 + "\nmore") == "x" * 400


def with_contexts(spark, fn, question, contexts):
    rows = spark.createDataFrame([(question, contexts)], "q string, c array<string>")
    return rows.select(fn(F.col("q"), F.col("c"))).first()[0]


def test_shipping_times(spark):
    run = lambda q, c: with_contexts(spark, answers.shipping_times, q, c)
    quoted = ["Standard Shipping\n3–5 business days", "x Two-Day Shipping 2-2 business days"]
    assert run("What is the shipping time?", quoted) == (
        "Our shipping times are: Standard Shipping takes 3–5 business days [1]. "
        "Two-Day Shipping takes 2-2 business days [1]."
    )
    assert run("hello", quoted) is None
    assert run("how long", ["nothing"]) is None


def test_fallbacks(spark):
    v2 = lambda q, c: with_contexts(spark, answers.fallback_answer_v2, q, c)
    assert v2("refund please", ["other words in here entirely", "the refund rules are simple"]) == (
        "Based on our records: the refund rules are simple [2]"
    )
    assert "could you please provide more details" in v2("x", [])
    assert v2("x", ["short"]).startswith("I don't have detailed information")
    v1 = lambda q, c: with_contexts(spark, lambda q, c: answers.fallback_answer_v1(c), q, c)
    assert v1("", ["First one is here. Second? Third."]) == (
        "Based on our records: First one is here. Second [1]"
    )


def test_clean_response_v1(texts):
    cases = {
        "[user] Your order was shipped today. -EmmaW": "Your order was shipped today.",
        "Too short. This sentence is long enough! tail": "This sentence is long enough!",
        "ABC DEF GHI no punctuation": "no punctuation",
        "": "I'm sorry, I'm having trouble with that request. Could you please rephrase?",
        "Yes. No.": "I'm sorry, I'm having trouble with that request. Could you please rephrase?",
    }
    assert texts(answers.clean_response_v1, list(cases)) == list(cases.values())


def test_extract_reply(spark):
    rows = spark.createDataFrame(
        [
            (0, "p Support (remember to cite [X] after each fact): one: two", "p"),
            (1, "p Support: a Support: b\nc ", "p"),
            (2, "prompt  rest\nline", "prompt"),
        ],
        "i int, g string, p string",
    )
    pick = lambda first: [
        r[0]
        for r in rows.select(answers.extract_reply(F.col("g"), F.col("p"), first).alias("r"), "i")
        .orderBy("i")
        .collect()
    ]
    assert pick(False) == ["two", "b\nc", "rest\nline"]
    assert pick(True) == ["two", "b", "rest"]


def test_words_are_whole_unicode_tokens(texts):
    sample = "éabcd abcd_ABCD word4 Word,four x-rays don't"
    wanted = re.findall(r"\b[a-z]{4,}\b", sample.lower())
    assert texts(lambda t: tx.whole_words(t, 4), [sample]) == [wanted]


def test_grounding(spark):
    rows = spark.createDataFrame(
        [
            (0, "alpha beta gamma delta [1]", ["alpha beta gamma"], None),
            (1, "alpha beta gamma delta", ["alpha beta gamma"], 0.9),
            (2, "nothing shared [1]", ["alpha beta gamma"], 0.6),
            (3, "nothing shared [1]", ["alpha beta gamma"], 0.59),
            (4, "alpha beta gamma [1]", [], 0.9),
            (5, "alpha beta gamma [1]", None, 0.9),
        ],
        "i int, r string, c array<string>, s double",
    )
    got = rows.orderBy("i").select(context.grounding_check(F.col("r"), F.col("c"), F.col("s"))).collect()
    assert [r[0] for r in got] == [True, False, True, False, False, False]
