import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from termpulse.functions import text as txt

STOP = ("the", "and", "is", "it's", "a", "of")
ALLOW = ("mcp", "context window", "o1", "x")


def expected_terms(text, stop, allow, max_n=3, min_len=2):
    toks = [m.lower() for m in re.findall(r"[A-Za-z][A-Za-z0-9'\-]*[A-Za-z0-9]|[A-Za-z]", text or "")]
    counts = Counter()
    for n in range(1, max_n + 1):
        for words in zip(*(toks[i:] for i in range(n))):
            gram = " ".join(words)
            long_enough = min(map(len, words)) >= min_len
            if gram in allow or (long_enough and not set(words) <= set(stop)):
                counts[gram] += 1
    return counts


def terms_of(spark, texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = txt.with_term_counts(df, F.col("t"), **options).select("i", "term_counts").collect()
    return [{c.term: c.tf for c in r.term_counts} for r in sorted(rows, key=lambda r: r.i)]


def test_tokens_keep_hyphens_and_apostrophes(column):
    got = column(txt.tokens, ["Well-known tools, don't they Run?", "", None, "naïve 3d x1-"])
    assert got[0] == ["well-known", "tools", "don't", "they", "run"]
    assert got[1] == [] and got[2] == []
    assert got[3] == ["na", "ve", "d", "x1"]


def test_ngrams(column):
    assert column(lambda c: txt.ngrams(txt.tokens(c), 2), ["a b c", "a", ""]) == [["a b", "b c"], [], []]


RULES = {
    # numbers are no words; a word of one letter ends every gram that holds it
    "Room 101 b 7 lamps2": "room|lamps2",
    # two letters are enough
    "an ox": "an|ox|an ox",
    # runs of stopwords alone are nothing, but grams may hold some
    "the and of the lamp of the and": "lamp|the lamp|lamp of|of the lamp|the lamp of|lamp of the",
    # listed grams stay, whatever they hold
    "x of MCP, the context window": (
        "x|mcp|context|window|of mcp|mcp the|the context|context window|of mcp the|mcp the context|the context window"
    ),
    "of the and": "",
}


def test_terms_follow_the_rules(spark):
    got = terms_of(spark, [*RULES, None], stopwords=STOP, allowlist=ALLOW)
    wanted = [{term: 1 for term in terms.split("|") if term} for terms in RULES.values()]
    assert got == [*wanted, {}] == [dict(expected_terms(t, STOP, ALLOW)) for t in [*RULES, None]]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aAbB tTheE'-1é\n\u212a", max_size=60), min_size=20, max_size=20))
def test_terms_of_any_text(spark, texts):
    got = terms_of(spark, texts, stopwords=STOP, allowlist=ALLOW)
    assert got == [dict(expected_terms(t, STOP, ALLOW)) for t in texts]


def test_other_sizes(spark):
    text = "alpha beta gamma delta alpha beta gamma delta"
    for max_n in (1, 2, 4):
        assert terms_of(spark, [text], stopwords=(), allowlist=(), max_n=max_n) == [
            dict(expected_terms(text, (), (), max_n))
        ]
    assert terms_of(spark, ["ab abc"], stopwords=(), allowlist=(), min_token_len=3) == [{"abc": 1}]


def test_top_terms_break_ties_by_term(spark):
    df = spark.createDataFrame([("b b a a c",)], "t string")
    top = txt.with_term_counts(df, F.col("t"), stopwords=(), allowlist=(), max_n=1, min_token_len=1)
    (row,) = top.select(txt.top_terms(F.col("term_counts"), 2).alias("top")).collect()
    assert [(t.term, t.tf) for t in row.top] == [("a", 2), ("b", 2)]
