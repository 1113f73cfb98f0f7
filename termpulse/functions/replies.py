"""Model prompts and replies: replies arrive as a text column, never over the network here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from termpulse import fixed_values as fixed
from termpulse.functions.common import blank_to_null, let, strip


def _unfenced(reply: Column) -> Column:
    """Strip, then drop the first and last line of a fenced reply of three lines or more."""

    def body(t: Column) -> Column:
        lines = F.split(t, r"\r\n|\r|\n")
        inner = strip(F.array_join(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 2, F.lit(0))), "\n"))
        return F.when(t.startswith("```") & (F.size(lines) >= 3), inner).otherwise(t)

    return let(strip(F.coalesce(reply, F.lit(""))), body)


def reply_object(reply: Column) -> Column:
    """The reply's JSON as a variant: the whole text, else its outermost braces, else NULL."""
    return let(
        _unfenced(reply),
        lambda t: F.coalesce(
            F.try_parse_json(t), F.try_parse_json(blank_to_null(F.regexp_extract(t, r"(?s)\{.*\}", 0)))
        ),
    )


def _is_string(v: Column) -> Column:
    return F.schema_of_variant(v) == "STRING"


def _string_at(obj: Column, path: str) -> Column:
    """Trimmed text at a path; NULL when absent, blank or no string."""
    v = F.try_variant_get(obj, path, "variant")
    return F.when(_is_string(v), blank_to_null(strip(F.try_variant_get(obj, path, "string"))))


def _strings_at(obj: Column, path: str) -> Column:
    """The non-blank string items of an array at a path; NULL when there is no array."""
    items = F.when(
        F.schema_of_variant(F.try_variant_get(obj, path, "variant")).startswith("ARRAY"),
        F.try_variant_get(obj, path, "array<variant>"),
    )
    return F.transform(
        F.filter(items, lambda v: _is_string(v) & (strip(F.try_variant_get(v, "$", "string")) != "")),
        lambda v: F.try_variant_get(v, "$", "string"),
    )


def parse_rerank(reply: Column) -> Column:
    """The terms named under ``top``, trimmed; NULL when the reply holds none."""
    top = F.transform(_strings_at(reply_object(reply), "$.top"), strip)
    return F.when(F.size(top) > 0, top)


def parse_blurb(reply: Column) -> Column:
    """``struct<summary, why, definition<text, references>>``; each part is NULL when unusable."""
    obj = reply_object(reply)
    text = F.coalesce(_string_at(obj, "$.definition.text"), _string_at(obj, "$.definition"))
    none = F.array().cast("array<string>")
    refs = F.coalesce(_strings_at(obj, "$.definition.references"), none)
    return F.struct(
        _string_at(obj, "$.summary").alias("summary"),
        _string_at(obj, "$.why").alias("why"),
        F.when(text.isNotNull(), F.struct(text.alias("text"), refs.alias("references"))).alias("definition"),
    )


def _quoted(term: Column) -> Column:
    # terms hold no backslash; one with an apostrophe is shown in double quotes
    return F.when(term.contains("'"), F.concat(F.lit('"'), term, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), term, F.lit("'"))
    )


def rerank_prompt(candidates: Column, limit: int = fixed.RERANK_INPUT) -> Column:
    """Prompt text over an ordered ``array<struct<term, tf_today, df_today>>``."""
    lines = F.transform(
        F.slice(candidates, 1, limit),
        lambda c: F.concat(
            F.lit("- "), _quoted(c["term"]), F.lit(" (tf="), c["tf_today"].cast("string"), F.lit(", df="),
            c["df_today"].cast("string"), F.lit(")"),
        ),
    )
    head = F.array(F.lit("Candidate terms for today's Word of the Day:"), F.lit(""))
    return F.array_join(F.concat(head, lines), "\n")


def blurb_prompt(word: Column, candidates: Column, evidence: Column) -> Column:
    """Prompt text from the word, ordered candidates and ordered evidence articles."""
    terms = F.transform(
        F.slice(candidates, 1, fixed.CANDIDATES_KEPT),
        lambda c: F.concat(
            F.lit("  - "), c["term"], F.lit(" (tf="), c["tf_today"].cast("string"), F.lit(", df="),
            c["df_today"].cast("string"), F.lit(")"),
        ),
    )

    def lines(a: Column) -> Column:
        body = F.coalesce(blank_to_null(a["snippet"]), blank_to_null(a["content_text"]))
        return F.concat_ws(
            "\n",
            F.concat(F.lit("  - ["), a["source_id"], F.lit("] "), F.coalesce(a["title"], F.lit("(no title)"))),
            F.concat(F.lit("    url: "), F.coalesce(a["url"], F.lit(""))),
            F.concat(F.lit("    excerpt: "), F.substring(body, 1, fixed.EXCERPT_CHARS)),
        )

    head = F.array(F.concat(F.lit("WORD OF THE DAY: "), word), F.lit(""), F.lit("Top candidates (term, tf_today, df_today):"))
    mid = F.array(F.lit(""), F.lit("Evidence articles:"))
    return F.array_join(F.concat(head, terms, mid, F.transform(F.slice(evidence, 1, fixed.BLURB_EVIDENCE), lines)), "\n")
