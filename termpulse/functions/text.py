"""Tokens, n-grams and per-article term counts.

One article is one row, so everything here is narrow: no shuffle is needed to count
the terms of an article, however many articles there are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termpulse import fixed_values as fixed
from termpulse.functions import grams

SHORT, STOP, WORD = 0, 1, 2


def tokens(text: Column) -> Column:
    """Lowercase ASCII tokens; inner hyphens and apostrophes stay."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(fixed.TOKEN_PATTERN), F.lit(0))
    return F.transform(found, F.lower)


def ngrams(toks: Column, n: int) -> Column:
    """All n-grams of a token array, space-joined, in text order."""
    last = F.size(toks) - F.lit(n - 1)
    return F.when(
        last >= 1,
        F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.array_join(F.slice(toks, i, n), " ")),
    ).otherwise(F.array().cast("array<string>"))


def _quoted(words: Iterable[str]) -> str:
    return ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in words)


def _from(items: Column, start: int) -> Column:
    """The array from its ``start``-th element (1-based) to its end."""
    return F.slice(items, F.lit(start), F.greatest(F.size(items) - F.lit(start - 1), F.lit(0)))


def with_terms(
    df: DataFrame,
    text: Column,
    *,
    out: str = "grams",
    keep: Iterable[str] | None = None,
    stopwords: Iterable[str] = fixed.STOPWORDS,
    allowlist: Iterable[str] = fixed.ALLOWLIST,
    max_n: int = fixed.MAX_N,
    min_token_len: int = fixed.MIN_TOKEN_LEN,
) -> DataFrame:
    """Add the sorted bag of kept 1..max_n-grams as an array column to the ``keep`` columns (or all).

    An allowlisted gram always stays. Any other gram goes when one of its tokens is
    shorter than ``min_token_len`` or when all of its tokens are stopwords.
    """
    # The lambdas are SQL text: building hundreds of literal columns one by one is slow.
    stop, allow = sorted(set(stopwords)), sorted(set(allowlist))
    keep = df.columns if keep is None else list(keep)
    stopped = f"when t in ({_quoted(stop)}) then {STOP}" if stop else ""
    token_class = f"case when length(t) < {int(min_token_len)} then {SHORT} {stopped} else {WORD} end"

    def kept_gram(n: int) -> str:
        words = [f"w.t{i}" for i in range(n)]
        classes = [f"w.c{i}" for i in range(n)]
        gram = f"concat({', \' \', '.join(words)})" if n > 1 else words[0]
        lowest = f"least({', '.join(classes)})" if n > 1 else classes[0]
        good = f"({words[-1]} is not null and {lowest} > {SHORT} and {' + '.join(classes)} > {n * STOP})"
        listed = [a for a in allow if len(a.split(" ")) == n]
        if listed:
            good += f" or {gram} in ({_quoted(listed)})"
        return f"case when {good} then {gram} end"

    kept_grams = f"array({', '.join(kept_gram(n) for n in range(1, max_n + 1))})"

    tok = df.select(*keep, tokens(text).alias("__tok"))
    cls = tok.select(*keep, "__tok", F.expr(f"transform(__tok, t -> {token_class})").alias("__cls"))
    shifted = [_from(F.col("__tok"), i + 1).alias(f"t{i}") for i in range(max_n)]
    shifted += [_from(F.col("__cls"), i + 1).alias(f"c{i}") for i in range(max_n)]
    windows = cls.select(*keep, F.arrays_zip(*shifted).alias("__at"))
    bag = F.sort_array(F.array_compact(F.flatten(F.expr(f"transform(__at, w -> {kept_grams})"))))
    return windows.select(*keep, bag.alias(out))


def term_counts(text: Column, **options) -> Column:
    """The kept terms of a text with their counts, in order; ``options`` are those of ``with_terms``.

    The rows of a task are worked on in pieces of bounded size (``grams``), however long their texts are together.
    """
    rules = grams.Rules.of(**options)

    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for first, size in grams.pieces(texts):
                yield grams.counts(texts.slice(first, size), rules)

    return F.arrow_udf(counted, "array<struct<term:string,tf:bigint>>")(text)


def top_counts(text: Column, n: int | None = fixed.TOP_TERMS_PER_ARTICLE, **options) -> Column:
    """``top_terms`` of a text; the counts of its other terms stay in the task."""
    rules = grams.Rules.of(**options)

    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for first, size in grams.pieces(texts):
                yield grams.top(texts.slice(first, size), rules, n)

    return F.arrow_udf(counted, "array<struct<term:string,tf:bigint>>")(text)


def with_term_counts(
    df: DataFrame, text: Column, *, out: str = "term_counts", keep: Iterable[str] | None = None, **options
) -> DataFrame:
    """Add ``array<struct<term, tf>>`` with the count of every kept term of the row.

    Name the columns to ``keep`` so that a long text does not travel on.

    Counting stays inside the row; the terms ascend.
    """
    keep = df.columns if keep is None else list(keep)
    return df.select(*keep, term_counts(text, **options).alias(out))


def top_terms(counts: Column, n: int | None = fixed.TOP_TERMS_PER_ARTICLE) -> Column:
    """The n most frequent terms of a counts array, by (-tf, term); all of them for None."""
    keyed = F.transform(counts, lambda c: F.struct((-c["tf"]).alias("neg"), c["term"].alias("term")))
    return F.transform(
        F.sort_array(keyed) if n is None else F.slice(F.sort_array(keyed), 1, n),
        lambda k: F.struct(k["term"].alias("term"), (-k["neg"]).alias("tf")),
    )
