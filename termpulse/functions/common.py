"""Small column helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four separators that Python's str methods also strip.
SPACE = r"[\s\x1c-\x1f]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def xml_text(text: Column) -> Column:
    """Resolve the five references that plain XML has."""
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("amp", "&")):
        text = F.replace(text, F.lit(f"&{name};"), F.lit(char))
    return text


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def first_match(items: Column, test: Callable[[Column], Column]) -> Column:
    return F.get(F.filter(items, test), F.lit(0))
