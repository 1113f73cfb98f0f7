"""Small inputs and plain versions that the operators are compared with."""

from __future__ import annotations

import os

import duckdb
import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, as further columns of the input.
CLASHING = ("row", "fp", "part", "rank", "base", "secrets", "sequence_id", "offset", "keep_id", "upper", "letters", "h", "q")


def table(name: str, sf: str = SF) -> list[tuple]:
    return duckdb.connect().execute(f"SELECT * FROM read_parquet('{sf}/{name}.parquet')").fetchall()


def texts(sf: str = SF) -> list[tuple[int, str]]:
    return [(r[0], r[1] or "") for r in table("documents", sf)]


def prose(seed: int, n: int) -> str:
    return " ".join(f"w{(seed * 7919 + k * k * 31 + k) % 100003}" for k in range(n))


def edge_rows() -> list[tuple]:
    """Null, empty, blank and very long texts, null ids, ties and repeated rows."""
    long_text = prose(5, 30000)
    return [
        (1, prose(1, 120), "en", "a", 10),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, " \n\t ", "en", "a", 4),
        (None, prose(2, 80), "en", "b", 5),
        (5, prose(1, 120), "en", "a", 10),
        (5, prose(1, 120), "en", "a", 10),
        (6, long_text, "en", "a", 9),
        (7, long_text + " end", "en", "a", 9),
        (8, "x" * 50000, "en", "a", 9),
        (9, "password = hunter2hunter2 é\U0001f642 done", "en", "a", 9),
        (10, "One", "en", "a", 3),
    ]


def frame(spark, rows, clashing: bool = False):
    df = spark.createDataFrame(rows, SCHEMA)
    if clashing:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("kept") for c in CLASHING})
    return df


def root_of(parent: dict, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x
