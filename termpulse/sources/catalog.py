"""Source catalog and word lists: small configuration read by the driver."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Entries of a list that becomes part of a column expression; longer ones are tables (``load_block_list``).
MAX_LIST_ENTRIES = 100_000

SOURCE_SCHEMA = (
    "source_id string, source_type string, source_ord bigint, name string, author string, url string, feed string, "
    "archive_url string, sitemap_url string, issue_path_prefix string, handle string, nitter_feed string, "
    "min_likes bigint, exclude_replies boolean, x_api boolean, added string"
)


def load_word_list(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Lowercase entries of a text file, one per line, without blank and # lines."""
    lines = spark.read.text(path).where(~F.col("value").startswith("#")).select(F.lower(F.trim("value")).alias("w"))
    rows = lines.where(F.col("w") != "").distinct().limit(MAX_LIST_ENTRIES + 1).collect()
    if len(rows) > MAX_LIST_ENTRIES:
        raise ValueError(f"{path}: more than {MAX_LIST_ENTRIES} entries is no word list")
    return tuple(sorted(r.w for r in rows))


def load_block_list(spark: SparkSession, path: str) -> DataFrame:
    """``host`` of a text file, one per line, without blank and # lines; of any length, for ``dedupe.drop_blocked``."""
    lines = spark.read.text(path).where(~F.col("value").startswith("#")).select(F.lower(F.trim("value")).alias("host"))
    return lines.where(F.col("host") != "").distinct()


def parse_sources(document: dict | None) -> list[dict]:
    document = document or {}
    if document.get("version") != 1:
        raise ValueError(f"unsupported catalog version: {document.get('version')!r}")
    sources = document.get("sources") or []
    if not isinstance(sources, list):
        raise ValueError("catalog: 'sources' must be a list")
    return sources


def load_sources(path: str) -> list[dict]:
    """Read a YAML (where the parser is installed) or JSON catalog file."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith((".yml", ".yaml")):
        try:
            import yaml
        except ImportError as error:
            raise RuntimeError("reading a YAML catalog needs the yaml package; use JSON") from error
        return parse_sources(yaml.safe_load(text))
    return parse_sources(json.loads(text))


def sources_frame(spark: SparkSession, sources: list[dict]) -> DataFrame:
    """The catalog as a table in file order; a repeated id keeps its first entry."""
    if len(sources) > MAX_LIST_ENTRIES:
        raise ValueError(f"catalog has more than {MAX_LIST_ENTRIES} sources")
    rows, seen = [], set()
    for order, s in enumerate(sources):
        if s["id"] in seen:
            continue
        seen.add(s["id"])
        rows.append(
            (
                s["id"], s.get("type"), order, s.get("name"), s.get("author"), s.get("url"), s.get("feed"),
                s.get("archive_url"), s.get("sitemap_url"), s.get("issue_path_prefix"), s.get("handle"),
                s.get("nitter_feed"), int(s.get("min_likes") or 0), bool(s.get("exclude_replies")),
                bool(s.get("x_api")), str(s["added"]) if s.get("added") else None,
            )
        )
    return spark.createDataFrame(rows, SOURCE_SCHEMA)
