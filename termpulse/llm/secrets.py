"""Secret scans: a keyword automaton finds where a secret may start, anchored patterns look there alone, and tokens that
carry a checksum count only when it is right.

Kinds, in this order: ``assign`` (a value given to a password-like name), ``access`` (access key ids), ``hex`` (long runs
of hexadecimal digits), ``github`` and ``npm`` (tokens whose last six characters are the CRC-32 of the others in
base 62). Spans count code points; the end is exclusive. Base kinds are leftmost and without overlap within a kind.

Null text: empty, no spans. Extra columns stay; a column named like the added one stays too, and the added one gets
underscores in front. Repeated rows: each is scanned. Empty table: no rows.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termpulse.llm import common

KINDS = ("assign", "access", "hex", "github", "npm")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
CHECKED = {
    "github": (re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"), ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    "npm": (re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"), ("npm_",)),
}
#: Fewest characters of an assigned value, an access key id and a hexadecimal run.
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: Hexadecimal digits of a keyword: every long run begins with one of the 16 ** 4.
HEX_KEY = 4
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def checksum(text: str) -> str:
    """CRC-32 in base 62, six characters."""
    value, out = zlib.crc32(text.encode("ascii")), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        out = DIGITS[digit] + out
    return out


@lru_cache(maxsize=1)
def automaton():
    """Keywords of all kinds; a hit tells the kind and the keyword's length."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for name in NAMES:
        for letters in itertools.product(*({c, c.upper()} for c in name)):
            found.add_word("".join(letters), (0, len(name)))
    found.add_word("AKIA", (1, 4))
    for digits in itertools.product("0123456789abcdef", repeat=HEX_KEY):
        found.add_word("".join(digits), (2, HEX_KEY))
    for kind, (_, keys) in CHECKED.items():
        for key in keys:
            found.add_word(key, (KINDS.index(kind), len(key)))
    found.make_automaton()
    return found


def scan(text: str) -> list[tuple[str, int, int]]:
    """Spans of one text by start, then kind."""
    free, spans = [0] * len(KINDS), []
    for last, (kind, n) in automaton().iter(text):
        start = last - n + 1
        if start < free[kind]:
            continue
        if kind == 2:
            # the first keyword of a run is its beginning
            end = HEX.match(text, start).end()
            good = end - start >= LEAST_HEX
        elif kind == 0:
            match = ASSIGN.match(text, start)
            if not match:
                continue
            end, good = match.end(), len(match[2]) >= LEAST_VALUE
        elif kind == 1:
            match = ACCESS.match(text, start)
            if not match:
                continue
            end, good = match.end(), match.end() - start >= LEAST_ACCESS
        else:
            match = CHECKED[KINDS[kind]][0].match(text, start)
            if not match:
                continue
            end, good = match.end(), checksum(match[1]) == match[2]
        free[kind] = end
        if good:
            spans.append((start, kind, end))
    return [(KINDS[kind], start, end) for start, kind, end in sorted(spans)]


def with_secrets(docs: DataFrame, text_col: str = "text", as_col: str = "secrets") -> DataFrame:
    """``docs`` with ``secrets``: array<struct<kind, start, end>>, scanned where the rows are."""
    name, at = common.free_name(docs, as_col), docs.columns.index(text_col)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end"), s)) for s in scan(v.as_py() or "")] for v in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, type=kind)], [*batch.schema.names, name])

    return docs.mapInArrow(scanned, T.StructType([*docs.schema.fields, T.StructField(name, SPANS)]))


def as_text(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
