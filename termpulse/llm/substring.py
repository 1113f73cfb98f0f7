"""Substring de-duplication by level-wise doubling.

A window is ``window`` words of one document. A word is removed when a window over it also starts in a document with a
smaller doc_id. Repeats are found at a quarter of the length, then at half of it, then at the full length, and only what
is repeated at one length is extended to the next:

1. Of each window the run of a quarter of its words with the least hash (the first of equal ones) is its anchor. Equal
   windows have equal anchors at equal places, so windows whose anchor is in one document only are no repeats.
   An anchor serves some twenty neighbouring windows, so about one record for twenty words is shuffled.
2. Anchors that more than one document has are extended to half the length on either side; one of the two extensions lies
   in every window of the anchor and must be repeated, too.
3. Those left are extended by all words that windows of the anchor can reach. Where such a surrounding is
   repeated, all windows of the anchor are. Of each different surrounding only those in its first document are left, and their
   windows of full length are compared one by one.

Documents are written once, dealt by row, and read from there at each level without another shuffle; texts are never
grouped. Keys at the last levels are two independent 64-bit hashes together.

Null text: no words. Null doc_id: never removed from, and never a reason to remove. Rows that share a doc_id: judged
each for itself, not against each other. Fewer words than a window: nothing removed. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termpulse.llm import common
from termpulse.llm.wordhash import Rolling, mixed, word_hashes

WINDOW = 50


def rolling(text: str) -> tuple[int, Rolling]:
    words = text.encode("utf-8").split()
    return len(words), Rolling(word_hashes(words))


def first_least(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the first least of each run of ``width`` values."""
    best, at, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        right = best[step:] < best[:-step]
        best, at = np.where(right, best[step:], best[:-step]), np.where(right, at[step:], at[:-step])
        have += step
    return at


def anchors(hashes: Rolling, n: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Place and hash of each anchor, and its first and last window."""
    short = -(-window // 4)
    if n < window:
        none = np.zeros(0, dtype=np.int64)
        return none, none.astype(np.uint64), none, none
    own = hashes.windows(short)
    at = first_least(own, window - short + 1)
    starts = np.flatnonzero(np.diff(at, prepend=-1))
    return at[starts], own[at[starts]], starts, np.append(starts[1:], len(at)) - 1


class Level:
    """Documents as written for all levels, and what of them is still a candidate."""

    def __init__(self, docs: DataFrame, row: str | None):
        number = F.col(row) if row else F.monotonically_increasing_id()
        rows = docs.select(number.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        self.texts = common.dealt(rows, "row", "texts")

    def each(self, rows: DataFrame, schema: str, found: Callable, columns: tuple[str, ...]) -> DataFrame:
        """``row, doc_id`` and the arrays that ``found(text, *lists)`` gives for each row of ``rows``, which has the text
        and, for each name in ``columns``, a list."""
        names = [p.split()[0] for p in schema.split(", ")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                get = lambda name: batch.column(batch.schema.get_field_index(name))
                lists = [[v.values.to_numpy(zero_copy_only=False) for v in get(c)] for c in columns]
                ids, doc_ids, held, sizes = get("row").to_pylist(), get("doc_id").to_pylist(), [], []
                for k, text in enumerate(common.texts_of(batch, "text")):
                    held.append(found(text, *[x[k] for x in lists]))
                    sizes.append(len(held[-1][0]))
                arrays = [pa.array(np.repeat(np.array(ids, dtype=np.int64), sizes)), pa.array(doc_ids, pa.int64()).take(pa.array(np.repeat(np.arange(len(ids)), sizes)))]
                for part in zip(*held):
                    part = np.concatenate(part)
                    arrays.append(pa.array(part.view(np.int64) if part.dtype == np.uint64 else part.astype(np.int64)))
                if held:
                    yield pa.RecordBatch.from_arrays(arrays, names)

        return rows.mapInArrow(run, schema)

    def again(self, candidates: DataFrame, columns: tuple[str, ...], schema: str, found: Callable) -> DataFrame:
        """``each`` over the texts that have candidates (row and ``columns``: long), a list of them for each text."""
        lists = candidates.groupBy("row").agg(F.collect_list(F.struct(*columns)).alias("c"))
        lists = lists.select("row", *[F.col(f"c.{c}").alias(c) for c in columns])
        return self.each(self.texts.join(lists, "row"), schema, found, columns)


def repeated(rows: DataFrame, *key: str) -> DataFrame:
    """Keys in documents with different ids, and the smallest id; summed before the shuffle, and written, so that a
    later join of a key with very many rows can be split."""
    sums = rows.groupBy(*key).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    return common.stage(sums.filter("first < last").select(*key, "first"), "repeated")


def removals(docs: DataFrame, window: int = WINDOW, row: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The written texts (row, doc_id, text) and ``row, lo, hi``: the first and last of windows in a row to be removed."""
    level = Level(docs, row)
    short, half, reach = -(-window // 4), -(-window // 2), window - -(-window // 4)
    base = "row long, doc_id long, q long, lo long, hi long, h long"

    def quarter(text: str) -> tuple:
        n, hashes = rolling(text)
        q, h, lo, hi = anchors(hashes, n, window)
        return q, lo, hi, h

    def halves(text: str, q: np.ndarray, lo: np.ndarray, hi: np.ndarray, h: np.ndarray) -> tuple:
        n, hashes = rolling(text)
        right = q + half <= n
        left = q + short - half >= 0
        keys = [mixed(hashes.runs(q[right], q[right] + half)), hashes.runs(q[left] + short - half, q[left] + short)]
        both = [np.concatenate([x[right], x[left]]) for x in (q, lo, hi, h)]
        return (*both, np.concatenate(keys))

    def surroundings(text: str, q: np.ndarray, lo: np.ndarray, hi: np.ndarray, h: np.ndarray) -> tuple:
        n, hashes = rolling(text)
        start, end = np.maximum(q - reach, 0), np.minimum(q + window, n)
        cut = ((q - start) * (2 * window) + (end - q)).astype(np.uint64)
        return q, lo, hi, h, mixed(hashes.runs(start, end) + cut)

    def windows(text: str, q: np.ndarray, lo: np.ndarray, hi: np.ndarray, h: np.ndarray) -> tuple:
        _, hashes = rolling(text)
        own = hashes.windows(window)
        at = common.ragged(lo, hi - lo + 1)
        return at, np.repeat(h, hi - lo + 1), own[at]

    first = common.stage(level.each(level.texts, base, quarter, ()), "anchors")
    left = first.join(repeated(first, "h"), "h", "left_semi")
    carried = ("q", "lo", "hi", "h")
    second = common.stage(level.again(left, carried, f"{base}, k long", halves), "halves")
    left = second.join(repeated(second, "k"), "k", "left_semi").select("row", *carried).distinct()
    third = common.stage(level.again(left, carried, f"{base}, c long", surroundings), "surroundings")
    classes = common.stage(third.groupBy("h", "c").agg(F.min("doc_id").alias("first")), "surrounding-classes")
    split = classes.groupBy("h").agg(F.min("first").alias("a"), F.max("first").alias("b")).filter("a < b").select("h")
    placed = third.join(classes, ["h", "c"])
    whole = placed.filter("doc_id > first").select("row", "lo", "hi")
    open_ = placed.filter("doc_id = first").join(common.stage(split, "split"), "h", "left_semi").select("row", *carried)
    fourth = common.stage(level.again(open_, carried, "row long, doc_id long, at long, h long, w long", windows), "windows")
    single = fourth.join(repeated(fourth, "h", "w"), ["h", "w"]).filter("doc_id > first").select("row", F.col("at").alias("lo"), F.col("at").alias("hi"))
    return level.texts, whole.unionByName(single)


def cleaned(docs: DataFrame, window: int = WINDOW, row: str | None = None) -> DataFrame:
    """``row, doc_id, n_words, n_removed, kept``: kept is the text of the words that stay, joined by one space."""
    texts, spans = removals(docs, window, row)
    lists = spans.groupBy("row").agg(F.collect_list(F.struct("lo", "hi")).alias("c")).select("row", F.col("c.lo").alias("lo"), F.col("c.hi").alias("hi"))
    schema = "row long, doc_id long, n_words long, n_removed long, kept string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda name: batch.column(batch.schema.get_field_index(name))
            totals, removed, kept = [], [], []
            for text, lo, hi in zip(common.texts_of(batch, "text"), get("lo"), get("hi")):
                words = text.encode("utf-8").split()
                totals.append(len(words))
                n = 0
                if lo.is_valid:
                    change = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(change, lo.values.to_numpy(zero_copy_only=False), 1)
                    np.add.at(change, hi.values.to_numpy(zero_copy_only=False) + window, -1)
                    stays = np.cumsum(change)[:-1] == 0
                    n = len(words) - int(stays.sum())
                    words = list(compress(words, stays.tolist()))
                removed.append(n)
                kept.append(b" ".join(words).decode("utf-8"))
            columns = [get("row"), get("doc_id"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n_words", "n_removed", "kept"])

    return texts.join(lists, "row", "left").mapInArrow(cut, schema)
