"""Benchmark decontamination: MinHash containment search over items partitioned by size, then exact shingle containment.

An item is contained in a document when at least ``THRESHOLD`` of its different five-word shingles (words between white
space, lower-cased in A-Z; a shorter text is one shingle) occur there. Items are partitioned by their number of shingles,
each partition up to a power of two ``u``. A document is searched in windows of ``2 * u`` shingles, one every ``u``, so
an item lies within one window, however long the document is; the window's size against the partition's bound keeps the
resemblance of the two above 0.19 for every contained item of five or more shingles. A window and an item that agree in any of
``HASHES`` minima are compared (a miss has a chance of about 1e-6 at the very worst, and far less for full copies). Items of
fewer shingles are looked up by each of their shingles' hashes, without a chance of a miss. Every candidate is verified
on the texts of its shingles.

Items are held in blocks of at most ``BLOCK_ITEMS``, each sent to the tasks and searched in a pass of its own; documents
are not shuffled. Null or blank text, of a document or item: no shingles, contained in nothing. Repeated rows: each is
searched, each is reported. Null ids: reported as null. Empty tables: no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termpulse.llm import common
from termpulse.llm.wordhash import Rolling, word_hashes

WORDS, THRESHOLD, HASHES, LEAST_BOUND = 5, 0.8, 64, 8
#: Items of fewer different shingles are looked up by shingle, not by minima.
FEW = 5
#: Items that one pass over the documents looks for; their shingles are at most some ten MB.
BLOCK_ITEMS = 20_000
#: Shingles hashed at once, in all orders.
HASHED = 1 << 10


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").lower().split()


def shingle_hashes(words: list[bytes], k: int) -> np.ndarray:
    if not words:
        return np.zeros(0, dtype=np.uint64)
    return Rolling(word_hashes(words)).windows(min(k, len(words)))


def shingle_set(words: list[bytes], k: int) -> set[bytes]:
    if len(words) <= k:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)}


class Minima:
    """``HASHES`` orders of 32-bit values, and the least values of runs of shingles in each."""

    def __init__(self, n: int = HASHES, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.a = rng.integers(1 << 31, size=n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.b = rng.integers(1 << 32, size=n, dtype=np.uint32)

    def of_blocks(self, hashes: np.ndarray, size: int) -> np.ndarray:
        """Row p: the least value of order p in each run of ``size`` hashes (the last run may be shorter)."""
        blocks = -(-len(hashes) // size)
        padded = np.concatenate([hashes, np.repeat(hashes[-1:], blocks * size - len(hashes))])
        folded = (padded >> np.uint64(32)).astype(np.uint32).reshape(blocks, size)
        out = np.empty((len(self.a), blocks), dtype=np.uint32)
        step = max(1, HASHED // size)
        for first in range(0, blocks, step):
            some = np.ascontiguousarray(folded[first : first + step].T)
            value = some[None] ^ self.b[:, None, None]
            value *= self.a[:, None, None]
            value ^= value >> np.uint32(15)
            out[:, first : first + step] = value.min(axis=1)
        return out


class Search:
    """Looks for one block of items."""

    def __init__(self, items: list[tuple[object, str | None]], words: int = WORDS, threshold: float = THRESHOLD):
        self.words, self.threshold, self.minima = words, threshold, Minima()
        self.items = [(item_id, shingle_set(words_of(text), words)) for item_id, text in items]
        self.bounds: dict[int, dict[tuple[int, int], list[int]]] = {}
        self.coarse: dict[int, np.ndarray] = {}
        #: Items below ``FEW`` shingles by each of their hashes, and these hashes in order.
        self.few: dict[int, list[int]] = defaultdict(list)
        for k, (_, text) in enumerate(items):
            hashes = np.unique(shingle_hashes(words_of(text), words))
            if not len(hashes):
                continue
            if len(hashes) < FEW:
                for value in hashes.tolist():
                    self.few[value].append(k)
                continue
            bound = max(LEAST_BOUND, 1 << int(len(hashes) - 1).bit_length())
            values = self.minima.of_blocks(hashes, len(hashes))[:, 0]
            for p, value in enumerate(values.tolist()):
                self.bounds.setdefault(bound, defaultdict(list))[p, value].append(k)
        for bound, keys in self.bounds.items():
            marked = np.zeros(HASHES << 16, dtype=bool)
            for p, value in keys:
                marked[(p << 16) + (value >> 16)] = True
            self.coarse[bound] = marked
        self.few_hashes = np.array(sorted(self.few), dtype=np.uint64)
        self.rows = np.arange(HASHES, dtype=np.uint32)[:, None] << np.uint32(16)

    def candidates(self, words: list[bytes]) -> set[int]:
        hashes = shingle_hashes(words, self.words)
        if not len(hashes):
            return set()
        found: set[int] = set()
        if self.few:
            for value in hashes[np.isin(hashes, self.few_hashes)].tolist():
                found.update(self.few[value])
        if not self.bounds:
            return found
        size, blocks = LEAST_BOUND, self.minima.of_blocks(hashes, LEAST_BOUND)
        for bound in range(LEAST_BOUND.bit_length() - 1, max(self.bounds, default=1).bit_length()):
            if 1 << bound > size:
                # two runs make one of the next partition
                if blocks.shape[1] % 2:
                    blocks = np.concatenate([blocks, blocks[:, -1:]], axis=1)
                blocks, size = np.minimum(blocks[:, ::2], blocks[:, 1::2]), 1 << bound
            if size in self.bounds:
                windows = np.minimum(blocks[:, :-1], blocks[:, 1:]) if blocks.shape[1] > 1 else blocks
                keys = self.bounds[size]
                hit = np.flatnonzero(self.coarse[size].take((windows >> np.uint32(16)) + self.rows))
                for p, value in zip((hit // windows.shape[1]).tolist(), windows.ravel()[hit].tolist()):
                    found.update(keys.get((p, value), ()))
        return found

    def matches(self, text: str | None) -> list[tuple[object, int, int]]:
        """(item id, its shingles, those in the text) of the items that the text contains."""
        words = words_of(text)
        found = self.candidates(words)
        if not found:
            return []
        own, out = shingle_set(words, self.words), []
        for k in sorted(found):
            item_id, wanted = self.items[k]
            shared = len(wanted & own)
            if shared >= self.threshold * len(wanted):
                out.append((item_id, len(wanted), shared))
        return out


def item_blocks(benchmark: DataFrame, size: int = BLOCK_ITEMS) -> Iterator[list[tuple[object, str | None]]]:
    """The items in blocks of at most ``size``; the driver holds one block at a time."""
    held = []
    for row in benchmark.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        held.append((row[0], row[1]))
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def contained(docs: DataFrame, benchmark: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_shared``: a row for every document and item that it contains."""
    schema = "doc_id long, item_id long, n_shingles long, n_shared long"

    def searched(items: list) -> DataFrame:
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            looking = Search(items, words, threshold)
            for batch in batches:
                rows = [(d, *m) for d, t in zip(batch.column(0).to_pylist(), batch.column(1)) for m in looking.matches(t.as_py())]
                columns = list(zip(*rows)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "n_shingles", "n_shared"])

        return common.documents(docs).mapInArrow(search, schema)

    found = [searched(items) for items in item_blocks(benchmark, block_items)]
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that contain no item."""
    at, schema = docs.columns.index("text"), T.StructType(docs.schema.fields)
    for items in item_blocks(benchmark, block_items):

        def clean(batches: Iterator[pa.RecordBatch], items: list = items) -> Iterator[pa.RecordBatch]:
            looking = Search(items, words, threshold)
            for batch in batches:
                yield batch.filter(pa.array([not looking.matches(t.as_py()) for t in batch.column(at)], pa.bool_()))

        docs = docs.mapInArrow(clean, schema)
    return docs
