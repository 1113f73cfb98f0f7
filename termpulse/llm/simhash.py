"""Near-duplicates by SimHash, compared bit by bit over many fingerprints at once.

A document's fingerprint has a bit for each of the 64 bits of its shingles' hashes: 1 if over half have it. Different
fingerprints meet in a bucket when some of their blocks of bits are equal: with ``blocks`` blocks of which ``equal``
must agree, every pair that differs in at most ``blocks - equal`` bits meets. A bucket's fingerprints are stored as bit
planes; the distances to 64 of them at a time are counted in carry-save counters, and a row is abandoned
once all of it exceeds the radius. Groups are the connected components of the links.

A bucket of more than ``CHUNK`` fingerprints is split into chunks that are compared two by two in separate groups, so
that no task holds a whole large bucket; for ``groups``, equal fingerprints count once from the start. A group yields a
spanning forest of its links, not all of them.

``deduplicate`` keeps of each group the row with the smallest doc_id. Its bar is the bit distance alone, so texts of one
frequent shingle (whose hash is then their fingerprint) are one group, as in ``groups``.

Null or blank text: fingerprint zero. Null doc_id: takes part, and names no component unless all of it is null. Repeated
rows: each has its own row. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termpulse.llm import common
from termpulse.llm.components import components, stars

SEED, WORDS, RADIUS, BLOCKS, EQUAL = 42, 3, 2, 4, 2
#: Fingerprints of a bucket that are compared in one go (twice as many in a split bucket).
CHUNK = 2048
#: Hashes added up at once.
SUMMED = 1 << 16


# ---- fingerprints


def shingles(text: str, words: int) -> list[bytes]:
    """Runs of ``words`` words, lower-cased in A-Z; the whole sequence if there are fewer."""
    parts = text.encode("utf-8").lower().split()
    if not parts:
        return []
    if len(parts) <= words:
        return [b" ".join(parts)]
    whole = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return [whole[a:b] for a, b in zip(starts[: len(parts) - words + 1].tolist(), ends[words - 1 :].tolist())]


def bit_totals(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each bit, lowest first: carry-save addition of three words to a sum and a carry."""
    totals, level, weight = np.zeros(64, dtype=np.int64), [hashes], 1
    while level:
        carries: list[np.ndarray] = []
        words = np.concatenate(level)
        while len(words) > 2:
            n = len(words) // 3
            a, b, c = words[:n], words[n : 2 * n], words[2 * n : 3 * n]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate([half ^ c, words[3 * n :]])
        totals += weight * np.unpackbits(words.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        level, weight = carries, 2 * weight
    return totals


def fingerprint(text: str, words: int = WORDS) -> int:
    parts = shingles(text, words)
    totals = np.zeros(64, dtype=np.int64)
    for first in range(0, len(parts), SUMMED):
        some = parts[first : first + SUMMED]
        totals += bit_totals(np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in some), dtype=np.uint64, count=len(some)))
    return int(np.packbits((2 * totals > len(parts)) & (len(parts) > 0), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = WORDS, row: str | None = None) -> DataFrame:
    """``row, doc_id, fp`` (fp: the 64 bits as a signed long); ``row`` names a column that numbers the rows already."""
    number = F.col(row) if row else F.monotonically_increasing_id()
    rows = docs.select(number.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, words) for t in common.texts_of(batch, "text")], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], ["row", "doc_id", "fp"])

    return rows.mapInArrow(marked, "row long, doc_id long, fp long")


# ---- comparison


def planes(values: np.ndarray) -> np.ndarray:
    """64 rows of words: bit b of value 64 * w + i is bit i of word w in row b."""
    padded = np.zeros(-(-len(values) // 64) * 64, dtype=np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def beyond(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """A bit for each lane whose counter is above ``radius``."""
    more, same = over.copy(), ~over
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            same &= counters[k]
        else:
            more |= same & counters[k]
            same &= ~counters[k]
    return more


def neighbours(values: np.ndarray, radius: int, rows: slice) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Of the values in ``rows``: their indexes that were not abandoned, and the counters of their lanes."""
    own, columns = values[rows], planes(values)
    index = np.arange(rows.start, rows.start + len(own))
    wide = columns.shape[1]
    counters = [np.zeros((len(own), wide), dtype=np.uint64) for _ in range(radius.bit_length() + 1)]
    over = np.zeros((len(own), wide), dtype=np.uint64)
    lanes = np.full(wide, ~np.uint64(0))
    if len(values) % 64:
        lanes[-1] = (np.uint64(1) << np.uint64(len(values) % 64)) - np.uint64(1)
    own_lane = np.zeros((len(own), wide), dtype=np.uint64)
    own_lane[np.arange(len(own)), index >> 6] = np.uint64(1) << (index & 63).astype(np.uint64)
    for plane in range(64):
        bits = (own >> np.uint64(plane)) & np.uint64(1)
        carry = columns[plane][None, :] ^ (~bits + np.uint64(1))[:, None]
        for k in range(len(counters)):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if plane % 8 == 7:
            near = ((~beyond(counters, over, radius)) & lanes & ~own_lane).any(axis=1)
            if not near.all():
                own, index, over, own_lane = own[near], index[near], over[near], own_lane[near]
                counters = [c[near] for c in counters]
                if not len(own):
                    break
    return index, counters, over | ~lanes | own_lane


def bucket_links(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Index pairs that join up all values within ``radius`` of each other: a forest, one pair for each value at most."""
    n, out = len(values), []
    near: dict[int, np.ndarray] = {}
    for first in range(0, n, 1024):
        index, counters, over = neighbours(values, radius, slice(first, min(n, first + 1024)))
        if len(index):
            near.update(zip(index.tolist(), ~beyond(counters, over, radius)))
    unseen = np.zeros(-(-n // 64) * 64, dtype=np.uint8)
    unseen[list(near)] = 1
    unseen = np.packbits(unseen, bitorder="little").view(np.uint64)
    for start in near:
        if not int(unseen[start >> 6]) >> (start & 63) & 1:
            continue
        unseen[start >> 6] &= ~(np.uint64(1) << np.uint64(start & 63))
        queue = [start]
        while queue:
            at = queue.pop()
            fresh = near[at] & unseen
            reached = np.flatnonzero(np.unpackbits(fresh.view(np.uint8), bitorder="little")).tolist()
            unseen &= ~fresh
            out += ((at, x) for x in reached)
            queue += reached
    return out


def small_links(values: np.ndarray, bucket: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Index pairs within ``radius`` in the same bucket; ``values`` stand by bucket, and buckets are small."""
    out, shift = [], 1
    while True:
        first = np.flatnonzero(bucket[shift:] == bucket[:-shift]) if shift < len(bucket) else np.zeros(0, dtype=np.int64)
        if not len(first):
            return out
        differing = planes(values[first] ^ values[first + shift])
        counters = [np.zeros(differing.shape[1], dtype=np.uint64) for _ in range(radius.bit_length() + 1)]
        over = np.zeros(differing.shape[1], dtype=np.uint64)
        for carry in differing:
            for k in range(len(counters)):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            over |= carry
        hit = np.flatnonzero(np.unpackbits((~beyond(counters, over, radius)).view(np.uint8), bitorder="little")[: len(first)])
        out += zip(first[hit].tolist(), (first[hit] + shift).tolist())
        shift += 1


#: Buckets up to this size are compared side by side.
SMALL = 32


def links(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, equal: int = EQUAL, chunk: int = CHUNK) -> DataFrame:
    """``a, b``: links between the different fingerprints of ``fps`` (column fp, staged) that keep their components."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    bits = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(blocks)]
    masks = [sum(some) for some in combinations(bits, equal)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    kinds = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("v")) for t, m in enumerate(masks)])
    keyed = fps.select("fp", F.explode(kinds).alias("k")).select("fp", "k.t", "k.v")
    sizes = common.stage(keyed.groupBy("t", "v").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    parts = F.ceil(F.col("n") / chunk).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("m")).cast("int")
    others = F.when(F.col("m") == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("m") - 1), lambda j: j != F.col("own")))
    cells = keyed.join(sizes, ["t", "v"]).withColumn("m", parts).withColumn("own", own)
    cells = cells.select("t", "v", "fp", "own", F.explode(others).alias("other"))
    cells = cells.select("t", "v", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    key = ["t", "v", "i", "j"]
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cells.repartition(n, *key).sortWithinPartitions(*key)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: np.ndarray | None = None

        def pairs_of(rows: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.concatenate([[True], (rows[1:, :4] != rows[:-1, :4]).any(axis=1)]))
            sizes_ = np.diff(np.append(starts, len(rows)))
            values, found = rows[:, 4].copy().view(np.uint64), []
            is_small = np.repeat(sizes_ <= SMALL, sizes_)
            if is_small.any():
                at = np.flatnonzero(is_small)
                bucket = np.repeat(np.arange(len(starts)), sizes_)[at]
                found += [(int(at[x]), int(at[y])) for x, y in small_links(values[at], bucket, radius)]
            for start, size in zip(starts.tolist(), sizes_.tolist()):
                if size > SMALL:
                    found += [(start + x, start + y) for x, y in bucket_links(values[start : start + size], radius)]
            index = np.array(found, dtype=np.int64).reshape(-1, 2)
            ends = np.sort(rows[:, 4][index], axis=1)
            ends = np.unique(ends[ends[:, 0] != ends[:, 1]], axis=0)
            return pa.RecordBatch.from_arrays([pa.array(ends[:, 1]), pa.array(ends[:, 0])], ["a", "b"])

        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
            rows = rows if rest is None else np.concatenate([rest, rows])
            if not len(rows):
                continue
            # the last bucket may go on in the next batch
            cut = np.flatnonzero((rows[:, :4] != rows[-1, :4]).any(axis=1))
            done = int(cut[-1]) + 1 if len(cut) else 0
            if done:
                yield pairs_of(rows[:done])
            rest = rows[done:]
        if rest is not None and len(rest):
            yield pairs_of(rest)

    return dealt.mapInArrow(compare, "a long, b long").distinct()


def grouped(marked: DataFrame, found: DataFrame) -> DataFrame:
    """``row, doc_id, fp, component_id, root`` from staged fingerprints and the links between them."""
    roots = components(found).withColumnRenamed("node", "fp")
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    labelled = nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    labelled = common.stage(labelled, "labelled")
    names = common.stage(labelled.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    # staged, so that the join of a fingerprint that very many documents have can be split
    by_key = common.stage(labelled.join(names, "root").select("fp", "root", "component_id"), "component-of")
    return marked.join(by_key, "fp").select("row", "doc_id", "fp", "component_id", "root")


def groups(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, blocks: int = BLOCKS, equal: int = EQUAL, row: str | None = None) -> DataFrame:
    """``row, doc_id, fp, component_id, root`` of every row: documents whose fingerprints are linked share a component,
    named by its smallest doc_id."""
    marked = common.stage(fingerprints(docs, words, row), "fingerprints")
    different = common.stage(marked.select("fp").distinct(), "different-fingerprints")
    return grouped(marked, links(different, radius, blocks, equal))


def deduplicate(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, blocks: int = BLOCKS, equal: int = EQUAL) -> DataFrame:
    """The rows of ``docs``, with all their columns: of each group of near-duplicates the one with the smallest doc_id."""
    written, row = common.numbered_files(docs, "numbered")
    members = groups(written, words, radius, blocks, equal, row)
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    stay = members.groupBy("root").agg(F.min(rank).alias("best")).select("best.row")
    return common.kept_rows(written, row, stay)
