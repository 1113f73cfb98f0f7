"""Packing of token pieces into sequences by minimum bin slack.

The fullest feasible combination of the available lengths is found by a subset-sum over a bitset, taken out as often as
the lengths allow, and so on until nothing is left. All pieces of one length are alike, so the search
works on the number of pieces of each length: at most ``capacity`` numbers, whatever the size of the input. The
pieces then find their place by their rank among those of their length.

Null text: empty document, which has the end id alone. Repeated rows: each is packed. Empty table: no rows. Extra
columns of ``pack`` stay, also where they share a name with a column that it adds (the added one gets underscores).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termpulse.llm import common, tokens

CAPACITY = 4096


def fill(available: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(length, how many) of a combination of ``available`` with the largest sum within ``room``."""
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted(available, reverse=True):
        left, take = min(available[length], room // length) if length <= room else 0, 1
        while left > 0:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= (reach << (take * length)) & mask
            left, take = left - take, 2 * take
        if reach >> room & 1:
            break
    best, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> best & 1:
            chosen[length] = chosen.get(length, 0) + take
            best -= take * length
    return list(chosen.items())


def patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """(how often, [(length, how many), ...]): bins of minimum slack until all pieces are placed.

    Each bin has the largest remaining piece. Every step uses up a length or leaves fewer of it than one bin takes.
    """
    left, out = dict(counts), []
    while left:
        largest = max(left)
        rest = {k: v - (k == largest) for k, v in left.items() if v - (k == largest) > 0}
        content = dict(fill(rest, capacity - largest))
        content[largest] = content.get(largest, 0) + 1
        times = min(left[k] // n for k, n in content.items())
        out.append((times, sorted(content.items(), reverse=True)))
        for k, n in content.items():
            left[k] -= times * n
            if not left[k]:
                del left[k]
    return out


def slots(plan: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first rank, how many in a bin, first sequence, first offset), by length and rank."""
    rows, used, sequence = [], {}, 0
    for times, content in plan:
        offset = 0
        for length, n in content:
            rows.append((length, used.get(length, 0), n, sequence, offset))
            used[length] = used.get(length, 0) + times * n
            offset += n * length
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, by_word: bool = True) -> DataFrame:
    """``doc_id, piece, start, length, ids``: ids with the end id as little-endian 32-bit numbers; only a document of
    more than ``capacity`` ids is cut."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokenizer, by_word)
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for doc_id, own in zip(batch.column(0).to_pylist(), encoder.encode_all(common.texts_of(batch, "text"))):
                ids = np.append(own, np.uint32(end_id)).astype("<u4")
                for k, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    for column, value in zip(columns, (doc_id, k, start, len(part), part.tobytes())):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids"])

    return common.documents(docs).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids binary")


def pack(rows: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """``rows`` with ``sequence_id`` and ``offset``; each row has a ``length`` from 1 to ``capacity``.

    ``rows`` is written once. A row's rank among its length is its rank within its task plus those of earlier tasks, so
    a length that very many rows share is ranked by all tasks.
    """
    spark = rows.sparkSession
    rows = common.stage(rows, "pieces")
    part, rank, base = (common.free_name(rows, n) for n in ("part", "rank", "base"))
    sequence_id, offset = common.free_name(rows, "sequence_id"), common.free_name(rows, "offset")
    at = rows.columns.index(length)

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, task = np.zeros(capacity + 1, dtype=np.int64), TaskContext.get().partitionId()
        for batch in batches:
            lengths = batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            if len(lengths) and not 1 <= lengths.min() <= lengths.max() <= capacity:
                raise ValueError(f"lengths must be from 1 to {capacity}")
            order = np.argsort(lengths, kind="stable")
            values, firsts, counts = np.unique(lengths[order], return_index=True, return_counts=True)
            ranks = np.empty(len(lengths), dtype=np.int64)
            ranks[order] = np.arange(len(lengths)) - np.repeat(firsts, counts) + seen[lengths[order]]
            seen[values] += counts
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(lengths), task, dtype=np.int32)), pa.array(ranks)], [*batch.schema.names, part, rank]
            )

    schema = T.StructType([*rows.schema.fields, T.StructField(part, T.IntegerType()), T.StructField(rank, T.LongType())])
    rows = common.stage(rows.mapInArrow(ranked, schema), "ranked-pieces")
    per_task = rows.groupBy(part, length).agg(F.count("*").alias(rank))
    earlier = Window.partitionBy(length).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.withColumn(base, F.coalesce(F.sum(rank).over(earlier), F.lit(0))).drop(rank)
    # at most ``capacity`` rows
    counts = {int(r[0]): int(r[1]) for r in rows.groupBy(length).agg(F.count("*")).collect()}
    table = slots(patterns(counts, capacity))
    own = [f for f in rows.schema.fields if f.name not in (part, rank)]
    kept_names = [f.name for f in own]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = (table[:, 0] << 44) | table[:, 1]
        for batch in batches:
            get = lambda name: batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False).astype(np.int64)
            lengths, ranks = get(length), get(rank) + get(base)
            row = table[np.searchsorted(keys, (lengths << 44) | ranks, side="right") - 1]
            k = ranks - row[:, 1]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in kept_names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(row[:, 3] + k // row[:, 2]), pa.array(row[:, 4] + k % row[:, 2] * lengths)], names)

    names = [*kept_names, sequence_id, offset]
    out = T.StructType([*own, T.StructField(sequence_id, T.LongType()), T.StructField(offset, T.LongType())])
    return rows.join(bases, [part, length]).mapInArrow(place, out)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, doc_ids, lengths, ids`` of packed pieces that carry ``ids``: one row for a sequence, its pieces in
    order. A sequence has at most ``capacity`` ids."""
    piece = F.struct("offset", "doc_id", "length", "ids")
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(piece)).alias("p"))
    return rows.select(
        "sequence_id", F.col("p.doc_id").alias("doc_ids"), F.col("p.length").alias("lengths"), F.unhex(F.array_join(F.transform("p", lambda x: F.hex(x["ids"])), "")).alias("ids")
    )
