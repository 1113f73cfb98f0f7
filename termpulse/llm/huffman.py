"""Token ids in a compressed binary form: canonical, length-limited Huffman codes from global counts.

``write`` encodes documents and writes them in ascending order of doc_id; ``read`` gives the ids back. A folder holds

* ``codes``: id and code length of every id that occurs; the canonical codes follow from them,
* ``blocks``: one row for a block of whole documents: ``part`` (number of the file range, ascending), ``start`` (ids
  before it in its part), ``doc_ids``, ``lengths`` (ids of each document) and ``frame``,
* ``parts``: the number of ids of each part.

A frame is, little-endian, the magic ``HUF1``, the number of ids and of checkpoints (unsigned 32-bit), the bit offset of
every ``CHECKPOINT``-th id (unsigned 64-bit), and the codes, highest bit first. Blocks are independent of each
other, and so are the runs between two checkpoints, which are decoded side by side from one table.

Null text: empty document. Null doc_id: before all others. Repeated doc_id: next to each other in order of their
ids' hash. Empty table: no blocks.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termpulse.llm import common, tokens

MAGIC = b"HUF1"
#: Ids from one bit offset to the next, and ids after which a block is closed at the next document.
CHECKPOINT, BLOCK_IDS = 256, 1 << 16
#: Longest code. Sixteen bits hold a code for each of 65,536 ids; more ids raise it as far as they need.
MAX_BITS = 16


# ---- codes


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Lengths of at most ``limit`` bits with the least total, by package-merge; all counts are positive."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, dtype=np.int64)
    limit = max(limit, int(n - 1).bit_length())
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    merged, levels = leaves, [np.ones(n, dtype=bool)]
    for _ in range(limit - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        by_weight = np.argsort(both, kind="stable")
        merged = both[by_weight]
        levels.append(by_weight < n)
    taken, lengths = 2 * n - 2, np.zeros(n, dtype=np.int64)
    for is_leaf in reversed(levels):
        own = int(is_leaf[:taken].sum())
        lengths[:own] += 1
        taken = 2 * (taken - own)
    result = np.empty(n, dtype=np.int64)
    result[order] = lengths
    return result


class Codes:
    """Canonical codes: shorter first, then by id."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        self.ids, self.lengths = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        self.bits = int(self.lengths[-1]) if len(ids) else 1
        steps = 1 << (self.bits - self.lengths)
        firsts = np.cumsum(steps) - steps
        self.codes = (firsts >> (self.bits - self.lengths)).astype(np.uint64)

    def of_ids(self) -> tuple[np.ndarray, np.ndarray]:
        """Code and length by id."""
        size = int(self.ids.max()) + 1 if len(self.ids) else 1
        code, length = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.int64)
        code[self.ids], length[self.ids] = self.codes, self.lengths
        return code, length

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Id and code length by the next ``bits`` bits."""
        steps = 1 << (self.bits - self.lengths)
        pad = (1 << self.bits) - int(steps.sum())
        ids = np.concatenate([np.repeat(self.ids, steps), np.zeros(pad, dtype=np.int64)]).astype(np.uint32)
        return ids, np.concatenate([np.repeat(self.lengths, steps), np.ones(pad, dtype=np.int64)])


def encode_frame(ids: np.ndarray, code: np.ndarray, length: np.ndarray) -> bytes:
    lengths = length[ids]
    ends = np.cumsum(lengths)
    at = ends - lengths
    total = int(ends[-1]) if len(ids) else 0
    words = np.zeros((total + 31) // 32 + 1, dtype=np.uint64)
    if len(ids):
        # a code of up to 32 bits lies in one or two words of 32 bits; codes that start in a word are added up
        shifted = code[ids] << (64 - (at & 31) - lengths).astype(np.uint64)
        word = at >> 5
        first = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[first]] |= np.add.reduceat(shifted >> np.uint64(32), first)
        words[word[first] + 1] |= np.add.reduceat(shifted & np.uint64(0xFFFFFFFF), first)
    checkpoints = at[::CHECKPOINT].astype("<u8")
    payload = words.astype(">u4").tobytes()[: (total + 7) // 8]
    return MAGIC + struct.pack("<II", len(ids), len(checkpoints)) + checkpoints.tobytes() + payload


def decode_frames(frames: list[bytes], table: tuple[np.ndarray, np.ndarray], bits: int) -> list[np.ndarray]:
    """Ids of each frame. All runs between checkpoints of all frames are decoded in step."""
    counts, lanes, payloads, before = [], [], [], 0
    for frame in frames:
        if frame[:4] != MAGIC:
            raise ValueError("not a block of this format")
        n, k = struct.unpack_from("<II", frame, 4)
        lanes.append(np.frombuffer(frame, dtype="<u8", count=k, offset=12).astype(np.int64) + 8 * before)
        payload = frame[12 + 8 * k :]
        payloads.append(payload)
        before += len(payload)
        counts.append((n, k))
    data = np.frombuffer(b"".join(payloads) + bytes(CHECKPOINT * 8 + 8), dtype=np.uint8).astype(np.uint32)
    window = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    at = np.concatenate(lanes) if lanes else np.zeros(0, dtype=np.int64)
    ids, lengths = table
    out = np.empty((CHECKPOINT, len(at)), dtype=np.uint32)
    last = len(window) - 1
    for step in range(CHECKPOINT):
        index = (window[np.minimum(at >> 3, last)].astype(np.int64) >> (32 - bits - (at & 7))) & ((1 << bits) - 1)
        out[step] = ids[index]
        at = at + lengths[index]
    out, done, lane = out.T, [], 0
    for n, k in counts:
        done.append(np.ascontiguousarray(out[lane : lane + k]).reshape(-1)[:n])
        lane += k
    return done


# ---- jobs


def _width(path: str) -> np.dtype:
    from tokenizers import Tokenizer

    return np.dtype("<u2") if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else np.dtype("<u4")


def token_table(docs: DataFrame, tokenizer: str, end_id: int, by_word: bool = True) -> DataFrame:
    """``doc_id`` and ``ids``: the ids with the end id, two bytes each where the vocabulary allows, else four."""
    width = _width(tokenizer)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokenizer, by_word)
        for batch in batches:
            ids = [np.append(own, np.uint32(end_id)).astype(width).tobytes() for own in encoder.encode_all(common.texts_of(batch, "text"))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, type=pa.binary())], ["doc_id", "ids"])

    return common.documents(docs).mapInArrow(encode, "doc_id long, ids binary")


def id_counts(token_rows: DataFrame, width: np.dtype) -> DataFrame:
    """``id, n`` over all documents; a task sends a row for each id that it met."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, dtype=np.int64)
        for batch in batches:
            for value in batch.column(0):
                own = np.bincount(np.frombuffer(value.as_buffer(), dtype=width))
                if len(own) > len(total):
                    total = np.concatenate([total, np.zeros(len(own) - len(total), dtype=np.int64)])
                total[: len(own)] += own
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met], pa.int64())], ["id", "n"])

    return token_rows.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


BLOCKS = "part int, start long, n_ids long, doc_ids array<long>, lengths array<int>, frame binary"


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, by_word: bool = True) -> None:
    """Encode ``docs`` (doc_id, text) and write the folder ``path``."""
    spark, width = docs.sparkSession, _width(tokenizer)
    rows = common.stage(token_table(docs, tokenizer, end_id, by_word), "token-ids")
    # as many rows as the vocabulary has ids
    counts = id_counts(rows, width).toPandas().sort_values("id")
    ids, lengths = counts["id"].to_numpy(np.int64), code_lengths(counts["n"].to_numpy(np.int64))
    spark.createDataFrame([(int(i), int(n)) for i, n in zip(ids, lengths)], "id long, length int").coalesce(1).write.parquet(f"{path}/codes")
    code, length = Codes(ids, lengths).of_ids()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start, doc_ids, held, n = TaskContext.get().partitionId(), 0, [], [], 0

        def block() -> pa.RecordBatch:
            frame = encode_frame(np.concatenate(held).astype(np.int64), code, length)
            columns = [[part], [start], [n], [doc_ids], [[len(x) for x in held]], [frame]]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "start", "n_ids", "doc_ids", "lengths", "frame"])

        for batch in batches:
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc_ids.append(doc_id)
                held.append(np.frombuffer(value.as_buffer(), dtype=width))
                n += len(held[-1])
                if n >= BLOCK_IDS:
                    yield block()
                    start, doc_ids, held, n = start + n, [], [], 0
        if held:
            yield block()

    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("ids")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    ordered.mapInArrow(encode, BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")
    spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n_ids")).coalesce(1).write.parquet(f"{path}/parts")
    common.remove(spark, rows)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` of a folder: ``start`` counts the ids before the document, ``ids`` is array<long>."""
    return decoded(spark, path, "doc_id long, start long, ids array<long>", lambda ids: ids.astype(np.int64))


def decoded(spark: SparkSession, path: str, schema: str, finish) -> DataFrame:
    """``doc_id, start`` and ``finish(ids)`` (one column or a tuple of them) of each document of a folder."""
    codes_rows = spark.read.parquet(f"{path}/codes").toPandas()
    codes = Codes(codes_rows["id"].to_numpy(np.int64), codes_rows["length"].to_numpy(np.int64))
    # one number for each file range
    parts = spark.read.parquet(f"{path}/parts").orderBy("part").collect()
    base, before = {}, 0
    for row in parts:
        base[row.part], before = before, before + row.n_ids
    names = [piece.split()[0] for piece in schema.split(", ")]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = codes.table()
        for batch in batches:
            for first in range(0, batch.num_rows, 16):
                some = batch.slice(first, 16).to_pylist()
                doc_ids, starts, results = [], [], []
                for block, ids in zip(some, decode_frames([b["frame"] for b in some], table, codes.bits)):
                    lengths = np.array(block["lengths"], dtype=np.int64)
                    ends = np.cumsum(lengths)
                    doc_ids += block["doc_ids"]
                    starts += (base[block["part"]] + block["start"] + ends - lengths).tolist()
                    for a, b in zip((ends - lengths).tolist(), ends.tolist()):
                        got = finish(ids[a:b])
                        results.append(got if isinstance(got, tuple) else (got,))
                columns = [doc_ids, starts, *map(list, zip(*results))]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) if i < 2 else pa.array(c) for i, c in enumerate(columns)], names)

    return spark.read.parquet(f"{path}/blocks").select("part", "start", "doc_ids", "lengths", "frame").mapInArrow(decode, schema)
