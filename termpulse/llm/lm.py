"""Language-model scoring with Brown classes.

Every word of the training documents gets one of ``CLASSES`` classes by exchange on the class bigrams. Words start in units
(each of the ``FREQUENT`` most frequent words, groups of the others by ending and length, the end of a document), whose classes
are exchanged until nothing moves. Then words leave their units: those that occur at least once in ``SHARE`` tokens move by
rounds, each to the class that raises the likelihood most while the others stay, and each rarer word joins the class
that its contexts in the corpus fit best. A word that no training document has keeps the class of its unit. The model is

    P(word | previous word) = MIX * P(class | previous class) * P(word | class) + (1 - MIX) * P(word)

with smoothed class transitions, word emissions from the counts of all training words, and the unigram base. One unknown
word stands for all unseen ones, so the probabilities after any word sum to one.

All counts are taken over all training documents by Spark. A round adds up, for each moving word, the classes before and after
it: tasks send blocks of these counts, and the words of a block are moved where their counts meet. What reaches the driver is
bounded by the model: units squared, classes squared, and the class of at most ``SHARE`` moving words. Rarer words are never
held whole: a task turns its documents into groups of about ``GROUP_TOKENS`` tokens with the list of their different words,
and the contexts of these meet by word.

Null text: empty, which is one end token. Null doc_id: its id as text is empty, so it is held out. Repeated rows: each
counts and is scored. No training document: every probability of an unseen token is one. Empty table: no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termpulse.llm import common

FREQUENT, ENDINGS, CLASSES, SWEEPS = 255, 256, 48, 20
#: Added to each count; weight of the class model; weight of the class shares in a transition.
ADDED, MIX, PRIOR = 0.1, 0.95, 10.0
GROUP_TOKENS = 1 << 21
#: A word of one in so many tokens moves by itself; countings of the rounds; words of a block.
SHARE, ROUNDS, BLOCK = 1 << 17, 6, 256
#: Entries that are packed at once.
PACKED = 1 << 20
#: The end of a document as a word: no word is empty.
END = b""


# ---- units and classes


def unit_of(word: bytes, frequent: dict[bytes, int]) -> int:
    """0 for the end, then the frequent words, then the endings."""
    if not word:
        return 0
    known = frequent.get(word)
    return known if known is not None else 1 + FREQUENT + zlib.crc32(word[-3:], min(len(word), 15) // 3) % ENDINGS


#: CRC-32 of one byte.
_CRC = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)


def units_of(words: list[bytes], frequent: dict[bytes, int]) -> np.ndarray:
    """``unit_of`` of all words at once."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    data, ends = np.frombuffer(b"".join(words), dtype=np.uint8), np.cumsum(sizes)
    found = ~(np.minimum(sizes, 15) // 3).astype(np.uint32)
    for back in (3, 2, 1):
        long = np.flatnonzero(sizes >= back)
        some = found[long]
        found[long] = _CRC[(some ^ data[ends[long] - back]) & 0xFF] ^ (some >> 8)
    out = np.where(sizes > 0, 1 + FREQUENT + (~found % ENDINGS).astype(np.int64), 0)
    known = np.fromiter((frequent.get(w, -1) for w in words), dtype=np.int64, count=len(words))
    return np.where((known >= 0) & (sizes > 0), known, out)


def _self_log(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def gains(joint: np.ndarray, after: np.ndarray, before: np.ndarray, own) -> np.ndarray:
    """What joining each class adds to the likelihood: of one or of many words (first axis), each left out of its ``joint``."""
    # other words are followed by it and follow it in any class
    out_total, in_total, turned = joint.sum(axis=-1) + before, joint.sum(axis=-2) + after, joint.swapaxes(-1, -2)
    gain = (_self_log(joint + after[..., None, :]) - _self_log(joint)).sum(axis=-1) + (_self_log(turned + before[..., None, :]) - _self_log(turned)).sum(axis=-1)
    d, own = np.diagonal(joint, axis1=-2, axis2=-1), np.asarray(own)[..., None]
    gain += _self_log(d + after + before + own) - _self_log(d + after) - _self_log(d + before) + _self_log(d)
    after, before = after.sum(axis=-1, keepdims=True), before.sum(axis=-1, keepdims=True)
    return gain - (_self_log(out_total + after + own) - _self_log(out_total) + _self_log(in_total + before + own) - _self_log(in_total))


def likelihood(joint: np.ndarray) -> float:
    """Of the class bigrams, besides what no class changes."""
    return float(_self_log(joint).sum() - _self_log(joint.sum(axis=0)).sum() - _self_log(joint.sum(axis=1)).sum())


def moved(joint: np.ndarray, cls: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The best class of each word while all others stay: ``counts`` are the classes after it, those before it, and itself after itself."""
    k, out = len(joint), cls.copy()
    for first in range(0, len(cls), 64):
        own_cls, some = cls[first : first + 64], counts[first : first + 64].astype(np.float64)
        at, own = np.arange(len(own_cls)), some[:, 2 * k]
        after, before = some[:, :k].copy(), some[:, k : 2 * k].copy()
        after[at, own_cls] -= own
        before[at, own_cls] -= own
        rest = np.repeat(joint[None], len(at), axis=0)
        rest[at, own_cls] -= after
        rest[at, :, own_cls] -= before
        rest[at, own_cls, own_cls] -= own
        gain = gains(rest, after, before, own)
        best = gain.argmax(axis=1)
        out[first : first + 64] = np.where(gain[at, best] > gain[at, own_cls] + 1e-9, best, own_cls)
    return out


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each unit from the counts ``pairs[a, b]`` of unit b after unit a."""
    n, totals = len(pairs), pairs.sum(axis=0) + pairs.sum(axis=1)
    cls = np.empty(n, dtype=np.int64)
    cls[np.argsort(-totals, kind="stable")] = np.arange(n) % classes
    one = np.zeros((n, classes))
    one[np.arange(n), cls] = 1
    pairs = pairs.astype(np.float64)
    joint, left, right = one.T @ pairs @ one, one.T @ pairs, pairs @ one  # left: class before unit; right: class after unit
    moving = [u for u in np.argsort(-totals, kind="stable").tolist() if totals[u]]
    for _ in range(sweeps):
        moved = 0
        for u in moving:
            a, own = int(cls[u]), pairs[u, u]
            after, before = right[u].copy(), left[:, u].copy()
            after[a] -= own
            before[a] -= own
            joint[a] -= after
            joint[:, a] -= before
            joint[a, a] -= own
            gain = gains(joint, after, before, own)
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = a
            joint[b] += after
            joint[:, b] += before
            joint[b, b] += own
            if b != a:
                moved += 1
                cls[u] = b
                left[a] -= pairs[u]
                left[b] += pairs[u]
                right[:, a] -= pairs[:, u]
                right[:, b] += pairs[:, u]
        if not moved:
            break
    return cls


@dataclass
class Model:
    """All that scoring needs besides the count of each word; its size is set by the units and classes."""

    frequent: dict[bytes, int]
    cls: np.ndarray
    transition: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    tokens: int
    words: int

    def base(self, counts: np.ndarray) -> np.ndarray:
        return (counts + ADDED) / (self.tokens + ADDED * (self.words + 1))

    def probabilities(self, before: np.ndarray, units: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Of tokens (unit and count) after tokens of the classes ``before``."""
        size = self.class_tokens + ADDED * (self.class_words + 1)
        own = self.cls[units]
        known = self.transition[before, own] * (counts + ADDED) / size[own]
        unknown = (self.transition @ (ADDED / size))[before]
        return MIX * np.where(counts > 0, known, unknown) + (1 - MIX) * self.base(counts)


def model_of(frequent: list[bytes], pairs: np.ndarray, unit_words: np.ndarray, tokens: int, words: int) -> Model:
    """The model from unit pairs and the number of different words in each unit."""
    cls = exchange(pairs)
    one = np.zeros((len(pairs), CLASSES))
    one[np.arange(len(pairs)), cls] = 1
    model = Model({w: k + 1 for k, w in enumerate(frequent)}, cls, np.zeros(0), np.zeros(0), np.zeros(0), tokens, words)
    return with_counts(model, one.T @ pairs @ one, one.T @ unit_words)


def with_counts(model: Model, joint: np.ndarray, class_words: np.ndarray) -> Model:
    """The model with the class pairs and the different words of each class."""
    class_tokens = joint.sum(axis=0)
    share = class_tokens / model.tokens if model.tokens else np.full(CLASSES, 1 / CLASSES)
    transition = (joint + PRIOR * share) / (joint.sum(axis=1, keepdims=True) + PRIOR)
    return replace(model, transition=transition, class_tokens=class_tokens, class_words=class_words)


# ---- jobs


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


GROUPS = "g long, rows array<long>, doc_ids array<long>, train array<boolean>, lengths array<int>, ids binary, words binary, counts array<int>"


def token_groups(docs: DataFrame, row: str | None = None, held_of: int = 10, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Documents in groups: ``ids`` are 32-bit numbers into ``words`` (joined by line ends), ``counts`` how often each word is
    in training documents, those whose crc32(doc_id as text) modulo ``held_of`` is not 0."""
    number = F.col(row) if row else F.monotonically_increasing_id()
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(number.alias("row"), doc_id.alias("doc_id"), (common.fold(doc_id, held_of) != 0).alias("train"), F.coalesce("text", F.lit("")).alias("text"))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, total = TaskContext.get().partitionId(), 0, 0
        numbers, held = _Numbers({END: 0}), []

        def group() -> pa.RecordBatch:
            lengths = [len(ids) for *_, ids in held]
            learned = [ids for _, _, train, ids in held if train]
            counts = np.bincount(np.concatenate(learned), minlength=len(numbers)) if learned else np.zeros(len(numbers), dtype=np.int64)
            values = [(task << 32) + made, [h[0] for h in held], [h[1] for h in held], [h[2] for h in held], lengths, np.concatenate([h[3] for h in held]).astype("<i4").tobytes(), b"\n".join(numbers)]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
            arrays = [pa.array([v], k) for v, k in zip(values, kinds)]
            return pa.RecordBatch.from_arrays([*arrays, common.list_column(counts, np.array([len(counts)]), pa.int32())], ["g", "rows", "doc_ids", "train", "lengths", "ids", "words", "counts"])

        for batch in batches:
            for number_, id_, train, text in zip(*(batch.column(k).to_pylist() for k in range(3)), common.texts_of(batch, "text")):
                words = text.encode("utf-8").lower().split()
                ids = np.fromiter(map(numbers.__getitem__, words), dtype=np.int32, count=len(words))
                held.append((number_, id_, train, np.append(ids, np.int32(0))))
                total += len(ids) + 1
                if total >= group_tokens:
                    yield group()
                    made, total, numbers, held = made + 1, 0, _Numbers({END: 0}), []
        if held:
            yield group()

    return rows.mapInArrow(collect, GROUPS)


def group_words(groups: DataFrame) -> DataFrame:
    """``g, at, word, n``: the different words of each group."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, words, counts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                parts = words.as_py().split(b"\n")
                n = len(parts)
                for first in range(0, n, 1 << 16):
                    some = parts[first : first + (1 << 16)]
                    at = np.arange(first, first + len(some), dtype=np.int32)
                    arrays = [pa.array(np.full(len(some), g)), pa.array(at), pa.array(some, pa.binary()), counts.values.slice(first, len(some)).cast(pa.int64())]
                    yield pa.RecordBatch.from_arrays(arrays, ["g", "at", "word", "n"])

    return groups.select("g", "words", "counts").mapInArrow(listed, "g long, at int, word binary, n long")


def vocabulary_of(words: DataFrame) -> DataFrame:
    """``word, c`` of all words of training documents, written."""
    return common.stage(words.groupBy("word").agg(F.sum("n").alias("c")).filter("c > 0"), "vocabulary")


# ---- classes of words


@dataclass
class Words:
    """The moving words, most frequent first, with their counts. Codes are their numbers, then those of the units of other words."""

    model: Model
    numbers: dict[bytes, int]
    counts: np.ndarray
    end_count: int

    def moving(self, words: list[bytes]) -> np.ndarray:
        """The codes of the words that move, -1 for others."""
        return np.fromiter((self.numbers.get(w, -1) for w in words), dtype=np.int64, count=len(words))

    def others(self, words: list[bytes], at: np.ndarray) -> np.ndarray:
        """The codes of some words that do not move."""
        return len(self.numbers) + units_of([words[k] for k in at.tolist()], self.model.frequent)

    def codes(self, words: list[bytes]) -> np.ndarray:
        found = self.moving(words)
        at = np.flatnonzero(found < 0)
        found[at] = self.others(words, at)
        return found


def coded_tokens(groups: DataFrame, words: Words) -> DataFrame:
    """The codes of the tokens of training documents, for each group."""
    sent = groups.sparkSession.sparkContext.broadcast(words)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = sent.value.codes(row["words"].split(b"\n")).astype("<i4")[np.frombuffer(row["ids"], dtype="<i4")]
                learned = np.repeat(np.array(row["train"], dtype=bool), row["lengths"])
                yield pa.RecordBatch.from_arrays([pa.array([found[learned].tobytes()], pa.binary())], ["codes"])

    return common.stage(groups.select("ids", "words", "train", "lengths").mapInArrow(code, "codes binary"), "token-codes")


def _sequences(batches: Iterator[pa.RecordBatch], end: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(codes before, codes): an end closes every document, so the token before the first is an end, too."""
    for batch in batches:
        for blob in batch.column(0):
            codes = np.frombuffer(blob.as_py(), dtype="<i4")
            yield np.concatenate([[end], codes[:-1]]) if len(codes) else codes, codes


def unit_pairs(coded: DataFrame, units: np.ndarray) -> np.ndarray:
    """Counts of pairs of ``units`` (by code); the first word follows an end. A task sends one row for a pair."""
    size, end = 1 + FREQUENT + ENDINGS, len(units) - 1 - FREQUENT - ENDINGS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, dtype=np.int64)
        for before, codes in _sequences(batches, end):
            total += np.bincount(units[before] * size + units[codes], minlength=size * size)
        yield _met(total)

    return _summed(coded.mapInArrow(count, "place long, n long"), size * size).reshape(size, size)


def class_counts(coded: DataFrame, cls: np.ndarray) -> DataFrame:
    """``block, counts``: of each code of a block how often each class follows it, precedes it, and it follows itself; written."""
    k, n, end = CLASSES, len(cls), len(cls) - 1 - FREQUENT - ENDINGS
    width = 2 * k + 1
    sent = coded.sparkSession.sparkContext.broadcast(cls.astype(np.int64))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, own = np.zeros((n, width), dtype=np.int64), sent.value
        for before, codes in _sequences(batches, end):
            total[:, :k] += np.bincount(before * k + own[codes], minlength=n * k).reshape(n, k)
            total[:, k : 2 * k] += np.bincount(codes * np.int64(k) + own[before], minlength=n * k).reshape(n, k)
            total[:, 2 * k] += np.bincount(codes[before == codes], minlength=n)
        firsts = [f for f in range(0, n, BLOCK) if total[f : f + BLOCK].any()]
        for first in firsts:
            yield _block(first // BLOCK, total[first : first + BLOCK])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = None, None
        for batch in batches:
            for block, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = _block_counts(blob.as_py())
                if block != held:
                    if held is not None:
                        yield _block(held, total)
                    held, total = block, counts.copy()
                else:
                    total += counts
        if held is not None:
            yield _block(held, total)

    rows = coded.mapInArrow(count, "block int, counts binary")
    shuffled = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "block").sortWithinPartitions("block")
    return common.stage(shuffled.mapInArrow(add, "block int, counts binary"), "class-counts")


def _block(block: int, counts: np.ndarray) -> pa.RecordBatch:
    data = zlib.compress(counts.astype("<i8").tobytes(), 1)
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([data], pa.binary())], ["block", "counts"])


def _block_counts(blob: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(blob), dtype="<i8").reshape(-1, 2 * CLASSES + 1)


def _summed(rows: DataFrame, size: int) -> np.ndarray:
    """The sums of ``place, n`` rows as ``size`` numbers."""
    found = rows.groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size)
    out[found["place"].to_numpy(np.int64)] = found["n"].to_numpy(float)
    return out


def _met(total: np.ndarray) -> pa.RecordBatch:
    met = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(met), pa.array(total.ravel()[met])], ["place", "n"])


def class_pairs(blocks: DataFrame, cls: np.ndarray) -> np.ndarray:
    """How often a class follows a class, from the blocks of ``class_counts``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((CLASSES, CLASSES), dtype=np.int64)
        for batch in batches:
            for block, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = _block_counts(blob.as_py())
                np.add.at(total, cls[block * BLOCK : block * BLOCK + len(counts)], counts[:, :CLASSES])
        yield _met(total)

    return _summed(blocks.mapInArrow(add, "place long, n long"), CLASSES * CLASSES).reshape(CLASSES, CLASSES)


def next_classes(blocks: DataFrame, cls: np.ndarray, joint: np.ndarray, moving: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """``cls`` after the move of those codes for which ``moving`` holds."""

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = _block_counts(blob.as_py())
                codes = np.arange(block * BLOCK, block * BLOCK + len(counts))
                chosen = moving(codes)
                own = cls[codes]
                own[chosen] = moved(joint, own[chosen], counts[chosen])
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([own.astype("u1").tobytes()], pa.binary())], ["block", "cls"])

    out = cls.copy()
    for r in blocks.mapInArrow(move, "block int, cls binary").collect():
        found = np.frombuffer(r.cls, dtype="u1")
        out[r.block * BLOCK : r.block * BLOCK + len(found)] = found
    return out


def exchanged(coded: DataFrame, cls: np.ndarray, n: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Classes of codes after rounds in which half of the ``n`` moving words move at once, and their class pairs.

    Words that move at once do not see each other's moves: the classes of greatest likelihood stay.
    """
    best = None
    for k in range(rounds):
        blocks = class_counts(coded, cls)
        joint = class_pairs(blocks, cls)
        value = likelihood(joint)
        if best is None or value > best[0]:
            best = value, cls, joint
        if k + 1 < rounds:
            after = next_classes(blocks, cls, joint, lambda codes, k=k: (codes < n) & (codes % 2 == k % 2))
            common.remove(blocks.sparkSession, blocks)
            cls = after
    return best[1:]


LISTS = "g long, at binary, c binary, cls binary, words binary"


def rare_words(groups: DataFrame, words: Words, cls: np.ndarray) -> DataFrame:
    """``g, at, word, contexts`` of the words of each group that do not move: the classes before and after each training token."""
    sent = groups.sparkSession.sparkContext.broadcast((words, cls))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own = sent.value
        n, end = len(known.numbers), own[len(known.numbers)]
        for batch in batches:
            for row in batch.to_pylist():
                parts, ids = row["words"].split(b"\n"), np.frombuffer(row["ids"], dtype="<i4")
                codes = known.codes(parts)
                rare = codes >= n
                rare[0] = False
                at = np.flatnonzero(rare)
                classes = own[codes].astype("u1")[ids]
                place = np.flatnonzero(np.repeat(np.array(row["train"], dtype=bool), row["lengths"]) & rare[ids])
                place = place[np.argsort(ids[place], kind="stable")]
                # an end follows: no document ends with a word
                contexts = np.stack([np.where(place > 0, classes[place - 1], end), classes[np.minimum(place + 1, len(ids) - 1)]], axis=1).astype("u1").tobytes()
                ends = np.concatenate([[0], np.cumsum(2 * np.bincount(ids[place], minlength=len(parts))[at])]).astype(np.int32)
                for first in range(0, len(at), 1 << 15):
                    some = at[first : first + (1 << 15)]
                    own_ends = ends[first : first + len(some) + 1]
                    blobs = pa.BinaryArray.from_buffers(pa.binary(), len(some), [None, pa.py_buffer((own_ends - own_ends[0]).tobytes()), pa.py_buffer(contexts[own_ends[0] : own_ends[-1]])])
                    arrays = [pa.array(np.full(len(some), row["g"])), pa.array(some.astype(np.int32)), pa.array([parts[k] for k in some.tolist()], pa.binary()), blobs]
                    yield pa.RecordBatch.from_arrays(arrays, ["g", "at", "word", "contexts"])

    return groups.select("g", "ids", "words", "train", "lengths").mapInArrow(listed, "g long, at int, word binary, contexts binary")


def joined_by_contexts(rows: DataFrame, joint: np.ndarray) -> DataFrame:
    """The count and class of each of ``rare_words`` for its groups, packed, and how many words each class gets. Words
    without a training token are left out. A word is one of very many, so it changes no pair of classes that it is judged by."""
    pairs = joint + PRIOR * np.outer(joint.sum(axis=1), joint.sum(axis=0)) / max(joint.sum(), 1) ** 2 + 1e-9
    fits = np.log(pairs / pairs.sum(axis=1, keepdims=True) / pairs.sum(axis=0))

    def packed(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        g, at, c, cls = (np.concatenate(x) for x in zip(*held))
        by = np.argsort(g, kind="stable")
        firsts = np.flatnonzero(np.concatenate([[True], np.diff(g[by]) != 0]))
        for some in np.split(by, firsts[1:]):
            blobs = [at[some].astype("<i4").tobytes(), c[some].astype("<i8").tobytes(), cls[some].astype("u1").tobytes(), None]
            yield pa.RecordBatch.from_arrays([pa.array([g[some[0]]], pa.int64()), *(pa.array([x], pa.binary()) for x in blobs)], ["g", "at", "c", "cls", "words"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size, rest = np.zeros(CLASSES, dtype=np.int64), [], 0, None

        def judged(table: pa.Table) -> None:
            nonlocal size
            table = table.combine_chunks()
            word = table.column("word").chunk(0).dictionary_encode()
            codes, n = word.indices.to_numpy(zero_copy_only=False), len(word.dictionary)
            contexts = table.column("contexts").chunk(0)
            owner = np.repeat(codes, pc.binary_length(contexts).to_numpy(zero_copy_only=False) // 2).astype(np.int64) * CLASSES
            ends = np.frombuffer(contexts.buffers()[1], dtype=np.int32)[contexts.offset : contexts.offset + len(contexts) + 1]
            classes = np.frombuffer(contexts.buffers()[2] or b"", dtype="u1")[ends[0] : ends[-1]].reshape(-1, 2)
            before, after = (np.bincount(owner + classes[:, k], minlength=n * CLASSES).reshape(n, CLASSES) for k in (0, 1))
            # rounded, as the order of sums must not decide
            cls, counts = np.round(after @ fits.T + before @ fits, 6).argmax(axis=1), before.sum(axis=1)
            np.add.at(total, cls[counts > 0], 1)
            some = np.flatnonzero(counts[codes] > 0)
            held.append((table.column("g").to_numpy()[some], table.column("at").to_numpy()[some], counts[codes][some], cls[codes][some]))
            size += len(some)

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            # the last word may go on in the next batch
            word = table.column("word")
            whole = pc.sum(pc.not_equal(word, word[-1])).as_py()
            rest = table.slice(whole)
            if whole:
                judged(table.slice(0, whole))
            if size >= PACKED:
                yield from packed(held)
                held.clear()
                size = 0
        if rest is not None:
            judged(rest)
        if size:
            yield from packed(held)
        arrays = [pa.array([-1], pa.int64()), *(pa.array([x], pa.binary()) for x in (None, None, None, total.astype("<i8").tobytes()))]
        yield pa.RecordBatch.from_arrays(arrays, ["g", "at", "c", "cls", "words"])

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "word").sortWithinPartitions("word").mapInArrow(join, LISTS)


def moving_words(vocabulary: DataFrame) -> Words:
    """The words that move, and the model without classes."""
    size = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("tokens"), F.count("*").alias("words"), F.sum(F.when(F.octet_length("word") == 0, F.col("c"))).alias("ends")).first()
    # one in SHARE tokens: at most SHARE words
    top = vocabulary.filter((F.octet_length("word") > 0) & (F.col("c") * SHARE >= int(size.tokens))).orderBy(F.desc("c"), "word").toPandas()
    found = [bytes(w) for w in top["word"]]
    frequent = vocabulary.filter(F.octet_length("word") > 0).orderBy(F.desc("c"), "word").limit(FREQUENT).collect()
    none = np.zeros(0)
    model = Model({bytes(r.word): k + 1 for k, r in enumerate(frequent)}, none, none, none, none, int(size.tokens), int(size.words))
    return Words(model, {w: k for k, w in enumerate(found)}, top["c"].to_numpy(np.int64), int(size.ends or 0))


def group_classes(row: dict, words: Words, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class, count in training documents) of each word of a group that has met its lists."""
    parts = row["words"].split(b"\n")
    codes, counts = words.moving(parts), np.zeros(len(parts))
    known = np.flatnonzero(codes >= 0)
    classes = np.full(len(parts), -1, dtype=np.int64)
    classes[known], counts[known] = cls[codes[known]], words.counts[codes[known]]
    counts[0] = words.end_count
    for one in row["lists"] or ():
        at = np.frombuffer(one["at"], dtype="<i4")
        counts[at], classes[at] = np.frombuffer(one["c"], dtype="<i8"), np.frombuffer(one["cls"], dtype="u1")
    # the end, and words that no training document has
    at = np.flatnonzero(classes < 0)
    classes[at] = cls[words.others(parts, at)]
    return classes, counts


def class_sequences(groups: DataFrame, words: Words, cls: np.ndarray) -> np.ndarray:
    """How often a class follows a class in the training documents of groups that have met their lists."""
    sent = groups.sparkSession.sparkContext.broadcast((words, cls))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * CLASSES, dtype=np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                classes, _ = group_classes(row, *sent.value)
                found = classes[np.frombuffer(row["ids"], dtype="<i4")]
                before = np.concatenate([classes[:1], found[:-1]])
                learned = np.repeat(np.array(row["train"], dtype=bool), row["lengths"])
                total += np.bincount((before * CLASSES + found)[learned], minlength=len(total))
        yield _met(total)

    rows = groups.select("ids", "words", "train", "lengths", "lists").mapInArrow(count, "place long, n long")
    return _summed(rows, CLASSES * CLASSES).reshape(CLASSES, CLASSES)


def scores(docs: DataFrame, row: str | None = None, held_of: int = 10, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """``row, doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document."""
    groups = common.in_buckets(token_groups(docs, row, held_of, group_tokens), "g", "token_groups")
    words = moving_words(vocabulary_of(group_words(groups)))
    frequent, n = list(words.model.frequent), len(words.numbers)
    coded = coded_tokens(groups, words)
    units = np.concatenate([units_of(list(words.numbers), words.model.frequent), np.arange(1 + FREQUENT + ENDINGS)])
    seed = model_of(frequent, unit_pairs(coded, units), np.zeros(1 + FREQUENT + ENDINGS), words.model.tokens, words.model.words)
    cls, joint = exchanged(coded, seed.cls[units], n)
    lists = common.dealt(joined_by_contexts(rare_words(groups, words, cls), joint), "g", "class_lists")
    class_words = np.bincount(cls[:n], minlength=CLASSES).astype(float)
    for r in lists.filter("words is not null").select("words").collect():
        class_words += np.frombuffer(r.words, dtype="<i8")
    class_words[cls[n]] += words.end_count > 0
    # of each group, the counts and classes of its words: as many as it has different words at most
    lists = lists.filter("words is null").groupBy("g").agg(F.collect_list(F.struct("at", "c", "cls")).alias("lists"))
    groups = groups.join(lists, "g", "left")
    # from here on, classes are the units
    model = with_counts(replace(seed, cls=np.arange(CLASSES)), class_sequences(groups, words, cls), class_words)
    sent = groups.sparkSession.sparkContext.broadcast((words, cls, model))
    schema = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, cls, model = sent.value
        for batch in batches:
            for held in batch.to_pylist():
                classes, counts = group_classes(held, words, cls)
                ids = np.frombuffer(held["ids"], dtype="<i4")
                found, seen = classes[ids], counts[ids]
                lengths = np.array(held["lengths"], dtype=np.int64)
                starts = np.cumsum(lengths) - lengths
                before = np.concatenate([classes[:1], found[:-1]])
                sums = [np.add.reduceat(x, starts) for x in ((seen > 0).astype(np.int64), np.log10(model.base(seen)), np.log10(model.probabilities(before, found, seen)))]
                arrays = [pa.array(held["rows"], pa.int64()), pa.array(held["doc_ids"], pa.int64()), pa.array([not t for t in held["train"]], pa.bool_()), pa.array(lengths), pa.array(sums[0])]
                arrays += [pa.array(np.full(len(lengths), model.tokens)), pa.array(sums[1]), pa.array(sums[2])]
                yield pa.RecordBatch.from_arrays(arrays, ["row", "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return groups.drop("counts").mapInArrow(score, schema)
