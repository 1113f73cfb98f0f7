"""Quality rules on how well public vocabularies fit a text.

Each word of a text is cut by a vocabulary of pieces with byte fallback and by a byte-level one. A text that they were not
made for falls into many short tokens, into single bytes, or into few different tokens again and again. So four measures
are taken: characters per token of either vocabulary, share of byte tokens, and entropy of the pieces. A band of each is
set for every language (of texts without one: every script) and class of length, from the median and the quartiles of all
its texts, and a text outside a band is rejected. Long and short texts are told apart because entropy grows with length.

Words are numbered once in each worker and only new ones are cut, so a text costs look-ups. What a worker remembers is
bounded in bytes; a word longer than ``LONG`` bytes is cut each time. The bands are one row for each language and class,
summed before the shuffle. Texts are read once and never shuffled; the second pass reads only their measures.

Null text: no words. Texts of fewer than ``LEAST_WORDS`` words fail the base rules; they have no tokens to speak of and
set no band. Null language: the script of most of the text's letters. Null doc_id and repeated rows: each has a row of its
own. Empty table: no rows. Extra columns do not take part.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termpulse.llm import common, wordhash

#: Words of the base rules: fewest of a text, and of a window that is looked for again; largest share of words in such windows, in hundredths.
LEAST_WORDS, WINDOW, MOST_REPEATED = 10, 5, 20
SYMBOLS = b"#*$%&|<>"
#: Bytes of words and of their tokens that a worker remembers; bytes of a word that is not remembered.
REMEMBERED, LONG = 96 << 20, 256


# ---- vocabularies


class Pieces:
    """A vocabulary of pieces with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])

    def cut(self, words: list[bytes]) -> list[list[int]]:
        return self.model.encode([w.decode("utf-8") for w in words], num_threads=1)


class Ranks:
    """A byte-level vocabulary, given as ranks; words stand behind a space, as in running text."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.model = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        # parts of characters that the vocabulary lacks
        self.is_byte = np.zeros(max(ranks.values()) + 1, dtype=bool)
        self.is_byte[[rank for token, rank in ranks.items() if len(token) == 1 and token[0] >= 0x80]] = True

    def cut(self, words: list[bytes]) -> list[list[int]]:
        return [self.model.encode_ordinary(" " + w.decode("utf-8")) for w in words]


class Words(dict):
    """Numbers words as they are met, and holds the tokens of each in a vocabulary of pieces and their number in the other."""

    def __init__(self, pieces: Pieces, ranks: Ranks, remembered: int = REMEMBERED):
        super().__init__()
        self.pieces, self.ranks, self.remembered = pieces, ranks, remembered
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.new: list[bytes] = []
        self.bytes = self.used = 0
        self.flat = np.zeros(1 << 16, dtype=np.int32)
        self.first, self.count, self.other, self.hash = (np.zeros(1 << 14, dtype=t) for t in (np.int64, np.int64, np.int64, np.uint64))

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number

    def learn(self) -> None:
        first_new, words = len(self) - len(self.new), self.new
        self.new = []
        while len(self) > len(self.first):
            self.first, self.count, self.other, self.hash = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.count, self.other, self.hash))
        ids = self.pieces.cut(words)
        counts = np.array([len(x) for x in ids], dtype=np.int64)
        total = int(counts.sum())
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + total] = [i for x in ids for i in x]
        own = slice(first_new, first_new + len(words))
        self.first[own], self.count[own] = self.used + np.cumsum(counts) - counts, counts
        self.other[own] = [len(x) for x in self.ranks.cut(words)]
        self.hash[own] = wordhash.word_hashes(words)
        self.used += total
        self.bytes += sum(map(len, words)) + 160 * len(words) + 4 * total

    def numbers(self, words: list[bytes]) -> np.ndarray:
        if self.bytes > self.remembered:
            self.forget()
        index = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        if self.new:
            self.learn()
            if max(map(len, words)) > LONG:
                # the next text starts anew, so that long words are not kept
                self.bytes += self.remembered
        return index


@lru_cache(maxsize=1)
def words_of(pieces: str, ranks: str, pattern: str) -> Words:
    """The words of a worker; they are remembered from task to task."""
    return Words(Pieces(pieces), Ranks(ranks, pattern))


# ---- measures


def repeated_words(hashes: np.ndarray, window: int = WINDOW) -> int:
    """Words that stand in a run of ``window`` words found twice or more, the first included."""
    runs = wordhash.Rolling(hashes).windows(window)
    order = np.argsort(runs, kind="stable")
    same = runs[order[1:]] == runs[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(len(hashes) + 1, dtype=np.int64)
    found = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    again[found] += 1
    np.subtract.at(again, found + window, 1)
    return int((np.cumsum(again[:-1]) > 0).sum())


def repeated_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def entropy(ids: np.ndarray) -> float:
    """Bits per token."""
    if not len(ids):
        return 0.0
    counts = np.bincount(ids)
    share = counts[counts > 0] / len(ids)
    return float(-(share * np.log2(share)).sum())


#: Scripts by the first code points of their blocks; each goes on to the next entry. "-": no letters of a script.
BLOCKS = (
    (0x0000, "-"), (0x0041, "Latin"), (0x005B, "-"), (0x0061, "Latin"), (0x007B, "-"), (0x00C0, "Latin"), (0x0250, "-"), (0x0370, "Greek"),
    (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0700, "-"), (0x0900, "Devanagari"), (0x0980, "Indic"),
    (0x0E00, "Thai"), (0x0E80, "-"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "-"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "-"),
    (0x3040, "Kana"), (0x3100, "-"), (0x3400, "Han"), (0xA000, "-"), (0xAC00, "Hangul"), (0xD7B0, "-"),
)
STARTS, SCRIPTS = np.array([a for a, _ in BLOCKS]), [s for _, s in BLOCKS]


def script(text: str) -> str:
    """The script of most letters, ties to the one that is first by name; "-" without any."""
    found = np.bincount(np.searchsorted(STARTS, np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32), side="right") - 1, minlength=len(BLOCKS))
    counts: dict[str, int] = {}
    for name, n in zip(SCRIPTS, found.tolist()):
        if name != "-" and n:
            counts[name] = counts.get(name, 0) + n
    return min(counts, key=lambda s: (-counts[s], s)) if counts else "-"


MEASURES = "doc_id long, kind string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_pieces long, n_bytes long, n_ranks long, entropy double"


def measured(docs: DataFrame, pieces: str, ranks: str, pattern: str) -> DataFrame:
    """The measures of every row: ``doc_id``, ``kind`` (language or script) and the counts named in ``MEASURES``."""
    names = [c.split()[0] for c in MEASURES.split(", ")]
    kinds = [{"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[c.split()[1]] for c in MEASURES.split(", ")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words_of(pieces, ranks, pattern)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), common.texts_of(batch, "text")):
                raw = text.encode("utf-8")
                words = raw.split()
                index = known.numbers(words)
                counts = known.count[index]
                ids = known.flat[common.ragged(known.first[index], counts)]
                spaces = sum(map(raw.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
                symbols = sum(raw.count(bytes([s])) for s in SYMBOLS)
                kind = lang if lang is not None else script(text)
                out.append(
                    (doc_id, kind, len(words), len(text) - spaces, symbols, repeated_lines(raw), repeated_words(known.hash[index]))
                    + (len(ids), int(known.pieces.is_byte[ids].sum()), int(known.other[index].sum()), entropy(ids))
                )
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * len(names), kinds)], names)

    return rows.mapInArrow(measure, MEASURES)


# ---- bands


def rates() -> dict[str, Column]:
    """The four measures that have a band, from the columns of ``measured``."""
    part = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "chars_per_piece": part("word_chars", "n_pieces"),
        "chars_per_rank": part("word_chars", "n_ranks"),
        "byte_share": part("n_bytes", "n_pieces"),
        "entropy": F.col("entropy"),
    }


#: Of each rate: how many ranges between the quartiles a text may lie below and above them (None: any), and the least range.
REACH = {"chars_per_piece": (4.0, 4.0, 0.05), "chars_per_rank": (4.0, 4.0, 0.05), "byte_share": (None, 4.0, 0.02), "entropy": (2.5, None, 0.1)}


def rated(rows: DataFrame) -> DataFrame:
    """``measured`` rows with their rates and ``length_class`` (words as a power of two)."""
    return rows.withColumns(rates()).withColumn("length_class", F.floor(F.log2(F.greatest("n_words", F.lit(1)))).cast("int"))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def bands(rows: DataFrame, reach: dict = REACH) -> DataFrame:
    """``kind, length_class, n_texts`` and ``<rate>_low, <rate>_high`` from the texts of ``rated`` rows with enough words."""
    quartiles = [F.percentile_approx(rate, [0.25, 0.75], 10000).alias(f"{rate}_q") for rate in reach]
    found = rows.filter(F.col("n_words") >= LEAST_WORDS).groupBy("kind", "length_class").agg(F.count("*").alias("n_texts"), *quartiles)
    out = [F.col("kind"), F.col("length_class"), F.col("n_texts")]
    for rate, (below, above, least) in reach.items():
        low, high = F.get(f"{rate}_q", F.lit(0)), F.get(f"{rate}_q", F.lit(1))
        spread = F.greatest(high - low, F.lit(least))
        out.append((low - below * spread if below is not None else F.lit(None).cast("double")).alias(f"{rate}_low"))
        out.append((high + above * spread if above is not None else F.lit(None).cast("double")).alias(f"{rate}_high"))
    return found.select(*out)


def judged(docs: DataFrame, pieces: str, ranks: str, pattern: str, reach: dict = REACH) -> DataFrame:
    """Every row's measures and rates, ``base_failed``, ``outside`` (names of the rates that are outside their band) and ``kept``."""
    rows = rated(common.stage(measured(docs, pieces, ranks, pattern), "fertility"))
    limits = common.stage(bands(rows, reach), "bands")
    names = [c for c in limits.columns if c.endswith(("_low", "_high"))]
    found = rows.join(limits.drop("n_texts"), ["kind", "length_class"], "left")
    # a missing bound, or no band at all (too few words), rejects nothing
    beyond = [F.when(F.coalesce(F.col(rate) < F.col(f"{rate}_low"), F.lit(False)) | F.coalesce(F.col(rate) > F.col(f"{rate}_high"), F.lit(False)), F.lit(rate)) for rate in reach]
    found = found.withColumn("outside", F.array_compact(F.array(*beyond)))
    return found.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & (F.size("outside") == 0)).drop(*names)
