"""Totals of each (date, term) straight from texts, without a row for each article and term.

Tasks add up pieces of their articles on numbers (``grams``). The different terms of a piece go out as one row for each
(date, slice), a slice being a share of the terms by their hash; one exchange brings the rows of a slice together, where
they are added up a slice at a time. A day's terms are in ``SLICES`` slices, so one large day is many groups.

With a cap of terms most grams are never made into terms. A first pass over the texts adds up the occurrences of each day in
``BUCKETS`` buckets of the grams' hashes. No term occurs more often than its bucket, so the terms that occur at least T
times are among those of buckets of T or more, and only these are counted by term. T is a guess; a day on which fewer
than the cap reach it is counted again with the count of its last term, which enough terms are known to reach.

Lists of the terms that stay are folded (``toplists``) where their texts are read: the terms are sent to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termpulse import fixed_values as fixed
from termpulse.functions import grams
from termpulse.functions import text as txt
from termpulse.operators import daystats, toplists, windows
from termpulse.session import stage

#: Slices of a day.
SLICES = 64
#: Rows of a batch that a task sends.
ROWS = 1 << 16
#: Buckets of a day, and the rows that they are sent in.
BUCKETS, PARTS = 1 << 18, 256
#: Days whose buckets a task holds at once.
HELD_DAYS = 16
_BUCKETS = "date date, part int, counts binary"
_PACKED = "date date, slice int, n int, sizes binary, terms binary, tf binary, df binary"
_TOTALS = "date date, term string, tf bigint, df bigint, document_count bigint"


def _blobs(numbers: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Runs of numbers as bytes: one byte each where all are small, else eight."""
    kind = np.dtype("u1" if numbers.max(initial=0) < 256 else "<i8")
    data = pa.py_buffer(np.ascontiguousarray(numbers.astype(kind)))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * kind.itemsize).astype(np.int64)), data]).cast(pa.binary())


def _numbers(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(blob, "u1" if len(blob) == n else "<i8").astype(np.int64)


def packed(day: np.ndarray, hashes: np.ndarray, terms: pa.Array, tf: np.ndarray, df: np.ndarray) -> pa.RecordBatch:
    """One row for each (date, slice) of the given totals."""
    part = hashes % SLICES
    group = grams.keys([day - day.min(initial=0), part])
    # numbers of 16 bits are sorted by their digits
    by = np.argsort(group.astype(np.uint16) if group.max(initial=0) < 1 << 16 else group, kind="stable")
    day, part, terms = day[by], part[by], terms.take(pa.array(by)).cast(pa.large_binary())
    bounds = np.append(np.flatnonzero(grams.changes(day, part)), len(by))
    sizes = pc.binary_length(terms).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, chars = np.concatenate([[0], np.cumsum(sizes)]), terms.buffers()[2] or pa.py_buffer(b"")
    joined = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(ends[bounds]), chars]).cast(pa.binary())
    at = bounds[:-1]
    columns = [pa.array(day[at].astype(np.int32)).cast(pa.date32()), pa.array(part[at].astype(np.int32)), pa.array(np.diff(bounds).astype(np.int32))]
    columns += [_blobs(sizes, bounds), joined, _blobs(tf[by], bounds), _blobs(df[by], bounds)]
    return pa.RecordBatch.from_arrays(columns, ["date", "slice", "n", "sizes", "terms", "tf", "df"])


def _added(rows: list[dict], max_terms: int | None) -> Iterator[pa.RecordBatch]:
    """The totals of one slice, without terms of one article where the day has more, and at most its ``max_terms`` first."""
    sizes = np.concatenate([_numbers(r["sizes"], r["n"]) for r in rows])
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    terms = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(ends), pa.py_buffer(b"".join(r["terms"] for r in rows))).dictionary_encode()
    codes, n = terms.indices.to_numpy(zero_copy_only=False), len(terms.dictionary)
    tf, df = (np.bincount(codes, np.concatenate([_numbers(r[c], r["n"]) for r in rows]), n).astype(np.int64) for c in ("tf", "df"))
    size = rows[0]["document_count"]
    at = np.flatnonzero(df >= 2) if size >= 2 else np.arange(n)
    words = terms.dictionary.take(pa.array(at)).cast(pa.string())
    if max_terms is not None and len(at) > max_terms:
        first = pc.sort_indices(pa.table({"tf": tf[at], "term": words}), sort_keys=[("tf", "descending"), ("term", "ascending")])[:max_terms]
        words, at = words.take(first), at[first.to_numpy()]
    found = [pa.array([rows[0]["date"]] * len(at), pa.date32()), words, pa.array(tf[at]), pa.array(df[at]), pa.array(np.full(len(at), size))]
    batch = pa.RecordBatch.from_arrays(found, ["date", "term", "tf", "df", "document_count"])
    for first in range(0, batch.num_rows, ROWS):
        yield batch.slice(first, ROWS)


def by_day(articles: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of the articles that have a date, written in ranges of days: a task then reads few days."""
    n = int(articles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = articles.select(*columns).where(F.col("date").isNotNull())
    return stage(rows.repartitionByRange(n, "date", "article_id"), "texts-by-day")


def bucket_of(hashes: np.ndarray) -> np.ndarray:
    """The first bits of the product, as numbers of 32 bits wrap around; ``BUCKETS`` is a power of two."""
    return (hashes.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(33 - BUCKETS.bit_length())


def _counts(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"<u{len(blob) * PARTS // BUCKETS}").astype(np.int64)


def _bucket_rows(held: dict[int, np.ndarray]) -> pa.RecordBatch:
    """One row for each day and part, its counts in as few bytes as they need."""
    blobs = []
    for part in (p for counts in held.values() for p in counts.reshape(PARTS, -1)):
        kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if part.max() <= np.iinfo(k).max)
        blobs.append(part.astype(kind).tobytes())
    days = pa.array(np.repeat(np.array(list(held), np.int32), PARTS)).cast(pa.date32())
    return pa.RecordBatch.from_arrays([days, pa.array(np.tile(np.arange(PARTS, dtype=np.int32), len(held))), pa.array(blobs, pa.binary())], ["date", "part", "counts"])


def _put(held: dict[int, np.ndarray], day: np.ndarray, hashes: np.ndarray, n: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Add occurrences of grams to the buckets of their days; yields those of days for which there is no room."""
    days, own = np.unique(day, return_inverse=True)
    yield from _put_at(held, days, own, hashes, n)


def _put_at(held: dict[int, np.ndarray], days: np.ndarray, own: np.ndarray, hashes: np.ndarray, n: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """``_put`` with the place of each gram's day among ``days``."""
    bucket = bucket_of(hashes)
    for first in range(0, len(days), HELD_DAYS):
        last = min(first + HELD_DAYS, len(days))
        some = slice(None) if last - first == len(days) else np.flatnonzero((own >= first) & (own < last))
        sums = np.bincount((own[some] - first) * BUCKETS + bucket[some], None if n is None else n[some], (last - first) * BUCKETS).astype(np.int64)
        for d, found in zip(days[first:last].tolist(), sums.reshape(-1, BUCKETS)):
            if d in held:
                held[d] += found
                continue
            if len(held) >= HELD_DAYS:
                yield _bucket_rows(held)
                held.clear()
            held[d] = found.copy()


def buckets(articles: DataFrame, text: Column, stored: DataFrame | None = None, **term_options) -> DataFrame:
    """``date, part, counts``: occurrences of the kept grams of ``text`` and of ``stored`` (date, term, tf) in buckets, partial sums."""
    rules = grams.Rules.of(**term_options)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            dates, texts = batch.columns
            for first, size in grams.pieces(texts):
                _, days, owner, codes, vocabulary = grams.dated(texts.slice(first, size), dates.slice(first, size))
                days, own = np.unique(days, return_inverse=True)
                for _, at, hashes in grams.hashes(owner, codes, vocabulary, rules):
                    yield from _put_at(held, days, own[owner[at]], hashes)
        if held:
            yield _bucket_rows(held)

    def given(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            day = batch.column(0).cast(pa.int32()).to_numpy(zero_copy_only=False)
            hashes = np.array([grams.hashed(t) for t in batch.column(1).to_pylist()], np.int64)
            yield from _put(held, day, hashes, batch.column(2).to_numpy(zero_copy_only=False))
        if held:
            yield _bucket_rows(held)

    rows = articles.select("date", text.alias("text")).mapInArrow(pieces, _BUCKETS)
    if stored is not None:
        rows = rows.unionByName(stored.where(F.col("date").isNotNull() & F.col("term").isNotNull()).select("date", "term", "tf").mapInArrow(given, _BUCKETS))
    return rows


def added_buckets(rows: DataFrame) -> DataFrame:
    """One row for each date and part of ``buckets``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None
        for batch in batches:
            for k, at in enumerate(zip(batch.column(0), batch.column(1))):
                if at != key:
                    if key is not None:
                        yield row(key, total)
                    key, total = at, np.zeros(BUCKETS // PARTS, np.int64)
                total += _counts(batch.column(2)[k].as_py())
        if key is not None:
            yield row(key, total)

    def row(key: tuple, total: np.ndarray) -> pa.RecordBatch:
        kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if total.max() <= np.iinfo(k).max)
        values = [pa.array([key[0].as_py()], pa.date32()), pa.array([key[1].as_py()], pa.int32()), pa.array([total.astype(kind).tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(values, ["date", "part", "counts"])

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "date", "part").sortWithinPartitions("date", "part").mapInArrow(add, _BUCKETS)


def _guesses(added: DataFrame, max_terms: int) -> DataFrame:
    """``date, least``: a count that about half as many terms again as the cap reach, less what other terms add to most buckets."""
    rank = -(-max_terms * 3 // (2 * PARTS))

    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = []
            for blob in batch.column(1):
                counts = np.sort(_counts(blob.as_py()))
                least.append(int(counts[-rank] - counts[len(counts) * 9 // 10]) if rank < len(counts) else 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(least, pa.int64())], ["date", "least"])

    found = added.select("date", "counts").mapInArrow(guess, "date date, least bigint")
    return found.groupBy("date").agg(F.greatest(F.avg("least").cast("bigint"), F.lit(1).cast("bigint")).alias("least"))


def _asked(added: DataFrame, leasts: dict) -> dict[int, bytes]:
    """Of each day number in ``leasts`` (by date) a bit for each bucket: whether it has that count."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [np.packbits(_counts(c.as_py()) >= leasts[d.as_py()]).tobytes() for d, c in zip(batch.column(0), batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(blobs, pa.binary())], ["date", "part", "bits"])

    parts: dict = {}
    # BUCKETS bits for each calendar day
    for r in added.where(F.col("date").isin(list(leasts))).mapInArrow(bits, "date date, part int, bits binary").collect():
        parts.setdefault(r.date, {})[r.part] = bytes(r.bits)
    epoch = np.datetime64("1970-01-01", "D")
    return {int((np.datetime64(d, "D") - epoch).astype(int)): b"".join(p[k] for k in range(PARTS)) for d, p in parts.items()}


class _Filter:
    """Whether grams of a day are asked for, from the bits of a broadcast."""

    def __init__(self, bits: dict[int, bytes]):
        self.days = np.array(sorted(bits), np.int64)
        self.table = np.frombuffer(b"".join(bits[d] for d in self.days.tolist()), np.uint8)

    def __call__(self, days: np.ndarray):
        """What tells of grams, given by the places of their days in ``days`` and their hashes, whether they are asked for."""
        if not len(self.days):
            return lambda at, hashes: np.zeros(len(at), bool)
        own = np.minimum(np.searchsorted(self.days, days), len(self.days) - 1)
        there, first = self.days[own] == days, own * (BUCKETS >> 3)

        def chosen(at: np.ndarray, hashes: np.ndarray) -> np.ndarray:
            bucket = bucket_of(hashes)
            return there[at] & ((self.table[first[at] + (bucket >> 3)] >> (7 - (bucket & 7)) & 1) > 0)

        return chosen


def _counted(
    articles: DataFrame, text: Column, days: DataFrame, stored: DataFrame | None, max_terms: int | None, asked: dict[int, bytes] | None, rules: grams.Rules
) -> DataFrame:
    sent = None if asked is None else articles.sparkSession.sparkContext.broadcast(asked)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = None if sent is None else _Filter(sent.value)
        for batch in batches:
            dates, texts = batch.columns
            for first, size in grams.pieces(texts):
                yield packed(*grams.totals(texts.slice(first, size), dates.slice(first, size), rules, chosen))

    def given(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = None if sent is None else _Filter(sent.value)
        for batch in batches:
            day = batch.column(0).cast(pa.int32()).to_numpy(zero_copy_only=False)
            hashes = np.array([grams.hashed(t) for t in batch.column(1).to_pylist()], np.int64)
            at = np.arange(len(day)) if chosen is None else np.flatnonzero(chosen(day)(np.arange(len(day)), hashes))
            yield packed(day[at], hashes[at], batch.column(1).take(pa.array(at)), *(batch.column(k).to_numpy(zero_copy_only=False)[at] for k in (2, 3)))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and (held[0]["date"], held[0]["slice"]) != (row["date"], row["slice"]):
                    yield from _added(held, max_terms)
                    held = []
                held.append(row)
        if held:
            yield from _added(held, max_terms)

    rows = articles.select("date", text.alias("text")).mapInArrow(pieces, _PACKED)
    if stored is not None:
        plain = stored.where(F.col("date").isNotNull() & F.col("term").isNotNull()).groupBy("date", "term").agg(F.sum("tf").alias("tf"), F.count(F.lit(1)).alias("df"))
        rows = rows.unionByName(plain.mapInArrow(given, _PACKED))
    # one fixed-width row per calendar date
    sized = rows.join(F.broadcast(days.select("date", "document_count")), "date")
    n = int(articles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = sized.repartition(n, "date", "slice").sortWithinPartitions("date", "slice").mapInArrow(summed, _TOTALS)
    return stage(found, "day-totals")


def text_totals(
    articles: DataFrame,
    text: Column,
    days: DataFrame,
    stored: DataFrame | None = None,
    max_terms: int | None = None,
    added: DataFrame | None = None,
    **term_options,
) -> DataFrame:
    """``daystats.day_totals`` of the kept terms of ``text`` and of ``stored`` (date, term, tf) rows, one for an article.

    Written, as a cap reads it twice. With ``max_terms``, terms may be left out that are not among so many of their day
    (``daystats.cap_terms`` finds those); ``articles`` are read twice then, so pass them written, best ``by_day``. ``added``
    holds the ``added_buckets`` of the same articles, if they are there already.
    """
    rules = grams.Rules.of(**term_options)
    if max_terms is None or max_terms > BUCKETS // 8:
        return _counted(articles, text, days, stored, max_terms, None, rules)
    if added is None:
        added = stage(added_buckets(buckets(articles, text, stored, **term_options)), "day-buckets")
    # one number for each calendar day
    leasts = {r.date: r.least for r in _guesses(added, max_terms).collect()}
    found = _counted(articles, text, days, stored, max_terms, _asked(added, leasts), rules)
    guessed = articles.sparkSession.createDataFrame(list(leasts.items()), "date date, least bigint")
    reached = found.join(F.broadcast(guessed), "date").groupBy("date").agg(F.sum((F.col("tf") >= F.col("least")).cast("int")).alias("n")).collect()
    enough = {r.date for r in reached if r.n >= max_terms}
    short = [d for d, least in leasts.items() if least > 1 and d not in enough]
    if not short:
        return found
    # as many terms as the cap reach the count of that in its place, if there is one
    ranked = found.where(F.col("date").isin(short)).withColumn("__rank", F.row_number().over(W.partitionBy("date").orderBy(F.desc("tf"))))
    last = {r.date: r.tf for r in ranked.where(F.col("__rank") == max_terms).select("date", "tf").collect()}
    own = F.col("date").isin(short)
    again = _counted(
        articles.where(own), text, days, None if stored is None else stored.where(own), max_terms, _asked(added, {d: last.get(d, 1) for d in short}), rules
    )
    return found.where(~own).unionByName(again)


# ---- lists


def text_occurrences(articles: DataFrame, text: Column, wanted: DataFrame, **term_options) -> DataFrame:
    """``date, term, article_id`` of the wanted (date, term) of a table, at most ``daystats.SENT_TERMS``, in ``text``."""
    found = _met(wanted, grams.Rules.of(**term_options))
    rows = articles.select("date", "article_id", F.lit(None).cast("string").alias("author"), text.alias("text"))

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found(batches):
            yield batch.select(["date", "term", "article_id"])

    return rows.mapInArrow(met, "date date, term string, article_id string")


def _met(wanted: DataFrame, rules: grams.Rules):
    """What turns rows ``date, article_id, author, text`` into ``date, article_id, author, term, tf`` (0) of wanted terms."""
    rows = wanted.select(F.datediff("date", F.lit("1970-01-01")).alias("day"), "term").where("day is not null and term is not null").toPandas()
    sent = wanted.sparkSession.sparkContext.broadcast((rows["day"].to_numpy(np.int64), rows["term"].tolist()))

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = grams.Wanted(sent.value[0], pa.array(sent.value[1], pa.string()))
        for batch in batches:
            date, ids, author, texts = batch.columns
            for first, size in grams.pieces(texts):
                place, day, term = asked.met(texts.slice(first, size), date.slice(first, size), rules)
                for k in range(0, len(place), ROWS):
                    at = pa.array(place[k : k + ROWS] + first)
                    columns = [date.take(at), ids.take(at), author.take(at), asked.terms.take(pa.array(term[k : k + ROWS])), pa.array(np.zeros(len(at), np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, ["date", "article_id", "author", "term", "tf"])

    return met


def text_states(
    articles: DataFrame, text: Column, wanted: DataFrame, max_articles: int | None, max_authors: int | None, **term_options
) -> DataFrame:
    """Partial ``toplists.states`` of the wanted (date, term) in ``text``, folded where the text is read; without sums."""
    found, fold = _met(wanted, grams.Rules.of(**term_options)), toplists.folds(max_articles, max_authors)
    rows = articles.select("date", "article_id", "author", text.alias("text"))
    return rows.mapInArrow(lambda batches: fold(found(batches)), toplists.STATE)


def day_terms(
    articles: DataFrame,
    text: Column,
    days: DataFrame,
    stored: DataFrame | None = None,
    *,
    max_terms: int | None = fixed.MAX_TERMS_PER_DAY,
    max_articles: int | None = fixed.MAX_ARTICLES_PER_TERM,
    max_authors: int | None = fixed.MAX_AUTHORS_PER_TERM,
    added: DataFrame | None = None,
    **term_options,
) -> DataFrame:
    """``daystats.day_terms`` of the texts of ``articles`` (date, article_id, author; best ``by_day``) and of ``stored`` counts (``term_counts``)."""
    if max_terms is None and stored is None:
        return windows.whole_terms(articles, text, days, max_articles, max_authors, **term_options)
    if max_terms is None:
        counts = txt.with_term_counts(articles, text, keep=("date", "article_id", "author"), **term_options)
        counts = counts.unionByName(stored.select(*counts.columns))
        return daystats.day_terms(counts, days, max_terms=None, max_articles=max_articles, max_authors=max_authors)
    plain = None if stored is None else daystats.article_terms(stored, "date")
    totals = text_totals(articles, text, days, plain, max_terms, added, **term_options)
    kept = stage(daystats.cap_terms(totals, max_terms).select("date", "term", "tf", "df"), "kept-terms")
    if kept.count() > daystats.SENT_TERMS:
        counts = txt.with_term_counts(articles, text, keep=("date", "article_id", "author"), **term_options)
        partial = toplists.states(daystats.met_counts(counts, kept), max_articles, max_authors)
    else:
        partial = text_states(articles, text, kept, max_articles, max_authors, **term_options)
    if stored is not None:
        partial = partial.unionByName(toplists.states(daystats.met_counts(stored, kept), max_articles, max_authors))
    lists = toplists.merged(partial, max_articles, max_authors)
    return toplists.published(lists.drop("tf", "df").join(kept, ["date", "term"]))
