"""Whole rollups from windows of tokens: all terms of each day with all of their articles and authors.

The occurrences of all terms are many times as large as the texts: a token begins up to ``max_n`` grams, and each repeats the
strings of its tokens. So tokens are moved, and grams are made where they are added up. A window is the tokens that the
kept grams of one place have, as numbers of a vocabulary that goes with them; windows of two tokens or more are dealt by
their first two, single tokens by themselves. A day's texts have a slice for each ``SIZE`` bytes, so a slice has about as many
windows at any size of a day. Tasks send one row for each (date, slice) of a piece of texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termpulse.functions import grams
from termpulse.operators import toplists

#: Bytes of a day's texts for each of its slices, and of a piece that is sent at once.
SIZE, PIECE = 1 << 22, 1 << 22
#: List entries of a batch that a task returns; a longer list is returned alone.
ENTRIES = 1 << 18
#: Words of blocks that are numbered by a table of all of them.
TABLE = 1 << 25
_BLOCKS = "date date, slice int, n int, width int, words int, articles int, size bigint, data binary"
_WHOLE = "date date, term string, tf bigint, df bigint, article_ids array<string>, authors array<string>"
_CODEC = "zstd"
_EPOCH = np.datetime64("1970-01-01", "D")


def _planes(numbers: np.ndarray, width: int) -> np.ndarray:
    """``width`` rows of bytes, the lowest first, which compress better than the numbers."""
    return np.stack([(numbers >> (8 * k) & 255).astype(np.uint8) for k in range(width)])


def _numbers(planes: np.ndarray) -> np.ndarray:
    return sum(plane.astype(np.int32 if len(planes) < 4 else np.int64) << (8 * k) for k, plane in enumerate(planes))


def _width(*numbers: np.ndarray) -> int:
    return max(1, -(-max(int(x.max(initial=0)) for x in numbers).bit_length() // 8))


def _packed(values: pa.Array, bounds: np.ndarray) -> Iterator[bytes]:
    """Runs of strings as bytes: their lengths and one (0: null), then their characters."""
    values = values.cast(pa.large_string())
    sizes = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, chars = np.concatenate([[0], np.cumsum(sizes)]), values.buffers()[2] or pa.py_buffer(b"")
    first = np.frombuffer(values.buffers()[1], np.int64)[values.offset] if len(values) else 0
    chars, planes = memoryview(chars)[first:], _planes(sizes + pc.is_valid(values).to_numpy(zero_copy_only=False), 4)
    for a, b in zip(bounds, bounds[1:]):
        yield planes[:, a:b].tobytes() + chars[ends[a] : ends[b]]


def _unpacked(data: list[tuple[memoryview, int]]) -> tuple[pa.Array, list[int]]:
    """(all strings of runs that stand at the beginning of data, the length of each run in bytes)."""
    sizes, chars, lengths = [], [], []
    for blob, n in data:
        marked = _numbers(np.frombuffer(blob[: 4 * n], np.uint8).reshape(4, n)) if n else np.zeros(0, np.int64)
        total = int(np.maximum(marked - 1, 0).sum())
        sizes.append(marked)
        chars.append(blob[4 * n : 4 * n + total])
        lengths.append(4 * n + total)
    marked = np.concatenate(sizes)
    ends = np.concatenate([[0], np.cumsum(np.maximum(marked - 1, 0))]).astype(np.int64)
    found = pa.LargeStringArray.from_buffers(len(marked), pa.py_buffer(ends), pa.py_buffer(b"".join(chars)))
    return (found if marked.all() else pc.if_else(pa.array(marked > 0), found, None)), lengths


def blocks(batch: pa.RecordBatch, rules: grams.Rules, slices: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """The windows of the rows ``date, article_id, author, text``, one row for each (date, slice); ``slices`` by day number."""
    dates, ids, authors, texts = batch.columns
    for start, size in grams.pieces(texts, PIECE):
        place, days, owner, codes, vocabulary = grams.dated(texts.slice(start, size), dates.slice(start, size))
        kept = np.zeros(len(codes), np.int64)
        for n, at in grams.places(owner, codes, vocabulary, rules):
            kept[at] |= 1 << (n - 1)
        one, more = np.flatnonzero(kept & 1), np.flatnonzero(kept >> 1)
        hashes = grams.word_hashes(vocabulary)[codes].astype(np.int64)
        spread = np.concatenate([hashes[one], hashes[more] * 31 + hashes[more + 1]])
        # windows of an article stay together, in each slice
        at, mask = np.concatenate([one, more]), np.concatenate([np.ones(len(one), np.int64), kept[more] >> 1 << 1])
        by = np.argsort(at, kind="stable")
        at, mask, spread = at[by], mask[by], spread[by]
        own, spread = owner[at].astype(np.int64), (spread * 0x9E3779B1 & 0xFFFFFFFF) >> 8
        numbers, day = np.unique(days, return_inverse=True)
        part = spread % np.array([slices[d] for d in numbers.tolist()], np.int64)[day[own]]
        group = grams.keys([day[own], part])
        by = np.argsort(group, kind="stable")
        at, mask, own, part, group = at[by], mask[by], own[by], part[by], group[by]
        if not len(at):
            continue
        first = np.flatnonzero(grams.changes(group))
        bounds = np.append(first, len(at))
        nth = np.repeat(np.arange(len(first)), np.diff(bounds))
        # the articles and words of each block, and the places that they have in it
        new = grams.changes(group, own)
        articles, seen = place[own[new]], np.cumsum(new) - 1
        ends = np.searchsorted(nth[new], np.arange(len(first) + 1))
        columns = [np.where(mask >> k > 0, codes[np.minimum(at + k, len(codes) - 1)].astype(np.int64) + 1, 0) for k in range(rules.max_n)]
        v = len(vocabulary) + 1
        if len(first) * v < TABLE:
            there = np.zeros(len(first) * v, bool)
            for c in columns:
                there[nth * v + c] = True
            words, number = np.flatnonzero(there), np.cumsum(there, dtype=np.int32) - 1
            local = np.stack([number[nth * v + c] for c in columns])
        else:
            words, local = np.unique(np.concatenate([nth * v + c for c in columns]), return_inverse=True)
            local = local.reshape(rules.max_n, -1)
        edges = np.searchsorted(words // v, np.arange(len(first) + 1))
        local = local - edges[nth]
        seen = seen - ends[nth]
        width = _width(mask, seen, local)
        planes = np.concatenate([_planes(x, width) for x in (mask, seen, *local)])
        chosen, listed = words % v, pa.array(articles + start)
        texts_of = [vocabulary.take(pa.array(chosen - 1, mask=chosen == 0)), ids.take(listed), authors.take(listed)]
        runs = zip(*(_packed(x, e) for x, e in zip(texts_of, (edges, ends, ends))))
        data = [b"".join(run) + planes[:, a:b].tobytes() for run, a, b in zip(runs, bounds, bounds[1:])]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(numbers[day[own[first]]].astype(np.int32)).cast(pa.date32()),
                pa.array(part[first].astype(np.int32)),
                pa.array(np.diff(bounds).astype(np.int32)),
                pa.array(np.full(len(first), width, np.int32)),
                pa.array(np.diff(edges).astype(np.int32)),
                pa.array(np.diff(ends).astype(np.int32)),
                pa.array([len(x) for x in data], pa.int64()),
                pa.array([pa.compress(x, _CODEC, asbytes=True) for x in data], pa.binary()),
            ],
            ["date", "slice", "n", "width", "words", "articles", "size", "data"],
        )


def _whole(rows: list[dict], max_n: int, max_articles: int, max_authors: int) -> Iterator[pa.RecordBatch]:
    """All terms of one slice, without those of one article where the day has more."""
    data = [memoryview(pa.decompress(r.pop("data"), r["size"], _CODEC, asbytes=True)) for r in rows]
    strings = []
    for count in ("words", "articles", "articles"):
        values, lengths = _unpacked([(d, r[count]) for d, r in zip(data, rows)])
        data = [d[k:] for d, k in zip(data, lengths)]
        strings.append(values)
    words, ids, authors = (x.cast(pa.string()) for x in strings)
    words = words.dictionary_encode()
    # 0: no further token
    codes = pc.fill_null(words.indices, -1).to_numpy(zero_copy_only=False).astype(np.int32) + 1
    found, a, w = [], 0, 0
    for r, d in zip(rows, data):
        planes = np.frombuffer(d, np.uint8).reshape(max_n + 2, r["width"], r["n"])
        mask, own, *columns = (_numbers(p) for p in planes)
        found.append((mask, own + a, *(codes[c + w] for c in columns)))
        a, w = a + r["articles"], w + r["words"]
    mask, own, *columns = (np.concatenate(x) for x in zip(*found))
    # ids in order; articles without one come last, and are not listed
    listed, signed = pc.is_valid(ids).to_numpy(zero_copy_only=False), pc.fill_null(pc.greater(pc.utf8_length(authors), 0), False).to_numpy(zero_copy_only=False)
    place, names = np.full(len(ids), len(ids), np.int64), np.zeros(len(ids), np.int64)
    place[listed], known = toplists._ranks(ids.filter(pa.array(listed)))
    names[signed], people = toplists._ranks(authors.filter(pa.array(signed)))
    for n in range(1, max_n + 1):
        some = np.flatnonzero(mask >> (n - 1) & 1)
        if not len(some):
            continue
        grams_of, article = [c[some] for c in columns[:n]], own[some]
        key = grams.keys(grams_of)
        # stable: what an article has of a gram stays together
        by = np.argsort(key, kind="stable")
        key, article = key[by], article[by]
        pairs, starts = np.flatnonzero(grams.changes(key, article)), np.flatnonzero(grams.changes(key))
        tf, df = np.diff(np.append(starts, len(key))), np.diff(np.append(np.searchsorted(pairs, starts), len(pairs)))
        keep = df >= 2 if rows[0]["document_count"] >= 2 else df >= 1
        group = np.repeat(np.cumsum(keep) - 1, df)[np.repeat(keep, df)]
        article, first = article[pairs][np.repeat(keep, df)], by[starts[keep]]
        tf, df, total = tf[keep], df[keep], int(keep.sum())
        article = article[np.argsort(group * (len(ids) + 1) + place[article], kind="stable")]
        with_id = np.flatnonzero(listed[article])
        with_id = with_id[toplists._first_of(group[with_id], max_articles)]
        named = np.flatnonzero(signed[article])
        g, name, at = group[named], names[article[named]], place[article[named]]
        # an author's first article, then the authors that come first
        by = np.lexsort((at, name, g))
        by = by[toplists._first_of(grams.keys([g[by], name[by]]), 1)] if len(by) else by
        by = by[np.lexsort((name[by], at[by], g[by]))]
        by = by[toplists._first_of(g[by], max_authors)]
        by = by[np.lexsort((name[by], g[by]))]
        batch = pa.RecordBatch.from_arrays(
            [
                pa.array([rows[0]["date"]] * total, pa.date32()),
                grams.strings(words.dictionary, [c[first] for c in grams_of]).cast(pa.string()),
                pa.array(tf.astype(np.int64)),
                pa.array(df.astype(np.int64)),
                toplists._lists(group[with_id], known.take(pa.array(place[article[with_id]])), total),
                toplists._lists(g[by], people.take(pa.array(name[by])), total),
            ],
            ["date", "term", "tf", "df", "article_ids", "authors"],
        )
        ends, first = np.cumsum(df), 0
        while first < total:
            last = max(int(np.searchsorted(ends, (ends[first - 1] if first else 0) + ENTRIES, "right")), first + 1)
            yield batch.slice(first, last - first)
            first = last


def whole_terms(articles: DataFrame, text: Column, days: DataFrame, max_articles: int | None, max_authors: int | None, **term_options) -> DataFrame:
    """``daystats.day_terms`` without a cap of terms, from the texts of ``articles`` (date, article_id, author).

    Texts are moved once, into ranges of days, so that the windows of a piece are those of few days and share their words; then
    windows are. The bytes of the texts of each day are one number for each calendar day.
    """
    rules, bounds = grams.Rules.of(**term_options), toplists._bounds(max_articles, max_authors)
    rows = articles.where(F.col("date").isNotNull()).select("date", "article_id", "author", text.alias("text"))
    sizes = rows.groupBy("date").agg(F.sum(F.octet_length("text")).alias("size")).collect()
    slices = {int((np.datetime64(r.date, "D") - _EPOCH).astype(int)): -(-(r.size or 1) // SIZE) or 1 for r in sizes}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from blocks(batch, rules, slices)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for k in range(batch.num_rows):
                (row,) = batch.slice(k, 1).to_pylist()
                if held and (held[0]["date"], held[0]["slice"]) != (row["date"], row["slice"]):
                    yield from _whole(held, rules.max_n, *bounds)
                    held = []
                held.append(row)
        if held:
            yield from _whole(held, rules.max_n, *bounds)

    n = int(articles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, "date", "article_id")
    # one fixed-width row per calendar date
    sized = ranged.mapInArrow(cut, _BLOCKS).join(F.broadcast(days.select("date", "document_count")), "date")
    return sized.repartition(n, "date", "slice").sortWithinPartitions("date", "slice").mapInArrow(summed, _WHOLE)
