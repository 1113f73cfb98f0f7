"""Totals and bounded lists of each (date, term) as one mergeable aggregate.

A bound of None keeps whole lists. A state is a row ``date, term, tf, df, articles, authors``: sums, the smallest article ids and the authors that appear
first, each with the id of their first article. Two states merge into one of the same bounds, so lists need no ranking of
all occurrences: every task folds its articles into states, only states are shuffled, and a second fold merges those of a
term. A term that is in every article of a day is at most one state of bounded size for each ``HELD`` rows of a task.

The folds work on whole Arrow columns (dictionary codes and sorts of numbers), as no built-in aggregate keeps the k
smallest values of a group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termpulse import fixed_values as fixed

STATE = "date date, term string, tf bigint, df bigint, articles array<string>, authors array<struct<author:string,first:string>>"
_AUTHOR = pa.struct([("author", pa.string()), ("first", pa.string())])
_SCHEMA = pa.schema(
    [("date", pa.date32()), ("term", pa.string()), ("tf", pa.int64()), ("df", pa.int64()), ("articles", pa.list_(pa.string())), ("authors", pa.list_(_AUTHOR))]
)
#: List entries and rows that a fold holds before it merges them.
HELD = 1 << 20
#: Stands for the first article of an author whose articles have no id; after every id.
LAST = "\U0010ffff"
#: Rows of one article and term that are folded at once.
PIECE = 1 << 18


def _bounds(max_articles: int | None, max_authors: int | None) -> tuple[int, int]:
    """Lists without a bound are whole."""
    return tuple(1 << 62 if n is None else n for n in (max_articles, max_authors))


def _ranks(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(rank of each value among the different ones, those in order)."""
    coded = values.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    ranks = np.empty(len(order), dtype=np.int64)
    ranks[order.to_numpy()] = np.arange(len(order))
    return ranks[coded.indices.to_numpy(zero_copy_only=False)] if len(values) else np.zeros(0, np.int64), coded.dictionary.take(order)


def _first_of(group: np.ndarray, limit: int) -> np.ndarray:
    """Positions of the first ``limit`` rows of each group; groups stand together."""
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(group)))
    return np.flatnonzero(np.arange(len(group)) - np.repeat(starts, sizes) < limit)


def _lists(group: np.ndarray, values: pa.Array, n: int) -> pa.ListArray:
    """One list for each of ``n`` groups; ``group`` is ascending."""
    offsets = np.searchsorted(group, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def fold(
    date: pa.Array,
    term: pa.Array,
    tf: np.ndarray,
    df: np.ndarray,
    articles: tuple[np.ndarray, pa.Array],
    authors: tuple[np.ndarray, pa.Array, pa.Array],
    max_articles: int,
    max_authors: int,
) -> pa.RecordBatch:
    """States of rows: ``articles`` are (row, id) and ``authors`` (row, author, first article) entries."""
    days, terms = date.cast(pa.int32()).dictionary_encode(), term.dictionary_encode()
    codes = days.indices.to_numpy(zero_copy_only=False).astype(np.int64) * max(len(terms.dictionary), 1) + terms.indices.to_numpy(zero_copy_only=False)
    keys, group = np.unique(codes, return_inverse=True)
    n, order = len(keys), np.argsort(group, kind="stable")
    starts = np.searchsorted(group[order], np.arange(n))
    sums = [np.add.reduceat(x[order], starts) if n else np.zeros(0, np.int64) for x in (tf, df)]

    own, ids = group[articles[0]], _ranks(articles[1])
    by = np.lexsort((ids[0], own))
    by = by[_first_of(own[by], max_articles)]
    listed = _lists(own[by], ids[1].take(pa.array(ids[0][by])), n)

    own, names, firsts = group[authors[0]], _ranks(authors[1]), _ranks(authors[2])
    by = np.lexsort((firsts[0], names[0], own))
    # an author's first article, then the authors that come first
    by = by[_first_of(own[by] * max(len(names[1]), 1) + names[0][by], 1)]
    by = by[np.lexsort((names[0][by], firsts[0][by], own[by]))]
    by = by[_first_of(own[by], max_authors)]
    people = pa.StructArray.from_arrays([names[1].take(pa.array(names[0][by])), firsts[1].take(pa.array(firsts[0][by]))], fields=list(_AUTHOR))
    at, wide = pa.array(keys // max(len(terms.dictionary), 1)), pa.array(keys % max(len(terms.dictionary), 1))
    columns = [days.dictionary.take(at).cast(pa.date32()), terms.dictionary.take(wide), *map(pa.array, sums), listed, _lists(own[by], people, n)]
    return pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)


def _entries(lists: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), sizes), lists.flatten()


def _fold_states(batches: list[pa.RecordBatch], max_articles: int, max_authors: int) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches).combine_chunks()
    column = lambda name: table.column(name).chunk(0) if table.num_rows else pa.array([], _SCHEMA.field(name).type)
    rows, people = _entries(column("authors"))
    numbers = [column(c).to_numpy(zero_copy_only=False) for c in ("tf", "df")]
    return fold(column("date"), column("term"), *numbers, _entries(column("articles")), (rows, people.field(0), people.field(1)), max_articles, max_authors)


def _size(batch: pa.RecordBatch) -> int:
    return batch.num_rows + len(batch.column(4).flatten()) + len(batch.column(5).flatten())


def states(
    counts: DataFrame, max_articles: int | None = fixed.MAX_ARTICLES_PER_TERM, max_authors: int | None = fixed.MAX_AUTHORS_PER_TERM
) -> DataFrame:
    """Partial states of ``counts`` (date, article_id, author, term_counts), folded within each task. No shuffle.

    An article without terms gives none; one without an author names none, one without an id is counted but not listed, and
    its author comes after all others. A null date is no day. Tasks take rows of one term each, so what a
    fold holds is bounded by ``PIECE`` and ``HELD`` and not by the terms of the articles that come together.
    """
    terms = counts.select("date", "article_id", "author", F.inline("term_counts")).where(F.col("date").isNotNull() & F.col("term").isNotNull())
    return terms.mapInArrow(folds(max_articles, max_authors), STATE)


def folds(max_articles: int | None, max_authors: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What turns the rows ``date, article_id, author, term, tf`` of a task into states."""
    bounds = _bounds(max_articles, max_authors)

    def folded(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        date, ids, author, term, tf = (c.combine_chunks() for c in pa.Table.from_batches(batches).columns)
        signed = np.flatnonzero(pc.fill_null(pc.greater(pc.utf8_length(author), 0), False).to_numpy(zero_copy_only=False))
        people = (signed, author.take(pa.array(signed)), pc.fill_null(ids.take(pa.array(signed)), LAST))
        listed = np.flatnonzero(pc.is_valid(ids).to_numpy(zero_copy_only=False))
        articles = (listed, ids.take(pa.array(listed)))
        return fold(date, term, tf.to_numpy(zero_copy_only=False), np.ones(len(term), np.int64), articles, people, *bounds)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[pa.RecordBatch] = []
        held: list[pa.RecordBatch] = []
        for batch in batches:
            rows.append(batch)
            if sum(b.num_rows for b in rows) < PIECE:
                continue
            held.append(folded(rows))
            rows = []
            if sum(map(_size, held)) > HELD:
                held = [_fold_states(held, *bounds)]
                if _size(held[0]) > HELD // 2:
                    yield held.pop()
        if rows:
            held.append(folded(rows))
        if held:
            yield _fold_states(held, *bounds)

    return partial


def merged(
    partial: DataFrame, max_articles: int | None = fixed.MAX_ARTICLES_PER_TERM, max_authors: int | None = fixed.MAX_AUTHORS_PER_TERM
) -> DataFrame:
    """One state for each (date, term) of ``partial`` states: one exchange on (date, term), then folds in its order.

    A term with very many states is folded as they come, so a task holds one state of it and a batch.
    """
    bounds = _bounds(max_articles, max_authors)
    n = int(partial.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = partial.repartition(n, "date", "term").sortWithinPartitions("date", "term")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, _SCHEMA)], schema=_SCHEMA)
            found = _fold_states([rest, batch] if rest is not None else [batch], *bounds)
            # the last key may go on in the next batch
            last = batch.slice(batch.num_rows - 1)
            same = pc.and_(pc.equal(found.column(0), last.column(0)[0]), pc.equal(found.column(1), last.column(1)[0]))
            rest = found.filter(same)
            yield found.filter(pc.invert(same))
        if rest is not None:
            yield rest

    return dealt.mapInArrow(merge, STATE)


def published(found: DataFrame) -> DataFrame:
    """Merged states with ``article_ids`` and ``authors`` as sorted arrays."""
    names = F.array_sort(F.transform("authors", lambda a: a["author"]))
    return found.select("date", "term", "tf", "df", F.col("articles").alias("article_ids"), names.alias("authors"))
