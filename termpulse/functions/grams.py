"""Kept n-grams of many texts at once, as arrays of numbers.

Tokens are found on the bytes of the texts and numbered in the order of their strings, so a gram is a row of numbers (0:
no further token) and grams sort as their joined strings do: the space that joins tokens is less than any character of a
token. Strings are made for different grams only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from termpulse import fixed_values as fixed

COUNTS = pa.list_(pa.struct([("term", pa.string()), ("tf", pa.int64())]))
#: Bytes of text that are worked on at once; a longer text is worked on alone.
PIECE = 1 << 22

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_LETTER = (_LOWER >= 97) & (_LOWER <= 122)
_ALNUM = _LETTER | ((_BYTES >= 48) & (_BYTES <= 57))
_INNER = _ALNUM | (_BYTES == ord("'")) | (_BYTES == ord("-"))
#: CRC-32 of one byte, and the length up to which words are hashed together.
_CRC = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)
_SHORT = 32


@dataclass(frozen=True)
class Rules:
    """Which grams are kept; see ``text.with_terms``."""

    stopwords: tuple[str, ...] = fixed.STOPWORDS
    allowlist: tuple[str, ...] = fixed.ALLOWLIST
    max_n: int = fixed.MAX_N
    min_token_len: int = fixed.MIN_TOKEN_LEN

    @classmethod
    def of(cls, stopwords: Iterable[str] = fixed.STOPWORDS, allowlist: Iterable[str] = fixed.ALLOWLIST, **more) -> Rules:
        return cls(tuple(sorted(set(stopwords))), tuple(sorted(set(allowlist))), **more)


def pieces(texts: pa.Array, most: int | None = None) -> Iterator[tuple[int, int]]:
    """(first, size) of slices of about ``most`` bytes, or ``PIECE``."""
    most = PIECE if most is None else most
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = max(int(np.searchsorted(ends, before + most, "right")), first + 1)
        yield first, last - first
        first = last


def _spans(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(all places from each ``first`` to its ``last``, where each span starts among them)."""
    ends = np.cumsum(last - first + 1)
    starts = np.concatenate([[0], ends[:-1]])
    return np.arange(ends[-1]) + np.repeat(first - starts, last - first + 1), starts


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(text of each token, its number in the vocabulary, the vocabulary in order), by ``fixed.TOKEN_PATTERN``.

    A run of inner characters holds one token at most: from its first letter to its last letter or digit.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    n = len(texts)
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[bounds[0] : bounds[-1]] if raw is not None else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    # a run ends with its text
    inner, cut = np.frombuffer(data.tobytes().translate(_INNER.tobytes()), bool), np.zeros(len(data) + 1, dtype=bool)
    cut[bounds] = True
    begins, stops = inner.copy(), inner.copy()
    begins[1:] &= ~inner[:-1] | cut[1:-1]
    stops[:-1] &= ~inner[1:] | cut[1:-1]
    begin, stop = np.flatnonzero(begins), np.flatnonzero(stops)
    odd = np.flatnonzero(~_LETTER[data[begin]])
    if len(odd):
        at, starts = _spans(begin[odd], stop[odd])
        begin[odd] = np.minimum.reduceat(np.where(_LETTER[data[at]], at, len(data)), starts)
        some = begin <= stop
        begin, stop = begin[some], stop[some]
    odd = np.flatnonzero(~_ALNUM[data[stop]])
    if len(odd):
        at, starts = _spans(begin[odd], stop[odd])
        stop[odd] = np.maximum.reduceat(np.where(_ALNUM[data[at]], at, 0), starts)
    sizes = stop - begin + 1
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    edges = np.zeros(len(data) + 1, np.int8)
    edges[begin] += 1
    edges[stop + 1] -= 1
    chars = data[np.cumsum(edges[:-1], dtype=np.int8).view(bool)].tobytes().translate(_LOWER.tobytes())
    words = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(chars))
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    ranks = np.empty(len(order), dtype=np.int32)
    ranks[order] = np.arange(len(order))
    codes = ranks[coded.indices.to_numpy(zero_copy_only=False)] if len(sizes) else np.zeros(0, np.int32)
    owner = np.repeat(np.arange(n, dtype=np.int32), np.diff(np.searchsorted(begin, bounds)))
    return owner, codes, coded.dictionary.take(pa.array(order)).cast(pa.string())


def places(owner: np.ndarray, codes: np.ndarray, vocabulary: pa.Array, rules: Rules) -> Iterator[tuple[int, np.ndarray]]:
    """For each length n the tokens at which a kept gram of n tokens begins, in order."""
    short = pc.less(pc.binary_length(vocabulary), rules.min_token_len).to_numpy(zero_copy_only=False)
    stop = pc.is_in(vocabulary, value_set=pa.array(rules.stopwords, pa.string())).to_numpy(zero_copy_only=False) & ~short
    asked = [a.split(" ") for a in rules.allowlist]
    words = pa.array(sorted({w for a in asked for w in a}), pa.string())
    at = pc.index_in(vocabulary, value_set=words)
    numbers = dict(zip(words.take(at.drop_null()).to_pylist(), np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False)).tolist()))
    listed_grams = [np.array([numbers[w] for w in a]) for a in asked if all(w in numbers for w in a)]
    # the others are kept anyway
    listed_grams = [gram for gram in listed_grams if short[gram].any() or stop[gram].all()]
    short, stop = short[codes], stop[codes]
    any_short, all_stop = np.zeros(len(codes), bool), np.ones(len(codes), bool)
    for n in range(1, rules.max_n + 1):
        last = max(len(codes) - n + 1, 0)
        any_short, all_stop = any_short[:last] | short[n - 1 :], all_stop[:last] & stop[n - 1 :]
        good = ~(any_short | all_stop)
        for gram in (g for g in listed_grams if len(g) == n):
            listed = np.flatnonzero(codes[:last] == gram[0])
            for k, word in enumerate(gram[1:], 1):
                listed = listed[codes[listed + k] == word]
            good[listed] = True
        yield n, np.flatnonzero(good & (owner[:last] == owner[n - 1 :]))


def columns_at(codes: np.ndarray, n: int, at: np.ndarray, max_n: int) -> list[np.ndarray]:
    """The tokens of grams of ``n`` tokens as ``max_n`` columns of numbers from 1."""
    return [codes[at + k].astype(np.int64) + 1 if k < n else np.zeros(len(at), np.int64) for k in range(max_n)]


def kept(texts: pa.Array, rules: Rules) -> tuple[np.ndarray, list[np.ndarray], pa.Array]:
    """(text of each kept gram, its tokens as ``max_n`` columns of numbers from 1, the vocabulary); texts ascend for each length."""
    owner, codes, vocabulary = tokens(texts)
    found = [(owner[at].astype(np.int64), columns_at(codes, n, at, rules.max_n)) for n, at in places(owner, codes, vocabulary, rules)]
    return np.concatenate([o for o, _ in found]), [np.concatenate(c) for c in zip(*(c for _, c in found))], vocabulary


def keys(columns: list[np.ndarray]) -> np.ndarray:
    """One number for each row of ``columns``, in their order."""
    key, top = columns[0].astype(np.int64), int(columns[0].max(initial=0)) + 1
    for c in columns[1:]:
        width = int(c.max(initial=0)) + 1
        if top * width >= 1 << 62:
            found, key = np.unique(key, return_inverse=True)
            top = len(found)
        key, top = key * width + c, top * width
    return key


def changes(*columns: np.ndarray) -> np.ndarray:
    """Whether each row differs from the one before in any column."""
    out = np.ones(len(columns[0]), dtype=bool)
    if len(out):
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def strings(vocabulary: pa.Array, columns: list[np.ndarray]) -> pa.Array:
    """Grams as their tokens joined by spaces."""
    words = [vocabulary.take(pa.array(c - 1, mask=c == 0)) for c in columns]
    return pc.binary_join_element_wise(*words, " ", null_handling="skip")


def counts(texts: pa.Array, rules: Rules) -> pa.ListArray:
    """For each text its kept grams in order, with how often they occur."""
    owner, columns, vocabulary = kept(texts, rules)
    key = keys([owner, *columns])
    by = np.argsort(key, kind="stable")
    starts = np.flatnonzero(changes(key[by]))
    tf, first = np.diff(np.append(starts, len(by))), by[starts]
    entries = pa.StructArray.from_arrays([strings(vocabulary, [c[first] for c in columns]), pa.array(tf.astype(np.int64))], fields=list(COUNTS.value_type))
    offsets = np.searchsorted(owner[first], np.arange(len(texts) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), entries)


def top(texts: pa.Array, rules: Rules, n: int | None) -> pa.ListArray:
    """The ``n`` most frequent entries of ``counts`` of each text, by (-tf, term); strings are made for these only."""
    owner, columns, vocabulary = kept(texts, rules)
    key = keys([owner, *columns])
    by = np.argsort(key, kind="stable")
    starts = np.flatnonzero(changes(key[by]))
    tf, first = np.diff(np.append(starts, len(by))), by[starts]
    # stable: terms of a count stay in their order
    by = np.lexsort((-tf, owner[first]))
    tf, first = tf[by], first[by]
    offsets = np.searchsorted(owner[first], np.arange(len(texts) + 1))
    if n is not None:
        some = np.arange(len(first)) - np.repeat(offsets[:-1], np.diff(offsets)) < n
        tf, first = tf[some], first[some]
        offsets = np.searchsorted(owner[first], np.arange(len(texts) + 1))
    entries = pa.StructArray.from_arrays([strings(vocabulary, [c[first] for c in columns]), pa.array(tf.astype(np.int64))], fields=list(COUNTS.value_type))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), entries)


def dated(texts: pa.Array, dates: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(place of each text, its day number, then ``tokens`` of the texts by date); a null date is none."""
    valid = np.flatnonzero(pc.is_valid(dates).to_numpy(zero_copy_only=False))
    days = dates.take(pa.array(valid)).cast(pa.int32()).to_numpy(zero_copy_only=False)
    by_date = np.argsort(days, kind="stable")
    place, days = valid[by_date], days[by_date]
    return place, days, *tokens(texts.take(pa.array(place)))


def word_hashes(words: pa.Array) -> np.ndarray:
    """CRC-32 of each word: of short ones byte by byte for all of them at once."""
    words = words.cast(pa.large_string())
    ends = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)
    sizes = np.diff(ends)
    by = np.argsort(sizes, kind="stable")
    sizes, starts = sizes[by], ends[:-1][by]
    found = np.full(len(by), 0xFFFFFFFF, np.uint32)
    for k in range(min(int(sizes.max(initial=0)), _SHORT)):
        first = int(np.searchsorted(sizes, k, "right"))
        some = found[first:]
        found[first:] = _CRC[(some ^ data[starts[first:] + k]) & 0xFF] ^ (some >> 8)
    found ^= 0xFFFFFFFF
    for k in range(int(np.searchsorted(sizes, _SHORT, "right")), len(by)):
        found[k] = zlib.crc32(data[starts[k] : starts[k] + sizes[k]].tobytes())
    out = np.empty(len(by), np.uint32)
    out[by] = found
    return out


def hashes(owner: np.ndarray, codes: np.ndarray, vocabulary: pa.Array, rules: Rules) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``places`` with a number of 32 bits for each gram."""
    words = word_hashes(vocabulary)[codes]
    out = np.zeros(len(codes), np.uint32)
    for n, at in places(owner, codes, vocabulary, rules):
        # numbers of 32 bits wrap around
        out = out[: max(len(codes) - n + 1, 0)] * np.uint32(31) + words[n - 1 :]
        yield n, at, out[at]


def totals(texts: pa.Array, dates: pa.Array, rules: Rules, asked=None) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Day number, hash, term, occurrences and texts of each different (date, gram), by gram; a null date is none.

    Only grams for which ``asked(day of each text)(text, hash)`` holds are counted, if it is given.
    """
    _, dates, owner, codes, vocabulary = dated(texts, dates)
    chosen, found = None if asked is None else asked(dates), []
    for n, at, own in hashes(owner, codes, vocabulary, rules):
        if chosen is not None:
            some = np.flatnonzero(chosen(owner[at], own))
            at, own = at[some], own[some]
        found.append((owner[at], own, columns_at(codes, n, at, rules.max_n)))
    owner, own = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    columns = [np.concatenate(c) for c in zip(*(f[2] for f in found))]
    key = keys(columns)
    # stable: the texts of a gram stay in the order of their dates
    by = np.argsort(key, kind="stable")
    key, owner = key[by], owner[by]
    day = dates[owner]
    starts = np.flatnonzero(changes(key, day))
    tf, first = np.diff(np.append(starts, len(by))), by[starts]
    df = np.add.reduceat(changes(key, owner).astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)
    return day[starts], own[first].astype(np.int64), strings(vocabulary, [c[first] for c in columns]), tf.astype(np.int64), df


def _mixed(hashes, words):
    return (hashes * 31 + words) & 0xFFFFFFFF


def hashed(term: str) -> int:
    """The hash that ``totals`` gives a term."""
    out = 0
    for word in term.split(" "):
        out = _mixed(out, zlib.crc32(word.encode()))
    return out


class Wanted:
    """Given (day number, term) pairs, to be found among the grams of texts: a tree of the terms' words."""

    def __init__(self, days: np.ndarray, terms: pa.Array):
        coded = terms.dictionary_encode()
        self.terms = coded.dictionary
        self.days = np.unique(days)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        self.pairs = np.unique(np.searchsorted(self.days, days).astype(np.int64) * len(self.terms) + codes)
        words: dict[str, int] = {}
        edges: dict[tuple[int, int], int] = {}
        ends = {}
        for k, term in enumerate(self.terms.to_pylist()):
            node = 0
            for word in term.split(" "):
                node = edges.setdefault((node, words.setdefault(word, len(words) + 1)), len(edges) + 1)
            ends[node] = k
        self.words, self.width = pa.array(list(words), pa.string()), len(words) + 1
        found = sorted((node * self.width + word, child) for (node, word), child in edges.items())
        self.edges, self.children = (np.array([e[k] for e in found], np.int64) for k in (0, 1))
        self.firsts = np.full(self.width, -1, np.int64)
        self.firsts[[word for node, word in edges if not node]] = [child for (node, _), child in edges.items() if not node]
        self.ends = np.full(len(edges) + 1, -1, np.int64)
        self.ends[list(ends)] = list(ends.values())

    def met(self, texts: pa.Array, dates: pa.Array, rules: Rules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the text, day number, number of the term) of each wanted pair that a text has, by day, text and term."""
        place, days, owner, codes, vocabulary = dated(texts, dates)
        known = pc.fill_null(pc.index_in(vocabulary, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        known = (known + 1)[codes]
        found = []
        for n, at in places(owner, codes, vocabulary, rules):
            node = self.firsts[known[at]]
            for k in range(1, n):
                at, node = at[node >= 0], node[node >= 0]
                edge = node * self.width + known[at + k]
                there = np.minimum(np.searchsorted(self.edges, edge), len(self.edges) - 1)
                node = np.where(self.edges[there] == edge, self.children[there], -1)
            at, node = at[node >= 0], node[node >= 0]
            found.append((owner[at].astype(np.int64), self.ends[node]))
        owner, term = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        owner, term = owner[term >= 0], term[term >= 0]
        if not len(term):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), term
        n = len(self.terms)
        met = np.unique(owner * n + term)
        owner, term = met // n, met % n
        day = np.searchsorted(self.days, days[owner])
        inside = day < len(self.days)
        inside[inside] = self.days[day[inside]] == days[owner][inside]
        pair = day * n + term
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        some = np.flatnonzero(inside & (self.pairs[at] == pair))
        return place[owner[some]], days[owner[some]].astype(np.int64), term[some]
