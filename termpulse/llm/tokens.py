"""Token ids of texts by a public tokenizer, with a bounded memory of words in each Python worker."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

from termpulse.llm.common import ragged

#: Bytes of words and their ids that a worker remembers; when full, it starts anew. A word costs about 170 besides its own.
REMEMBERED, WORD = 200 << 20, 170
#: Words encoded in one call, and characters of the texts whose new words are encoded together.
JOINED, TOGETHER = 500, 1 << 21
#: Signs that may close a word, after an unaccented letter. The apostrophe, which may begin a part of its own, is left out.
SIGNS = b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
LETTER, SIGN, SPACE = 1, 2, 3
KINDS = np.zeros(256, dtype=np.uint8)
for kind, octets in ((LETTER, b"abcdefghijklmnopqrstuvwxyz"), (SIGN, SIGNS), (SPACE, b" \t\n\x0b\x0c\r")):
    KINDS[list(octets)] = kind


def signs_apart(raw: bytes) -> bytes:
    """A space before each run of signs between an unaccented letter and white space."""
    octets = np.frombuffer(raw, dtype=np.uint8)
    kinds = KINDS[octets]
    sign = kinds == SIGN
    starts = np.flatnonzero(sign[1:] & (kinds[:-1] == LETTER)) + 1
    if not len(starts):
        return raw
    last = np.flatnonzero(sign[:-1] & ~sign[1:])
    # a run that ends the text is not followed by white space
    run = np.searchsorted(last, starts)
    starts = starts[run < len(last)]
    closing = kinds[last[run[: len(starts)]] + 1] == SPACE
    return np.insert(octets, starts[closing], 32).tobytes()


class _Numbers(dict):
    """Numbers new words in the order in which they are met, and lists them."""

    def __init__(self):
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class Encoder:
    """Encodes whole texts to ids.

    ``by_word`` is for vocabularies that drop white space, lower letters and part signs from letters (such as
    word_bpe_49k): there the ids of a text are those of its words in a row, and those of a word are its letters' and then
    its closing signs'. So each different word is encoded once and then looked up. Other vocabularies encode the
    whole text.
    """

    def __init__(self, path: str, by_word: bool = True, remembered: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word, self.remembered = by_word, remembered
        ending = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix") if by_word else None
        self.ends = None
        if ending:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
            self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self.ends[[i for token, i in vocabulary.items() if token.endswith(ending)]] = True
        self._forget()

    def _forget(self) -> None:
        self.known = _Numbers()
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.first = np.zeros(1 << 14, dtype=np.int64)
        self.count = np.zeros(1 << 14, dtype=np.int64)
        self.used = self.bytes = 0

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self) -> None:
        """Encode the words that are new."""
        texts, first_new = [w.decode("utf-8") for w in self.known.new], len(self.known) - len(self.known.new)
        self.bytes += sum(map(len, self.known.new)) + WORD * len(self.known.new)
        self.known.new = []
        letters = [self.ends is not None and w.isalpha() for w in texts]
        joined = [k for k, x in enumerate(letters) if x]
        alone = [k for k, x in enumerate(letters) if not x]
        for first in range(0, len(joined), JOINED):
            some = joined[first : first + JOINED]
            ids = np.array(self._ids([" ".join([texts[k] for k in some])])[0], dtype=np.uint32)
            ends = np.flatnonzero(self.ends[ids]) + 1
            # every word has an end at least, so equal numbers mean one for each
            if len(ends) == len(some) and ends[-1] == len(ids):
                self._add(first_new + np.array(some), ids, np.diff(ends, prepend=0))
            else:
                alone += some
        if alone:
            ids = self._ids([texts[k] for k in alone])
            counts = np.array([len(own) for own in ids], dtype=np.int64)
            self._add(first_new + np.array(alone), np.array([i for own in ids for i in own], dtype=np.uint32), counts)

    def _add(self, numbers: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.known) > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.count = np.concatenate([self.count, np.zeros_like(self.count)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.first[numbers] = self.used + np.cumsum(counts) - counts
        self.count[numbers] = counts
        self.used += len(ids)
        self.bytes += 4 * len(ids)

    def _index(self, text: str) -> np.ndarray:
        """The numbers of a text's words."""
        raw = text.encode("utf-8")
        # special strings must keep their case and signs to be told from others
        words = (raw if b"<|" in raw else signs_apart(raw.lower())).split()
        return np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))

    def encode_all(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text. New words of texts of ``TOGETHER`` characters are encoded together."""
        if not self.by_word:
            yield from (np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, dtype=np.uint32) for t in texts)
            return
        held, size = [], 0

        def found() -> Iterator[np.ndarray]:
            if self.known.new:
                self._learn()
            yield from (self.flat[ragged(self.first[index], self.count[index])] for index in held)
            if self.bytes > self.remembered:
                self._forget()

        for text in texts:
            held.append(self._index(text))
            size += len(text)
            if size >= TOGETHER:
                yield from found()
                held, size = [], 0
        yield from found()

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_all([text]))


@lru_cache(maxsize=2)
def encoder(path: str, by_word: bool = True) -> Encoder:
    """The encoder of a worker; its words are remembered from task to task."""
    return Encoder(path, by_word)
