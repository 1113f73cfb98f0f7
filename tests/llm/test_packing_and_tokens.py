import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import helpers as h
from termpulse.llm import huffman, packing, queries, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def expected_pieces(rows, plain):
    for doc_id, text in rows:
        ids = [*plain(text), 1]
        for k, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            yield doc_id, k, start, len(part), crc(part)


def check_sequences(rows, capacity=4096):
    """Rows (length, sequence, offset): gapless, within the capacity, few."""
    found = defaultdict(list)
    for length, sequence, offset in rows:
        found[sequence].append((offset, length))
    for pieces in found.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(found)


def test_words_give_the_ids_of_the_text(plain):
    encoder = tokens.Encoder(PATH, remembered=20)
    for text in ("Don't stop, it's fine.", "<|endoftext|> a<|ENDOFTEXT|>b,", "İstanbul ÀÉ́ 12.5 ... !! a_b.", "end.\nnext!é, x", "", " \n", "　\x1c 日本", "word" * 400):
        assert encoder.encode(text).tolist() == plain(text)
        assert tokens.Encoder(PATH, by_word=False).encode(text).tolist() == plain(text)


def test_fill_is_the_fullest():
    for available, room in (({5: 2, 3: 3}, 11), ({7: 1, 4: 1}, 10), ({2: 10}, 7), ({9: 1}, 8), ({}, 5)):
        sums = {0}
        for length, n in available.items():
            sums = {s + k * length for s in sums for k in range(n + 1)}
        content = packing.fill(available, room)
        assert sum(a * b for a, b in content) == max(s for s in sums if s <= room)
        assert all(b <= available[a] for a, b in content)


def test_patterns_place_every_piece():
    counts = dict(Counter(np.random.default_rng(3).integers(1, 101, 3000).tolist()))
    plan, placed = packing.patterns(counts, 100), Counter()
    for times, content in plan:
        assert sum(a * b for a, b in content) <= 100
        for length, n in content:
            placed[length] += times * n
    assert placed == counts
    assert sum(t for t, _ in plan) <= 1.02 * sum(k * v for k, v in counts.items()) / 100 + 1


@h.needs_data
def test_packing_query(spark, plain):
    rows = queries.op1_best_fit_packing(spark, h.SF).collect()
    assert sorted(tuple(r)[:5] for r in rows) == sorted(expected_pieces(h.texts(), plain))
    used = check_sequences([(r.length, r.sequence_id, r.offset) for r in rows])
    assert used <= -(-sum(r.length for r in rows) // 4096) + 1


def test_packing_of_edge_rows(spark, plain):
    pieces = packing.pieces(h.frame(spark, h.edge_rows(), clashing=True), PATH)
    packed = packing.pack(pieces.withColumn("rank", F.lit("mine")).withColumn("Part", F.lit("own")))
    rows = packed.collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    wanted = sorted(expected_pieces([r[:2] for r in h.edge_rows()], plain), key=key)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in rows), key=key) == wanted
    assert {r.rank for r in rows} == {"mine"} and {r.Part for r in rows} == {"own"}
    check_sequences([(r.length, r.sequence_id, r.offset) for r in rows])
    for s in packing.sequences(packed).collect():
        assert len(s.ids) == 4 * sum(s.lengths) <= 4 * 4096


def test_packing_of_nothing(spark):
    assert packing.pack(packing.pieces(h.frame(spark, []), PATH)).collect() == []


def test_code_lengths_are_the_best_within_the_limit():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 7, 40, 300):
        counts = (rng.pareto(0.6, n) * 10 + 1).astype(np.int64)
        free, short = huffman.code_lengths(counts, 60), huffman.code_lengths(counts, max(9, int(n - 1).bit_length()))
        assert (2.0**-free).sum() <= 1 and (2.0**-short).sum() <= 1 and short.max() <= max(9, int(n - 1).bit_length())
        import heapq

        heap, total = sorted(counts.tolist()), 0
        while len(heap) > 1:
            two = heapq.heappop(heap) + heapq.heappop(heap)
            total += two
            heapq.heappush(heap, two)
        assert n == 1 or (counts * free).sum() == total
        assert (counts * short).sum() >= (counts * free).sum()


def test_frames_round_trip():
    rng = np.random.default_rng(2)
    ids = np.minimum(rng.zipf(1.3, 5000), 900)
    met, counts = np.unique(ids, return_counts=True)
    codes = huffman.Codes(met, huffman.code_lengths(counts, 12))
    parts = [ids[:0], ids[:1], ids[1:257], ids[257:769], ids[769:]]
    frames = [huffman.encode_frame(p, *codes.of_ids()) for p in parts]
    for got, wanted in zip(huffman.decode_frames(frames, codes.table(), codes.bits), parts):
        assert got.tolist() == wanted.tolist()


def expected_binary(rows, plain):
    start = 0
    for doc_id, text in rows:
        ids = [*plain(text), 2]
        yield doc_id, start, len(ids), crc(ids)
        start += len(ids)


@h.needs_data
def test_binary_query(spark, plain):
    got = sorted(tuple(r) for r in queries.op4_token_binary(spark, h.SF).collect())
    assert got == list(expected_binary(sorted(h.texts()), plain))


def test_binary_of_edge_rows(spark, plain, tmp_path):
    huffman.write(h.frame(spark, h.edge_rows(), clashing=True), f"{tmp_path}/files", PATH, end_id=2)
    rows = sorted(huffman.read(spark, f"{tmp_path}/files").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 5, 5, 6, 7, 8, 9, 10]
    wanted = {r[0]: [*plain(r[1]), 2] for r in h.edge_rows()}
    start = 0
    for r in rows:
        assert r.ids == wanted[r.doc_id] and r.start == start
        start += len(r.ids)


def test_binary_of_nothing(spark, tmp_path):
    huffman.write(h.frame(spark, []), f"{tmp_path}/none", PATH, end_id=2)
    assert huffman.read(spark, f"{tmp_path}/none").collect() == []
