import hashlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from checks import compare
from tests.llm import helpers as h
from termpulse.llm import common, decontaminate, exact, queries, simhash, substring
from termpulse.llm.components import components


@pytest.fixture(scope="module")
def con():
    return compare.duck(h.SF)


@h.needs_data
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, con, name):
    df = queries.QUERIES[name](spark, h.SF)
    mine = compare.rows_of(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(queries.SQL[name])
    assert mine == compare.rows_of([c[0] for c in found.description], found.fetchall())


# ---- exact


def test_exact_groups_of_edge_rows(spark):
    extra = [(20, "a b c", "x", "x", 1), (21, " abc  ", "x", "x", 1), (22, "ab\tc", "x", "x", 1), (None, " abc  ", "x", "x", 1), (23, "abd", "x", "x", 1)]
    rows = exact.groups(h.frame(spark, h.edge_rows() + extra, clashing=False)).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.text_sha256].append(r)
    abc = by[hashlib.sha256(b"abc").hexdigest()]
    assert len(abc) == 4 and {(r.keep_id, r.group_size) for r in abc} == {(21, 4)} and sum(r.row == r.keep_row for r in abc) == 1
    empty = by[hashlib.sha256(b"").hexdigest()]
    assert len(empty) == 3 and {r.keep_id for r in empty} == {4}
    same = [r for r in rows if r.doc_id in (1, 5)]
    assert {r.group_size for r in same} == {3} and {r.keep_id for r in same} == {1}
    assert len(rows) == len(h.edge_rows()) + 5


def test_exact_keeps_columns_and_one_of_each(spark):
    rows = exact.deduplicate(h.frame(spark, h.edge_rows(), clashing=True)).collect()
    assert len(rows) == 8 and all(r.row == "kept" and r.q == "kept" for r in rows)
    assert exact.deduplicate(h.frame(spark, [])).collect() == []


def test_exact_tells_clashing_chunks_apart(spark):
    """Two chunks that share an identifier are one only if their digests are equal."""
    rows = [(1, 10, 5, "s1", [(7, b"a"), (8, b"b")]), (2, 11, 5, "s2", [(7, b"z"), (8, b"b")]), (3, 12, 5, "s1", [(7, b"a"), (8, b"b")]), (4, 13, 0, "s0", [])]
    df = spark.createDataFrame(rows, "row long, doc_id long, n_chars long, text_sha256 string, recipe array<struct<id: long, digest: binary>>")
    keys = {r.row: [tuple(k) for k in r.key] for r in exact.verified(df).collect()}
    assert keys[1] == keys[3] != keys[2] and keys[4] == [] and keys[1][1] == keys[2][1]


def test_chunks_are_the_text(spark):
    text = "".join(f"word{k}{',' if k % 97 == 0 else ''}" for k in range(6000)) + "\U0001f642" * 9000
    df = spark.createDataFrame([(text,), ("",)], "t string")
    chunks = [r.c for r in df.select(F.regexp_extract_all("t", F.lit(exact.CHUNK), F.lit(0)).alias("c")).collect()]
    assert "".join(chunks[0]) == text and max(map(len, chunks[0])) <= exact.MOST and len(chunks[0]) > 5 and chunks[1] == []


# ---- substrings


def plain_removal(rows, window):
    """Smallest id by window, then the words left of each row."""
    first = {}
    words = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in words:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if d is not None:
                first[key] = min(d, first.get(key, d))
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        out.append((d, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=repr)


def removed(spark, rows, window):
    df = spark.createDataFrame([(d, t) for d, t in rows], "doc_id long, text string")
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring.cleaned(df, window).collect()), key=repr)


@h.needs_data
def test_substring_query(spark):
    got = sorted(tuple(r) for r in queries.op5_substring_dedup(spark, h.SF).collect())
    assert got == sorted((d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in plain_removal(h.texts(), 50))


def test_substring_small_windows(spark):
    rng = np.random.default_rng(4)
    passages = [[f"p{k}_{i}" for i in range(rng.integers(5, 25))] for k in range(6)] + [["same"] * 20, ["a", "b"] * 12]
    rows = []
    for d in range(60):
        words = []
        for _ in range(4):
            words += [f"u{rng.integers(0, 50)}" for _ in range(rng.integers(0, 9))]
            p = passages[rng.integers(0, len(passages))]
            words += p[rng.integers(0, 3) : len(p) - rng.integers(0, 3)]
        rows.append((int(d % 50) if d % 13 else None, " ".join(words)))
    for window in (7, 12):
        assert removed(spark, rows, window) == plain_removal(rows, window)


def test_substring_edge_rows(spark):
    rows = [r[:2] for r in h.edge_rows()]
    assert removed(spark, rows, 50) == plain_removal(rows, 50)
    assert removed(spark, [], 50) == []


# ---- near-duplicates


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] * bool(words)
    totals = [0] * 64
    for p in parts:
        value = xxhash.xxh64_intdigest(p, 42)
        for b in range(64):
            totals[b] += value >> b & 1
    return sum(1 << b for b in range(64) if 2 * totals[b] > len(parts))


def plain_components(rows, radius):
    prints = [(d, plain_fingerprint(t)) for d, t in rows]
    values = sorted({f for _, f in prints})
    parent = {v: v for v in values}
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= radius:
                x, y = h.root_of(parent, a), h.root_of(parent, b)
                parent[max(x, y)] = min(x, y)
    least = {}
    for d, f in prints:
        if d is not None:
            root = h.root_of(parent, f)
            least[root] = min(d, least.get(root, d))
    return sorted(((d, f"{f:016x}", least.get(h.root_of(parent, f))) for d, f in prints), key=repr)


@h.needs_data
def test_simhash_query(spark):
    got = sorted((tuple(r) for r in queries.op9_simhash_near_dedup(spark, h.SF).collect()), key=repr)
    assert got == plain_components(h.texts(), 2)


def near_rows():
    """A ball of near copies, of different sizes, beside unlike texts."""
    base = h.prose(3, 400).split()
    out = [(d, " ".join(base[:k] + [f"new{d}"] + base[k + 1 :])) for d, k in ((d, 7 * d) for d in range(40))]
    return out + [(100 + d, h.prose(50 + d, 60)) for d in range(30)] + [r[:2] for r in h.edge_rows()]


@pytest.mark.parametrize(("radius", "blocks", "equal"), [(2, 4, 2), (3, 4, 1)])
def test_simhash_of_near_copies(spark, radius, blocks, equal):
    df = spark.createDataFrame(near_rows(), "doc_id long, text string")
    got = simhash.groups(df, radius=radius, blocks=blocks, equal=equal).collect()
    mine = sorted(((r.doc_id, f"{r.fp % (1 << 64):016x}", r.component_id) for r in got), key=repr)
    assert mine == plain_components(near_rows(), radius)


def test_buckets_split_into_chunks_lose_no_link(spark):
    rng = np.random.default_rng(7)
    values = np.unique([0x1234567890ABCDEF ^ sum(1 << int(k) for k in rng.choice(32, 2, replace=False)) for _ in range(300)])
    df = spark.createDataFrame([(int(v),) for v in values], "fp long")
    links = simhash.links(df, chunk=32).collect()
    roots = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {int(v): int(v) for v in values}
    for a in parent:
        for b in list(parent):
            if (a ^ b).bit_count() <= 2:
                x, y = h.root_of(parent, a), h.root_of(parent, b)
                parent[max(x, y)] = min(x, y)
    assert {v: roots.get(v, v) for v in parent} == {v: h.root_of(parent, v) for v in parent}


@pytest.mark.parametrize("radius", [0, 1, 2, 5, 11])
def test_bit_sliced_links(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    values = np.unique(np.array([b ^ np.uint64(sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 9), replace=False))) for b in base for _ in range(60)], dtype=np.uint64))
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= radius
    one = simhash.small_links(values, np.zeros(len(values), dtype=np.int64), radius)
    assert sorted(one) == [(a, b) for a, b in zip(*np.nonzero(near)) if a < b]
    assert all(near[a, b] and a != b for a, b in simhash.bucket_links(values, radius))


def test_components_of_a_chain_a_star_and_a_pair(spark):
    links = [(k + 1, k) for k in range(70)] + [(1000, 1000 + k) for k in range(1, 90)] + [(-5, 5000), (3, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(1, 71)}, **{1000 + k: 1000 for k in range(1, 90)}, 5000: -5}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_near_dedup_keeps_the_least_of_each_group(spark):
    """Null ids, ties, repeated rows, empty and very long texts, and clashing names."""
    # ids of the edge rows stand for themselves alone
    near = [(d if k >= 70 else 1000 + d, t) for k, (d, t) in enumerate(near_rows())]
    kept = simhash.deduplicate(h.frame(spark, [(d, t, "en", "a", 1) for d, t in near], clashing=True)).collect()
    groups = plain_components(near, 2)
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted({least for _, _, least in groups if least is not None}) and len(kept) > 35
    # a group without any id is named by none, and one of its rows stays
    assert sum(r.doc_id is None for r in kept) == len({f for d, f, least in groups if least is None})
    assert all(r.fp == "kept" and r.row == "kept" for r in kept)
    assert simhash.deduplicate(h.frame(spark, [])).collect() == []


def test_rows_are_kept_in_place(spark):
    """The written rows meet the numbers that stay without a shuffle of theirs; no table is left in the catalog."""
    df = spark.range(100_000).repartition(3).selectExpr("id", "cast(id % 7 as string) AS row", "id * 2 AS task")
    written, row = common.numbered_files(df, "numbered")
    stay = written.filter("id % 5 = 0 or id > 99000").select(F.col(row).alias("row"))
    kept = common.kept_rows(written, row, stay)
    assert kept.columns == ["id", "row", "task"]
    assert sorted(r.id for r in kept.collect()) == [k for k in range(100_000) if k % 5 == 0 or k > 99_000]
    assert common.kept_rows(written, row, stay.limit(0)).collect() == []
    assert not [x for x in spark.catalog.listTables() if x.name.startswith("numbered")]


# ---- decontamination

ITEMS = [(1, h.prose(70, 30)), (2, None), (3, ""), (4, "only three words"), (1, h.prose(70, 30)), (None, h.prose(71, 14)), (6, h.prose(72, 300))]


def plain_contained(docs, items):
    def parts(text):
        words = (text or "").encode().lower().split()
        return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    out = []
    for d, text in docs:
        own = parts(text)
        for item, wanted in ((i, parts(t)) for i, t in items):
            if wanted and len(wanted & own) >= 0.8 * len(wanted):
                out.append((d, item, len(wanted), len(wanted & own)))
    return sorted(out, key=repr)


def leaking():
    item = ITEMS[0][1].split()
    return [
        (1, h.prose(1, 5000) + " " + ITEMS[0][1].upper() + " " + h.prose(2, 3000)),
        (2, " ".join(item[:15]) + " " + h.prose(3, 700) + " " + " ".join(item[10:])),
        (3, " ".join(item[:20])),
        (4, "Only THREE words"),
        (None, h.prose(9, 40) + "\n" + h.prose(71, 14)),
        (5, h.prose(72, 260)),
        (6, None),
        (7, ""),
        (8, h.prose(1, 100)),
    ]


@pytest.mark.parametrize("block_items", [2, 100])
def test_contained_items(spark, block_items):
    docs = spark.createDataFrame(leaking(), "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted((tuple(r) for r in decontaminate.contained(docs, items, block_items=block_items).collect()), key=repr)
    assert got == plain_contained(leaking(), ITEMS) and len(got) >= 7


def test_decontaminated_rows(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    bad = {d for d, *_ in plain_contained(leaking(), ITEMS)}
    df = h.frame(spark, [(d, t, "en", "a", 1) for d, t in leaking()], clashing=True)
    for size in (2, 100):
        kept = decontaminate.decontaminate(df, items, block_items=size).collect()
        assert sorted(r.doc_id for r in kept) == sorted(d for d, _ in leaking() if d not in bad) and all(r.row == "kept" for r in kept)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(df, none).count() == len(leaking())
    assert decontaminate.contained(df, none).count() == 0 and decontaminate.contained(df.limit(0), items).count() == 0


def test_items_of_few_shingles_are_never_missed(spark):
    """Items of five to eight words have too small a share of a window for its minima."""
    rng = np.random.default_rng(3)
    items = [(k, " ".join(f"i{k}_{x}" for x in range(5 + k % 4))) for k in range(1200)]
    fill = lambda n: " ".join(f"f{x}" for x in rng.integers(10**9, size=n))
    search = decontaminate.Search(items)
    for k, text in items:
        n = 1 + k % 4
        assert search.matches(f"{fill(40)} {text} {fill(40)}") == [(k, n, n)]
