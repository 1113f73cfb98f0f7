"""Conversation repair, Merkle manifest and fertility next to plain versions."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm import helpers as h
from termpulse.llm import fertility, merkle, queries, repair, structure_sql

SPACES = " \t\n\x0b\x0c\r"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ---- conversations


def every_repair(rows):
    """(cost, audit) by trying all edits; rows: (initial, fault)."""
    best, sound, begun = None, re.compile(r"(s?(ua)+)?$"), re.compile(r"(s?(ua)*u?)?$")
    choices = [["I" * k + o for k in range(3) for o in ("D" if f in ("blank", "duplicate") else "KRD")] for _, f in rows]
    for combo in itertools.product(*choices, ("", "I", "II")):
        audit = "".join(combo)
        cost, outs, left = 0, [""], iter(rows)
        for letter in audit:
            initial, fault = ("", None) if letter == "I" else next(left)
            cost += {"K": 0, "R": 1, "D": 2, "I": 5}[letter] + 5 * (fault == "truncated" and letter != "D")
            ends = {"K": [initial], "D": [""]}.get(letter, ["u", "a"])
            outs = [o + e for o in outs for e in ends if begun.match(o + e)]
        if any(map(sound.match, outs)) and (best is None or (cost, audit) < best):
            best = (cost, audit)
    return best


def test_search_finds_the_cheapest_and_first_of_all_edits():
    rng = random.Random(1)
    for _ in range(150):
        rows = [(rng.choice("suuaax"), rng.choice([None, None, "truncated", "blank"])) for _ in range(rng.randint(0, 4))]
        found = repair.Survivors()
        for initial, fault in rows:
            letters = {None: repair.SOUND, "truncated": repair.CUT}.get(fault, repair.GONE)
            found.advance(repair.MOVES[letters["suax".index(initial)]].__getitem__)
        state, cost, last = found.end()
        assert (cost, "".join(found.taken() + found.rest(state)) + last) == every_repair(rows), rows


def test_memory_holds_only_what_is_unresolved():
    rng, found, deepest = random.Random(2), repair.Survivors(), 0
    for _ in range(20_000):
        found.advance(repair.MOVES[rng.choice("suuuaaaxUA12")].__getitem__)
        deepest = max(deepest, *(node.depth - found.root.depth for _, node in found.paths.values()))
    assert len(found.taken()) > 19_000 and deepest < 300


def plain_repair(turns):
    """The contract's row of one conversation; turns: (turn, role, text) after damage."""
    key = lambda z: (z[0] is not None, z[0] or 0, z[1], hashlib.sha256(f"{len(z[1].encode())}:{z[1]}{z[2]}".encode()).digest())
    rows = sorted(turns, key=key)
    numbers, seen, faults = [z[0] for z in rows if z[0] is not None], set(), []
    for _, role, text in rows:
        core = text.strip(SPACES)
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None)
        seen.add((role, text))
    bad = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}

    def inserted():
        for _ in range(2):
            for at, (cost, audit, out) in list(best.items()):
                for x in follow[at].replace("s", ""):
                    new = (cost + 5, audit + "I", (*out, ("user" if x == "u" else "assistant") + ":"))
                    best[x] = min(best.get(x, new), new, key=lambda z: z[:2])
        return best

    for (_, role, text), fault in zip(rows, faults):
        found = []
        for at, (cost, audit, out) in inserted().items():
            found.append((at, (cost + 2, audit + "D", out)))
            if fault in ("blank", "duplicate"):
                continue
            cost += 5 * (fault == "truncated")
            if role[:1] and role[:1] in follow[at]:
                found.append((role[:1], (cost, audit + "K", (*out, f"{role}:{text}"))))
            found += [(x, (cost + 1, audit + "R", (*out, ("user" if x == "u" else "assistant") + f":{text}"))) for x in follow[at].replace("s", "")]
        best = {}
        for at, new in found:
            best[at] = min(best.get(at, new), new, key=lambda z: z[:2])
    cost, audit, out = min((z for at, z in inserted().items() if at in ("", "a")), key=lambda z: z[:2])
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    return (gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), bad, cost, audit, sha("\n".join(out)))


def damaged(turns):
    out: dict = {}
    for conv, turn, role, text in turns:
        own = out.setdefault(conv, [])
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if k:
            own += [(turn, "user" if k == 4 else role, "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text)] * (1 + (k == 3))
    return out


def odd_turns():
    rng = random.Random(4)
    rows = [(c, rng.choice([None, *range(9)]), rng.choice(["user", "assistant", "system", "tool", None, "", "User"]), rng.choice(["Yes.", "No", "", None, " \x0b", "Ünd?", "Yes."])) for c in (1, 2, 3, None) for _ in range(40)]
    return [*rows, (4, 0, "user", "a" * 300_000 + "."), (4, 1, "assistant", "b"), (5, None, None, None), (6, 3, "user", "Hello."), (6, 3, "user", "Hello.")]


def run_repair(spark, turns, monkeypatch, size):
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("place", "conv", "fault", "digest", "part")})
    monkeypatch.setattr(queries, "table", lambda *_: df)
    whole = repair.repair
    monkeypatch.setattr(repair, "repair", lambda rows: whole(rows, size))
    return queries.op11_conversation_repair(spark, "")


@pytest.mark.parametrize("size", [5, 4096])
def test_repair_of_odd_turns(spark, monkeypatch, size):
    """Nulls, empty and long texts, ties, repeated rows and clashing names, in short and in whole segments."""
    turns = odd_turns()
    rows = run_repair(spark, turns, monkeypatch, size).collect()
    wanted = {conv: plain_repair(own) for conv, own in damaged(turns).items()}
    assert {r.conv_id: tuple(r)[1:] for r in rows} == wanted and len(rows) == len(wanted)


def test_repair_of_no_turns(spark, monkeypatch):
    assert run_repair(spark, [], monkeypatch, 4096).collect() == []


@h.needs_data
def test_repair_equals_plain_and_sql(spark):
    rows = {r.conv_id: tuple(r)[1:] for r in queries.op11_conversation_repair(spark, h.SF).collect()}
    turns = h.table("conversations")
    assert rows == {conv: plain_repair(own) for conv, own in damaged(turns).items()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{h.SF}/conversations.parquet'")
    assert {r[0]: r[1:] for r in con.execute(structure_sql.REPAIR).fetchall()} == rows


# ---- manifest


def plain_levels(level):
    out = [level]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][k : k + 16])) for k in range(0, len(out[-1]), 16)])
    return out


def plain_manifest(docs):
    """doc_id -> the contract's row, as a list in the order of leaves; docs: (doc_id, text, lang, source, n_chars)."""
    leaf = lambda r: sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))
    groups: dict = {}
    for doc_id, text, lang, source, n_chars in docs:
        row = (doc_id, source, lang, n_chars, text)
        low = None if text is None else re.sub("[A-Z]", lambda m: m[0].lower(), text)
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        groups.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf(row), leaf((*row[:4], low)) if hit else leaf(row), doc_id))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_levels([x[2] for x in sorted(groups[s])]) for s in names}
    top = plain_levels([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (_, _, own, cur, doc_id) in enumerate(sorted(groups[s])):
            proof = ""
            for levels, at in ((trees[s], i), (top, k)):
                for level in levels[:-1]:
                    run, slot = level[at // 16 * 16 : at // 16 * 16 + 16], at % 16
                    proof += "".join(run[:slot] + run[slot + 1 :])
                    cur = sha("".join(run[:slot] + [cur] + run[slot + 1 :]))
                    at //= 16
            root = top[-1][0]
            out.append((doc_id, own, trees[s][-1][0], root, sha(proof), cur, cur == root))
    return out


def test_positions_are_those_of_the_append_log():
    for n in (1, 2, 15, 16, 17, 33, 256, 257, 300, 4097, 5000):
        log, builder = [], merkle.Builder(merkle.height(n))
        builder.append, whole = (lambda d, level=0: (log.append(level), whole(d, level))[1]), builder.append
        for k in range(n):
            builder.append(b"%032d" % k)
        assert len(builder.finish()) == len(log)
        seen = Counter()
        for at, level in enumerate(log):
            assert merkle.position(level, seen[level], n) == at
            seen[level] += 1


@h.needs_data
def test_manifest_equals_plain_and_sql(spark):
    rows = sorted(tuple(r) for r in queries.op12_merkle_manifest(spark, h.SF).collect())
    assert rows == sorted(plain_manifest(h.table("documents")))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{h.SF}/documents.parquet'")
    assert sorted(con.execute(structure_sql.MERKLE).fetchall()) == rows


def test_manifest_of_edge_rows_and_of_several_tiers(spark, monkeypatch):
    """Nulls, repeated rows, ties, long texts, clashing names; one source of more than one builder."""
    docs = [*h.edge_rows(), *[(k, f"Text {k}", "en", "hot", k) for k in range(100, 4400)], *[(9000 + k, "A", None, f"s{k:02d}", 1) for k in range(20)]]
    df = h.frame(spark, docs, clashing=True).withColumns({c: F.lit(0) for c in ("n", "place", "leaf", "root", "digest", "siblings", "group_key")})
    monkeypatch.setattr(queries, "table", lambda *_: df)
    rows = [tuple(r) for r in queries.op12_merkle_manifest(spark, "").collect()]
    assert sorted(rows, key=repr) == sorted(plain_manifest(docs), key=repr)


def test_log_is_gapless_and_in_postorder(spark):
    rows = spark.range(4500).select("id", F.when(F.col("id") % 90 > 0, F.lit("a")).alias("by"), F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("leaf"))
    manifest = merkle.build(rows, "by", "leaf", ["id"], ["id"])
    log = manifest.log().collect()
    for key, n in (("=a", 4450), ("", 50)):
        builder = merkle.Builder(merkle.height(n))
        for r in sorted(rows.filter(F.coalesce("by", F.lit("")) == key[1:]).collect()):
            builder.append(bytes(r.leaf))
        own = sorted((r.position, bytes(r.digest)) for r in log if r.group_key == key)
        assert own == list(enumerate(builder.finish()))
    assert [r.root for r in manifest.root.collect()] == [proof.root.hex() for proof in merkle.proofs(manifest).limit(1).collect()]


def test_manifest_of_nothing(spark, monkeypatch):
    monkeypatch.setattr(queries, "table", lambda *_: h.frame(spark, []))
    assert queries.op12_merkle_manifest(spark, "").collect() == []


# ---- fertility


def plain_counts(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines, again, windows = [x for x in text.split("\n") if x.strip(SPACES)], set(), {}
    for k in range(len(words) - 4):
        windows.setdefault(tuple(words[k : k + 5]), []).append(k)
    for at in windows.values():
        again |= {k + j for k in at if len(at) > 1 for j in range(5)}
    failed = len(words) < 10 or 100 * len(again) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again), failed)


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


@h.needs_data
def test_fertility_of_all_documents(spark):
    sf = h.SF.replace("sf0.001", "sf0.01")
    rows = {r.doc_id: r for r in queries.op13_tokeniser_fertility(spark, sf).collect()}
    docs, labels = dict(h.texts(sf)), {r[0]: r[1] for r in h.table("labels", sf)}
    assert len(rows) == len(docs)
    model, ranks = _vocabularies()
    for doc_id, text in docs.items():
        r = rows[doc_id]
        assert tuple(r[c] for c in BASE) == plain_counts(text)
        words = text.encode().split()
        ids = [i for x in model.cut(words) for i in x]
        assert r.kept == (not r.base_failed and not r.outside)
        if doc_id % 10 == 0 and ids:
            counts = Counter(ids)
            assert r.chars_per_piece == pytest.approx(r.word_chars / len(ids)) and r.chars_per_rank == pytest.approx(r.word_chars / sum(map(len, ranks.cut(words))))
            assert r.byte_share == pytest.approx(sum(bool(model.is_byte[i]) for i in ids) / len(ids))
            assert r.entropy == pytest.approx(fertility.entropy(ids)) and -sum(n / len(ids) * __import__("math").log2(n / len(ids)) for n in counts.values()) == pytest.approx(r.entropy)
    good = [rows[d].kept for d, q in labels.items() if q == 1 and not rows[d].base_failed]
    bad = [rows[d].kept for d, q in labels.items() if q == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.45 * len(bad)


def _vocabularies():
    tokenizers = queries.public_tokenizers
    return fertility.Pieces(tokenizers.path(queries.PIECES)), fertility.Ranks(tokenizers.path(queries.RANKS), tokenizers.PATTERN)


def _judged(spark, rows, **options):
    tokenizers = queries.public_tokenizers
    return fertility.judged(h.frame(spark, rows, **options), tokenizers.path(queries.PIECES), tokenizers.path(queries.RANKS), tokenizers.PATTERN)


def test_bands_reject_caps_fillers_and_foreign_bytes(spark):
    rng = random.Random(5)
    vocabulary = [f"{a}{b}{c}" for a in ("con", "re", "in", "pre") for b in ("tain", "form", "sent", "cess") for c in ("ed", "ing", "s", "ion")]
    rows = [(k, " ".join(rng.choices(vocabulary, k=90)), "en", "a", 1) for k in range(200)]
    rows += [(900, " ".join(rng.choices(vocabulary, k=90)).upper(), "en", "a", 1), (901, "\U0001f9ff ᎠᎡᎢ " * 45, "en", "a", 1)]
    rows += [(902, " ".join(f"x{k} the" for k in range(45)), "en", "a", 1), (903, " ".join(rng.choices(["Wort", "Hand", "Haus", "Feld", "Wald"], k=100)), None, "a", 1)]
    found = {r.doc_id: r for r in _judged(spark, rows, clashing=True).collect()}
    assert sum(found[k].kept for k in range(200)) >= 198
    assert not any(found[k].kept for k in (900, 901, 902)) and "chars_per_piece" in found[900].outside and found[901].byte_share > 0.5
    assert found[903].kind == "Latin"


def test_fertility_of_edge_rows(spark):
    rows = _judged(spark, h.edge_rows()).collect()
    assert len(rows) == len(h.edge_rows())
    wanted = Counter((d, *plain_counts(t or "")) for d, t, *_ in h.edge_rows())
    assert Counter((r.doc_id, *(r[c] for c in BASE)) for r in rows) == wanted
    assert _judged(spark, []).collect() == []


def test_scripts():
    assert [fertility.script(t) for t in ("Grüße 12", "Привет мир x", "漢字かな漢", "12 !", "", "ab αβ")] == ["Latin", "Cyrillic", "Han", "-", "-", "Greek"]


def test_words_are_forgotten_within_their_bound():
    known = fertility.Words(*_vocabularies(), remembered=20_000)
    for k in range(50):
        index = known.numbers([b"w%d" % (k * 50 + j) for j in range(50)])
        assert (known.count[index] > 0).all() and known.bytes < 60_000
    known.numbers([b"x" * 5000])
    assert len(known) < 200 and known.numbers([b"a"])[0] == 0
