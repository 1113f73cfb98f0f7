import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm import helpers as h
from termpulse.llm import lm, quality, queries, secrets

# ---- secrets

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def plain_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(secrets.KINDS[k], a, b) for a, k, b in sorted(found)]


def base(spans):
    return [s for s in spans if s[0] in secrets.KINDS[:3]]


@h.needs_data
def test_secret_query(spark):
    rows = {r.doc_id: r for r in queries.op3_secret_scan(spark, h.SF).collect()}
    assert len(rows) == len(h.texts())
    for doc_id, text in h.texts():
        wanted, r = plain_spans(text), rows[doc_id]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in wanted)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for k, *_ in wanted) for kind in secrets.KINDS[:3])
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and r.spans == joined


def test_scan_equals_patterns_on_mixed_pieces():
    rng = np.random.default_rng(5)
    pieces = ["password", "PassWD", "token", " = ", ":", '"', "'", "AKIA", "ABCDEFGH12345", "deadbeef", "0123", "cafe" * 9, "xyz", " ", "tokentoken", "é", "-", "secret=secret=abcdefgh", "api_key=", "apiKey: ", "ſecret=12345678", "\U0001f642", "İ"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces, rng.integers(0, 20)))
        assert base(secrets.scan(text)) == plain_spans(text)


def test_checksums_tell_tokens_from_look_alikes():
    body = "aB3" * 10
    good, bad = f"ghp_{body}{secrets.checksum(body)}", f"ghp_{body}000000"
    assert secrets.scan(f"é {good} {bad} npm_{body}{secrets.checksum(body)} {good}x") == [("github", 2, 42), ("npm", 84, 124)]
    assert secrets.checksum("") == "000000" and len(secrets.checksum(body)) == 6


def test_secrets_of_edge_rows(spark):
    rows = secrets.with_secrets(h.frame(spark, h.edge_rows(), clashing=True)).collect()
    assert len(rows) == len(h.edge_rows()) and all(r.secrets == "kept" for r in rows)
    found = {r.doc_id: r._secrets for r in rows}
    assert found[9] == [("assign", 0, 25)] and all(v == [] for k, v in found.items() if k != 9)
    assert secrets.with_secrets(h.frame(spark, [])).collect() == []


# ---- quality


def test_quality_on_held_out_labels(spark):
    sf = h.SF.replace("sf0.001", "sf0.01")
    rows = {r.doc_id: r for r in queries.op2_quality_classifier(spark, sf).collect()}
    assert len(rows) == len(h.texts(sf)) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in rows.items())
    marked = [(rows[d].score, q) for d, q, _ in h.table("labels", sf) if rows[d].held_out]
    good, bad = [s for s, q in marked if q == 1], [s for s, q in marked if q == 0]
    assert np.mean([a > b for a in good for b in bad]) > 0.97
    assert np.mean([s >= 0.5 for s in good]) > 0.97


def test_held_out_labels_are_not_learned_from(spark):
    docs = h.frame(spark, [(d, h.prose(d, 20 + d % 7), "en", "a", 1) for d in range(60)])
    one = spark.createDataFrame([(d, d % 2, 0) for d in range(60)], "doc_id long, quality int, toxic int")
    two = spark.createDataFrame([(d, d % 2 if zlib.crc32(str(d).encode()) % 3 != 1 else 1 - d % 2, 1) for d in range(60)], "doc_id long, quality int, toxic int")
    assert sorted(quality.scored(docs, one).collect()) == sorted(quality.scored(docs, two).collect())


def test_statistics(spark):
    text = "Aa bb bb, !! 12 ||\nxx\nxx"
    r = quality.measured(h.frame(spark, [(1, text, None, None, None)])).first().asDict()
    n = len(text)
    wanted = {"upper": 1 / n, "digits": 2 / n, "letters": 10 / n, "shouts": 2 / 8, "bars": 2 / 8, "doubled_signs": 4 / 8, "different_words": 7 / 8, "repeated_words": 1 / 8, "different_lines": 2 / 3, "log_words": math.log1p(8)}
    assert {k: round(r[k], 9) for k in wanted} == {k: round(v, 9) for k, v in wanted.items()}


@pytest.mark.parametrize("labels", [[], [(1, None, None)], [(1, 1, 0), (10, 1, 0), (None, 0, 0)]])
def test_quality_of_edge_rows(spark, labels):
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = h.frame(spark, h.edge_rows(), clashing=True)
    rows = quality.scored(docs, known).collect()
    assert len(rows) == len(h.edge_rows()) and all(0.5 <= r.score < 1 for r in rows)
    kept = quality.accepted(docs, known)
    assert kept.columns == docs.columns and kept.count() == len(h.edge_rows())
    assert quality.accepted(docs.limit(0), known).count() == 0


def test_rules_are_sparse_and_found():
    rng = np.random.default_rng(8)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.7) & (x[:, 2] <= 0.5)).astype(float)
    model = quality.learn(x, y, ("a", "b", "c", "d"))
    score = model.intercept + sum(w * r.holds(x, ("a", "b", "c", "d")) for w, r in model.rules)
    assert ((score > 0) == (y == 1)).mean() > 0.97 and 1 <= len(model.rules) < 150


# ---- language model


def tokens_of(text):
    return [*(text or "").encode().lower().split(), b""]


def check_scores(rows, docs):
    held = {d: zlib.crc32(str("" if d is None else d).encode()) % 10 == 0 for d, _ in docs}
    counts = Counter(w for d, t in docs if not held[d] for w in tokens_of(t))
    n, v = sum(counts.values()), len(counts)
    wanted = sorted((d is None, d or 0, held[d], len(w), sum(counts[x] > 0 for x in w), n, round(sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 6)) for d, w in ((d, tokens_of(t)) for d, t in docs))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
    assert [g[:-1] for g in got] == [w[:-1] for w in wanted]
    assert np.allclose([g[-1] for g in got], [w[-1] for w in wanted])


@h.needs_data
def test_lm_query_beats_its_base(spark):
    rows = queries.op7_brown_lm_scores(spark, h.SF).collect()
    check_scores(rows, h.texts())
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("group_tokens", [50, 1 << 20])
def test_lm_of_edge_rows(spark, group_tokens):
    docs = [r[:2] for r in h.edge_rows()]
    rows = lm.scores(h.frame(spark, h.edge_rows(), clashing=True), group_tokens=group_tokens).collect()
    check_scores(rows, docs)
    assert all(r.score < 0 for r in rows)
    assert lm.scores(h.frame(spark, [])).collect() == []


def test_lm_scores_do_not_depend_on_groups(spark):
    df = h.frame(spark, [(d, h.prose(d % 5, 40), "en", "a", 1) for d in range(40)])
    one, two = (sorted((r.doc_id, round(r.score, 6)) for r in lm.scores(df, group_tokens=n).collect()) for n in (30, 1 << 20))
    assert one == two


def test_lm_without_training_documents(spark):
    held = [d for d in range(200) if zlib.crc32(str(d).encode()) % 10 == 0][:3]
    rows = lm.scores(h.frame(spark, [(d, "a b", "en", "a", 1) for d in held])).collect()
    assert len(rows) == 3 and all(r.base_score == 0 and abs(r.score) < 1e-9 and r.n_known == 0 for r in rows)


def plain_likelihood(pairs, cls):
    k = cls.max() + 1
    joint = np.zeros((k, k))
    np.add.at(joint, (cls[:, None], cls[None, :]), pairs)
    part = lambda x: float((x[x > 0] * np.log(x[x > 0])).sum())
    return part(joint) - part(joint.sum(axis=0)) - part(joint.sum(axis=1))


def test_exchange_ends_where_no_single_move_helps():
    rng = np.random.default_rng(9)
    pairs = rng.poisson(np.where((np.arange(12)[:, None] + np.arange(12)[None, :]) % 3 == 0, 20, 1))
    cls = lm.exchange(pairs, classes=3)
    best = plain_likelihood(pairs, cls)
    for u in range(12):
        for c in range(3):
            other = cls.copy()
            other[u] = c
            if other.max() == 2:
                assert plain_likelihood(pairs, other) <= best + 1e-6


def test_lm_probabilities_sum_to_one():
    rng = np.random.default_rng(10)
    size = 1 + lm.FREQUENT + lm.ENDINGS
    words = [b"", *[f"w{k}".encode() for k in range(300)]]
    counts = rng.integers(1, 30, len(words))
    frequent = words[1 : 1 + lm.FREQUENT]
    units = lm.units_of(words, {w: k + 1 for k, w in enumerate(frequent)})
    pairs, unit_words = np.zeros((size, size)), np.bincount(units, minlength=size)
    totals = np.bincount(units, weights=counts, minlength=size)
    pairs[:] = np.outer(totals, totals) / totals.sum()
    model = lm.model_of(frequent, pairs, unit_words, int(counts.sum()), len(words))
    for before in (0, 5, 11):
        known = model.probabilities(np.full(len(words), before), units, counts.astype(float))
        unknown = model.probabilities(np.array([before]), np.array([300]), np.array([0.0]))
        assert abs(known.sum() + unknown[0] - 1) < 1e-6


def test_a_word_moves_where_the_likelihood_is_greatest():
    rng = np.random.default_rng(11)
    pairs, cls, k = rng.poisson(3, (20, 20)), rng.integers(0, 4, 20), 4
    one = np.eye(k)[cls]
    counts = np.hstack([pairs @ one, pairs.T @ one, np.diag(pairs)[:, None]])
    found = lm.moved(one.T @ pairs @ one, cls, counts)
    for u in range(20):
        values = [plain_likelihood(pairs, np.where(np.arange(20) == u, c, cls)) for c in range(k)]
        assert values[found[u]] >= max(values) - 1e-6


def alternating(seed, n):
    """Words of one ending and length, of which even ones follow odd ones."""
    rng = np.random.default_rng(seed)
    return " ".join(f"{2 * int(rng.integers(0, 400)) + k % 2:04d}end" for k in range(n))


def test_lm_classes_are_those_of_words(spark):
    docs = [(d, alternating(d, 400)) for d in range(150)]
    rows = [r for r in lm.scores(h.frame(spark, [(d, t, "en", "a", 1) for d, t in docs]), group_tokens=5000).collect() if r.held_out]
    assert sum(r.score - r.base_score for r in rows) / sum(r.n_tokens for r in rows) > 0.2


def test_lm_rare_words_join_by_their_contexts(spark, monkeypatch):
    monkeypatch.setattr(lm, "SHARE", 60)
    docs = [(d, " ".join(f"{w} {'xy'[k % 2]}{k % 2}" for k, w in enumerate(alternating(d, 200).split()))) for d in range(60)]
    rows = [r for r in lm.scores(h.frame(spark, [(d, t, "en", "a", 1) for d, t in docs]), group_tokens=3000).collect() if r.held_out]
    assert sum(r.score - r.base_score for r in rows) / sum(r.n_tokens for r in rows) > 0.2
