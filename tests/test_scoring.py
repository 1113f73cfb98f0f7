import datetime as dt
import math
import random

from pyspark.sql import functions as F

from termpulse.operators import scoring

TARGET = dt.date(2026, 4, 13)
ALLOW = ("mcp", "agents")


def frames(spark, days, docs):
    """days: {date: {term: (tf, df)}}; docs: {date: document count}"""
    rows = [(d, t, tf, df, [f"{t}-1", f"{t}-2"]) for d, ts in days.items() for t, (tf, df) in ts.items()]
    terms = spark.createDataFrame(rows, "date date, term string, tf bigint, df bigint, article_ids array<string>")
    return terms, spark.createDataFrame(list(docs.items()), "date date, document_count bigint")


def reference_scores(days, docs, target, n):
    base = [days.get(target - dt.timedelta(days=i)) for i in range(1, n + 1) if target - dt.timedelta(days=i) in docs]
    base = [b or {} for b in base]
    ever = set.intersection(*[set(b) for b in base]) if base else set()
    out = []
    for t, (tf, df) in days.get(target, {}).items():
        if df < (2 if docs[target] >= 2 else 1):
            continue
        seen = [b[t][0] for b in base if t in b]
        avg = sum(seen) / len(seen) if seen else 0.0
        s = math.log(1.0 + tf) * (tf / max(avg, 0.5)) * (0.5 + df / docs[target])
        out.append((s * (1.5 if t in ALLOW else 1) * (0.5 if t in ever else 1), t, avg))
    return sorted(out, key=lambda x: (-x[0], x[1]))


def test_spike_wins_over_steady_term(spark):
    days = {TARGET - dt.timedelta(days=i): {"openai": (5, 3), "mcp": (1, 2)} for i in range(1, 8)}
    days[TARGET] = {"openai": (6, 3), "mcp": (12, 3)}
    terms, headers = frames(spark, days, {d: 3 for d in days})
    ranked = scoring.rank_candidates(scoring.score_terms(terms, headers, allowlist=ALLOW))
    won = {r.date: r for r in scoring.elect(ranked, headers).collect()}
    assert won[TARGET].word == "mcp"
    assert [c.term for c in won[TARGET].candidates] == ["mcp", "openai"]
    assert won[TARGET].evidence_article_ids == ["mcp-1", "mcp-2"]
    assert len(won) == 8


def test_random_days_match_a_plain_loop(spark):
    rng = random.Random(3)
    start = dt.date(2026, 1, 1)
    days, docs = {}, {}
    for i in range(25):
        d = start + dt.timedelta(days=i)
        if rng.random() < 0.2:
            continue
        docs[d] = rng.choice([1, 2, 5])
        if rng.random() < 0.85:
            days[d] = {t: (rng.randrange(1, 9), rng.randrange(1, docs[d] + 1)) for t in ("mcp", "rag", "a", "b", "c") if rng.random() < 0.8}
    terms, headers = frames(spark, days, docs)
    scored = scoring.score_terms(terms, headers, allowlist=ALLOW, baseline_days=6)
    got = {}
    for r in scoring.rank_candidates(scored).orderBy("date", "rank").collect():
        got.setdefault(r.date, []).append((r.score, r.term, r.avg_tf_baseline))
    for d in docs:
        expect = reference_scores(days, docs, d, 6)
        assert [t for _, t, _ in got.get(d, [])] == [t for _, t, _ in expect]
        for a, b in zip(got.get(d, []), expect):
            assert math.isclose(a[0], b[0], rel_tol=1e-12) and math.isclose(a[2], b[2], rel_tol=1e-12)


def test_known_score_values(spark):
    """The published inputs of two candidates give their published scores."""
    df = spark.createDataFrame(
        [("tools", 5, 2, 3, 259.6364, True), ("access", 2, 2, 3, 117.4, True)],
        "term string, tf bigint, df bigint, document_count bigint, avg_tf_baseline double, ever_present boolean",
    )
    got = {r.term: r.s for r in df.select("term", F.round(scoring.score(()), 6).alias("s")).collect()}
    plain = {"tools": math.log(6) * 5 / 259.6364 * (0.5 + 2 / 3), "access": math.log(3) * 2 / 117.4 * (0.5 + 2 / 3)}
    assert got == {k: round(v * 0.5, 6) for k, v in plain.items()}
    assert {round(v, 6) for v in plain.values()} == {0.040256, 0.021835}


def test_day_without_candidates_keeps_a_row(spark):
    terms, headers = frames(spark, {TARGET: {"mcp": (5, 1)}}, {TARGET: 3})
    (row,) = scoring.elect(scoring.rank_candidates(scoring.score_terms(terms, headers)), headers).collect()
    assert (row.word, row.score, row.candidates, row.evidence_article_ids, row.rerank) == (None, 0.0, [], [], None)


def test_single_article_day_elects(spark):
    terms, headers = frames(spark, {TARGET: {"mcp": (7, 1)}}, {TARGET: 1})
    (row,) = scoring.elect(scoring.rank_candidates(scoring.score_terms(terms, headers)), headers).collect()
    assert row.word == "mcp"


def test_rerank_only_takes_known_terms(spark):
    ts = {f"t{i:02d}": (100 - i, 2) for i in range(50)}
    terms, headers = frames(spark, {TARGET: ts}, {TARGET: 2})
    ranked = scoring.rank_candidates(scoring.score_terms(terms, headers))

    def word(top):
        asked = spark.createDataFrame([(TARGET, top)], "date date, top array<string>")
        (row,) = scoring.elect(ranked, headers, asked).collect()
        return row.word, row.rerank and row.rerank.top, [c.term for c in row.candidates]

    ten = [f"t{i:02d}" for i in range(10)]
    assert word(["invented", "t39", "t01"]) == ("t39", ["t39", "t01"], ten)
    assert word(["t40"]) == ("t00", None, ten)
