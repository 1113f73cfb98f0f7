import random
from collections import defaultdict

from pyspark.sql import functions as F

from termpulse.operators import daystats

DAY = "2026-04-13"


def counts_frame(spark, rows):
    """rows: (date, article, author, {term: tf})"""
    data = [(d, a, w, [(t, n) for t, n in terms.items()]) for d, a, w, terms in rows]
    schema = "date string, article_id string, author string, term_counts array<struct<term:string,tf:bigint>>"
    return spark.createDataFrame(data, schema).withColumn("date", F.col("date").cast("date"))


def roll(spark, rows, **caps):
    counts = counts_frame(spark, rows)
    return {
        (str(r.date), r.term): r for r in daystats.day_terms(counts, daystats.day_headers(counts), **caps).collect()
    }


def test_totals_and_single_article_terms(spark):
    got = roll(spark, [(DAY, "a1", "x", {"mcp": 3, "agents": 1}), (DAY, "a2", "", {"mcp": 2}), ("2026-04-14", "b", None, {"solo": 1})])
    assert {(k, r.tf, r.df) for k, r in got.items()} == {((DAY, "mcp"), 5, 2), (("2026-04-14", "solo"), 1, 1)}
    assert got[(DAY, "mcp")].article_ids == ["a1", "a2"] and got[(DAY, "mcp")].authors == ["x"]


def test_caps(spark):
    rows = [(DAY, f"a{i:03d}", f"w{(i * 7) % 50:02d}", {"mcp": 1, "rag": 2}) for i in range(300)]
    got = roll(spark, rows, max_articles=20, max_authors=5)
    r = got[(DAY, "mcp")]
    assert (r.tf, r.df) == (300, 300)
    assert r.article_ids == [f"a{i:03d}" for i in range(20)]
    assert r.authors == sorted(f"w{(i * 7) % 50:02d}" for i in range(5))


def test_term_cap_breaks_ties_by_term(spark):
    rows = [(DAY, a, None, {f"t{i}": 1 + (i == 7) for i in range(10)}) for a in ("a", "b")]
    assert sorted(t for _, t in roll(spark, rows, max_terms=3)) == ["t0", "t1", "t7"]


def test_day_without_terms_has_a_header(spark):
    counts = counts_frame(spark, [(DAY, "a", None, {}), (DAY, "b", None, {})])
    assert [(str(r.date), r.document_count) for r in daystats.day_headers(counts).collect()] == [(DAY, 2)]
    assert daystats.day_terms(counts, daystats.day_headers(counts)).count() == 0


def test_both_list_strategies_agree(spark):
    """The lists hold what the rows of each term say, in their order."""
    rng = random.Random(5)
    rows = [
        (f"2026-04-{10 + rng.randrange(3)}", f"a{i:03d}", rng.choice(["x", "y", None, ""]), {f"t{rng.randrange(6)}": rng.randrange(1, 4) for _ in range(4)})
        for i in range(120)
    ]
    counts = counts_frame(spark, rows)
    terms = daystats.article_terms(counts, "date", "article_id", "author")
    kept = daystats.day_totals(terms, daystats.day_headers(counts))
    listed = {(str(r.date), r.term): r for r in daystats.with_lists(kept, terms, max_articles=3, max_authors=2).collect()}
    whole = {(str(r.date), r.term): r for r in daystats.with_lists(kept, terms, max_articles=None, max_authors=None).collect()}
    for key, r in whole.items():
        ids = sorted(a for d, a, _, ts in rows if (d, key[1]) == key and key[1] in ts)
        assert r.article_ids == ids and listed[key].article_ids == ids[:3]
        assert r.authors == sorted({w for d, _, w, ts in rows if (d, key[1]) == key and key[1] in ts and w})
    expect = defaultdict(lambda: [0, 0])
    for d, _, _, ts in rows:
        for t, n in ts.items():
            expect[(d, t)][0] += n
            expect[(d, t)][1] += 1
    assert {(str(r[0]), r[1]): [r[2], r[3]] for r in whole.values()} == {k: v for k, v in expect.items() if v[1] >= 2}


def test_stored_terms_stand_in_for_missing_text(spark):
    df = spark.sql(
        "SELECT 1 AS i, true AS has, array(named_struct('term','a','tf',1L)) AS t, array(named_struct('term','b','tf',2L)) AS s "
        "UNION ALL SELECT 2, false, null, array(named_struct('term','b','tf',2L)) UNION ALL SELECT 3, false, null, null"
    )
    got = df.select("i", daystats.text_or_stored_counts(F.col("has"), F.col("t"), F.col("s")).alias("c")).orderBy("i").collect()
    assert [[(c.term, c.tf) for c in r.c] for r in got] == [[("a", 1)], [("b", 2)], []]
