import datetime as dt
import random

import pytest

from termpulse.operators import toplists

DAY = dt.date(2024, 1, 1)


def corpus(seed, n):
    rng, out = random.Random(seed), []
    for k in range(n):
        terms = {rng.choice(["a", "b b", "ü", "hot", f"t{rng.randrange(40)}"]): rng.randint(1, 9) for _ in range(rng.randint(0, 9))}
        out.append((DAY + dt.timedelta(days=rng.randrange(3)), f"s--{rng.randrange(10**6):06d}", rng.choice([None, "", "Ann", "Bo", "Cy", f"p{k % 23}"]), list(terms.items())))
    return out


def plain(rows, articles, authors):
    found: dict = {}
    for date, article, author, terms in rows:
        for term, tf in terms:
            found.setdefault((date, term), []).append((article, author, tf))
    out = {}
    for key, uses in found.items():
        first: dict = {}
        for article, author, _ in sorted(uses, key=lambda u: u[0]):
            if author:
                first.setdefault(author, article)
        kept = sorted(first.items(), key=lambda x: (x[1], x[0]))[:authors]
        out[key] = (sum(u[2] for u in uses), len(uses), sorted(u[0] for u in uses)[:articles], kept)
    return out


def frame(spark, rows, parts):
    return spark.createDataFrame(rows, "date date, article_id string, author string, term_counts array<struct<term:string,tf:bigint>>").repartition(parts)


def as_dict(found):
    return {(r.date, r.term): (r.tf, r.df, r.articles, [(a.author, a["first"]) for a in r.authors]) for r in found.collect()}


@pytest.mark.parametrize(("articles", "authors", "held"), [(5, 3, 1 << 20), (50, 10, 40), (1, 1, 7)])
def test_merged_states_equal_lists_of_all_rows(spark, monkeypatch, articles, authors, held):
    monkeypatch.setattr(toplists, "HELD", held)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 13)
    try:
        rows = corpus(articles, 400)
        found = toplists.merged(toplists.states(frame(spark, rows, 3), articles, authors), articles, authors)
        assert as_dict(found) == plain(rows, articles, authors)
        # states of states
        parts = [toplists.states(frame(spark, rows[k::2], 2), articles, authors) for k in range(2)]
        again = toplists.merged(toplists.merged(parts[0].union(parts[1]), articles, authors), articles, authors)
        assert as_dict(again) == plain(rows, articles, authors)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_nothing_and_articles_without_terms(spark):
    assert toplists.merged(toplists.states(frame(spark, [], 2))).collect() == []
    rows = [(DAY, "a--1", None, []), (DAY, "a--2", "Ann", None), (DAY, "a--3", "Ann", [("x", 2)])]
    assert as_dict(toplists.merged(toplists.states(frame(spark, rows, 1)))) == {(DAY, "x"): (2, 1, ["a--3"], [("Ann", "a--3")])}
