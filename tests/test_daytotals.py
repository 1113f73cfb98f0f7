import datetime as dt
import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from termpulse.functions import grams
from termpulse.functions import text as txt
from termpulse.operators import daystats, daytotals, toplists, windows

DAY = dt.date(2024, 1, 1)
WORDS = ["the", "and", "prompt", "injection", "o1", "x", "don't", "it's", "-a", "b-", "'q'", "1st", "b2-", "--", "Ünder", "café", "the.and", "re-use"]


def rows(n):
    rng = random.Random(n)
    noise = lambda: "".join(rng.choice("abAB019'- \n.é") for _ in range(rng.randrange(30)))
    texts = [None, "", "-", "9a-b'", "a" * 300 + " word"] + [" ".join([rng.choice(WORDS) for _ in range(rng.randrange(30))] + [noise()]) for _ in range(n)]
    return [(k, DAY + dt.timedelta(days=rng.randrange(3)) if k else None, f"s--{k:04d}", rng.choice([None, "", "Ann", "Bo"]), t) for k, t in enumerate(texts)]


def frame(spark, n=300, parts=3):
    return spark.createDataFrame(rows(n), "k int, date date, article_id string, author string, text string").repartition(parts, "k")


def test_counts_of_many_texts_equal_their_sorted_grams(spark, monkeypatch):
    monkeypatch.setattr(grams, "PIECE", 200)
    for options in ({}, {"max_n": 4, "min_token_len": 1}, {"stopwords": (), "allowlist": ()}, {"max_n": 1, "allowlist": ("the", "x")}):
        both = txt.with_term_counts(txt.with_terms(frame(spark), F.col("text"), **options), F.col("text"), **options)
        again = F.flatten(F.transform("term_counts", lambda c: F.array_repeat(c["term"], c["tf"].cast("int"))))
        assert both.where(~again.eqNullSafe(F.col("grams"))).count() == 0


def counted(df):
    return txt.with_term_counts(df, F.col("text"), keep=("date", "article_id", "author"))


def test_totals_of_texts_equal_those_of_their_terms(spark):
    articles = frame(spark)
    days = daystats.day_headers(articles.where("date is not null"))
    plain = daystats.day_totals(daystats.article_terms(counted(articles), "date"), days)
    key = lambda df: sorted((r.date, r.term, r.tf, r.df, r.document_count) for r in df.collect())
    assert key(daytotals.text_totals(articles, F.col("text"), days)) == key(plain)
    short = articles.where("k % 3 = 0")
    stored = daystats.article_terms(counted(short), "date")
    mixed = daytotals.text_totals(articles.where("k % 3 <> 0"), F.col("text"), days, stored)
    assert key(mixed) == key(plain)
    some = daytotals.text_totals(articles, F.col("text"), days, max_terms=7)
    assert key(daystats.cap_terms(some, 7)) == key(daystats.cap_terms(plain, 7))


def test_states_take_one_term_a_row_and_whole_lists_one_exchange(spark):
    counts = counted(frame(spark, 50))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    taken = plan(toplists.states(counts)).split("MapInArrow")[1]
    assert "Generate inline" in taken
    days = daystats.day_headers(counts)
    whole = daystats.day_terms(counts, days, max_terms=None, max_articles=None, max_authors=None)
    assert plan(whole).count("RepartitionByExpression [date") == 1
    found = {(r.date, r.term): (r.tf, r.df, r.article_ids, r.authors) for r in whole.collect()}
    listed = daystats.with_lists(
        daystats.day_totals(daystats.article_terms(counts, "date"), days), daystats.article_terms(counts, "date", "article_id", "author"), max_articles=None, max_authors=None
    )
    assert found == {(r.date, r.term): (r.tf, r.df, r.article_ids, r.authors) for r in listed.collect()}


def test_rollup_with_totals_equals_that_of_all_states(spark):
    articles = frame(spark)
    days = daystats.day_headers(articles.where("date is not null"))
    totals = daytotals.text_totals(articles, F.col("text"), days)
    bounds = {"max_terms": 9, "max_articles": 3, "max_authors": 2}
    key = lambda df: sorted((r.date, r.term, r.tf, r.df, r.article_ids, r.authors) for r in df.collect())
    assert key(daystats.day_terms(counted(articles), days, totals, **bounds)) == key(daystats.day_terms(counted(articles), days, **bounds))


def test_articles_without_an_id_count_and_are_not_listed(spark):
    rows = [(DAY, None, "Ann", [("x", 2)]), (DAY, "a--2", "Bo", [("x", 1)]), (DAY, None, None, [("x", 1)]), (None, "a--3", "Cy", [("x", 1)])]
    counts = spark.createDataFrame(rows, "date date, article_id string, author string, term_counts array<struct<term:string,tf:bigint>>")
    days = spark.createDataFrame([(DAY, 3)], "date date, document_count bigint")
    for bound, authors in ((None, ["Ann", "Bo"]), (1, ["Bo"])):
        (r,) = daystats.day_terms(counts, days, max_terms=None, max_articles=bound, max_authors=bound).collect()
        assert (r.tf, r.df, r.article_ids, r.authors) == (4, 3, ["a--2"], authors)


def test_a_cap_counts_few_terms_and_a_guess_that_is_too_high_is_mended(spark, monkeypatch):
    articles = frame(spark).where("date is not null").cache()
    days = daystats.day_headers(articles)
    plain = daystats.day_totals(daystats.article_terms(counted(articles), "date"), days)
    key = lambda df: sorted((r.date, r.term, r.tf, r.df) for r in df.collect())
    stored = daystats.article_terms(counted(articles.where("k % 3 = 0")), "date")
    for least in (8, 1 << 40):
        guess = lambda added, n: added.select("date", F.lit(least).cast("bigint").alias("least")).distinct()  # noqa: B023, E731
        monkeypatch.setattr(daytotals, "_guesses", guess)
        found = daytotals.text_totals(articles.where("k % 3 <> 0"), F.col("text"), days, stored, max_terms=7)
        assert key(daystats.cap_terms(found, 7)) == key(daystats.cap_terms(plain, 7))
        assert found.count() < plain.count()


def test_buckets_bound_every_term_and_hold_few_days_at_once(monkeypatch):
    monkeypatch.setattr(daytotals, "HELD_DAYS", 2)
    rng = np.random.default_rng(5)
    day, hashes, n = rng.integers(0, 9, 500), rng.integers(0, 1 << 32, 500), rng.integers(1, 400, 500)
    held, batches = {}, []
    for part in (slice(0, 250), slice(250, 500)):
        batches += daytotals._put(held, day[part], hashes[part], n[part])
        assert len(held) <= 2
    batches.append(daytotals._bucket_rows(held))
    sums = {}
    for r in (r for b in batches for r in b.to_pylist()):
        sums[r["date"], r["part"]] = sums.get((r["date"], r["part"]), 0) + daytotals._counts(r["counts"])
    assert sum(int(s.sum()) for s in sums.values()) == n.sum()
    width = daytotals.BUCKETS // daytotals.PARTS
    for d, b, c in zip(day.tolist(), daytotals.bucket_of(hashes).tolist(), n.tolist()):
        assert sums[dt.date(1970, 1, 1) + dt.timedelta(days=d), b // width][b % width] >= c


def test_lists_of_texts_equal_those_of_their_terms(spark):
    articles = frame(spark)
    days = daystats.day_headers(articles.where("date is not null"))
    bounds = {"max_terms": 9, "max_articles": 3, "max_authors": 2}
    key = lambda df: sorted((r.date, r.term, r.tf, r.df, r.article_ids, r.authors) for r in df.collect())
    stored = counted(articles.where("k % 3 = 0"))
    found = daytotals.day_terms(articles.where("k % 3 <> 0"), F.col("text"), days, stored, **bounds)
    assert key(found) == key(daystats.day_terms(counted(articles), days, **bounds))


def test_wanted_pairs_and_top_terms_equal_those_of_all_counts():
    some = rows(200)
    texts, dates = pa.array([r[4] for r in some], pa.string()), pa.array([r[1] for r in some], pa.date32())
    for options in ({}, {"max_n": 4, "min_token_len": 1}, {"stopwords": (), "allowlist": ()}):
        rules = grams.Rules.of(**options)
        counts = grams.counts(texts, rules).to_pylist()
        assert grams.top(texts, rules, 3).to_pylist() == [sorted(c, key=lambda e: (-e["tf"], e["term"]))[:3] for c in counts]
        assert grams.top(texts, rules, None).to_pylist() == [sorted(c, key=lambda e: (-e["tf"], e["term"])) for c in counts]
        pairs = sorted({(r[1], e["term"]) for r, c in zip(some, counts) for e in c if r[1]})[::3] + [(DAY, "not there"), (DAY, "a  b"), (DAY, "")]
        asked = grams.Wanted(np.array([(d - dt.date(1970, 1, 1)).days for d, _ in pairs]), pa.array([t for _, t in pairs]))
        place, day, term = asked.met(texts, dates, rules)
        met = sorted(zip(place.tolist(), asked.terms.take(pa.array(term)).to_pylist()))
        assert met == sorted((k, e["term"]) for k, (r, c) in enumerate(zip(some, counts)) for e in c if (r[1], e["term"]) in set(pairs))
        assert all(some[k][1] == dt.date(1970, 1, 1) + dt.timedelta(days=d) for k, d in zip(place.tolist(), day.tolist()))


def test_words_are_hashed_together_as_one_by_one():
    words = ["", "a", "don't", "b2", "x" * 32, "x" * 33, "w" * 500]
    assert grams.word_hashes(pa.array(words)[1:]).tolist() == [zlib.crc32(w.encode()) for w in words[1:]]
    assert grams.word_hashes(pa.array([], pa.string())).tolist() == []


def test_columns_are_made_for_asked_grams_only(monkeypatch):
    some = rows(200)
    texts, dates = pa.array([r[4] for r in some], pa.string()), pa.array([r[1] for r in some], pa.date32())
    rules, made, plain = grams.Rules.of(), [], grams.columns_at
    everything = grams.totals(texts, dates, rules)
    # as many places as hashes, and every hash that of its term
    assert everything[1].tolist() == [grams.hashed(t) for t in everything[2].to_pylist()]
    asked = set(everything[1].tolist()[::7])
    monkeypatch.setattr(grams, "columns_at", lambda codes, n, at, max_n: made.append(len(at)) or plain(codes, n, at, max_n))
    found = grams.totals(texts, dates, rules, lambda days: lambda at, hashes: np.isin(hashes, list(asked)))
    entries = lambda t: sorted(zip(t[0].tolist(), t[2].to_pylist(), t[3].tolist(), t[4].tolist()))
    keep = [h in asked for h in everything[1].tolist()]
    assert entries(found) == [e for e in entries(everything) if grams.hashed(e[1]) in asked] and any(keep)
    assert sum(made) == found[3].sum() < everything[3].sum() // 2


def test_whole_lists_of_texts_equal_those_of_all_states_and_move_less(spark, monkeypatch):
    monkeypatch.setattr(windows, "SIZE", 1000)
    monkeypatch.setattr(windows, "PIECE", 2000)
    monkeypatch.setattr(windows, "ENTRIES", 50)
    articles = frame(spark).withColumn("article_id", F.when(F.col("k") % 11 != 0, F.concat(F.lit("s--"), (F.col("k") % 250).cast("string"))))
    # a day of one article keeps all of its terms
    articles = articles.union(articles.where("k = 7").withColumn("date", F.lit(dt.date(2024, 2, 1))))
    days = daystats.day_headers(articles.where("date is not null"))
    key = lambda df: sorted((r.date, r.term, r.tf, r.df, r.article_ids, r.authors) for r in df.collect())
    for table, options in ((1, {}), (1 << 25, {"max_n": 4, "min_token_len": 1}), (1 << 25, {"max_n": 1, "stopwords": (), "allowlist": ()})):
        monkeypatch.setattr(windows, "TABLE", table)
        counts = txt.with_term_counts(articles, F.col("text"), keep=("date", "article_id", "author"), **options)
        for bounds in ({"max_articles": None, "max_authors": None}, {"max_articles": 3, "max_authors": 2}):
            found = daytotals.day_terms(articles, F.col("text"), days, max_terms=None, **bounds, **options)
            assert key(found) == key(daystats.day_terms(counts, days, max_terms=None, **bounds)) != []
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # tokens are moved, not terms
    assert "term_counts" not in plan and plan.count("RepartitionByExpression [date") == 2
    assert {"data", "words"} <= {c.split("#")[0] for c in plan.split("MapInArrow")[2].split("]")[0].replace("[", " ").replace(",", " ").split()}
