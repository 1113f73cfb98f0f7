import datetime as dt

from checks import report_queries as report
from termpulse.operators import daytotals


def documents(spark, path):
    words = ["alpha", "beta", "gamma delta", "epsilon", "prompt injection"]
    rows = [(k, f"{words[k % 5]} {words[k % 3]} of the {words[k * k % 5]} day", "en", f"src{k % 4}", 40 if k % 6 else 400) for k in range(90)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return str(path)


def counted_passes(monkeypatch):
    read, plain = [], daytotals.by_day
    monkeypatch.setattr(daytotals, "by_day", lambda *a: read.append(1) or plain(*a))
    return read


def test_elections_of_the_api_count_the_texts_once(spark, tmp_path, monkeypatch):
    path, read = documents(spark, tmp_path), counted_passes(monkeypatch)
    rows = report.api_elections(spark, path).collect()
    assert sum(read) == 1
    assert len(rows) == 15 and all(r.word and r.evidence_article_ids and r.candidate_terms for r in rows)


def test_elections_of_the_export_come_from_its_terms(spark, tmp_path, monkeypatch):
    path, read = documents(spark, tmp_path), counted_passes(monkeypatch)
    shown = {str(r.date): (r.word, r.candidate_terms) for r in report.api_elections(spark, path).collect()}
    read.clear()
    rows = report.export_roundtrip(spark, path).where("table = 'elections'").collect()
    assert sum(read) == 1
    assert {r.a: (r.b, r.more) for r in rows if r.a in shown} == shown
    assert len(rows) == 30 and dt.date.fromisoformat(min(r.a for r in rows)) == dt.date(2024, 1, 1)
