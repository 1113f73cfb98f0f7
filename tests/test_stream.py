import datetime as dt

import pytest
from pyspark.sql import functions as F

from termpulse.sources import tables
from termpulse.streaming import deltas
from tests.test_jobs import DAYS, SETTINGS, raw, snapshot

LANDED = dt.datetime(2026, 4, 14, 6)
STATS = (("terms", "date", "term", "tf", "df", "article_ids", "authors"), ("days", "date", "document_count"), ("articles", "article_key", "bucket_date"))


def landed(spark, rows, at=LANDED):
    return raw(spark, rows).withColumn("landed_at", F.lit(at))


def state(spark, root):
    return [snapshot(spark, root, name, *columns) for name, *columns in STATS]


def run(spark, tmp_path, loads, name="data"):
    """The folder after a run for each load, on one checkpoint."""
    root, source = str(tmp_path / name), str(tmp_path / f"{name}-in")
    for load in loads:
        load.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(load.schema).option("maxFilesPerTrigger", 1).parquet(source)
        deltas.start(stream, root, SETTINGS, str(tmp_path / f"{name}-cp"), available_now=True).awaitTermination()
    return root


def test_restarts_late_items_and_copies_equal_one_load(spark, tmp_path):
    again = [("other", "x", DAYS[0][2], "copy of a URL agents")]
    copies = landed(spark, again, LANDED + dt.timedelta(days=1)).withColumn("url_canonical", F.lit("https://a.com/g11-0"))
    parts = run(spark, tmp_path, [landed(spark, DAYS[3:]), landed(spark, DAYS[:3]), copies])
    whole = run(spark, tmp_path, [landed(spark, DAYS)], "whole")
    assert state(spark, parts) == state(spark, whole)
    assert {r.term: r.tf for r in tables.read(spark, parts, "terms").where("date = '2026-04-13'").collect()}["mcp"] == 12
    assert tables.read(spark, parts, "articles").count() == 6 and len(deltas.live(spark, parts, "terms")) == 3


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "data")
    deltas.write_batch(landed(spark, DAYS[:4]), 0, root, SETTINGS)
    deltas.write_batch(landed(spark, DAYS[4:]), 1, root, SETTINGS)
    before = state(spark, root)
    deltas.write_batch(landed(spark, DAYS[4:]), 1, root, SETTINGS)
    assert state(spark, root) == before


def test_compacted_batches_give_the_same_stats(spark, tmp_path):
    root = str(tmp_path / "data")
    for k in range(3):
        deltas.write_batch(landed(spark, DAYS[2 * k : 2 * k + 2]), k, root, SETTINGS)
    before = state(spark, root)
    deltas.compact(spark, root, SETTINGS)
    assert [f[:2] for f in deltas.live(spark, root, "terms")] == [(0, 2)] == [f[:2] for f in deltas.live(spark, root, "days")]
    # folders that a merge covers no longer count
    deltas._write(deltas.deltas(spark, root, "days"), root, "days", 1, 1)
    deltas.publish(spark, root, SETTINGS, [dt.date(2026, 4, d) for d in (11, 12, 13)])
    assert state(spark, root) == before


def test_of_one_batch_the_first_item_of_a_url_wins(spark, tmp_path):
    rows = raw(spark, [("b", "2", DAYS[0][2], "second agents"), ("a", "1", DAYS[0][2], "first agents"), ("c", "3", None, ""), ("d", "4", "", None)])
    rows = rows.withColumn("item_ord", F.array(F.when(F.col("external_id") == "1", 0).otherwise(5).cast("bigint")))
    shared = F.when(F.col("external_id").isin("1", "2"), F.lit("https://x.com/same"))
    root = run(spark, tmp_path, [rows.withColumn("url_canonical", shared).withColumn("landed_at", F.lit(LANDED))])
    found = {(r.source_id, r.url_canonical) for r in tables.read(spark, root, "articles").collect()}
    # items without a URL are one, too
    assert found == {("a", "https://x.com/same"), ("c", None)}


def test_items_without_a_landing_time_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        deltas.write_batch(raw(spark, DAYS), 0, str(tmp_path), SETTINGS)


def test_an_empty_batch(spark, tmp_path):
    root = str(tmp_path / "data")
    deltas.write_batch(landed(spark, DAYS).limit(0), 0, root, SETTINGS)
    assert tables.read(spark, root, "terms").count() == 0 == tables.read(spark, root, "days").count()


def test_states_of_a_batch_have_a_size_that_its_terms_do_not_set(spark, tmp_path):
    root = str(tmp_path / "data")
    deltas.write_batch(landed(spark, DAYS[:4]), 0, root, SETTINGS)
    deltas.write_batch(landed(spark, DAYS[4:]), 1, root, SETTINGS)
    (day,) = spark.sql("select date'2026-04-13' d").first()
    states = deltas.deltas(spark, root, "terms", [day])
    assert "term" not in states.columns and states.groupBy("part").count().where("count > 2").count() == 0


def test_first_items_are_found_on_columns_and_their_state_is_keyed_in_the_jvm(spark, tmp_path):
    load = landed(spark, DAYS)
    load.write.parquet(str(tmp_path / "in"))
    rows = deltas.first_wins(spark.readStream.schema(load.schema).parquet(str(tmp_path / "in")))
    stream = rows.writeStream.format("memory").queryName("firsts").outputMode("append").trigger(availableNow=True)
    query = stream.option("checkpointLocation", str(tmp_path / "cp")).start()
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert "Pandas" not in plan and "StreamingDeduplicate" in plan
    assert spark.table("firsts").count() == load.count()


def test_an_order_with_a_missing_number_comes_first(spark, tmp_path):
    rows = raw(spark, [("a", "1", DAYS[0][2], "first agents"), ("b", "2", DAYS[0][2], "second agents")])
    order = F.when(F.col("external_id") == "2", F.array(F.lit(None).cast("bigint"))).otherwise(F.array(F.lit(1).cast("bigint")))
    rows = rows.withColumn("item_ord", order).withColumn("url_canonical", F.lit("https://x.com/same")).withColumn("landed_at", F.lit(LANDED))
    root = run(spark, tmp_path, [rows])
    assert [r.source_id for r in tables.read(spark, root, "articles").collect()] == ["b"]


def test_stats_read_the_texts_of_their_days_in_place(spark, tmp_path):
    root = str(tmp_path / "data")
    deltas.write_batch(landed(spark, DAYS), 0, root, SETTINGS)
    rows = deltas._texts(spark, root, [dt.date(2026, 4, 13)])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert all("/fulltext/" in file for file in rows.inputFiles())
    articles = tables.read(spark, root, "articles").where("bucket_date = '2026-04-13'")
    assert sorted((r.article_id, r.author) for r in rows.collect()) == sorted((r.article_id, r.author or None) for r in articles.collect())


def test_a_large_load_lands_in_many_files_and_is_one_batch(spark, tmp_path, monkeypatch):
    from checks import report_queries

    texts = [(k, "s", f"agents {k % 5} meet mcp", 20) for k in range(400)]
    docs = spark.createDataFrame(texts, "doc_id bigint, source string, text string, n_chars bigint")
    docs.repartition(3).write.parquet(str(tmp_path / "sf/documents.parquet"))
    monkeypatch.setattr(report_queries, "shared_dir", lambda spark: str(tmp_path / "out"))
    batches = []
    write = deltas.write_batch
    monkeypatch.setattr(deltas, "write_batch", lambda batch, k, *rest: (batches.append(k), write(batch, k, *rest)))
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        assert report_queries._parts(spark, str(tmp_path / "sf")) == 3
        found = report_queries.stream_first_wins(spark, str(tmp_path / "sf")).collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    (landing,) = (tmp_path / "out").glob("stream-*/landing")
    assert len(list(landing.glob("part=*/*.parquet"))) == 3 * report_queries.LOADS
    assert batches == [0, 1, 2] and len(found) == 400 and {str(r.first_seen_date) for r in found} == {"2024-01-28", "2024-01-29", "2024-01-30"}
