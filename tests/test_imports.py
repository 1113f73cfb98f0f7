import json
from pathlib import Path

from checks import source_queries
from termpulse.session import shared_dir
from termpulse.sources import imports


def test_a_file_of_several_articles(spark, tmp_path):
    (tmp_path / "2024-01-02").mkdir()
    (tmp_path / "2024-01-02" / "a.json").write_text(json.dumps([{"article_id": "a"}, {"article_id": "b", "top_terms": [["x", "3"]]}]))
    (tmp_path / "2024-01-02" / "c.json").write_text(json.dumps({"article_id": "c"}))
    assert sorted(r.article_id for r in imports.read_articles(spark, str(tmp_path)).collect()) == ["a", "b", "c"]


def test_articles_share_files(spark, tmp_path):
    # rows of their own
    docs = spark.range(0, 900).selectExpr("id doc_id", "concat('text \\n', id) text", "'src1' source", "'en' lang", "8L n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.glob("json-articles-*"))
    assert source_queries.json_articles(spark, str(tmp_path)).count() == 900
    (made,) = set(folder.glob("json-articles-*")) - before
    assert len(list(made.rglob("*.txt"))) == 30
