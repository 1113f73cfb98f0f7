import hashlib

from pyspark.sql import functions as F

from tests.llm import helpers as h  # noqa: F401
from termpulse.llm import warc

PAGE = '<html><head><title>A &amp; B</title></head><body><p>One</p><script>x()</script><a href="/x">two</a><a href="#y">z</a></body></html>'
ROWS = [(1, "https://a.example/p", PAGE), (2, None, None), (3, "https://b.example/", ""), (None, "https://a.example/p", PAGE), (1, "https://a.example/p", PAGE)]


def pages(spark, rows=ROWS):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record_type", F.lit("mine"))


def test_derivatives_refer_to_their_response(spark):
    responses = warc.responses(pages(spark), date=F.lit("2024-01-30T06:00:00Z"), keep=["page_id"])
    made = warc.derive(responses, keep=["page_id"]).collect()
    source = {r.record_id: r for r in responses.collect()}
    assert len(made) == 2 * len(ROWS) and len(source) == len(ROWS) - 1
    for r in made:
        of = source[r.refers_to]
        assert (r.target_uri, r.warc_date, r.http_header) == (of.target_uri, of.warc_date, of.http_header)
        assert (r.source_payload_digest, r.source_block_digest) == (of.payload_digest, of.block_digest)
        assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest()
        assert of.block_digest == "sha256:" + hashlib.sha256(f"{of.http_header}\r\n{of.block}".encode()).hexdigest()
    one = {r.record_type: r for r in made if r.page_id == 1}
    assert one["conversion"].block == "A & B\nOne\ntwo\nz"
    assert "title: A & B\r\n" in one["metadata"].block and "outlink: /x L a/@href\r\n" in one["metadata"].block
    assert f"conversion: {one['conversion'].record_id}\r\n" in one["metadata"].block and "#y" not in one["metadata"].block
    assert {r.block for r in made if r.page_id in (2, 3) and r.record_type == "conversion"} == {""}


def test_files_round_trip(spark, tmp_path):
    responses = warc.responses(pages(spark))
    both = responses.select(*warc.RECORD).unionByName(warc.derive(responses).select(*warc.RECORD))
    warc.write(both, f"{tmp_path}/warc")
    back = warc.read(spark, f"{tmp_path}/warc").collect()
    key = lambda r: (r.record_type, r.record_id, r.refers_to or "", r.target_uri or "", r.block_digest, r.block or "", r.payload_digest or "")
    assert all(r.whole for r in back) and sorted(map(key, back)) == sorted(map(key, both.collect()))
    assert {r.http_header for r in back if r.record_type == "response"} == {r.http_header for r in responses.collect()}


def test_only_responses_are_derived_from(spark):
    responses = warc.responses(pages(spark)).withColumn("record_type", F.lit("request"))
    assert warc.derive(responses).collect() == []
    assert warc.derive(warc.responses(pages(spark, []))).collect() == []
