"""The pipeline next to plain code, stage by stage on the stage's own input."""

import corpus_pipeline
import pytest

from tests.llm import helpers as h
from tests.llm.test_dedup import plain_components, plain_contained
from tests.llm.test_packing_and_tokens import check_sequences, expected_pieces, plain  # noqa: F401
from termpulse.llm import quality

pytestmark = h.needs_data


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows (doc_id, text) after each stage, the first those of ``documents``."""
    folder, docs = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{h.SF}/documents.parquet")
    columns, out = docs.columns, {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, h.SF).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out[name] = docs.collect()
        assert name == "packing" or docs.columns == columns
    return out


def ids(rows):
    return {r.doc_id for r in rows}


def test_quality_rejects_what_it_predicts(spark, stages):
    docs, labels = (spark.read.parquet(f"{h.SF}/{t}.parquet") for t in ("documents", "labels"))
    assert ids(stages["quality"]) == {r.doc_id for r in quality.scored(docs, labels).collect() if r.predicted}


def test_exact_keeps_one_of_equal_texts(stages):
    best = {}
    for r in stages["quality"]:
        key = "".join((r.text or "").translate(dict.fromkeys(b" \t\n\x0b\x0c\r")))
        best[key] = min(best.get(key, (1, 0)), (-len(r.text or ""), r.doc_id))
    assert ids(stages["exact_dedup"]) == {d for _, d in best.values()}


def test_near_dedup_keeps_the_least_of_each_group(stages):
    groups = plain_components([(r.doc_id, r.text) for r in stages["exact_dedup"]], 2)
    assert ids(stages["near_dedup"]) == {least for _, _, least in groups}


def test_decontamination_drops_what_contains_an_item(stages):
    items = h.table("benchmark")
    bad = {d for d, *_ in plain_contained([(r.doc_id, r.text) for r in stages["near_dedup"]], items)}
    assert ids(stages["decontamination"]) == ids(stages["near_dedup"]) - bad


def test_packing_places_every_piece(stages, plain):  # noqa: F811
    rows = stages["packing"]
    kept = [(r.doc_id, r.text) for r in stages["decontamination"]]
    assert sorted(tuple(r)[:5] for r in rows) == sorted(expected_pieces(kept, plain))
    check_sequences([(r.length, r.sequence_id, r.offset) for r in rows])


def test_run_gives_the_last_stage(spark, stages):
    key = lambda r: tuple(r)[:5]
    assert sorted(map(key, corpus_pipeline.run(spark, h.SF).collect())) == sorted(map(key, stages["packing"]))


def test_stages_on_edge_rows(spark):
    """Nulls, empty and very long texts, ties, repeated rows, clashing names and empty tables, as the docstring says."""
    docs = h.frame(spark, h.edge_rows(), clashing=True)
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, h.SF).collect()
        kept = sorted((r.doc_id for r in rows if r.doc_id is not None))
        assert stage(spark, docs.limit(0), h.SF).count() == 0, name
        if name == "packing":
            assert set(kept) == {1, 2, 3, 4, 5, 6, 7, 8, 9, 10} and sum(r.length for r in rows if r.doc_id in (2, 3, 4)) == 3
            continue
        assert rows[0].__fields__ == docs.columns and all(r.row == "kept" and r.fp == "kept" for r in rows), name
        if name == "exact_dedup":
            assert kept == [1, 4, 6, 7, 8, 9, 10] and len(rows) == 8
        if name == "near_dedup":
            assert kept == [1, 2, 6, 8, 9, 10] and len(rows) == 7
        if name == "decontamination":
            assert kept == [1, 2, 3, 4, 5, 5, 6, 7, 8, 9, 10]
