"""The pipeline's stages one by one, each judged on its own input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dimloom.llm import (
    bpe,
    centroids,
    forest,
    jaccard,
    lempel_ziv,
    neighbours,
    packing,
    personal,
    queries,
    spelling,
    unigram,
)
from dimloom.llm.common import stored, table
from tests.llm.helpers import odd_documents
from tests.llm.test_jaccard import by_pairs
from tests.llm.test_personal import base

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = table(spark, SF_DIR, "documents")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stored(stage(spark, frames[-1], SF_DIR), name))
    return frames


def test_names_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_copies", "personal_data", "packing",
    ]
    assert all(f.columns == steps[0].columns for f in steps[1:4])


def test_rejected_documents_are_toxic(spark, steps):
    labels = table(spark, SF_DIR, "labels")
    gone = steps[0].join(steps[1], "doc_id", "left_anti").join(labels, "doc_id")
    assert gone.count() > 0 and gone.where("toxic = 0").count() <= 1
    assert steps[1].exceptAll(steps[0]).isEmpty()


def test_one_of_each_group_stays(steps):
    rows = {r["doc_id"]: r["text"] for r in steps[1].collect()}
    ids = sorted(rows)
    want = {ids[least] for _, least, _ in by_pairs([rows[i] for i in ids]).values()}
    assert {r["doc_id"] for r in steps[2].collect()} == want
    assert steps[2].exceptAll(steps[1]).isEmpty()


def test_personal_data_is_masked_and_the_rest_kept(steps):
    before = {r["doc_id"]: r for r in steps[2].collect()}
    after = {r["doc_id"]: r for r in steps[3].collect()}
    assert before.keys() == after.keys()
    for i, row in after.items():
        assert not base(row["text"] or "")
        if not base(before[i]["text"] or ""):
            assert row == before[i]


def test_every_document_is_packed(steps):
    tokens = steps[4].groupBy("doc_id").agg(
        F.sum("length").alias("sum"), F.max("doc_tokens").alias("all"), F.sum(F.size("ids")).alias("ids")
    )
    assert tokens.count() == steps[3].count()
    assert tokens.where("sum <> all or ids <> all").isEmpty()


def test_run_is_the_stages_in_turn(spark, steps):
    columns = ["doc_id", "start", "length", "ids_crc32"]
    whole_run = corpus_pipeline.run(spark, SF_DIR).select(columns)
    assert whole_run.exceptAll(steps[4].select(columns)).isEmpty()
    assert whole_run.count() == steps[4].count()


def test_odd_rows(spark):
    """Nulls, blanks, repeated rows and ids, clashing columns: the results that are stated."""
    docs = [odd_documents(spark)]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(stored(stage(spark, docs[-1], SF_DIR), "odd"))
    odd, clean, single, masked, packed = docs
    # Too few labels to learn from: all stay. The repeated row goes; texts without words stay.
    assert clean.exceptAll(odd).isEmpty() and clean.count() == odd.count()
    assert single.count() == odd.count() - 1 and single.exceptAll(odd).isEmpty()
    assert masked.schema == odd.schema and masked.exceptAll(single).isEmpty()
    whole = packed.groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n"))
    assert whole.where("n % doc_tokens <> 0").isEmpty()
    assert packed.where("start = 0").count() == masked.count()
    assert packed.where("doc_tokens = 1").count() == 4  # two nulls, an empty and a blank text


def test_empty_tables_pass_all_stages(spark):
    docs = table(spark, SF_DIR, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), "none")
        assert docs.count() == 0


def test_operators_run_on_plain_frames_and_leave_the_session_alone(spark):
    """No query has opened the tables; the package and small batches come with the operator."""
    names = [f"spark.sql.execution.arrow.max{x}PerBatch" for x in ("Records", "Bytes")]
    before = {name: spark.conf.get(name, None) for name in names}
    for name in names:
        spark.conf.unset(name)
    usual = [spark.conf.get(name) for name in names]
    docs = spark.createDataFrame([(1, "some words " * 30), (2, None)], "doc_id long, text string")
    vectors = spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 4.0])], "vec_id long, embedding array<float>")
    try:
        assert packing.pack(docs, queries.vocabulary("word_bpe_49k.json")).count() > 1
        assert lempel_ziv.document_fingerprints(docs).count() == 2
        assert bpe.round_trip_digests(docs, queries.vocabulary("byte_bpe_50k.json")).count() == 2
        assert unigram.token_counts(docs, queries.vocabulary("byte_bpe_50k.tiktoken")).count() == 2
        assert jaccard.jaccard_components(docs).count() == 2
        assert personal.personal_data(docs).count() == 2
        assert neighbours.nearest_neighbours(vectors, F.col("vec_id") == 1).count() == 1
        assert forest.near_duplicates(vectors).where("n_links = 1").count() == 2
        assert spelling.spelling_forms(docs).count() == 2 - 1
        assert centroids.centroid_clusters(vectors, length=2).count() == 2
        assert [spark.conf.get(name) for name in names] == usual
    finally:
        for name, value in before.items():
            if value is not None:
                spark.conf.set(name, value)


@pytest.mark.parametrize("name", [n for n in queries.QUERIES])
def test_registered_queries_run(spark, name):
    result = queries.QUERIES[name](spark, SF_DIR)
    assert result.count() > 0
