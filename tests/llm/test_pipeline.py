"""The registered queries and the stages over the smallest tables."""

import zlib

import pandas as pd
import pytest
import public_tokenizers

import corpus_pipeline
from checks.compare import database, difference
from clickweir.llm import common, decontamination, packing, queries
from test_overlap import brute_force

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.statements()))
def test_query_equals_sql(spark, name):
    assert difference(spark, database(FOLDER), name, FOLDER) is None


@pytest.mark.parametrize("name", [n for n in queries.registered() if n != "pipeline"])
def test_queries_run(spark, name):
    found = queries.registered()[name](spark, FOLDER).count()
    assert found > 0 or name == "op4_secret_scans"  # these few documents have no secret


@pytest.mark.parametrize("name,column,modulus,held", [("op1_toxicity", "toxic", 5, 0), ("op2_quality_classifier", "quality", 4, 2)])
def test_held_out_accuracy(spark, name, column, modulus, held):
    folder = "/root/testdata/sf0.01"
    got = queries.registered()[name](spark, folder).toPandas()
    assert (got["held_out"] == got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % modulus == held)).all()
    judged = got[got["held_out"]].merge(pd.read_parquet(f"{folder}/labels.parquet"), on="doc_id")
    assert (judged["predicted"] == judged[column]).mean() > 0.9


def test_stages_one_by_one(spark):
    docs = common.table(spark, FOLDER, "documents")
    before = {r["doc_id"]: r for r in docs.collect()}
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.stored(stage(spark, docs, FOLDER), "test-stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    toxic, near, clean, masked = kept
    assert set(masked) == set(clean) <= set(near) <= set(toxic) <= set(before)
    assert sorted(near) == brute_force(sorted(toxic.items()))
    passages = [(r["item_id"], r["text"]) for r in common.table(spark, FOLDER, "benchmark").collect()]
    index = decontamination.Index(passages, decontamination.Settings())
    assert set(clean) == {i for i, t in near.items() if not index.leaks(t)}
    assert not any(p in t for t in clean.values() for _, p in passages)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).toPandas()
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    assert packed.groupby("doc_id")["length"].sum().to_dict() == {i: len(packing.encode(t, ranks)) + 1 for i, t in masked.items()}


def test_stages_on_no_documents_and_more_columns(spark):
    docs = common.table(spark, FOLDER, "documents").withColumn("score", common.F.lit(1)).withColumn("row", common.F.lit("x"))
    for given in (docs.limit(0), docs.limit(20)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            given = common.stored(stage(spark, given, FOLDER), "test-stage")
            assert given.columns == docs.columns, name
        corpus_pipeline.STAGES[-1][1](spark, given, FOLDER).count()


@pytest.mark.parametrize("given,left", [("10000", "2000"), ("0", "2000"), ("500", "500")])
def test_stages_send_small_batches_of_texts(spark, given, left):
    """Batches are made smaller than Spark's, never larger than was asked for; 0 stands for no bound."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, given)
    try:
        corpus_pipeline.decontamination_stage(spark, common.table(spark, FOLDER, "documents"), FOLDER)
        assert spark.conf.get(name) == left
    finally:
        spark.conf.set(name, before)
