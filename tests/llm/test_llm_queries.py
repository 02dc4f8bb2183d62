"""Registered queries and the pipeline on the small given tables."""

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from catalith.llm import kernel

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
COLUMNS = {
    "op1_vantage_point_search": {"query_id", "rank", "vec_id", "score"},
    "op2_suffix_dedup": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op3_minhash_near_dedup": {"doc_id", "class_id", "kept"},
    "op4_packing": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op5_quality_classifier": {"doc_id", "held_out", "score", "predicted"},
    "op6_token_files": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op7_lexicon_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op8_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op9_metric_join": {"vec_id", "n_links", "component_id", "kept"},
    "op10_language_id": {"doc_id", "held_out", "lang_pred", "score"},
}


@pytest.mark.parametrize("name", COLUMNS)
def test_query(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    assert COLUMNS[name] <= set(df.columns)
    n = df.count()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    if "doc_id" in df.columns and name != "op4_packing":
        assert n == docs
    assert n > 0


def test_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(None, "no id " * 30, "en", "s", 1), (10**9, None, None, None, None), (10**9 + 1, "", "en", "s", 0), (10**9 + 2, "the same words " * 2000, "en", "s", 5)], docs.schema)
    docs = docs.union(odd)
    columns, counts = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = kernel.stored(stage(spark, docs, FOLDER), name)
        counts.append(docs.count())
        if name != "packing":
            assert docs.columns == columns
    assert counts[0] >= counts[1] >= counts[2] == counts[3] <= counts[4]
    empty = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).count() == 0


def test_nothing_else_imports_the_subpackage():
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for base in ("catalith", "bindings"):
        for folder, _, files in os.walk(os.path.join(root, base)):
            if os.path.join("catalith", "llm") in folder:
                continue
            for f in files:
                if f.endswith(".py"):
                    assert "llm" not in open(os.path.join(folder, f)).read(), f
