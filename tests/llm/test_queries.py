"""The registered queries: oracles where SQL has them, the pipeline, the guard."""

import os
import subprocess
import sys

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from ingestkit.llm.queries import QUERIES

SF_SMALL = "/root/testdata/sf0.001"


def test_one_query_an_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "minhash_dedup", "decontaminate", "mix_sources", "shard"]
    assert "pipeline" in queries() and "pipeline" in oracle_sql()


def test_one_row_a_document(spark):
    n = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    for name in ("op1_lm_scores", "op4_count_tokens", "op5_languages", "op8_remove_repeats"):
        df = queries()[name](spark, SF_SMALL)
        assert df.count() == n and "doc_id" in df.columns


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = queries()["op5_languages"](spark, "/root/testdata/sf0.01").where("held_out").join(docs, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)


def test_stages_keep_odd_rows_and_extra_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    more = spark.createDataFrame([(None, "words without an id, but readable", "en", None, 1), (9001, None, "en", "s", 0),
                                  (9002, "", None, None, 0), (9003, "the and " * 20000, None, "s", None)], docs.schema)
    docs = docs.unionByName(more).selectExpr("*", "1 AS size", "'x' AS score", "2 AS rep", "3 AS items")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        if name != "shard":
            assert out.columns == docs.columns, name
            empty = stage(spark, docs.where("false"), SF_SMALL)
            assert empty.count() == 0 and empty.columns == docs.columns
        path = str(tmp_path / name)
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        assert 0 < docs.count() and (name == "mix_sources" or docs.count() <= before.count())
        if name == "language_id":
            ids = {r.doc_id for r in docs.select("doc_id").collect()}
            assert None in ids and 9003 in ids and not ids & {9001, 9002}


def test_language_stage_without_labels_keeps_texts_with_a_letter(spark):
    docs = spark.createDataFrame([(1, "some words", None, "s", 1), (2, None, None, "s", 1), (3, "12 !", None, None, 1), (4, "\u00e9", None, "s", 1),
                                  (None, "\u4e2d", None, "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    out = dict(corpus_pipeline.STAGES)["language_id"](spark, docs, SF_SMALL)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == {1, 4, None}


def test_library_works_without_the_subpackage(tmp_path):
    """Also with the pipeline's module left in place."""
    import shutil
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(root, tmp_path / "repo", ignore=shutil.ignore_patterns("llm", ".git", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'scd2_full' in q and not any(n.startswith('op') and n[2].isdigit() for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True)
