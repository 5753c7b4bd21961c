"""The pipeline: stages, columns, decisions, and the token files at the end."""

import duckdb
import numpy as np
import public_tokenizers
import zlib
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from gristmill.llm import oracles
from gristmill.llm import queries as llm_queries
from tests.llm.helpers import classes, shingles
from tools.compare import TABLES, difference

SF = "/root/testdata/sf0.001"


def test_registered():
    names = queries()
    assert "pipeline" in names and set(llm_queries.catalog()) <= set(names)
    assert set(oracles.oracles()) <= set(oracle_sql())


def test_sql_twins(spark):
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in oracles.oracles().items():
        ours = llm_queries.catalog()[name](spark, SF).toPandas()
        assert difference(ours, db.sql(sql).df()) is None


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.toPandas()
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near-dedup", "decontamination", "mixing", "tokens"]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        after = docs.toPandas()
        if name != "tokens":
            assert docs.columns == columns
            assert set(after.doc_id) <= set(before.doc_id)
        if name == "near-dedup":
            roots = classes({i: shingles(t) for i, t in zip(before.doc_id, before.text)}, corpus_pipeline.NEAR_PERCENT)
            assert sorted(after.doc_id) == sorted(set(roots.values()))
        if name == "tokens":
            tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
            start = 0
            rows = after.sort_values(["doc_id", "start"]).itertuples(index=False)
            for row, (i, text) in zip(rows, sorted(zip(before.doc_id, before.text)), strict=True):
                ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [1], "<u4")
                assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (
                    i, start, len(ids), zlib.crc32(ids.tobytes()))
                start += len(ids)
        before = after


def test_empty_documents(spark, tmp_path):
    """All stages pass an empty table on."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.count() == 0


def test_near_copies_from_80_percent(spark):
    """The stage drops near copies between 0.80 and 0.85 too, as brute force does."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sets = {r.doc_id: shingles(r.text) for r in docs.collect()}
    kept = [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, sf).select("doc_id").collect()]
    assert sorted(kept) == sorted(set(classes(sets, 80).values()))
    assert len(kept) < len(set(classes(sets, 85).values()))
