"""Registered queries against their SQL, and the pipeline's decisions."""

import glob
import os

import duckdb
import pytest

import corpus_pipeline
from lernspur.llm import decontam, mixing, ngramjoin, quality, queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL_BY_NAME))
def test_sql(spark, data, name):
    con = duckdb.connect()
    for path in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = queries.QUERIES[name](spark, data)
    result = con.execute(queries.ORACLE_SQL_BY_NAME[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(repr([r[names.index(c)] for c in sorted(names)]) for r in result.fetchall())
    assert sorted(repr([r[c] for c in sorted(names)]) for r in df.collect()) == want


def test_stages(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns = docs.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, data).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        own = sorted(r.doc_id for r in docs.select("doc_id").collect())
        ids = {r.doc_id for r in before.select("doc_id").collect()}
        if name == "quality_filter":
            scores = quality.quality_scores(before, spark.read.parquet(f"{data}/labels.parquet"))
            assert own == sorted(r.doc_id for r in scores.where("accepted").collect())
        elif name == "near_duplicates":
            assert own == sorted({r.component_id for r in ngramjoin.ngram_components(before).collect()})
        elif name == "decontamination":
            found = decontam.leaks(before, spark.read.parquet(f"{data}/benchmark.parquet"))
            assert own == sorted(ids - {r.doc_id for r in found.collect()})
        elif name == "source_mix":
            assert own == sorted(r.doc_id for r in mixing.mix(before).collect() for p in r.passes if p)
    assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert docs.count() == before.count()
