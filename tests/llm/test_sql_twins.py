"""Queries with a SQL twin, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from scread.llm import queries


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_twin(spark, sf, name):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    df = queries.queries()[name](spark, sf)
    cols = sorted(df.columns)
    want = con.execute(f"select {', '.join(cols)} from ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in df.select(cols).collect()))) == sorted(map(str, want))


def test_pipeline_on_small_tables(spark, sf):
    import corpus_pipeline as p

    assert [n for n, _ in p.STAGES] == ["quality classifier", "n-gram Jaccard join", "substring dedup", "mixing", "packing"]
    d = spark.read.parquet(f"{sf}/documents.parquet")
    for _, step in p.STAGES[:-1]:
        d2 = step(spark, d, sf)
        assert d2.columns == p.COLUMNS
        d = d2
    out = p.run(spark, sf)
    assert out.count() > 0 and out.groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0] <= 2048
