import corpus_pipeline
from inkwell.llm import queries

from .helpers import SMALL


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    start, seen = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == start.columns, name
        seen.append(docs.count())
    assert seen[0] > seen[1] > seen[2] >= seen[3]
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_run_equals_the_stages_in_a_row(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
    got = queries.pipeline(spark, SMALL)
    assert got.columns == docs.columns and {"shard", "slot"} <= set(got.columns)
    rows = sorted(map(tuple, got.collect()))
    assert rows == sorted(map(tuple, docs.collect())) and len(rows) > 50
    assert len({r.shard for r in got.select("shard").collect()}) == 8
