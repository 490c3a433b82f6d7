"""Callers' columns come back as they were, whatever they are called."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from inkwell.llm import mixing, near_dedup, sharding

from .helpers import awkward_texts

NAMES = ("_id _key _copy _copies _words _slots _n _l _first _margin load posterior n_words rate id key its_key its_copy copy caller0 caller3 "
         "text_key kept component_id n_shingles size row part end hi lo n node domain n_chars").split()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, f"row {j}") for j, (i, t) in enumerate(awkward_texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, row_no string").repartition(3)
    return df.select("doc_id", "text", *[F.concat(F.lit(n + " of "), "row_no").alias(n) for n in NAMES], "row_no")


def _whole(df):
    """Every row's columns still speak of one and the same row."""
    rows = df.collect()
    assert all(r[n] == f"{n} of {r.row_no}" for r in rows for n in NAMES)
    return rows


def test_near_duplicates(docs):
    got = near_dedup.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    plain = near_dedup.drop_near_duplicates(docs.select("doc_id", "text"))
    assert sorted(map(str, ((r.doc_id, r.text) for r in _whole(got)))) == sorted(map(str, map(tuple, plain.collect())))


def test_shards(docs):
    got = sharding.shard_documents(docs)
    assert got.columns == [*docs.columns, "shard", "slot"]
    rows = _whole(got)
    assert sorted(r.row_no for r in rows) == sorted(r.row_no for r in docs.collect())
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    # the same rows in another order of partitions get the same places
    again = sharding.shard_documents(docs.repartition(5, "row_no")).collect()
    assert {(r.row_no, r.shard, r.slot) for r in again} == {(r.row_no, r.shard, r.slot) for r in rows}


def test_placement_equals_brute_force(docs):
    rows = sharding.records(docs).collect()
    rows.sort(key=lambda r: (r.key, r.doc_id is not None, r.doc_id or 0, r["size"], r.text_crc32))
    total, end, want = sum(r["size"] for r in rows), 0, []
    for r in rows:
        end += r["size"]
        want.append((r.doc_id, r.key, min(7, int((end - r["size"] / 2) * 8 / total))))
    got = [(r.doc_id, r.key, r.shard) for r in sharding.place(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_mix(docs, spark):
    labels = docs.filter("doc_id is not null").select("doc_id", F.when(F.col("doc_id") % 2 == 0, "clean").otherwise("toxic").alias("domain"))
    got = mixing.mix_documents(docs, labels, corpus_pipeline.MIX_TARGETS, keep="clean")
    assert got.columns == docs.columns and _whole(got)
    targets = {"clean": 0.5, "toxic": 0.5}
    assert mixing.mix_documents(docs, labels, targets).columns == docs.columns
    rates = mixing.mixing_rates(docs, labels, targets)
    rows = rates.collect()
    for t in mixing.mixing_totals(rates, targets).collect():
        assert t.target == pytest.approx(sum(r.n_words for r in rows) / 2)
        assert t.had == pytest.approx(sum(r.n_words * r["p_" + t.domain] for r in rows))
        assert t.reached == pytest.approx(sum(r.n_words * r["p_" + t.domain] * r.rate for r in rows))
    assert [t.reached for t in mixing.mixing_totals(rates.limit(0), targets).collect()] == [0.0, 0.0]


@pytest.mark.parametrize("run", [near_dedup.drop_near_duplicates, sharding.shard_documents])
def test_empty(docs, run):
    assert run(docs.limit(0)).count() == 0
