import random

import pytest
from pyspark.sql import functions as F

from inkwell.operators import grams as G
from inkwell.operators import rules as R

SF = "/root/testdata/sf0.001"


def test_every_contained_pattern_meets_its_text(spark):
    rng = random.Random(1)
    letters = "abcab美股😀é \n"
    texts = [(i, "".join(rng.choice(letters) for _ in range(rng.randrange(0, 30)))) for i in range(80)] + [(99, None), (100, "")]
    patterns = {"".join(rng.choice(letters) for _ in range(rng.randrange(1, 8))) for _ in range(120)}
    t = spark.createDataFrame(texts, "id int, text string")
    p = spark.createDataFrame([(x,) for x in patterns] + [("",)], "p string")
    met = {(r.id, r.p) for r in G.meeting(t, F.col("text"), p, "p").collect()}
    assert {(i, x) for i, text in texts for x in patterns if x in (text or "")} <= met
    assert G.anchored(p, "p").count() == len(patterns)


def test_phrase_hits_equal_counting_with_many_rules(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id").alias("script_id"), "text").limit(60)
    rows = docs.collect()
    rng = random.Random(2)
    rules = {("filler", "the"), ("limit", "of"), ("x", "e"), ("x", "aaaa"), ("y", " the "), ("z", " the ")}
    for r in rows:
        for _ in range(60):
            a = rng.randrange(0, max(1, len(r.text) - 12))
            rules.add((rng.choice("xyz"), r.text[a:a + rng.randrange(1, 12)]))
    rules = {r for r in rules if r[1]}
    table = spark.createDataFrame([(c, p, None, None) for c, p in rules], R.RULES_SCHEMA)
    got = {tuple(h) for h in R.phrase_hits_index(docs, table).collect()}
    assert got == {(r.script_id, c, p, r.text.count(p)) for r in rows for c, p in rules if c in "xyz" and p in r.text}
    assert got == {tuple(h) for h in R.phrase_hits(docs, table).collect()}


def test_phrase_hits_of_repeated_and_missing_keys(spark):
    docs = spark.createDataFrame([(1, "ab ab"), (1, "ab cd"), (None, "cd"), (2, None), (3, "")], "script_id int, text string")
    rules = spark.createDataFrame([("c", "ab", None, None), ("c", "cd", None, None), ("c", "x", None, None)], R.RULES_SCHEMA)
    got = sorted(map(str, (tuple(r) for r in R.phrase_hits_index(docs, rules).collect())))
    assert got == sorted(map(str, [(1, "c", "ab", 2), (1, "c", "ab", 1), (1, "c", "cd", 1), (None, "c", "cd", 1)]))
    assert R.phrase_hits_index(docs, rules.limit(0)).count() == 0


def test_no_plan_holds_the_rules_in_every_row(spark, capsys):
    docs = spark.createDataFrame([(1, "a")], "script_id int, text string")
    R.phrase_hits_index(docs, R.rules_dim(spark)).explain()
    plan = capsys.readouterr().out
    assert "Subquery" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_meeting_broadcasts_neither_side(spark):
    """The exploded texts pass as a small table: joined by broadcast they fill the driver."""
    t = spark.createDataFrame([(1, "abc")], "id long, text string")
    p = spark.createDataFrame([("ab",)], "p string")
    plan = G.meeting(t, F.col("text"), p, "p")._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan


def test_candidates_are_counted_outside_interpreted_functions(spark):
    """Occurrences do not overlap, repeated keys count each text, and no array function replaces texts."""
    docs = spark.createDataFrame([(1, "aaaaa \U0001f600x\U0001f600x"), (1, "aab"), (1, None), (2, "")], "script_id int, text string")
    rules = spark.createDataFrame([("c", "aa", None, None), ("d", "aa", None, None), ("c", "\U0001f600x", None, None)], R.RULES_SCHEMA)
    hits = R.phrase_hits_index(docs, rules)
    assert sorted(tuple(r) for r in hits.collect()) == sorted(
        [(1, c, "aa", n) for c in "cd" for n in (2, 1)] + [(1, "c", "\U0001f600x", 2)])
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(" not in plan and "replace(" not in plan


@pytest.mark.parametrize("held", [1, 7, 10 ** 6])
def test_texts_send_only_grams_that_patterns_are_filed_under(spark, monkeypatch, held):
    """No contained pattern is missed, whatever its length, and a text's other grams stay in its task."""
    monkeypatch.setattr(G, "HELD_ROWS", held)
    rng = random.Random(5)
    letters = "abcdefgh美股😀é \n"
    texts = [(i % 40, "".join(rng.choice(letters) for _ in range(rng.randrange(0, 200)))) for i in range(60)] + [(99, None), (100, ""), (None, "abc")]
    patterns = {x[a:a + n] for _, x in texts if x for n in (1, 2, 3, 5, 6, 9) for a in [rng.randrange(len(x))]} - {""}
    t = spark.createDataFrame(texts, "id int, text string")
    filed = G.anchored(spark.createDataFrame([(x,) for x in patterns], "p string"), "p", G.TEXT_WIDTHS)
    grams = G.passing_grams(t, "id", "text", G.gram_filter(filed))
    met = {(r.id, r.p) for r in grams.join(filed, "gram").collect()}
    assert filed.count() == len(patterns) and {(i, x) for i, text in texts for x in patterns if x in (text or "")} <= met
    one = G.anchored(spark.createDataFrame([("abcdefgh",)], "p string"), "p", G.TEXT_WIDTHS)
    sent = G.passing_grams(spark.createDataFrame([(1, "x abcdefgh y" * 9), (2, "b c d e f g h " * 50)], "id int, text string"),
                           "id", "text", G.gram_filter(one)).collect()
    assert [r.id for r in sent] == [1]
