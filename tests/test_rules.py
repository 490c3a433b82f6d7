import random

import pytest
from pyspark.sql import functions as F

from inkwell.operators import rules as R


def _texts(n=200, seed=7):
    rnd = random.Random(seed)
    alphabet = ["aa", "a", "b", "毫无疑问", "其实", " ", "。", "？", "那么"]
    return [(i, "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60)))) for i in range(n)]


def test_phrase_hits_paths_agree_with_str_count(spark):
    texts = _texts()
    rules = spark.createDataFrame([("x", "aa", None, None), ("x", "aaa", None, None), ("ai_speak", "毫无疑问", "alt", None),
                                   ("filler", "其实", None, None)], R.RULES_SCHEMA)
    df = spark.createDataFrame(texts, "script_id int, text string")
    # fillers are deleted, not forbidden
    expect = {(i, p): t.count(p) for i, t in texts for p in ["aa", "aaa", "毫无疑问"] if t.count(p) > 0}
    got = {(r.script_id, r.phrase): r.n for r in R.phrase_hits(df, rules).collect()}
    assert got == expect


def test_rules_dim_and_suggestions(spark):
    rules = R.rules_dim(spark)
    assert rules.filter("rule_class = 'limit' and phrase = 'max_sentence_chars'").first().limit == 25
    df = spark.createDataFrame([(1, "毫无疑问，这是双刃剑。众所周知。")], "script_id int, text string")
    hits = R.phrase_hits(df, rules)
    s = {r.phrase: r.suggestions for r in R.phrase_suggestions(hits, rules).collect()}
    assert set(s) == {"毫无疑问", "双刃剑", "众所周知"}
    assert "说句人话" not in s["毫无疑问"] and "大家可以看一下这组数据：..." in s["毫无疑问"]


def test_fillers_sentences_density_style(spark):
    df = spark.createDataFrame([("那么我们其实要看，也就是说数据。这是一个非常非常非常非常非常非常非常非常非常长的句子，超过二十五个字符了吧！价格 1.5 美元？我去了 3 次。",)],
                               "text string")
    text, n = R.strip_fillers("text")
    r = df.select(text, n).first()
    assert r[1] == 3 and "其实" not in r[0] and "也就是说" not in r[0]
    ls = R.long_sentences("text", 25)
    r = df.select(ls["n_sent"], ls["n_long"]).first()
    assert r[0] == 5 and r[1] == 1
    dn = R.info_density("text")
    assert df.select(dn["n_numbers"]).first()[0] == 2
    st = R.style_ratios("text")
    r = df.select(st["n_sent"], st["question_share"], st["first_person_share"]).first()
    assert r[0] == 5 and abs(r[1] - 0.2) < 1e-12 and abs(r[2] - 0.4) < 1e-12


def test_cover_length(spark):
    df = spark.createDataFrame([("中产在偷偷变穷",), ("Costco悄悄降级",), ("瑜伽裤，没护城河了？",)], "c string")
    n, ok = R.cover_length(F.col("c"))
    assert [tuple(r) for r in df.select(n, ok).collect()] == [(7, True), (10, False), (8, True)]


def test_hashtag_matrix(spark):
    tags = spark.createDataFrame([(1, ["美股", "宏观经济", "价值投资", "沃尔玛", "长期主义"]),
                                  (2, ["美股", "价值投资", "宏观经济", "沃尔玛", "长期主义"]), (3, [])], "id int, tags array<string>")
    dim = spark.createDataFrame([("美股", "macro"), ("宏观经济", "macro"), ("价值投资", "vertical"), ("沃尔玛", "vertical"),
                                 ("长期主义", "identity")], "tag string, tag_class string")
    got = {r.id: (r.n_tags, r.ok) for r in R.hashtag_matrix(tags, "id", dim).collect()}
    assert got == {1: (5, True), 2: (5, False), 3: (0, False)}


def test_scorecard_and_feedback(spark):
    checks = spark.createDataFrame([(1, "a", True), (1, "b", False), (2, "a", True)], "k int, check string, passed boolean")
    got = {r.k: (r.a, r.b, r.n_passed) for r in R.scorecard(checks, "k", ["a", "b"]).collect()}
    assert got == {1: (True, False, 1), 2: (True, False, 1)}
    hits = spark.createDataFrame([(1, "c", "x", 3), (2, "c", "x", 1), (1, "c", "y", 9)],
                                 "script_id int, rule_class string, phrase string, n long")
    top = [r.phrase for r in R.recurring_phrases(hits, k=2).collect()]
    assert top == ["x", "y"]


def test_sentence_arrays_split_form_equals_split_sentences(spark):
    from inkwell.functions.text import split_sentences
    rnd = random.Random(13)
    alphabet = ["a", "b", " ", "。", "！", "？", "!", "?", ".", "\n", "　", "中"]
    texts = [(i, "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 50)))) for i in range(400)]
    df = spark.createDataFrame(texts, "id int, text string")
    rows = R.sentence_arrays(df).select("_s", split_sentences("text").alias("ref")).collect()
    for r in rows:
        assert r["_s"] == r["ref"]


def test_frequent_phrases_equal_a_brute_force_miner(spark):
    import re
    from collections import Counter, defaultdict

    import regex

    from inkwell.operators import rules as R
    from tests.conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").selectExpr("doc_id as script_id", "text")
    hits, scripts = Counter(), defaultdict(set)
    for r in docs.collect():
        for sentence in re.findall(r"[^。！？!?.\n]+", (r.text or "").lower()):
            w = regex.findall(r"[^ \t\n\x0b\f\r\p{P}]+", sentence)
            for n in range(1, 5):
                for i in range(len(w) - n + 1):
                    p = tuple(w[i:i + n])
                    hits[p] += 1
                    scripts[p].add(r.script_id)
    frequent = {p: (len(scripts[p]), hits[p]) for p in hits if len(scripts[p]) >= 4}
    held = {(q, c) for p, c in frequent.items() if len(p) > 1 for q in (p[1:], p[:-1])}
    want = {(" ".join(p), len(p), *c) for p, c in frequent.items() if (p, c) not in held}
    got = {tuple(x) for x in R.frequent_phrases(docs, min_scripts=4).collect()}
    assert len(want) > 100 and (sorted(got - want)[:8], sorted(want - got)[:8]) == ([], [])
    assert R.frequent_phrases(docs.limit(0)).count() == 0


def _brute_phrases(rows, min_scripts, max_words):
    """rows: (key, text) → the closed phrases, counted by hand."""
    import re
    from collections import Counter, defaultdict
    hits, scripts = Counter(), defaultdict(set)
    for (key, text), copies in Counter(rows).items():      # a text that comes again under its key: words count again
        for sentence in re.findall(r"[^。！？!?.\n]+", (text or "").lower()):
            w = re.findall(r"[a-z]+", sentence)
            for n in range(1, max_words + 1):
                for i in range(len(w) - n + 1):
                    hits[tuple(w[i:i + n])] += copies if n == 1 else 1
                    scripts[tuple(w[i:i + n])].add(key)
    frequent = {p: (len(scripts[p]), hits[p]) for p in hits if len(scripts[p]) >= min_scripts}
    held = {(q, c) for p, c in frequent.items() if len(p) > 1 for q in (p[1:], p[:-1])}
    return {(" ".join(p), len(p), *c) for p, c in frequent.items() if (p, c) not in held}


def _made_scripts(n):
    import random
    rng = random.Random(11)
    words = ["ab", "cd", "ef", "gh", "ij", "kl", "mn", "op"]
    texts = [" ".join(rng.choices(words, range(8, 0, -1), k=rng.randint(0, 30))).replace("op", "op.").replace("mn ef", "mn\nef") for _ in range(n)]
    # keys come again with other texts and with the same, some are null
    return [(None if i % 17 == 0 else i % (n - 9), t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, texts[3]), (900, None), (901, "")]


@pytest.mark.parametrize("chunk_words", [40, 1_000_000])
def test_frequent_phrases_with_repeated_and_null_keys(spark, monkeypatch, chunk_words):
    monkeypatch.setattr(R, "CHUNK_WORDS", chunk_words)
    rows = _made_scripts(80)
    df = spark.createDataFrame(rows, "script_id long, text string").repartition(3)
    got = {tuple(r) for r in R.frequent_phrases(df, min_scripts=4, max_words=3).collect()}
    assert got == _brute_phrases(rows, 4, 3) and len(got) > 50
    # another pattern of words goes the other way of cutting sentences
    assert {tuple(r) for r in R.frequent_phrases(df, min_scripts=4, max_words=3, token="[a-z]+").collect()} == got


def test_frequent_phrases_shuffle_counts_and_no_words(spark, tmp_path):
    """What goes between tasks is one row per phrase and task, not one per word."""
    df = spark.createDataFrame([(i, "the same few words again and again. " * 200) for i in range(40)], "script_id long, text string").repartition(2)
    assert "Window" not in R.frequent_phrases(df)._jdf.queryExecution().toString()
    words = R._script_words(df, "script_id", "text", R.TOKEN)
    counts = words.mapInArrow(R._count_grams((1, 2, 3, 4), {}, frozenset(R.SENTENCE_BREAKS)), R._GRAM_COUNTS)
    assert counts.count() <= 2 * 30 and counts.agg({"hits": "sum"}).first()[0] == 40 * 200 * (7 + 6 + 5 + 4)


@pytest.mark.parametrize("k", [1, 12, 500])
def test_rulebook_feedback_loses_nothing_to_its_bound(spark, k):
    rows = _made_scripts(60)
    listed = ["ab cd", " CD ab ", "ab", "ab ab cd"]
    df = spark.createDataFrame(rows, "script_id long, text string")
    rules = spark.createDataFrame([("x", p, None, None) for p in listed], R.RULES_SCHEMA)
    want = sorted((p for p in _brute_phrases(rows, 3, 4) if p[1] > 1 and p[0] not in {x.strip().lower() for x in listed}),
                  key=lambda p: (-p[2], -p[3], p[0]))[:k]
    assert [tuple(r) for r in R.rulebook_feedback(df, rules, k=k, min_scripts=3).collect()] == want
    if k == 1:
        assert R.scripts_of_the_best(df, 9, min_scripts=3) > 3
