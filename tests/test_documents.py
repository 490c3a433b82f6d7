import datetime as dt
import re

from pyspark.sql import functions as F

from inkwell.operators import documents as D


def test_latest_document_tie_break(spark):
    t = dt.datetime(2024, 1, 1)
    docs = spark.createDataFrame([("b.txt", t, "X"), ("a.txt", t, "X"), ("c.txt", t - dt.timedelta(1), "X"),
                                  ("z.md", t, "Y")], "name string, mtime timestamp, label string")
    got = {r.label: (r.name, r.n_docs) for r in D.latest_document(docs, by=["label"]).collect()}
    assert got == {"X": ("a.txt", 3), "Y": ("z.md", 1)}
    assert D.latest_document(docs).first().name == "a.txt"


def test_pair_essence_alias_and_fallback(spark):
    labels = spark.createDataFrame([("WMT",), ("LULU",), ("NOPE",)], "label string")
    ess = spark.createDataFrame([("walmart_essence_20260524.txt", 3), ("LULU_essence.md", 1),
                                 ("essence_20260524_macro_split.txt", 5)], "name string, mtime long")
    got = {r.label: (r.essence_name, r.matched) for r in D.pair_essence(labels, ess).collect()}
    assert got == {"WMT": ("walmart_essence_20260524.txt", True), "LULU": ("LULU_essence.md", True),
                   "NOPE": ("essence_20260524_macro_split.txt", False)}


def test_label_keywords(spark):
    df = spark.createDataFrame([("WMT_Q1",), ("walmart",), ("2026_04_PCE",), ("A_B",)], "label string")
    got = [r[0] for r in df.select(D.label_keywords("label")).collect()]
    assert got == [["wmt", "q1", "walmart"], ["walmart", "wmt"], ["2026", "04", "pce"], []]


def test_resolve_input_empty_explicit_counts_as_missing(spark):
    docs = spark.createDataFrame([("WMT_raw.txt", 1, "wmt text"), ("empty.md", 2, ""), ("LULU_raw.md", 3, "lulu")],
                                 "name string, mtime long, content string")
    req = spark.createDataFrame([(1, "WMT_raw.txt"), (2, "empty.md"), (3, None), (4, "missing.txt")],
                                "req_id int, explicit string")
    got = {r.req_id: (r.chosen_source, r.label, r.content) for r in D.resolve_input(req, docs).collect()}
    assert got[1] == ("explicit", "WMT", "wmt text")
    assert got[2] == ("latest", "LULU", "lulu")
    assert got[3] == ("latest", "LULU", "lulu")
    assert got[4] == ("latest", "LULU", "lulu")
    docs2 = spark.createDataFrame([("x.md", 9, "")], "name string, mtime long, content string")
    r = D.resolve_input(req.limit(1), docs2).first()
    assert (r.chosen_source, r.label, r.content) == ("default", D.NO_RAW_LABEL, D.NO_RAW_TEXT)


RESPONSE = """开头\n<CognitiveCard>\n**标题一**\n内容一\n</CognitiveCard>\n\n\n\n中间<CognitiveCard>**标题二**\n内容二</CognitiveCard>\n尾巴<CognitiveCard>未闭合"""


def test_tags_cards_and_clean(spark):
    df = spark.createDataFrame([("CAPE", RESPONSE)], "label string, text string")
    spans = D.extract_tagged(df, "text", keep=["label"]).collect()
    assert [(r.idx, r.body) for r in spans] == [(1, "**标题一**\n内容一"), (2, "**标题二**\n内容二")]
    clean = df.select(D.strip_tagged("text").alias("c")).first().c
    assert clean == "开头\n\n中间\n尾巴<CognitiveCard>未闭合"
    assert df.select(D.tag_leak(D.strip_tagged("text"))).first()[0] is True
    title, text = D.card_fields(F.lit("**标题一**\n内容一\n"))
    assert tuple(spark.range(1).select(title, text).first()) == ("标题一", "内容一")
    doc = df.select(D.card_document_text(F.col("label"), F.lit(dt.datetime(2026, 5, 26, 19, 29, 36)),
                                         D.tagged_spans("text"))).first()[0]
    assert doc.startswith("# 认知提炼自：CAPE\n沉淀时间: 2026-05-26 19:29:36\n\n---\n\n### 💡 硬核认知卡片 1\n**标题一**")
    assert doc.endswith("### 💡 硬核认知卡片 2\n**标题二**\n内容二\n\n---\n\n")
    none = spark.createDataFrame([("X", "no cards")], "label string, text string")
    assert none.select(D.card_document_text("label", F.lit(dt.datetime(2026, 1, 1)), D.tagged_spans("text"))).first()[0] is None


def test_few_shot_incomplete_folder_uses_a_slot(spark):
    files = spark.createDataFrame([
        ("d4", D.DRAFT_NAME, 40, "a4"),                             # newest, no v2: uses a slot
        ("d3", D.DRAFT_NAME, 30, "a3"), ("d3", D.FINAL_NAME, 31, "b3"),
        ("d2", D.DRAFT_NAME, 20, "a2"), ("d2", D.FINAL_NAME, 21, "b2"),
        ("d1", D.DRAFT_NAME, 10, "a1"), ("d1", D.FINAL_NAME, 11, "b1"),
    ], "dir string, name string, mtime long, content string")
    pairs = D.few_shot_pairs(files, 3)
    assert [(r.dir, r.n) for r in pairs.orderBy("n").collect()] == [("d3", 1), ("d2", 2)]
    block = D.few_shot_block(pairs).first()
    assert block.n_pairs == 2
    assert block.few_shot.startswith(D.FEW_SHOT_HEADER + "【修改对照案例 1：d3】\n--- 你的粗糙初稿 (v1_AI.md) ---\na3\n\n")
    empty = D.few_shot_block(D.few_shot_pairs(files.filter("dir = 'd4'"), 3)).first()
    assert (empty.n_pairs, empty.few_shot) == (0, "")


def test_assemble_pages_numbering(spark):
    pages = spark.createDataFrame([(1, 1, "p1"), (1, 2, ""), (1, 3, "p3"), (2, 1, "")],
                                  "doc_id int, page_no int, text string")
    got = {r.doc_id: r for r in D.assemble_pages(pages, block=2).collect()}
    assert got[1].content == "--- 第 1 页 ---\np1\n\n--- 第 3 页 ---\np3\n"
    assert got[1].n_pages == 3
    assert got[2].content == "" and got[2].n_pages == 1


def test_response_parts(spark):
    text = ("1. **抖音/短视频高流量流量包装套餐**\n\n*   **视频封面文字**：瑜伽裤，没护城河了？\n"
            "*   **吸睛发布标题**：Lululemon 利润暴跌？\n*   **5 个高流量精准 Hashtags**：#美股 #宏观经济 #Lululemon #价值投资 #长期主义\n\n"
            "---\n\n2. **视频逐字口播稿**\n\n昨天我去了趟商场。\n\n---\n\n3. **卡片**\n")
    df = spark.createDataFrame([(text,)], "t string")
    p = D.response_parts("t")
    r = df.select(p["cover"], p["title"], p["hashtags"], p["spoken"]).first()
    assert r[0] == "瑜伽裤，没护城河了？"
    assert r[1] == "Lululemon 利润暴跌？"
    assert r[2] == ["美股", "宏观经济", "Lululemon", "价值投资", "长期主义"]
    assert r[3] == "昨天我去了趟商场。"


def test_prompt_and_log(spark):
    df = spark.createDataFrame([("P", "F", "R", "", "raw", "ess", None, "resp")],
                               "p string, f string, r string, fs string, raw string, e string, idea string, resp string")
    r = df.select(D.system_prompt("p", "f", "r").alias("s"), D.user_prompt("fs", "raw", "e", "idea").alias("u")) \
        .select("s", "u", D.sectioned_log("s", "u", F.lit("resp")).alias("log")).first()
    assert "\nP\nF\n" in r.s and "\nR\n" in r.s
    assert "\nraw\n" in r.u and D.DEFAULT_IDEA in r.u
    assert r.log.startswith("=== SYSTEM INSTRUCTION ===\n" + r.s + "\n\n=== USER PROMPT ===\n")
    assert r.log.endswith("=== MODEL RAW RESPONSE ===\nresp\n")


def test_properties_strip_idempotent_and_counts_agree(spark):
    import random
    from inkwell.operators import rules as R
    rnd = random.Random(11)
    pieces = ["<CognitiveCard>", "</CognitiveCard>", "x", "\n", " ", "卡", "　"]
    texts = [("".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 40))),) for _ in range(300)]
    df = spark.createDataFrame(texts, "t string")
    once = D.strip_tagged("t")
    n, _ = R.card_count("t")
    rows = df.select(once.alias("a"), D.strip_tagged(once).alias("b"), F.size(D.tagged_spans("t")).alias("k"),
                     n.alias("n")).collect()
    for r in rows:
        assert r.a == r.b          # cleaning twice changes nothing
        assert r.k == r.n          # extracted spans == counted cards


def test_card_document_grouped_drops_fallback(spark):
    cards = spark.createDataFrame([("L", dt.datetime(2026, 1, 1), 2, "b", False), ("L", dt.datetime(2026, 1, 1), 1, "a", False),
                                   ("M", dt.datetime(2026, 1, 1), 1, "mock", True)],
                                  "label string, run_ts timestamp, idx int, body string, is_fallback boolean")
    got = {r.label: r for r in D.card_document(cards).collect()}
    assert set(got) == {"L"} and got["L"].n_cards == 2
    assert got["L"].content.index("### 💡 硬核认知卡片 1\na") < got["L"].content.index("### 💡 硬核认知卡片 2\nb")


def test_pairing_substring_false_positive_is_kept(spark):
    # Q4: a label token like "2026" matches every file dated 2026 (kept on purpose)
    labels = spark.createDataFrame([("2026_04_PCE_MACRO_DEDUCTION_LOG",)], "label string")
    ess = spark.createDataFrame([("essence_20260524_macro_split.txt", 5), ("walmart_essence_20250101.txt", 9)],
                                "name string, mtime long")
    r = D.pair_essence(labels, ess).first()
    assert (r.essence_name, r.matched) == ("essence_20260524_macro_split.txt", True)


def test_append_attachment_status_and_kind(spark):
    rep = spark.createDataFrame([("A", "report A"), ("B", "report B"), ("C", "report C")], "k string, content string")
    att = spark.createDataFrame([("A", "ok", "pdf text"), ("B", "error", "[解析 PDF 出错：x]"), ("C", "ok", "")],
                                "k string, status string, text string")
    got = {r.k: (r.content, r.attached) for r in D.append_attachment(rep, att, "k", "macro").collect()}
    assert got["A"] == ("report A" + D.ATTACH_MACRO + "pdf text", True)
    assert got["B"] == ("report B", False) and got["C"] == ("report C", False)


def test_newest_of_one_name_is_the_input(spark):
    import datetime as dt
    docs = spark.createDataFrame([("a_raw.txt", dt.datetime(2026, 1, d), f"text {d}") for d in (1, 3, 2)] + [("b_raw.txt", dt.datetime(2026, 2, 1), "")],
                                 "name string, mtime timestamp, content string")
    asked = spark.createDataFrame([(1, "a_raw.txt"), (2, None), (3, "none.txt")], "req_id int, explicit string")
    got = sorted((r.req_id, r.chosen_source, r.content) for r in D.resolve_input(asked, docs, default_text="nothing").collect())
    assert got == [(1, "explicit", "text 3"), (2, "default", "nothing"), (3, "default", "nothing")]


def test_a_whole_table_is_numbered_without_one_task(spark, capsys):
    import pytest
    from pyspark.sql import functions as F

    from inkwell.operators import documents as D
    rows = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("v")).repartition(6)
    out = D.number_rows(rows, [], [F.col("v")], coarse=F.floor(F.col("v") / 100))
    assert out.columns == ["v", "n"] and out.filter("n <> v + 1").count() == 0 and out.count() == 5000
    out.explain()
    assert "SinglePartition" not in capsys.readouterr().out.split("Subqueries")[0].split("Subquery")[0]
    with pytest.raises(ValueError):
        D.number_rows(rows, [], [F.col("v")])


def test_pair_essence_does_not_join_the_files_again(spark):
    """Their newest times come with their names; repeated names count by their newest."""
    lab = spark.createDataFrame([("WMT_X",), ("NONE_1",), ("",)], "label string")
    ess = spark.createDataFrame([("a_wmt.md", 1), ("a_wmt.md", 5), ("b_walmart.md", 4), ("z.md", 9), (None, 2)], "name string, mtime long")
    paired = D.pair_essence(lab, ess)
    got = {r.label: (r.essence_name, r.essence_mtime, r.matched) for r in paired.collect()}
    assert got == {"WMT_X": ("a_wmt.md", 5, True), "NONE_1": ("z.md", 9, False), "": ("z.md", 9, False)}
    joins = [x for x in paired._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x]
    assert joins and not any(re.search(r"name#\d+ = name#", x) for x in joins)
