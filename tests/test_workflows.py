import datetime as dt
import os

from pyspark.sql import functions as F

from inkwell.operators import documents as D

from inkwell.operators import market as M
from inkwell.operators import rules as R
from inkwell.plans import workflows as W
from inkwell.sources import files as S


def _w(path, text, mtime):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    os.utime(path, (mtime, mtime))


def test_company_and_macro_snapshot(spark):
    keys = spark.createDataFrame([("WMT",), ("ZZZ",)], "ticker string")
    live = spark.createDataFrame([("WMT", "Walmart Inc.", "Consumer Defensive", "Discount Stores", "Retail.",
                                   38.0, 33.5, 7.8e11, 0.0285, 0.042, 1.5e10, 6.0e10, 0.7)], M.COMPANY_SCHEMA)
    ref = live.limit(0)
    att = spark.createDataFrame([("WMT", "ok", "--- 第 1 页 ---\npdf\n")], "ticker string, status string, text string")
    rep = {r.ticker: r for r in W.company_snapshot(keys, live, ref, F.lit(dt.datetime(2026, 5, 24, 17, 10, 3)),
                                                  att).collect()}
    assert "市值 (Market Cap): 780.00 B USD" in rep["WMT"].content
    assert rep["WMT"].content.endswith("\n\n=== 附加本地个股企业 PDF 解析内容 ===\n--- 第 1 页 ---\npdf\n")
    assert rep["ZZZ"].record_source == "default" and "企业全称: ZZZ" in rep["ZZZ"].content
    t = dt.datetime(2026, 5, 22, 16)
    prices = spark.createDataFrame([("^TNX", t, 4.45), ("^TNX", t + dt.timedelta(days=1), 4.435),
                                    ("BTC-USD", t + dt.timedelta(days=1), 67250.0)],
                                   "symbol string, ts timestamp, close double")
    quotes = spark.createDataFrame([("^VIX", 12.35, None, 12.64)],
                                   "symbol string, regularMarketPrice double, price double, regularMarketPreviousClose double")
    r = W.macro_snapshot(prices, F.lit(dt.datetime(2026, 5, 24, 17, 7, 57)), quotes=quotes).first()
    assert "(^TNX)\n  最新价格/数值: 4.435%\n  日内涨跌幅: -0.34%\n" in r.content
    assert "(BTC-USD)\n  最新价格/数值: 67250.00\n  日内涨跌幅: 暂无\n" in r.content
    assert "(^VIX)\n  最新价格/数值: 12.35\n  日内涨跌幅: -2.29%\n" in r.content


def test_generation_prompts_and_split(spark, tmp_path):
    base = str(tmp_path)
    _w(f"{base}/raw/WMT_raw_20260524_171003.txt", "wmt numbers", 100)
    _w(f"{base}/raw/LULU_raw.md", "lulu numbers", 200)
    _w(f"{base}/ess/walmart_essence_20260524.txt", "walmart essence", 50)
    _w(f"{base}/ess/LULU_essence.md", "lulu essence", 60)
    _w(f"{base}/hist/A解析_1/{D.DRAFT_NAME}", "draft a", 10)
    _w(f"{base}/hist/A解析_1/{D.FINAL_NAME}", "final a", 11)
    raw = S.scan_documents(spark, f"{base}/raw").select("name", "mtime", "content")
    ess = S.scan_documents(spark, f"{base}/ess").select("name", "mtime", "content")
    hist = S.scan_pairs(spark, f"{base}/hist")
    req = spark.createDataFrame([(1, "WMT_raw_20260524_171003.txt", None, "idea"), (2, None, None, None)],
                                "req_id int, explicit string, explicit_essence string, idea string")
    _w(f"{base}/config/persona.md", "P", 1)
    _w(f"{base}/config/frameworks.md", "F", 1)
    _w(f"{base}/config/Master_Rulebook.md", "R", 1)
    cfg = S.required_documents(spark, f"{base}/config", ["persona.md", "frameworks.md", "Master_Rulebook.md"])
    assert all(r.ok for r in cfg.collect())
    persona, frameworks, rulebook = (cfg.filter(F.col("name") == n).select("content").scalar()
                                     for n in ["persona.md", "frameworks.md", "Master_Rulebook.md"])
    out = {r.req_id: r for r in W.generation_prompts(req, raw, ess, hist, persona, frameworks, rulebook).collect()}
    assert "\nP\nF\n" in out[1].system
    assert (out[1].label, out[1].essence_name) == ("WMT", "walmart_essence_20260524.txt")
    assert (out[2].label, out[2].raw_source, out[2].essence_name) == ("LULU", "latest", "LULU_essence.md")
    assert "wmt numbers" in out[1].prompt and "walmart essence" in out[1].prompt and "draft a" in out[1].prompt
    assert "\nidea\n" in out[1].prompt
    responses = spark.createDataFrame([
        ("WMT", dt.datetime(2026, 5, 24, 21, 0, 40),
         "*   **视频封面文字**：中产在偷偷变穷\n\n---\n\n2. **口播**\n\n正文。\n\n---\n\n<CognitiveCard>\n**卡一**\n内容\n</CognitiveCard>",
         False),
        ("MACRO_SPLIT", dt.datetime(2026, 5, 26, 21, 36, 28), "<CognitiveCard>**mock**\nx</CognitiveCard>", True)],
        "label string, run_ts timestamp, text string, is_fallback boolean")
    parts = W.split_responses(responses)
    assert parts["cards"].count() == 2
    assert [r.label for r in parts["card_documents"].collect()] == ["WMT"]
    s = {r.label: r for r in parts["scripts"].collect()}
    assert s["WMT"].cover == "中产在偷偷变穷" and s["WMT"].cover_ok and s["WMT"].spoken == "正文。"
    assert s["WMT"].n_cards == 1 and not s["WMT"].tag_leak


def test_audit_workflows(spark):
    inp = spark.createDataFrame([("v1", '{"views": 9000, "retention_5s": 0.65}', None), ("v2", None, None)],
                                "video_id string, inline string, file_content string")
    a = {r.video_id: r for r in W.audit_metrics(inp).collect()}
    assert (a["v1"].grade, a["v1"].retention_pct, a["v2"].grade) == ("good", "65.0", "warning")
    scripts = spark.createDataFrame([(1, "毫无疑问，这很好。"), (2, "我去了 3 次 Costco？")], "script_id int, text string")
    card = {r.script_id: r for r in W.script_audit(scripts, R.rules_dim(spark)).collect()}
    assert card[1].no_forbidden is False and card[2].no_forbidden is True
    assert card[2].has_numbers and card[2].asks_questions and card[2].n_passed == 4


def test_script_audit_with_a_large_rule_table(spark):
    rows = [("x", f"词{i:03d}", None, None) for i in range(80)] + [("ai_speak", "毫无疑问", None, None)]
    rules = spark.createDataFrame(rows, R.RULES_SCHEMA)
    scripts = spark.createDataFrame([(1, "毫无疑问，这很好。"), (2, "词007 出现了。"), (3, "干净的句子。")],
                                    "script_id int, text string")
    card = {r.script_id: r.no_forbidden for r in W.script_audit(scripts, rules).collect()}
    assert card == {1: False, 2: False, 3: True}


def test_a_response_without_fallback_flag_keeps_its_cards(spark):
    text = "<CognitiveCard>\n**标题**: a\nbody\n</CognitiveCard>"
    df = spark.createDataFrame([("L", None, text, None), ("M", None, text, True)], "label string, run_ts timestamp, text string, is_fallback boolean")
    assert [r.label for r in W.split_responses(df)["cards"].select("label").distinct().orderBy("label").collect()] == ["L", "M"]
    assert "M" not in [r.label for r in W.split_responses(df)["card_documents"].collect()]


def test_the_archive_feeds_the_next_few_shot_block(spark, tmp_path):
    from inkwell import sinks
    path, at = str(tmp_path / "reports"), lambda d: F.lit(f"2026-05-{d} 10:00:00").cast("timestamp_ntz")
    docs = lambda *rows: spark.createDataFrame(rows, "label string, content string")
    sinks.write_reports(docs(("A", "draft a"), ("B", "draft b")), path, "draft", at(24))
    sinks.write_reports(docs(("A", "final a")), path, "final", at(24))
    sinks.write_reports(docs(("2026", "draft c")), path, "draft", at(25))
    sinks.write_reports(docs(("2026", "final c")), path, "final", at(25))
    sinks.write_reports(docs(("A", "a log")), path, "log", at(25))
    back = sinks.read_reports(spark, path, ["draft", "final"])
    assert back.count() == 5 and sinks.read_reports(spark, path).count() == 6
    files = sinks.archive_files(back)
    assert {(r.dir, r.name) for r in files.collect()} >= {("2026解析_20260525_100000", D.DRAFT_NAME), ("B解析_20260524_100000", D.DRAFT_NAME)}
    pairs = {r.dir: (r.v1, r.v2, r.n) for r in D.few_shot_pairs(files, 3).collect()}
    assert pairs == {"2026解析_20260525_100000": ("draft c", "final c", 1), "A解析_20260524_100000": ("draft a", "final a", 2)}
    assert sinks.archive_files(sinks.read_reports(spark, path, ["log"])).first().dir is None


def test_audit_step_makes_a_prompt_and_a_report_per_video(spark):
    inputs = spark.createDataFrame([("v1", '{"views": 9000, "note": "好"}', None), ("v2", None, None)],
                                   "video_id string, inline string, file_content string")
    t0 = dt.datetime(2026, 5, 24, 10)
    plays = [("v1", v, t0 + dt.timedelta(seconds=s), "end" if s == 40 else "tick") for v in range(4) for s in range(0, 10 * v + 11, 10)]
    playback = spark.createDataFrame(plays, "video_id string, viewer int, ts timestamp_ntz, event_type string")
    out = W.audit_step(inputs, playback, F.lit("2026-05-25 09:00:00").cast("timestamp_ntz"), 10, 10, "1 minute", "end")
    prompts = {r.video_id: r for r in out["prompts"].collect()}
    assert '"note": "好"' in prompts["v1"].prompt and '"views": 9000' in prompts["v1"].prompt and '"views": 12000' in prompts["v2"].prompt
    reports = {r.video_id: r for r in out["reports"].collect()}
    assert reports["v1"].n_findings >= 1 and "opening_loss" in reports["v1"].content and "9000" in reports["v1"].content
    assert reports["v2"].n_findings == 0


def test_response_audit_follows_the_limits_of_the_rule_table(spark):
    card = "<CognitiveCard>\n**a**\nb\n</CognitiveCard>\n"
    good = ("*   **视频封面文字**：中产在偷偷变穷\n*   **5 个 Hashtags**：#m1 #m2 #v1 #v2 #me\n\n---\n\n2. **口播**\n\n我去了 3 次 Costco？\n\n---\n\n" + card * 3)
    rows = [(1, good), (2, good.replace("#me", "")), (3, "毫无疑问，没有部分。" + card + "<CognitiveCard>"), (4, ""), (5, None)]
    responses = spark.createDataFrame(rows, "label int, text string")
    tags = spark.createDataFrame([("m1", "macro"), ("m2", "macro"), ("v1", "vertical"), ("v2", "vertical"), ("me", "identity")], "tag string, tag_class string")
    rules = R.rules_dim(spark)
    card_of = {r.label: r for r in W.response_audit(responses, rules, tags).collect()}
    assert card_of[1].n_passed == 9 and card_of[2].hashtags_ok is False and card_of[2].n_passed == 8
    assert not card_of[3].no_forbidden and not card_of[3].cards_ok and not card_of[3].no_tag_leak and not card_of[3].has_numbers
    assert len(card_of) == 5
    two = rules.withColumn("limit", F.when(F.col("phrase") == "cards", 1).otherwise(F.col("limit")))
    assert {r.label: r.cards_ok for r in W.response_audit(responses, two, tags).collect()}[3] is True


def test_keywords_take_another_alias_table(spark):
    df = spark.createDataFrame([("MSFT_NEWS",), ("WMT",)], "label string")
    own = [r[0] for r in df.select(D.label_keywords("label", [("msft", "microsoft")])).collect()]
    assert own == [["msft", "news", "microsoft"], ["wmt"]]
    assert [r[0] for r in df.select(D.label_keywords("label", [])).collect()] == [["msft", "news"], ["wmt"]]
