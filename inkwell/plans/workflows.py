"""End-to-end compositions of the operators: the Spark form of the three
steps a user of the original scripts runs (SURVEY §3) — snapshot the market
data, build the generation prompts and split the model responses, audit the
results — over whole tables instead of one ticker / file / video per run.

Every function only chains operators; it takes DataFrames and returns
DataFrames, so callers decide where the inputs come from (``sources``) and
where results go (``sinks``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import source_label
from inkwell.operators import audience as A
from inkwell.operators import documents as D
from inkwell.operators import market as M
from inkwell.operators import metrics as X
from inkwell.operators import rules as R


# ------------------------------------------------------------------ snapshot

def company_snapshot(keys: DataFrame, live: DataFrame, reference: DataFrame, run_ts: Column,
                     attachments: DataFrame | None = None) -> DataFrame:
    """Per ticker: the rendered company report (live record, else reference,
    else default), optionally with an attachment appended
    (``attachments``: ticker, status, text).  Output: ticker, is_fallback,
    record_source, content."""
    keep = ["record_source", "is_fallback"]
    rec = M.with_fallback(keys, live, reference, key="ticker")
    rep = M.company_report(M.company_metrics(rec, keep), run_ts, keep)
    if attachments is not None:
        rep = D.append_attachment(rep, attachments, "ticker", "company").drop("attached")
    return rep


def macro_snapshot(prices: DataFrame, run_ts: Column, dim: DataFrame | None = None,
                   quotes: DataFrame | None = None, days: int = 5, tiebreak: str | None = None) -> DataFrame:
    """The macro report from price history (symbol, ts, close): last two
    daily closes inside ``days``, every dimension symbol once in order,
    quote fallback for symbols without closes, formatted stanzas."""
    dim = dim if dim is not None else M.macro_dim(prices.sparkSession)
    keys = dim.select("symbol")
    wanted = prices.join(keys, "symbol", "left_semi")
    # days count back from the newest price of a wanted symbol
    newest = wanted.select(F.to_date(F.max("ts"))).scalar()
    closes = M.last_two_closes(M.daily_closes(M.recent_prices(wanted, days=days), tiebreak=tiebreak), days, as_of=newest)
    if quotes is not None:
        closes = M.quote_fallback(closes, quotes.join(keys, "symbol", "left_semi"))
    rows = M.dim_left_join(dim, closes)
    price, change = M.quote_format(F.col("close_now"), F.col("pct_change"), F.col("is_yield"))
    st = M.macro_stanzas(rows.select("ord", "symbol", "description", price.alias("price_str"),
                                     change.alias("change_str")))
    return M.macro_report(st, run_ts)


# ---------------------------------------------------------------- generation

def generation_prompts(requests: DataFrame, raw_docs: DataFrame, essence_docs: DataFrame,
                       history_files: DataFrame, persona: Column, frameworks: Column, rulebook: Column,
                       k: int = 3) -> DataFrame:
    """Per request (req_id, explicit, explicit_essence, idea): choose the
    raw input and its label, pair the essence, add the few-shot block of the
    newest ``k`` history folders and fill both templates.

    ``raw_docs`` / ``essence_docs``: name, mtime, content;
    ``history_files``: dir, name, mtime, content.  Output: req_id, label,
    raw_source, essence_name, system, prompt."""
    raw = D.resolve_input(requests.select("req_id", "explicit"), raw_docs)
    ess_req = raw.select("req_id", "label").join(
        requests.select("req_id", F.col("explicit_essence").alias("explicit")), "req_id")
    ess = D.resolve_essence(ess_req, essence_docs, keep=["req_id"]).drop("label")
    few = D.few_shot_block(D.few_shot_pairs(history_files, k)).select("few_shot").scalar()
    j = raw.join(ess, "req_id", "left").join(requests.select("req_id", "idea"), "req_id")
    return j.select(
        "req_id", "label", F.col("chosen_source").alias("raw_source"), "essence_name",
        D.system_prompt(persona, frameworks, rulebook).alias("system"),
        D.user_prompt(few, F.col("content"), F.col("essence"), F.col("idea")).alias("prompt"))


def split_responses(responses: DataFrame, drop_fallback: bool = True) -> dict[str, DataFrame]:
    """Model responses (label, run_ts, text[, is_fallback]) → cards (one row
    per card with title/text and the fallback flag), card documents, clean scripts with their
    checks (card count, tag leak, cover, hashtags), and the sectioned log
    when ``system`` / ``prompt`` columns are present.  Fallback responses
    are left out of the card documents by default."""
    has_flag = "is_fallback" in responses.columns
    keep = ["label", "run_ts", *(["is_fallback"] if has_flag else [])]
    cards = D.extract_tagged(responses, "text", keep=keep)
    title, text = D.card_fields(F.col("body"))
    cards = cards.select(*keep, "idx", "body", title.alias("title"), text.alias("card_text"))
    src = responses.filter(~F.coalesce("is_fallback", F.lit(False))) if (has_flag and drop_fallback) else responses
    docs = src.select("label", "run_ts", D.card_document_text(F.col("label"), F.col("run_ts"),
                                                              D.tagged_spans("text")).alias("content")) \
        .filter(F.col("content").isNotNull())
    n, ok = R.card_count("text")
    parts = D.response_parts(D.strip_tagged("text"))
    cover_n, cover_ok = R.cover_length(parts["cover"])
    clean = responses.select(
        "label", "run_ts", D.strip_tagged("text").alias("clean"), n.alias("n_cards"), ok.alias("cards_ok"),
        parts["cover"].alias("cover"), cover_n.alias("cover_len"), cover_ok.alias("cover_ok"),
        parts["title"].alias("title"), parts["hashtags"].alias("hashtags"), parts["spoken"].alias("spoken"))
    clean = clean.withColumn("tag_leak", D.tag_leak("clean"))
    out = {"cards": cards, "card_documents": docs, "scripts": clean}
    if {"system", "prompt"} <= set(responses.columns):
        out["logs"] = responses.select("label", "run_ts",
                                       D.sectioned_log("system", "prompt", "text").alias("content"))
    return out


# --------------------------------------------------------------------- audit

def audit_metrics(metric_inputs: DataFrame, key: str = "video_id") -> DataFrame:
    """Per video: metrics overlaid on the defaults, the overview strings and
    the benchmark grade (``metric_inputs``: key, inline, file_content)."""
    return _overview(X.merge_metrics(metric_inputs, key=key), key)


def _overview(merged: DataFrame, key: str) -> DataFrame:
    grade, red = X.benchmark_grade(F.col("retention_5s"))
    return X.audit_overview(merged.withColumn("grade", grade).withColumn("red", red), key=key,
                            keep=["grade", "red", "retention_5s", "completion_rate"])


def audit_step(metric_inputs: DataFrame, playback: DataFrame, run_ts: Column, bucket_s: int, horizon_s: int,
               gap: str, end_event: str, key: str = "video_id") -> dict[str, DataFrame]:
    """The audit step of many videos at once: stated metrics and playback in, prompts and reports out.

    ``metric_inputs``: key, inline, file_content (a video's stated metrics beat
    the defaults); ``playback``: key, viewer, ts, event_type.  Output:

    * ``prompts``: key, system, prompt (the metrics as JSON);
    * ``reports``: key, n_findings, content: the overview of the merged metrics
      and one finding per stretch of the retention curve, for every video of
      ``metric_inputs`` (without playback: no finding).  ``sinks.write_reports``
      stores them.
    """
    merged = X.merge_metrics(metric_inputs, key=key)
    system, prompt = D.audit_prompt(F.col("metrics_json"))
    prompts = X.metrics_json(merged, key=key).select(key, system.alias("system"), prompt.alias("prompt"))
    curve = A.retention_curve(A.sessions(playback, gap=gap, end_event=end_event, by=[key]), bucket_s, by=[key])
    findings = A.report_findings(A.segment_findings(curve, bucket_s, horizon_s, by=[key]), bucket_s, [key])
    reports = X.audit_report(_overview(merged, key), findings, key, run_ts)
    return {"prompts": prompts, "reports": reports}


def script_audit(scripts: DataFrame, rules: DataFrame, key: str = "script_id", text: str = "text") -> DataFrame:
    """Per script: forbidden-phrase hits, sentence / density / style checks
    as one scorecard row."""
    listed = rules.filter(~F.col("rule_class").isin(*R.NOT_FORBIDDEN)).agg(F.collect_set("phrase")).scalar()
    base = scripts.withColumn("_rules", listed) \
        .withColumn("_hits", F.exists("_rules", lambda p: F.col(text).contains(p)).cast("int")).drop("_rules")
    arr = R.sentence_arrays(base, text)
    ls = R.long_sentences("_s")
    dn = R.info_density(text)
    st = R.style_ratios("_se")
    checks = arr.select(
        key, (F.col("_hits") == 0).alias("no_forbidden"), (ls["n_long"] == 0).alias("short_sentences"),
        (dn["n_numbers"] > 0).alias("has_numbers"),
        F.coalesce(st["question_share"] > 0, F.lit(False)).alias("asks_questions"))
    return R.scorecard_wide(checks, key, ["no_forbidden", "short_sentences", "has_numbers", "asks_questions"])


# The checks of a whole response, in the order of the scorecard.
RESPONSE_CHECKS = ["no_forbidden", "short_sentences", "has_numbers", "asks_questions", "first_person",
                   "cover_ok", "hashtags_ok", "cards_ok", "no_tag_leak"]


def response_audit(responses: DataFrame, rules: DataFrame, tag_dim: DataFrame, key: str = "label", text: str = "text",
                   first_person: str = R.FIRST_PERSON) -> DataFrame:
    """All nine checks of a model response as one scorecard row.

    Phrases are searched in the response without its cards; sentence length,
    numbers, questions and the first person in the spoken part (a response
    without parts has none, so those that need something there fail and no
    sentence is too long).  The numbers to meet are the ``limit`` rows of
    ``rules`` (sentence length, cover length, hashtags, cards); a limit that the
    table does not hold is not checked.  ``tag_dim``: tag, tag_class.
    """
    limits = (rules.filter(F.col("rule_class") == "limit")
              .agg(F.map_from_entries(F.collect_set(F.struct("phrase", "limit")))).scalar())
    listed = rules.filter(~F.col("rule_class").isin(*R.NOT_FORBIDDEN)).agg(F.collect_set("phrase")).scalar()
    met = lambda name, test: F.coalesce(test(F.col("_limits")[name]), F.col("_limits")[name].isNull())
    base = (responses.select(key, F.col(text).alias("_text"), D.strip_tagged(text).alias("_clean"))
            .withColumns({"_limits": limits, "_listed": listed}))
    parts = D.response_parts("_clean")
    base = base.withColumns({"_cover": parts["cover"], "_tags": parts["hashtags"], "_spoken": F.coalesce(parts["spoken"], F.lit(""))})
    arr = R.sentence_arrays(base, "_spoken")
    style, (n_cards, _), (n_cover, _) = R.style_ratios("_se", first_person), R.card_count("_text"), R.cover_length(F.col("_cover"))
    some = lambda share: F.coalesce(share > 0, F.lit(False))
    longest = F.coalesce(F.array_max(F.transform("_s", lambda s: F.length(s))), F.lit(0))
    checks = arr.select(
        key, (~F.exists("_listed", lambda p: F.col("_clean").contains(p))).alias("no_forbidden"),
        met("max_sentence_chars", lambda n: longest <= n).alias("short_sentences"),
        (R.info_density("_spoken")["n_numbers"] > 0).alias("has_numbers"),
        some(style["question_share"]).alias("asks_questions"), some(style["first_person_share"]).alias("first_person"),
        (met("cover_min_chars", lambda n: n_cover >= n) & met("cover_max_chars", lambda n: n_cover <= n)).alias("cover_ok"),
        met("hashtags", lambda n: F.size("_tags") == n).alias("_count_ok"),
        met("cards", lambda n: n_cards == n).alias("cards_ok"), (~D.tag_leak("_clean")).alias("no_tag_leak"))
    matrix = R.hashtag_matrix(base.select(key, "_tags").withColumnRenamed("_tags", "tags"), key, tag_dim)
    ordered = matrix.select(F.col(key).alias("_key"), F.col("order_ok").alias("_order_ok"))
    joined = checks.join(ordered, checks[key] == F.col("_key"), "left").withColumn("hashtags_ok", F.col("_count_ok") & F.col("_order_ok"))
    return R.scorecard_wide(joined, key, RESPONSE_CHECKS)


def label_of(name: Column) -> Column:
    """Topic label of a file name (re-exported for callers of the workflows)."""
    return source_label(name)
