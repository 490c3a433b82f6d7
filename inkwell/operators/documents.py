"""Document operators: labels, newest-per-topic, essence pairing, input
resolution, tagged spans and cards, draft/final pairs, page assembly,
prompt assembly and sectioned logs.

Documents are rows ``(name, mtime, content, ...)``; the reference's folders
become columns.  Nothing here walks a folder on the driver.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.operators.grams import meeting
from inkwell.functions.text import epoch_micros, source_label, squeeze_newlines, ustrip

# ---------------------------------------------------------------- fixed values
NO_ESSENCE_NAME = "无"
NO_RAW_TEXT = "[无最新输入原材料：系统将仅依靠你的想法 and 你的讨论精髓直接对撞生成]"
NO_RAW_LABEL = "RAW_THOUGHT"
NO_ESSENCE_TEXT = "[无最新的对撞精髓：系统将仅基于原始数据和你的实时想法进行生成]"
NO_ESSENCE_FILE = "无对撞精髓"
DEFAULT_IDEA = "请将上面的核心精髓与原始财务数据进行深度对撞，帮我写出一份有极高第一视角故事张力和长期防守认知的爆款口播稿。"
# Keyword aliases of the essence pairing, by priority: a label containing
# the first word gets the second word added; only the first hit counts.
KEYWORD_ALIASES = [("wmt", "walmart"), ("walmart", "wmt")]
# Draft / final file names inside a history folder.
DRAFT_NAME = "v1_AI.md"
FINAL_NAME = "v2_Ryan.md"
FEW_SHOT_HEADER = (
    "\n===【语感强化对比学习：以下是博主最近 3 次的初稿(V1)与最终人工精修终稿(V2)的修改对照】===\n"
    "【请仔细揣摩：博主是如何大刀阔斧地删减AI虚浮废话、把句子改得极度短小口语化、以及增强真实美国生活/物理体感的】\n\n"
)
FEW_SHOT_CASE = "【修改对照案例 {n}：{dir}】\n"
FEW_SHOT_V1 = "--- 你的粗糙初稿 (v1_AI.md) ---\n"
FEW_SHOT_V2 = "--- 我的发布终稿 (v2_Ryan.md) ---\n"
RULE_72 = "=" * 72
CARD_TAG = "CognitiveCard"
CARD_HEADER = "# 认知提炼自："
CARD_TIME = "沉淀时间: "
CARD_TITLE = "### 💡 硬核认知卡片 "
PAGE_HEADER = "--- 第 {n} 页 ---\n"
ATTACH_COMPANY = "\n\n=== 附加本地个股企业 PDF 解析内容 ===\n"
ATTACH_MACRO = "\n\n=== 附加本地 PDF 解析内容 ===\n"
LOG_SYSTEM = "=== SYSTEM INSTRUCTION ===\n"
LOG_PROMPT = "=== USER PROMPT ===\n"
LOG_RESPONSE = "=== MODEL RAW RESPONSE ===\n"
# Labelled packaging lines of a model response.
COVER_LINE = "视频封面文字"
TITLE_LINE = "吸睛发布标题"
HASHTAG_LINE = "Hashtags"
# -----------------------------------------------------------------------------

_TEMPLATES = os.path.join(os.path.dirname(__file__), "templates")


def _template(name: str) -> str:
    with open(os.path.join(_TEMPLATES, name), encoding="utf-8") as f:
        return f.read()


SYSTEM_TEMPLATE = _template("system_prompt.txt")
USER_TEMPLATE = _template("user_prompt.txt")
AUDIT_SYSTEM_TEMPLATE = _template("audit_system_prompt.txt")
AUDIT_USER_TEMPLATE = _template("audit_user_prompt.txt")


def template_parts(template: str) -> list[str]:
    """Split ``a{x}b{y}c`` into ['a', 'x', 'b', 'y', 'c']."""
    return re.split(r"\{([a-z_]+)\}", template)


def fill_template(template: str, values: dict) -> Column:
    """Fill ``{name}`` slots with columns; one ``concat`` in codegen."""
    parts = template_parts(template)
    cols = []
    for i, p in enumerate(parts):
        if i % 2 == 0:
            if p:
                cols.append(F.lit(p))
        else:
            cols.append(values[p])
    return F.concat(*cols)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _desc_key(df: DataFrame, col: str) -> Column:
    """A column that sorts ascending in the order ``col`` sorts descending."""
    dt = df.schema[col].dataType
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return -epoch_micros(col, dt)
    if isinstance(dt, T.DateType):
        return -F.unix_date(F.col(col))
    return -F.col(col)


# ------------------------------------------------------------------- W-1 / W-4

def latest_document(docs: DataFrame, by: list[str] | None = None,
                    mtime: str = "mtime", name: str = "name") -> DataFrame:
    """Newest document (mtime desc, name asc); per ``by`` group when given.

    Grouped form is one ``min_by`` aggregate: partial aggregation keeps a
    single candidate per group and map partition, so a topic holding a third
    of the files is reduced before the shuffle.  Output adds ``n_docs``.
    """
    if not by:
        return docs.orderBy(F.col(mtime).desc(), F.col(name).asc()).limit(1)
    rest = [c for c in docs.columns if c not in by]
    best = F.min_by(F.struct(*rest), F.struct(_desc_key(docs, mtime), F.col(name)))
    out = docs.groupBy(*by).agg(best.alias("_b"), F.count(F.lit(1)).alias("n_docs"))
    return out.select(*by, *[F.col("_b")[c].alias(c) for c in rest], "n_docs")


def number_rows(df: DataFrame, key: list[str], order: list[Column], name: str = "n", coarse: Column | None = None) -> DataFrame:
    """1-based ordinals inside ``key`` by ``order``.

    Over a whole table (no key) ``coarse`` is needed, a value that never falls along
    the order (the day of a timestamp, say): rows are numbered inside each coarse
    value and begin after the count of all lower ones.  The counts, one number per
    coarse value, are one array; the rows are never in one task.
    """
    if key:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    if coarse is None:
        raise ValueError("numbering a whole table needs a coarse value of its order")
    dealt = df.withColumn("_coarse", coarse)
    counts = (dealt.groupBy("_coarse").agg(F.count(F.lit(1)).alias("n")).agg(F.collect_list(F.struct("_coarse", "n"))).scalar())
    own, dealt = F.col("_coarse"), dealt.withColumn("_counts", counts)
    lower = F.filter("_counts", lambda c: F.when(own.isNull(), F.lit(False)).otherwise(c["_coarse"].isNull() | (c["_coarse"] < own)))
    before = F.aggregate(lower, F.lit(0).cast("long"), lambda s, c: s + c["n"])
    ranked = dealt.withColumn(name, F.row_number().over(Window.partitionBy("_coarse").orderBy(*order)) + before)
    return ranked.drop("_coarse", "_counts")


# ------------------------------------------------------------------- P-6 / J-1

def label_keywords(label, aliases: list[tuple[str, str]] = KEYWORD_ALIASES) -> Column:
    """Keywords of a label: its ``_`` parts longer than one character, plus
    the first matching alias.  ``aliases``: (word, added word) by priority."""
    low = F.lower(_c(label))
    kws = F.filter(F.split(low, "_"), lambda x: F.length(x) > 1)
    alias = None
    for needle, extra in reversed(aliases):
        alias = F.when(low.contains(needle), F.lit(extra)).otherwise(alias if alias is not None else F.lit(None))
    return kws if alias is None else F.when(alias.isNull(), kws).otherwise(F.concat(kws, F.array(alias)))


def _substring_matches(names: DataFrame, kw: DataFrame) -> DataFrame:
    """(name, ..., kw) for every keyword that occurs in the lower-cased name.

    Names and keywords meet on a gram of two characters (every keyword has two at
    least) and are then verified, so what is shuffled follows the names' lengths and
    not the length of the longest keyword.  The columns of ``names`` stay beside them.
    """
    met = meeting(names, F.lower("name"), kw, "kw", widths=(2,))
    return met.filter(F.lower("name").contains(F.col("kw"))).select(*names.columns, "kw")


def pair_essence(labels: DataFrame, essences: DataFrame, aliases: list[tuple[str, str]] = KEYWORD_ALIASES) -> DataFrame:
    """Pair each label with an essence document (substring theta join).

    A label matches an essence when any of its keywords occurs in the
    lower-cased essence file name; the newest match wins (mtime desc, name
    asc), else the newest essence overall, else the placeholder name.

    The match is an equi-join on two-character grams of names and keywords.
    """
    lab = labels.select("label").distinct()
    lk = lab.select("label", F.explode(F.array_distinct(label_keywords("label", aliases))).alias("kw"))
    kw = lk.select("kw").distinct()
    ess = essences.select("name", "mtime")
    order = F.struct(_desc_key(ess, "mtime"), F.col("name"))
    # the newest time of each name travels with the name: a join back to the files would
    # broadcast all of them, because compressed they look small to the planner
    times = ess.groupBy("name").agg(F.min_by("mtime", F.struct(_desc_key(ess, "mtime"))).alias("mtime"))
    hits = _substring_matches(times, kw)
    # newest match per keyword first (partial aggregate), then per label over
    # its keywords: a keyword that matches a large share of the files (a
    # year, say) never pairs every such file with every label holding it
    per_kw = hits.groupBy("kw").agg(F.min_by(F.struct("name", "mtime"), order).alias("k"))
    cand = lk.join(per_kw, "kw").select("label", F.col("k.name").alias("name"), F.col("k.mtime").alias("mtime"))
    best = cand.groupBy("label").agg(
        F.min_by(F.struct("name", "mtime"), F.struct(_desc_key(ess, "mtime"), F.col("name"))).alias("b"))
    newest = ess.orderBy(F.col("mtime").desc(), F.col("name").asc()).limit(1)
    newest_name = newest.select("name").scalar()
    newest_mtime = newest.select("mtime").scalar()
    j = lab.join(best, "label", "left")
    return j.select(
        "label",
        F.coalesce(F.col("b.name"), newest_name, F.lit(NO_ESSENCE_NAME)).alias("essence_name"),
        F.coalesce(F.col("b.mtime"), newest_mtime).alias("essence_mtime"),
        F.col("b.name").isNotNull().alias("matched"),
    )


# ------------------------------------------------------------------------ F-3

def _asked(docs: DataFrame, requests: DataFrame) -> DataFrame:
    """(x_name, x_content) of the explicitly named documents, the newest of
    each name; the texts of the others do not travel."""
    names = requests.select(F.col("explicit").alias("name")).distinct()
    return docs.join(names, "name", "left_semi").groupBy(F.col("name").alias("x_name")).agg(
        F.max_by("content", F.struct("mtime", "content")).alias("x_content"))


def resolve_input(requests: DataFrame, docs: DataFrame, default_text: str = NO_RAW_TEXT,
                  default_label: str = NO_RAW_LABEL) -> DataFrame:
    """Choose the input of every request: the explicitly named document if
    it exists and is non-empty, else the newest document overall if
    non-empty, else the default text.  The label follows the chosen source.

    ``requests``: req_id, explicit (name or NULL); ``docs``: name, mtime,
    content; of several documents of one name the newest counts.  Output:
    req_id, chosen_source, chosen_name, label, content.
    """
    j = requests.join(_asked(docs, requests), F.col("explicit") == F.col("x_name"), "left")
    newest = docs.orderBy(F.col("mtime").desc(), F.col("name").asc()).limit(1).select(F.struct("name", "content")).scalar()
    n_name, n_content = newest.getField("name"), newest.getField("content")
    explicit_ok = F.nullif(F.col("x_content"), F.lit("")).isNotNull()
    latest_ok = F.nullif(n_content, F.lit("")).isNotNull()
    src = F.when(explicit_ok, F.lit("explicit")).when(latest_ok, F.lit("latest")).otherwise(F.lit("default"))
    return j.select(
        "req_id",
        src.alias("chosen_source"),
        F.when(explicit_ok, F.col("x_name")).when(latest_ok, n_name).alias("chosen_name"),
        F.when(explicit_ok, source_label(F.col("x_name"))).when(latest_ok, source_label(n_name))
         .otherwise(F.lit(default_label)).alias("label"),
        F.when(explicit_ok, F.col("x_content")).when(latest_ok, n_content)
         .otherwise(F.lit(default_text)).alias("content"),
    )


def resolve_essence(requests: DataFrame, essences: DataFrame,
                    keep: list[str] | None = None) -> DataFrame:
    """Essence side of the input chain, per request (label, explicit):
    the explicitly named essence if it exists and is non-empty, else the
    paired essence of the label (J-1: newest match, else newest overall),
    else the fixed placeholder text.  Output: keep..., label,
    essence_source, essence_name, essence."""
    pairing = pair_essence(requests.select("label"), essences.select("name", "mtime"))
    order = F.struct("mtime", "content")
    # labels without a match share one essence: its text is one value and meets no join
    newest = essences.orderBy(F.col("mtime").desc(), F.col("name").asc()).limit(1).select("name").scalar()
    newest_content = essences.filter(F.col("name") == newest).agg(F.max_by("content", order)).scalar()
    # the others: one text per name that a label matched, reduced before any label sees it
    named = pairing.filter("matched").select(F.col("essence_name").alias("name")).distinct()
    texts = (essences.join(named, "name", "left_semi").groupBy(F.col("name").alias("p_name"))
             .agg(F.max_by("content", order).alias("p_text")))
    j = (requests.join(_asked(essences, requests), F.col("explicit") == F.col("x_name"), "left").join(pairing, "label", "left")
         .join(texts, F.col("matched") & (F.col("essence_name") == F.col("p_name")), "left")
         .withColumn("p_content", F.when(F.col("matched"), F.col("p_text")).otherwise(newest_content)))
    explicit_ok = F.nullif(F.col("x_content"), F.lit("")).isNotNull()
    paired_ok = F.nullif(F.col("p_content"), F.lit("")).isNotNull()
    return j.select(
        *(keep or []), "label",
        F.when(explicit_ok, F.lit("explicit")).when(paired_ok, F.lit("paired")).otherwise(F.lit("default"))
         .alias("essence_source"),
        F.when(explicit_ok, F.col("x_name")).when(paired_ok, F.col("essence_name"))
         .otherwise(F.lit(NO_ESSENCE_FILE)).alias("essence_name"),
        F.when(explicit_ok, F.col("x_content")).when(paired_ok, F.col("p_content"))
         .otherwise(F.lit(NO_ESSENCE_TEXT)).alias("essence"))


# ------------------------------------------------------------ P-7 / P-8 / P-9

def tag_pattern(tag: str, capture: bool = True) -> str:
    t = re.escape(tag)
    return f"(?s)<{t}>(.*?)</{t}>" if capture else f"(?s)<{t}>.*?</{t}>"


def tagged_spans(text, tag: str = CARD_TAG) -> Column:
    """Array of the stripped bodies of all ``<tag>…</tag>`` spans, in order."""
    return F.transform(F.regexp_extract_all(_c(text), F.lit(tag_pattern(tag)), 1), lambda x: ustrip(x))


def extract_tagged(df: DataFrame, text: str, tag: str = CARD_TAG, keep: list[str] | None = None) -> DataFrame:
    """One row per tagged span: keep-columns, idx (1-based), body."""
    keep = keep or []
    return df.select(*keep, F.posexplode(tagged_spans(text, tag)).alias("pos", "body")) \
        .select(*keep, (F.col("pos") + 1).alias("idx"), "body")


def strip_tagged(text, tag: str = CARD_TAG) -> Column:
    """Remove closed spans, strip, squeeze 3+ newlines (in that order)."""
    removed = F.regexp_replace(_c(text), tag_pattern(tag, capture=False), "")
    return squeeze_newlines(ustrip(removed))


def tag_leak(clean, tag: str = CARD_TAG) -> Column:
    """True when a (necessarily unclosed) tag survived in the clean text."""
    return _c(clean).contains(f"<{tag}>") | _c(clean).contains(f"</{tag}>")


def card_fields(body) -> tuple[Column, Column]:
    """(title, text): the first ``**…**`` is the title, text is everything
    after the first line, stripped."""
    title = F.regexp_extract(_c(body), r"\*\*(.*?)\*\*", 1)
    rest = F.regexp_extract(_c(body), r"(?s)^[^\n]*\n(.*)$", 1)
    return title, ustrip(rest)


def card_document_text(label, run_ts, cards) -> Column:
    """Card file content from an ordered array of card bodies; NULL when
    there is no card (no file is written)."""
    items = F.transform(_c(cards), lambda x, i: F.concat(
        F.lit(CARD_TITLE), (i + 1).cast("string"), F.lit("\n"), x, F.lit("\n\n---\n\n")))
    content = F.concat(
        F.lit(CARD_HEADER), _c(label), F.lit("\n"),
        F.lit(CARD_TIME), F.date_format(_c(run_ts), "yyyy-MM-dd HH:mm:ss"), F.lit("\n\n"),
        F.lit("---\n\n"), F.array_join(items, ""))
    return F.when(F.size(_c(cards)) > 0, content)


def card_document(cards: DataFrame, by: list[str] = ("label", "run_ts"), drop_fallback: bool = True) -> DataFrame:
    """Grouped form over a card table (by..., idx, body[, is_fallback]): one
    document per group with n_cards; cards from fallback output are left
    out unless ``drop_fallback`` is False."""
    by = list(by)
    if drop_fallback and "is_fallback" in cards.columns:
        cards = cards.filter(~F.coalesce(F.col("is_fallback"), F.lit(False)))
    arr = F.transform(F.sort_array(F.collect_list(F.struct("idx", "body"))), lambda x: x["body"])
    g = cards.groupBy(*by).agg(arr.alias("cards"))
    return g.select(*by, F.size("cards").alias("n_cards"),
                    card_document_text(F.col(by[0]), F.col(by[1]), F.col("cards")).alias("content"))


def response_parts(text) -> dict[str, Column]:
    """Packaging lines and spoken script of a three-part model response."""
    t = _c(text)
    line = lambda key: ustrip(F.regexp_extract(t, re.escape(key) + r"[^\n]*?[：:]([^\n]*)", 1))
    tags_line = F.regexp_extract(t, re.escape(HASHTAG_LINE) + r"[^\n]*?[：:]([^\n]*)", 1)
    sections = F.split(t, r"\n-{3,}[ \t]*(\n|\z)")
    spoken = ustrip(F.regexp_replace(ustrip(F.element_at(sections, 2)), r"^[0-9]+\.[^\n]*\n", ""))
    return {
        "cover": line(COVER_LINE),
        "title": line(TITLE_LINE),
        "hashtags": F.regexp_extract_all(tags_line, F.lit(r"#([^\s#]+)"), 1),
        "spoken": F.when(F.size(sections) >= 2, spoken),
    }


# ------------------------------------------------------------ W-2 / J-2 / A-3

def latest_k_groups(files: DataFrame, k: int = 3, group: str = "dir", mtime: str = "mtime") -> DataFrame:
    """The newest ``k`` groups by their newest file (TakeOrderedAndProject)."""
    g = files.groupBy(group).agg(F.max(mtime).alias("group_mtime"))
    return g.orderBy(F.col("group_mtime").desc(), F.col(group).asc()).limit(k) \
        .withColumn("rank", F.row_number().over(Window.orderBy(F.col("group_mtime").desc(), F.col(group))))


def pair_versions(files: DataFrame, group: str = "dir") -> DataFrame:
    """Draft and final of the folders that have both: (dir, v1, v2), in one
    scan and one group-by."""
    version = lambda name: F.max(F.when(F.col("name") == name, F.col("content")))
    return (files.filter(F.col("name").isin(DRAFT_NAME, FINAL_NAME) & F.col(group).isNotNull()).groupBy(group)
            .agg(version(DRAFT_NAME).alias("v1"), version(FINAL_NAME).alias("v2")).filter("v1 is not null and v2 is not null"))


def few_shot_pairs(files: DataFrame, k: int = 3, group: str = "dir") -> DataFrame:
    """Rank the newest ``k`` folders first, then keep complete pairs and
    number them in newest-first order (an incomplete folder uses a slot)."""
    top = latest_k_groups(files, k, group)
    # only the k chosen folders are paired (a k-row broadcast semi join)
    chosen = files.join(F.broadcast(top.select(group)), group, "left_semi")
    kept = top.join(pair_versions(chosen, group), group, "inner")
    return number_rows(kept, [], [F.col("rank")], "n", coarse=F.col("rank").cast("int"))


def few_shot_block(pairs: DataFrame, group: str = "dir") -> DataFrame:
    """The few-shot text of numbered pairs; empty string when none."""
    block = F.concat(
        F.lit("【修改对照案例 "), F.col("n").cast("string"), F.lit("："), F.col(group).cast("string"),
        F.lit("】\n"), F.lit(FEW_SHOT_V1), F.col("v1"), F.lit("\n\n"),
        F.lit(FEW_SHOT_V2), F.col("v2"), F.lit("\n"), F.lit(RULE_72 + "\n\n"))
    parts = F.transform(F.sort_array(F.collect_list(F.struct(F.col("n"), block.alias("b")))), lambda x: x["b"])
    agg = pairs.agg(F.count(F.lit(1)).alias("n_pairs"), F.array_join(parts, "").alias("body"))
    return agg.select("n_pairs", F.when(F.col("n_pairs") > 0, F.concat(F.lit(FEW_SHOT_HEADER), F.col("body")))
                      .otherwise(F.lit("")).alias("few_shot"))


# ------------------------------------------------------------ A-1 / F-1 / K-2

def assemble_pages(pages: DataFrame, doc: str = "doc_id", page_no: str = "page_no",
                   text: str = "text", block: int = 256) -> DataFrame:
    """Ordered page texts under ``--- 第 N 页 ---`` headers, empty pages
    skipped but counted; output (doc, content, n_pages, n_chars).

    Two levels: pages are first stitched in blocks of ``block`` consecutive
    pages in parallel, then a document joins its few block strings, so a
    very long document is not gathered page by page in one task.
    """
    piece = F.when(F.length(F.col(text)) > 0, F.concat(
        F.lit("--- 第 "), F.col(page_no).cast("string"), F.lit(" 页 ---\n"), F.col(text), F.lit("\n")))
    p = pages.select(doc, page_no, piece.alias("piece"),
                     F.floor(F.col(page_no) / block).alias("blk"))
    lvl1 = p.groupBy(doc, "blk").agg(
        F.count(F.lit(1)).alias("n"),
        F.array_join(F.transform(F.filter(F.sort_array(F.collect_list(F.struct(page_no, "piece"))),
                                          lambda x: x["piece"].isNotNull()), lambda x: x["piece"]),
                     "\n").alias("part"))
    part = F.when(F.length("part") > 0, F.col("part"))
    lvl2 = lvl1.groupBy(doc).agg(
        F.sum("n").alias("n_pages"),
        F.array_join(F.transform(F.filter(F.sort_array(F.collect_list(F.struct(F.col("blk"), part.alias("p")))),
                                          lambda x: x["p"].isNotNull()), lambda x: x["p"]), "\n").alias("content"))
    return lvl2.select(doc, "content", F.col("n_pages").cast("long").alias("n_pages"),
                       F.length("content").cast("long").alias("n_chars"))


def nonempty_pages(pages: DataFrame, text: str = "text") -> DataFrame:
    return pages.filter(F.length(F.col(text)) > 0)


def append_attachment(report: DataFrame, attachment: DataFrame, key: str, kind: str = "company") -> DataFrame:
    """Append an attachment under the separator of its kind, only when its
    status is ok and the text is non-empty (``attachment``: key, status, text)."""
    sep = ATTACH_COMPANY if kind == "company" else ATTACH_MACRO
    a = attachment.select(key, F.col("status").alias("_st"), F.col("text").alias("_tx"))
    j = report.join(a, key, "left")
    ok = (F.col("_st") == "ok") & (F.length(F.col("_tx")) > 0)
    return j.select(*[c for c in report.columns if c != "content"],
                    F.when(ok, F.concat(F.col("content"), F.lit(sep), F.col("_tx")))
                     .otherwise(F.col("content")).alias("content"),
                    F.coalesce(ok, F.lit(False)).alias("attached"))


# ------------------------------------------------------------------ S-2 / P-13 / P-14

def required_gate(docs: DataFrame, key: str, kind: str, content: str, required: list[str],
                  order: str | None = None) -> DataFrame:
    """One column per required kind (its first document by ``order``; a
    missing one is empty text) and ``ok`` when all are non-empty."""
    pick = F.min_by(F.col(content), F.col(order)) if order else F.min(F.col(content))
    p = docs.groupBy(key).pivot(kind, required).agg(pick)
    cols = [F.coalesce(F.col(r), F.lit("")).alias(r) for r in required]
    out = p.select(key, *cols)
    ok = None
    for r in required:
        c = F.length(F.col(r)) > 0
        ok = c if ok is None else ok & c
    return out.withColumn("ok", ok)


def system_prompt(persona, frameworks, rulebook) -> Column:
    return fill_template(SYSTEM_TEMPLATE, {
        "persona": _c(persona), "frameworks": _c(frameworks), "master_rulebook": _c(rulebook)})


def user_prompt(few_shot, raw, essence, idea) -> Column:
    return fill_template(USER_TEMPLATE, {
        "few_shot_data": _c(few_shot), "raw_data": _c(raw), "core_essence": _c(essence),
        "idea": F.coalesce(F.nullif(_c(idea), F.lit("")), F.lit(DEFAULT_IDEA))})


def audit_prompt(metrics_json) -> tuple[Column, Column]:
    """(system, user) prompt of the audit step; the user prompt shows the metrics."""
    return F.lit(AUDIT_SYSTEM_TEMPLATE), fill_template(AUDIT_USER_TEMPLATE, {"metrics_json": _c(metrics_json)})


def sectioned_log(system, prompt, response) -> Column:
    return F.concat(F.lit(LOG_SYSTEM), _c(system), F.lit("\n\n"), F.lit(LOG_PROMPT), _c(prompt),
                    F.lit("\n\n"), F.lit(LOG_RESPONSE), _c(response), F.lit("\n"))
