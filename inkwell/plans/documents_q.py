"""Document bindings.

* file names from ``events``: ``dialogue_log_<ts>_<event_type>_<user_id>.txt``
  with mtime = ts
* labels from ``part`` names and customer segments; essence files from
  ``part`` (mtime = p_partkey)
* tagged spans from ``pages.html`` (tag ``li``)
* folders from ``conversations``: folder = conv_id, draft = turn 2,
  final = turn 3, system turns are blank pages
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import PY_SPACE, source_label
from inkwell.operators import documents as D
from inkwell.operators import rules as R
from inkwell.operators.market import normalize_ticker
from inkwell.plans.tables import load

# run stamp parameter (wall clock, no zone: independent of the session zone)
RUN_TS = "2026-01-01 00:00:00"
_RUN_TS_SQL = "TIMESTAMP '2026-01-01 00:00:00'"


def _q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


# -------------------------------------------------------------- name + label

def _event_docs(spark, d) -> DataFrame:
    ev = load(spark, d, "events")
    name = F.concat(F.lit("dialogue_log_"), F.date_format("ts", "yyyyMMdd_HHmmss"), F.lit("_"),
                    F.col("event_type"), F.lit("_"), F.col("user_id").cast("string"), F.lit(".txt"))
    return ev.select("event_id", "event_type", name.alias("name"), F.col("ts").alias("mtime"))


def q_source_labels(spark, d) -> DataFrame:
    docs = _event_docs(spark, d)
    return docs.select("event_id", "name", source_label("name").alias("label"),
                       normalize_ticker(F.col("event_type")).alias("ticker"))


def q_latest_per_label(spark, d) -> DataFrame:
    docs = _event_docs(spark, d).select("name", "mtime", source_label("name").alias("label"))
    out = D.latest_document(docs, by=["label"])
    return out.select("label", "name", F.date_format("mtime", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("mtime"),
                      "n_docs")


def _labels(spark, d) -> DataFrame:
    p = load(spark, d, "part").select(F.upper(F.replace("p_name", F.lit(" "), F.lit("_"))).alias("label"))
    c = load(spark, d, "customer").select(F.col("c_mktsegment").alias("label"))
    return p.unionByName(c).distinct()


def _essences(spark, d) -> DataFrame:
    p = load(spark, d, "part")
    name = F.concat(F.lit("essence_"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"),
                    F.col("p_partkey").cast("string"), F.lit(".md"))
    return p.select(name.alias("name"), F.col("p_partkey").alias("mtime"))


def q_essence_pairing(spark, d) -> DataFrame:
    lab = _labels(spark, d)
    res = D.pair_essence(lab, _essences(spark, d))
    kws = lab.select("label", F.array_join(D.label_keywords("label"), ",").alias("keywords"))
    return res.join(kws, "label").select("label", "keywords", "essence_name", "essence_mtime", "matched")


def q_essence_pairing_equijoin(spark, d) -> DataFrame:
    """The pairing with the newest time of each match."""
    lab = _labels(spark, d)
    res = D.pair_essence(lab, _essences(spark, d))
    return res.select("label", "essence_name", "essence_mtime", "matched")


def _essence_files(spark, d) -> DataFrame:
    """Essence folder: one file per part (content = p_type, mtime =
    p_partkey) plus one ``essence_<type>.md`` file per part type (mtime -1,
    the PROMO one empty)."""
    p = load(spark, d, "part")
    name = F.concat(F.lit("essence_"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"),
                    F.col("p_partkey").cast("string"), F.lit(".md"))
    per_part = p.select(name.alias("name"), F.col("p_partkey").alias("mtime"), F.col("p_type").alias("content"))
    per_type = p.select(F.concat(F.lit("essence_"), F.lower("p_type"), F.lit(".md")).alias("name"),
                        F.lit(-1).cast("long").alias("mtime"),
                        F.when(F.col("p_type") == "PROMO", F.lit("")).otherwise(F.col("p_type")).alias("content")) \
        .distinct()
    return per_part.unionByName(per_type)


def q_resolve_essence(spark, d) -> DataFrame:
    """Explicit essence = ``essence_<first label word>.md`` (exists for some
    labels, empty for one), else the label's paired essence."""
    req = _labels(spark, d).select(
        "label", F.concat(F.lit("essence_"), F.lower(F.split("label", "_").getItem(0)), F.lit(".md")).alias("explicit"))
    res = D.resolve_essence(req, _essence_files(spark, d))
    return res.select("label", "essence_source", "essence_name", F.md5("essence").alias("essence_md5"))


def _turn_docs(spark, d) -> DataFrame:
    c = load(spark, d, "conversations")
    return c.select(
        F.concat(F.lit("turn_"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string"),
                 F.lit(".md")).alias("name"),
        (F.col("conv_id") * 100 + F.col("turn")).alias("mtime"),
        F.when(F.col("role") == "system", F.lit("")).otherwise(F.col("text")).alias("content"),
        "conv_id", "turn")


def q_resolve_input(spark, d) -> DataFrame:
    docs = _turn_docs(spark, d)
    req = docs.select((F.col("conv_id") * 100 + F.col("turn")).alias("req_id"),
                      F.concat(F.lit("turn_"), F.col("conv_id").cast("string"), F.lit("_"),
                               (F.col("turn") + 1).cast("string"), F.lit(".md")).alias("explicit"))
    out = D.resolve_input(req, docs.select("name", "mtime", "content"))
    return out.select("req_id", "chosen_source", "chosen_name", "label", F.md5("content").alias("content_md5"))


# --------------------------------------------------------------- tagged spans

TAG = "li"


def q_tagged_spans(spark, d) -> DataFrame:
    p = load(spark, d, "pages")
    out = D.extract_tagged(p, "html", TAG, keep=["page_id"])
    return out.select("page_id", F.col("idx").cast("long").alias("idx"), "body")


def q_clean_pages(spark, d) -> DataFrame:
    p = load(spark, d, "pages")
    clean = D.strip_tagged("html", TAG)
    n = F.size(F.regexp_extract_all("html", F.lit(D.tag_pattern(TAG)), 1))
    return p.select("page_id", clean.alias("clean"), n.alias("n_cards")).select(
        "page_id", F.col("n_cards").cast("long").alias("n_cards"), (F.col("n_cards") == 3).alias("card_ok"),
        F.length("clean").cast("long").alias("clean_chars"), F.md5("clean").alias("clean_md5"),
        D.tag_leak("clean", TAG).alias("tag_leak"))


def q_card_documents(spark, d) -> DataFrame:
    p = load(spark, d, "pages")
    cards = D.tagged_spans("html", TAG)
    label = F.concat(F.lit("PAGE_"), F.col("page_id").cast("string"))
    content = D.card_document_text(label, F.lit(RUN_TS).cast("timestamp_ntz"), cards)
    return p.select("page_id", F.size(cards).cast("long").alias("n_cards"), content.alias("content")) \
        .filter(F.col("content").isNotNull())


def q_card_fields(spark, d) -> DataFrame:
    p = load(spark, d, "part")
    body = F.concat(F.lit("**"), F.col("p_name"), F.lit("**\n"), F.col("p_type"))
    title, text = D.card_fields(body)
    return p.select("p_partkey", title.alias("title"), text.alias("text"))


def _responses(spark, d) -> DataFrame:
    p = load(spark, d, "part")
    text = F.concat(
        F.lit("1. **抖音/短视频高流量流量包装套餐**\n\n*   **视频封面文字**："), F.col("p_name"),
        F.lit("\n*   **吸睛发布标题**："), F.col("p_type"), F.lit(" "), F.col("p_name"), F.lit("？"),
        F.lit("\n*   **5 个高流量精准 Hashtags**：#"), F.replace("p_name", F.lit(" "), F.lit(" #")),
        F.lit(" #"), F.col("p_type"), F.lit(" "), F.col("p_brand"), F.lit(" #size"), F.col("p_size").cast("string"),
        F.lit("\n\n---\n\n2. **视频逐字口播稿**\n\n"), F.col("p_name"), F.lit(" costs "),
        F.col("p_retailprice").cast("string"), F.lit(".\n\n---\n\n3. **硬核投资认知卡片**\n"))
    return p.select("p_partkey", "p_name", "p_type", "p_size", text.alias("text"))


def q_response_parts(spark, d) -> DataFrame:
    r = _responses(spark, d)
    parts = D.response_parts("text")
    out = r.select("p_partkey", parts["cover"].alias("cover"), parts["title"].alias("title"),
                   parts["hashtags"].alias("tags"), parts["spoken"].alias("spoken"))
    n, ok = R.cover_length(F.col("cover"))
    return out.select("p_partkey", "cover", n.cast("long").alias("cover_len"), ok.alias("cover_ok"), "title",
                      F.array_join("tags", " ").alias("hashtags"), F.size("tags").cast("long").alias("n_tags"),
                      "spoken")


def _tag_dim(spark, d) -> DataFrame:
    p = load(spark, d, "part")
    words = F.split("p_name", " ")
    macro = p.select(F.explode(words).alias("tag")).withColumn("tag_class", F.lit("macro"))
    vert = p.select(F.col("p_type").alias("tag")).withColumn("tag_class", F.lit("vertical")) \
        .unionByName(p.select(F.regexp_extract("p_brand", "#(.*)$", 1).alias("tag"))
                     .withColumn("tag_class", F.lit("vertical")))
    ident = p.filter(F.col("p_size") <= 25).select(
        F.concat(F.lit("size"), F.col("p_size").cast("string")).alias("tag")).withColumn("tag_class", F.lit("identity"))
    return macro.unionByName(vert).unionByName(ident).groupBy("tag").agg(F.min("tag_class").alias("tag_class"))


def q_hashtag_matrix(spark, d) -> DataFrame:
    r = _responses(spark, d)
    tags = r.select("p_partkey", D.response_parts("text")["hashtags"].alias("tags"))
    return R.hashtag_matrix(tags, "p_partkey", _tag_dim(spark, d))


# ------------------------------------------------------------ folders / pairs

def _folder_files(spark, d) -> DataFrame:
    c = load(spark, d, "conversations")
    name = (F.when(F.col("turn") == 2, F.lit(D.DRAFT_NAME)).when(F.col("turn") == 3, F.lit(D.FINAL_NAME))
            .otherwise(F.concat(F.lit("turn_"), F.col("turn").cast("string"), F.lit(".md"))))
    return c.select(F.col("conv_id").alias("dir"), name.alias("name"), F.col("conv_id").alias("mtime"),
                    F.col("text").alias("content"))


def q_latest_folders(spark, d) -> DataFrame:
    out = D.latest_k_groups(_folder_files(spark, d), 3)
    return out.select("dir", "group_mtime", F.col("rank").cast("long").alias("rank"))


def q_version_pairs(spark, d) -> DataFrame:
    p = D.pair_versions(_folder_files(spark, d))
    return p.select("dir", F.length("v1").cast("long").alias("v1_chars"),
                    F.length("v2").cast("long").alias("v2_chars"))


def q_few_shot_block(spark, d) -> DataFrame:
    b = D.few_shot_block(D.few_shot_pairs(_folder_files(spark, d), 3))
    return b.select(F.col("n_pairs").cast("long").alias("n_pairs"),
                    F.length("few_shot").cast("long").alias("n_chars"), F.md5("few_shot").alias("few_shot_md5"))


def q_draft_final_diff(spark, d) -> DataFrame:
    from inkwell.operators.diff import draft_final_diff
    return draft_final_diff(D.pair_versions(_folder_files(spark, d)), key="dir")


def _reordered(spark, d) -> DataFrame:
    """Stand-in versions of a conversation: v1 = all turns in order, v2 = the
    turns without a user's first, then the users' again from the last one on."""
    c = load(spark, d, "conversations")
    turns = c.groupBy(F.col("conv_id").alias("dir")).agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    texts = lambda a: F.array_join(F.transform(a, lambda x: x["text"]), "\n")
    user = lambda x: x["role"] == "user"
    return turns.select("dir", texts(F.col("t")).alias("v1"), F.concat(
        texts(F.filter("t", lambda x: ~user(x))), F.lit("\n"), texts(F.reverse(F.filter("t", user)))).alias("v2"))


def q_draft_final_alignment(spark, d) -> DataFrame:
    from inkwell.operators.diff import draft_final_alignment
    return draft_final_alignment(_reordered(spark, d))


def q_archive_few_shot(spark, d) -> DataFrame:
    """Drafts (turn 2) and finals (turn 3) as rows of the report table, read as the
    history folders of the next generation run (run stamp = a second per conversation)."""
    from inkwell.sinks import archive_files, report_rows
    c = load(spark, d, "conversations")
    run_ts = F.timestamp_add("SECOND", F.col("conv_id"), F.lit(RUN_TS).cast("timestamp_ntz"))
    docs = c.select("turn", F.concat(F.lit("C"), F.col("conv_id").cast("string")).alias("label"), run_ts.alias("at"),
                    F.col("text").alias("content"))
    rows = report_rows(docs.filter("turn = 2"), "draft", F.col("at")).unionByName(
        report_rows(docs.filter("turn = 3"), "final", F.col("at")))
    b = D.few_shot_block(D.few_shot_pairs(archive_files(rows), 3))
    return b.select(F.col("n_pairs").cast("long").alias("n_pairs"), F.length("few_shot").cast("long").alias("n_chars"),
                    F.md5("few_shot").alias("few_shot_md5"))


def _conv_pages(spark, d) -> DataFrame:
    c = load(spark, d, "conversations")
    return c.select(F.col("conv_id").alias("doc_id"), (F.col("turn") + 1).alias("page_no"),
                    F.when(F.col("role") == "system", F.lit("")).otherwise(F.col("text")).alias("text"))


def q_assembled_pages(spark, d) -> DataFrame:
    a = D.assemble_pages(_conv_pages(spark, d), block=4)
    return a.select("doc_id", "n_pages", "n_chars", F.md5("content").alias("content_md5"))


def q_required_gate(spark, d) -> DataFrame:
    c = load(spark, d, "conversations")
    g = D.required_gate(c, "conv_id", "role", "text", ["user", "assistant", "system"], order="turn")
    return g.select("conv_id", *[F.length(r).cast("long").alias(f"{r}_chars") for r in ["user", "assistant", "system"]],
                    "ok")


def q_sectioned_log(spark, d) -> DataFrame:
    c = load(spark, d, "conversations")
    g = D.required_gate(c, "conv_id", "role", "text", ["user", "assistant", "system"], order="turn")
    log = D.sectioned_log("system", "user", "assistant")
    return g.select("conv_id", log.alias("log")).select(
        "conv_id", F.length("log").cast("long").alias("log_chars"), F.md5("log").alias("log_md5"))


def q_prompt_assembly(spark, d) -> DataFrame:
    docs = load(spark, d, "documents")
    cfg = docs.select("doc_id", "text").orderBy("doc_id").limit(3)
    pick = lambda i: cfg.orderBy("doc_id").offset(i).limit(1).select("text").scalar()
    system = D.system_prompt(pick(0), pick(1), pick(2))
    few = D.few_shot_block(D.few_shot_pairs(_folder_files(spark, d), 3)).select("few_shot").scalar()
    label = source_label(F.concat(F.col("source"), F.lit("_raw_"), F.col("doc_id").cast("string"), F.lit(".txt")))
    prompt = D.user_prompt(few, F.col("text"), F.lit(D.NO_ESSENCE_TEXT), F.lit(None).cast("string"))
    return docs.select("doc_id", label.alias("label"), F.md5(system).alias("system_md5"),
                       F.md5(prompt).alias("prompt_md5"), F.length(prompt).cast("long").alias("prompt_chars"))


def q_union_sources(spark, d) -> DataFrame:
    """Two listings (``*.txt`` documents, ``*.md`` pages) as one document
    table."""
    from inkwell.sources.files import union_sources
    a = load(spark, d, "documents").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"),
        F.col("text").alias("content"), F.lit("raw").alias("kind"))
    b = load(spark, d, "pages").select(
        F.concat(F.lit("page_"), F.col("page_id").cast("string"), F.lit(".md")).alias("name"),
        F.col("html").alias("content"))
    u = union_sources(a, b)
    return u.select("name", source_label("name").alias("label"), F.coalesce("kind", F.lit("page")).alias("kind"),
                    F.length("content").cast("long").alias("n_chars"))


QUERIES = {
    "union_sources": q_union_sources,
    "source_labels": q_source_labels,
    "latest_per_label": q_latest_per_label,
    "essence_pairing": q_essence_pairing,
    "essence_pairing_equijoin": q_essence_pairing_equijoin,
    "resolve_input": q_resolve_input,
    "resolve_essence": q_resolve_essence,
    "tagged_spans": q_tagged_spans,
    "clean_pages": q_clean_pages,
    "card_documents": q_card_documents,
    "card_fields": q_card_fields,
    "response_parts": q_response_parts,
    "hashtag_matrix": q_hashtag_matrix,
    "latest_folders": q_latest_folders,
    "version_pairs": q_version_pairs,
    "few_shot_block": q_few_shot_block,
    "draft_final_diff": q_draft_final_diff,
    "draft_final_alignment": q_draft_final_alignment,
    "archive_few_shot": q_archive_few_shot,
    "assembled_pages": q_assembled_pages,
    "required_gate": q_required_gate,
    "sectioned_log": q_sectioned_log,
    "prompt_assembly": q_prompt_assembly,
}

# ----------------------------------------------------------------- DuckDB SQL

_STRIP = rf"'\A{PY_SPACE}+|{PY_SPACE}+\z'"


def _ustrip(x: str) -> str:
    return f"regexp_replace({x}, {_STRIP}, '', 'g')"


def _label(x: str) -> str:
    s = f"lower({x})"
    for lit in [".txt", ".md", "_raw", "dialogue_log_", "essence_"]:
        s = f"replace({s}, '{lit}', '')"
    s = f"regexp_replace({s}, '[0-9]{{8}}(_[0-9]{{6}})?', '', 'g')"
    s = f"regexp_replace({s}, '_+', '_', 'g')"
    s = f"regexp_replace({s}, '^_+|_+$', '', 'g')"
    return f"coalesce(nullif(upper({s}), ''), 'TOPIC')"


_EVENT_NAME = ("'dialogue_log_' || strftime(ts, '%Y%m%d_%H%M%S') || '_' || event_type || '_' "
               "|| CAST(user_id AS VARCHAR) || '.txt'")

_KWS = ("CASE WHEN contains(lower(label), 'wmt') THEN list_append(k0, 'walmart') "
        "WHEN contains(lower(label), 'walmart') THEN list_append(k0, 'wmt') ELSE k0 END")

_PAIRING = f"""
lab AS (SELECT DISTINCT upper(replace(p_name, ' ', '_')) AS label FROM part
        UNION SELECT DISTINCT c_mktsegment FROM customer),
ess AS (SELECT 'essence_' || replace(p_name, ' ', '_') || '_' || CAST(p_partkey AS VARCHAR) || '.md' AS name,
               p_partkey AS mtime FROM part),
k0 AS (SELECT label, list_filter(string_split(lower(label), '_'), lambda x: length(x) > 1) AS k0 FROM lab),
kl AS (SELECT label, {_KWS} AS kws FROM k0),
lk AS (SELECT DISTINCT label, unnest(kws) AS kw FROM kl),
cand AS (SELECT DISTINCT lk.label, e.name, e.mtime FROM lk JOIN ess e ON contains(lower(e.name), lk.kw)),
best AS (SELECT label, name, mtime FROM (
           SELECT *, row_number() OVER (PARTITION BY label ORDER BY mtime DESC, name) AS r FROM cand) WHERE r = 1),
newest AS (SELECT name, mtime FROM ess ORDER BY mtime DESC, name LIMIT 1),
res AS (SELECT l.label, coalesce(b.name, (SELECT name FROM newest), '无') AS essence_name,
               coalesce(b.mtime, (SELECT mtime FROM newest)) AS essence_mtime, b.name IS NOT NULL AS matched
        FROM lab l LEFT JOIN best b ON b.label = l.label)"""

_PAIRING_FILES = _PAIRING.replace(
    """ess AS (SELECT 'essence_' || replace(p_name, ' ', '_') || '_' || CAST(p_partkey AS VARCHAR) || '.md' AS name,
               p_partkey AS mtime FROM part),""",
    """ess AS (SELECT 'essence_' || replace(p_name, ' ', '_') || '_' || CAST(p_partkey AS VARCHAR) || '.md' AS name,
               p_partkey AS mtime, p_type AS content FROM part
           UNION ALL SELECT DISTINCT 'essence_' || lower(p_type) || '.md', -1,
               CASE WHEN p_type = 'PROMO' THEN '' ELSE p_type END FROM part),""")
assert _PAIRING_FILES != _PAIRING

_TURN_DOCS = """
docs AS (SELECT 'turn_' || CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) || '.md' AS name,
                conv_id * 100 + turn AS mtime,
                CASE WHEN role = 'system' THEN '' ELSE text END AS content, conv_id, turn
         FROM conversations)"""

_LI = r"'<li>(.*?)</li>'"
_LI0 = r"'<li>.*?</li>'"

_COVER_DROP = r"'[\p{P}" + PY_SPACE[1:-1] + "]'"

_RESP = r"""
resp AS (SELECT p_partkey, p_name, p_type, p_size,
  '1. **抖音/短视频高流量流量包装套餐**' || chr(10) || chr(10) || '*   **视频封面文字**：' || p_name
  || chr(10) || '*   **吸睛发布标题**：' || p_type || ' ' || p_name || '？'
  || chr(10) || '*   **5 个高流量精准 Hashtags**：#' || replace(p_name, ' ', ' #') || ' #' || p_type || ' ' || p_brand
  || ' #size' || CAST(p_size AS VARCHAR)
  || chr(10) || chr(10) || '---' || chr(10) || chr(10) || '2. **视频逐字口播稿**' || chr(10) || chr(10)
  || p_name || ' costs ' || CAST(p_retailprice AS VARCHAR) || '.' || chr(10) || chr(10) || '---' || chr(10) || chr(10)
  || '3. **硬核投资认知卡片**' || chr(10) AS text FROM part),
parts AS (SELECT p_partkey, text,
  regexp_extract(text, '视频封面文字[^\n]*?[：:]([^\n]*)', 1) AS cover0,
  regexp_extract(text, '吸睛发布标题[^\n]*?[：:]([^\n]*)', 1) AS title0,
  regexp_extract_all(regexp_extract(text, 'Hashtags[^\n]*?[：:]([^\n]*)', 1), '#([^\s#]+)', 1) AS tags,
  regexp_split_to_array(text, '\n-{3,}[ \t]*(\n|\z)') AS sections FROM resp)"""

_FOLDER = """
files AS (SELECT conv_id AS dir,
                 CASE WHEN turn = 2 THEN '""" + D.DRAFT_NAME + """' WHEN turn = 3 THEN '""" + D.FINAL_NAME + """'
                      ELSE 'turn_' || CAST(turn AS VARCHAR) || '.md' END AS name,
                 conv_id AS mtime, text AS content FROM conversations),
top AS (SELECT dir, max(mtime) AS group_mtime FROM files GROUP BY dir ORDER BY group_mtime DESC, dir LIMIT 3),
ranked AS (SELECT *, row_number() OVER (ORDER BY group_mtime DESC, dir) AS rank FROM top),
pairs AS (SELECT a.dir, a.content AS v1, b.content AS v2 FROM files a JOIN files b
          ON a.dir = b.dir AND a.name = '""" + D.DRAFT_NAME + """' AND b.name = '""" + D.FINAL_NAME + """'),
kept AS (SELECT p.*, row_number() OVER (ORDER BY r.rank) AS n FROM ranked r JOIN pairs p ON p.dir = r.dir),
fs AS (SELECT CAST(count(*) AS BIGINT) AS n_pairs,
              CASE WHEN count(*) > 0 THEN """ + _q(D.FEW_SHOT_HEADER) + """ || string_agg(
                 '【修改对照案例 ' || CAST(n AS VARCHAR) || '：' || CAST(dir AS VARCHAR) || '】' || chr(10)
                 || """ + _q(D.FEW_SHOT_V1) + """ || v1 || chr(10) || chr(10)
                 || """ + _q(D.FEW_SHOT_V2) + """ || v2 || chr(10)
                 || '""" + D.RULE_72 + """' || chr(10) || chr(10), '' ORDER BY n)
              ELSE '' END AS few_shot FROM kept)"""

_GATE = """
g AS (SELECT conv_id,
        coalesce(arg_min(text, turn) FILTER (WHERE role = 'user'), '') AS "user",
        coalesce(arg_min(text, turn) FILTER (WHERE role = 'assistant'), '') AS assistant,
        coalesce(arg_min(text, turn) FILTER (WHERE role = 'system'), '') AS system
      FROM conversations GROUP BY conv_id)"""


def _fill_sql(template: str, values: dict) -> str:
    parts = D.template_parts(template)
    out = []
    for i, p in enumerate(parts):
        if i % 2 == 0:
            if p:
                out.append(_q(p))
        else:
            out.append(values[p])
    return " || ".join(out)


ORACLE = {
    "union_sources": f"""WITH u AS (
          SELECT 'doc_' || CAST(doc_id AS VARCHAR) || '.txt' AS name, text AS content, 'raw' AS kind FROM documents
          UNION ALL SELECT 'page_' || CAST(page_id AS VARCHAR) || '.md', html, NULL FROM pages)
        SELECT name, {_label('name')} AS label, coalesce(kind, 'page') AS kind, CAST(length(content) AS BIGINT) AS n_chars
        FROM u""",
    "source_labels": f"""SELECT event_id, {_EVENT_NAME} AS name, {_label(_EVENT_NAME)} AS label,
                            upper(event_type) AS ticker FROM events""",
    "latest_per_label": f"""WITH docs AS (SELECT {_EVENT_NAME} AS name, ts AS mtime, {_label(_EVENT_NAME)} AS label FROM events),
        r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY mtime DESC, name) AS rn,
                     count(*) OVER (PARTITION BY label) AS n_docs FROM docs)
        SELECT label, name, strftime(mtime, '%Y-%m-%d %H:%M:%S.%f') AS mtime, CAST(n_docs AS BIGINT) AS n_docs
        FROM r WHERE rn = 1""",
    "essence_pairing": f"""WITH {_PAIRING}
        SELECT r.label, array_to_string(kl.kws, ',') AS keywords, essence_name, essence_mtime, matched
        FROM res r JOIN kl ON kl.label = r.label""",
    "essence_pairing_equijoin": f"""WITH {_PAIRING} SELECT label, essence_name, essence_mtime, matched FROM res""",
    "resolve_essence": f"""WITH {_PAIRING_FILES},
        req AS (SELECT label, 'essence_' || lower(string_split(label, '_')[1]) || '.md' AS explicit FROM lab),
        j AS (SELECT r.label, x.name AS x_name, x.content AS x_content, res.essence_name AS p_name, pc.content AS p_content
              FROM req r LEFT JOIN ess x ON x.name = r.explicit
              LEFT JOIN res ON res.label = r.label LEFT JOIN ess pc ON pc.name = res.essence_name),
        o AS (SELECT label,
                CASE WHEN nullif(x_content, '') IS NOT NULL THEN 'explicit'
                     WHEN nullif(p_content, '') IS NOT NULL THEN 'paired' ELSE 'default' END AS essence_source,
                CASE WHEN nullif(x_content, '') IS NOT NULL THEN x_name
                     WHEN nullif(p_content, '') IS NOT NULL THEN p_name ELSE {_q(D.NO_ESSENCE_FILE)} END AS essence_name,
                CASE WHEN nullif(x_content, '') IS NOT NULL THEN x_content
                     WHEN nullif(p_content, '') IS NOT NULL THEN p_content ELSE {_q(D.NO_ESSENCE_TEXT)} END AS essence
              FROM j)
        SELECT label, essence_source, essence_name, md5(essence) AS essence_md5 FROM o""",
    "resolve_input": f"""WITH {_TURN_DOCS},
        req AS (SELECT conv_id * 100 + turn AS req_id,
                       'turn_' || CAST(conv_id AS VARCHAR) || '_' || CAST(turn + 1 AS VARCHAR) || '.md' AS explicit FROM docs),
        newest AS (SELECT name, content FROM docs ORDER BY mtime DESC, name LIMIT 1),
        j AS (SELECT r.req_id, d.name AS x_name, d.content AS x_content,
                     nullif(d.content, '') IS NOT NULL AS e_ok,
                     nullif((SELECT content FROM newest), '') IS NOT NULL AS l_ok
              FROM req r LEFT JOIN docs d ON d.name = r.explicit)
        SELECT req_id,
          CASE WHEN e_ok THEN 'explicit' WHEN l_ok THEN 'latest' ELSE 'default' END AS chosen_source,
          CASE WHEN e_ok THEN x_name WHEN l_ok THEN (SELECT name FROM newest) END AS chosen_name,
          CASE WHEN e_ok THEN {_label('x_name')} WHEN l_ok THEN {_label('(SELECT name FROM newest)')}
               ELSE 'RAW_THOUGHT' END AS label,
          md5(CASE WHEN e_ok THEN x_content WHEN l_ok THEN (SELECT content FROM newest)
                   ELSE {_q(D.NO_RAW_TEXT)} END) AS content_md5
        FROM j""",
    "tagged_spans": f"""WITH s AS (SELECT page_id, regexp_extract_all(html, {_LI}, 1, 's') AS a FROM pages),
        u AS (SELECT page_id, generate_subscripts(a, 1) AS idx, unnest(a) AS body FROM s)
        SELECT page_id, CAST(idx AS BIGINT) AS idx, {_ustrip('body')} AS body FROM u""",
    "clean_pages": f"""WITH s AS (SELECT page_id,
             regexp_replace({_ustrip(f"regexp_replace(html, {_LI0}, '', 'gs')")}, '\\n{{3,}}', chr(10) || chr(10), 'g') AS clean,
             CAST(len(regexp_extract_all(html, {_LI}, 1, 's')) AS BIGINT) AS n_cards FROM pages)
        SELECT page_id, n_cards, n_cards = 3 AS card_ok, CAST(length(clean) AS BIGINT) AS clean_chars,
               md5(clean) AS clean_md5, contains(clean, '<li>') OR contains(clean, '</li>') AS tag_leak FROM s""",
    "card_documents": f"""WITH s AS (SELECT page_id, regexp_extract_all(html, {_LI}, 1, 's') AS a FROM pages),
        u AS (SELECT page_id, generate_subscripts(a, 1) AS idx, unnest(a) AS body FROM s)
        SELECT page_id, CAST(count(*) AS BIGINT) AS n_cards,
          {_q(D.CARD_HEADER)} || 'PAGE_' || CAST(page_id AS VARCHAR) || chr(10) || {_q(D.CARD_TIME)}
          || strftime({_RUN_TS_SQL}, '%Y-%m-%d %H:%M:%S') || chr(10) || chr(10) || '---' || chr(10) || chr(10)
          || string_agg({_q(D.CARD_TITLE)} || CAST(idx AS VARCHAR) || chr(10) || {_ustrip('body')}
                        || chr(10) || chr(10) || '---' || chr(10) || chr(10), '' ORDER BY idx) AS content
        FROM u GROUP BY page_id""",
    "card_fields": r"""WITH b AS (SELECT p_partkey, '**' || p_name || '**' || chr(10) || p_type AS body FROM part)
        SELECT p_partkey, regexp_extract(body, '\*\*(.*?)\*\*', 1) AS title, """
        + _ustrip(r"regexp_extract(body, '^[^\n]*\n(.*)$', 1, 's')") + " AS text FROM b",
    "response_parts": f"""WITH {_RESP},
        x AS (SELECT p_partkey, {_ustrip('cover0')} AS cover, {_ustrip('title0')} AS title, tags,
                CASE WHEN len(sections) >= 2 THEN
                  {_ustrip(f"regexp_replace({_ustrip('sections[2]')}, '^[0-9]+\\.[^\\n]*\\n', '')")} END AS spoken
              FROM parts)
        SELECT p_partkey, cover, CAST(length(regexp_replace(cover, {_COVER_DROP}, '', 'g')) AS BIGINT) AS cover_len,
               length(regexp_replace(cover, {_COVER_DROP}, '', 'g')) BETWEEN 6 AND 8 AS cover_ok,
               title, array_to_string(tags, ' ') AS hashtags, CAST(len(tags) AS BIGINT) AS n_tags, spoken FROM x""",
    "hashtag_matrix": f"""WITH {_RESP},
        dim0 AS (SELECT unnest(string_split(p_name, ' ')) AS tag, 'macro' AS tag_class FROM part
                 UNION ALL SELECT p_type, 'vertical' FROM part
                 UNION ALL SELECT regexp_extract(p_brand, '#(.*)$', 1), 'vertical' FROM part
                 UNION ALL SELECT 'size' || CAST(p_size AS VARCHAR), 'identity' FROM part WHERE p_size <= 25),
        dim AS (SELECT tag, min(tag_class) AS tag_class FROM dim0 GROUP BY tag),
        u AS (SELECT p_partkey, generate_subscripts(tags, 1) AS pos, unnest(tags) AS tag FROM parts),
        c AS (SELECT u.p_partkey, u.pos, coalesce(d.tag_class, 'unknown') AS cls FROM u LEFT JOIN dim d ON d.tag = u.tag),
        a AS (SELECT p_partkey, CAST(count(*) AS BIGINT) AS n_tags,
                 CAST(count(*) FILTER (WHERE cls = 'macro') AS BIGINT) AS n_macro,
                 CAST(count(*) FILTER (WHERE cls = 'vertical') AS BIGINT) AS n_vertical,
                 CAST(count(*) FILTER (WHERE cls = 'identity') AS BIGINT) AS n_identity,
                 CAST(count(*) FILTER (WHERE cls = 'unknown') AS BIGINT) AS n_unknown,
                 string_agg(cls, ',' ORDER BY pos) AS class_seq FROM c GROUP BY p_partkey),
        w AS (SELECT r.p_partkey, coalesce(n_tags, 0) AS n_tags, coalesce(n_macro, 0) AS n_macro, coalesce(n_vertical, 0) AS n_vertical,
                 coalesce(n_identity, 0) AS n_identity, coalesce(n_unknown, 0) AS n_unknown, coalesce(class_seq, '') AS class_seq
              FROM parts r LEFT JOIN a ON a.p_partkey = r.p_partkey)
        SELECT *, class_seq = 'macro,macro,vertical,vertical,identity' AS order_ok,
               n_tags = 5 AND class_seq = 'macro,macro,vertical,vertical,identity' AS ok FROM w""",
    "latest_folders": f"""WITH {_FOLDER} SELECT dir, group_mtime, CAST(rank AS BIGINT) AS rank FROM ranked""",
    "version_pairs": f"""WITH {_FOLDER} SELECT dir, CAST(length(v1) AS BIGINT) AS v1_chars,
        CAST(length(v2) AS BIGINT) AS v2_chars FROM pairs""",
    "few_shot_block": f"""WITH {_FOLDER} SELECT n_pairs, CAST(length(few_shot) AS BIGINT) AS n_chars,
        md5(few_shot) AS few_shot_md5 FROM fs""",
    "assembled_pages": """WITH p AS (SELECT conv_id AS doc_id, turn + 1 AS page_no,
              CASE WHEN role = 'system' THEN '' ELSE text END AS text FROM conversations),
        a AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n_pages,
                coalesce(string_agg(CASE WHEN length(text) > 0 THEN '--- 第 ' || CAST(page_no AS VARCHAR) || ' 页 ---'
                       || chr(10) || text || chr(10) END, chr(10) ORDER BY page_no), '') AS content
              FROM p GROUP BY doc_id)
        SELECT doc_id, n_pages, CAST(length(content) AS BIGINT) AS n_chars, md5(content) AS content_md5 FROM a""",
    "required_gate": f"""WITH {_GATE}
        SELECT conv_id, CAST(length("user") AS BIGINT) AS user_chars, CAST(length(assistant) AS BIGINT) AS assistant_chars,
               CAST(length(system) AS BIGINT) AS system_chars,
               length("user") > 0 AND length(assistant) > 0 AND length(system) > 0 AS ok FROM g""",
    "sectioned_log": f"""WITH {_GATE},
        l AS (SELECT conv_id, {_q(D.LOG_SYSTEM)} || system || chr(10) || chr(10) || {_q(D.LOG_PROMPT)} || "user"
                 || chr(10) || chr(10) || {_q(D.LOG_RESPONSE)} || assistant || chr(10) AS log FROM g)
        SELECT conv_id, CAST(length(log) AS BIGINT) AS log_chars, md5(log) AS log_md5 FROM l""",
    "prompt_assembly": f"""WITH {_FOLDER},
        cfg AS (SELECT text, row_number() OVER (ORDER BY doc_id) AS i FROM (SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 3)),
        sp AS (SELECT {_fill_sql(D.SYSTEM_TEMPLATE, {"persona": "(SELECT text FROM cfg WHERE i = 1)",
                                                    "frameworks": "(SELECT text FROM cfg WHERE i = 2)",
                                                    "master_rulebook": "(SELECT text FROM cfg WHERE i = 3)"})} AS s),
        up AS (SELECT doc_id, source, {_fill_sql(D.USER_TEMPLATE, {"few_shot_data": "(SELECT few_shot FROM fs)",
                                                                 "raw_data": "text",
                                                                 "core_essence": _q(D.NO_ESSENCE_TEXT),
                                                                 "idea": _q(D.DEFAULT_IDEA)})} AS p FROM documents)
        SELECT doc_id, {_label("source || '_raw_' || CAST(doc_id AS VARCHAR) || '.txt'")} AS label,
               md5((SELECT s FROM sp)) AS system_md5, md5(p) AS prompt_md5, CAST(length(p) AS BIGINT) AS prompt_chars
        FROM up""",
}


def _sents_sql(x: str) -> str:
    return (f"list_filter(list_transform(regexp_split_to_array({x}, '[。！？!?.\\n]'), "
            f"lambda s: {_ustrip('s')}), lambda s: length(s) > 0)")


ORACLE["draft_final_diff"] = f"""WITH {_FOLDER},
    s AS (SELECT dir, v1, v2, {_sents_sql('v1')} AS s1, {_sents_sql('v2')} AS s2 FROM pairs),
    d AS (SELECT *, list_distinct(s1) AS d1, list_distinct(s2) AS d2 FROM s)
    SELECT dir, CAST(len(d1) AS BIGINT) AS n_v1, CAST(len(d2) AS BIGINT) AS n_v2,
      CAST(len(list_filter(d1, lambda x: list_contains(d2, x))) AS BIGINT) AS kept,
      CAST(len(list_filter(d1, lambda x: NOT list_contains(d2, x))) AS BIGINT) AS removed,
      CAST(len(list_filter(d2, lambda x: NOT list_contains(d1, x))) AS BIGINT) AS added,
      CASE WHEN length(v1) > 0 THEN length(v2) / length(v1) END AS length_ratio,
      (CASE WHEN len(s2) > 0 THEN list_sum(list_transform(s2, lambda x: length(x))) / len(s2) END)
      - (CASE WHEN len(s1) > 0 THEN list_sum(list_transform(s1, lambda x: length(x))) / len(s1) END)
        AS mean_sentence_len_change
    FROM d"""

# a row of the dynamic programme per sentence of v1; best(j) is a running maximum over j
ORACLE["draft_final_alignment"] = f"""WITH RECURSIVE t AS (
      SELECT conv_id AS dir, string_agg(text, chr(10) ORDER BY turn) AS v1,
             coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (WHERE role <> 'user'), '') || chr(10)
             || coalesce(string_agg(text, chr(10) ORDER BY turn DESC) FILTER (WHERE role = 'user'), '') AS v2
      FROM conversations GROUP BY conv_id),
    s AS (SELECT dir, {_sents_sql('v1')} AS s1, {_sents_sql('v2')} AS s2 FROM t),
    cells AS (
      SELECT dir, 0 AS i, j, 0 AS best FROM (SELECT dir, unnest(range(0, len(s2) + 1)) AS j FROM s)
      UNION ALL
      SELECT dir, i + 1, j, max(reach) OVER (PARTITION BY dir ORDER BY j) FROM (
        SELECT c.dir, c.i, c.j, greatest(c.best, CASE WHEN c.j > 0 AND s.s1[c.i + 1] = s.s2[c.j]
                 THEN 1 + lag(c.best) OVER (PARTITION BY c.dir ORDER BY c.j) ELSE 0 END) AS reach
        FROM cells c JOIN s ON s.dir = c.dir WHERE c.i < len(s.s1))),
    k AS (SELECT s.dir, len(s1) AS n1, len(s2) AS n2, max(best) AS kept FROM s JOIN cells c ON c.dir = s.dir AND c.i = len(s1) GROUP BY ALL),
    w1 AS (SELECT dir, x, count(*) AS n FROM (SELECT dir, unnest(s1) AS x FROM s) GROUP BY ALL),
    w2 AS (SELECT dir, x, count(*) AS n FROM (SELECT dir, unnest(s2) AS x FROM s) GROUP BY ALL),
    sh AS (SELECT w1.dir, sum(least(w1.n, w2.n)) AS shared FROM w1 JOIN w2 ON w1.dir = w2.dir AND w1.x = w2.x GROUP BY w1.dir)
    SELECT k.dir, CAST(n1 AS BIGINT) AS n_v1, CAST(n2 AS BIGINT) AS n_v2, CAST(kept AS BIGINT) AS kept,
           CAST(n1 - kept AS BIGINT) AS removed, CAST(n2 - kept AS BIGINT) AS added,
           CAST(coalesce(shared, 0) - kept AS BIGINT) AS moved
    FROM k LEFT JOIN sh ON sh.dir = k.dir"""

_ARCHIVE = _FOLDER.replace("SELECT conv_id AS dir,", f"""SELECT 'C' || CAST(conv_id AS VARCHAR) || '解析_'
                 || strftime({_RUN_TS_SQL} + to_seconds(conv_id), '%Y%m%d_%H%M%S') AS dir,""").replace(
    "text AS content FROM conversations", "text AS content FROM conversations WHERE turn IN (2, 3)")
ORACLE["archive_few_shot"] = f"""WITH {_ARCHIVE} SELECT n_pairs, CAST(length(few_shot) AS BIGINT) AS n_chars,
        md5(few_shot) AS few_shot_md5 FROM fs"""
