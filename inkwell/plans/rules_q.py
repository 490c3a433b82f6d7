"""Rule bindings over ``documents.text`` (scripts = documents).

The driver's documents hold no Chinese, so besides the real rule table
(``rulebook_scan``) the checks run with a stand-in rule table of frequent
words in three classes, stated below as fixed values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import PY_SPACE, split_sentences
from inkwell.operators import rules as R
from inkwell.plans.tables import load

# ---------------------------------------------------------------- fixed values
# Stand-in rule table for the invented multilingual prose of ``documents``.
STAND_IN_RULES = [
    ("article", " the ", "a"), ("article", " the ", "this"), ("article", " la ", None),
    ("article", " der ", None), ("article", " le ", None),
    ("conjunction", " and ", "plus"), ("conjunction", " and ", "with"), ("conjunction", " und ", None),
    ("conjunction", " et ", None), ("conjunction", " que ", None),
    ("preposition", " of ", "from"), ("preposition", " de ", None), ("preposition", " des ", None),
]
STAND_IN_FILLERS = [" et ", " and ", " und "]
FIRST_PERSON_STAND_IN = "re"
MAX_SENTENCE = 25
TOP_K = 10
MIN_SCRIPTS = 5
# Parts of a stand-in response.
RESPONSE_HEAD = "1. **包装**\n\n*   **视频封面文字**："
RESPONSE_SPOKEN = "\n\n---\n\n2. **口播稿**\n\n"
RESPONSE_CARDS = "\n\n---\n\n3. **卡片**\n"
RESPONSE_CARD = "<CognitiveCard>\n**a**\nb\n</CognitiveCard>\n"
# -----------------------------------------------------------------------------


def stand_in_rules(spark) -> DataFrame:
    return spark.createDataFrame([(c, p, r, None) for c, p, r in STAND_IN_RULES], R.RULES_SCHEMA)


def _docs(spark, d) -> DataFrame:
    return load(spark, d, "documents").select(F.col("doc_id").alias("script_id"), "text")


def q_phrase_hits(spark, d) -> DataFrame:
    return R.phrase_hits(_docs(spark, d), stand_in_rules(spark))


def q_rulebook_scan(spark, d) -> DataFrame:
    """The real rule table over every document."""
    return R.phrase_hits(_docs(spark, d), R.rules_dim(spark))


def q_phrase_hits_index(spark, d) -> DataFrame:
    """Every term (word of eight letters and more) of the benchmark texts as a rule, over every document."""
    words = load(spark, d, "benchmark").select(F.explode(F.split("text", r"[\x20\x09-\x0D]+")).alias("phrase"))
    rules = words.filter(F.length("phrase") >= 8).distinct().select(F.lit("benchmark").alias("rule_class"), "phrase")
    return R.phrase_hits_index(_docs(spark, d), rules)


def q_phrase_suggestions(spark, d) -> DataFrame:
    rules = stand_in_rules(spark)
    s = R.phrase_suggestions(R.phrase_hits(_docs(spark, d), rules), rules)
    return s.select("script_id", "rule_class", "phrase", "n", "suggestions")


def q_strip_fillers(spark, d) -> DataFrame:
    text, n = R.strip_fillers("text", STAND_IN_FILLERS)
    return _docs(spark, d).select("script_id", n.cast("long").alias("n_removed"),
                                  F.length(text).cast("long").alias("n_chars"), F.md5(text).alias("text_md5"))


def q_long_sentences(spark, d) -> DataFrame:
    c = R.long_sentences("_s", MAX_SENTENCE)
    docs = _docs(spark, d).select("script_id", "text", split_sentences("text").alias("_s"))
    return docs.select("script_id", c["n_sent"].cast("long").alias("n_sent"),
                                  c["n_long"].cast("long").alias("n_long"), c["long_share"].alias("long_share"))


def q_info_density(spark, d) -> DataFrame:
    c = R.info_density("text")
    return _docs(spark, d).select("script_id", c["n_numbers"].cast("long").alias("n_numbers"),
                                  c["numbers_per_100"].alias("numbers_per_100"))


def q_style_ratios(spark, d) -> DataFrame:
    c = R.style_ratios("_se", FIRST_PERSON_STAND_IN)
    return R.sentence_arrays(_docs(spark, d)).select("script_id", c["n_sent"].cast("long").alias("n_sent"),
                                  c["question_share"].alias("question_share"),
                                  c["first_person_share"].alias("first_person_share"))


CHECKS = ["no_forbidden", "short_sentences", "has_numbers", "asks_questions"]


def q_scorecard(spark, d) -> DataFrame:
    """All checks of a document come from its own row: one projection."""
    ls = R.long_sentences("_s", MAX_SENTENCE)
    dn = R.info_density("text")
    st = R.style_ratios("_se", FIRST_PERSON_STAND_IN)
    phrases = [p for _, p, _ in STAND_IN_RULES]
    checks = R.sentence_arrays(_docs(spark, d)).select(
        "script_id", (~R.any_phrase(F.col("text"), phrases)).alias("no_forbidden"),
        (ls["n_long"] == 0).alias("short_sentences"), (dn["n_numbers"] > 0).alias("has_numbers"),
        F.coalesce(st["question_share"] > 0, F.lit(False)).alias("asks_questions"))
    return R.scorecard_wide(checks, "script_id", CHECKS)


def q_recurring_phrases(spark, d) -> DataFrame:
    h = R.phrase_hits(_docs(spark, d), stand_in_rules(spark))
    return R.recurring_phrases(h, k=TOP_K).select("rule_class", "phrase", "n_scripts",
                                                  F.col("n_hits").cast("long").alias("n_hits"))


def q_rulebook_candidates(spark, d) -> DataFrame:
    rules = stand_in_rules(spark).select("rule_class", F.trim("phrase").alias("phrase"), "replacement", "limit")
    return R.rulebook_candidates(_docs(spark, d), rules, k=TOP_K)


def q_rulebook_feedback(spark, d) -> DataFrame:
    """Phrases of two to four words that recur over all documents and are no rule yet."""
    return R.rulebook_feedback(_docs(spark, d), stand_in_rules(spark), k=TOP_K, min_scripts=MIN_SCRIPTS).select(
        "phrase", F.col("n_words").cast("long").alias("n_words"), "n_scripts", "n_hits")


def _document_responses(spark, d) -> DataFrame:
    """Stand-in responses: every document as the spoken part of a three-part response,
    its parameters (cover, hashtags, cards, title) cut from its own columns."""
    c = load(spark, d, "documents")
    size = F.length("text")
    mark = lambda test, then: F.when(test, F.lit(then)).otherwise(F.lit(""))
    return c.select(F.col("doc_id").alias("label"), F.concat(
        F.lit(RESPONSE_HEAD), F.substring("text", 1, 8), F.lit("\n*   **吸睛发布标题**：a title"), mark(size < 1000, " 毫无疑问"),
        F.lit("\n*   **5 个高流量精准 Hashtags**："), F.concat(*[F.concat(F.lit(" #"), F.col(x)) for x in ("lang", "lang", "source", "source")]),
        mark(size >= 500, " #me"), F.lit(RESPONSE_SPOKEN), F.col("text"), F.lit(RESPONSE_CARDS),
        F.lit(RESPONSE_CARD), F.lit(RESPONSE_CARD), mark(size >= 300, RESPONSE_CARD), mark(size >= 5000, "<CognitiveCard>")).alias("text"))


def q_response_scorecard(spark, d) -> DataFrame:
    """All nine checks of every response, with the real rule table and its limits."""
    from inkwell.plans import workflows as W
    c = load(spark, d, "documents")
    tags = (c.select(F.col("lang").alias("tag"), F.lit("macro").alias("tag_class")).distinct()
            .unionByName(c.select(F.col("source").alias("tag"), F.lit("vertical").alias("tag_class")).distinct())
            .unionByName(c.select(F.lit("me").alias("tag"), F.lit("identity").alias("tag_class")).distinct()))
    tag_dim = tags.groupBy("tag").agg(F.min("tag_class").alias("tag_class"))
    return W.response_audit(_document_responses(spark, d), R.rules_dim(spark), tag_dim, first_person=FIRST_PERSON_STAND_IN)


QUERIES = {
    "rulebook_feedback": q_rulebook_feedback,
    "response_scorecard": q_response_scorecard,
    "phrase_hits": q_phrase_hits,
    "phrase_hits_index": q_phrase_hits_index,
    "rulebook_scan": q_rulebook_scan,
    "phrase_suggestions": q_phrase_suggestions,
    "strip_fillers": q_strip_fillers,
    "long_sentences": q_long_sentences,
    "info_density": q_info_density,
    "style_ratios": q_style_ratios,
    "scorecard": q_scorecard,
    "recurring_phrases": q_recurring_phrases,
    "rulebook_candidates": q_rulebook_candidates,
}

# ----------------------------------------------------------------- DuckDB SQL


def _q(s):
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


_RULES = "rules(rule_class, phrase, replacement) AS (VALUES " + ", ".join(
    f"({_q(c)}, {_q(p)}, {_q(r)})" for c, p, r in STAND_IN_RULES) + ")"


def _rulebook_values() -> str:
    # phrases of the real rule table that are forbidden (fillers are only deleted)
    rows = []
    for phrases, alts in R.AI_SPEAK_ALTERNATIVES:
        rows += [("ai_speak", p) for p in phrases]
    rows += [("ai_speak", p) for p in R.AI_SPEAK_BANNED]
    rows += [("grand_narrative", p) for p in R.GRAND_NARRATIVE]
    rows += [("textbook", p) for p in R.TEXTBOOK]
    rows += [("clickbait", p) for p in R.CLICKBAIT if p != "崩盘就在明天！"]   # holds a shorter listed phrase
    rows += [("rousing_ending", p) for p in R.ROUSING_ENDING]
    rows = sorted(set(rows))
    return "rb(rule_class, phrase) AS (VALUES " + ", ".join(f"({_q(c)}, {_q(p)})" for c, p in rows) + ")"


_HITS = f"""{_RULES},
ph AS (SELECT DISTINCT rule_class, phrase FROM rules),
hits AS (SELECT * FROM (SELECT d.doc_id AS script_id, p.rule_class, p.phrase,
           CAST((length(d.text) - length(replace(d.text, p.phrase, ''))) // length(p.phrase) AS BIGINT) AS n
         FROM documents d, ph p) WHERE n > 0)"""

_STRIP = rf"'\A{PY_SPACE}+|{PY_SPACE}+\z'"
_SENTS = (f"list_filter(list_transform(regexp_split_to_array(text, '[。！？!?.\\n]'), "
          f"lambda s: regexp_replace(s, {_STRIP}, '', 'g')), lambda s: length(s) > 0)")
_SENTS_END = (f"list_filter(list_transform(regexp_extract_all(text, '[^。！？!?.\\n]+[。！？!?.]?', 0), "
              f"lambda s: regexp_replace(s, {_STRIP}, '', 'g')), lambda s: length(s) > 0)")
_FILL = R.filler_pattern(STAND_IN_FILLERS)

_BASE = f"""
b AS (SELECT doc_id AS script_id, text, {_SENTS} AS s, {_SENTS_END} AS se FROM documents),
m AS (SELECT script_id, len(s) AS n_sent, len(list_filter(s, lambda x: length(x) > {MAX_SENTENCE})) AS n_long,
             len(regexp_extract_all(text, '[0-9]+(\\.[0-9]+)?', 0)) AS n_numbers,
             len(se) AS n_sent_e, len(list_filter(se, lambda x: suffix(x, '?') OR suffix(x, '？'))) AS n_q,
             len(list_filter(se, lambda x: contains(x, '{FIRST_PERSON_STAND_IN}'))) AS n_fp, length(text) AS n_chars
      FROM b)"""

ORACLE = {
    "phrase_hits": f"WITH {_HITS} SELECT * FROM hits",
    "phrase_hits_index": r"""WITH p AS (SELECT DISTINCT phrase FROM (
          SELECT unnest(regexp_split_to_array(text, '[\x20\x09-\x0D]+')) AS phrase FROM benchmark) WHERE length(phrase) >= 8)
        SELECT * FROM (SELECT d.doc_id AS script_id, 'benchmark' AS rule_class, p.phrase,
          CAST((length(d.text) - length(replace(d.text, p.phrase, ''))) // length(p.phrase) AS BIGINT) AS n
          FROM documents d JOIN p ON contains(d.text, p.phrase)) WHERE n > 0""",
    "rulebook_scan": f"""WITH {_rulebook_values()}
        SELECT * FROM (SELECT d.doc_id AS script_id, p.rule_class, p.phrase,
          CAST((length(d.text) - length(replace(d.text, p.phrase, ''))) // length(p.phrase) AS BIGINT) AS n
          FROM documents d, rb p) WHERE n > 0""",
    "phrase_suggestions": f"""WITH {_HITS},
        alts AS (SELECT rule_class, phrase, array_to_string(list_sort(list_distinct(list(replacement))), ' / ') AS suggestions
                 FROM rules WHERE replacement IS NOT NULL GROUP BY rule_class, phrase)
        SELECT h.script_id, h.rule_class, h.phrase, h.n, a.suggestions
        FROM hits h LEFT JOIN alts a ON a.phrase = h.phrase AND a.rule_class = h.rule_class""",
    "strip_fillers": f"""SELECT doc_id AS script_id, CAST(len(regexp_extract_all(text, '{_FILL}', 0)) AS BIGINT) AS n_removed,
        CAST(length(regexp_replace(text, '{_FILL}', '', 'g')) AS BIGINT) AS n_chars,
        md5(regexp_replace(text, '{_FILL}', '', 'g')) AS text_md5 FROM documents""",
    "long_sentences": f"""WITH {_BASE} SELECT script_id, CAST(n_sent AS BIGINT) AS n_sent, CAST(n_long AS BIGINT) AS n_long,
        CASE WHEN n_sent > 0 THEN n_long / n_sent END AS long_share FROM m""",
    "info_density": f"""WITH {_BASE} SELECT script_id, CAST(n_numbers AS BIGINT) AS n_numbers,
        CASE WHEN n_chars > 0 THEN n_numbers * 100.0 / n_chars END AS numbers_per_100 FROM m""",
    "style_ratios": f"""WITH {_BASE} SELECT script_id, CAST(n_sent_e AS BIGINT) AS n_sent,
        CASE WHEN n_sent_e > 0 THEN n_q / n_sent_e END AS question_share,
        CASE WHEN n_sent_e > 0 THEN n_fp / n_sent_e END AS first_person_share FROM m""",
    "scorecard": f"""WITH {_HITS}, {_BASE},
        hs AS (SELECT DISTINCT script_id FROM hits)
        SELECT m.script_id, hs.script_id IS NULL AS no_forbidden, n_long = 0 AS short_sentences,
               n_numbers > 0 AS has_numbers, coalesce(n_sent_e > 0 AND n_q > 0, false) AS asks_questions,
               CAST((hs.script_id IS NULL)::INT + (n_long = 0)::INT + (n_numbers > 0)::INT
                    + coalesce(n_sent_e > 0 AND n_q > 0, false)::INT AS BIGINT) AS n_passed
        FROM m LEFT JOIN hs ON hs.script_id = m.script_id""",
    "recurring_phrases": f"""WITH {_HITS}
        SELECT rule_class, phrase, count(DISTINCT script_id) AS n_scripts, CAST(sum(n) AS BIGINT) AS n_hits FROM hits
        GROUP BY rule_class, phrase ORDER BY n_scripts DESC, n_hits DESC, phrase LIMIT {TOP_K}""",
    "rulebook_candidates": f"""WITH {_RULES},
        w AS (SELECT unnest(regexp_extract_all(lower(text), '[^\\s\\p{{P}}]+', 0)) AS phrase FROM documents),
        c AS (SELECT phrase, count(*) AS n_hits FROM w GROUP BY phrase)
        SELECT phrase, CAST(n_hits AS BIGINT) AS n_hits FROM c
        WHERE phrase NOT IN (SELECT lower(trim(phrase)) FROM rules)
        ORDER BY n_hits DESC, phrase LIMIT {TOP_K}""",
}

_GRAMS = " UNION ALL ".join(
    f"SELECT script_id, list_aggregate(w[i:i + {n - 1}], 'string_agg', ' ') AS phrase, {n} AS n_words "
    f"FROM (SELECT script_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM pieces WHERE len(w) >= {n})" for n in range(1, 5))

ORACLE["rulebook_feedback"] = f"""WITH {_RULES},
    pieces AS (SELECT script_id, regexp_extract_all(p, '[^\\s\\p{{P}}]+', 0) AS w FROM (
        SELECT doc_id AS script_id, unnest(regexp_extract_all(lower(text), '[^。！？!?.\\n]+', 0)) AS p FROM documents)),
    g AS ({_GRAMS}),
    c AS (SELECT phrase, n_words, count(DISTINCT script_id) AS n_scripts, count(*) AS n_hits FROM g GROUP BY ALL
          HAVING count(DISTINCT script_id) >= {MIN_SCRIPTS}),
    inner_ AS (SELECT regexp_replace(phrase, ' [^ ]+$', '') AS phrase, n_scripts, n_hits FROM c WHERE n_words > 1
               UNION SELECT regexp_replace(phrase, '^[^ ]+ ', ''), n_scripts, n_hits FROM c WHERE n_words > 1)
    SELECT c.phrase, CAST(c.n_words AS BIGINT) AS n_words, CAST(c.n_scripts AS BIGINT) AS n_scripts, CAST(c.n_hits AS BIGINT) AS n_hits
    FROM c ANTI JOIN inner_ i ON i.phrase = c.phrase AND i.n_scripts = c.n_scripts AND i.n_hits = c.n_hits
    WHERE c.n_words > 1 AND c.phrase NOT IN (SELECT trim(lower(phrase)) FROM rules)
    ORDER BY n_scripts DESC, n_hits DESC, phrase LIMIT {TOP_K}"""


def _strip(x: str) -> str:
    return f"regexp_replace({x}, {_STRIP}, '', 'g')"


_MARK = lambda test, then: f"CASE WHEN {test} THEN {_q(then)} ELSE '' END"
_LIMIT = dict(R.LIMITS)

ORACLE["response_scorecard"] = f"""WITH {_rulebook_values()},
    resp AS (SELECT doc_id AS label, lang, source, {_q(RESPONSE_HEAD)} || substring(text, 1, 8) || chr(10) || '*   **吸睛发布标题**：a title'
        || {_MARK("length(text) < 1000", " 毫无疑问")} || chr(10) || '*   **5 个高流量精准 Hashtags**：' || ' #' || lang || ' #' || lang
        || ' #' || source || ' #' || source || {_MARK("length(text) >= 500", " #me")} || {_q(RESPONSE_SPOKEN)} || text || {_q(RESPONSE_CARDS)}
        || {_q(RESPONSE_CARD)} || {_q(RESPONSE_CARD)} || {_MARK("length(text) >= 300", RESPONSE_CARD)}
        || {_MARK("length(text) >= 5000", "<CognitiveCard>")} AS response FROM documents),
    cl AS (SELECT *, regexp_replace({_strip("regexp_replace(response, '<CognitiveCard>.*?</CognitiveCard>', '', 'gs')")},
                                    '\\n{{3,}}', chr(10) || chr(10), 'g') AS clean FROM resp),
    pa AS (SELECT *, {_strip("regexp_extract(clean, '视频封面文字[^\\n]*?[：:]([^\\n]*)', 1)")} AS cover,
        regexp_extract_all(regexp_extract(clean, 'Hashtags[^\\n]*?[：:]([^\\n]*)', 1), '#([^\\s#]+)', 1) AS tags,
        {_strip(f"regexp_replace({_strip('regexp_split_to_array(clean, chr(10) || ' + chr(39) + '-{3,}[ ' + chr(92) + 't]*(' + chr(92) + 'n|' + chr(92) + 'z)' + chr(39) + ')[2]')}, '^[0-9]+\\.[^\\n]*\\n', '')")} AS text FROM cl),
    se AS (SELECT label, {_SENTS} AS s, {_SENTS_END} AS se FROM pa),
    dim AS (SELECT tag, min(cls) AS cls FROM (SELECT lang AS tag, 'macro' AS cls FROM documents UNION SELECT source, 'vertical' FROM documents
                                             UNION SELECT 'me', 'identity') GROUP BY tag),
    tg AS (SELECT u.label, string_agg(coalesce(d.cls, 'unknown'), ',' ORDER BY u.pos) AS seq, count(*) AS n
           FROM (SELECT label, generate_subscripts(tags, 1) AS pos, unnest(tags) AS tag FROM pa) u LEFT JOIN dim d ON d.tag = u.tag GROUP BY u.label),
    ch AS (SELECT pa.label, NOT EXISTS (SELECT 1 FROM rb WHERE contains(pa.clean, rb.phrase)) AS no_forbidden,
        len(list_filter(s, lambda x: length(x) > {_LIMIT["max_sentence_chars"]})) = 0 AS short_sentences,
        len(regexp_extract_all(text, '[0-9]+(\\.[0-9]+)?', 0)) > 0 AS has_numbers,
        len(list_filter(se, lambda x: suffix(x, '?') OR suffix(x, '？'))) > 0 AS asks_questions,
        len(list_filter(se, lambda x: contains(x, '{FIRST_PERSON_STAND_IN}'))) > 0 AS first_person,
        length(regexp_replace(cover, '[\\p{{P}}{PY_SPACE[1:-1]}]', '', 'g')) BETWEEN {_LIMIT["cover_min_chars"]} AND {_LIMIT["cover_max_chars"]} AS cover_ok,
        coalesce(tg.n = {_LIMIT["hashtags"]} AND tg.seq = '{",".join(R.HASHTAG_ORDER)}', false) AS hashtags_ok,
        len(regexp_extract_all(response, '<CognitiveCard>.*?</CognitiveCard>', 0, 's')) = {_LIMIT["cards"]} AS cards_ok,
        NOT (contains(clean, '<CognitiveCard>') OR contains(clean, '</CognitiveCard>')) AS no_tag_leak
      FROM pa JOIN se ON se.label = pa.label LEFT JOIN tg ON tg.label = pa.label)
    SELECT *, CAST(no_forbidden::INT + short_sentences::INT + has_numbers::INT + asks_questions::INT + first_person::INT + cover_ok::INT
                   + hashtags_ok::INT + cards_ok::INT + no_tag_leak::INT AS BIGINT) AS n_passed FROM ch"""
