"""Script quality rules: forbidden phrases, suggestions, fillers, sentence
length, cover length, hashtag matrix, card count, information density,
style ratios, scorecard and rulebook feedback.

Scripts are rows; every check is a row-local expression except the ones
that aggregate over all scripts (feedback, scorecard pivot).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions.text import PY_SPACE, count_literal, split_sentences, ustrip
from inkwell.operators.grams import TEXT_WIDTHS, anchored, gram_filter, passing_grams

# ---------------------------------------------------------------- fixed values
# The rulebook's forbidden phrases by class, with the recommended
# alternatives of the persona's table (several per phrase) and the numeric
# limits.  A trailing "..." of the source is not part of a phrase.
AI_SPEAK_ALTERNATIVES = [
    (["毫无疑问", "不可否认"], ["这背后的核心驱动力其实就一个：...", "大家可以看一下这组数据：..."]),
    (["正如我们所知", "众所周知"], ["如果你长期在一线盯供应链，你会发现...", "行内人其实都明白..."]),
    (["简而言之", "总而言之"], ["说句人话就是...", "把这层皮剥掉，核心其实是..."]),
    (["双刃剑", "硬币的另一面"], ["但这笔交易也有它致命的漏洞：...", "不过这个硬逻辑在一种情况下会失效：..."]),
    (["不仅如此", "值得注意的是"], ["而且更深的一层是...", "这里有个细节大家很容易忽略..."]),
    (["在当今快节奏的世界中"], ["直接切入正题，例如：“今天我们只聊一个大家非常关心的事：...”"]),
    (["通过这种方式，我们可以"], ["这样一来，我们就能...", "这就直接打通了..."]),
]
AI_SPEAK_BANNED = ["毫无疑问", "正如我们所知", "简而言之", "双刃剑", "众所周知", "拉开序幕", "总而言之"]
AI_SPEAK_REPLACEMENTS = ["说句人话", "这里有个死逻辑", "大家看这组数"]
GRAND_NARRATIVE = ["在变幻莫测的全球资本风暴中", "让我们共同见证", "拉开了宏伟的序幕"]
TEXTBOOK = ["倒挂利差的定义是什么", "网络效应在经济学上指的是"]
CLICKBAIT = ["惊天大爆料！", "看完吓出一身冷汗", "崩盘就在明天！", "这个行业彻底完了", "再不买就晚了", "崩盘就在明天"]
ROUSING_ENDING = ["让我们在这个不确定的世界里共同寻找财富"]
FILLERS = ["那么", "然后", "其实", "也就是说"]
LIMITS = [("max_sentence_chars", 25), ("cover_min_chars", 6), ("cover_max_chars", 8),
          ("hashtags", 5), ("cards", 3)]
HASHTAG_ORDER = ["macro", "macro", "vertical", "vertical", "identity"]
QUESTION_MARKS = ["?", "？"]
FIRST_PERSON = "我"
# -----------------------------------------------------------------------------

RULES_SCHEMA = "rule_class string, phrase string, replacement string, limit int"


def rules_dim(spark: SparkSession) -> DataFrame:
    """The rule table (rule_class, phrase, replacement, limit)."""
    rows: list = []
    seen = set()
    for phrases, alts in AI_SPEAK_ALTERNATIVES:
        for p in phrases:
            seen.add(p)
            rows += [("ai_speak", p, a, None) for a in alts]
    for p in AI_SPEAK_BANNED:
        if p not in seen:
            rows += [("ai_speak", p, a, None) for a in AI_SPEAK_REPLACEMENTS]
    rows += [("grand_narrative", p, None, None) for p in GRAND_NARRATIVE]
    rows += [("textbook", p, None, None) for p in TEXTBOOK]
    # a phrase that holds another one of its class would count twice
    shortest = [p for p in dict.fromkeys(CLICKBAIT) if not any(q != p and q in p for q in CLICKBAIT)]
    rows += [("clickbait", p, None, None) for p in shortest]
    rows += [("rousing_ending", p, None, None) for p in ROUSING_ENDING]
    rows += [("filler", p, None, None) for p in FILLERS]
    rows += [("limit", name, None, v) for name, v in LIMITS]
    return spark.createDataFrame(rows, RULES_SCHEMA)


# ------------------------------------------------------------------------ R-1

# Classes whose phrases a script must not hold; fillers are only deleted.
FORBIDDEN_CLASSES = ("ai_speak", "grand_narrative", "textbook", "clickbait", "rousing_ending")
NOT_FORBIDDEN = ("limit", "filler")


def phrase_hits(scripts: DataFrame, rules: DataFrame, key: str = "script_id", text: str = "text") -> DataFrame:
    """(key, rule_class, phrase, n) for every forbidden phrase found n > 0
    times (non-overlapping literal occurrences, like ``str.count``).

    For rulebooks: the rule table, a dimension, is one array (scalar subquery)
    that each script counts row-locally; ``phrase_hits_index`` takes large ones.  No join, no
    shuffle of the scripts, nothing runs while the plan is built.
    """
    listed = rules.filter(~F.col("rule_class").isin(*NOT_FORBIDDEN) & (F.length("phrase") > 0)).agg(
        F.array_sort(F.collect_set(F.struct("rule_class", "phrase")))).scalar()
    t = F.col("_t")
    counted = F.transform(F.col("_rules"), lambda p: F.struct(
        p["rule_class"].alias("rule_class"), p["phrase"].alias("phrase"),
        ((F.length(t) - F.length(F.replace(t, p["phrase"], F.lit("")))) / F.length(p["phrase"])).cast("long").alias("n")))
    return (scripts.select(F.col(key), F.col(text).alias("_t"), listed.alias("_rules"))
            .select(F.col(key), F.inline(F.filter(counted, lambda h: h["n"] > 0))))


def _occurrences():
    """(text, phrases) -> how often each phrase occurs in the text, like ``str.count``.

    Array functions of Spark are interpreted and measure the text anew for every phrase.
    """
    def counts(texts, phrases):
        import pandas as pd
        return pd.Series([[t.count(p) for p in ps] if t else [0] * len(ps) for t, ps in zip(texts, phrases)])

    counts.__annotations__ = {}
    return F.pandas_udf(counts, "array<long>", F.PandasUDFType.SCALAR)


def phrase_hits_index(scripts: DataFrame, rules: DataFrame, key: str = "script_id", text: str = "text") -> DataFrame:
    """(key, rule_class, phrase, n) for every forbidden phrase found n > 0
    times (non-overlapping literal occurrences, like ``str.count``).

    The same rows as ``phrase_hits`` for rule tables of any size: texts and phrases
    meet on the phrases' rarest grams (``grams``, rows without the
    text), the candidates of a text are counted on the text, and classes come back by
    phrase.  No table of rules is held by the driver or carried by every row.  A text
    sends only the grams that phrases may be filed under: the phrases are filed while the plan
    is built, for the filter.
    """
    listed = rules.filter(~F.col("rule_class").isin(*NOT_FORBIDDEN) & (F.length("phrase") > 0)).select("rule_class", "phrase").distinct()
    t = F.col(text)
    filed = anchored(listed, "phrase", TEXT_WIDTHS)
    grams = passing_grams(scripts.select(F.col(key).alias("_key"), t.alias("_text")), "_key", "_text", gram_filter(filed))
    candidates = grams.join(filed, "gram").groupBy("_key").agg(F.collect_set("phrase").alias("_phrases"))
    own = scripts.select(F.col(key), t.alias("_t"))
    counted = own.join(candidates, own[key].eqNullSafe(candidates["_key"])).select(F.col(key), "_phrases", _occurrences()("_t", "_phrases").alias("_n"))
    hits = F.filter(F.arrays_zip("_phrases", "_n"), lambda h: h["_n"] > 0)
    found = counted.select(F.col(key), F.inline(hits)).withColumnsRenamed({"_phrases": "phrase", "_n": "n"})
    return found.join(listed, "phrase").select(key, "rule_class", "phrase", "n")


def phrase_suggestions(hits: DataFrame, rules: DataFrame, key: str = "script_id") -> DataFrame:
    """Attach the sorted alternatives of every hit phrase (advice only)."""
    alts = rules.filter(F.col("replacement").isNotNull()).groupBy("rule_class", "phrase") \
        .agg(F.array_join(F.sort_array(F.collect_set("replacement")), " / ").alias("suggestions"))
    return hits.join(alts, ["rule_class", "phrase"], "left")


def regex_literal(s: str) -> str:
    """Escape the metacharacters shared by Java regex and RE2."""
    return re.sub(r"([.^$*+?()\[\]{}|\\])", r"\\\1", s)


def filler_pattern(fillers: list[str]) -> str:
    return "|".join(regex_literal(f) for f in sorted(fillers, key=lambda x: (-len(x), x)))


def strip_fillers(text, fillers: list[str] = FILLERS) -> tuple[Column, Column]:
    """(text without the filler words, number removed)."""
    pat = filler_pattern(fillers)
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(t, pat, ""), F.size(F.regexp_extract_all(t, F.lit(pat), 0))


# ------------------------------------------------------------------------ R-4

def sentence_arrays(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Project the two sentence arrays once (``_s``: split on sentence ends;
    ``_se``: sentences with their end mark).  Higher-order functions are
    evaluated without codegen, so every metric reads these columns instead
    of re-splitting; Catalyst keeps the projection because the arrays are
    referenced several times."""
    keep = keep if keep is not None else [c for c in df.columns if c != text]
    # one regex pass: the pieces with their end mark; the split form is the
    # same pieces without the mark (a piece holds no mark but its last char)
    raw = df.select(*keep, F.col(text),
                    F.regexp_extract_all(F.col(text), F.lit(SENTENCE_WITH_END), 0).alias("_raw"))
    se = F.filter(F.transform("_raw", lambda x: ustrip(x)), lambda x: F.length(x) > 0)
    ends = list(SENTENCE_MARKS)
    s_ = F.filter(F.transform("_raw", lambda x: ustrip(F.coalesce(_drop_last_mark(x, ends), x))),
                  lambda x: F.length(x) > 0)
    return raw.select(*keep, F.col(text), s_.alias("_s"), se.alias("_se"))


def _drop_last_mark(x: Column, ends: list[str]) -> Column:
    return F.when(F.substring(x, -1, 1).isin(ends), F.substring(x, F.lit(1), F.length(x) - 1))


def long_sentences(text, max_len: int = 25) -> dict[str, Column]:
    """Sentence counts; pass the ``_s`` column of ``sentence_arrays`` as
    ``text`` to reuse a split, or a text column to split here."""
    s = F.col("_s") if isinstance(text, str) and text == "_s" else split_sentences(text)
    n = F.size(s)
    n_long = F.size(F.filter(s, lambda x: F.length(x) > max_len))
    return {"n_sent": n, "n_long": n_long,
            "long_share": F.when(n > 0, n_long / n)}


# ------------------------------------------------------------------- R-5 / R-6

COVER_DROP = r"[\p{P}" + PY_SPACE[1:-1] + "]"


def cover_length(cover: Column, lo: int = 6, hi: int = 8) -> tuple[Column, Column]:
    """Letters/Han count of a cover line (punctuation and space dropped)."""
    n = F.length(F.regexp_replace(cover, COVER_DROP, ""))
    return n, n.between(lo, hi)


def hashtag_matrix(tags: DataFrame, key: str, tag_dim: DataFrame, order: list[str] = HASHTAG_ORDER) -> DataFrame:
    """Per response: tag counts by class and whether the 5-tag matrix is
    met in order.  ``tags``: key, tags array; ``tag_dim``: tag, tag_class
    (a vocabulary-sized dimension)."""
    # outer: a response without tags keeps its row (no tag, not ok)
    u = tags.select(key, F.posexplode_outer("tags").alias("pos", "tag"))
    c = u.join(tag_dim, "tag", "left") \
        .withColumn("cls", F.when(F.col("pos").isNotNull(), F.coalesce("tag_class", F.lit("unknown"))))
    seq = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "cls")))), lambda x: x["cls"]), ",")
    cnt = lambda k: F.count(F.when(F.col("cls") == k, 1)).alias(f"n_{k}")
    a = c.groupBy(key).agg(F.count("pos").alias("n_tags"), cnt("macro"), cnt("vertical"), cnt("identity"),
                           cnt("unknown"), seq.alias("class_seq"))
    want = ",".join(order)
    return a.withColumn("order_ok", F.col("class_seq") == want) \
        .withColumn("ok", (F.col("n_tags") == len(order)) & (F.col("class_seq") == want))


# ------------------------------------------------------------------ R-7 .. R-10

def card_count(text, tag: str = "CognitiveCard", expected: int = 3) -> tuple[Column, Column]:
    from inkwell.operators.documents import tag_pattern
    t = F.col(text) if isinstance(text, str) else text
    n = F.size(F.regexp_extract_all(t, F.lit(tag_pattern(tag)), 1))
    return n, n == expected


NUMBER = r"[0-9]+(\.[0-9]+)?"


def info_density(text) -> dict[str, Column]:
    """Number tokens and number tokens per 100 characters."""
    t = F.col(text) if isinstance(text, str) else text
    n = F.size(F.regexp_extract_all(t, F.lit(NUMBER), 0))
    ln = F.length(t)
    return {"n_numbers": n, "numbers_per_100": F.when(ln > 0, n * 100.0 / ln)}


SENTENCE_MARKS = "。！？!?."
SENTENCE_WITH_END = r"[^。！？!?.\n]+[。！？!?.]?"


def style_ratios(text, first_person: str = FIRST_PERSON) -> dict[str, Column]:
    """Share of sentences that ask a question; share holding the first-person
    token."""
    if isinstance(text, str) and text == "_se":
        sents = F.col("_se")
    else:
        t = F.col(text) if isinstance(text, str) else text
        sents = F.filter(F.transform(F.regexp_extract_all(t, F.lit(SENTENCE_WITH_END), 0), lambda x: ustrip(x)),
                         lambda x: F.length(x) > 0)
    n = F.size(sents)
    q = F.size(F.filter(sents, lambda x: x.endswith(QUESTION_MARKS[0]) | x.endswith(QUESTION_MARKS[1])))
    fp = F.size(F.filter(sents, lambda x: x.contains(first_person)))
    return {"n_sent": n, "question_share": F.when(n > 0, q / n), "first_person_share": F.when(n > 0, fp / n)}


# ------------------------------------------------------------------ R-11 / R-12

def scorecard(checks: DataFrame, key: str, names: list[str]) -> DataFrame:
    """``checks``: key, check, passed → one row per key, a column per check
    and the number passed."""
    p = checks.groupBy(key).pivot("check", names).agg(F.max(F.col("passed").cast("int")))
    cols = [F.coalesce(F.col(n), F.lit(0)).cast("boolean").alias(n) for n in names]
    out = p.select(key, *cols)
    total = sum((F.col(n).cast("int") for n in names), F.lit(0))
    return out.withColumn("n_passed", total.cast("long"))


def scorecard_wide(df: DataFrame, key: str, names: list[str]) -> DataFrame:
    """Checks computed on the same row (boolean columns ``names``): no
    union, no pivot, no shuffle — one projection."""
    total = sum((F.coalesce(F.col(n), F.lit(False)).cast("int") for n in names), F.lit(0))
    return df.select(key, *[F.coalesce(F.col(n), F.lit(False)).alias(n) for n in names],
                     total.cast("long").alias("n_passed"))


def any_phrase(text, phrases: list[str]) -> Column:
    """True when any phrase occurs in the text: one regex search that stops
    at the first hit (equivalent to ``phrase_total(...) > 0``)."""
    from inkwell.functions.text import quote_literal
    pat = "|".join(quote_literal(p) for p in dict.fromkeys(phrases))
    t = F.col(text) if isinstance(text, str) else text
    return t.rlike(pat) if phrases else F.lit(False)


def phrase_total(text, phrases: list[str]) -> Column:
    """Total occurrences of all phrases in a text (inline counts)."""
    return sum((count_literal(text, p) for p in dict.fromkeys(phrases)), F.lit(0).cast("long"))


def recurring_phrases(hits: DataFrame, key: str = "script_id", k: int = 10) -> DataFrame:
    """The k phrases hit in most scripts (then most often), over all scripts."""
    g = hits.groupBy("rule_class", "phrase").agg(F.count(F.lit(1)).alias("n_scripts"),
                                                 F.sum("n").alias("n_hits"))
    return g.orderBy(F.col("n_scripts").desc(), F.col("n_hits").desc(), "phrase").limit(k)


def rulebook_candidates(scripts: DataFrame, rules: DataFrame, text: str = "text", k: int = 10,
                        token: str = r"[^\s\p{P}]+") -> DataFrame:
    """Most frequent tokens over all scripts that the rulebook does not list
    yet (word count with map-side combine, anti join on the phrase)."""
    words = scripts.select(F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(token), 0)).alias("phrase"))
    counts = words.groupBy("phrase").agg(F.count(F.lit(1)).alias("n_hits"))
    known = rules.select(F.lower("phrase").alias("phrase")).distinct()
    return counts.join(known, "phrase", "left_anti") \
        .orderBy(F.col("n_hits").desc(), "phrase").limit(k)


TOKEN = r"[^\s\p{P}]+"
# What ends a sentence (as in SENTENCE_WITH_END).
SENTENCE_BREAKS = "。！？!?.\n"
# Bits of the filters that say which phrases may be frequent and which keys may come twice, and words counted in one go.
FILTER_BITS = 1 << 24
CHUNK_WORDS = 1_000_000

_GRAM_COUNTS = "part string, phrase string, n_words int, scripts long, hits long"


def _filter_bits(values: DataFrame, column: str) -> bytes:
    """A bit per slot that a value's crc32 falls in: 2 MB, whatever the number of values."""
    import numpy as np
    slot = F.crc32(F.encode(F.col(column), "UTF-8")).bitwiseAND(F.lit(FILTER_BITS - 1))
    rows = (values.select(slot.alias("slot")).groupBy(F.shiftright("slot", 5).cast("int").alias("at"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 31 as int))")).alias("bits")).toArrow())
    words = np.zeros(FILTER_BITS // 32, "<u4")
    words[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return words.tobytes()


def _count_grams(wanted: tuple[int, ...], filters: dict[int, bytes], marks: frozenset[str]):
    """Counts of the phrases of ``wanted`` lengths, added up within a chunk of scripts.

    ``words`` are a script's words, null after each sentence or marks in between.  A phrase is counted where the filters have both of its parts that are a word shorter, and itself.
    A script whose key may come again has rows of its own (``part``).
    """
    most, n_bits, chunk_words = max(wanted), FILTER_BITS, CHUNK_WORDS

    def run(batches):
        from zlib import crc32

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        bits = {n: np.frombuffer(f, np.uint8) for n, f in filters.items()}

        def kept(n, phrases):
            if n not in bits:
                return np.ones(len(phrases), bool)
            slot = np.fromiter((crc32(x.encode("utf-8", "surrogatepass")) for x in phrases), np.int64, len(phrases)) & (n_bits - 1)
            return (bits[n][slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)

        def counted(n, phrases, code, row, parts, copies):
            """One row per phrase for all scripts without a part, one per phrase and script for the others."""
            at, hits = np.unique(row * np.int64(len(phrases)) + code, return_counts=True)
            code, row = at % len(phrases), at // len(phrases)
            if n == 1:
                hits = hits * copies[row]
            own = np.array([x is not None for x in parts], bool)[row]
            scripts = np.bincount(code[~own], minlength=len(phrases))
            total = np.bincount(code[~own], hits[~own], minlength=len(phrases)).astype(np.int64)
            seen = np.nonzero(scripts)[0]
            names = [phrases[i] for i in seen] + [phrases[i] for i in code[own]]
            return pa.RecordBatch.from_arrays(
                [pa.array([None] * len(seen) + [parts[i] for i in row[own]], pa.string()), pa.array(names, pa.string()),
                 pa.array(np.full(len(names), n, np.int32)),
                 pa.array(np.concatenate([scripts[seen], np.ones(int(own.sum()), np.int64)]).astype(np.int64)),
                 pa.array(np.concatenate([total[seen], hits[own]]).astype(np.int64))],
                names=["part", "phrase", "n_words", "scripts", "hits"])

        def grams(column, sizes, parts, copies):
            encoded = column.flatten().dictionary_encode()
            words = encoded.dictionary.to_pylist()
            word = pc.fill_null(encoded.indices, -1).to_numpy().astype(np.int64)
            script = np.repeat(np.arange(len(sizes)), sizes)
            if marks:
                word = np.where(np.array([x in marks for x in words] + [True])[word], -1, word)
            pos = np.nonzero(word >= 0)[0]
            code, phrases = word[pos], words
            for n in range(1, most + 1):
                if n > 1:
                    # the next phrase begins one word on, in the same sentence: both parts of the longer one are there
                    i = np.nonzero((pos[1:] == pos[:-1] + 1) & (script[pos[1:]] == script[pos[:-1]]))[0]
                    pos, pair = pos[i], code[i] * np.int64(len(words)) + word[pos[i] + n - 1]
                    found, code = np.unique(pair, return_inverse=True)
                    phrases = [f"{phrases[a]} {words[b]}" for a, b in zip((found // max(1, len(words))).tolist(),
                                                                         (found % max(1, len(words))).tolist(), strict=True)]
                good = kept(n, phrases)
                if not good.all():
                    stays = good[code]
                    pos, code = pos[stays], (np.cumsum(good) - 1)[code[stays]]
                    phrases = [x for x, g in zip(phrases, good.tolist(), strict=True) if g]
                if not len(pos):
                    return
                if n in wanted:
                    yield counted(n, phrases, code, script[pos], parts, copies)

        for batch in batches:
            column, parts, copies = batch.column("words"), batch.column("part").to_pylist(), batch.column("copies").to_numpy()
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy().astype(np.int64)
            ends = [*(np.nonzero(np.diff(np.cumsum(sizes) // chunk_words))[0] + 1).tolist(), len(sizes)]
            for a, b in zip([0, *ends], ends, strict=False):
                yield from grams(column.slice(a, b - a), sizes[a:b], parts[a:b], copies[a:b])

    return run


def _phrase_counts(words: DataFrame, wanted: tuple[int, ...], filters: dict[int, bytes], min_scripts: int, token: str) -> DataFrame:
    """``phrase, n_words, n_scripts, n_hits`` of the phrases that stand in at least ``min_scripts`` scripts."""
    rows = words.mapInArrow(_count_grams(wanted, filters, frozenset(SENTENCE_BREAKS if token == TOKEN else "")), _GRAM_COUNTS)
    return (rows.groupBy("part", "n_words", "phrase").agg(F.sum("scripts").alias("scripts"), F.sum("hits").alias("hits"))
            .groupBy("n_words", "phrase").agg(F.sum(F.when(F.col("part").isNull(), F.col("scripts")).otherwise(1)).alias("n_scripts"),
                                              F.sum("hits").alias("n_hits"))
            .filter(F.col("n_scripts") >= min_scripts).select("phrase", "n_words", "n_scripts", "n_hits"))


def _script_words(scripts: DataFrame, key: str, text: str, token: str) -> DataFrame:
    """``part, copies, words array<string>``: ``part`` names the key where it may come again; the words of a
    sentence are followed by null, or those of all sentences have the marks between them as elements.

    A text that comes again under its key is one row with its ``copies``: its words count as often
    as they come, its longer phrases once.
    """
    lower = F.lower("text")
    if token == TOKEN:                  # such tokens hold no mark: one pass finds both
        words = F.regexp_extract_all(lower, F.lit(f"{TOKEN}|[{SENTENCE_BREAKS}]"), F.lit(0))
    else:
        words = F.flatten(F.transform(F.regexp_extract_all(lower, F.lit(SENTENCE_WITH_END), F.lit(0)), lambda s: F.concat(
            F.regexp_extract_all(s, F.lit(token), F.lit(0)), F.array(F.lit(None).cast("string")))))
    name = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))
    named = scripts.select(name.alias("name"), F.col(text).alias("text"))
    found = named.select(F.lit(None).cast("string").alias("part"), F.lit(1).cast("long").alias("copies"), "text")
    repeated = named.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not repeated.isEmpty():
        twice = _may_be_in(_filter_bits(repeated, "name"))("name")
        again = named.filter(twice).groupBy("name", "text").agg(F.count(F.lit(1)).alias("copies"))
        found = (named.filter(~twice).select(F.lit(None).cast("string").alias("part"), F.lit(1).cast("long").alias("copies"), "text")
                .unionByName(again.select(F.col("name").alias("part"), "copies", "text")))
    return found.select("part", "copies", words.alias("words"))


def _may_be_in(bits: bytes):
    n_bits = FILTER_BITS

    def may(values):
        from zlib import crc32

        import pandas as pd
        return pd.Series([bool(bits[(c := crc32(v.encode()) & (n_bits - 1)) >> 3] >> (c & 7) & 1) for v in values])

    may.__annotations__ = {}
    return F.pandas_udf(may, "boolean", F.PandasUDFType.SCALAR)


def frequent_phrases(scripts: DataFrame, key: str = "script_id", text: str = "text", min_scripts: int = 2, max_words: int = 4,
                     token: str = TOKEN) -> DataFrame:
    """Phrases of 1 to ``max_words`` tokens that stand in at least ``min_scripts``
    scripts, within a sentence: phrase, n_words, n_scripts, n_hits.

    Level by level: a phrase of n words is only counted where its first and its
    last n - 1 words may be frequent.  What may be frequent is a filter of a fixed
    size (``FILTER_BITS``) that goes to the tasks, so neither texts nor places are
    shuffled, only counts that are added up within a task's scripts; the
    frequencies themselves are exact.  The levels below the longest are counted
    while the plan is built, for their filters.  Only closed phrases are returned:
    none that a phrase one word longer holds with the same number of scripts and
    of hits.
    """
    words = _script_words(scripts, key, text, token)
    filters: dict[int, bytes] = {}
    for n in range(1, max_words):
        filters[n] = _filter_bits(_phrase_counts(words, (n,), filters, min_scripts, token), "phrase")
    found = _phrase_counts(words, tuple(range(1, max_words + 1)), filters, min_scripts, token)
    # a phrase beside the phrases that its longer neighbours hold: one pass over what was found
    shorter = F.when(F.col("n_words") > 1, F.array(*[F.struct(F.regexp_replace("phrase", p, "").alias("phrase"), F.lit(None).cast("int").alias("n_words"))
                                                     for p in (" [^ ]+$", "^[^ ]+ ")])).otherwise(F.array())
    both = found.select(F.inline(F.concat(F.array(F.struct("phrase", "n_words")), shorter)), "n_scripts", "n_hits")
    return (both.groupBy("phrase", "n_scripts", "n_hits").agg(F.count(F.lit(1)).alias("n"), F.max("n_words").alias("n_words"))
            .filter("n = 1 and n_words is not null").select("phrase", "n_words", "n_scripts", "n_hits"))


# Words whose pairs give the bound on the best phrases (any will do; the more, the closer the bound).
BOUND_WORDS = 1000


def scripts_of_the_best(scripts: DataFrame, n: int, key: str = "script_id", text: str = "text", min_scripts: int = 2,
                        token: str = TOKEN) -> int:
    """A number of scripts that at least ``n`` pairs of words reach, ``min_scripts`` at least: the ``n``-th
    largest count among the pairs of the words that stand in most scripts."""
    words = _script_words(scripts, key, text, token)
    spread = (_phrase_counts(words, (1,), {}, min_scripts, token).orderBy(F.col("n_scripts").desc(), "phrase").limit(BOUND_WORDS))
    pairs = _phrase_counts(words, (2,), {1: _filter_bits(spread, "phrase")}, min_scripts, token)
    best = pairs.orderBy(F.col("n_scripts").desc()).limit(n).agg(F.count(F.lit(1)).alias("n"), F.min("n_scripts").alias("least")).first()
    return best["least"] if n and best["n"] == n else min_scripts


def rulebook_feedback(scripts: DataFrame, rules: DataFrame, key: str = "script_id", text: str = "text", k: int = 10,
                      min_scripts: int = 2, max_words: int = 4) -> DataFrame:
    """The ``k`` phrases of two words and more that stand in most scripts (then most
    often) and that the rulebook does not list yet.

    Every frequent pair of words lies in a closed phrase that stands in as many
    scripts, and a phrase holds at most ``max_words - 1`` pairs.  So where
    (k + listed phrases) * (max_words - 1) pairs stand in s scripts, k phrases that
    are not listed do, too, and phrases in fewer scripts are not among the k.
    """
    known = rules.select(F.trim(F.lower("phrase")).alias("phrase")).distinct()
    pairs = (k + known.filter(F.col("phrase").contains(" ")).count()) * max(1, max_words - 1)
    least = max(min_scripts, scripts_of_the_best(scripts, pairs, key, text, min_scripts))
    return (frequent_phrases(scripts, key, text, least, max_words).filter("n_words > 1").join(known, "phrase", "left_anti")
            .orderBy(F.col("n_scripts").desc(), F.col("n_hits").desc(), "phrase").limit(k))
