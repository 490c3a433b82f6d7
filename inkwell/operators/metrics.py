"""Video metrics: parse inline / file metrics (JSON, else header+1-row CSV),
infer scalar types, overlay on defaults, render the overview and grade it.

Precedence per video (as in the reference): a non-empty inline value wins
even when it does not parse; otherwise the file content is tried as a JSON
object first and as CSV second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.fmt import fixed, python_float
from inkwell.functions.text import ustrip

# ---------------------------------------------------------------- fixed values
DEFAULT_METRICS = [("views", "12000"), ("retention_5s", "0.45"), ("completion_rate", "0.18")]
RETENTION_WARN = 0.60
RETENTION_GOOD_TOP = 0.70
LOSS_RED = 0.45
OVERVIEW_TITLE = "# 多模态音频复盘与诊断报告 (物理世界听音反馈)"
# -----------------------------------------------------------------------------

_MAP = "map<string,string>"


def _json(c: Column, type_: str) -> Column:
    """A JSON object as a map; NULL when the text is not one object."""
    whole = F.when(F.rtrim(c).endswith("}"), c)         # the reader would pass over text behind the object
    return F.from_json(whole, type_, {"mode": "PERMISSIVE", "allowSingleQuotes": "false"})


def _csv(c: Column) -> tuple[Column, Column]:
    """Header line and first data line split on ',' (no quoting), cut to the
    shorter one; NULL with fewer than two lines."""
    lines = F.split(F.regexp_replace(c, r"\n\z", ""), "\n")
    hdr = F.split(ustrip(F.get(lines, F.lit(0))), ",")
    val = F.split(ustrip(F.get(lines, F.lit(1))), ",")
    n = F.least(F.size(hdr), F.size(val))
    two = F.size(lines) > 1
    return F.when(two, F.slice(hdr, 1, n)), F.when(two, F.slice(val, 1, n))


def _last_of_each(keys: Column, values: Column) -> Column:
    """The values of the distinct keys; a repeated key counts with its last value."""
    return F.transform(F.array_distinct(keys), lambda k: F.get(
        values, (F.size(keys) - F.array_position(F.reverse(keys), k)).cast("int")))


def _quoted(c: Column) -> Column:
    """A string as JSON text."""
    j = F.to_json(F.array(c))
    return F.substring(j, F.lit(2), F.length(j) - 2)


def parse_metrics(metrics: DataFrame, key: str = "video_id", inline: str = "inline",
                  file_content: str = "file_content") -> DataFrame:
    """(key, source, names, texts, jsons) for every row: the distinct metric
    names in order of appearance, their values as text, and as JSON text of
    the type they had (a nested value stays on one line).

    source ∈ inline / json / csv; ``names`` is empty where nothing parses.
    Row-local: one projection, no shuffle.
    """
    inl = F.nullif(F.col(inline), F.lit(""))
    chosen = metrics.select(F.col(key), inl.isNotNull().alias("_inl"), F.col(file_content).alias("_file"),
                            F.coalesce(inl, F.col(file_content)).alias("_txt"))
    head, first = _csv(F.col("_file"))
    parsed = chosen.select(key, "_inl", "_file", _json(F.col("_txt"), _MAP).alias("_js"),
                           _json(F.col("_txt"), "map<string,variant>").alias("_jv"), head.alias("_h"), first.alias("_c"))
    src = (F.when(F.col("_inl"), F.lit("inline")).when(F.col("_file").isNull(), F.lit(None))
           .when(F.col("_js").isNotNull(), F.lit("json")).otherwise(F.lit("csv")))
    is_json = F.col("_inl") | F.col("_js").isNotNull()
    keys = F.when(is_json, F.map_keys("_js")).otherwise(F.col("_h"))
    texts = F.when(is_json, F.map_values("_js")).otherwise(F.col("_c"))
    typed = F.transform(F.map_values("_jv"), lambda v: F.coalesce(F.to_json(v), F.lit("null")))
    picked = parsed.select(
        key, src.alias("source"), is_json.alias("_is_json"), F.array_distinct(keys).alias("_names"),
        _last_of_each(keys, texts).alias("_texts"),
        F.when(is_json, _last_of_each(F.map_keys("_jv"), typed)).alias("_typed"))

    def rendered(t: Column, i: Column) -> Column:
        num = infer_scalar(t)
        own = F.get(F.col("_typed"), i)
        return F.when(F.col("_is_json"), F.when(own.rlike("^-?[0-9]") & t.rlike("[.eE]"), python_float(t.try_cast("double"))).otherwise(own)) \
            .when(num["kind"] == "float", python_float(num["double_value"])) \
            .when(num["kind"] == "int", num["long_value"].cast("string")).otherwise(_quoted(t))

    none = F.array().cast("array<string>")
    return picked.select(key, "source", F.coalesce("_names", none).alias("names"), F.coalesce("_texts", none).alias("texts"),
                         F.coalesce(F.transform("_texts", rendered), none).alias("jsons"))


def scan_metrics(metrics: DataFrame, key: str = "video_id", inline: str = "inline",
                 file_content: str = "file_content") -> DataFrame:
    """Long table (key, metric, value, source) of the parsed metrics.

    Videos whose inputs do not parse produce no rows (they keep the defaults
    in ``merge_metrics``).
    """
    p = parse_metrics(metrics, key, inline, file_content)
    # explode_outer + filter: a plain explode would make the optimizer infer
    # a size > 0 filter and re-evaluate the parse below the generator
    return (p.select(key, "source", F.explode_outer(F.arrays_zip("names", "texts")).alias("m"))
            .select(key, "source", F.col("m.names").alias("metric"), F.col("m.texts").alias("value"))
            .filter(F.col("metric").isNotNull()))


def infer_scalar(value) -> dict[str, Column]:
    """'.' in the text ⇒ float, else int, else keep the string."""
    v = F.col(value) if isinstance(value, str) else value
    # Java also reads suffixes such as 0.5d; only plain numbers count
    as_double = F.when(v.contains(".") & v.rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"), v.try_cast("double"))
    as_long = F.when(~v.contains("."), v.try_cast("bigint"))
    kind = (F.when(as_double.isNotNull(), F.lit("float")).when(as_long.isNotNull(), F.lit("int"))
            .otherwise(F.lit("string")))
    return {"kind": kind, "long_value": as_long,
            "double_value": F.coalesce(as_double, as_long.cast("double"))}


def merge_metrics(metrics: DataFrame, key: str = "video_id", inline: str = "inline",
                  file_content: str = "file_content") -> DataFrame:
    """Overlay the parsed metrics on the defaults, row by row.

    The three known metrics become numeric columns (a non-numeric value falls
    back to the default); every other key is kept in ``extra`` (map); ``typed``
    lists all (name, JSON text), the known ones first.
    """
    known = dict(DEFAULT_METRICS)
    p = parse_metrics(metrics, key, inline, file_content)
    of = lambda array, k: F.get(array, (F.array_position("names", F.lit(k)) - 1).cast("int"))
    cols = [F.coalesce(infer_scalar(of("texts", k))["double_value"], F.lit(float(v))).alias(k) for k, v in known.items()]
    other = lambda x: ~x["names"].isin(list(known))
    extra = F.map_from_entries(F.transform(F.filter(F.arrays_zip("names", "texts"), other),
                                           lambda x: F.struct(x["names"], x["texts"])))
    typed = F.concat(
        F.array(*[F.struct(F.lit(k).alias("name"), F.coalesce(of("jsons", k), F.lit(v)).alias("json")) for k, v in known.items()]),
        F.transform(F.filter(F.arrays_zip("names", "jsons"), other),
                    lambda x: F.struct(x["names"].alias("name"), x["jsons"].alias("json"))))
    return p.select(key, *cols, extra.alias("extra"), (F.size("names") > 0).alias("parsed"), typed.alias("typed"))


def metrics_json(merged: DataFrame, key: str = "video_id") -> DataFrame:
    """Metrics of each video as JSON for a prompt: four spaces, one key per
    line, values of their own types, non-ASCII kept."""
    lines = F.transform("typed", lambda x: F.concat(F.lit("    "), _quoted(x["name"]), F.lit(": "), x["json"]))
    return merged.select(key, F.concat(F.lit("{\n"), F.array_join(lines, ",\n"), F.lit("\n}")).alias("metrics_json"))


def audit_overview(merged: DataFrame, key: str = "video_id", keep: list[str] | None = None) -> DataFrame:
    """views, retention %, loss % (100 − retention×100), completion %,
    1 decimal each."""
    r = F.col("retention_5s") * 100
    return merged.select(
        key, *(keep or []), F.col("views"),
        fixed(r, 1).alias("retention_pct"),
        fixed(F.lit(100.0) - r, 1).alias("loss_pct"),
        fixed(F.col("completion_rate") * 100, 1).alias("completion_pct"))


def benchmark_grade(retention: Column) -> tuple[Column, Column]:
    """(grade, red): warning under 60 %, good 60–70 %, excellent above;
    red when the loss (1 − retention) is over 45 %."""
    grade = (F.when(retention < RETENTION_WARN, F.lit("warning"))
             .when(retention <= RETENTION_GOOD_TOP, F.lit("good")).otherwise(F.lit("excellent")))
    red = (F.lit(1.0) - retention) > LOSS_RED
    return grade, red


def audit_report(overview: DataFrame, findings: DataFrame, key: str, run_ts: Column) -> DataFrame:
    """Markdown report per key: metrics overview, one section per finding in
    time order, action list.  ``findings``: key, seq, kind, from_s, to_s,
    detail; a key's findings are a short list of merged segments."""
    sec = F.concat(F.lit("### "), F.col("kind"), F.lit(" ("), F.col("from_s"), F.lit(" - "), F.col("to_s"),
                   F.lit(")\n"), F.col("detail"), F.lit("\n\n"))
    act = F.concat(F.col("seq").cast("string"), F.lit(". "), F.col("kind"), F.lit(": "), F.col("from_s"),
                   F.lit(" - "), F.col("to_s"), F.lit("\n"))
    f = findings.groupBy(key).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", sec.alias("s")))), lambda x: x["s"]), "")
        .alias("sections"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", act.alias("a")))), lambda x: x["a"]), "")
        .alias("actions"),
        F.count(F.lit(1)).alias("n_findings"))
    j = overview.join(f, key, "left")
    views = F.col("views").cast("double")
    # a whole number is shown as one
    shown = F.when((views == F.floor(views)) & (F.abs(views) < 2.0 ** 53), F.col("views").cast("long").cast("string")).otherwise(python_float(views))
    content = F.concat(
        F.lit(OVERVIEW_TITLE + "\n\n"),
        F.lit("报告生成时间: "), F.date_format(run_ts, "yyyy-MM-dd HH:mm:ss"), F.lit("\n"),
        F.lit("=" * 72 + "\n\n"),
        F.lit("## 1. 核心表现数据分析 (Metrics Overview)\n"),
        F.lit("*   **本期视频播放量 (Views)**: "), shown, F.lit("\n"),
        F.lit("*   **前 5 秒保留率 (5s Retention)**: "), F.col("retention_pct"), F.lit("% ("), F.col("grade"),
        F.lit(")\n"),
        F.lit("*   **全片完播率 (Completion Rate)**: "), F.col("completion_pct"), F.lit("%\n\n---\n\n"),
        F.lit("## 2. 多模态表达诊断 (Speech & Tone Diagnostics)\n"), F.coalesce("sections", F.lit("")),
        F.lit("---\n\n## 3. 下期迭代优化动作清单 (Action Items for Next Week)\n"), F.coalesce("actions", F.lit("")))
    return j.select(key, F.coalesce("n_findings", F.lit(0)).cast("long").alias("n_findings"),
                    content.alias("content"))
