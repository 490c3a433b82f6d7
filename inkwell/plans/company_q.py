"""Company bindings: one company per customer.

The *live* record aggregates the customer's orders of the last 365 days
(relative to the newest order), the *reference* record its older orders;
customers without orders fall to the default record.  Attachments are the
customer's conversation pages (conv_id = c_custkey).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.operators import documents as D
from inkwell.operators import market as M
from inkwell.plans.tables import load

_DEC = "decimal(18,2)"


def _agg(spark, d) -> DataFrame:
    """One aggregation of the orders per (customer, is_live): the live and
    the reference record both read it, so the exchange is computed once."""
    o = load(spark, d, "orders")
    cutoff = F.date_sub(o.select(F.max("o_orderdate")).scalar(), 365)
    dec = F.col("o_totalprice").cast(_DEC)
    zero = F.lit(0).cast(_DEC)
    agg = o.groupBy("o_custkey", (F.col("o_orderdate") > cutoff).alias("is_live")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(dec).cast("double").alias("tot"),
        F.sum(F.when(F.col("o_orderstatus") == "F", dec).otherwise(zero)).cast("double").alias("tot_f"),
        F.sum(F.when(F.col("o_orderstatus") == "O", dec).otherwise(zero)).cast("double").alias("tot_o"),
        # a bounded set (the priority codes): one aggregate, no distinct expansion
        F.size(F.collect_set("o_orderpriority")).alias("n_prio"))
    c = load(spark, d, "customer")
    n = load(spark, d, "nation")
    return agg.join(c, F.col("o_custkey") == F.col("c_custkey")) \
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")


def _records(j: DataFrame, live: bool) -> DataFrame:
    j = j.filter(F.col("is_live") == live)
    return j.select(
        F.col("c_name").alias("ticker"),
        (F.concat(F.col("c_name"), F.lit(" Inc.")) if live else F.lit(None).cast("string")).alias("longName"),
        F.col("c_mktsegment").alias("sector"),
        (F.col("n_name") if live else F.lit(None).cast("string")).alias("industry"),
        F.concat(F.lit("Orders: "), F.col("n").cast("string")).alias("longBusinessSummary"),
        F.col("n").cast("double").alias("trailingPE"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("forwardPE"),
        (F.col("tot") * 1000.0).alias("marketCap"),
        F.try_divide(F.col("tot_f"), F.col("tot")).alias("profitMargins"),
        F.try_divide(F.col("tot_f") - F.col("tot_o"), F.col("tot")).alias("operatingMargins"),
        (F.col("tot") * 100.0).alias("freeCashflow"),
        F.when(F.col("c_acctbal") < 0, -F.col("c_acctbal") * 1e6).otherwise(F.lit(0.0)).alias("totalDebt"),
        F.col("n_prio").cast("double").alias("debtToEquity"))


def _run_ts(spark, d):
    return load(spark, d, "orders").select(F.max("o_orderdate")).scalar()


def _reports(spark, d) -> DataFrame:
    keys = load(spark, d, "customer").select(F.col("c_name").alias("ticker"))
    j = _agg(spark, d)
    rec = M.with_fallback(keys, _records(j, True), _records(j, False), key="ticker")
    keep = ["record_source", "is_fallback"]
    return M.company_report(M.company_metrics(rec, keep), _run_ts(spark, d), keep)


def q_company_reports(spark, d) -> DataFrame:
    return _reports(spark, d).select("ticker", "record_source", "is_fallback", "content")


# Fixed value: description lines that look like metrics and are none.
PROSE = "The segments (Retail): 45 stores in ten states\n股票代码: NONE\n  margin: 5"


def q_report_metrics(spark, d) -> DataFrame:
    from inkwell.plans.market_q import q_macro_report
    comp = _reports(spark, d).select(F.col("ticker").alias("doc_id"), F.concat("content", F.lit(PROSE)).alias("content"))
    macro = q_macro_report(spark, d).select(F.concat(F.lit("MACRO "), F.col("desk").cast("string")).alias("doc_id"), "content")
    p = M.parse_report(comp.unionByName(macro))
    return p.select("doc_id", F.col("pos").cast("long").alias("pos"), "label", "metric", "value", "unit")


def q_report_attachment(spark, d) -> DataFrame:
    rep = _reports(spark, d).join(load(spark, d, "customer").select(F.col("c_name").alias("ticker"), "c_custkey"),
                                  "ticker")
    conv = load(spark, d, "conversations").select(
        F.col("conv_id").alias("c_custkey"), (F.col("turn") + 1).alias("page_no"),
        F.when(F.col("role") == "system", F.lit("")).otherwise(F.col("text")).alias("text"))
    pages = D.assemble_pages(conv, doc="c_custkey", block=4)
    att = pages.select("c_custkey", F.lit("ok").alias("status"), F.col("content").alias("text"))
    out = D.append_attachment(rep.select("ticker", "c_custkey", "content"), att, "c_custkey", "company")
    return out.select("ticker", "attached", F.length("content").cast("long").alias("n_chars"),
                      F.md5("content").alias("content_md5"))


QUERIES = {
    "company_reports": q_company_reports,
    "report_metrics": q_report_metrics,
    "report_attachment": q_report_attachment,
}

# ----------------------------------------------------------------- DuckDB SQL


def _rec_sql(name: str, live: bool) -> str:
    cond = "o_orderdate > cutoff" if live else "o_orderdate <= cutoff"
    return f"""
{name} AS (SELECT c.c_name AS ticker,
    {"c.c_name || ' Inc.'" if live else "CAST(NULL AS VARCHAR)"} AS longName, c.c_mktsegment AS sector,
    {"n.n_name" if live else "CAST(NULL AS VARCHAR)"} AS industry,
    'Orders: ' || CAST(a.n AS VARCHAR) AS longBusinessSummary, CAST(a.n AS DOUBLE) AS trailingPE,
    CASE WHEN c.c_acctbal >= 0 THEN c.c_acctbal END AS forwardPE, a.tot * 1000.0 AS marketCap,
    a.tot_f / nullif(a.tot, 0) AS profitMargins, (a.tot_f - a.tot_o) / nullif(a.tot, 0) AS operatingMargins,
    a.tot * 100.0 AS freeCashflow, CASE WHEN c.c_acctbal < 0 THEN -c.c_acctbal * 1e6 ELSE 0.0 END AS totalDebt,
    CAST(a.n_prio AS DOUBLE) AS debtToEquity
  FROM (SELECT o_custkey, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS tot,
               CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS tot_f,
               CAST(sum(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS tot_o,
               count(DISTINCT o_orderpriority) AS n_prio
        FROM orders, (SELECT max(o_orderdate) - INTERVAL 365 DAY AS cutoff FROM orders) WHERE {cond} GROUP BY o_custkey) a
  JOIN customer c ON c.c_custkey = a.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey)"""


def _fmt(x: str, unit: str = "") -> str:
    return f"printf('%.2f', {x})" + (f" || '{unit}'" if unit else "")


_REPORTS = f"""{_rec_sql('live', True)}, {_rec_sql('ref', False)},
rec AS (SELECT k.c_name AS ticker,
    CASE WHEN l.ticker IS NOT NULL THEN 'live' WHEN r.ticker IS NOT NULL THEN 'reference' ELSE 'default' END AS record_source,
    l.ticker IS NULL AS is_fallback,
    CASE WHEN l.ticker IS NOT NULL THEN l.longName ELSE r.longName END AS longName,
    CASE WHEN l.ticker IS NOT NULL THEN l.sector ELSE r.sector END AS sector,
    CASE WHEN l.ticker IS NOT NULL THEN l.industry ELSE r.industry END AS industry,
    CASE WHEN l.ticker IS NOT NULL THEN l.longBusinessSummary ELSE r.longBusinessSummary END AS summary,
    CASE WHEN l.ticker IS NOT NULL THEN l.trailingPE ELSE r.trailingPE END AS trailingPE,
    CASE WHEN l.ticker IS NOT NULL THEN l.forwardPE ELSE r.forwardPE END AS forwardPE,
    CASE WHEN l.ticker IS NOT NULL THEN l.marketCap ELSE r.marketCap END AS marketCap,
    CASE WHEN l.ticker IS NOT NULL THEN l.profitMargins ELSE r.profitMargins END AS profitMargins,
    CASE WHEN l.ticker IS NOT NULL THEN l.operatingMargins ELSE r.operatingMargins END AS operatingMargins,
    CASE WHEN l.ticker IS NOT NULL THEN l.freeCashflow ELSE r.freeCashflow END AS freeCashflow,
    CASE WHEN l.ticker IS NOT NULL THEN l.totalDebt ELSE r.totalDebt END AS totalDebt,
    CASE WHEN l.ticker IS NOT NULL THEN l.debtToEquity ELSE r.debtToEquity END AS debtToEquity
  FROM customer k LEFT JOIN live l ON l.ticker = k.c_name LEFT JOIN ref r ON r.ticker = k.c_name),
rep AS (SELECT ticker, record_source, is_fallback, concat_ws(chr(10),
    '{M.COMPANY_TITLE}', '股票代码: ' || ticker, '企业全称: ' || coalesce(longName, ticker),
    '行业板块: ' || coalesce(sector, '未知') || ' - ' || coalesce(industry, '未知'),
    '数据抓取时间: ' || strftime((SELECT max(o_orderdate) FROM orders), '%Y-%m-%d %H:%M:%S'),
    '{M.RULE_40}', '{M.COMPANY_CORE}',
    '市值 (Market Cap): ' || {_fmt('coalesce(marketCap, 0.0) / 1e9', ' B USD')},
    '滚动市盈率 (Trailing PE): ' || coalesce(CAST(trailingPE AS VARCHAR), '暂无'),
    '预测市盈率 (Forward PE): ' || coalesce(CAST(forwardPE AS VARCHAR), '暂无'),
    '净利润率 (Profit Margin): ' || {_fmt('coalesce(profitMargins, 0.0) * 100', '%')},
    '营业利润率 (Operating Margin): ' || {_fmt('coalesce(operatingMargins, 0.0) * 100', '%')},
    '自由现金流 (Free Cash Flow): ' || {_fmt('coalesce(freeCashflow, 0.0) / 1e6', ' M USD')},
    '总负债 (Total Debt): ' || {_fmt('coalesce(totalDebt, 0.0) / 1e6', ' M USD')},
    '债务权益比 (Debt to Equity): ' || coalesce(CAST(debtToEquity AS VARCHAR), '暂无'),
    '{M.RULE_40}', '{M.COMPANY_DESC}', coalesce(summary, '{M.NO_SUMMARY}')) || chr(10) AS content FROM rec)"""

_PARSE = r"""
docs AS (SELECT ticker AS doc_id, content || 'The segments (Retail): 45 stores in ten states' || chr(10) || '股票代码: NONE'
                || chr(10) || '  margin: 5' AS content FROM rep UNION ALL SELECT 'MACRO ' || CAST(desk AS VARCHAR), content FROM macro),
ln0 AS (SELECT doc_id, pos, line FROM (SELECT doc_id, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS line
        FROM (SELECT doc_id, string_split(content, chr(10)) AS l FROM docs))),
ln AS (SELECT doc_id, pos, line FROM (
        SELECT *, coalesce(last_value(CASE WHEN line = '【官方业务模式描述】' THEN 1 WHEN line IN ('【美股企业自动抓取财报摘要】',
                  '【全球核心宏观流动性与资产价格实时报告】') THEN 0 END IGNORE NULLS)
                  OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING), 0) AS prose FROM ln0) WHERE prose = 0),
l2 AS (SELECT *, last_value(CASE WHEN regexp_extract(line, '^股票代码: (.*)$', 1) <> '' THEN regexp_extract(line, '^股票代码: (.*)$', 1)
                                 WHEN regexp_extract(line, '^● .* \(([^()]*)\)$', 1) <> '' THEN regexp_extract(line, '^● .* \(([^()]*)\)$', 1) END
                            IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS label,
              regexp_extract(line, '^([^:：]+?) \(([^()]+)\): (.*)$', 2) AS m1,
              regexp_extract(line, '^([^:：]+?) \(([^()]+)\): (.*)$', 3) AS r1,
              regexp_extract(line, '^  ([^:：]+): (.*)$', 1) AS m2,
              regexp_extract(line, '^  ([^:：]+): (.*)$', 2) AS r2 FROM ln),
l3 AS (SELECT doc_id, pos, label, CASE WHEN m1 <> '' THEN m1 WHEN m2 <> '' THEN m2 END AS metric,
              CASE WHEN m1 <> '' THEN r1 WHEN m2 <> '' THEN r2 END AS raw FROM l2),
l4 AS (SELECT *, regexp_extract(raw, '^[+-]?[0-9]+(\.[0-9]+)?', 0) AS num FROM l3 WHERE metric IS NOT NULL)
SELECT doc_id, CAST(pos AS BIGINT) AS pos, label, metric,
       CASE WHEN num <> '' THEN TRY_CAST(num AS DOUBLE) END AS value,
       CASE WHEN num <> '' THEN trim(regexp_replace(raw, '^[+-]?[0-9]+(\.[0-9]+)?', '')) END AS unit
FROM l4"""

from inkwell.plans.market_q import MACRO_CTES  # noqa: E402

ORACLE = {
    "report_metrics": f"WITH {MACRO_CTES}, {_REPORTS}, {_PARSE}",
    "company_reports": f"WITH {_REPORTS} SELECT ticker, record_source, is_fallback, content FROM rep",
    "report_attachment": f"""WITH {_REPORTS},
        p AS (SELECT conv_id, turn + 1 AS page_no, CASE WHEN role = 'system' THEN '' ELSE text END AS text FROM conversations),
        a AS (SELECT conv_id, coalesce(string_agg(CASE WHEN length(text) > 0 THEN '--- 第 ' || CAST(page_no AS VARCHAR)
                     || ' 页 ---' || chr(10) || text || chr(10) END, chr(10) ORDER BY page_no), '') AS t FROM p GROUP BY conv_id),
        j AS (SELECT r.ticker, a.t IS NOT NULL AND length(a.t) > 0 AS attached, r.content, a.t
              FROM rep r JOIN customer c ON c.c_name = r.ticker LEFT JOIN a ON a.conv_id = c.c_custkey),
        o AS (SELECT ticker, attached, CASE WHEN attached THEN content || chr(10) || chr(10) || '=== 附加本地个股企业 PDF 解析内容 ===' || chr(10) || t ELSE content END AS content FROM j)
        SELECT ticker, attached, CAST(length(content) AS BIGINT) AS n_chars, md5(content) AS content_md5 FROM o""",
}
