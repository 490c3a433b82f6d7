"""Market data: daily closes, last-two-close change, quote fallback,
company metrics and the rendered company / macro reports.

The reference fetches one symbol after the other; here every symbol is a
group key and the whole universe is one job.
"""

from __future__ import annotations

import decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.functions.fmt import MISSING, fixed, raw_or_missing, signed
from inkwell.functions.text import epoch_micros

# ---------------------------------------------------------------- fixed values
# Report layout strings of the company and macro reports.
RULE_40 = "-" * 40
RULE_72 = "=" * 72
COMPANY_TITLE = "【美股企业自动抓取财报摘要】"
COMPANY_CORE = "【财务核心指标】"
COMPANY_DESC = "【官方业务模式描述】"
COMPANY_LABELS = {
    "ticker": "股票代码", "name": "企业全称", "sector": "行业板块", "time": "数据抓取时间",
    "cap": "市值 (Market Cap)", "pe": "滚动市盈率 (Trailing PE)", "fpe": "预测市盈率 (Forward PE)",
    "pm": "净利润率 (Profit Margin)", "om": "营业利润率 (Operating Margin)",
    "fcf": "自由现金流 (Free Cash Flow)", "debt": "总负债 (Total Debt)",
    "de": "债务权益比 (Debt to Equity)",
}
UNKNOWN = "未知"
NO_SUMMARY = "暂无公司业务摘要。"
MACRO_TITLE = "【全球核心宏观流动性与资产价格实时报告】"
MACRO_PRICE = "  最新价格/数值: "
MACRO_CHANGE = "  日内涨跌幅: "
MACRO_FOOTER_TITLE = "【前线微观供应链与生活体感观察提示】"
MACRO_FOOTER = [
    "1. 目前高利率（^TNX 高企）对实体经济的渗透开始进入实质性磨损期，罗素2000（^RUT）与科技股指数（^SOX）出现估值分化。",
    "2. 铜价 (HG=F) 维持在高位，暗示尽管美债利率高压，底层的制造业和AI基础设施用铜需求依然强韧。",
    "3. 油价 (CL=F) 回落，卡车柴油现货价格下行，说明北美商品物流在经历去库存后的软着陆。",
    "4. 加密资产 BTC-USD 与 ETH-USD 的大涨，反映了美元高息压力下，场外高风险流动性向另类原生资产的高速溢出。",
]
# The yield symbols shown as a percentage with three decimals below 100.
YIELD_SYMBOLS = ["^TNX", "^FVX"]
# Fixed value: the default 12-symbol macro dimension (order matters).
MACRO_SYMBOLS = [
    ("^TNX", "美国10年期国债收益率 (US 10Y Yield)"),
    ("^FVX", "美国5年期中短期国债收益率 (US 5Y Yield)"),
    ("DX-Y.NYB", "美元指数 (US Dollar Index)"),
    ("^VIX", "恐慌指数 (CBOE Volatility Index)"),
    ("GC=F", "黄金期货价格 (Gold Futures)"),
    ("BTC-USD", "比特币价格 (Bitcoin USD)"),
    ("ETH-USD", "以太坊价格 (Ethereum USD)"),
    ("CL=F", "WTI原油期货价格 (Crude Oil)"),
    ("HG=F", "铜期货价格 (Copper Futures)"),
    ("^SOX", "费城半导体指数 (PHLX Semiconductor)"),
    ("^RUT", "罗素2000小盘股指数 (Russell 2000)"),
    ("CNY=X", "美元兑人民币汇率 (USD/CNY)"),
]
# -----------------------------------------------------------------------------


def macro_dim(spark) -> DataFrame:
    """The default symbol dimension (ord, symbol, description, is_yield)."""
    rows = [(i + 1, s, d, s in YIELD_SYMBOLS) for i, (s, d) in enumerate(MACRO_SYMBOLS)]
    return spark.createDataFrame(rows, "ord int, symbol string, description string, is_yield boolean")


def recent_prices(prices: DataFrame, ts: str = "ts", days: int = 5) -> DataFrame:
    """The prices of the last ``days`` days up to the newest one.  The bound is
    one scalar subquery on the raw timestamps, so the filter reaches the scan."""
    first = F.date_sub(F.to_date(F.max(ts)), days - 1).cast(prices.schema[ts].dataType)
    return prices.filter(F.col(ts) >= prices.select(first).scalar())


def daily_closes(prices: DataFrame, symbol: str = "symbol", ts: str = "ts",
                 close: str = "close", tiebreak: str | None = None) -> DataFrame:
    """One close per (symbol, day): the last price of the day, ties on the
    timestamp broken by the largest ``tiebreak``.

    ``max_by`` is an ordinary aggregate, so Spark combines it map-side: a hot
    symbol is reduced inside every input partition before the shuffle.  The
    (timestamp, integer tiebreak) order is packed into one DECIMAL(38,0)
    (micros · 2^64 + tiebreak + 2^63, order-preserving and exact), which
    keeps the aggregation on the hash path; a struct key would force a
    sort-based aggregate.
    """
    dtype = prices.schema[ts].dataType
    if tiebreak and isinstance(prices.schema[tiebreak].dataType, (T.LongType, T.IntegerType, T.ShortType)):
        order = lexicographic_key(epoch_micros(ts, dtype), F.col(tiebreak))
    elif tiebreak:
        order = F.struct(F.col(ts), F.col(tiebreak))
    else:
        order = F.col(ts)
    return (prices.groupBy(F.col(symbol).alias("symbol"), F.to_date(F.col(ts)).alias("day"))
            .agg(F.max_by(F.col(close), order).alias("close")))


_D38 = "decimal(38,0)"


def lexicographic_key(hi: Column, lo: Column) -> Column:
    """Order-preserving exact key of a pair of 64-bit integers."""
    return (hi.cast(_D38) * F.lit(decimal.Decimal(2 ** 64)).cast(_D38)
            + (lo.cast(_D38) + F.lit(decimal.Decimal(2 ** 63)).cast(_D38)))


def last_two_closes(daily: DataFrame, days: int = 5, as_of: Column | None = None) -> DataFrame:
    """Last and previous daily close inside the last ``days`` days.

    ``as_of`` defaults to the newest day in the data (a scalar subquery).
    Output: symbol, n_closes (0..2 used), close_now, close_prev, pct_change;
    pct_change is NULL with fewer than two closes or a zero previous close.
    """
    if as_of is None:
        as_of = daily.select(F.max("day")).scalar()
    recent = daily.filter(F.col("day") > F.date_sub(as_of, days))
    w = Window.partitionBy("symbol").orderBy(F.col("day").desc())
    # rank <= 2 is planned as a WindowGroupLimit: each map partition keeps at
    # most two days per symbol before the exchange.
    top = recent.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= 2)
    agg = top.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_closes"),
        F.max(F.when(F.col("rn") == 1, F.col("close"))).alias("close_now"),
        F.max(F.when(F.col("rn") == 2, F.col("close"))).alias("close_prev"),
    )
    return agg.withColumn("pct_change", pct_change(F.col("close_now"), F.col("close_prev")))


def pct_change(now: Column, prev: Column) -> Column:
    """(now - prev) / prev * 100; NULL when prev is NULL or zero."""
    return F.try_divide(now - prev, F.nullif(prev, F.lit(0.0))) * F.lit(100.0)


def quote_fallback(closes: DataFrame, quotes: DataFrame) -> DataFrame:
    """Symbols without any close take the quote record's prices.

    ``quotes``: symbol, regularMarketPrice, price, regularMarketPreviousClose.
    Current price = first non-zero of regularMarketPrice, price; a zero or
    missing previous close gives no change.  Output adds ``source``
    (history / quote / none).
    """
    q = quotes.select(
        "symbol",
        F.coalesce(F.nullif("regularMarketPrice", F.lit(0.0)), F.nullif("price", F.lit(0.0))).alias("q_now"),
        F.nullif("regularMarketPreviousClose", F.lit(0.0)).alias("q_prev"),
    )
    j = closes.join(q, "symbol", "full_outer")
    has_hist = F.coalesce(F.col("n_closes"), F.lit(0)) > 0
    return j.select(
        "symbol",
        F.when(has_hist, F.lit("history")).when(F.col("q_now").isNotNull(), F.lit("quote"))
         .otherwise(F.lit("none")).alias("source"),
        F.when(has_hist, F.col("close_now")).otherwise(F.col("q_now")).alias("close_now"),
        F.when(has_hist, F.col("pct_change"))
         .otherwise(pct_change(F.col("q_now"), F.col("q_prev"))).alias("pct_change"),
    )


def quote_format(close: Column, pct: Column, is_yield: Column) -> tuple[Column, Column]:
    """(price_str, change_str) of the macro report.

    Yields under 100 show three decimals and ``%``; everything else two
    decimals; the change is always signed with two decimals and ``%``.
    """
    price = (F.when(close.isNull(), F.lit(MISSING))
             .when(is_yield & (close < 100), F.concat(fixed(close, 3), F.lit("%")))
             .otherwise(fixed(close, 2)))
    change = F.when(pct.isNull(), F.lit(MISSING)).otherwise(F.concat(signed(pct, 2), F.lit("%")))
    return price, change


def dim_left_join(dim: DataFrame, quotes: DataFrame, key: str = "symbol") -> DataFrame:
    """Every dimension row once, with or without data.

    The optimizer chooses the join from the sides' byte statistics.
    """
    return dim.join(quotes, key, "left")


def macro_stanzas(rows: DataFrame) -> DataFrame:
    """Adds the 4-line stanza of each symbol (needs description, symbol,
    price_str, change_str)."""
    stanza = F.concat(
        F.lit("● "), F.col("description"), F.lit(" ("), F.col("symbol").cast("string"), F.lit(")\n"),
        F.lit(MACRO_PRICE), F.col("price_str"), F.lit("\n"),
        F.lit(MACRO_CHANGE), F.col("change_str"), F.lit("\n"),
        F.lit("  " + RULE_40 + "\n"),
    )
    return rows.withColumn("stanza", stanza)


def macro_report(stanzas: DataFrame, run_ts: Column, by: list[str] | None = None) -> DataFrame:
    """One report per group: title, time, the stanzas in ``ord`` order, footer.

    The group is one dimension's symbols (a bounded list), so the ordered
    ``collect_list`` holds at most that many short strings.
    """
    by = by or []
    body = F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct("ord", "stanza"))), lambda x: x["stanza"]), "")
    agg = stanzas.groupBy(*by).agg(body.alias("body"), F.count(F.lit(1)).alias("n_symbols"))
    content = F.concat(
        F.lit(MACRO_TITLE + "\n"),
        F.lit("数据抓取时间: "), F.date_format(run_ts, "yyyy-MM-dd HH:mm:ss"), F.lit("\n"),
        F.lit(RULE_72 + "\n\n"),
        F.col("body"),
        F.lit("\n" + MACRO_FOOTER_TITLE + "\n"),
        F.lit("".join(line + "\n" for line in MACRO_FOOTER)),
    )
    return agg.select(*by, "n_symbols", content.alias("content"))


# ------------------------------------------------------------------ companies

COMPANY_SCHEMA = (
    "ticker string, longName string, sector string, industry string, "
    "longBusinessSummary string, trailingPE double, forwardPE double, marketCap double, "
    "profitMargins double, operatingMargins double, freeCashflow double, totalDebt double, "
    "debtToEquity double"
)


def company_metrics(company: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Defaults for missing fields and the unit conversions of the report.

    A missing or NULL number counts as 0; PE and debt ratio are shown raw or
    as the missing marker.  ``keep`` columns are passed through.
    """
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return company.select(
        F.col("ticker"), *(keep or []),
        F.coalesce("longName", "ticker").alias("company_name"),
        F.coalesce("sector", F.lit(UNKNOWN)).alias("sector"),
        F.coalesce("industry", F.lit(UNKNOWN)).alias("industry"),
        F.coalesce("longBusinessSummary", F.lit(NO_SUMMARY)).alias("summary"),
        raw_or_missing("trailingPE").alias("pe_str"),
        raw_or_missing("forwardPE").alias("forward_pe_str"),
        (z("marketCap") / 1e9).alias("market_cap_b"),
        (z("profitMargins") * 100).alias("profit_margin_pct"),
        (z("operatingMargins") * 100).alias("operating_margin_pct"),
        (z("freeCashflow") / 1e6).alias("free_cashflow_m"),
        (z("totalDebt") / 1e6).alias("total_debt_m"),
        raw_or_missing("debtToEquity").alias("debt_to_equity_str"),
    )


def company_report(metrics: DataFrame, run_ts: Column, keep: list[str] | None = None) -> DataFrame:
    """Render the fixed 18-line company report (ticker, keep..., content)."""
    L = COMPANY_LABELS
    lines = [
        F.lit(COMPANY_TITLE),
        F.concat(F.lit(L["ticker"] + ": "), F.col("ticker")),
        F.concat(F.lit(L["name"] + ": "), F.col("company_name")),
        F.concat(F.lit(L["sector"] + ": "), F.col("sector"), F.lit(" - "), F.col("industry")),
        F.concat(F.lit(L["time"] + ": "), F.date_format(run_ts, "yyyy-MM-dd HH:mm:ss")),
        F.lit(RULE_40),
        F.lit(COMPANY_CORE),
        F.concat(F.lit(L["cap"] + ": "), fixed("market_cap_b"), F.lit(" B USD")),
        F.concat(F.lit(L["pe"] + ": "), F.col("pe_str")),
        F.concat(F.lit(L["fpe"] + ": "), F.col("forward_pe_str")),
        F.concat(F.lit(L["pm"] + ": "), fixed("profit_margin_pct"), F.lit("%")),
        F.concat(F.lit(L["om"] + ": "), fixed("operating_margin_pct"), F.lit("%")),
        F.concat(F.lit(L["fcf"] + ": "), fixed("free_cashflow_m"), F.lit(" M USD")),
        F.concat(F.lit(L["debt"] + ": "), fixed("total_debt_m"), F.lit(" M USD")),
        F.concat(F.lit(L["de"] + ": "), F.col("debt_to_equity_str")),
        F.lit(RULE_40),
        F.lit(COMPANY_DESC),
        F.col("summary"),
    ]
    content = F.concat(F.concat_ws("\n", *lines), F.lit("\n"))
    return metrics.select("ticker", *(keep or []), content.alias("content"))


def with_fallback(keys: DataFrame, live: DataFrame, reference: DataFrame, key: str = "ticker") -> DataFrame:
    """Per key: the live record, else the keyed reference record, else a
    default record that carries only the key.

    Two left joins on the key and a per-column ``coalesce``; ``is_fallback``
    and ``record_source`` say which one was used.
    """
    fields = [c for c in live.columns if c != key]
    lv = live.select(F.col(key), *[F.col(c).alias("l_" + c) for c in fields], F.lit(True).alias("_l"))
    rf = reference.select(F.col(key), *[F.col(c).alias("r_" + c) for c in fields], F.lit(True).alias("_r"))
    j = keys.select(key).join(lv, key, "left").join(rf, key, "left")
    live_hit = F.col("_l").isNotNull()
    ref_hit = F.col("_r").isNotNull()
    cols = [F.when(live_hit, F.col("l_" + c)).when(ref_hit, F.col("r_" + c)).alias(c) for c in fields]
    return j.select(
        F.col(key), *cols,
        (~live_hit).alias("is_fallback"),
        F.when(live_hit, F.lit("live")).when(ref_hit, F.lit("reference")).otherwise(F.lit("default"))
         .alias("record_source"),
    )


def normalize_ticker(c: Column) -> Column:
    """Tickers are upper case."""
    return F.upper(c)


# ------------------------------------------------------------------- S-7

REPORT_LINE = r"^([^:：]+?) \(([^()]+)\): (.*)$"
STANZA_HEAD = r"^● .* \(([^()]*)\)$"
STANZA_LINE = r"^  ([^:：]+): (.*)$"
NUMBER_PREFIX = r"^[+-]?[0-9]+(\.[0-9]+)?"


def _metric_lines():
    """Batches (key, marked lines) -> (key, pos, label, line) of the metric lines outside prose."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            listed = batch.column(1)
            sizes = listed.value_lengths().fill_null(0).to_numpy()
            pos, line, prose, label, metric = listed.flatten().flatten()
            doc, at = np.repeat(np.arange(len(sizes)), sizes), np.arange(len(pos))
            first = np.repeat(np.cumsum(sizes) - sizes, sizes)

            def last(chosen):                             # the last chosen line up to each line
                return np.maximum.accumulate(np.where(chosen, at, -1))

            told = last(prose.is_valid().to_numpy(zero_copy_only=False))
            in_prose = (told >= first) & (prose.fill_null(0).to_numpy()[told] == 1)
            own = last(label.is_valid().to_numpy(zero_copy_only=False) & ~in_prose)
            above = np.concatenate([[-1], own])[:len(at)]
            kept = np.flatnonzero(metric.to_numpy(zero_copy_only=False) & ~in_prose)
            rows, labels = pa.array(kept), pa.array(above[kept], mask=above[kept] < first[kept])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc[kept])), pos.take(rows), label.take(labels), line.take(rows)],
                                             names=[batch.schema.names[0], "pos", "label", "line"])

    return run


def parse_report(docs: DataFrame, key: str = "doc_id", content: str = "content") -> DataFrame:
    """Rendered reports back into a long table (key, label, metric, value,
    unit).

    Company reports: ``name (metric): value unit`` lines, label = the ticker
    line.  Macro reports: ``●`` stanza heads give the label of the value
    lines below them.  What follows the heading of the business description is
    prose up to the next report's title and gives neither label nor metric.
    One pass over the marked lines carries (label, prose) and keeps the metric lines, in
    time that follows the number of lines; nothing is shuffled.  A value that is not a
    number (the missing marker) is NULL.
    """
    def marked(line: Column, i: Column) -> Column:
        ticker, head = F.regexp_extract(line, r"^股票代码: (.*)$", 1), F.regexp_extract(line, STANZA_HEAD, 1)
        return F.struct(
            i.cast("int").alias("pos"), line.alias("line"),
            F.when(line == COMPANY_DESC, 1).when(line.isin(COMPANY_TITLE, MACRO_TITLE), 0).alias("prose"),
            F.coalesce(F.nullif(ticker, F.lit("")), F.nullif(head, F.lit(""))).alias("label"),
            (line.rlike(REPORT_LINE) | line.rlike(STANZA_LINE)).alias("metric"))

    # array functions are not compiled: the generator makes the text a value before them, so that the
    # expressions that rendered it are not interpreted within
    texts = docs.select(key, F.explode(F.array(content)).alias("_text"))
    lines = F.filter(F.transform(F.split("_text", "\n"), marked),
                     lambda x: x["prose"].isNotNull() | x["label"].isNotNull() | x["metric"])
    kept = T.StructType([docs.schema[key]]).add("pos", T.IntegerType()).add("label", T.StringType()).add("line", T.StringType())
    found = texts.select(key, lines.alias("_lines")).mapInArrow(_metric_lines(), kept)
    m1, m2 = F.regexp_extract("line", REPORT_LINE, 2), F.regexp_extract("line", STANZA_LINE, 1)
    raw = F.when(m1 != "", F.regexp_extract("line", REPORT_LINE, 3)).otherwise(F.regexp_extract("line", STANZA_LINE, 2))
    rows = found.select(key, "pos", "label", F.when(m1 != "", m1).otherwise(m2).alias("metric"), raw.alias("raw"))
    num = F.regexp_extract("raw", NUMBER_PREFIX, 0)
    unit = F.regexp_replace(F.regexp_replace("raw", NUMBER_PREFIX, ""), r"\A\s+|\s+\z", "")
    return rows.select(key, "pos", "label", "metric", F.when(num != "", num.try_cast("double")).alias("value"),
                       F.when(num != "", unit).alias("unit"))
