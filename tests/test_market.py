import datetime as dt

from pyspark.sql import functions as F

from inkwell.operators import market as M


def _d(s):
    return dt.datetime.fromisoformat(s)


def test_quote_format_cases(spark):
    rows = [(4.435, -0.3381, True), (104.75, 0.12, True), (12.345, None, False), (None, None, False),
            (2335.2, 0.45, False)]
    df = spark.createDataFrame(rows, "c double, p double, y boolean")
    price, change = M.quote_format(F.col("c"), F.col("p"), F.col("y"))
    got = df.select(price, change).collect()
    assert [tuple(r) for r in got] == [("4.435%", "-0.34%"), ("104.75", "+0.12%"), ("12.35", "暂无"),
                                       ("暂无", "暂无"), ("2335.20", "+0.45%")]


def test_last_two_closes_and_fallback(spark):
    prices = spark.createDataFrame([
        ("A", _d("2024-01-05 10:00"), 10.0, 1), ("A", _d("2024-01-05 16:00"), 11.0, 2),   # day close 11
        ("A", _d("2024-01-04 16:00"), 10.0, 3),
        ("B", _d("2024-01-05 09:00"), 5.0, 4),                                            # one close
        ("C", _d("2024-01-05 09:00"), 7.0, 5), ("C", _d("2024-01-03 09:00"), 0.0, 6),     # prev zero
        ("D", _d("2023-12-01 09:00"), 1.0, 7),                                            # outside window
    ], "symbol string, ts timestamp, close double, id int")
    daily = M.daily_closes(prices, tiebreak="id")
    closes = {r.symbol: r for r in M.last_two_closes(daily, days=5).collect()}
    assert closes["A"].close_now == 11.0 and closes["A"].close_prev == 10.0
    assert abs(closes["A"].pct_change - 10.0) < 1e-12
    assert closes["B"].n_closes == 1 and closes["B"].pct_change is None
    assert closes["C"].pct_change is None
    assert "D" not in closes
    quotes = spark.createDataFrame([
        ("D", 0.0, 3.0, 2.0), ("E", None, None, 1.0), ("B", 99.0, None, 1.0)],
        "symbol string, regularMarketPrice double, price double, regularMarketPreviousClose double")
    fb = {r.symbol: r for r in M.quote_fallback(M.last_two_closes(daily, days=5), quotes).collect()}
    assert fb["B"].source == "history" and fb["B"].close_now == 5.0
    assert fb["D"].source == "quote" and fb["D"].close_now == 3.0 and abs(fb["D"].pct_change - 50.0) < 1e-12
    assert fb["E"].source == "none" and fb["E"].close_now is None


def test_company_report_layout(spark):
    rec = spark.createDataFrame([
        ("HIMS", "Hims & Hers Health, Inc.", "Healthcare", "Drug Manufacturers", "Summary.", None, 18.459074,
         5.5e9, -0.0056, -0.079, 174.31e6, 1132.04e6, 253.725)], M.COMPANY_SCHEMA)
    content = M.company_report(M.company_metrics(rec), F.lit(_d("2026-05-24 16:46:50"))).first().content
    lines = content.split("\n")
    assert len(lines) == 19 and lines[-1] == ""
    assert lines[1] == "股票代码: HIMS"
    assert lines[4] == "数据抓取时间: 2026-05-24 16:46:50"
    assert lines[7] == "市值 (Market Cap): 5.50 B USD"
    assert lines[8] == "滚动市盈率 (Trailing PE): 暂无"
    assert lines[9] == "预测市盈率 (Forward PE): 18.459074"
    assert lines[10] == "净利润率 (Profit Margin): -0.56%"
    assert lines[11] == "营业利润率 (Operating Margin): -7.90%"
    assert lines[12] == "自由现金流 (Free Cash Flow): 174.31 M USD"
    assert lines[14] == "债务权益比 (Debt to Equity): 253.725"


def test_with_fallback_and_parse_round_trip(spark):
    keys = spark.createDataFrame([("AAA",), ("BBB",), ("CCC",)], "ticker string")
    live = spark.createDataFrame([("AAA", "A Corp", None, None, None, 10.0, None, 2e9, 0.1, 0.2, 3e6, 0.0, 1.5)],
                                 M.COMPANY_SCHEMA)
    ref = spark.createDataFrame([("BBB", None, "Tech", None, None, None, None, 1e9, None, None, None, None, None),
                                 ("AAA", "stale", None, None, None, 1.0, None, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0)],
                                M.COMPANY_SCHEMA)
    rec = M.with_fallback(keys, live, ref, key="ticker")
    src = {r.ticker: (r.record_source, r.is_fallback) for r in rec.collect()}
    assert src == {"AAA": ("live", False), "BBB": ("reference", True), "CCC": ("default", True)}
    rep = M.company_report(M.company_metrics(rec), F.lit(_d("2026-01-01 00:00:00")))
    parsed = M.parse_report(rep.withColumnRenamed("ticker", "doc_id"))
    got = {(r.label, r.metric): r.value for r in parsed.collect()}
    assert got[("AAA", "Market Cap")] == 2.0
    assert got[("AAA", "Profit Margin")] == 10.0
    assert got[("CCC", "Trailing PE")] is None
    assert got[("BBB", "Market Cap")] == 1.0


def test_macro_report_layout(spark):
    dim = M.macro_dim(spark)
    closes = spark.createDataFrame([("^TNX", 4.435, -0.015)], "symbol string, close_now double, pct_change double")
    rows = M.dim_left_join(dim, closes)
    price, change = M.quote_format(F.col("close_now"), F.col("pct_change"), F.col("is_yield"))
    st = M.macro_stanzas(rows.select("ord", "symbol", "description", price.alias("price_str"),
                                     change.alias("change_str")))
    r = M.macro_report(st, F.lit(_d("2026-05-24 17:07:57"))).first()
    assert r.n_symbols == 12
    assert "● 美国10年期国债收益率 (US 10Y Yield) (^TNX)\n  最新价格/数值: 4.435%\n  日内涨跌幅: -0.01%\n" in r.content
    assert r.content.count("暂无") == 22
    assert r.content.endswith(M.MACRO_FOOTER[-1] + "\n")


def test_lexicographic_key_orders_pairs(spark):
    import itertools
    vals = [-2**63, -5, -1, 0, 1, 7, 2**63 - 1]
    pairs = list(itertools.product([-3, 0, 1, 1_700_000_000_000_000], vals))
    df = spark.createDataFrame(pairs, "hi long, lo long")
    got = [(r.hi, r.lo) for r in df.orderBy(M.lexicographic_key(F.col("hi"), F.col("lo"))).collect()]
    assert got == sorted(pairs)


def test_prose_gives_no_metric(spark):
    text = "\n".join([M.COMPANY_TITLE, "股票代码: AAA", "市值 (Market Cap): 2.00 B USD", M.COMPANY_DESC,
                      "The segments (Retail): 45 stores in ten states", "股票代码: BBB", "● x (^Y)", "  margin: 5",
                      M.MACRO_TITLE, "● rate (^TNX)", "  price: 4.4%", "  none: 暂无", "x (^Y)"])
    docs = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "a (b): 1")], "doc_id int, content string")
    got = [tuple(r) for r in M.parse_report(docs).orderBy("doc_id", "pos").collect()]
    assert got == [(1, 2, "AAA", "Market Cap", 2.0, "B USD"), (1, 10, "^TNX", "price", 4.4, "%"), (1, 11, "^TNX", "none", None, None),
                   (4, 0, None, "b", 1.0, "")]


def test_parse_report_carries_labels_in_one_pass(spark):
    """No fold that copies the metric lines found so far; labels end with their document, equal keys included."""
    stanzas = "\n".join(f"● user {i} (S{i})\n  price: {i}" for i in range(3000))
    docs = spark.createDataFrame([("A", M.MACRO_TITLE + "\n" + stanzas), ("A", "  price: 7\nx (b): 1"), (None, "● y (Z)\n  price: 8"), ("B", "  none: 1")],
                                 "doc_id string, content string").coalesce(1)
    parsed = M.parse_report(docs)
    got = sorted([(r.doc_id or "", r.pos, r.label, r.value) for r in parsed.collect()], key=str)
    want = [("A", 2 + 2 * i, f"S{i}", float(i)) for i in range(3000)] + [
        ("A", 0, None, 7.0), ("A", 1, None, 1.0), ("", 1, "Z", 8.0), ("B", 0, None, 1.0)]
    assert got == sorted(want, key=str)
    assert "aggregate(" not in parsed._jdf.queryExecution().optimizedPlan().toString()
