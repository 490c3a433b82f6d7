"""Market bindings: symbol = events.user_id, price = events.value.

* daily close = last value of the day by (ts, event_id)
* macro dimension = every user id, dealt to 25 desks (one report each); the
  first two of a desk act as yields
* quotes for the fallback = each customer's two newest orders (total price)
  with the account balance as the secondary price field
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.operators import market as M
from inkwell.plans.tables import load

N_DESKS = 25
N_YIELD = 2


def _daily(spark, d) -> DataFrame:
    ev = load(spark, d, "events").select(
        F.col("user_id").alias("symbol"), "ts", F.col("value").alias("close"), "event_id")
    return M.daily_closes(M.recent_prices(ev), tiebreak="event_id")


def _dim(spark, d) -> DataFrame:
    ids = load(spark, d, "events").select(F.col("user_id").alias("symbol")).distinct() \
        .withColumn("desk", F.pmod("symbol", F.lit(N_DESKS)))
    w = Window.partitionBy("desk").orderBy("symbol")
    return ids.select(
        "desk", F.row_number().over(w).alias("ord"), "symbol",
        F.concat(F.lit("user "), F.col("symbol").cast("string")).alias("description"),
    ).withColumn("is_yield", F.col("ord") <= N_YIELD)


def _run_ts(spark, d):
    return load(spark, d, "events").select(F.max("ts")).scalar()


def _closes(spark, d) -> DataFrame:
    return M.last_two_closes(_daily(spark, d), as_of=F.to_date(_run_ts(spark, d)))


def q_last_two_closes(spark, d) -> DataFrame:
    return _closes(spark, d)


def _macro_rows(spark, d) -> DataFrame:
    dim = _dim(spark, d)
    rows = M.dim_left_join(dim, _closes(spark, d))
    price, change = M.quote_format(F.col("close_now"), F.col("pct_change"), F.col("is_yield"))
    return rows.select("desk", "ord", "symbol", "description", "close_now", "pct_change",
                       price.alias("price_str"), change.alias("change_str"))


def q_macro_quotes(spark, d) -> DataFrame:
    return _macro_rows(spark, d).select(
        "desk", F.col("ord").cast("long").alias("ord"), "symbol", "description", "price_str", "change_str")


def q_macro_report(spark, d) -> DataFrame:
    st = M.macro_stanzas(_macro_rows(spark, d))
    return M.macro_report(st, _run_ts(spark, d), by=["desk"])


def _quotes(spark, d) -> DataFrame:
    o = load(spark, d, "orders").select("o_custkey", "o_totalprice", "o_orderdate", "o_orderkey")
    w = Window.partitionBy("o_custkey").orderBy(F.col("o_orderdate").desc(), F.col("o_orderkey").desc())
    top = o.withColumn("rn", F.row_number().over(w)).filter("rn <= 2").groupBy("o_custkey").agg(
        F.max(F.when(F.col("rn") == 1, F.col("o_totalprice"))).alias("regularMarketPrice"),
        F.max(F.when(F.col("rn") == 2, F.col("o_totalprice"))).alias("regularMarketPreviousClose"))
    c = load(spark, d, "customer").select(F.col("c_custkey").alias("symbol"), F.col("c_acctbal").alias("price"))
    return c.join(top.withColumnRenamed("o_custkey", "symbol"), "symbol", "left")


def q_quote_fallback(spark, d) -> DataFrame:
    res = M.quote_fallback(_closes(spark, d), _quotes(spark, d))
    price, change = M.quote_format(F.col("close_now"), F.col("pct_change"), F.lit(False))
    return res.select("symbol", "source", "close_now", "pct_change",
                      price.alias("price_str"), change.alias("change_str"))


QUERIES = {
    "last_two_closes": q_last_two_closes,
    "macro_quotes": q_macro_quotes,
    "macro_report": q_macro_report,
    "quote_fallback": q_quote_fallback,
}

# ----------------------------------------------------------------- DuckDB SQL

_DAILY = """
daily AS (
  SELECT symbol, day, close FROM (
    SELECT user_id AS symbol, CAST(ts AS DATE) AS day, value AS close,
           row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS r
    FROM events) WHERE r = 1)"""

_CLOSES = """
recent AS (SELECT * FROM daily WHERE day > (SELECT max(day) FROM daily) - INTERVAL 5 DAY),
top2 AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY day DESC) AS rn FROM recent),
c0 AS (SELECT symbol, CAST(count(*) AS BIGINT) AS n_closes,
              max(CASE WHEN rn = 1 THEN close END) AS close_now,
              max(CASE WHEN rn = 2 THEN close END) AS close_prev
       FROM top2 WHERE rn <= 2 GROUP BY symbol),
closes AS (SELECT *, (close_now - close_prev) / nullif(close_prev, 0) * 100.0 AS pct_change FROM c0)"""

_DIM = """
dim AS (SELECT symbol % 25 AS desk, row_number() OVER (PARTITION BY symbol % 25 ORDER BY symbol) AS ord, symbol,
               'user ' || CAST(symbol AS VARCHAR) AS description
        FROM (SELECT DISTINCT user_id AS symbol FROM events)),
mrows AS (
  SELECT d.desk, d.ord, d.symbol, d.description, c.close_now, c.pct_change,
         CASE WHEN c.close_now IS NULL THEN '暂无'
              WHEN d.ord <= 2 AND c.close_now < 100 THEN printf('%.3f', c.close_now) || '%'
              ELSE printf('%.2f', c.close_now) END AS price_str,
         CASE WHEN c.pct_change IS NULL THEN '暂无' ELSE printf('%+.2f', c.pct_change) || '%' END AS change_str
  FROM dim d LEFT JOIN closes c ON c.symbol = d.symbol)"""

_FOOTER = "".join(line + "\n" for line in M.MACRO_FOOTER)

_MACRO_SELECT = f"""        SELECT desk, CAST(count(*) AS BIGINT) AS n_symbols,
          '{M.MACRO_TITLE}' || chr(10) || '数据抓取时间: ' || strftime((SELECT max(ts) FROM events), '%Y-%m-%d %H:%M:%S') || chr(10)
          || '{M.RULE_72}' || chr(10) || chr(10)
          || string_agg('● ' || description || ' (' || CAST(symbol AS VARCHAR) || ')' || chr(10)
               || '{M.MACRO_PRICE}' || price_str || chr(10) || '{M.MACRO_CHANGE}' || change_str || chr(10)
               || '  {M.RULE_40}' || chr(10), '' ORDER BY ord)
          || chr(10) || '{M.MACRO_FOOTER_TITLE}' || chr(10) || '{_FOOTER}' AS content
        FROM mrows GROUP BY desk"""

MACRO_CTES = f"{_DAILY}, {_CLOSES}, {_DIM}, macro AS ({_MACRO_SELECT})"

ORACLE = {
    "last_two_closes": f"WITH {_DAILY}, {_CLOSES} SELECT * FROM closes",
    "macro_quotes": f"""WITH {_DAILY}, {_CLOSES}, {_DIM}
        SELECT desk, CAST(ord AS BIGINT) AS ord, symbol, description, price_str, change_str FROM mrows""",
    "macro_report": f"""WITH {_DAILY}, {_CLOSES}, {_DIM}
{_MACRO_SELECT}""",
    "quote_fallback": f"""WITH {_DAILY}, {_CLOSES},
      o AS (SELECT o_custkey, o_totalprice,
                   row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) rn FROM orders),
      top AS (SELECT o_custkey, max(CASE WHEN rn = 1 THEN o_totalprice END) AS rmp,
                     max(CASE WHEN rn = 2 THEN o_totalprice END) AS prev
              FROM o WHERE rn <= 2 GROUP BY o_custkey),
      q AS (SELECT c.c_custkey AS symbol,
                   coalesce(nullif(t.rmp, 0), nullif(c.c_acctbal, 0)) AS q_now, nullif(t.prev, 0) AS q_prev
            FROM customer c LEFT JOIN top t ON t.o_custkey = c.c_custkey),
      j AS (SELECT coalesce(c.symbol, q.symbol) AS symbol,
                   CASE WHEN coalesce(c.n_closes, 0) > 0 THEN 'history' WHEN q.q_now IS NOT NULL THEN 'quote' ELSE 'none' END AS source,
                   CASE WHEN coalesce(c.n_closes, 0) > 0 THEN c.close_now ELSE q.q_now END AS close_now,
                   CASE WHEN coalesce(c.n_closes, 0) > 0 THEN c.pct_change
                        ELSE (q.q_now - q.q_prev) / nullif(q.q_prev, 0) * 100.0 END AS pct_change
            FROM closes c FULL OUTER JOIN q ON q.symbol = c.symbol)
      SELECT symbol, source, close_now, pct_change,
             CASE WHEN close_now IS NULL THEN '暂无' ELSE printf('%.2f', close_now) END AS price_str,
             CASE WHEN pct_change IS NULL THEN '暂无' ELSE printf('%+.2f', pct_change) || '%' END AS change_str
      FROM j""",
}
