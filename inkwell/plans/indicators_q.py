"""Indicator bindings: monthly series per return flag from ``lineitem``
(income = extended price, consumption = net of discount, transfers = tax on
the net, inventory = quantity; exact DECIMAL sums), nations' annual order
value per customer, and supplier coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.operators import indicators as I
from inkwell.plans.tables import load

_P = "decimal(18,2)"
_R = "decimal(4,2)"


def monthly(spark, d) -> DataFrame:
    li = load(spark, d, "lineitem")
    price = F.col("l_extendedprice").cast(_P)
    net = price * (F.lit(1) - F.col("l_discount").cast(_R))
    g = li.groupBy(F.col("l_returnflag").alias("entity"), I.period_index(F.col("l_shipdate")).alias("idx")).agg(
        F.sum(price).alias("income_x"), F.sum(net).alias("consumption_x"),
        F.sum(net * F.col("l_tax").cast(_R)).alias("transfers_x"),
        F.sum(F.col("l_quantity").cast(_P)).alias("inventory_x"))
    return g.select("*", *[F.col(f"{c}_x").cast("double").alias(c)
                           for c in ["income", "consumption", "transfers", "inventory"]]) \
        .withColumn("margin", F.col("consumption") / F.col("income"))


def _with_growth(spark, d) -> DataFrame:
    m = monthly(spark, d).withColumn("savings_rate", I.savings_rate(F.col("income"), F.col("consumption"),
                                                                       F.col("transfers")))
    return I.period_change(m, "entity", "idx", "income", margin="margin")


def q_savings_rate(spark, d) -> DataFrame:
    m = monthly(spark, d)
    return m.select("entity", "idx", "income", "consumption", "transfers",
                    I.savings_rate(F.col("income"), F.col("consumption"), F.col("transfers")).alias("savings_rate"))


def q_per_capita_monthly(spark, d) -> DataFrame:
    o = load(spark, d, "orders")
    c = load(spark, d, "customer")
    n = load(spark, d, "nation")
    pop = c.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("population"))
    annual = o.join(c.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")) \
        .groupBy("c_nationkey", F.year("o_orderdate").cast("long").alias("year")) \
        .agg(F.sum(F.col("o_totalprice").cast(_P)).cast("double").alias("annual"))
    j = annual.join(pop, "c_nationkey").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.select("n_name", "year", "annual", "population",
                    I.per_capita_monthly(F.col("annual"), F.col("population")).alias("per_capita_monthly"))


def q_contribution_share(spark, d) -> DataFrame:
    m = monthly(spark, d)
    return m.select("entity", "idx", I.contribution_share(m, "income_x", ["idx"]).alias("share"))


def q_period_change(spark, d) -> DataFrame:
    return _with_growth(spark, d).select("entity", "idx", "growth_pct", "margin_change_bp")


def q_cyclical_ratio(spark, d) -> DataFrame:
    m = monthly(spark, d)
    m = m.withColumn("price", F.col("income") / F.col("inventory")) \
        .withColumn("earnings_x", F.col("income_x") - F.col("consumption_x") - F.col("transfers_x"))
    return I.cyclical_ratio(m, "entity", "idx", "price", "earnings_x").select("entity", "idx", "cyclical_ratio")


def q_coverage_flag(spark, d) -> DataFrame:
    li = load(spark, d, "lineitem")
    s = load(spark, d, "supplier")
    interest = li.groupBy("l_suppkey").agg(
        (F.sum(F.col("l_extendedprice").cast(_P) * F.col("l_tax").cast(_R)).cast("double") / 1000.0).alias("interest"))
    j = s.join(interest, F.col("s_suppkey") == F.col("l_suppkey"), "left")
    ratio, flag = I.coverage_flag(F.col("s_acctbal"), F.col("interest"))
    return j.select("s_suppkey", F.col("s_acctbal").alias("ebit"), "interest", ratio.alias("coverage"),
                    flag.alias("flag"))


def q_above_prior_peak(spark, d) -> DataFrame:
    g = _with_growth(spark, d)
    return g.select("entity", "idx", "savings_rate",
                    I.above_prior_peak("savings_rate", "entity", "idx").alias("above_peak"))


def q_consecutive_decline(spark, d) -> DataFrame:
    m = monthly(spark, d)
    r = I.consecutive_decline(m, "entity", "idx", "margin", "inventory_x", n=3)
    return r.select("entity", "idx", "margin", "decline_run", "inventory_above_mean", "flag")


def q_first_stall(spark, d) -> DataFrame:
    f = I.stall_flags(_with_growth(spark, d), "entity", "idx", "growth_pct")
    return I.first_stall(f, "entity", "idx")


def q_alert_level(spark, d) -> DataFrame:
    g = _with_growth(spark, d)
    g = I.stall_flags(g, "entity", "idx", "growth_pct")
    g = g.withColumn("peak", I.above_prior_peak("savings_rate", "entity", "idx")) \
        .withColumn("cf_down", F.col("income") < I.lagged("income", "entity", "idx", 3))
    lvl = I.alert_level(F.col("growth_pct"), F.col("peak"), F.col("cf_down"), F.col("stall"))
    return g.select("entity", "idx", lvl.alias("level"))


QUERIES = {
    "savings_rate": q_savings_rate,
    "per_capita_monthly": q_per_capita_monthly,
    "contribution_share": q_contribution_share,
    "period_change": q_period_change,
    "cyclical_ratio": q_cyclical_ratio,
    "coverage_flag": q_coverage_flag,
    "above_prior_peak": q_above_prior_peak,
    "consecutive_decline": q_consecutive_decline,
    "first_stall": q_first_stall,
    "alert_level": q_alert_level,
}

# ----------------------------------------------------------------- DuckDB SQL

_M = """
m0 AS (SELECT l_returnflag AS entity, CAST(year(l_shipdate) * 12 + month(l_shipdate) - 1 AS BIGINT) AS idx,
         sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS income_x,
         sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS consumption_x,
         sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) * CAST(l_tax AS DECIMAL(4,2))) AS transfers_x,
         sum(CAST(l_quantity AS DECIMAL(18,2))) AS inventory_x
       FROM lineitem GROUP BY 1, 2),
m AS (SELECT *, CAST(income_x AS DOUBLE) AS income, CAST(consumption_x AS DOUBLE) AS consumption,
             CAST(transfers_x AS DOUBLE) AS transfers, CAST(inventory_x AS DOUBLE) AS inventory,
             CAST(consumption_x AS DOUBLE) / CAST(income_x AS DOUBLE) AS margin FROM m0),
g AS (SELECT *, (income - consumption - transfers) / nullif(income, 0) AS savings_rate,
        (income - first(income) OVER (PARTITION BY entity ORDER BY idx RANGE BETWEEN 12 PRECEDING AND 12 PRECEDING))
          / nullif(first(income) OVER (PARTITION BY entity ORDER BY idx RANGE BETWEEN 12 PRECEDING AND 12 PRECEDING), 0) * 100.0 AS growth_pct,
        (margin - first(margin) OVER (PARTITION BY entity ORDER BY idx RANGE BETWEEN 12 PRECEDING AND 12 PRECEDING)) * 10000.0 AS margin_change_bp,
        income < first(income) OVER (PARTITION BY entity ORDER BY idx RANGE BETWEEN 3 PRECEDING AND 3 PRECEDING) AS cf_down,
        coalesce(savings_rate > max(savings_rate) OVER (PARTITION BY entity ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS peak
      FROM m),
s AS (SELECT *, coalesce(growth_pct <= 0 AND first(growth_pct) OVER (PARTITION BY entity ORDER BY idx RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) > 0, false) AS stall,
             coalesce(growth_pct <= -10.0, false) AS double_drop FROM g)"""

ORACLE = {
    "savings_rate": f"WITH {_M} SELECT entity, idx, income, consumption, transfers, savings_rate FROM g",
    "per_capita_monthly": """WITH pop AS (SELECT c_nationkey, count(*) AS population FROM customer GROUP BY 1),
        a AS (SELECT c.c_nationkey, CAST(year(o.o_orderdate) AS BIGINT) AS year,
                     CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS annual
              FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY 1, 2)
        SELECT n.n_name, a.year, a.annual, CAST(p.population AS BIGINT) AS population,
               a.annual / nullif(p.population * 12, 0) AS per_capita_monthly
        FROM a JOIN pop p ON p.c_nationkey = a.c_nationkey JOIN nation n ON n.n_nationkey = a.c_nationkey""",
    "contribution_share": f"""WITH {_M} SELECT entity, idx,
        CAST(income_x AS DOUBLE) / nullif(CAST(sum(income_x) OVER (PARTITION BY idx) AS DOUBLE), 0) AS share FROM m""",
    "period_change": f"WITH {_M} SELECT entity, idx, growth_pct, margin_change_bp FROM g",
    "cyclical_ratio": f"""WITH {_M},
        e AS (SELECT *, income / inventory AS price, income_x - consumption_x - transfers_x AS earnings_x FROM m)
        SELECT entity, idx, price / nullif(
          CAST(sum(earnings_x) OVER (PARTITION BY entity ORDER BY idx RANGE BETWEEN 119 PRECEDING AND CURRENT ROW) AS DOUBLE)
          / count(earnings_x) OVER (PARTITION BY entity ORDER BY idx RANGE BETWEEN 119 PRECEDING AND CURRENT ROW), 0)
          AS cyclical_ratio FROM e""",
    "coverage_flag": """WITH i AS (SELECT l_suppkey,
            CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2))) AS DOUBLE) / 1000.0 AS interest
            FROM lineitem GROUP BY 1)
        SELECT s.s_suppkey, s.s_acctbal AS ebit, i.interest, s.s_acctbal / nullif(i.interest, 0) AS coverage,
               s.s_acctbal / nullif(i.interest, 0) < 1.5 AS flag
        FROM supplier s LEFT JOIN i ON i.l_suppkey = s.s_suppkey""",
    "above_prior_peak": f"WITH {_M} SELECT entity, idx, savings_rate, peak AS above_peak FROM g",
    "consecutive_decline": f"""WITH {_M},
        f AS (SELECT m.*, coalesce(m.margin < p.margin, false) AS f_ FROM m LEFT JOIN m p ON p.entity = m.entity AND p.idx = m.idx - 1),
        gg AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY idx)
                         - row_number() OVER (PARTITION BY entity, f_ ORDER BY idx) AS grp FROM f),
        r AS (SELECT *, CAST(CASE WHEN f_ THEN row_number() OVER (PARTITION BY entity, f_, grp ORDER BY idx) ELSE 0 END AS BIGINT) AS decline_run,
                     inventory_x * count(*) OVER (PARTITION BY entity) > sum(inventory_x) OVER (PARTITION BY entity) AS inventory_above_mean
              FROM gg)
        SELECT entity, idx, margin, decline_run, inventory_above_mean, decline_run >= 3 AND inventory_above_mean AS flag FROM r""",
    "first_stall": f"""WITH {_M} SELECT entity, min(CASE WHEN stall THEN idx END) AS first_stall,
        min(CASE WHEN double_drop THEN idx END) AS first_double_drop FROM s GROUP BY entity""",
    "alert_level": f"""WITH {_M} SELECT entity, idx,
        CASE WHEN coalesce(cf_down, false) OR stall THEN 'red'
             WHEN coalesce(growth_pct >= 4.5, false) AND peak THEN 'yellow' ELSE 'green' END AS level FROM s""",
}
