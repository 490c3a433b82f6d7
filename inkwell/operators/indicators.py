"""Analyst calculations stated as formulas in the reference's notes:
savings rate, per-capita monthly value, contribution share, year-over-year
change, cyclically adjusted ratio, coverage flag, prior-peak breach,
consecutive decline, first stall and the alert level.

Series are rows ``(entity, period_idx, …)`` with an integer period index
(months since year 0), so "12 periods before" is a RANGE frame and missing
months are never confused with the previous row.  Every window is
partitioned by the entity; one entity's series is a few hundred periods.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
COVERAGE_MIN = 1.5            # EBIT / interest below this is flagged
INFLATION_YELLOW = 4.5        # "about 4.5 %" read as >= 4.5
DOUBLE_DIGIT_DROP = -10.0     # growth at or below -10 % is a double-digit drop
CAPE_YEARS = 10
# -----------------------------------------------------------------------------


def period_index(ts: Column) -> Column:
    """Months since year 0 of a date/timestamp."""
    return (F.year(ts) * 12 + F.month(ts) - 1).cast("long")


def _w(entity: str, idx: str) -> Window:
    return Window.partitionBy(entity).orderBy(idx)


def savings_rate(income: Column, consumption: Column, transfers: Column) -> Column:
    """(income − consumption − interest and transfers) / income."""
    return F.try_divide(income - consumption - transfers, income)


def per_capita_monthly(total: Column, population: Column) -> Column:
    """Annual total / (population × 12)."""
    return F.try_divide(total, population * 12)


def contribution_share(df: DataFrame, part_exact: str, by: list[str]) -> Column:
    """Part / total of its group; the total is summed on the exact (decimal)
    column so the share does not depend on summation order."""
    total = F.sum(F.col(part_exact)).over(Window.partitionBy(*by))
    return F.try_divide(F.col(part_exact).cast("double"), total.cast("double"))


def lagged(value: str, entity: str, idx: str, periods: int) -> Column:
    """The value exactly ``periods`` periods earlier (NULL when that period
    is missing)."""
    return F.first(F.col(value)).over(_w(entity, idx).rangeBetween(-periods, -periods))


def period_change(df: DataFrame, entity: str, idx: str, value: str, margin: str | None = None,
                  periods: int = 12) -> DataFrame:
    """Growth in % against the same period ``periods`` earlier and, when a
    margin column is given, its change in basis points."""
    prev = lagged(value, entity, idx, periods)
    out = df.withColumn("growth_pct", F.try_divide(F.col(value) - prev, prev) * 100.0)
    if margin:
        out = out.withColumn("margin_change_bp", (F.col(margin) - lagged(margin, entity, idx, periods)) * 10000.0)
    return out


def cyclical_ratio(df: DataFrame, entity: str, idx: str, price: str, earnings_exact: str,
                   years: int = CAPE_YEARS) -> DataFrame:
    """Price / mean earnings of the last ``years`` years (the current period
    included).  The mean is an exact decimal sum over a count."""
    w = _w(entity, idx).rangeBetween(-(years * 12 - 1), 0)
    mean = F.sum(F.col(earnings_exact)).over(w).cast("double") / F.count(F.col(earnings_exact)).over(w)
    return df.withColumn("cyclical_ratio", F.try_divide(F.col(price), mean))


def coverage_flag(ebit: Column, interest: Column, threshold: float = COVERAGE_MIN) -> tuple[Column, Column]:
    ratio = F.try_divide(ebit, interest)
    return ratio, ratio < threshold


def above_prior_peak(value: str, entity: str, idx: str) -> Column:
    """True when the value exceeds every earlier value of its entity."""
    prior = F.max(F.col(value)).over(_w(entity, idx).rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(F.col(value) > prior, F.lit(False))


def consecutive_decline(df: DataFrame, entity: str, idx: str, margin: str, inventory_exact: str,
                        n: int = 3) -> DataFrame:
    """``decline_run``: length of the current run of falling margins (each
    against the period right before; a missing period ends the run);
    ``flag``: run ≥ n while inventory is above its entity mean (compared in
    exact arithmetic as inventory · count > sum)."""
    w = _w(entity, idx)
    falling = F.coalesce(F.col(margin) < lagged(margin, entity, idx, 1), F.lit(False))
    d = df.withColumn("_f", falling)
    d = d.withColumn("_grp", F.row_number().over(w) - F.row_number().over(Window.partitionBy(entity, "_f").orderBy(idx)))
    run = F.when(F.col("_f"), F.row_number().over(Window.partitionBy(entity, "_f", "_grp").orderBy(idx))) \
        .otherwise(F.lit(0))
    all_ = Window.partitionBy(entity)
    above = F.col(inventory_exact) * F.count(F.lit(1)).over(all_) > F.sum(F.col(inventory_exact)).over(all_)
    d = d.withColumn("decline_run", run.cast("long")).withColumn("inventory_above_mean", above)
    return d.withColumn("flag", (F.col("decline_run") >= n) & F.col("inventory_above_mean")).drop("_f", "_grp")


def stall_flags(df: DataFrame, entity: str, idx: str, growth: str) -> DataFrame:
    """``stall``: growth ≤ 0 right after a period of growth > 0;
    ``double_drop``: growth ≤ −10 %."""
    prev = lagged(growth, entity, idx, 1)
    return df.withColumn("stall", F.coalesce((F.col(growth) <= 0) & (prev > 0), F.lit(False))) \
        .withColumn("double_drop", F.coalesce(F.col(growth) <= DOUBLE_DIGIT_DROP, F.lit(False)))


def first_stall(flags: DataFrame, entity: str, idx: str) -> DataFrame:
    """First stall and first double-digit drop per entity."""
    return flags.groupBy(entity).agg(
        F.min(F.when(F.col("stall"), F.col(idx))).alias("first_stall"),
        F.min(F.when(F.col("double_drop"), F.col(idx))).alias("first_double_drop"))


def alert_level(inflation: Column, delinquency_peak: Column, cash_flow_down: Column, capex_stall: Column) -> Column:
    """red: cash flow down on the quarter or a capex stall; yellow:
    inflation ≥ 4.5 % together with the delinquency flag; else green."""
    return (F.when(F.coalesce(cash_flow_down, F.lit(False)) | F.coalesce(capex_stall, F.lit(False)), F.lit("red"))
            .when(F.coalesce(inflation >= INFLATION_YELLOW, F.lit(False)) & delinquency_peak, F.lit("yellow"))
            .otherwise(F.lit("green")))
