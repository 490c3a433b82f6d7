"""Audience analytics from playback events: sessions, retention at a
horizon, completion, the survival curve, segment findings and pacing.

Sessionisation runs ``session_window`` per (viewer, time chunk) and then
stitches the partial sessions per viewer, so a viewer holding a large share
of the events is spread over many tasks (see ``sessions``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions.text import epoch_micros


def _interval_us(spec: str) -> int:
    n, unit = spec.split()
    mult = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600,
            "day": 86400, "days": 86400}[unit.lower()]
    return int(n) * mult * 1_000_000


def sessions(events: DataFrame, viewer: str = "viewer", ts: str = "ts", event_type: str = "event_type",
             gap: str = "12 hours", end_event: str = "purchase", by: list[str] | None = None,
             chunk: str = "1 hour") -> DataFrame:
    """One row per session: (by..., viewer, start, end, n_events,
    reached_end, duration_us).  A new session starts when the next event is
    more than ``gap`` after the previous one.

    Two phases, so that one viewer holding a large share of the events is
    not sorted in a single task:

    1. sessions inside each (viewer, time chunk) with ``session_window`` —
       the shuffle key includes the chunk, so a hot viewer spreads over
       many tasks;
    2. the partial sessions (far fewer than events) are stitched across
       chunk borders per viewer: a partial starts a new session when it
       begins more than ``gap`` after the previous partial ended.
    """
    by = by or []
    dtype = events.schema[ts].dataType
    gap_us = _interval_us(gap)
    chunk_us = _interval_us(chunk)
    ev = events.withColumn("_chunk", F.floor(epoch_micros(ts, dtype) / chunk_us))
    part = ev.groupBy(*by, viewer, "_chunk", F.session_window(F.col(ts), gap).alias("sw")).agg(
        F.min(ts).alias("start"), F.max(ts).alias("end"), F.count(F.lit(1)).alias("n"),
        F.max((F.col(event_type) == end_event).cast("int")).alias("_end"))
    part = part.withColumn("_s", epoch_micros("start", dtype)).withColumn("_e", epoch_micros("end", dtype))
    w = Window.partitionBy(*by, viewer).orderBy("_s", "_e")
    prev_end = F.lag("_e").over(w)
    new = F.when(prev_end.isNull() | (F.col("_s") - prev_end > gap_us), 1).otherwise(0)
    marked = part.withColumn("_new", new)
    sid = F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    g = marked.withColumn("_sid", sid).groupBy(*by, viewer, "_sid").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n_events"),
        F.max("_end").alias("_end"))
    return g.select(*by, viewer, "start", "end", "n_events", (F.col("_end") == 1).alias("reached_end"),
                    (epoch_micros("end", dtype) - epoch_micros("start", dtype)).alias("duration_us"))


def playback_metrics(sess: DataFrame, horizon_s: int = 5, by: list[str] | None = None) -> DataFrame:
    """views (= sessions), retention at the horizon (share of sessions still
    alive ``horizon_s`` after their start) and completion rate (share that
    reached the end event)."""
    by = by or []
    h = horizon_s * 1_000_000
    return sess.groupBy(*by).agg(
        F.count(F.lit(1)).alias("views"),
        (F.sum((F.col("duration_us") >= h).cast("long")) / F.count(F.lit(1))).alias("retention_h"),
        (F.sum(F.col("reached_end").cast("long")) / F.count(F.lit(1))).alias("completion_rate"))


# Buckets whose running sums one window makes.
GROUP_BUCKETS = 1024


def retention_curve(sess: DataFrame, bucket_s: int, by: list[str] | None = None) -> DataFrame:
    """Survival curve per ``by``: for every bucket b from 0 to the longest
    session, ``alive`` = sessions lasting at least b buckets, ``drop`` =
    alive(b−1) − alive(b) (0 for b = 0).  The histogram is a partial aggregate;
    windows see one row per bucket in which a session ends, and each of
    those rows yields the buckets since the one before.  Sums have two levels:
    a window runs inside a group of ``GROUP_BUCKETS`` buckets, and the groups'
    totals, one row each, are an array per ``by``."""
    by = by or []
    b = F.floor(F.col("duration_us") / (bucket_s * 1_000_000)).cast("long")
    hist = sess.groupBy(*by, b.alias("_end")).agg(F.count(F.lit(1)).alias("_ended"))
    hist = hist.withColumn("_g", F.floor(F.col("_end") / GROUP_BUCKETS))
    group = hist.groupBy(*by, "_g").agg(F.sum("_ended").alias("n"), F.max(F.struct("_end", "_ended")).alias("last"))
    hist = _with_totals(hist, by, group, _groups=F.collect_list(F.struct("_g", "n", "last")))
    lower = F.filter("_groups", lambda x: x["_g"] < F.col("_g"))
    below = F.aggregate(lower, F.lit(0).cast("long"), lambda s, x: s + x["n"])
    total = F.aggregate("_groups", F.lit(0).cast("long"), lambda s, x: s + x["n"])
    w = Window.partitionBy(*by, "_g").orderBy("_end")
    before = below + F.coalesce(F.sum("_ended").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    previous = F.coalesce(F.lag(F.struct("_end", "_ended")).over(w), F.array_max(F.transform(lower, lambda x: x["last"])))
    ends = hist.select(*by, "_end", (total - before).cast("long").alias("alive"), previous.alias("_previous")).select(
        *by, "_end", "alive", F.coalesce(F.col("_previous._end") + 1, F.lit(0)).alias("_from"),
        F.coalesce(F.col("_previous._ended"), F.lit(0)).cast("long").alias("_lost"))
    return (ends.withColumn("bucket", F.explode(F.sequence("_from", "_end")))
            .select(*by, "bucket", "alive", F.when(F.col("bucket") == F.col("_from"), F.col("_lost"))
                    .otherwise(F.lit(0).cast("long")).alias("drop")))


def _with_totals(df: DataFrame, by: list[str], of: DataFrame | None = None, **totals: Column) -> DataFrame:
    """``df`` with aggregates of its group (or of the whole) of ``of`` (itself) on every row."""
    cols, of = [c.alias(n) for n, c in totals.items()], df if of is None else of
    if by:
        return df.join(of.groupBy(*by).agg(*cols), by)
    t = of.agg(F.struct(*cols).alias("t")).scalar()
    return df.withColumns({n: t.getField(n) for n in totals})


def segment_findings(curve: DataFrame, bucket_s: int, horizon_s: int, by: list[str] | None = None) -> DataFrame:
    """Classify buckets and merge contiguous runs of one kind, per ``by``.

    opening = buckets ending within the horizon; otherwise sag when the drop
    is above the mean drop (over buckets ≥ 1), highlight when below a quarter
    of it, else steady.  Comparisons are done in integers (drop·n vs sum) so
    no float rounding decides a class.
    """
    by = by or []
    s = _with_totals(curve.filter(F.col("bucket") >= 1), by, _sum=F.sum("drop"), _n=F.count(F.lit(1)))
    opening_last = -(-horizon_s // bucket_s)  # ceil
    kind = (F.when(F.col("bucket") <= opening_last, F.lit("opening_loss"))
            .when(F.col("drop") * F.col("_n") > F.col("_sum"), F.lit("sag"))
            .when(F.col("drop") * F.col("_n") * 4 < F.col("_sum"), F.lit("highlight"))
            .otherwise(F.lit("steady")))
    k = s.withColumn("kind", kind)
    isl = k.withColumn("grp", F.col("bucket") - F.row_number().over(Window.partitionBy(*by, "kind").orderBy("bucket")))
    g = isl.groupBy(*by, "kind", "grp").agg(F.min("bucket").alias("from_bucket"), F.max("bucket").alias("to_bucket"),
                                            F.sum("drop").alias("total_drop"))
    return g.select(*by, "kind", "from_bucket", "to_bucket", F.col("total_drop").cast("long").alias("total_drop"))


def report_findings(segments: DataFrame, bucket_s: int, by: list[str]) -> DataFrame:
    """``segment_findings`` as rows of an audit report: by, seq in time order, kind, from_s, to_s, detail."""
    return segments.select(
        *by, F.row_number().over(Window.partitionBy(*by).orderBy("from_bucket")).alias("seq"), "kind",
        fmt_offset(F.col("from_bucket") * bucket_s).alias("from_s"),
        fmt_offset((F.col("to_bucket") + 1) * bucket_s).alias("to_s"),
        F.concat(F.lit("sessions lost: "), F.col("total_drop").cast("string")).alias("detail"))


def pacing(events: DataFrame, ts: str = "ts", bucket: str = "1 hour", by: list[str] | None = None) -> DataFrame:
    """Events per time bucket and the ratio to the mean bucket of ``by``
    (computed as n · buckets / total, exact in integers until the final
    division)."""
    by = by or []
    g = events.groupBy(*by, F.window(F.col(ts), bucket).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return _with_totals(g, by, _b=F.count(F.lit(1)), _t=F.sum("n")).select(
        *by, F.col("w.start").alias("bucket_start"), F.col("n"), (F.col("n") * F.col("_b") / F.col("_t")).alias("ratio"))


def fmt_offset(seconds: Column) -> Column:
    """Seconds as ``HH:MM:SS`` (hours unbounded)."""
    s = seconds.cast("long")
    return F.concat(F.lpad((s / 3600).cast("long").cast("string"), 2, "0"), F.lit(":"),
                    F.lpad(((s % 3600) / 60).cast("long").cast("string"), 2, "0"), F.lit(":"),
                    F.lpad((s % 60).cast("string"), 2, "0"))
