from pyspark.sql import functions as F

from inkwell.operators import indicators as I
from inkwell.operators.diff import draft_final_diff


def test_draft_final_diff_identity(spark):
    pairs = spark.createDataFrame([("d", "甲。乙。丙。乙。", "甲。丁！"), ("e", "", "x")], "dir string, v1 string, v2 string")
    got = {r.dir: r for r in draft_final_diff(pairs).collect()}
    r = got["d"]
    assert (r.n_v1, r.n_v2, r.kept, r.removed, r.added) == (3, 2, 1, 2, 1)
    assert r.kept + r.removed == r.n_v1
    assert got["e"].length_ratio is None


def test_indicator_formulas(spark):
    df = spark.createDataFrame([(611.7e9, 349e6)], "total double, pop double")
    v = df.select(I.per_capita_monthly(F.col("total"), F.col("pop"))).first()[0]
    assert round(v) == 146
    s = spark.createDataFrame([("x", 100.0, 80.0, 5.0)], "e string, inc double, con double, tr double")
    assert abs(s.select(I.savings_rate(F.col("inc"), F.col("con"), F.col("tr"))).first()[0] - 0.15) < 1e-12
    ratio, flag = I.coverage_flag(F.lit(1.0), F.lit(1.0))
    assert spark.range(1).select(flag).first()[0] is True


def test_series_windows(spark):
    rows = [("a", i, float(v)) for i, v in enumerate([10, 12, 11, 9, 8, 7, 15])]
    df = spark.createDataFrame(rows, "e string, idx long, v double")
    pc = I.period_change(df, "e", "idx", "v", periods=1).orderBy("idx").collect()
    assert pc[0].growth_pct is None and abs(pc[1].growth_pct - 20.0) < 1e-9
    peaks = [r[0] for r in df.select(I.above_prior_peak("v", "e", "idx")).orderBy(F.lit(1)).collect()]
    assert sum(peaks) == 2
    dec = I.consecutive_decline(df.withColumn("inv", F.col("v").cast("decimal(10,2)")), "e", "idx", "v", "inv", n=3)
    runs = [r.decline_run for r in dec.orderBy("idx").collect()]
    assert runs == [0, 0, 1, 2, 3, 4, 0]
    flags = I.stall_flags(I.period_change(df, "e", "idx", "v", periods=1), "e", "idx", "growth_pct")
    fs = I.first_stall(flags, "e", "idx").first()
    assert fs.first_stall == 2 and fs.first_double_drop == 3


def test_contribution_cyclical_alert(spark):
    df = spark.createDataFrame([("a", 1, "1.50"), ("b", 1, "2.50"), ("a", 2, "3.00")], "e string, idx long, x string") \
        .withColumn("x", F.col("x").cast("decimal(10,2)"))
    shares = {(r.e, r.idx): r.s for r in df.select("e", "idx", I.contribution_share(df, "x", ["idx"]).alias("s")).collect()}
    assert abs(shares[("a", 1)] + shares[("b", 1)] - 1.0) < 1e-15 and shares[("a", 2)] == 1.0
    series = spark.createDataFrame([("a", i, 10.0, 2.0) for i in range(130)], "e string, idx long, price double, earn double") \
        .withColumn("earn", F.col("earn").cast("decimal(10,2)"))
    ratios = {r.idx: r.cyclical_ratio for r in I.cyclical_ratio(series, "e", "idx", "price", "earn").collect()}
    assert all(abs(v - 5.0) < 1e-12 for v in ratios.values())
    flags = spark.createDataFrame([(5.0, True, False, False), (4.4, True, False, False), (9.0, False, True, False),
                                   (None, True, None, True)], "infl double, peak boolean, cf boolean, stall boolean")
    got = [r[0] for r in flags.select(I.alert_level(F.col("infl"), F.col("peak"), F.col("cf"), F.col("stall"))).collect()]
    assert got == ["yellow", "green", "red", "red"]


def test_a_missing_period_is_no_predecessor(spark):
    from pyspark.sql import functions as F

    from inkwell.operators import indicators as I
    rows = [("e", 1, 5.0, 10), ("e", 2, 4.0, 10), ("e", 20, 3.0, 99), ("e", 21, 2.0, 99)]
    df = spark.createDataFrame(rows, "entity string, idx long, margin double, inv int").withColumn("inv", F.col("inv").cast("decimal(18,2)"))
    run = {r.idx: r.decline_run for r in I.consecutive_decline(df, "entity", "idx", "margin", "inv").collect()}
    assert run == {1: 0, 2: 1, 20: 0, 21: 1}
    g = spark.createDataFrame([("e", 1, 3.0), ("e", 40, -1.0), ("e", 41, 2.0), ("e", 42, -2.0)], "entity string, idx long, growth double")
    assert {r.idx for r in I.stall_flags(g, "entity", "idx", "growth").filter("stall").collect()} == {42}


def test_alignment_equals_a_brute_force_common_subsequence(spark):
    import random

    from inkwell.operators.diff import draft_final_alignment

    def common(a, b):
        rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
        return rows[-1][-1]

    rng = random.Random(4)
    versions = [([rng.choice("abcdef") for _ in range(rng.randrange(n))], [rng.choice("abcdef") for _ in range(rng.randrange(n))])
                for n in (1, 4, 9, 30, 90, 200) for _ in range(6)]
    rows = [(str(i), "".join(x + "。" for x in a), "".join(x + "。" for x in b)) for i, (a, b) in enumerate(versions)]
    rows += [("null", None, "a。"), ("empty", "", "a。a。")]
    got = {r.dir: r for r in draft_final_alignment(spark.createDataFrame(rows, "dir string, v1 string, v2 string")).collect()}
    for i, (a, b) in enumerate(versions):
        r, kept = got[str(i)], common(a, b)
        shared = sum(min(a.count(x), b.count(x)) for x in set(a))
        assert (r.n_v1, r.n_v2, r.kept, r.removed, r.added, r.moved) == (len(a), len(b), kept, len(a) - kept, len(b) - kept, shared - kept)
    assert got["null"].kept is None and (got["empty"].kept, got["empty"].added) == (0, 2)
    assert draft_final_alignment(spark.createDataFrame([], "dir string, v1 string, v2 string")).count() == 0
