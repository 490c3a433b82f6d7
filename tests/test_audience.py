import datetime as dt

from pyspark.sql import functions as F

from inkwell.operators import audience as A

T0 = dt.datetime(2024, 1, 1)


def _ev(spark):
    rows = [
        (1, T0, "view"), (1, T0 + dt.timedelta(hours=12), "view"),            # exactly one gap: same session
        (1, T0 + dt.timedelta(hours=24, seconds=1), "purchase"),               # > gap: new session
        (2, T0, "view"), (2, T0 + dt.timedelta(minutes=30), "purchase"),
        (3, T0, "view"),
    ]
    return spark.createDataFrame(rows, "viewer int, ts timestamp, event_type string")


def test_sessions_gap_boundary(spark):
    s = A.sessions(_ev(spark), gap="12 hours").orderBy("viewer", "start").collect()
    assert [(r.viewer, r.n_events, r.reached_end) for r in s] == [(1, 2, False), (1, 1, True), (2, 2, True), (3, 1, False)]
    m = A.playback_metrics(A.sessions(_ev(spark)), horizon_s=3600).first()
    assert m.views == 4 and m.retention_h == 0.25 and m.completion_rate == 0.5


def test_retention_curve_never_increases(spark):
    curve = A.retention_curve(A.sessions(_ev(spark)), 3600).orderBy("bucket").collect()
    alive = [r.alive for r in curve]
    assert alive[0] == 4 and all(a >= b for a, b in zip(alive, alive[1:]))
    assert sum(r.drop for r in curve) == alive[0] - alive[-1]
    seg = A.segment_findings(A.retention_curve(A.sessions(_ev(spark)), 3600), 3600, 3600).collect()
    assert sum(r.total_drop for r in seg) == alive[0] - alive[-1]
    assert {r.kind for r in seg} <= {"opening_loss", "sag", "highlight", "steady"}


def test_pacing_ratio(spark):
    p = A.pacing(_ev(spark), bucket="1 hour").collect()
    assert abs(sum(r.ratio for r in p) / len(p) - 1.0) < 1e-12
    assert spark.range(1).select(A.fmt_offset(F.lit(3725))).first()[0] == "01:02:05"


def _python_sessions(rows, gap_s):
    out = []
    by_viewer = {}
    for v, t, e in rows:
        by_viewer.setdefault(v, []).append((t, e))
    for v, evs in by_viewer.items():
        evs.sort()
        cur = None
        for t, e in evs:
            if cur is None or (t - cur[1]).total_seconds() > gap_s:
                if cur:
                    out.append((v,) + tuple(cur))
                cur = [t, t, 0, False]
            cur[1] = t
            cur[2] += 1
            cur[3] = cur[3] or e == "purchase"
        out.append((v,) + tuple(cur))
    return sorted(out)


def test_chunked_sessions_equal_global_sessionisation(spark):
    import random
    rnd = random.Random(3)
    rows = []
    for v in range(5):
        t = T0
        for _ in range(rnd.randint(1, 60)):
            t = t + dt.timedelta(seconds=rnd.choice([1, 30, 59, 60, 61, 600, 3600, 7200]))
            rows.append((v, t, rnd.choice(["view", "purchase"])))
    ev = spark.createDataFrame(rows, "viewer int, ts timestamp, event_type string")
    expect = _python_sessions(rows, 60)
    for chunk in ["1 minutes", "1 hours", "1000 days"]:
        got = sorted((r.viewer, r.start, r.end, r.n_events, r.reached_end)
                     for r in A.sessions(ev, gap="60 seconds", chunk=chunk).collect())
        assert got == expect, chunk


def test_curves_of_several_videos_stand_alone(spark):
    second = _ev(spark).filter("viewer < 3").withColumn("ts", F.expr("ts + interval 40 days"))
    both = _ev(spark).withColumn("video", F.lit("a")).unionByName(second.withColumn("video", F.lit("b")))
    curve = A.retention_curve(A.sessions(both, by=["video"]), 3600, by=["video"])
    for video, ev in (("a", _ev(spark)), ("b", second)):
        alone = A.retention_curve(A.sessions(ev), 3600)
        assert sorted(map(tuple, curve.filter(F.col("video") == video).drop("video").collect())) == sorted(map(tuple, alone.collect()))
        found = A.segment_findings(curve, 3600, 3600, by=["video"]).filter(F.col("video") == video).drop("video")
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, A.segment_findings(alone, 3600, 3600).collect()))
        paced = A.pacing(both, by=["video"]).filter(F.col("video") == video).drop("video")
        assert sorted(map(tuple, paced.collect())) == sorted(map(tuple, A.pacing(ev).collect()))


def test_curve_sums_in_groups(spark, monkeypatch):
    ev = _ev(spark)
    want = [tuple(r) for r in A.retention_curve(A.sessions(ev), 60).orderBy("bucket").collect()]
    monkeypatch.setattr(A, "GROUP_BUCKETS", 2)
    assert [tuple(r) for r in A.retention_curve(A.sessions(ev), 60).orderBy("bucket").collect()] == want and len(want) > 4
