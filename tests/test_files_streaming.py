import os
import time

from pyspark.sql import functions as F

from inkwell.operators import documents as D

from inkwell.sinks import write_reports
from inkwell.sources import files as S
from inkwell.streaming.ingest import ingest_stream, read_newest


def _write(path, text, mtime=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    if mtime:
        os.utime(path, (mtime, mtime))


def test_scan_documents_and_listing(spark, tmp_path):
    d = tmp_path / "raw"
    _write(str(d / "WMT_raw_20260524_171003.txt"), "wmt\nline2", 1000)
    _write(str(d / "LULU_raw.md"), "lulu", 2000)
    _write(str(d / "notes.pdf"), "skip", 3000)
    docs = {r.name: r for r in S.scan_documents(spark, str(d), kind="raw").collect()}
    assert set(docs) == {"WMT_raw_20260524_171003.txt", "LULU_raw.md"}
    assert docs["WMT_raw_20260524_171003.txt"].content == "wmt\nline2"
    assert docs["WMT_raw_20260524_171003.txt"].label == "WMT"
    listing = S.scan_listing(spark, str(d)).orderBy(F.col("mtime").desc()).first()
    assert listing.name == "LULU_raw.md"
    latest = S.read_latest(spark, str(d)).collect()
    assert [(r.name, r.content, r.label) for r in latest] == [("LULU_raw.md", "lulu", "LULU")]
    both = S.union_sources(S.scan_documents(spark, str(d), glob="*.txt"), S.scan_documents(spark, str(d), glob="*.md"))
    assert both.count() == 2


def test_scan_pairs_skips_dot_folders(spark, tmp_path):
    h = tmp_path / "hist"
    _write(str(h / "A解析_1" / D.DRAFT_NAME), "draft")
    _write(str(h / "A解析_1" / D.FINAL_NAME), "final")
    _write(str(h / ".hidden" / D.DRAFT_NAME), "x")
    _write(str(h / "A B+1" / D.DRAFT_NAME), "spaced")
    _write(str(h / "top.md"), "x")
    _write(str(h / "A解析_1" / "deeper" / D.DRAFT_NAME), "x")
    rows = {(r.dir, r.name) for r in S.scan_pairs(spark, str(h)).collect()}
    assert rows == {("A解析_1", D.DRAFT_NAME), ("A解析_1", D.FINAL_NAME), ("A B+1", D.DRAFT_NAME)}


def test_read_latest_takes_the_name_literally(spark, tmp_path):
    _write(str(tmp_path / "a b[1]{x}.txt"), "odd")
    assert [r.content for r in S.read_latest(spark, str(tmp_path)).collect()] == ["odd"]


def test_required_documents_and_metric_files(spark, tmp_path):
    c = tmp_path / "config"
    _write(str(c / "persona.md"), "p")
    _write(str(c / "frameworks.md"), "")
    got = {r.name: (r.content, r.ok) for r in
           S.required_documents(spark, str(c), ["persona.md", "frameworks.md", "Master_Rulebook.md"]).collect()}
    assert got == {"persona.md": ("p", True), "frameworks.md": ("", False), "Master_Rulebook.md": ("", False)}
    m = tmp_path / "metrics"
    _write(str(m / "v1.json"), '{"views": 10}')
    _write(str(m / "v2.csv"), "views,retention_5s\n20,0.5\n")
    got = {r.video_id: r.file_content for r in S.scan_metric_files(spark, str(m)).collect()}
    assert set(got) == {"v1", "v2"}


def test_load_company(spark, tmp_path):
    p = tmp_path / "company.json"
    _write(str(p), '{"ticker": "HIMS", "forwardPE": 18.459074, "other": 1}\n{"ticker": "WMT"}\n')
    rows = {r.ticker: r for r in S.load_company(spark, str(p)).collect()}
    assert rows["HIMS"].forwardPE == 18.459074 and rows["WMT"].marketCap is None


def test_write_reports_partitioned(spark, tmp_path):
    df = spark.createDataFrame([("WMT", "a"), ("LULU", "b")], "label string, content string")
    out = str(tmp_path / "cards")
    import datetime as dt
    write_reports(df, out, "card", F.lit(dt.datetime(2026, 5, 26, 19, 29, 36)))
    back = spark.read.parquet(out)
    assert {r.name for r in back.collect()} == {"card_20260526_192936_WMT.md", "card_20260526_192936_LULU.md"}
    assert os.path.isdir(os.path.join(out, "kind=card", "run_ts=20260526_192936"))
    years = spark.createDataFrame([("2026", "a"), ("2027", "b")], "label string, content string")
    for _ in range(2):                  # the same run again leaves no doubles, and other runs stay
        write_reports(years, out, "card", F.lit(dt.datetime(2026, 6, 1)))
    assert sorted(r.label for r in spark.read.parquet(out).collect()) == ["2026", "2027", "LULU", "WMT"]


def test_ingest_stream_newest_per_label(spark, tmp_path):
    src = tmp_path / "in"
    _write(str(src / "WMT_raw_20260101_000000.txt"), "old", time.time() - 100)
    _write(str(src / "LULU_raw.md"), "lulu", time.time() - 50)
    table, ckpt = str(tmp_path / "table"), str(tmp_path / "ckpt")
    ingest_stream(spark, str(src), table, ckpt).awaitTermination()
    _write(str(src / "WMT_raw_20260102_000000.txt"), "new", time.time())
    ingest_stream(spark, str(src), table, ckpt).awaitTermination()
    got = {r.label: r.content for r in read_newest(spark, table).collect()}
    assert got == {"WMT": "new", "LULU": "lulu"}


def test_fresh_checkpoint_goes_on_with_the_table(spark, tmp_path):
    src, table = tmp_path / "in", str(tmp_path / "table")
    for i, text in enumerate(["old", "mid"]):
        _write(str(src / f"WMT_raw_2026010{i + 1}_000000.txt"), text, time.time() - 100 + i)
        ingest_stream(spark, str(src), table, str(tmp_path / "ckpt")).awaitTermination()
    _write(str(src / "WMT_raw_20260103_000000.txt"), "new", time.time())
    ingest_stream(spark, str(src), table, str(tmp_path / "other")).awaitTermination()
    assert [r.content for r in read_newest(spark, table).collect()] == ["new"]
    assert len([n for n in os.listdir(table) if n.startswith("v=")]) == 2
    os.makedirs(os.path.join(table, "v=99"))             # a write that broke off
    assert [r.content for r in read_newest(spark, table).collect()] == ["new"]


def test_ingest_epoch_replay_is_idempotent(spark, tmp_path):
    import datetime as dt
    from inkwell.streaming.ingest import _merge_newest
    table = str(tmp_path / "t")
    merge = _merge_newest(table)
    b0 = spark.createDataFrame([("WMT_raw.txt", dt.datetime(2026, 1, 1), "a", "WMT")],
                               "name string, mtime timestamp, content string, label string")
    b1 = spark.createDataFrame([("WMT_raw_2.txt", dt.datetime(2026, 1, 2), "b", "WMT"),
                                ("LULU_raw.md", dt.datetime(2026, 1, 2), "c", "LULU")],
                               "name string, mtime timestamp, content string, label string")
    merge(b0, 0)
    merge(b1, 1)
    first = sorted(tuple(r) for r in read_newest(spark, table).collect())
    merge(b1, 1)            # the same epoch replayed after a failure
    assert sorted(tuple(r) for r in read_newest(spark, table).collect()) == first
    assert {r.label: r.content for r in read_newest(spark, table).collect()} == {"WMT": "b", "LULU": "c"}


def _data_folders(table):
    return {os.path.join(v, b) for v in os.listdir(os.path.join(table, "data"))
            for b in os.listdir(os.path.join(table, "data", v)) if b.startswith("bucket=")}


def test_a_batch_writes_the_buckets_it_touches_only(spark, tmp_path):
    import datetime as dt
    from inkwell.streaming.ingest import BUCKETS, _merge_newest, _newest
    table, schema = str(tmp_path / "t"), "name string, mtime timestamp, content string, label string"
    merge = _merge_newest(table)
    day = dt.datetime(2026, 1, 1)
    many = spark.range(20_000).select(F.concat(F.lit("f"), "id").alias("name"), F.lit(day).alias("mtime"),
                                      F.concat(F.lit("text "), "id").alias("content"), F.concat(F.lit("L"), "id").alias("label"))
    merge(many, 0)
    before = _data_folders(table)
    assert len(before) == BUCKETS
    new = [(f"g{i}", day + dt.timedelta(days=i - 1), f"new {i}", f"L{i}") for i in range(3)] + [("h", day, "h", "another")]
    merge(spark.createDataFrame(new, schema), 1)
    assert 1 <= len(_data_folders(table) - before) <= 4 and before <= _data_folders(table)     # the older version is kept
    got = {r.label: r.content for r in read_newest(spark, table).collect()}
    want = {f"L{i}": f"text {i}" for i in range(20_000)} | {"L2": "new 2", "another": "h"}     # L0 is older, L1 ties: f1 < g1
    assert got == want
    merge(spark.createDataFrame([], schema), 2)                  # an empty batch makes no version
    assert max(int(n[2:]) for n in os.listdir(table) if n.startswith("v=")) == 1
    merge(spark.createDataFrame(new, schema), 3)
    merge(spark.createDataFrame(new, schema), 4)
    named = set(_newest(spark, table)[0].values())
    assert len(named) == BUCKETS and len(_data_folders(table)) <= BUCKETS + 4                  # replaced buckets are gone
    assert {r.label: r.content for r in read_newest(spark, table).collect()} == want


def test_data_without_a_manifest_is_never_read(spark, tmp_path):
    import datetime as dt
    from inkwell.streaming.ingest import _merge_newest
    table, schema = str(tmp_path / "t"), "name string, mtime timestamp, content string, label string"
    merge = _merge_newest(table)
    merge(spark.createDataFrame([("a", dt.datetime(2026, 1, 1), "one", "A")], schema), 0)
    os.makedirs(os.path.join(table, "data", "v=7", "bucket=1"))           # broke off before its manifest
    os.makedirs(os.path.join(table, "v=6"))                               # broke off within it
    assert [r.content for r in read_newest(spark, table).collect()] == ["one"]
    merge(spark.createDataFrame([("b", dt.datetime(2026, 1, 2), "two", "A")], schema), 1)
    assert [r.content for r in read_newest(spark, table).collect()] == ["two"]
    assert "v=8" in os.listdir(table) and "v=7" not in os.listdir(os.path.join(table, "data"))


def test_report_partitions_are_pruned(spark, tmp_path):
    import contextlib
    import datetime as dt
    import io
    out = str(tmp_path / "reports")
    df = spark.createDataFrame([("WMT", "a")], "label string, content string")
    write_reports(df, out, "raw", F.lit(dt.datetime(2026, 1, 1)))
    write_reports(df, out, "raw", F.lit(dt.datetime(2026, 1, 2)))
    q = spark.read.parquet(out).filter((F.col("run_ts") == "20260102_000000") & (F.col("label") == "WMT"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain()
    assert "PartitionFilters" in buf.getvalue() and q.count() == 1
