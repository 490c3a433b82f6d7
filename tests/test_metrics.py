from pyspark.sql import functions as F

from inkwell.operators import metrics as M

INPUTS = [
    ("inline_bad", "{not json", '{"views": 5}'),               # inline wins even if it fails
    ("inline_ok", '{"views": 777, "extra": "x"}', None),
    ("json", None, '{"views": 100, "retention_5s": 0.62}'),
    ("csv", None, "views,retention_5s,completion_rate\n200,0.7,0.25\n999,0.1,0.1"),
    ("csv_short", None, "views,retention_5s,completion_rate\n300"),
    ("csv_str", None, "views,retention_5s\nlots,0.5"),
    ("one_line", None, "views,retention_5s"),
    ("none", None, None),
]


def _merged(spark):
    inp = spark.createDataFrame(INPUTS, "video_id string, inline string, file_content string")
    return {r.video_id: r for r in M.merge_metrics(inp).collect()}


def test_precedence_and_parsing(spark):
    m = _merged(spark)
    assert (m["inline_bad"].views, m["inline_bad"].parsed) == (12000.0, False)
    assert m["inline_ok"].views == 777.0 and m["inline_ok"].extra == {"extra": "x"}
    assert (m["json"].views, m["json"].retention_5s, m["json"].completion_rate) == (100.0, 0.62, 0.18)
    assert (m["csv"].views, m["csv"].retention_5s, m["csv"].completion_rate) == (200.0, 0.7, 0.25)
    assert (m["csv_short"].views, m["csv_short"].retention_5s) == (300.0, 0.45)
    assert (m["csv_str"].views, m["csv_str"].retention_5s) == (12000.0, 0.5)
    assert m["one_line"].parsed is False and m["none"].views == 12000.0


def test_infer_scalar(spark):
    df = spark.createDataFrame([("1.5",), ("12",), ("abc",), ("1.2.3",)], "v string")
    inf = M.infer_scalar("v")
    assert [tuple(r) for r in df.select(inf["kind"], inf["double_value"]).collect()] == \
        [("float", 1.5), ("int", 12.0), ("string", None), ("string", None)]


def test_overview_grade_and_json(spark):
    inp = spark.createDataFrame(INPUTS, "video_id string, inline string, file_content string")
    merged = M.merge_metrics(inp)
    ov = {r.video_id: r for r in M.audit_overview(merged).collect()}
    assert (ov["none"].retention_pct, ov["none"].loss_pct, ov["none"].completion_pct) == ("45.0", "55.0", "18.0")
    g, red = M.benchmark_grade(F.col("retention_5s"))
    got = {r.video_id: (r[1], r[2]) for r in merged.select("video_id", g, red).collect()}
    assert got["none"] == ("warning", True) and got["json"] == ("good", False) and got["csv"] == ("good", False)
    js = {r.video_id: r.metrics_json for r in M.metrics_json(merged).collect()}
    assert js["inline_ok"] == '{\n    "views": 777,\n    "retention_5s": 0.45,\n    "completion_rate": 0.18,\n    "extra": "x"\n}'


def test_repeated_columns_suffixes_and_loose_json(spark):
    from inkwell.operators import metrics as X
    rows = [("a", None, "views,views\n5,7"), ("b", "{'views': 5}", None), ("c", '{"views": "0.5d"}', None)]
    df = spark.createDataFrame(rows, "video_id string, inline string, file_content string")
    got = {r.video_id: r.views for r in X.merge_metrics(df).collect()}
    assert got == {"a": 7.0, "b": 12000.0, "c": 12000.0}   # last column; not JSON; not a number


def test_json_of_each_type_is_python_s(spark):
    import json
    texts = ['{"views": 9, "x": 1, "views": 2, "x": "é/\\n"}', '{"a": 7, "b": true, "c": null, "d": 5.0, "e": 0.50, "f": 1e22, "g": -3}',
             "{}", '{"views": 5} xyz', "likes,likes,n\n1,2.50,0.5d", "views\n12"]
    df = spark.createDataFrame([(str(i), None, t) for i, t in enumerate(texts)], "video_id string, inline string, file_content string")
    got = {r.video_id: r.metrics_json for r in M.metrics_json(M.merge_metrics(df)).collect()}
    base = {"views": 12000, "retention_5s": 0.45, "completion_rate": 0.18}
    for i in (0, 1, 2):
        assert got[str(i)] == json.dumps(base | json.loads(texts[i]), ensure_ascii=False, indent=4)
    assert got["3"] == json.dumps(base, indent=4)
    assert got["4"] == json.dumps(base | {"likes": 2.5, "n": "0.5d"}, indent=4)
    assert got["5"] == json.dumps(base | {"views": 12}, indent=4)


def test_merge_needs_no_shuffle(spark):
    df = spark.createDataFrame([("a", None, "{}")], "video_id string, inline string, file_content string")
    assert "Exchange" not in M.merge_metrics(df)._jdf.queryExecution().executedPlan().toString()
