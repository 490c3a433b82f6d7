"""Metrics and audience bindings.

Metrics inputs are built per event (video = event_id): clicks carry their
``props`` JSON inline; the file content is a JSON object for purchases,
a header + 1-row CSV for signups, ``props`` for views and a malformed or
partly non-numeric text for errors.

Playback = ``events``: viewer = user_id, gap 12 hours, horizon 1 hour,
end event ``purchase``, buckets of 1 hour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions.fmt import fixed
from inkwell.operators import audience as A
from inkwell.operators import documents as D
from inkwell.operators import metrics as M
from inkwell.plans.tables import load

GAP = "12 hours"
GAP_US = 12 * 3600 * 1_000_000
HORIZON_S = 3600
BUCKET_S = 3600


def _metric_inputs(spark, d) -> DataFrame:
    ev = load(spark, d, "events")
    uid10 = (F.col("user_id") * 10).cast("string")
    f = (F.when(F.col("event_type") == "purchase",
                F.concat(F.lit('{"views": '), uid10, F.lit(', "retention_5s": '), fixed(F.col("value") / 100, 4),
                         F.lit(', "note": "'), F.col("event_type"), F.lit('"}')))
         .when(F.col("event_type") == "signup",
               F.concat(F.lit("views,retention_5s,completion_rate\n"), uid10, F.lit(","),
                        fixed(F.col("value") / 100, 4), F.lit(","), fixed(F.col("value") / 200, 4), F.lit("\n")))
         .when(F.col("event_type") == "view", F.col("props"))
         .when((F.col("event_type") == "error") & (F.col("value") > 25),
               F.concat(F.lit("views,retention_5s\nlots,"), fixed(F.col("value") / 100, 2)))
         .when(F.col("event_type") == "error", F.lit("views;broken")))
    inline = F.when(F.col("event_type") == "click", F.col("props"))
    return ev.select(F.col("event_id").alias("video_id"), inline.alias("inline"), f.alias("file_content"))


def _merged(spark, d) -> DataFrame:
    return M.merge_metrics(_metric_inputs(spark, d))


def q_metric_values(spark, d) -> DataFrame:
    p = M.scan_metrics(_metric_inputs(spark, d))
    inf = M.infer_scalar("value")
    # the typed value (raw number spelling differs between JSON readers)
    return p.select("video_id", "source", "metric", inf["kind"].alias("kind"),
                    inf["double_value"].alias("num"),
                    F.when(inf["kind"] == "string", F.col("value")).alias("text_value"))


def q_merged_metrics(spark, d) -> DataFrame:
    m = _merged(spark, d)
    return m.select("video_id", "views", "retention_5s", "completion_rate",
                    F.size("extra").cast("long").alias("n_extra"), "parsed")


def q_metrics_json(spark, d) -> DataFrame:
    return M.metrics_json(_merged(spark, d))


def q_audit_overview(spark, d) -> DataFrame:
    m = _merged(spark, d)
    grade, red = M.benchmark_grade(F.col("retention_5s"))
    return M.audit_overview(m.withColumns({"grade": grade, "red": red}), keep=["grade", "red"])


# ------------------------------------------------------------------ audience

def _sessions(spark, d) -> DataFrame:
    ev = load(spark, d, "events").select(F.col("user_id").alias("viewer"), "ts", "event_type")
    return A.sessions(ev, gap=GAP, end_event="purchase")


def q_playback_sessions(spark, d) -> DataFrame:
    s = _sessions(spark, d)
    return s.select("viewer", F.date_format("start", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("start"),
                    F.date_format("end", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("end"), "n_events", "reached_end",
                    "duration_us")


def q_playback_metrics(spark, d) -> DataFrame:
    return A.playback_metrics(_sessions(spark, d), HORIZON_S)


def q_retention_curve(spark, d) -> DataFrame:
    return A.retention_curve(_sessions(spark, d), BUCKET_S)


def q_segment_findings(spark, d) -> DataFrame:
    return A.segment_findings(A.retention_curve(_sessions(spark, d), BUCKET_S), BUCKET_S, HORIZON_S)


def q_pacing(spark, d) -> DataFrame:
    p = A.pacing(load(spark, d, "events"), bucket="1 hour")
    return p.select(F.date_format("bucket_start", "yyyy-MM-dd HH:mm:ss").alias("bucket_start"), "n", "ratio")


def _video_events(spark, d) -> DataFrame:
    """Events by video; a video is a month of events."""
    return load(spark, d, "events").select(F.date_format("ts", "yyyy-MM").alias("video"), F.col("user_id").alias("viewer"), "ts", "event_type")


def _video_curve(spark, d) -> DataFrame:
    s = A.sessions(_video_events(spark, d), gap=GAP, end_event="purchase", by=["video"])
    return A.retention_curve(s, BUCKET_S, by=["video"])


def q_retention_curve_by_video(spark, d) -> DataFrame:
    return _video_curve(spark, d)


def q_segment_findings_by_video(spark, d) -> DataFrame:
    return A.segment_findings(_video_curve(spark, d), BUCKET_S, HORIZON_S, by=["video"])


def q_pacing_by_video(spark, d) -> DataFrame:
    p = A.pacing(_video_events(spark, d), bucket="1 hour", by=["video"])
    return p.select("video", F.date_format("bucket_start", "yyyy-MM-dd HH:mm:ss").alias("bucket_start"), "n", "ratio")


def q_audit_report(spark, d) -> DataFrame:
    """One report over all playback: the report key is the month of the
    newest event (a data-derived key, so overview and findings meet in a
    real equi-join)."""
    from pyspark.sql import Window
    run_ts = load(spark, d, "events").select(F.max("ts")).scalar()
    key = F.date_format(run_ts, "yyyy-MM")
    sess = _sessions(spark, d)
    pm = A.playback_metrics(sess, HORIZON_S).select(
        key.alias("video"), "views", F.col("retention_h").alias("retention_5s"), "completion_rate")
    grade, _ = M.benchmark_grade(F.col("retention_5s"))
    ov = M.audit_overview(pm.withColumn("grade", grade), key="video", keep=["grade"])
    seg = A.segment_findings(A.retention_curve(sess, BUCKET_S), BUCKET_S, HORIZON_S)
    f = seg.select(
        key.alias("video"),
        F.row_number().over(Window.orderBy("from_bucket")).alias("seq"), "kind",
        A.fmt_offset(F.col("from_bucket") * BUCKET_S).alias("from_s"),
        A.fmt_offset((F.col("to_bucket") + 1) * BUCKET_S).alias("to_s"),
        F.concat(F.lit("sessions lost: "), F.col("total_drop").cast("string")).alias("detail"))
    r = M.audit_report(ov, f, "video", run_ts)
    return r.select("video", "n_findings", F.length("content").cast("long").alias("n_chars"),
                    F.md5("content").alias("content_md5"))


def _typed_events(spark, d) -> DataFrame:
    """Events by video; a video is one event type in one month."""
    return load(spark, d, "events").select(F.concat_ws("-", F.date_format("ts", "yyyy-MM"), "event_type").alias("video"),
                                           F.col("user_id").alias("viewer"), "ts", "event_type", "value")


def q_audit_step(spark, d) -> DataFrame:
    """Prompt and report of every video.  Stated metrics: clicks as inline JSON, errors
    none at all (the defaults hold), the other types as a CSV file."""
    from inkwell.plans import workflows as W
    ev = _typed_events(spark, d)
    n = F.count(F.lit(1))
    share = lambda limit: F.floor(10000 * F.count(F.when(F.col("value") > limit, 1)) / n).cast("decimal(5,0)") * F.lit("0.0001").cast("decimal(5,4)")
    stated = ev.groupBy("video").agg(F.min("event_type").alias("type"), n.cast("string").alias("n"),
                                     share(10).cast("string").alias("r"), share(40).cast("string").alias("c"))
    inputs = stated.select(
        "video", F.when(F.col("type") == "click", F.concat(F.lit('{"views": '), "n", F.lit(', "note": "'), "type", F.lit('"}'))).alias("inline"),
        F.when(~F.col("type").isin("click", "error"), F.concat(F.lit("views,retention_5s,completion_rate\n"), F.concat_ws(",", "n", "r", "c")))
        .alias("file_content"))
    run_ts = load(spark, d, "events").select(F.max("ts")).scalar()
    out = W.audit_step(inputs, ev, run_ts, BUCKET_S, HORIZON_S, GAP, "purchase", key="video")
    prompts = out["prompts"].select("video", F.md5("system").alias("system_md5"), F.md5("prompt").alias("prompt_md5"))
    reports = out["reports"].select("video", "n_findings", F.length("content").cast("long").alias("n_chars"),
                                    F.md5("content").alias("content_md5"))
    return prompts.join(reports, "video")


QUERIES = {
    "audit_step": q_audit_step,
    "metric_values": q_metric_values,
    "merged_metrics": q_merged_metrics,
    "metrics_json": q_metrics_json,
    "audit_overview": q_audit_overview,
    "playback_sessions": q_playback_sessions,
    "playback_metrics": q_playback_metrics,
    "retention_curve": q_retention_curve,
    "segment_findings": q_segment_findings,
    "pacing": q_pacing,
    "audit_report": q_audit_report,
    "retention_curve_by_video": q_retention_curve_by_video,
    "segment_findings_by_video": q_segment_findings_by_video,
    "pacing_by_video": q_pacing_by_video,
}

# ----------------------------------------------------------------- DuckDB SQL

_INPUTS = r"""
inp AS (SELECT event_id AS video_id,
  CASE WHEN event_type = 'click' THEN props END AS inline,
  CASE WHEN event_type = 'purchase' THEN '{"views": ' || CAST(user_id * 10 AS VARCHAR) || ', "retention_5s": '
            || printf('%.4f', value / 100) || ', "note": "' || event_type || '"}'
       WHEN event_type = 'signup' THEN 'views,retention_5s,completion_rate' || chr(10) || CAST(user_id * 10 AS VARCHAR)
            || ',' || printf('%.4f', value / 100) || ',' || printf('%.4f', value / 200) || chr(10)
       WHEN event_type = 'view' THEN props
       WHEN event_type = 'error' AND value > 25 THEN 'views,retention_5s' || chr(10) || 'lots,' || printf('%.2f', value / 100)
       WHEN event_type = 'error' THEN 'views;broken' END AS file_content
  FROM events),
cls AS (SELECT video_id, inline, file_content,
  nullif(inline, '') IS NOT NULL AS has_inline,
  coalesce(CASE WHEN json_valid(file_content) THEN json_type(file_content::JSON) = 'OBJECT' END, false) AS file_json
  FROM inp),
jsrc AS (SELECT video_id, CASE WHEN has_inline THEN 'inline' ELSE 'json' END AS source,
                CASE WHEN has_inline THEN inline ELSE file_content END AS j FROM cls
         WHERE (has_inline AND coalesce(CASE WHEN json_valid(inline) THEN json_type(inline::JSON) = 'OBJECT' END, false))
            OR (NOT has_inline AND file_json)),
jkv AS (SELECT video_id, source, k AS metric, json_extract_string(j, '$."' || k || '"') AS value
        FROM (SELECT video_id, source, j, unnest(json_keys(j::JSON)) AS k FROM jsrc)),
csrc AS (SELECT video_id, string_split(regexp_replace(file_content, '\n\z', ''), chr(10)) AS lines FROM cls
         WHERE NOT has_inline AND file_content IS NOT NULL AND NOT file_json),
cpair AS (SELECT video_id, string_split(trim(lines[1]), ',') AS h, string_split(trim(lines[2]), ',') AS v
          FROM csrc WHERE len(lines) > 1),
ckv AS (SELECT video_id, 'csv' AS source, h[i] AS metric, v[i] AS value
        FROM (SELECT video_id, h, v, unnest(range(1, least(len(h), len(v)) + 1)) AS i FROM cpair)),
kv AS (SELECT * FROM jkv UNION ALL SELECT * FROM ckv),
typed AS (SELECT *, CASE WHEN contains(value, '.') THEN TRY_CAST(value AS DOUBLE) END AS d,
                    CASE WHEN NOT contains(value, '.') THEN TRY_CAST(value AS BIGINT) END AS l FROM kv),
merged AS (SELECT i.video_id,
     coalesce(max(CASE WHEN t.metric = 'views' THEN coalesce(t.d, CAST(t.l AS DOUBLE)) END), 12000.0) AS views,
     coalesce(max(CASE WHEN t.metric = 'retention_5s' THEN coalesce(t.d, CAST(t.l AS DOUBLE)) END), 0.45) AS retention_5s,
     coalesce(max(CASE WHEN t.metric = 'completion_rate' THEN coalesce(t.d, CAST(t.l AS DOUBLE)) END), 0.18) AS completion_rate,
     CAST(count(DISTINCT t.metric) FILTER (WHERE t.metric NOT IN ('views', 'retention_5s', 'completion_rate')) AS BIGINT) AS n_extra,
     count(t.metric) > 0 AS parsed
   FROM inp i LEFT JOIN typed t ON t.video_id = i.video_id GROUP BY i.video_id)"""

_SESS = f"""
e AS (SELECT user_id AS viewer, ts, event_type,
             CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                    OR epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) > {GAP_US}
                  THEN 1 ELSE 0 END AS new_s FROM events),
e2 AS (SELECT *, sum(new_s) OVER (PARTITION BY viewer ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM e),
sess AS (SELECT viewer, min(ts) AS "start", max(ts) AS "end", CAST(count(*) AS BIGINT) AS n_events,
                bool_or(event_type = 'purchase') AS reached_end,
                epoch_us(max(ts)) - epoch_us(min(ts)) AS duration_us
         FROM e2 GROUP BY viewer, sid)"""

_CURVE = f"""
hist AS (SELECT CAST(floor(duration_us / {BUCKET_S * 1_000_000}) AS BIGINT) AS bucket, count(*) AS ended
         FROM sess GROUP BY 1),
grid AS (SELECT unnest(range(0, (SELECT max(bucket) FROM hist) + 1)) AS bucket),
dense AS (SELECT g.bucket, coalesce(h.ended, 0) AS ended FROM grid g LEFT JOIN hist h ON h.bucket = g.bucket),
alive AS (SELECT bucket, sum(ended) OVER (ORDER BY bucket DESC ROWS UNBOUNDED PRECEDING) AS alive FROM dense),
curve AS (SELECT CAST(bucket AS BIGINT) AS bucket, CAST(alive AS BIGINT) AS alive,
                 CAST(coalesce(lag(alive) OVER (ORDER BY bucket) - alive, 0) AS BIGINT) AS "drop" FROM alive)"""

_SEG = f"""
c1 AS (SELECT *, sum("drop") OVER () AS s_, count(*) OVER () AS n_ FROM curve WHERE bucket >= 1),
k AS (SELECT *, CASE WHEN bucket <= {-(-HORIZON_S // BUCKET_S)} THEN 'opening_loss'
                     WHEN "drop" * n_ > s_ THEN 'sag'
                     WHEN "drop" * n_ * 4 < s_ THEN 'highlight' ELSE 'steady' END AS kind FROM c1),
isl AS (SELECT *, bucket - row_number() OVER (PARTITION BY kind ORDER BY bucket) AS grp FROM k),
seg AS (SELECT kind, min(bucket) AS from_bucket, max(bucket) AS to_bucket, CAST(sum("drop") AS BIGINT) AS total_drop
        FROM isl GROUP BY kind, grp)"""


_VIDEO_CURVE = f"""
e AS (SELECT strftime(ts, '%Y-%m') AS video, user_id AS viewer, ts FROM events),
e1 AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) <= {GAP_US} THEN 0 ELSE 1 END AS new_s
       FROM e WINDOW w AS (PARTITION BY video, viewer ORDER BY ts)),
e2 AS (SELECT *, sum(new_s) OVER (PARTITION BY video, viewer ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM e1),
lens AS (SELECT video, CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / {BUCKET_S * 1_000_000}) AS BIGINT) AS l
         FROM e2 GROUP BY video, viewer, sid),
hist AS (SELECT video, l, count(*) AS n FROM lens GROUP BY ALL),
grid AS (SELECT video, unnest(range(0, max(l) + 1)) AS bucket FROM hist GROUP BY video),
lives AS (SELECT g.video, g.bucket, sum(h.n) AS alive FROM grid g JOIN hist h ON h.video = g.video AND h.l >= g.bucket GROUP BY ALL),
curve AS (SELECT video, CAST(bucket AS BIGINT) AS bucket, CAST(alive AS BIGINT) AS alive,
                 CAST(coalesce(lag(alive) OVER (PARTITION BY video ORDER BY bucket) - alive, 0) AS BIGINT) AS "drop" FROM lives)"""


def _offset(x: str) -> str:
    return (f"lpad(CAST(({x}) // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST((({x}) % 3600) // 60 AS VARCHAR), 2, '0')"
            f" || ':' || lpad(CAST(({x}) % 60 AS VARCHAR), 2, '0')")


ORACLE = {
    "metric_values": f"""WITH {_INPUTS}
        SELECT video_id, source, metric,
               CASE WHEN d IS NOT NULL THEN 'float' WHEN l IS NOT NULL THEN 'int' ELSE 'string' END AS kind,
               coalesce(d, CAST(l AS DOUBLE)) AS num,
               CASE WHEN d IS NULL AND l IS NULL THEN value END AS text_value FROM typed""",
    "merged_metrics": f"WITH {_INPUTS} SELECT * FROM merged",
    "metrics_json": f"""WITH {_INPUTS},
        keyed AS (SELECT video_id, j, json_keys(j::JSON) AS ks FROM jsrc),
        jx AS (SELECT video_id, i, ks[i] AS metric, json_extract(j::JSON, '$."' || ks[i] || '"') AS x
               FROM (SELECT *, unnest(range(1, len(ks) + 1)) AS i FROM keyed)),
        cx AS (SELECT video_id, i, h[i] AS metric, v[i] AS x
               FROM (SELECT *, unnest(range(1, least(len(h), len(v)) + 1)) AS i FROM cpair)),
        t AS (SELECT video_id, i, metric, CASE WHEN json_type(x) = 'DOUBLE' THEN CAST(CAST(x AS DOUBLE) AS VARCHAR)
                                               ELSE CAST(x AS VARCHAR) END AS s FROM jx
              UNION ALL
              SELECT video_id, i, metric, CASE WHEN contains(x, '.') AND TRY_CAST(x AS DOUBLE) IS NOT NULL THEN CAST(CAST(x AS DOUBLE) AS VARCHAR)
                                               WHEN NOT contains(x, '.') AND TRY_CAST(x AS BIGINT) IS NOT NULL THEN CAST(CAST(x AS BIGINT) AS VARCHAR)
                                               ELSE CAST(to_json(x) AS VARCHAR) END FROM cx)
        SELECT i.video_id, '{{' || chr(10)
               || '    "views": ' || coalesce(max(CASE WHEN metric = 'views' THEN s END), '12000') || ',' || chr(10)
               || '    "retention_5s": ' || coalesce(max(CASE WHEN metric = 'retention_5s' THEN s END), '0.45') || ',' || chr(10)
               || '    "completion_rate": ' || coalesce(max(CASE WHEN metric = 'completion_rate' THEN s END), '0.18')
               || coalesce(string_agg(',' || chr(10) || '    ' || CAST(to_json(metric) AS VARCHAR) || ': ' || s, '' ORDER BY t.i)
                           FILTER (WHERE metric NOT IN ('views', 'retention_5s', 'completion_rate')), '')
               || chr(10) || '}}' AS metrics_json
        FROM inp i LEFT JOIN t ON t.video_id = i.video_id GROUP BY i.video_id""",
    "retention_curve_by_video": f"WITH {_VIDEO_CURVE} SELECT * FROM curve",
    "segment_findings_by_video": f"""WITH {_VIDEO_CURVE},
        c1 AS (SELECT *, sum("drop") OVER (PARTITION BY video) AS s_, count(*) OVER (PARTITION BY video) AS n_ FROM curve WHERE bucket >= 1),
        k AS (SELECT *, CASE WHEN bucket <= {-(-HORIZON_S // BUCKET_S)} THEN 'opening_loss' WHEN "drop" * n_ > s_ THEN 'sag'
                             WHEN "drop" * n_ * 4 < s_ THEN 'highlight' ELSE 'steady' END AS kind FROM c1),
        isl AS (SELECT *, bucket - row_number() OVER (PARTITION BY video, kind ORDER BY bucket) AS grp FROM k)
        SELECT video, kind, min(bucket) AS from_bucket, max(bucket) AS to_bucket, CAST(sum("drop") AS BIGINT) AS total_drop
        FROM isl GROUP BY video, kind, grp""",
    "pacing_by_video": """WITH g AS (SELECT strftime(ts, '%Y-%m') AS video, time_bucket(INTERVAL 1 HOUR, ts) AS b, count(*) AS n FROM events GROUP BY ALL)
        SELECT video, strftime(b, '%Y-%m-%d %H:%M:%S') AS bucket_start, CAST(n AS BIGINT) AS n,
               n * count(*) OVER (PARTITION BY video) / sum(n) OVER (PARTITION BY video) AS ratio FROM g""",
    "audit_overview": f"""WITH {_INPUTS}
        SELECT video_id, views, printf('%.1f', retention_5s * 100) AS retention_pct,
               printf('%.1f', 100.0 - retention_5s * 100) AS loss_pct, printf('%.1f', completion_rate * 100) AS completion_pct,
               CASE WHEN retention_5s < 0.6 THEN 'warning' WHEN retention_5s <= 0.7 THEN 'good' ELSE 'excellent' END AS grade,
               (1.0 - retention_5s) > 0.45 AS red
        FROM merged""",
    "playback_sessions": f"""WITH {_SESS}
        SELECT viewer, strftime("start", '%Y-%m-%d %H:%M:%S.%f') AS "start", strftime("end", '%Y-%m-%d %H:%M:%S.%f') AS "end",
               n_events, reached_end, duration_us FROM sess""",
    "playback_metrics": f"""WITH {_SESS}
        SELECT CAST(count(*) AS BIGINT) AS views,
               sum(CASE WHEN duration_us >= {HORIZON_S * 1_000_000} THEN 1 ELSE 0 END) / count(*) AS retention_h,
               sum(CASE WHEN reached_end THEN 1 ELSE 0 END) / count(*) AS completion_rate FROM sess""",
    "retention_curve": f"WITH {_SESS}, {_CURVE} SELECT * FROM curve",
    "segment_findings": f"WITH {_SESS}, {_CURVE}, {_SEG} SELECT * FROM seg",
    "pacing": """WITH g AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS b, count(*) AS n FROM events GROUP BY 1)
        SELECT strftime(b, '%Y-%m-%d %H:%M:%S') AS bucket_start, CAST(n AS BIGINT) AS n,
               n * count(*) OVER () / sum(n) OVER () AS ratio FROM g""",
    "audit_report": f"""WITH {_SESS}, {_CURVE}, {_SEG},
        pm AS (SELECT count(*) AS views,
                      sum(CASE WHEN duration_us >= {HORIZON_S * 1_000_000} THEN 1 ELSE 0 END) / count(*) AS r,
                      sum(CASE WHEN reached_end THEN 1 ELSE 0 END) / count(*) AS c FROM sess),
        f AS (SELECT row_number() OVER (ORDER BY from_bucket) AS seq, kind,
                     {_offset(f'from_bucket * {BUCKET_S}')} AS from_s, {_offset(f'(to_bucket + 1) * {BUCKET_S}')} AS to_s,
                     'sessions lost: ' || CAST(total_drop AS VARCHAR) AS detail FROM seg),
        fa AS (SELECT count(*) AS n_findings,
                 string_agg('### ' || kind || ' (' || from_s || ' - ' || to_s || ')' || chr(10) || detail || chr(10) || chr(10), '' ORDER BY seq) AS sections,
                 string_agg(CAST(seq AS VARCHAR) || '. ' || kind || ': ' || from_s || ' - ' || to_s || chr(10), '' ORDER BY seq) AS actions FROM f),
        rep AS (SELECT '{M.OVERVIEW_TITLE}' || chr(10) || chr(10) || '报告生成时间: ' || strftime((SELECT max(ts) FROM events), '%Y-%m-%d %H:%M:%S')
              || chr(10) || '{"=" * 72}' || chr(10) || chr(10) || '## 1. 核心表现数据分析 (Metrics Overview)' || chr(10)
              || '*   **本期视频播放量 (Views)**: ' || CAST(views AS VARCHAR) || chr(10)
              || '*   **前 5 秒保留率 (5s Retention)**: ' || printf('%.1f', r * 100) || '% ('
              || CASE WHEN r < 0.6 THEN 'warning' WHEN r <= 0.7 THEN 'good' ELSE 'excellent' END || ')' || chr(10)
              || '*   **全片完播率 (Completion Rate)**: ' || printf('%.1f', c * 100) || '%' || chr(10) || chr(10) || '---' || chr(10) || chr(10)
              || '## 2. 多模态表达诊断 (Speech & Tone Diagnostics)' || chr(10) || coalesce(sections, '')
              || '---' || chr(10) || chr(10) || '## 3. 下期迭代优化动作清单 (Action Items for Next Week)' || chr(10) || coalesce(actions, '') AS content,
              n_findings FROM pm, fa)
        SELECT strftime((SELECT max(ts) FROM events), '%Y-%m') AS video, CAST(n_findings AS BIGINT) AS n_findings, CAST(length(content) AS BIGINT) AS n_chars,
               md5(content) AS content_md5 FROM rep""",
}

_VIDEO_SEG = f"""
c1 AS (SELECT *, sum("drop") OVER (PARTITION BY video) AS s_, count(*) OVER (PARTITION BY video) AS n_ FROM curve WHERE bucket >= 1),
k AS (SELECT *, CASE WHEN bucket <= {-(-HORIZON_S // BUCKET_S)} THEN 'opening_loss' WHEN "drop" * n_ > s_ THEN 'sag'
                     WHEN "drop" * n_ * 4 < s_ THEN 'highlight' ELSE 'steady' END AS kind FROM c1),
isl AS (SELECT *, bucket - row_number() OVER (PARTITION BY video, kind ORDER BY bucket) AS grp FROM k),
seg AS (SELECT video, kind, min(bucket) AS from_bucket, max(bucket) AS to_bucket, CAST(sum("drop") AS BIGINT) AS total_drop
        FROM isl GROUP BY video, kind, grp)"""


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


ORACLE["audit_step"] = f"""WITH {_VIDEO_CURVE.replace("strftime(ts, '%Y-%m') AS video", "strftime(ts, '%Y-%m') || '-' || event_type AS video")}, {_VIDEO_SEG},
    st AS (SELECT strftime(ts, '%Y-%m') || '-' || event_type AS video, min(event_type) AS type, count(*) AS n,
                  floor(10000 * count(*) FILTER (WHERE value > 10) / count(*)) / 10000 AS r0,
                  floor(10000 * count(*) FILTER (WHERE value > 40) / count(*)) / 10000 AS c0 FROM events GROUP BY 1),
    m AS (SELECT video, type, CASE WHEN type = 'error' THEN 12000 ELSE n END AS views,
                 CASE WHEN type IN ('click', 'error') THEN 0.45::DOUBLE ELSE r0::DOUBLE END AS r,
                 CASE WHEN type IN ('click', 'error') THEN 0.18::DOUBLE ELSE c0::DOUBLE END AS c FROM st),
    pr AS (SELECT *, '{{' || chr(10) || '    "views": ' || CAST(views AS VARCHAR) || ',' || chr(10)
                  || '    "retention_5s": ' || CAST(r AS VARCHAR) || ',' || chr(10) || '    "completion_rate": ' || CAST(c AS VARCHAR)
                  || CASE WHEN type = 'click' THEN ',' || chr(10) || '    "note": "click"' ELSE '' END || chr(10) || '}}' AS js FROM m),
    f AS (SELECT video, row_number() OVER (PARTITION BY video ORDER BY from_bucket) AS seq, kind,
                 {_offset(f'from_bucket * {BUCKET_S}')} AS from_s, {_offset(f'(to_bucket + 1) * {BUCKET_S}')} AS to_s,
                 'sessions lost: ' || CAST(total_drop AS VARCHAR) AS detail FROM seg),
    fa AS (SELECT video, count(*) AS n_findings,
             string_agg('### ' || kind || ' (' || from_s || ' - ' || to_s || ')' || chr(10) || detail || chr(10) || chr(10), '' ORDER BY seq) AS sections,
             string_agg(CAST(seq AS VARCHAR) || '. ' || kind || ': ' || from_s || ' - ' || to_s || chr(10), '' ORDER BY seq) AS actions
           FROM f GROUP BY video),
    rep AS (SELECT pr.video, {_text(D.template_parts(D.AUDIT_USER_TEMPLATE)[0])} || js || {_text(D.template_parts(D.AUDIT_USER_TEMPLATE)[2])} AS prompt,
          coalesce(n_findings, 0) AS n_findings,
          '{M.OVERVIEW_TITLE}' || chr(10) || chr(10) || '报告生成时间: ' || strftime((SELECT max(ts) FROM events), '%Y-%m-%d %H:%M:%S')
          || chr(10) || '{"=" * 72}' || chr(10) || chr(10) || '## 1. 核心表现数据分析 (Metrics Overview)' || chr(10)
          || '*   **本期视频播放量 (Views)**: ' || CAST(views AS VARCHAR) || chr(10)
          || '*   **前 5 秒保留率 (5s Retention)**: ' || printf('%.1f', r * 100) || '% ('
          || CASE WHEN r < 0.6 THEN 'warning' WHEN r <= 0.7 THEN 'good' ELSE 'excellent' END || ')' || chr(10)
          || '*   **全片完播率 (Completion Rate)**: ' || printf('%.1f', c * 100) || '%' || chr(10) || chr(10) || '---' || chr(10) || chr(10)
          || '## 2. 多模态表达诊断 (Speech & Tone Diagnostics)' || chr(10) || coalesce(sections, '')
          || '---' || chr(10) || chr(10) || '## 3. 下期迭代优化动作清单 (Action Items for Next Week)' || chr(10) || coalesce(actions, '') AS content
        FROM pr LEFT JOIN fa ON fa.video = pr.video)
    SELECT video, md5({_text(D.AUDIT_SYSTEM_TEMPLATE)}) AS system_md5, md5(prompt) AS prompt_md5,
           CAST(n_findings AS BIGINT) AS n_findings, CAST(length(content) AS BIGINT) AS n_chars, md5(content) AS content_md5 FROM rep"""
