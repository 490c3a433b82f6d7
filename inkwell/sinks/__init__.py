"""Writers: one partitioned table instead of one driver-side file per row.

The reference writes ``{T}_raw_{ts}.txt``, ``card_{ts}_{L}.md``,
``dialogue_log_{ts}_{L}.txt`` … one file at a time.  Here the derived file
name is a column and the rows are written by the executors, partitioned by
kind and run stamp, so a later reader prunes partitions; the label stays a
(sorted) string column, because a partition value such as ``2026`` would be
read back as a number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.operators.documents import DRAFT_NAME, FINAL_NAME


def report_name(kind: str, label: Column, run_ts: Column) -> Column:
    """The reference's file name for a document of ``kind``."""
    ts = F.date_format(run_ts, "yyyyMMdd_HHmmss")
    if kind == "raw":
        return F.concat(label, F.lit("_raw_"), ts, F.lit(".txt"))
    if kind == "macro":
        return F.concat(F.lit("macro_raw_"), ts, F.lit(".txt"))
    if kind == "card":
        return F.concat(F.lit("card_"), ts, F.lit("_"), label, F.lit(".md"))
    if kind == "draft":
        return F.concat(label, F.lit("解析_"), ts, F.lit("/" + DRAFT_NAME))
    if kind == "final":
        return F.concat(label, F.lit("解析_"), ts, F.lit("/" + FINAL_NAME))
    if kind == "log":
        return F.concat(F.lit("dialogue_log_"), ts, F.lit("_"), label, F.lit(".txt"))
    if kind == "report":
        return F.concat(F.lit("report_"), ts, F.lit(".md"))
    raise ValueError(kind)


def report_rows(df: DataFrame, kind: str, run_ts: Column, label: str = "label") -> DataFrame:
    """Documents (label, content) as rows of the report table: kind, label, run_ts, name, content."""
    return df.select(
        F.lit(kind).alias("kind"), F.col(label).alias("label"),
        F.date_format(run_ts, "yyyyMMdd_HHmmss").alias("run_ts"),
        report_name(kind, F.col(label), run_ts).alias("name"), F.col("content"))


def write_reports(df: DataFrame, path: str, kind: str, run_ts: Column, label: str = "label") -> DataFrame:
    """Write documents (label, content) as parquet partitioned by kind and
    run stamp; returns the frame that was written.

    A run writes each kind once: writing a (kind, run stamp) again replaces it,
    so a repeated job leaves no doubles, and other runs stay.  Rows are dealt
    by ranges of (run stamp, label), so a run makes files by its size, not
    by its number of labels."""
    out = report_rows(df, kind, run_ts, label)
    (out.repartitionByRange("run_ts", "label").sortWithinPartitions("run_ts", "label")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("kind", "run_ts").parquet(path))
    return out


REPORT_SCHEMA = "label string, name string, content string, kind string, run_ts string"


def read_reports(spark: SparkSession, path: str, kinds: list[str] | None = None) -> DataFrame:
    """The written report table: kind, label, run_ts, name, content; other kinds' partitions are not read."""
    rows = spark.read.schema(REPORT_SCHEMA).parquet(path).select("kind", "label", "run_ts", "name", "content")
    return rows if kinds is None else rows.filter(F.col("kind").isin(kinds))


def archive_files(reports: DataFrame) -> DataFrame:
    """Rows of the report table as the files of a history folder: dir, name, mtime, content.

    A name ``folder/file`` is a file of that folder; a document without a folder
    has none (dir NULL) and belongs to no pair.  mtime is the run stamp, which
    is when the document was written.
    """
    folder = F.nullif(F.regexp_extract("name", r"^(.*)/[^/]*$", 1), F.lit(""))
    return reports.select(folder.alias("dir"), F.regexp_extract("name", r"([^/]*)$", 1).alias("name"),
                          F.to_timestamp_ntz("run_ts", F.lit("yyyyMMdd_HHmmss")).alias("mtime"), "content")
