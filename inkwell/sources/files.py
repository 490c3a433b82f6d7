"""File sources: whole-text documents with name and mtime, draft/final
folders, metrics files, company records, and the union of listings.

All readers are plain ``spark.read`` calls; file name and modification time
come from the hidden ``_metadata`` column, so the folder is listed by Spark
(in parallel on a cluster), never walked on the driver.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions.text import source_label
from inkwell.operators.market import COMPANY_SCHEMA

# Fixed value: the suffixes the reference reads as documents.
DOC_GLOB = "*.{txt,md}"


def scan_documents(spark: SparkSession, path: str, glob: str = DOC_GLOB, kind: str | None = None,
                   recursive: bool = False) -> DataFrame:
    """(path, name, mtime, content, kind, label) — one row per whole file."""
    df = spark.read.text(path, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=recursive)
    out = df.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_modification_time").alias("mtime"),
        F.col("value").alias("content"),
    )
    return out.withColumn("kind", F.lit(kind)).withColumn("label", source_label(F.col("name")))


def scan_listing(spark: SparkSession, path: str, glob: str = DOC_GLOB) -> DataFrame:
    """Names and mtimes only (no content is read): the first step of a
    newest-file lookup; join the chosen paths back to read them."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return df.select(F.col("path"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name"),
                     F.col("modificationTime").alias("mtime"), F.col("length"))


def read_latest(spark: SparkSession, path: str, glob: str = DOC_GLOB) -> DataFrame:
    """The newest document of a folder, reading only that file's content.

    Step 1 lists names and mtimes (``binaryFile`` with the content column
    pruned); step 2 reads the one chosen path.  Output as ``scan_documents``
    (empty when the folder has no matching file)."""
    top = scan_listing(spark, path, glob).orderBy(F.col("mtime").desc(), F.col("name").asc()).limit(1).collect()
    if not top:
        return scan_documents(spark, path, glob).limit(0)
    # the path is a name here, not a pattern
    return scan_documents(spark, re.sub(r"([\[\]{}*?\\])", r"\\\1", top[0]["path"]), glob="*")


def scan_pairs(spark: SparkSession, path: str, glob: str = "*.md") -> DataFrame:
    """(dir, name, mtime, content) of every file in a folder directly below
    ``path``; dot- and underscore-folders are skipped by Spark's listing."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root)
    df = spark.read.text(path, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True)
    # the path is a URI: without scheme and host, it lies two names below the root; a plus sign is itself
    p = F.regexp_replace("_metadata.file_path", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    depth = root.depth() + 2
    return df.filter(F.size(F.split(p, "/")) - 1 == depth).select(
        F.url_decode(F.replace(F.regexp_extract(p, r"([^/]+)/[^/]+$", 1), F.lit("+"), F.lit("%2B"))).alias("dir"),
        F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_modification_time").alias("mtime"),
        F.col("value").alias("content"),
    )


def required_documents(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Whole texts of the named config files; a missing file is an empty
    text (Spark's file sources produce no row for a zero-length file, which
    is the same outcome).  Output: one row per name (name, content, ok)."""
    want = spark.createDataFrame([(n,) for n in names], "name string")
    got = scan_documents(spark, path, glob="*").select("name", "content")
    return want.join(got, "name", "left").select(
        "name", F.coalesce("content", F.lit("")).alias("content"),
        (F.length(F.coalesce("content", F.lit(""))) > 0).alias("ok"))


def scan_metric_files(spark: SparkSession, path: str, glob: str = "*.{json,csv}") -> DataFrame:
    """(video_id, inline, file_content) from one metrics file per video; the
    video id is the file name without its suffix."""
    df = spark.read.text(path, wholetext=True, pathGlobFilter=glob)
    return df.select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1).alias("video_id"),
                     F.lit(None).cast("string").alias("inline"), F.col("value").alias("file_content"))


def load_company(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Company records with the 13 known nullable fields (any may be missing
    in the source; unknown fields are dropped)."""
    return spark.read.schema(COMPANY_SCHEMA).format(fmt).load(path)


def union_sources(a: DataFrame, b: DataFrame) -> DataFrame:
    """Concatenate two listings by column name."""
    return a.unionByName(b, allowMissingColumns=True)
