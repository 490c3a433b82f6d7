"""Incremental ingest of raw text files: the "pick up the newest raw file"
poll as a Structured Streaming query.

New files are read whole (``wholetext``), labelled, and merged into a
newest-per-label table in ``foreachBatch``.  The table lies in buckets of the
label's hash.  A micro-batch is reduced to its newest file per label; only the
buckets that these labels fall into are read, merged and written again, under
``data/v=<version>/bucket=<n>``.  A version is a manifest, a folder ``v=<n>`` with
one row per bucket that names the folder which holds it; buckets that the batch
did not touch keep theirs.  A manifest counts only once its ``_SUCCESS`` marker is
there, and it is written after its data, so a write that broke off is never read.
The version number follows the table, not the epoch: a fresh checkpoint over an
existing table goes on where the table stands, and a replayed epoch merges to the
same rows (newest-per-label is idempotent).  The last two versions are kept, for
readers that still hold the older one; data that neither names is deleted.
``availableNow`` processes what is there and stops, so the job can run on a
schedule; the checkpoint makes a restart resume where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions.text import source_label
from inkwell.operators.documents import latest_document

SCHEMA = "value string"
KEPT_VERSIONS = 2
# Buckets of a new table; a table keeps the number that it began with.
BUCKETS = 256
_MANIFEST = "bucket int, folder string, buckets int"


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(p.rstrip("/") for p in parts))


def _versions(spark: SparkSession, table_path: str, *below: str):
    """The file system, and version number -> folder of the versions that lie there."""
    root = _path(spark, table_path, *below)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    return fs, {int(n[2:]): _path(spark, table_path, *below, n) for n in names if n.startswith("v=") and n[2:].isdigit()}


def _manifests(spark: SparkSession, table_path: str):
    """The file system, and version number -> (folder, complete)."""
    fs, found = _versions(spark, table_path)
    return fs, {v: (p, fs.exists(_path(spark, p.toString(), "_SUCCESS"))) for v, p in found.items()}


def _manifest(spark: SparkSession, folder) -> tuple[dict[int, str], int]:
    """bucket -> its folder below the table, and the number of buckets: as many rows as buckets."""
    rows = spark.read.schema(_MANIFEST).parquet(folder.toString()).collect()
    return {r["bucket"]: r["folder"] for r in rows}, rows[0]["buckets"]


def _newest(spark: SparkSession, table_path: str) -> tuple[dict[int, str], int]:
    _, found = _manifests(spark, table_path)
    done = [v for v, (_, complete) in found.items() if complete]
    return _manifest(spark, found[max(done)][0]) if done else ({}, BUCKETS)


def _read(spark: SparkSession, table_path: str, folders: list[str]) -> DataFrame:
    return spark.read.parquet(*[f"{table_path.rstrip('/')}/{f}" for f in folders])


def read_newest(spark: SparkSession, table_path: str) -> DataFrame | None:
    """The current newest-per-label table (its highest complete version), or None."""
    folders, _ = _newest(spark, table_path)
    return _read(spark, table_path, sorted(folders.values())) if folders else None


def _merge_newest(table_path: str):
    root = table_path.rstrip("/")

    def merge(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        folders, buckets = _newest(spark, root)
        bucket = F.pmod(F.xxhash64("label"), F.lit(buckets)).cast("int")
        fresh = latest_document(batch, by=["label"]).drop("n_docs")
        # at most ``buckets`` numbers
        touched = sorted(r["bucket"] for r in fresh.select(bucket.alias("bucket")).distinct().collect())
        if not touched:
            return
        held = [folders[b] for b in touched if b in folders]
        if held:
            fresh = latest_document(_read(spark, root, held).unionByName(fresh), by=["label"]).drop("n_docs")
        fs, found = _manifests(spark, root)
        _, written = _versions(spark, root, "data")
        version = max([*found, *written], default=-1) + 1
        fresh.withColumn("bucket", bucket).repartition(len(touched), "bucket").write.partitionBy("bucket").parquet(f"{root}/data/v={version}")
        folders = folders | {b: f"data/v={version}/bucket={b}" for b in touched}
        spark.createDataFrame([(b, f, buckets) for b, f in folders.items()], _MANIFEST).coalesce(1).write.parquet(f"{root}/v={version}")
        _clean(spark, root)
    return merge


def _clean(spark: SparkSession, root: str) -> None:
    """Delete all but the last complete versions, and the data that those do not name."""
    fs, found = _manifests(spark, root)
    kept = sorted(v for v, (_, complete) in found.items() if complete)[-KEPT_VERSIONS:]
    for v, (folder, _) in found.items():
        if v not in kept:
            fs.delete(folder, True)
    named = {f for v in kept for f in _manifest(spark, found[v][0])[0].values()}
    _, written = _versions(spark, root, "data")
    for v, folder in written.items():
        for status in fs.listStatus(folder):
            name = status.getPath().getName()
            if name.startswith("bucket=") and f"data/v={v}/{name}" not in named:
                fs.delete(status.getPath(), True)
        if not any(f.startswith(f"data/v={v}/") for f in named):
            fs.delete(folder, True)


def ingest_stream(spark: SparkSession, source_dir: str, table_path: str, checkpoint: str,
                  glob: str = "*.{txt,md}"):
    """Start the availableNow ingest; returns the StreamingQuery."""
    stream = (spark.readStream.format("text").option("wholetext", True)
              .option("pathGlobFilter", glob).schema(SCHEMA).load(source_dir))
    docs = stream.select(
        F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_modification_time").alias("mtime"),
        F.col("value").alias("content"),
    ).withColumn("label", source_label(F.col("name")))
    return (docs.writeStream.foreachBatch(_merge_newest(table_path))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
