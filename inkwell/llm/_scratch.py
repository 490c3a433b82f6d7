"""Written tables that cut lineage.

Intermediate tables go to the folder that the cluster names in
``spark.checkpoint.dir``: shared storage, so that a lost executor costs only
the tasks it was running.  Where the setting is absent, a local session (as in
tests) makes a folder of its own; on a cluster that is an error, because a
machine-local folder would not be seen by the other machines.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per application.

    Operators with Python stages call it first, so that they also run where
    the package is importable on the driver only.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="inkwell-ship-")) / "inkwell.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f"{package.name}/{f.relative_to(package)}")
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _own:
        _own[sc.applicationId] = tempfile.mkdtemp(prefix="inkwell-llm-")
    return _own[sc.applicationId]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet into the shared folder and read it back."""
    path = f"{scratch_root(df.sparkSession)}/inkwell-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
