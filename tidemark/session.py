"""Session settings and durable intermediate results."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings every session should have.  Partition counts are deliberately absent: on a
# cluster set spark.sql.adaptive.coalescePartitions.initialPartitionNum high (for
# instance 3x the total cores) and let adaptive execution merge small partitions.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the package's settings to a session builder."""
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session without that
    setting gets a folder of its own; a cluster session without it is an error, because a
    folder on one machine would be lost with that machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="tidemark-")
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir()


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one written table inside the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into a table in the shared folder and read it back.

    Lost executors then never recompute it, later reads take only the columns they need, and
    the optimizer knows its real size: a join broadcasts it only if that size is below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise.
    """
    path = work_path(df.sparkSession, "durable")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(table: DataFrame) -> None:
    """Delete the files of a table that ``durable`` wrote, once nothing will read it any more.

    Only folders that ``work_path`` named are touched; a table that nobody releases stays until the
    lifetime rule of the shared folder removes it.
    """
    spark = table.sparkSession
    folders = {file.rsplit("/", 1)[0] for file in table.inputFiles()}
    for folder in folders:
        if folder.rsplit("/", 1)[1].startswith("durable-"):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per session, as a user would with --py-files."""
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return spark
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(), "tidemark.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, Path(package.name) / file.relative_to(package))
    context.addPyFile(archive)
    context._tidemark_shipped = True
    return spark
