"""The folder that driver and executors share, cutting lineage with it, and the size of batches sent to Python."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a batch of rows that Python gets at once; texts of any length still come whole.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """From now on the session's Arrow batches end at BATCH_BYTES, so that workers hold few texts at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def folder(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir. Where that is unset, a folder of this machine serves a session that
    runs in one process, as in tests; a cluster has to name one that all its machines share."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or sc._jsc.sc().getCheckpointDir().getOrElse(None)
    if not base:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp()}"
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """df written to the shared folder as Parquet and read again: computed once, and safe if executors are lost."""
    spark = df.sparkSession
    bounded_batches(spark)
    path = folder(spark, name)
    df.write.parquet(path, compression=compression)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._kept_at = path
    return kept


def discard(*kept: DataFrame) -> None:
    """Deletes what `keep` wrote for these; nothing may read them any more."""
    for df in kept:
        path = getattr(df, "_kept_at", None)
        if path:
            jvm = df.sparkSession._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(at, True)
