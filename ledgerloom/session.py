"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(
    app_name: str = "ledgerloom",
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """Session with UTC clock and adaptive execution; ``conf`` wins over the defaults.

    Partition counts and memory are left to the cluster, so nothing here is
    sized for one machine.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, with Spark's checkpoint directory set.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a temporary folder; elsewhere that folder would exist on one
    machine only, so a missing setting is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if configured is None and current is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="ledgerloom-")
    if current is None:
        context.setCheckpointDir(configured)
    return configured or current


#: Has Spark delete what a query shuffled once it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_table(df: DataFrame) -> DataFrame:
    """``df`` written once as parquet under the shared folder, read from there.

    Later passes prune columns, and lost executors never go back to the source.
    What the write shuffled is deleted with its end, as nothing else reads it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/table-{uuid.uuid4()}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a frame that ``shared_table`` gave, once nothing reads it any more."""
    context = df.sparkSession.sparkContext
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        if "/table-" in folder:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
