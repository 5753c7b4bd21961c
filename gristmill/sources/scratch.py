"""Where intermediate tables go: the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def scratch_folder(spark: SparkSession) -> str:
    """The session's shared folder.

    A cluster names it in ``spark.checkpoint.dir``. A local session that does
    not gets a temporary folder; a cluster session that does not is refused,
    because executors could not see a machine-local one.
    """
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="gristmill-"))
    return context.getCheckpointDir()


_HANDED_OUT: dict[str, list[str]] = {}  # paths by application


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    path = f"{scratch_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _HANDED_OUT.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Deletes what ``fresh_path`` handed out in this application; returns how many folders there were.

    To be called once the results that were read from them have been written.
    """
    context, n = spark.sparkContext, 0
    for path in _HANDED_OUT.pop(context.applicationId, []):
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        n += place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
    return n


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage by a reliable checkpoint, so a lost executor costs no earlier round."""
    spark = df.sparkSession
    folder = scratch_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()
