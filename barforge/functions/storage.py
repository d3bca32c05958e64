"""Shared scratch folder for tables that cut lineage or feed a second read."""

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Folders of local sessions that named none, by application.
_OWN_FOLDERS: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder the cluster names in ``spark.checkpoint.dir``.

    Without that setting, the folder of ``SparkContext.setCheckpointDir`` serves. Only a
    session whose executors are threads of this process may do without both; it gets a
    temporary folder of its own, and the context's checkpoint folder stays as it is. On a
    cluster such a folder would exist on one machine alone, so there it is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if context.applicationId not in _OWN_FOLDERS:
            _OWN_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="barforge-")
        root = _OWN_FOLDERS[context.applicationId]
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, partition_by: str | list[str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Jobs that read the same frame many times then scan columns of a table
    instead of replaying its windows, also after an executor was lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
