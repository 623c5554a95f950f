"""The folder that all executors share, and tables in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset, a temporary one in a local session, and an error on a cluster."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        context = spark.sparkContext
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set: tables need a folder that all executors share")
        path = _own[context.applicationId] = _own.get(context.applicationId) or "file://" + tempfile.mkdtemp(prefix="blocklake-")
    return path.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts its lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
