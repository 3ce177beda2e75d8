"""The folder that driver and executors share, for tables that a query writes itself."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path as the standard library takes it, None where it lies in another file system."""
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    scheme = own.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme()
    return own.toUri().getPath() if scheme == "file" else None


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder spark.checkpoint.dir names, or in a temporary one where it is unset and master is local."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="keelstone-")
        spark.conf.set("spark.checkpoint.dir", named)
    return f"{named.rstrip('/')}/{name}-{uuid.uuid4().hex}"
