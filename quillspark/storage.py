"""Cutting lineage with tables in the shared folder of the cluster.

The folder is the one the session names in ``spark.checkpoint.dir``; only where
that is unset and the session runs on one machine (tests, a notebook) a local folder is chosen;
on a cluster an unset folder is an error.
Tables are written with Spark's commit protocol, so a lost executor costs the
recomputation of its tasks and nothing else.
"""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables of this application."""
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not base:
            if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = "file://" + os.path.join(tempfile.gettempdir(), "quillspark-checkpoints")
            spark.sparkContext.setCheckpointDir(base)
        _ROOTS[app] = f"{base.rstrip('/')}/quillspark-{app}"
        atexit.register(_remove, spark, _ROOTS[app])
    return _ROOTS[app]


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session is gone already; the folder belongs to the cluster's own clean-up
        pass


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a compressed table of the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
