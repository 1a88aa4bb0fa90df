"""Shared storage: tables and files that the driver and every executor can see.

Everything kept between jobs is written below ``spark.checkpoint.dir``, in a folder of the application that is deleted when its JVM
ends.  Only a local master may leave that setting out; a temporary folder is used then.  A cluster without it is an
error: its executors would each write to a disk of their own, and later reads would miss those files.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_marked: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """A new folder name below the application's shared folder (not created yet)."""
    context = spark.sparkContext
    root = spark.conf.get(SETTING, None) or context.getConf().get(SETTING)
    if not root:
        if not context.master.startswith("local"):
            raise ValueError(f"{SETTING} must name a folder that the driver and all executors share")
        root = "file://" + tempfile.gettempdir() + "/namewright-shared"
    home = f"{root.rstrip('/')}/namewright/{context.applicationId}"
    if home not in _marked:
        _marked.add(home)
        where = spark._jvm.org.apache.hadoop.fs.Path(home)
        store = where.getFileSystem(spark._jsc.hadoopConfiguration())
        store.mkdirs(where)
        store.deleteOnExit(where)
    return f"{home}/{uuid.uuid4().hex}"


def keep(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._kept_at = path  # type: ignore[attr-defined]
    return out


def drop(*tables: DataFrame | None) -> None:
    """Delete tables written by :func:`keep`; nothing may read them afterwards."""
    for df in tables:
        path = getattr(df, "_kept_at", None)
        if path is not None:
            where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def together(spark: SparkSession, *steps: Callable[[], Any]) -> list[Any]:
    """What the steps return.  Their jobs run side by side, so that one's tasks fill the cores that another's leave idle; all have ended
    when the first error, if any, is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        begun = []
        for f in steps:
            # A wrapper for each: it holds the local properties that the thread goes on to change.
            inherit = inheritable_thread_target(spark)
            begun.append(pool.submit(inherit(f) if callable(inherit) else f))
    return [b.result() for b in begun]
