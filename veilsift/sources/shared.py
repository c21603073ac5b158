"""The folder that driver and executors share, and lineage cut into it."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes that Spark takes for a table of unknown size.
UNKNOWN_SIZE = (1 << 63) - 1


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only in local mode, where driver and executor are one process, a temporary folder stands in for
    an absent setting; on a cluster that is an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not where:
        known = sc._jsc.sc().getCheckpointDir()
        if known.isDefined():
            return known.get().rsplit("/", 1)[0]
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError(f"spark.checkpoint.dir names no folder, and {sc.master} has no local one that all share")
        where = "file://" + tempfile.mkdtemp(prefix="veilsift-")
        atexit.register(remove, where)
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(where)
    return where


def own_folder(spark: SparkSession, kind: str) -> str:
    """A new name below the shared folder; what lies there goes when the driver's program ends."""
    folder = f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    atexit.register(remove, folder)
    return folder


def remove(folder: str) -> None:
    from pyarrow import fs

    with contextlib.suppress(OSError, pa.ArrowException):  # it may be gone, or never have been made
        files, path = fs.FileSystem.from_uri(folder)
        files.delete_dir(path)


def cut(df: DataFrame) -> DataFrame:
    """Materialise to the shared folder: later readers survive the loss of any executor.

    Spark estimates a join as the product of its sides and keeps that with the checkpoint. Where rounds join
    what rounds before have joined, the digits of the estimate double with each join until they fill the
    driver; so one over UNKNOWN_SIZE is dropped, and the size is unknown again.
    """
    shared_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    plan = out._jdf.queryExecution().analyzed()
    if plan.stats().sizeInBytes() > UNKNOWN_SIZE:
        again = df.sparkSession._jsparkSession.internalCreateDataFrame(plan.rdd(), out._jdf.schema(), False)
        return DataFrame(again, df.sparkSession)
    return out
