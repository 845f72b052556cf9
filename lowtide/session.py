"""Session settings."""

from __future__ import annotations

import os
import re

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", app: str = "lowtide", partitions: int | None = None,
                  shared_dir: str | None = None) -> SparkSession:
    """A session with the settings the plans are written for.

    ``shared_dir`` is a folder that driver and executors reach, for stage tables;
    a cluster that names one in ``spark.checkpoint.dir`` needs none here.

    On a cluster leave ``partitions`` unset and start with a high initial
    number: adaptive execution coalesces small shuffles and splits skewed ones.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # split a hot key even where the next step then needs one more shuffle
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # no call-site capture per expression: plans here hold thousands of them
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shared_dir is not None:
        builder = builder.config("spark.checkpoint.dir", shared_dir)
    if partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for a stage table, below the shared folder in ``spark.checkpoint.dir``.

    Without one, a single machine uses the warehouse folder; on a cluster that
    is an error, because executors would write to disks nobody else reads.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^-]*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder: the master is {master}")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/stages"
    path = f"{base.rstrip('/')}/lowtide-{name}-{os.urandom(8).hex()}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


_made: dict[str, list[str]] = {}


def remove_stages(spark: SparkSession) -> None:
    """Delete the stage tables of this session; tables read from them are void afterwards."""
    for path in _made.pop(spark.sparkContext.applicationId, []):
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark reaches, if it is there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def files_below(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, size, modification time) of the files of a folder, or of one file, of any file system that Spark reaches."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    listed = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(where, True)
    out = []
    while listed.hasNext():
        f = listed.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return out
