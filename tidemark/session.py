"""Spark session defaults and the shared work folder.

Cluster runs name a shared folder in ``spark.checkpoint.dir``; every job that has to
write (upserts, streaming checkpoints, lineage cuts) goes below it.  Only a local master
may leave it unset (tests); anything else must name a folder.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "tidemark",
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for materialisations: the session's ``spark.checkpoint.dir``.

    On a cluster the setting is required: a folder that only the driver sees would make
    executors write to their own disks.  A local master (tests on one machine, where all
    executors share the driver's disk) gets a folder of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tidemark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    # RDD checkpointing needs the context-level setting as well.
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark context.

    Functions that run in tasks are pickled by module reference, so workers on other
    machines need the package; Spark's own file distribution carries a zip of it.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tidemark_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="tidemark-code-"), "tidemark_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(target)
    sc._tidemark_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared work folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
