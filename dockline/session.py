"""Session set-up and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

PACKAGE = os.path.dirname(os.path.abspath(__file__))
_shipped: set[str] = set()

SETTINGS = {
    # Path dates are naive; every conversion below assumes UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot buckets, keys and partitions are split at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A batch is held by the executor and its Python worker at once, several times over.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings this package relies on to a session."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, whatever their paths are."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="dockline-"), "dockline.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(PACKAGE)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def build_session(app: str = "dockline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    # Checkpoints go with the data frames they belong to.
    start = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}
    for name, value in {**start, **SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="dockline-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared root."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def enable_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` write below the shared root."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(spark))
