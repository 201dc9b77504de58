"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import SparkSession

import tiffin

# Settings the plans rely on: run-time re-planning and fixed semantics. The same
# values serve a laptop and a large cluster; sizes such as the number of shuffle
# partitions belong to the cluster and are left alone.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",  # strict casts must fail the job
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",  # else they stay until the driver's next collection
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),  # what a Python worker holds at a time
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session.

    Functions of this package travel to the tasks with their code, so executors
    need not have it installed.
    """
    cloudpickle.register_pickle_by_value(tiffin)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Run-time settings that hold for a block of statements."""
    old = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables, in the place all executors share.

    The cluster names that place in ``spark.checkpoint.dir``. Only a local
    session may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="tiffin-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
