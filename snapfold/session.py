"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every plan here relies on.  Parallelism settings are left to the
# cluster: AQE coalesces small shuffles and splits skewed join partitions.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("snapfold")
    settings = {
        **DEFAULTS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a write are freed as soon as it has finished."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def emptied(spark: SparkSession, folder: str) -> None:
    """Free the files of a scratch folder that nothing reads any more, by overwriting them with no rows."""
    spark.createDataFrame([], "none string").write.mode("overwrite").csv(folder)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder name below ``spark.checkpoint.dir``.

    That setting names the folder every executor can reach.  A session without
    it uses a folder of its warehouse, which tables share in the same way.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return os.path.join(base, f"{label}-{uuid.uuid4().hex}")
