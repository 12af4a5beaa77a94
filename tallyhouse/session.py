"""Session settings the plans in this package are written for."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Only behaviour that the plans rely on. Sizing (executors, memory, shuffle width) belongs to the
# cluster's own configuration, so nothing here overrides it.
PLAN_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(app_name: str = "tallyhouse", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or reuse) a session that has this package on its executors. ``master`` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**PLAN_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def local_session(cpus: int | None = None, **extra: str) -> SparkSession:
    """Single-JVM session for tests and the benchmark."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    defaults = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("tallyhouse-local", f"local[{cpus}]", **{**defaults, **extra})
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What runs inside removes its shuffle files from all executors as it ends.

    Otherwise they stay until the driver happens to collect its garbage, so that a run of many writes holds
    the shuffles of all of them. Only for frames that are executed once: a second action on the same frame
    (not a second write, which is planned anew) would make its shuffles again.
    """
    before = spark.conf.get(_REMOVE_SHUFFLES, None)
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(_REMOVE_SHUFFLES) if before is None else spark.conf.set(_REMOVE_SHUFFLES, before)


# Applications that have the package; executors get it once.
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, so that their Python workers can import it wherever they start.

    The archive is made on the driver and served by it. With ``spark-submit --py-files`` it is sent twice,
    which does no harm.
    """
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    folder = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tallyhouse-"), "tallyhouse.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for at, _, names in os.walk(folder):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(at, name)
                    z.write(path, os.path.join("tallyhouse", os.path.relpath(path, folder)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(application)
