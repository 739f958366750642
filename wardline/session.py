"""Session for tests and local measurement. A cluster brings its own."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

PACKAGE = os.path.dirname(os.path.abspath(__file__))
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application.

    Python functions that run on executors import it there, so it must be on their path whatever
    the driver's working directory is. The driver's file server hands the archive out.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="wardline-"), "wardline.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(PACKAGE)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def local_session(cores: str | int = 8, partitions: int = 8, app: str = "wardline") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
