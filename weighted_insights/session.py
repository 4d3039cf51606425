"""Session settings for local runs; a cluster brings its own."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app: str = "weighted-insights", **conf: object) -> SparkSession:
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "8g",
        # Between the JVM and Python workers; a TCP socket costs tens of milliseconds a task.
        "spark.python.unix.domain.socket.enabled": "true",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.host": "127.0.0.1",
    }
    settings.update({key: str(value) for key, value in conf.items()})
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per Spark application.

    Tasks that run Python name functions of the package; a worker finds them wherever it was started.
    """
    context = spark.sparkContext
    if getattr(context, "_weighted_insights_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), "weighted_insights")
    path = shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package))
    context.addPyFile(path)
    context._weighted_insights_shipped = True
