"""Local session for tests and the benchmark (a cluster passes its own)."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  scratch: str | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]")
               .appName("cartograph")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true")
               .config("spark.driver.memory", "8g"))
    spark = builder.getOrCreate()
    prepare_session(spark, scratch)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare_session(spark: SparkSession, scratch: str | None = None) -> None:
    """Settle where intermediate tables go, and let executors import the package.

    Intermediate tables go to the cluster's ``spark.checkpoint.dir``. A folder
    of this machine stands in only for a local master, where all tasks share
    its disk; any other master without that setting is refused.
    """
    if not spark.conf.get("spark.checkpoint.dir", None):
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"master {master}: name a folder that all executors share in "
                               "spark.checkpoint.dir")
        d = scratch or tempfile.mkdtemp(prefix="cartograph-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    _ship_package(spark)


def _ship_package(spark: SparkSession) -> None:
    """Python workers get this package as a zip (once per context)."""
    context = spark.sparkContext
    if getattr(context, "_cartograph_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="cartograph-zip-"), "cartograph")
    context.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(root), os.path.basename(root)))
    context._cartograph_shipped = True
