"""Sessions and what every session needs."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent


def session(master: str | None = None, partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A session in UTC with ANSI, AQE and Arrow on. On a cluster, master and memory come from spark-submit."""
    builder = SparkSession.builder.appName("curatrix")
    if master:
        builder = builder.master(master).config("spark.driver.memory", memory)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
    }
    return builder.config(map=settings | {k.replace("__", "."): v for k, v in conf.items()}).getOrCreate()


def importable(spark: SparkSession) -> None:
    """Ship this repository to the executors' Python, once, unless their PYTHONPATH has it."""
    sc = spark.sparkContext
    if str(ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(sc, "_curatrix_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="curatrix-")  # executors fetch the file from here as long as the driver runs
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    shutil.copytree(ROOT / "curatrix", Path(folder) / "tree" / "curatrix", ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(f"{folder}/curatrix", "zip", f"{folder}/tree"))
    sc._curatrix_shipped = True
