"""Tables of one run in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[str, object]] = []


def clear() -> None:
    """Delete the tables of all runs of this process; results that read them are of no use afterwards. Done when the process ends."""
    jvm = SparkContext._jvm
    while _made and jvm is not None:
        path, conf = _made.pop()
        try:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)
        except Exception:  # noqa: BLE001  the JVM or the store may be gone; what is left can be deleted by hand
            return


atexit.register(clear)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only a local session without that setting gets a temporary folder."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named.rstrip("/")
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="curatrix-"))
    return sc.getCheckpointDir().rstrip("/")


class Scratch:
    """Tables of one operator run, written to the shared folder; they cut the lineage and outlive executors.

    Results read them, so they stay until the process ends or `clear` is called."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.path = f"{shared_dir(spark)}/curatrix-scratch/{name}-{uuid.uuid4().hex}"
        _made.append((self.path, spark._jsc.hadoopConfiguration()))

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """df, written under this name and read again with the schema it had."""
        df.write.option("compression", "zstd").parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, name: str = "") -> None:
        """Delete one table, or all."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        """Let the context cleaner drop the shuffle files of plans that are no longer referenced.

        The last job's plan is still held, so a small job comes first."""
        self.spark.range(1).count()
        self.spark._jvm.System.gc()
