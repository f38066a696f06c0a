"""Intermediate tables of iterative jobs in the cluster's shared folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir. Where it names none, a local session gets one of its
    own, removed at the end; on a cluster that is an error, as executors don't share the driver's disk."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="marquetry-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


class Scratch:
    """The intermediate tables of one operator: parquet in the shared folder, so a lost executor costs no recomputation.

    `result` stores the operator's outcome and removes all tables before it; the outcome itself goes with the session.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, str] = {}

    def _path(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def table(self, df: DataFrame) -> DataFrame:
        """`df` written out and read from there."""
        path = f"{shared_folder(self.spark)}/table-{uuid.uuid4().hex}"
        df.write.parquet(path)
        fs, p = self._path(path)
        fs.deleteOnExit(p)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def counted(self, df: DataFrame) -> tuple[DataFrame, int]:
        """`table` and its number of rows, counted while it is written."""
        seen = Observation()
        out = self.table(df.observe(seen, F.count(F.lit(1)).alias("n")))
        return out, seen.get["n"]

    def drop(self, *tables: DataFrame) -> None:
        """Remove these tables, or all stored so far; nothing may read them any more."""
        for key in [id(t) for t in tables] or list(self.paths):
            fs, p = self._path(self.paths.pop(key))
            fs.delete(p, True)

    def result(self, df: DataFrame) -> DataFrame:
        before, self.paths = self.paths, {}
        out = self.table(df)
        kept, self.paths = self.paths, before
        self.drop()
        self.paths = kept
        return out


def stored(spark: SparkSession, df: DataFrame) -> DataFrame:
    """`df` as a table of the shared folder that stays until the session ends."""
    return Scratch(spark).table(df)
