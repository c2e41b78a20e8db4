"""Intermediate tables in the folder that all executors share, so that lineage ends there and a lost executor costs one stage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where it is unset on a single machine (``local``) a temporary folder becomes
    it; executors elsewhere couldn't read that, so on a cluster it must be set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        kept = spark.sparkContext._jsc.sc().getCheckpointDir()
        if kept.isDefined():
            return kept.get()
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="threadmill-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Scratch:
    """Tables of one operator run. ``put`` writes and reads back; ``drop`` deletes one that nothing needs any more.

    What the result reads stays until the session's folder is cleaned: the result is lazy.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}", 0

    def put(self, df: DataFrame) -> tuple[DataFrame, str]:
        self.n += 1
        path = f"{self.root}/{self.n}.parquet"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def drop(self, path: str) -> None:
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def spread(scan: DataFrame, per_core: int = 2) -> DataFrame:
    """A scan of few splits, dealt out to all cores; a scan that has enough splits is left alone, so nothing is moved at
    scale. For operators that spend far more time on a row than moving it takes. ``scan`` must not contain a shuffle."""
    want = per_core * scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= want else scan.repartition(want)
