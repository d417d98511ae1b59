"""Shared working folder: where lineage is cut and intermediate tables live."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SPREAD_BYTES = 32 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    Only a single-machine session without that setting gets a temporary folder:
    on a cluster a machine-local folder would not be seen by other executors."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="cohortflow-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Iterative fits (boosting) checkpoint their node caches; give them the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def _session_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/cohortflow/{spark.sparkContext.applicationId}"


class ScratchScope:
    """Collects the intermediate tables that a flow writes while it is entered; delete() removes them.

    A flow is entered step by step and closed once, when its results are stored elsewhere."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> ScratchScope:
        _SCOPES.append(self)
        return self

    def __exit__(self, *_) -> None:
        _SCOPES.remove(self)

    def delete(self) -> None:
        for path in self.paths:
            delete_path(self.spark, path)
        self.paths = []


_SCOPES: list[ScratchScope] = []


def delete_path(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{_session_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].paths.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application; call it when their results are stored."""
    delete_path(spark, _session_folder(spark))


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write a frame that several jobs read to the shared folder and read it back.

    Survives lost executors (unlike cached blocks) and keeps column pruning."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate. Steers only how work is divided, never a result."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _small(df: DataFrame) -> bool:
    """Estimated at less than a small split per core: such a frame may use only a few cores."""
    return estimated_bytes(df) < df.sparkSession.sparkContext.defaultParallelism * SPREAD_BYTES


def spread(df: DataFrame) -> DataFrame:
    """Deal a small frame out to all cores; larger ones already have enough splits."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if _small(df) else df


@contextmanager
def shared_scan(df: DataFrame) -> Iterator[DataFrame]:
    """A frame that several jobs read: small ones are dealt out once and kept in memory,
    larger ones are simply read again, so nothing big is ever cached."""
    if not _small(df):
        yield df
        return
    kept = spread(df).persist()
    try:
        yield kept
    finally:
        kept.unpersist()
