"""Helpers for driver-side iteration over distributed state.

Iterative operators (PageRank, colour refinement, gradient descent, matrix
factorization) keep their state as DataFrames.  Each round's plan grows on top
of the previous one, so the lineage is cut with a *reliable* checkpoint written
to the session's checkpoint directory: an executor lost later can be recomputed
from that folder instead of from round one.  ``localCheckpoint`` is never used,
because its blocks die with the executor that holds them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tessera.session import ensure_checkpoint_dir


def checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder and cut its lineage.

    Under AQE the planner does not know the partitioning of the result: a later
    join shuffles it as a plain read, which also lets AQE split its hot keys.
    """
    ensure_checkpoint_dir(df.sparkSession)
    with _shuffles_removed(df.sparkSession):
        return df.checkpoint(eager=True)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the shuffles of what is written here as the write ends: nothing reads
    them again, and they would else stay until the driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def _planned_for(spark: SparkSession, parts: int) -> Iterator[None]:
    """Plan without adaptive execution, in ``parts`` partitions.

    Exchanges inside the plan then get the same number of partitions, so that
    they meet what is partitioned already without another one; without runtime
    sizes a broadcast would rest on an estimate.  All settings are restored.
    """
    ensure_checkpoint_dir(spark)
    held = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": str(parts),
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def checkpoint_keyed(df: DataFrame, parts: int, *keys: str, order: tuple[str, ...] = ()) -> DataFrame:
    """Checkpoint ``df`` hash-partitioned and sorted by ``keys``, in a way later joins see.

    Adaptive execution reports no partitioning for what it plans, so it is off
    for this one write; joins on ``keys`` then move only their other side, to
    the same ``parts`` partitions.  Such a partition can no longer be split at
    run time: salt hot keys before.  Without ``keys`` the partitioning that the
    plan ends in stays.  Later joins may use further keys, ``order`` being
    sorted by as well.
    """
    with _planned_for(df.sparkSession, parts), _shuffles_removed(df.sparkSession):
        return (df.repartition(parts, *keys).sortWithinPartitions(*keys, *order) if keys else df).checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: columnar and compressed, where a
    checkpoint holds every row as it lies in memory.  For wide or large tables
    that are read a few times."""
    return written_parts([df], name)


def written_parts(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """The rows of ``parts`` as one table in the shared folder, written one after
    the other, so that only one part's shuffles lie on disk at a time."""
    path = None
    for df in parts:
        spark, schema = df.sparkSession, df.schema
        path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        with _shuffles_removed(spark):
            df.write.mode("append").parquet(path)
    table = spark.read.schema(schema).parquet(path)
    table._path = path
    return table


def dropped(table: DataFrame) -> None:
    """Delete a table that ``written`` returned, once all that was made of it is checkpointed."""
    _delete(table.sparkSession, table._path)


def forgotten(df: DataFrame) -> None:
    """Delete the files of a checkpoint that nothing reads any more, such as the state before the last round."""
    file = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if file.isDefined():
        _delete(df.sparkSession, file.get())


def _delete(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def written_round(df: DataFrame, parts: int, name: str) -> DataFrame:
    """The state of a round as a table in the shared folder, planned like
    ``checkpoint_keyed``.  Unlike a checkpoint it has its true size: a checkpoint
    keeps the planner's estimate, a product over the joins of all rounds so far,
    whose digits double where a round joins its state twice.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with _planned_for(spark, parts), _shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
