"""Scan parallelism guard.

A parquet file is split into tasks by row group.  A table stored as a few
large row groups yields fewer scan tasks than the cluster has cores, and a
CPU-heavy narrow stage on top of it (tokenizing text, extracting links) then
runs on a handful of threads.  ``spread`` round-robins such a scan over the
default parallelism; a scan that already has enough partitions (any large
table) is returned untouched, so at scale no extra shuffle is added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    sc = df.sparkSession.sparkContext
    target = min_partitions or sc.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df
