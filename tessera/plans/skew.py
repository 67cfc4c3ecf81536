"""Splitting hot keys ahead of a join.

``hot_keys`` lists the keys with more than ``rows`` rows (at most all rows /
``rows`` of them) in a written table, counted with map-side combining.  The hot
side gets a sub-key ``_salt`` from a hash of its other columns, the other side a
copy per sub-key, and the join is on key and sub-key, so no task gets more than
about ``rows`` rows of one key.  Looking the sub-keys up is itself a join on the
hot key: the list is broadcast behind a check of its length, and joined from the
written table beyond it, where adaptive execution may split the partition of a
hot key (both sides are plain reads).  The session setting ``tessera.skew.rows``
overrides ``HOT_ROWS``.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.plans.iterate import checkpoint

HOT_ROWS = 2_000_000
BROADCAST_KEYS = 100_000


class HotKeys(NamedTuple):
    """The written list (key, _salts), and its length."""

    table: DataFrame
    n: int


def hot_rows(df: DataFrame, rows: int | None = None) -> int:
    return int(rows or df.sparkSession.conf.get("tessera.skew.rows", str(HOT_ROWS)))


def hot_keys(df: DataFrame, key: str, rows: int | None = None, count: Column | None = None) -> HotKeys:
    """(key, _salts): the keys of ``df`` with more than ``rows`` rows, and the
    number of sub-keys of each.  ``count`` names a column of counts if ``df``
    has one row per key already."""
    limit = hot_rows(df, rows)
    per = df.select(key, count.alias("_n")) if count is not None else df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    table = checkpoint(per.where(F.col("_n") > limit).select(
        key, F.ceil(F.col("_n") / F.lit(float(limit))).cast("int").alias("_salts")))
    return HotKeys(table, table.count())


def with_salts(df: DataFrame, hot: HotKeys, key: str, name: str = "_salts") -> DataFrame:
    """``df`` with the number of sub-keys of each row's key (1 if not hot)."""
    if not hot.n:
        return df.withColumn(name, F.lit(1))
    listed = hot.table.withColumnRenamed("_salts", "_of")
    return (df.join(F.broadcast(listed) if hot.n <= BROADCAST_KEYS else listed, key, "left")
            .withColumn(name, F.coalesce("_of", F.lit(1))).drop("_of"))


def salt(by: Sequence[str] | str, salts: str = "_salts") -> Column:
    """The sub-key of a row of the hot side."""
    return F.pmod(F.xxhash64(*([by] if isinstance(by, str) else by)), F.col(salts)).cast("int")


def fan(salts: str = "_salts") -> Column:
    """One row per sub-key, for the other side."""
    return F.explode(F.sequence(F.lit(0), F.col(salts) - 1))


def hot_join(left: DataFrame, right: DataFrame, key: str, by: Sequence[str] | str, how: str = "inner",
             hot: HotKeys | None = None, rows: int | None = None) -> DataFrame:
    """``left.join(right, key, how)`` for an inner or left join whose left side
    may hold a key in a large part of its rows.  ``by`` are columns of ``left``
    that tell the rows of a key apart."""
    if how not in ("inner", "left", "left_semi"):
        raise ValueError("the right side of a split join must not be kept whole")
    hot = hot_keys(left, key, rows) if hot is None else hot
    if not hot.n:
        return left.join(right, key, how)
    dealt = with_salts(left, hot, key).withColumn("_salt", salt(by)).drop("_salts")
    copied = with_salts(right, hot, key).withColumn("_salt", fan()).drop("_salts")
    return dealt.join(copied, [key, "_salt"], how).drop("_salt")
