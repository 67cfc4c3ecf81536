"""Shared helpers of the document operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

#: Bytes of an Arrow batch that become Python objects at once.
AT_ONCE = 8 << 20
#: ASCII white space, as the operators' contracts define it.
WHITE = " \t\n\x0b\x0c\r"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
ASCII_LOWER = bytes.maketrans(_UPPER, _LOWER)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def id_remainder(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as ''."""
    key = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % F.lit(modulus)


def free_name(name: str, taken) -> str:
    """``name``, with underscores added until it clashes with nothing taken."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name


def words_of(text: str) -> list[bytes]:
    """Lower-cased (A-Z only) words between ASCII white space, as UTF-8.

    ``bytes.split`` without arguments splits on exactly the six ASCII white
    space characters, and ``translate`` touches ASCII letters only.
    """
    return text.encode().translate(ASCII_LOWER).split()


def stage_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends
    here, and a lost executor costs a reread instead of a recomputation."""
    path = stage_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_rows(df: DataFrame, fn: Callable[[Iterator[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` over batches turned into column dictionaries.

    ``fn`` gets an iterator of ``{column: list}`` per part of a batch and yields
    dictionaries of output columns (lists or arrays).
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def columns():
            for b in batches:
                # Python objects of a few MB at a time, whatever the batch holds
                step = max(1, b.num_rows * AT_ONCE // max(AT_ONCE, b.nbytes))
                for s in range(0, b.num_rows, step):
                    part = b.slice(s, step)
                    yield {n: c.to_pylist() for n, c in zip(part.schema.names, part.columns)}
        for out in fn(columns()):
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def deal_groups(rows: DataFrame, homes: DataFrame, key: str, identity: str, block: int) -> DataFrame:
    """Rows dealt and sorted by (key, salt) for a streaming group comparison.

    In ``rows`` each key has home rows (``home`` is true) and replicas; every
    home row is to meet every row of its key.  A key with more than ``block``
    home rows is split: its home rows are spread over salts by their identity,
    and all rows are copied to each salt (a home row counts as a replica in the
    others).  ``homes`` holds the home rows' keys alone; keys that need a split
    are few, as each has over ``block`` of them.
    """
    heavy = stage(homes.groupBy(key).count().where(F.col("count") > block)
                  .select(key, F.ceil(F.col("count") / F.lit(float(block))).cast("int").alias("_salts")),
                  "heavy-keys")
    salts = F.col("_salts")
    out = (rows.join(heavy, key, "left")
           .withColumn("_salt", F.explode(F.when(salts.isNull(), F.array(F.lit(0)))
                                          .otherwise(F.sequence(F.lit(0), salts - 1))))
           .withColumn("home", F.col("home") & (
               salts.isNull() | (F.pmod(F.xxhash64(identity), salts) == F.col("_salt"))))
           .drop("_salts"))
    return out.repartition(key, "_salt").sortWithinPartitions(key, "_salt")


def groups_of(batches: Iterator[dict], keys: tuple[str, ...]) -> Iterator[dict]:
    """Groups of two or more rows from batches sorted by ``keys`` (numbers),
    as column dictionaries; a group may span batches."""
    import numpy as np

    kept: dict | None = None
    for b in batches:
        if kept is not None:
            b = {k: kept[k] + v for k, v in b.items()}
        k = np.array([b[c] for c in keys], np.int64)
        cut = np.nonzero((k[:, 1:] != k[:, :-1]).any(0))[0] + 1
        starts = np.concatenate([[0], cut])
        ends = np.concatenate([cut, [k.shape[1]]])
        for i in np.nonzero(ends[:-1] - starts[:-1] > 1)[0]:
            yield {c: v[starts[i]:ends[i]] for c, v in b.items()}
        kept = {c: v[starts[-1]:] for c, v in b.items()}
    if kept is not None and len(next(iter(kept.values()))) > 1:
        yield kept
