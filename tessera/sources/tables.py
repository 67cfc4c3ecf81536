"""Loaders for the parquet test tables and the inputs derived from them.

Each derived input is a lazy DataFrame over the base tables, so Catalyst prunes
columns and pushes filters into the parquet scans of every query built on it.
The equivalent SQL of every derivation lives in ``tessera.plans.oracle``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.expr import hash_bucket, letter_words
from tessera.plans.parallel import spread

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


LINES = 1 << 20   # lines that a task sorts to meet their orders


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _with_orders(li: DataFrame, od: DataFrame) -> DataFrame:
    """Lines with their orders.  Keys compress so well that adaptive execution deals
    many millions of lines to a task, which then sorts them in memory: more lines make
    more partitions instead.  Tables with few lines are left to the planner."""
    on = li.l_orderkey == od.o_orderkey
    parts = math.ceil(li.count() / LINES)   # from the files' footers
    if parts <= li.sparkSession.sparkContext.defaultParallelism:
        return li.join(od, on)
    return li.repartition(parts, "l_orderkey").join(od.repartition(parts, "o_orderkey"), on)


# ---------------------------------------------------------------- text
def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, spread over the cluster when the scan has too few tasks
    (tokenizing is CPU-bound; a single large row group would serialise it)."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


# ---------------------------------------------------------------- ratings
def rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user, item, rating) of every line: customer, part and quantity, with
    a row for each time the customer bought the part."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return _with_orders(li, od).select(
        F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"), F.col("l_quantity").alias("rating"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One explicit rating per (customer, part): avg quantity over their lines."""
    return rating_lines(spark, sf_dir).groupBy("user", "item").agg(F.avg("rating").alias("rating"))


def split_key(user: str = "user", item: str = "item"):
    return F.concat(F.col(user).cast("string"), F.lit("|"), F.col(item).cast("string"))


# ---------------------------------------------------------------- graphs
def supply_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directed customer -> part -> supplier graph with return edges.

    Return edges supplier -> part exist for returned lines of even suppliers,
    which creates cycles, dangling nodes and nodes without in-edges.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c2p = (_with_orders(li, od)
           .select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("src"),
                   F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("dst")))
    p2s = li.select(F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("src"),
                    F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("dst"))
    s2p = (li.where((F.col("l_returnflag") == "R") & (F.col("l_suppkey") % 2 == 0))
           .select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("src"),
                   F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("dst")))
    return c2p.unionByName(p2s).unionByName(s2p).distinct()


def nation_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer nation -> supplier nation per line item; parallel edges kept."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (_with_orders(li, od)
            .join(cu, F.col("o_custkey") == F.col("c_custkey"))
            .join(su, F.col("l_suppkey") == F.col("s_suppkey"))
            .select(F.col("c_nationkey").alias("src"), F.col("s_nationkey").alias("dst")))


HREF_PATTERN = r'href="([^"]*)"'


def link_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page url -> each href target found in its html (duplicates kept)."""
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "html"))
    return (pages.select(F.col("page_id").cast("string").alias("src"),
                         F.explode(F.regexp_extract_all("html", F.lit(HREF_PATTERN), 1))
                         .alias("dst")))


def part_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    # distinct by the keys, which take less room than the names made of them
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()
    return li.select(F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("src"),
                     F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("dst"))


def relabel(edges: DataFrame, prefix: str = "X") -> DataFrame:
    """An isomorphic copy: every node renamed to prefix + md5(node)."""
    return edges.select(F.concat(F.lit(prefix), F.md5("src")).alias("src"),
                        F.concat(F.lit(prefix), F.md5("dst")).alias("dst"))


def drop_one_edge(edges: DataFrame) -> DataFrame:
    """Remove the edge with the smallest md5(src|dst): a non-isomorphic copy."""
    key = F.md5(F.concat("src", F.lit("|"), "dst"))
    return edges.where(key != edges.select(F.min(key)).scalar())


def place_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer - nation - region forest (undirected; one row per edge)."""
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    na = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    c2n = cu.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("src"),
                    F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("dst"))
    n2r = na.select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("src"),
                    F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("dst"))
    return c2n.unionByName(n2r)


# ---------------------------------------------------------------- regression
def price_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense labelled rows: x = (qty/50, discount*10, tax*10), y = price/1e5."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.array((F.col("l_quantity") / 50.0), (F.col("l_discount") * 10.0),
                (F.col("l_tax") * 10.0)).alias("x"),
        (F.col("l_extendedprice") / 100000.0).alias("y"))


def price_rows_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``price_rows`` with the line keys (l_orderkey, l_linenumber) kept."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.array((F.col("l_quantity") / 50.0), (F.col("l_discount") * 10.0),
                (F.col("l_tax") * 10.0)).alias("x"),
        (F.col("l_extendedprice") / 100000.0).alias("y"))


def sparse_rows(spark: SparkSession, sf_dir: str):
    """Sparse labelled rows from the labelled documents.

    Returns ``(x, y)``: ``x(row_id, feature, value)`` holds the term counts of
    each labelled document, ``y(row_id, y)`` the label 2*quality-1 in {-1, +1}.
    """
    docs = documents(spark, sf_dir).select("doc_id", "text")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    y = lab.select(F.col("doc_id").alias("row_id"),
                   (F.col("quality") * 2 - 1).cast("int").alias("y"))
    toks = (docs.join(lab.select("doc_id"), "doc_id", "left_semi")
            .select(F.col("doc_id").alias("row_id"),
                    F.explode(letter_words(F.col("text"))).alias("feature")))
    x = toks.groupBy("row_id", "feature").agg(F.count(F.lit(1)).cast("double").alias("value"))
    return x, y
