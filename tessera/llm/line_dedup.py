"""Line deduplication over levelled sorted runs of line hashes.

``LineRuns`` keeps runs of (line hash, number of documents), each written
sorted to the shared folder.  A batch first merge-anti-joins the lines it
brings with the runs, if asked which of them are new, and then adds its own
counts as a run of level 0.  As soon as a level holds ``fanout`` runs they are
merged into one run of the next level, so n batches leave O(log n) runs.

A line's key is the line without ASCII white space at both ends and with A-Z
lower-cased; two independent 64-bit hashes stand for it.  Texts are
read twice but never exploded into rows: a row holds a document, a position
and the hashes.  Positions to drop come back per document, and the text is
rebuilt from slices of its line array.  Everything is DataFrame functions.

Defined cases: a null or empty text is one empty line; empty keys are never
dropped; a document whose lines all go has the empty text; rows that repeat
both id and text count as one document and each get the result; further
columns are ignored (``drop_common_lines`` keeps them).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import WHITE, free_name, stage, text_or_empty

MIN_DOCS = 10
BATCHES = 4
FANOUT = 3
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(WHITE))
    # lower() equals the ASCII rule where all characters are ASCII, and is much faster there
    return F.when(F.length(bare) == F.octet_length(bare), F.lower(bare)).otherwise(
        F.translate(bare, _UPPER, _UPPER.lower()))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


class LineRuns:
    """Levelled runs of (k1, k2, docs)."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = []

    def _write(self, counts: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        run = stage(counts.sortWithinPartitions("k1", "k2"), f"line-run-{level}")
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self._merged(self.levels[level])
            self.levels[level] = []
            self._write(merged, level + 1)

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, runs).groupBy("k1", "k2").agg(F.sum("docs").alias("docs"))

    def runs(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def add(self, lines: DataFrame) -> None:
        """Add a batch of lines (doc, row, k1, k2); a document is in one batch only."""
        once = lines.groupBy("k1", "k2", "doc", "row").agg(F.lit(1).alias("one"))
        self._write(once.groupBy("k1", "k2").agg(F.count("one").alias("docs")), 0)

    def unseen(self, lines: DataFrame) -> DataFrame:
        """The lines whose key is in no run yet."""
        return reduce(lambda left, run: left.join(run, ["k1", "k2"], "left_anti"), self.runs(), lines)

    def common(self, min_docs: int) -> DataFrame:
        """(k1, k2) of the keys found in at least ``min_docs`` documents."""
        runs = self.runs()
        if not runs:
            return self.spark.createDataFrame([], "k1 long, k2 long")
        return self._merged(runs).where(F.col("docs") >= min_docs).select("k1", "k2")


def line_table(docs: DataFrame) -> DataFrame:
    """(doc, row, pos, k1, k2) of every line whose key is not empty."""
    text = text_or_empty()
    keys = docs.select(F.col("doc_id").alias("doc"), F.xxhash64(text).alias("row"),
                       F.posexplode(_lines(text)).alias("pos", "line")).select(
        "doc", "row", "pos", line_key(F.col("line")).alias("key"))
    return keys.where("key != ''").select(
        "doc", "row", "pos", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), "key").alias("k2"))


def dropped_positions(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """(doc, row, drop): positions of lines found in ``min_docs`` documents or
    more, ascending, for the documents that have any."""
    lines = stage(line_table(docs).withColumn("batch", F.pmod(F.xxhash64("doc", "row"), F.lit(batches))), "lines")
    runs = LineRuns(docs.sparkSession)
    for b in range(batches):
        runs.add(lines.where(F.col("batch") == b))
    common = stage(runs.common(min_docs), "common-lines")
    return (lines.join(common, ["k1", "k2"], "left_semi").groupBy("doc", "row")
            .agg(F.sort_array(F.collect_set("pos")).alias("drop")))


def _without(lines: Column, drop: Column) -> Column:
    """The lines at no position of ``drop`` (ascending), as slices between them."""
    edges = F.concat(F.array(F.lit(-1)), drop, F.array(F.size(lines)))
    return F.flatten(F.transform(
        F.sequence(F.lit(1), F.size(drop) + 1),
        lambda j: F.slice(lines, F.element_at(edges, j) + 2,
                          F.element_at(edges, j + 1) - F.element_at(edges, j) - 1)))


def _joined(docs: DataFrame, min_docs: int, batches: int) -> tuple[DataFrame, str]:
    drop = free_name("_drop", docs.columns)
    found = dropped_positions(docs, min_docs, batches).select(
        F.col("doc").alias("_doc"), F.col("row").alias("_row"), F.col("drop").alias(drop))
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_doc"])
                     & (F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))) == found["_row"]),
                     "left").drop(found["_doc"], found["_row"]), drop


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_sha256 and the kept text."""
    rows, drop = _joined(docs.select("doc_id", "text"), min_docs, batches)
    text = text_or_empty()
    kept = F.when(F.col(drop).isNull(), text).otherwise(
        F.concat_ws("\n", _without(_lines(text), F.col(drop))))
    return rows.select("doc_id", F.size(_lines(text)).cast("long").alias("n_lines"),
                       F.coalesce(F.size(drop), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept")
                       ).withColumn("n_dropped", F.greatest("n_dropped", F.lit(0)))


def dedup_digests(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def drop_common_lines(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """Documents without their common lines; columns stay, ``n_chars`` (where
    present) follows the text.  A text nothing is dropped from stays as it is."""
    names = docs.columns
    rows, drop = _joined(docs, min_docs, batches)
    out = rows.withColumn("text", F.when(F.col(drop).isNull(), F.col("text")).otherwise(
        F.concat_ws("\n", _without(_lines(F.col("text")), F.col(drop)))))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col(drop).isNull(), F.col("n_chars")).otherwise(
            F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*names)


#: DuckDB SQL of the query's rows.
ORACLE = """
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), common AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT k.*, c.key IS NOT NULL AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
