"""Hard-negative mining over lists that the anchors of a cluster share.

Anchors are clustered by direction.  By the triangle inequality of angles the
inner product of a candidate i with any anchor u of a cluster with centre c and
widest angle w is at most |u| |i| cos(max(0, angle(i, c) - w)).  The
candidates of a cluster are sorted by |i| cos(...) once, and all its anchors
walk that list together; an anchor leaves when the bound times its norm falls
below the score it still needs, which certifies its result.

Two walks follow each other: over candidates of the anchor's label for the
positives, then over all for the negatives, in the score window each positive
opens.  What an anchor needs at least is known beforehand from a bounded sample of
candidates (real scores, so valid bounds), and a candidate is sent to a cluster
only if its bound reaches the least need there.  A cluster's anchors are cut
into blocks of about ``ANCHORS`` and its list into parts of about ``LISTED``; the
best of the parts are merged by rank.  So a task holds one block of anchors and
a batch of the list, whatever the sizes of clusters and labels, and no lost
task costs more than its lists.  Without structure in the data the bounds prune
little and the walk is the blocked comparison of the anchors with all rows.

Centres are fitted on at most ``FITTED`` anchors and needs on at most ``SAMPLED``
rows; neither affects the result.  Scores are exact integers (double matrix products
below 2^53, long ones above); vectors whose squared length reaches 2^56 raise.

Defined cases: rows with a null id, label or vector, or a null or non-finite
component, take no part; vectors shorter than the longest count as if filled up
with zeros; repeated rows are rows of their own, also as each other's positives;
labels compare as whole numbers or by a 64-bit hash of their text; an
empty table, or one without anchors, gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tessera.llm.common import stage

KEEP = 5  # positives of an anchor, and negatives of a positive
ANCHORS, LISTED = 256, 4096
PER_CLUSTER, CLUSTERS = 32, 256
FITTED, SAMPLED = 8192, 4096
CHUNK = 512
LEAST, MOST = -(1 << 62), 1 << 62
_SLACK = 1e-6  # of a norm, for rounding in angles
_TILE = ("cluster", "of_label", "block", "part")


def _packed(m: np.ndarray, kind: str) -> pa.Array:
    """The rows of a matrix as binary values."""
    raw = np.ascontiguousarray(m, kind)
    step = raw.shape[1] * raw.itemsize
    ends = np.arange(len(raw) + 1, dtype=np.int32) * np.int32(step)
    return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(ends), pa.py_buffer(raw)])


def _matrix(column, kind: str, dim: int) -> np.ndarray:
    """Rows of ``_packed`` as the numbers to multiply: doubles, or longs if wide."""
    raw = np.frombuffer(b"".join(column.to_pylist()), "<i8" if kind == "wide" else kind)
    return raw.reshape(-1, dim).astype(np.int64 if kind == "wide" else np.float64)


def _table(rows: DataFrame, vector: str, scale: int) -> tuple[DataFrame, str, int] | None:
    """(rid, vec_id, label, vec, norm) of the rows that take part, how vectors
    are stored, and their length."""
    whole = isinstance(rows.schema["label"].dataType, IntegralType)
    label = F.col("label").cast("long") if whole else F.xxhash64(F.col("label").cast("string"))
    scaled = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale))
    fine = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                    & (F.abs(x.cast("double")) < float("inf")))
    clean = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull() & fine
                       ).select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), scaled.alias("q"))
    square = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    widest, dim, size = clean.agg(F.max(square), F.max(F.size("q")),
                                  F.max(F.array_max(F.transform("q", lambda x: F.abs(x))))).first()
    if widest is None:
        return None
    if widest >= 2.0 ** 56:
        raise ValueError("inner products of these vectors may not fit: squared length of 2^56 or more")
    kind = "wide" if widest >= 2.0 ** 53 else "<i2" if (size or 0) < 1 << 15 else "<i4" if size < 1 << 31 else "<i8"
    dim = max(dim, 1)

    def pack(batches):
        for b in batches:
            q = b.column("q")
            lengths = pc.list_value_length(q).to_numpy(zero_copy_only=False)
            m = np.zeros((b.num_rows, dim), np.int64)
            m[np.arange(dim) < lengths[:, None]] = q.flatten().to_numpy(zero_copy_only=False)
            norm = np.sqrt((m.astype(np.float64) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), _packed(m, "<i8" if kind == "wide" else kind), pa.array(norm)],
                names=["vec_id", "label", "vec", "norm"])

    packed = clean.mapInArrow(pack, "vec_id long, label long, vec binary, norm double")
    return stage(packed.withColumn("rid", F.monotonically_increasing_id()), "vectors"), kind, dim


def _sample(rows: DataFrame, size: int) -> dict[str, list]:
    """At most ``size`` rows, chosen by hash."""
    found = rows.orderBy(F.xxhash64("rid"), "rid").limit(size).toArrow()
    return {n: found.column(n) for n in found.schema.names}


def _centres(m: np.ndarray, k: int) -> np.ndarray:
    """Unit centres of a spherical k-means over the rows that are not zero."""
    unit = m[m.any(1)].astype(np.float64)
    if not len(unit):
        return np.zeros((0, m.shape[1]))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    centres = unit[np.random.default_rng(1).choice(len(unit), min(k, len(unit)), replace=False)]
    for _ in range(8):
        near = (unit @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, unit)
        length = np.linalg.norm(sums, axis=1)
        centres = np.where(length[:, None] > 0, sums / np.maximum(length, 1e-300)[:, None], centres)
    return centres


def _angles(m: np.ndarray, norm: np.ndarray, centres: np.ndarray) -> np.ndarray:
    cosine = m.astype(np.float64) @ centres.T / np.where(norm > 0, norm, 1)[:, None]
    return np.arccos(np.clip(cosine, -1, 1))


def _kth(scores: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Per row the k-th best allowed score, LEAST where there are fewer."""
    s = np.where(allowed, scores, LEAST).astype(np.int64)
    return np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k] if s.shape[1] >= k else np.full(len(s), LEAST)


def _walk(kind: str, dim: int, same: bool):
    """The shared walk over sorted tiles: anchors of a tile come first, then its
    candidates by falling bound."""

    def chunks(batches) -> Iterator[tuple]:
        """(tile, side, columns) of stretches of rows of one tile and side."""
        for b in batches:
            cols = {n: b.column(n) for n in b.schema.names}
            keys = np.stack([cols[n].to_numpy(zero_copy_only=False) for n in (*_TILE, "side")])
            cut = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            for s, e in zip([0, *cut], [*cut, b.num_rows]):
                if s < e:
                    yield tuple(keys[:4, s].tolist()), int(keys[4, s]), {n: c.slice(s, e - s) for n, c in cols.items()}

    def run(batches):
        tile, members, state = None, [], None
        for key, side, cols in chunks(batches):
            if key != tile:
                if state is not None:
                    yield from state.best()
                tile, members, state = key, [], None
            if side == 0:
                members.append(cols)
                continue
            if not members:  # no anchor of this block: nothing to walk for
                continue
            if state is None:
                state = _Members(members, kind, dim, same)
            state.walk(cols)
        if state is not None:
            yield from state.best()

    return run


class _Members:
    """The anchors of a tile, their slots (a score window each) and best rows so far."""

    def __init__(self, members: list[dict], kind: str, dim: int, same: bool):
        def joined(name):
            return np.concatenate([c[name].to_numpy(zero_copy_only=False) for c in members])
        self.kind, self.dim, self.same = kind, dim, same
        self.rid, self.label, self.norm = joined("rid"), joined("label"), joined("norm")
        self.m = np.concatenate([_matrix(c["vec"], kind, dim) for c in members])
        slots = [s for c in members for s in c["slots"].to_pylist()]
        self.of = np.array([i for i, s in enumerate(slots) for _ in s], np.int64)
        self.top = np.array([x["top"] for s in slots for x in s], np.int64)
        self.need = np.array([x["need"] for s in slots for x in s], np.int64)
        self.kept = np.zeros((0, 3), np.int64)  # slot, score, vec_id

    def walk(self, cols: dict) -> None:
        bound = cols["bound"].to_numpy(zero_copy_only=False)
        for s in range(0, len(bound), CHUNK):
            open_ = np.flatnonzero(self.need <= self.norm[self.of] * bound[s])
            if not len(open_):
                return  # certified: nothing further down can enter any list
            who, slot = np.unique(self.of[open_], return_inverse=True)
            part = {n: c.slice(s, CHUNK) for n, c in cols.items() if n in ("vec", "label", "rid", "vec_id")}
            scores = (self.m[who] @ _matrix(part["vec"], self.kind, self.dim).T).astype(np.int64)
            label, rid = (part[n].to_numpy(zero_copy_only=False) for n in ("label", "rid"))
            fits = (self.label[who][:, None] == label) if self.same else (self.label[who][:, None] != label)
            fits &= self.rid[who][:, None] != rid
            scores = np.where(fits, scores, LEAST - 1)[slot]
            hit, at = np.nonzero((scores >= self.need[open_][:, None]) & (scores <= self.top[open_][:, None]))
            if not len(hit):
                continue
            new = np.stack([open_[hit], scores[hit, at], part["vec_id"].to_numpy(zero_copy_only=False)[at]], 1)
            rows = np.concatenate([self.kept, new])
            rows = rows[np.lexsort((rows[:, 2], -rows[:, 1], rows[:, 0]))]
            first = np.searchsorted(rows[:, 0], rows[:, 0])
            place = np.arange(len(rows)) - first
            self.kept = rows[place < KEEP]
            last = rows[place == KEEP - 1]
            self.need[last[:, 0]] = np.maximum(self.need[last[:, 0]], last[:, 1])

    def best(self) -> Iterator[pa.RecordBatch]:
        if len(self.kept):
            slot = self.kept[:, 0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.rid[self.of[slot]]), pa.array(self.top[slot]), pa.array(self.kept[:, 2]),
                 pa.array(self.kept[:, 1])], names=["rid", "top", "found_id", "score"])


def _listed(table: DataFrame, centres: np.ndarray, limits: dict[int, tuple[float, float]], kind: str, dim: int) -> DataFrame:
    """Candidates once per cluster whose least need their bound can reach."""
    def run(batches):
        for b in batches:
            m = _matrix(b.column("vec"), kind, dim)
            norm = b.column("norm").to_numpy(zero_copy_only=False)
            angle = _angles(m, norm, centres)
            for c, (widest, need) in limits.items():
                away = np.maximum(0, angle[:, c] - widest) if c < len(centres) else np.zeros(len(m))
                bound = norm * (np.cos(away) + _SLACK)
                keep = np.flatnonzero(bound >= need)
                if len(keep):
                    out = b.take(pa.array(keep))
                    yield pa.RecordBatch.from_arrays(
                        [*out.columns, pa.array(np.full(len(keep), c, np.int32)), pa.array(bound[keep])],
                        names=[*out.schema.names, "cluster", "bound"])

    return table.mapInArrow(run, "vec_id long, label long, vec binary, norm double, rid long, cluster int, bound double")


def _search(anchors: DataFrame, table: DataFrame, centres: np.ndarray, kind: str, dim: int, parts: int,
            same: bool) -> DataFrame:
    """(rid, top, found_id, score, rank) of the best rows of each slot."""
    need = F.array_min(F.transform("slots", lambda s: s["need"])).cast("double")
    limits = {r["cluster"]: (r["widest"], r["need"]) for r in anchors.groupBy("cluster").agg(
        F.max("angle").alias("widest"),
        F.min(F.when(F.col("norm") > 0, need / F.col("norm")).otherwise(F.lit(float("-inf")))).alias("need")).collect()}
    of_label = F.col("label") if same else F.lit(0).cast("long")
    mine = anchors.withColumn("of_label", of_label)
    # one small row per cluster (and label); Spark measures it before it sends it to every task
    units = stage(mine.groupBy("cluster", "of_label").agg(F.count(F.lit(1)).alias("n")).select(
        "cluster", "of_label", F.ceil(F.col("n") / F.lit(float(ANCHORS))).cast("int").alias("blocks")), "units")
    mine = mine.join(units, ["cluster", "of_label"]).select(
        "cluster", "of_label", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(0).alias("side"), "vec_id", "label",
        "vec", "norm", "rid", F.lit(float("inf")).alias("bound"), "slots")
    listed = _listed(table, centres, limits, kind, dim).withColumn("of_label", of_label).join(
        units, ["cluster", "of_label"]).select(
        "cluster", "of_label", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("rid", F.lit(1)), F.lit(parts)).cast("int").alias("part"), F.lit(1).alias("side"), "vec_id",
        "label", "vec", "norm", "rid", "bound", F.lit(None).cast("array<struct<top:long,need:long>>").alias("slots"))
    dealt = mine.unionByName(listed).repartition(*_TILE).sortWithinPartitions(*_TILE, "side", F.col("bound").desc())
    found = dealt.mapInArrow(_walk(kind, dim, same), "rid long, top long, found_id long, score long")
    order = Window.partitionBy("rid", "top").orderBy(F.col("score").desc(), F.col("found_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= KEEP)


def mine_negatives(rows: DataFrame, is_anchor: Column, vector: str = "embedding", scale: int = 256,
                   low: int = 80, high: int = 100) -> DataFrame:
    """Per anchor and positive the first negatives whose score lies between
    ``low`` and ``high`` hundredths (0 <= low <= high <= 100) of the positive's.

    ``rows(vec_id, vector, label)``; ``is_anchor`` is a condition on vec_id.
    """
    if not 0 <= low <= high <= 100:
        raise ValueError("low and high are hundredths, in order")
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    made = _table(rows, vector, scale)
    spark = rows.sparkSession
    if made is None:
        return spark.createDataFrame([], out)
    table, kind, dim = made
    chosen = table.where(is_anchor)
    n_rows, n_anchors = table.count(), chosen.count()
    if not n_anchors:
        return spark.createDataFrame([], out)
    centres = _centres(_matrix(_sample(chosen, FITTED)["vec"], kind, dim),
                       min(CLUSTERS, -(-n_anchors // PER_CLUSTER)))
    some = _sample(table, SAMPLED)
    sample = {n: some[n].to_numpy() for n in ("label", "rid")} | {"m": _matrix(some["vec"], kind, dim)}
    parts = -(-n_rows // LISTED)

    def assign(batches):
        for b in batches:
            m = _matrix(b.column("vec"), kind, dim)
            norm, label, rid = (b.column(n).to_numpy(zero_copy_only=False) for n in ("norm", "label", "rid"))
            angle = _angles(m, norm, centres)
            # zero vectors have no direction: a cluster of their own
            near = np.where(norm > 0, angle.argmin(1), len(centres)) if len(centres) else np.zeros(len(m), np.int64)
            turn = np.where(near < len(centres), angle[np.arange(len(m)), np.minimum(near, len(centres) - 1)], 0.0) \
                if len(centres) else np.zeros(len(m))
            need = _kth((m @ sample["m"].T).astype(np.int64),
                        (label[:, None] == sample["label"]) & (rid[:, None] != sample["rid"]), KEEP)
            slots = pa.array([[{"top": MOST, "need": int(x)}] for x in need],
                             pa.list_(pa.struct([("top", pa.int64()), ("need", pa.int64())])))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near.astype(np.int32)), pa.array(turn), slots],
                                             names=[*b.schema.names, "cluster", "angle", "slots"])

    kinds = ("vec_id long, label long, vec binary, norm double, rid long, cluster int, angle double, "
             "slots array<struct<top:long,need:long>>")
    anchors = stage(chosen.mapInArrow(assign, kinds), "anchors")
    positives = stage(_search(anchors, table, centres, kind, dim, parts, True).select(
        "rid", F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    def window(batches):
        for b in batches:
            m = _matrix(b.column("vec"), kind, dim)
            label = b.column("label").to_numpy(zero_copy_only=False)
            scores = (m @ sample["m"].T).astype(np.int64)
            slots = []
            for i, tops in enumerate(b.column("tops").to_pylist()):
                others = scores[i, label[i] != sample["label"]]
                mine = []
                for top in tops:
                    least = -(-low * top // 100)
                    under = others[(others <= high * top // 100) & (others >= least)]
                    known = int(np.partition(under, len(under) - KEEP)[-KEEP]) if len(under) >= KEEP else LEAST
                    mine.append({"top": top, "need": max(least, known)})
                slots.append(mine)
            kept = [b.column(n) for n in b.schema.names if n != "tops"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(slots, pa.list_(pa.struct([("top", pa.int64()), ("need", pa.int64())])))],
                names=[*(n for n in b.schema.names if n != "tops"), "slots"])

    # a negative score opens an empty window
    tops = positives.where("positive_score >= 0").groupBy("rid").agg(F.collect_set("positive_score").alias("tops"))
    seeking = stage(anchors.drop("slots").join(tops, "rid").select(
        "vec_id", "label", "vec", "norm", "rid", "cluster", "angle", "tops").mapInArrow(window, kinds), "seeking")
    negatives = _search(seeking, table, centres, kind, dim, parts, False)
    named = positives.join(anchors.select("rid", F.col("vec_id").alias("anchor_id")), "rid")
    return named.join(negatives.withColumnRenamed("top", "positive_score"), ["rid", "positive_score"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def hard_negatives(rows: DataFrame) -> DataFrame:
    """The query: every seventh row's label moves on by one, every hundredth row
    is an anchor."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(rows.select("vec_id", "embedding", moved.alias("label")), F.col("vec_id") % 100 == 0)


#: DuckDB SQL of the query's rows.
ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.rid, a.vec_id AS anchor_id, a.label = b.label AS same, b.rid AS other, b.vec_id,
         CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.rid <> b.rid WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS place FROM s WHERE same)
  WHERE place <= 5
), negatives AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.rid, p.other ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN s n ON n.rid = p.rid AND NOT n.same
    AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= 5
"""
