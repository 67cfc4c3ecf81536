"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors with cosine >= c are within squared distance 2 - 2c.  A fixed
random rotation spreads the variance evenly; the rotated vector is split into
blocks of ``BLOCK_DIMS`` dimensions, and the squared distance budget is shared
out in proportion to their dimensions.  A pair within the whole budget is
within its share in at least one block, so each block is range-joined on its
own: a vector's home is its grid cell over the block's leading coordinates,
and it is replicated to every cell that its budget ball reaches.  At a cell
every home vector meets all vectors that came there; a pair counts at the
first block in which it is within budget, so no pair counts twice, and all
candidates are verified by the cosine of the original vectors in double
precision.

Equal vectors of a label are one row with a count.  A cell's links leave as
link counts per home vector and a spanning forest, never as all pairs.  Cells
with very many homes are cut by the block's next coordinates, and those still
large into tiles of a home block and a replica block, so what a task holds at
once is bounded by ``BLOCK``, not by the cell.

Defined cases: a vector that is null, zero, or holds null or non-finite
components, or whose label is null, links with nothing; a zero-length vector
counts as zero; vectors of different lengths do not link; repeated rows are
other vectors; further columns are ignored.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import groups_of, map_rows, stage
from tessera.llm.components import connected_components

MIN_COSINE = 0.93
BLOCK_DIMS = 8
GRID_DIMS = 2
BLOCK = 4096
#: Rows of a replica block per row of a home block; home blocks from which a cell is cut by more coordinates.
REPLICAS = 4
FINER = 8
_ROW = "cell string, home boolean, block int, cid string, n long, vec binary"
TILE = 1024
_ROUNDING = 1e-9  # room for rounding in the candidate search; the check is exact


def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(7).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def _units(vectors: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), -1)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _budgets(dims: int, cosine: float) -> tuple[list[slice], np.ndarray]:
    blocks = [slice(s, min(dims, s + BLOCK_DIMS)) for s in range(0, dims, BLOCK_DIMS)]
    share = np.array([b.stop - b.start for b in blocks]) / dims
    return blocks, (2 - 2 * cosine) * share + _ROUNDING


def _cells(x: np.ndarray, radius: float):
    """(row, cell numbers, home) of every grid cell the balls reach; cells are
    twice the radius wide."""
    width = 2 * radius
    g = min(GRID_DIMS, x.shape[1])
    base = np.floor(x[:, :g] / width).astype(np.int64)
    steps = np.stack(np.meshgrid(*[[-1, 0, 1]] * g, indexing="ij"), -1).reshape(-1, g)
    for step in steps:
        cell = base + step
        gap = np.maximum(cell * width - x[:, :g], 0) + np.maximum(x[:, :g] - (cell + 1) * width, 0)
        rows = np.nonzero((gap * gap).sum(1) <= radius * radius)[0]
        yield rows, cell[rows], not step.any()


def _replicate(cosine: float, vectors: bool):
    def run(batches):
        for b in batches:
            by_size: dict[int, list[int]] = {}
            for i, v in enumerate(b["vec"]):
                by_size.setdefault(len(v), []).append(i)
            for size, members in by_size.items():
                dims = size // 8
                x = _units([b["vec"][i] for i in members]) @ rotation(dims)
                blocks, budget = _budgets(dims, cosine)
                for k, block in enumerate(blocks):
                    for rows, cell, home in _cells(x[:, block], float(np.sqrt(budget[k]))):
                        if not len(rows):
                            continue
                        pick = [members[r] for r in rows]
                        names = [f"{b['label'][i]}|{dims}|{k}|" + ",".join(map(str, c))
                                 for i, c in zip(pick, cell.tolist())]
                        out = {"cell": names, "home": [home] * len(pick)}
                        if vectors:
                            out |= {"block": [k] * len(pick), "cid": [b["cid"][i] for i in pick],
                                    "n": [b["n"][i] for i in pick], "vec": [b["vec"][i] for i in pick]}
                        yield out
    return run


def _refine(cosine: float, done: int):
    """Rows of cells over the first ``done`` coordinates, sent on to the cells
    over the next ones too that their balls reach."""
    def run(batches):
        for b in batches:
            by_kind: dict[tuple[int, int], list[int]] = {}
            for i, (v, k) in enumerate(zip(b["vec"], b["block"])):
                by_kind.setdefault((len(v), k), []).append(i)
            for (size, k), members in by_kind.items():
                dims = size // 8
                blocks, budget = _budgets(dims, cosine)
                x = (_units([b["vec"][i] for i in members]) @ rotation(dims))[:, blocks[k]]
                g = min(done + GRID_DIMS, x.shape[1])
                old = np.array([b["cell"][i].rsplit("|", 1)[1].split(",") for i in members], np.int64)
                width = 2 * np.sqrt(budget[k])
                base = np.floor(x[:, old.shape[1]:g] / width).astype(np.int64)
                for step in itertools.product((-1, 0, 1), repeat=base.shape[1]):
                    cell = np.concatenate([old, base + np.array(step, np.int64)], 1)
                    gap = np.maximum(cell * width - x[:, :g], 0) + np.maximum(x[:, :g] - (cell + 1) * width, 0)
                    rows = np.nonzero((gap * gap).sum(1) <= budget[k])[0]
                    if not len(rows):
                        continue
                    pick = [members[r] for r in rows]
                    yield {"cell": [",".join([b["cell"][i], *map(str, c[old.shape[1]:])])
                                    for i, c in zip(pick, cell[rows].tolist())],
                           "home": [b["home"][i] and not any(step) for i in pick], "block": [k] * len(pick),
                           "cid": [b["cid"][i] for i in pick], "n": [b["n"][i] for i in pick],
                           "vec": [b["vec"][i] for i in pick]}
    return run


def _tiles(rows: DataFrame, block: int) -> DataFrame:
    """Rows with the tile (_h, _r) of their cell.  A cell of up to ``block``
    home rows (``_homes``) and ``REPLICAS`` times that in all (``_rows``) is one
    tile, where a home row is an ``other`` row as well.  A larger one has a tile
    per home block and block of others; a home row goes to each tile of its home
    block, and every row as an other to each tile of its block of others."""
    whole = F.col("_rows").isNull()
    h = F.ceil(F.col("_homes") / F.lit(float(block))).cast("int")
    r = F.ceil(F.col("_rows") / F.lit(float(REPLICAS * block))).cast("int")

    def tile(a, b, home, other):
        return F.struct(a.cast("int").alias("_h"), b.cast("int").alias("_r"), home.alias("home"), other.alias("other"))

    yes, no, zero = F.lit(True), F.lit(False), F.lit(0)
    own_h, own_r = F.pmod(F.xxhash64("cid", F.lit(1)), h), F.pmod(F.xxhash64("cid", F.lit(2)), r)
    as_home = F.transform(F.sequence(zero, r - 1), lambda i: tile(own_h, i, yes, no))
    as_other = F.transform(F.sequence(zero, h - 1), lambda i: tile(i, own_r, no, yes))
    to = (F.when(whole, F.array(tile(zero, zero, F.col("home"), yes)))
          .when(F.col("home"), F.concat(as_home, as_other)).otherwise(as_other))
    return (rows.where(whole | (F.col("_homes") > 0))  # without a home there is nothing to compare
            .withColumn("_to", F.explode(to))
            .select("key", "cell", "block", "cid", "n", "vec", "_to.*"))


def _dealt(classes: DataFrame, cosine: float, block: int) -> DataFrame:
    """All rows of all cells, dealt and sorted by (key, _h, _r)."""
    key = F.xxhash64("cell").alias("key")
    rows = map_rows(classes.select("cid", "label", "vec", "n"), _replicate(cosine, True), _ROW).select(key, "*")
    names = map_rows(classes.select("label", "vec"), _replicate(cosine, False),
                     "cell string, home boolean").select(key, "home")
    parts = []
    for done in range(GRID_DIMS, BLOCK_DIMS + 1, GRID_DIMS):
        large = stage(names.groupBy("key").agg(F.count(F.lit(1)).alias("_rows"),
                                               F.sum(F.col("home").cast("long")).alias("_homes"))
                      .where((F.col("_rows") > REPLICAS * block) | (F.col("_homes") > block)), "large-cells")
        counted = rows.join(large, "key", "left")
        finer = F.coalesce(F.col("_homes") > FINER * block, F.lit(False))
        if done + GRID_DIMS > BLOCK_DIMS or large.where(finer).isEmpty():
            parts.append(_tiles(counted, block))
            break
        parts.append(_tiles(counted.where(~finer), block))
        rows = stage(map_rows(counted.where(finer).select("cell", "home", "block", "cid", "n", "vec"),
                              _refine(cosine, done), _ROW), "finer-cells").select(key, "*")
        names = rows.select("key", "home")
    out = functools.reduce(DataFrame.unionByName, parts)
    return out.repartition("key", "_h", "_r").sortWithinPartitions("key", "_h", "_r")


def _forest(cids, pairs):
    """Edges of ``pairs`` (row, row) that join parts not yet joined."""
    root = list(range(len(cids)))
    for a, b in pairs:
        ra, rb = a, b
        while root[ra] != ra:
            root[ra] = ra = root[root[ra]]
        while root[rb] != rb:
            root[rb] = rb = root[root[rb]]
        if ra != rb:
            root[max(ra, rb)] = min(ra, rb)
            yield cids[a], cids[b]


def _compare(cosine: float):
    def run(batches):
        for g in groups_of(batches, ("key", "_h", "_r")):
            home_rows = np.nonzero(np.array(g["home"], bool))[0]
            if not len(home_rows):
                continue
            # a 64-bit key may hold two cells; a cell's name decides
            names, code = np.unique(np.array(g["cell"]), return_inverse=True)
            for c in range(len(names)):
                rows = np.nonzero(code == c)[0]
                homes = home_rows[code[home_rows] == c]
                if len(rows) < 2 or not len(homes):
                    continue
                k = g["block"][rows[0]]
                unit = _units([g["vec"][i] for i in rows])
                turned = unit @ rotation(unit.shape[1])
                blocks, budget = _budgets(unit.shape[1], cosine)
                weight = np.array([g["n"][i] for i in rows], np.int64)
                cids = [g["cid"][i] for i in rows]
                who = np.array(cids, object)
                rest = np.nonzero(np.array([g["other"][i] for i in rows], bool))[0]
                at = np.searchsorted(rows, homes)
                links = np.zeros(len(homes), np.int64)
                edges = []

                def apart(h, r, block):
                    a, b = turned[h, block], turned[r, block]
                    return (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T

                for hs in range(0, len(at), TILE):
                    h = at[hs:hs + TILE]
                    tile = []
                    for rs in range(0, len(rest), 4 * TILE):
                        r = rest[rs:rs + 4 * TILE]
                        hit = apart(h, r, blocks[k]) <= budget[k]
                        for j in range(k):  # an earlier block has these already
                            if hit.any():
                                hit &= apart(h, r, blocks[j]) > budget[j]
                        hi, ri = np.nonzero(hit)
                        ri = r[ri]
                        ok = (unit[h[hi]] * unit[ri]).sum(1) >= cosine
                        hi, ri = hi[ok], ri[ok]
                        other = who[h[hi]] != who[ri]
                        np.add.at(links, hs + hi[other], weight[ri[other]])
                        tile += zip(h[hi[other]].tolist(), ri[other].tolist())
                    edges += _forest(range(len(cids)), tile)  # keeps the list as short as the group
                edges = list(_forest(cids, edges))
                linked = np.nonzero(links)[0]
                if len(linked):
                    yield {"u": [cids[at[i]] for i in linked] + [a for a, _ in edges],
                           "v": [None] * len(linked) + [b for _, b in edges],
                           "n_links": [int(links[i]) for i in linked] + [0] * len(edges)}
    return run


def link_vectors(vectors: DataFrame, cosine: float = MIN_COSINE, block: int = BLOCK) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    v = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    sound = (F.col("label").isNotNull() & F.col("embedding").isNotNull()
             & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
             & F.exists("embedding", lambda x: x != 0))
    kind = v.schema["vec_id"].dataType.simpleString()

    def pack(batches):
        for b in batches:
            yield {"vec_id": b["vec_id"], "label": [None if x is None else str(x) for x in b["label"]],
                   "vec": [None if e is None else np.array(e, "<f8").tobytes() for e in b["embedding"]]}

    packed = map_rows(v.withColumn("embedding", F.when(F.coalesce(sound, F.lit(False)), F.col("embedding"))),
                      pack, f"vec_id {kind}, label string, vec binary")
    rows = stage(packed.withColumn("cid", F.when(F.col("vec").isNotNull(), F.sha1(F.concat(
        F.col("label").cast("binary"), F.lit(b"|"), F.col("vec"))))), "vectors")
    classes = stage(rows.where("cid IS NOT NULL").groupBy("cid").agg(
        F.first("label").alias("label"), F.first("vec").alias("vec"), F.count(F.lit(1)).alias("n"),
        F.min("vec_id").alias("lo")), "vector-classes")

    found = stage(map_rows(_dealt(classes, cosine, block), _compare(cosine), "u string, v string, n_links long"), "vector-links")

    links = found.groupBy(F.col("u").alias("cid")).agg(F.sum("n_links").alias("n_links"))
    parts = stage(connected_components(found.where("v IS NOT NULL").select("u", "v")), "components")
    named = stage(classes.select("cid", "n", "lo").join(parts, F.col("cid") == F.col("node"), "left")
                  .select("cid", "n", "lo", F.coalesce("component", "cid").alias("root"))
                  .join(links, "cid", "left"), "vector-components")
    lowest = stage(named.groupBy("root").agg(F.min("lo").alias("component_id")), "component-ids")
    of = stage(named.join(lowest, "root").select(
        "cid", (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"), "component-of")
    alone = rows.where("cid IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                             F.col("vec_id").alias("component_id"))
    linked = rows.where("cid IS NOT NULL").join(of, "cid").select("vec_id", "n_links", "component_id")
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


#: DuckDB SQL of the query's rows (all pairs of a label; for small tables).
ORACLE = """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM sound a JOIN sound b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93
), reach(u, v) AS (
  SELECT u, v FROM pairs UNION SELECT r.u, p.v FROM reach r JOIN pairs p ON r.v = p.u
), lowest AS (SELECT u, min(v) AS lo FROM reach GROUP BY u),
counts AS (SELECT u, count(*) AS n FROM pairs GROUP BY u)
SELECT e.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links,
       least(e.vec_id, coalesce(l.lo, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(l.lo, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN counts c ON c.u = e.vec_id LEFT JOIN lowest l ON l.u = e.vec_id
"""
