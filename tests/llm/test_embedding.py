import math
import random

import numpy as np

import __spark_entry__ as E
from oracle_compare import compare, duck
from tessera.llm import embedding_dedup as D


def brute(rows, cosine=0.93):
    def sound(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    links = {i: [] for i in range(len(rows))}
    for i, (_, a, la) in enumerate(rows):
        for j, (_, b, lb) in enumerate(rows):
            if i != j and la is not None and la == lb and sound(a) and sound(b) and len(a) == len(b):
                a64, b64 = np.array(a, np.float32).astype(float), np.array(b, np.float32).astype(float)
                if a64 @ b64 / np.sqrt((a64 @ a64) * (b64 @ b64)) >= cosine:
                    links[i].append(j)
    out = []
    for i, (vid, _, _) in enumerate(rows):
        seen, work = {i}, [i]
        while work:
            for j in links[work.pop()]:
                if j not in seen:
                    seen.add(j)
                    work.append(j)
        lo = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((vid, len(links[i]), lo, vid == lo))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x") for r in rows],
                               "vec_id long, embedding array<float>, label int, cid string")
    return sorted((tuple(r) for r in D.link_vectors(df, **kw).collect()), key=str)


def test_query_matches_sql(spark, sf):
    compare(E.queries()["op6_embedding_dedup"](spark, sf), duck(sf), E.oracle_sql()["op6_embedding_dedup"])


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(6):
        centre = rng.standard_normal(20)
        for _ in range(25):
            rows.append((len(rows), (centre + 0.18 * rng.standard_normal(20)).tolist(), c % 2))
    rows += [(200 + i, rows[0][1], 0) for i in range(30)]
    want = brute(rows)
    assert any(x[1] for x in want)
    assert run(spark, rows) == want
    assert run(spark, rows, block=5) == want


def test_defined_cases(spark):
    v = [1.0, 2.0, 0.5]
    rows = [(9, v, 1), (4, v, 1), (4, v, 1), (1, v, None), (2, v, 2), (3, None, 1), (5, [0.0] * 3, 1), (6, [], 1),
            (7, [float("nan"), 1.0, 1.0], 1), (8, [float("inf"), 1.0, 1.0], 1), (10, [None, 1.0, 1.0], 1),
            (11, [1.0, 2.0], 1), (12, [2.0, 4.0, 1.0], 1), (None, v, 3)]
    assert run(spark, rows) == sorted([(a, b, c, a == c) for a, b, c, _ in brute(rows)], key=str)
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert D.link_vectors(df).collect() == []


def test_every_near_pair_shares_a_cell():
    rng = random.Random(5)
    gen = np.random.default_rng(5)
    for _ in range(100):
        a = gen.standard_normal(64)
        b = a + 0.3 * gen.standard_normal(64) * rng.random()
        x = np.stack([a / np.linalg.norm(a), b / np.linalg.norm(b)])
        if x[0] @ x[1] < 0.93:
            continue
        blocks, budget = D._budgets(64, 0.93)
        turned, met = x @ D.rotation(64), False
        for k, block in enumerate(blocks):
            d = ((turned[0, block] - turned[1, block]) ** 2).sum()
            if d <= budget[k]:
                where = [(int(r), tuple(c), h) for rows, cell, h in D._cells(turned[:, block], budget[k] ** 0.5)
                         for r, c in zip(rows, cell.tolist())]
                home = next(c for r, c, h in where if r == 0 and h)
                met |= any(r == 1 and c == home for r, c, _ in where)
        assert met


def test_hot_cell_is_cut_into_bounded_tiles(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(16)
    rows = [(i, (centre + 0.12 * rng.standard_normal(16)).tolist(), 1) for i in range(240)]
    sizes = []
    dealt = D._dealt

    def spy(classes, cosine, block):
        out = dealt(classes, cosine, block)
        sizes.extend(r["count"] for r in out.groupBy("key", "_h", "_r").count().collect())
        return out

    monkeypatch.setattr(D, "_dealt", spy)
    want = brute(rows)
    assert sum(x[1] for x in want) > 1000
    for finer in (1, 100):  # more coordinates first, or tiles alone
        monkeypatch.setattr(D, "FINER", finer)
        sizes.clear()
        assert run(spark, rows, block=8) == want
        # a home block and a block of others, both dealt by a hash: twice their mean at most
        assert max(sizes) <= 2 * (1 + D.REPLICAS) * 8
