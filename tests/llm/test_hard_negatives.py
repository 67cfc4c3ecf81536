"""Hard negatives against a plain ranking and SQL."""

import math

import numpy as np
import pytest
from oracle_compare import compare, duck
from pyspark.sql import functions as F
from tessera.llm import hard_negatives as H


def brute(rows, is_anchor, scale=256):
    clean = [(i, [math.floor(x * scale) for x in v], lab) for i, v, lab in rows
             if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (ai, av, al) in enumerate(clean):
        if not is_anchor(ai):
            continue
        scored = [(-sum(x * y for x, y in zip(av, v)), i, lab) for b, (i, v, lab) in enumerate(clean) if b != a]
        for p, pi in sorted((s, i) for s, i, lab in scored if lab == al)[:5]:
            fits = sorted((s, i) for s, i, lab in scored if lab != al and 80 * -p <= 100 * -s <= 100 * -p)
            out += [(ai, pi, r, ni, -p, -n) for r, (n, ni) in enumerate(fits[:5], 1)]
    return sorted(out)


def table(spark, rows, label="int"):
    return spark.createDataFrame([(*r, "x", 0.5) for r in rows],
                                 f"vec_id long, embedding array<float>, label {label}, vec string, norm double")


def mined(spark, rows, is_anchor, label="int", **sizes):
    return sorted(tuple(r) for r in H.mine_negatives(table(spark, rows, label), is_anchor, **sizes).collect())


def sample(n, seed=1, dim=6, labels=3, centres=4):
    rng = np.random.default_rng(seed)
    mid = rng.normal(size=(centres, dim))
    m = (mid[rng.integers(0, centres, n)] + 0.4 * rng.normal(size=(n, dim))).astype(np.float32)
    return [(i, m[i].tolist(), int(rng.integers(0, labels))) for i in range(n)]


def test_against_ranking(spark, monkeypatch):
    monkeypatch.setattr(H, "SAMPLED", 40)
    monkeypatch.setattr(H, "ANCHORS", 5)
    monkeypatch.setattr(H, "LISTED", 50)
    monkeypatch.setattr(H, "PER_CLUSTER", 8)
    rows = sample(400)
    rows += rows[:20] + [(i, v, 1) for i, v, _ in rows[20:40]]  # repeated rows, and ids with another label
    got = mined(spark, rows, F.col("vec_id") % 10 == 0)
    assert got and got == brute(rows, lambda i: i % 10 == 0)


def test_ties_and_hot_label(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-1, 2, 4)], 0 if i % 3 else i % 2) for i in range(150)]
    assert mined(spark, rows, F.col("vec_id") % 10 == 0) == brute(rows, lambda i: i % 10 == 0)


def test_rows_that_take_no_part(spark):
    nan = float("nan")
    rows = sample(60, 5) + [(None, [1.0] * 6, 1), (100, None, 1), (200, [1.0] * 5 + [None], 1), (300, [nan] * 6, 1),
                            (400, [float("inf")] * 6, 1), (500, [1.0] * 6, None), (600, [], 1), (610, [1.0, 2.0], 1),
                            (620, [0.0] * 6, 0), (630, [0.0] * 6, 1), (640, [], 0)]
    assert mined(spark, rows, F.col("vec_id") % 10 == 0) == brute(rows, lambda i: i % 10 == 0)
    words = [(i, v, None if lab is None else "abc"[lab]) for i, v, lab in rows]
    assert mined(spark, words, F.col("vec_id") % 10 == 0, "string") == brute(words, lambda i: i % 10 == 0)


def test_wide_vectors(spark):
    rows = [(i, [float(np.float32(x * 1e3)) for x in v], lab) for i, v, lab in sample(80, 6)]
    assert mined(spark, rows, F.col("vec_id") % 10 == 0, scale=40_000) == brute(rows, lambda i: i % 10 == 0, 40_000)
    with pytest.raises(ValueError, match="2\\^56"):
        mined(spark, [(0, [1e9] * 6, 1)], F.col("vec_id") % 10 == 0)


def test_empty(spark):
    assert mined(spark, [], F.col("vec_id") % 10 == 0) == []
    assert mined(spark, sample(20), F.col("vec_id") < 0) == []
    assert mined(spark, sample(20, labels=1), F.col("vec_id") % 10 == 0) == []
    assert mined(spark, [(0, [1.0], 1)], F.col("vec_id") == 0) == []


def test_query_against_sql(spark, sf):
    from tessera.llm.queries import ORACLE, QUERIES
    compare(QUERIES["op13_hard_negatives"](spark, sf), duck(sf), ORACLE["op13_hard_negatives"])
