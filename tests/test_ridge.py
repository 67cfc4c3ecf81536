import math

import numpy as np

from tessera.operators import ridge as R
from tessera.sources import files as IO
from tessera.sources import tables as S


def brute_train(X, y, lam, max_iter=100, eps=0.01):
    n, d = X.shape
    F = lambda b: np.mean((y - X @ b) ** 2) + lam * b @ b
    G = lambda b: -2.0 / n * X.T @ (y - X @ b) + 2 * lam * b
    b = np.zeros(d)
    g = G(b)
    k = 0
    while k < max_iter and np.linalg.norm(g) > eps:
        t, f0 = 1.0, F(b)
        while F(b - t * g) > f0 - 0.2 * t * g @ g:
            t *= 0.6
        b = b - t * g
        g = G(b)
        k += 1
    return b, np.linalg.norm(g), k


def _data(spark, sf):
    df = S.price_rows(spark, sf)
    rows = df.collect()
    X = np.array([r.x for r in rows])
    y = np.array([r.y for r in rows])
    return df, X, y


def test_train_gram_and_pass_match_brute_force(spark, sf):
    df, X, y = _data(spark, sf)
    want_b, want_g, want_k = brute_train(X, y, 0.1)
    for method in ("gram", "pass"):
        b, g, k = R.ridge_train(df, lam=0.1, method=method, max_iter=100 if method == "gram" else 6)
        if method == "gram":
            assert k == want_k
            assert np.allclose(b, want_b, atol=1e-9)
            assert abs(g - want_g) < 1e-9
        else:
            wb, _, wk = brute_train(X, y, 0.1, max_iter=6)
            assert k == wk and np.allclose(b, wb, atol=1e-9)


def test_objective_gradient_and_check(spark, sf):
    df, X, y = _data(spark, sf)
    beta = np.array([0.3, -0.1, 0.2])
    f = R.ridge_objective(df, beta, 0.5).first()["objective"]
    assert abs(f - (np.mean((y - X @ beta) ** 2) + 0.5 * beta @ beta)) < 1e-12
    g = {r.idx: r.grad for r in R.ridge_gradient(df, beta, 0.5).collect()}
    want = -2.0 / len(y) * X.T @ (y - X @ beta) + beta
    assert all(abs(g[i] - want[i]) < 1e-12 for i in range(3))
    for r in R.gradient_check(df, beta, 0.5).collect():
        assert abs(r.numeric - r.analytic) < 1e-4


def test_model_roundtrip(spark, tmp_path):
    IO.save_dense_model(spark, [1.0, -2.5, 3.25], str(tmp_path / "b"))
    assert IO.load_dense_model(spark, str(tmp_path / "b")) == [1.0, -2.5, 3.25]


def test_optimum_agrees_with_mllib(spark, sf):
    """The GD fixed point equals MLlib's ridge optimum with regParam = lam * std(y)."""
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.regression import LinearRegression
    df, X, y = _data(spark, sf)
    b, _, _ = R.ridge_train(df, lam=0.1, max_iter=5000, eps=1e-10)
    std = float(np.std(y, ddof=1))
    ml = spark.createDataFrame([(Vectors.dense(x), float(t)) for x, t in zip(X, y)], ["features", "label"])
    m = LinearRegression(regParam=0.1 * std, elasticNetParam=0.0, fitIntercept=False,
                         standardization=False, solver="l-bfgs", tol=1e-12, maxIter=1000).fit(ml)
    assert np.allclose(b, m.coefficients.toArray(), atol=1e-5)


def test_large_offsets_cancel_nothing(spark):
    """Columns shifted by 1e6: the centred statistics and the passes agree, as do exact fractions."""
    import random
    from fractions import Fraction
    rng = random.Random(4)
    rows = [([1e6 + rng.random(), rng.random()], 1e6 + rng.random()) for _ in range(300)]
    df = spark.createDataFrame(rows, "x ARRAY<DOUBLE>, y DOUBLE").repartition(7)
    beta = [0.999, 0.3]
    exact = [sum(-2 * (Fraction(y) - sum(Fraction(a) * Fraction(b) for a, b in zip(x, beta))) * Fraction(x[i])
                 for x, y in rows) / len(rows) for i in range(2)]
    stats = R._gradient_from_stats(R.gram_statistics(df, 2), beta, 0.0)
    passed = [r.grad for r in R.ridge_gradient(df, beta).orderBy("idx").collect()]
    assert np.allclose(stats, [float(v) for v in exact], rtol=1e-9)
    assert np.allclose(passed, [float(v) for v in exact], rtol=1e-9)
    var = R.gram_statistics(df, 2)["cov_xx"][0][0]
    mean = sum(Fraction(x[0]) for x, _ in rows) / len(rows)
    assert abs(var / float(sum((Fraction(x[0]) - mean) ** 2 for x, _ in rows) / len(rows)) - 1) < 1e-9
    got = [R.ridge_train(df, 0.1, max_iter=3, eps=0.0, beta0=beta, method=m)[0] for m in ("gram", "pass")]
    assert np.allclose(got[0], got[1], rtol=1e-9)


def test_nan_raises(spark):
    import pytest
    df = spark.createDataFrame([([1.0], 2.0), ([float("nan")], 1.0)], "x ARRAY<DOUBLE>, y DOUBLE")
    for method in ("gram", "pass"):
        with pytest.raises(ValueError):
            R.ridge_train(df, 0.1, method=method)
    with pytest.raises(ValueError):
        R.ridge_line_search(df, [0.1], [1.0])


def test_wide_model_is_one_constant(spark):
    import time
    d = 3000
    rng = np.random.default_rng(5)
    X, b = rng.normal(size=(4, d)), rng.normal(size=d)
    df = spark.createDataFrame([(x.tolist(), 1.0) for x in X], "x ARRAY<DOUBLE>, y DOUBLE")
    R.ridge_objective(df, b, 0.1).explain()
    t0 = time.time()
    plan = R.ridge_objective(df, b + 1e-3, 0.1)
    plan._jdf.queryExecution().executedPlan()
    assert time.time() - t0 < 1
    want = np.mean((1.0 - X @ (b + 1e-3)) ** 2) + 0.1 * (b + 1e-3) @ (b + 1e-3)
    assert abs(plan.first()["objective"] - want) < 1e-6
    g = {r.idx: r.grad for r in R.ridge_gradient(df, b, 0.1).collect()}
    assert np.allclose([g[i] for i in range(d)], -2 / 4 * X.T @ (1.0 - X @ b) + 0.2 * b, atol=1e-9)
