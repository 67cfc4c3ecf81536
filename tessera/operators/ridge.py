"""Ridge regression by gradient descent with backtracking line search.

F(b) = 1/n sum (y - <x, b>)^2 + lam * ||b||^2,  grad F = -2/n sum (y - <x,b>) x + 2 lam b.

Two execution strategies, same mathematics:

* ``method="gram"`` (default): one aggregation over the data computes n, the
  means and the covariances of x and y (d*(d+1)/2 + d co-moments, which Spark
  merges pairwise around their means, so a large offset of a column cancels
  nothing).  grad F at any b and F's decrease along it are functions of these
  d x d numbers, so every gradient step and every line-search trial costs no
  further pass over the data.  The statistics grow with d, never with n.
* ``method="pass"``: for large d, each iteration runs one distributed gradient
  (posexplode + groupBy(idx), d rows per task after partial aggregation) and
  one line-search pass that evaluates all trial steps at once: F(b - t g) - F(b)
  is a quadratic in t whose two data-dependent sums come from a single agg.

beta enters a plan as one text constant that the optimizer folds into one array,
so a plan's size does not grow with d.  A loss that is no number raises.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.expr import array_dot

A_LS, B_LS = 0.2, 0.6   # backtracking parameters (sufficient decrease, shrink)


def _lit_array(beta) -> F.Column:
    """All of beta as one constant: the shortest decimal text of a double reads back as that double."""
    if not len(beta):
        return F.array().cast("array<double>")
    return F.split(F.lit(",".join(repr(float(b)) for b in beta)), ",").cast("array<double>")


def dimension(data: DataFrame, x: str = "x") -> int:
    """Number of features (length of the first feature array)."""
    row = data.select(F.size(x).alias("d")).first()
    return int(row["d"]) if row else 0


# ---------------------------------------------------------------- R2 R3 R6
def ridge_objective(data: DataFrame, beta, lam: float = 0.0, x: str = "x",
                    y: str = "y") -> DataFrame:
    """R2: one-row DataFrame with F(beta)."""
    b = _lit_array(beta)
    reg = lam * sum(float(v) ** 2 for v in beta)
    return data.agg((F.avg(F.pow(F.col(y) - array_dot(F.col(x), b), 2)) + F.lit(reg))
                    .alias("objective"))


def ridge_gradient(data: DataFrame, beta, lam: float = 0.0, x: str = "x",
                   y: str = "y") -> DataFrame:
    """(idx, grad) rows of grad F(beta), computed in one distributed pass."""
    b = _lit_array(beta)
    e = data.select((F.col(y) - array_dot(F.col(x), b)).alias("e"),
                    F.posexplode(x).alias("idx", "xi"))
    # every row has all d positions, so the per-idx count is n
    part = e.groupBy("idx").agg(F.sum(F.lit(-2.0) * F.col("e") * F.col("xi")).alias("s"),
                                F.count(F.lit(1)).alias("n"))
    reg = _lit_array([2.0 * lam * float(v) for v in beta])
    return part.select("idx", (F.col("s") / F.col("n") + reg[F.col("idx")]).alias("grad"))


def ridge_predict(data: DataFrame, beta, x: str = "x") -> DataFrame:
    """Data with yhat = <x, beta>."""
    return data.withColumn("yhat", array_dot(F.col(x), _lit_array(beta)))


def ridge_mse(data: DataFrame, beta, x: str = "x", y: str = "y") -> DataFrame:
    """One-row mean squared error (F with lam = 0)."""
    return ridge_objective(data, beta, 0.0, x, y).withColumnRenamed("objective", "mse")


# ---------------------------------------------------------------- R7
def gradient_check(data: DataFrame, beta, lam: float = 0.0, delta: float = 1e-6,
                   x: str = "x", y: str = "y") -> DataFrame:
    """Forward-difference gradient (F(b + delta e_i) - F(b)) / delta.

    All d + 1 objective values come from one aggregation by position: with
    e = y - <x, b>, the residual under b + delta e_i is e - delta x_i.
    Returns (idx, numeric, analytic).
    """
    e = data.select((F.col(y) - array_dot(F.col(x), _lit_array(beta))).alias("e"),
                    F.posexplode(x).alias("idx", "xi"))
    base = sum(float(v) ** 2 for v in beta)
    moved = _lit_array([lam * (base - float(v) ** 2 + (float(v) + delta) ** 2) for v in beta])
    num = e.groupBy("idx").agg(F.avg(F.pow(F.col("e") - F.lit(delta) * F.col("xi"), 2)).alias("f1"),
                               F.avg(F.pow("e", F.lit(2))).alias("f0"))
    num = num.select("idx", ((F.col("f1") + moved[F.col("idx")] - F.col("f0") - F.lit(lam * base))
                             / F.lit(delta)).alias("numeric"))
    ana = ridge_gradient(data, beta, lam, x, y).withColumnRenamed("grad", "analytic")
    return num.join(ana, "idx")


# ---------------------------------------------------------------- statistics
def gram_statistics(data: DataFrame, d: int, x: str = "x", y: str = "y") -> dict:
    """n, the means of x (d) and y, and the covariances (divided by n) of x with
    y (d) and with itself (d x d), from one aggregation."""
    xs, target = [F.col(x)[i].cast("double") for i in range(d)], F.col(y).cast("double")
    cols = [F.count(F.lit(1)).alias("n"), F.avg(target).alias("my")]
    cols += [F.avg(xs[i]).alias(f"m{i}") for i in range(d)]
    cols += [F.covar_pop(xs[i], target).alias(f"xy{i}") for i in range(d)]
    cols += [F.covar_pop(xs[i], xs[j]).alias(f"xx{i}_{j}") for i in range(d) for j in range(i, d)]
    r = data.agg(*cols).first()
    cov = [[float(r[f"xx{min(i, j)}_{max(i, j)}"] or 0.0) for j in range(d)] for i in range(d)]
    return {"n": int(r["n"]), "mean_y": float(r["my"] or 0.0), "mean_x": [float(r[f"m{i}"] or 0.0) for i in range(d)],
            "cov_xy": [float(r[f"xy{i}"] or 0.0) for i in range(d)], "cov_xx": cov}


def _matvec(m, v):
    return [sum(a * b for a, b in zip(row, v)) for row in m]


def _dot(a, b):
    return sum(p * q for p, q in zip(a, b))


def _gradient_from_stats(st, beta, lam):
    cb, left = _matvec(st["cov_xx"], beta), st["mean_y"] - _dot(st["mean_x"], beta)
    return [2.0 * (cb[i] - st["cov_xy"][i]) - 2.0 * st["mean_x"][i] * left + 2.0 * lam * beta[i]
            for i in range(len(beta))]


def _backtrack(change, slope: float, a=A_LS, b=B_LS) -> float:
    """The first t of 1, b, b^2, ... with change(t) = F(beta - t g) - F(beta) <=
    -a t slope; a change that is no number raises."""
    t = 1.0
    while not (c := change(t)) <= -a * t * slope:
        if math.isnan(c):
            raise ValueError("the loss is not a number")
        t *= b
    return t


# ---------------------------------------------------------------- R4
def ridge_line_search(data: DataFrame, beta, grad, lam: float = 0.0, x: str = "x",
                      y: str = "y", a: float = A_LS, b: float = B_LS) -> float:
    """Backtracking step t = b^k for the smallest k with
    F(beta - t g) <= F(beta) - a t ||g||^2, from one pass over the data.

    With e = y - <x, beta> and w = <x, g>, F(beta - t g) - F(beta) =
    t (2 mean(e w) - 2 lam <beta, g>) + t^2 (mean(w w) + lam <g, g>), so one
    aggregation of two means prices every t, without a difference of large sums.
    """
    bb, gg = _lit_array(beta), _lit_array(grad)
    e = F.col(y) - array_dot(F.col(x), bb)
    w = array_dot(F.col(x), gg)
    r = data.agg(F.avg(e * w).alias("ew"), F.avg(w * w).alias("ww")).first()
    if r["ww"] is None:
        raise ValueError("no rows to search a step on")
    linear = 2.0 * (r["ew"] - lam * _dot(beta, grad))
    square = r["ww"] + lam * _dot(grad, grad)
    return _backtrack(lambda t: t * linear + t * t * square, _dot(grad, grad), a, b)


# ---------------------------------------------------------------- R5
def ridge_train(data: DataFrame, lam: float = 0.0, max_iter: int = 100, eps: float = 0.01,
                beta0=None, method: str = "gram", x: str = "x", y: str = "y"):
    """Gradient descent from beta0 (zeros) with backtracking line search.

    Stops after ``max_iter`` steps or when ||grad F||_2 <= eps.  Returns
    ``(beta, grad_norm, iterations)``; beta0 is not modified.  The caller
    picks the method: ``"gram"`` reads the data once and suits d up to some
    dozens (d(d+1)/2 sums); ``"pass"`` reads it twice per step.
    """
    d = len(beta0) if beta0 is not None else dimension(data, x)
    beta = [float(v) for v in (beta0 if beta0 is not None else [0.0] * d)]
    if method == "gram":
        st = gram_statistics(data, d, x, y)
        if st["n"] == 0:
            return beta, 0.0, 0
        fgrad = lambda bt: _gradient_from_stats(st, bt, lam)
    elif method == "pass":
        data = data.select(x, y).persist()

        def fgrad(bt):
            rows = ridge_gradient(data, bt, lam, x, y).collect()
            g = [0.0] * d
            for r in rows:
                g[r["idx"]] = r["grad"]
            return g
    else:
        raise ValueError("method must be 'gram' or 'pass'")

    def step(bt, gr):
        if method == "pass":
            return ridge_line_search(data, bt, gr, lam, x, y)
        along, slope = _dot(st["mean_x"], gr), _dot(gr, gr)
        curve = _dot(gr, _matvec(st["cov_xx"], gr)) + along * along + lam * slope
        return _backtrack(lambda t: t * t * curve - t * slope, slope)

    try:
        for k in range(max_iter + 1):
            g = fgrad(beta)
            gnorm = math.sqrt(_dot(g, g))
            if not math.isfinite(gnorm):
                raise ValueError("the gradient is not finite")
            if k == max_iter or gnorm <= eps:
                return beta, gnorm, k
            t = step(beta, g)
            beta = [p - t * q for p, q in zip(beta, g)]
    finally:
        if method == "pass":
            data.unpersist()


def ridge_train_df(data: DataFrame, lam: float = 0.0, max_iter: int = 100, eps: float = 0.01,
                   method: str = "gram", x: str = "x", y: str = "y") -> DataFrame:
    """R5 as a DataFrame: (idx, beta, grad_norm, iterations)."""
    beta, gnorm, k = ridge_train(data, lam, max_iter, eps, method=method, x=x, y=y)
    return data.sparkSession.createDataFrame(
        [(i, float(v), float(gnorm), int(k)) for i, v in enumerate(beta)],
        "idx INT, beta DOUBLE, grad_norm DOUBLE, iterations INT")
