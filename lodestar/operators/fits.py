"""Small gradient fits as aggregates: a one-parameter curve and a three-variable polynomial.

The curve f(x, w) = (x - w)(x - 2w) is polynomial in w, so loss and gradient at any w follow from six
sums over the data (n, sum x, sum x^2, sum a, sum a^2, sum a*x with a = y - x^2). One pass over the
table serves a whole sweep of w values or every step of a descent; the steps then run on six numbers.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------- curve


def curve_residual(x: Column, y: Column, w) -> Column:
    return y - (x - w) * (x - F.lit(2.0) * w)


def curve_loss_grad(df: DataFrame, w: float, x: str = "x", y: str = "y") -> DataFrame:
    """(w, loss, grad) at one w: loss = log sum r^2, grad = -2 sum r (4w - 3x) / sum r^2, r = y - f(x, w)."""
    r = curve_residual(F.col(x), F.col(y), F.lit(w))
    s = df.agg(F.sum(r * r).alias("_ss"), F.sum(r * (F.lit(4.0 * w) - F.lit(3.0) * F.col(x))).alias("_sg"))
    return s.select(F.lit(w).alias("w"), F.log("_ss").alias("loss"), (F.lit(-2.0) * F.col("_sg") / F.col("_ss")).alias("grad"))


def curve_moments(df: DataFrame, x: str = "x", y: str = "y", group: str | None = None) -> DataFrame:
    a = F.col(y) - F.col(x) * F.col(x)
    aggs = [
        F.count(F.lit(1)).cast("double").alias("n"),
        F.sum(F.col(x)).alias("sx"),
        F.sum(F.col(x) * F.col(x)).alias("sxx"),
        F.sum(a).alias("sa"),
        F.sum(a * a).alias("saa"),
        F.sum(a * F.col(x)).alias("sax"),
    ]
    return (df.groupBy(group) if group else df).agg(*aggs)


def _moment_loss_grad(m: dict, w: float) -> tuple[float, float]:
    n, sx, sxx, sa, saa, sax = (m[k] for k in ("n", "sx", "sxx", "sa", "saa", "sax"))
    ss = saa + 9 * w * w * sxx + 4 * w**4 * n + 6 * w * sax - 4 * w * w * sa - 12 * w**3 * sx
    sg = 4 * w * sa - 3 * sax + 18 * w * w * sx - 9 * w * sxx - 8 * w**3 * n
    return math.log(ss), -2.0 * sg / ss


def curve_sweep(df: DataFrame, start: float, stop: float, num: int = 100, x: str = "x", y: str = "y") -> DataFrame:
    """Loss and gradient at ``num`` evenly spaced w in [start, stop] (the last point is exactly ``stop``).

    One aggregate gives the six sums; the w grid is exploded on that single row (no join with the data).
    """
    m = curve_moments(df, x, y)
    step = (stop - start) / (num - 1)
    i = F.explode(F.sequence(F.lit(0), F.lit(num - 1))).alias("_i")
    g = m.select("*", i)
    w = F.when(F.col("_i") == num - 1, F.lit(float(stop))).otherwise(F.col("_i") * F.lit(step) + F.lit(float(start)))
    g = g.withColumn("w", w)
    ww = F.col("w")
    ss = (
        F.col("saa") + F.lit(9.0) * ww * ww * F.col("sxx") + F.lit(4.0) * F.pow(ww, 4) * F.col("n")
        + F.lit(6.0) * ww * F.col("sax") - F.lit(4.0) * ww * ww * F.col("sa") - F.lit(12.0) * F.pow(ww, 3) * F.col("sx")
    )
    sg = (
        F.lit(4.0) * ww * F.col("sa") - F.lit(3.0) * F.col("sax") + F.lit(18.0) * ww * ww * F.col("sx")
        - F.lit(9.0) * ww * F.col("sxx") - F.lit(8.0) * F.pow(ww, 3) * F.col("n")
    )
    return g.select(F.col("_i").alias("i"), "w", F.log(ss).alias("loss"), (F.lit(-2.0) * sg / ss).alias("grad"))


def fit_curve(df: DataFrame, w0: float = 0.0, lr: float = 0.005, epochs: int = 300, x: str = "x", y: str = "y"):
    """Gradient descent on w: one pass over the data for the sums, then ``epochs`` steps on six numbers.
    Returns (w, history [(epoch, w, grad, loss)])."""
    m = curve_moments(df, x, y).first().asDict()
    w, hist = w0, []
    for e in range(epochs):
        loss, g = _moment_loss_grad(m, w)
        w = w - lr * g
        hist.append((e, w, g, _moment_loss_grad(m, w)[0]))
    return w, hist


def fit_curve_batched(df: DataFrame, batch: str, w0: float = 0.0, lr: float = 0.01, epochs: int = 50, x: str = "x", y: str = "y"):
    """Mini-batch descent over the batches of column ``batch`` in order: one grouped pass gives the six
    sums per batch (one row per batch, bounded by the batch count), then the steps run on those."""
    rows = sorted((r.asDict() for r in curve_moments(df, x, y, group=batch).collect()), key=lambda r: r[batch])
    w = w0
    for _ in range(epochs):
        for m in rows:
            w = w - lr * _moment_loss_grad(m, w)[1]
    return w


# ---------------------------------------------------------------- polynomial


def monomial_exponents(nx: int, ny: int, nz: int) -> list[tuple[int, int, int]]:
    """All (i, j, k) with i <= nx, j <= ny, k <= nz: (nx+1)(ny+1)(nz+1) coefficients."""
    return list(itertools.product(range(nx + 1), range(ny + 1), range(nz + 1)))


def _pow(c: Column, e: int) -> Column:
    out = F.lit(1.0)
    for _ in range(e):
        out = out * c
    return out


def monomial(x: Column, y: Column, z: Column, i: int, j: int, k: int) -> Column:
    return _pow(x, i) * _pow(y, j) * _pow(z, k)


def poly_value(x: Column, y: Column, z: Column, coefs: dict[tuple[int, int, int], float]) -> Column:
    """sum c_ijk x^i y^j z^k as one expression (codegen'd), terms in the order of ``coefs``."""
    out = None
    for (i, j, k), c in coefs.items():
        t = F.lit(float(c)) * monomial(x, y, z, i, j, k)
        out = t if out is None else out + t
    return out


def poly_loss_grad(df: DataFrame, coefs: dict[tuple[int, int, int], float], x="x", y="y", z="z", t="t") -> DataFrame:
    """loss = log sum (P - t)^2 and d loss / d c_ijk = 2 sum (P - t) m_ijk / sum (P - t)^2, all from one
    aggregate of 1 + len(coefs) sums. Output (i, j, k, loss, grad)."""
    X, Y, Z = F.col(x), F.col(y), F.col(z)
    d = poly_value(X, Y, Z, coefs) - F.col(t)
    keys = list(coefs)
    aggs = [F.sum(d * d).alias("_ss")] + [F.sum(d * monomial(X, Y, Z, *e)).alias(f"_g{n}") for n, e in enumerate(keys)]
    s = df.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(e[0]).alias("i"), F.lit(e[1]).alias("j"), F.lit(e[2]).alias("k"), F.col(f"_g{n}").alias("g"))
        for n, e in enumerate(keys)
    ])
    out = s.select("_ss", F.explode(rows).alias("_r"))
    return out.select(
        "_r.i", "_r.j", "_r.k", F.log("_ss").alias("loss"), (F.lit(2.0) * F.col("_r.g") / F.col("_ss")).alias("grad")
    )


def fit_poly(df: DataFrame, coefs: dict, lr: float, steps: int, **cols) -> dict:
    """Full-batch descent on the coefficients: one aggregate per step (each step needs the new residuals)."""
    c = dict(coefs)
    for _ in range(steps):
        g = {(r["i"], r["j"], r["k"]): r["grad"] for r in poly_loss_grad(df, c, **cols).collect()}
        c = {e: v - lr * g[e] for e, v in c.items()}
    return c


def poly_least_squares(df: DataFrame, exps: Sequence[tuple[int, int, int]], x="x", y="y", z="z", t="t"):
    """Exact least-squares coefficients via Spark ML LinearRegression on the monomial columns."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    X, Y, Z = F.col(x), F.col(y), F.col(z)
    feats = [monomial(X, Y, Z, i, j, k).alias(f"m{i}{j}{k}") for (i, j, k) in exps if (i, j, k) != (0, 0, 0)]
    d = df.select(F.col(t).alias("label"), *feats)
    va = VectorAssembler(inputCols=[c for c in d.columns if c != "label"], outputCol="features")
    model = LinearRegression(fitIntercept=True, regParam=0.0, solver="normal").fit(va.transform(d))
    return model
