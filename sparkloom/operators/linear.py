"""Linear regression: closed form (M1) and batch gradient descent (M2-M4).

The squared-error gradient and cost depend on the data only through the moments
``n, sum(x~), sum(x~ x~^T), sum(x~ y), sum(y^2)`` of the augmented features x~ = (1, x).
So a fit is *one* Spark aggregation (partial sums per partition, a (d+1)^2 result) and
the iterations run on the driver over O(d^2) numbers: 100 iterations cost one pass over
the data instead of 200 (the surveyed jobs run two jobs per iteration).

Arithmetic inside an iteration is written as explicit left-to-right sums so that the
DuckDB oracle, which evaluates the same expressions, reproduces it operation for
operation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def closed_form(df: DataFrame, x: str, y: str, digits: int = 6) -> DataFrame:
    """M1 + A7 + P12: ``(n, slope, intercept)`` of y = slope * x + intercept (least squares)."""
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.regr_slope(F.col(y), F.col(x)), digits).alias("slope"),
        F.round(F.regr_intercept(F.col(y), F.col(x)), digits).alias("intercept"),
    )


@dataclass
class Moments:
    """Moments of augmented features: ``g[i][j] = sum(x~_i x~_j)``, ``c[i] = sum(x~_i y)``."""

    n: float
    g: list[list[float]]
    c: list[float]
    syy: float


def moments(df: DataFrame, features: list[Column | str], target: Column | str) -> Moments:
    """One aggregation pass; returns (d+1)^2 + (d+1) + 2 numbers to the driver."""
    xs = [F.lit(1.0)] + [F.col(f) if isinstance(f, str) else f for f in features]
    y = F.col(target) if isinstance(target, str) else target
    d1 = len(xs)
    aggs = [F.count(F.lit(1)).cast("double").alias("n")]
    for i in range(d1):
        for j in range(i, d1):
            aggs.append(F.sum((xs[i] * xs[j]).cast("double")).alias(f"g{i}_{j}"))
    for i in range(d1):
        aggs.append(F.sum((xs[i] * y).cast("double")).alias(f"c{i}"))
    aggs.append(F.sum((y * y).cast("double")).alias("syy"))
    row = df.agg(*aggs).first()
    g = [[0.0] * d1 for _ in range(d1)]
    for i in range(d1):
        for j in range(i, d1):
            g[i][j] = g[j][i] = float(row[f"g{i}_{j}"] or 0.0)
    return Moments(float(row["n"]), g, [float(row[f"c{i}"] or 0.0) for i in range(d1)], float(row["syy"] or 0.0))


def _dot(a: list[float], b: list[float]) -> float:
    acc = a[0] * b[0]
    for i in range(1, len(a)):
        acc = acc + a[i] * b[i]
    return acc


def sse(m: Moments, theta: list[float]) -> float:
    """Sum of squared residuals at ``theta`` = syy - 2 theta.c + theta^T G theta."""
    gt = [_dot(m.g[i], theta) for i in range(len(theta))]
    return m.syy - 2.0 * _dot(theta, m.c) + _dot(theta, gt)


def residual_products(m: Moments, theta: list[float]) -> list[float]:
    """``sum(r * x~_i)`` for residual r = y - theta.x~."""
    return [m.c[i] - _dot(m.g[i], theta) for i in range(len(theta))]


def bold_driver(cost: float, old_cost: float, lr: float, up: float = 1.05, down: float = 0.5) -> tuple[float, float]:
    """M4: grow the step after a decrease, halve it after an increase (old cost starts at 0)."""
    if cost < old_cost:
        return lr * up, cost
    if cost > old_cost:
        return lr * down, cost
    return lr, old_cost


def gradient_descent(
    m: Moments, theta0: list[float], lr: float, iterations: int, grad_scale: float, cost_scale: float,
) -> list[tuple]:
    """Batch GD on moments. Per iteration: cost and gradient at the current parameters,
    step, then the bold-driver step-size rule. Returns ``(iteration, cost, theta..., lr)``."""
    theta = list(theta0)
    old = 0.0
    trace = []
    for it in range(1, iterations + 1):
        cost = sse(m, theta) * cost_scale
        rp = residual_products(m, theta)
        grad = [grad_scale * rp[i] for i in range(len(theta))]
        theta = [theta[i] - lr * grad[i] for i in range(len(theta))]
        lr, old = bold_driver(cost, old, lr)
        trace.append((it, cost, *theta, lr))
    return trace


def fit_simple_gd(df: DataFrame, x: str, y: str, m0: float = 0.1, b0: float = 0.1, lr: float = 1e-4,
                  iterations: int = 100) -> list[tuple]:
    """M2: y = m x + b; gradient -2/n sum(...), cost SSE / n. Trace ``(it, cost, b, m, lr)``."""
    mom = moments(df, [x], y)
    return gradient_descent(mom, [b0, m0], lr, iterations, -2.0 / mom.n, 1.0 / mom.n)


def standardised(df: DataFrame, features: list[str]) -> tuple[DataFrame, list[str]]:
    """Features rescaled to zero mean and unit (population) deviation: one extra pass."""
    stats = df.agg(*[F.avg(f).alias(f"mu_{f}") for f in features],
                   *[F.stddev_pop(f).alias(f"sd_{f}") for f in features]).first()
    cols = []
    for f in features:
        mu, sd = float(stats[f"mu_{f}"]), float(stats[f"sd_{f}"] or 0.0)
        scale = sd if sd > 0 else 1.0
        df = df.withColumn(f"z_{f}", (F.col(f) - F.lit(mu)) / F.lit(scale))
        cols.append(f"z_{f}")
    return df, cols


def fit_multi_gd(df: DataFrame, features: list[str], y: str, w0: float = 0.1, lr: float = 1e-3,
                 iterations: int = 100, standardize: bool = True) -> list[tuple]:
    """M3: y = b + w.x; gradient -1/n sum(...), cost SSE / (2n). Trace ``(it, cost, b, w..., lr)``.

    ``standardize`` rescales the features first: at the raw scale (trip seconds in the
    thousands) lr = 1e-3 diverges for many iterations before the bold driver recovers.
    """
    if standardize:
        df, features = standardised(df, features)
    mom = moments(df, features, y)
    return gradient_descent(mom, [w0] * (len(features) + 1), lr, iterations, -1.0 / mom.n, 0.5 / mom.n)


def trace_frame(spark: SparkSession, trace: list[tuple], names: list[str], digits: int = 6) -> DataFrame:
    """The iteration trace as a DataFrame; parameters and cost rounded to ``digits``."""
    fields = [T.StructField("iteration", T.LongType())] + [T.StructField(n, T.DoubleType()) for n in names] + [
        T.StructField("learning_rate", T.DoubleType())
    ]
    df = spark.createDataFrame([tuple([r[0]] + [float(v) for v in r[1:]]) for r in trace], T.StructType(fields))
    return df.select("iteration", *[F.round(n, digits).alias(n) for n in names], "learning_rate")
