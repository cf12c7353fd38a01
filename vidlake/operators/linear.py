"""Linear and logistic models from sums (ML-5, ML-6, ML-9), and conformal intervals (ML-12).

A least-squares model needs the rows only through the sums of products of its columns.  One scan with partial
aggregation gives those sums per fold (a matrix of the number of features squared; all that reaches the driver);
every fold's training sums are the total less the fold's own, so cross validation over any number of penalties is
solved from them without reading a row again.  The logistic model takes one such scan a Newton step.

Models are plain numbers; predictions are column expressions, so scoring needs no Python worker.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidlake.operators.joins import join_checked_broadcast
from vidlake.operators.ranking import row_number_within
from vidlake.session import materialize

FOLDS = 5
STRENGTHS = (0.0, 0.01, 0.1, 1.0)
NEWTON_STEPS, NEWTON_STOP, NEWTON_PENALTY = 25, 1e-9, 1e-4


class Linear(NamedTuple):
    """intercept + sum of weight * feature."""

    features: tuple[str, ...]
    intercept: float
    weights: tuple[float, ...]

    def score(self) -> Column:
        return sum((F.lit(float(w)) * F.col(c) for c, w in zip(self.features, self.weights)), F.lit(float(self.intercept)))


def fold_number(key: str = "video_id", folds: int = FOLDS, seed: int = 42) -> Column:
    """The row's fold, from bits of the key's digest that the train/validation/test split does not use."""
    digest = F.md5(F.concat_ws(":", F.col(key), F.lit(str(seed))).cast("binary"))
    return F.conv(F.substring(digest, 9, 8), 16, 10).cast("long") % folds


def product_sums(df: DataFrame, columns: Sequence[str], by: Column | None = None, weight: Column | None = None) -> dict:
    """{group: symmetric matrix of sum(weight * a * b)} over ``columns``, in one scan.  Rows with a null are left out."""
    xs = [F.col(c).cast("double") for c in columns]
    w = F.lit(1.0) if weight is None else weight
    sums = [F.sum(w * a * b).alias(f"s{i}_{j}") for i, a in enumerate(xs) for j, b in enumerate(xs[i:], i)]
    known = df.dropna(subset=list(columns))
    out = {}
    for r in (known.groupBy(by.alias("g")).agg(*sums) if by is not None else known.agg(*sums, F.lit(0).alias("g"))).collect():
        m = np.zeros((len(xs), len(xs)))
        for i in range(len(xs)):
            for j in range(i, len(xs)):
                m[i, j] = m[j, i] = r[f"s{i}_{j}"] or 0.0
        out[r["g"]] = m
    return out


def ridge(sums: np.ndarray, features: Sequence[str], strength: float = 0.0) -> Linear:
    """Least squares with a penalty on standardised weights, from the sums over (1, features, label).  A constant
    feature has weight 0."""
    n = sums[0, 0]
    mean = sums[0] / n if n else sums[0]
    cov = sums / n - np.outer(mean, mean) if n else sums
    sd = np.sqrt(np.maximum(np.diag(cov), 0.0))
    # what is left of a constant column after the subtraction is rounding
    use = [i for i in range(1, len(features) + 1) if sd[i] > 1e-7 * max(1.0, abs(mean[i]))]
    weights = np.zeros(len(features))
    if use:
        a = cov[np.ix_(use, use)] / np.outer(sd[use], sd[use]) + strength * np.eye(len(use))
        found = np.linalg.lstsq(a, cov[use, -1] / sd[use], rcond=1e-12)[0]
        weights[[i - 1 for i in use]] = found / sd[use]
    return Linear(tuple(features), float(mean[-1] - weights @ mean[1:-1]), tuple(map(float, weights)))


def r2_of(sums: np.ndarray, model: Linear) -> float | None:
    """Explained share of the label's variance over the rows that ``sums`` were taken of."""
    w = np.array([model.intercept, *model.weights, -1.0])
    total = sums[-1, -1] - sums[0, -1] ** 2 / sums[0, 0] if sums[0, 0] else 0.0
    return float(1 - (w @ sums @ w) / total) if total > 0 else None


def tune_ridge(train: DataFrame, features: Sequence[str], label: str, strengths: Sequence[float] = STRENGTHS,
               folds: int = FOLDS, key: str = "video_id") -> tuple[Linear, float, dict[float, float | None]]:
    """ML-9: (model over all rows, its strength, mean R2 of every strength over the folds).  One scan."""
    per = product_sums(train.withColumn("_one", F.lit(1.0)), ["_one", *features, label], fold_number(key, folds))
    if not per:
        raise ValueError("no rows to train on")
    whole = sum(per.values())
    scores: dict[float, float | None] = {}
    for s in strengths:
        found = [r2_of(m, ridge(whole - m, features, s)) for m in per.values()]
        found = [r for r in found if r is not None]
        scores[s] = sum(found) / len(found) if found else None
    best = max(strengths, key=lambda s: -math.inf if scores[s] is None else scores[s])
    return ridge(whole, features, best), best, scores


def logistic(train: DataFrame, features: Sequence[str], label: str, penalty: float = NEWTON_PENALTY,
             steps: int = NEWTON_STEPS, stop: float = NEWTON_STOP) -> Linear:
    """ML-6: logistic regression of a 0/1 label by Newton's method; ``score()`` is the log odds.  The features are
    standardised by their training moments and their weights (but the intercept) penalised."""
    frame = materialize(train.select(*(F.col(c).cast("double").alias(c) for c in features), F.col(label).cast("double").alias("_y"))
                        .dropna().withColumn("_one", F.lit(1.0)), "logistic")
    sums = product_sums(frame, ["_one", *features])[0]
    n = sums[0, 0]
    if not n:
        raise ValueError("no rows to train on")
    mean = sums[0, 1:] / n
    sd = np.sqrt(np.maximum(np.diag(sums)[1:] / n - mean ** 2, 0.0))
    use = [i for i in range(len(features)) if sd[i] > 1e-7 * max(1.0, abs(mean[i]))]
    names = ["_one"] + [f"_z{i}" for i in use]
    z = frame.select("_y", "_one", *(((F.col(features[i]) - F.lit(float(mean[i]))) / F.lit(float(sd[i]))).alias(f"_z{i}") for i in use))
    beta = np.zeros(len(names))
    hold = penalty * n * np.diag([0.0] + [1.0] * len(use))
    for _ in range(steps):
        p = F.lit(1.0) / (1 + F.exp(-Linear(tuple(names[1:]), beta[0], tuple(beta[1:])).score()))
        sums = [F.sum(p * (1 - p) * F.col(a) * F.col(b)).alias(f"h{i}_{j}")
                for i, a in enumerate(names) for j, b in enumerate(names[i:], i)]
        r = z.agg(*sums, *(F.sum((F.col("_y") - p) * F.col(a)).alias(f"g{i}") for i, a in enumerate(names))).first()
        hess = np.array([[r[f"h{min(i, j)}_{max(i, j)}"] for j in range(len(names))] for i in range(len(names))])
        step = np.linalg.lstsq(hess + hold, np.array([r[f"g{i}"] for i in range(len(names))]) - hold @ beta, rcond=1e-12)[0]
        beta = beta + step
        if np.abs(step).max() < stop:
            break
    weights = np.zeros(len(features))
    weights[use] = beta[1:] / sd[use]
    return Linear(tuple(features), float(beta[0] - weights @ mean), tuple(map(float, weights)))


def binary_metrics(scored: DataFrame, label: str, odds: str = "prediction") -> DataFrame:
    """ML-7 for a 0/1 label and log odds, in one pass: rows, accuracy, precision, recall, f1, log_loss."""
    y, said = F.col(label) == 1, F.col(odds) >= 0
    hit, n = F.count_if(y & said), F.count(F.lit(1))
    loss = F.avg(F.log1p(F.exp(-F.abs(odds))) + F.greatest(F.when(y, -F.col(odds)).otherwise(F.col(odds)), F.lit(0.0)))
    a = scored.agg(n.alias("n"), hit.alias("hit"), F.count_if(said).alias("said"), F.count_if(y).alias("true"),
                   F.count_if(y == said).alias("right"), loss.alias("log_loss"))
    return a.select(F.col("n").alias("rows"), F.try_divide("right", "n").alias("accuracy"), F.try_divide("hit", "said").alias("precision"),
                    F.try_divide("hit", "true").alias("recall"), F.try_divide(2 * F.col("hit"), F.col("said") + F.col("true")).alias("f1"),
                    "log_loss")


def conformal_widths(calibration: DataFrame, group: str, label: str, prediction: str = "prediction",
                     coverage: float = 0.9) -> tuple[DataFrame, float | None]:
    """ML-12: per group the half width of an interval that holds a new row's label with probability ``coverage`` at
    least: the residual of rank ceil((n + 1) * coverage) by size among the group's n calibration rows.  Groups with
    too few rows for that rank are left out and take the second result, the pooled half width (None if all rows
    are too few).  Ranks are taken by range partitioning, so one group may hold most rows."""
    rows = calibration.select(F.col(group).alias("grp"), F.abs(F.col(label) - F.col(prediction)).alias("r")).dropna(subset=["r"])
    rank = F.ceil((F.col("n") + 1) * F.lit(coverage))

    def at_rank(part: DataFrame) -> DataFrame:
        counts = part.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).select(F.col("grp").alias("of"), rank.alias("k"), "n")
        ranked = row_number_within(part, ["grp"], [F.col("r")], "at", kind="long")
        return join_checked_broadcast(ranked, counts.filter("k <= n"), (F.col("grp").eqNullSafe(F.col("of"))) & (F.col("at") == F.col("k")),
                                      "inner").select("grp", F.col("r").alias("width"), "n")

    rows = materialize(rows, "residuals")
    pooled = at_rank(rows.withColumn("grp", F.lit(0))).first()
    return at_rank(rows), (pooled["width"] if pooled else None)


def with_intervals(scored: DataFrame, widths: DataFrame, pooled: float | None, group: str, prediction: str = "prediction") -> DataFrame:
    """``scored`` with ``lo``, ``hi`` around the prediction (null where no interval is known) and ``own_group``, whether the
    row's own group gave it."""
    w = widths.select(F.col("grp").alias("_grp"), F.col("width").alias("_width"))
    out = join_checked_broadcast(scored, w, F.col(group).eqNullSafe(F.col("_grp")))
    half = F.coalesce("_width", F.lit(pooled).cast("double"))
    return out.withColumns({"lo": F.col(prediction) - half, "hi": F.col(prediction) + half,
                            "own_group": F.col("_width").isNotNull()}).drop("_grp", "_width")
