"""Quantile fits per hotel and forecast distance. A model is a row of a parameter table, not a file.

Model rows (operators.features) hold `y`, the targets in path order, `base`, the known pace, and `x`. A group
(hotel, distance) has one row per stay date, so its size is bounded by the calendar, not by bookings.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacecast.config import check_quantiles
from pacecast.operators.pace import work_tasks
from pacecast.schema import LINEAR_PARAMS

GROUP = ("HotelID", "day_ahead")
#: Widths of the smoothed band, in spreads of the target, and steps at each; REST is the largest move that counts as rest.
BANDS, STEPS, REST = (0.3, 0.05, 0.01, 0.002), 500, 1e-6


def _path_lead(pos: Column, far_step: int | None) -> Column:
    """Lead of path point `pos`: d-1, d-2, ..., 0 near; the single lead d - step far."""
    d = F.col("day_ahead")
    return (d - 1 - pos if far_step is None else d - far_step).cast("int")


def pickup_fit(
    rows: DataFrame, quantiles=(0.1, 0.5, 0.9), far_step: int | None = None, tasks: int | None = None
) -> DataFrame:
    """Quantiles of what was still booked between the origin and each target lead.

    Own definition: the pickup `y - base` is taken as independent of the base. Percentiles are exact. Paths
    travel as arrays to their (hotel, distance) and are exploded there: one shuffle of few rows, and the
    percentiles group inside the same tasks. (The outer explode keeps Spark from adding a non-empty check,
    which would work the arrays out twice.)
    """
    check_quantiles(quantiles)
    placed = rows.select(*GROUP, "base", "y").repartition(tasks or work_tasks(rows.sparkSession), *GROUP)
    long = placed.select(*GROUP, "base", F.posexplode_outer("y").alias("pos", "target"))
    long = long.withColumn("pickup", F.col("target") - F.col("base")).where(F.col("pickup").isNotNull())
    return (
        long.withColumn("target_lead", _path_lead(F.col("pos"), far_step))
        .groupBy(*GROUP, "target_lead")
        .agg(F.percentile("pickup", F.array(*map(F.lit, quantiles))).alias("offsets"))
    )


class SharedDesign:
    """Quantile lines of many targets and quantiles over one design, which is decomposed once.

    The pinball loss is smoothed over a band of width h (in spreads of the target) and its curvature bounded by that of
    the band's middle. The bound is the same quadratic for every target and quantile, so one Gram matrix serves all: with
    its Cholesky factor L the columns Q = Z L^-T are orthonormal and a majorise-minimise step is one product with Q'. All
    targets and quantiles take their steps together, with momentum, and the band shrinks in stages, each starting from the one before.

    Target j may use the first `width[j]` columns only. The factor of a leading block of the Gram matrix is the leading
    block of L, so path models, where each point sees one column more, need no factor of their own: the columns of Q
    beyond a target's width are left out of its steps.
    """

    def __init__(self, X: np.ndarray, ridge: float):
        self.mean, self.scale = X.mean(axis=0), X.std(axis=0)
        self.scale = np.where(self.scale > 1e-9 * np.maximum(np.abs(self.mean), 1.0), self.scale, np.inf)  # constant: no slope
        self.Z = np.hstack([np.ones((len(X), 1)), (X - self.mean) / self.scale])
        self.ridge, self.n = ridge, len(X)
        self.gram = self.Z.T @ self.Z / self.n

    def solve(self, Y: np.ndarray, quantiles, width: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(intercepts, slopes over X, whether the steps came to rest) of each target (last axis) and quantile."""
        spread = np.where(Y.std(axis=0) > 0, Y.std(axis=0), 1.0)
        q = np.tile(np.asarray(quantiles, float), Y.shape[1])
        at = np.repeat(np.arange(Y.shape[1]), len(quantiles))
        T = ((Y - Y.mean(axis=0)) / spread)[:, at]
        free = np.arange(self.Z.shape[1])[:, None] <= width[at]  # column 0 is the constant
        penalty = np.full(self.Z.shape[1], self.ridge)
        penalty[0] = 0.0
        beta, rested = np.zeros((self.Z.shape[1], len(at))), np.zeros(len(at), bool)
        beta[0] = [np.quantile(T[:, j], x) for j, x in enumerate(q)]
        for h in BANDS:
            bound = self.gram / (2 * h) + np.diag(penalty + 1e-9)
            L = np.linalg.cholesky(bound)
            Q = np.linalg.solve(L, self.Z.T).T
            theta = L.T @ beta
            beta, rested = self._descend(Q, L, theta, T, q, free, penalty, h)
        residual = T - self.Z @ beta
        # The best constant, given the slopes, is the quantile of what the slopes leave.
        beta[0] += [np.quantile(residual[:, j], x) for j, x in enumerate(q)]
        slopes = beta[1:] / self.scale[:, None] * spread[at]
        intercepts = beta[0] * spread[at] + Y.mean(axis=0)[at] - self.mean @ slopes
        return intercepts, slopes, rested

    def _descend(self, Q, L, theta, T, q, free, penalty, h):
        """Accelerated steps in the coordinates where the bound is the identity, restarted where momentum runs uphill."""
        ahead, momentum = theta, np.ones(theta.shape[1])
        rested, inverse = np.zeros(theta.shape[1], bool), np.linalg.inv(L)
        active = np.arange(theta.shape[1])
        theta, ahead = theta.copy(), ahead.copy()
        for _ in range(STEPS):
            own = ahead[:, active]
            pull = 0.5 * np.clip((T[:, active] - Q @ own) / h, -1, 1) + (q[active] - 0.5)
            slope = Q.T @ pull / self.n - inverse @ (penalty[:, None] * (inverse.T @ own))
            after = own + np.where(free[:, active], slope, 0.0)
            moved = after - theta[:, active]
            uphill = (slope * moved).sum(axis=0) < 0
            m = np.where(uphill, 1.0, momentum[active])
            grown = (1 + np.sqrt(1 + 4 * m * m)) / 2
            ahead[:, active] = after + (m - 1) / grown * moved
            theta[:, active], momentum[active] = after, grown
            still = np.abs(moved).max(axis=0) <= REST * np.maximum(np.abs(after).max(axis=0), 1e-3)
            rested[active[still]] = True
            active = active[~still]
            if not len(active):
                break
        return inverse.T @ theta, rested


def _fit_group(pdf: pd.DataFrame, quantiles, far_step: int | None, recursive: bool, ridge: float = 1e-4) -> pd.DataFrame:
    hotel, d = str(pdf["HotelID"].iloc[0]), int(pdf["day_ahead"].iloc[0])
    X = np.stack(pdf["x"].to_numpy()).astype(float)
    Y = np.stack(pdf["y"].to_numpy()).astype(float)
    known = ~np.isnan(Y).any(axis=1)
    X, Y = X[known], Y[known]
    if not len(Y):
        return pd.DataFrame([], columns=LINEAR_PARAMS.fieldNames())
    points, p, k = Y.shape[1], X.shape[1], len(quantiles)
    seen = np.hstack([X, Y[:, : points - 1]]) if recursive else X
    width = p + np.arange(points) if recursive else np.full(points, p)
    intercepts, slopes, rested = SharedDesign(seen, ridge).solve(Y, quantiles, width)
    out = []
    for pos in range(points):
        own = slice(pos * k, (pos + 1) * k)
        lead = d - 1 - pos if far_step is None else d - far_step
        coefs, path = slopes[:p, own].T.tolist(), slopes[p : width[pos], own].T.tolist()
        out.append((hotel, d, lead, intercepts[own].tolist(), coefs, path, rested[own].tolist()))
    return pd.DataFrame(out, columns=LINEAR_PARAMS.fieldNames())


def linear_fit(
    rows: DataFrame,
    quantiles=(0.1, 0.5, 0.9),
    far_step: int | None = None,
    recursive: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Linear pinball fit on all features; numpy solves one (hotel, distance) group at a time.

    All targets of a distance share one group, so features travel once, not once per target and quantile.
    With `recursive`, each path point also sees the earlier points of its path. Rows that carry a `part` are
    already placed by hotel and part (plans.training.placed_rows) and are not shuffled again.
    """
    check_quantiles(quantiles)
    quantiles = list(quantiles)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        return _fit_group(pdf, quantiles, far_step, recursive)

    if "part" in rows.columns:
        return rows.select("part", *GROUP, "y", "x").groupBy("part", *GROUP).applyInPandas(fit, LINEAR_PARAMS)
    picked = rows.select(*GROUP, "y", "x").repartition(tasks or work_tasks(rows.sparkSession), *GROUP)
    return picked.groupBy(*GROUP).applyInPandas(fit, LINEAR_PARAMS)
