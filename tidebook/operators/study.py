"""Linear forecasts over expanding days, from sums of products: no series is gathered in one place.

Each day gives one row of moments; running sums of those are the training sets of all folds, each fit is a small
matrix, and forecasts are made where the rows are.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["venue", "symbol"]
#: A column that those before it explain to this share is left out.
REDUNDANT = 0.999


def fit(n: float, s: np.ndarray, ss: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    """Columns kept, then mean, deviation and coefficients (intercept first) of the fit of column ``k`` on the ``k`` before.

    ``s`` and ``ss`` are sums and sums of products.  Columns come in order; one that is constant, or that those kept
    explain, is left out, so that no two describe the same thing.
    """
    mean = s / n
    cov = ss / n - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(cov), 0))
    kept: list[int] = []
    for j in range(k):
        if sd[j] <= 1e-12 or high[j] - low[j] <= 1e-12:
            continue
        if kept:
            r = cov[np.ix_(kept, kept)] / np.outer(sd[kept], sd[kept])
            c = cov[kept, j] / (sd[kept] * sd[j])
            if c @ np.linalg.lstsq(r, c, rcond=None)[0] > REDUNDANT:
                continue
        kept.append(j)
    r = cov[np.ix_(kept, kept)] / np.outer(sd[kept], sd[kept])
    beta = np.linalg.lstsq(r, cov[kept, k] / sd[kept], rcond=None)[0] if kept else np.zeros(0)
    return kept, mean, sd, np.concatenate(([mean[k]], beta))


def folds(rows: DataFrame, features: list[str], target: str, purge: int, least: int) -> DataFrame:
    """``rows``: keys, ``day``, ``t``, features and target, all finite.  A fold for each day but the first trains on all
    days before, without the last ``purge`` rows of each, whose targets reach past it; folds with fewer than ``least``
    rows on either side are absent.  Per fold: rows, R2 against zero, the trailing-mean R2 of the training target, share
    of feature values held to the training range, the mean gain of taking the forecast's sign, both sums of squares, and the columns kept."""
    names = [*features, target]
    k = len(features)
    day = Window.partitionBy(*KEYS, "day").orderBy(F.desc("t"))
    x = rows.select(*KEYS, "day", "t", F.array(*[F.col(c).cast("double") for c in names]).alias("x")).withColumn("late", F.row_number().over(day) <= purge)
    at = lambda i: F.get("x", F.lit(i))
    pairs = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
    early = lambda c: F.when(~F.col("late"), c)
    moments = x.groupBy(*KEYS, "day").agg(
        F.count_if(~F.col("late")).cast("double").alias("n"), F.array(*[F.coalesce(F.sum(early(at(i))), F.lit(0.0)) for i in range(k + 1)]).alias("s"),
        F.array(*[F.coalesce(F.sum(early(at(i) * at(j))), F.lit(0.0)) for i, j in pairs]).alias("ss"), F.array(*[F.min(early(at(i))) for i in range(k)]).alias("low"), F.array(*[F.max(early(at(i))) for i in range(k)]).alias("high"))
    past = Window.partitionBy(*KEYS).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    each = lambda f, c, n: F.array(*[f(F.get(c, F.lit(i))).over(past) for i in range(n)])
    trained = moments.select(*KEYS, "day", F.sum("n").over(past).alias("n"), each(F.sum, "s", k + 1).alias("s"), each(F.sum, "ss", len(pairs)).alias("ss"), each(F.min, "low", k).alias("low"), each(F.max, "high", k).alias("high")).where(F.col("n") >= least)

    def solve(frames: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                ss = np.zeros((k + 1, k + 1))
                for (i, j), v in zip(pairs, r.ss, strict=True):
                    ss[i, j] = ss[j, i] = v
                low, high = np.array(r.low, float), np.array(r.high, float)
                kept, mean, sd, beta = fit(r.n, np.array(r.s, float), ss, low, high, k)
                weight = np.zeros(k)
                weight[kept] = beta[1:] / sd[kept]
                out.append((r.venue, r.symbol, r.day, int(r.n), float(beta[0]), weight.tolist(), mean[:k].tolist(), low.tolist(), high.tolist(), [features[i] for i in kept]))
            yield pd.DataFrame(out, columns=["venue", "symbol", "day", "n_train", "base", "weight", "mean", "low", "high", "kept"])

    kind = dict(rows.dtypes)["day"]
    fits = trained.mapInPandas(solve, f"venue string, symbol string, day {kind}, n_train long, base double, weight array<double>, mean array<double>, low array<double>, high array<double>, kept array<string>")
    used = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.struct(F.get("x", i).alias("x"), F.get("weight", i).alias("w"), F.get("mean", i).alias("m"), F.get("low", i).alias("a"), F.get("high", i).alias("b")))
    own = x.join(fits, [*KEYS, "day"]).withColumn("u", F.filter(used, lambda u: u["w"] != 0))
    held = lambda u: F.greatest(u["a"], F.least(u["b"], u["x"]))
    forecast = F.col("base") + F.aggregate("u", F.lit(0.0), lambda acc, u: acc + u["w"] * (held(u) - u["m"]))
    own = own.withColumn("forecast", forecast).withColumn("clipped", F.size(F.filter("u", lambda u: held(u) != u["x"]))).withColumn("y", at(k))
    y, p = F.col("y"), F.col("forecast")
    done = own.groupBy(*KEYS, "day").agg(
        F.first("n_train").alias("n_train"), F.count("*").alias("n_test"), (1 - F.try_divide(F.sum((y - p) * (y - p)), F.sum(y * y))).alias("r2_zero"),
        (1 - F.try_divide(F.sum((y - F.col("base")) * (y - F.col("base"))), F.sum(y * y))).alias("r2_mean"), F.coalesce(F.try_divide(F.sum("clipped"), F.sum(F.size("u"))), F.lit(0.0)).alias("clipped"),
        F.avg(F.signum(p) * y).alias("edge"), F.sum((y - p) * (y - p)).alias("sse"), F.sum(y * y).alias("syy"), F.first("kept").alias("kept"))
    return done.where(F.col("n_test") >= least)


def fold_summary(done: DataFrame) -> DataFrame:
    """Per series: folds, how many beat zero, and the range of their R2."""
    return done.groupBy(*KEYS).agg(F.count("*").alias("folds"), F.count_if(F.col("r2_zero") > 0).alias("positive"), F.min("r2_zero").alias("low"), F.max("r2_zero").alias("high"), F.sum("n_test").alias("rows"))


def crossed_interval(values: DataFrame, value: str, rows: str, columns: str, draws: int, seed: int) -> DataFrame:
    """Interval of the mean of ``value`` when both ``rows`` and ``columns`` labels are drawn anew, from sums per pair.

    One task holds the sums of the pairs of labels, days by venues, and not the values."""
    cells = values.where(F.col(value).isNotNull()).groupBy(rows, columns).agg(F.sum(value).alias("s"), F.count("*").alias("n")).select(F.col(rows).cast("string").alias("r"), F.col(columns).cast("string").alias("c"), "s", "n")

    def run(f: pd.DataFrame) -> pd.DataFrame:
        s = f.pivot_table(index="r", columns="c", values="s", aggfunc="sum", fill_value=0.0).sort_index().to_numpy(float)
        n = f.pivot_table(index="r", columns="c", values="n", aggfunc="sum", fill_value=0).sort_index().to_numpy(float)
        rng = np.random.default_rng(seed)
        means = []
        for _ in range(draws):
            i, j = rng.integers(0, s.shape[0], s.shape[0]), rng.integers(0, s.shape[1], s.shape[1])
            total = n[np.ix_(i, j)].sum()
            if total:
                means.append(s[np.ix_(i, j)].sum() / total)
        low, high = np.quantile(means, [0.025, 0.975]) if means else (None, None)
        return pd.DataFrame([(s.sum() / n.sum(), low, high)], columns=["mean", "low", "high"])

    return cells.withColumn("whole", F.lit(0)).groupBy("whole").applyInPandas(run, "mean double, low double, high double")
