"""Panels on a fixed grid, targets, baselines and scores."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import imbalance, microprice_bps, midpoint
from .book import side_sum

KEYS = ["venue", "symbol"]
ROW = [*KEYS, "t"]


def panel(ticks: DataFrame, step: int) -> DataFrame:
    """Per grid instant the last tick at or before it, its age, and how many ticks the step before it held.

    Steps without a tick carry the last one on; a series starts at its first tick's step.
    """
    due = ticks.withColumn("t", F.col("recv_wall") + F.pmod(-F.col("recv_wall"), F.lit(step)))
    last = due.groupBy(*KEYS, "t").agg(F.max_by(F.struct("mid", "spread", "recv_wall", "suspect"), "first_ordinal").alias("x"), F.count("*").alias("msgs"), F.count_if("suspect").alias("suspect_msgs"))
    later = F.lead("t").over(Window.partitionBy(*KEYS).orderBy("t"))
    held = last.withColumn("to", F.coalesce(later - step, F.col("t")))
    rows = held.select(*KEYS, "x", "msgs", "suspect_msgs", F.col("t").alias("at"), F.explode(F.sequence("t", "to", F.lit(step))).alias("t"))
    fresh = F.col("t") == F.col("at")
    return rows.select(*ROW, "x.mid", "x.spread", (F.col("t") - F.col("x.recv_wall")).alias("age_ns"), F.when(fresh, F.col("msgs")).otherwise(0).alias("msgs"), F.when(fresh, F.col("suspect_msgs")).otherwise(0).alias("suspect_msgs"))


def series():
    return Window.partitionBy(*KEYS).orderBy("t")


def returns(p: DataFrame, back: int, ahead: int) -> DataFrame:
    """Trailing and forward log returns of the mid in basis points; null where either end is missing."""
    w, mid = series(), F.log(F.col("mid").cast("double"))
    return p.select(*ROW, F.round((mid - F.lag(mid, back).over(w)) * 10_000, 6).alias("trailing_bps"), F.round((F.lead(mid, ahead).over(w) - mid) * 10_000, 6).alias("forward_bps"))


def clean_runs(p: DataFrame, need: int) -> DataFrame:
    """Length of the run of clean rows that ends at each row, and whether the next ``need`` rows are all clean."""
    w = series()
    ok = (F.col("suspect_msgs") == 0) & F.col("mid").isNotNull()
    at = p.withColumn("ok", ok).withColumn("n", F.row_number().over(w))
    bad = F.coalesce(F.max(F.when(~F.col("ok"), F.col("n"))).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    ahead = w.rowsBetween(0, need)
    usable = (F.count_if("ok").over(ahead) == need + 1).alias("usable")
    return at.select(*ROW, (F.col("n") - bad).cast("bigint").alias("clean_run"), usable)


def realized_volatility(p: DataFrame, n: int) -> DataFrame:
    """Root of the summed squared log returns over the last ``n`` returns of an island of clean rows, else null."""
    w = series()
    ok = (F.col("suspect_msgs") == 0) & F.col("mid").isNotNull()
    marked = p.withColumn("ok", ok).withColumn("island", F.count_if(~F.col("ok")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    own = Window.partitionBy(*KEYS, "island").orderBy("t")
    r = marked.where("ok").withColumn("r", F.log(F.col("mid").cast("double")) - F.lag(F.log(F.col("mid").cast("double"))).over(own))
    span = own.rowsBetween(-(n - 1), 0)
    return r.select(*ROW, F.round(F.when(F.count("r").over(span) == n, F.sqrt(F.sum(F.col("r") * F.col("r")).over(span))) * 10_000, 6).alias("vol_bps"))


def rolling_mean(p: DataFrame, n: int) -> DataFrame:
    span = series().rowsBetween(-(n - 1), 0)
    return p.select(*ROW, F.when(F.count("mid").over(span) == n, F.sum("mid").over(span)).alias("mid_sum"))


def labels(p: DataFrame, horizon: int, cuts: tuple[int, int]) -> DataFrame:
    """Forward moves with their split; a label whose horizon leaves its split is dropped.

    Bad rows between and an embargo play no part; ``clean_labels`` has both."""
    return _labelled(p, horizon, cuts, 0).where("label is not null and split = end_split").drop("end_split", "usable")


def clean_labels(p: DataFrame, horizon: int, cuts: tuple[int, int], embargo: int) -> DataFrame:
    """``labels`` of which all rows from the instant to its horizon are clean, and both ends outside the ``embargo``
    nanoseconds after each cut."""
    return _labelled(p, horizon, cuts, embargo).where("usable and label is not null and split = end_split").drop("end_split", "usable")


def _labelled(p: DataFrame, horizon: int, cuts: tuple[int, int], embargo: int) -> DataFrame:
    w = series()
    split = lambda t: F.when(t < cuts[0], "train").when((t >= cuts[0] + embargo) & (t < cuts[1]), "validation").when(t >= cuts[1] + embargo, "test")
    clean = F.count_if((F.col("suspect_msgs") == 0) & F.col("mid").isNotNull()).over(w.rowsBetween(0, horizon)) == horizon + 1
    return p.select(*ROW, split(F.col("t")).alias("split"), (F.lead("mid", horizon).over(w) - F.col("mid")).alias("label"), split(F.lead("t", horizon).over(w)).alias("end_split"), (F.col("mid") - F.lag("mid", horizon).over(w)).alias("previous"), clean.alias("usable"))


def baseline_error(labelled: DataFrame) -> DataFrame:
    """Summed absolute error of the constant-zero and of the previous-move forecast per split."""
    rows = labelled.where("previous is not null")
    return rows.groupBy("split").agg(F.count("*").alias("n"), F.sum(F.abs("label")).alias("zero_error"), F.sum(F.abs(F.col("label") - F.col("previous"))).alias("previous_error"))


def calibration(labelled: DataFrame) -> DataFrame:
    """Out-of-sample R2 against zero, and the line of label on forecast, from exact sums."""
    x, y = F.col("previous").cast("double") / 1e6, F.col("label").cast("double") / 1e6
    s = labelled.where("previous is not null").groupBy("split").agg(F.count("*").alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"), F.sum(x * x).alias("sxx"), F.sum(x * y).alias("sxy"), F.sum(y * y).alias("syy"))
    slope = (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / (F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx"))
    return s.select("split", "n", F.round(1 - (F.col("syy") - 2 * F.col("sxy") + F.col("sxx")) / F.col("syy"), 6).alias("r2"), F.round(slope, 6).alias("slope"))


def hac_t(p: DataFrame, value: str, lags: int) -> DataFrame:
    """Newey-West t statistic of a mean per series, by lagged products."""
    w = series()
    mean = F.avg(value).over(Window.partitionBy(*KEYS))
    d = p.where(F.col(value).isNotNull()).withColumn("d", F.col(value) - mean)
    d = d.select(*KEYS, value, "d", *[(F.col("d") * F.lag("d", k).over(w)).alias(f"g{k}") for k in range(1, lags + 1)])
    s = d.groupBy(*KEYS).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.sum(F.col("d") * F.col("d")).alias("g0"), *[F.sum(f"g{k}").alias(f"g{k}") for k in range(1, lags + 1)])
    long_run = F.col("g0") + sum((F.col(f"g{k}") * (2 * (1 - k / (lags + 1))) for k in range(1, lags + 1)), F.lit(0.0))
    return s.select(*KEYS, "n", (F.round(F.col("mean") / F.sqrt(long_run / F.col("n") / F.col("n")), 6) + 0.0).alias("t"))


def economics(p: DataFrame, cost: int) -> DataFrame:
    """A position of the last move's sign: summed gain after cost, and the deepest fall from the running peak."""
    w = series()
    move = F.col("mid") - F.lag("mid").over(w)
    rows = p.withColumn("move", move).withColumn("side", F.signum(F.lag("move").over(w).cast("double")).cast("bigint")).where("side is not null and move is not null")
    gain = F.col("side") * F.col("move") - F.abs("side") * cost
    rows = rows.withColumn("gain", gain).withColumn("equity", F.sum("gain").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("peak", F.greatest(F.lit(0), F.max("equity").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    return rows.groupBy(*KEYS).agg(F.count_if(F.col("side") != 0).alias("trades"), F.sum("gain").alias("total"), F.max(F.col("peak") - F.col("equity")).alias("drawdown"), F.count_if(F.col("gain") > 0).alias("wins"))


def block_bootstrap(p: DataFrame, value: str, block: int, draws: int, seed: int) -> DataFrame:
    """Moving-block interval of a mean per series; draws are seeded, so reruns agree."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        x = frame.sort_values("t")[value].dropna().to_numpy(float)
        if len(x) <= block:
            return pd.DataFrame(columns=["venue", "symbol", "mean", "low", "high"])
        rng = np.random.default_rng(seed)
        starts = rng.integers(0, len(x) - block + 1, (draws, -(-len(x) // block)))
        total = np.concatenate(([0.0], np.cumsum(x)))
        means = (total[starts + block] - total[starts]).sum(1) / (starts.shape[1] * block)
        low, high = np.quantile(means, [0.025, 0.975])
        return pd.DataFrame([(frame["venue"].iloc[0], frame["symbol"].iloc[0], x.mean(), low, high)], columns=["venue", "symbol", "mean", "low", "high"])

    return p.select(*ROW, value).groupBy(*KEYS).applyInPandas(run, "venue string, symbol string, mean double, low double, high double")


def depth_panel(books: DataFrame, step: int, depths: tuple[int, ...]) -> DataFrame:
    """Per grid instant the last two-sided book at or before it: mid, spread, imbalance of the best 1, 5, ... levels,
    the touch's weighted deviation, age and level counts; only steps with a message have a row.

    ``books`` are messages as ``book.shown`` gives them, with as many levels as the largest of ``depths``."""
    bid, ask = F.get("bids", F.lit(0)), F.get("asks", F.lit(0))
    mid = midpoint(bid["price"], ask["price"])
    seen = [imbalance(side_sum("bids", n), side_sum("asks", n)).alias(f"imb{n}") for n in depths]
    micro = microprice_bps(*[c.cast("double") for c in (bid["price"], ask["price"], bid["qty"], ask["qty"])])
    rows = books.where("bid_levels > 0 and ask_levels > 0").withColumn("t", F.col("recv_wall") + F.pmod(-F.col("recv_wall"), F.lit(step)))
    told = F.struct(mid.alias("mid"), (ask["price"] - bid["price"]).alias("spread"), *seen, micro.alias("micro_dev_bps"), "recv_wall", "bid_levels", "ask_levels")
    last = rows.groupBy(*KEYS, "t").agg(F.max_by(told, "first_ordinal").alias("x"), F.count("*").alias("msgs"), F.count_if("suspect").alias("suspect_msgs"))
    return last.select(*ROW, "x.mid", "x.spread", *[F.round(f"x.imb{n}", 9).alias(f"imb{n}") for n in depths], F.round("x.micro_dev_bps", 6).alias("micro_dev_bps"), (F.col("t") - F.col("x.recv_wall")).alias("age_ns"), "x.bid_levels", "x.ask_levels", "msgs", "suspect_msgs")


def usable(max_age: int):
    """Clean, priced and fresh."""
    return (F.col("suspect_msgs") == 0) & F.col("mid").isNotNull() & (F.col("age_ns") <= max_age)


def lagged_target(p: DataFrame, lag: int, ahead: int) -> DataFrame:
    """Log return in basis points from ``lag`` steps after an instant, when a decision could act, to ``ahead`` steps later."""
    w, mid = series(), F.log(F.col("mid").cast("double"))
    return p.select(*ROW, F.round((F.lead(mid, lag + ahead).over(w) - F.lead(mid, lag).over(w)) * 10_000, 6).alias("target_bps"))


def round_trips(p: DataFrame, lag: int, ahead: int, fee_bps: float) -> DataFrame:
    """Trips that don't overlap: every (lag + ahead)-th instant of a series takes the sign of the last move, enters ``lag``
    steps on and leaves ``ahead`` later; half of both spreads and twice the fee are its cost."""
    w = series()
    mid, bps = F.col("mid").cast("double"), F.col("spread") / F.col("mid") * 10_000
    rows = p.select(*ROW, (F.row_number().over(w) - 1).alias("place"), F.signum(mid - F.lag(mid).over(w)).alias("side"), (F.lead(mid, lag + ahead).over(w) / F.lead(mid, lag).over(w) - 1).alias("move"), ((F.lead(bps, lag).over(w) + F.lead(bps, lag + ahead).over(w)) / 2).alias("spreads"))
    rows = rows.where((F.col("place") % (lag + ahead) == 0) & F.col("side").isNotNull() & F.col("move").isNotNull())
    net = F.col("side") * F.col("move") * 10_000 - F.abs("side") * (F.col("spreads") + 2 * fee_bps)
    return rows.groupBy(*KEYS).agg(F.count("*").alias("opportunities"), F.count_if(F.col("side") != 0).alias("round_trips"), F.round(F.sum(net), 4).alias("net_bps"))


def costs(p: DataFrame, fee_bps: float) -> DataFrame:
    """Median and ninetieth percentile of the spread in basis points, and what a round trip costs with an assumed fee."""
    bps = F.col("spread") / F.col("mid") * 10_000
    return p.where("mid is not null and suspect_msgs = 0").groupBy(*KEYS).agg(F.percentile(bps, 0.5).alias("m"), F.percentile(bps, 0.9).alias("p")).select(*KEYS, F.round("m", 6).alias("median_spread_bps"), F.round("p", 6).alias("p90_spread_bps"), F.round(F.col("m") / 2, 6).alias("half_spread_bps"), F.round(F.col("m") + 2 * fee_bps, 6).alias("round_trip_bps"))


def paired(a: DataFrame, b: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The difference of two models' ``value`` on the cells that both have."""
    both = a.select(*keys, F.col(value).alias("first")).join(b.select(*keys, F.col(value).alias("second")), keys)
    return both.withColumn("delta", F.col("second") - F.col("first"))
