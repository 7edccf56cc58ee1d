"""Registered queries of forecasts; none of them is SQL, tests hold them to least squares and hand-made cases."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import HOUR, KEYS, panel
from .operators import research, study
from .registry import Registry

_own = Registry()
query = _own.query
WEEK = 7 * 24 * HOUR


def fold_rows(spark, sf_dir):
    """Features and target of each panel row that has all of them."""
    p = panel(spark, sf_dir)
    w = research.series()
    mid = F.log(F.col("mid").cast("double"))
    back = lambda k: (mid - F.lag(mid, k).over(w)) * 10_000
    rows = p.select(*KEYS, "t", F.floor(F.col("t") / WEEK).cast("bigint").alias("day"), back(1).alias("r1"), back(5).alias("r5"), (F.col("spread") / F.col("mid") * 10_000).alias("spread"), (F.col("spread") / F.col("mid") * 5_000).alias("half_spread"), F.lit(1.0).alias("one"), ((F.lead(mid, 3).over(w) - mid) * 10_000).alias("y"))
    return rows.dropna()


def _folds(spark, sf_dir):
    return study.folds(fold_rows(spark, sf_dir), ["r1", "r5", "spread", "half_spread", "one"], "y", 3, 30)


@query()
def ols_folds(spark, sf_dir):
    return _folds(spark, sf_dir)


@query()
def study_headline(spark, sf_dir):
    return study.fold_summary(_folds(spark, sf_dir))


@query()
def crossed_bootstrap(spark, sf_dir):
    p = research.returns(panel(spark, sf_dir), 1, 1).withColumn("day", F.floor(F.col("t") / (24 * HOUR)))
    return study.crossed_interval(p, "forward_bps", "day", "venue", 500, 7)


queries, oracle_sql = _own.queries, _own.oracle_sql
