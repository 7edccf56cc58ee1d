"""Controls of a study: a job run twice, once with its future rewritten, and a signal of known size put in its target.

Both runs are reduced to digests of their rows and counted together, so that neither is gathered anywhere.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import study
from .study import KEYS

Job = Callable[[DataFrame], DataFrame]


def gauss(seed: int, *keys: str) -> Column:
    """A standard normal value made from the row's keys, so that a task run again draws the same."""
    even = lambda i: (F.pmod(F.xxhash64(*keys, F.lit(seed), F.lit(i)), F.lit(1 << 52)) + 0.5) / (1 << 52)
    return F.sqrt(-2 * F.log(even(0))) * F.cos(2 * math.pi * even(1))


def rewritten(rows: DataFrame, at: str, cut: int, new: dict[str, Column]) -> DataFrame:
    """The rows with the columns of ``new`` replaced after the cut; rows with a null ``at`` stay as they are."""
    late = F.coalesce(F.col(at) > cut, F.lit(False))
    return rows.withColumns({c: F.when(late, value.cast(rows.schema[c].dataType)).otherwise(F.col(c)) for c, value in new.items()})


def compare(first: DataFrame, second: DataFrame, at: str, cut: int, series: list[str], digits: int = 9) -> DataFrame:
    """Per series how many rows of two runs of a job differ up to the cut and after it, repeats counted.

    Rows are told apart by a digest of all columns, doubles rounded to ``digits`` places, since the order of a sum is
    open; null is a value; a row with a null ``at`` counts as before the cut.  ``verdict`` is ``fail`` if anything up to
    the cut differs, ``unproven`` if nothing after it does (the control then says nothing), else ``pass``."""

    def told(df: DataFrame, sign: int) -> DataFrame:
        same = [F.round(c, digits).alias(c) if kind in ("double", "float") else F.col(c) for c, kind in sorted(df.dtypes)]
        digest = F.unhex(F.sha2(F.to_json(F.struct(*same), {"ignoreNullFields": "false"}), 256))
        return df.select(*series, F.coalesce(F.col(at) > cut, F.lit(False)).alias("__late"), digest.alias("__digest"), F.lit(sign).alias("__n"))

    both = told(first, 1).unionByName(told(second, -1)).groupBy(*series, "__late", "__digest")
    rows = both.agg(F.count_if(F.col("__n") > 0).alias("__was"), F.sum("__n").alias("__n"))
    total = lambda late, value: F.sum(F.when(F.col("__late") == late, value).otherwise(0)).cast("bigint")
    gone, added = F.greatest("__n", F.lit(0)), F.greatest(-F.col("__n"), F.lit(0))
    parts = [("before", False), ("after", True)]
    told_of = [total(late, v).alias(name) for when, late in parts for name, v in ((f"rows_{when}", F.col("__was")), (f"{when}_gone", gone), (f"{when}_added", added))]
    verdict = F.when(F.expr("before_gone + before_added > 0"), "fail").when(F.expr("after_gone + after_added = 0"), "unproven").otherwise("pass")
    return rows.groupBy(*series).agg(*told_of).withColumn("verdict", verdict)


def lookahead(job: Job, rows: DataFrame, at: str, cut: int, new: dict[str, Column], seen: str, series: list[str] | None = None, digits: int = 9) -> DataFrame:
    """:func:`compare` of ``job(rows)`` and the same job on rows rewritten after the cut; ``seen`` is the result's time."""
    return compare(job(rows), job(rewritten(rows, at, cut, new)), seen, cut, series or KEYS, digits)


def planted(rows: DataFrame, feature: str, target: str, strength: float, seed: int, scale: float = 0.1) -> DataFrame:
    """The rows with ``target`` replaced by the standardised feature and noise, so that the feature explains ``strength``
    of its variance; noise alone at 0.  A missing feature counts as 0.  A constant feature gives a null target."""
    x = F.coalesce(F.nanvl(F.col(feature).cast("double"), F.lit(None)), F.lit(0.0))
    told = rows.agg(F.avg(x).alias("__mean"), F.stddev_pop(x).alias("__sd"))
    noise = gauss(seed, *KEYS, "t")
    z = F.try_divide(x - F.col("__mean"), F.col("__sd"))
    value = noise + 0 * z if strength <= 0 else z + noise * math.sqrt((1 - strength) / strength)
    return rows.crossJoin(F.broadcast(told)).withColumn(target, value * scale).drop("__mean", "__sd")


def recovered(rows: DataFrame, feature: str, strengths: list[float], seed: int, purge: int, least: int) -> DataFrame:
    """``strength, venue, symbol, folds, rows, r2``: what the folds find of a planted signal, over all folds of a series."""
    parts = []
    for s in strengths:
        done = study.folds(planted(rows, feature, "planted", s, seed).dropna(subset=[feature, "planted"]), [feature], "planted", purge, least)
        parts.append(done.groupBy(*KEYS).agg(F.count("*").alias("folds"), F.sum("n_test").alias("rows"), (1 - F.try_divide(F.sum("sse"), F.sum("syy"))).alias("r2")).select(F.lit(s).alias("strength"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
