"""Point-in-time reads: what had arrived by an instant, and how fresh it was."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans import running


def observations(rows: DataFrame) -> DataFrame:
    """Bid prices as they arrived: entity, value, event time, availability and arrival order."""
    return rows.where("side = 0 and qty <> 0").select(F.col("venue").alias("entity"), F.col("price").alias("value"), F.col("venue_ts").alias("event_time"), F.col("recv_wall").alias("available_at"), F.col("row_ordinal").alias("arrival"))


def freshness(as_of: Column, event_time: Column, arrival: Column, ttl: int) -> Column:
    return F.when(arrival.isNull(), "missing").when(event_time.isNull(), "age_unknown").when(as_of - event_time <= ttl, "fresh").otherwise("stale")


def as_of(observed: DataFrame, probes: DataFrame, ttl: int, clock: str = "available_at", chunk: int = 6 * 3_600_000_000_000) -> DataFrame:
    """Per probe (``entity, as_of``) the eligible observation that arrived last, and its verdict.

    Eligible is ``clock <= as_of``; the winner is by arrival, not by clock, since clocks step back.  A running maximum
    within chunks of time and a running maximum over the chunks' maxima make one entity many tasks' work.  A null entity
    is one like others; a probe without an instant sees nothing.
    """
    seen = observed.where(F.col(clock).isNotNull()).select("entity", F.col(clock).alias("at"), F.lit(0).alias("probe"), F.struct("arrival", "value", "event_time", "available_at").alias("o"))
    asked = probes.select("entity", F.col("as_of").alias("at"), F.lit(1).alias("probe"), F.lit(None).cast(seen.schema["o"].dataType).alias("o"))
    both = seen.unionByName(asked).withColumn("chunk", F.col("at") - F.pmod("at", F.lit(chunk)))
    tops = both.groupBy("entity", "chunk").agg(F.max("o").alias("top"))
    earlier = tops.select(F.col("entity").alias("of"), F.col("chunk").alias("in"), F.max("top").over(Window.partitionBy("entity").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"))
    within = Window.partitionBy("entity", "chunk").orderBy("at", "probe").rowsBetween(Window.unboundedPreceding, 0)
    won = both.withColumn("here", F.max("o").over(within)).where("probe = 1").join(earlier, F.col("entity").eqNullSafe(F.col("of")) & F.col("chunk").eqNullSafe(F.col("in"))).withColumn("w", F.greatest("here", "earlier"))
    return won.select("entity", F.col("at").alias("as_of"), F.col("w.value").alias("value"), F.col("w.arrival").alias("arrival"), freshness(F.col("at"), F.col("w.event_time"), F.col("w.arrival"), ttl).alias("freshness"))


def latest(observed: DataFrame, watermark: int, ttl: int) -> DataFrame:
    """The newest arrival per entity by a watermark, judged there."""
    won = observed.where(F.col("available_at") <= watermark).groupBy("entity").agg(F.max_by(F.struct("value", "event_time", "arrival"), "arrival").alias("w"))
    return won.select("entity", F.col("w.value").alias("value"), F.col("w.arrival").alias("arrival"), freshness(F.lit(watermark), F.col("w.event_time"), F.col("w.arrival"), ttl).alias("freshness"))


def grid(entities: DataFrame, start: int, end: int, step: int) -> DataFrame:
    return entities.select("entity").distinct().select("entity", F.explode(F.sequence(F.lit(start), F.lit(end), F.lit(step))).alias("as_of"))


def edges(observed: DataFrame, start: int, end: int, step: int) -> DataFrame:
    """Probes where an answer may change: an even grid, and each arrival with the instants just before and after."""
    near = observed.where("available_at is not null").select("entity", F.explode(F.array(F.col("available_at") - 1, F.col("available_at"), F.col("available_at") + 1)).alias("as_of"))
    return grid(observed, start, end, step).union(near).distinct()


def paced(messages: DataFrame, speed: float) -> DataFrame:
    """``wait_ns``: how long after the message before it each is due at ``speed`` times real time; a clock that steps
    back makes no debt."""
    seen = running.before(messages, ["venue", "symbol"], "first_ordinal", was_at=("lag", F.col("recv_wall")))
    gap = F.col("recv_wall") - F.col("was_at")
    return seen.withColumn("wait_ns", F.floor(F.greatest(F.coalesce(gap, F.lit(0)), F.lit(0)) / speed).cast("bigint")).drop("was_at")


def compare_reports(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two tables of ``metric, value`` side by side, with the change where both have one."""
    both = a.select("metric", F.col("value").alias("before")).join(b.select("metric", F.col("value").alias("after")), "metric", "full")
    return both.withColumn("delta", F.col("after") - F.col("before"))
