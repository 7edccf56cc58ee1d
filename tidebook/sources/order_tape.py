"""A tape of order events made from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import UNIT

TICK = 10_000_000


def derived_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four events an order, seven orders at a time: an add that is sometimes missing, a size or price change, an
    execution, change or second add, and an end that one order in five goes without."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "value", "props")
    n, k = F.col("event_id"), F.regexp_extract("props", r'"k": (-?\d+)', 1).cast("bigint")
    turn, order = F.expr("(event_id % 28) div 7"), F.expr("event_id % 7 + 7 * (event_id div 28)")
    rows = e.select(n.alias("ordinal"), turn.alias("turn"), order.alias("o"), k.alias("k"), F.round(F.col("value") * 100).cast("bigint").alias("c"))
    o, k, turn = F.col("o"), F.col("k"), F.col("turn")
    action = (
        F.when(turn == 0, F.when(o % 23 == 0, "cancel").otherwise("add")).when(turn == 1, "modify")
        .when(turn == 2, F.when(o % 3 == 0, "modify").when(o % 11 == 0, "add").otherwise("execute")).otherwise(F.when(o % 5 == 0, "modify").otherwise("cancel"))
    )
    away = (1 + o % 6 + F.when((turn == 1) & (k % 4 == 0), 1).otherwise(0)) * TICK
    side = o % 2
    return rows.select(
        F.when(o % 4 < 2, "bitstamp").otherwise("kraken").alias("venue"), F.lit("BTC-USD").alias("symbol"), "ordinal", action.alias("action"), o.cast("string").alias("order_id"), side.cast("int").alias("side"),
        (100 * UNIT + F.when(side == 0, -away).otherwise(away)).alias("price"), F.when(k % 9 == 0, 0).otherwise((1 + k % 50) * 1_000_000).alias("qty"), F.when(k % 3 != 0, turn * 2_000_000).alias("executed"))
