"""Raw frames as they came: JSON lines of venue, both clocks and the payload, untouched."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FRAME = "venue string, t_mono bigint, t_wall bigint, payload string"
FIELDS = ["venue", "t_mono", "t_wall", "payload"]


def write_frames(frames: DataFrame, path: str) -> None:
    """One line a frame, in order of the monotonic clock within a venue; ranges of it are tasks of their own."""
    ordered = frames.repartitionByRange("venue", "t_mono").sortWithinPartitions("venue", "t_mono")
    ordered.select(F.to_json(F.struct(*FIELDS)).alias("value")).write.mode("append").text(path)


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    """Frames with ``bad`` true where a line is none."""
    told = spark.read.text(path).select(F.from_json("value", FRAME).alias("x"))
    return told.select("x.*", (F.col("x").isNull() | F.col("x.payload").isNull()).alias("bad"))


def bare_payloads(payloads: DataFrame, venue: str, order: str, payload: str = "payload") -> DataFrame:
    """Frames of payloads without clocks, a millisecond apart in the order of a column that counts from 0."""
    at = F.col(order) * 1_000_000
    return payloads.select(F.lit(venue).alias("venue"), at.alias("t_mono"), at.alias("t_wall"), F.col(payload).alias("payload"))


def without(frames: DataFrame, order: str, dropped: list[int]) -> DataFrame:
    """The frames but for those at some places: a loss put in on purpose."""
    return frames.where(~F.col(order).isin(dropped))
