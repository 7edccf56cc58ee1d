"""Shards of nearly equal bytes that keep equal texts together; DataFrame functions only.

Groups of equal texts lie in the order of their digest.  The least capacity with which a greedy walk needs no more than
the given number of shards is found by binary search, from sums of ranges of digests that are refined only where a cut
may fall: the driver holds sums of ranges, never the groups.
"""

from __future__ import annotations

from bisect import bisect_right
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.durable import materialize

#: Hex digits of a digest by which ranges are cut at first, and further ones with each refinement.
FIRST, MORE = 4, 2
DIGITS = 64
#: Ranges of a shard in which slots are counted on; starts of all, at most shards times this many rows, go to every task.
RANGES = 4_096


class Ranges(NamedTuple):
    """Ranges of digests in order: prefix, bytes before the range, and whether it holds one group alone; bytes in all."""

    prefix: list[str]
    start: list[int]
    single: list[bool]
    total: int


def walk(r: Ranges, capacity: int, shards: int, hopeful: bool) -> tuple[list[int], bool]:
    """Ends of greedy shards in bytes, and whether these are all.  Hopeful: a range of several groups could be cut at any
    byte; else only known cuts count, so that true cuts lie between the two."""
    ends, at = [], 0
    for _ in range(shards):
        if at + capacity >= r.total:
            return [*ends, r.total], True
        i = bisect_right(r.start, at + capacity) - 1
        to = at + capacity if hopeful and not r.single[i] else r.start[i]
        if to <= at:
            return ends, False
        ends.append(to)
        at = to
    return ends, at >= r.total


def least(r: Ranges, shards: int, hopeful: bool) -> int:
    low, high = max(0, -(-r.total // shards) - 1), r.total
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if walk(r, middle, shards, hopeful)[1] else (middle, high)
    return high


def ranges(groups: DataFrame, digits: int, within: list[str] | None = None, width: int = 0) -> list[tuple[str, int, bool]]:
    """``(prefix, bytes, single)`` of the ranges of ``digits`` digits, or of those below the given prefixes of ``width``."""
    some = groups if within is None else groups.join(F.broadcast(groups.sparkSession.createDataFrame([(p,) for p in within], "at string")), F.substring("digest", 1, width) == F.col("at"), "left_semi")
    rows = some.groupBy(F.substring("digest", 1, digits).alias("p")).agg(F.sum("bytes").alias("b"), F.count("*").alias("n"), F.min("digest").alias("d")).collect()
    return [(r["d"] if r["n"] == 1 else r["p"], r["b"], r["n"] == 1) for r in rows]


def _line(found: list[tuple[str, int, bool]]) -> Ranges:
    found.sort()
    start, at = [], 0
    for _, b, _ in found:
        start.append(at)
        at += b
    return Ranges([p for p, _, _ in found], start, [s for _, _, s in found], at)


def cuts(groups: DataFrame, shards: int) -> tuple[int, list[str]]:
    """The least capacity, and the digest prefixes at which the second shard and each later one begin.

    Refined are the ranges that cuts of any capacity still in question can fall into.  Each step adds ``MORE`` digits,
    and ends with capacities that agree, or with single groups.
    """
    found, digits = ranges(groups, FIRST), FIRST
    while True:
        line = _line(found)
        low, high = least(line, shards, True), least(line, shards, False)
        if low >= high or all(line.single):
            break
        from_, to = walk(line, low, shards, False)[0], walk(line, high, shards, True)[0]
        open_: set[int] = set()
        for i in range(len(to)):
            first = bisect_right(line.start, from_[i] if i < len(from_) else (from_[-1] if from_ else 0)) - 1
            last = bisect_right(line.start, min(to[i], line.total - 1)) - 1
            open_.update(j for j in range(max(first, 0), last + 1) if not line.single[j])
        # Each refined range keeps the digits that it had; those of other widths are refined in a later step.
        width = min(len(line.prefix[j]) for j in open_) if open_ else digits
        picked = [line.prefix[j] for j in sorted(open_) if len(line.prefix[j]) == width]
        if not picked:
            break
        gone = set(picked)
        found = [f for f in found if f[0] not in gone] + ranges(groups, min(DIGITS, width + MORE), picked, width)
    ends = walk(line, high, shards, False)[0]
    return high, [line.prefix[bisect_right(line.start, e) - 1] for e in ends if e < line.total]


def giants(groups: DataFrame, shards: int) -> list[tuple[str, int]]:
    """``(digest, bytes)`` of the groups that fill a shard by themselves: each at least an even part of what is left."""
    left = groups.agg(F.sum("bytes")).first()[0] or 0
    own: list[tuple[str, int]] = []
    for r in groups.orderBy(F.desc("bytes"), "digest").limit(shards - 1).collect():
        if r["bytes"] * (shards - len(own)) < left:
            break
        own.append((r["digest"], r["bytes"]))
        left -= r["bytes"]
    return own


def shard(df: DataFrame, shards: int = 40, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row; law is ``bytes``: sizes near equal.

    A row's size is the UTF-8 bytes of its text and 16.  Equal texts are one group and lie in one shard.  Groups that an
    even part can't hold come first, a shard each; all others are cut, in the order of their digests, at the least
    capacity with which the other shards suffice.  Slots number a shard's rows without gaps from 0, in steps over
    ranges of hashed ids, so that no shard is one task.

    Null text counts as empty, in size, checksum and group; null and repeated ids are rows like others; fewer groups
    than shards leave shards empty; an empty table gives no rows.  ``grown_shard`` is null, as it says nothing under
    this law.  Only the named columns are read, and texts don't move.
    """
    if shards < 1:
        raise ValueError("shards: 1 or more")
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    own = df.select(F.col(f"`{id_col}`").alias("doc_id"), (F.octet_length(whole) + 16).cast("long").alias("size"), F.crc32(whole.cast("binary")).alias("text_crc32"), F.sha2(whole.cast("binary"), 256).alias("digest"))
    rows = materialize(own, "sizes")
    groups = materialize(rows.groupBy("digest").agg(F.sum("size").alias("bytes")), "groups")
    alone = [d for d, _ in giants(groups, shards)]
    rest = groups.where(~F.col("digest").isin(alone)) if alone else groups
    starts = cuts(rest, shards - len(alone))[1]
    return slots(rows.withColumn("shard", place(F.col("digest"), alone, starts)), shards)


def place(digest: Column, alone: list[str], starts: list[str]) -> Column:
    """The shard of a digest: that of its own, or after those the number of cuts at or before it."""
    after = F.size(F.filter(F.array(*[F.lit(s) for s in starts]), lambda s: s <= digest)) if starts else F.lit(0)
    own = F.array_position(F.array(*[F.lit(d) for d in alone]), digest) if alone else F.lit(0)
    return F.when(own > 0, own - 1).otherwise(after + len(alone)).cast("int")


def slots(rows: DataFrame, shards: int) -> DataFrame:
    """Rows with ``shard`` numbered within it: counts of ranges are added up, rows only within their range."""
    cut = rows.withColumn("range", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(RANGES)).cast("int"))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut.groupBy("shard", "range").agg(F.count("*").alias("n")).select("shard", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "range").orderBy("doc_id", "digest")
    slot = (F.col("first") + F.row_number().over(within) - 1).cast("long")
    return cut.join(F.broadcast(starts), ["shard", "range"]).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
