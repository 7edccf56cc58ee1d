"""Accounts of what a recording holds and lost: counters per series, totals, trust in a range, plans against what came,
faults put in on purpose, and checks of panels and runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans import running
from . import book

KEYS = ["venue", "symbol"]
COUNTERS = ("messages", "applied", "snapshots", "duplicates", "stale", "unverifiable", "sequence_gaps", "messages_missing", "out_of_order", "divergences", "resets", "crossed", "locked", "absent_removals")


def gap_counters(judged: DataFrame, expected: DataFrame) -> DataFrame:
    """A row per expected series with the counters of its messages; one that never delivered has zeros and null fractions.

    ``judged`` is a row per message: keys, ``event, recv_wall, verdict, missing, crossed, locked, absent_removals``.
    What was considered leaves out stale and repeated messages; the verified share is of what was considered.
    """
    of = lambda *v: F.count_if(F.col("verdict").isin(*v))
    own = judged.groupBy(*KEYS).agg(
        F.count("*").alias("messages"), F.count_if(~F.col("verdict").isin("duplicate", "stale")).alias("applied"), F.count_if(F.col("event") == 0).alias("snapshots"), of("duplicate").alias("duplicates"), of("stale").alias("stale"),
        of("unverifiable", "awaiting_snapshot", "absent").alias("unverifiable"), of("gap").alias("sequence_gaps"), F.sum("missing").alias("messages_missing"), of("out_of_order").alias("out_of_order"), of("divergence").alias("divergences"), of("reset").alias("resets"),
        F.count_if("crossed").alias("crossed"), F.count_if("locked").alias("locked"), F.sum("absent_removals").alias("absent_removals"), F.min("recv_wall").alias("first_seen"), F.max("recv_wall").alias("last_seen"))
    rows = expected.select(*KEYS).join(own, KEYS, "left").na.fill(0, [*COUNTERS])
    rows = rows.withColumn("considered", F.col("messages") - F.col("stale") - F.col("duplicates"))
    return rows.withColumn("verified_fraction", F.round(F.when(F.col("considered") > 0, (F.col("considered") - F.col("unverifiable")) / F.col("considered")), 9))


def gap_totals(report: DataFrame, windows: DataFrame) -> DataFrame:
    """Totals of a report, or of several in one table, and whether it is spotless: no suspect window, no loss, and nothing
    that could not be checked."""
    opened = windows.groupBy(*KEYS).agg(F.count("*").alias("windows"))
    rows = report.join(opened, KEYS, "left").na.fill(0, ["windows"])
    clean = (F.col("windows") + F.col("sequence_gaps") + F.col("divergences") + F.col("crossed") + F.col("out_of_order") + F.col("unverifiable")) == 0
    return rows.agg(F.sum("messages_missing").alias("missing"), F.sum(F.col("sequence_gaps") + F.col("divergences")).alias("gaps"), F.count_if(F.col("messages") == 0).alias("silent"), F.sum("windows").alias("windows"), F.bool_and(clean).alias("spotless"))


def trust_summary(rows: DataFrame, lost: DataFrame, after: int, until: int) -> DataFrame:
    """Per series what an answer over a range rests on: rows, suspect rows and their span, stated losses that meet the range.

    ``lost``: ``lost_venue`` (null: all), ``lost_from`` (null: open), ``lost_to``, few rows that a manifest states."""
    seen = rows.where((F.col("recv_wall") > after) & (F.col("recv_wall") <= until)).groupBy(*KEYS).agg(
        F.count("*").alias("rows"), F.count_if("suspect").alias("suspect_rows"), F.min(F.when(F.col("suspect"), F.col("recv_wall"))).alias("suspect_from"), F.max(F.when(F.col("suspect"), F.col("recv_wall"))).alias("suspect_to"))
    met = lost.where((F.coalesce("lost_from", F.lit(after)) <= until) & (F.col("lost_to") >= after))
    named = met.where("lost_venue is not null").groupBy(F.col("lost_venue").alias("venue")).agg(F.count("*").alias("own"))
    every = met.agg(F.count_if(F.col("lost_venue").isNull()).alias("every")).withColumn("one", F.lit(1))
    done = seen.join(named, "venue", "left").withColumn("one", F.lit(1)).join(every, "one").withColumn("truncations", F.coalesce("own", F.lit(0)) + F.col("every")).drop("own", "one", "every")
    return done.withColumn("clean", (F.col("suspect_rows") == 0) & (F.col("truncations") == 0))


def cursor(rows: DataFrame, after: int, until: int, n: int = 1) -> DataFrame:
    """What the book shows after each message with ``after < recv_wall <= until``.

    The book at the left edge comes from one grouped last write and seeds the epoch that stood there; only the range's
    own rows are then replayed.  ``rows`` carry ``epoch`` and ``pos``."""
    inside = rows.where((F.col("recv_wall") > after) & (F.col("recv_wall") <= until)).select(*book._INPUT[:3], *book._INPUT[4:])
    seen = rows.where(F.col("recv_wall") <= after)
    newest = seen.groupBy(*KEYS).agg(F.max("epoch").alias("epoch"))
    seed = seen.where("qty >= 0").join(newest, book.EPOCH).groupBy(*book.EPOCH, "side", "price").agg(F.max_by("qty", "row_ordinal").alias("qty")).where("qty > 0")
    begin = {"pos": "bigint", "row_ordinal": "bigint", "msg_index": "bigint"}
    seed = seed.withColumns({c: F.lit(-1).cast(k) for c, k in begin.items()}).withColumn("event", F.lit(1)).withColumn("recv_wall", F.lit(after)).withColumn("suspect", F.lit(False))
    return book.shown(inside.unionByName(seed), n).where("pos >= 0")


def revisions_at(revisions: DataFrame, points: Column, width: int) -> DataFrame:
    """What a store that takes revisions as they become available holds at each of ``points`` (an array): per series and
    point the newest window, and of that the newest batch.  A running maximum over chunks of ``width`` in availability."""
    told = revisions.select(*KEYS, F.col("availability_max").alias("t"), F.lit(0).alias("probe"), F.xxhash64("window_start", "batch_id").alias("tie"), F.struct("window_start", "batch_id", "rows", "availability_max").alias("o"))
    asked = revisions.select(*KEYS).distinct().select(*KEYS, F.explode(points).alias("t"), F.lit(1).alias("probe"), F.lit(0).cast("bigint").alias("tie"), F.lit(None).cast(told.schema["o"].dataType).alias("o"))
    both = running.before(told.unionByName(asked), KEYS, ["t", "probe", "tie"], width, w=("max", F.col("o")))
    return both.where("probe = 1 and w is not null").select(*KEYS, F.col("t").alias("as_of"), "w.window_start", "w.batch_id", "w.rows")


def agreement(a: DataFrame, b: DataFrame) -> DataFrame:
    """Answers ``entity, as_of, value, freshness`` of two stores side by side: how many agree in value, in verdict, in both."""
    both = a.select("entity", "as_of", F.col("value").alias("v1"), F.col("freshness").alias("f1")).join(b.select("entity", "as_of", F.col("value").alias("v2"), F.col("freshness").alias("f2")), ["entity", "as_of"], "full")
    value, verdict = F.col("v1").eqNullSafe(F.col("v2")), F.col("f1").eqNullSafe(F.col("f2"))
    return both.groupBy("entity").agg(F.count("*").alias("points"), F.count_if(value).alias("same_value"), F.count_if(verdict).alias("same_verdict"), F.count_if(value & verdict).alias("agree"))


def merged_by_arrival(rows: DataFrame, width: int) -> DataFrame:
    """All venues' rows as one stream: ``place`` by receipt, then venue, then ordinal, counted over chunks of receipt."""
    coded = rows.join(F.broadcast(venue_places(rows)), "venue")
    return running.before(coded, [], ["recv_wall", "venue_place", "row_ordinal"], width, place=("sum", F.lit(1))).withColumn("place", F.coalesce("place", F.lit(0)).cast("bigint")).drop("venue_place")


def venue_places(rows: DataFrame) -> DataFrame:
    """``venue, venue_place``: a row per venue, of which there are few, in order of name."""
    return rows.select("venue").distinct().withColumn("venue_place", F.row_number().over(Window.orderBy("venue")))


def partition_drift(rows: DataFrame, part: str, steps: int, width: int) -> DataFrame:
    """``step, spread_ns``: how far apart in arrival the partitions are when each is read to the same share of its rows."""
    placed = running.before(rows, [part], ["recv_wall", "row_ordinal"], width, place=("sum", F.lit(1))).select(part, "recv_wall", F.coalesce("place", F.lit(0)).cast("bigint").alias("place"))
    sizes = placed.groupBy(part).agg(F.count("*").alias("n"))
    wanted = sizes.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps)))).withColumn("place", F.least(F.col("n") - 1, F.expr(f"step * n div {steps}"))).drop("n")
    reached = placed.join(wanted, [part, "place"])
    return reached.groupBy("step").agg((F.max("recv_wall") - F.min("recv_wall")).alias("spread_ns"))


def watermark_floor(inversions: DataFrame, drift: DataFrame) -> DataFrame:
    """The least watermark that drops nothing: the worst inversion of a series and the worst drift between partitions."""
    worst = inversions.agg(F.max("worst_ns").alias("inversion_ns")).withColumn("one", F.lit(1))
    return worst.join(drift.agg(F.max("spread_ns").alias("drift_ns")).withColumn("one", F.lit(1)), "one").select("inversion_ns", "drift_ns", (F.col("inversion_ns") + F.col("drift_ns")).alias("floor_ns"))


def faulty(rows: DataFrame, order: str, drop: tuple[int, int], resend: tuple[int, int], lag: int, stop: int, window: int) -> DataFrame:
    """A topic with faults put in: a slice never sent, a slice sent again ``lag`` later, nothing from ``stop`` on, and
    order shuffled within windows of ``window``.  Adds ``slot``, the window, and ``again``; within a slot rows go by the
    hash of their ordinal."""
    at = F.col(order)
    first = rows.where(~((at >= drop[0]) & (at < drop[1]))).withColumn("sent", at).withColumn("again", F.lit(False))
    more = rows.where((at >= resend[0]) & (at < resend[1])).withColumn("sent", at + lag).withColumn("again", F.lit(True))
    return first.unionByName(more).where(F.col("sent") < stop).withColumn("slot", F.expr(f"sent div {window}")).withColumn("turn", F.md5(F.concat_ws("|", at.cast("string"), F.col("again").cast("string")))).drop("sent")


def tampered(numbered: DataFrame) -> DataFrame:
    """A control for the validators: in each epoch of four messages or more the numbers of the middle message and the next
    are swapped and the second message comes twice.  ``numbered``: keys, ``epoch, pos, seq``; adds ``copy``."""
    span = numbered.groupBy(*book.EPOCH).agg(F.min("pos").alias("begin"), F.count("*").alias("n")).where("n >= 4")
    span = span.select(*book.EPOCH, (F.col("begin") + F.floor(F.col("n") / 2)).alias("middle"), (F.col("begin") + 1).alias("second"))
    rows = numbered.join(span, book.EPOCH, "left")
    here = F.col("pos") - F.col("middle")
    pair = rows.where(here.isin(0, 1)).select(*book.EPOCH, (F.col("middle") * 2 + 1 - F.col("pos")).alias("pos"), F.col("seq").alias("other"))
    swapped = rows.join(pair, book.MESSAGE, "left").withColumn("seq", F.coalesce("other", "seq")).drop("other", "middle")
    out = swapped.withColumn("copy", F.explode(F.when(F.col("pos") == F.col("second"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return out.drop("second")


def panel_violations(p: DataFrame, step: int, windows: list[tuple[int, int]]) -> DataFrame:
    """How many rows of a panel break a rule: repeated instants, receipt after the instant, crossed touch, instants outside
    every window, holes between neighbours."""
    inside = F.lit(False)
    for a, b in windows:
        inside = inside | ((F.col("t") >= a) & (F.col("t") < b))
    once = p.groupBy(*KEYS, "t").agg(F.count("*").alias("n"), F.count_if(F.col("age_ns") < 0).alias("future"), F.count_if(F.col("spread") < 0).alias("crossed"))
    gap = running.before(once, KEYS, "t", step << 20, was=("lag", F.col("t")))
    return gap.groupBy(*KEYS).agg(
        F.sum(F.col("n") - 1).alias("repeated"), F.sum("future").alias("future"), F.sum("crossed").alias("crossed"), F.count_if(~inside).alias("outside"), F.count_if(F.col("t") - F.col("was") != step).alias("holes"))


def planned_coverage(p: DataFrame, instruments: DataFrame, windows: list[tuple[str, int, int]], step: int) -> DataFrame:
    """Every planned instrument and window (name, from, to) with its expected, observed and missing instants, those without
    a row too."""
    made = F.array(*[F.struct(F.lit(n).alias("window"), F.lit((b - a) // step).alias("expected")) for n, a, b in windows])
    plan = instruments.select(*KEYS, F.explode(made).alias("x")).select(*KEYS, "x.*")
    label = F.coalesce(*[F.when((F.col("t") >= a) & (F.col("t") < b), n) for n, a, b in windows])
    seen = p.withColumn("window", label).where("window is not null").groupBy(*KEYS, "window").agg(F.count("*").alias("observed"))
    rows = plan.join(seen, [*KEYS, "window"], "left").na.fill(0, ["observed"])
    return rows.select(*KEYS, "window", "expected", "observed", (F.col("expected") - F.col("observed")).alias("missing"), F.when(F.col("observed") == 0, "missing_window").otherwise("observed").alias("status"))


def stability(runs: DataFrame, least: int = 3) -> tuple[DataFrame, DataFrame]:
    """Per venue, strategy and symbol the windows' results of runs that may be judged, and how many were left out and why.

    ``runs``: ``venue, strategy, symbol, window, pnl, verifiable, held, truncated``; a null flag counts against a run."""
    why = F.when(~F.coalesce("verifiable", F.lit(False)), "unverifiable").when(~F.coalesce("held", F.lit(False)), "risk_not_held").when(F.coalesce("truncated", F.lit(True)), "truncated")
    told = runs.withColumn("why", why)
    stats = told.where("why is null").groupBy("venue", "strategy", "symbol").agg(
        F.count("*").alias("windows"), F.count_if(F.col("pnl") > 0).alias("positive"), F.sum("pnl").alias("total"), F.min("pnl").alias("worst"), F.max("pnl").alias("best"), (F.count("*") - F.count_distinct("window")).alias("repeated"))
    return stats.withColumn("coverage", F.when(F.col("windows") >= least, "window_only").otherwise("insufficient_windows")), told.where("why is not null").groupBy("why").agg(F.count("*").alias("runs"))


def rolling_checksum(events: DataFrame, order: str, value: Column, start: tuple[int, int] = (0, 0), chunk: int = running.CHUNK) -> DataFrame:
    """``events, checksum, resume_at`` after the events from an offset on, where each makes checksum * 31 + value in 64 bits.

    ``order`` counts events from 0; ``start`` is (offset, checksum) of a run that stopped.  A chunk of events is a map
    x -> a x + b; each is made in a task of its own, and the maps, one to a chunk, are applied in turn at the end."""

    def part(key: tuple, table: pa.Table) -> pa.Table:
        x = table.sort_by("place").column("value").to_numpy().astype(np.int64).view(np.uint64)
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(len(x), 31, np.uint64))))
            b = (x * powers[len(x) - 1 :: -1]).sum(dtype=np.uint64) if len(x) else np.uint64(0)
        return pa.table({"chunk": [key[0].as_py()], "n": [len(x)], "a": pa.array([int(powers[-1].view(np.int64))], pa.int64()), "b": pa.array([int(b.view(np.int64))], pa.int64())})

    rows = events.where(F.col(order) >= start[0]).select(F.floor(F.col(order) / chunk).alias("chunk"), F.col(order).alias("place"), value.cast("bigint").alias("value"))
    maps = rows.groupBy("chunk").applyInArrow(part, "chunk bigint, n bigint, a bigint, b bigint")
    none = events.sparkSession.range(1).select(F.lit(-1).cast("bigint").alias("chunk"), F.lit(0).cast("bigint").alias("n"), F.lit(1).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"))
    maps = maps.unionByName(none).repartition(1).sortWithinPartitions("chunk")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, c = 0, start[1]
        for batch in batches:
            for k, a, b in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                n, c = n + k, (c * a + b) % (1 << 64)
        c = c % (1 << 64)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([c - (1 << 64) if c >> 63 else c], pa.int64()), pa.array([start[0] + n], pa.int64())], ["events", "checksum", "resume_at"])

    return maps.mapInArrow(whole, "events bigint, checksum bigint, resume_at bigint")


def message_volume(rows: DataFrame, tells: Column) -> DataFrame:
    """Quantity traded per message: the sum of what its rows tell, 0 if none do, null on feeds that tell no trades."""
    return rows.groupBy(*book.MESSAGE, "msg_index").agg(F.max("recv_wall").alias("recv_wall"), F.when(F.bool_or(tells), F.coalesce(F.sum("traded"), F.lit(0))).alias("traded"))
