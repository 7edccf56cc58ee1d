"""Loss detection and what it says of an archive: verdicts, suspect windows, coverage, latency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import DAY, floor_bucket
from ..plans import running

KEYS = ["venue", "symbol"]


def counter_verdicts(numbered: DataFrame) -> DataFrame:
    """``verdict`` and ``missing`` of a per-message counter ``seq``, in order of ``first_ordinal``.

    The floor is the largest number so far; a number under it is stale, equal a duplicate, past the next a gap.
    """
    seq = F.col("seq")
    numbered = running.before(numbered, KEYS, "first_ordinal", floor=("max", seq))
    verdict = F.when(F.col("floor").isNull(), "first").when(seq == F.col("floor") + 1, "in_order").when(seq == F.col("floor"), "duplicate").when(seq < F.col("floor"), "stale").otherwise("gap")
    return numbered.withColumn("verdict", verdict).withColumn("missing", F.when(F.col("verdict") == "gap", seq - F.col("floor") - 1).otherwise(0)).drop("floor")


def chain_verdicts(chained: DataFrame) -> DataFrame:
    """Whether ``prev_seq`` names the message before it; a null predecessor starts a chain."""
    chained = running.before(chained, KEYS, "first_ordinal", last=("lag", F.col("seq")))
    return chained.withColumn("verdict", F.when(F.col("prev_seq").isNull() | F.col("last").isNull(), "reset").when(F.col("prev_seq") == F.col("last"), "in_order").otherwise("gap")).drop("last")


def timestamp_verdicts(stamped: DataFrame) -> DataFrame:
    """Venue stamps can show disorder but never completeness, so one that advances is unverifiable."""
    at = F.col("venue_ts")
    return running.before(stamped, KEYS, "first_ordinal", floor=("max", at)).withColumn("verdict", F.when(at.isNull(), "absent").when(F.col("floor").isNull() | (at > F.col("floor")), "unverifiable").when(at == F.col("floor"), "duplicate").otherwise("out_of_order")).drop("floor")


def suspect_windows(messages: DataFrame) -> DataFrame:
    """Runs of suspect messages: first and last receipt, and the receipt of the next snapshot after the start."""
    seen = running.before(messages, KEYS, "first_ordinal", was=("lag", F.col("suspect"))).withColumn("opens", (F.col("suspect") & ~F.coalesce("was", F.lit(False))).cast("int")).drop("was")
    run = running.before(seen, KEYS, "first_ordinal", opened=("sum", F.col("opens"))).withColumn("run", F.coalesce("opened", F.lit(0)) + F.col("opens"))
    run = running.after(run, KEYS, "first_ordinal", healed_at=("last", F.when(F.col("event") == 0, F.col("recv_wall"))))
    return run.where("suspect").groupBy(*KEYS, "run").agg(F.min("recv_wall").alias("opened_at"), F.max("recv_wall").alias("last_at"), F.min_by("healed_at", "first_ordinal").alias("healed_at"), F.count("*").alias("messages")).drop("run")


def coverage_state(messages: Column, suspect: Column, verifiable: Column) -> Column:
    return F.when(messages == 0, "absent").when(suspect > 0, "suspect").when(verifiable, "clean").otherwise("unverifiable")


def coverage_grid(rows: DataFrame, width: int, verifiable: dict[str, bool]) -> DataFrame:
    """Every bucket of one grid over all series, with counts and state; nothing recorded is a state too."""
    seen = rows.withColumn("bucket", floor_bucket(F.col("recv_wall"), width)).groupBy(*KEYS, "bucket").agg(F.count_distinct("msg_index").alias("messages"), F.count("*").alias("rows"), F.count_if("suspect").alias("suspect_rows"))
    span = seen.agg(F.min("bucket").alias("a"), F.max("bucket").alias("b")).first()
    if span["a"] is None:
        return seen.withColumn("state", F.lit("absent"))
    grid = seen.select(*KEYS).distinct().withColumn("bucket", F.explode(F.sequence(F.lit(span["a"]), F.lit(span["b"]), F.lit(width))))
    proof = F.coalesce(*[F.when(F.col("venue") == v, F.lit(x)) for v, x in verifiable.items()], F.lit(False))
    full = grid.join(seen, [*KEYS, "bucket"], "left").na.fill(0, ["messages", "rows", "suspect_rows"])
    return full.withColumn("state", coverage_state(F.col("messages"), F.col("suspect_rows"), proof))


def gap_report(messages: DataFrame) -> DataFrame:
    """Counters of a series: messages, suspect time over observed time, verified share; null where nothing was seen."""
    timed = running.after(messages, KEYS, "first_ordinal", next_at=("lag", F.col("recv_wall")))
    return timed.groupBy(*KEYS).agg(
        F.count("*").alias("messages"), F.sum("n_rows").alias("rows"), F.count_if(F.col("event") == 0).alias("snapshots"), F.count_if("suspect").alias("suspect_messages"),
        (F.max("recv_wall") - F.min("recv_wall")).alias("observed_ns"), F.coalesce(F.sum(F.when(F.col("suspect"), F.col("next_at") - F.col("recv_wall"))), F.lit(0)).alias("suspect_ns"),
    ).withColumn("clean_fraction", F.round(F.when(F.col("observed_ns") > 0, 1 - F.col("suspect_ns") / F.col("observed_ns")), 9))


def latency_bucket(ns: Column, steps: int = 8) -> Column:
    """Signed log bucket: ``steps`` to a power of two, negative for readings before their time, zero for zero."""
    size = F.abs(ns)
    power = F.floor(F.log2(size.cast("double"))).cast("bigint")
    step = F.floor((size / F.pow(F.lit(2.0), power) - 1) * steps).cast("bigint")
    return F.when(ns == 0, 0).otherwise(F.signum(ns.cast("double")).cast("bigint") * (power * steps + step + 1))


def bucket_edge(bucket: Column, steps: int = 8) -> Column:
    """The edge of a bucket that is nearest zero, in whole nanoseconds toward zero."""
    place = F.abs(bucket) - 1
    edge = F.pow(F.lit(2.0), F.floor(place / steps)) * (1 + F.pmod(place, F.lit(steps)) / steps)
    return F.when(bucket == 0, 0).otherwise(F.signum(bucket.cast("double")) * F.floor(edge)).cast("bigint")


def histogram(values: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """``bucket, n, sum, min, max`` per key: what :func:`merged` adds and :func:`latency_summary` reads."""
    kept = values.where(F.col(value).isNotNull()).withColumn("bucket", latency_bucket(F.col(value)))
    return kept.groupBy(*keys, "bucket").agg(F.count("*").alias("n"), F.sum(F.col(value).cast("decimal(38,0)")).alias("sum"), F.min(value).alias("min"), F.max(value).alias("max"))


def merged(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """One histogram of two: bucket by bucket sums, and the outer extremes."""
    return a.unionByName(b).groupBy(*keys, "bucket").agg(F.sum("n").alias("n"), F.sum("sum").cast("decimal(38,0)").alias("sum"), F.min("min").alias("min"), F.max("max").alias("max"))


def latency_summary(hist: DataFrame, keys: list[str], qs: tuple[float, ...] = (0.5, 0.99)) -> DataFrame:
    """Count, how many are below zero, exact mean and extremes, and quantiles read from the buckets.

    A quantile is the edge nearest zero of the bucket that holds the rank ceil(q n), the most negative first, held
    between the extremes.  The window runs over buckets, some hundreds a key, and not over readings.
    """
    w = Window.partitionBy(*keys)
    upto = F.sum("n").over(w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    ranked = hist.withColumn("upto", upto).withColumn("total", F.sum("n").over(w))
    at = [F.min(F.when(F.col("upto") >= F.greatest(F.ceil(F.lit(q) * F.col("total")), F.lit(1)), F.col("bucket"))).alias(f"b{i}") for i, q in enumerate(qs)]
    told = ranked.groupBy(*keys).agg(
        F.sum("n").alias("count"), F.coalesce(F.sum(F.when(F.col("bucket") < 0, F.col("n"))), F.lit(0)).alias("negative"), F.sum("sum").cast("double").alias("sum"), F.min("min").alias("min_ns"), F.max("max").alias("max_ns"), *at)
    held = [F.greatest("min_ns", F.least("max_ns", bucket_edge(F.col(f"b{i}")))).alias(f"p{round(q * 100)}_ns") for i, q in enumerate(qs)]
    return told.select(*keys, "count", "negative", F.round(F.col("sum") / F.col("count"), 3).alias("mean_ns"), "min_ns", "max_ns", *held)


def quantile_ranks(values: DataFrame, value: str, keys: list[str], qs: list[float], steps: int = 64) -> DataFrame:
    """Nearest-rank quantiles, sorted[round(q (n - 1))], of whole numbers in two rounds.

    Counts of fine log buckets tell which bucket holds each rank; only that bucket's values are then put in order."""
    kept = values.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("v"), latency_bucket(F.col(value), steps).alias("bucket"))
    counts = kept.groupBy(*keys, "bucket").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*keys)
    upto = F.coalesce(F.sum("n").over(w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = counts.withColumn("from", upto).withColumn("total", F.sum("n").over(w))
    ranks = F.array(*[F.struct(F.lit(i).alias("q"), F.floor(F.lit(q) * (F.col("total") - 1) + 0.5).alias("rank")) for i, q in enumerate(qs)])
    wanted = ranked.withColumn("x", F.explode(ranks)).where((F.col("x.rank") >= F.col("from")) & (F.col("x.rank") < F.col("from") + F.col("n")))
    wanted = wanted.select(*keys, "bucket", F.col("x.q").alias("q"), (F.col("x.rank") - F.col("from")).alias("rank"))
    inside = kept.join(wanted, [*keys, "bucket"]).groupBy(*keys, "q", "rank", "v").agg(F.count("*").alias("n"))
    reached = inside.withColumn("upto", F.sum("n").over(Window.partitionBy(*keys, "q").orderBy("v"))).where(F.col("upto") > F.col("rank"))
    return reached.groupBy(*keys).agg(*[F.min(F.when(F.col("q") == i, F.col("v"))).alias(f"q{round(q * 100)}") for i, q in enumerate(qs)])


def observed_tick(rows: DataFrame) -> DataFrame:
    """The smallest gap between the prices of an instrument, from its distinct prices in ranges of price."""
    prices = rows.select(*KEYS, "price").distinct()
    gaps = running.before(prices, KEYS, "price", 1 << 40, under=("last", F.col("price"))).select(*KEYS, (F.col("price") - F.col("under")).alias("d"))
    return gaps.where("d > 0").groupBy(*KEYS).agg(F.min("d").alias("tick"))


def inversions(rows: DataFrame) -> DataFrame:
    """How far event time has fallen behind its running maximum in arrival order, worst per instrument."""
    seen = running.before(rows.where("venue_ts is not null"), KEYS, "row_ordinal", top=("max", F.col("venue_ts")))
    return seen.withColumn("behind", F.greatest(F.coalesce("top", "venue_ts"), "venue_ts") - F.col("venue_ts")).groupBy(*KEYS).agg(F.max("behind").alias("worst_ns"), F.count_if(F.col("behind") > 0).alias("inverted"))


def late_rows(rows: DataFrame, lateness: int) -> DataFrame:
    """Rows late against the maximum before them, judged before that moves."""
    judged = running.before(rows.where("venue_ts is not null"), KEYS, "row_ordinal", top=("max", F.col("venue_ts")))
    judged = judged.withColumn("late", F.coalesce(F.col("venue_ts") < F.col("top") - lateness, F.lit(False)))
    return judged.groupBy(*KEYS).agg(F.count("*").alias("rows"), F.count_if("late").alias("late"))


def range_verdicts(updates: DataFrame, anchors: DataFrame) -> DataFrame:
    """``verdict`` and ``missing`` of update ranges ``first_seq..seq`` against the snapshot they build on.

    ``updates`` has ``first_ordinal``; ``anchors`` has the keys, ``first_ordinal`` and ``snapshot_id``.  Before any
    anchor nothing can be told.  After one, ranges that end within it are stale; the first that does not must hold the
    id after it, and each later one the id after the last applied; a range that ends no later is a duplicate.
    """
    both = updates.select(*KEYS, "first_ordinal", "first_seq", "seq", F.lit(None).cast("bigint").alias("snapshot_id"))
    both = both.unionByName(anchors.select(*KEYS, "first_ordinal", "snapshot_id", F.lit(None).cast("bigint").alias("first_seq"), F.lit(None).cast("bigint").alias("seq")))
    seen = running.before(both, KEYS, "first_ordinal", anchors=("sum", F.col("snapshot_id").isNotNull().cast("bigint")), standing=("last", F.col("snapshot_id")))
    marked = seen.withColumn("anchor", F.coalesce("anchors", F.lit(0)) + F.col("snapshot_id").isNotNull().cast("bigint")).withColumn("base", F.coalesce("snapshot_id", "standing")).drop("anchors", "standing")
    rows = running.before(marked, [*KEYS, "anchor"], "first_ordinal", last=("max", F.when(F.col("seq") > F.col("base"), F.col("seq")))).where("snapshot_id is null")
    due = F.coalesce("last", "base") + 1
    verdict = (
        F.when(F.col("base").isNull(), "awaiting_snapshot").when(F.col("last").isNull() & (F.col("seq") <= F.col("base")), "stale")
        .when(F.col("seq") <= F.col("last"), "duplicate").when(F.col("first_seq") <= due, "in_order").otherwise("gap")
    )
    rows = rows.withColumn("verdict", verdict).withColumn("missing", F.when(F.col("verdict") == "gap", F.col("first_seq") - due).otherwise(0))
    return rows.select(*KEYS, "first_ordinal", "first_seq", "seq", "verdict", "missing")


def is_loss(verdict: Column) -> Column:
    return verdict.isin("gap", "divergence", "out_of_order")


def applies(verdict: Column) -> Column:
    return ~verdict.isin("duplicate", "stale")


def first_violation(judged: DataFrame) -> DataFrame:
    """What an archive reader may use: per series the messages before the first that is suspect, lost, repeated or stale,
    or received before the one that precedes it."""
    judged = running.before(judged, KEYS, "first_ordinal", was_at=("lag", F.col("recv_wall")))
    back = F.coalesce(F.col("recv_wall") < F.col("was_at"), F.lit(False))
    bad = F.col("suspect") | back | is_loss(F.col("verdict")) | ~applies(F.col("verdict"))
    marked = judged.withColumn("bad", bad)
    first = marked.where("bad").groupBy(*KEYS).agg(F.min("first_ordinal").alias("stop"))
    return marked.join(first, KEYS, "left").where("stop is null or first_ordinal < stop").drop("bad", "stop", "was_at")


def grid_coverage(messages: DataFrame, grid: DataFrame, lost: DataFrame, verifiable: bool, silence: int = 60_000_000_000) -> DataFrame:
    """State of each grid instant ``t`` per series: missing, invalid, unknown, verified or observed_unverifiable.

    Missing: before the first or after the last message, inside a silence or a stated loss (``lost_from``, null: open,
    to ``lost_to``).  Invalid: after a suspect message not followed by a snapshot.  Unknown: no snapshot since the
    start, the last silence or the last loss.  Messages and instants meet in running values over days.
    """
    order = ["recv_wall", "first_ordinal"]
    seen = messages.select(*KEYS, "recv_wall", "first_ordinal", "event", "suspect")
    seen = running.before(seen, KEYS, order, DAY, before=("lag", F.col("recv_wall")), earlier=("sum", F.lit(1)))
    seen = running.after(seen, KEYS, order, DAY, after=("lag", F.col("recv_wall"))).withColumn("n", F.coalesce("earlier", F.lit(0)) + 1).drop("earlier")
    cuts = lost.select(F.col("venue").alias("lost_venue"), "lost_from", "lost_to")
    cut = seen.join(cuts, (F.col("venue") == F.col("lost_venue")) & (F.col("lost_to") <= F.col("recv_wall")) & (F.col("lost_to") > F.col("before")), "left_semi").select(*KEYS, "first_ordinal", F.lit(True).alias("cut"))
    seen = seen.join(cut, [*KEYS, "first_ordinal"], "left")
    breaks = F.coalesce("cut", F.lit(False)) | F.coalesce(F.col("recv_wall") - F.col("before") > silence, F.lit(False))
    when = {"snapshot": F.when(F.col("event") == 0, F.col("n")), "broken": F.when(breaks, F.col("n")), "tainted": F.when(F.col("suspect"), F.col("n"))}
    known = running.before(seen.withColumns({f"at_{k}": c for k, c in when.items()}), KEYS, order, DAY, **{k: ("max", F.col(f"at_{k}")) for k in when})
    known = known.withColumns({k: F.coalesce(f"at_{k}", k, F.lit(0)) for k in when})
    state = F.when((F.col("tainted") > 0) & (F.col("tainted") >= F.col("snapshot")), "invalid").when((F.col("snapshot") == 0) | (F.col("snapshot") < F.col("broken")), "unknown").otherwise("verified" if verifiable else "observed_unverifiable")
    told = known.select(*KEYS, F.col("recv_wall").alias("t"), F.lit(0).alias("probe"), "n", F.struct("n", state.alias("state"), F.col("recv_wall").alias("last"), F.col("after").alias("next")).alias("o"))
    asked = grid.select(*KEYS, "t", F.lit(1).alias("probe"), F.lit(0).alias("n"), F.lit(None).cast(told.schema["o"].dataType).alias("o"))
    rows = running.before(told.unionByName(asked), KEYS, ["t", "probe", "n"], DAY, w=("max", F.col("o"))).where("probe = 1").select(*KEYS, "t", "w.*")
    gone = rows.join(cuts, (F.col("venue") == F.col("lost_venue")) & (F.col("t") < F.col("lost_to")) & (F.col("lost_from").isNull() | (F.col("t") > F.col("lost_from"))), "left_semi").select(*KEYS, "t", F.lit(True).alias("gone"))
    rows = rows.join(gone.distinct(), [*KEYS, "t"], "left")
    outside = F.col("n").isNull() | (F.col("next").isNull() & (F.col("t") > F.col("last")))
    silent = F.coalesce((F.col("next") - F.col("last") > silence) & (F.col("t") > F.col("last")), F.lit(False))
    return rows.select(*KEYS, "t", F.when(outside | silent | F.col("gone").isNotNull(), "missing").otherwise(F.col("state")).alias("state"))
