"""Order-by-order books: what each event does, queues and positions in them, as windows over the life of an order.

An event is ``venue, symbol, ordinal, action, order_id, side, price, qty, executed``.  Whether an order rests before an
event follows from the last event that could set that, so no fold is needed: every step is partitioned by order or by
level, and a book at an instant is a filter on the spans in which orders rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["venue", "symbol"]
ORDER = [*KEYS, "order_id"]
LEVEL = [*KEYS, "side", "price"]
#: From sure to unsure; a queue is as sure as the least sure order in it.
OBSERVED, SEEDED, UNKNOWN = 0, 1, 2


def certainty_name(code: Column) -> Column:
    return F.element_at(F.array(F.lit("observed"), F.lit("seeded"), F.lit("unknown")), code + 1)


def applied(events: DataFrame) -> DataFrame:
    """Adds to each event what it finds and does.

    ``outcome``: applied, duplicate_add, unknown_order, negative, or empty (an add of nothing).  For applied events
    ``price_before, qty_before``; ``traded``: the rise of the cumulative executed quantity, of which an order without a
    history can claim no more than rested, or what rested if an execution gives no figure; ``queued``: the ordinal at
    which the order last went to the back of a queue, by an add, a price change or a larger size; ``certainty``: unknown
    once a larger size has moved it; ``rests``: whether it stands afterwards.
    """
    action, qty = F.col("action"), F.col("qty")
    w = Window.partitionBy(*ORDER).orderBy("ordinal")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    ends = action.isin("cancel", "execute") | ((action == "modify") & (qty == 0))
    sets = F.when((action == "add") & (qty > 0), True).when(ends & (qty >= 0), False)
    rows = events.withColumn("sets", sets).withColumn("stood", F.coalesce(F.last("sets", True).over(before), F.lit(False)))
    outcome = (
        F.when(qty < 0, "negative").when((action == "add") & F.col("stood"), "duplicate_add").when((action == "add") & (qty == 0), "empty")
        .when((action != "add") & ~F.col("stood"), "unknown_order").otherwise("applied")
    )
    rows = rows.withColumn("outcome", outcome).drop("sets", "stood")
    did = F.col("outcome") == "applied"
    rows = rows.withColumn("life", F.count_if(did & (action == "add")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    own = Window.partitionBy(*ORDER, "life").orderBy("ordinal")
    past = own.rowsBetween(Window.unboundedPreceding, -1)
    last = lambda c: F.when(did & (action != "add"), F.last(F.when(did, F.col(c)), True).over(past))
    rows = rows.withColumn("side_before", last("side")).withColumn("price_before", last("price")).withColumn("qty_before", last("qty")).withColumn("executed_before", last("executed"))
    moved = (F.col("price") != F.col("price_before")) | (F.col("side") != F.col("side_before"))
    raised = ~moved & (qty > F.col("qty_before"))
    now, was, rested = F.col("executed"), F.col("executed_before"), F.col("qty_before")
    traded = F.when(now.isNotNull() & was.isNotNull(), F.greatest(now - was, F.lit(0))).when(now.isNotNull(), F.least(now, rested)).when(action == "execute", rested).otherwise(0)
    rows = rows.withColumn("traded", F.when(did & action.isin("modify", "execute"), traded)).drop("executed_before")
    joins = did & ((action == "add") | ((action == "modify") & (moved | raised)))
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("queued", F.when(did, F.max(F.when(joins, F.col("ordinal"))).over(upto)))
    rows = rows.withColumn("certainty", F.when(did, F.when(F.max(F.when(did & (action == "modify") & raised, 1)).over(upto) == 1, UNKNOWN).otherwise(OBSERVED)))
    return rows.withColumn("rests", did & (action != "cancel") & (action != "execute") & (qty > 0))


def anomalies(done: DataFrame) -> DataFrame:
    """Per series: events applied, each kind of refusal, price moves, and quantity traded."""
    of = lambda kind: F.count_if(F.col("outcome") == kind)
    moved = (F.col("outcome") == "applied") & (F.col("action") == "modify") & (F.col("price") != F.col("price_before"))
    return done.groupBy(*KEYS).agg(
        of("applied").alias("applied"), of("duplicate_add").alias("duplicate_adds"), of("unknown_order").alias("unknown_orders"), of("negative").alias("negative"),
        F.count_if(moved).alias("price_moves"), F.coalesce(F.sum("traded"), F.lit(0)).alias("traded"))


def resting(done: DataFrame) -> DataFrame:
    """Spans ``since <= ordinal < to`` (null: still) in which an order rests with one price and quantity."""
    own = Window.partitionBy(*ORDER).orderBy("ordinal")
    rows = done.where("outcome = 'applied'").withColumn("to", F.lead("ordinal").over(own)).where("rests")
    return rows.select(*ORDER, "side", "price", "qty", "queued", "certainty", F.col("ordinal").alias("since"), "to")


def incomplete_levels(done: DataFrame, at: int) -> DataFrame:
    """Levels at an ordinal where an event named an order never seen to arrive, since they were last seen to empty."""
    seen = done.where(F.col("ordinal") <= at)
    marks = seen.where("outcome = 'unknown_order'").groupBy(*LEVEL).agg(F.max("ordinal").alias("marked"))
    joins = F.col("queued") == F.col("ordinal")
    step = lambda when, side, price, n, phase: F.when(when, F.struct(F.col(side).alias("side"), F.col(price).alias("price"), F.lit(n).alias("step"), F.lit(phase).alias("phase")))
    turns = F.array_compact(F.array(
        step((F.col("action") != "add") & (joins | ~F.col("rests")), "side_before", "price_before", -1, 0), step(joins, "side", "price", 1, 1),
        step(joins & ~F.col("rests"), "side", "price", -1, 2)))
    steps = seen.where("outcome = 'applied'").select(*KEYS, "ordinal", F.explode(turns).alias("x")).select(*KEYS, "ordinal", "x.*")
    count = F.sum("step").over(Window.partitionBy(*LEVEL).orderBy("ordinal", "phase").rowsBetween(Window.unboundedPreceding, 0))
    cleared = steps.withColumn("left", count).where("left = 0 and step < 0").groupBy(*LEVEL).agg(F.max("ordinal").alias("cleared"))
    return marks.join(cleared, LEVEL, "left").where("cleared is null or cleared < marked").select(*LEVEL)


def queues(done: DataFrame, at: int) -> DataFrame:
    """Every order that rests at an ordinal: its place in its queue, the quantity ahead and how sure that is."""
    here = standing(done, at)
    unsure = incomplete_levels(done, at).withColumn("unsure", F.lit(UNKNOWN))
    rows = here.join(unsure, LEVEL, "left")
    w = Window.partitionBy(*LEVEL).orderBy("queued")
    ahead = w.rowsBetween(Window.unboundedPreceding, -1)
    first = F.first(F.when(F.col("certainty") != OBSERVED, F.col("certainty")), True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    sure = F.when(F.col("unsure").isNotNull() | (F.col("certainty") == UNKNOWN), UNKNOWN).otherwise(F.coalesce(first, F.col("certainty")))
    return rows.select(
        *ORDER, "side", "price", "qty", (F.row_number().over(w) - 1).cast("bigint").alias("position"), F.coalesce(F.sum("qty").over(ahead), F.lit(0)).alias("qty_ahead"), certainty_name(sure).alias("certainty"))


def standing(done: DataFrame, at: int) -> DataFrame:
    """The orders that rest at an ordinal."""
    return resting(done).where((F.col("since") <= at) & (F.col("to").isNull() | (F.col("to") > at)))


def to_levels(orders: DataFrame) -> DataFrame:
    """Resting orders by level."""
    return orders.groupBy(*LEVEL).agg(F.sum("qty").alias("qty"), F.count("*").alias("orders"))


def reconcile(levels: DataFrame, other: DataFrame) -> DataFrame:
    """Levels of one book against those of another: how many agree, differ or stand in one alone."""
    a, b = levels.select(*LEVEL, F.col("qty").alias("a")), other.select(*LEVEL, F.col("qty").alias("b"))
    both = a.join(b, LEVEL, "full")
    return both.groupBy(*KEYS).agg(F.count_if(F.col("a") == F.col("b")).alias("equal"), F.count_if(F.col("a") != F.col("b")).alias("differ"), F.count_if(F.col("b").isNull()).alias("only_first"), F.count_if(F.col("a").isNull()).alias("only_second"))
