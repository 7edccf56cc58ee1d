"""Running values over long series without a window that holds a whole series.

A series is cut into chunks of its order column.  A grouped aggregate gives each chunk's part, one short window over
chunks carries the parts on, and rows meet what was carried to their chunk: a series is the work of many tasks.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .durable import materialize

#: Width of a chunk where the order column counts rows.
CHUNK = 1 << 20


def before(df: DataFrame, keys: list[str], order: str | list[str], width: int = CHUNK, **values: tuple[str, Column]) -> DataFrame:
    """Adds for each name the value over the rows of ``keys`` that come before in ``order``: whole numbers without ties,
    of which the first is cut into chunks of ``width``.

    Null keys are series like any other, and nulls in ``order`` come first, as they do in a window.

    ``max`` and ``sum`` pass nulls over and are null if there was nothing; ``last`` is the last value that is not null;
    ``lag`` is that of the row just before, null or not.  For what comes after, order by the negated number.
    """
    kinds = {n: k for n, (k, _) in values.items()}
    order = [order] if isinstance(order, str) else order
    place = F.struct(*order)
    # Read twice below; written once first, so that running values of running values don't double the work with each step.
    df = df if hasattr(df, "_written_at") else materialize(df, "series")
    held = df.withColumns({f"__v_{n}": F.struct(c.alias("x")) if kinds[n] == "lag" else c for n, (_, c) in values.items()}).withColumn("__chunk", F.floor(F.col(order[0]) / width))
    at = lambda n: F.col(f"__v_{n}")
    part = {"max": F.max, "sum": F.sum, "last": None, "lag": None}
    parts = [part[k](at(n)).alias(f"__p_{n}") if part[k] else F.max_by(at(n), F.when(at(n).isNotNull(), place)).alias(f"__p_{n}") for n, k in kinds.items()]
    chunks = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    over = {"max": F.max, "sum": F.sum, "last": lambda c: F.last(c, True), "lag": lambda c: F.last(c, True)}
    carried = held.groupBy(*keys, "__chunk").agg(*parts).select(*keys, "__chunk", *[over[k](F.col(f"__p_{n}")).over(chunks).alias(f"__c_{n}") for n, k in kinds.items()])
    within = Window.partitionBy(*keys, "__chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = held.withColumns({f"__w_{n}": over[k](at(n)).over(within) for n, k in kinds.items()})
    same = [*keys, "__chunk"]
    carried = carried.select(*[F.col(k).alias(f"__of_{k}") for k in same], *[f"__c_{n}" for n in kinds])
    both = own.join(carried, reduce(and_, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in same]))

    def joined(n: str, k: str) -> Column:
        here, past = F.col(f"__w_{n}"), F.col(f"__c_{n}")
        if k == "max":
            return F.greatest(here, past)
        if k == "sum":
            return F.when(here.isNotNull() | past.isNotNull(), F.coalesce(here, F.lit(0)) + F.coalesce(past, F.lit(0)))
        last = F.coalesce(here, past)
        return last["x"] if k == "lag" else last

    return both.withColumns({n: joined(n, k) for n, k in kinds.items()}).select(*df.columns, *values)


def after(df: DataFrame, keys: list[str], order: str | list[str], width: int = CHUNK, **values: tuple[str, Column]) -> DataFrame:
    """As :func:`before` over the rows that come after: ``last`` is the first value to come, ``lag`` the next row's."""
    order = [order] if isinstance(order, str) else order
    turned = df.withColumns({f"__back_{c}": -F.col(c) for c in order})
    return before(turned, keys, [f"__back_{c}" for c in order], width, **values).drop(*[f"__back_{c}" for c in order])
