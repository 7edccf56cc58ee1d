"""Series with null keys and null order lose no row."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidebook.operators import book, pit
from tidebook.plans import running

ROWS = [(v, s, o, o and o * 3) for v in ("k", None) for s in ("x", None) for o in (None, 1, 5, 12, 13, 40)]


@pytest.mark.parametrize("kind", ["max", "sum", "last", "lag"])
def test_before_and_after_keep_null_keys(spark, kind):
    df = spark.createDataFrame(ROWS, "venue string, symbol string, o long, x long")
    rule = {"max": F.max, "sum": F.sum, "last": lambda c: F.last(c, True), "lag": lambda c: F.last(c)}[kind]
    for step, order in ((running.before, F.col("o")), (running.after, -F.col("o"))):
        w = Window.partitionBy("venue", "symbol").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        want = df.select("venue", "symbol", "o", rule("x").over(w).alias("v"))
        got = step(df, ["venue", "symbol"], "o", 10, v=(kind, F.col("x"))).select("venue", "symbol", "o", "v")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == len(ROWS)


def test_positions_keep_null_keys(spark):
    rows = [(v, s, i, 1, i, 100 + i, 100 + i, 0, 10 + i, 1, False) for v in ("k", None) for s in ("x", None) for i in range(4)]
    df = spark.createDataFrame(rows, "venue string, symbol string, row_ordinal long, event int, msg_index long, recv_wall long, venue_ts long, side int, price long, qty long, suspect boolean")
    assert book.with_position(book.with_epoch(df)).count() == len(rows)


def test_as_of_answers_null_entities(spark):
    seen = spark.createDataFrame([(e, 7 + i, 10 * i, 10 * i, i) for e in ("a", None) for i in range(4)], "entity string, value long, event_time long, available_at long, arrival long")
    asked = spark.createDataFrame([(e, t) for e in ("a", None) for t in (-1, 0, 15, 99, None)], "entity string, as_of long")
    got = {(r["entity"], r["as_of"]): (r["value"], r["freshness"]) for r in pit.as_of(seen, asked, 20, chunk=10).collect()}
    one = {-1: (None, "missing"), 0: (7, "fresh"), 15: (8, "fresh"), 99: (10, "stale"), None: (None, "missing")}
    assert got == {(e, t): x for e in ("a", None) for t, x in one.items()}
