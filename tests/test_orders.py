"""Order books: registered queries against DuckDB, and the windows against the fold."""

import duckdb
import pytest

from plain_orders import OrderBook
from tidebook import catalog_orders
from tidebook.operators import orders
from tidebook.sources.order_tape import derived_orders

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog_orders.queries()))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{DATA}/events.parquet'")
    got = catalog_orders.queries()[name](spark, DATA)
    want = con.execute(catalog_orders.oracle_sql()[name])
    order = [d[0] for d in want.description]
    assert sorted(order) == sorted(got.columns)
    have = sorted(map(str, (tuple(r) for r in got.select(order).collect())))
    assert have == sorted(map(str, want.fetchall())) and have


def test_windows_agree_with_the_fold(spark):
    events = derived_orders(spark, DATA)
    done = orders.applied(events)
    said = {r["ordinal"]: (r["outcome"], r["traded"]) for r in done.collect()}
    books, told = {}, {}
    for r in events.orderBy("ordinal").collect():
        own = books.setdefault(r["venue"], OrderBook())
        told[r["ordinal"]] = own.apply(r["action"], r["order_id"], r["side"], r["price"], r["qty"], r["executed"])
    assert said == told
    rows = orders.queues(done, 10**9).collect()
    names = ("observed", "seeded", "unknown")
    assert {(r["venue"], r["order_id"]): (r["position"], r["qty_ahead"], r["certainty"]) for r in rows} == {
        (v, n): (*b.position(n)[:2], names[b.position(n)[2]]) for v, b in books.items() for n in b.orders
    }
    assert sum(1 for r in rows if r["certainty"] == "unknown") and any(r["position"] for r in rows)


def test_seeded_orders_are_pruned_until_uncrossed():
    b = OrderBook()
    b.seed([("a", 0, 10, 5), ("b", 0, 9, 5), ("c", 1, 11, 5), ("zero", 1, 12, 0)])
    assert b.apply("add", "d", 1, 9, 2) == ("applied", None) and b.crossed()
    assert b.prune_seeded() == 1 and not b.crossed() and b.best(0) == 9
    assert b.position("b") == (0, 0, orders.SEEDED) and b.position("zero") is None
    b.apply("add", "e", 0, 9, 1)
    assert b.position("e") == (1, 5, orders.SEEDED)
    assert b.apply("execute", "b", 0, 9, 0, 7) == ("applied", 5)
    assert b.apply("modify", "none", 0, 9, 1) == ("unknown_order", None) and b.position("e")[2] == orders.UNKNOWN
