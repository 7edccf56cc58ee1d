"""Venue frames and feed validation: queries against DuckDB, checksums against zlib, parsers on odd frames."""

import os
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tidebook import catalog_feeds
from tidebook.operators import trust
from tidebook.sources import tape, venues

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog_feeds.oracle_sql()))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in os.listdir(DATA):
        con.execute(f"create view {t.split('.')[0]} as select * from '{DATA}/{t}'")
    got = catalog_feeds.queries()[name](spark, DATA)
    want = con.execute(catalog_feeds.oracle_sql()[name])
    order = [d[0] for d in want.description]
    assert sorted(order) == sorted(got.columns)
    have = sorted(map(str, (tuple(r) for r in got.select(order).collect())))
    assert have == sorted(map(str, want.fetchall())) and have


def test_checksum_by_hand(spark):
    unit = 10**9
    levels = [("x", 1, 101 * unit, 2_340_000), ("x", 1, 102 * unit, unit), ("x", 0, 100_500_000_000, 5 * unit), ("x", 0, 99 * unit, 1)]
    row = venues.checksums(spark.createDataFrame(levels, "k string, side int, price bigint, qty bigint"), ["k"], 1, 8).first()
    assert row["computed"] == zlib.crc32(b"1010" b"234000" b"1020" b"100000000" b"1005" b"500000000" b"990" b"0")
    assert (row["lossy"], row["bid_levels"], row["ask_levels"]) == (1, 2, 2)


def test_checksums_of_every_message(spark):
    from test_engine import plain_books

    books = plain_books(tape.derived_tape(spark, DATA).orderBy("row_ordinal").collect())
    seen = set()
    for r in catalog_feeds.book_checksums(spark, DATA).collect():
        bids, asks = (x[:10] for x in books[r["venue"], r["msg_index"]])
        sum_ = zlib.crc32("".join((f"{p // 10**7}".lstrip("0") or "0") + (f"{q // 10**6}".lstrip("0") or "0") for p, q in (*asks, *bids)).encode())
        wrong = r["msg_index"] % 53 == 0
        assert r["computed"] == sum_ and (r["expected"] == sum_) != wrong
        assert r["verdict"] == ("in_order" if not wrong else "divergence" if min(len(bids), len(asks)) >= 10 else "unverifiable")
        seen.add(r["verdict"])
    assert seen == {"in_order", "divergence", "unverifiable"}


def test_odd_frames_give_no_rows(spark):
    odd = ["", "{", "null", "[]", '{"channel":"heartbeat"}', '{"channel":"subscriptions","sequence_num":3,"events":[{"subscriptions":{"level2":["BTC-USD"]}}]}', '{"e":"trade"}', '{"data":{}}', '{"topic":"tickers","data":{"s":"x"}}', None]
    frames = spark.createDataFrame([(i, x) for i, x in enumerate(odd)], "n int, payload string")
    for venue in venues.SHAPES:
        assert venues.to_rows(venues.parse(frames, venue), "n").count() == 0
    kinds = {r["n"]: r["kind"] for r in venues.classify(frames).collect()}
    assert kinds[1] == kinds[0] == kinds[9] == "malformed" and kinds[4] == "json"
    fine = spark.createDataFrame([(0, '{"e":"depthUpdate","E":5,"s":"BTCUSDT","U":7,"u":9,"b":[["1.5","0"],["1.0000000001","1"]],"a":[]}')], "n int, payload string")
    got = venues.to_rows(venues.parse(fine, "binance_us"), "n").orderBy("place").collect()
    assert [(r["first_seq"], r["seq"], r["side"], r["price"], r["qty"], r["bad"]) for r in got] == [(7, 9, 0, 1_500_000_000, 0, False), (7, 9, 0, None, 10**9, True)]


def test_symbols(spark):
    said = ["btc/usd", "BTCUSDT", "ETH_BTC", "USD", "WEIRD", None]
    rows = spark.createDataFrame([(x,) for x in said], "s string").select(venues.canonical_symbol(F.col("s")).alias("c")).collect()
    assert [r["c"] for r in rows] == ["BTC-USD", "BTC-USDT", "ETH-BTC", None, None, None]


def test_verdict_groups(spark):
    rows = spark.createDataFrame([("gap",), ("stale",), ("in_order",)], "v string").select(trust.is_loss(F.col("v")).alias("a"), trust.applies(F.col("v")).alias("b")).collect()
    assert [tuple(r) for r in rows] == [(True, True), (False, False), (False, True)]
