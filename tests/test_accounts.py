"""Accounts: registered queries against DuckDB, and what SQL can't say against plain versions."""


import duckdb
import pytest
from pyspark.sql import functions as F

from tidebook import catalog_accounts
from tidebook.functions import expr
from tidebook.operators import accounts, research
from tidebook.plans import running
from tidebook.sources import raw, tape, venues
from tidebook.streaming import features

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog_accounts.oracle_sql()))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{DATA}/events.parquet'")
    got = catalog_accounts.queries()[name](spark, DATA)
    want = con.execute(catalog_accounts.oracle_sql()[name])
    order = [d[0] for d in want.description]
    assert sorted(order) == sorted(got.columns)
    assert sorted(map(str, (tuple(r) for r in got.select(order).collect()))) == sorted(map(str, want.fetchall()))


def test_rolling_checksum_resumes(spark):
    values = [(i, (i * 7919) ** 2 * 10**5 - 10**9) for i in range(500)]
    df = spark.createDataFrame(values, "o long, v long").repartition(5)
    wrap = lambda x: (x + (1 << 63)) % (1 << 64) - (1 << 63)
    want = 0
    for _, v in values:
        want = wrap(want * 31 + v)
    whole = accounts.rolling_checksum(df, "o", F.col("v"), chunk=37).first()
    assert tuple(whole) == (500, want, 500)
    first = accounts.rolling_checksum(df.where("o < 210"), "o", F.col("v"), chunk=37).first()
    rest = accounts.rolling_checksum(df, "o", F.col("v"), (first["resume_at"], first["checksum"]), chunk=37).first()
    assert tuple(rest) == (290, want, 500)
    assert tuple(accounts.rolling_checksum(df.limit(0), "o", F.col("v")).first()) == (0, 0, 0)


def test_stability_leaves_out_what_cannot_be_judged(spark):
    rows = [("k", "s", "b", 0, 1.0, True, True, False), ("k", "s", "b", 1, -2.0, True, True, False), ("k", "s", "b", 2, 9.0, None, True, False), ("k", "s", "b", 3, 9.0, True, False, False), ("k", "s", "b", 4, 9.0, True, True, None)]
    stats, out = accounts.stability(spark.createDataFrame(rows, "venue string, strategy string, symbol string, window int, pnl double, verifiable boolean, held boolean, truncated boolean"))
    assert [tuple(r) for r in stats.collect()] == [("k", "s", "b", 2, 1, -1.0, -2.0, 1.0, 0, "insufficient_windows")]
    assert dict(map(tuple, out.collect())) == {"unverifiable": 1, "risk_not_held": 1, "truncated": 1}


def test_raw_frames_round_trip(spark, tmp_path):
    sent = tape.derived_tape(spark, DATA).select("msg_index").distinct()
    bare = sent.select(F.dense_rank().over(running.Window.orderBy("msg_index")).alias("n"), F.concat(F.lit('{"e":"depthUpdate","E":1,"s":"BTCUSDT","U":1,"u":2,"b":[["1.5","'), F.col("msg_index"), F.lit('"]],"a":[]}')).alias("payload"))
    frames = raw.bare_payloads(bare, "binance_us", "n")
    raw.write_frames(frames, f"{tmp_path}/raw")
    back = raw.read_frames(spark, f"{tmp_path}/raw")
    assert back.where("bad").count() == 0 and back.drop("bad").exceptAll(frames).count() == 0 and back.count() == frames.count()
    assert venues.to_rows(venues.parse(back.select("t_mono", "payload"), "binance_us"), "t_mono").count() == frames.count()
    assert raw.without(bare, "n", [1, 2]).count() == bare.count() - 2
    (tmp_path / "torn").write_text('{"venue":"x","t_mono":1,"t_wall":1,"payload":"p"}\n{"venue":"x","t_mo')
    assert sorted(r["bad"] for r in raw.read_frames(spark, f"{tmp_path}/torn").collect()) == [False, True]


def test_small_rules(spark):
    row = spark.range(1).select(
        expr.checked_sum(F.lit(2**63 - 1), F.lit(1)).alias("a"), expr.checked_difference(F.lit(-(2**63) + 1), F.lit(5)).alias("b"), expr.parse_float(F.lit(0.1)).alias("c"),
        expr.venue_of(F.lit("Binance")).alias("d"), expr.venue_of(F.lit("else")).alias("e"), expr.partition_of_path(F.lit("a/venue=kraken/symbol=btc-usd/x.parquet")).alias("f"),
    ).first()
    assert tuple(row) == (None, None, 100_000_000, "binance_us", None, None)
    a, b = (spark.createDataFrame(x, "day int, venue string, mse double") for x in ([(1, "k", 2.0), (2, "k", 3.0)], [(1, "k", 2.5)]))
    assert [r["delta"] for r in research.paired(a, b, ["day", "venue"], "mse").collect()] == [0.5]
    sink = spark.createDataFrame([("k", "s", 0, 5), ("k", "s", 1, 6)], "venue string, symbol string, window_start long, rows long")
    other = spark.createDataFrame([("k", "s", 0, 4), ("k", "s", 2, 6)], sink.schema)
    assert dict(map(tuple, features.compare_sinks(sink, other, ["venue", "symbol", "window_start"]).collect())) == {"rows": 1, "missing": 1, "extra": 1}
