"""Registered queries against DuckDB, folds against the declarative books, archives and streams end to end."""

import math
import os
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tidebook import catalog
from tidebook.functions import expr
from tidebook.operators import book, trust
from tidebook.plans import running
from tidebook.sources import tape
from tidebook.streaming import features

DATA = "/root/testdata/sf0.001"
CHECKED = ["derived_tape", "messages", "top_of_book", "replay_fold", "depth_top5", "bars_1h", "asof_observation", "coverage_grid", "counter_verdicts", "suspect_windows", "panel_grid", "instants", "hac_t"]


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in os.listdir(DATA):
        con.execute(f"create view {t.split('.')[0]} as select * from '{DATA}/{t}'")
    got = catalog.queries()[name](spark, DATA)
    want = con.execute(catalog.oracle_sql()[name])
    order = [d[0] for d in want.description]
    assert sorted(order) == sorted(got.columns)
    assert sorted(map(str, (tuple(r) for r in got.select(order).collect()))) == sorted(map(str, want.fetchall()))


def test_limited_feed_forgets_levels():
    deep, shallow = book.LevelBook(), book.LevelBook(2)
    for b in (deep, shallow):
        for message in ([(0, 10, 1), (0, 9, 1), (1, 11, 1)], [(0, 12, 1), (0, 10, 0)], [(0, 13, 1)], [(0, 13, 0), (0, 12, 0)]):
            for change in message:
                b.set(*change)
            b.trim()
    assert deep.prices[0] == [9] and shallow.prices[0] == []
    assert deep.digest("BTC-USD") != shallow.digest("BTC-USD")


def plain_books(rows, limit=None):
    """(venue, msg_index) -> (bids, asks), best first, by a fold over rows in arrival order."""
    books, told, last = {}, {}, {}
    for r in rows:
        own = books.setdefault(r["venue"], ({}, {}))
        if r["event"] == 0 and last.get(r["venue"], (1, None)) != (0, r["msg_index"]) and last.get(r["venue"], (1,))[0] != 0:
            own[0].clear(), own[1].clear()
        last[r["venue"]] = (r["event"], r["msg_index"])
        side = own[r["side"]]
        if r["qty"] > 0:
            side[r["price"]] = r["qty"]
        elif r["qty"] == 0:
            side.pop(r["price"], None)
        told[r["venue"], r["msg_index"]] = tuple(sorted(x.items(), reverse=i == 0) for i, x in enumerate(own))
    return told


def test_blocks_are_the_fold(spark):
    """Small blocks, so that most books begin with carried levels; snapshots only now and then; an index that starts over."""
    rows = tape.derived_tape(spark, DATA).withColumn("event", F.expr("case when msg_index in (0, 1, 100, 101) then 0 else 1 end"))
    want = plain_books(rows.orderBy("row_ordinal").collect())
    ready = book.with_position(rows)
    for block in (7, 4096):
        got = {(r["venue"], r["msg_index"]): r for r in book.shown(ready, 3, within=50_000_000, digest=True, block=block).collect()}
        assert got.keys() == want.keys()
        for k, (bids, asks) in want.items():
            r = got[k]
            assert [tuple(x) for x in r["bids"]] == bids[:3] and [tuple(x) for x in r["asks"]] == asks[:3] and (r["bid_levels"], r["ask_levels"]) == (len(bids), len(asks))
            whole = b"".join([b"BTC-USD", *(x for tag, side in ((b"B", bids), (b"A", asks)) for x in (tag, *(n.to_bytes(8, "little", signed=True) for level in side for n in level)))])
            assert r["digest"] == zlib.crc32(whole)
            if bids and asks:
                mid = (bids[0][0] + asks[0][0]) // 2
                assert (r["bid_within"], r["ask_within"]) == (sum(q for p, q in bids if p >= mid - 50_000_000), sum(q for p, q in asks if p <= mid + 50_000_000))
    again = rows.withColumn("msg_index", F.col("msg_index") % 100)
    assert book.messages(book.with_position(again)).count() == len(want)
    plan = book.shown(ready)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_limited_replay_streams_an_epoch(spark):
    rows = book.with_position(tape.derived_tape(spark, DATA))
    got = {(r["venue"], r["msg_index"]): tuple(r)[3:] for r in book.replay(rows, 2).collect()}
    books, last = {}, {}
    for r in rows.orderBy("row_ordinal").collect():
        k = (r["venue"], r["msg_index"])
        if last.get(r["venue"], k) != k:
            books[r["venue"]].trim()
            b = books[r["venue"]]
            n = len(b.prices[0]), len(b.prices[1])
            assert got[last[r["venue"]]] == ((b.best(0, 1) or [None])[0], (b.best(1, 1) or [None])[0], *n, b.digest("BTC-USD"))
        if r["event"] == 0 and last.get(r["venue"]) != k:
            books[r["venue"]] = book.LevelBook(2)
        last[r["venue"]] = k
        books.setdefault(r["venue"], book.LevelBook(2)).set(r["side"], r["price"], r["qty"])


def test_running_values_cross_chunks(spark):
    rng = random.Random(2)
    data = [(i % 3, i * 7, rng.choice([None, rng.randrange(50)])) for i in range(200)]
    df = spark.createDataFrame(data, "k int, o long, v long")
    v = F.col("v")
    got = running.before(df, ["k"], "o", 40, top=("max", v), total=("sum", v), last=("last", v), lag=("lag", v))
    got = running.after(got, ["k"], "o", 40, next=("lag", v), coming=("last", v))
    assert got.columns == ["k", "o", "v", "top", "total", "last", "lag", "next", "coming"]
    for r in got.collect():
        past = [x for k, o, x in data if k == r["k"] and o < r["o"]]
        ahead = [x for k, o, x in data if k == r["k"] and o > r["o"]]
        seen = [x for x in past if x is not None]
        want = (max(seen, default=None), sum(seen) if seen else None, seen[-1] if seen else None, past[-1] if past else None, ahead[0] if ahead else None, next((x for x in ahead if x is not None), None))
        assert tuple(r)[3:] == want


def test_archive_scans_prune(spark):
    at = catalog.START + 48 * catalog.HOUR
    plan = tape.recorded(spark, DATA, at, at + 24 * catalog.HOUR).select("venue", "price")._jdf.queryExecution().toString()
    scan = plan[plan.rindex("== Physical Plan"):]
    assert f"GreaterThan(recv_wall,{at})" in scan and "LessThanOrEqual(recv_wall," in scan and "date#" in scan[scan.index("PartitionFilters") : scan.index("PushedFilters")]
    assert "ReadSchema: struct<recv_wall:bigint,price:bigint>" in scan


def test_quantiles_and_buckets(spark):
    rng = random.Random(4)
    values = [rng.choice((-1, 1)) * int(10 ** rng.uniform(0, 12)) for _ in range(500)] + [0, 0, 5, 5, 5]
    df = spark.createDataFrame([("v", "s", x) for x in values] + [("v", "t", 3)], "venue string, symbol string, x long")
    order = sorted(values)
    row = trust.quantile_ranks(df, "x", ["venue", "symbol"], [0.0, 0.5, 0.9, 1.0]).where("symbol = 's'").first()
    assert tuple(row)[2:] == tuple(order[math.floor(q * (len(order) - 1) + 0.5)] for q in (0.0, 0.5, 0.9, 1.0))
    hist = trust.histogram(df, "x", ["venue", "symbol"])
    halves = trust.merged(trust.histogram(df.where("x >= 0"), "x", ["venue", "symbol"]), trust.histogram(df.where("x < 0"), "x", ["venue", "symbol"]), ["venue", "symbol"])
    assert sorted(map(str, hist.collect())) == sorted(map(str, halves.collect()))
    told = trust.latency_summary(hist, ["venue", "symbol"]).where("symbol = 's'").first()
    assert (told["count"], told["negative"], told["min_ns"], told["max_ns"]) == (len(values), sum(x < 0 for x in values), min(values), max(values))
    exact = order[math.ceil(0.5 * len(order)) - 1]
    assert abs(told["p50_ns"]) <= abs(exact) and abs(exact - told["p50_ns"]) <= abs(exact) / 8


def test_scalars(spark):
    row = spark.range(1).select(
        expr.parse_decimal(F.lit("1e-9")).alias("a"), expr.parse_decimal(F.lit("0.0000000001")).alias("b"), expr.render_decimal(F.lit(1_500_000_000), 0).alias("c"),
        expr.midpoint(F.lit(-3), F.lit(0)).alias("d"), expr.floor_bucket(F.lit(-1), 1000).alias("e"), expr.parse_instant(F.lit("1970-01-01T01:00:00.5+01:00")).alias("f"),
        expr.base_of(F.lit("btc/usd")).alias("g"), expr.fits(F.lit(1_230_000_000), 1).alias("h"), expr.parse_instant(F.lit("nonsense")).alias("i"),
    ).first()
    assert tuple(row) == (1, None, "2", -1, -1000, 500_000_000, "BTC", False, None)


def test_archive_and_manifest(spark, tmp_path):
    rows = tape.derived_tape(spark, DATA)
    tape.write_archive(rows, f"{tmp_path}/a", rows_per_file=100)
    at = catalog.START + 48 * catalog.HOUR
    got = tape.read_archive(spark, f"{tmp_path}/a", at, at + 24 * catalog.HOUR, rows.columns)
    want = rows.where((F.col("recv_wall") > at) & (F.col("recv_wall") <= at + 24 * catalog.HOUR))
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    tape.compact(spark, f"{tmp_path}/a", f"{tmp_path}/b")
    assert spark.read.parquet(f"{tmp_path}/b").count() == rows.count()
    lines = ['{"kind":"file","path":"x","venue":"k","rows":5}', '{"kind":"file","path":"y","venue":"k","rows":6}', '{"kind":"compaction","produced":{"path":"z","rows":11},"retired":["x","y"]}', '{"kind":"file","path":"w","rows":1}', '{"kind":"fi']
    (tmp_path / "m.jsonl").write_text("\n".join(lines))
    assert sorted((r["path"], r["rows"]) for r in tape.read_manifest(spark, f"{tmp_path}/m.jsonl").collect()) == [("w", 1), ("z", 11)]
    (tmp_path / "m.jsonl").write_text("\n".join([lines[0], lines[4], lines[1]]))
    with pytest.raises(ValueError, match="middle"):
        tape.read_manifest(spark, f"{tmp_path}/m.jsonl")
    log = tmp_path / "log"
    log.mkdir()
    (log / "000.jsonl").write_text("\n".join([lines[0], lines[1], '{"kind":"retention","removed":["x"]}']) + "\n")
    (log / "001.jsonl").write_text("\n".join([lines[0], *['{"kind":"file","path":"a","rows":2}'] * 400, lines[4]]))
    assert sorted(r["path"] for r in tape.read_manifest(spark, str(log)).collect()) == ["a", "x", "y"]


@pytest.mark.parametrize("late", [False, True])
def test_stream_and_batch(spark, tmp_path, late):
    """In order nothing is dropped and the stream is the batch; a last file of old rows is dropped and accounted for."""
    rows = tape.derived_tape(spark, DATA).orderBy("row_ordinal").limit(400).cache()
    parts = [rows.where((F.col("row_ordinal") >= 200 * i) & (F.col("row_ordinal") < 200 * i + 220)) for i in range(2)]
    if late:
        parts.append(rows.where("row_ordinal < 50").withColumn("row_ordinal", F.col("row_ordinal") + 10_000))
    for i, part in enumerate(parts):
        features.payloads(part).select("value").coalesce(1).write.text(f"{tmp_path}/in/{i}")
    progress = features.run_revisions(spark, f"{tmp_path}/in/*", f"{tmp_path}/sink", f"{tmp_path}/check", "10 minutes")
    latest = features.latest_revisions(features.committed(spark, f"{tmp_path}/sink")).drop("batch_id")
    want = features.window_features(rows, "10 minutes")
    assert sum(p["rows"] for p in progress) == 420 + 50 * late
    dropped = sum(p["dropped"] for p in progress)
    assert (dropped > 0) == late
    told = features.accounting(parts[0].unionByName(parts[1]) if not late else parts[0].unionByName(parts[1]).unionByName(parts[2]), latest, dropped).first()
    assert told["balanced"]
    if not late:
        assert latest.select(want.columns).exceptAll(want).count() == 0 and latest.count() == want.count()
        os.remove(f"{tmp_path}/sink/batch_id=0/_SUCCESS")
        assert 0 not in {r["batch_id"] for r in features.committed(spark, f"{tmp_path}/sink").select("batch_id").distinct().collect()}
