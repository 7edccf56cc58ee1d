"""Registered queries over venue frames and feed validation, with their DuckDB SQL."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .catalog import _BASE, AT, HOUR, KEYS, START, rows
from .functions.expr import instant_text, render_decimal
from .operators import book, trust
from .plans.durable import materialize
from .registry import Registry
from .sources import tape, venues

_own = Registry()
query = _own.query

# The tape's messages as a venue would send them, to be read back.
_ROWS = " SELECT msg_index, CAST(row_number() OVER (PARTITION BY msg_index ORDER BY side, row_ordinal) - 1 AS INT) AS place, side, price, qty, {native} AS native, {seq} AS seq FROM tape"


def frames(spark, sf_dir, venue: str) -> DataFrame:
    """``msg_index, payload``: a frame per message of the tape in the form of ``venue``."""
    t = tape.recorded(spark, sf_dir)
    text = lambda c: render_decimal(F.col(c), 9)
    m = t.groupBy("msg_index").agg(F.max("event").alias("event"), F.max("recv_wall").alias("at"), F.sort_array(F.collect_list(F.struct("side", "row_ordinal", text("price").alias("price"), text("qty").alias("qty")))).alias("x"))
    n, at = F.col("msg_index"), F.col("at")

    def side(s: int, form) -> Column:
        return F.transform(F.filter("x", lambda u: u["side"] == s), form)

    pair = lambda u: F.array(u["price"], u["qty"])
    kind = F.when(F.col("event") == 0, "snapshot")
    if venue == "coinbase":
        up = F.transform("x", lambda u: F.struct(F.when(u["side"] == 0, "bid").otherwise("offer").alias("side"), u["price"].alias("price_level"), u["qty"].alias("new_quantity")))
        body = F.struct(F.lit("l2_data").alias("channel"), instant_text(at).alias("timestamp"), n.alias("sequence_num"), F.array(F.struct(kind.otherwise("update").alias("type"), F.lit("BTC-USD").alias("product_id"), up.alias("updates"))).alias("events"))
    elif venue == "kraken":
        number = lambda u: F.struct(u["price"].cast("decimal(28,9)").alias("price"), u["qty"].cast("decimal(28,9)").alias("qty"))
        body = F.struct(F.lit("book").alias("channel"), kind.otherwise("update").alias("type"), F.array(F.struct(F.lit("BTC/USD").alias("symbol"), side(0, number).alias("bids"), side(1, number).alias("asks"), (n * 7).alias("checksum"), instant_text(at).alias("timestamp"))).alias("data"))
    elif venue == "okx":
        body = F.struct(F.struct(F.lit("books").alias("channel"), F.lit("BTC-USDT").alias("instId")).alias("arg"), kind.otherwise("update").alias("action"), F.array(F.struct(side(0, pair).alias("bids"), side(1, pair).alias("asks"), F.expr("at div 1000000").cast("string").alias("ts"), n.alias("seqId"), (n - 1).alias("prevSeqId"))).alias("data"))
    elif venue == "bybit":
        body = F.struct(F.lit("orderbook.50.BTCUSDT").alias("topic"), kind.otherwise("delta").alias("type"), F.expr("at div 1000000").alias("ts"), F.struct(F.lit("BTCUSDT").alias("s"), side(0, pair).alias("b"), side(1, pair).alias("a"), n.alias("u"), (n * 3).alias("seq")).alias("data"))
    elif venue == "binance_us":
        levels = lambda s: F.to_json(side(s, pair))
        return m.select("msg_index", F.concat(F.lit('{"e":"depthUpdate","E":'), F.expr("at div 1000000"), F.lit(',"s":"BTCUSDT","U":'), n * 4, F.lit(',"u":'), n * 4 + 3, F.lit(',"b":'), levels(0), F.lit(',"a":'), levels(1), F.lit("}")).alias("payload"))
    else:
        body = F.struct(F.struct(F.expr("at div 1000000000").cast("string").alias("timestamp"), F.expr("at div 1000").cast("string").alias("microtimestamp"), side(0, pair).alias("bids"), side(1, pair).alias("asks")).alias("data"))
    return m.select("msg_index", F.to_json(body).alias("payload"))


def _read(spark, sf_dir, venue):
    return venues.to_rows(venues.parse(frames(spark, sf_dir, venue), venue), "msg_index").select("msg_index", "place", "side", "price", "qty", "native", "seq")


@query(_BASE + _ROWS.format(native="'BTC-USD'", seq="msg_index"))
def parse_coinbase(spark, sf_dir):
    return _read(spark, sf_dir, "coinbase")


@query(_BASE + _ROWS.format(native="'BTC/USD'", seq="CAST(NULL AS BIGINT)"))
def parse_kraken(spark, sf_dir):
    return _read(spark, sf_dir, "kraken")


@query(_BASE + _ROWS.format(native="'BTC-USDT'", seq="msg_index"))
def parse_okx(spark, sf_dir):
    return _read(spark, sf_dir, "okx")


@query(_BASE + _ROWS.format(native="'BTCUSDT'", seq="msg_index"))
def parse_bybit(spark, sf_dir):
    return _read(spark, sf_dir, "bybit")


@query(_BASE + _ROWS.format(native="'BTCUSDT'", seq="msg_index * 4 + 3"))
def parse_binance_us(spark, sf_dir):
    return _read(spark, sf_dir, "binance_us")


@query(_BASE + _ROWS.format(native="CAST(NULL AS VARCHAR)", seq="recv_wall // 1000"))
def parse_bitstamp(spark, sf_dir):
    return _read(spark, sf_dir, "bitstamp")


def sent_checksums(books: DataFrame, price_places: int, qty_places: int) -> DataFrame:
    """What a venue would send along with each message, by its own arithmetic over the shown levels; every 53rd message
    carries a wrong one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = lambda units, places: (str(units // 10 ** (9 - places)).lstrip("0") or "0")
        for b in batches:
            sums = []
            for index, asks, bids in zip(*(b.column(c).to_pylist() for c in ("msg_index", "asks", "bids")), strict=True):
                text = "".join(plain(x["price"], price_places) + plain(x["qty"], qty_places) for x in (*asks, *bids))
                sums.append(zlib.crc32(text.encode()) ^ (index % 53 == 0))
            yield pa.RecordBatch.from_arrays([b.column("venue"), b.column("symbol"), b.column("msg_index"), pa.array(sums, pa.int64())], ["venue", "symbol", "msg_index", "expected"])

    return books.select(*KEYS, "msg_index", "asks", "bids").mapInArrow(run, "venue string, symbol string, msg_index bigint, expected bigint")


@query()
def book_checksums(spark, sf_dir):
    books = materialize(book.shown(rows(spark, sf_dir), venues.CHECKSUM_LEVELS).where("bid_levels + ask_levels > 0"), "books")
    sent = sent_checksums(books, 2, 3)
    done = venues.checksums(book.levels_shown(books), [*KEYS, "msg_index"], 2, 3).join(sent, [*KEYS, "msg_index"])
    shallow = F.least("bid_levels", "ask_levels")
    return done.withColumn("verdict", venues.checksum_verdict(F.col("expected"), F.col("computed"), F.col("lossy"), shallow))


def _ranges(spark, sf_dir):
    """Updates with id ranges that overlap, repeat and skip, and a snapshot id for each snapshot message but the first."""
    i = F.expr("msg_index div 2")
    m = book.messages(rows(spark, sf_dir)).withColumn("i", i)
    last = i * 4 + 3 - F.when(i % 13 == 0, 8).otherwise(0)
    first = i * 4 - F.when(i % 7 == 0, 2).when(i % 11 == 0, -3).when(i % 13 == 0, 8).otherwise(0)
    updates = m.where("event = 1").select(*KEYS, "first_ordinal", "recv_wall", "suspect", first.alias("first_seq"), last.alias("seq"))
    anchors = m.where("event = 0 and i > 0").select(*KEYS, "first_ordinal", (i * 4 + 5).alias("snapshot_id"))
    return updates, anchors


_RANGE = _BASE + """, i AS (SELECT *, msg_index // 2 AS i FROM m), u AS (SELECT venue, symbol, first_ordinal, CASE WHEN event = 1 THEN i * 4 - CASE WHEN i % 7 = 0 THEN 2 WHEN i % 11 = 0 THEN -3 WHEN i % 13 = 0 THEN 8 ELSE 0 END END AS first_seq,
  CASE WHEN event = 1 THEN i * 4 + 3 - CASE WHEN i % 13 = 0 THEN 8 ELSE 0 END END AS seq, CASE WHEN event = 0 THEN i * 4 + 5 END AS sid, recv_wall, suspect FROM i WHERE event = 1 OR i > 0),
a AS (SELECT *, count(sid) OVER (PARTITION BY venue, symbol ORDER BY first_ordinal) AS an, last_value(sid IGNORE NULLS) OVER (PARTITION BY venue, symbol ORDER BY first_ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS base FROM u),
l AS (SELECT *, max(CASE WHEN seq > base THEN seq END) OVER (PARTITION BY venue, symbol, an ORDER BY first_ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last FROM a),
v AS (SELECT *, CASE WHEN base IS NULL THEN 'awaiting_snapshot' WHEN last IS NULL AND seq <= base THEN 'stale' WHEN seq <= last THEN 'duplicate' WHEN first_seq <= coalesce(last, base) + 1 THEN 'in_order' ELSE 'gap' END AS verdict FROM l WHERE sid IS NULL)"""


@query(_RANGE + " SELECT venue, symbol, first_ordinal, first_seq, seq, verdict, CASE WHEN verdict = 'gap' THEN first_seq - coalesce(last, base) - 1 ELSE 0 END AS missing FROM v")
def range_verdicts(spark, sf_dir):
    return trust.range_verdicts(*_ranges(spark, sf_dir))


@query(_RANGE + """, bj AS (SELECT *, suspect OR verdict IN ('gap', 'duplicate', 'stale') OR coalesce(recv_wall < lag(recv_wall) OVER (PARTITION BY venue, symbol ORDER BY first_ordinal), false) AS bad FROM v),
s AS (SELECT venue, symbol, min(first_ordinal) AS stop FROM bj WHERE bad GROUP BY ALL) SELECT venue, symbol, first_ordinal, verdict FROM bj LEFT JOIN s USING (venue, symbol) WHERE stop IS NULL OR first_ordinal < stop""")
def usable_prefix(spark, sf_dir):
    updates, anchors = _ranges(spark, sf_dir)
    judged = trust.range_verdicts(updates, anchors).join(updates.select(*KEYS, "first_ordinal", "recv_wall", "suspect"), [*KEYS, "first_ordinal"])
    return trust.first_violation(judged).select(*KEYS, "first_ordinal", "verdict")


@query(_BASE + f""", g AS (SELECT venue, symbol, unnest(generate_series({START - 6 * HOUR}, {START + 726 * HOUR}, {6 * HOUR})) AS t FROM (SELECT DISTINCT venue, symbol FROM m)),
lost AS (SELECT 'kraken' AS lv, {AT} AS lf, {AT + 30 * HOUR} AS lt UNION ALL SELECT 'coinbase', NULL, {START + 20 * HOUR}),
s AS (SELECT *, lag(recv_wall) OVER w AS bf, lead(recv_wall) OVER w AS af, row_number() OVER w AS n FROM m WINDOW w AS (PARTITION BY venue, symbol ORDER BY recv_wall, first_ordinal)),
k AS (SELECT *, coalesce(recv_wall - bf > {4 * HOUR}, false) OR EXISTS (SELECT 1 FROM lost WHERE lv = venue AND lt <= recv_wall AND lt > bf) AS brk FROM s),
f AS (SELECT *, coalesce(max(CASE WHEN event = 0 THEN n END) OVER w, 0) AS sn, coalesce(max(CASE WHEN brk THEN n END) OVER w, 0) AS br, coalesce(max(CASE WHEN suspect THEN n END) OVER w, 0) AS ta FROM k WINDOW w AS (PARTITION BY venue, symbol ORDER BY n)),
j AS (SELECT g.venue, g.symbol, g.t, max(f.n) AS n FROM g LEFT JOIN f ON f.venue = g.venue AND f.symbol = g.symbol AND f.recv_wall <= g.t GROUP BY ALL)
SELECT j.venue, j.symbol, j.t, CASE WHEN j.n IS NULL OR (f.af IS NULL AND j.t > f.recv_wall) OR (f.af - f.recv_wall > {4 * HOUR} AND j.t > f.recv_wall) OR EXISTS (SELECT 1 FROM lost WHERE lv = j.venue AND j.t < lt AND (lf IS NULL OR j.t > lf)) THEN 'missing'
  WHEN ta > 0 AND ta >= sn THEN 'invalid' WHEN sn = 0 OR sn < br THEN 'unknown' ELSE 'verified' END AS state FROM j LEFT JOIN f ON f.venue = j.venue AND f.symbol = j.symbol AND f.n = j.n""")
def grid_coverage(spark, sf_dir):
    m = book.messages(rows(spark, sf_dir))
    grid = m.select(*KEYS).distinct().withColumn("t", F.explode(F.sequence(F.lit(START - 6 * HOUR), F.lit(START + 726 * HOUR), F.lit(6 * HOUR))))
    lost = spark.createDataFrame([("kraken", AT, AT + 30 * HOUR), ("coinbase", None, START + 20 * HOUR)], "venue string, lost_from bigint, lost_to bigint")
    return trust.grid_coverage(m, grid, lost, True, 4 * HOUR)


queries, oracle_sql = _own.queries, _own.oracle_sql
