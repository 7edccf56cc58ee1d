"""Venue frames: JSON of six order-book feeds to events and rows, and the checksum that one of them sends along.

Numbers are read as text, so that prices and sizes keep every digit.  A frame that is no book frame is a control frame;
one that is no JSON is malformed: both stay in :func:`classify` and give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expr import fits, parse_decimal, parse_instant, render_decimal

# What each venue publishes about loss, and in which order.
CAPABILITIES = (
    ("coinbase", "counter", "connection", True),
    ("kraken", "checksum", "symbol", True),
    ("okx", "chain", "symbol", True),
    ("bybit", "counter", "symbol", True),
    ("binance_us", "range", "symbol", True),
    ("bitstamp", "timestamp", "symbol", False),
)
CHECKSUM_LEVELS = 10
PAIR = "array<array<string>>"
SHAPES = {
    "coinbase": "channel string, timestamp string, sequence_num bigint, events array<struct<type:string,product_id:string,updates:array<struct<side:string,event_time:string,price_level:string,new_quantity:string>>>>",
    "kraken": "channel string, type string, data array<struct<symbol:string,bids:array<struct<price:string,qty:string>>,asks:array<struct<price:string,qty:string>>,checksum:bigint,timestamp:string>>",
    "okx": f"arg struct<channel:string,instId:string>, action string, data array<struct<bids:{PAIR},asks:{PAIR},ts:string,seqId:bigint,prevSeqId:bigint>>",
    "bybit": f"topic string, type string, ts bigint, data struct<s:string,b:{PAIR},a:{PAIR},u:bigint,seq:bigint>",
    "binance_us": f"e string, E bigint, s string, U bigint, u bigint, b {PAIR}, a {PAIR}",
    "bitstamp": f"channel string, event string, data struct<timestamp:string,microtimestamp:string,bids:{PAIR},asks:{PAIR}>",
}
_LEVEL = "array<struct<side:int,price:string,qty:string>>"


def capabilities(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CAPABILITIES, "venue string, scheme string, scope string, can_detect_loss boolean")


def _none(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _pairs(levels: Column, side: int) -> Column:
    return F.transform(F.coalesce(levels, F.array().cast(PAIR)), lambda x: F.struct(F.lit(side).alias("side"), F.get(x, F.lit(0)).alias("price"), F.get(x, F.lit(1)).alias("qty")))


def _both(bids: Column, asks: Column) -> Column:
    return F.concat(_pairs(bids, 0), _pairs(asks, 1))


def _event(name: Column) -> Column:
    return F.when(name == "snapshot", 0).when(name == "update", 1).when(name == "delta", 1)


def parse(frames: DataFrame, venue: str, payload: str = "payload") -> DataFrame:
    """Book events of one venue's frames: the frame's other columns, then ``venue, native, event, venue_ts, seq, first_seq,
    prev_seq, checksum, levels``; a frame can hold several.  ``levels`` are (side, price, qty) as sent, in their order."""
    kept = [c for c in frames.columns if c != payload]
    # A feed may write a field in either letter case beside another (U, u): names are told apart by JSON path there.
    if venue == "binance_us":
        at = lambda k: F.get_json_object(payload, f"$.{k}")
        f = frames.select(*kept, F.struct(at("e").alias("e"), at("E").cast("bigint").alias("ms"), at("s").alias("s"), at("U").cast("bigint").alias("first"), at("u").cast("bigint").alias("last"), F.from_json(at("b"), PAIR).alias("b"), F.from_json(at("a"), PAIR).alias("a")).alias("f"))
    else:
        f = frames.select(*kept, F.from_json(payload, SHAPES[venue]).alias("f"))
    null = _none("bigint")
    if venue == "coinbase":
        rows = f.where("f.channel = 'l2_data'").select(*kept, "f", F.explode("f.events").alias("x"))
        levels = F.transform(F.coalesce("x.updates", F.array().cast("array<struct<side:string,event_time:string,price_level:string,new_quantity:string>>")), lambda u: F.struct(F.when(u["side"] == "bid", 0).when(u["side"].isin("offer", "ask"), 1).alias("side"), u["price_level"].alias("price"), u["new_quantity"].alias("qty")))
        out = [F.col("x.product_id"), _event(F.col("x.type")), parse_instant(F.col("f.timestamp")), F.col("f.sequence_num"), null, null, null, levels]
    elif venue == "kraken":
        rows = f.where("f.channel = 'book'").select(*kept, "f", F.explode("f.data").alias("x"))
        named = lambda c, side: F.transform(F.coalesce(c, F.array().cast("array<struct<price:string,qty:string>>")), lambda u: F.struct(F.lit(side).alias("side"), u["price"].alias("price"), u["qty"].alias("qty")))
        out = [F.col("x.symbol"), _event(F.col("f.type")), parse_instant(F.col("x.timestamp")), null, null, null, F.col("x.checksum"), F.concat(named(F.col("x.bids"), 0), named(F.col("x.asks"), 1))]
    elif venue == "okx":
        rows = f.where("f.data is not null and f.arg.channel like 'books%'").select(*kept, "f", F.explode("f.data").alias("x"))
        begins = F.when(F.col("x.prevSeqId") >= 0, F.col("x.prevSeqId"))
        out = [F.col("f.arg.instId"), _event(F.col("f.action")), F.col("x.ts").cast("bigint") * 1_000_000, F.col("x.seqId"), null, begins, null, _both(F.col("x.bids"), F.col("x.asks"))]
    elif venue == "bybit":
        rows = f.where("f.data is not null and f.topic like 'orderbook.%'")
        out = [F.col("f.data.s"), _event(F.col("f.type")), F.col("f.ts") * 1_000_000, F.col("f.data.u"), null, null, null, _both(F.col("f.data.b"), F.col("f.data.a"))]
    elif venue == "binance_us":
        rows = f.where("f.e = 'depthUpdate'")
        out = [F.col("f.s"), F.lit(1), F.col("f.ms") * 1_000_000, F.col("f.last"), F.col("f.first"), null, null, _both(F.col("f.b"), F.col("f.a"))]
    elif venue == "bitstamp":
        rows = f.where("f.data.microtimestamp is not null and f.data.bids is not null")
        stamp = F.col("f.data.microtimestamp").cast("bigint")
        out = [_none("string"), F.lit(1), stamp * 1000, stamp, null, null, null, _both(F.col("f.data.bids"), F.col("f.data.asks"))]
    else:
        raise ValueError(f"unknown venue {venue}")
    names = ["native", "event", "venue_ts", "seq", "first_seq", "prev_seq", "checksum", "levels"]
    return rows.select(*kept, F.lit(venue).alias("venue"), *[c.alias(n) for c, n in zip(out, names, strict=True)]).where("event is not null")


def classify(frames: DataFrame, payload: str = "payload") -> DataFrame:
    """Frames with their ``kind``: malformed or json."""
    return frames.withColumn("kind", F.when(F.get_json_object(payload, "$").isNull(), "malformed").otherwise("json"))


def to_rows(parsed: DataFrame, index: str) -> DataFrame:
    """A row per level with exact ``price`` and ``qty``; a level whose number has too many digits has ``bad`` true.

    ``index`` names the column that orders frames; ``place`` orders the levels of one."""
    rows = parsed.select(*[c for c in parsed.columns if c != "levels"], F.posexplode("levels").alias("place", "x"))
    price, qty = parse_decimal(F.col("x.price")), parse_decimal(F.col("x.qty"))
    rows = rows.withColumn("side", F.col("x.side")).withColumn("price", price).withColumn("qty", qty).drop("x")
    return rows.withColumn("bad", F.col("price").isNull() | F.col("qty").isNull() | F.col("side").isNull())


def canonical_symbol(native: Column, quotes: tuple[str, ...] = ("USDT", "USDC", "USD", "EUR", "BTC")) -> Column:
    """BASE-QUOTE of a venue's spelling; null where a spelling without a mark could be split in more than one way, or none."""
    plain = F.upper(F.regexp_replace(native, "[-/_]", "-"))
    ends = F.filter(F.array(*[F.lit(q) for q in quotes]), lambda q: F.endswith(plain, q) & (F.length(plain) > F.length(q)))
    one = F.get(ends, F.lit(0))
    return F.when(F.contains(plain, F.lit("-")), plain).when(F.size(ends) == 1, F.concat(F.substring(plain, F.lit(1), F.length(plain) - F.length(one)), F.lit("-"), one))


def _digits(units: Column, places: int) -> Column:
    bare = F.ltrim(F.regexp_replace(render_decimal(units, places), "[^0-9]", ""), F.lit("0"))
    return F.when(bare == "", "0").otherwise(bare)


def checksums(levels: DataFrame, keys: list[str], price_places: int, qty_places: int) -> DataFrame:
    """``computed, lossy, bid_levels, ask_levels`` per book of ``keys`` from its live levels.

    CRC-32 over the ten best asks, then bids, best first: price then size at their places, without point or leading zeros.
    A level that its places can't hold is lossy.
    """
    w = Window.partitionBy(*keys, "side").orderBy(F.when(F.col("side") == 0, -F.col("price")).otherwise(F.col("price")))
    top = levels.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= CHECKSUM_LEVELS)
    token = F.concat(_digits(F.col("price"), price_places), _digits(F.col("qty"), qty_places))
    lossy = (~fits(F.col("price"), price_places)).cast("int") + (~fits(F.col("qty"), qty_places)).cast("int")
    rows = top.withColumn("token", token).withColumn("lossy", lossy)
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("side")).alias("s"), "rank", "token"))), lambda x: x["token"]), "")
    return rows.groupBy(*keys).agg(F.crc32(text.cast("binary")).alias("computed"), F.sum("lossy").alias("lossy"), F.count_if(F.col("side") == 0).alias("bid_levels"), F.count_if(F.col("side") == 1).alias("ask_levels"))


def checksum_verdict(expected: Column, computed: Column, lossy: Column, shallow: Column) -> Column:
    """A lossy book can't be judged; one of fewer levels than the sum covers only if it agrees."""
    return F.when(lossy > 0, "unverifiable").when(computed == expected, "in_order").when(shallow < CHECKSUM_LEVELS, "unverifiable").otherwise("divergence")
