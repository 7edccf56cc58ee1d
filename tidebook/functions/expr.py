"""Exact scalar expressions: fixed-point money in 1e-9 units, nanosecond instants, symbols, costs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = 1_000_000_000
DAY = 86_400 * UNIT


def parse_decimal(text: Column) -> Column:
    """A decimal string, plain or scientific, as 1e-9 units; null if it needs more digits or overflows."""
    units = text.try_cast("decimal(38,18)") * F.lit(UNIT).cast("decimal(10,0)")
    whole = units.try_cast("bigint")
    return F.when(units == whole, whole)


def render_decimal(units: Column, places: int) -> Column:
    """Units as a decimal string with that many places, halves away from zero."""
    return F.round(units.cast("decimal(28,9)") / F.lit(UNIT).cast("decimal(10,0)"), places).cast(f"decimal(28,{places})").cast("string")


def fits(units: Column, places: int) -> Column:
    return F.pmod(units, F.lit(10 ** (9 - places))) == 0


def midpoint(bid: Column, ask: Column) -> Column:
    """Half the sum, cut toward zero; exact where the sum passes a long."""
    total = bid.cast("decimal(38,0)") + ask.cast("decimal(38,0)")
    return F.when(total >= 0, F.floor(total / 2)).otherwise(F.ceil(total / 2)).cast("bigint")


def floor_bucket(at: Column, width: int) -> Column:
    """The start of the interval that holds an instant, also before the epoch."""
    return at - F.pmod(at, F.lit(width))


def instant_text(ns: Column) -> Column:
    """RFC 3339 in UTC with nine digits."""
    seconds = (ns - F.pmod(ns, F.lit(UNIT))) / F.lit(UNIT)
    stamp = F.date_format(F.timestamp_seconds(seconds.cast("bigint")), "yyyy-MM-dd'T'HH:mm:ss")
    return F.concat(stamp, F.lit("."), F.lpad(F.pmod(ns, F.lit(UNIT)).cast("string"), 9, "0"), F.lit("Z"))


def parse_instant(text: Column) -> Column:
    """Nanoseconds of an RFC 3339 instant with up to nine digits and any offset; null if it is none."""
    form = r"^(\d{4}-\d{2}-\d{2})[Tt ](\d{2}:\d{2}:\d{2})(?:\.(\d{1,9}))?([Zz]|[+-]\d{2}:\d{2})$"
    part = lambda i: F.regexp_extract(text, form, i)
    zone = F.when(F.upper(part(4)) == "Z", "+00:00").otherwise(part(4))
    stamp = F.try_to_timestamp(F.concat(part(1), F.lit(" "), part(2), zone), F.lit("yyyy-MM-dd HH:mm:ssXXX"))
    return F.when(F.regexp_like(text, F.lit(form)), F.unix_seconds(stamp) * UNIT + F.rpad(part(3), 9, "0").cast("bigint"))


def utc_date(ns: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), (floor_bucket(ns, DAY) / DAY).cast("int"))


def base_of(symbol: Column) -> Column:
    return F.upper(F.regexp_extract(symbol, r"^([A-Za-z0-9]+)[-/_]([A-Za-z0-9]+)$", 1))


def quote_of(symbol: Column) -> Column:
    return F.upper(F.regexp_extract(symbol, r"^([A-Za-z0-9]+)[-/_]([A-Za-z0-9]+)$", 2))


def crc_partition(key: Column, n: int) -> Column:
    return F.pmod(F.crc32(key.cast("binary")), F.lit(n))


def spread_bps(bid: Column, ask: Column) -> Column:
    mid = midpoint(bid, ask)
    return F.when(mid != 0, (ask - bid) / mid * 10_000)


def imbalance(bid: Column, ask: Column) -> Column:
    """(bid - ask) / (bid + ask), null if there is nothing."""
    return F.when(bid + ask != 0, (bid - ask) / (bid + ask))


def microprice_bps(bid: Column, ask: Column, bid_qty: Column, ask_qty: Column) -> Column:
    """How far the touch, weighted by the other side's quantity, lies from the mid."""
    mid = (bid + ask) / 2
    return F.when(bid_qty + ask_qty != 0, ((bid * ask_qty + ask * bid_qty.cast("double")) / (bid_qty + ask_qty) - mid) / mid * 10_000)


def round_to_tick(price: Column, tick: int, side: Column) -> Column:
    """Away from the mid: bids down, asks up."""
    low = floor_bucket(price, tick)
    return F.when((side == 0) | (low == price), low).otherwise(low + tick)


def fee(notional: Column, bps: float) -> Column:
    return notional * bps / 10_000


def slipped(price: Column, side: Column, bps: float) -> Column:
    """A price moved against the taker: up for a buy (0), down for a sell."""
    return price * F.when(side == 0, 1 + bps / 10_000).otherwise(1 - bps / 10_000)


def parse_float(value: Column) -> Column:
    """A double as 1e-9 units by its shortest decimal spelling, not by its binary expansion."""
    return parse_decimal(value.cast("string"))


def checked_sum(a: Column, b: Column) -> Column:
    """Null, and no wrong number, where the sum passes a long."""
    return F.try_add(a, b)


def checked_difference(a: Column, b: Column) -> Column:
    return F.try_subtract(a, b)


def lossy_double(units: Column) -> Column:
    return units.cast("double") / UNIT


# The spellings under which venues are known.
VENUES = {"coinbase": "coinbase", "kraken": "kraken", "okx": "okx", "bybit": "bybit", "binance-us": "binance_us", "binanceus": "binance_us", "binance_us": "binance_us", "binance": "binance_us", "bitstamp": "bitstamp"}


def venue_of(text: Column) -> Column:
    """The venue a spelling names, in any case; null if none."""
    return F.coalesce(*[F.when(F.lower(text) == k, v) for k, v in VENUES.items()])


def partition_of_path(path: Column) -> Column:
    """``venue, symbol, date`` from the folders of an archive path; null unless all three are there."""
    part = lambda k: F.regexp_extract(path, rf"(?:^|/){k}=([^/]+)(?:/|$)", 1)
    venue = venue_of(part("venue"))
    return F.when(venue.isNotNull() & (part("symbol") != "") & (part("date") != ""), F.struct(venue.alias("venue"), F.upper(part("symbol")).alias("symbol"), part("date").alias("date")))
