"""Books from archive rows: epochs, messages, and what the book shows after each message or at an instant.

Within an epoch, which starts at a snapshot, the book is the last write of each price level.  Messages are cut into
blocks; the levels that stand where a block begins are carried to it, and each block is then one group of its own: its
work is its messages and the levels it starts from, however long an epoch is.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import floor_bucket, imbalance, midpoint, spread_bps
from ..plans import running

KEYS = ["venue", "symbol"]
EPOCH = [*KEYS, "epoch"]
MESSAGE = [*EPOCH, "pos"]
#: Messages to a block: as many as keep carried levels few beside a block's own rows.
BLOCK = 4096


def with_epoch(rows: DataFrame) -> DataFrame:
    """Adds ``epoch``: how many runs of snapshot rows have begun, less one, in arrival order per instrument."""
    seen = running.before(rows, KEYS, "row_ordinal", event_before=("lag", F.col("event")))
    seen = seen.withColumn("starts", ((F.col("event") == 0) & (F.coalesce("event_before", F.lit(1)) != 0)).cast("bigint"))
    return running.before(seen, KEYS, "row_ordinal", begun=("sum", F.col("starts"))).withColumn("epoch", F.coalesce("begun", F.lit(0)) + F.col("starts") - 1).drop("event_before", "starts", "begun")


def with_position(rows: DataFrame) -> DataFrame:
    """Adds ``epoch`` and ``pos``, the number of a row's message in its instrument: consecutive rows of one ``msg_index``,
    ``event`` and ``recv_wall`` are a message, so that an index that starts over is a new one."""
    seen = running.before(rows, KEYS, "row_ordinal", was=("lag", F.struct("msg_index", "event", "recv_wall")))
    fresh = (F.col("event") == 0) & (F.coalesce(F.col("was.event"), F.lit(1)) != 0)
    new = ~F.struct("msg_index", "event", "recv_wall").eqNullSafe(F.col("was"))
    seen = seen.withColumn("starts", fresh.cast("bigint")).withColumn("opens", new.cast("bigint")).drop("was")
    done = running.before(seen, KEYS, "row_ordinal", begun=("sum", F.col("starts")), opened=("sum", F.col("opens")))
    epoch, pos = F.coalesce("begun", F.lit(0)) + F.col("starts") - 1, F.coalesce("opened", F.lit(0)) + F.col("opens") - 1
    return done.withColumn("epoch", epoch).withColumn("pos", pos).drop("starts", "opens", "begun", "opened")


def messages(rows: DataFrame) -> DataFrame:
    """One row per message of rows with ``epoch`` and ``pos``."""
    return rows.groupBy(*MESSAGE, "msg_index", "event").agg(
        F.count("*").alias("n_rows"), F.min("row_ordinal").alias("first_ordinal"), F.max("recv_wall").alias("recv_wall"), F.max("suspect").alias("suspect"))


class LevelBook:
    """Two sides of levels by price; a feed of limited depth forgets its worst levels after each message."""

    def __init__(self, limit: int | None = None):
        self.limit, self.qty, self.prices = limit, ({}, {}), ([], [])

    def set(self, side: int, price: int, qty: int) -> None:
        own, order = self.qty[side], self.prices[side]
        if qty > 0:
            if price not in own:
                insort(order, price)
            own[price] = qty
        elif qty == 0 and price in own:
            del own[price], order[bisect_left(order, price)]

    def trim(self) -> None:
        if self.limit is not None:
            for side, order in enumerate(self.prices):
                while len(order) > self.limit:
                    del self.qty[side][order.pop(0 if side == 0 else -1)]

    def best(self, side: int, n: int) -> list[int]:
        """The best ``n`` prices of a side, best first."""
        order = self.prices[side]
        return order[: -n - 1 : -1] if side == 0 else order[:n]

    def within(self, side: int, offset: int) -> int | None:
        """Quantity no further than ``offset`` from the mid, both ends counted; of two-sided books only."""
        bids, asks = self.prices
        if not bids or not asks:
            return None
        total = bids[-1] + asks[0]
        mid = total // 2 if total >= 0 else -(-total // 2)
        near = bids[bisect_left(bids, mid - offset) :] if side == 0 else asks[: bisect_left(asks, mid + offset + 1)]
        return sum(map(self.qty[side].__getitem__, near))

    def digest(self, symbol: str) -> int:
        """CRC32 of the symbol, then per side its tag and (price, quantity) pairs, best first, little-endian."""
        parts = [symbol.encode()]
        for side, tag in ((0, b"B"), (1, b"A")):
            own = self.qty[side]
            parts += [tag, *(p.to_bytes(8, "little", signed=True) + own[p].to_bytes(8, "little", signed=True) for p in self.best(side, len(own)))]
        return zlib.crc32(b"".join(parts))


_LEVELS = "array<struct<price:bigint,qty:bigint>>"
_SHOWN = f"venue string, symbol string, epoch bigint, pos bigint, msg_index bigint, event int, n_rows bigint, first_ordinal bigint, recv_wall bigint, suspect boolean, bid_levels bigint, ask_levels bigint, bids {_LEVELS}, asks {_LEVELS}, bid_within bigint, ask_within bigint, digest bigint"
_INPUT = ["venue", "symbol", "epoch", "block", "pos", "row_ordinal", "msg_index", "event", "recv_wall", "suspect", "side", "price", "qty"]


class _Fold:
    """Applies rows in order to a book and notes what it shows after each message."""

    def __init__(self, symbol: str, n: int, within: int | None, digest: bool, limit: int | None):
        self.symbol, self.n, self.offset, self.digests = symbol, n, within, digest
        self.book, self.open, self.clear = LevelBook(limit), None, []
        self.out: list[tuple] = []
        self.levels: tuple[list, list] = ([], [])

    def row(self, pos, ordinal, index, event, wall, suspect, side, price, qty) -> None:
        if self.open is not None and self.open[0] != pos:
            self.close()
        if self.open is None:
            self.open = [pos, index, event, 0, ordinal, wall, False]
        self.open[3] += 1
        self.open[5] = max(self.open[5], wall)
        self.open[6] = self.open[6] or bool(suspect)
        self.book.set(side, price, qty)

    def close(self) -> None:
        b = self.book
        b.trim()
        near = [None if self.offset is None else b.within(s, self.offset) for s in (0, 1)]
        self.out.append((*self.open, len(b.prices[0]), len(b.prices[1]), *near, b.digest(self.symbol) if self.digests else None))
        for side, kept in enumerate(self.levels):
            own = b.qty[side]
            kept.append([(p, own[p]) for p in b.best(side, self.n)])
        self.open = None

    def table(self, keys: tuple) -> pa.Table:
        cols = list(zip(*self.out, strict=True)) if self.out else [()] * 12
        flat = []
        for kept in self.levels:
            prices, sizes = pa.array([p for x in kept for p, _ in x], pa.int64()), pa.array([q for x in kept for _, q in x], pa.int64())
            cuts, at = [0], 0
            for x in kept:
                at += len(x)
                cuts.append(at)
            flat.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays([prices, sizes], ["price", "qty"])))
        n = len(self.out)
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        own = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
        head = [pa.array([keys[0]] * n, pa.string()), pa.array([keys[1]] * n, pa.string()), pa.array([keys[2]] * n, pa.int64())]
        self.out, self.levels = [], ([], [])
        return pa.Table.from_arrays([*head, *own[:9], *flat, *own[9:]], [x.split(" ")[0] for x in _SHOWN.split(", ")])


def carried(rows: DataFrame) -> DataFrame:
    """The levels that stand where each block of ``rows`` (with ``block``) begins, as rows without a position."""
    ends = rows.groupBy(*EPOCH).agg(F.max("block").alias("last"))
    wrote = rows.where("qty >= 0").groupBy(*EPOCH, "block", "side", "price").agg(F.max_by("qty", "row_ordinal").alias("qty"))
    later = F.lead("block").over(Window.partitionBy(*EPOCH, "side", "price").orderBy("block"))
    held = wrote.withColumn("to", later).where("qty > 0").join(ends, EPOCH).withColumn("to", F.coalesce("to", "last")).where(F.col("to") > F.col("block"))
    held = held.withColumn("block", F.explode(F.sequence(F.col("block") + 1, F.col("to"))))
    none = {"pos": "bigint", "row_ordinal": "bigint", "msg_index": "bigint", "event": "int", "recv_wall": "bigint", "suspect": "boolean"}
    return held.withColumns({c: F.lit(None).cast(k) for c, k in none.items()}).select(*_INPUT)


def shown(rows: DataFrame, n: int = 1, within: int | None = None, digest: bool = False, block: int = BLOCK) -> DataFrame:
    """A row per message with what its book shows: level counts, the best ``n`` levels a side (``bids``, ``asks``), if asked
    the quantity ``within`` an offset of the mid and the digest of the whole book."""
    cut = rows.withColumn("block", F.floor(F.col("pos") / block)).select(*_INPUT)
    both = cut.unionByName(carried(cut))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        names = [k.as_py() for k in key]
        fold = _Fold(names[1], n, within, digest, None)
        table = table.select(_INPUT[4:]).sort_by([("pos", "ascending"), ("row_ordinal", "ascending")])
        begun = table.column("pos").null_count  # nulls come last
        own, base = table.slice(0, len(table) - begun), table.slice(len(table) - begun)
        for side, price, qty in zip(*(base.column(c).to_pylist() for c in ("side", "price", "qty")), strict=True):
            fold.book.set(side, price, qty)
        for r in zip(*(c.to_pylist() for c in own.columns), strict=True):
            fold.row(*r)
        if fold.open:
            fold.close()
        return fold.table((names[0], names[1], names[2]))

    return both.groupBy(*EPOCH, "block").applyInArrow(run, _SHOWN)


def replay(rows: DataFrame, limit: int | None = None, digest: bool = True) -> DataFrame:
    """Touch, level counts and digest after each message.

    A feed of limited depth forgets a level that is pushed out until it is sent again, so its state can't be told from
    last writes: its epochs stream through a task each, in order, and only ``limit`` levels a side are held.
    """
    if limit is None:
        done = shown(rows, 1, digest=digest)
    else:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fold, at = None, None
            for b in batches:
                for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if r[:3] != at:
                        if fold and fold.open:
                            fold.close()
                            yield from fold.table(at).to_batches()
                        fold, at = _Fold(r[1], 1, None, digest, limit), r[:3]
                    fold.row(*r[4:])
                    if len(fold.out) >= 2000:
                        yield from fold.table(at).to_batches()
            if fold and fold.open:
                fold.close()
                yield from fold.table(at).to_batches()

        ordered = rows.withColumn("block", F.lit(0).cast("bigint")).select(*_INPUT).repartition(*EPOCH).sortWithinPartitions(*EPOCH, "row_ordinal")
        done = ordered.mapInArrow(run, _SHOWN)
    first = lambda c: F.get(c, F.lit(0))["price"]
    return done.select(*KEYS, "msg_index", first("bids").alias("bid"), first("asks").alias("ask"), "bid_levels", "ask_levels", "digest")


def touch(books: DataFrame) -> DataFrame:
    """``bid, ask, bid_qty, ask_qty`` from the first levels of :func:`shown`; a side without levels is null."""
    first = lambda c, f: F.get(c, F.lit(0))[f]
    return books.withColumns({"bid": first("bids", "price"), "ask": first("asks", "price"), "bid_qty": first("bids", "qty"), "ask_qty": first("asks", "qty")})


def top_of_book(rows: DataFrame) -> DataFrame:
    """Per message the best level and the number of levels a side; a side without levels is null."""
    return touch(shown(rows)).select(*MESSAGE, "msg_index", "event", "n_rows", "first_ordinal", "recv_wall", "suspect", "bid", "ask", "bid_qty", "ask_qty", "bid_levels", "ask_levels")


def quotes(rows: DataFrame) -> DataFrame:
    """Mid, spread, spread in basis points, and whether the touch is crossed or locked; null if one-sided."""
    bid, ask = F.col("bid"), F.col("ask")
    return top_of_book(rows).select(*KEYS, "msg_index", "first_ordinal", "recv_wall", "suspect", midpoint(bid, ask).alias("mid"), (ask - bid).alias("spread"), F.round(spread_bps(bid, ask), 6).alias("spread_bps"), (bid > ask).alias("crossed"), (bid == ask).alias("locked"))


def side_sum(levels: str, n: int) -> Column:
    """Quantity of the best ``n`` of a side's shown levels."""
    return F.aggregate(F.slice(levels, 1, n), F.lit(0).cast("bigint"), lambda acc, x: acc + x["qty"])


def depth(rows: DataFrame, n: int) -> DataFrame:
    """Per message with any level the quantity and number of the best ``n`` levels a side, and their imbalance."""
    books = shown(rows, n).where("bid_levels + ask_levels > 0")
    sums = books.select(*KEYS, "msg_index", side_sum("bids", n).alias("bid_qty"), side_sum("asks", n).alias("ask_qty"), F.size("bids").cast("bigint").alias("bid_levels"), F.size("asks").cast("bigint").alias("ask_levels"))
    return sums.withColumn("imbalance", F.round(imbalance(F.col("bid_qty"), F.col("ask_qty")), 9))


def depth_within(rows: DataFrame, offset: int) -> DataFrame:
    """Quantity of whole levels no further than ``offset`` from the mid, both ends counted; two-sided books only."""
    books = touch(shown(rows, 1, within=offset)).where("bid is not null and ask is not null")
    return books.select(*KEYS, "msg_index", midpoint(F.col("bid"), F.col("ask")).alias("mid"), F.col("bid_within").alias("bid_qty"), F.col("ask_within").alias("ask_qty"))


def levels_shown(books: DataFrame) -> DataFrame:
    """The levels of :func:`shown` as rows: ``side, price, qty`` beside the message's columns."""
    tagged = lambda c, s: F.transform(c, lambda x: F.struct(F.lit(s).alias("side"), x["price"].alias("price"), x["qty"].alias("qty")))
    return books.select(*KEYS, "msg_index", F.explode(F.concat(tagged("bids", 0), tagged("asks", 1))).alias("x")).select(*KEYS, "msg_index", "x.*")


def bars(ticks: DataFrame, width: int) -> DataFrame:
    """Open, high, low and close of the mid per bucket with ticks; empty buckets are absent."""
    kept = ticks.where("mid is not null").withColumn("bucket", floor_bucket(F.col("recv_wall"), width))
    return kept.groupBy(*KEYS, "bucket").agg(
        F.min_by("mid", "first_ordinal").alias("open"), F.max("mid").alias("high"), F.min("mid").alias("low"), F.max_by("mid", "first_ordinal").alias("close"),
        F.count("*").alias("updates"), F.count_if("suspect").alias("suspect_updates"), F.sum("spread").alias("spread_sum"))


def bars_with_volume(ticks: DataFrame, traded: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """Bars with ``traded`` and ``mean_spread``, and the volume that no bar takes: ``bucket, traded`` of buckets without one.

    ``traded``: keys, ``recv_wall`` and ``traded`` per message, null on feeds that tell no trades, which stays null in
    the bar.  Trades before the book has two sides belong to their bucket's bar."""
    own = traded.withColumn("bucket", floor_bucket(F.col("recv_wall"), width)).groupBy(*KEYS, "bucket").agg(F.sum("traded").alias("traded"))
    made = bars(ticks, width).withColumn("mean_spread", F.round(F.col("spread_sum") / F.col("updates"), 6)).drop("spread_sum")
    return made.join(own, [*KEYS, "bucket"], "left"), own.where("traded is not null").join(made.select(*KEYS, "bucket"), [*KEYS, "bucket"], "left_anti")


def book_at(rows: DataFrame, at: int) -> DataFrame:
    """The levels that stand at an instant: last write of each level in the newest epoch begun by then."""
    seen = rows.where(F.col("recv_wall") <= at)
    newest = seen.groupBy(*KEYS).agg(F.max("epoch").alias("epoch"))
    level = seen.where("qty >= 0").join(newest, EPOCH).groupBy(*KEYS, "side", "price").agg(F.max_by("qty", "row_ordinal").alias("qty"))
    return level.where("qty > 0")


def anomalies(rows: DataFrame) -> DataFrame:
    """Removals of levels that do not stand, per message."""
    wrote = rows.where("qty >= 0").groupBy(*MESSAGE, "msg_index", "event", "side", "price").agg(F.max_by("qty", "row_ordinal").alias("qty"))
    before = F.lag("qty").over(Window.partitionBy(*EPOCH, "side", "price").orderBy("pos"))
    absent = wrote.withColumn("before", before).where("event = 1 and qty = 0 and coalesce(before, 0) = 0")
    return absent.groupBy(*KEYS, "msg_index").agg(F.count("*").alias("absent_removals"))
