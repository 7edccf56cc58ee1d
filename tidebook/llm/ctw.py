"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions; each decision, named by the bits before it, has its own tree over contexts of 0 to
``order`` preceding bytes.  Every node keeps a Krichevsky-Trofimov estimate, and a node's weight against those below it
is the posterior of the context-tree mixture over the training texts.  All that the mixture needs from the corpus are
the counts of byte (order+1)-grams, so training is one grouped sum.  The model is then a table of a log probability per
gram.  A table of at most ``BROADCAST_GRAMS`` rows goes to the workers; a larger one goes in parts of about that size,
one after the other, and texts are read once for each: only a sum per text is moved, never the grams of texts.

Texts are lower-cased (A-Z) and end in the byte 0xFF, which UTF-8 never holds and which also stands before a text.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.durable import materialize
from .common import Rows, sliced, tidied

ORDER = 5
BROADCAST_GRAMS = 4_000_000
#: A word that makes up more than this part of all training tokens is broadcast: there can be no more such words.
HEAVY = 1 << 20
#: Context bytes that grams are dealt by.
TOP = 3
#: Grams that one task builds its part of the trees from, about.
TASK_GRAMS = 400_000
#: The part of the table that holds a gram: its remainder by this prime, to which every byte counts, modulo the parts.
SPREAD = 1_000_003
END = 0xFF
_SMALL = np.array([math.lgamma(n + 0.5) for n in range(64)]), np.array([math.lgamma(n + 1.0) for n in range(64)])


def _log_gamma(n: np.ndarray, half: bool) -> np.ndarray:
    """log gamma(n + 1/2) if half, else of n + 1, for counts n: a table, then Stirling's series."""
    x = n + (0.5 if half else 1.0)
    big = np.maximum(x, 32.0)
    series = (big - 0.5) * np.log(big) - big + 0.5 * math.log(2 * math.pi) + 1 / (12 * big) - 1 / (360 * big**3)
    return np.where(n < 64, _SMALL[0 if half else 1][np.minimum(n, 63).astype(np.int64)], series)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log probability that the Krichevsky-Trofimov estimator gives to n0 zeros and n1 ones."""
    return _log_gamma(n0, True) + _log_gamma(n1, True) - math.log(math.pi) - _log_gamma(n0 + n1, False)


def grams(data: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The byte grams of texts as integers, oldest byte first, and the number of the text of each; ends included."""
    size = np.array([len(t) for t in data], np.int64)
    pad = bytes([END]) * order
    raw = np.frombuffer(pad + pad.join(data) + pad, np.uint8)
    owner = np.repeat(np.arange(len(data)), size + 1)
    start = np.cumsum(np.concatenate(([0], size[:-1] + order))) if len(data) else size
    at = np.arange(len(owner)) - np.repeat(np.cumsum(np.concatenate(([0], size[:-1] + 1))) if len(data) else size, size + 1) + np.repeat(start, size + 1)
    wide = raw.astype(np.uint64)
    code = np.zeros(len(raw) - order, np.uint64)
    for i in range(order + 1):
        code = (code << np.uint64(8)) | wide[i : len(raw) - order + i]
    return code[at], owner


def _sum_by(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    found, place = np.unique(keys, return_inverse=True)
    return found, *(np.bincount(place.reshape(-1), v, len(found)) for v in values)


def _nodes(code: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The decision nodes of contexts and bytes in ``code``: context then the marked bits so far; zeros and ones seen."""
    u = np.uint64
    keys = [((code >> u(8)) << u(8)) | u(1 << b) | ((code & u(255)) >> u(8 - b)) for b in range(8)]
    ones = [((code >> u(7 - b)) & u(1)).astype(float) * count for b in range(8)]
    return _sum_by(np.concatenate(keys), np.tile(count, 8) - np.concatenate(ones), np.concatenate(ones))


def _mask(bytes_: int) -> np.uint64:
    return np.uint64((1 << (8 * bytes_)) - 1)


class Level:
    """The nodes of one depth, by rising key, with estimate of a one, log estimate and log weighted probability.

    A node's weighted probability is half its estimate and half the product of its children's; a child that holds no
    counts has probability one, and its estimate of the next decision is one half."""

    def __init__(self, key: np.ndarray, n0: np.ndarray, n1: np.ndarray, below: tuple[np.ndarray, np.ndarray] | None):
        self.key, self.one, self.log_e = key, (n1 + 0.5) / (n0 + n1 + 1), log_kt(n0, n1)
        if below is None:
            self.log_w, self.keep = self.log_e, np.ones(len(key))
        else:
            s = np.bincount(np.searchsorted(key, below[0]), below[1], len(key))
            self.log_w = np.logaddexp(self.log_e, s) - math.log(2)
            self.keep = np.exp(self.log_e - math.log(2) - self.log_w)

    def enter(self, acc: np.ndarray, rem: np.ndarray) -> None:
        """Takes what the shallower nodes have mixed so far and the weight they left over."""
        self.acc, self.rem = acc + rem * self.keep * self.one, rem * (1 - self.keep)
        self.final = self.acc + self.rem / 2


def levels(code: np.ndarray, count: np.ndarray, deepest: int, top: int) -> list[Level]:
    """Levels of depth ``top`` to ``deepest`` from grams seen in training, weighted from the deepest up."""
    out: list[Level] = []
    below = None
    for d in range(deepest, top - 1, -1):
        code, count = _sum_by(code & _mask(d + 1), count)
        level = Level(*_nodes(code, count), below)
        below = (level.key & _mask(d), level.log_w) if d else None
        out.insert(0, level)
    return out


def descend(found: list[Level], top: int, acc: np.ndarray, rem: np.ndarray) -> None:
    for i, level in enumerate(found):
        if i:
            at = np.searchsorted(found[i - 1].key, level.key & _mask(top + i))
            acc, rem = found[i - 1].acc[at], found[i - 1].rem[at]
        level.enter(acc, rem)


def log_probability(code: np.ndarray, above: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """log10 of each gram's last byte given the rest, by the mixture over all depths.

    ``above``: for each depth from 0 the node keys and the mixture of a path whose next node training never met: that
    node and all below it hold no counts, so what weight is left over for them says one half.
    """
    u = np.uint64
    total = np.zeros(len(code))
    for b in range(8):
        node = ((code >> u(8)) << u(8)) | u(1 << b) | ((code & u(255)) >> u(8 - b))
        p = np.full(len(code), 0.5)
        for d, (key, final) in enumerate(above):
            if len(key):
                want = node & _mask(d + 1)
                at = np.minimum(np.searchsorted(key, want), len(key) - 1)
                hit = key[at] == want
                p[hit] = final[at[hit]]
        one = ((code >> u(7 - b)) & u(1)).astype(bool)
        total += np.log10(np.where(one, p, 1 - p))
    return total


def _lowered(texts: list[str | None]) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]


def count_grams(rows: DataFrame, order: int) -> DataFrame:
    """``gram, n``: each gram of any text with its count in training texts, summed within tasks and then by key."""

    def run(batches: Iterable[pa.RecordBatch]) -> Rows:
        key, n, new, size = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

        def fold() -> tuple[np.ndarray, np.ndarray]:
            k, c = np.concatenate([key, *(x for x, _ in new)]), np.concatenate([n, *(x for _, x in new)])
            k, c = _sum_by(k, c)
            return k, c.astype(np.int64)

        for part in sliced(batches, 200):
            code, owner = grams(_lowered(part.column(1).to_pylist()), order)
            train = ~np.asarray(part.column(2).to_pylist(), bool)
            order_ = np.sort((code << np.uint64(1)) | train[owner].astype(np.uint64))
            cut = np.flatnonzero(np.concatenate(([True], order_[1:] != order_[:-1]))) if len(order_) else np.zeros(0, np.int64)
            found, times = order_[cut], np.diff(np.append(cut, len(order_)))
            new.append((found >> np.uint64(1), times * (found & np.uint64(1)).astype(np.int64)))
            size += len(found)
            if size > max(500_000, len(key)):
                key, n = fold()
                new, size = [], 0
        key, n = fold()
        for at in range(0, len(key), 200_000):
            yield pa.RecordBatch.from_arrays([pa.array(key[at : at + 200_000].view(np.int64)), pa.array(n[at : at + 200_000])], ["gram", "n"])

    return rows.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def gram_table(counts: DataFrame, order: int) -> DataFrame:
    """``gram, log10_p`` for every gram in ``counts``.

    Trees below three context bytes are whole in the partition of those bytes; what lies above are the nodes of two, one
    and no context bytes, at most 2^24 and in prose some hundred thousand, made on the driver from the sums that the
    partitions send up.
    """
    top = min(TOP, order)
    spark = counts.sparkSession
    parts = max(1, math.ceil(counts.count() / TASK_GRAMS))
    dealt = counts.repartition(parts, F.expr(f"(gram >> 8) & {(1 << (8 * top)) - 1}"))

    def whole(frames: Iterable[pd.DataFrame]) -> tuple[np.ndarray, np.ndarray]:
        got = pd.concat([pd.DataFrame({"gram": np.zeros(0, np.int64), "n": np.zeros(0, np.int64)}), *frames])
        return got["gram"].to_numpy(np.int64).view(np.uint64), got["n"].to_numpy(float)

    def up(frames: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        code, n = whole(frames)
        code, n = code[n > 0], n[n > 0]
        if len(code):
            level = levels(code, n, order, top)[0]
            short, count = _sum_by(code & _mask(top), n)
            key, n0, n1 = _nodes(short, count)
            at, w = _sum_by(level.key & _mask(top), level.log_w)
            yield pd.DataFrame({"node": key.view(np.int64), "n0": n0, "n1": n1, "w": w[np.searchsorted(at, key)]})

    sums = dealt.mapInPandas(up, "node long, n0 double, n1 double, w double").groupBy("node").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("w").alias("w")).toArrow().sort_by("node")
    key = sums["node"].to_numpy().view(np.uint64)
    n0, n1 = sums["n0"].to_numpy(), sums["n1"].to_numpy()
    first = [Level(key, n0, n1, (key, sums["w"].to_numpy()))]
    for d in range(top - 2, -1, -1):
        low, m0, m1 = _sum_by(first[0].key & _mask(d + 1), n0, n1)
        first.insert(0, Level(low, m0, m1, (first[0].key & _mask(d + 1), first[0].log_w)))
        n0, n1 = m0, m1
    if len(key):
        descend(first, 0, np.zeros(len(first[0].key)), np.ones(len(first[0].key)))
    above = spark.sparkContext.broadcast([(x.key, x.final, x.acc, x.rem) for x in first] if len(key) else [])

    def down(frames: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        code, n = whole(frames)
        tops = above.value
        depths = [(k, f) for k, f, _, _ in tops]
        seen = n > 0
        if seen.any():
            own = levels(code[seen], n[seen], order, top)
            last, _, acc, rem = tops[-1]
            at = np.searchsorted(last, own[0].key & _mask(top))
            descend(own, top, acc[at], rem[at])
            depths += [(x.key, x.final) for x in own]
        for at in range(0, len(code), 200_000):
            part = code[at : at + 200_000]
            yield pd.DataFrame({"gram": part.view(np.int64), "log10_p": log_probability(part, depths)})

    return dealt.mapInPandas(down, "gram long, log10_p double")


class Table:
    """Open addressing over gram keys, at most two thirds full; the top bit marks a used slot."""

    USED = np.uint64(1 << 63)

    def __init__(self, key: np.ndarray, value: np.ndarray):
        bits = max(4, int(len(key) * 3 // 2).bit_length())
        key = key | self.USED
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.key, self.value = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits)
        todo = np.arange(len(key))
        slot = self._slot(key)
        while len(todo):
            free = self.key[slot] == 0
            self.key[slot[free]] = key[todo[free]]
            done = self.key[slot] == key[todo]
            self.value[slot[done]] = value[todo[done]]
            todo, slot = todo[~done], (slot[~done] + 1) & self.last

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __getitem__(self, key: np.ndarray) -> np.ndarray:
        key = key | self.USED
        slot = self._slot(key)
        out = self.value[slot]
        todo = np.flatnonzero(self.key[slot] != key)
        slot = slot[todo]
        while len(todo):
            slot = (slot + 1) & self.last
            hit = self.key[slot] == key[todo]
            out[todo[hit]] = self.value[slot[hit]]
            todo, slot = todo[~hit], slot[~hit]
        return out


def count_words(rows: DataFrame) -> DataFrame:
    """``word, n`` over training texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Rows:
        total: Counter = Counter()

        def flush() -> Rows:
            for at in range(0, len(keys := list(total)), 100_000):
                part = keys[at : at + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([total[w] for w in part], pa.int64())], ["word", "n"])

        for part in sliced(batches, 200):
            for t, held in zip(part.column(1), part.column(2), strict=True):
                if not held.as_py():
                    total.update((t.as_py() or "").encode("utf-8", "surrogatepass").lower().split())
            if len(total) > 300_000:
                yield from flush()
                total.clear()
        yield from flush()

    return rows.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


_PASS = "doc_id {kind}, held_out boolean, n_tokens long, n_bytes long, known long, heavy double, score double, light array<binary>, light_n array<int>, grams array<long>, gram_n array<int>, form binary"


def held_part(table: DataFrame, parts: int, part: int) -> Table:
    """One of the parts that the rows of a gram table fall into."""
    got = table.where(F.col("gram") % SPREAD % parts == part).toArrow()
    return Table(got["gram"].to_numpy().view(np.uint64), got["log10_p"].to_numpy())


def _sums(probabilities: Table, parts: int, part: int, texts: list[bytes], order: int) -> np.ndarray:
    """Per text the sum over those of its grams that fall into the part."""
    code, owner = grams(texts, order)
    if parts > 1:
        own = np.flatnonzero(code % np.uint64(SPREAD) % np.uint64(parts) == part)
        code, owner = code[own], owner[own]
    return np.bincount(owner, probabilities[code], len(texts))


def _form(text: bytes) -> bytes:
    return hashlib.md5(text).digest()


def _part_pass(rows: DataFrame, shared: Broadcast, parts: int, part: int, order: int) -> DataFrame:
    """``form, part, sum``: the share that one part of the table has in the score of a text of that form."""

    def run(batches: Iterable[pa.RecordBatch]) -> Rows:
        for b in sliced(batches, 200):
            texts = _lowered(b.column(0).to_pylist())
            sums = _sums(shared.value, parts, part, texts, order)
            yield pa.RecordBatch.from_arrays([pa.array([_form(t) for t in texts], pa.binary()), pa.array([part] * len(texts), pa.int32()), pa.array(sums, pa.float64())], ["form", "part", "sum"])

    return rows.select("text").mapInArrow(tidied(run), "form binary, part int, sum double")


def _pass(rows: DataFrame, shared: Broadcast, parts: int, order: int) -> DataFrame:
    """Per text what can be told from the broadcast, logs of heavy words and the first part of the table: all of it but
    rare words and further parts.  Without a table its grams come with it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Rows:
        logs, probabilities = shared.value
        for part in sliced(batches, 200):
            texts = _lowered(part.column(1).to_pylist())
            size, known, sums, light, light_n, own_grams, own_n = [], [], [], [], [], [], []
            if probabilities is not None:
                score = _sums(probabilities, parts, 0, texts, order)
            else:
                score = np.zeros(len(texts))
                for x in np.split(grams(texts, order)[0], np.cumsum([len(t) + 1 for t in texts])[:-1]):
                    k, n = np.unique(x, return_counts=True)
                    own_grams.append(k.view(np.int64).tolist())
                    own_n.append(n.tolist())
            for t in texts:
                words = t.split()
                rare = Counter([w for w in words if w not in logs])
                size.append(len(words) + 1)
                known.append(len(words) - rare.total())
                sums.append(math.fsum([logs[w] for w in words if w in logs]))
                light.append(list(rare))
                light_n.append(list(rare.values()))
            none = [None] * len(texts) if not own_grams else own_grams
            yield pa.RecordBatch.from_arrays([
                part.column(0), part.column(2), pa.array(size, pa.int64()), pa.array([len(t) + 1 for t in texts], pa.int64()), pa.array(known, pa.int64()), pa.array(sums, pa.float64()), pa.array(score, pa.float64()),
                pa.array(light, pa.list_(pa.binary())), pa.array(light_n, pa.list_(pa.int32())), pa.array(none, pa.list_(pa.int64())), pa.array(own_n or none, pa.list_(pa.int32())),
                pa.array([_form(t) if parts > 1 else None for t in texts], pa.binary()),
            ], [x.split()[0] for x in _PASS.split(", ")])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, _PASS.format(kind=kind)).withColumn("rid", F.monotonically_increasing_id())


def _exploded(done: DataFrame, items: str, counts: str) -> DataFrame:
    return done.select("rid", F.explode(F.arrays_zip(F.col(items).alias("item"), F.col(counts).alias("k"))).alias("x")).select("rid", F.col("x.item").alias("item"), F.col("x.k").alias("k"))


def score(df: DataFrame, held_out: Column, order: int = ORDER, broadcast_grams: int = BROADCAST_GRAMS, heavy_share: int = HEAVY, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per input row ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``.

    Learns from rows where ``held_out`` is not true and scores all.  ``score`` is the log10 probability of the lower-cased
    text and its end.  The base is an add-one unigram over words and one end per text: words that are more than a
    2^-20 part of the training tokens are looked up in a broadcast of at most that many, all others by a join.  The
    model goes to the workers in parts of about ``broadcast_grams`` rows, each with a pass over the texts; with 0 it is
    joined by shuffles of the grams of all texts, many times their size.
    Null and empty texts are an end alone; with nothing to learn from every decision is even and the base gives every
    token 1/1; repeated rows each train and score; an empty table gives none; other columns play no part.
    """
    if not 2 <= order <= 6:
        raise ValueError("order must be 2 to 6: a gram and a mark fit in 64 bits")
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    words = materialize(count_words(rows), "words")
    told = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    texts = rows.where("not held_out").count()
    total, kinds = told["n"] + texts, told["v"] + (texts > 0)
    bar = total // heavy_share
    often = words.where(F.col("n") > bar).toArrow()
    heavy = dict(zip(often["word"].to_pylist(), often["n"].to_pylist(), strict=True))
    del often
    table = materialize(gram_table(materialize(count_grams(rows, order), "grams"), order), "model")
    parts = max(1, math.ceil(table.count() / broadcast_grams)) if broadcast_grams else 0
    share = rows.sparkSession.sparkContext.broadcast
    shared = share(({w: math.log10(n + 1) for w, n in heavy.items()}, held_part(table, parts, 0) if parts else None))
    done = materialize(_pass(rows, shared, parts, order), "scored")
    shared.destroy()  # the rows are in a table
    further = []
    for part in range(1, parts):
        shared = share(held_part(table, parts, part))
        further.append(materialize(_part_pass(rows, shared, parts, part, order), "sums"))
        shared.destroy()
    light = _exploded(done, "light", "light_n").join(words.where(F.col("n") <= bar).withColumnRenamed("word", "item"), "item")
    light = light.groupBy("rid").agg(F.sum("k").alias("light_known"), F.sum(F.col("k") * F.log10(F.col("n") + 1)).alias("light_sum"))
    out = done.select("rid", "doc_id", "held_out", "n_tokens", "n_bytes", "known", "heavy", "score", "form").join(light, "rid", "left")
    if further:  # equal texts have equal sums, and parts are added by their numbers
        by_form = functools.reduce(DataFrame.union, further).groupBy("form").agg(*[F.max(F.when(F.col("part") == part, F.col("sum"))).alias(f"sum_{part}") for part in range(1, parts)])
        out = out.join(by_form, "form").withColumn("score", functools.reduce(Column.__add__, [F.col(f"sum_{part}") for part in range(1, parts)], F.col("score")))
    if not parts:
        by_gram = _exploded(done, "grams", "gram_n").join(table.withColumnRenamed("gram", "item"), "item").groupBy("rid").agg(F.sum(F.col("k") * F.col("log10_p")).alias("gram_score"))
        out = out.join(by_gram, "rid", "left").withColumn("score", F.coalesce("gram_score", "score"))
    base = F.col("heavy") + F.coalesce("light_sum", F.lit(0.0)) + math.log10(texts + 1) - F.col("n_tokens") * math.log10(total + kinds + 1)
    known = F.col("known") + F.coalesce("light_known", F.lit(0)) + int(texts > 0)
    return out.select("doc_id", "held_out", "n_tokens", known.cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), "score", (F.col("score") * -math.log2(10) / F.col("n_bytes")).alias("bits_per_byte"))
