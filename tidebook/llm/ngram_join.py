"""N-gram Jaccard join: rare-first prefixes with length, positional and suffix filters; each pair verified once.

Texts with equal shingle sets are one class from the start, so copies never meet each other.  Classes that share a
prefix shingle first meet the leader of that shingle alone; components of what this links leave only pairs between
different components to look at, so a large group of near copies costs a row per member and not one per pair.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.durable import materialize, release
from .common import Rows, free_name, sliced, tidied, word_bytes
from .components import components

#: Shingles that all tasks know to be common, at most: the most frequent of all, nine bytes each.
COMMON = 1_000_000
#: Among all others order is by a sketch of about as many buckets as there are shingles, 2^25 at most, half a byte each,
#: and by as many bytes again, a bit for each of four times as many buckets: whether it holds a shingle of two texts.
MOST_BITS = 25
_MARK_BITS = 2
#: Bits of a key that shingles are counted by, log2 of the chunks of keys, keys that a task gathers before it folds them in, and keys
#: that it holds before it sends them: few, since a copy or two of them is made on the way and each core has a worker.
_KEY_BITS, _CHUNK_BITS, _FRESH, _HELD = 44, 12, 200_000, 600_000
_KEY_SHIFT, _REST = np.uint64(64 - _KEY_BITS), np.uint64(_KEY_BITS - _CHUNK_BITS)
#: Most ids of texts to verify that are broadcast, rather than joined by a shuffle.
BROADCAST_IDS = 1_000_000
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(29), np.uint64(32))


def shingles(text: str | None, words: int) -> np.ndarray:
    """The set of 64-bit hashes of a text's shingles, rising; a text of fewer words is one shingle, none is empty."""
    found = word_bytes(text)
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) < words:
        return np.array([xxhash.xxh3_64_intdigest(b"\0".join(found), len(found))], np.uint64)
    h = np.array(list(map(xxhash.xxh3_64_intdigest, found)), np.uint64)
    n = len(h) - words + 1
    code = h[:n]
    for i in range(1, words):
        code = (code ^ (code >> _MIX[2])) * _MIX[0] + h[i : i + n]
    code = (code ^ (code >> _MIX[3])) * _MIX[1]
    code = code ^ (code >> _MIX[2])
    code.sort()
    return code[np.concatenate(([True], code[1:] != code[:-1]))] if n > 1 else code


def prefix_length(n: int, percent: int) -> int:
    """How many shingles of a set must be looked at so that any set of that similarity shares one of them."""
    return n - (percent * n + 99) // 100 + 1


def needed(a: Column, b: Column, percent: int) -> Column:
    """The least overlap of sets of these sizes at that similarity."""
    return F.ceil((a + b) * percent / (100 + percent))


def behind(n: Column, percent: int) -> Column:
    """How many shingles of a set are not in its prefix."""
    return F.floor((n * percent + 99) / 100) - 1


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.add.reduceat(n, at) if len(at) else n


def _folded(keys: np.ndarray, n: np.ndarray, fresh: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two rising lists of distinct keys as one, counts added; only the new keys are put in, nothing is put in order again."""
    place = np.searchsorted(keys, fresh)
    known = place < len(keys)
    known[known] = keys[place[known]] == fresh[known]
    n[place[known]] += more[known]
    new = ~known
    return np.insert(keys, place[new], fresh[new]), np.insert(n, place[new], more[new])


def sketch_bits(texts: DataFrame, most: int = MOST_BITS) -> int:
    """log2 of the buckets for these texts, at a shingle to eight characters."""
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    return max(17, min(most, int(chars // 8).bit_length()))


def _packed(keys: np.ndarray, n: np.ndarray) -> Rows:
    """A row per chunk of rising keys: differences of 32 bits by bytes of like weight, and the counts, nearly all ones."""
    cuts = np.searchsorted(keys, np.arange((1 << _CHUNK_BITS) + 1, dtype=np.uint64) << _REST)
    filled = np.flatnonzero(cuts[1:] > cuts[:-1]).tolist()
    for some in (filled[at : at + 256] for at in range(0, len(filled), 256)):
        data = [[], []]
        for own in (slice(cuts[chunk], cuts[chunk + 1]) for chunk in some):
            rest = keys[own] & np.uint64((1 << int(_REST)) - 1)
            steps = np.diff(rest, prepend=np.uint64(0)).astype("<u4").view(np.uint8).reshape(-1, 4)
            for out, x in zip(data, (steps.T.tobytes(), n[own].astype("<u4").tobytes()), strict=True):
                out.append(zlib.compress(x, 1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *(pa.array(x, pa.binary()) for x in data)], ["chunk", "steps", "counts"])


def _unpacked(steps: pa.Scalar, counts: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zlib.decompress(steps.as_buffer()), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").reshape(-1), dtype=np.uint64), np.frombuffer(zlib.decompress(counts.as_buffer()), "<u4").astype(np.int64)


def common_shingles(texts: DataFrame, words: int, most: int = COMMON, most_bits: int = MOST_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What :func:`known_shingles` tells but for the marks."""
    return known_shingles(texts, words, most, most_bits)[:3]


def known_shingles(texts: DataFrame, words: int, most: int = COMMON, most_bits: int = MOST_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent shingles by rising key, with log2 of how many texts hold them, a sketch for all others, and marks.

    The list holds all shingles that are in at least 2^c texts, for the least c of 2 or more with which they are ``most``
    or fewer.  The sketch has half a byte per bucket of keys: log2 of how many texts' shingles fall there, rounded up.
    The marks have a bit per smaller bucket: whether any shingle there is in two texts or more.  Single shingles fill the
    sketch, but not the marks; where there is no mark, a shingle is in one text alone.
    Every shingle of every text is counted, where its chunk of keys is summed.  However much text there is, and however
    full the sketch, prefixes keep clear of what the list holds.
    """
    bits = sketch_bits(texts, most_bits)

    def count(batches: Iterable[pa.RecordBatch]) -> Rows:
        key, n, new, size = np.zeros(0, np.uint64), np.zeros(0, np.uint32), [], 0

        def fold() -> tuple[np.ndarray, np.ndarray]:
            fresh = np.concatenate([np.zeros(0, np.uint64), *new])
            new.clear()
            fresh.sort()
            at = np.flatnonzero(np.concatenate(([True], fresh[1:] != fresh[:-1]))) if len(fresh) else np.zeros(0, np.int64)
            return _folded(key, n, fresh[at], np.diff(np.append(at, len(fresh))).astype(np.uint32))

        for b in sliced(batches):
            for t in b.column(0).to_pylist():
                new.append(shingles(t, words) >> _KEY_SHIFT)
                size += len(new[-1])
                if size > _FRESH:
                    key, n = fold()
                    size = 0
                    if len(key) > _HELD:
                        yield from _packed(key, n)
                        key, n = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        yield from _packed(*fold())

    def add(batches: Iterable[pa.RecordBatch]) -> Rows:
        chunk, keys, counts = None, [], []

        def told() -> Rows:
            k, n = _summed(np.concatenate(keys), np.concatenate(counts))
            place = (k >> np.uint64(_KEY_BITS - bits)).astype(np.int64)
            full = np.bincount(place, n, 1 << (bits - _CHUNK_BITS))
            half = np.minimum(np.ceil(np.log2(np.maximum(full, 1))), 15).astype(np.uint8)
            marks = np.zeros(1 << (bits + _MARK_BITS - _CHUNK_BITS), bool)
            marks[k[n > 1] >> np.uint64(_KEY_BITS - bits - _MARK_BITS)] = True
            code = np.floor(np.log2(n)).astype(np.uint8)
            often = code >= 2
            k, code = k[often] | (np.uint64(chunk) << _REST), code[often]
            tally = np.bincount(code, minlength=64).tolist()
            data = [k.astype("<u8").tobytes(), code.tobytes(), (half[::2] | half[1::2] << 4).tobytes(), np.packbits(marks, bitorder="little").tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), *(pa.array([x], pa.binary()) for x in data), pa.array([tally], pa.list_(pa.int64()))], ["chunk", "keys", "codes", "sketch", "marks", "tally"])

        for b in batches:
            for c, steps, n in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                if c != chunk and keys:
                    yield from told()
                    keys, counts = [], []
                chunk = c
                for own, x in zip((keys, counts), _unpacked(steps, n), strict=True):
                    own.append(x)
                if sum(map(len, keys)) > 2_000_000 and len(keys) > 1:
                    k, m = _summed(np.concatenate(keys), np.concatenate(counts))
                    keys, counts = [k], [m]
        if keys:
            yield from told()

    dealt = texts.select("text").mapInArrow(tidied(count), "chunk int, steps binary, counts binary").repartition("chunk").sortWithinPartitions("chunk")
    found = materialize(dealt.mapInArrow(tidied(add), "chunk int, keys binary, codes binary, sketch binary, marks binary, tally array<long>"), "common")
    tally = np.zeros(64, np.int64)
    for r in found.select(F.posexplode("tally").alias("code", "n")).groupBy("code").agg(F.sum("n").alias("n")).collect():
        tally[r["code"]] = r["n"]
    bar = next((c for c in range(2, 64) if tally[c:].sum() <= most), 64)

    def above(batches: Iterable[pa.RecordBatch]) -> Rows:
        for b in batches:
            for keys, codes in zip(b.column(0), b.column(1), strict=True):
                code = np.frombuffer(codes.as_buffer(), np.uint8)
                kept = code >= bar
                yield pa.RecordBatch.from_arrays([pa.array([np.frombuffer(keys.as_buffer(), "<u8")[kept].tobytes()], pa.binary()), pa.array([code[kept].tobytes()], pa.binary())], ["keys", "codes"])

    got = found.select("keys", "codes").mapInArrow(tidied(above), "keys binary, codes binary").toArrow()
    sketch, marks = np.zeros(1 << (bits - 1), np.uint8), np.zeros(1 << (bits + _MARK_BITS - 3), np.uint8)
    for r in found.select("chunk", "sketch", "marks").toLocalIterator():
        for whole, own in ((sketch, r["sketch"]), (marks, r["marks"])):
            whole[r["chunk"] * len(own) : (r["chunk"] + 1) * len(own)] = np.frombuffer(own, np.uint8)
    release(found)
    keys = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(x.as_buffer(), "<u8") for x in got["keys"])])
    codes = np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(x.as_buffer(), np.uint8) for x in got["codes"])])
    order = np.argsort(keys)
    return keys[order], codes[order], sketch, marks


class Commonness:
    """An order of shingles, rarest first: by the sketch those that the list doesn't hold, and after them those it does.
    Nought has a shingle that no other text holds, as sketch or marks tell."""

    MAP = np.uint64(_KEY_BITS - 22)

    def __init__(self, keys: np.ndarray, codes: np.ndarray, sketch: np.ndarray, marks: np.ndarray | None = None):
        self.keys, self.codes, self.sketch, self.marks = keys, codes, sketch, marks
        self.bucket = np.uint64(_KEY_BITS - (2 * len(sketch)).bit_length() + 1)
        self.seen = np.zeros(1 << 22, bool)
        self.seen[keys >> self.MAP] = True

    def __call__(self, shingles_: np.ndarray) -> np.ndarray:
        key = shingles_ >> _KEY_SHIFT
        at = (key >> self.bucket).astype(np.int64)
        out = self.sketch[at >> 1] >> ((at & 1) << 2).astype(np.uint8) & 15
        if self.marks is not None:
            at = (key >> (self.bucket - np.uint64(_MARK_BITS))).astype(np.int64)
            out *= self.marks[at >> 3] >> (at & 7).astype(np.uint8) & 1
        at = np.flatnonzero(self.seen[key >> self.MAP])
        if len(at):
            place = np.minimum(np.searchsorted(self.keys, key[at]), len(self.keys) - 1)
            hit = self.keys[place] == key[at]
            out[at[hit]] = self.codes[place[hit]] + 16
        return out


def prefixes(texts: DataFrame, words: int, percent: int, often: Broadcast) -> DataFrame:
    """``rid, doc_id, n, able, common, set_key, prefix`` per text: the key names the set, the prefix holds its rarest
    shingles, rarest first, but for those that no other text holds, ``able`` is how many shingles another text may hold,
    and ``common`` how frequent they are on the whole."""

    def run(batches: Iterable[pa.RecordBatch]) -> Rows:
        commonness = Commonness(*often.value)
        for b in sliced(batches):
            n, able, keys, rare, common = [], [], [], [], []
            for t in b.column(1).to_pylist():
                s = shingles(t, words)
                n.append(len(s))
                keys.append(hashlib.md5(s.tobytes()).digest())
                take = prefix_length(len(s), percent) if len(s) else 0
                code = commonness(s)
                common.append(float(code.mean()) if len(s) else 0.0)
                able.append(np.count_nonzero(code))
                first = np.argsort(code, kind="stable")[:take]
                rare.append(s[first[code[first] > 0]].view(np.int64))
            cuts = np.cumsum([0, *map(len, rare)])
            lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate(rare) if rare else np.zeros(0, np.int64), pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(able, pa.int64()), pa.array(common, pa.float32()), pa.array(keys, pa.binary()), lists], ["doc_id", "n", "able", "common", "set_key", "prefix"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    rows = texts.select("doc_id", "text").mapInArrow(tidied(run), f"doc_id {kind}, n long, able long, common float, set_key binary, prefix array<long>")
    return rows.withColumn("rid", F.monotonically_increasing_id())


def _sets(texts: DataFrame, classes: DataFrame, wanted: DataFrame, words: int, broadcast_ids: int) -> DataFrame:
    """``cid, items``: the sets of the classes in ``wanted`` (column ``cid``), made again from one text of each."""
    ids = materialize(classes.join(wanted, "cid", "left_semi").select("cid", "doc_id", "set_key"), "wanted")
    named = ids.select(F.col("doc_id").alias("id")).distinct()
    small = named.count() <= broadcast_ids
    near = texts.join(F.broadcast(named) if small else named, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")

    def run(batches: Iterable[pa.RecordBatch]) -> Rows:
        for b in sliced(batches):
            items = [shingles(t, words).tobytes() for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([hashlib.md5(x).digest() for x in items], pa.binary()), pa.array(items, pa.binary())], ["set_key", "items"])

    made = near.select("text").mapInArrow(tidied(run), "set_key binary, items binary")
    return made.join(ids.select("cid", "set_key"), "set_key").dropDuplicates(["cid"]).select("cid", "items")


def overlap_at_least(a: np.ndarray, b: np.ndarray, least: int) -> bool:
    """Whether two rising arrays share that many.  First the suffix filter: parts between common pivots that differ
    in size by more than the sets may differ rule a pair out without a merge."""
    if len(a) > 8:
        pivots = a[len(a) // 4 :: max(1, len(a) // 4)]
        parts = [np.diff(np.searchsorted(x, pivots), prepend=0, append=len(x)) for x in (a, b)]
        if np.abs(parts[0] - parts[1]).sum() > len(a) + len(b) - 2 * least:
            return False
    return len(np.intersect1d(a, b, assume_unique=True)) >= least


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows ``a, b`` of ``pairs`` whose sets are similar enough."""

    def run(batches: Iterable[pa.RecordBatch]) -> Rows:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                u, v = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                keep.append(overlap_at_least(u, v, -(-percent * (len(u) + len(v)) // (100 + percent))))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left, right = sets.select(F.col("cid").alias("a"), F.col("items").alias("items_a")), sets.select(F.col("cid").alias("b"), F.col("items").alias("items_b"))
    rows = pairs.join(right, "b").join(left, "a").select("a", "b", "items_a", "items_b")
    return rows.mapInArrow(tidied(run), "a long, b long")


def join_classes(texts: DataFrame, words: int, percent: int, common: int = COMMON, broadcast_ids: int = BROADCAST_IDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (``rid, doc_id, n, set_key``), classes (``cid, set_key, doc_id``) and roots (``node, root`` over cids).

    The leader of a shingle is the class whose shingles are the most frequent: in a group of near copies, the one that
    the others differ from.  Between components a pair comes up at its first common prefix shingle only, and only if
    the shingles common to both prefixes and all that follows the shorter of them can reach the overlap: a common
    shingle no later than the end of either prefix is in both, so the rest of one set bounds what is still to come.

    A shingle's leader and components are grouped minima, joined back, so that a hot shingle is aggregated before it
    moves, and what meets by shingle are joins, whose skewed partitions adaptive execution splits.
    """
    often = texts.sparkSession.sparkContext.broadcast(known_shingles(texts, words, common))
    rows = materialize(prefixes(texts, words, percent, often), "prefixes")
    often.destroy()  # the rows are in a table
    filled = rows.where("n > 0")
    first = filled.groupBy("set_key").agg(F.min("rid").alias("rid"))
    kept = filled.join(first.select("rid"), "rid", "left_semi")
    postings = kept.select(F.col("rid").alias("cid"), "n", "able", "common", F.explode("prefix").alias("token"))
    lead = postings.groupBy("token").agg(F.count("*").alias("m"), F.min(F.struct((-F.col("common")).alias("x"), "n", "cid", "able")).alias("l")).where("m > 1")
    met = postings.join(lead, "token").select("token", "cid", "n", "able", F.col("l.cid").alias("leader"), F.col("l.n").alias("leader_n"), F.col("l.able").alias("leader_able"))
    met = materialize(met, "met")
    classes = materialize(kept.select(F.col("rid").alias("cid"), "set_key", "doc_id"), "classes")
    like = lambda x, y: (x * 100 >= y * percent) & (y * 100 >= x * percent)
    enough = F.least("able", "leader_able") >= needed(F.col("leader_n"), F.col("n"), percent)
    star = materialize(met.where((F.col("cid") != F.col("leader")) & like(F.col("leader_n"), F.col("n")) & enough).select(F.col("leader").alias("a"), F.col("cid").alias("b")).distinct(), "star")
    ends = lambda p: p.select(F.col("a").alias("cid")).union(p.select("b")).distinct()
    links = verified(star, _sets(texts, classes, ends(star), words, broadcast_ids), percent)
    roots = materialize(components(links), "roots")

    part = met.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    mixed = part.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("token")
    apart = part.join(mixed, "token").select("token", "cid", "n", "able", "root")
    apart = materialize(apart.join(rows.select(F.col("rid").alias("cid"), "prefix"), "cid"), "apart")
    x, y = apart.alias("x"), apart.alias("y")
    first_n, second_n = F.col("x.n"), F.col("y.n")
    length = (first_n * 100 >= second_n * percent) & ((first_n < second_n) | ((first_n == second_n) & (F.col("x.cid") < F.col("y.cid"))))
    both = F.array_intersect("x.prefix", "y.prefix")
    rest = F.greatest(behind(first_n, percent), behind(second_n, percent))
    once = (F.get(both, F.lit(0)) == F.col("x.token")) & (F.size(both) + rest >= needed(first_n, second_n, percent))
    enough = F.least("x.able", "y.able") >= needed(first_n, second_n, percent)
    more = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.root") != F.col("y.root")) & length & enough & once)
    tried = star.select(F.least("a", "b").alias("c"), F.greatest("a", "b").alias("d"))
    more = more.select(F.col("x.cid").alias("a"), F.col("y.cid").alias("b"))
    more = materialize(more.join(tried, (F.least("a", "b") == F.col("c")) & (F.greatest("a", "b") == F.col("d")), "left_anti"), "more")
    release(met, apart)
    late = verified(more, _sets(texts, classes, ends(more), words, broadcast_ids), percent)
    named = lambda c: (roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")), c)
    late = late.join(*named("a"), "left").join(*named("b"), "left").select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b"))
    joined = components(late)
    up = joined.select(F.col("node").alias("root"), F.col("root").alias("top"))
    both = roots.join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    rest = joined.select("node", "root").join(roots.select("node"), "node", "left_anti")
    return rows.select("rid", "doc_id", "n", "set_key"), classes, both.union(rest)


def label(df: DataFrame, words: int = 5, percent: int = 80, text: str = "text", id_col: str = "doc_id", common: int = COMMON, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """Per input row ``doc_id, n_shingles, component_id``.

    Sets are compared by 64-bit shingle hashes: two different shingles of one pair of texts of 10,000 share one with a
    chance of some 1e-11, which could change a count by one; no link is made or lost by anything else.  ``component_id`` is the least id of the rows that a row reaches by links
    of at least ``percent`` per cent similarity, its own among them.  Null and empty texts have no shingles and link with
    nothing, so their component is their own id; texts of fewer words than a shingle link if all words are equal; repeated
    rows and repeated ids are rows of their own; a null id gives way to any other; an empty table gives no rows; other
    columns play no part.
    """
    texts = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows, classes, roots = join_classes(texts, words, percent, common, broadcast_ids)
    least = rows.where("n > 0").groupBy("set_key").agg(F.min("doc_id").alias("least"))
    top = classes.join(least, "set_key").join(roots.withColumnRenamed("node", "cid"), "cid", "left").select("set_key", "least", F.coalesce("root", "cid").alias("root"))
    ends = top.groupBy("root").agg(F.min("least").alias("component_id"))
    named = top.join(ends, "root").select("set_key", "component_id")
    out = rows.join(named, "set_key", "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(df: DataFrame, words: int = 5, percent: int = 80, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Of each group of linked rows the one of least id stays, null ids last; equal ids are told apart by a hash of the
    text, and rows that repeat both by a hash of all columns.

    Rows are judged by themselves, never by another row of their id.  Rows without shingles all stay.
    """
    key = lambda: F.struct(F.col(f"`{id_col}`").isNull().alias("none"), F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("form"))
    named = label(df.select(key().alias("key"), F.col(f"`{text}`").alias("text")), words, percent, "text", "key").where("n_shingles > 0")
    named = materialize(named.select(F.col("doc_id").alias("key"), F.col("component_id").alias("first")), "named")
    own = free_name(df, "own_key")
    marked = df.withColumn(own, key())
    out = free_name(df, "gone_key")
    gone = _sized(named.where("key <> first").select(F.col("key").alias(out)).distinct(), "gone")
    left = marked.join(gone, F.col(own) == F.col(out), "left_anti")
    again = _sized(named.where("key = first").groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("key").alias(out)), "again")
    place = free_name(df, "place")
    order = Window.partitionBy(own).orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    once = left.join(again, F.col(own) == F.col(out), "left_semi").withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(place)
    return left.join(again, F.col(own) == F.col(out), "left_anti").unionByName(once).drop(own)


def _sized(ids: DataFrame, name: str) -> DataFrame:
    """Ids to join texts with: broadcast if they are few, which is counted on a written table."""
    kept = materialize(ids, name)
    return F.broadcast(kept) if kept.count() <= BROADCAST_IDS else kept


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM d),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS t FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.t = b.t AND a.doc_id <> b.doc_id AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
r AS (SELECT doc_id AS a, doc_id AS c FROM d UNION SELECT p.a, r.c FROM r JOIN p ON p.b = r.a)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, min(r.c) AS component_id FROM s JOIN r ON r.a = s.doc_id GROUP BY s.doc_id, s.g
"""
