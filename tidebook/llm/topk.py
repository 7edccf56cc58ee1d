"""Exact top-k inner products: vectors in buckets of like length, each pruned by length or by coordinates.

Buckets are global: rows of like length over the whole table.  Every query first meets the longest vectors, a block of
bounded size that all tasks hold; the k-th score there is a threshold below which nothing counts.  A query is then sent
only to the buckets that its length times the bucket's largest reaches that threshold with, and queries of like reach
travel together, so that short vectors go to few blocks of queries or none.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.durable import materialize
from .common import Rows

SCALE = 1024
#: Vectors and queries that one task holds at once, and vectors of the block that all tasks hold first.
BLOCK, QUERIES, FIRST = 32_768, 16_384, 2_048
#: Buckets of like length over the table, rows compared in a task at a time, and coordinates that these are pruned by.
BUCKETS, STEP, FOCUS = 1_024, 512, 3
#: Below this local cosine threshold, coordinates rule out too little to be looked at.
COSINE = 0.6
#: Products of numbers whose sums stay under this are exact in doubles.
EXACT = 2.0**52
TOP = (1 << 63) - 1
LARGE = int(1e308)


def scaled(vector: Column) -> Column:
    """floor(1024 x) of each component, as doubles; null for a vector that is null, empty or not finite throughout, or
    whose scaled components are not.  From 2^53 on every double is whole, so nothing is cut to a long."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double") * SCALE) == float("inf")))
    whole = lambda y: F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y)
    return F.when(vector.isNotNull() & ~bad & (F.size(vector) > 0), F.transform(vector, lambda x: whole(x.cast("double") * SCALE)))


def sort_key(score: int) -> bytes:
    """Bytes in the order of whole numbers of any size: sign and length, then the number, turned over below zero."""
    size = (abs(score).bit_length() + 7) // 8
    raw = abs(score).to_bytes(size, "big")
    return (0x8000 + size).to_bytes(2, "big") + raw if score >= 0 else (0x8000 - size).to_bytes(2, "big") + bytes(255 - b for b in raw)


def from_key(key: bytes) -> int:
    size = int.from_bytes(key[:2], "big") - 0x8000
    return int.from_bytes(key[2:], "big") if size >= 0 else -int.from_bytes(bytes(255 - b for b in key[2:]), "big")


class Best:
    """The k best (score, id) so far of each of many queries: scores in doubles where these are exact, else whole numbers."""

    def __init__(self, n: int, k: int):
        self.k, self.found = k, [[] for _ in range(n)]
        self.theta = np.full(n, -np.inf)

    def add(self, i: int, scores: list[int], ids: list[int]) -> None:
        kept = sorted([*self.found[i], *zip([-s for s in scores], ids, strict=True)])[: self.k]
        self.found[i] = kept
        if len(kept) == self.k:
            self.theta[i] = max(self.theta[i], float(max(-LARGE, min(LARGE, -kept[-1][0]))))


def lengths(v: np.ndarray) -> np.ndarray:
    top = np.abs(v).max(1, initial=0.0)
    safe = np.where(top > 0, top, 1.0)
    with np.errstate(over="ignore"):
        return top * np.sqrt(((v / safe[:, None]) ** 2).sum(1))


def search_block(q_ids: np.ndarray, q: np.ndarray, theta: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int) -> Best:
    """Each query's k best of one block, the query's own id left out, that reach its ``theta``.

    Vectors come by falling length, ``STEP`` at a time.  A vector can only count if its cosine with the query is at least
    theta / (|q| times the largest length).  Over 1 the rest is done; over ``COSINE`` a step is cut by its query's largest
    coordinates: if x is the unit vector's and f the query's value there, f x + sqrt(1 - f^2) sqrt(1 - x^2) must reach
    that bound.  What is left is verified by whole products; where doubles don't hold these, by Python's integers.
    """
    best = Best(len(q_ids), k)
    best.theta = theta.astype(float).copy()
    limit = math.sqrt(EXACT / max(1, q.shape[1]))
    big_q, big_v = np.abs(q).max(1, initial=0.0) >= limit, np.abs(v).max(1, initial=0.0) >= limit
    for rows, cols in ((np.flatnonzero(big_q), np.arange(len(v))), (np.flatnonzero(~big_q), np.flatnonzero(big_v))):
        wide = [[int(x) for x in v[j]] for j in cols] if len(rows) else []
        for i in rows:
            own = [int(x) for x in q[i]]
            kept = [(sum(x * y for x, y in zip(own, w, strict=True)), int(ids[j])) for w, j in zip(wide, cols, strict=True) if ids[j] != q_ids[i]]
            best.add(i, [s for s, _ in kept], [j for _, j in kept])
    rows, cols = np.flatnonzero(~big_q), np.flatnonzero(~big_v)
    q, v, ids = q[rows], v[cols], ids[cols]
    length, q_length = lengths(v), lengths(q)
    order = np.lexsort((ids, -length))
    ids, v, length = ids[order], v[order], length[order]
    unit, q_unit = v / np.where(length > 0, length, 1)[:, None], q / np.where(q_length > 0, q_length, 1)[:, None]
    focus = np.argsort(-np.abs(q_unit), axis=1)[:, :FOCUS]
    open_ = np.arange(len(rows))
    for at in range(0, len(ids), STEP):
        b = slice(at, at + STEP)
        top = length[b][0]
        bar = best.theta[rows[open_]]
        live = (bar <= 0) | (q_length[open_] * top * (1 + 1e-9) >= bar)  # equal scores still compete by id
        open_, bar = open_[live], bar[live]
        if not len(open_):
            break
        bound = bar * (1 - 1e-9) / np.maximum(q_length[open_] * top, 1e-300)
        sharp = bound >= COSINE
        for i, t in zip(open_[sharp], bound[sharp], strict=True):
            left = ids[b] != q_ids[rows[i]]
            for c in focus[i]:
                f, x = q_unit[i, c], unit[b][:, c]
                left &= f * x + np.sqrt(max(0.0, 1 - f * f)) * np.sqrt(np.maximum(0.0, 1 - x * x)) >= t - 1e-9
            if left.any():
                s = v[b][left] @ q[i]
                near = s >= best.theta[rows[i]]
                best.add(rows[i], s[near].astype(np.int64).tolist(), ids[b][left][near].tolist())
        rest = open_[~sharp]
        for part in np.array_split(rest, max(1, math.ceil(len(rest) / 4096))) if len(rest) else []:
            score = q[part] @ v[b].T
            near = (score >= best.theta[rows[part]][:, None]) & (ids[b][None, :] != q_ids[rows[part]][:, None])
            for p in np.flatnonzero(near.any(1)):
                best.add(rows[part[p]], score[p, near[p]].astype(np.int64).tolist(), ids[b][near[p]].tolist())
    return best


def _dense(vectors: list[list[float]]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Places and matrix of the vectors of each dimension."""
    size = np.array([len(x) for x in vectors], np.int64)
    return {int(d): (at := np.flatnonzero(size == d), np.array([vectors[i] for i in at], float).reshape(-1, int(d))) for d in np.unique(size)}


def _reached(best: Best, places: np.ndarray, rows: pd.DataFrame) -> list[tuple]:
    return [(int(rows["query_id"].iloc[i]), int(rows["form"].iloc[i]), int(x), sort_key(-s)) for j, i in enumerate(places) for s, x in best.found[j]]


def search(df: DataFrame, is_query: Column, k: int = 10, vector: str = "embedding", id_col: str = "vec_id", block: int = BLOCK, queries: int = QUERIES, buckets: int = BUCKETS, first: int = FIRST) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest integer inner products of each query row with every other id.

    Lengths are cut into at most ``buckets`` global buckets by their quantiles, each into blocks of about ``block`` rows;
    query rows go by reach into parts of about ``queries``.  A block and a part meet only if the part's reach covers the
    block's bucket, and each such pair is one task's group, so memory is bounded.  The ``first`` longest vectors, which
    give every query its threshold, are broadcast: that many at most.  The best k of each group are reduced per query.

    Products are exact at any size and ranked as such; the score shown is held within the range of a long.  Vectors that
    are null, empty or hold a null or non-finite component take no part, nor do ids that are null or no whole numbers;
    vectors of another dimension than the query's score nothing; a repeated row is a candidate each time and one query;
    equal scores go to the smaller id.  An empty table gives none.
    """
    rows = df.select(F.col(f"`{id_col}`").try_cast("long").alias("vec_id"), scaled(F.col(f"`{vector}`")).alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query")).where("v is not null and vec_id is not null")
    top = F.array_max(F.transform("v", lambda x: F.abs(x)))
    norm = F.when(F.col("top") > 0, F.col("top") * F.sqrt(F.aggregate("v", F.lit(0.0), lambda acc, x: acc + (x / F.col("top")) * (x / F.col("top"))))).otherwise(0.0)
    rows = materialize(rows.withColumn("top", top).withColumn("norm", norm).drop("top"), "vectors")
    n = rows.count()
    q = rows.where("is_query").dropDuplicates(["vec_id", "v"]).select(F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("form"), "norm", "v")
    m = min(buckets, math.ceil(n / block))
    cuts = sorted(set(rows.agg(F.percentile_approx("norm", [i / m for i in range(1, m)], 10 * buckets).alias("c")).first()["c"]), reverse=True) if m > 1 else []
    # bucket 0 holds the longest: a length falls into the number of cuts that lie above it
    bucket = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c > F.col("norm"))) if cuts else F.lit(0)
    held = rows.orderBy(F.desc("norm"), "vec_id").limit(first).select("vec_id", "v").toArrow()
    started = rows.sparkSession.sparkContext.broadcast((held["vec_id"].to_numpy(), held["v"].to_pylist()))
    del held

    def begin(batches: Iterable[pa.RecordBatch]) -> Rows:
        ids, vectors = started.value
        own = _dense(vectors)
        for b in batches:
            names, asked = b.column("query_id").to_numpy(), b.column("v").to_pylist()
            theta = np.full(len(names), -np.inf)
            for d, (at, m) in _dense(asked).items():
                if d in own:
                    place, base = own[d]
                    theta[at] = search_block(names[at], m, theta[at], ids[place], base, k).theta
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("query_id", "form", "norm", "v")), pa.array(theta)], ["query_id", "form", "norm", "v", "theta"])

    asked = q.mapInArrow(begin, "query_id long, form long, norm double, v array<double>, theta double")
    seen = {r["bucket"]: r for r in rows.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"), F.max("norm").alias("most")).collect()}
    sizes = [seen[i]["n"] if i in seen else 0 for i in range(len(cuts) + 1)]
    most = F.array(*[F.lit(float(seen[i]["most"]) if i in seen else 0.0) for i in range(len(cuts) + 1)])
    reach = F.size(F.filter(most, lambda m: (F.col("theta") <= 0) | (F.col("norm") * m * (1 + 1e-9) >= F.col("theta"))))
    asked = materialize(asked.withColumn("reach", reach), "asked")
    counts = asked.groupBy("reach").agg(F.count("*").alias("n")).orderBy(F.desc("reach")).collect()
    # blocks by bucket, longest first; parts by falling reach: what meets is a prefix of either
    blocks_upto = np.cumsum([0, *(max(1, math.ceil(x / block)) for x in sizes)]).tolist()
    parts = [(c["reach"], max(1, math.ceil(c["n"] / queries))) for c in counts]
    begins = np.cumsum([0, *(p for _, p in parts)]).tolist()
    numbered = {r: (begins[i], p) for i, (r, p) in enumerate(parts)}
    last_part = [sum(p for r, p in parts if r > i) for i in range(len(sizes))]  # parts that reach bucket i
    pick = lambda values, at: F.element_at(F.array(*[F.lit(int(x)) for x in values] or [F.lit(0)]), at + 1)
    deal = lambda key, n: F.pmod(key, n).cast("int")
    by_reach = [numbered.get(r, (0, 1)) for r in range(len(sizes) + 1)]
    left = rows.withColumn("bucket", bucket.cast("int")).withColumn("parts", pick(last_part, F.col("bucket"))).where("parts > 0")
    size_of = pick([blocks_upto[i + 1] - blocks_upto[i] for i in range(len(sizes))], F.col("bucket"))
    left = left.select((pick(blocks_upto[:-1], F.col("bucket")) + deal(F.xxhash64("vec_id", "v"), size_of)).alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "vec_id", "v")
    right = asked.where("reach > 0").select((pick([a for a, _ in by_reach], F.col("reach")) + deal(F.xxhash64("query_id", "form"), pick([p for _, p in by_reach], F.col("reach")))).alias("part"), F.explode(F.sequence(F.lit(0), pick(blocks_upto, F.col("reach")) - 1)).alias("block"), "query_id", "form", "theta", "v")

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        vectors, ids = _dense([*a["v"]]), a["vec_id"].to_numpy(np.int64)
        for d, (at, m) in _dense([*b["v"]]).items():
            if d in vectors:
                place, base = vectors[d]
                names = b["query_id"].to_numpy(np.int64)[at]
                out += _reached(search_block(names, m, b["theta"].to_numpy(float)[at], ids[place], base, k), at, b)
        return pd.DataFrame(out, columns=["query_id", "form", "vec_id", "key"])

    best = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(run, "query_id long, form long, vec_id long, key binary")
    rank = F.row_number().over(Window.partitionBy("query_id", "form").orderBy(F.desc("key"), "vec_id"))

    def shown(batches: Iterable[pa.RecordBatch]) -> Rows:
        for b in batches:
            score = [max(-TOP - 1, min(TOP, from_key(x))) for x in b.column("key").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("query_id"), b.column("rank"), b.column("vec_id"), pa.array(score, pa.int64())], ["query_id", "rank", "vec_id", "score"])

    ranked = best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "key")
    return ranked.mapInArrow(shown, "query_id long, rank int, vec_id long, score long")


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
