"""Product codes of vectors from integer codebooks that are trained over all of them.

Codebooks are small and go to every task; the vectors stay where they were written.  A round is a narrow pass: distances
of a batch to all entries come from norms and one integer matrix product, a partition keeps a sum and a count per entry,
and a grouped shuffle of those adds them up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.durable import materialize
from .common import Rows, sliced
from .topk import scaled

#: Up to this size components, products and distances are exact in 64 bits for parts of up to 4,096 components.
NARROW = 1 << 24
#: Vectors compared at a time: a block of distances holds this many rows of all entries.
STEP = 4_096
#: Labels whose totals are sent to all tasks; beyond, they are joined, each label in ``SALTS`` places.
LABELS, SALTS = 100_000, 32
LONGEST = (1 << 63) - 1


def whole_numbers(v: np.ndarray, wide: bool) -> np.ndarray:
    """Whole doubles as 64-bit integers, or as Python's own where 64 bits might not hold a distance."""
    return np.array([int(x) for x in v.ravel()], object).reshape(v.shape) if wide else v.astype(np.int64)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first nearest entry of each row and its squared distance: |x|^2 - 2 x.b + |b|^2."""
    d = (book * book).sum(1)[None, :] - 2 * (x @ book.T)
    at = d.argmin(1)
    return at, d[np.arange(len(x)), at] + (x * x).sum(1)


def blocks(batches: Iterable[pa.RecordBatch], parts: int, wide: bool) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches with their vectors as ``rows x parts x width``."""
    for b in sliced(batches, STEP):
        if b.num_rows:
            flat = b.column("v").flatten().to_numpy(zero_copy_only=False)
            yield b, whole_numbers(flat, wide).reshape(b.num_rows, parts, -1)


def round_sums(kept: DataFrame, books: list[np.ndarray], wide: bool) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Count and sums of the vectors nearest to each entry, a row per entry, merged on the executors."""
    width = books[0].shape[1]

    def partition(batches: Rows) -> Rows:
        sums = [np.zeros(b.shape, object if wide else np.int64) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for _, v in blocks(batches, len(books), wide):
            for p, book in enumerate(books):
                at, _ = nearest(v[:, p], book)
                order = at.argsort(kind="stable")
                used, first = np.unique(at[order], return_index=True)
                sums[p][used] += np.add.reduceat(v[order, p], first, axis=0)
                counts[p] += np.bincount(at, minlength=len(book))
        rows = [(p, e, int(counts[p][e]), [str(s) if wide else int(s) for s in sums[p][e]]) for p in range(len(books)) for e in np.flatnonzero(counts[p])]
        if rows:
            part, entry, n, s = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n, pa.int64()), pa.array(s, pa.list_(pa.string() if wide else pa.int64()))], ["part", "entry", "n", "s"])

    def merged(t: pa.Table) -> pa.Table:
        total = [str(sum(int(x) for x in column)) for column in zip(*t.column("s").to_pylist(), strict=True)]
        return pa.table({"part": t.column("part")[:1], "entry": t.column("entry")[:1], "n": pa.array([sum(t.column("n").to_pylist())], pa.int64()), "s": pa.array([total], pa.list_(pa.string()))})

    grouped = kept.select("v").mapInArrow(partition, f"part int, entry int, n long, s array<{'string' if wide else 'long'}>").groupBy("part", "entry")
    if wide:
        sums = grouped.applyInArrow(merged, "part int, entry int, n long, s array<string>")
    else:
        exact = [F.sum(F.col("s")[i].cast("decimal(38,0)")) for i in range(width)]
        sums = grouped.agg(F.sum("n").alias("n"), F.array(*exact).alias("s"))
    return {(r["part"], r["entry"]): (r["n"], [int(x) for x in r["s"]]) for r in sums.collect()}


def encode(df: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, vector: str = "embedding", id_col: str = "vec_id", label: str = "label") -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every vector kept.

    Components become floor(1024 x); vectors are cut into ``parts`` equal parts.  A part's codebook starts as that part
    of the ``entries`` vectors of least id; a round assigns every part to its nearest entry (ties: the lower index) and
    replaces each used entry by floor(sum / count).  At most ``parts * entries`` sums reach the driver in a round,
    whatever the table holds.  Arithmetic is exact at any size of component; an error beyond 64 bits shows as the
    largest long.

    Left out: vectors null, empty, holding a null or a component that isn't finite, or of another length than the one of
    least id whose length ``parts`` divides.  Fewer vectors than ``entries``: smaller codebooks.  Ids may repeat, then
    rows start codebooks in order of their components; null ids come last.  Equal rows give equal rows; null labels add
    up together; an empty table gives none.  Only the named columns are read.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits to a part: 1 to 256 entries")
    own = df.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label}`").alias("label"), scaled(F.col(f"`{vector}`")).alias("v"))
    out = f"vec_id {dict(own.dtypes)['vec_id']}, label {dict(own.dtypes)['label']}, code string, error long"
    shape = own.where(F.col("v").isNotNull() & (F.size("v") % parts == 0)).orderBy(F.asc_nulls_last("vec_id"), "v").select(F.size("v")).first()
    size = shape[0] if shape else parts
    kept = materialize(own.where(F.col("v").isNotNull() & (F.size("v") == size)), "vectors")
    largest = kept.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0]
    wide = largest is not None and (largest > NARROW or size // parts > 4_096)
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()
    start = whole_numbers(np.array([r["v"] for r in first], float).reshape(len(first), size), wide).reshape(len(first), parts, size // parts)
    books = [start[:, p].copy() for p in range(parts)]
    for _ in range(rounds if first else 0):
        for (p, e), (n, total) in round_sums(kept, books, wide).items():
            books[p][e] = [s // n for s in total]
    digest = hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()

    def assign(batches: Rows) -> Rows:
        for b, v in blocks(batches, parts, wide):
            found = [nearest(v[:, p], book) for p, book in enumerate(books)]
            codes = np.stack([at for at, _ in found], 1).astype(np.uint8)
            error = [min(int(x), LONGEST) for x in sum(d for _, d in found)]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array([c.tobytes().hex() for c in codes]), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    coded = materialize(kept.mapInArrow(assign, out), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONGEST)).cast("long").alias("label_error")
    totals = coded.groupBy("label").agg(total).withColumnRenamed("label", "of")
    if totals.limit(LABELS + 1).count() <= LABELS:
        joined = coded.join(F.broadcast(totals), F.col("label").eqNullSafe(F.col("of")))
    else:
        places = totals.withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        spread = coded.withColumn("at", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
        joined = spread.join(places, F.col("label").eqNullSafe(F.col("of")) & (F.col("at") == F.col("place")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _oracle(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """DuckDB SQL: a step for each round, as a table of parts and one of entries."""
    steps = [
        f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r, * FROM (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
x AS MATERIALIZED (SELECT r, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS v FROM kept, range({parts}) AS t(p)),
b0 AS MATERIALIZED (SELECT p, (r - 1)::BIGINT AS e, v FROM x WHERE r <= {entries})"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (SELECT r, p, min({{'d': d, 'e': e}}) AS m FROM (
  SELECT x.r, x.p, b.e, list_inner_product(x.v, x.v) - 2 * list_inner_product(x.v, b.v) + list_inner_product(b.v, b.v) AS d FROM x JOIN b{i} b ON x.p = b.p) GROUP BY r, p)"""
        )
        if i < rounds:
            steps.append(
                f"""b{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(n.v, b.v) AS v FROM b{i} b LEFT JOIN (
  SELECT p, e, list(floor(s / c) ORDER BY i) AS v FROM (
    SELECT p, e, i, sum(y) AS s, count(*) AS c FROM (
      SELECT x.p, a.m.e AS e, unnest(x.v) AS y, generate_subscripts(x.v, 1) AS i FROM x JOIN a{i} a ON x.r = a.r AND x.p = a.p) GROUP BY p, e, i) GROUP BY p, e) n USING (p, e))"""
            )
    last = f"""h AS (SELECT sha256(string_agg(array_to_string(list_transform(v, lambda y: y::BIGINT::VARCHAR), ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds}),
c AS (SELECT r, string_agg(lpad(lower(to_hex(m.e)), 2, '0'), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN c USING (r), h"""
    return ",\n".join([*steps, last])


ORACLE = _oracle()
