"""Mixing sources to target weights by Efraimidis-Spirakis keys; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD

SEED = "mix-1"
#: Key ranges within a source; each is prefix-summed in a task of its own.
RANGES = 4096
SYMBOL = r"[#*$%&|<>]"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """In (0, 1]: 1 without symbol marks, less the more of them there are to a word."""
    return (size + 1) / (size + 1 + F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SYMBOL)))


def uniform(id_text: Column, seed: str = SEED) -> Column:
    """In (0, 1), from 52 bits of a digest of the id, so that reruns agree on any cluster."""
    return (F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), id_text)), 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)


def targets(sources: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """``skey, source_size, target`` from one row per source with ``source`` and ``source_size``.

    Weights repeat over sources by code point, null last.  All targets together are all sizes.  A source is held at
    ``cap`` times its size if its share, once those with less size to a weight are held, still exceeds that; the
    comparison is of whole numbers.  One window over the sources, of which there is one row each.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("w", F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    every = Window.partitionBy(F.lit(0))
    fill = every.orderBy(F.col("source_size") * cap / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    size_left = F.sum("source_size").over(every) - F.coalesce(F.sum(F.col("source_size") * cap).over(fill), F.lit(0))
    weight_left = F.sum("w").over(every) - F.coalesce(F.sum("w").over(fill), F.lit(0))
    held = ranked.withColumn("held", size_left * F.col("w") > F.col("source_size") * cap * weight_left)
    rest = F.sum("source_size").over(every) - F.coalesce(F.sum(F.when(F.col("held"), F.col("source_size") * cap)).over(every), F.lit(0))
    share = rest / F.sum(F.when(F.col("held"), 0).otherwise(F.col("w"))).over(every) * F.col("w")
    return held.withColumn("target", F.when(F.col("held"), (F.col("source_size") * cap).cast("double")).otherwise(share)).select("skey", "source_size", "target")


def mix(df: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, carry: tuple[str, ...] = (), text: str = "text", source: str = "source", id_col: str = "doc_id") -> DataFrame:
    """Per input row ``doc_id, size, source_size, target, taken``, with the columns in ``carry`` as ``carried``.

    Rows of a source are in order of the key -ln(u)/quality, so that rows of good quality tend to come first.  Every
    row gives floor(target / source size) whole epochs; the remaining words are taken along that order by prefix sums,
    the row at the end in part.  Prefix sums run in two steps, over sums of key ranges and within a range, so a source
    with a third of all rows is spread over many tasks; the one shuffle carries no text unless asked to.

    Null text has size 0 and gives nothing; a null source is a source of its own, the last; a null id hashes as empty;
    equal ids share a key and are ordered by size; an empty table gives none.  Only the named columns are read.
    """
    own = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), F.col(f"`{text}`").alias("text"), *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried")] if carry else []))
    sized = own.withColumn("size", word_count(F.col("text"))).withColumn("skey", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    u = uniform(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    keyed = sized.withColumn("key", -F.log(u) / quality_weight(F.col("text"), F.col("size"))).drop("text")
    keyed = keyed.withColumn("range", F.floor((1 - F.exp(-F.col("key"))) * RANGES).cast("int"))
    sums = keyed.groupBy("source", "skey", "range").agg(F.sum("size").alias("range_size"))
    plan = targets(sums.groupBy("source", "skey").agg(F.sum("range_size").alias("source_size")), weights, cap)
    along = Window.partitionBy("skey").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("range_start", F.coalesce(F.sum("range_size").over(along), F.lit(0))).join(plan, "skey").select("skey", "range", "range_start", "source_size", "target")
    within = Window.partitionBy("skey", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.drop("source").join(starts, ["skey", "range"]).withColumn("before", F.col("range_start") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    epochs = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(cap))).otherwise(0).cast("long")
    left = F.floor("target").cast("long") - epochs * F.col("source_size") - F.col("before")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(left, F.col("size")))
    return placed.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), *(["carried"] if carry else []))


def mixed_documents(df: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """The documents of the mix, with the columns of ``df``: a row per whole copy taken, and one with the first words
    of a copy taken in part (then with single blanks between them).  ``n_chars``, where there, follows the text."""
    columns = tuple(df.columns)
    got = mix(df, weights, cap, columns).where("taken > 0")
    whole = (F.col("taken") / F.col("size")).cast("long")
    rows = got.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("taken") / F.col("size")))))
    words = F.col("taken") - whole * F.col("size")
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col("carried.text"), F.lit(WORD), F.lit(0)), F.lit(1), F.greatest(words, F.lit(0)).cast("int")), " ")
    text = F.when(F.col("copy") <= whole, F.col("carried.text")).otherwise(cut)
    rows = rows.withColumn("new_text", text)
    value = {"text": F.col("new_text"), "n_chars": F.length("new_text").cast(dict(df.dtypes).get("n_chars", "long"))}
    return rows.select(*[value.get(c, F.col(f"carried.`{c}`")).alias(c) for c in columns])


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::BIGINT AS marks,
         (('0x' || substr(md5('mix-1|' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM documents),
k AS (SELECT *, -ln(u) / ((size + 1)::DOUBLE / (size + 1 + marks)::DOUBLE) AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS w FROM s),
f AS (SELECT *, sum(source_size) OVER () AS total,
        sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER p, 0) AS size_left, sum(w) OVER () - coalesce(sum(w) OVER p, 0) AS weight_left
      FROM r WINDOW p AS (ORDER BY 3 * source_size / w::DOUBLE, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
h AS (SELECT *, size_left * w > 3 * source_size * weight_left AS held FROM f),
t AS (SELECT source, source_size, CASE WHEN held THEN (3 * source_size)::DOUBLE
        ELSE (total - coalesce(sum(CASE WHEN held THEN 3 * source_size END) OVER (), 0))::DOUBLE / (sum(CASE WHEN held THEN 0 ELSE w END) OVER ())::DOUBLE * w::DOUBLE END AS target FROM h),
o AS (SELECT k.doc_id, k.size, t.source_size, t.target,
        coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY key, doc_id, k.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
        CASE WHEN t.source_size > 0 THEN least(floor(t.target / t.source_size)::BIGINT, 3) ELSE 0 END AS epochs
      FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(floor(target)::BIGINT - epochs * source_size - before, size)))::BIGINT AS taken
FROM o
"""
