"""Chat formatting: logged snapshots of a growing conversation collapse into the longest; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ORDER = ("turn", "role", "text")


def prefixes(df: DataFrame) -> DataFrame:
    """Per turn ``conv_id, pos, n_turns, h1, h2``: the hash of the conversation up to it, rolled turn by turn.

    Each turn's hash holds its position, so the xor of those so far is that of the ordered prefix.  Two seeds make
    128 bits.  Turns are in order of ``turn``, then role and text, nulls first.
    """
    w = Window.partitionBy("conv_id").orderBy(*ORDER)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = df.select("conv_id", *ORDER).withColumn("pos", F.row_number().over(w))
    said = [F.coalesce(F.col(c), F.lit("")) for c in ("role", "text")] + [F.col(c).isNull() for c in ("role", "text")]
    rows = rows.withColumn("h1", F.xxhash64("pos", *said)).withColumn("h2", F.xxhash64(F.lit("second"), *reversed(said), "pos"))
    return rows.select("conv_id", "pos", F.count("*").over(Window.partitionBy("conv_id")).alias("n_turns"), F.bit_xor("h1").over(so_far).alias("h1"), F.bit_xor("h2").over(so_far).alias("h2"))


def maximal(df: DataFrame) -> DataFrame:
    """``conv_id`` of the conversations that are no prefix of a longer one; of equal ones, that of the least id.

    Whole and inner prefixes are made distinct before they meet, so a first turn or conversation that many share
    is one row on either side.
    """
    rolled = prefixes(df)
    whole = rolled.where("pos = n_turns").groupBy("pos", "h1", "h2").agg(F.min(F.struct(F.col("conv_id").isNull().alias("none"), "conv_id")).alias("kept"))
    inner = rolled.where("pos < n_turns").select("pos", "h1", "h2").distinct()
    return whole.join(inner, ["pos", "h1", "h2"], "left_anti").select(F.col("kept.conv_id").alias("conv_id"), F.col("pos").cast("long").alias("n_turns"))


def render(df: DataFrame) -> DataFrame:
    """``conv_id, n_turns, text``: the maximal conversations, each turn as <|role|>, its text and <|end|>.

    A missing role reads ``unknown`` and a missing text is empty; rows without a conversation id are one conversation,
    with a null id; repeated rows are repeated turns; an empty table gives none.  Other columns play no part.  One
    conversation is one row of the result, so one task joins its turns, however long it is.
    """
    kept = maximal(df).withColumnRenamed("conv_id", "kept_id")
    turns = df.select("conv_id", *ORDER).join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id")))
    part = lambda x: F.concat(F.lit("<|"), F.coalesce(x["role"], F.lit("unknown")), F.lit("|>\n"), F.coalesce(x["text"], F.lit("")), F.lit("<|end|>\n"))
    said = F.sort_array(F.collect_list(F.struct(*ORDER)))
    return turns.groupBy("conv_id").agg(F.first("n_turns").alias("n_turns"), said.alias("said")).select("conv_id", "n_turns", F.array_join(F.transform("said", part), "").alias("text"))


ORACLE = """
WITH t AS (SELECT conv_id, turn, role, text, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n,
             '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS part
           FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)),
p AS (SELECT conv_id, pos, n, string_agg(part, '') OVER (PARTITION BY conv_id ORDER BY pos) AS said FROM t),
f AS (SELECT min(conv_id) AS conv_id, n, said FROM p WHERE pos = n GROUP BY n, said)
SELECT conv_id, n::BIGINT AS n_turns, said AS text FROM f
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.pos < p.n AND p.pos = f.n AND p.said = f.said)
"""
