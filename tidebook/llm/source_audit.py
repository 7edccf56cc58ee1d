"""How far the sources of a language differ in their words, in whole numbers throughout.

Counts of (language, source, term) are grouped once.  For the distance of two sources, terms that many sources have go
through dense tiles of integers, a task each; for all others a source's own share of a term it lacks is one number, so
that only the terms a source has, and those that two have in common, correct a base figure.  The parts add up exactly.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.durable import materialize
from .common import Rows, sliced

#: Bytes of a term: letters, of which A-Z become a-z, and all of what isn't ASCII; every other byte parts terms.
LETTERS = bytes(c if c > 0x7F or chr(c).isalpha() else 0x20 for c in bytes(range(256)).lower())
UNIT = 1_000_000_000
#: A term that more sources of a language than this have is heavy.
HEAVY = 8
#: Sources along a side of a tile, and terms in it: 1 MB for each side.
SIDE, TERMS = 256, 512
#: Terms that a task counts before it hands them on, and rows of a table that is sent to all tasks.
HELD, FEW = 200_000, 100_000


def share(count: Column, prior: int) -> Column:
    """1 + floor(10^9 (count + prior) / (N + prior V)); null where nothing is kept."""
    top = (count + F.lit(prior)).cast("decimal(22,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return F.call_function("div", top, F.nullif(F.col("n_all") + F.col("vocabulary") * prior, F.lit(0)).cast("decimal(22,0)")) + 1


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: counted in tasks, in tables of at most about ``HELD`` terms, and grouped once."""

    def count(batches: Rows) -> Rows:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for b in sliced(batches):
            for text, lang, source in zip(*(b.column(c) for c in ("text", "lang", "source")), strict=True):
                terms = text.as_py().encode("utf-8", "surrogatepass").translate(LETTERS).split()
                n, seen = held.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
                before = len(n)
                n.update(terms)
                seen.update(set(terms))
                size += len(n) - before
                if size > HELD:
                    yield from _counted(held)
                    held, size = {}, 0
        yield from _counted(held)

    found = docs.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _counted(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Rows:
    for (lang, source), (n, seen) in held.items():
        terms = list(n)
        columns = [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()), pa.array([seen[t] for t in terms], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])


def few(df: DataFrame) -> DataFrame:
    """A table to join by, sent to all tasks if it is counted to be small, so that no language's rows go to one task."""
    return F.broadcast(df) if df.limit(FEW + 1).count() <= FEW else df


def tile(t: pa.Table, side: int) -> pa.Table:
    """Distances over the terms of a tile: a row without a term gives what a source has of a term that it lacks, and how
    many terms there are, also those that no source of the tile has."""
    g, p = (t.column(c).to_numpy() for c in ("g", "p"))
    lang, left, right = (t.column(c)[0].as_py() for c in ("lang", "left", "right"))
    terms = t.column("term").combine_chunks().dictionary_encode()
    base, place = terms.indices.is_null().to_numpy(zero_copy_only=False), terms.indices.fill_null(-1).to_numpy()
    ids = np.sort(g[base])
    lacks = np.empty(len(ids), np.int64)
    lacks[np.searchsorted(ids, g[base])] = p[base]
    unseen = pc.max(t.column("names")).as_py() - len(terms.dictionary)
    dense = np.repeat(lacks[:, None], len(terms.dictionary), 1)
    dense[np.searchsorted(ids, g[~base]), place[~base]] = p[~base]
    out = []
    for i in np.flatnonzero(ids // side == left):
        others = np.flatnonzero((ids // side == right) & (ids > ids[i]))
        for at in range(0, len(others), 64):
            j = others[at : at + 64]
            out.append(np.stack([np.full(len(j), ids[i]), ids[j], np.abs(dense[j] - dense[i]).sum(1) + unseen * np.abs(lacks[j] - lacks[i])], 1))
    rows = np.concatenate(out) if out else np.empty((0, 3), np.int64)
    return pa.table({"lang": pa.array([lang] * len(rows), pa.string()), "g": pa.array(rows[:, 0]), "h": pa.array(rows[:, 1]), "value": pa.array(rows[:, 2])})


def heavy_pairs(postings: DataFrame, groups: DataFrame, side: int = SIDE, terms: int = TERMS) -> DataFrame:
    """``lang, g, h, value`` with g < h, a row per tile, over heavy postings ``lang, term, g, p``.

    A tile is a block of terms and a pair of blocks of sources; up to ``side`` sources that is each posting once.
    """
    names = postings.select("lang", "term").distinct()
    blocks = names.groupBy("lang").agg(F.ceil(F.count("*") / terms).cast("int").alias("blocks"))
    blocks = few(materialize(blocks, "blocks"))
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")
    sizes = names.join(blocks, "lang").groupBy("lang", block).agg(F.count("*").alias("names"))
    sides = groups.groupBy("lang").agg(F.floor(F.max("g") / side).alias("last"))
    placed = postings.join(blocks, "lang").select("lang", block, "g", "term", "p", F.lit(None).cast("long").alias("names"))
    lacking = groups.join(sizes, "lang").select("lang", "block", "g", F.lit(None).cast("string").alias("term"), F.col("z").alias("p"), "names")
    rows = placed.unionByName(lacking)
    own = F.floor(F.col("g") / side)
    rows = rows.join(few(sides), "lang").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
    rows = rows.select("lang", "block", F.least(own, "other").alias("left"), F.greatest(own, "other").alias("right"), "g", "term", "p", "names")
    return rows.groupBy("lang", "block", "left", "right").applyInArrow(lambda t: tile(t, side), "lang string, g long, h long, value long")


def light_pairs(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, g, h, value`` with g < h, to be added up, over postings of terms that at most ``HEAVY`` sources have.

    Sources that lack a term differ by |z_g - z_h|, all light terms together that times their number.  A source's own
    terms correct that as if the other lacked them, by how often each share occurs; where both have one, once more.
    """
    light = postings.select("lang", "term").distinct().groupBy("lang").agg(F.count("*").alias("light"))
    one = groups.select("lang", F.col("g"), F.col("z"))
    two = few(groups.select("lang", F.col("g").alias("h"), F.col("z").alias("y")))
    apart = lambda a, b: F.abs(F.col(a) - F.col(b))
    base = one.join(two, "lang").where("g < h").join(light, "lang").select("lang", "g", "h", (apart("z", "y") * F.col("light")).alias("value"))
    often = postings.groupBy("lang", "g", "z", "p").agg(F.count("*").alias("often"))
    own = often.join(two, "lang").where("g <> h").groupBy("lang", F.least("g", "h").alias("a"), F.greatest("g", "h").alias("b")).agg(F.sum(F.col("often") * (apart("p", "y") - apart("z", "y"))).alias("value"))
    left, right = postings.select("lang", "term", "g", "p", "z"), postings.select("lang", "term", F.col("g").alias("h"), F.col("p").alias("o"), F.col("z").alias("y"))
    both = left.join(right, ["lang", "term"]).where("g < h").groupBy("lang", "g", "h").agg(F.sum(apart("p", "o") - apart("p", "y") - apart("z", "o") + apart("z", "y")).alias("value"))
    return base.unionByName(own.withColumnsRenamed({"a": "g", "b": "h"})).unionByName(both)


def audit(df: DataFrame, least_docs: int = 30, prior: int = 5, top: int = 50, heavy: int = HEAVY, side: int = SIDE, tile_terms: int = TERMS, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank``: each source's distance to every other one of its language (``pair``),
    and the ``top`` terms that it has more of than the language (``term``).

    A language keeps the terms that at least ``least_docs`` of its rows have.  Null text, language and source are empty
    strings; a group without terms is there with all its pairs; a language without kept terms has pairs of 0 and no
    terms; repeated rows count each; texts are read whole; an empty table gives no rows.  A source with a third of all
    rows is summed per partition before anything moves.  Only the named columns are read.
    """
    empty = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    docs = df.select(empty(text).alias("text"), empty(lang).alias("lang"), empty(source).alias("source"))
    counts = materialize(term_counts(docs), "terms")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_count"), F.sum("docs").alias("lang_docs"), F.count("*").alias("spread")).where(F.col("lang_docs") >= least_docs)
    langs = kept.groupBy("lang").agg(F.count("*").alias("vocabulary"), F.sum("lang_count").alias("n_all"))
    langs = few(materialize(langs, "langs"))
    found = counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_count", "spread")
    found = materialize(found, "kept")
    numbered = docs.select("lang", "source").distinct().withColumn("g", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long"))
    sums = found.groupBy("lang", "source").agg(F.sum("n").alias("n_all"))
    groups = numbered.join(sums, ["lang", "source"], "left").join(langs.select("lang", "vocabulary"), "lang", "left").fillna(0, ["n_all", "vocabulary"])
    groups = materialize(groups.withColumn("z", share(F.lit(0).cast("long"), prior)), "groups")
    postings = found.join(few(groups), ["lang", "source"]).withColumn("p", share(F.col("n"), prior))
    postings = materialize(postings.select("lang", "source", "term", "g", "z", "p", "lang_count", "spread"), "shares")

    over = postings.join(langs, "lang").withColumn("value", F.col("p") - share(F.col("lang_count"), prior)).where("value > 0")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    terms = over.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")

    none = numbered_pairs(groups)
    pairs = none.unionByName(light_pairs(postings.where(F.col("spread") <= heavy), groups)).unionByName(heavy_pairs(postings.where(F.col("spread") > heavy), groups, side, tile_terms))
    pairs = pairs.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", F.explode(F.array(F.struct(F.col("g"), F.col("h")), F.struct(F.col("h").alias("g"), F.col("g").alias("h")))).alias("e"), "value").select("lang", "e.g", "e.h", "value")
    named = pairs.join(few(groups.select("lang", "g", "source")), ["lang", "g"]).join(few(groups.select("lang", F.col("g").alias("h"), F.col("source").alias("item"))), ["lang", "h"])
    farthest = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return named.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(farthest).alias("rank")).unionByName(terms)


def numbered_pairs(groups: DataFrame) -> DataFrame:
    """Every two sources of a language, once, with nothing between them yet: what is asked for is a row per pair."""
    return groups.select("lang", "g").join(groups.select("lang", F.col("g").alias("h")), "lang").where("g < h").withColumn("value", F.lit(0).cast("long"))


ORACLE = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
o AS (SELECT r, lang, source, unnest(terms) AS term FROM d),
c AS MATERIALIZED (SELECT lang, source, term, count(*)::BIGINT AS n, count(DISTINCT r) AS docs FROM o GROUP BY ALL),
k AS MATERIALIZED (SELECT lang, term, sum(n)::BIGINT AS n FROM c GROUP BY ALL HAVING sum(docs) >= 30),
l AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS n FROM k GROUP BY lang),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
s AS (SELECT c.lang, c.source, sum(c.n)::BIGINT AS n FROM c JOIN k ON c.lang = k.lang AND c.term = k.term GROUP BY ALL),
p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (coalesce(s.n, 0) + 5 * l.v) AS p, 1 + (1000000000 * (k.n + 5)) // (l.n + 5 * l.v) AS q
  FROM g JOIN k ON g.lang = k.lang JOIN l ON g.lang = l.lang LEFT JOIN s ON g.lang = s.lang AND g.source = s.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
e AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM e QUALIFY part = 'pair' OR rank <= 50
"""
