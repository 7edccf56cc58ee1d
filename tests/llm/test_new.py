"""Vector codes, source distances and shards against plain versions and DuckDB."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tidebook.llm import queries, sharding, source_audit, vector_codes

DATA = "/root/testdata/sf0.01"
LONG = " ".join(f"w{i % 977}" for i in range(200_000))


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_source_audit"])
def test_same_rows_as_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    want = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in want.description]
    got = queries.queries()[name](spark, DATA)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(str, map(tuple, got.select(names).collect()))) == sorted(map(str, want.fetchall()))


# --- codes -----------------------------------------------------------------------------------------------------------
def plain_codes(rows, parts, entries, rounds):
    """``rows`` of (id, whole components), by Python's own numbers."""
    width = len(rows[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    first = [v for _, v in sorted(rows)[:entries]]
    books = [[cut(v, p) for v in first] for p in range(parts)]
    pick = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for _, v in rows:
                held[pick(cut(v, p), books[p])[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(held[i]) for c in zip(*held[i], strict=True)] if held[i] else e for i, e in enumerate(books[p])]
    out = []
    for k, v in rows:
        best = [pick(cut(v, p), books[p]) for p in range(parts)]
        out.append((k, "".join(f"{i:02x}" for _, i in best), min(sum(d for d, _ in best), (1 << 63) - 1)))
    return sorted(out), hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


@pytest.mark.parametrize("size", [1.0, 1e30])
def test_codes_are_the_plain_ones(spark, size, monkeypatch):
    rng = random.Random(3)
    vectors = [(i, [rng.gauss(0, 1) * (size if i % 9 == 0 else 1) for _ in range(8)], i % 3 or None) for i in range(80)]
    vectors += [(100 + i, vectors[0][1], 1) for i in range(5)]  # ties
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int").withColumn("v", F.lit("own")).repartition(5)
    want, digest = plain_codes([(k, [int(x * 1024 // 1) for x in v]) for k, v, _ in vectors], 4, 7, 4)
    totals = Counter()
    for (_, _, e), (_, _, label) in zip(want, sorted(vectors, key=lambda r: r[0]), strict=True):
        totals[label] += e
    for bound in (100, 0):  # totals sent to all tasks, and joined
        monkeypatch.setattr(vector_codes, "LABELS", bound)
        got = vector_codes.encode(df, entries=7).collect()
        assert sorted((r["vec_id"], r["code"], r["error"]) for r in got) == want
        assert {r["codebooks_sha256"] for r in got} == {digest}
        labels = {k: label for k, _, label in vectors}
        assert all(r["label_error"] == min(totals[labels[r["vec_id"]]], (1 << 63) - 1) for r in got)


def test_codes_of_odd_rows(spark):
    ok = [0.5] * 4
    rows = [(1, ok, 1), (1, ok, 1), (None, [1.0] * 4, None), (2, None, 1), (3, [1.0, None, 1.0, 1.0], 1), (4, [float("nan")] + ok[:3], 1), (5, [float("inf")] + ok[:3], 1), (6, [], 1), (7, [1.0] * 5, 1), (8, [1.0] * 8, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(map(tuple, vector_codes.encode(df).select("vec_id", "code", "error", "label_error").collect()), key=str)
    assert got == [(1, "00000000", 0, 0), (1, "00000000", 0, 0), (None, "02020202", 0, 0)]
    assert vector_codes.encode(df.limit(0)).collect() == [] and vector_codes.encode(df.where("vec_id = 2")).collect() == []


# --- sources ---------------------------------------------------------------------------------------------------------
def plain_audit(rows, least, top):
    fold = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source, term, terms = lang or "", source or "", "", []
        for c in (text or "").translate(fold) + " ":
            if c.isascii() and not c.isalpha():
                terms += [term] * bool(term)
                term = ""
            else:
                term += c
        groups[lang].add(source)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        every = sum((counts[lang, s] for s in sources), Counter())

        def shares(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(every)
        for s in sources:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources - {s})
            terms = sorted((q[t] - p[s][t], t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t])[:top]
            for part, found in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, item.decode(), -v, i) for i, (v, item) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize(("heavy", "side", "terms"), [(8, 256, 4096), (0, 3, 4), (2, 3, 4), (100, 256, 4096)])
def test_audit_is_the_plain_one(spark, heavy, side, terms):
    rng = random.Random(7)
    words = [f"{a}{b}" for a in "abcdeÄéß𝒳" for b in ("", "x", "YZ")]
    rows = [(" ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=rng.randint(0, 30))), rng.choice(["de", "en"]), f"s{min(rng.randint(0, 15), rng.randint(0, 15))}") for _ in range(150)]
    rows += [(None, "de", None), ("", "xx", "a"), ("a1b-c", "xx", "b"), ("Ax aX", None, "only"), ("ß", "de", "𝒳"), ("ß", "de", "￿"), (LONG, "de", "s1")] + [("a b", "de", "s1")] * 3
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("term", F.lit(1)).withColumn("n", F.lit("x")).repartition(3)
    got = source_audit.audit(df, least_docs=4, top=5, heavy=heavy, side=side, tile_terms=terms)
    assert sorted(map(tuple, got.select("lang", "source", "part", "item", "value", "rank").collect())) == plain_audit(rows, 4, 5)
    assert source_audit.audit(df.limit(0)).count() == 0


# --- shards ----------------------------------------------------------------------------------------------------------
def fits(sizes, capacity, shards):
    n, at = 1, 0
    for s in sizes:
        if s > capacity:
            return False
        n, at = (n, at + s) if at + s <= capacity else (n + 1, s)
    return n <= shards


@pytest.mark.parametrize(("n", "shards", "digits"), [(3000, 40, 1), (3000, 7, 4), (300, 40, 2), (20, 40, 4)])
def test_shards_have_the_least_capacity(spark, monkeypatch, n, shards, digits):
    monkeypatch.setattr(sharding, "FIRST", digits)
    monkeypatch.setattr(sharding, "MORE", 1)
    rng = random.Random(n + shards)
    texts = ["é" * min(int(rng.paretovariate(1.2) * 20), 20_000) + str(i) for i in range(n)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(n + i, texts[i % 5]) for i in range(n // 3)] + [(9 * n + i, "hot one " * 50) for i in range(n // 2)] + [(None, None), (None, ""), (1, texts[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("x")).withColumn("size", F.lit(0))
    got = sharding.shard(df, shards).collect()
    groups, where, slots, filled = Counter(), {}, defaultdict(list), Counter()
    for _, t in rows:
        groups[t or ""] += len((t or "").encode()) + 16
    crc = {zlib.crc32(t.encode()): t for t in groups}
    assert len(crc) == len(groups) and len(got) == len(rows)
    assert Counter((r["doc_id"], crc[r["text_crc32"]]) for r in got) == Counter((d, t or "") for d, t in rows)
    for r in got:
        assert where.setdefault(r["text_crc32"], r["shard"]) == r["shard"] and 0 <= r["shard"] < shards
        assert r["law"] == "bytes" and r["grown_shard"] is None and r["size"] == len(crc[r["text_crc32"]].encode()) + 16
        slots[r["shard"]].append(r["slot"])
        filled[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    left, alone = sum(groups.values()), []
    for t, b in sorted(groups.items(), key=lambda x: -x[1])[: shards - 1]:
        if b * (shards - len(alone)) < left:
            break
        alone.append(t)
        left -= b
    assert all(sum(where[c] == where[zlib.crc32(t.encode())] for c in where) == 1 for t in alone)
    rest = [groups[t] for t in sorted(groups.keys() - set(alone), key=lambda t: hashlib.sha256(t.encode()).hexdigest())]
    capacity = max((b for s, b in filled.items() if s >= len(alone)), default=0)
    if not rest:
        return
    assert fits(rest, capacity, shards - len(alone)) and (capacity == max(rest) or not fits(rest, capacity - 1, shards - len(alone)))


def test_shards_of_odd_tables(spark):
    df = spark.createDataFrame([(1, LONG), (1, LONG), (None, None)], "doc_id long, text string")
    got = sorted((r["size"], r["slot"], r["shard"]) for r in sharding.shard(df, 3).collect())
    assert [(a, b) for a, b, _ in got] == [(16, 0), (len(LONG) + 16, 0), (len(LONG) + 16, 1)] and got[1][2] == got[2][2] != got[0][2]
    assert sharding.shard(df.limit(0)).collect() == [] and {r["shard"] for r in sharding.shard(df, 1).collect()} == {0}
