"""What operators write besides their results grows no faster than it must, and goes when nothing reads it any more."""

import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidebook.llm import ctw, ngram_join, quality_model
from tidebook.plans import durable

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def written(monkeypatch):
    """The tables that the modules write, by name, and whether their files are still there."""
    tables: dict[str, list] = {}

    def materialize(df, name):
        tables.setdefault(name, []).append(durable.materialize(df, name))
        return tables[name][-1]

    for module in (ctw, ngram_join, quality_model):
        monkeypatch.setattr(module, "materialize", materialize)
    return tables


def there(table) -> bool:
    return os.path.exists(table._written_at.removeprefix("file://"))


def test_no_shingle_of_one_text_alone_is_posted(spark, written):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    sets = {d: ngram_join.shingles(t, 5) for d, t in texts.items()}
    count = Counter(x for s in sets.values() for x in s.tolist())
    got = ngram_join.label(docs, 5, 80).collect()
    rows = {r["doc_id"]: r for r in written["prefixes"][0].collect()}
    assert len(got) == len(rows) == len(texts) and any(len(r["prefix"]) for r in rows.values())
    alone = posted = whole = 0
    for d, s in sets.items():
        shared = {x for x in s.tolist() if count[x] > 1}
        own = np.array(rows[d]["prefix"], np.int64).view(np.uint64).tolist()
        take = ngram_join.prefix_length(len(s), 80) if len(s) else 0
        assert rows[d]["able"] >= len(shared) and take - (len(s) - len(shared)) <= len(own) <= take
        alone, posted, whole = alone + len(set(own) - shared), posted + len(own), whole + take
    assert alone <= 0.02 * posted < 0.02 * whole


def test_marks_tell_single_shingles_when_the_sketch_is_full(spark):
    """200,000 single shingles in 131,072 buckets: the sketch alone takes most of them for common ones."""
    lines = [" ".join(f"{at:x}-{i:x}" for i in range(402)) for at in range(500)] + ["a b c d e f g"] * 2
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "doc_id long, text string").repartition(4)
    keys, codes, sketch, marks = ngram_join.known_shingles(frame, 3, most_bits=17)
    single = np.concatenate([ngram_join.shingles(t, 3) for t in lines[:-2]])
    told = ngram_join.Commonness(keys, codes, sketch, marks)
    assert len(sketch) == 1 << 16 and len(marks) == 1 << 16 and np.mean(ngram_join.Commonness(keys, codes, sketch)(single) > 0) > 0.5
    assert np.mean(told(single) > 0) < 0.001 and (told(ngram_join.shingles(lines[-1], 3)) > 0).all()


def test_tables_go_when_nothing_reads_them(spark, written):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    good = quality_model.keep_good(docs)
    assert written["features"] and not any(map(there, written["features"])) and good.count()
    kept = ngram_join.keep_one(docs)
    assert not any(there(t) for name in ("met", "apart") for t in written[name]) and kept.count()


def test_a_model_of_many_parts_moves_no_grams(spark, written):
    """Three parts give what one gives, for repeated, null and empty texts too, and only a sum per text is written."""
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").limit(60)
    odd = spark.createDataFrame([(None, None), (9001, ""), (9002, "abra cadabra"), (9002, "abra cadabra"), (9003, "Abra cadabra")], rows.schema)
    docs, held = rows.union(odd), F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    key = lambda r: (str(r["doc_id"]), r["n_tokens"], r["score"])
    one = sorted(ctw.score(docs, held, order=3).collect(), key=key)
    size = written["model"][0].count()
    got = sorted(ctw.score(docs, held, order=3, broadcast_grams=-(-size // 3)).collect(), key=key)
    assert len(got) == len(one) == 65
    for a, b in zip(one, got, strict=True):
        assert a[:6] == b[:6] and np.allclose(a[6:], b[6:], rtol=1e-12)
    assert not written["scored"][1].where("grams is not null").count() and len(written["sums"]) == 2
