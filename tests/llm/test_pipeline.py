"""The pipeline stage by stage against plain versions of what each must do."""

import hashlib

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tidebook.llm import bpe, quality_model, secret_scan
from tidebook.llm.queries import VOCABULARY
from tidebook.plans.durable import materialize

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["quality_classifier", "ngram_jaccard_join", "secret_scans", "source_mixing", "byte_level_bpe"]
    good = pipeline.classify_quality(spark, docs, DATA)
    kept = {r["doc_id"] for r in quality_model.classify(docs).where("kept").collect()}
    assert {r["doc_id"] for r in good.collect()} == kept
    one = pipeline.join_near_copies(spark, good, DATA)
    texts = {r["doc_id"]: r["text"] for r in good.collect()}
    shingles = {}
    for d, t in texts.items():
        w = t.encode().lower().split()
        shingles[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}
    group = {d: d for d in texts}
    for a in sorted(texts):
        for b in sorted(texts):
            if a < b and 100 * len(shingles[a] & shingles[b]) >= 80 * len(shingles[a] | shingles[b]):
                low, high = sorted((group[a], group[b]))
                group = {d: low if g == high else g for d, g in group.items()}
    assert {r["doc_id"] for r in one.collect()} == {d for d in texts if group[d] == d}
    encoding = secret_scan._encoding(path, pattern)
    hidden = pipeline.hide_secrets(spark, one, DATA)
    for r in hidden.collect():
        want, at = "", 0
        for a, b, k in secret_scan.scan_text(texts[r["doc_id"]], encoding)[1]:
            want, at = (want + texts[r["doc_id"]][at:a] + f"<{k}>", b) if a >= at else (want, max(at, b))
        assert r["text"] == want + texts[r["doc_id"]][at:] and r["n_chars"] == len(r["text"])
    mixed = pipeline.mix_sources(spark, hidden, DATA)
    assert good.columns == one.columns == hidden.columns == mixed.columns == docs.columns
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    want = sorted((r["doc_id"], len(own.encode_ordinary(r["text"])), hashlib.sha256(r["text"].encode()).hexdigest()) for r in mixed.collect())
    assert sorted((r["doc_id"], r["n_tokens"], r["decoded_sha256"]) for r in pipeline.encode_bytes(spark, mixed, DATA).collect()) == want


def test_awkward_rows_and_an_empty_table(spark):
    """Nulls in every column, empty and very long texts, repeated rows, an id with two texts, and clashing columns."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    plain = "The quick brown fox jumps over the lazy dog and then it rests for a while under the old tree."
    long = " ".join(f"word{i % 977}" for i in range(20_000))
    odd = [(90_001, plain, "en", "a", 1), (90_001, plain, "en", "a", 1), (90_001, f"Nothing of the kind is said here. {plain[::-1]}", None, None, None), (None, None, None, None, None), (None, plain, "en", "b", 1), (90_002, "", "en", "b", 0), (90_003, " \t\n", "en", "b", 3), (90_004, long, "en", "c", 1), (90_005, long, "en", "c", 1)]
    types = dict(docs.dtypes)
    names = ("doc_id", "text", "lang", "source", "n_chars")
    rows = docs.select(*names).unionByName(spark.createDataFrame(odd, ", ".join(f"{n} {types[n]}" for n in names)))
    for clash in ("n_tokens", "kept", "own_key", "key", "size", "carried", "component_id", "new_text"):
        rows = rows.withColumn(clash, F.lit(None).cast("int"))
    at, texts = rows, []
    for name, stage in pipeline.STAGES[:-1]:
        at = materialize(stage(spark, at, DATA), name)
        assert at.columns == rows.columns
        texts.append(sorted((r["doc_id"] or 0, r["text"] or "") for r in at.collect()))
    good, one, _, mixed = texts
    assert all(t.strip() for _, t in good) and set(one) <= set(good) and len(one) == len(set(one))
    assert sum(t == plain for _, t in one) == min(1, sum(t == plain for _, t in good)) and sum(t == long for _, t in one) == min(1, sum(t == long for _, t in good))
    done = pipeline.STAGES[-1][1](spark, at, DATA)
    assert sorted(r["decoded_sha256"] for r in done.collect()) == sorted(hashlib.sha256(t.encode()).hexdigest() for _, t in mixed)
    for _, stage in pipeline.STAGES:
        assert stage(spark, rows.limit(0), DATA).count() == 0
