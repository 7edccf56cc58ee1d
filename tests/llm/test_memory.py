"""Python workers give back what a task no longer needs."""

import re
import tracemalloc
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

import corpus_pipeline as pipeline
from tidebook.llm import bpe, common, ngram_join
from tidebook.llm.queries import VOCABULARY

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="memory can't be read here")
def test_memory_goes_back_after_the_last_row():
    held = lambda: int(re.search(r"Pss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024
    pins = []

    def run(batches):
        blocks = [bytes([i % 256]) * 6000 for i in range(40_000)]
        pins.append(blocks[-1])
        yield from batches

    rows = [pa.RecordBatch.from_arrays([pa.array([1, None])], ["a"]), pa.RecordBatch.from_arrays([pa.array([], pa.int64())], ["a"])]
    before = held()
    got = list(common.tidied(run)(iter(rows)))
    assert got == rows and pins and held() - before < 60


class Caught(Exception):
    """Raised with the function that a frame was to map."""


def caught(make, frame, monkeypatch):
    def stop(self, run, *rest, **named):
        raise Caught(run)

    monkeypatch.setattr(type(frame), "mapInArrow", stop)
    with pytest.raises(Caught) as e:
        make(frame)
    return e.value.args[0]


def test_counting_shingles_holds_few_of_them(spark, monkeypatch):
    """A task over 2,400,000 shingles, all counted; its arrays and rows stay below 40 MB."""
    frame = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    count = caught(lambda f: ngram_join.common_shingles(f, 5), frame, monkeypatch)
    texts = (" ".join(f"{at:x}-{i:x}" for i in range(604)) for at in range(4000))
    batches = (pa.RecordBatch.from_arrays([pa.array([next(texts) for _ in range(100)])], ["text"]) for _ in range(40))
    tracemalloc.start()
    total = sum(int(ngram_join._unpacked(*pair)[1].sum()) for b in count(batches) for pair in zip(b.column(1), b.column(2), strict=True))
    most = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert total == 4000 * 600 and most < 40


def test_no_vocabulary_stays_behind(spark, monkeypatch):
    frame = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    run = caught(lambda f: bpe.round_trip(f, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN), frame, monkeypatch)
    rows = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["some text", None])], ["doc_id", "text"])
    assert sum(b.num_rows for b in run(iter([rows]))) == 2 and not bpe._loaded


def test_workers_get_few_bytes_at_a_time(spark):
    text = "some words of a text " * 500
    docs = spark.range(1000, numPartitions=1).selectExpr("id AS doc_id", f"'{text}' || id AS text", "'en' AS lang", "'s' AS source", "0L AS n_chars")
    before = spark.conf.get(BATCH_BYTES)
    try:
        pipeline.encode_bytes(spark, docs, "")
        seen = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches), "n long").toPandas()["n"]
        assert np.max(seen) < 5_000_000 < np.sum(seen)
        spark.conf.set(BATCH_BYTES, "1m")
        pipeline.encode_bytes(spark, docs, "")
        assert spark.conf.get(BATCH_BYTES) == "1m"
    finally:
        spark.conf.set(BATCH_BYTES, before)
