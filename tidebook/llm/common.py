"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import functools
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: A word everywhere in this subpackage: a run without space, tab, \n, \v, \f, \r.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)

Rows = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_bytes(text: str | None) -> list[bytes]:
    """The words of a text with A-Z lower-cased; ``bytes.split`` parts at exactly the six separators."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as keep it apart from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def give_back() -> None:
    """Returns memory that is free in this process to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidied(run: Callable[[Iterable[pa.RecordBatch]], Rows]) -> Callable[[Iterable[pa.RecordBatch]], Rows]:
    """``run``, which gives back its memory after its last row: Python workers wait for further tasks with what they hold."""

    @functools.wraps(run)
    def own(batches: Iterable[pa.RecordBatch]) -> Rows:
        yield from run(batches)
        give_back()

    return own


def small_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """From now on the session hands Python workers at most about ``most`` bytes of rows at a time, unless it hands them
    less already.  A batch is held whole by the executor and by the worker, 64 MB of it by Spark's default."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    if not 0 < now <= most:
        spark.conf.set(name, str(most))


def sliced(batches: Iterable[pa.RecordBatch], step: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that little of a batch is ever held as Python objects.  Spark itself bounds a
    batch by bytes (spark.sql.execution.arrow.maxBytesPerBatch)."""
    for b in batches:
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)
    pa.default_memory_pool().release_unused()
