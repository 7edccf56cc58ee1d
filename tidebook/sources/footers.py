"""Parquet footers as rows: an archive is opened, planned and verified from them, and no data page is read to do so.

Tasks read the footers.  A file that can't be read is a row that says so, and the job goes on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Open = Callable[[str], Any]
SCHEMA = "path string, problem string, row_group int, column string, rows bigint, bytes bigint, nulls bigint, low bigint, high bigint, low_text string, high_text string, told map<string,string>"
FIELDS = ["path", "problem", "row_group", "column", "rows", "bytes", "nulls", "low", "high", "low_text", "high_text", "told"]
ARROW = pa.schema([("path", pa.string()), ("problem", pa.string()), ("row_group", pa.int32()), ("column", pa.string()), *[(c, pa.int64()) for c in ("rows", "bytes", "nulls", "low", "high")], ("low_text", pa.string()), ("high_text", pa.string()), ("told", pa.map_(pa.string(), pa.string()))])
#: Longest value of a file's own notes that is kept; schemas of engines lie there too.
NOTE = 200


def open_uri(path: str) -> Any:
    """A file by its path or URI, as far as Arrow knows the file system; others are given an opener of their own."""
    from pyarrow import fs

    if "://" not in path:
        return fs.LocalFileSystem().open_input_file(path.removeprefix("file:"))
    store, at = fs.FileSystem.from_uri(path)
    return store.open_input_file(at)


def listed(spark: SparkSession, root: str) -> DataFrame:
    """``path, bytes`` of the data files below a folder, the path from the folder on; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    return files.select(_below(F.col("path"), root).alias("path"), F.col("length").alias("bytes"))


def _below(path: Column, root: str) -> Column:
    """What follows the folder's own path, however its scheme is spelt."""
    folder = root.split("://", 1)[-1].removeprefix("file:").strip("/") + "/"
    return F.substring_index(path, "/" + folder, -1)


def _row(path: str, **known: Any) -> dict[str, Any]:
    return {**dict.fromkeys(FIELDS), "path": path, **known}


def _footer(path: str, meta: pq.FileMetaData) -> Iterator[dict[str, Any]]:
    notes = {k.decode("utf-8", "replace"): v.decode("utf-8", "replace") for k, v in (meta.metadata or {}).items() if len(v) <= NOTE}
    yield _row(path, rows=meta.num_rows, bytes=meta.serialized_size, told=list(notes.items()))
    for g in range(meta.num_row_groups):
        group = meta.row_group(g)
        for i in range(group.num_columns):
            c = group.column(i)
            s = c.statistics if c.is_stats_set else None
            low, high = (s.min, s.max) if s is not None and s.has_min_max else (None, None)
            whole = c.physical_type in ("INT32", "INT64") and isinstance(low, int) and not isinstance(low, bool)
            text = isinstance(low, str)
            yield _row(path, row_group=g, column=c.path_in_schema, rows=group.num_rows, bytes=c.total_compressed_size, nulls=s.null_count if s is not None and s.has_null_count else None,
                       low=low if whole else None, high=high if whole else None, low_text=low if text else None, high_text=high if text else None)


def _pages(path: str, file: pq.ParquetFile, column: str) -> Iterator[dict[str, Any]]:
    """One row from all pages of all columns, a batch at a time: rows, and the bounds of one column."""
    import pyarrow.compute as pc

    rows, low, high = 0, None, None
    for batch in file.iter_batches(batch_size=65_536):
        rows += batch.num_rows
        if column in batch.schema.names:
            b = pc.min_max(batch.column(column)).as_py()
            if b["min"] is not None:
                low, high = b["min"] if low is None else min(low, b["min"]), b["max"] if high is None else max(high, b["max"])
    yield _row(path, column=column, rows=rows, low=low, high=high)


def _told(files: DataFrame, root: str, tell: Callable[[str, Any], Iterator[dict[str, Any]]], opener: Open, tasks: int | None) -> DataFrame:
    spread = tasks or files.sparkSession.sparkContext.defaultParallelism * 4
    base = root.rstrip("/")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                try:
                    with opener(f"{base}/{path}") as f:
                        out = list(tell(path, f))
                except FileNotFoundError:
                    out = [_row(path, problem="absent")]
                except (OSError, pa.ArrowException) as e:
                    out = [_row(path, problem=f"unreadable: {e}"[:NOTE])]
                yield pa.RecordBatch.from_pylist(out, schema=ARROW)

    return files.where("path is not null").select("path").distinct().repartition(spread, "path").mapInArrow(read, SCHEMA)


def footers(files: DataFrame, root: str, opener: Open = open_uri, tasks: int | None = None) -> DataFrame:
    """For each ``path`` of ``files`` a row for the file (``row_group`` null: its rows and notes) and one per row group and
    column with rows, bytes, nulls and bounds: ``low, high`` of whole numbers, ``low_text, high_text`` of texts, null
    where a file has none.  A file that is absent or damaged is one row with a ``problem``.  Null paths are left out,
    repeated ones told once, no files give no rows."""
    return _told(files, root, lambda path, f: _footer(path, pq.read_metadata(f)), opener, tasks)


def inspected(files: DataFrame, root: str, column: str = "recv_wall", opener: Open = open_uri, tasks: int | None = None) -> DataFrame:
    """Per file ``path, problem, rows, low, high`` by reading every page, so that damage behind a good footer shows."""
    return _told(files, root, lambda path, f: _pages(path, pq.ParquetFile(f), column), opener, tasks).select("path", "problem", "rows", "low", "high")


def _named(key: str) -> Column:
    """The value of a ``key=value`` folder of a path, as Hive escapes it."""
    found = F.regexp_extract("path", rf"(?:^|/){key}=([^/]*)", 1)
    return F.nullif(F.url_decode(F.replace(found, F.lit("+"), F.lit("%2B"))), F.lit(""))


def file_table(told: DataFrame, column: str = "recv_wall") -> DataFrame:
    """What a manifest says of each readable file, from footers: ``path, venue, symbol, date, rows, bytes`` (of its
    columns), ``groups, first_recv_wall, last_recv_wall``; both bounds are null if any row group doesn't give its own."""
    own, whole = F.col("column") == column, F.col("row_group").isNull()
    bounded = F.count_if(own & (F.col("rows") > 0)) == F.count_if(own & F.col("low").isNotNull())
    files = told.where("problem is null").groupBy("path").agg(
        F.max(F.when(whole, F.col("rows"))).alias("rows"), F.coalesce(F.sum(F.when(~whole, F.col("bytes"))), F.lit(0)).alias("bytes"), F.count_if(own).alias("groups"),
        F.when(bounded, F.min(F.when(own, F.col("low")))).alias("first_recv_wall"), F.when(bounded, F.max(F.when(own, F.col("high")))).alias("last_recv_wall"))
    return files.select("path", _named("venue").alias("venue"), _named("symbol").alias("symbol"), _named("date").cast("date").alias("date"), "rows", "bytes", "groups", "first_recv_wall", "last_recv_wall")


def plan(told: DataFrame, after: int, until: int, column: str = "recv_wall") -> DataFrame:
    """Per row group ``path, row_group, rows, kept``: whether it may hold ``after < column <= until``.  Without bounds it
    is kept; a group of nulls alone holds nothing in a range."""
    groups = told.where((F.col("column") == column) & (F.col("rows") > 0))
    open_ended = F.col("low").isNull() | F.col("high").isNull()
    empty = open_ended & F.coalesce(F.col("nulls") == F.col("rows"), F.lit(False))
    kept = (open_ended & ~empty) | ((F.col("high") > after) & (F.col("low") <= until))
    return groups.select("path", "row_group", "rows", F.coalesce(kept, F.lit(False)).alias("kept"))


def pruned(planned: DataFrame) -> DataFrame:
    """One row: files, row groups and rows there are, and how many of each a plan keeps."""
    files = planned.groupBy("path").agg(F.max("kept").alias("kept"), F.count("*").alias("groups"), F.count_if("kept").alias("groups_kept"), F.sum("rows").alias("rows"), F.sum(F.when(F.col("kept"), F.col("rows")).otherwise(0)).alias("rows_kept"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return files.agg(F.count("*").alias("files"), F.count_if("kept").alias("files_kept"), total("groups"), total("groups_kept"), total("rows"), total("rows_kept"))


def scan(spark: SparkSession, root: str, planned: DataFrame, after: int, until: int, column: str = "recv_wall") -> DataFrame:
    """Rows of a range from the files that a plan keeps; the bounds reach their row groups and pages too.

    The names of the files kept go through the driver, as those of every scan do; no file kept gives no rows."""
    kept = sorted(r["path"] for r in planned.where("kept").select("path").distinct().toLocalIterator())
    rows = spark.read.option("basePath", root).parquet(*[f"{root.rstrip('/')}/{p}" for p in kept]) if kept else spark.read.parquet(root).limit(0)
    return rows.where((F.col(column) > after) & (F.col(column) <= until))


def in_order(files: DataFrame) -> DataFrame:
    """Adds ``place``: the order of a partition's files by their first receipt, those without one last."""
    from pyspark.sql import Window

    return files.withColumn("place", F.row_number().over(Window.partitionBy("venue", "symbol", "date").orderBy(F.asc_nulls_last("first_recv_wall"), "path")))


def verified(manifest: DataFrame, seen: DataFrame, told: DataFrame, scale_note: str = "price_scale", scale: int = 9) -> DataFrame:
    """``path, problem, detail`` of the manifest's files (``path, rows, venue, symbol, first_recv_wall, last_recv_wall``)
    against what was ``inspected`` and their footers: ``absent``, ``unreadable``, ``rows``, ``span``, ``mislabelled`` (the
    folder names another venue or symbol), ``scale`` (the file notes another one).  A file may have several."""
    notes = told.where("row_group is null and problem is null").select("path", F.col("told")[scale_note].alias("__scale"))
    both = manifest.join(seen.select("path", F.col("problem").alias("__bad"), F.col("rows").alias("__rows"), F.col("low").alias("__low"), F.col("high").alias("__high")), "path", "left").join(notes, "path", "left")
    told_as = F.concat_ws(" ", _named("venue"), _named("symbol"))
    claim = F.concat_ws(" ", "venue", "symbol")
    found = lambda name, when, detail: F.when(when, F.struct(F.lit(name).alias("problem"), detail.cast("string").alias("detail")))
    whole = F.col("__bad").isNull() & F.col("__rows").isNotNull()
    span = lambda a, b: F.concat_ws("..", F.col(a).cast("string"), F.col(b).cast("string"))
    problems = F.array_compact(F.array(
        found("absent", (F.col("__bad") == "absent") | (F.col("__bad").isNull() & F.col("__rows").isNull()), F.lit(None)), found("unreadable", F.col("__bad") != "absent", F.col("__bad")),
        found("rows", whole & ~F.col("rows").eqNullSafe(F.col("__rows")), F.col("__rows")), found("span", whole & (span("first_recv_wall", "last_recv_wall") != span("__low", "__high")), span("__low", "__high")),
        found("mislabelled", whole & (told_as != "") & (told_as != claim), told_as), found("scale", whole & (F.col("__scale") != str(scale)), F.col("__scale"))))
    return both.select("path", F.explode(problems).alias("x")).select("path", "x.*")


def write_manifest(files: DataFrame, path: str) -> None:
    """The lines that record files, as ``tape.read_manifest`` reads them; a folder of text files."""
    fields = ["path", "venue", "symbol", F.col("date").cast("string").alias("date"), "rows", "bytes", "first_recv_wall", "last_recv_wall"]
    files.select(F.to_json(F.struct(F.lit("file").alias("kind"), *fields)).alias("value")).write.mode("append").text(path)
