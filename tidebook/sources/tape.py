"""Archive rows: reading and writing archives, and a tape of book events made from the ``events`` table."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expr import DAY, UNIT, utc_date
from ..plans.durable import scratch_path
from . import footers

MICRO = 1_000
KEYS = ["venue", "symbol"]


def derived_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tape by integer arithmetic from ``events``: four rows a message, snapshots, gaps, both signs of skew."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "value", "props")
    k = F.regexp_extract("props", r'"k": (-?\d+)', 1).cast("bigint")
    rows = e.select(
        F.col("event_id").alias("row_ordinal"), F.expr("event_id div 4").alias("msg_index"), F.round(F.col("value") * 100).cast("bigint").alias("c"),
        k.alias("k"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
    )
    m, tick, base = F.col("msg_index"), 10_000_000, 100 * UNIT
    rows = rows.withColumn("recv_wall", F.max("us").over(Window.partitionBy("msg_index")) * MICRO)
    away = F.when(m % 97 == 0, -tick).otherwise((1 + F.col("c") % 20) * tick)
    side = F.col("row_ordinal") % 2
    return rows.select(
        F.when(m % 2 == 0, "kraken").otherwise("coinbase").alias("venue"), F.lit("BTC-USD").alias("symbol"), "row_ordinal", "msg_index",
        F.when(F.expr("(msg_index div 2) % 40") == 0, 0).otherwise(1).alias("event"), "recv_wall",
        F.when(m % 41 != 0, F.col("recv_wall") - (F.col("k") - 20) * 1_000_000).alias("venue_ts"), side.cast("int").alias("side"),
        (F.lit(base) + F.when(side == 0, -away).otherwise(away)).alias("price"), F.when(F.col("k") % 5 == 0, 0).otherwise(F.col("k") * 1_000_000).alias("qty"),
        (m % 37 == 0).alias("suspect"),
    )


def write_archive(rows: DataFrame, root: str, rows_per_file: int = 250_000, codec: str = "zstd") -> None:
    """``venue=/symbol=/date=`` Parquet, each file in receipt order, so that only the clustered column's statistics prune.

    Rows are dealt by ranges of receipt within a day, so that a busy day of one instrument is many tasks' work."""
    order = [*KEYS, "date", "recv_wall", "row_ordinal"]
    dated = rows.withColumn("date", utc_date(F.col("recv_wall"))).repartitionByRange(*order).sortWithinPartitions(*order)
    dated.write.mode("append").partitionBy(*KEYS, "date").option("compression", codec).option("maxRecordsPerFile", rows_per_file).parquet(root)


_written: dict[tuple[str, str], str] = {}


def archive_of(spark: SparkSession, sf_dir: str) -> str:
    """The archive of the derived tape, written once in an application, below the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        path = scratch_path(spark, "archive")
        write_archive(derived_tape(spark, sf_dir), path)
        _written[key] = path
    return _written[key]


def recorded(spark: SparkSession, sf_dir: str, after: int | None = None, until: int | None = None) -> DataFrame:
    """Rows of that archive, without the date they lie under."""
    return read_archive(spark, archive_of(spark, sf_dir), after, until).drop("date")


def _day(at: int):
    return F.lit(date(1970, 1, 1) + timedelta(days=at // DAY))


def read_archive(spark: SparkSession, root: str, after: int | None = None, until: int | None = None, columns: list[str] | None = None) -> DataFrame:
    """Rows with ``after < recv_wall <= until``; both bounds reach the scan, and the dates they imply prune folders."""
    rows = spark.read.parquet(root)
    if after is not None:
        rows = rows.where((F.col("recv_wall") > after) & (F.col("date") >= _day(after)))
    if until is not None:
        rows = rows.where((F.col("recv_wall") <= until) & (F.col("date") <= _day(until)))
    return rows.select(*columns) if columns else rows


def compact(spark: SparkSession, root: str, out: str) -> None:
    """One run of files per partition, same rows, receipt order."""
    write_archive(spark.read.parquet(root).drop("date"), out, rows_per_file=5_000_000)


def file_table(spark: SparkSession, root: str) -> DataFrame:
    """What a manifest says of each file, from the footers: path below the root, partition, rows, bytes, first and last receipt."""
    return footers.file_table(footers.footers(footers.listed(spark, root), root))


MANIFEST = "kind string, path string, venue string, symbol string, date string, rows bigint, bytes bigint, first_recv_wall bigint, last_recv_wall bigint, retired array<string>, removed array<string>, produced struct<path:string,venue:string,symbol:string,date:string,rows:bigint,bytes:bigint,first_recv_wall:bigint,last_recv_wall:bigint>, _bad string"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Live files of a JSON-lines manifest, a file or a folder of files whose names are in order: those whose last
    mention records or produces them, so that a path recorded again after its retirement is live.

    A broken last line of the last file is a torn write and is left out; a broken line before it raises.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", "\n")).alias("line", "text")).where(F.trim("text") != "")
    parsed = files.select(F.struct("file", "line").alias("at"), F.from_json("text", MANIFEST, {"columnNameOfCorruptRecord": "_bad"}).alias("x"))
    last = parsed.agg(F.max("at").alias("last"))
    if parsed.where("x._bad is not null").join(F.broadcast(last), F.col("at") < F.col("last")).limit(1).count():
        raise ValueError("a line in the middle of the manifest is broken")
    good = parsed.where("x is not null and x._bad is null").select("at", "x.*")
    fields = ["path", "venue", "symbol", "date", "rows", "bytes", "first_recv_wall", "last_recv_wall"]
    told = lambda rows, phase, own: rows.select(F.struct("at", F.lit(phase).alias("phase")).alias("at"), own.alias("x"))
    known = told(good.where("kind = 'file'"), 1, F.struct(*fields)).unionByName(told(good.where("kind = 'compaction'"), 1, F.struct(*[F.col(f"produced.{f}").alias(f) for f in fields])))
    gone = good.select("at", F.explode(F.concat(F.coalesce("retired", F.array()), F.coalesce("removed", F.array()))).alias("path"))
    mentions = known.select("at", F.col("x.path").alias("path"), "x").unionByName(gone.select(F.struct("at", F.lit(0).alias("phase")).alias("at"), "path", F.lit(None).cast(known.schema["x"].dataType).alias("x")))
    latest = mentions.groupBy("path").agg(F.max_by(F.struct("x"), "at").alias("m"))
    return latest.where("m.x is not null").select("m.x.*")


def files_in_range(files: DataFrame, after: int, until: int) -> DataFrame:
    """Files whose span may hold rows with ``after < recv_wall <= until``."""
    return files.where((F.col("last_recv_wall") > after) & (F.col("first_recv_wall") <= until))


def retention(files: DataFrame, now: int, max_age: int, max_bytes: int) -> DataFrame:
    """Files to remove: first those whose newest row is too old, then oldest first until the rest fits."""
    old = F.col("last_recv_wall") < now - max_age
    kept = files.where(~old)
    newest = Window.orderBy(F.desc("last_recv_wall"), F.desc("path"))
    over = kept.withColumn("kept_bytes", F.sum("bytes").over(newest)).where(F.col("kept_bytes") > max_bytes).drop("kept_bytes")
    return files.where(old).withColumn("reason", F.lit("age")).unionByName(over.withColumn("reason", F.lit("bytes")))
