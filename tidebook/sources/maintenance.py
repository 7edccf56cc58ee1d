"""Care of an archive: verification, frozen data sets, transcoding, checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .tape import KEYS


def verify(spark: SparkSession, root: str, listed: DataFrame) -> DataFrame:
    """``path, problem`` of files whose rows are not as many as listed, that lie under another venue or symbol, or are
    listed and absent: one scan of the two key columns."""
    file = F.regexp_extract(F.input_file_name(), r"(venue=.*)$", 1)
    seen = spark.read.parquet(root).select(file.alias("path"), "venue", "symbol").groupBy("path").agg(F.count("*").alias("have"), F.min("venue").alias("v"), F.min("symbol").alias("s"))
    both = listed.select("path", "rows", "venue", "symbol").join(seen, "path", "full")
    problem = F.when(F.col("have").isNull(), "absent").when(F.col("rows").isNull(), "unlisted").when(F.col("rows") != F.col("have"), "rows").when((F.col("venue") != F.col("v")) | (F.col("symbol") != F.col("s")), "mislabelled")
    return both.select("path", problem.alias("problem")).where("problem is not null")


def schema_conflict(want: StructType, have: StructType) -> dict[str, list[str]]:
    """Names that one schema has beyond the other, and those of another type."""
    a, b = {f.name: f.dataType for f in want}, {f.name: f.dataType for f in have}
    return {"extra": sorted(b.keys() - a.keys()), "missing": sorted(a.keys() - b.keys()), "retyped": sorted(n for n in a.keys() & b.keys() if a[n] != b[n])}


def freeze(spark: SparkSession, root: str) -> DataFrame:
    """``path, bytes, sha256`` of every data file: what a study pins.  A file is one row while it is hashed; archives
    bound their files by rows (``write_archive``), and Spark reads none beyond 2 GB this way."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    return files.select(F.regexp_extract("path", r"(venue=.*|[^/]*)$", 1).alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def thawed(frozen: DataFrame, now: DataFrame) -> DataFrame:
    """Files that are not as they were frozen."""
    both = frozen.withColumnRenamed("sha256", "was").select("path", "was").join(now.select("path", "sha256"), "path", "full")
    return both.where("not (was <=> sha256)").select("path", F.when(F.col("was").isNull(), "added").when(F.col("sha256").isNull(), "gone").otherwise("changed").alias("problem"))


def transcode(spark: SparkSession, root: str, out: str, codec: str, page_bytes: int, group_bytes: int) -> None:
    """The same rows in the same files' order with another codec and other page and group sizes."""
    order = [*KEYS, "date", "recv_wall", "row_ordinal"]
    rows = spark.read.parquet(root).repartitionByRange(*order).sortWithinPartitions(*order)
    rows.write.partitionBy(*KEYS, "date").option("compression", codec).option("parquet.page.size", page_bytes).option("parquet.block.size", group_bytes).parquet(out)


def checkpoints(rows: DataFrame, instants: list[int]) -> DataFrame:
    """The book at each instant with the ordinal it reaches: ``at, venue, symbol, side, price, qty, upto``.

    One pass: rows fall between instants, each level keeps its last write there, and a write stands at every instant
    until the level's next one, as long as its epoch is the newest."""
    marks = sorted(instants)
    due = F.size(F.filter(F.array(*[F.lit(x).cast("bigint") for x in marks]), lambda x: x < F.col("recv_wall")))
    cut = rows.withColumn("i", due).where(F.col("i") < len(marks))
    reached = cut.groupBy(*KEYS, "i").agg(F.max("row_ordinal").alias("upto"), F.max("epoch").alias("epoch"))
    slots = reached.select(*KEYS).distinct().withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(len(marks) - 1))))
    upto = Window.partitionBy(*KEYS).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    state = slots.join(reached, [*KEYS, "i"], "left").select(*KEYS, "i", F.max("upto").over(upto).alias("upto"), F.max("epoch").over(upto).alias("epoch"))
    wrote = cut.where("qty >= 0").groupBy(*KEYS, "epoch", "side", "price", "i").agg(F.max_by("qty", "row_ordinal").alias("qty"))
    later = F.lead("i").over(Window.partitionBy(*KEYS, "epoch", "side", "price").orderBy("i"))
    held = wrote.withColumn("to", F.coalesce(later - 1, F.lit(len(marks) - 1))).where("qty > 0").withColumn("i", F.explode(F.sequence("i", "to"))).drop("to")
    at = F.element_at(F.array(*[F.lit(x).cast("bigint") for x in marks]), F.col("i") + 1)
    return held.join(state, [*KEYS, "epoch", "i"]).select(*KEYS, "side", "price", "qty", "upto", at.alias("at"))


def restore(rows: DataFrame, saved: DataFrame, at: int) -> DataFrame:
    """The book at an instant from the newest checkpoint by then and the rows after it; the same levels as from all rows.

    A snapshot after the checkpoint drops it.  Only rows past the checkpoint's ordinal are read."""
    newest = saved.where(F.col("at") <= at).groupBy(*KEYS).agg(F.max_by("upto", "at").alias("upto"), F.max("at").alias("base"))
    base = saved.join(newest.select(*KEYS, F.col("base").alias("at")), [*KEYS, "at"])
    after = rows.where(F.col("recv_wall") <= at).join(newest, KEYS, "left").where("upto is null or row_ordinal > upto")
    fresh = after.groupBy(*KEYS).agg(F.max(F.when(F.col("event") == 0, F.col("epoch"))).alias("snapshot"))
    late = after.join(fresh, KEYS).where("qty >= 0 and (snapshot is null or epoch = snapshot)").select(*KEYS, "side", "price", "qty", "row_ordinal")
    kept = base.join(fresh.where("snapshot is not null"), KEYS, "left_anti").select(*KEYS, "side", "price", "qty", F.lit(-1).cast("bigint").alias("row_ordinal"))
    return kept.unionByName(late).groupBy(*KEYS, "side", "price").agg(F.max_by("qty", "row_ordinal").alias("qty")).where("qty > 0")
