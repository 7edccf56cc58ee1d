"""Checkpoints, probes and archive care."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tidebook import catalog, catalog_history
from tidebook.operators import book, pit
from tidebook.sources import maintenance, tape

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog_history.queries()))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{DATA}/events.parquet'")
    got = catalog_history.queries()[name](spark, DATA)
    want = con.execute(catalog_history.oracle_sql()[name])
    order = [d[0] for d in want.description]
    have = sorted(map(str, (tuple(r) for r in got.select(order).collect())))
    assert sorted(order) == sorted(got.columns) and have == sorted(map(str, want.fetchall())) and have


def test_restore_anywhere(spark):
    r = catalog.rows(spark, DATA).cache()
    saved = maintenance.checkpoints(r, catalog_history.MARKS).cache()
    for hours in (50, 100, 191, 700):
        at = catalog.START + hours * catalog.HOUR
        a, b = (sorted(map(tuple, x.select(*catalog.KEYS, "side", "price", "qty").collect())) for x in (book.book_at(r, at), maintenance.restore(r, saved, at)))
        assert a == b


def test_archive_care(spark, tmp_path):
    root = f"file://{tmp_path}/a"
    tape.write_archive(tape.derived_tape(spark, DATA), root, rows_per_file=200)
    files = tape.file_table(spark, root).select(F.regexp_extract("path", "(venue=.*)$", 1).alias("path"), "venue", "symbol", F.col("rows")).cache()
    assert maintenance.verify(spark, root, files).count() == 0
    first = files.orderBy("path").first()["path"]
    wrong = files.withColumn("rows", F.when(F.col("path") == first, F.col("rows") + 1).otherwise(F.col("rows")))
    assert [tuple(r) for r in maintenance.verify(spark, root, wrong).collect()] == [(first, "rows")]
    frozen = maintenance.freeze(spark, root).cache()
    assert frozen.count() == files.count() and maintenance.thawed(frozen, maintenance.freeze(spark, root)).count() == 0
    maintenance.transcode(spark, root, f"{root}2", "gzip", 1 << 16, 1 << 20)
    rows = spark.read.parquet(root)
    assert spark.read.parquet(f"{root}2").select(rows.columns).exceptAll(rows).count() == 0


def test_small_helpers(spark):
    a, b = (spark.createDataFrame(x, "metric string, value double") for x in ([("x", 1.0), ("y", 2.0)], [("x", 4.0), ("z", 1.0)]))
    assert {r["metric"]: r["delta"] for r in pit.compare_reports(a, b).collect()} == {"x": 3.0, "y": None, "z": None}
    assert maintenance.schema_conflict(a.schema, spark.createDataFrame([(1, 2)], "metric int, other int").schema) == {"extra": ["other"], "missing": ["value"], "retyped": ["metric"]}
