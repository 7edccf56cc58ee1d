"""Controls: clean jobs pass, leaky ones are caught, and a planted signal is found at its size."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidebook import catalog_controls
from tidebook.operators import controls

DATA = "/root/testdata/sf0.01"


def _series(spark):
    rng = np.random.default_rng(3)
    rows = [(v, "s", t, float(x)) for v in ("a", None) for t, x in enumerate(rng.normal(size=40))]
    return spark.createDataFrame(rows, "venue string, symbol string, t long, x double")


@pytest.mark.parametrize("leak", ["none", "lead", "mean", "count"])
def test_leaks_are_caught_in_every_series(spark, leak):
    w = Window.partitionBy("venue", "symbol")
    jobs = {
        "none": lambda d: d.withColumn("f", F.sum("x").over(w.orderBy("t"))),
        "lead": lambda d: d.withColumn("f", F.lead("x", 2).over(w.orderBy("t"))),
        "mean": lambda d: d.withColumn("f", F.col("x") - F.avg("x").over(w)),
        "count": lambda d: d.withColumn("top", F.max("x").over(w)).where("top < 50").drop("top"),
    }
    got = controls.lookahead(jobs[leak], _series(spark), "t", 29, {"x": F.col("x") + 100}, "t").collect()
    assert len(got) == 2 and {r["venue"] for r in got} == {"a", None}
    for r in got:
        assert (r["rows_before"], r["rows_after"]) == (30, 10) and r["verdict"] == ("pass" if leak == "none" else "fail")
        assert r["before_gone"] == {"none": 0, "lead": 2, "mean": 30, "count": 30}[leak]
        assert r["before_added"] == (0 if leak == "count" else r["before_gone"]) and r["after_gone"] == 10


def test_repeats_nulls_and_nothing(spark):
    schema = "venue string, symbol string, t long, x double"
    one = spark.createDataFrame([("a", "s", 1, None), ("a", "s", 1, None), ("a", "s", None, 2.0), ("a", "s", 9, 1.0)], schema)
    two = spark.createDataFrame([("a", "s", 1, None), ("a", "s", None, 2.0), ("a", "s", 9, 1.0 + 1e-13)], schema)
    got = controls.compare(one, two, "t", 5, ["venue", "symbol"]).first()
    assert (got["rows_before"], got["before_gone"], got["before_added"], got["after_gone"], got["verdict"]) == (3, 1, 0, 0, "fail")
    assert controls.compare(one, one, "t", 5, ["venue", "symbol"]).first()["verdict"] == "unproven"
    assert controls.compare(one.limit(0), one.limit(0), "t", 5, ["venue", "symbol"]).count() == 0


def test_planted_signals_come_back_and_a_shifted_one_does_not(spark):
    rows = spark.range(12_000).select(F.lit("v").alias("venue"), F.lit("s").alias("symbol"), F.expr("id div 2000").alias("day"), F.col("id").alias("t"), (controls.gauss(1, "id") * 3 + 5).alias("x"))
    for s in (0.0, 0.1, 0.5):
        p = controls.planted(rows, "x", "y", s, 11).toPandas()
        design = np.column_stack([np.ones(len(p)), p["x"]])
        rest = p["y"] - design @ np.linalg.lstsq(design, p["y"], rcond=None)[0]
        assert 1 - rest.var() / p["y"].var() == pytest.approx(s, abs=0.03)
    got = {r["strength"]: r for r in controls.recovered(rows, "x", [0.0, 0.1, 0.5], 11, 5, 100).collect()}
    for s, r in got.items():
        assert r["folds"] == 5 and r["rows"] == 10_000 and r["r2"] == pytest.approx(s, abs=0.03)
    late = controls.planted(rows, "x", "y", 0.5, 11).withColumn("x", F.lag("x").over(Window.partitionBy("venue").orderBy("t"))).dropna()
    found = controls.study.folds(late, ["x"], "y", 5, 100).agg(F.max("r2_zero").alias("r")).first()["r"]
    assert found < 0.02
    assert controls.planted(rows.withColumn("x", F.lit(1.0)), "x", "y", 0.5, 11).where("y is not null").count() == 0
    again = [controls.planted(rows.repartition(n), "x", "y", 0.5, 11).agg(F.sum(F.round("y", 6).cast("decimal(20,6)"))).first()[0] for n in (2, 7)]
    assert again[0] == again[1]


@pytest.mark.parametrize("name", ["control_book_future", "control_panel_future"])
def test_controls_match_duckdb(spark, name):
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{DATA}/events.parquet'")
    want = con.execute(catalog_controls.oracle_sql()[name])
    order = [d[0] for d in want.description]
    rows = [tuple(r) for r in catalog_controls.queries()[name](spark, DATA).select(order).collect()]
    assert rows and sorted(map(str, rows)) == sorted(map(str, want.fetchall()))
    assert {r[-1] for r in rows if r[0] != "forward_bps"} == {"pass"} and all(r[-1] == "fail" for r in rows if r[0] == "forward_bps")


def test_fold_controls_on_the_tape(spark):
    got = catalog_controls.queries()["control_fold_future"](spark, DATA).collect()
    assert got and all(r["verdict"] == "pass" and r["rows_before"] > 0 for r in got)
    for r in catalog_controls.queries()["control_planted"](spark, DATA).collect():
        assert r["folds"] > 1 and r["r2"] == pytest.approx(r["strength"], abs=0.12)
