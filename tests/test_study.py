"""Folds from moments against least squares on the rows themselves."""

import duckdb
import numpy as np
import pytest

from tidebook import catalog, catalog_research
from tidebook.operators import research, study

DATA = "/root/testdata/sf0.001"


def test_folds_match_least_squares(spark):
    rng = np.random.default_rng(5)
    rows = []
    for day in range(3):
        for t in range(60):
            a, b = rng.normal(), rng.normal() * (3 if day == 2 else 1)
            rows.append(("v", "s", day, day * 100 + t, a, 2 * a + 1, b, 4.0, 0.5 * a - b + rng.normal() / 5))
    names = ["venue", "symbol", "day", "t", "a", "twice", "b", "flat", "y"]
    df = spark.createDataFrame(rows, names)
    got = {r["day"]: r for r in study.folds(df, ["a", "twice", "b", "flat"], "y", 5, 20).collect()}
    assert sorted(got) == [1, 2]
    data = np.array([r[2:] for r in rows], float)
    for day in (1, 2):
        train = np.concatenate([data[data[:, 0] == d][:-5] for d in range(day)])
        test = data[data[:, 0] == day]
        design = lambda m: np.column_stack([np.ones(len(m)), m[:, 2], m[:, 4]])
        beta = np.linalg.lstsq(design(train), train[:, 6], rcond=None)[0]
        low, high = train[:, [2, 4]].min(0), train[:, [2, 4]].max(0)
        held = np.clip(test[:, [2, 4]], low, high)
        p = np.column_stack([np.ones(len(test)), held]) @ beta
        y = test[:, 6]
        assert got[day]["kept"] == ["a", "b"] and (got[day]["n_train"], got[day]["n_test"]) == (len(train), 60)
        assert got[day]["r2_zero"] == pytest.approx(1 - ((y - p) ** 2).sum() / (y**2).sum())
        assert got[day]["clipped"] == pytest.approx((held != test[:, [2, 4]]).mean())
        assert got[day]["edge"] == pytest.approx((np.sign(p) * y).mean())
    assert study.fold_summary(study.folds(df, ["a", "b"], "y", 5, 20)).first()["folds"] == 2


def test_crossed_interval_holds_the_mean(spark):
    df = spark.createDataFrame([(d, v, float(d + v)) for d in range(6) for v in range(3) for _ in range(4)], "d int, v int, x double")
    r = study.crossed_interval(df, "x", "d", "v", 200, 1).first()
    assert r["mean"] == pytest.approx(3.5) and r["low"] < 3.5 < r["high"]


def test_crossed_bootstrap_runs(spark):
    assert catalog_research.queries()["crossed_bootstrap"](spark, DATA).collect()


def test_clean_labels_leave_out_gaps_and_embargo(spark):
    bad, missing = {7}, {30}
    rows = [("v", "s", t, None if t in missing else 100 + t * t, int(t in bad)) for t in range(60)]
    p = spark.createDataFrame(rows, "venue string, symbol string, t long, mid long, suspect_msgs long")
    split = lambda t: "train" if t < 20 else "validation" if 24 <= t < 40 else "test" if t >= 44 else None
    want = {(t, split(t), (t + 3) ** 2 - t * t) for t in range(57) if split(t) and split(t) == split(t + 3) and not (bad | missing) & set(range(t, t + 4))}
    assert {(r["t"], r["split"], r["label"]) for r in research.clean_labels(p, 3, (20, 40), 4).collect()} == want
    kept = {r["t"] for r in research.labels(p, 3, (20, 40)).collect()}
    assert {t for t, _, _ in want} < kept and {5, 6, 29} <= kept


@pytest.mark.parametrize("name", ["labels_split", "labels_clean", "baseline_mae_clean", "score_calibration_clean"])
def test_labels_match_duckdb(spark, name):
    con = duckdb.connect()
    con.execute("create view events as select * from '/root/testdata/sf0.01/events.parquet'")
    want = con.execute(catalog.oracle_sql()[name])
    order = [d[0] for d in want.description]
    rows = [tuple(r) for r in catalog.queries()[name](spark, "/root/testdata/sf0.01").select(order).collect()]
    assert rows and sorted(map(str, rows)) == sorted(map(str, want.fetchall()))
    print(name, len(rows))
