"""An archive opened from footers: what is pruned, what is damaged, and the rows that are left."""

import os

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tidebook import catalog_archive
from tidebook.sources import footers, tape

DATA = "/root/testdata/sf0.001"
DAY = 86_400_000_000_000


@pytest.fixture
def archive(tmp_path):
    """Three files: two row groups of a day, another venue's, one with a null bound, and a symbol that Hive escapes."""
    def put(folder, name, walls, groups=100):
        os.makedirs(tmp_path / folder, exist_ok=True)
        t = pa.table({"recv_wall": pa.array(walls, pa.int64()), "qty": pa.array([1] * len(walls), pa.int64()), "note": pa.array(["x"] * len(walls))})
        pq.write_table(t.replace_schema_metadata({"price_scale": "9"}), tmp_path / folder / name, row_group_size=groups)
        return f"{folder}/{name}"

    a = put("venue=kraken/symbol=BTC-USD/date=1970-01-01", "b.parquet", list(range(200)))
    b = put("venue=kraken/symbol=BTC-USD/date=1970-01-02", "a.parquet", [DAY + i for i in range(50)] + [None])
    c = put("venue=okx/symbol=A%2FB+C/date=1970-01-01", "c.parquet", [None, None])
    return str(tmp_path), [a, b, c]


def test_tables_and_plans(spark, archive):
    root, (a, b, c) = archive
    files = footers.listed(spark, root)
    assert {r["path"] for r in files.collect()} == {a, b, c}
    told = footers.footers(files.unionByName(files), root).cache()
    got = {r["path"]: r.asDict() for r in footers.file_table(told).collect()}
    assert (got[a]["rows"], got[a]["groups"], got[a]["first_recv_wall"], got[a]["last_recv_wall"]) == (200, 2, 0, 199)
    assert got[b]["rows"] == 51 and got[b]["first_recv_wall"] == DAY and str(got[b]["date"]) == "1970-01-02"
    assert got[c]["symbol"] == "A/B+C" and got[c]["first_recv_wall"] is None and got[c]["rows"] == 2
    texts = told.where("`column` = 'note' and path like '%kraken%1970-01-01%'").first()
    assert (texts["low_text"], texts["low"]) == ("x", None)
    planned = footers.plan(told, 99, 150)
    assert footers.pruned(planned).first().asDict() == {"files": 3, "files_kept": 1, "groups": 4, "groups_kept": 1, "rows": 253, "rows_kept": 100}
    assert sorted(r[0] for r in footers.scan(spark, root, planned, 99, 150).select("recv_wall").collect()) == list(range(100, 151))
    assert footers.scan(spark, root, footers.plan(told, 5 * DAY, 6 * DAY), 5 * DAY, 6 * DAY).count() == 0
    assert footers.footers(files.limit(0), root).count() == 0 and footers.pruned(planned.limit(0)).first()["rows"] == 0
    places = {r["path"]: r["place"] for r in footers.in_order(footers.file_table(told)).collect()}
    assert places == {a: 1, b: 1, c: 1}


def test_damage_is_a_row_and_nothing_stops(spark, archive):
    root, (a, b, c) = archive
    footers.write_manifest(footers.file_table(footers.footers(footers.listed(spark, root), root)), f"{root}/_manifest")
    live = tape.read_manifest(spark, f"{root}/_manifest").cache()
    check = lambda m: {(r["path"], r["problem"]) for r in footers.verified(m, footers.inspected(m, root), footers.footers(m, root)).collect()}
    assert check(live) == set()
    assert {p for _, p in check(live.selectExpr("path", "rows + 1 as rows", "'gemini' as venue", "symbol", "first_recv_wall", "last_recv_wall + 1 as last_recv_wall"))} == {"rows", "mislabelled", "span"}
    noted = footers.verified(live, footers.inspected(live, root), footers.footers(live, root), scale=8).collect()
    assert {(r["problem"], r["detail"]) for r in noted} == {("scale", "9")} and len(noted) == 3
    with open(f"{root}/{a}", "r+b") as f:  # a page, the footer stays good
        f.seek(8)
        f.write(b"\xff" * 60)
    with open(f"{root}/{b}", "r+b") as f:
        f.truncate(40)
    os.remove(f"{root}/{c}")
    got = check(live)
    assert got == {(a, "unreadable"), (b, "unreadable"), (c, "absent")}
    bad = {r["path"]: r["problem"] for r in footers.footers(live, root).where("problem is not null").collect()}
    assert set(bad) == {b, c} and bad[c] == "absent"


def test_opener_is_the_callers(spark, archive):
    root, (a, _, _) = archive
    inside = f"{root}/"
    opener = lambda path: footers.open_uri(path.replace("held://x/", inside))
    assert footers.footers(spark.createDataFrame([(a,), (None,)], "path string"), "held://x", opener).where("row_group is null").first()["rows"] == 200


@pytest.mark.parametrize("name", ["archive_days", "planned_scan"])
def test_footers_match_duckdb(spark, name):
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{DATA}/events.parquet'")
    want = con.execute(catalog_archive.oracle_sql()[name])
    order = [d[0] for d in want.description]
    rows = [tuple(r) for r in catalog_archive.queries()[name](spark, DATA).select(order).collect()]
    assert rows and sorted(map(str, rows)) == sorted(map(str, want.fetchall()))


def test_the_archive_is_sound_and_pruned(spark):
    q = catalog_archive.queries()
    assert q["archive_problems"](spark, DATA).count() == 0
    r = q["pruned_counts"](spark, DATA).first()
    assert 0 < r["files_kept"] < r["files"] and r["rows_kept"] < r["rows"]
    assert q["files_in_order"](spark, DATA).count() == r["files"]
