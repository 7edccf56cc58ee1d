"""Registered queries of an archive's footers: its files, what a range prunes, the scan planned from them, verification."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import _BASE, AT, HOUR, KEYS
from .plans.durable import materialize, scratch_path
from .registry import Registry
from .sources import footers, tape

_own = Registry()
query = _own.query
UNTIL = AT + 24 * HOUR


def _live(spark, sf_dir):
    """The archive, its live files by a manifest written from footers, and the footers of those files."""
    root = tape.archive_of(spark, sf_dir)
    found = footers.file_table(footers.footers(footers.listed(spark, root), root))
    path = scratch_path(spark, "manifest")
    footers.write_manifest(found, path)
    live = tape.read_manifest(spark, path)
    return root, live, materialize(footers.footers(live, root), "footers")


@query(_BASE + """ SELECT venue, symbol, make_date(1970, 1, 1) + CAST(recv_wall // 86400000000000 AS INT) AS date, count(*) AS rows, min(recv_wall) AS first_recv_wall, max(recv_wall) AS last_recv_wall,
  CAST(count(*) FILTER (venue_ts IS NULL) AS BIGINT) AS unstamped FROM tape GROUP BY ALL""")
def archive_days(spark, sf_dir):
    """Rows, span and rows without a venue's stamp per day, from footers alone."""
    _, _, told = _live(spark, sf_dir)
    nulls = told.where("`column` = 'venue_ts'").groupBy("path").agg(F.sum("nulls").alias("nulls"))
    files = footers.file_table(told).join(nulls, "path", "left")
    return files.groupBy(*KEYS, "date").agg(F.sum("rows").alias("rows"), F.min("first_recv_wall").alias("first_recv_wall"), F.max("last_recv_wall").alias("last_recv_wall"), F.sum("nulls").alias("unstamped"))


@query(_BASE + f" SELECT venue, symbol, row_ordinal, recv_wall, side, price, qty FROM tape WHERE recv_wall > {AT} AND recv_wall <= {UNTIL}")
def planned_scan(spark, sf_dir):
    """The rows of a day, of which only the files that footers leave are opened."""
    root, _, told = _live(spark, sf_dir)
    return footers.scan(spark, root, footers.plan(told, AT, UNTIL), AT, UNTIL).select(*KEYS, "row_ordinal", "recv_wall", "side", "price", "qty")


@query()
def pruned_counts(spark, sf_dir):
    """How many files, row groups and rows that day keeps of all."""
    return footers.pruned(footers.plan(_live(spark, sf_dir)[2], AT, UNTIL))


@query()
def archive_problems(spark, sf_dir):
    """Verification by reading every page of every live file; a sound archive has no rows."""
    root, live, told = _live(spark, sf_dir)
    return footers.verified(live, footers.inspected(live, root), told)


@query()
def files_in_order(spark, sf_dir):
    """The files of each day by their first receipt."""
    return footers.in_order(footers.file_table(_live(spark, sf_dir)[2]))


queries, oracle_sql = _own.queries, _own.oracle_sql
