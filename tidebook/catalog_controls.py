"""Registered queries of controls: futures rewritten in books, panels and folds, and signals planted."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from .catalog import _BASE, _PANEL, _WIN, AT, HOUR, KEYS, START, panel
from .catalog_research import WEEK, fold_rows
from .operators import book, controls, research, study
from .registry import Registry
from .sources import tape

_own = Registry()
query = _own.query

_COUNTS = """count(*) FILTER (NOT late) AS rows_before, count(*) FILTER (NOT late AND d) AS before_gone, count(*) FILTER (NOT late AND d) AS before_added,
  count(*) FILTER (late) AS rows_after, count(*) FILTER (late AND d) AS after_gone, count(*) FILTER (late AND d) AS after_added,
  CASE WHEN count(*) FILTER (NOT late AND d) > 0 THEN 'fail' WHEN count(*) FILTER (late AND d) = 0 THEN 'unproven' ELSE 'pass' END AS verdict"""
# The levels once more, from rows whose quantities after the instant are seven times as large.
_LEVELS = re.sub(r"\b(wr|li|b|tb|r)\b", r"\g<1>2", _BASE[_BASE.index("wr AS") : _BASE.index(",\nqt AS")])


@query(_BASE + f""", r2 AS (SELECT * REPLACE (CASE WHEN recv_wall > {AT} THEN qty * 7 ELSE qty END AS qty) FROM r), {_LEVELS},
x AS (SELECT m.venue, m.symbol, m.recv_wall > {AT} AS late, (tb.bid, tb.ask, tb.bid_qty, tb.ask_qty, tb.bid_levels, tb.ask_levels) IS DISTINCT FROM (tb2.bid, tb2.ask, tb2.bid_qty, tb2.ask_qty, tb2.bid_levels, tb2.ask_levels) AS d
  FROM m LEFT JOIN tb USING (venue, symbol, msg_index) LEFT JOIN tb2 USING (venue, symbol, msg_index)) SELECT venue, symbol, {_COUNTS} FROM x GROUP BY ALL""")
def control_book_future(spark, sf_dir):
    """Quantities of the tape after an instant are rewritten; no book up to it may change."""
    job = lambda rows: book.top_of_book(book.with_position(rows))
    return controls.lookahead(job, tape.recorded(spark, sf_dir), "recv_wall", AT, {"qty": F.col("qty") * 7}, "recv_wall")


_MOVES = f"round((ln(mid::DOUBLE) - lag(ln(mid::DOUBLE), 5) {_WIN}) * 10000, 6) AS trailing_bps, round((lead(ln(mid::DOUBLE), 3) {_WIN} - ln(mid::DOUBLE)) * 10000, 6) AS forward_bps"


@query(_PANEL + f""", p2 AS (SELECT * REPLACE (CASE WHEN t > {AT} THEN mid + (1 + (t // {HOUR}) % 7) * 10000000 ELSE mid END AS mid) FROM p),
a AS (UNPIVOT (SELECT venue, symbol, t, {_MOVES} FROM p) ON trailing_bps, forward_bps INTO NAME job VALUE v), a2 AS (UNPIVOT (SELECT venue, symbol, t, {_MOVES} FROM p2) ON trailing_bps, forward_bps INTO NAME job VALUE v),
k AS (SELECT job, venue, symbol, t FROM p, (VALUES ('trailing_bps'), ('forward_bps')) j(job)),
x AS (SELECT job, venue, symbol, t > {AT} AS late, a.v IS DISTINCT FROM a2.v AS d FROM k LEFT JOIN a USING (job, venue, symbol, t) LEFT JOIN a2 USING (job, venue, symbol, t)) SELECT job, venue, symbol, {_COUNTS} FROM x GROUP BY job, venue, symbol""")
def control_panel_future(spark, sf_dir):
    """Mids after an instant are rewritten: trailing moves up to it stay, forward moves, which a feature must not be, don't."""
    job = lambda p: research.returns(p, 5, 3).unpivot(research.ROW, ["trailing_bps", "forward_bps"], "job", "value")
    moved = F.col("mid") + (1 + F.expr(f"t div {HOUR}") % 7) * 10_000_000
    return controls.lookahead(job, panel(spark, sf_dir), "t", AT, {"mid": moved}, "t", ["job", *KEYS])


@query()
def control_fold_future(spark, sf_dir):
    """Features and targets after a week are replaced by noise; folds tested by then may not change."""
    features = ["r1", "r5", "spread", "half_spread"]
    noise = {c: controls.gauss(i, *KEYS, "t") * 100 for i, c in enumerate([*features, "y"])}
    job = lambda rows: study.folds(rows, [*features, "one"], "y", 3, 30)
    return controls.lookahead(job, fold_rows(spark, sf_dir), "day", START // WEEK + 2, noise, "day")


@query()
def control_planted(spark, sf_dir):
    """What the folds find of signals that explain nothing, a twentieth and three tenths of a target."""
    return controls.recovered(fold_rows(spark, sf_dir), "r1", [0.0, 0.05, 0.3], 7, 3, 30)


queries, oracle_sql = _own.queries, _own.oracle_sql
