"""Registered queries over checkpoints, probes and replays, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import _BASE, _OBS, AT, HOUR, KEYS, START, rows
from .operators import book, pit
from .plans.durable import materialize
from .registry import Registry
from .sources import maintenance, tape

_own = Registry()
query = _own.query
MARKS = [START + 100 * HOUR, START + 190 * HOUR]


@query(_BASE + f""", s AS (SELECT * FROM r WHERE recv_wall <= {AT}), n AS (SELECT venue, symbol, max(epoch) AS epoch FROM s GROUP BY ALL),
w AS (SELECT venue, symbol, side, price, arg_max(qty, row_ordinal) AS qty FROM s JOIN n USING (venue, symbol, epoch) WHERE qty >= 0 GROUP BY ALL) SELECT * FROM w WHERE qty > 0""")
def book_from_checkpoint(spark, sf_dir):
    r = rows(spark, sf_dir)
    return maintenance.restore(r, materialize(maintenance.checkpoints(r, MARKS), "checkpoints"), AT)


@query(_OBS + f""" e AS (SELECT entity, available_at + unnest([-1, 0, 1]) AS as_of FROM o UNION SELECT entity, as_of FROM a) SELECT DISTINCT entity, as_of FROM e""")
def probe_edges(spark, sf_dir):
    return pit.edges(pit.observations(tape.recorded(spark, sf_dir)), START, START + 720 * HOUR, 6 * HOUR)


@query(_OBS + f""" e AS (SELECT entity, available_at + unnest([-1, 0, 1]) AS as_of FROM o UNION SELECT entity, as_of FROM a),
z AS (SELECT entity, as_of AS tt, 1 AS probe, NULL AS arrival, NULL AS event_time FROM e UNION ALL SELECT entity, available_at, 0, arrival, event_time FROM o),
y AS (SELECT entity, tt, probe, max(arrival) OVER (PARTITION BY entity ORDER BY tt, probe) AS arrival FROM z)
SELECT y.entity, y.tt AS as_of, y.arrival, CASE WHEN y.arrival IS NULL THEN 'missing' WHEN o.event_time IS NULL THEN 'age_unknown' WHEN y.tt - o.event_time <= {HOUR} THEN 'fresh' ELSE 'stale' END AS freshness
FROM y LEFT JOIN o ON o.arrival = y.arrival WHERE probe = 1""")
def asof_at_edges(spark, sf_dir):
    seen = pit.observations(tape.recorded(spark, sf_dir))
    return pit.as_of(seen, pit.edges(seen, START, START + 720 * HOUR, 6 * HOUR), HOUR).select("entity", "as_of", "arrival", "freshness")


@query(_BASE + " SELECT venue, symbol, msg_index, CAST(floor(greatest(coalesce(recv_wall - lag(recv_wall) OVER (PARTITION BY venue, symbol ORDER BY first_ordinal), 0), 0) / 5) AS BIGINT) AS wait_ns FROM m")
def paced_replay(spark, sf_dir):
    return pit.paced(book.messages(rows(spark, sf_dir)), 5.0).select(*KEYS, "msg_index", "wait_ns")


queries, oracle_sql = _own.queries, _own.oracle_sql
