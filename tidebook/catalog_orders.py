"""Registered queries over order-by-order books, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import orders
from .registry import Registry
from .sources.order_tape import derived_orders

_own = Registry()
query = _own.query
#: After every event of the tape.
AT = 1 << 60

_EVENTS = r"""WITH x0 AS (SELECT event_id AS ordinal, event_id % 28 // 7 AS turn, event_id % 7 + 7 * (event_id // 28) AS o, CAST(regexp_extract(props, '"k": (-?\d+)', 1) AS BIGINT) AS k FROM events),
ev AS (SELECT CASE WHEN o % 4 < 2 THEN 'bitstamp' ELSE 'kraken' END AS venue, 'BTC-USD' AS symbol, ordinal,
  CASE turn WHEN 0 THEN CASE WHEN o % 23 = 0 THEN 'cancel' ELSE 'add' END WHEN 1 THEN 'modify' WHEN 2 THEN CASE WHEN o % 3 = 0 THEN 'modify' WHEN o % 11 = 0 THEN 'add' ELSE 'execute' END
    ELSE CASE WHEN o % 5 = 0 THEN 'modify' ELSE 'cancel' END END AS action, CAST(o AS VARCHAR) AS order_id, CAST(o % 2 AS INT) AS side,
  100000000000 + CASE WHEN o % 2 = 0 THEN -1 ELSE 1 END * (1 + o % 6 + CASE WHEN turn = 1 AND k % 4 = 0 THEN 1 ELSE 0 END) * 10000000 AS price,
  CASE WHEN k % 9 = 0 THEN 0 ELSE (1 + k % 50) * 1000000 END AS qty, CASE WHEN k % 3 <> 0 THEN turn * 2000000 END AS executed FROM x0),
s0 AS (SELECT *, coalesce(last_value(CASE WHEN action = 'add' AND qty > 0 THEN true WHEN action IN ('cancel', 'execute') OR action = 'modify' AND qty = 0 THEN false END IGNORE NULLS)
  OVER (PARTITION BY venue, symbol, order_id ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS stood FROM ev),
s1 AS (SELECT *, CASE WHEN action = 'add' AND stood THEN 'duplicate_add' WHEN action = 'add' AND qty = 0 THEN 'empty' WHEN action <> 'add' AND NOT stood THEN 'unknown_order' ELSE 'applied' END AS outcome FROM s0),
s2 AS (SELECT *, count(*) FILTER (outcome = 'applied' AND action = 'add') OVER (PARTITION BY venue, symbol, order_id ORDER BY ordinal) AS life FROM s1),
s3 AS (SELECT *, CASE WHEN action <> 'add' THEN lag(price) OVER w END AS price_before, CASE WHEN action <> 'add' THEN lag(qty) OVER w END AS qty_before,
  CASE WHEN action <> 'add' THEN last_value(executed IGNORE NULLS) OVER (PARTITION BY venue, symbol, order_id, life ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS was
  FROM s2 WHERE outcome = 'applied' WINDOW w AS (PARTITION BY venue, symbol, order_id, life ORDER BY ordinal)),
s4 AS (SELECT *, CASE WHEN action IN ('modify', 'execute') THEN CASE WHEN executed IS NOT NULL AND was IS NOT NULL THEN greatest(executed - was, 0) WHEN executed IS NOT NULL THEN least(executed, qty_before)
    WHEN action = 'execute' THEN qty_before ELSE 0 END END AS traded, action = 'add' OR action = 'modify' AND (price <> price_before OR qty > qty_before) AS joins,
  action = 'modify' AND price = price_before AND qty > qty_before AS raised, action NOT IN ('cancel', 'execute') AND qty > 0 AS rests FROM s3),
s5 AS (SELECT *, max(CASE WHEN joins THEN ordinal END) OVER w AS queued, bool_or(raised) OVER w AS shaken, lead(ordinal) OVER (PARTITION BY venue, symbol, order_id ORDER BY ordinal) AS nxt
  FROM s4 WINDOW w AS (PARTITION BY venue, symbol, order_id, life ORDER BY ordinal))"""
_AT = _EVENTS + f""",
here AS (SELECT * FROM s5 WHERE rests AND ordinal <= {AT} AND (nxt IS NULL OR nxt > {AT}))"""


def _done(spark, sf_dir):
    return orders.applied(derived_orders(spark, sf_dir))


@query(_EVENTS + " SELECT * FROM ev")
def order_events(spark, sf_dir):
    return derived_orders(spark, sf_dir)


@query(_EVENTS + " SELECT venue, symbol, ordinal, s1.outcome, s5.traded, s5.queued FROM s1 LEFT JOIN s5 USING (venue, symbol, ordinal)")
def order_outcomes(spark, sf_dir):
    return _done(spark, sf_dir).select("venue", "symbol", "ordinal", "outcome", "traded", "queued")


@query(_EVENTS + """ SELECT venue, symbol, count(*) FILTER (s1.outcome = 'applied') AS applied, count(*) FILTER (s1.outcome = 'duplicate_add') AS duplicate_adds, count(*) FILTER (s1.outcome = 'unknown_order') AS unknown_orders,
  CAST(0 AS BIGINT) AS negative, count(*) FILTER (s5.action = 'modify' AND s5.price <> s5.price_before) AS price_moves, CAST(coalesce(sum(s5.traded), 0) AS BIGINT) AS traded FROM s1 LEFT JOIN s5 USING (venue, symbol, ordinal) GROUP BY ALL""")
def order_anomalies(spark, sf_dir):
    return orders.anomalies(_done(spark, sf_dir))


@query(_AT + """,
marks AS (SELECT venue, symbol, side, price, max(ordinal) AS marked FROM s1 WHERE outcome = 'unknown_order' AND ordinal <= """ + f"""{AT} GROUP BY ALL),
steps AS (SELECT venue, symbol, side, price_before AS price, ordinal, -1 AS step, 0 AS phase FROM s5 WHERE ordinal <= {AT} AND action <> 'add' AND (joins OR NOT rests)
  UNION ALL SELECT venue, symbol, side, price, ordinal, 1, 1 FROM s5 WHERE ordinal <= {AT} AND joins UNION ALL SELECT venue, symbol, side, price, ordinal, -1, 2 FROM s5 WHERE ordinal <= {AT} AND joins AND NOT rests),
cl AS (SELECT venue, symbol, side, price, max(ordinal) AS cleared FROM (SELECT *, sum(step) OVER (PARTITION BY venue, symbol, side, price ORDER BY ordinal, phase) AS n FROM steps) WHERE n = 0 AND step < 0 GROUP BY ALL),
bad AS (SELECT marks.* FROM marks LEFT JOIN cl USING (venue, symbol, side, price) WHERE cleared IS NULL OR cleared < marked)
SELECT venue, symbol, order_id, side, price, qty, row_number() OVER w - 1 AS position, CAST(coalesce(sum(qty) OVER (PARTITION BY venue, symbol, side, price ORDER BY queued ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS qty_ahead,
  CASE WHEN marked IS NOT NULL OR bool_or(shaken) OVER w THEN 'unknown' ELSE 'observed' END AS certainty FROM here LEFT JOIN bad USING (venue, symbol, side, price) WINDOW w AS (PARTITION BY venue, symbol, side, price ORDER BY queued)""")
def queue_positions(spark, sf_dir):
    return orders.queues(_done(spark, sf_dir), AT)


@query(_AT + " SELECT venue, symbol, side, price, CAST(sum(qty) AS BIGINT) AS qty, count(*) AS orders FROM here GROUP BY ALL")
def orders_to_levels(spark, sf_dir):
    return orders.to_levels(orders.standing(_done(spark, sf_dir), AT))


@query(_AT + """, a AS (SELECT venue, symbol, side, price, sum(qty) AS qa FROM here GROUP BY ALL), b AS (SELECT venue, symbol, side, price, sum(qty) AS qb FROM here WHERE NOT shaken GROUP BY ALL)
SELECT venue, symbol, count(*) FILTER (qa = qb) AS equal, count(*) FILTER (qa <> qb) AS differ, count(*) FILTER (qb IS NULL) AS only_first, count(*) FILTER (qa IS NULL) AS only_second FROM a FULL JOIN b USING (venue, symbol, side, price) GROUP BY ALL""")
def order_reconciliation(spark, sf_dir):
    here = orders.standing(_done(spark, sf_dir), AT)
    return orders.reconcile(orders.to_levels(here), orders.to_levels(here.where(F.col("certainty") == orders.OBSERVED)))


@query(_EVENTS + " SELECT venue, symbol, ordinal - ordinal % 100 AS bucket, CAST(sum(traded) AS BIGINT) AS traded, count(*) FILTER (traded > 0) AS trades FROM s5 WHERE traded IS NOT NULL GROUP BY ALL")
def traded_volume(spark, sf_dir):
    done = _done(spark, sf_dir).where("traded is not null").withColumn("bucket", F.col("ordinal") - F.pmod("ordinal", F.lit(100)))
    return done.groupBy("venue", "symbol", "bucket").agg(F.sum("traded").alias("traded"), F.count_if(F.col("traded") > 0).alias("trades"))


queries, oracle_sql = _own.queries, _own.oracle_sql
