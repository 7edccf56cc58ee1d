"""Registered queries of the order-book engine with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import expr
from .operators import book, pit, research, trust
from .plans.durable import materialize
from .registry import Registry
from .sources import tape
from .streaming import features

HOUR = 3_600_000_000_000
START = 1_704_067_200_000_000_000
AT = START + 200 * HOUR
KEYS = ["venue", "symbol"]
CUTS = (START + 300 * HOUR, START + 500 * HOUR)

_BASE = r"""WITH t0 AS (SELECT event_id AS row_ordinal, event_id // 4 AS msg_index, CAST(round(value * 100) AS BIGINT) AS c,
  CAST(regexp_extract(props, '"k": (-?\d+)', 1) AS BIGINT) AS k, epoch_us(ts) AS us FROM events),
t1 AS (SELECT *, max(us) OVER (PARTITION BY msg_index) * 1000 AS recv_wall, CASE WHEN msg_index % 97 = 0 THEN -10000000 ELSE (1 + c % 20) * 10000000 END AS away FROM t0),
tape AS (SELECT CASE WHEN msg_index % 2 = 0 THEN 'kraken' ELSE 'coinbase' END AS venue, 'BTC-USD' AS symbol, row_ordinal, msg_index,
  CASE WHEN (msg_index // 2) % 40 = 0 THEN 0 ELSE 1 END AS event, recv_wall, CASE WHEN msg_index % 41 <> 0 THEN recv_wall - (k - 20) * 1000000 END AS venue_ts,
  CAST(row_ordinal % 2 AS INT) AS side, 100000000000 + CASE WHEN row_ordinal % 2 = 0 THEN -away ELSE away END AS price,
  CASE WHEN k % 5 = 0 THEN 0 ELSE k * 1000000 END AS qty, msg_index % 37 = 0 AS suspect FROM t1),
e0 AS (SELECT *, CASE WHEN event = 0 AND coalesce(lag(event) OVER (PARTITION BY venue, symbol ORDER BY row_ordinal), 1) <> 0 THEN 1 ELSE 0 END AS s FROM tape),
r AS (SELECT * EXCLUDE (s), CAST(sum(s) OVER (PARTITION BY venue, symbol ORDER BY row_ordinal) - 1 AS BIGINT) AS epoch FROM e0),
m AS (SELECT venue, symbol, epoch, msg_index, event, count(*) AS n_rows, min(row_ordinal) AS first_ordinal, max(recv_wall) AS recv_wall, bool_or(suspect) AS suspect
  FROM r GROUP BY venue, symbol, epoch, msg_index, event),
wr AS (SELECT venue, symbol, epoch, msg_index, event, side, price, arg_max(qty, row_ordinal) AS qty FROM r WHERE qty >= 0 GROUP BY ALL),
li AS (SELECT *, lead(msg_index) OVER (PARTITION BY venue, symbol, epoch, side, price ORDER BY msg_index) AS nxt,
  lag(qty) OVER (PARTITION BY venue, symbol, epoch, side, price ORDER BY msg_index) AS before FROM wr),
b AS (SELECT m.venue, m.symbol, m.msg_index, l.side, l.price, l.qty FROM m JOIN li l ON l.venue = m.venue AND l.symbol = m.symbol AND l.epoch = m.epoch AND l.qty > 0
  AND l.msg_index <= m.msg_index AND (l.nxt IS NULL OR m.msg_index < l.nxt)),
tb AS (SELECT venue, symbol, msg_index, max(price) FILTER (side = 0) AS bid, min(price) FILTER (side = 1) AS ask, arg_max(qty, price) FILTER (side = 0) AS bid_qty,
  arg_min(qty, price) FILTER (side = 1) AS ask_qty, count(*) FILTER (side = 0) AS bid_levels, count(*) FILTER (side = 1) AS ask_levels FROM b GROUP BY ALL),
qt AS (SELECT m.venue, m.symbol, m.msg_index, m.first_ordinal, m.recv_wall, m.suspect, bid, ask, (bid + ask) // 2 AS mid, ask - bid AS spread,
  bid > ask AS crossed, bid = ask AS locked FROM m LEFT JOIN tb USING (venue, symbol, msg_index))"""
_PANEL = _BASE + """,
g0 AS (SELECT *, recv_wall + ((-recv_wall) % 3600000000000 + 3600000000000) % 3600000000000 AS t FROM qt WHERE mid IS NOT NULL),
g1 AS (SELECT venue, symbol, t, arg_max(mid, first_ordinal) AS mid, arg_max(spread, first_ordinal) AS spread, arg_max(recv_wall, first_ordinal) AS lw, count(*) AS msgs, count(*) FILTER (suspect) AS suspect_msgs FROM g0 GROUP BY ALL),
g2 AS (SELECT *, coalesce(lead(t) OVER (PARTITION BY venue, symbol ORDER BY t) - 3600000000000, t) AS up FROM g1),
p AS (SELECT venue, symbol, u.t AS t, mid, spread, u.t - lw AS age_ns, CASE WHEN u.t = g2.t THEN msgs ELSE 0 END AS msgs, CASE WHEN u.t = g2.t THEN suspect_msgs ELSE 0 END AS suspect_msgs
  FROM g2, LATERAL (SELECT unnest(generate_series(g2.t, g2.up, 3600000000000)) AS t) u)"""
_WIN = "OVER (PARTITION BY venue, symbol ORDER BY t)"

_own = Registry()
query = _own.query


_numbered_rows: dict[tuple[str, str], DataFrame] = {}


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive's rows with epoch and message number, written once in an application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _numbered_rows:
        _numbered_rows[key] = materialize(book.with_position(tape.recorded(spark, sf_dir)), "numbered")
    return _numbered_rows[key]


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return research.panel(book.quotes(rows(spark, sf_dir)).where("mid is not null"), HOUR)


@query(_BASE + "\nSELECT * FROM tape")
def derived_tape(spark, sf_dir):
    return tape.derived_tape(spark, sf_dir)


@query(_BASE + "\nSELECT venue, symbol, row_ordinal, epoch FROM r")
def epochs(spark, sf_dir):
    return book.with_epoch(tape.recorded(spark, sf_dir)).select(*KEYS, "row_ordinal", "epoch")


@query(_BASE + "\nSELECT venue, symbol, epoch, msg_index, event, n_rows, first_ordinal, recv_wall, suspect FROM m")
def messages(spark, sf_dir):
    return book.messages(rows(spark, sf_dir)).drop("pos")


@query(_BASE + "\nSELECT m.venue, m.symbol, m.msg_index, bid, ask, bid_qty, ask_qty, coalesce(bid_levels, 0) AS bid_levels, coalesce(ask_levels, 0) AS ask_levels FROM m LEFT JOIN tb USING (venue, symbol, msg_index)")
def top_of_book(spark, sf_dir):
    return book.top_of_book(rows(spark, sf_dir)).select(*KEYS, "msg_index", "bid", "ask", "bid_qty", "ask_qty", "bid_levels", "ask_levels")


@query(_BASE + "\nSELECT m.venue, m.symbol, m.msg_index, bid, ask, coalesce(bid_levels, 0) AS bid_levels, coalesce(ask_levels, 0) AS ask_levels FROM m LEFT JOIN tb USING (venue, symbol, msg_index)")
def replay_fold(spark, sf_dir):
    return book.replay(rows(spark, sf_dir)).drop("digest")


@query()
def replay_feed_depth_5(spark, sf_dir):
    return book.replay(rows(spark, sf_dir), limit=5)


@query(_BASE + "\nSELECT venue, symbol, msg_index, first_ordinal, recv_wall, suspect, mid, spread, round(CASE WHEN mid <> 0 THEN spread / mid * 10000 END, 6) AS spread_bps, crossed, locked FROM qt")
def spread_bps(spark, sf_dir):
    return book.quotes(rows(spark, sf_dir))


_DEPTH = """, k AS (SELECT *, row_number() OVER (PARTITION BY venue, symbol, msg_index, side ORDER BY CASE WHEN side = 0 THEN -price ELSE price END) AS rk FROM b)
SELECT venue, symbol, msg_index, CAST(coalesce(sum(qty) FILTER (side = 0), 0) AS BIGINT) AS bid_qty, CAST(coalesce(sum(qty) FILTER (side = 1), 0) AS BIGINT) AS ask_qty,
  count(*) FILTER (side = 0) AS bid_levels, count(*) FILTER (side = 1) AS ask_levels,
  round(CAST(sum(CASE WHEN side = 0 THEN qty ELSE -qty END) AS DOUBLE) / CAST(sum(qty) AS DOUBLE), 9) AS imbalance FROM k WHERE rk <= 5 GROUP BY venue, symbol, msg_index"""


@query(_BASE + _DEPTH)
def depth_top5(spark, sf_dir):
    return book.depth(rows(spark, sf_dir), 5)


@query(_BASE + """ SELECT b.venue, b.symbol, b.msg_index, q.mid, CAST(sum(CASE WHEN side = 0 AND price >= mid - 50000000 THEN qty ELSE 0 END) AS BIGINT) AS bid_qty,
  CAST(sum(CASE WHEN side = 1 AND price <= mid + 50000000 THEN qty ELSE 0 END) AS BIGINT) AS ask_qty FROM b JOIN qt q USING (venue, symbol, msg_index) WHERE q.mid IS NOT NULL GROUP BY ALL""")
def depth_within(spark, sf_dir):
    return book.depth_within(rows(spark, sf_dir), 50_000_000)


@query(_BASE + """ SELECT venue, symbol, recv_wall - recv_wall % 3600000000000 AS bucket, arg_min(mid, first_ordinal) AS open, max(mid) AS high, min(mid) AS low, arg_max(mid, first_ordinal) AS close,
  count(*) AS updates, count(*) FILTER (suspect) AS suspect_updates, CAST(sum(spread) AS BIGINT) AS spread_sum FROM qt WHERE mid IS NOT NULL GROUP BY ALL""")
def bars_1h(spark, sf_dir):
    return book.bars(book.quotes(rows(spark, sf_dir)), HOUR)


@query(_BASE + f""", s AS (SELECT * FROM r WHERE recv_wall <= {AT}), n AS (SELECT venue, symbol, max(epoch) AS epoch FROM s GROUP BY ALL),
w AS (SELECT venue, symbol, side, price, arg_max(qty, row_ordinal) AS qty FROM s JOIN n USING (venue, symbol, epoch) WHERE qty >= 0 GROUP BY ALL) SELECT * FROM w WHERE qty > 0""")
def book_at_instant(spark, sf_dir):
    return book.book_at(rows(spark, sf_dir), AT)


@query(_BASE + " SELECT venue, symbol, msg_index, count(*) AS absent_removals FROM li WHERE event = 1 AND qty = 0 AND coalesce(before, 0) = 0 GROUP BY ALL")
def book_anomalies(spark, sf_dir):
    return book.anomalies(rows(spark, sf_dir))


@query(_BASE + f" SELECT venue, symbol, row_ordinal, recv_wall, side, price, qty FROM tape WHERE recv_wall > {AT} AND recv_wall <= {AT + 24 * HOUR} AND NOT suspect")
def range_scan(spark, sf_dir):
    return tape.recorded(spark, sf_dir, AT, AT + 24 * HOUR).where(~F.col("suspect")).select(*KEYS, "row_ordinal", "recv_wall", "side", "price", "qty")


@query(_BASE + f" SELECT venue, symbol, max(recv_wall) AS snapshot_at FROM tape WHERE event = 0 AND recv_wall <= {AT} GROUP BY ALL")
def snapshot_probe(spark, sf_dir):
    return tape.recorded(spark, sf_dir, until=AT).where(F.col("event") == 0).groupBy(*KEYS).agg(F.max("recv_wall").alias("snapshot_at"))


_OBS = _BASE + f""", o AS (SELECT venue AS entity, price AS value, venue_ts AS event_time, recv_wall AS available_at, row_ordinal AS arrival FROM tape WHERE side = 0 AND qty <> 0),
a AS (SELECT entity, unnest(generate_series({START}, {START + 720 * HOUR}, {6 * HOUR})) AS as_of FROM (SELECT DISTINCT entity FROM o)),
"""


def _asof_sql(clock: str) -> str:
    return _OBS + f"""w AS (SELECT a.entity, a.as_of, max(arrival) AS arrival FROM a LEFT JOIN o ON o.entity = a.entity AND o.{clock} <= a.as_of GROUP BY ALL)
SELECT w.entity, w.as_of, o.value, w.arrival, CASE WHEN w.arrival IS NULL THEN 'missing' WHEN o.event_time IS NULL THEN 'age_unknown' WHEN w.as_of - o.event_time <= {HOUR} THEN 'fresh' ELSE 'stale' END AS freshness
FROM w LEFT JOIN o ON o.arrival = w.arrival"""


def _probed(spark, sf_dir, clock):
    seen = pit.observations(tape.recorded(spark, sf_dir))
    return pit.as_of(seen, pit.grid(seen, START, START + 720 * HOUR, 6 * HOUR), HOUR, clock)


@query(_asof_sql("available_at"))
def asof_observation(spark, sf_dir):
    return _probed(spark, sf_dir, "available_at")


@query(_asof_sql("event_time"))
def event_time_leak_control(spark, sf_dir):
    return _probed(spark, sf_dir, "event_time")


@query(_OBS + f"""w AS (SELECT entity, max(arrival) AS arrival FROM o WHERE available_at <= {AT} GROUP BY ALL)
SELECT entity, o.value, arrival, CASE WHEN o.event_time IS NULL THEN 'age_unknown' WHEN {AT} - o.event_time <= {HOUR} THEN 'fresh' ELSE 'stale' END AS freshness FROM w JOIN o USING (entity, arrival)""")
def online_latest(spark, sf_dir):
    return pit.latest(pit.observations(tape.recorded(spark, sf_dir)), AT, HOUR)


_FIGURES = """count(*) AS rows, count(*) FILTER (side = 0) AS bid_updates, count(*) FILTER (side = 1) AS ask_updates, count(*) FILTER (qty = 0) AS removals, count(*) FILTER (event = 0) AS snapshot_rows, count(*) FILTER (suspect) AS suspect_rows,
  CAST(sum(qty) AS BIGINT) AS qty_sum, count(qty) AS qty_known, min(price) AS price_min, max(price) AS price_max, min(venue_ts) AS event_time_min, max(venue_ts) AS event_time_max, min(recv_wall) AS availability_min, max(recv_wall) AS availability_max,
  min(row_ordinal) AS ordinal_min, max(row_ordinal) AS ordinal_max, min(abs(recv_wall - venue_ts)) AS skew_ns_min, max(abs(recv_wall - venue_ts)) AS skew_ns_max"""
_FEATURES = f"SELECT venue, symbol, CAST(venue_ts - venue_ts % 600000000000 AS BIGINT) AS window_start, {_FIGURES} FROM tape WHERE venue_ts IS NOT NULL GROUP BY ALL"


@query(_BASE + " " + _FEATURES)
def window_features_10m(spark, sf_dir):
    return features.window_features(tape.recorded(spark, sf_dir), "10 minutes")


def _revisions(spark, sf_dir):
    """Three revisions as a sink holds them: each batch sees a third more of the arrivals."""
    t = tape.recorded(spark, sf_dir).withColumn("batch_id", F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(3)]))).where("row_ordinal % 3 <= batch_id and venue_ts is not null")
    cut = t.withColumn("window_start", F.col("venue_ts") - F.pmod("venue_ts", F.lit(600_000_000_000)))
    return cut.groupBy(*KEYS, "window_start", "batch_id").agg(F.count("*").alias("rows"), F.max("recv_wall").alias("availability_max"))


_REV = _BASE + """, rev AS (SELECT venue, symbol, CAST(venue_ts - venue_ts % 600000000000 AS BIGINT) AS window_start, CAST(i AS BIGINT) AS batch_id, count(*) AS rows, max(recv_wall) AS availability_max
  FROM tape, (SELECT unnest([0, 1, 2]) AS i) WHERE row_ordinal % 3 <= i AND venue_ts IS NOT NULL GROUP BY ALL) """


@query(_REV + "SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY venue, symbol, window_start ORDER BY batch_id DESC) AS n FROM rev) WHERE n = 1")
def latest_revision(spark, sf_dir):
    return features.latest_revisions(_revisions(spark, sf_dir))


@query(_REV + f"SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY venue, symbol ORDER BY window_start DESC, batch_id DESC) AS n FROM rev WHERE availability_max <= {AT}) WHERE n = 1")
def revision_as_of(spark, sf_dir):
    return features.revision_as_of(_revisions(spark, sf_dir), AT)


@query(_REV + """, a AS (SELECT * FROM rev WHERE batch_id = 1), z AS (SELECT * FROM rev WHERE batch_id = 2)
SELECT count(*) FILTER (a.rows IS NULL) AS missing, count(*) FILTER (z.rows IS NULL) AS extra, count(*) FILTER (a.rows <> z.rows) AS differ, count(*) FILTER (a.rows = z.rows) AS equal FROM a FULL JOIN z USING (venue, symbol, window_start)""")
def sink_compare(spark, sf_dir):
    rev = _revisions(spark, sf_dir)
    a, z = rev.where("batch_id = 1").select(*KEYS, "window_start", F.col("rows").alias("a")), rev.where("batch_id = 2").select(*KEYS, "window_start", F.col("rows").alias("z"))
    both = a.join(z, [*KEYS, "window_start"], "full")
    return both.agg(F.count_if(F.col("a").isNull()).alias("missing"), F.count_if(F.col("z").isNull()).alias("extra"), F.count_if(F.col("a") != F.col("z")).alias("differ"), F.count_if(F.col("a") == F.col("z")).alias("equal"))


@query(_BASE + """, c AS (SELECT venue, symbol, recv_wall - recv_wall % 21600000000000 AS bucket, count(DISTINCT msg_index) AS messages, count(*) AS rows, count(*) FILTER (suspect) AS suspect_rows FROM tape GROUP BY ALL),
g AS (SELECT venue, symbol, bucket FROM (SELECT DISTINCT venue, symbol FROM c), (SELECT unnest(generate_series(min(bucket), max(bucket), 21600000000000)) AS bucket FROM c))
SELECT venue, symbol, bucket, coalesce(messages, 0) AS messages, coalesce(rows, 0) AS rows, coalesce(suspect_rows, 0) AS suspect_rows,
  CASE WHEN messages IS NULL THEN 'absent' WHEN suspect_rows > 0 THEN 'suspect' WHEN venue = 'kraken' THEN 'clean' ELSE 'unverifiable' END AS state FROM g LEFT JOIN c USING (venue, symbol, bucket)""")
def coverage_grid(spark, sf_dir):
    return trust.coverage_grid(tape.recorded(spark, sf_dir), 6 * HOUR, {"kraken": True, "coinbase": False})


def _numbered(spark, sf_dir):
    """Messages with a counter that skips, repeats and steps back, and a chain that breaks."""
    i = F.expr("msg_index div 2")
    seq = F.when(i % 29 == 0, i - 1).when(i % 31 == 0, i - 5).when(i % 43 == 0, i + 2).otherwise(i)
    return book.messages(rows(spark, sf_dir)).withColumn("seq", seq).withColumn("prev_seq", F.when(i % 40 != 0, F.when(i % 47 == 0, i - 2).otherwise(i - 1)))


_SEQ = _BASE + """, i AS (SELECT *, msg_index // 2 AS i FROM m), sq AS (SELECT *, CASE WHEN i % 29 = 0 THEN i - 1 WHEN i % 31 = 0 THEN i - 5 WHEN i % 43 = 0 THEN i + 2 ELSE i END AS seq,
  CASE WHEN i % 40 <> 0 THEN CASE WHEN i % 47 = 0 THEN i - 2 ELSE i - 1 END END AS prev_seq FROM i) """


@query(_SEQ + """, f AS (SELECT *, max(seq) OVER (PARTITION BY venue, symbol ORDER BY first_ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS fl FROM sq)
SELECT venue, symbol, msg_index, seq, CASE WHEN fl IS NULL THEN 'first' WHEN seq = fl + 1 THEN 'in_order' WHEN seq = fl THEN 'duplicate' WHEN seq < fl THEN 'stale' ELSE 'gap' END AS verdict,
  CASE WHEN seq > fl + 1 THEN seq - fl - 1 ELSE 0 END AS missing FROM f""")
def counter_verdicts(spark, sf_dir):
    return trust.counter_verdicts(_numbered(spark, sf_dir)).select(*KEYS, "msg_index", "seq", "verdict", "missing")


@query(_SEQ + """, f AS (SELECT *, lag(seq) OVER (PARTITION BY venue, symbol ORDER BY first_ordinal) AS la FROM sq)
SELECT venue, symbol, msg_index, CASE WHEN prev_seq IS NULL OR la IS NULL THEN 'reset' WHEN prev_seq = la THEN 'in_order' ELSE 'gap' END AS verdict FROM f""")
def chain_verdicts(spark, sf_dir):
    return trust.chain_verdicts(_numbered(spark, sf_dir)).select(*KEYS, "msg_index", "verdict")


@query(_BASE + """, s AS (SELECT venue, symbol, msg_index, min(row_ordinal) AS first_ordinal, max(venue_ts) AS ts FROM tape GROUP BY ALL),
f AS (SELECT *, max(ts) OVER (PARTITION BY venue, symbol ORDER BY first_ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS fl FROM s)
SELECT venue, symbol, msg_index, CASE WHEN ts IS NULL THEN 'absent' WHEN fl IS NULL OR ts > fl THEN 'unverifiable' WHEN ts = fl THEN 'duplicate' ELSE 'out_of_order' END AS verdict FROM f""")
def timestamp_verdicts(spark, sf_dir):
    stamped = tape.recorded(spark, sf_dir).groupBy(*KEYS, "msg_index").agg(F.min("row_ordinal").alias("first_ordinal"), F.max("venue_ts").alias("venue_ts"))
    return trust.timestamp_verdicts(stamped).select(*KEYS, "msg_index", "verdict")


@query(_BASE + """, o AS (SELECT *, CASE WHEN suspect AND NOT coalesce(lag(suspect) OVER w, false) THEN 1 ELSE 0 END AS op FROM m WINDOW w AS (PARTITION BY venue, symbol ORDER BY first_ordinal)),
u AS (SELECT *, sum(op) OVER (PARTITION BY venue, symbol ORDER BY first_ordinal) AS run FROM o)
SELECT venue, symbol, min(recv_wall) AS opened_at, max(recv_wall) AS last_at, (SELECT s.recv_wall FROM m s WHERE s.venue = u.venue AND s.symbol = u.symbol AND s.event = 0 AND s.first_ordinal > min(u.first_ordinal) ORDER BY s.first_ordinal LIMIT 1) AS healed_at,
  count(*) AS messages FROM u WHERE suspect GROUP BY venue, symbol, run""")
def suspect_windows(spark, sf_dir):
    return trust.suspect_windows(book.messages(rows(spark, sf_dir)))


@query(_BASE + """, n AS (SELECT *, lead(recv_wall) OVER (PARTITION BY venue, symbol ORDER BY first_ordinal) AS nx FROM m)
SELECT venue, symbol, count(*) AS messages, CAST(sum(n_rows) AS BIGINT) AS rows, count(*) FILTER (event = 0) AS snapshots, count(*) FILTER (suspect) AS suspect_messages, max(recv_wall) - min(recv_wall) AS observed_ns,
  CAST(coalesce(sum(nx - recv_wall) FILTER (suspect), 0) AS BIGINT) AS suspect_ns,
  round(CASE WHEN max(recv_wall) > min(recv_wall) THEN 1 - CAST(coalesce(sum(nx - recv_wall) FILTER (suspect), 0) AS DOUBLE) / (max(recv_wall) - min(recv_wall)) END, 9) AS clean_fraction FROM n GROUP BY venue, symbol""")
def gap_report(spark, sf_dir):
    return trust.gap_report(book.messages(rows(spark, sf_dir)))


@query(_BASE + """, s AS (SELECT venue, symbol, recv_wall - venue_ts AS skew FROM tape WHERE venue_ts IS NOT NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY venue, symbol ORDER BY skew) - 1 AS i, count(*) OVER (PARTITION BY venue, symbol) AS n FROM s)
SELECT venue, symbol, min(skew) FILTER (i >= floor(0.5 * (n - 1) + 0.5)) AS q50, min(skew) FILTER (i >= floor(0.9 * (n - 1) + 0.5)) AS q90, min(skew) FILTER (i >= floor(0.99 * (n - 1) + 0.5)) AS q99 FROM k GROUP BY ALL""")
def skew_quantiles(spark, sf_dir):
    skew = tape.recorded(spark, sf_dir).withColumn("skew", F.col("recv_wall") - F.col("venue_ts"))
    return trust.quantile_ranks(skew, "skew", KEYS, [0.5, 0.9, 0.99])


@query(_BASE + """, s AS (SELECT venue, symbol, recv_wall - venue_ts AS x FROM tape WHERE venue_ts IS NOT NULL),
g AS (SELECT *, CASE WHEN x <> 0 THEN CAST(floor(log2(abs(x)::DOUBLE)) AS BIGINT) END AS pw FROM s)
SELECT venue, symbol, CASE WHEN x = 0 THEN 0 ELSE CAST(sign(x) AS BIGINT) * (pw * 8 + CAST(floor((abs(x)::DOUBLE / pow(2.0::DOUBLE, pw) - 1) * 8) AS BIGINT) + 1) END AS bucket, count(*) AS n FROM g GROUP BY ALL""")
def skew_histogram(spark, sf_dir):
    t = tape.recorded(spark, sf_dir).where("venue_ts is not null")
    return t.withColumn("bucket", trust.latency_bucket(F.col("recv_wall") - F.col("venue_ts"))).groupBy(*KEYS, "bucket").agg(F.count("*").alias("n"))


@query(_BASE + """, v AS (SELECT venue, symbol, max(venue_ts) OVER (PARTITION BY venue, symbol ORDER BY row_ordinal) - venue_ts AS behind FROM tape WHERE venue_ts IS NOT NULL)
SELECT venue, symbol, max(behind) AS worst_ns, count(*) FILTER (behind > 0) AS inverted FROM v GROUP BY ALL""")
def worst_inversion(spark, sf_dir):
    return trust.inversions(tape.recorded(spark, sf_dir))


@query(_BASE + """, v AS (SELECT venue, symbol, venue_ts < max(venue_ts) OVER (PARTITION BY venue, symbol ORDER BY row_ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 20000000 AS late FROM tape WHERE venue_ts IS NOT NULL)
SELECT venue, symbol, count(*) AS rows, count(*) FILTER (late) AS late FROM v GROUP BY ALL""")
def late_events(spark, sf_dir):
    return trust.late_rows(tape.recorded(spark, sf_dir).where("venue_ts is not null"), 20_000_000)


@query(_PANEL + " SELECT * FROM p")
def panel_grid(spark, sf_dir):
    return panel(spark, sf_dir)


@query(_PANEL + f" SELECT venue, symbol, t, round((ln(mid::DOUBLE) - lag(ln(mid::DOUBLE), 5) {_WIN}) * 10000, 6) AS trailing_bps, round((lead(ln(mid::DOUBLE), 3) {_WIN} - ln(mid::DOUBLE)) * 10000, 6) AS forward_bps FROM p")
def forward_returns(spark, sf_dir):
    return research.returns(panel(spark, sf_dir), 5, 3)


@query(_PANEL + f""", o AS (SELECT *, suspect_msgs = 0 AND mid IS NOT NULL AS ok, row_number() {_WIN} AS n FROM p)
SELECT venue, symbol, t, n - coalesce(max(CASE WHEN NOT ok THEN n END) {_WIN}, 0) AS clean_run,
  count(*) FILTER (ok) OVER (PARTITION BY venue, symbol ORDER BY t ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING) = 6 AS usable FROM o""")
def clean_run(spark, sf_dir):
    return research.clean_runs(panel(spark, sf_dir), 5)


@query(_PANEL + f""", o AS (SELECT *, suspect_msgs = 0 AS ok, count(*) FILTER (suspect_msgs <> 0) {_WIN} AS isl FROM p),
l AS (SELECT *, ln(mid::DOUBLE) - lag(ln(mid::DOUBLE)) OVER (PARTITION BY venue, symbol, isl ORDER BY t) AS lr FROM o WHERE ok)
SELECT venue, symbol, t, round(CASE WHEN count(lr) OVER w = 10 THEN sqrt(sum(lr * lr) OVER w) END * 10000, 6) AS vol_bps FROM l WINDOW w AS (PARTITION BY venue, symbol, isl ORDER BY t ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""")
def realized_vol(spark, sf_dir):
    return research.realized_volatility(panel(spark, sf_dir), 10)


@query(_PANEL + """ SELECT venue, symbol, t, CASE WHEN count(mid) OVER w = 60 THEN CAST(sum(mid) OVER w AS BIGINT) END AS mid_sum FROM p WINDOW w AS (PARTITION BY venue, symbol ORDER BY t ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)""")
def baseline_roll(spark, sf_dir):
    return research.rolling_mean(panel(spark, sf_dir), 60)


def _split(t: str) -> str:
    return f"CASE WHEN {t} < {CUTS[0]} THEN 'train' WHEN {t} < {CUTS[1]} THEN 'validation' ELSE 'test' END"


_LABELS = _PANEL + f""", lb AS (SELECT venue, symbol, t, {_split("t")} AS split, lead(mid, 3) {_WIN} - mid AS label, {_split(f"lead(t, 3) {_WIN}")} AS es, mid - lag(mid, 3) {_WIN} AS previous FROM p),
lab AS (SELECT * EXCLUDE (es) FROM lb WHERE label IS NOT NULL AND split = es)"""


@query(_LABELS + " SELECT * FROM lab")
def labels_split(spark, sf_dir):
    return research.labels(panel(spark, sf_dir), 3, CUTS)


@query(_LABELS + " SELECT split, count(*) AS n, CAST(sum(abs(label)) AS BIGINT) AS zero_error, CAST(sum(abs(label - previous)) AS BIGINT) AS previous_error FROM lab WHERE previous IS NOT NULL GROUP BY ALL")
def baseline_mae(spark, sf_dir):
    return research.baseline_error(research.labels(panel(spark, sf_dir), 3, CUTS))


@query(_LABELS + """, s AS (SELECT split, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy, sum(y * y) AS syy FROM (SELECT split, previous / 1e6 AS x, label / 1e6 AS y FROM lab WHERE previous IS NOT NULL) GROUP BY ALL)
SELECT split, n, round(1 - (syy - 2 * sxy + sxx) / syy, 6) AS r2, round((n * sxy - sx * sy) / (n * sxx - sx * sx), 6) AS slope FROM s""")
def score_calibration(spark, sf_dir):
    return research.calibration(research.labels(panel(spark, sf_dir), 3, CUTS))


#: No less than the horizon of the labels.
EMBARGO = 3 * HOUR


def _apart(t: str) -> str:
    return f"CASE WHEN {t} < {CUTS[0]} THEN 'train' WHEN {t} >= {CUTS[0] + EMBARGO} AND {t} < {CUTS[1]} THEN 'validation' WHEN {t} >= {CUTS[1] + EMBARGO} THEN 'test' END"


_CLEAN = _PANEL + f""", lb AS (SELECT venue, symbol, t, {_apart("t")} AS split, lead(mid, 3) {_WIN} - mid AS label, {_apart(f"lead(t, 3) {_WIN}")} AS es, mid - lag(mid, 3) {_WIN} AS previous,
  count(*) FILTER (suspect_msgs = 0 AND mid IS NOT NULL) OVER (PARTITION BY venue, symbol ORDER BY t ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) = 4 AS usable FROM p),
lab AS (SELECT * EXCLUDE (es, usable) FROM lb WHERE usable AND label IS NOT NULL AND split = es)"""


@query(_CLEAN + " SELECT * FROM lab")
def labels_clean(spark, sf_dir):
    return research.clean_labels(panel(spark, sf_dir), 3, CUTS, EMBARGO)


@query(_CLEAN + " SELECT split, count(*) AS n, CAST(sum(abs(label)) AS BIGINT) AS zero_error, CAST(sum(abs(label - previous)) AS BIGINT) AS previous_error FROM lab WHERE previous IS NOT NULL GROUP BY ALL")
def baseline_mae_clean(spark, sf_dir):
    return research.baseline_error(research.clean_labels(panel(spark, sf_dir), 3, CUTS, EMBARGO))


@query(_CLEAN + """, s AS (SELECT split, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy, sum(y * y) AS syy FROM (SELECT split, previous / 1e6 AS x, label / 1e6 AS y FROM lab WHERE previous IS NOT NULL) GROUP BY ALL)
SELECT split, n, round(1 - (syy - 2 * sxy + sxx) / syy, 6) AS r2, round((n * sxy - sx * sy) / (n * sxx - sx * sx), 6) AS slope FROM s""")
def score_calibration_clean(spark, sf_dir):
    return research.calibration(research.clean_labels(panel(spark, sf_dir), 3, CUTS, EMBARGO))


@query(_PANEL + f""", f AS (SELECT venue, symbol, t, round((lead(ln(mid::DOUBLE), 1) {_WIN} - ln(mid::DOUBLE)) * 10000, 6) AS v FROM p), d AS (SELECT *, v - avg(v) OVER (PARTITION BY venue, symbol) AS d FROM f WHERE v IS NOT NULL),
g AS (SELECT *, d * lag(d, 1) {_WIN} AS g1, d * lag(d, 2) {_WIN} AS g2, d * lag(d, 3) {_WIN} AS g3 FROM d)
SELECT venue, symbol, count(*) AS n, round(avg(v) / sqrt((sum(d * d) + 1.5 * sum(g1) + 1.0 * sum(g2) + 0.5 * sum(g3)) / count(*) / count(*)), 6) + 0.0 AS t FROM g GROUP BY ALL""")
def hac_t(spark, sf_dir):
    return research.hac_t(research.returns(panel(spark, sf_dir), 1, 1), "forward_bps", 3)


@query(_PANEL + f""", a AS (SELECT *, mid - lag(mid) {_WIN} AS mv FROM p), c AS (SELECT *, CAST(sign(lag(mv) {_WIN}) AS BIGINT) AS sd FROM a), d AS (SELECT *, sd * mv - abs(sd) * 10000000 AS gain FROM c WHERE sd IS NOT NULL AND mv IS NOT NULL),
e AS (SELECT *, sum(gain) {_WIN} AS eq FROM d), f AS (SELECT *, greatest(0, max(eq) {_WIN}) AS pk FROM e)
SELECT venue, symbol, count(*) FILTER (sd <> 0) AS trades, CAST(sum(gain) AS BIGINT) AS total, CAST(max(pk - eq) AS BIGINT) AS drawdown, count(*) FILTER (gain > 0) AS wins FROM f GROUP BY ALL""")
def previous_price_backtest(spark, sf_dir):
    return research.economics(panel(spark, sf_dir), 10_000_000)


@query()
def block_bootstrap(spark, sf_dir):
    return research.block_bootstrap(research.returns(panel(spark, sf_dir), 1, 1), "forward_bps", 24, 500, 7)


def _files(spark, sf_dir):
    """The tape cut to files of 500 rows, as a manifest lists them."""
    t = tape.recorded(spark, sf_dir).withColumn("part", F.expr("row_ordinal div 500"))
    f = t.groupBy(*KEYS, "part").agg(F.count("*").alias("rows"), F.min("recv_wall").alias("first_recv_wall"), F.max("recv_wall").alias("last_recv_wall"))
    return f.select(*KEYS, F.concat_ws("-", "venue", F.col("part").cast("string")).alias("path"), expr.utc_date(F.col("first_recv_wall")).cast("string").alias("date"), "rows", (F.col("rows") * 10).alias("bytes"), "first_recv_wall", "last_recv_wall")


_FILES = _BASE + """, fl AS (SELECT venue, symbol, venue || '-' || (row_ordinal // 500) AS path, CAST(CAST(make_timestamp(min(recv_wall) // 1000) AS DATE) AS VARCHAR) AS date, count(*) AS rows, count(*) * 10 AS bytes, min(recv_wall) AS first_recv_wall, max(recv_wall) AS last_recv_wall
  FROM tape GROUP BY venue, symbol, row_ordinal // 500) """


@query(_FILES + f"SELECT * FROM fl WHERE last_recv_wall > {AT} AND first_recv_wall <= {AT + 24 * HOUR}")
def zone_map_prune(spark, sf_dir):
    return tape.files_in_range(_files(spark, sf_dir), AT, AT + 24 * HOUR)


@query(_FILES + f""", kb AS (SELECT *, sum(bytes) OVER (ORDER BY last_recv_wall DESC, path DESC) AS kb FROM fl WHERE last_recv_wall >= {AT})
SELECT path, 'age' AS reason FROM fl WHERE last_recv_wall < {AT} UNION ALL SELECT path, 'bytes' FROM kb WHERE kb > 40000""")
def retention_select(spark, sf_dir):
    return tape.retention(_files(spark, sf_dir), AT, 0, 40_000).select("path", "reason")


@query(_FILES + "SELECT venue, symbol, date, CAST(sum(rows) AS BIGINT) AS rows, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes, min(first_recv_wall) AS first, max(last_recv_wall) AS last FROM fl GROUP BY ALL")
def partition_rollup(spark, sf_dir):
    return _files(spark, sf_dir).groupBy(*KEYS, "date").agg(F.sum("rows").alias("rows"), F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.min("first_recv_wall").alias("first"), F.max("last_recv_wall").alias("last"))


@query(_BASE + """, x AS (SELECT DISTINCT venue, symbol, price FROM tape), g AS (SELECT venue, symbol, price - lag(price) OVER (PARTITION BY venue, symbol ORDER BY price) AS d FROM x)
SELECT venue, symbol, min(d) AS tick FROM g WHERE d > 0 GROUP BY ALL""")
def observed_tick(spark, sf_dir):
    return trust.observed_tick(tape.recorded(spark, sf_dir))


@query(_BASE + """, k AS (SELECT venue, symbol, spread, row_number() OVER (PARTITION BY venue, symbol ORDER BY spread) - 1 AS i, count(*) OVER (PARTITION BY venue, symbol) AS n FROM qt WHERE spread IS NOT NULL)
SELECT venue, symbol, min(spread) FILTER (i >= floor(0.5 * (n - 1) + 0.5)) AS q50, min(spread) FILTER (i >= floor(0.9 * (n - 1) + 0.5)) AS q90 FROM k GROUP BY ALL""")
def spread_costs(spark, sf_dir):
    return trust.quantile_ranks(book.quotes(rows(spark, sf_dir)), "spread", KEYS, [0.5, 0.9])


@query(_BASE + """ SELECT venue, symbol, m.msg_index, round((((bid::DOUBLE * ask_qty + ask::DOUBLE * bid_qty) / (bid_qty + ask_qty)) - (bid + ask) / 2) / ((bid + ask) / 2) * 10000, 6) AS microprice_bps FROM tb m WHERE bid IS NOT NULL AND ask IS NOT NULL""")
def microprice(spark, sf_dir):
    t = book.top_of_book(rows(spark, sf_dir)).where("bid is not null and ask is not null")
    c = [F.col(x).cast("double") for x in ("bid", "ask", "bid_qty", "ask_qty")]
    return t.select(*KEYS, "msg_index", F.round(expr.microprice_bps(*c), 6).alias("microprice_bps"))


@query("""SELECT l_orderkey, l_linenumber, CAST(round(CAST(l_extendedprice AS DECIMAL(18, 2)) * 1000000000) AS BIGINT) AS units, CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS VARCHAR) AS shown, true AS fits FROM lineitem""")
def fixed_point(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    units = expr.parse_decimal(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"))
    return li.select("l_orderkey", "l_linenumber", units.alias("units"), expr.render_decimal(units, 2).alias("shown"), expr.fits(units, 2).alias("fits"))


@query(_BASE + """ SELECT row_ordinal, strftime(make_timestamp(recv_wall // 1000), '%Y-%m-%dT%H:%M:%S') || '.' || lpad(CAST(recv_wall % 1000000000 AS VARCHAR), 9, '0') || 'Z' AS shown, recv_wall AS parsed,
  CAST(CAST(make_timestamp(recv_wall // 1000) AS DATE) AS VARCHAR) AS day, recv_wall - recv_wall % 600000000000 AS bucket FROM tape""")
def instants(spark, sf_dir):
    t, at = tape.recorded(spark, sf_dir), F.col("recv_wall")
    return t.select("row_ordinal", expr.instant_text(at).alias("shown"), expr.parse_instant(expr.instant_text(at)).alias("parsed"), expr.utc_date(at).cast("string").alias("day"), expr.floor_bucket(at, 600_000_000_000).alias("bucket"))


@query(_BASE + f""", tr AS (SELECT NULL AS venue, {AT} AS lost_from, {AT + HOUR} AS lost_to UNION ALL SELECT 'kraken', {AT - 50 * HOUR}, {AT - 48 * HOUR}), q AS (SELECT venue, symbol, epoch, min(recv_wall) AS a, max(recv_wall) AS z FROM r GROUP BY ALL)
SELECT q.venue, q.symbol, q.epoch, count(*) AS truncations FROM q JOIN tr ON (tr.venue IS NULL OR tr.venue = q.venue) AND tr.lost_from <= q.z AND tr.lost_to >= q.a GROUP BY ALL""")
def truncation_overlap(spark, sf_dir):
    lost = spark.sql(f"select * from values (cast(null as string), {AT}L, {AT + HOUR}L), ('kraken', {AT - 50 * HOUR}L, {AT - 48 * HOUR}L) as t(lost_venue, lost_from, lost_to)")
    spans = rows(spark, sf_dir).groupBy(*KEYS, "epoch").agg(F.min("recv_wall").alias("a"), F.max("recv_wall").alias("z"))
    hit = (F.col("lost_venue").isNull() | (F.col("lost_venue") == F.col("venue"))) & (F.col("lost_from") <= F.col("z")) & (F.col("lost_to") >= F.col("a"))
    return spans.join(F.broadcast(lost), hit).groupBy(*KEYS, "epoch").agg(F.count("*").alias("truncations"))


@query(_BASE + """ SELECT venue, symbol, count(*) AS total, count(DISTINCT row_ordinal) AS distinct_rows, count(*) - count(DISTINCT row_ordinal) AS duplicates, count(*) FILTER (venue_ts IS NULL) AS no_event_time
  FROM (SELECT * FROM tape UNION ALL SELECT * FROM tape WHERE row_ordinal % 10 = 0) GROUP BY ALL""")
def topic_census(spark, sf_dir):
    t = tape.recorded(spark, sf_dir)
    sent = features.parse(features.payloads(t.unionByName(t.where("row_ordinal % 10 = 0"))))
    return sent.groupBy(*KEYS).agg(F.count("*").alias("total"), F.count_distinct("row_ordinal").alias("distinct_rows"), (F.count("*") - F.count_distinct("row_ordinal")).alias("duplicates"), F.count_if(F.col("venue_ts").isNull()).alias("no_event_time"))


queries, oracle_sql = _own.queries, _own.oracle_sql
