"""Registered queries of accounts: volume, counters, trust, ranges, plans, faults and panels, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import _BASE, _FIGURES, _OBS, _PANEL, _REV, _SEQ, AT, HOUR, KEYS, START, _numbered, _probed, _revisions, panel, rows
from .functions import expr
from .operators import accounts, book, research, trust
from .plans import running
from .registry import Registry
from .sources import tape
from .streaming import features

_own = Registry()
query = _own.query
DAY = 24 * HOUR

# What coinbase rows tell of trades; kraken's tell none.
_TRADED = "CASE WHEN venue = 'coinbase' AND row_ordinal % 5 = 0 THEN qty // 4 END"


def _traded(df):
    return df.withColumn("traded", F.when((F.col("venue") == "coinbase") & (F.col("row_ordinal") % 5 == 0), F.expr("qty div 4")))


_VOLUME = _BASE + f""", tv AS (SELECT venue, symbol, msg_index, max(recv_wall) AS recv_wall, CASE WHEN venue = 'coinbase' THEN CAST(coalesce(sum({_TRADED}), 0) AS BIGINT) END AS traded FROM r GROUP BY venue, symbol, msg_index)"""
_OPEN = "(recv_wall // 3600000000000) % 11 <> 0"


@query(_VOLUME + " SELECT venue, symbol, msg_index, traded FROM tv")
def message_volume(spark, sf_dir):
    return accounts.message_volume(_traded(rows(spark, sf_dir)), F.col("venue") == "coinbase").select(*KEYS, "msg_index", "traded")


def _bars(spark, sf_dir):
    """Bars of the book as if it had one side only in every eleventh hour."""
    r = rows(spark, sf_dir)
    ticks = book.quotes(r).where((F.expr("recv_wall div 3600000000000") % 11) != 0)
    return book.bars_with_volume(ticks, accounts.message_volume(_traded(r), F.col("venue") == "coinbase"), HOUR)


@query(_VOLUME + f""", bv AS (SELECT venue, symbol, recv_wall - recv_wall % {HOUR} AS bucket, CAST(sum(traded) AS BIGINT) AS traded FROM tv GROUP BY ALL),
bb AS (SELECT venue, symbol, recv_wall - recv_wall % {HOUR} AS bucket, arg_min(mid, first_ordinal) AS open, max(mid) AS high, min(mid) AS low, arg_max(mid, first_ordinal) AS close, count(*) AS updates, count(*) FILTER (suspect) AS suspect_updates,
  round(CAST(sum(spread) AS DOUBLE) / count(*), 6) AS mean_spread FROM qt WHERE mid IS NOT NULL AND {_OPEN} GROUP BY ALL) SELECT bb.*, traded FROM bb LEFT JOIN bv USING (venue, symbol, bucket)""")
def bars_with_volume(spark, sf_dir):
    return _bars(spark, sf_dir)[0]


@query(_VOLUME + f""", bv AS (SELECT venue, symbol, recv_wall - recv_wall % {HOUR} AS bucket, CAST(sum(traded) AS BIGINT) AS traded FROM tv GROUP BY ALL),
bb AS (SELECT DISTINCT venue, symbol, recv_wall - recv_wall % {HOUR} AS bucket FROM qt WHERE mid IS NOT NULL AND {_OPEN}) SELECT bv.* FROM bv ANTI JOIN bb USING (venue, symbol, bucket) WHERE traded IS NOT NULL""")
def unattributed_volume(spark, sf_dir):
    return _bars(spark, sf_dir)[1]


@query(_BASE + f""", w AS (SELECT *, {_TRADED} AS traded, venue_ts - venue_ts % 10000000000 AS window_start FROM r WHERE venue_ts IS NOT NULL)
SELECT venue, symbol, window_start, window_start + 10000000000 AS window_end, {_FIGURES}, count(*) FILTER (row_ordinal % 50 = 0) AS unknown_field_rows, CAST(sum(traded) AS BIGINT) AS traded_sum, count(traded) AS traded_known,
  min(epoch) AS epoch_min, max(epoch) AS epoch_max, min(CASE WHEN row_ordinal % 100 = 0 THEN 2 ELSE 1 END) AS schema_version_min, max(CASE WHEN row_ordinal % 100 = 0 THEN 2 ELSE 1 END) AS schema_version_max FROM w GROUP BY venue, symbol, window_start""")
def window_features_10s(spark, sf_dir):
    return features.windowed(_topic(spark, sf_dir), 10_000_000_000)


def _topic(spark, sf_dir):
    return _traded(rows(spark, sf_dir)).withColumn("schema_version", F.when(F.col("row_ordinal") % 100 == 0, 2).otherwise(1)).withColumn("unknown_fields", (F.col("row_ordinal") % 50 == 0).cast("int"))


_JUDGED = _SEQ + """, f AS (SELECT *, max(seq) OVER (PARTITION BY venue, symbol ORDER BY first_ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS fl FROM sq),
v AS (SELECT *, CASE WHEN fl IS NULL THEN 'first' WHEN seq = fl + 1 THEN 'in_order' WHEN seq = fl THEN 'duplicate' WHEN seq < fl THEN 'stale' ELSE 'gap' END AS verdict, CASE WHEN seq > fl + 1 THEN seq - fl - 1 ELSE 0 END AS missing FROM f),
ar AS (SELECT venue, symbol, msg_index, count(*) AS n FROM li WHERE event = 1 AND qty = 0 AND coalesce(before, 0) = 0 GROUP BY ALL),
j AS (SELECT v.*, coalesce(qt.crossed, false) AS crossed, coalesce(qt.locked, false) AS locked, coalesce(ar.n, 0) AS absent FROM v JOIN qt USING (venue, symbol, msg_index) LEFT JOIN ar USING (venue, symbol, msg_index)),
ex AS (SELECT * FROM (VALUES ('kraken', 'BTC-USD'), ('coinbase', 'BTC-USD'), ('okx', 'BTC-USD')) x(venue, symbol)),
g AS (SELECT ex.venue, ex.symbol, count(j.msg_index) AS messages, count(j.msg_index) FILTER (verdict NOT IN ('duplicate', 'stale')) AS applied, count(*) FILTER (event = 0) AS snapshots, count(*) FILTER (verdict = 'duplicate') AS duplicates, count(*) FILTER (verdict = 'stale') AS stale,
  CAST(0 AS BIGINT) AS unverifiable, count(*) FILTER (verdict = 'gap') AS sequence_gaps, CAST(coalesce(sum(missing), 0) AS BIGINT) AS messages_missing, CAST(0 AS BIGINT) AS out_of_order, CAST(0 AS BIGINT) AS divergences, CAST(0 AS BIGINT) AS resets,
  count(*) FILTER (crossed) AS crossed, count(*) FILTER (locked) AS locked, CAST(coalesce(sum(absent), 0) AS BIGINT) AS absent_removals, min(recv_wall) AS first_seen, max(recv_wall) AS last_seen FROM ex LEFT JOIN j USING (venue, symbol) GROUP BY ALL)"""


def _report(spark, sf_dir):
    r = rows(spark, sf_dir)
    judged = trust.counter_verdicts(_numbered(spark, sf_dir)).select(*KEYS, "msg_index", "event", "recv_wall", "verdict", "missing")
    touch = book.quotes(r).select(*KEYS, "msg_index", F.coalesce("crossed", F.lit(False)).alias("crossed"), F.coalesce("locked", F.lit(False)).alias("locked"))
    joined = judged.join(touch, [*KEYS, "msg_index"]).join(book.anomalies(r), [*KEYS, "msg_index"], "left").na.fill(0, ["absent_removals"])
    expected = spark.createDataFrame([(v, "BTC-USD") for v in ("kraken", "coinbase", "okx")], "venue string, symbol string")
    return accounts.gap_counters(joined, expected)


@query(_JUDGED + " SELECT *, messages - stale - duplicates AS considered, round(CASE WHEN messages - stale - duplicates > 0 THEN 1.0::DOUBLE END, 9) AS verified_fraction FROM g")
def gap_counters(spark, sf_dir):
    return _report(spark, sf_dir)


@query(_JUDGED + """, op AS (SELECT venue, symbol, count(*) AS windows FROM (SELECT *, suspect AND NOT coalesce(lag(suspect) OVER (PARTITION BY venue, symbol ORDER BY first_ordinal), false) AS o FROM m) WHERE o GROUP BY ALL)
SELECT CAST(sum(messages_missing) AS BIGINT) AS missing, CAST(sum(sequence_gaps + divergences) AS BIGINT) AS gaps, count(*) FILTER (messages = 0) AS silent, CAST(sum(coalesce(windows, 0)) AS BIGINT) AS windows,
  bool_and(coalesce(windows, 0) + sequence_gaps + divergences + crossed + out_of_order + unverifiable = 0) AS spotless FROM g LEFT JOIN op USING (venue, symbol)""")
def gap_totals(spark, sf_dir):
    return accounts.gap_totals(_report(spark, sf_dir), trust.suspect_windows(book.messages(rows(spark, sf_dir))))


_EDGE = "CASE WHEN b = 0 THEN 0 ELSE CAST(sign(b) * floor(pow(2.0::DOUBLE, (abs(b) - 1) // 8) * (1 + ((abs(b) - 1) % 8)::DOUBLE / 8)) AS BIGINT) END"


@query(_BASE + f""", s AS (SELECT venue, symbol, recv_wall - venue_ts AS x FROM tape WHERE venue_ts IS NOT NULL), g AS (SELECT *, CASE WHEN x <> 0 THEN CAST(floor(log2(abs(x)::DOUBLE)) AS BIGINT) END AS pw FROM s),
h AS (SELECT *, CASE WHEN x = 0 THEN 0 ELSE CAST(sign(x) AS BIGINT) * (pw * 8 + CAST(floor((abs(x)::DOUBLE / pow(2.0::DOUBLE, pw) - 1) * 8) AS BIGINT) + 1) END AS b FROM g),
k AS (SELECT *, row_number() OVER (PARTITION BY venue, symbol ORDER BY b) AS i, count(*) OVER (PARTITION BY venue, symbol) AS n FROM h), e AS (SELECT *, {_EDGE} AS edge FROM k)
SELECT venue, symbol, count(*) AS count, count(*) FILTER (x < 0) AS negative, round(CAST(sum(x) AS DOUBLE) / count(*), 3) AS mean_ns, min(x) AS min_ns, max(x) AS max_ns,
  greatest(min(x), least(max(x), min(edge) FILTER (i >= ceil(0.5 * n)))) AS p50_ns, greatest(min(x), least(max(x), min(edge) FILTER (i >= ceil(0.99 * n)))) AS p99_ns FROM e GROUP BY venue, symbol""")
def latency_report(spark, sf_dir):
    """From the histograms of two halves of the tape, merged."""
    t = tape.recorded(spark, sf_dir).withColumn("skew", F.col("recv_wall") - F.col("venue_ts"))
    halves = [trust.histogram(t.where(F.col("row_ordinal") % 2 == i), "skew", KEYS) for i in (0, 1)]
    return trust.latency_summary(trust.merged(*halves, KEYS), KEYS)


@query(_BASE + f""", tr AS (SELECT NULL AS lv, {AT} AS lf, {AT + HOUR} AS lt UNION ALL SELECT 'kraken', NULL, {AT - 48 * HOUR} UNION ALL SELECT 'coinbase', NULL, {AT + HOUR})
SELECT venue, symbol, count(*) AS rows, count(*) FILTER (suspect) AS suspect_rows, min(recv_wall) FILTER (suspect) AS suspect_from, max(recv_wall) FILTER (suspect) AS suspect_to,
  (SELECT count(*) FROM tr WHERE (lv IS NULL OR lv = venue) AND coalesce(lf, {AT}) <= {AT + DAY} AND lt >= {AT}) AS truncations,
  count(*) FILTER (suspect) = 0 AND (SELECT count(*) FROM tr WHERE (lv IS NULL OR lv = venue) AND coalesce(lf, {AT}) <= {AT + DAY} AND lt >= {AT}) = 0 AS clean FROM tape WHERE recv_wall > {AT} AND recv_wall <= {AT + DAY} GROUP BY venue, symbol""")
def trust_summary(spark, sf_dir):
    lost = spark.createDataFrame([(None, AT, AT + HOUR), ("kraken", None, AT - 48 * HOUR), ("coinbase", None, AT + HOUR)], "lost_venue string, lost_from bigint, lost_to bigint")
    return accounts.trust_summary(tape.recorded(spark, sf_dir, AT, AT + DAY), lost, AT, AT + DAY)


@query(_BASE + f" SELECT m.venue, m.symbol, m.msg_index, bid, ask, coalesce(bid_levels, 0) AS bid_levels, coalesce(ask_levels, 0) AS ask_levels FROM m LEFT JOIN tb USING (venue, symbol, msg_index) WHERE m.recv_wall > {AT} AND m.recv_wall <= {AT + 2 * DAY}")
def range_cursor(spark, sf_dir):
    return book.touch(accounts.cursor(rows(spark, sf_dir), AT, AT + 2 * DAY)).select(*KEYS, "msg_index", "bid", "ask", "bid_levels", "ask_levels")


@query(_REV + f""", pt AS (SELECT unnest(generate_series({START}, {START + 720 * HOUR}, {12 * HOUR})) AS as_of), z AS (SELECT pt.as_of, rev.*, row_number() OVER (PARTITION BY pt.as_of, venue, symbol ORDER BY window_start DESC, batch_id DESC) AS n FROM pt JOIN rev ON availability_max <= as_of)
SELECT venue, symbol, as_of, window_start, batch_id, rows FROM z WHERE n = 1""")
def online_snapshots(spark, sf_dir):
    return accounts.revisions_at(_revisions(spark, sf_dir), F.sequence(F.lit(START), F.lit(START + 720 * HOUR), F.lit(12 * HOUR)), DAY)


def _arm(clock: str, name: str) -> str:
    return f"""{name}w AS (SELECT a.entity, a.as_of, max(arrival) AS arrival FROM a LEFT JOIN o ON o.entity = a.entity AND o.{clock} <= a.as_of GROUP BY ALL),
{name} AS (SELECT w.entity, w.as_of, o.value, CASE WHEN w.arrival IS NULL THEN 'missing' WHEN o.event_time IS NULL THEN 'age_unknown' WHEN w.as_of - o.event_time <= {HOUR} THEN 'fresh' ELSE 'stale' END AS freshness FROM {name}w w LEFT JOIN o ON o.arrival = w.arrival)"""


@query(_OBS + _arm("available_at", "x") + ", " + _arm("event_time", "y") + """ SELECT entity, count(*) AS points, count(*) FILTER (x.value IS NOT DISTINCT FROM y.value) AS same_value, count(*) FILTER (x.freshness = y.freshness) AS same_verdict,
  count(*) FILTER (x.value IS NOT DISTINCT FROM y.value AND x.freshness = y.freshness) AS agree FROM x JOIN y USING (entity, as_of) GROUP BY entity""")
def store_agreement(spark, sf_dir):
    return accounts.agreement(_probed(spark, sf_dir, "available_at"), _probed(spark, sf_dir, "event_time"))


@query(_BASE + " SELECT venue, symbol, row_ordinal, row_number() OVER (ORDER BY recv_wall, venue, row_ordinal) - 1 AS place FROM tape")
def arrival_merge(spark, sf_dir):
    return accounts.merged_by_arrival(tape.recorded(spark, sf_dir), DAY).select(*KEYS, "row_ordinal", "place")


_DRIFT = _BASE + """, pr AS (SELECT row_ordinal % 3 AS part, recv_wall, row_number() OVER (PARTITION BY row_ordinal % 3 ORDER BY recv_wall, row_ordinal) - 1 AS place, count(*) OVER (PARTITION BY row_ordinal % 3) AS n FROM tape WHERE row_ordinal % 3 <> 2 OR row_ordinal % 4 = 0),
st AS (SELECT unnest(generate_series(1, 10)) AS step), dr AS (SELECT CAST(step AS INT) AS step, max(recv_wall) - min(recv_wall) AS spread_ns FROM st JOIN pr ON place = least(n - 1, step * n // 10) GROUP BY ALL)"""


def _drift(spark, sf_dir):
    t = tape.recorded(spark, sf_dir).withColumn("part", F.col("row_ordinal") % 3).where("part <> 2 or row_ordinal % 4 = 0")
    return accounts.partition_drift(t, "part", 10, DAY)


@query(_DRIFT + " SELECT * FROM dr")
def partition_drift(spark, sf_dir):
    return _drift(spark, sf_dir)


@query(_DRIFT + """, iv AS (SELECT max(behind) AS inversion_ns FROM (SELECT max(venue_ts) OVER (PARTITION BY venue, symbol ORDER BY row_ordinal) - venue_ts AS behind FROM tape WHERE venue_ts IS NOT NULL))
SELECT inversion_ns, (SELECT max(spread_ns) FROM dr) AS drift_ns, inversion_ns + (SELECT max(spread_ns) FROM dr) AS floor_ns FROM iv""")
def watermark_floor(spark, sf_dir):
    return accounts.watermark_floor(trust.inversions(tape.recorded(spark, sf_dir)), _drift(spark, sf_dir))


@query(_BASE + """, s AS (SELECT venue, symbol, row_ordinal, row_ordinal AS sent, false AS again FROM tape WHERE NOT (row_ordinal >= 100 AND row_ordinal < 140) UNION ALL SELECT venue, symbol, row_ordinal, row_ordinal + 300, true FROM tape WHERE row_ordinal >= 200 AND row_ordinal < 260)
SELECT venue, symbol, row_ordinal, again, sent // 16 AS slot, md5(row_ordinal || '|' || again) AS turn FROM s WHERE sent < 900""")
def faulty_topic(spark, sf_dir):
    return accounts.faulty(tape.recorded(spark, sf_dir).select(*KEYS, "row_ordinal"), "row_ordinal", (100, 140), (200, 260), 300, 900, 16)


@query(_BASE + """, c AS (SELECT venue, symbol, epoch, msg_index, msg_index // 2 AS seq, row_number() OVER (PARTITION BY venue, symbol, epoch ORDER BY msg_index) - 1 AS l, count(*) OVER (PARTITION BY venue, symbol, epoch) AS n FROM m),
d AS (SELECT venue, symbol, epoch, msg_index, CASE WHEN n >= 4 AND l = n // 2 THEN coalesce(lead(seq) OVER w, seq) WHEN n >= 4 AND l = n // 2 + 1 THEN lag(seq) OVER w ELSE seq END AS seq, l, n FROM c WINDOW w AS (PARTITION BY venue, symbol, epoch ORDER BY msg_index)),
e AS (SELECT *, 0 AS copy FROM d UNION ALL SELECT *, 1 FROM d WHERE n >= 4 AND l = 1), f AS (SELECT *, max(seq) OVER (PARTITION BY venue, symbol ORDER BY msg_index, copy ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS fl FROM e)
SELECT venue, symbol, msg_index, copy, seq, CASE WHEN fl IS NULL THEN 'first' WHEN seq = fl + 1 THEN 'in_order' WHEN seq = fl THEN 'duplicate' WHEN seq < fl THEN 'stale' ELSE 'gap' END AS verdict FROM f""")
def tamper_control(spark, sf_dir):
    m = book.messages(rows(spark, sf_dir)).withColumn("seq", F.expr("msg_index div 2"))
    done = accounts.tampered(m).withColumn("first_ordinal", F.col("first_ordinal") * 2 + F.col("copy"))
    return trust.counter_verdicts(done).select(*KEYS, "msg_index", "copy", "seq", "verdict")


_DEPTHS = (1, 5, 10, 20)
_BOOKS = _BASE + """, kr AS (SELECT *, row_number() OVER (PARTITION BY venue, symbol, msg_index, side ORDER BY CASE WHEN side = 0 THEN -price ELSE price END) AS rk FROM b),
im AS (SELECT venue, symbol, msg_index, """ + ", ".join(f"CAST(sum(CASE WHEN side = 0 THEN qty ELSE -qty END) FILTER (rk <= {n}) AS DOUBLE) / CAST(sum(qty) FILTER (rk <= {n}) AS DOUBLE) AS imb{n}" for n in _DEPTHS) + """ FROM kr GROUP BY ALL),
fb AS (SELECT qt.*, tb.bid_qty, tb.ask_qty, tb.bid_levels, tb.ask_levels, im.* EXCLUDE (venue, symbol, msg_index), recv_wall + ((-recv_wall) % 3600000000000 + 3600000000000) % 3600000000000 AS t,
  (((qt.bid::DOUBLE * ask_qty + qt.ask::DOUBLE * bid_qty) / (bid_qty + ask_qty)) - (qt.bid + qt.ask) / 2) / ((qt.bid + qt.ask) / 2) * 10000 AS md FROM qt JOIN tb USING (venue, symbol, msg_index) JOIN im USING (venue, symbol, msg_index) WHERE mid IS NOT NULL),
dp AS (SELECT venue, symbol, t, """ + ", ".join(f"arg_max({c}, first_ordinal) AS {c}" for c in ("mid", "spread", "bid_levels", "ask_levels")) + ", " + ", ".join(f"round(arg_max(imb{n}, first_ordinal), 9) AS imb{n}" for n in _DEPTHS) + """,
  round(arg_max(md, first_ordinal), 6) AS micro_dev_bps, t - arg_max(recv_wall, first_ordinal) AS age_ns, count(*) AS msgs, count(*) FILTER (suspect) AS suspect_msgs FROM fb GROUP BY venue, symbol, t)"""


@query(_BOOKS + f" SELECT *, suspect_msgs = 0 AND age_ns <= {HOUR // 2} AS usable FROM dp")
def panel_features(spark, sf_dir):
    p = research.depth_panel(book.shown(rows(spark, sf_dir), max(_DEPTHS)), HOUR, _DEPTHS)
    return p.withColumn("usable", research.usable(HOUR // 2))


@query(_PANEL + " SELECT venue, symbol, t, round((ln(lead(mid, 5) OVER w) - ln(lead(mid, 2) OVER w)) * 10000, 6) AS target_bps FROM p WINDOW w AS (PARTITION BY venue, symbol ORDER BY t)")
def lagged_target(spark, sf_dir):
    return research.lagged_target(panel(spark, sf_dir), 2, 3)


@query(_PANEL + """, z AS (SELECT venue, symbol, row_number() OVER w - 1 AS place, sign(mid - lag(mid) OVER w) AS side, (lead(mid, 4) OVER w)::DOUBLE / (lead(mid, 1) OVER w)::DOUBLE - 1 AS mv, (lead(spread::DOUBLE / mid * 10000, 1) OVER w + lead(spread::DOUBLE / mid * 10000, 4) OVER w) / 2 AS sp FROM p WINDOW w AS (PARTITION BY venue, symbol ORDER BY t))
SELECT venue, symbol, count(*) AS opportunities, count(*) FILTER (side <> 0) AS round_trips, round(sum(side * mv * 10000 - abs(side) * (sp + 2 * 1.5::DOUBLE)), 4) AS net_bps FROM z WHERE place % 4 = 0 AND side IS NOT NULL AND mv IS NOT NULL GROUP BY ALL""")
def round_trips(spark, sf_dir):
    return research.round_trips(panel(spark, sf_dir), 1, 3, 1.5)


@query(_PANEL + """, z AS (SELECT venue, symbol, quantile_cont(spread::DOUBLE / mid * 10000, 0.5) AS md, quantile_cont(spread::DOUBLE / mid * 10000, 0.9) AS pd FROM p WHERE suspect_msgs = 0 GROUP BY ALL)
SELECT venue, symbol, round(md, 6) AS median_spread_bps, round(pd, 6) AS p90_spread_bps, round(md / 2, 6) AS half_spread_bps, round(md + 2 * 1.5::DOUBLE, 6) AS round_trip_bps FROM z""")
def trading_costs(spark, sf_dir):
    return research.costs(panel(spark, sf_dir), 1.5)


# A panel with faults: every 50th instant twice, every 97th gone, every 61st of the future, spreads below zero where the book is crossed.
_FAULTY = _PANEL + """, y AS (SELECT venue, symbol, t, CASE WHEN (t // 3600000000000) % 61 = 0 THEN -1 ELSE age_ns END AS age_ns, spread FROM p WHERE (t // 3600000000000) % 97 <> 0), x AS (SELECT * FROM y UNION ALL SELECT * FROM y WHERE (t // 3600000000000) % 50 = 0)"""
_SPANS = [("early", START, START + 300 * HOUR), ("late", START + 320 * HOUR, START + 640 * HOUR), ("never", START - 300 * HOUR, START - 200 * HOUR)]


@query(_FAULTY + f""", o AS (SELECT venue, symbol, t, count(*) AS n, count(*) FILTER (age_ns < 0) AS fu, count(*) FILTER (spread < 0) AS cr FROM x GROUP BY ALL), g AS (SELECT *, lag(t) OVER (PARTITION BY venue, symbol ORDER BY t) AS was FROM o)
SELECT venue, symbol, CAST(sum(n - 1) AS BIGINT) AS repeated, CAST(sum(fu) AS BIGINT) AS future, CAST(sum(cr) AS BIGINT) AS crossed, count(*) FILTER (NOT ({" OR ".join(f"(t >= {a} AND t < {b})" for _, a, b in _SPANS)})) AS outside, count(*) FILTER (t - was <> {HOUR}) AS holes FROM g GROUP BY ALL""")
def panel_violations(spark, sf_dir):
    hour = F.expr(f"t div {HOUR}")
    y = panel(spark, sf_dir).where(hour % 97 != 0).select(*KEYS, "t", F.when(hour % 61 == 0, -1).otherwise(F.col("age_ns")).alias("age_ns"), "spread")
    return accounts.panel_violations(y.unionByName(y.where(hour % 50 == 0)), HOUR, [(a, b) for _, a, b in _SPANS])


@query(_PANEL + f""", pl AS (SELECT * FROM (VALUES ('kraken'), ('coinbase'), ('okx')) v(venue), (VALUES {", ".join(f"('{n}', {a}, {b})" for n, a, b in _SPANS)}) w(win, f, u))
SELECT pl.venue, 'BTC-USD' AS symbol, win AS "window", (u - f) // {HOUR} AS expected, count(p.t) AS observed, (u - f) // {HOUR} - count(p.t) AS missing, CASE WHEN count(p.t) = 0 THEN 'missing_window' ELSE 'observed' END AS status
FROM pl LEFT JOIN p ON p.venue = pl.venue AND p.t >= f AND p.t < u GROUP BY pl.venue, win, f, u""")
def planned_coverage(spark, sf_dir):
    instruments = spark.createDataFrame([(v, "BTC-USD") for v in ("kraken", "coinbase", "okx")], "venue string, symbol string")
    return accounts.planned_coverage(panel(spark, sf_dir), instruments, _SPANS, HOUR)


@query()
def bounded_replay(spark, sf_dir):
    """The checksum of all messages of one venue after the first thousand rows' worth of them."""
    m = book.messages(rows(spark, sf_dir)).where("venue = 'kraken'")
    placed = running.before(m, KEYS, "first_ordinal", place=("sum", F.lit(1))).withColumn("place", F.coalesce("place", F.lit(0)).cast("bigint"))
    return accounts.rolling_checksum(placed, "place", F.col("msg_index") + F.expr("recv_wall div 1000000"), (50, 7), 64)


@query(_BASE + """ SELECT row_ordinal, CASE lower(x) WHEN 'coinbase' THEN 'coinbase' WHEN 'binance-us' THEN 'binance_us' WHEN 'kraken' THEN 'kraken' END AS venue, CASE WHEN row_ordinal % 4 <> 3 AND lower(x) <> 'nowhere' THEN 'BTC-USD' END AS symbol,
  price + qty AS total, price / 1e9 AS lossy, qty AS units FROM (SELECT *, ['CoinBase', 'binance-US', 'KRAKEN', 'nowhere'][CAST(row_ordinal % 4 AS INT) + 1] AS x FROM tape)""")
def spellings(spark, sf_dir):
    t = tape.recorded(spark, sf_dir)
    name = F.element_at(F.array(*[F.lit(x) for x in ("CoinBase", "binance-US", "KRAKEN", "nowhere")]), (F.col("row_ordinal") % 4 + 1).cast("int"))
    path = expr.partition_of_path(F.concat(F.lit("root/venue="), name, F.lit("/symbol=btc-usd/date=2024-01-01/part-1.parquet")))
    return t.select("row_ordinal", expr.venue_of(name).alias("venue"), path["symbol"].alias("symbol"), expr.checked_sum(F.col("price"), F.col("qty")).alias("total"), expr.lossy_double(F.col("price")).alias("lossy"), expr.parse_float(expr.lossy_double(F.col("qty"))).alias("units"))


queries, oracle_sql = _own.queries, _own.oracle_sql
