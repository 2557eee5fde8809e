"""Ordered history, lifecycles and state machines."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkloom.functions import scalars as S
from linkloom.operators import marts, signals, states
from linkloom.plans import stand_ins as T
from linkloom.plans.catalog import query
from linkloom.plans.catalog.results import rounded
from linkloom.streaming import timers

with_sql, DAY = T.with_sql, T.DAY
LINK = "PARTITION BY session, peer ORDER BY t_ms"
BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"

# Counters

RATE = f"""SELECT session, peer, t_ms, CASE WHEN d >= 0 AND dt > 0 THEN floor(d * 8 / dt + 0.5) ELSE -1 END::BIGINT AS up_kbps FROM (
  SELECT *, bytes_sent - lag(bytes_sent) OVER ({LINK}) AS d, t_ms - lag(t_ms) OVER ({LINK}) AS dt FROM stat)"""


@query("uplink_rate", with_sql("ev", "stat", body=RATE))
def uplink_rate(spark, sf_dir):
    return signals.uplink_rate(T.stat_samples(spark, sf_dir)).select("session", "peer", "t_ms", "up_kbps")


T.SQL["jitter"] = f"""SELECT *, CASE WHEN NOT (jb_delay >= 0 AND jb_count > 0) THEN -1
    WHEN jb_count > base.c AND jb_delay >= base.d THEN (jb_delay - base.d) / (jb_count - base.c) * 1000 ELSE jb_delay / jb_count * 1000 END::DOUBLE AS jb
  FROM (SELECT *, last_value(CASE WHEN jb_delay >= 0 AND jb_count > 0 THEN {{'d': jb_delay, 'c': jb_count}} END IGNORE NULLS) OVER ({LINK} {BEFORE}) AS base FROM stat)"""
T.SQL["latency"] = """SELECT *, CASE WHEN rtt_s >= 0 AND jb >= 0 THEN floor(rtt_s * 1000 / 2 + jb + 40 + 0.5) ELSE -1 END::BIGINT AS lat FROM jitter"""


@query("jitter_buffer_avg", with_sql("ev", "stat", "jitter", body="SELECT session, peer, t_ms, round(jb, 6) AS jb_avg_ms FROM jitter"))
def jitter_buffer_avg(spark, sf_dir):
    return rounded(signals.jitter_buffer_avg(T.stat_samples(spark, sf_dir)), "jb_avg_ms").select("session", "peer", "t_ms", "jb_avg_ms")


def latency(spark, sf_dir):
    return signals.mouth_to_ear(signals.jitter_buffer_avg(T.stat_samples(spark, sf_dir)))


query("mouth_to_ear", with_sql("ev", "stat", "jitter", "latency", body="SELECT session, peer, t_ms, lat AS lat_raw_ms FROM latency"))(
    lambda spark, sf_dir: latency(spark, sf_dir).select("session", "peer", "t_ms", "lat_raw_ms"))
query("calibrate_latency", with_sql("ev", "stat", "jitter", "latency", body="""SELECT session, peer, t_ms,
  CASE WHEN lat >= 0 THEN floor(lat - 12.25 + 0.5) ELSE -1 END::BIGINT AS lat_cal_ms FROM latency"""))(
    lambda spark, sf_dir: signals.calibrate_latency(latency(spark, sf_dir), -12.25).select("session", "peer", "t_ms", "lat_cal_ms"))


@query("residual_energy", with_sql("ev", "stat", body=f"""SELECT session, t_ms, round(coalesce(forced, battery, greatest(0::DOUBLE, 1 - spent / 52428800)), 6) AS energy,
  CASE WHEN forced IS NOT NULL THEN 'forced' WHEN battery IS NOT NULL THEN 'battery' ELSE 'virtual' END AS source FROM (
  SELECT *, sum(CASE WHEN d >= 0 THEN d ELSE 0 END) OVER (PARTITION BY session ORDER BY t_ms ROWS UNBOUNDED PRECEDING) AS spent FROM (
    SELECT *, bytes_sent - lag(bytes_sent) OVER ({LINK}) AS d FROM stat))"""))
def residual_energy(spark, sf_dir):
    return rounded(signals.node_energy(T.stat_samples(spark, sf_dir)), "energy").select("session", "t_ms", "energy", "source")


@query("last_n_reports", with_sql("ev", body="SELECT user_id AS session, t_ms AS t, k FROM ev QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY t_ms DESC) <= 10"))
def last_n_reports(spark, sf_dir):
    reports = T.events(spark, sf_dir).select(F.col("user_id").alias("session"), F.col("t_ms").alias("t"), "k")
    return signals.last_n_reports(reports, 10)


# Phases, stalls, verdicts

PHASES = [("form", 0, 1), ("teardown", 5, 0), ("reconnect", 10, 3)]
RUNS = ("ev", "run_sample", "mark")


@query("phase_timing", with_sql(*RUNS, body=f"""SELECT m.run, p.phase, coalesce(min(s.t) - any_value(m.departed + p.d * {DAY}), -1)::BIGINT AS ms
  FROM mark m CROSS JOIN (VALUES {', '.join(map(str, PHASES))}) p(phase, d, target)
  LEFT JOIN run_sample s ON s.run = m.run AND s.peers = p.target AND s.t >= m.departed + p.d * {DAY} AND s.t < m.departed + (p.d + 2) * {DAY}
  GROUP BY m.run, p.phase"""))
def phase_timing(spark, sf_dir):
    plan = F.array(*[F.struct(F.lit(p).alias("phase"), F.lit(d * DAY).alias("d"), F.lit(n).alias("target")) for p, d, n in PHASES])
    marks = T.run_marks(spark, sf_dir).select("run", "departed", F.inline(plan))
    phases = marks.select("run", "phase", (F.col("departed") + F.col("d")).alias("start"), "target", F.lit(2 * DAY).alias("timeout"))
    return signals.phase_timing(T.run_samples(spark, sf_dir), phases)


STALL = 2 * DAY


@query("packet_stall", with_sql(*RUNS, body=f"""SELECT m.run, coalesce(stop, -1)::BIGINT AS stop_ms FROM mark m LEFT JOIN (
  SELECT run, min_by(last_at, t) + {STALL // 2} - any_value(departed) AS stop FROM (
    SELECT *, greatest(departed, coalesce(max(CASE WHEN pkts > greatest(base, coalesce(top, -1)) THEN t END)
        OVER (PARTITION BY run ORDER BY t ROWS UNBOUNDED PRECEDING), departed)) AS last_at FROM (
      SELECT s.run, s.t, s.pkts, m.departed, max(s.pkts) OVER (PARTITION BY s.run ORDER BY s.t {BEFORE}) AS top,
        coalesce((SELECT max_by(b.pkts, b.t) FROM run_sample b WHERE b.run = m.run AND b.t <= m.departed), -1) AS base
      FROM mark m JOIN run_sample s ON s.run = m.run AND s.t > m.departed))
  WHERE t - last_at > {STALL} GROUP BY run) x USING (run)"""))
def packet_stall(spark, sf_dir):
    return signals.packet_stall(T.run_samples(spark, sf_dir), T.run_marks(spark, sf_dir), STALL)


@query("packet_resume", with_sql(*RUNS, body=f"""SELECT m.run, coalesce(min(CASE WHEN s.pkts - s.before > 2 AND s.t > m.returned AND s.t - m.returned <= {3 * DAY}
  THEN s.t - m.returned END), -1)::BIGINT AS resume_ms FROM mark m LEFT JOIN (
    SELECT *, lag(pkts) OVER (PARTITION BY run ORDER BY t) AS before FROM run_sample) s USING (run) GROUP BY m.run"""))
def packet_resume(spark, sf_dir):
    return signals.packet_resume(T.run_samples(spark, sf_dir), T.run_marks(spark, sf_dir), 2, 3 * DAY)


@query("resume_after_return", with_sql(*RUNS, body=f"""SELECT run, coalesce(ms, -1)::BIGINT AS resume_ms, CASE WHEN ms >= 0 THEN 'PASS' ELSE 'WEDGE' END AS verdict FROM (
  SELECT m.run, min(CASE WHEN s.pkts > 0 AND s.pkts <> s.before AND s.t - s.returned <= {DAY} THEN s.t - s.returned END) AS ms FROM mark m LEFT JOIN (
    SELECT s.run, s.t, s.pkts, m.returned, lag(s.pkts) OVER (PARTITION BY s.run ORDER BY s.t) AS before
    FROM run_sample s JOIN mark m ON m.run = s.run AND s.t > m.returned) s USING (run) GROUP BY m.run)"""))
def resume_after_return(spark, sf_dir):
    return signals.resume_after_return(T.run_samples(spark, sf_dir), T.run_marks(spark, sf_dir), DAY)


@query("silence_validity", """SELECT o_orderkey, CASE WHEN s >= 0 AND r >= 0 THEN s + r ELSE -1 END AS total_ms, s > 0 AND r > 0 AND s < 9000 + 3000 AS valid
  FROM (SELECT o_orderkey, o_custkey % 15000 - 100 AS s, CAST(floor(o_totalprice) AS BIGINT) % 3000 - 50 AS r FROM orders)""")
def silence_validity(spark, sf_dir):
    runs = T.table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_custkey") % 15000 - 100).alias("stop_ms"), (F.floor("o_totalprice") % 3000 - 50).alias("resume_ms"),
        F.lit(9000).alias("absence_ms"))
    return signals.silence_validity(runs).select("o_orderkey", "total_ms", "valid")


@query("classify_wedge", with_sql("ev", "stat", body=f"""SELECT run, CASE WHEN silent THEN 'silent' WHEN pending OR seen = 0 THEN 'never-connected' ELSE 'clean' END AS class FROM (
  SELECT session AS run, count(due) AS seen, coalesce(bool_or(due.s = 'connected' AND due.p <= 0), false) AS silent, coalesce(bool_or(due.s <> 'connected'), false) AS pending FROM (
    SELECT session, peer, arg_max({{'s': state, 'p': packets_received % 4}}, t_ms) FILTER (t_ms - {T.START} <= {4 * DAY}) AS due FROM stat GROUP BY ALL) GROUP BY session)"""))
def classify_wedge(spark, sf_dir):
    samples = T.stat_samples(spark, sf_dir).withColumnRenamed("session", "run").withColumns(
        {"t_ms": F.col("t_ms") - T.START, "packets_received": F.col("packets_received") % 4})
    return signals.classify_wedge(samples, 4 * DAY)


@query("ghost_peers", with_sql("ev", body=f"""SELECT session, peers_seen FROM (SELECT user_id AS session, max(CASE WHEN t_ms - {T.START} <= {DAY} THEN k % 4 END) AS peers_seen
  FROM ev GROUP BY 1) s WHERE peers_seen >= 1 AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = s.session AND c.c_acctbal > 0)"""))
def ghost_peers(spark, sf_dir):
    sessions = T.events(spark, sf_dir).select(F.col("user_id").alias("session"), (F.col("t_ms") - T.START).alias("t"), (F.col("k") % 4).alias("peers"))
    live = T.table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("session"))
    return signals.ghost_peers(sessions, live, DAY)


# Links

LIFE = """told AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY session, peer ORDER BY t_ms) AS rn FROM link_state WHERE state <> 'connecting'),
walk AS (
  SELECT session, peer, 0::BIGINT AS rn, 0 AS n, -1::BIGINT AS det, -1::BIGINT AS con, false AS fail FROM (SELECT DISTINCT session, peer FROM told)
  UNION ALL
  SELECT session, peer, rn, CASE WHEN opens THEN n + 1 ELSE n END, CASE WHEN opens THEN t_ms ELSE det END,
    CASE WHEN opens THEN -1 WHEN n > 0 AND con < 0 AND state = 'connected' THEN t_ms ELSE con END,
    CASE WHEN opens OR (n > 0 AND con < 0 AND state = 'connected') THEN false WHEN n > 0 AND con < 0 AND state IN ('failed', 'closed') THEN true ELSE fail END
  FROM (SELECT w.session, w.peer, t.rn, w.n, w.det, w.con, w.fail, t.t_ms, t.state, t.state = 'detected' AND (w.n = 0 OR w.con >= 0 OR w.fail) AS opens
    FROM walk w JOIN told t ON t.session = w.session AND t.peer = w.peer AND t.rn = w.rn + 1))"""
LIFE_OUT = """SELECT session, peer, n::BIGINT AS incarnation, det AS detected_ms, con AS connected_ms, CASE WHEN con >= 0 THEN con - det ELSE -1 END AS setup_ms, fail AS failed
  FROM walk WHERE n > 0 QUALIFY row_number() OVER (PARTITION BY session, peer, n ORDER BY rn DESC) = 1"""
LIFECYCLE = with_sql("ev", "link_state", recursive=LIFE, body=LIFE_OUT)


@query("link_lifecycle", LIFECYCLE)
def link_lifecycle(spark, sf_dir):
    return states.link_lifecycle(T.link_states(spark, sf_dir))


T.SQL["measured"] = f"""SELECT session, peer, t_ms, rtt_ms, CASE packets_received % 4 WHEN 1 THEN 'host' WHEN 2 THEN 'srflx' WHEN 3 THEN 'relay' ELSE '' END AS kind, lat FROM latency"""
RECORDS = f"""SELECT r.session, r.peer, r.incarnation, r.setup_ms, r.failed, coalesce(arg_max(m.kind, m.t_ms) FILTER (m.kind <> ''), '') AS candidate_type,
  coalesce(arg_max(m.rtt_ms, m.t_ms) FILTER (m.rtt_ms >= 0), -1)::BIGINT AS rtt_ms, coalesce(arg_max(m.lat, m.t_ms) FILTER (m.lat >= 0), -1)::BIGINT AS lat_raw_ms
  FROM (SELECT *, lead(detected_ms) OVER (PARTITION BY session, peer ORDER BY incarnation) AS until FROM ({LIFE_OUT})) r
  LEFT JOIN measured m ON m.session = r.session AND m.peer = r.peer AND m.t_ms >= r.detected_ms AND (r.until IS NULL OR m.t_ms < r.until) GROUP BY ALL"""


@query("link_lifecycle_measured", with_sql("ev", "link_state", "stat", "jitter", "latency", "measured", recursive=LIFE, body=RECORDS))
def link_lifecycle_measured(spark, sf_dir):
    """From state changes and counters to complete link records, on one time line."""
    kinds = F.array(*map(F.lit, ("", "host", "srflx", "relay")))
    samples = latency(spark, sf_dir).withColumn("candidate_type", F.element_at(kinds, (F.col("packets_received") % 4 + 1).cast("int")))
    records = states.link_lifecycle(T.link_states(spark, sf_dir), samples=samples)
    return records.select("session", "peer", "incarnation", "setup_ms", "failed", "candidate_type", "rtt_ms", "lat_raw_ms")


def offers(spark, sf_dir):
    return T.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("session"), F.col("l_linenumber").alias("peer"), F.col("l_partkey").alias("my_nonce"),
        F.col("l_orderkey").alias("remote_nonce"), (F.col("l_linestatus") == "O").alias("making_offer"),
        F.when(F.col("l_returnflag") == "N", "stable").otherwise("have-local-offer").alias("state"))


@query("glare_count", """SELECT l_suppkey AS session, l_linenumber AS peer,
  count(*) FILTER (l_partkey >= l_orderkey AND (l_linestatus = 'O' OR l_returnflag <> 'N')) AS glare FROM lineitem GROUP BY ALL""")
def glare_count(spark, sf_dir):
    return states.glare_count(offers(spark, sf_dir))


def watch_ticks(spark, sf_dir):
    """Events drawn together in time, as the first seconds of one peer."""
    k = F.col("k")
    return T.events(spark, sf_dir).select(
        F.col("user_id").alias("session"), (k % 3).alias("peer"), F.lit(T.START).alias("born_ms"),
        (F.lit(T.START) + F.floor((F.col("t_ms") - T.START) / 200000)).alias("t_ms"),
        (F.col("event_type") == "purchase").alias("ever_connected"),
        F.when(k % 2 == 0, "stable").otherwise("have-local-offer").alias("signaling"), F.lit("new").alias("ice"),
        k.alias("my_nonce"), (F.col("user_id") % 120 - 10).alias("remote_nonce"))


WATCHED = f"""SELECT session, peer, {T.START}::BIGINT AS born_ms, t_ms, action FROM (
  SELECT *, 'restart' AS action, a AS t_ms FROM acts WHERE a IS NOT NULL AND (b IS NULL OR a <= b) UNION ALL SELECT *, 'recreate', b FROM acts WHERE b IS NOT NULL)"""
T.SQL["acts"] = f"""SELECT user_id AS session, k % 3 AS peer, min(CASE WHEN t - {T.START} > 3000 AND k % 2 = 0 AND user_id % 120 - 10 >= 0
    AND k > user_id % 120 - 10 THEN t END) AS a, min(CASE WHEN t - {T.START} > 8000 THEN t END) AS b
  FROM (SELECT *, {T.START} + (t_ms - {T.START}) // 200000 AS t FROM ev WHERE event_type <> 'purchase') GROUP BY ALL"""


@query("never_connected_timeout", with_sql("ev", "acts", body=WATCHED))
def never_connected_timeout(spark, sf_dir):
    return states.never_connected_timeout(watch_ticks(spark, sf_dir))


def late_ticks(spark, sf_dir):
    """Peers born one after another, so that some stop before their deadlines and some deadlines lie behind the last tick."""
    ticks = watch_ticks(spark, sf_dir)
    born = F.lit(T.START) + F.col("session") % 9 * 1500
    return ticks.withColumn("born_ms", born).where((F.col("t_ms") >= born) & (F.col("t_ms") - born < F.col("session") % 5 * 3000 + 500))


DEADLINES = f"""WITH ev AS MATERIALIZED ({T.SQL['ev']}),
  tick AS (SELECT user_id AS session, k % 3 AS peer, {T.START} + user_id % 9 * 1500 AS born_ms, {T.START} + (t_ms - {T.START}) // 200000 AS t,
    event_type = 'purchase' AS joined, k % 2 = 0 AND user_id % 120 - 10 >= 0 AND k > user_id % 120 - 10 AS able FROM ev),
  own AS (SELECT * FROM tick WHERE t >= born_ms AND t - born_ms < session % 5 * 3000 + 500),
  told AS (SELECT session, peer, born_ms, min(CASE WHEN joined THEN t END) AS joined, max(CASE WHEN t <= born_ms + 3001 THEN t * 2 + able::INT END) % 2 = 1 AS able,
    min(CASE WHEN able AND t > born_ms + 3001 THEN t END) AS later FROM own WHERE t <= born_ms + 8001 GROUP BY ALL),
  acts AS (SELECT session, peer, born_ms, joined, CASE WHEN able THEN born_ms + 3001 ELSE later END AS at_ms, 'restart' AS action FROM told
    UNION ALL SELECT session, peer, born_ms, joined, born_ms + 8001, 'recreate' FROM told)
  SELECT session, peer, born_ms::BIGINT AS born_ms, at_ms::BIGINT AS at_ms, action FROM acts
  WHERE at_ms <= born_ms + 8001 AND (joined IS NULL OR joined > at_ms) AND at_ms < (SELECT max(t) FROM own)"""


@query("never_connected_deadlines", DEADLINES)
def never_connected_deadlines(spark, sf_dir):
    return timers.never_connected_deadlines(late_ticks(spark, sf_dir))


# Voice activity

VAD = """walk AS (
  SELECT stream, -50::BIGINT AS t_ms, false AS active, 0 AS hi, 0 AS lo, NULL::VARCHAR AS edge FROM (SELECT DISTINCT stream FROM level)
  UNION ALL
  SELECT stream, t_ms, CASE WHEN hi >= 3 THEN true WHEN lo >= 2 THEN false ELSE active END, CASE WHEN lo >= 2 THEN 0 ELSE hi END, CASE WHEN hi >= 3 THEN 0 ELSE lo END,
    CASE WHEN NOT active AND hi >= 3 THEN 'open' WHEN active AND lo >= 2 THEN 'close' END
  FROM (SELECT w.stream, l.t_ms, w.active, CASE WHEN w.active THEN 0 WHEN l.rms >= 0.06 THEN w.hi + 1 ELSE 0 END AS hi,
    CASE WHEN NOT w.active THEN 0 WHEN l.rms < 0.035 THEN w.lo + 1 ELSE 0 END AS lo FROM walk w JOIN level l ON l.stream = w.stream AND l.t_ms = w.t_ms + 50))"""
EDGES = with_sql("frame", "level", recursive=VAD, body="SELECT stream, t_ms, edge FROM walk WHERE edge IS NOT NULL")


@query("vad_edges", EDGES)
def vad_edges(spark, sf_dir):
    return states.vad_edges(T.levels(spark, sf_dir), hang_ms=100)


# Grace windows

HELD = 2 * DAY
GRACE = f"""WITH ev AS MATERIALIZED ({T.SQL['ev']}), tick AS MATERIALIZED ({T.SQL['tick']}),
  around AS (SELECT *, lag(t_ms) OVER (PARTITION BY node ORDER BY t_ms) AS before, lead(t_ms) OVER (PARTITION BY node ORDER BY t_ms) AS after FROM tick),
  seen AS (SELECT node, unnest(in_range) AS peer, t_ms, before, after FROM around),
  marked AS (SELECT *, CASE WHEN lag(t_ms) OVER p IS NULL OR (before > lag(t_ms) OVER p AND before >= lag(after) OVER p + {HELD}) THEN 1 ELSE 0 END AS fresh
    FROM seen WINDOW p AS (PARTITION BY node, peer ORDER BY t_ms)),
  linked AS (SELECT *, sum(fresh) OVER (PARTITION BY node, peer ORDER BY t_ms ROWS UNBOUNDED PRECEDING) AS link FROM marked),
  spans AS (SELECT node, peer, link::BIGINT AS link, min(t_ms) AS start_ms, arg_max_null(after, t_ms) + {HELD} AS due FROM linked GROUP BY ALL)
SELECT s.node, s.peer, s.link, s.start_ms, min(t.t_ms) AS end_ms, min(t.t_ms) - s.start_ms AS held_ms
FROM spans s LEFT JOIN tick t ON t.node = s.node AND t.t_ms >= s.due GROUP BY s.node, s.peer, s.link, s.start_ms"""


@query("grace_window", GRACE)
def grace_window(spark, sf_dir):
    return states.grace_window(T.ranges(spark, sf_dir), HELD)


# Suppression

QUIET = DAY // 2
WALK = f"""walk AS (
  SELECT session, 0::BIGINT AS rn, 0::BIGINT AS t_ms, NULL::VARCHAR AS kind, NULL::VARCHAR AS note, 0::BIGINT AS told, false AS known,
    0 AS px, 0 AS py, 0 AS pi, '' AS ps, 0::DOUBLE AS pr, 0::DOUBLE AS pl FROM (SELECT DISTINCT session FROM node)
  UNION ALL
  SELECT session, rn, t_ms, said.k, said.n, CASE WHEN said.k IS NULL THEN told ELSE t_ms END,
    CASE WHEN said.k IS NULL THEN known ELSE said.k <> 'node-sleep' END,
    CASE WHEN said.k IS NULL THEN px ELSE x END, CASE WHEN said.k IS NULL THEN py ELSE y END, CASE WHEN said.k IS NULL THEN pi ELSE i END,
    CASE WHEN said.k IS NULL THEN ps ELSE s END, CASE WHEN said.k IS NULL THEN pr ELSE rtt END, CASE WHEN said.k IS NULL THEN pl ELSE loss END
  FROM (SELECT w.told, w.known, w.px, w.py, w.pi, w.ps, w.pr, w.pl, n.*,
    CASE WHEN n.forced IS NOT NULL THEN {{'k': n.forced, 'n': ''}}
      WHEN NOT w.known THEN {{'k': 'move', 'n': 'first position fix'}}
      WHEN (n.x - w.px) ** 2 + (n.y - w.py) ** 2 >= 36 THEN {{'k': 'move', 'n': 'moved ' || CAST(floor(sqrt((n.x - w.px) ** 2 + (n.y - w.py) ** 2) + 0.5) AS BIGINT) || ' tiles'}}
      WHEN n.i <> w.pi THEN {{'k': 'topology', 'n': 'peer ' || n.i || ' replaced a neighbor'}}
      WHEN n.s <> w.ps THEN {{'k': 'link', 'n': 'peer ' || n.i || ' ' || w.ps || ' → ' || n.s}}
      WHEN abs(n.rtt - w.pr) >= 20 AND abs(n.rtt - w.pr) >= w.pr * 0.5 THEN {{'k': 'link', 'n': 'peer ' || n.i || ' RTT ' || w.pr::BIGINT || ' → ' || n.rtt::BIGINT || ' ms'}}
      WHEN n.loss - w.pl >= 2 THEN {{'k': 'link', 'n': 'peer ' || n.i || ' loss ' || w.pl::BIGINT || ' → ' || n.loss::BIGINT || '%'}}
      WHEN n.t_ms - w.told >= {QUIET} THEN {{'k': 'heartbeat', 'n': ''}} ELSE {{'k': NULL::VARCHAR, 'n': ''}} END AS said
    FROM walk w JOIN node n ON n.session = w.session AND n.rn = w.rn + 1))"""


def walked(body: str) -> str:
    return with_sql("ev", "node", recursive=WALK, body=body)


DECIDED = walked("SELECT session, t_ms, kind, note, kind IS NULL AS suppressed FROM walk WHERE rn > 0")


def decisions(spark, sf_dir):
    return states.event_suppression(T.node_samples(spark, sf_dir), heartbeat_ms=QUIET)


query("event_suppression", DECIDED)(decisions)
query("heartbeat_due", walked("SELECT session, t_ms, kind FROM walk WHERE kind = 'heartbeat'"))(
    lambda spark, sf_dir: states.heartbeat_due(decisions(spark, sf_dir)).select("session", "t_ms", "kind"))
query("session_reset", walked("SELECT session, t_ms, kind FROM walk WHERE kind = 'node-sleep'"))(
    lambda spark, sf_dir: states.session_reset(decisions(spark, sf_dir)).select("session", "t_ms", "kind"))
query("suppression_by_node", walked("""SELECT session, samples, suppressed, floor(suppressed * 100 / samples + 0.5)::BIGINT AS suppressed_pct FROM (
  SELECT session, count(*) FILTER (coalesce(kind, '') <> 'node-sleep') AS samples, count(*) FILTER (kind IS NULL) AS suppressed FROM walk WHERE rn > 0 GROUP BY 1)"""))(
    lambda spark, sf_dir: marts.suppression_by_node(decisions(spark, sf_dir)))


@query("ignores_offer", """SELECT l_returnflag, l_linestatus, count(*) FILTER (l_partkey >= l_orderkey AND (l_linestatus = 'O' OR l_returnflag <> 'N')) AS ignored FROM lineitem GROUP BY ALL""")
def ignores_offer(spark, sf_dir):
    flags = T.table(spark, sf_dir, "lineitem").withColumns({
        "making": F.col("l_linestatus") == "O", "state": F.when(F.col("l_returnflag") == "N", "stable").otherwise("have-local-offer")})
    return flags.groupBy("l_returnflag", "l_linestatus").agg(
        F.count_if(S.ignores_offer("l_partkey", "l_orderkey", "making", "state")).alias("ignored"))
