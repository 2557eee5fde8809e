"""Marts, rollups, mesh joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkloom.functions import percentiles as P
from linkloom.functions import scalars as S
from linkloom.operators import marts, meshes, parity, reshape
from linkloom.plans import stand_ins as T
from linkloom.plans.catalog import query, shapes
from linkloom.plans.catalog.ingest import trials

with_sql = T.with_sql


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# Voice


def voice_clients(spark, sf_dir):
    return reshape.voice_client_summary(T.voice_exports(spark, sf_dir))


def voice_runs(spark, sf_dir):
    return reshape.voice_runs(T.voice_exports(spark, sf_dir))


NEWEST = "SELECT c.* FROM client c JOIN (SELECT n_peers, max(source_file) AS source_file FROM client GROUP BY 1) m USING (n_peers, source_file)"
KPI = f"""SELECT n_peers, round(avg(peers), 1) AS avg_peers, sum(greatest(links, 0))::BIGINT AS conn_links,
  round(quantile_cont(CASE WHEN setup_median_ms >= 0 THEN setup_median_ms END, 0.5)) AS setup_median_ms,
  quantile_cont(CASE WHEN setup_median_ms >= 0 THEN setup_median_ms END, 0.5) AS setup_median_ms_raw,
  round(quantile_cont(CASE WHEN setup_p95_ms >= 0 THEN setup_p95_ms END, 0.5)) AS setup_p95_ms,
  round(avg(ice_success_pct)) AS ice_success_pct, round(avg(relay_pct)) AS relay_pct, round(avg(lat_raw_median_ms)) AS m2e_ms,
  round(avg(mean_up_kbps)) AS uplink_kbps, round(avg(suppressed_pct)) AS suppressed_pct, sum(glare_total)::BIGINT AS glare_total
  FROM ({NEWEST}) GROUP BY 1"""
KPI_COLUMNS = ["n_peers", "avg_peers", "conn_links", "setup_median_ms", "setup_median_ms_raw", "setup_p95_ms", "ice_success_pct",
               "relay_pct", "m2e_ms", "uplink_kbps", "suppressed_pct", "glare_total"]


def kpi(spark, sf_dir, runs=None):
    return marts.kpi_vs_n(voice_clients(spark, sf_dir), voice_runs(spark, sf_dir) if runs is None else runs)


query("kpi_vs_n", with_sql("client", body=KPI))(lambda spark, sf_dir: kpi(spark, sf_dir).select(*KPI_COLUMNS))


@query("newest_run_per_n", with_sql("client", body=f"SELECT n_peers, source_file, client, peers FROM ({NEWEST})"))
def newest_run_per_n(spark, sf_dir):
    return marts.newest_run_per_n(voice_clients(spark, sf_dir), voice_runs(spark, sf_dir)).select("n_peers", "source_file", "client", "peers")


# Global summaries


def _range_sql(name, column):
    return f"""round(quantile_cont({column}, 0.5)) AS {name}_median_ms, quantile_cont({column}, 0.5) AS {name}_median_ms_raw,
      min({column})::INTEGER AS {name}_min_ms, max({column})::INTEGER AS {name}_max_ms"""


CYCLES = with_sql("cycle", body="SELECT count(*) AS complete_cycles, " + ", ".join(_range_sql(p, p + "_ms") for p in ("form", "teardown", "reconnect"))
                  + f" FROM ({shapes.CYCLE}) WHERE complete_case")
query("mobility_cycles", CYCLES)(lambda spark, sf_dir: marts.mobility_cycles(shapes.mobility(spark, sf_dir)))
query("mobility_skipped", with_sql("cycle", body=f"SELECT count(*) AS skipped FROM ({shapes.CYCLE}) WHERE NOT complete_case"))(
    lambda spark, sf_dir: marts.mobility_skipped(shapes.mobility(spark, sf_dir)))
GAPS = with_sql("gap", body="SELECT count(*) AS valid_runs, " + ", ".join(_range_sql(p, p + "_ms") for p in ("stop", "reconnect", "total_silence"))
                + " FROM gap WHERE valid")
query("audiogap", GAPS)(lambda spark, sf_dir: marts.audiogap(shapes.audiogap(spark, sf_dir)))
query("audiogap_skipped", with_sql("gap", body="SELECT count(*) AS skipped FROM gap WHERE NOT valid"))(
    lambda spark, sf_dir: marts.audiogap_skipped(shapes.audiogap(spark, sf_dir)))

# Sensing

SHARES = "SELECT source_file, scenario, k AS pct FROM sense UNION ALL SELECT source_file, scenario, 100 - k FROM sense"
SUPPRESSION = f"""SELECT scenario, count(DISTINCT source_file) AS trials, round(quantile_cont(pct, 0.5)) AS suppression_median_pct,
  quantile_cont(CAST(pct AS DOUBLE), 0.5) AS suppression_median_pct_raw FROM ({SHARES}) WHERE scenario <> '' GROUP BY 1"""


def suppression(spark, sf_dir):
    return marts.sensing_suppression(reshape.normalize_sensing(T.sensing_exports(spark, sf_dir)))


query("sensing_suppression", with_sql("ev", "sense", body=SUPPRESSION))(suppression)


@query("sensing_report_mix", with_sql("ev", "sense", body="""SELECT scenario, kind, count(*) AS runs, sum(n)::BIGINT AS reports,
  round(sum(n) / count(*), 6) AS reports_per_run FROM (SELECT scenario, 'move' AS kind, k % 5 AS n FROM sense
  UNION ALL SELECT scenario, 'link', k % 3 FROM sense) WHERE scenario <> '' GROUP BY ALL"""))
def sensing_report_mix(spark, sf_dir):
    return rounded(marts.sensing_report_mix(T.sensing_exports(spark, sf_dir)), "reports_per_run")


# Real network

REALNET = """SELECT cond AS condition, CASE WHEN cond LIKE 'cellular%' THEN 'cellular' WHEN cond LIKE 'homeNAT%' THEN 'home' ELSE 'other' END AS access,
  CASE WHEN max(CASE WHEN candidate_type = 'relay' THEN 1 ELSE 0 END) = 1 THEN 'relay' ELSE 'direct' END AS path,
  count(CASE WHEN setup_ms >= 0 THEN 1 END) AS links,
  round(quantile_cont(CASE WHEN setup_ms >= 0 THEN setup_ms END, 0.5)) AS setup_median_ms,
  quantile_cont(CASE WHEN setup_ms >= 0 THEN setup_ms END, 0.5) AS setup_median_ms_raw,
  round(quantile_cont(CASE WHEN rtt_ms >= 0 THEN rtt_ms END, 0.5)) AS rtt_median_ms,
  quantile_cont(CASE WHEN rtt_ms >= 0 THEN rtt_ms END, 0.5) AS rtt_median_ms_raw, sum(glare)::BIGINT AS glare_total FROM links GROUP BY cond"""
LINKS = ("ev", "rep", "newest", "links")


def conditions(spark, sf_dir):
    return marts.realnet_conditions(shapes.link_fact(spark, sf_dir))


query("realnet_conditions", with_sql(*LINKS, body=REALNET))(conditions)
query("path_from_links", with_sql(*LINKS, body=f"SELECT condition, path FROM ({REALNET})"))(
    lambda spark, sf_dir: marts.path_from_links(shapes.link_fact(spark, sf_dir)))
ALL_LINKS = """(SELECT cond, setup_ms, rtt_ms, candidate_type FROM links WHERE link_index IS NOT NULL
  UNION ALL SELECT cond, setup_ms, rtt_ms, candidate_type FROM trial_link)"""
query("realnet_link_timing", with_sql(*LINKS, "trial_link", body=f"""SELECT cond AS condition, count(CASE WHEN setup_ms >= 0 THEN 1 END) AS links,
  quantile_cont(CASE WHEN setup_ms >= 0 THEN setup_ms END, 0.5) AS setup_median_ms_raw,
  quantile_cont(CASE WHEN rtt_ms >= 0 THEN rtt_ms END, 0.5) AS rtt_median_ms_raw FROM {ALL_LINKS} GROUP BY cond"""))(
    lambda spark, sf_dir: marts.realnet_link_timing(shapes.link_fact(spark, sf_dir), trials(spark, sf_dir)))
query("candidate_mix", with_sql(*LINKS, "trial_link", body=f"""SELECT cond AS condition, coalesce(nullif(candidate_type, ''), '?') AS candidate_type,
  count(*) AS links FROM {ALL_LINKS} GROUP BY ALL"""))(lambda spark, sf_dir: marts.candidate_mix(shapes.link_fact(spark, sf_dir), trials(spark, sf_dir)))

BLOCKS = """SELECT cond, setup, k AS ice, k % 2 * 100 AS relay, k - 10 AS lat, k % 3 AS glare FROM newest
  UNION ALL SELECT cond, setup, ice, NULL, NULL, glare FROM trial"""


@query("realnet_session_kpis", with_sql("ev", "rep", "newest", "trial", body=f"""SELECT cond AS condition, count(*) AS n,
  quantile_cont(CASE WHEN setup >= 0 THEN setup END, 0.5) AS setup_median_ms_raw, round(avg(CASE WHEN ice >= 0 THEN ice END)) AS ice_success_pct,
  round(avg(CASE WHEN relay >= 0 THEN relay END)) AS relay_pct, round(avg(CASE WHEN lat >= 0 THEN lat END), 6) AS m2e_ms_raw,
  sum(glare)::BIGINT AS kpi_glare_total FROM ({BLOCKS}) GROUP BY 1"""))
def realnet_session_kpis(spark, sf_dir):
    got = marts.realnet_session_kpis(shapes.stream(spark, sf_dir), trials(spark, sf_dir))
    return rounded(got, "m2e_ms_raw").select(
        "condition", "n", "setup_median_ms_raw", "ice_success_pct", "relay_pct", "m2e_ms_raw", "kpi_glare_total")


@query("union_realnet_sources", with_sql("ev", "rep", "newest", "trial", body=f"""SELECT cond AS condition, CAST(setup AS DOUBLE) AS setup_ms,
  CAST(ice AS DOUBLE) AS ice_pct FROM ({BLOCKS})"""))
def union_realnet_sources(spark, sf_dir):
    both = marts.union_realnet_sources(reshape.parsed_reports(shapes.stream(spark, sf_dir)), trials(spark, sf_dir))
    return both.select("condition", F.col("kpis.setupMedianMs").alias("setup_ms"), F.col("kpis.iceSuccessPct").alias("ice_pct"))


ACCESS_PATH = with_sql(*LINKS, body=f"SELECT access, path, round_even(avg(rtt_median_ms), 0) AS mean_ms FROM ({REALNET}) GROUP BY ALL")
query("mean_by_access_path", ACCESS_PATH)(lambda spark, sf_dir: marts.mean_by_access_path(conditions(spark, sf_dir), "rtt_median_ms"))

# Duty cycle, uplink

CELLS = """SELECT absence_ms, grace_ms, count(*) AS n, min(reconnect_gap_ms)::INTEGER AS gap_min_ms, max(reconnect_gap_ms)::INTEGER AS gap_max_ms,
  round(quantile_cont(reconnect_gap_ms, 0.5)) AS gap_median_ms, quantile_cont(reconnect_gap_ms, 0.5) AS gap_median_ms_raw,
  round(quantile_cont(CASE WHEN stop_ms >= 0 THEN stop_ms END, 0.5)) AS stop_median_ms,
  round(quantile_cont(CASE WHEN hold_kbps >= 0 THEN hold_kbps END, 0.5), 6) AS hold_median_kbps_raw FROM grace WHERE reconnect_gap_ms >= 0 GROUP BY ALL"""
CELL_COLUMNS = ["absence_ms", "grace_ms", "n", "gap_min_ms", "gap_max_ms", "gap_median_ms", "gap_median_ms_raw", "stop_median_ms", "hold_median_kbps_raw"]


def grace_cells(spark, sf_dir):
    return marts.gracegap_series(shapes.gracegap(spark, sf_dir))


query("gracegap_series", with_sql("grace", body=CELLS))(
    lambda spark, sf_dir: rounded(grace_cells(spark, sf_dir), "hold_median_kbps_raw").select(*CELL_COLUMNS))


@query("dtx_uplink", with_sql("dtx_run", body="""SELECT source, dtx, count(*) AS n, round(quantile_cont(uplink_kbps, 0.5), 6) AS uplink_median_kbps_raw,
  round(quantile_cont(uplink_kbps, 0.5)) AS uplink_median_kbps FROM dtx_run WHERE uplink_kbps >= 0 GROUP BY ALL"""))
def dtx_uplink(spark, sf_dir):
    return rounded(marts.dtx_uplink(shapes.normalize_dtx(spark, sf_dir)), "uplink_median_kbps_raw")


# Links and samples


def _rank(column, p):
    return f"coalesce(quantile_disc(CASE WHEN up AND {column} >= 0 THEN {column} END, {p}), -1)::BIGINT"


@query("link_kpi_rollup", with_sql("link", body=f"""SELECT session, count(*) FILTER (up) AS links, count(*) FILTER (up OR failed) AS ice_attempts,
  CASE WHEN count(*) FILTER (up OR failed) > 0 THEN floor(count(*) FILTER (up) * 100 / count(*) FILTER (up OR failed) + 0.5) ELSE -1 END::BIGINT AS ice_success_pct,
  {_rank('setup_ms', 0.5)} AS setup_median_ms, {_rank('setup_ms', 0.95)} AS setup_p95_ms,
  CASE WHEN count(*) FILTER (up AND kind <> '') > 0 THEN floor(count(*) FILTER (up AND kind = 'relay') * 100 / count(*) FILTER (up AND kind <> '') + 0.5) ELSE -1 END::BIGINT AS relay_pct,
  count(*) FILTER (up AND kind = 'host') AS mix_host, count(*) FILTER (up AND kind = 'srflx') AS mix_srflx, count(*) FILTER (up AND kind = 'relay') AS mix_relay,
  {_rank('lat_raw_ms', 0.5)} AS lat_raw_median_ms, {_rank('lat_raw_ms', 0.95)} AS lat_raw_p95_ms,
  {_rank('lat_cal_ms', 0.5)} AS lat_cal_median_ms, {_rank('lat_cal_ms', 0.95)} AS lat_cal_p95_ms, sum(glare)::BIGINT AS glare_total FROM link GROUP BY 1"""))
def link_kpi_rollup(spark, sf_dir):
    return marts.link_kpi_rollup(T.link_records(spark, sf_dir), calibrated=True)


PRICES = """SELECT l_returnflag, l_linestatus, count(*) AS n, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50,
  round(quantile_cont(l_extendedprice, 0.95), 4) AS p95 FROM lineitem GROUP BY ALL"""


@query("percentile_interpolated", PRICES)
def percentile_interpolated(spark, sf_dir):
    """Prices have no coarse grid and the groups are few, so ranks come from counted values."""
    got = P.exact_percentiles(T.table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", {"p50": 0.5, "p95": 0.95})
    return rounded(got, "p50", "p95", digits=4)


@query("percentile_nearest_rank", """SELECT l_partkey, coalesce(quantile_disc(CASE WHEN l_quantity >= 25 THEN CAST(l_quantity AS BIGINT) END, 0.5), -1)::BIGINT AS p50,
  coalesce(quantile_disc(CASE WHEN l_quantity >= 25 THEN CAST(l_quantity AS BIGINT) END, 0.95), -1)::BIGINT AS p95 FROM lineitem GROUP BY 1""")
def percentile_nearest_rank(spark, sf_dir):
    value = "case when l_quantity >= 25 then cast(l_quantity as bigint) end"
    return T.table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        P.percentile_nearest_rank(value, 0.5).alias("p50"), P.percentile_nearest_rank(value, 0.95).alias("p95"))


DAILY = f"SELECT *, t_ms // {T.DAY} * {T.DAY} AS day FROM stat"


def daily(spark, sf_dir):
    return T.stat_samples(spark, sf_dir).withColumn("t_ms", F.floor(F.col("t_ms") / T.DAY) * T.DAY)


query("mean_link_rtt", with_sql("ev", "stat", body=f"""SELECT session, day AS t_ms, coalesce(floor(avg(CASE WHEN rtt_ms >= 0 THEN rtt_ms END) + 0.5), -1)::BIGINT AS mean_rtt_ms
  FROM ({DAILY}) GROUP BY ALL"""))(lambda spark, sf_dir: marts.mean_link_rtt(daily(spark, sf_dir)))
query("mesh_snapshot", with_sql("ev", "stat", body=f"""SELECT session, day AS t_ms, count(*) AS in_range, count(*) FILTER (state = 'connected') AS linked,
  count(*) FILTER (state IN ('new', 'connecting')) AS negotiating FROM ({DAILY}) GROUP BY ALL"""))(lambda spark, sf_dir: marts.mesh_snapshot(daily(spark, sf_dir)))
query("rx_totals", with_sql("ev", "stat", body=f"""SELECT session, day AS t_ms, sum(packets_received)::BIGINT AS pkts, sum(jb_count)::BIGINT AS samples,
  round(max(level), 6) AS level FROM ({DAILY}) GROUP BY ALL"""))(lambda spark, sf_dir: rounded(marts.rx_totals(daily(spark, sf_dir)), "level"))
query("relay_hop_rtt", with_sql("ev", "stat", body="""SELECT session AS run, coalesce(floor(avg(CASE WHEN rtt_ms >= 0 THEN rtt_ms END) + 0.5), -1)::BIGINT AS hop_rtt_ms
  FROM stat GROUP BY ALL"""))(lambda spark, sf_dir: marts.relay_hop_rtt(T.stat_samples(spark, sf_dir).withColumnRenamed("session", "run")))


@query("suppressed_pct", """SELECT l_partkey, count(*) AS samples, count(*) FILTER (l_quantity < 40) AS suppressed,
  floor(count(*) FILTER (l_quantity < 40) * 100 / count(*) + 0.5)::BIGINT AS pct FROM lineitem GROUP BY 1""")
def suppressed_pct(spark, sf_dir):
    counted = T.table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("samples"), F.count_if(F.col("l_quantity") < 40).alias("suppressed"))
    return counted.withColumn("pct", S.suppressed_pct("samples", "suppressed"))


HIST = """SELECT round(lo + floor((value - lo) / 10) * 10, 6) AS bin_lo, round(lo + floor((value - lo) / 10) * 10 + 10, 6) AS bin_hi, count(*) AS n
  FROM events, (SELECT min(value) AS lo FROM events) GROUP BY ALL"""


@query("latency_histogram", HIST)
def latency_histogram(spark, sf_dir):
    return rounded(marts.latency_histogram(T.table(spark, sf_dir, "events"), "value", 10.0), "bin_lo", "bin_hi")


@query("burst_statistics", """SELECT event_type AS recording_id, count(*) AS n, round(quantile_cont(value, 0.5), 4) AS p50, round(quantile_cont(value, 0.95), 4) AS p95,
  round(avg(value), 4) AS mean_ms, min(value) AS min_ms, max(value) AS max_ms FROM events WHERE value >= 5 GROUP BY 1""")
def burst_statistics(spark, sf_dir):
    bursts = T.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("recording_id"), F.col("value").alias("latency_ms"), (F.col("value") >= 5).alias("kept"))
    return rounded(marts.burst_statistics(bursts), "p50", "p95", "mean_ms", digits=4)


# Meshes: parts and suppliers as neighbours


def known_peers(spark, sf_dir):
    return T.table(spark, sf_dir, "lineitem").where("l_returnflag <> 'N'").select(F.col("l_partkey").alias("node"), F.col("l_suppkey").alias("peer"))


def peers_now(spark, sf_dir):
    return T.table(spark, sf_dir, "lineitem").where("l_linestatus = 'O'").select(F.col("l_partkey").alias("node"), F.col("l_suppkey").alias("peer"))


SETS = """WITH w AS (SELECT DISTINCT l_partkey AS node, l_suppkey AS peer FROM lineitem WHERE l_returnflag <> 'N'),
  c AS (SELECT DISTINCT l_partkey AS node, l_suppkey AS peer FROM lineitem WHERE l_linestatus = 'O') """


@query("neighbor_delta", SETS + """SELECT node, peer, 'departed' AS change FROM (SELECT * FROM w EXCEPT SELECT * FROM c)
  UNION ALL SELECT node, peer, 'arrived' FROM (SELECT * FROM c EXCEPT SELECT * FROM w)""")
def neighbor_delta(spark, sf_dir):
    return meshes.neighbor_delta(known_peers(spark, sf_dir), peers_now(spark, sf_dir))


@query("topology_change", SETS + """SELECT node, 'topology' AS change, CASE WHEN was <> now_n THEN was || ' → ' || now_n || ' neighbors'
    ELSE 'peer ' || unseen || ' replaced a neighbor' END AS note FROM (
  SELECT node, count(DISTINCT CASE WHEN side = 1 THEN peer END) AS was, count(DISTINCT CASE WHEN side = 2 THEN peer END) AS now_n,
    min(CASE WHEN side = 2 AND NOT known THEN peer END) AS unseen FROM (
    SELECT node, peer, 1 AS side, true AS known FROM w UNION ALL
    SELECT c.node, c.peer, 2, EXISTS (SELECT 1 FROM w WHERE w.node = c.node AND w.peer = c.peer) FROM c) GROUP BY node)
  WHERE was <> now_n OR unseen IS NOT NULL""")
def topology_change(spark, sf_dir):
    return meshes.topology_change(known_peers(spark, sf_dir), peers_now(spark, sf_dir))


INSTANT = f"user_id * 1000 + (t_ms - {T.START}) // {T.DAY}"


@query("proximity_pairs", with_sql("ev", body=f"""SELECT {INSTANT.replace('user_id', 'a.user_id').replace('t_ms', 'a.t_ms')} AS t, a.event_id AS a, b.event_id AS b,
  round(sqrt((a.k - b.k) ** 2 + (floor(a.value) - floor(b.value)) ** 2), 6) AS dist FROM ev a JOIN ev b ON a.user_id = b.user_id AND a.event_id < b.event_id
    AND (a.t_ms - {T.START}) // {T.DAY} = (b.t_ms - {T.START}) // {T.DAY}
  WHERE (a.k - b.k) ** 2 + (floor(a.value) - floor(b.value)) ** 2 <= 225"""))
def proximity_pairs(spark, sf_dir):
    """A mesh instant is a user's day; an event's properties are its tile."""
    tiles = T.events(spark, sf_dir).select(
        F.expr(f"user_id * 1000 + (t_ms - {T.START}) div {T.DAY}").alias("t"),
        F.col("event_id").alias("node"), F.col("k").alias("x"), F.floor("value").cast("int").alias("y"))
    return rounded(meshes.proximity_pairs(tiles, 15), "dist")


@query("join_expected_actual", """SELECT e.l_partkey AS key, e.expected, a.actual FROM
  (SELECT l_partkey, count(*) AS expected FROM lineitem GROUP BY 1) e LEFT JOIN
  (SELECT l_partkey, count(*) AS actual FROM lineitem WHERE l_quantity >= 48 GROUP BY 1) a USING (l_partkey)""")
def join_expected_actual(spark, sf_dir):
    line = T.table(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "key")
    expected = line.groupBy("key").agg(F.count(F.lit(1)).alias("expected"))
    actual = line.where("l_quantity >= 48").groupBy("key").agg(F.count(F.lit(1)).alias("actual"))
    return parity.join_expected_actual(expected, actual, ["key"])
