"""Orders and figure series."""

from __future__ import annotations


from linkloom.operators import marts, reshape, series
from linkloom.plans import stand_ins as T
from linkloom.plans.catalog import query, results, shapes
from linkloom.plans.catalog.ingest import readings
from linkloom.sources.layers import order_mart

with_sql = T.with_sql
KPI, REALNET, LINKS = results.KPI, results.REALNET, results.LINKS


def kpi_query(name, columns, build):
    query(name, with_sql("client", body=f"SELECT {columns} FROM ({KPI})"))(lambda spark, sf_dir: build(results.kpi(spark, sf_dir)))


kpi_query("order_mart", "n_peers, conn_links", lambda m: order_mart(m, "n_peers").select("n_peers", "conn_links"))
kpi_query("series_setup_vs_n", "n_peers, setup_median_ms, setup_p95_ms", series.series_setup_vs_n)
kpi_query("series_glare_density", "n_peers * (n_peers - 1) AS density, glare_total", series.series_glare_density)
kpi_query("series_m2e", "n_peers, m2e_ms, m2e_ms <= 150 AS within_target", series.series_m2e)
query("series_uplink", with_sql("client", body=f"""SELECT n_peers, uplink_kbps AS per_link_kbps, uplink_kbps * (n_peers - 1) AS node_total_kbps
  FROM ({KPI}) WHERE uplink_kbps IS NOT NULL"""))(lambda spark, sf_dir: series.series_uplink(results.kpi(spark, sf_dir)))
query("drop_null_series_points", with_sql("client", body="SELECT source_file, client, mean_up_kbps FROM client WHERE mean_up_kbps IS NOT NULL"))(
    lambda spark, sf_dir: reshape.drop_null_series_points(results.voice_clients(spark, sf_dir), "mean_up_kbps").select("source_file", "client", "mean_up_kbps"))

RANK = "CASE scenario WHEN 'idle' THEN 1 WHEN 'walk' THEN 2 WHEN 'churn' THEN 3 WHEN 'conv' THEN 4 END::BIGINT"
TABLE_RANK = "CASE scenario WHEN 'idle' THEN 1 WHEN 'walk' THEN 2 WHEN 'conv' THEN 3 WHEN 'churn' THEN 4 END::BIGINT"
query("series_suppression", with_sql("ev", "sense", body=f"SELECT {RANK} AS rank, scenario, suppression_median_pct FROM ({results.SUPPRESSION})"))(
    lambda spark, sf_dir: series.series_suppression(results.suppression(spark, sf_dir)))
query("scenario_rank_order", with_sql("ev", "sense", body=f"SELECT {TABLE_RANK} AS rank, scenario, trials FROM ({results.SUPPRESSION})"))(
    lambda spark, sf_dir: series.scenario_rank_order(results.suppression(spark, sf_dir), order=series.TABLE_ORDER).select("rank", "scenario", "trials"))


def bars_sql(cte, source, phases):
    inner = ", ".join(results._range_sql(p, p + "_ms") for p in phases)
    return with_sql(cte, body=" UNION ALL ".join(
        f"""SELECT '{p}' AS phase, {p}_median_ms AS median_ms, {p}_median_ms - {p}_min_ms AS below_ms, {p}_max_ms - {p}_median_ms AS above_ms
        FROM (SELECT {inner} FROM {source})""" for p in phases))


query("series_mobility", bars_sql("cycle", f"({shapes.CYCLE}) WHERE complete_case", ("form", "teardown", "reconnect")))(
    lambda spark, sf_dir: series.series_mobility(marts.mobility_cycles(shapes.mobility(spark, sf_dir))))
query("series_audiogap", bars_sql("gap", "gap WHERE valid", ("stop", "reconnect", "total_silence")))(
    lambda spark, sf_dir: series.series_audiogap(marts.audiogap(shapes.audiogap(spark, sf_dir))))


def grid_sql(metric):
    mean = lambda path: f"coalesce(max(CASE WHEN path = '{path}' THEN m END), 0) AS {path}"
    return with_sql(*LINKS, body=f"""SELECT access, {mean('direct')}, {mean('relay')} FROM (
      SELECT access, path, round_even(avg({metric}), 0) AS m FROM ({REALNET}) GROUP BY ALL) WHERE access <> 'other' GROUP BY access""")


query("series_realnet_rtt", grid_sql("rtt_median_ms"))(lambda spark, sf_dir: series.series_realnet_rtt(results.conditions(spark, sf_dir)))
query("series_realnet_setup", grid_sql("setup_median_ms"))(lambda spark, sf_dir: series.series_realnet_setup(results.conditions(spark, sf_dir)))
query("series_device_energy", """SELECT c_name AS device, c_nationkey * 100.5::DOUBLE AS baseline, c_nationkey * 100.5::DOUBLE + c_custkey % 8 / 4 AS with_voice,
  c_custkey % 8 / 4 AS delta FROM customer""")(
    lambda spark, sf_dir: series.series_device_energy(readings(spark, sf_dir)).select("device", "baseline", "with_voice", "delta"))
query("series_grace_window", with_sql("grace", body=f"SELECT (absence_ms // 1000) || 's absence' AS series, absence_ms, grace_ms, gap_median_ms FROM ({results.CELLS})"))(
    lambda spark, sf_dir: series.series_grace_window(results.grace_cells(spark, sf_dir)))
