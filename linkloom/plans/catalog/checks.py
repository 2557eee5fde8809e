"""Quality suites and the parity gate."""

from __future__ import annotations

from functools import cache, partial

from pyspark.sql import functions as F

from linkloom.operators import marts, parity, quality
from linkloom.plans import stand_ins as T
from linkloom.plans.catalog import query, results, shapes
from linkloom.plans.catalog.ingest import scratch
from linkloom.plans.catalog.results import rounded

with_sql = T.with_sql


def check_sql(name: str, bad: str, source: str) -> str:
    return f"SELECT '{name}' AS \"check\", count(*) FILTER ({bad}) = 0 AS ok, count(*) FILTER ({bad}) AS bad_rows FROM {source}"


def suite_of(name: str, check, bad: str):
    @query(name, check_sql(check.name, bad, "lineitem"))
    def build(spark, sf_dir):
        columns = T.table(spark, sf_dir, "lineitem").withColumn("tag", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")))
        return quality.run_suite(columns, [check])


suite_of("expect_not_null", quality.expect_not_null("tag"), "l_returnflag = 'N'")
suite_of("expect_in_set", quality.expect_in_set("tag", ["A"]), "l_returnflag NOT IN ('A', 'N')")
suite_of("expect_between", quality.expect_between("l_quantity", 2, 49), "l_quantity < 2 OR l_quantity > 49")


@query("expect_unique", """SELECT 'l_orderkey unique' AS "check", coalesce(sum(n) FILTER (n > 1), 0) = 0 AS ok, coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS bad_rows
  FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)""")
def expect_unique(spark, sf_dir):
    return quality.run_suite(T.table(spark, sf_dir, "lineitem"), [quality.expect_unique("l_orderkey")])


FACT_SUITE = [("source_file not null", "false"), ("record_type in set", "false"), ("candidate_type in set", "candidate_type NOT IN ('host', 'srflx', 'relay')"),
              ("n_peers between", "peers < 0"), ("glare between", "glare < 0")]
SUITE = " UNION ALL ".join(check_sql(n, bad, "links") for n, bad in FACT_SUITE)


@query("run_suite", with_sql(*results.LINKS, body=SUITE))
def run_suite(spark, sf_dir):
    return quality.run_suite(shapes.link_fact(spark, sf_dir), quality.LINK_FACT_CHECKS)


COND_SUITE = [("path in set", "path NOT IN ('direct', 'relay')"), ("access in set", "access NOT IN ('cellular', 'home', 'other')"),
              ("rtt_median_ms between", "rtt_median_ms < 0 OR rtt_median_ms > 5000")]
SENSE_SUITE = [("scenario not null", "scenario IS NULL"), ("scenario in set", "scenario NOT IN ('idle', 'walk', 'conv', 'churn')"),
               ("suppression_median_pct between", "suppression_median_pct < 0 OR suppression_median_pct > 100")]


def suite_sql(table, suite, source):
    return " UNION ALL ".join(f"SELECT '{table}' AS \"table\", * FROM ({check_sql(n, bad, source)})" for n, bad in suite)


CHECKPOINT = " UNION ALL ".join([suite_sql("link_fact", FACT_SUITE, "links"), suite_sql("realnet_conditions", COND_SUITE, f"({results.REALNET})"),
                                 suite_sql("sensing_suppression", SENSE_SUITE, f"({results.SUPPRESSION})")])


def checkpoint(spark, sf_dir):
    fact = shapes.link_fact(spark, sf_dir)
    return quality.run_checkpoint({
        "link_fact": (fact, quality.LINK_FACT_CHECKS),
        "realnet_conditions": (marts.realnet_conditions(fact), quality.MART_CHECKS["realnet_conditions"]),
        "sensing_suppression": (results.suppression(spark, sf_dir), quality.MART_CHECKS["sensing_suppression"]),
    })


query("run_checkpoint", with_sql(*results.LINKS, "sense", body=CHECKPOINT))(checkpoint)


@query("assert_rows_empty", "SELECT count(*) AS n, count(*) = 0 AS ok FROM lineitem WHERE l_discount < 0 OR l_discount > 0.09")
def assert_rows_empty(spark, sf_dir):
    return quality.assert_rows_empty(T.table(spark, sf_dir, "lineitem").where("l_discount < 0 OR l_discount > 0.09"))


# Parity

REF_DTX = """SELECT source || '/' || dtx AS key, quantile_cont(uplink_kbps, 0.5) AS expected FROM dtx_run WHERE uplink_kbps >= 0 GROUP BY source, dtx"""
REF_SENSE = f"""SELECT scenario AS key, quantile_cont(CAST(pct AS DOUBLE), 0.5) AS expected FROM ({results.SHARES}) WHERE scenario <> '' GROUP BY 1"""
query("reference_dtx", with_sql("dtx_run", body=f"SELECT key, round(expected, 6) AS expected FROM ({REF_DTX})"))(
    lambda spark, sf_dir: rounded(parity.reference_dtx(T.dtx_exports(spark, sf_dir)), "expected"))
query("reference_sensing", with_sql("ev", "sense", body=REF_SENSE))(lambda spark, sf_dir: parity.reference_sensing(T.sensing_exports(spark, sf_dir)))


@query("compare_within_tolerance", """SELECT ok, count(*) AS n FROM (SELECT CASE WHEN a IS NULL AND b IS NULL THEN true ELSE coalesce(abs(a - b) <= 1, false) END AS ok FROM (
  SELECT CASE WHEN l_returnflag <> 'N' THEN l_quantity END AS a, CASE WHEN l_linestatus = 'O' THEN l_linenumber * 5 END AS b FROM lineitem)) GROUP BY 1""")
def compare_within_tolerance(spark, sf_dir):
    pairs = T.table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity")).alias("a"), F.when(F.col("l_linestatus") == "O", F.col("l_linenumber") * 5).alias("b"))
    return pairs.groupBy(parity.compare_within_tolerance("a", "b").alias("ok")).agg(F.count(F.lit(1)).alias("n"))


BAND_SQL = f"""SELECT mart || '[' || key || '].' || metric AS "check", '[' || low || ',' || high || ']' AS expected, actual, coalesce(actual >= low::DOUBLE AND actual <= high::DOUBLE, false) AS ok FROM (
  SELECT 'kpi_vs_n' AS mart, CAST(n_peers AS VARCHAR) AS key, 'm2e_ms' AS metric, '60.0' AS low, '80.0' AS high, m2e_ms AS actual FROM ({results.KPI})
  UNION ALL SELECT 'kpi_vs_n', CAST(n_peers AS VARCHAR), 'ice_success_pct', '100.0', '100.0', ice_success_pct FROM ({results.KPI}) WHERE n_peers IN (2, 3, 4)
  UNION ALL SELECT 'mobility_cycles', 'all', 'reconnect_median_ms', '2000.0', '2700.0', (SELECT round(quantile_cont(reconnect_ms, 0.5)) FROM ({shapes.CYCLE}) WHERE complete_case)
  UNION ALL SELECT 'audiogap', 'all', 'reconnect_median_ms', '2300.0', '3200.0', (SELECT round(quantile_cont(reconnect_ms, 0.5)) FROM gap WHERE valid))"""


MARTS = {
    "kpi_vs_n": results.kpi,
    "mobility_cycles": lambda spark, sf_dir: marts.mobility_cycles(shapes.mobility(spark, sf_dir)),
    "audiogap": lambda spark, sf_dir: marts.audiogap(shapes.audiogap(spark, sf_dir)),
    "sensing_suppression": results.suppression,
    "realnet_conditions": results.conditions,
    "gracegap_series": results.grace_cells,
    "dtx_uplink": lambda spark, sf_dir: marts.dtx_uplink(shapes.normalize_dtx(spark, sf_dir)),
}


def all_marts(spark, sf_dir, runs):
    """What makes each mart; ``runs`` makes the files and sizes that the mart of cluster sizes picks from."""
    made = {name: partial(build, spark, sf_dir) for name, build in MARTS.items()}
    return made | {"kpi_vs_n": lambda: results.kpi(spark, sf_dir, runs())}


@query("check_bands", with_sql("client", "cycle", "gap", body=BAND_SQL))
def check_bands(spark, sf_dir):
    """Only marts that have a band are built; some count their values as they are."""
    banded = {name: MARTS[name](spark, sf_dir) for name in ("kpi_vs_n", "mobility_cycles", "audiogap")}
    return parity.check_bands(parity.mart_metrics(banded), parity.band_table(spark))


def actual_sql(mart, key, value, source):
    return f"SELECT '{mart}[' || {key} || ']' AS \"check\", round({value}, 6) AS actual, true AS ok FROM {source}"


REPORT = " UNION ALL ".join([
    actual_sql("dtx_uplink", "key", "expected", f"({REF_DTX})"),
    actual_sql("sensing_suppression", "key", "expected", f"({REF_SENSE})"),
    actual_sql("gracegap_series", "absence_ms || '/' || grace_ms", "gap_median_ms_raw", f"({results.CELLS})"),
    actual_sql("mobility_cycles", "'all'", "(SELECT quantile_cont(reconnect_ms, 0.5))", f"({shapes.CYCLE}) WHERE complete_case"),
    actual_sql("audiogap", "'all'", "(SELECT quantile_cont(reconnect_ms, 0.5))", "gap WHERE valid"),
    actual_sql("kpi_vs_n", "n_peers", "setup_median_ms_raw", f"({results.KPI})"),
    actual_sql("realnet_conditions", "condition", "setup_median_ms_raw", f"({results.REALNET})"),
]).replace("(SELECT quantile_cont(reconnect_ms, 0.5))", "quantile_cont(reconnect_ms, 0.5)")


@query("parity_report", with_sql("dtx_run", "ev", "sense", "grace", "cycle", "gap", "client", "rep", "newest", "links", body=REPORT))
def parity_report(spark, sf_dir):
    """All seven marts against their second reduction: every row must agree."""
    raw = {"raw_json": shapes.all_exports(spark, sf_dir), "raw_stream": shapes.stream(spark, sf_dir)}
    runs = cache(lambda: parity.newest_by_both_sizes(parity.sized(raw["raw_json"])))
    compared = parity.compare_all(raw, all_marts(spark, sf_dir, runs), runs=runs)
    return rounded(parity.parity_report(*compared), "actual").select("check", "actual", "ok")


ALL_COLUMNS = {
    "audiogap": "reconnect_max_ms reconnect_median_ms reconnect_median_ms_raw reconnect_min_ms stop_max_ms stop_median_ms stop_median_ms_raw stop_min_ms "
    "total_silence_max_ms total_silence_median_ms total_silence_median_ms_raw total_silence_min_ms valid_runs",
    "dtx_uplink": "n uplink_median_kbps uplink_median_kbps_raw",
    "gracegap_series": "gap_max_ms gap_median_ms gap_median_ms_raw gap_min_ms hold_median_kbps hold_median_kbps_raw n stop_median_ms stop_median_ms_raw",
    "kpi_vs_n": "avg_peers conn_links glare_total ice_success_pct ice_success_pct_raw m2e_ms m2e_ms_raw relay_pct relay_pct_raw setup_median_ms setup_median_ms_raw "
    "setup_p95_ms setup_p95_ms_raw suppressed_pct suppressed_pct_raw uplink_kbps uplink_kbps_raw",
    "mobility_cycles": "complete_cycles form_max_ms form_median_ms form_median_ms_raw form_min_ms reconnect_max_ms reconnect_median_ms reconnect_median_ms_raw reconnect_min_ms "
    "teardown_max_ms teardown_median_ms teardown_median_ms_raw teardown_min_ms",
    "realnet_conditions": "access glare_total links path rtt_median_ms rtt_median_ms_raw setup_median_ms setup_median_ms_raw",
    "sensing_suppression": "suppression_median_pct suppression_median_pct_raw trials",
}
COLUMN_ROWS = ", ".join(f"('{mart}.{c}')" for mart, columns in ALL_COLUMNS.items() for c in columns.split())


@query("parity_columns", f"SELECT c AS \"check\", 0::BIGINT AS differing, true AS ok FROM (VALUES {COLUMN_ROWS}) v(c)")
def parity_columns(spark, sf_dir):
    """All columns of all seven marts: none may differ from the second reduction."""
    raw = {"raw_json": shapes.all_exports(spark, sf_dir), "raw_stream": shapes.stream(spark, sf_dir)}
    runs = cache(lambda: parity.newest_by_both_sizes(parity.sized_with_clients(raw["raw_json"])))
    return parity.compare_all_columns(raw, all_marts(spark, sf_dir, runs), runs=runs).select("check", "differing", "ok")


@query("checkpoint_while_writing", with_sql(*results.LINKS, "sense", body=CHECKPOINT))
def checkpoint_while_writing(spark, sf_dir):
    """The same suites, counted while the tables are written; the link fact is built once."""
    folder = scratch(spark)

    def written(df, name, checks):
        path = f"{folder}/{name}"
        return quality.write_checked(df, name, checks, lambda o: o.write.parquet(path), lambda: spark.read.parquet(path))

    fact = written(shapes.link_fact(spark, sf_dir), "link_fact", quality.LINK_FACT_CHECKS)
    kept = spark.read.parquet(f"{folder}/link_fact")
    conditions = written(marts.realnet_conditions(kept), "realnet_conditions", quality.MART_CHECKS["realnet_conditions"])
    sensing = written(results.suppression(spark, sf_dir), "sensing_suppression", quality.MART_CHECKS["sensing_suppression"])
    return fact.unionByName(conditions).unionByName(sensing)


@query("checkpoint_summary", with_sql(*results.LINKS, "sense", body=f"SELECT \"table\", bool_and(ok) AS ok FROM ({CHECKPOINT}) GROUP BY ROLLUP (\"table\")"))
def checkpoint_summary(spark, sf_dir):
    return quality.checkpoint_summary(checkpoint(spark, sf_dir))


