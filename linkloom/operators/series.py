"""Figure series: the data each figure shows, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions.scalars import ms_to_seconds_label
from linkloom.operators.marts import mean_by_access_path
from linkloom.operators.reshape import drop_null_series_points

# Fixed orders and targets of the figures.
SCENARIO_ORDER = ["idle", "walk", "churn", "conv"]
TABLE_ORDER = ["idle", "walk", "conv", "churn"]
TARGET_MS = 150
ACCESS = ["home", "cellular"]
PATHS = ["direct", "relay"]


def scenario_rank_order(df: DataFrame, column: str = "scenario", order: list[str] = SCENARIO_ORDER) -> DataFrame:
    """Keep the listed values, ranked by their place in the list."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col(column))
    return df.withColumn("rank", place).where(F.col("rank") > 0).orderBy("rank")


def series_setup_vs_n(kpi: DataFrame) -> DataFrame:
    return kpi.select("n_peers", "setup_median_ms", "setup_p95_ms").orderBy("n_peers")


def series_glare_density(kpi: DataFrame) -> DataFrame:
    n = F.col("n_peers")
    return kpi.select((n * (n - 1)).alias("density"), "glare_total").orderBy("density")


def series_m2e(kpi: DataFrame, target_ms: int = TARGET_MS) -> DataFrame:
    within = F.col("m2e_ms") <= target_ms
    return kpi.select("n_peers", "m2e_ms", within.alias("within_target")).orderBy("n_peers")


def series_uplink(kpi: DataFrame) -> DataFrame:
    total = F.col("uplink_kbps") * (F.col("n_peers") - 1)
    return drop_null_series_points(kpi, "uplink_kbps").select(
        "n_peers", F.col("uplink_kbps").alias("per_link_kbps"), total.alias("node_total_kbps")
    ).orderBy("n_peers")


def series_suppression(mart: DataFrame) -> DataFrame:
    return scenario_rank_order(mart).select("rank", "scenario", "suppression_median_pct")


def _phase_bars(mart: DataFrame, phases: list[str]) -> DataFrame:
    bars = [
        F.struct(
            F.lit(p).alias("phase"),
            F.col(f"{p}_median_ms").alias("median_ms"),
            (F.col(f"{p}_median_ms") - F.col(f"{p}_min_ms")).alias("below_ms"),
            (F.col(f"{p}_max_ms") - F.col(f"{p}_median_ms")).alias("above_ms"),
        )
        for p in phases
    ]
    return mart.select(F.inline(F.array(*bars)))


def series_mobility(mart: DataFrame) -> DataFrame:
    return _phase_bars(mart, ["form", "teardown", "reconnect"])


def series_audiogap(mart: DataFrame) -> DataFrame:
    return _phase_bars(mart, ["stop", "reconnect", "total_silence"])


def _access_path_grid(conditions: DataFrame, metric: str) -> DataFrame:
    means = mean_by_access_path(conditions, metric).where(F.col("access").isin(ACCESS))
    grid = means.groupBy("access").pivot("path", PATHS).agg(F.first("mean_ms"))
    return grid.fillna(0.0, PATHS)


def series_realnet_rtt(conditions: DataFrame) -> DataFrame:
    return _access_path_grid(conditions, "rtt_median_ms")


def series_realnet_setup(conditions: DataFrame) -> DataFrame:
    return _access_path_grid(conditions, "setup_median_ms")


def series_device_energy(readings: DataFrame) -> DataFrame:
    delta = F.round(F.col("with_voice") - F.col("baseline"), 6)
    return readings.withColumn("delta", delta)


def series_grace_window(mart: DataFrame) -> DataFrame:
    return mart.select(
        ms_to_seconds_label("absence_ms").alias("series"), "absence_ms", "grace_ms", "gap_median_ms"
    ).orderBy("absence_ms", "grace_ms")
