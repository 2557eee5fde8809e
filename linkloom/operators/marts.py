"""Result marts: aggregates over the flat per-run, per-client and per-link tables.

Rounded columns carry the published rounding (half up); the ``_raw`` twins are the
unrounded values that parity compares. Readings are whole milliseconds, percent or
counts, so the exact medians keep few distinct values per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom import schemas
from linkloom.functions.percentiles import exact_percentiles, median, percentile_nearest_rank
from linkloom.functions.scalars import (
    access_of,
    greatest_zero,
    normalize_candidate_type,
    sentinel_to_null,
    suppressed_pct,
)
from linkloom.operators.history import broadcast_if_small, same_keys, settled
from linkloom.operators.reshape import (
    filter_complete_cases,
    filter_known_condition,
    filter_measured,
    filter_valid_runs,
    parse_payload,
    parsed_reports,
    union_sources,
)


def _rounded(columns: dict[str, Column]) -> dict[str, Column]:
    return {**{n: F.round(c) for n, c in columns.items()}, **{n + "_raw": c for n, c in columns.items()}}


def _aliased(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in columns.items()]


# Voice runs by cluster size


def newest_run_per_n(df: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """Rows of the newest file of each cluster size; file names sort by time.

    ``runs`` gives the sizes and files of df where they cost less to read than df's own
    (``reshape.voice_runs``). One row per cluster size is kept. Files are picked by name
    first: a name needs no parsing, so Spark picks ahead of any parsing that df still
    holds, and only the newest files are parsed. Nothing wide is shuffled.
    """
    keys = ["n_peers", "source_file"]
    newest = settled((df if runs is None else runs).groupBy("n_peers").agg(F.max("source_file").alias("source_file")))
    newest = broadcast_if_small(newest.where(F.col("n_peers").isNotNull()).select(*[F.col(k).alias("_n_" + k) for k in keys]))
    # A missing name counts as an empty one here: the join below tells them apart.
    named = df.where(F.coalesce("source_file", F.lit("")).isin(newest.select(F.coalesce("_n_source_file", F.lit("")))))
    # Null-safe, so that no null check runs ahead of the parsing that df may still hold.
    return named.join(newest, same_keys(named, newest, keys, "_n_"), "left_semi")


def kpi_vs_n(voice_client: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """Per cluster size, over the clients of its newest run; ``runs`` as in ``newest_run_per_n``."""
    measured = {
        "setup_median_ms": median(sentinel_to_null("setup_median_ms")),
        "setup_p95_ms": median(sentinel_to_null("setup_p95_ms")),
        "ice_success_pct": F.avg(sentinel_to_null("ice_success_pct")),
        "relay_pct": F.avg(sentinel_to_null("relay_pct")),
        "m2e_ms": F.avg(sentinel_to_null("lat_raw_median_ms")),
        "uplink_kbps": F.avg("mean_up_kbps"),
        "suppressed_pct": F.avg("suppressed_pct"),
    }
    return newest_run_per_n(voice_client, runs).groupBy("n_peers").agg(
        F.round(F.avg("peers"), 1).alias("avg_peers"),
        F.sum(greatest_zero("links")).alias("conn_links"),
        *_aliased(_rounded(measured)),
        F.sum("glare_total").alias("glare_total"),
    )


# Mobility and audio gap: global summaries


def _ranges(columns: dict[str, str]) -> list[Column]:
    out = []
    for name, column in columns.items():
        out += [
            F.round(median(column)).alias(f"{name}_median_ms"),
            median(column).alias(f"{name}_median_ms_raw"),
            F.min(column).alias(f"{name}_min_ms"),
            F.max(column).alias(f"{name}_max_ms"),
        ]
    return out


def mobility_cycles(mobility: DataFrame) -> DataFrame:
    """Counts and ranges over complete cycles; a partial run distorts its other phases."""
    phases = {p: f"{p}_ms" for p in ("form", "teardown", "reconnect")}
    return filter_complete_cases(mobility).agg(
        F.count(F.lit(1)).alias("complete_cycles"), *_ranges(phases)
    )


def mobility_skipped(mobility: DataFrame) -> DataFrame:
    return mobility.agg(F.count_if(~F.col("complete_case")).alias("skipped"))


def audiogap(runs: DataFrame) -> DataFrame:
    phases = {p: f"{p}_ms" for p in ("stop", "reconnect", "total_silence")}
    return filter_valid_runs(runs).agg(F.count(F.lit(1)).alias("valid_runs"), *_ranges(phases))


def audiogap_skipped(runs: DataFrame) -> DataFrame:
    return runs.agg(F.count_if(~F.col("valid")).alias("skipped"))


# Sensing


def sensing_suppression(sensing: DataFrame) -> DataFrame:
    """Per scenario: runs, and the median over all their clients."""
    clients = sensing.where(F.col("scenario").isNotNull() & (F.col("scenario") != ""))
    # Runs and shares are counted side by side, so that clients are made once: a distinct count
    # beside a median would keep the values of every run apart.
    run = F.struct("source_file", F.lit(None).cast("double").alias("share"))
    value = F.struct(F.lit(None).cast("string").alias("source_file"), F.col("suppressed_pct").cast("double").alias("share"))
    counted = clients.select("scenario", F.inline(F.array(run, value))).groupBy("scenario", "source_file", "share").agg(F.count(F.lit(1)).alias("_n"))
    share = F.percentile("share", 0.5, F.col("_n"))
    return counted.groupBy("scenario").agg(
        F.count("source_file").alias("trials"),
        F.round(share).alias("suppression_median_pct"),
        share.alias("suppression_median_pct_raw"),
    )


def sensing_report_mix(raw_json: DataFrame) -> DataFrame:
    """Mean reports per run by scenario and kind."""
    runs = parse_payload(
        raw_json.where(F.col("record_type") == "sensing"), schemas.payload("sensing"), "r"
    ).select(F.col("r.scenario").alias("scenario"), F.col("r.kindCounts").alias("kinds"))
    runs = filter_known_condition(runs, "scenario")
    # One pass: every run adds a row of its own under a NULL kind, next to its counts.
    lines = runs.select("scenario", F.explode_outer(F.concat(
        F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(1).alias("value"))),
        F.coalesce(F.map_entries("kinds"), F.array()),
    )).alias("e"))
    sums = lines.groupBy("scenario", F.col("e.key").alias("kind")).agg(F.sum("e.value").alias("n"))
    runs_of = F.struct(F.col("kind"), F.col("n"))
    folded = sums.groupBy("scenario").agg(
        F.max(F.when(F.col("kind").isNull(), F.col("n"))).alias("runs"),
        F.collect_list(F.when(F.col("kind").isNotNull(), runs_of)).alias("kinds"),
    )
    return folded.select("scenario", "runs", F.explode("kinds").alias("k")).select(
        "scenario", F.col("k.kind").alias("kind"), "runs", F.col("k.n").alias("reports"),
        (F.col("k.n") / F.col("runs")).alias("reports_per_run"),
    )


# Real network


def path_from_links(link_fact: DataFrame) -> DataFrame:
    """Relay if any link of the condition is relayed, else direct."""
    return link_fact.groupBy("condition").agg(_path().alias("path"))


def _path() -> Column:
    relayed = F.max(F.when(F.col("candidate_type") == "relay", 1).otherwise(0)) == 1
    return F.when(relayed, "relay").otherwise("direct")


def realnet_conditions(link_fact: DataFrame) -> DataFrame:
    """Per condition: access, path, measured links, setup and RTT medians, glare."""
    links = filter_known_condition(link_fact.where(F.col("record_type") == "realnet"), "condition")
    measured = {
        "setup_median_ms": median(sentinel_to_null("setup_ms")),
        "rtt_median_ms": median(sentinel_to_null("rtt_ms")),
    }
    return (
        links.groupBy("condition")
        .agg(
            _path().alias("path"),
            F.count(sentinel_to_null("setup_ms")).alias("links"),
            *_aliased(_rounded(measured)),
            F.sum("glare").alias("glare_total"),
        )
        .withColumn("access", access_of("condition"))
    )


def _realnet_links(link_fact: DataFrame, trials: DataFrame | None) -> DataFrame:
    """Links of the newest session reports and of trial files: condition, setup_ms, rtt_ms, candidate_type."""
    own = filter_known_condition(link_fact.where(F.col("record_type") == "realnet"), "condition")
    own = own.where(F.col("link_index").isNotNull()).select("condition", "setup_ms", "rtt_ms", "candidate_type")
    if trials is None:
        return own
    links = trials.select("condition", F.explode("links").alias("l")).select(
        "condition", F.col("l.setupMs").alias("setup_ms"), F.col("l.rttMs").alias("rtt_ms"),
        F.col("l.candidateType").alias("candidate_type"),
    )
    return union_sources(own, links)


def realnet_link_timing(link_fact: DataFrame, trials: DataFrame | None = None) -> DataFrame:
    """Per condition: links with a measured set-up, set-up median, RTT median."""
    return _realnet_links(link_fact, trials).groupBy("condition").agg(
        F.count(sentinel_to_null("setup_ms")).alias("links"),
        median(sentinel_to_null("setup_ms")).alias("setup_median_ms_raw"),
        median(sentinel_to_null("rtt_ms")).alias("rtt_median_ms_raw"),
    )


def candidate_mix(link_fact: DataFrame, trials: DataFrame | None = None) -> DataFrame:
    """Links per condition and candidate type; an empty type counts as '?'."""
    kind = F.coalesce(F.nullif("candidate_type", F.lit("")), F.lit("?"))
    return _realnet_links(link_fact, trials).groupBy("condition", kind.alias("candidate_type")).agg(F.count(F.lit(1)).alias("links"))


def union_realnet_sources(reports: DataFrame, trials: DataFrame) -> DataFrame:
    """KPI blocks per condition: newest session reports and trial files."""
    sessions = reports.where(F.col("r.kpis").isNotNull()).select(
        F.col("cond").alias("condition"), F.col("r.kpis").alias("kpis")
    )
    return union_sources(sessions, trials.select("condition", "kpis"))


def realnet_session_kpis(raw_stream: DataFrame, trials: DataFrame) -> DataFrame:
    """Per condition over its newest session reports and trials."""
    blocks = union_realnet_sources(parsed_reports(raw_stream), trials)
    measured = {
        "setup_median_ms": median(sentinel_to_null("kpis.setupMedianMs")),
        "ice_success_pct": F.avg(sentinel_to_null("kpis.iceSuccessPct")),
        "relay_pct": F.avg(sentinel_to_null("kpis.relayPct")),
        "m2e_ms": F.avg(sentinel_to_null("kpis.latRawMedianMs")),
    }
    return blocks.groupBy("condition").agg(
        F.count(F.lit(1)).alias("n"),
        *_aliased(_rounded(measured)),
        F.coalesce(F.sum("kpis.glareTotal"), F.lit(0)).alias("kpi_glare_total"),
    )


def mean_by_access_path(conditions: DataFrame, metric: str) -> DataFrame:
    """Mean of condition medians per access network and path, rounded half to even."""
    return conditions.groupBy("access", "path").agg(F.bround(F.avg(metric)).alias("mean_ms"))


# Duty cycle and uplink


def gracegap_series(gracegap: DataFrame) -> DataFrame:
    """Per (absence, grace) cell over runs whose reconnect gap was measured."""
    measured = {
        "gap_median_ms": median("reconnect_gap_ms"),
        "stop_median_ms": median(sentinel_to_null("stop_ms")),
        "hold_median_kbps": median(sentinel_to_null("hold_kbps")),
    }
    return filter_measured(gracegap, "reconnect_gap_ms").groupBy("absence_ms", "grace_ms").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("reconnect_gap_ms").alias("gap_min_ms"),
        F.max("reconnect_gap_ms").alias("gap_max_ms"),
        *_aliased(_rounded(measured)),
    )


def dtx_uplink(dtx: DataFrame) -> DataFrame:
    """Per source and DTX switch: runs with a measured uplink and their median.

    A rate has no grid, so its median is the one that ranks counted values.
    """
    cells = exact_percentiles(
        filter_measured(dtx, "uplink_kbps"), ["source", "dtx"], "uplink_kbps",
        {"uplink_median_kbps_raw": 0.5},
    )
    return cells.withColumn("uplink_median_kbps", F.round("uplink_median_kbps_raw"))


# Link records


def link_kpi_rollup(links: DataFrame, calibrated: bool = False) -> DataFrame:
    """Session summary of link records; -1 where a figure is undefined."""
    up = "connected_ms >= 0"
    connected = F.count_if(F.expr(up))
    attempts = F.count_if(F.expr(f"{up} or failed"))
    kind = normalize_candidate_type("candidate_type")
    of_kind = lambda k: F.count_if(F.expr(up) & (kind == k))
    typed = F.count_if(F.expr(up) & (F.col("candidate_type") != ""))

    def pct(part: Column, whole: Column) -> Column:
        share = F.floor(part * 100 / F.nullif(whole, F.lit(0)) + 0.5)
        return F.coalesce(share, F.lit(-1)).cast("bigint")

    def ranked(column: str, p: float) -> Column:
        return percentile_nearest_rank(f"case when {up} and {column} >= 0 then {column} end", p)

    undefined = F.lit(-1).cast("bigint")
    return links.groupBy("session").agg(
        connected.alias("links"),
        attempts.alias("ice_attempts"),
        pct(connected, attempts).alias("ice_success_pct"),
        ranked("setup_ms", 0.5).alias("setup_median_ms"),
        ranked("setup_ms", 0.95).alias("setup_p95_ms"),
        pct(of_kind("relay"), typed).alias("relay_pct"),
        of_kind("host").alias("mix_host"),
        of_kind("srflx").alias("mix_srflx"),
        of_kind("relay").alias("mix_relay"),
        ranked("lat_raw_ms", 0.5).alias("lat_raw_median_ms"),
        ranked("lat_raw_ms", 0.95).alias("lat_raw_p95_ms"),
        (ranked("lat_cal_ms", 0.5) if calibrated else undefined).alias("lat_cal_median_ms"),
        (ranked("lat_cal_ms", 0.95) if calibrated else undefined).alias("lat_cal_p95_ms"),
        F.sum("glare").alias("glare_total"),
    )


# Live samples


def mean_link_rtt(samples: DataFrame) -> DataFrame:
    """Per session and time: mean RTT over links that report one; -1 if none does."""
    rtt = F.floor(F.avg(sentinel_to_null("rtt_ms")) + 0.5).cast("bigint")
    return samples.groupBy("session", "t_ms").agg(F.coalesce(rtt, F.lit(-1)).alias("mean_rtt_ms"))


def mesh_snapshot(samples: DataFrame) -> DataFrame:
    """Per session and time: peers in range, linked, negotiating."""
    return samples.groupBy("session", "t_ms").agg(
        F.count(F.lit(1)).alias("in_range"),
        F.count_if(F.col("state") == "connected").alias("linked"),
        F.count_if(F.col("state").isin("new", "connecting")).alias("negotiating"),
    )


def rx_totals(samples: DataFrame) -> DataFrame:
    """Per session and time: packets, emitted samples and loudest level over peers."""
    return samples.groupBy("session", "t_ms").agg(
        F.coalesce(F.sum("packets_received"), F.lit(0)).alias("pkts"),
        F.coalesce(F.sum("jb_count"), F.lit(0)).alias("samples"),
        F.greatest(F.max("level"), F.lit(0.0)).alias("level"),
    )


def suppression_by_node(decisions: DataFrame) -> DataFrame:
    """Per session: samples and the share not reported.

    Forced samples count below the line, only quiet periodic ones above it; the
    final report of a sleeping node is not a sample.
    """
    sampled = F.coalesce(F.col("kind"), F.lit("")) != "node-sleep"
    counted = decisions.groupBy("session").agg(
        F.count_if(sampled).alias("samples"),
        F.count_if(F.col("suppressed")).alias("suppressed"),
    )
    return counted.withColumn("suppressed_pct", suppressed_pct("samples", "suppressed"))


def relay_hop_rtt(hops: DataFrame) -> DataFrame:
    """Per run: mean of the measured hop RTTs, -1 if none was."""
    rtt = F.floor(F.avg(sentinel_to_null("rtt_ms")) + 0.5).cast("bigint")
    return hops.groupBy("run").agg(F.coalesce(rtt, F.lit(-1)).alias("hop_rtt_ms"))


# Bursts


def burst_statistics(bursts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Count, percentiles, mean and range of the kept bursts per recording."""
    return exact_percentiles(
        bursts.where("kept"), keys or ["recording_id"], "latency_ms", {"p50": 0.5, "p95": 0.95}, spread=True
    )


def latency_histogram(df: DataFrame, value: str, width: float = 10.0) -> DataFrame:
    """Fixed-width bins from the smallest value up; empty bins have no row."""
    values = df.where(F.col(value).isNotNull())
    least = values.agg(F.min(value)).scalar()
    placed = values.withColumn("_least", least).withColumn(
        "_bin", F.floor((F.col(value) - F.col("_least")) / width)
    )
    low = F.col("_least") + F.col("_bin") * width
    return placed.groupBy(low.alias("bin_lo"), (low + width).alias("bin_hi")).agg(
        F.count(F.lit(1)).alias("n")
    )
