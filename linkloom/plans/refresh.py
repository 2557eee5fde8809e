"""Land, conform, aggregate, check: the whole refresh, one written table per step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom import schemas
from linkloom.operators import marts, parity, quality, reshape
from linkloom.sources import exports, reports
from linkloom.sources.layers import read_layer, write_layer

EXPORT_TYPES = ["voice", "mobility", "audiogap", "gracegap", "dtx", "sensing"]

SILVER_MARTS = {
    "kpi_vs_n": (marts.kpi_vs_n, "voice_client"),
    "mobility_cycles": (marts.mobility_cycles, "mobility"),
    "audiogap": (marts.audiogap, "audiogap"),
    "sensing_suppression": (marts.sensing_suppression, "sensing"),
    "realnet_conditions": (marts.realnet_conditions, "link_fact"),
    "gracegap_series": (marts.gracegap_series, "gracegap"),
    "dtx_uplink": (marts.dtx_uplink, "dtx"),
}


#: Marts whose sources are more than one silver table; they carry no reference of their own.
JOINED_MARTS = ("realnet_session_kpis", "realnet_link_timing", "candidate_mix", "sensing_report_mix")


def land(spark: SparkSession, data_root: str, lake: str, ingested_at: str) -> None:
    """Raw layer. Exports are partitioned by type, so each later reader opens only its own files."""
    write_layer(
        exports.land_json_exports(spark, data_root, ingested_at),
        lake + "/bronze", "raw_json", partition_by="record_type",
    )
    write_layer(exports.read_trial_exports(spark, data_root), lake + "/silver", "trials")
    log = data_root.rstrip("/") + "/" + reports.STREAM_FILE
    write_layer(reports.land_jsonl_stream(spark, log, ingested_at), lake + "/bronze", "raw_stream")


def _checked(spark: SparkSession, df: DataFrame, root: str, name: str, checks: list[quality.Check]) -> DataFrame:
    """Write a table and count its suite on the way."""
    return quality.write_checked(
        df, name, checks, lambda observed: write_layer(observed, root, name), lambda: read_layer(spark, root, name))


def conform(spark: SparkSession, lake: str) -> DataFrame:
    """The silver tables; returns the results of the link fact's suite."""
    raw_json = read_layer(spark, lake + "/bronze", "raw_json")
    raw_stream = read_layer(spark, lake + "/bronze", "raw_stream")
    for name, table in reshape.build_experiment_tables(raw_json).items():
        write_layer(table, lake + "/silver", name)
    fact = reshape.build_link_fact(raw_json, raw_stream, read_layer(spark, lake + "/silver", "voice_client"))
    results = _checked(spark, fact, lake + "/silver", "link_fact", quality.LINK_FACT_CHECKS)
    write_layer(quarantine(spark, lake), lake + "/silver", "quarantine")
    return results


def quarantine(spark: SparkSession, lake: str) -> DataFrame:
    """Payloads of any type that do not fit their read schema."""
    raw_json = read_layer(spark, lake + "/bronze", "raw_json")
    raw_stream = read_layer(spark, lake + "/bronze", "raw_stream")
    kinds = [(reshape.filter_record_type(raw_json, name), name) for name in EXPORT_TYPES]
    parts = [reports.quarantine_malformed(df, schemas.payload(name))[1] for df, name in [*kinds, (raw_stream, "realnet")]]
    return reshape.union_sources(*parts)


def aggregate(spark: SparkSession, lake: str) -> DataFrame:
    """The marts; returns the results of their suites."""
    results = [
        _checked(spark, build(read_layer(spark, lake + "/silver", table)), lake + "/gold", name, quality.MART_CHECKS[name])
        for name, (build, table) in SILVER_MARTS.items()
    ]
    raw_json, raw_stream = (read_layer(spark, lake + "/bronze", name) for name in ("raw_json", "raw_stream"))
    link_fact, trials = (read_layer(spark, lake + "/silver", name) for name in ("link_fact", "trials"))
    joined = {
        "realnet_session_kpis": marts.realnet_session_kpis(raw_stream, trials),
        "realnet_link_timing": marts.realnet_link_timing(link_fact, trials),
        "candidate_mix": marts.candidate_mix(link_fact, trials),
        "sensing_report_mix": marts.sensing_report_mix(reshape.filter_record_type(raw_json, "sensing")),
    }
    for name in JOINED_MARTS:
        write_layer(joined[name], lake + "/gold", name)
    return reshape.union_sources(*results)


def read_marts(spark: SparkSession, lake: str) -> dict[str, DataFrame]:
    return {name: read_layer(spark, lake + "/gold", name) for name in SILVER_MARTS}


def check(spark: SparkSession, lake: str) -> DataFrame:
    """Quality of the link fact and of every mart, from the tables as they lie; a refresh counts it while it writes."""
    tables = read_marts(spark, lake)
    suites = {name: (tables[name], checks) for name, checks in quality.MART_CHECKS.items()}
    link_fact = read_layer(spark, lake + "/silver", "link_fact")
    return quality.run_checkpoint({"link_fact": (link_fact, quality.LINK_FACT_CHECKS), **suites})


def parity_gate(spark: SparkSession, lake: str) -> DataFrame:
    """The seven marts of one silver table against their references, and the published bands."""
    tables = read_marts(spark, lake)
    raw = {name: read_layer(spark, lake + "/bronze", name) for name in ("raw_json", "raw_stream")}
    compared = [
        parity.compare_mart(name, reference(raw[source]), tables[name])
        for name, (reference, source, _, _) in parity.MART_REFERENCES.items()
    ]
    metrics = parity.mart_metrics(tables)
    return parity.parity_report(*compared, parity.check_bands(metrics, parity.band_table(spark)))


def parity_columns(spark: SparkSession, lake: str) -> DataFrame:
    """Every column of the seven marts against the second reduction of the raw payloads."""
    raw = {name: read_layer(spark, lake + "/bronze", name) for name in ("raw_json", "raw_stream")}
    return parity.compare_all_columns(raw, read_marts(spark, lake))


def refresh(spark: SparkSession, data_root: str, lake: str, ingested_at: str) -> DataFrame:
    """End to end. Returns one row per gate with whether it passed."""
    land(spark, data_root, lake, ingested_at)
    fact_results = conform(spark, lake)
    write_layer(reshape.union_sources(fact_results, aggregate(spark, lake)), lake + "/gold", "quality")
    rejected = read_layer(spark, lake + "/silver", "quarantine")
    gates = {
        "quality": read_layer(spark, lake + "/gold", "quality"),
        "parity": parity_gate(spark, lake),
        "columns": parity_columns(spark, lake),
        "quarantine": quality.assert_rows_empty(rejected),
    }
    rows = [df.agg(F.bool_and("ok").alias("ok")).select(F.lit(n).alias("gate"), "ok") for n, df in gates.items()]
    return reshape.union_sources(*rows)
