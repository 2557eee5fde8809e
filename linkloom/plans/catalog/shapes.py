"""Parsing, reshaping, filters, scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkloom import schemas
from linkloom.functions import scalars as S
from linkloom.operators import loopback, reshape
from linkloom.plans import stand_ins as T
from linkloom.plans.catalog import query
from linkloom.plans.catalog.ingest import scratch
from linkloom.sources import layers, reports

with_sql = T.with_sql


def stream(spark, sf_dir):
    return reports.prepare_lines(T.report_payloads(spark, sf_dir), T.AT)


def link_fact(spark, sf_dir):
    return reshape.explode_realnet_links(stream(spark, sf_dir))


# Parsing


@query("parse_payload", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def parse_payload(spark, sf_dir):
    df = T.table(spark, sf_dir, "events").withColumnRenamed("props", "payload")
    return reshape.parse_payload(df, schemas.StructType.fromDDL("k int"), "r").select("event_id", "r.k")


@query("probe_json_paths", with_sql("ev", "rep", body="SELECT cond, sid, CAST(ts AS VARCHAR) AS ts FROM rep"))
def probe_json_paths(spark, sf_dir):
    paths = {"cond": "$.cond", "sid": "$.sid", "ts": "$.ts"}
    return reports.probe_json_paths(T.report_payloads(spark, sf_dir), paths).select(*paths)


LATEST = with_sql("ev", "rep", "newest", body="SELECT cond, sid, ts, peers FROM newest")


@query("latest_report_per_session", LATEST)
def latest_report_per_session(spark, sf_dir):
    return reshape.parsed_reports(stream(spark, sf_dir)).select("cond", "sid", "ts", "r.peers")


FACT_SQL = """SELECT 'realnet' AS record_type, cond AS condition, sid AS session_id, peers AS n_peers, link_index,
  CAST(setup_ms AS DOUBLE) AS setup_ms, CAST(rtt_ms AS DOUBLE) AS rtt_ms, candidate_type, glare FROM links"""


@query("explode_realnet_links", with_sql("ev", "rep", "newest", "links", body=FACT_SQL))
def explode_realnet_links(spark, sf_dir):
    return link_fact(spark, sf_dir).select(
        "record_type", "condition", "session_id", "n_peers", "link_index", "setup_ms", "rtt_ms", "candidate_type", "glare"
    )


VOICE_FACT = """SELECT source_file, n_peers, client, CAST(setup_median_ms AS DOUBLE) AS setup_ms, candidate_type,
  CAST(lat_raw_median_ms AS DOUBLE) AS lat_raw_ms, CAST(glare_total AS INTEGER) AS glare FROM client"""


@query("flatten_voice_kpis", with_sql("client", body=VOICE_FACT))
def flatten_voice_kpis(spark, sf_dir):
    return reshape.flatten_voice_kpis(T.voice_exports(spark, sf_dir)).select(
        "source_file", "n_peers", "client", "setup_ms", "candidate_type", "lat_raw_ms", "glare"
    )


SUMMARY = ["source_file", "n_peers", "client", "peers", "links", "glare_total"]
SUMMARY_D = ["setup_median_ms", "setup_p95_ms", "ice_success_pct", "relay_pct", "lat_raw_median_ms", "mean_up_kbps", "suppressed_pct"]


@query("voice_client_summary", with_sql("client", body="SELECT " + ", ".join(
    SUMMARY[:5] + ["CAST(glare_total AS INTEGER) AS glare_total"] + [f"CAST({c} AS DOUBLE) AS {c}" for c in SUMMARY_D]) + " FROM client"))
def voice_client_summary(spark, sf_dir):
    return reshape.voice_client_summary(T.voice_exports(spark, sf_dir)).select(*SUMMARY, *SUMMARY_D)


@query("build_link_fact", with_sql("client", "ev", "rep", "newest", "links", body="""
  SELECT record_type, candidate_type, count(*) AS rows_n, count(link_index) AS indexed, sum(glare)::BIGINT AS glare,
    count(client) AS clients, count(condition) AS conditions, round(sum(CAST(setup_ms AS DOUBLE)), 3) AS setup_sum FROM (
  SELECT 'realnet' AS record_type, candidate_type, link_index, glare, NULL AS client, cond AS condition, setup_ms FROM links
  UNION ALL SELECT 'voice', candidate_type, NULL, glare_total, client, NULL, setup_median_ms FROM client) GROUP BY ALL"""))
def build_link_fact(spark, sf_dir):
    fact = reshape.build_link_fact(T.voice_exports(spark, sf_dir), stream(spark, sf_dir))
    return fact.groupBy("record_type", "candidate_type").agg(
        F.count(F.lit(1)).alias("rows_n"), F.count("link_index").alias("indexed"), F.sum("glare").alias("glare"),
        F.count("client").alias("clients"), F.count("condition").alias("conditions"), F.round(F.sum("setup_ms"), 3).alias("setup_sum"),
    )


@query("union_sources", with_sql("client", "ev", "rep", "newest", "links", body="""
  SELECT condition, client, setup_ms FROM (SELECT cond AS condition, NULL AS client, CAST(setup_ms AS DOUBLE) AS setup_ms FROM links
  UNION ALL SELECT NULL, client, CAST(setup_median_ms AS DOUBLE) FROM client)"""))
def union_sources(spark, sf_dir):
    pick = ["condition", "client", "setup_ms"]
    voice = reshape.flatten_voice_kpis(T.voice_exports(spark, sf_dir)).select(*reversed(pick))
    return reshape.union_sources(link_fact(spark, sf_dir).select(*pick), voice)


CYCLE = """SELECT source_file, CAST(form_ms AS INTEGER) AS form_ms, CAST(teardown_ms AS INTEGER) AS teardown_ms,
  CAST(reconnect_ms AS INTEGER) AS reconnect_ms, coalesce(form_ms >= 0 AND teardown_ms >= 0 AND reconnect_ms >= 0, false) AS complete_case FROM cycle"""


def mobility(spark, sf_dir):
    return reshape.normalize_mobility(T.mobility_exports(spark, sf_dir)).drop("ingested_at")


query("normalize_mobility", with_sql("cycle", body=CYCLE))(mobility)
query("filter_complete_cases", with_sql("cycle", body=f"SELECT * FROM ({CYCLE}) WHERE complete_case"))(
    lambda spark, sf_dir: reshape.filter_complete_cases(mobility(spark, sf_dir))
)

GAP = """SELECT source_file, valid, CAST(stop_ms AS INTEGER) AS stop_ms, CAST(reconnect_ms AS INTEGER) AS reconnect_ms,
  CAST(total_silence_ms AS INTEGER) AS total_silence_ms FROM gap"""


def audiogap(spark, sf_dir):
    return reshape.normalize_audiogap(T.audiogap_exports(spark, sf_dir)).drop("ingested_at")


query("normalize_audiogap", with_sql("gap", body=GAP))(audiogap)
query("filter_valid_runs", with_sql("gap", body=f"SELECT * FROM ({GAP}) WHERE valid"))(
    lambda spark, sf_dir: reshape.filter_valid_runs(audiogap(spark, sf_dir))
)

GRACE = """SELECT source_file, absence_ms, grace_ms, CAST(reconnect_gap_ms AS INTEGER) AS reconnect_gap_ms, hold_kbps, stop_ms FROM grace"""


def gracegap(spark, sf_dir):
    return reshape.normalize_gracegap(T.gracegap_exports(spark, sf_dir)).drop("ingested_at")


query("normalize_gracegap", with_sql("grace", body=GRACE))(gracegap)
query("filter_measured", with_sql("grace", body=f"SELECT * FROM ({GRACE}) WHERE reconnect_gap_ms >= 0"))(
    lambda spark, sf_dir: reshape.filter_measured(gracegap(spark, sf_dir), "reconnect_gap_ms")
)


@query("normalize_dtx", with_sql("dtx_run", body="SELECT source_file, source, dtx, uplink_kbps FROM dtx_run"))
def normalize_dtx(spark, sf_dir):
    return reshape.normalize_dtx(T.dtx_exports(spark, sf_dir)).drop("ingested_at")


@query("normalize_sensing", with_sql("ev", "sense", body="""SELECT source_file, scenario, who.client,
  CAST(CASE who.client WHEN 'A' THEN k ELSE 100 - k END AS DOUBLE) AS suppressed_pct FROM sense, (VALUES ('A'), ('B')) who(client)"""))
def normalize_sensing(spark, sf_dir):
    return reshape.normalize_sensing(T.sensing_exports(spark, sf_dir)).drop("ingested_at")


REPORTS = """SELECT source_file, scenario, 'A' AS client, t_ms AS t, event_type AS kind, k AS x, CAST(floor(value) AS INTEGER) AS y,
  k % 3 AS neighbors, k FROM sense"""


def sense_reports(spark, sf_dir):
    return reshape.explode_sense_reports(T.sensing_exports(spark, sf_dir))


@query("explode_sense_reports", with_sql("ev", "sense", body=f"SELECT source_file, scenario, client, t, kind, x, y, neighbors FROM ({REPORTS})"))
def explode_sense_reports(spark, sf_dir):
    return sense_reports(spark, sf_dir).select("source_file", "scenario", "client", "t", "kind", "pos.x", "pos.y", "neighbors")


@query("explode_link_readings", with_sql("ev", "sense", body="""SELECT source_file, t_ms AS t, i AS index, CASE WHEN i IS NOT NULL THEN 'connected' END AS state,
  k + i AS rtt_ms, CASE WHEN i IS NOT NULL THEN k % 5 END AS jitter_ms, CASE WHEN i IS NOT NULL THEN k % 8 / 4::DOUBLE END AS loss_pct,
  CASE WHEN i IS NOT NULL THEN k * 2 END AS up_kbps FROM (
    SELECT *, 0 AS i FROM sense WHERE k % 3 >= 1 UNION ALL SELECT *, 1 FROM sense WHERE k % 3 = 2 UNION ALL SELECT *, NULL FROM sense WHERE k % 3 = 0)"""))
def explode_link_readings(spark, sf_dir):
    return reshape.explode_link_readings(sense_reports(spark, sf_dir)).select(
        "source_file", "t", "index", "state", "rtt_ms", "jitter_ms", "loss_pct", "up_kbps"
    )


@query("explode_series", """SELECT 'wsn-audiogap-' || o_orderkey || '.json' AS source_file, i::INTEGER AS pos,
  o_orderkey * 1000 + i * 200 AS t, (o_custkey + i * 7) % 50 AS pkts FROM orders, (VALUES (0), (1), (2)) s(i)""")
def explode_series(spark, sf_dir):
    return reshape.explode_series(T.audiogap_exports(spark, sf_dir)).select("source_file", "pos", "t", "pkts")


# Rows of every table in one shape: its name, the file, a label and up to four figures.
TABLE_ROWS = {
    "mobility": ("CAST(coalesce(form_ms >= 0 AND teardown_ms >= 0 AND reconnect_ms >= 0, false) AS VARCHAR)", "form_ms", "teardown_ms", "reconnect_ms", "NULL", "cycle"),
    "audiogap": ("CAST(valid AS VARCHAR)", "stop_ms", "reconnect_ms", "total_silence_ms", "NULL", "gap"),
    "gracegap": ("CAST(stop_ms AS VARCHAR)", "absence_ms", "grace_ms", "reconnect_gap_ms", "hold_kbps", "grace"),
    "dtx": ("source || '/' || dtx", "uplink_kbps", "NULL", "NULL", "NULL", "dtx_run"),
    "sensing": ("coalesce(scenario, '') || '/' || who.client", "CASE who.client WHEN 'A' THEN k ELSE 100 - k END", "NULL", "NULL", "NULL", "sense, (VALUES ('A'), ('B')) who(client)"),
    "voice_client": ("client", "n_peers", "setup_median_ms", "lat_raw_median_ms", "mean_up_kbps", "client"),
}


def rows_sql(prefix: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{prefix}{name}' AS name, source_file, {label} AS label, " + ", ".join(f"CAST({c} AS DOUBLE) AS {n}" for n, c in zip("abcd", figures, strict=True)) + f" FROM {source}"
        for name, (label, *figures, source) in TABLE_ROWS.items())


def shown(name: str, df):
    """A table's rows in that shape."""
    labels = {
        "mobility": F.col("complete_case").cast("string") if "complete_case" in df.columns else None,
        "audiogap": F.col("valid").cast("string") if "valid" in df.columns else None,
        "gracegap": F.col("stop_ms").cast("int").cast("string") if "stop_ms" in df.columns else None,
        "dtx": F.concat_ws("/", "source", F.col("dtx").cast("string")) if "dtx" in df.columns else None,
        "sensing": F.concat(F.coalesce("scenario", F.lit("")), F.lit("/"), "client") if "scenario" in df.columns else None,
        "voice_client": F.col("client") if "client" in df.columns else None,
        "link_fact": F.col("candidate_type") if "candidate_type" in df.columns else None,
    }
    figures = {
        "mobility": ("form_ms", "teardown_ms", "reconnect_ms", None), "audiogap": ("stop_ms", "reconnect_ms", "total_silence_ms", None),
        "gracegap": ("absence_ms", "grace_ms", "reconnect_gap_ms", "hold_kbps"), "dtx": ("uplink_kbps", None, None, None),
        "sensing": ("suppressed_pct", None, None, None), "voice_client": ("n_peers", "setup_median_ms", "lat_raw_median_ms", "mean_up_kbps"),
        "link_fact": ("setup_ms", "glare", None, None),
    }[name]
    cells = [(F.col(c) if c else F.lit(None)).cast("double").alias(n) for n, c in zip("abcd", figures, strict=True)]
    return df.select(F.lit(name).alias("name"), "source_file", labels[name].alias("label"), *cells)


def all_exports(spark, sf_dir):
    makers = (T.voice_exports, T.mobility_exports, T.audiogap_exports, T.gracegap_exports, T.dtx_exports, T.sensing_exports)
    return reshape.union_sources(*[make(spark, sf_dir) for make in makers])


@query("build_experiment_tables", with_sql("cycle", "gap", "grace", "dtx_run", "ev", "sense", "client", body=rows_sql()))
def build_experiment_tables(spark, sf_dir):
    """All six tables off one raw table; the type filter reaches each branch of the union."""
    tables = reshape.build_experiment_tables(all_exports(spark, sf_dir))
    return reshape.union_sources(*[shown(name, df) for name, df in tables.items()])


@query("filter_record_type", with_sql("dtx_run", body="SELECT 'dtx' AS record_type, source_file, uplink_kbps FROM dtx_run"))
def filter_record_type(spark, sf_dir):
    kept = reshape.filter_record_type(all_exports(spark, sf_dir), "dtx")
    return kept.select("record_type", "source_file", F.get_json_object("payload", "$.uplinkKbps").cast("double").alias("uplink_kbps"))


@query("filter_known_condition", with_sql("ev", "rep", body="SELECT cond, sid, CAST(ts AS VARCHAR) AS ts FROM rep WHERE cond <> ''"))
def filter_known_condition(spark, sf_dir):
    return reshape.filter_known_condition(stream(spark, sf_dir)).select("cond", "sid", "ts")


@query("conform_columns", "SELECT o_orderkey, NULL::VARCHAR AS client, CAST(o_custkey AS INTEGER) AS o_custkey FROM orders")
def conform_columns(spark, sf_dir):
    schema = schemas.StructType.fromDDL("o_orderkey bigint, client string, o_custkey int")
    return reshape.conform_columns(T.table(spark, sf_dir, "orders"), schema)


@query("condition_dims", with_sql("ev", "rep", body="""SELECT cond AS condition, CASE WHEN cond LIKE 'cellular%' THEN 'cellular'
  WHEN cond LIKE 'homeNAT%' THEN 'home' ELSE 'other' END AS access, count(*) AS n FROM rep GROUP BY ALL"""))
def condition_dims(spark, sf_dir):
    dims = reshape.condition_dims(stream(spark, sf_dir).withColumnRenamed("cond", "condition"))
    return dims.groupBy("condition", "access").agg(F.count(F.lit(1)).alias("n"))


LINK_ROWS = "SELECT 'stg_link_fact', 'wsn-remote-reports.jsonl', candidate_type, CAST(setup_ms AS DOUBLE), CAST(glare AS DOUBLE), NULL, NULL FROM links"


@query("staging_views", with_sql("cycle", "gap", "grace", "dtx_run", "ev", "sense", "client", "rep", "newest", "links", body=rows_sql("stg_") + " UNION ALL " + LINK_ROWS))
def staging_views(spark, sf_dir):
    """All seven views, over written tables."""
    out = scratch(spark)
    tables = reshape.build_experiment_tables(all_exports(spark, sf_dir))
    layers.write_layers({**tables, "link_fact": link_fact(spark, sf_dir)}, out)
    reshape.staging_views(spark, out)
    views = [shown(table, spark.table(view)).withColumn("name", F.lit(view)) for view, table in reshape.STAGING.items()]
    return reshape.union_sources(*views)


# Scalar expressions over line items and friends


def lines(spark, sf_dir):
    return T.table(spark, sf_dir, "lineitem")


@query("normalize_candidate_mix", """SELECT l_returnflag, l_linestatus, CASE WHEN l_returnflag = 'R' THEN 'relay' WHEN l_linestatus = 'O' THEN 'srflx' ELSE 'host' END AS kind,
  l_returnflag = 'R' OR l_linestatus = 'O' OR l_returnflag = 'A' AS known, count(*) AS n FROM lineitem GROUP BY ALL""")
def normalize_candidate_mix(spark, sf_dir):
    flag = F.col("l_returnflag")
    mix = F.struct(
        F.when(flag == "A", 2).alias("host"), (F.col("l_linestatus") == "O").cast("int").alias("srflx"), (flag == "R").cast("int").alias("relay")
    )
    df = lines(spark, sf_dir).withColumn("mix", mix)
    kind, known = S.normalize_candidate_mix(F.col("mix")), S.candidate_known(F.col("mix"))
    return df.groupBy("l_returnflag", "l_linestatus", kind.alias("kind"), known.alias("known")).agg(F.count(F.lit(1)).alias("n"))


@query("normalize_candidate_type", """SELECT CASE l_linenumber WHEN 1 THEN 'host' WHEN 2 THEN 'srflx' WHEN 3 THEN 'srflx' ELSE 'relay' END AS kind, count(*) AS n FROM lineitem GROUP BY 1""")
def normalize_candidate_type(spark, sf_dir):
    kinds = F.array(*map(F.lit, ("host", "srflx", "prflx", "relay")))
    kind = S.normalize_candidate_type(F.element_at(kinds, F.least("l_linenumber", F.lit(4))))
    return lines(spark, sf_dir).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


SENTINEL = "CASE WHEN l_quantity < 10 THEN -1 ELSE CAST(l_quantity AS BIGINT) END"


def scalar(name: str, sql: str, **columns):
    """A query that keeps one row per line item: its keys and the expressions under test."""
    key = "l_orderkey, l_linenumber, l_partkey, "

    @query(name, f"SELECT {key}{sql} FROM lineitem")
    def build(spark, sf_dir):
        made = [make().alias(n) for n, make in columns.items()]
        return lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", *made)


def _sentinel():
    return F.when(F.col("l_quantity") < 10, F.lit(-1)).otherwise(F.col("l_quantity").cast("bigint"))


scalar("sentinel_to_null", f"nullif({SENTINEL}, -1) AS q", q=lambda: S.sentinel_to_null(_sentinel()))
scalar("null_if_negative", f"nullif({SENTINEL}, -1) AS q", q=lambda: S.null_if_negative(_sentinel()))
scalar("coalesce_default", "coalesce(CASE WHEN l_returnflag <> 'N' THEN l_linestatus = 'O' END, false) AS dtx",
       dtx=lambda: S.coalesce_default(F.when(F.col("l_returnflag") != "N", F.col("l_linestatus") == "O"), False))
scalar("greatest_zero", f"greatest(CASE WHEN l_returnflag <> 'N' THEN {SENTINEL} END, 0) AS q",
       q=lambda: S.greatest_zero(F.when(F.col("l_returnflag") != "N", _sentinel())))
scalar("round_half_up", "round(l_quantity / 2) AS up, round((l_quantity - 25) / 2) AS signed_up, floor((l_quantity - 25) / 2 + 0.5)::BIGINT AS toward_plus",
       up=lambda: S.round_half_up(F.col("l_quantity") / 2), signed_up=lambda: S.round_half_up((F.col("l_quantity") - 25) / 2),
       toward_plus=lambda: S.round_half_ceiling((F.col("l_quantity") - 25) / 2))
scalar("round_half_even", "round_even((l_quantity - 25) / 2, 0) AS even", even=lambda: S.round_half_even((F.col("l_quantity") - 25) / 2))
scalar("like_prefix", "l_returnflag || l_linestatus LIKE 'R%' AS hit",
       hit=lambda: S.like_prefix(F.concat("l_returnflag", "l_linestatus"), "R"))
scalar("ms_to_seconds_label", "(l_linenumber * 1500 // 1000) || 's absence' AS label",
       label=lambda: S.ms_to_seconds_label(F.col("l_linenumber") * 1500))
scalar("loss_pct", """CASE WHEN l_suppkey % 5 + l_partkey % 100 > 0 THEN floor((l_suppkey % 5) * 1000 / (l_suppkey % 5 + l_partkey % 100) + 0.5) / 10
  ELSE -1 END::DOUBLE AS loss""", loss=lambda: S.loss_pct(F.col("l_suppkey") % 5, F.col("l_partkey") % 100))
scalar("tile_distance", """(l_suppkey % 50 - l_partkey % 50) * (l_suppkey % 50 - l_partkey % 50) + (l_linenumber - 3) * (l_linenumber - 3) AS d2,
  round(sqrt((l_suppkey % 50 - l_partkey % 50) ** 2 + (l_linenumber - 3) ** 2), 6) AS d""",
       d2=lambda: S.tile_distance_sq(F.col("l_suppkey") % 50, F.col("l_linenumber"), F.col("l_partkey") % 50, F.lit(3)),
       d=lambda: F.round(S.tile_distance(F.col("l_suppkey") % 50, F.col("l_linenumber"), F.col("l_partkey") % 50, F.lit(3)), 6))


@query("regex_extract", "SELECT page_id, nullif(regexp_extract(url, '^https?://([^/]+)/', 1), '') AS host, nullif(regexp_extract(url, '/([0-9]+)', 1), '') AS num FROM pages")
def regex_extract(spark, sf_dir):
    return T.table(spark, sf_dir, "pages").select(
        "page_id", S.regex_extract("url", "^https?://([^/]+)/").alias("host"), S.regex_extract("url", "/([0-9]+)").alias("num")
    )


@query("rms_level", """SELECT vec_id, round(sqrt(avg(x * x)), 6) AS rms, round(sqrt(avg((floor(x * 100) / 128) ** 2)), 6) AS byte_rms
  FROM (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) GROUP BY vec_id""")
def rms_level(spark, sf_dir):
    """RMS of frames, and of the same samples as centred bytes."""
    vectors = T.table(spark, sf_dir, "embeddings")
    exact = F.transform("embedding", lambda x: x.cast("double"))
    samples = vectors.select("vec_id", F.explode(exact).alias("x"))
    as_bytes = F.transform(exact, lambda x: F.floor(x * 100).cast("int") + 128)
    packed = vectors.select("vec_id", F.round(S.rms_of_bytes(as_bytes), 6).alias("byte_rms"))
    level = loopback.rms_level(samples, ["vec_id"], "x").withColumn("rms", F.round("rms", 6))
    return level.join(packed, "vec_id")


@query("peak_amplitude", "SELECT vec_id, round(max(abs(CAST(x AS DOUBLE))), 6) AS peak, round(max(abs(CAST(x AS DOUBLE))), 6) AS peak_of_array FROM (SELECT vec_id, unnest(embedding) AS x FROM embeddings) GROUP BY vec_id")
def peak_amplitude(spark, sf_dir):
    vectors = T.table(spark, sf_dir, "embeddings").withColumn("embedding", F.transform("embedding", lambda x: x.cast("double")))
    samples = vectors.select("vec_id", F.explode("embedding").alias("x"))
    by_rows = loopback.peak_amplitude(samples, ["vec_id"], "x").withColumn("peak", F.round("peak", 6))
    return by_rows.join(vectors.select("vec_id", F.round(S.peak_of("embedding"), 6).alias("peak_of_array")), "vec_id")
