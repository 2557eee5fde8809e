"""Sources, landing, sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkloom import schemas
from linkloom import session as settings
from linkloom.functions import scalars as S
from linkloom.operators import reshape
from linkloom.plans import stand_ins as T
from linkloom.plans.catalog import query
from linkloom.sources import exports, layers, reports

NAMES = """SELECT 'wsn-' || CASE l_returnflag || l_linestatus WHEN 'RO' THEN 'voice-N' || l_linenumber WHEN 'RF' THEN 'dtx'
  WHEN 'AF' THEN 'remote' WHEN 'AO' THEN 'sensing-idle' WHEN 'NO' THEN 'unknown' ELSE 'mobility' END || '-' || l_orderkey
  || CASE WHEN l_linenumber = 7 THEN '.txt' ELSE '.json' END AS source_file FROM lineitem"""
KIND = """CASE regexp_extract(source_file, '^wsn-([a-z]+)', 1) WHEN 'audiogap' THEN 'audiogap' WHEN 'dtx' THEN 'dtx' WHEN 'gracegap' THEN 'gracegap'
  WHEN 'mobility' THEN 'mobility' WHEN 'remote' THEN 'realnet' WHEN 'sensing' THEN 'sensing' WHEN 'voice' THEN 'voice' END"""


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as file names, some outside the grammar."""
    n = F.col("l_linenumber").cast("string")
    pair = F.concat("l_returnflag", "l_linestatus")
    kind = (
        F.when(pair == "RO", F.concat(F.lit("voice-N"), n)).when(pair == "RF", "dtx").when(pair == "AF", "remote")
        .when(pair == "AO", "sensing-idle").when(pair == "NO", "unknown").otherwise("mobility")
    )
    end = F.when(F.col("l_linenumber") == 7, ".txt").otherwise(".json")
    return T.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("wsn-"), kind, F.lit("-"), F.col("l_orderkey").cast("string"), end).alias("source_file")
    )


def scratch(spark: SparkSession) -> str:
    """A fresh folder beside the reliable checkpoints, reachable by every executor."""
    settings.use_checkpoints(spark)
    return spark.sparkContext.getCheckpointDir() + "/out-" + uuid.uuid4().hex


# Customers as export files: seven kinds of names, some outside the grammar, with a payload in plain text.
FILES = """SELECT c_custkey, 'wsn-' || ['audiogap', 'voice-N3-summary', 'dtx', 'unknown', 'remote', 'sensing-idle', 'voice-office-' || c_mktsegment[1:1] || '-trial'][CAST(c_custkey % 7 + 1 AS INTEGER)]
    || CASE WHEN c_custkey % 7 = 6 THEN '' ELSE '-' END || c_custkey || CASE WHEN c_custkey % 11 = 0 THEN '.txt' ELSE '.json' END AS source_file,
  CASE WHEN c_custkey % 2 = 0 THEN '{"setupMedianMs": ' || c_nationkey || ', "glareTotal": ' || c_custkey % 4 || '}'
    ELSE '{"kpis": {"setupMedianMs": ' || c_nationkey || ', "glareTotal": ' || c_custkey % 4 || '},\n "links": [{"index": 1, "rttMs": ' || c_custkey || '}]}' END AS payload FROM customer"""


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on Spark, as rows to be written as files."""
    key, text = F.col("c_custkey"), lambda c: c.cast("string")
    kinds = [F.lit(k) for k in ("audiogap-", "voice-N3-summary-", "dtx-", "unknown-", "remote-", "sensing-idle-")]
    kinds.append(F.concat(F.lit("voice-office-"), F.substring("c_mktsegment", 1, 1), F.lit("-trial")))
    name = F.concat(F.lit("wsn-"), F.element_at(F.array(*kinds), (key % 7 + 1).cast("int")), text(key), F.when(key % 11 == 0, ".txt").otherwise(".json"))
    block = F.concat(F.lit('{"setupMedianMs": '), text(F.col("c_nationkey")), F.lit(', "glareTotal": '), text(key % 4), F.lit("}"))
    nested = F.concat(F.lit('{"kpis": '), block, F.lit(',\n "links": [{"index": 1, "rttMs": '), text(key), F.lit("}]}"))
    return T.table(spark, sf_dir, "customer").select(name.alias("source_file"), F.when(key % 2 == 0, block).otherwise(nested).alias("payload"))


def export_root(spark: SparkSession, sf_dir: str) -> str:
    root = scratch(spark)
    exports.write_exports(files(spark, sf_dir), root)
    return root


@query("discover_exports", f"""SELECT source_file FROM ({FILES}) WHERE source_file LIKE '%.json' AND ({KIND}) IS NOT NULL""")
def discover_exports(spark, sf_dir):
    """Found by listing the files."""
    return exports.discover_exports(spark, export_root(spark, sf_dir))


@query("keep_exports", f"""SELECT source_file FROM ({NAMES}) WHERE source_file LIKE '%.json' AND ({KIND}) IS NOT NULL""")
def keep_exports(spark, sf_dir):
    return exports.keep_exports(names(spark, sf_dir)).orderBy("source_file")


@query("classify_record_type", f"""SELECT coalesce({KIND}, 'rejected') AS record_type, count(*) AS files FROM ({NAMES}) GROUP BY 1""")
def classify_record_type(spark, sf_dir):
    known, rejected = exports.classify_record_type(names(spark, sf_dir))
    everything = known.unionByName(rejected.withColumn("record_type", F.lit("rejected")))
    return everything.groupBy("record_type").agg(F.count(F.lit(1)).alias("files"))


lookup_sql = f"""SELECT DISTINCT regexp_extract(source_file, '^wsn-([a-z]+)', 1) AS prefix, {KIND} AS record_type FROM ({NAMES})"""


@query("lookup_type_map", lookup_sql)
def lookup_type_map(spark, sf_dir):
    """The map is a literal of seven entries, so the lookup needs no join."""
    prefix = F.regexp_extract("source_file", S.PREFIX_PATTERN, 1)
    return names(spark, sf_dir).select(prefix.alias("prefix"), S.record_type("source_file").alias("record_type")).distinct()


@query("peer_count", f"""SELECT CAST(nullif(regexp_extract(source_file, '-N([0-9]+)', 1), '') AS INTEGER) AS peer_count, count(*) AS files
  FROM ({NAMES}) GROUP BY 1""")
def peer_count(spark, sf_dir):
    df = names(spark, sf_dir).withColumn("peer_count", S.peer_count("source_file"))
    return df.groupBy("peer_count").agg(F.count(F.lit(1)).alias("files"))


@query("stamp_provenance", f"""SELECT source_file, {KIND} AS record_type,
  CAST(nullif(regexp_extract(source_file, '-N([0-9]+)', 1), '') AS INTEGER) AS peer_count, '{T.AT}' AS ingested_at FROM ({NAMES})""")
def stamp_provenance(spark, sf_dir):
    return exports.stamp_provenance(names(spark, sf_dir), T.AT)


@query("land_json_exports", f"""SELECT payload, source_file, {KIND} AS record_type,
  CAST(nullif(regexp_extract(source_file, '-N([0-9]+)', 1), '') AS INTEGER) AS peer_count, '{T.AT}' AS ingested_at
  FROM ({FILES}) WHERE source_file LIKE '%.json' AND ({KIND}) IS NOT NULL""")
def land_json_exports(spark, sf_dir):
    """Landed from the files: the payload verbatim, and where it came from."""
    return exports.land_json_exports(spark, export_root(spark, sf_dir), T.AT)


@query("stamp_payloads", T.with_sql("gap", body=f"""SELECT source_file, 'audiogap' AS record_type, NULL::INTEGER AS peer_count,
  '{T.AT}' AS ingested_at, reconnect_ms FROM gap"""))
def stamp_payloads(spark, sf_dir):
    """The landed grain; the payload is kept verbatim, shown by reading one field back."""
    landed = exports.stamp_provenance(T.audiogap_exports(spark, sf_dir).select("payload", "source_file"), T.AT)
    field = F.get_json_object("payload", "$.reconnectAudioGapMs").cast("bigint")
    return landed.select("source_file", "record_type", "peer_count", "ingested_at", field.alias("reconnect_ms"))


def landed(spark, sf_dir):
    return reports.drop_redelivered(reports.prepare_lines(T.report_payloads(spark, sf_dir, copies=True), T.AT))


LANDED = T.with_sql("ev", "rep", body="SELECT cond, sid, CAST(ts AS VARCHAR) AS ts, count(*) AS n FROM rep GROUP BY ALL")


@query("land_jsonl_stream", LANDED)
def land_jsonl_stream(spark, sf_dir):
    """The log is written as lines of text and landed from its files."""
    out = scratch(spark)
    T.report_payloads(spark, sf_dir, copies=True).select(F.col("payload").alias("value")).write.text(out)
    got = reports.land_jsonl_stream(spark, out, T.AT)
    return got.groupBy("cond", "sid", "ts").agg(F.count(F.lit(1)).alias("n"))


@query("skip_blank_lines", """SELECT doc_id, count(*) AS lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
  WHERE NOT regexp_full_match(line, '[ \\t\\n\\x0B\\f\\r]*') GROUP BY doc_id""")
def skip_blank_lines(spark, sf_dir):
    lines = T.table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return reports.skip_blank_lines(lines, "line").groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines"))


def broken_lines(spark, sf_dir):
    """Event properties, some cut short and some with a fraction where an int belongs."""
    kind = F.col("event_type")
    text = F.when(kind == "error", F.substring("props", 1, 4)).when(kind == "view", F.replace("props", F.lit("}"), F.lit(".5}")))
    return T.table(spark, sf_dir, "events").select(F.coalesce(text, "props").alias("payload"))


@query("quarantine_malformed", """SELECT CASE event_type WHEN 'error' THEN 'not json' WHEN 'view' THEN 'type mismatch' ELSE 'good' END AS outcome,
  count(*) AS lines, sum(CASE WHEN event_type NOT IN ('error', 'view') THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END)::BIGINT AS k_sum
  FROM events GROUP BY 1""")
def quarantine_malformed(spark, sf_dir):
    schema = schemas.StructType.fromDDL("k int")
    good, bad = reports.quarantine_malformed(broken_lines(spark, sf_dir), schema)
    both = good.select(F.lit("good").alias("outcome"), F.col("r.k").alias("k")).unionByName(
        bad.select(F.col("reason").alias("outcome"), F.lit(None).cast("int").alias("k"))
    )
    return both.groupBy("outcome").agg(F.count(F.lit(1)).alias("lines"), F.sum("k").alias("k_sum"))


FRAMED = T.with_sql("ev", "rep", body="SELECT sid AS partition_key, count(*) AS events, min(ts) AS first_ts, max(ts) AS last_ts FROM rep GROUP BY 1")


@query("frame_events", FRAMED)
def frame_events(spark, sf_dir):
    framed = reports.frame_events(T.report_payloads(spark, sf_dir))
    return framed.groupBy("partition_key").agg(
        F.count(F.lit(1)).alias("events"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )


@query("per_session_order", T.with_sql("ev", "rep", body="""SELECT sid AS partition_key, ts,
  row_number() OVER (PARTITION BY sid ORDER BY ts) AS place FROM rep"""))
def per_session_order(spark, sf_dir):
    """Each event's place in its session, by where the ordered partitions hold it."""
    framed = reports.frame_events(T.report_payloads(spark, sf_dir)).select("partition_key", "ts")
    # numbered partition by partition, so the numbers follow the order as it reads
    held = reports.per_session_order(framed).withColumn("_at", F.monotonically_increasing_id())
    in_session = Window.partitionBy("partition_key").orderBy("_at")
    return held.select("partition_key", "ts", F.row_number().over(in_session).alias("place"))


@query("publish_keyed_events", T.with_sql("ev", "rep", body="""SELECT sid AS partition_key, count(*) AS events, min(ts) AS first_ts,
  max(ts) AS last_ts, true AS in_order FROM rep GROUP BY 1"""))
def publish_keyed_events(spark, sf_dir):
    """The published files read back: every session's events, and whether they lie in order of time."""
    out = scratch(spark)
    reports.publish_keyed_events(reports.frame_events(T.report_payloads(spark, sf_dir)), out)
    log = spark.read.schema("partition_key string, body string").json(out).select(
        "partition_key", F.get_json_object("body", "$.ts").cast("bigint").alias("ts"),
        F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    as_read = Window.partitionBy("partition_key").orderBy("_file", "_block", "_line")
    rising = F.coalesce(F.col("ts") >= F.lag("ts").over(as_read), F.lit(True))
    return log.withColumn("_rising", rising).groupBy("partition_key").agg(
        F.count(F.lit(1)).alias("events"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        F.bool_and("_rising").alias("in_order"),
    )


DTX_LAYER = T.with_sql("dtx_run", body="SELECT source_file, source, dtx, uplink_kbps FROM dtx_run")


@query("read_layer", DTX_LAYER)
def read_layer(spark, sf_dir):
    out = scratch(spark)
    layers.write_layer(reshape.normalize_dtx(T.dtx_exports(spark, sf_dir)), out, "dtx")
    return layers.read_layer(spark, out, "dtx").select("source_file", "source", "dtx", "uplink_kbps")


@query("write_layer", T.with_sql("dtx_run", body="SELECT source, dtx, count(*) AS n FROM dtx_run GROUP BY ALL"))
def write_layer(spark, sf_dir):
    """Written twice: the second write replaces the first."""
    out = scratch(spark)
    table = reshape.normalize_dtx(T.dtx_exports(spark, sf_dir))
    layers.write_layer(table, out, "dtx", partition_by="source")
    layers.write_layer(table, out, "dtx", partition_by="source")
    return layers.read_layer(spark, out, "dtx").groupBy("source", "dtx").agg(F.count(F.lit(1)).alias("n"))


@query("read_mart", T.with_sql("grace", body="SELECT absence_ms, grace_ms, count(*) AS n FROM grace WHERE reconnect_gap_ms >= 0 GROUP BY ALL"))
def read_mart(spark, sf_dir):
    from linkloom.operators import marts

    out = scratch(spark)
    layers.write_layer(marts.gracegap_series(reshape.normalize_gracegap(T.gracegap_exports(spark, sf_dir))), out, "gracegap_series")
    return layers.read_mart(spark, out, "gracegap_series", ["absence_ms", "grace_ms"]).select("absence_ms", "grace_ms", "n")


TRIAL_CANDIDATES = ["relay", "host", ""]


def trial_files(spark, sf_dir):
    """Orders as trial exports; the KPI block is nested for some, with two links, and the whole body for others."""
    block = F.struct(
        (F.floor("o_totalprice") % 900 - 20).alias("setupMedianMs"), (F.col("o_custkey") % 101).alias("iceSuccessPct"),
        (F.col("o_custkey") % 3).alias("glareTotal"),
    )
    link = lambda k: F.struct(
        F.lit(k).alias("index"), (F.col("o_orderkey") * k % 700 - 5).alias("setupMs"), (F.col("o_custkey") * k % 90 - 2).alias("rttMs"),
        F.element_at(F.array(*[F.lit(c) for c in TRIAL_CANDIDATES]), (F.col("o_custkey") % 3 + 1).cast("int")).alias("candidateType"),
    )
    nested = F.to_json(F.struct(block.alias("kpis"), F.array(link(1), link(2)).alias("links")))
    tag = F.when(F.col("o_orderstatus") == "F", "cellular-relay").when(F.col("o_orderstatus") == "O", "homeNAT-direct").otherwise("office")
    return T.table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderpriority") == "1-URGENT", F.to_json(block)).otherwise(nested).alias("payload"),
        F.concat(F.lit("wsn-voice-"), tag, F.lit("-trial"), F.col("o_orderkey").cast("string"), F.lit(".json")).alias("source_file"),
    )


T.SQL["trial"] = """SELECT 'wsn-voice-' || cond || '-trial' || o_orderkey || '.json' AS source_file, cond,
  CAST(floor(o_totalprice) AS BIGINT) % 900 - 20 AS setup, o_custkey % 101 AS ice, o_custkey % 3 AS glare FROM (SELECT *,
  CASE o_orderstatus WHEN 'F' THEN 'cellular-relay' WHEN 'O' THEN 'homeNAT-direct' ELSE 'office' END AS cond FROM orders)"""

T.SQL["trial_link"] = """SELECT cond, o_orderkey * k % 700 - 5 AS setup_ms, o_custkey * k % 90 - 2 AS rtt_ms,
  ['relay', 'host', ''][CAST(o_custkey % 3 + 1 AS INTEGER)] AS candidate_type FROM (SELECT *,
  CASE o_orderstatus WHEN 'F' THEN 'cellular-relay' WHEN 'O' THEN 'homeNAT-direct' ELSE 'office' END AS cond FROM orders), (VALUES (1), (2)) AS two(k)
  WHERE o_orderpriority <> '1-URGENT'"""


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.parse_trials(trial_files(spark, sf_dir))


@query("read_trial_exports", f"""SELECT source_file, 'office-' || c_mktsegment[1:1] AS condition, c_nationkey::DOUBLE AS setup_ms, (c_custkey % 4)::INTEGER AS glare,
  CASE WHEN c_custkey % 2 = 1 THEN 1 END::INTEGER AS links, CASE WHEN c_custkey % 2 = 1 THEN c_custkey END::DOUBLE AS rtt_ms
  FROM ({FILES}) JOIN customer USING (c_custkey) WHERE c_custkey % 7 = 6 AND source_file LIKE '%.json'""")
def read_trial_exports(spark, sf_dir):
    """Read from the files, the KPI block nested or whole."""
    found = exports.read_trial_exports(spark, export_root(spark, sf_dir))
    return found.select(
        "source_file", "condition", F.col("kpis.setupMedianMs").alias("setup_ms"), F.col("kpis.glareTotal").alias("glare"),
        F.when(F.col("links").isNotNull(), F.size("links")).alias("links"), F.get("links", F.lit(0))["rttMs"].alias("rtt_ms"),
    )


@query("parse_trials", T.with_sql("trial", body="""SELECT source_file, cond AS condition, setup::DOUBLE AS setup_ms,
  ice::DOUBLE AS ice_pct, glare::INTEGER AS glare FROM trial"""))
def parse_trials(spark, sf_dir):
    return trials(spark, sf_dir).select(
        "source_file", "condition", F.col("kpis.setupMedianMs").alias("setup_ms"),
        F.col("kpis.iceSuccessPct").alias("ice_pct"), F.col("kpis.glareTotal").alias("glare"),
    )


def readings(spark, sf_dir):
    """Customers as metered devices."""
    return T.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("device"), F.lit("power").alias("metric"), F.lit("mW").alias("unit"),
        (F.col("c_nationkey") * 100.5).alias("baseline"), (F.col("c_nationkey") * 100.5 + F.col("c_custkey") % 8 / 4).alias("with_voice"),
    )


@query("read_device_energy", """SELECT c_name AS device, 'power' AS metric, 'mW' AS unit, c_nationkey * 100.5::DOUBLE AS baseline,
  c_nationkey * 100.5::DOUBLE + c_custkey % 8 / 4 AS with_voice FROM customer""")
def read_device_energy(spark, sf_dir):
    out = scratch(spark)
    layers.write_burst_csv(readings(spark, sf_dir), out)
    return layers.read_device_energy(spark, out)


@query("write_burst_csv", "SELECT l_linenumber AS burst, count(*) AS n, sum(CAST(l_quantity AS BIGINT))::BIGINT AS total FROM lineitem GROUP BY 1")
def write_burst_csv(spark, sf_dir):
    out = scratch(spark)
    rows = T.table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("burst"), F.col("l_quantity").cast("bigint").alias("q"))
    layers.write_burst_csv(rows, out)
    back = spark.read.csv(out, schema="burst int, q bigint", header=True)
    return back.groupBy("burst").agg(F.count(F.lit(1)).alias("n"), F.sum("q").alias("total"))
