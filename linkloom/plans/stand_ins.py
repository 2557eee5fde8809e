"""The given tables shaped as telemetry.

Each frame here is a narrow projection of whole tables (no sampling, no shuffle),
so every query over it grows with them. ``SQL`` holds the same projections as
common table expressions for the SQL side of the correctness check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.session import fill_cores

DAY = 86_400_000
START = 1_704_067_200_000  # first instant of the event table, epoch ms
AT = "2024-02-01T00:00:00Z"

# How event types play link states, condition tags and sensing scenarios.
LINK_STATE = {"signup": "detected", "click": "connecting", "purchase": "connected", "error": "failed", "view": "closed"}
CONDITION = {"view": "cellular-relay", "signup": "homeNAT-direct", "click": "office", "purchase": "cellular-direct", "error": ""}
SCENARIO = {"view": "idle", "click": "walk", "purchase": "conv", "signup": "churn", "error": ""}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _map(column: str, values: dict[str, str]) -> Column:
    out = None
    for key, value in values.items():
        test = F.col(column) == key
        out = F.when(test, value) if out is None else out.when(test, value)
    return out


def _sql_map(column: str, values: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " END"


SQL: dict[str, str] = {}


def with_sql(*names: str, body: str, recursive: str = "") -> str:
    """A statement over named projections; ``recursive`` adds walking expressions after them."""
    parts = [f"{n} AS MATERIALIZED ({SQL[n]})" for n in names]
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(parts + ([recursive] if recursive else [])) + "\n" + body


# Events


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events")
    if dict(raw.dtypes)["ts"] == "timestamp":
        millis = F.unix_millis("ts")
    else:
        millis = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    # One element exploded: what is built from k reads a column, where a filter pushed down
    # through plain projections would parse props again for every place k stands in.
    k = F.explode(F.array(F.get_json_object("props", "$.k").cast("int")))
    return raw.select("event_id", "user_id", "event_type", "value", k.alias("k"), millis.alias("t_ms"))


SQL["ev"] = """SELECT event_id, user_id, event_type, value,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, epoch_us(ts) // 1000 AS t_ms FROM events"""


def report_payloads(spark: SparkSession, sf_dir: str, copies: bool = False) -> DataFrame:
    """Events as lines of the report log; ``copies`` delivers each one to three times."""
    ev = fill_cores(events(spark, sf_dir))
    if copies:
        ev = ev.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("k") % 3)))
    else:
        ev = ev.withColumn("copy", F.lit(0))
    k = F.col("k")
    setup = F.when(F.col("value") < 20, F.lit(-1)).otherwise(F.floor(F.col("value") * 10).cast("int"))
    kind = F.element_at(F.array(*map(F.lit, ("host", "srflx", "relay", ""))), F.greatest(k % 5, F.lit(1)))
    first = F.struct(
        F.lit(0).alias("index"), setup.alias("setupMs"), (k * 3 - 10).alias("rttMs"),
        kind.alias("candidateType"), (k + 20).alias("latRawMs"), (k % 3).alias("glare"),
    )
    second = F.struct(
        F.lit(1).alias("index"), (k * 7).alias("setupMs"), F.lit(-1).alias("rttMs"),
        F.lit("host").alias("candidateType"), F.lit(-1).alias("latRawMs"), F.lit(0).alias("glare"),
    )
    body = F.struct(
        _map("event_type", CONDITION).alias("cond"),
        F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("sid"),
        F.col("t_ms").alias("ts"),
        (k % 4).alias("peers"),
        F.struct(
            setup.alias("setupMedianMs"), k.alias("iceSuccessPct"), (k % 2 * 100).alias("relayPct"),
            (k - 10).alias("latRawMedianMs"), (k % 3).alias("glareTotal"),
        ).alias("kpis"),
        F.when(k % 5 == 0, F.array().cast(f"array<{first_type()}>")).otherwise(F.array(first, second)).alias("links"),
    )
    return ev.select(
        F.to_json(body).alias("payload"),
        F.lit("wsn-remote-reports.jsonl").alias("source_file"),
        F.struct(
            F.lit("log").alias("file"), F.col("copy").cast("bigint").alias("block"), F.col("event_id").alias("row")
        ).alias("line"),
    )


def first_type() -> str:
    return "struct<index:int,setupMs:int,rttMs:int,candidateType:string,latRawMs:int,glare:int>"


SQL["rep"] = f"""SELECT event_id, {_sql_map('event_type', CONDITION)} AS cond, 's' || user_id AS sid, t_ms AS ts, k, k % 4 AS peers,
  CASE WHEN value < 20 THEN -1 ELSE CAST(floor(value * 10) AS INTEGER) END AS setup FROM ev"""
SQL["newest"] = """SELECT * FROM rep WHERE cond <> ''
  QUALIFY row_number() OVER (PARTITION BY cond, sid ORDER BY ts DESC, event_id DESC) = 1"""
SQL["links"] = """SELECT cond, sid, peers, 0 AS link_index, setup AS setup_ms, k * 3 - 10 AS rtt_ms,
    CASE k % 5 WHEN 1 THEN 'host' WHEN 2 THEN 'srflx' WHEN 3 THEN 'relay' ELSE '' END AS candidate_type,
    k + 20 AS lat_raw_ms, k % 3 AS glare FROM newest WHERE k % 5 <> 0
  UNION ALL SELECT cond, sid, peers, 1, k * 7, -1, 'host', -1, 0 FROM newest WHERE k % 5 <> 0
  UNION ALL SELECT cond, sid, peers, NULL, NULL, NULL, NULL, NULL, NULL FROM newest WHERE k % 5 = 0"""


def link_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("user_id").alias("session"), (F.col("k") % 3).alias("peer"), "t_ms",
        _map("event_type", LINK_STATE).alias("state"),
    )


SQL["link_state"] = f"""SELECT user_id AS session, k % 3 AS peer, t_ms, {_sql_map('event_type', LINK_STATE)} AS state FROM ev"""


def stat_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters that grow with the event number and wrap, as after a reset."""
    n, k = F.col("event_id"), F.col("k")
    return events(spark, sf_dir).select(
        F.col("user_id").alias("session"), (k % 3).alias("peer"), "t_ms",
        _map("event_type", LINK_STATE).alias("state"),
        F.when(F.col("event_type") != "error", F.col("value") / 1000).alias("rtt_s"),
        (k * 3 - 10).alias("rtt_ms"),
        F.when(k % 10 != 0, n * 37 % 100000).otherwise(F.lit(-1)).alias("jb_count"),
        (n * 41 % 90000 / F.lit(64.0)).alias("jb_delay"),
        (n * 1009 % 1000003).alias("bytes_sent"),
        (n * 13 % 50).alias("packets_received"),
        (k % 7).alias("lost"), (k * 10).alias("received"),
        (F.col("value") / 500).alias("level"),
        F.when(k % 50 == 0, F.lit(0.15)).alias("forced"),
        F.when(k % 25 == 1, F.lit(0.8)).alias("battery"),
    )


SQL["stat"] = f"""SELECT user_id AS session, k % 3 AS peer, t_ms, {_sql_map('event_type', LINK_STATE)} AS state,
  CASE WHEN event_type <> 'error' THEN value / 1000 END AS rtt_s, k * 3 - 10 AS rtt_ms,
  CASE WHEN k % 10 <> 0 THEN event_id * 37 % 100000 ELSE -1 END AS jb_count,
  (event_id * 41 % 90000) / 64.0::DOUBLE AS jb_delay, event_id * 1009 % 1000003 AS bytes_sent,
  event_id * 13 % 50 AS packets_received, k % 7 AS lost, k * 10 AS received, value / 500 AS level,
  CASE WHEN k % 50 = 0 THEN 0.15::DOUBLE END AS forced, CASE WHEN k % 25 = 1 THEN 0.8::DOUBLE END AS battery FROM ev"""


def node_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, kind = F.col("k"), F.col("event_type")
    link = F.struct(
        (k % 2).alias("index"), F.when(k % 9 == 0, "failed").otherwise("connected").alias("state"),
        (k % 50).cast("double").alias("rttMs"), (k % 4).cast("double").alias("lossPct"),
    )
    return events(spark, sf_dir).select(
        F.col("user_id").alias("session"), "t_ms",
        F.when((kind == "error") & (k % 10 == 0), "node-sleep").when(kind == "signup", "speech-start").alias("forced_kind"),
        (k % 5).alias("x"), F.when(k > 90, 8).otherwise(0).alias("y"), F.array(link).alias("links"),
    )


SQL["node"] = """SELECT user_id AS session, t_ms,
  CASE WHEN event_type = 'error' AND k % 10 = 0 THEN 'node-sleep' WHEN event_type = 'signup' THEN 'speech-start' END AS forced,
  k % 5 AS x, CASE WHEN k > 90 THEN 8 ELSE 0 END AS y, k % 2 AS i, CASE WHEN k % 9 = 0 THEN 'failed' ELSE 'connected' END AS s,
  CAST(k % 50 AS DOUBLE) AS rtt, CAST(k % 4 AS DOUBLE) AS loss,
  row_number() OVER (PARTITION BY user_id ORDER BY t_ms) AS rn FROM ev"""


def run_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("user_id").alias("run"), F.col("t_ms").alias("t"),
        (F.col("event_id") * 13 % 500).alias("pkts"), (F.col("k") % 4).alias("peers"),
    )


SQL["run_sample"] = "SELECT user_id AS run, t_ms AS t, event_id * 13 % 500 AS pkts, k % 4 AS peers FROM ev"


def run_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = F.lit(START) + F.col("c_custkey") % 20 * DAY
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("run"), out.alias("departed"), (out + 5 * DAY).alias("returned")
    )


SQL["mark"] = f"""SELECT c_custkey AS run, {START} + c_custkey % 20 * {DAY} AS departed,
  {START} + c_custkey % 20 * {DAY} + {5 * DAY} AS returned FROM customer"""


def ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    return events(spark, sf_dir).select(
        F.col("user_id").alias("node"), "t_ms", F.array(k % 3, k % 2 + 3).alias("in_range")
    )


SQL["tick"] = "SELECT user_id AS node, t_ms, [k % 3, k % 2 + 3] AS in_range FROM ev"


# Exports


def _exports(df: DataFrame, record_type: str, source_file: Column, body: Column) -> DataFrame:
    # One element exploded, as above: a parse of the payload reads a column. Merged into the parse,
    # the body would be built by expressions that Spark does not compile.
    return fill_cores(df).select(
        F.explode(F.array(F.to_json(body))).alias("payload"), source_file.alias("source_file"),
        F.lit(record_type).alias("record_type"), F.lit(None).cast("int").alias("peer_count"),
        F.lit(AT).alias("ingested_at"),
    )


def _file(record_type: str, key: str) -> Column:
    return F.concat(F.lit(f"wsn-{record_type}-"), F.col(key).cast("string"), F.lit(".json"))


def voice_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per line item, with two clients."""
    line = table(spark, sf_dir, "lineitem")
    n, flag = F.col("l_linenumber") + 1, F.col("l_returnflag")
    setup = F.floor(F.col("l_extendedprice") / 100).cast("int")
    quantity = F.col("l_quantity").cast("int")

    def client(name: str, peers: Column, setup: Column, quantity: Column) -> Column:
        return F.struct(
            F.lit(name).alias("client"), peers.alias("peers"),
            F.struct(
                (peers - 2).alias("links"), setup.alias("setupMedianMs"), (setup * 2).alias("setupP95Ms"),
                F.round(F.col("l_discount") * 100).cast("int").alias("iceSuccessPct"),
                F.round(F.col("l_tax") * 100).cast("int").alias("relayPct"),
                F.struct(
                    F.lit(1).alias("host"), (flag == "A").cast("int").alias("srflx"), (flag == "R").cast("int").alias("relay")
                ).alias("candidateMix"),
                (quantity + 40).alias("latRawMedianMs"), (F.col("l_partkey") % 4).cast("int").alias("glareTotal"),
            ).alias("kpis"),
            F.when(flag != "N", quantity + 0.5).alias("meanUpKbps"),
            F.struct((n * 10).alias("suppressedPct")).alias("sense"),
        )

    other = F.when(quantity < 10, F.lit(-1)).otherwise(setup + 7)
    body = F.struct(
        n.alias("N"), F.array(client("wsn0", n - 1, setup, quantity), client("wsn1", n, other, quantity + 1)).alias("perClient")
    )
    source = F.concat(
        F.lit("wsn-voice-N"), n.cast("string"), F.lit("-summary-"),
        F.lpad(F.col("l_orderkey").cast("string"), 12, "0"), F.lit(".json"),
    )
    return _exports(line, "voice", source, body)


SQL["client"] = """SELECT source_file, n_peers, client, peers, peers - 2 AS links, setup AS setup_median_ms, setup * 2 AS setup_p95_ms,
    CAST(round(l_discount * 100) AS INTEGER) AS ice_success_pct, CAST(round(l_tax * 100) AS INTEGER) AS relay_pct,
    quantity + 40 AS lat_raw_median_ms, l_partkey % 4 AS glare_total,
    CASE WHEN l_returnflag <> 'N' THEN quantity0 + 0.5::DOUBLE + bump END AS mean_up_kbps, n_peers * 10 AS suppressed_pct,
    CASE l_returnflag WHEN 'R' THEN 'relay' WHEN 'A' THEN 'srflx' ELSE 'host' END AS candidate_type
  FROM (SELECT 'wsn-voice-N' || (l_linenumber + 1) || '-summary-' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '.json' AS source_file,
      l_linenumber + 1 AS n_peers, who.client, l_linenumber + who.bump AS peers, who.bump,
      CASE WHEN who.bump = 0 THEN CAST(floor(l_extendedprice / 100) AS INTEGER)
        WHEN CAST(l_quantity AS INTEGER) < 10 THEN -1 ELSE CAST(floor(l_extendedprice / 100) AS INTEGER) + 7 END AS setup,
      CAST(l_quantity AS INTEGER) AS quantity0, CAST(l_quantity AS INTEGER) + who.bump AS quantity,
      l_discount, l_tax, l_partkey, l_returnflag
    FROM lineitem, (VALUES ('wsn0', 0), ('wsn1', 1)) who(client, bump))"""


def mobility_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = lambda c: F.struct(c.alias("ms"))
    teardown = F.when(F.col("o_orderstatus") == "P", F.lit(-1)).otherwise(F.col("o_custkey") % 500 + 5000)
    reconnect = F.when(F.col("o_orderpriority") != "5-LOW", F.floor("o_totalprice") % 3000)
    body = F.struct(
        F.struct(
            ms(F.col("o_custkey") % 2000).alias("initialForm"), ms(teardown).alias("teardown"), ms(reconnect).alias("reconnect")
        ).alias("phases")
    )
    return _exports(table(spark, sf_dir, "orders"), "mobility", _file("mobility", "o_orderkey"), body)


SQL["cycle"] = """SELECT 'wsn-mobility-' || o_orderkey || '.json' AS source_file, o_custkey % 2000 AS form_ms,
  CASE WHEN o_orderstatus = 'P' THEN -1 ELSE o_custkey % 500 + 5000 END AS teardown_ms,
  CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(floor(o_totalprice) AS BIGINT) % 3000 END AS reconnect_ms FROM orders"""


def audiogap_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    stop, reconnect = F.col("o_custkey") % 25, F.floor("o_totalprice") % 900 + 2300
    point = lambda i: F.struct(
        (F.col("o_orderkey") * 1000 + i * 200).alias("t"), ((F.col("o_custkey") + i * 7) % 50).alias("pkts")
    )
    status = F.col("o_orderstatus")
    body = F.struct(
        F.when(status == "F", True).when(status == "O", False).alias("valid"),
        stop.alias("audioStopAfterOutMs"), reconnect.alias("reconnectAudioGapMs"),
        (stop + reconnect + 9000).alias("totalSilenceMs"), F.array(*[point(i) for i in range(3)]).alias("series"),
    )
    return _exports(table(spark, sf_dir, "orders"), "audiogap", _file("audiogap", "o_orderkey"), body)


SQL["gap"] = """SELECT *, stop_ms + reconnect_ms + 9000 AS total_silence_ms FROM (
  SELECT 'wsn-audiogap-' || o_orderkey || '.json' AS source_file, coalesce(o_orderstatus = 'F', false) AS valid,
  o_custkey % 25 AS stop_ms, CAST(floor(o_totalprice) AS BIGINT) % 900 + 2300 AS reconnect_ms FROM orders)"""


def gracegap_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.struct(
        F.when(F.col("l_linestatus") == "F", 6000).otherwise(12000).alias("absenceMs"),
        (F.col("l_linenumber") * 1000).alias("graceMs"),
        (F.floor("l_extendedprice") % 3000 - 100).alias("reconnectGapMs"),
        (F.col("l_quantity") / 8 - 1).alias("holdKbps"),
        (F.col("l_quantity").cast("int") - 15).alias("stopAfterOutMs"),
    )
    return _exports(table(spark, sf_dir, "lineitem"), "gracegap", _file("gracegap", "l_orderkey"), body)


SQL["grace"] = """SELECT 'wsn-gracegap-' || l_orderkey || '.json' AS source_file,
  CASE WHEN l_linestatus = 'F' THEN 6000 ELSE 12000 END AS absence_ms, l_linenumber * 1000 AS grace_ms,
  CAST(floor(l_extendedprice) AS BIGINT) % 3000 - 100 AS reconnect_gap_ms, l_quantity / 8 - 1 AS hold_kbps,
  CAST(l_quantity AS INTEGER) - 15 AS stop_ms FROM lineitem"""


def dtx_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    body = F.struct(
        F.when(flag == "R", "speech").otherwise("tone").alias("source"),
        F.when(flag != "N", F.col("l_linestatus") == "O").alias("dtx"),
        (F.col("l_quantity") / 2 - 5 + F.col("l_linenumber") / 8).alias("uplinkKbps"),
    )
    return _exports(table(spark, sf_dir, "lineitem"), "dtx", _file("dtx", "l_orderkey"), body)


SQL["dtx_run"] = """SELECT 'wsn-dtx-' || l_orderkey || '.json' AS source_file,
  CASE WHEN l_returnflag = 'R' THEN 'speech' ELSE 'tone' END AS source, l_returnflag <> 'N' AND l_linestatus = 'O' AS dtx,
  l_quantity / 2 - 5 + l_linenumber / 8::DOUBLE AS uplink_kbps FROM lineitem"""


def sensing_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per event: client A with one report of k % 3 readings, client B without."""
    k = F.col("k")
    reading = lambda i: F.struct(
        i.alias("index"), F.lit("connected").alias("state"), (k + i).alias("rttMs"), (k % 5).alias("jitterMs"),
        (k % 8 / 4).alias("lossPct"), (k * 2).alias("upKbps"),
    )
    report = F.struct(
        F.col("t_ms").alias("t"), F.col("event_type").alias("kind"),
        F.struct(k.alias("x"), F.floor("value").cast("int").alias("y")).alias("pos"),
        (k % 3).alias("neighbors"),
        F.slice(F.array(reading(F.lit(0)), reading(F.lit(1))), 1, k % 3).alias("links"),
        F.lit(0.5).alias("energy"), F.lit("").alias("note"),
    )
    stats = lambda share: F.struct(share.alias("suppressedPct")).alias("stats")
    clients = F.struct(
        F.struct(stats(k), F.array(report).alias("reports")).alias("A"), F.struct(stats(100 - k)).alias("B")
    )
    body = F.struct(
        _map("event_type", SCENARIO).alias("scenario"),
        F.struct((k % 5).alias("move"), (k % 3).alias("link")).alias("kindCounts"),
        clients.alias("clients"),
    )
    return _exports(events(spark, sf_dir), "sensing", _file("sensing", "event_id"), body)


SQL["sense"] = f"""SELECT 'wsn-sensing-' || event_id || '.json' AS source_file, {_sql_map('event_type', SCENARIO)} AS scenario,
  k, t_ms, event_type, value FROM ev"""


# Line items as links and offers


def link_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, flag = F.col("l_linenumber"), F.col("l_returnflag")
    up = flag != "N"
    kinds = F.array(*map(F.lit, ("host", "srflx", "prflx", "relay")))
    raw = F.when(up & (F.col("l_discount") >= 0.02), F.col("l_quantity").cast("int") * 3).otherwise(F.lit(-1))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("session"),
        F.when(up, n * 1000).otherwise(F.lit(-1)).alias("connected_ms"),
        F.when(up, F.floor(F.col("l_extendedprice") / 100)).otherwise(F.lit(-1)).alias("setup_ms"),
        (~up & (F.col("l_linestatus") == "F")).alias("failed"),
        F.when(n <= 4, F.element_at(kinds, F.least(n, F.lit(4)))).otherwise("").alias("candidate_type"),
        raw.alias("lat_raw_ms"), F.when(raw >= 0, raw + 12).otherwise(F.lit(-1)).alias("lat_cal_ms"),
        (F.col("l_suppkey") % 3).alias("glare"),
    )


SQL["link"] = """SELECT *, CASE WHEN lat_raw_ms >= 0 THEN lat_raw_ms + 12 ELSE -1 END AS lat_cal_ms FROM (
  SELECT l_partkey AS session, l_returnflag <> 'N' AS up, l_returnflag = 'N' AND l_linestatus = 'F' AS failed,
  CASE WHEN l_returnflag <> 'N' THEN CAST(floor(l_extendedprice / 100) AS BIGINT) ELSE -1 END AS setup_ms,
  CASE l_linenumber WHEN 1 THEN 'host' WHEN 2 THEN 'srflx' WHEN 3 THEN 'srflx' WHEN 4 THEN 'relay' ELSE '' END AS kind,
  CASE WHEN l_returnflag <> 'N' AND l_discount >= 0.02 THEN CAST(l_quantity AS INTEGER) * 3 ELSE -1 END AS lat_raw_ms,
  l_suppkey % 3 AS glare FROM lineitem)"""


# Embeddings as recordings and levels


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One recording per vector; the microphone hears it later, at half strength."""
    vectors = fill_cores(table(spark, sf_dir, "embeddings"))
    sample = vectors.select("vec_id", "embedding", F.posexplode("embedding").alias("pos", "x"))
    delay = (F.col("vec_id") % 7 + 2).cast("int")
    heard = F.try_element_at("embedding", F.col("pos") - delay + 1)
    mic = F.when(F.col("pos") >= delay, heard * F.lit(0.5).cast("float")).otherwise(F.lit(0.0).cast("float"))
    return sample.select(
        F.col("vec_id").alias("recording_id"), F.col("pos").cast("bigint").alias("frame"),
        F.col("x").alias("ref"), mic.cast("float").alias("mic"),
    )


SQL["frame"] = """SELECT vec_id AS recording_id, pos - 1 AS frame, CAST(embedding[pos] AS DOUBLE) AS ref,
  CASE WHEN pos - 1 >= vec_id % 7 + 2 THEN CAST(embedding[pos - (vec_id % 7 + 2)] AS DOUBLE) * 0.5 ELSE 0.0::DOUBLE END AS mic
  FROM (SELECT vec_id, embedding, unnest(generate_series(1, len(embedding))) AS pos FROM embeddings)"""


def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames(spark, sf_dir).select(
        F.col("recording_id").alias("stream"), (F.col("frame") * 50).alias("t_ms"),
        F.abs(F.col("ref").cast("double")).alias("rms"),
    )


SQL["level"] = "SELECT recording_id AS stream, frame * 50 AS t_ms, abs(ref) AS rms FROM frame"
