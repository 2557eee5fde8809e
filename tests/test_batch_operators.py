"""Ingest, parsing, marts on literal payloads."""

import json

import pytest
from pyspark.sql import functions as F

from linkloom import schemas
from linkloom.functions.percentiles import exact_percentiles, percentile_interpolated, percentile_nearest_rank
from linkloom.functions import scalars as S
from linkloom.operators import marts, parity, quality, reshape, series
from linkloom.plans import refresh, stand_ins
from linkloom.sources import exports, layers, reports

AT = "2026-01-01T00:00:00Z"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def raw(spark, *records):
    """(source_file, record_type, body) triples as landed exports."""
    data = [(json.dumps(b), f, t, None, AT) for f, t, b in records]
    return spark.createDataFrame(data, schemas.RAW_JSON)


def stream(spark, *bodies):
    data = [
        (b if isinstance(b, str) else json.dumps(b), "wsn-remote-reports.jsonl", ("f", 0, i))
        for i, b in enumerate(bodies)
    ]
    lines = spark.createDataFrame(
        data, "payload string, source_file string, line struct<file:string,block:bigint,row:bigint>"
    )
    return reports.prepare_lines(lines, AT)


# Ingest


@pytest.mark.parametrize("name, kind, peers", [
    ("wsn-audiogap-2026-01.json", "audiogap", None),
    ("wsn-voice-N4-summary-2026.json", "voice", 4),
    ("wsn-remote-reports.jsonl", "realnet", None),
    ("energy-screenshots", None, None),
    ("wsn-unknown-1.json", None, None),
])
def test_names(spark, name, kind, peers):
    got = one(spark, S.record_type(F.lit(name)).alias("k"), S.peer_count(F.lit(name)).alias("n"))
    assert tuple(got) == (kind, peers)


def test_discover_and_land(spark, tmp_path):
    (tmp_path / "wsn-voice-N3-summary-a.json").write_text('{\n"N": 3\n}')
    (tmp_path / "wsn-audiogap-b.json").write_text('{\n"valid": true\n}')
    (tmp_path / "wsn-junk-c.json").write_text("{}")
    (tmp_path / "wsn-remote-reports.jsonl").write_text('{"sid":"A","ts":1}\n{"sid":"B","ts":1}\n{"sid":"A","ts":1}\n  \n')
    (tmp_path / "notes.txt").write_text("x")
    names = [r.source_file for r in exports.discover_exports(spark, str(tmp_path)).collect()]
    assert names == ["wsn-audiogap-b.json", "wsn-voice-N3-summary-a.json"]
    landed = exports.land_json_exports(spark, str(tmp_path), AT)
    assert {(r.source_file, r.record_type, r.peer_count) for r in landed.collect()} == {
        ("wsn-voice-N3-summary-a.json", "voice", 3), ("wsn-audiogap-b.json", "audiogap", None)}
    log = reports.land_jsonl_stream(spark, str(tmp_path / "wsn-remote-reports.jsonl"), AT)
    assert sorted(r.sid for r in log.collect()) == ["A", "B"]
    assert reports.land_jsonl_stream(spark, str(tmp_path / "none.jsonl"), AT).count() == 0


def test_redelivery_needs_both_keys(spark):
    lines = stream(spark, '{"a":1}', '{"a":2}', '{"a":1}', '{"sid":"s","ts":1,"cond":"x"}',
                   '{"sid":"s","ts":1,"cond":"y"}', '{"sid":"s","ts":1,"cond":"x"}')
    assert reports.drop_redelivered(lines).count() == 4


def test_frame_events(spark):
    lines = spark.createDataFrame(
        [('{"sid":"abc","cond":"c"}',), ('{"cond":"home"}',), ('{"sid":"","cond":""} ',), ("   ",)], "payload string")
    assert [r.partition_key for r in reports.frame_events(lines).orderBy("partition_key").collect()] == ["abc", "home", "unknown"]


def test_publish_keeps_order(spark, tmp_path):
    lines = spark.createDataFrame([(json.dumps({"sid": s, "ts": t}),) for t in (3, 1, 2) for s in "ab"], "payload string")
    reports.publish_keyed_events(reports.frame_events(lines), str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out")).where("partition_key = 'a'")
    assert [json.loads(r.body)["ts"] for r in back.coalesce(1).collect()] == [1, 2, 3]


def test_quarantine(spark):
    df = spark.createDataFrame([('{"a":1,"new":2}',), ('{"a":24.75}',), ("oops",)], "payload string")
    from pyspark.sql.types import StructType
    good, bad = reports.quarantine_malformed(df, StructType.fromDDL("a int"))
    assert [r.r.a for r in good.collect()] == [1]
    assert rows(bad) == [("oops", "not json"), ('{"a":24.75}', "type mismatch")]


def test_layers_and_csv(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "n int, s string")
    layers.write_layer(df, str(tmp_path), "t")
    assert [r.n for r in layers.read_mart(spark, str(tmp_path), "t", "n").collect()] == [1, 2]
    layers.write_burst_csv(df, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 2
    path = tmp_path / "e.csv"
    path.write_text("device,metric,unit,baseline,with_voice\nlaptop,power,mW,4685,5622\nphone,cpu,%,17.2,21.5\n")
    energy = series.series_device_energy(layers.read_device_energy(spark, str(path)))
    assert [r.delta for r in energy.orderBy("device").collect()] == [937.0, 4.3]


def test_trials(spark):
    files = spark.createDataFrame([
        (json.dumps({"kpis": {"setupMedianMs": 5}, "links": [{"index": 0}]}), "wsn-voice-cellular-relay-trial1.json"),
        (json.dumps({"setupMedianMs": 7, "links": []}), "wsn-voice-homeNAT-trial2.json"),
        ("{}", "wsn-voice-N2-summary-x.json")], "payload string, source_file string")
    got = exports.parse_trials(files).select("condition", "kpis.setupMedianMs")
    assert rows(got) == [("cellular-relay", 5.0), ("homeNAT", 7.0)]


# Reports and links


def report(sid, ts, cond="cellular-relay", links=({"index": 0, "setupMs": 5714, "rttMs": 101, "candidateType": "relay", "glare": 1},), **more):
    return {"cond": cond, "sid": sid, "ts": ts, "links": list(links), **more}


def test_newest_report_links(spark):
    two = [{"index": 0, "setupMs": 1}, {"index": 1, "setupMs": 2}]
    lines = stream(spark, report("s", 100, links=two), report("s", 200), report("t", 1, links=two),
                   report("e", 1, links=[]), report("n", 9, cond=None), report("m", 9, cond=""))
    got = reshape.explode_realnet_links(lines).select("session_id", "link_index", "setup_ms", "rtt_ms")
    assert rows(got) == [("e", None, None, None), ("s", 0, 5714.0, 101.0), ("t", 0, 1.0, None), ("t", 1, 2.0, None)]


def test_newest_report_ties_and_missing_ts(spark):
    lines = stream(spark, report("s", 5, peers=1), report("s", 5, peers=2), report("q", None, peers=3), report("q", None, peers=4))
    got = reshape.parsed_reports(lines).select("sid", "r.peers")
    assert rows(got) == [("q", 4), ("s", 2)]


def client(name="a", mix=(1, 0, 0), **kpis):
    host, srflx, relay = mix
    return {"client": name, "peers": 1, "kpis": {"candidateMix": {"host": host, "srflx": srflx, "relay": relay}, **kpis}}


def voice(n, *clients):
    return {"N": n, "perClient": list(clients)}


def test_voice_and_link_fact(spark):
    json_rows = raw(spark, ("wsn-voice-N2-summary-1.json", "voice", voice(2, client("a", setupMedianMs=300), client("b", (0, 0, 2)), client("c", (0, 0, 0)))))
    flat = reshape.flatten_voice_kpis(json_rows).select("client", "candidate_type", "link_index")
    assert rows(flat) == [("a", "host", None), ("b", "relay", None), ("c", "host", None)]
    known = reshape.voice_client_summary(json_rows).select("client", "candidate_known")
    assert rows(known) == [("a", True), ("b", True), ("c", False)]
    fact = reshape.build_link_fact(json_rows, stream(spark, report("s", 1)))
    assert fact.columns == schemas.LINK_FACT.names and fact.count() == 4


def test_run_tables(spark):
    json_rows = raw(
        spark,
        ("m1", "mobility", {"phases": {"initialForm": {"ms": 800}, "teardown": {"ms": 20}, "reconnect": {"ms": 2400}}}),
        ("m2", "mobility", {"phases": {"initialForm": {"ms": 800}, "teardown": {"ms": -1}, "reconnect": {"ms": 25}}}),
        ("m3", "mobility", {"phases": {}}),
        ("a1", "audiogap", {"valid": True, "audioStopAfterOutMs": 20}),
        ("a2", "audiogap", {"audioStopAfterOutMs": 20, "series": [{"t": 1, "pkts": 3}, {"t": 2, "pkts": 4}]}),
        ("d1", "dtx", {"source": "tone", "uplinkKbps": 31.5}),
        ("s1", "sensing", {"scenario": "idle", "kindCounts": {"link": 2}, "clients": {
            "A": {"stats": {"suppressedPct": 91}, "reports": [{"t": 1, "kind": "move", "links": [{"index": 3, "rttMs": 4}, {"index": 5}]}, {"t": 2, "kind": "heartbeat", "links": []}]},
            "B": {"stats": {"suppressedPct": 89}}}}),
    )
    tables = reshape.build_experiment_tables(json_rows)
    assert rows(tables["mobility"].select("source_file", "complete_case")) == [("m1", True), ("m2", False), ("m3", False)]
    assert rows(marts.mobility_skipped(tables["mobility"])) == [(2,)]
    assert rows(tables["audiogap"].select("valid")) == [(False,), (True,)]
    assert rows(tables["dtx"].select("dtx", "uplink_kbps")) == [(False, 31.5)]
    assert rows(tables["sensing"].select("client", "suppressed_pct")) == [("A", 91.0), ("B", 89.0)]
    assert rows(reshape.explode_series(json_rows).select("pos", "t", "pkts")) == [(0, 1, 3), (1, 2, 4)]
    sense = reshape.explode_sense_reports(json_rows)
    assert rows(sense.select("t", "kind")) == [(1, "move"), (2, "heartbeat")]
    assert rows(reshape.explode_link_readings(sense).select("t", "index")) == [(1, 3), (1, 5), (2, None)]
    mix = marts.sensing_report_mix(json_rows).select("scenario", "kind", "reports_per_run")
    assert rows(mix) == [("idle", "link", 2.0)]


def test_made_payloads_are_parsed_as_columns(spark, tmp_path):
    """A body merged into the parse would be built without compiled code."""
    spark.createDataFrame(
        [(7, 1, 2, 30.0, 900.5, 0.02, 0.04, "R", "F"), (7, 1, 2, 5.0, 10.0, 0.0, 0.0, "N", "O"), (7, None, None, None, None, None, None, None, None)],
        "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    made = stand_ins.dtx_exports(spark, str(tmp_path))
    dtx = reshape.normalize_dtx(made)
    parses = [line for line in dtx._jdf.queryExecution().executedPlan().toString().splitlines() if "from_json(" in line]
    assert parses and not any("StructsToJson" in line or "to_json" in line for line in parses)
    assert rows(made.select("payload")) == [
        ('{"source":"speech","dtx":false,"uplinkKbps":10.25}',), ('{"source":"tone","uplinkKbps":-2.25}',), ('{"source":"tone"}',)]
    assert rows(dtx.select("source_file", "source", "dtx", "uplink_kbps")) == [
        ("wsn-dtx-7.json", "speech", False, 10.25), ("wsn-dtx-7.json", "tone", False, -2.25), ("wsn-dtx-7.json", "tone", False, None)]
    assert reshape.voice_client_summary(stand_ins.voice_exports(spark, str(tmp_path))).count() == 6


def test_tables_written_at_once(spark, tmp_path):
    root = str(tmp_path / "lake")
    layers.write_layers({f"t{i}": spark.range(i).toDF("n") for i in range(4)}, root)
    assert [layers.read_layer(spark, root, f"t{i}").count() for i in range(4)] == [0, 1, 2, 3]
    layers.write_layers({}, root)
    bad = spark.range(1).select(F.raise_error(F.lit("no such run")).cast("long").alias("n"))
    with pytest.raises(Exception, match="no such run"):
        layers.write_layers({"t1": spark.range(5).toDF("n"), "t2": bad}, root)
    assert layers.read_layer(spark, root, "t1").count() == 5


# Marts


def test_kpi_vs_n_takes_newest_run(spark):
    def c(name, **k):
        return client(name, **{**dict(setupMedianMs=100, setupP95Ms=100, iceSuccessPct=100, relayPct=0, latRawMedianMs=70, glareTotal=1, links=2), **k})
    json_rows = raw(
        spark,
        ("wsn-voice-N2-summary-1.json", "voice", voice(2, c("a", setupMedianMs=9))),
        ("wsn-voice-N2-summary-2.json", "voice", voice(2, c("a", setupMedianMs=358), c("b", setupMedianMs=595), c("c", setupMedianMs=-1, links=-1))),
    )
    silver = reshape.voice_client_summary(json_rows)
    got = marts.kpi_vs_n(silver).first()
    assert (got.setup_median_ms, got.setup_median_ms_raw, got.conn_links, got.glare_total, got.uplink_kbps) == (477.0, 476.5, 4, 3, None)
    assert marts.newest_run_per_n(silver).count() == 3


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def newest_runs(spark):
    """Two runs of size 2, one of a size whose newest run has no client, one without a size."""
    return raw(
        spark,
        ("wsn-voice-N2-summary-1.json", "voice", voice(2, client("a", setupMedianMs=9))),
        ("wsn-voice-N2-summary-2.json", "voice", voice(2, client("a", setupMedianMs=358), client("b", setupMedianMs=595))),
        ("wsn-voice-N3-summary-1.json", "voice", voice(3, client("a", setupMedianMs=7))),
        ("wsn-voice-N3-summary-2.json", "voice", voice(3)),
        ("wsn-voice-summary-3.json", "voice", '{"perClient": [{"client": "a"}]}'),
        ("wsn-voice-N2-summary-9.json", "voice", "{"),
    )


def test_newest_runs_are_picked_before_parsing(spark):
    json_rows = newest_runs(spark)
    silver = reshape.voice_client_summary(json_rows)
    newest = marts.newest_run_per_n(silver, reshape.voice_runs(json_rows))
    assert rows(newest.select("n_peers", "source_file", "client")) == [
        (2, "wsn-voice-N2-summary-2.json", "a"), (2, "wsn-voice-N2-summary-2.json", "b"), (3, "wsn-voice-N3-summary-1.json", "a")]
    assert rows(newest) == rows(marts.newest_run_per_n(silver))
    assert rows(marts.kpi_vs_n(silver, reshape.voice_runs(json_rows))) == rows(marts.kpi_vs_n(silver))
    plan = plan_of(newest)
    assert plan.rindex("LeftSemi") > plan.index("Generate")  # a join lies below the parsing


def written(spark, tmp_path, df):
    """Rows that the optimizer cannot fold into constants."""
    df.write.parquet(str(tmp_path / "raw"))
    return spark.read.parquet(str(tmp_path / "raw"))


def test_a_filter_on_a_parsed_field_parses_no_payload_again(spark, tmp_path):
    json_rows = written(spark, tmp_path, raw(spark, ("d", "dtx", {"source": "tone", "dtx": True, "uplinkKbps": 3.5})))
    tables = reshape.build_experiment_tables(json_rows)
    for made in (marts.gracegap_series(tables["gracegap"]), marts.mobility_cycles(tables["mobility"]), marts.audiogap(tables["audiogap"]),
                 marts.sensing_suppression(tables["sensing"]), reshape.filter_measured(tables["dtx"], "uplink_kbps")):
        assert plan_of(made).count("from_json(") == 1


def test_references_read_a_payload_once(spark, tmp_path):
    json_rows = written(spark, tmp_path, raw(spark, ("d", "dtx", {"source": "tone", "dtx": True, "uplinkKbps": 3.5})))
    for name in ("dtx_uplink", "gracegap_series", "mobility_cycles", "audiogap", "sensing_suppression"):
        for made in (parity.MART_REFERENCES[name][0](json_rows), parity.FULL_REFERENCES[name](json_rows)):
            plan = plan_of(made)
            assert plan.count("get_json_object(payload") + plan.count("json_tuple(payload") + plan.count("from_json(StructField(phases") == 1, name


def test_references_read_numbers_in_quotes(spark):
    json_rows = raw(
        spark, ("m", "mobility", {"phases": {"initialForm": {"ms": "10"}, "teardown": {"ms": 20}, "reconnect": {"ms": 30.5}}}),
        ("m2", "mobility", {"phases": {"initialForm": {"ms": 1}, "teardown": 5, "reconnect": {"ms": 7}}}), ("m3", "mobility", {"phases": {}}),
        ("a", "audiogap", {"valid": "true", "reconnectAudioGapMs": "2500"}), ("a2", "audiogap", {"valid": False, "reconnectAudioGapMs": 1}),
        ("d", "dtx", {"source": "tone", "uplinkKbps": "4.5"}), ("d2", "dtx", {"source": "tone", "dtx": None, "uplinkKbps": -1}))
    assert rows(parity.reference_mobility(json_rows)) == [("all", 30.5)]
    assert rows(parity._mobility_columns(json_rows).select("complete_cycles", "form_median_ms_raw", "reconnect_max_ms")) == [(1, 10.0, 30.5)]
    assert rows(parity.reference_audiogap(json_rows)) == [("all", 2500.0)]
    assert rows(parity._audiogap_columns(json_rows).select("valid_runs", "reconnect_max_ms")) == [(1, 2500.0)]
    assert rows(parity.reference_dtx(json_rows)) == [("tone/false", 4.5)]


def test_runs_and_shares_of_sensing_are_counted_side_by_side(spark, tmp_path):
    body = lambda *shares: {"scenario": "idle", "clients": {f"c{i}": {"stats": {"suppressedPct": v}} for i, v in enumerate(shares)}}
    json_rows = raw(spark, ("s1", "sensing", body(10, 20)), ("s1", "sensing", body(10, None)), ("s2", "sensing", body(40)), (None, "sensing", body(70)), ("s4", "sensing", body()))
    expected = ("idle", 2, 20.0)  # of 10, 20, 10, 40 and 70
    mart = marts.sensing_suppression(reshape.normalize_sensing(json_rows))
    assert rows(mart.select("scenario", "trials", "suppression_median_pct_raw")) == [expected]
    # the reference counts a run without a name as one
    assert rows(parity._sensing_columns(json_rows).select("scenario", "trials", "suppression_median_pct_raw")) == [("idle", 3, 20.0)]
    assert plan_of(marts.sensing_suppression(reshape.normalize_sensing(written(spark, tmp_path, json_rows)))).count("Relation") == 1


def test_newest_runs_of_mart_and_reference_from_one_making(spark):
    json_rows = newest_runs(spark)
    silver = reshape.voice_client_summary(json_rows)
    for sizes, reference in ((parity.sized, parity.reference_kpi_vs_n), (parity.sized_with_clients, parity._kpi_columns)):
        runs = parity.newest_by_both_sizes(sizes(json_rows))
        assert rows(marts.kpi_vs_n(silver, runs)) == rows(marts.kpi_vs_n(silver, reshape.voice_runs(json_rows)))
        assert rows(reference(json_rows, runs)) == rows(reference(json_rows))
    odd = raw(spark, ("f1", "voice", {"N": "3", "perClient": [None]}), ("f2", "voice", {"N": 4, "perClient": [1, 2]}), ("f3", "voice", {"N": 5, "perClient": []}), ("f4", "voice", {"N": 6}))
    assert rows(parity.sized_with_clients(odd).select("source_file", "_n")) == [("f1", 3), ("f2", 4), ("f3", None), ("f4", None)]


def test_references_read_clients_of_newest_runs_only(spark):
    json_rows = newest_runs(spark)
    assert rows(parity.reference_kpi_vs_n(json_rows)) == [("2", 476.5), ("3", None), (None, None)]
    assert rows(parity._kpi_columns(json_rows).select("n_peers", "setup_median_ms_raw")) == [(2, 476.5), (3, 7.0)]
    for df in (parity.reference_kpi_vs_n(json_rows), parity._kpi_columns(json_rows)):
        plan = plan_of(df)
        assert plan.rindex("LeftSemi") > plan.index("Generate")


def test_written_exports_are_spread_and_found(spark, tmp_path):
    made = spark.range(300).coalesce(1).select(
        F.concat(F.lit("wsn-dtx-"), F.col("id").cast("string"), F.lit(".json")).alias("source_file"),
        F.concat(F.lit('{"é": '), F.col("id").cast("string"), F.lit("}\n")).alias("payload"))
    root = str(tmp_path / "out")
    assert exports.write_exports(made.unionByName(made.limit(1)), root) == 301
    assert len({p.parent for p in (tmp_path / "out").rglob("*.json")}) > 100
    (tmp_path / "out" / "wsn-dtx-flat.json").write_text("{}")
    (tmp_path / "out" / "_wsn-dtx-own.json").write_text("{}")
    (tmp_path / "out" / "wsn-dtx-empty.json").write_text("")
    got = {r.source_file: r.payload for r in exports.land_json_exports(spark, root, AT).collect()}
    assert got == {r.source_file: r.payload for r in made.collect()} | {"wsn-dtx-flat.json": "{}"}
    assert [r.source_file for r in exports.discover_exports(spark, root).collect()] == sorted(got)
    assert exports.land_json_exports(spark, root, AT, glob="wsn-dtx-{1,2}.json").count() == 2


def test_bands_build_banded_marts_only(spark, tmp_path, monkeypatch):
    from linkloom.plans.catalog import checks, load
    load()
    built = []
    for name in ("kpi_vs_n", "mobility_cycles", "audiogap", "sensing_suppression", "realnet_conditions", "gracegap_series", "dtx_uplink"):
        monkeypatch.setattr(marts, name, lambda *a, name=name: built.append(name) or spark.createDataFrame(
            [(2, 70.0, 100.0, 2500.0)], "n_peers int, m2e_ms double, ice_success_pct double, reconnect_median_ms double"))
    monkeypatch.setattr(checks.T, "table", lambda spark_, sf_dir, name: spark.createDataFrame([], {
        "lineitem": "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string",
        "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string",
        "events": "event_id long, ts timestamp, user_id long, event_type string, value double, props string"}[name]))
    assert checks.check_bands(spark, str(tmp_path)).where("ok").count() == 4
    assert sorted(built) == ["audiogap", "kpi_vs_n", "mobility_cycles"]


def test_event_properties_are_parsed_once(spark, tmp_path):
    spark.createDataFrame(
        [(1, 1, "view", 3.0, '{"k": 7}'), (2, 1, "click", 4.0, '{"k": 8}'), (3, 2, "click", 5.0, None)],
        "event_id long, user_id long, event_type string, value double, props string",
    ).withColumn("ts", F.timestamp_millis(F.col("event_id") * 1000)).write.parquet(str(tmp_path / "events.parquet"))
    got = stand_ins.events(spark, str(tmp_path))
    assert rows(got.select("event_id", "k", "t_ms")) == [(1, 7, 1000), (2, 8, 2000), (3, None, 3000)]
    shares = marts.sensing_suppression(reshape.normalize_sensing(stand_ins.sensing_exports(spark, str(tmp_path))))
    assert plan_of(shares).count("get_json_object(props") == plan_of(shares).count("Relation [")
    assert rows(shares.select("scenario", "trials", "suppression_median_pct_raw")) == [("idle", 1, 50.0), ("walk", 2, 50.0)]


def test_dtx_and_grace(spark):
    dtx = spark.createDataFrame([("speech", True, 18.1), ("speech", True, 17.9), ("speech", False, 23.0), ("tone", False, -1.0)], "source string, dtx boolean, uplink_kbps double")
    assert rows(marts.dtx_uplink(dtx).select("source", "dtx", "uplink_median_kbps")) == [("speech", False, 23.0), ("speech", True, 18.0)]
    grace = spark.createDataFrame([(6000, 0, 200, -1.0, -5), (6000, 0, 301, 0.1, 4), (6000, 0, -1, 1.0, 1)], "absence_ms int, grace_ms int, reconnect_gap_ms int, hold_kbps double, stop_ms int")
    got = marts.gracegap_series(grace).first()
    assert (got.n, got.gap_median_ms_raw, got.stop_median_ms, got.hold_median_kbps_raw) == (2, 250.5, 4.0, 0.1)


def test_realnet_marts(spark):
    lines = stream(spark, report("a", 1, kpis={"setupMedianMs": 900, "iceSuccessPct": 100, "glareTotal": 2}),
                   report("b", 1, cond="homeNAT-x", links=[{"index": 0, "setupMs": -1, "rttMs": 107, "candidateType": ""}, {"index": 1, "setupMs": 50, "rttMs": -1}]),
                   report("c", 1, cond="homeNAT-x", links=[]))
    fact = reshape.explode_realnet_links(lines)
    got = marts.realnet_conditions(fact).select("condition", "access", "path", "links", "setup_median_ms", "rtt_median_ms")
    assert rows(got) == [("cellular-relay", "cellular", "relay", 1, 5714.0, 101.0), ("homeNAT-x", "home", "direct", 1, 50.0, 107.0)]
    assert rows(marts.candidate_mix(fact)) == [("cellular-relay", "relay", 1), ("homeNAT-x", "?", 2)]
    trials = exports.parse_trials(spark.createDataFrame([('{"setupMedianMs":100,"glareTotal":1}', "wsn-voice-cellular-relay-trial1.json")], "payload string, source_file string"))
    got = marts.realnet_session_kpis(lines, trials).select("condition", "n", "setup_median_ms_raw", "kpi_glare_total")
    assert rows(got) == [("cellular-relay", 2, 500.0, 3)]


def test_access_path_grid(spark):
    conditions = spark.createDataFrame([("cellular", "relay", 131.0), ("cellular", "relay", 115.0), ("cellular", "direct", 101.0), ("cellular", "direct", 107.0)], "access string, path string, rtt_median_ms double")
    assert rows(series.series_realnet_rtt(conditions)) == [("cellular", 104.0, 123.0)]


def test_link_rollup(spark):
    links = spark.createDataFrame([
        ("s", 10, 500, False, "host", 70, -1, 1), ("s", 20, 900, False, "relay", 70, -1, 0), ("s", -1, -1, True, "", -1, -1, 0)],
        "session string, connected_ms int, setup_ms int, failed boolean, candidate_type string, lat_raw_ms int, lat_cal_ms int, glare int")
    r = marts.link_kpi_rollup(links).first()
    assert (r.links, r.ice_attempts, r.ice_success_pct, r.setup_median_ms, r.setup_p95_ms, r.relay_pct, r.lat_raw_median_ms, r.lat_cal_median_ms, r.glare_total) == (2, 3, 67, 500, 900, 50, 70, -1, 1)


@pytest.mark.parametrize("limit", [10**6, 3])
def test_percentiles(spark, limit):
    df = spark.createDataFrame([("g", float(v)) for v in range(101)] + [("h", 1.5), ("h", 1.5), ("h", 4.0), ("h", None)], "k string, v double")
    got = rows(exact_percentiles(df, ["k"], "v", {"p50": 0.5, "p95": 0.95}, limit=limit))
    assert got == [("g", 101, 50.0, 95.0), ("h", 3, 1.5, 3.75)]
    assert df.where("k='h'").agg(percentile_interpolated("v", 0.95)).first()[0] == pytest.approx(3.75)
    five = spark.createDataFrame([(v,) for v in (50, 10, 30, 40, 20)], "v int")
    assert tuple(five.agg(percentile_nearest_rank("v", 0.5), percentile_nearest_rank("v", 0.95)).first()) == (30, 50)
    assert five.where("v > 99").agg(percentile_nearest_rank("v", 0.5)).first()[0] == -1


def test_scalars(spark):
    L = F.lit
    got = one(
        spark, S.loss_pct(L(0), L(0)), S.loss_pct(L(5), L(995)), S.loss_pct(L(2), L(98)),
        S.up_kbps(L(3000), L(1000)), S.up_kbps(L(0), L(1000)), S.up_kbps(L(100), L(0)),
        S.suppressed_pct(L(0), L(0)), S.suppressed_pct(L(100), L(91)),
        S.mouth_to_ear_ms(L(0.044), L(16.0)), S.calibrated_ms(L(-1), L(12)), S.calibrated_ms(L(78), L(12)),
        S.ignores_offer(L(20), L(10), L(True), L("stable")), S.ignores_offer(L(10), L(20), L(True), L("stable")),
        S.ignores_offer(L(20), L(10), L(False), L("stable")), S.round_half_ceiling(L(-2.5)), S.round_half_even(L(2.5)), S.round_half_up(L(2.5)),
        S.peak_of(F.array(L(0.1), L(-0.8), L(0.3))), S.peak_of(F.array().cast("array<double>")),
        S.rms_of_bytes(F.array(L(128), L(128))), S.rms_of_bytes(F.array().cast("array<int>")),
        S.normalize_candidate_type(L("prflx")), S.ms_to_seconds_label(L(6000)))
    assert tuple(got) == (-1.0, 0.5, 2.0, 24, 0, -1, 0, 91, 78, -1, 90, True, False, False, -3 + 1, 2.0, 3.0, 0.8, 0.0, 0.0, 0.0, "srflx", "6s absence")


# Quality, parity


def test_suites(spark):
    df = spark.createDataFrame([("f", "voice", "host", 2, 0), ("f", "voice", "bogus", 2, -1), (None, "voice", None, None, None)],
                               "source_file string, record_type string, candidate_type string, n_peers int, glare int")
    got = {r.check: (r.ok, r.bad_rows) for r in quality.run_suite(df, quality.LINK_FACT_CHECKS + [quality.expect_unique("n_peers")]).collect()}
    assert got["source_file not null"] == (False, 1) and got["candidate_type in set"] == (False, 1)
    assert got["n_peers between"] == (True, 0) and got["glare between"] == (False, 1) and got["n_peers unique"] == (False, 2)
    results = quality.run_checkpoint({"t": (df, quality.LINK_FACT_CHECKS)})
    assert {(r.table, r.ok) for r in quality.checkpoint_summary(results).collect()} == {("t", False), (None, False)}
    assert tuple(quality.assert_rows_empty(df.where("glare > 5")).first()) == (0, True)


def test_suites_are_counted_while_writing(spark, tmp_path):
    df = spark.createDataFrame([("f", "voice", "host", 2, 0), ("f", "voice", "bogus", 2, -1), (None, "voice", None, None, None)] * 40,
                               "source_file string, record_type string, candidate_type string, n_peers int, glare int").repartition(7)
    checks = quality.LINK_FACT_CHECKS + [quality.expect_unique("n_peers")]
    path = str(tmp_path / "t")
    got = quality.write_checked(df, "t", checks, lambda o: o.write.parquet(path), lambda: spark.read.parquet(path))
    want = quality.run_checkpoint({"t": (df, checks)})
    assert rows(got) == rows(want) and spark.read.parquet(path).count() == 120


def test_columns_are_compared_by_bucket(spark):
    fields = "k string, n long, v double, kind string"
    data = [(f"k{i}", i, i / 7, "a" if i % 3 else None) for i in range(500)]
    expected = spark.createDataFrame(data, fields)
    same = spark.createDataFrame([(k, float(n), v, s) for k, n, v, s in reversed(data)], "k string, n double, v double, kind string")
    got = parity.compare_columns("m", expected, same, ["k"], 0)
    assert rows(got.select("check", "rows", "differing", "ok")) == [(f"m.{c}", 500, 0, True) for c in ("kind", "n", "v")]
    assert all(r.buckets == [] for r in got.collect())
    planted = [(k, n, v + (5 if k == "k77" else 0.4 if k == "k78" else 0), "b" if k == "k9" else s) for k, n, v, s in data if k != "k400"]
    other = spark.createDataFrame(planted, fields)
    found = {r["check"]: r for r in parity.compare_columns("m", expected, other, ["k"], 1).collect()}
    assert not any(r.ok for r in found.values()) and found["m.n"].differing == 1 and found["m.n"].key == "k400" and found["m.n"].actual is None
    assert found["m.v"].differing == 2 and (found["m.kind"].differing, found["m.kind"].key) == (2, "k400")
    only = parity.compare_columns("m", expected.where("k <> 'k400'"), other, ["k"], 1).where("not ok").collect()
    assert [(r["check"], r.differing, r.key, r.expected[:6], r.actual[:6], len(r.buckets)) for r in only if r["check"] == "m.v"] == [("m.v", 1, "k77", "11.000", "16.000", 2)]
    assert [(r["check"], r.key, r.expected, r.actual) for r in only if r["check"] == "m.kind"] == [("m.kind", "k9", None, "b")]


def test_tolerance(spark):
    df = spark.createDataFrame([(202, 203), (202, 205), (None, None), (5, None)], "a int, b int")
    assert [r[0] for r in df.select(parity.compare_within_tolerance("a", "b")).collect()] == [True, False, True, False]


def test_references(spark):
    json_rows = raw(spark, *[(f"d{i}", "dtx", {"source": s, "dtx": d, "uplinkKbps": v}) for i, (s, d, v) in enumerate(
        [("speech", True, 18.1), ("speech", True, 17.9), ("speech", False, 23.0), ("tone", True, -1)])],
        ("s", "sensing", {"scenario": "idle", "clients": {"A": {"stats": {"suppressedPct": 91}}, "B": {"stats": {"suppressedPct": 89}}}}))
    assert rows(parity.reference_rounded(parity.reference_dtx(json_rows))) == [("speech/false", 23.0), ("speech/true", 18.0)]
    assert rows(parity.reference_sensing(json_rows)) == [("idle", 90.0)]


def test_series(spark):
    kpi = spark.createDataFrame([(n, 24.0 if n < 5 else None, n, 70.0, 1.0, 2.0) for n in (2, 3, 4, 5)], "n_peers int, uplink_kbps double, glare_total int, m2e_ms double, setup_median_ms double, setup_p95_ms double")
    assert [r.node_total_kbps for r in series.series_uplink(kpi).collect()] == [24.0, 48.0, 72.0]
    assert [r.density for r in series.series_glare_density(kpi).collect()][:3] == [2, 6, 12]
    mart = spark.createDataFrame([(s, 1.0) for s in ("conv", "idle", "walk", "other")], "scenario string, suppression_median_pct double")
    assert [r.scenario for r in series.series_suppression(mart).collect()] == ["idle", "walk", "conv"]


def test_refresh_end_to_end(spark, tmp_path):
    data = tmp_path / "data"
    data.mkdir()
    def put(name, body):
        (data / name).write_text(json.dumps(body, indent=1))
    kp = dict(setupMedianMs=300, setupP95Ms=400, iceSuccessPct=100, relayPct=0, latRawMedianMs=70, glareTotal=0, links=1)
    put("wsn-voice-N2-summary-1.json", voice(2, client("a", **kp), client("b", **kp)))
    put("wsn-mobility-1.json", {"phases": {"initialForm": {"ms": 800}, "teardown": {"ms": 20}, "reconnect": {"ms": 2400}}})
    put("wsn-audiogap-1.json", {"valid": True, "audioStopAfterOutMs": 20, "reconnectAudioGapMs": 2500, "totalSilenceMs": 2520})
    put("wsn-gracegap-1.json", {"absenceMs": 6000, "graceMs": 0, "reconnectGapMs": 2100, "holdKbps": -1, "stopAfterOutMs": 3})
    put("wsn-dtx-1.json", {"source": "tone", "dtx": False, "uplinkKbps": 31.5})
    put("wsn-sensing-1.json", {"scenario": "idle", "clients": {"A": {"stats": {"suppressedPct": 91}}}})
    (data / "wsn-remote-reports.jsonl").write_text(json.dumps(report("s", 1)) + "\n" + json.dumps(report("s", 2)) + "\n")
    gates = refresh.refresh(spark, str(data), str(tmp_path / "lake"), AT)
    assert {(r.gate, r.ok) for r in gates.collect()} == {("quality", True), ("parity", True), ("columns", True), ("quarantine", True)}
    recorded = layers.read_layer(spark, str(tmp_path / "lake" / "gold"), "quality")
    assert rows(recorded) == rows(refresh.check(spark, str(tmp_path / "lake")))
    reshape.staging_views(spark, str(tmp_path / "lake" / "silver"))
    assert spark.table("stg_dtx").count() == 1
    report_rows = refresh.parity_gate(spark, str(tmp_path / "lake"))
    assert report_rows.where("check like 'dtx_uplink%'").first().actual == 31.5

    put("wsn-dtx-2.json", {"source": "tone", "dtx": False, "uplinkKbps": "fast"})
    gates = refresh.refresh(spark, str(data), str(tmp_path / "lake"), AT)
    assert {(r.gate, r.ok) for r in gates.collect()} == {("quality", True), ("parity", True), ("columns", True), ("quarantine", False)}
    bad = layers.read_layer(spark, str(tmp_path / "lake" / "silver"), "quarantine").first()
    assert (bad.source_file, bad.reason) == ("wsn-dtx-2.json", "type mismatch")
