"""Ordered history, lifecycles, machines: plain way, chunked way and stream must agree."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from linkloom.functions.sensing import Heard, Thresholds, Track
from linkloom.operators import marts, meshes, signals, states
from linkloom.session import HOT_ROWS_CONF
from linkloom.streaming import machines

LIMITS = [10**6, 7]
READING = "array<struct<index:int,state:string,rttMs:double,lossPct:double>>"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(params=LIMITS)
def limit(request, spark):
    spark.conf.set(HOT_ROWS_CONF, str(request.param))
    yield request.param
    spark.conf.unset(HOT_ROWS_CONF)


def samples(spark, data, columns):
    random.Random(3).shuffle(data)
    return spark.createDataFrame(data, columns).repartition(3)


def test_uplink_rate(spark, limit):
    data = [("s", 1, t * 1000, b) for t, b in enumerate([0, 3000, 3000, 100, 3100])] + [("s", 2, 5, 9)]
    got = signals.uplink_rate(samples(spark, data, "session string, peer int, t_ms bigint, bytes_sent bigint"))
    assert rows(got.where("peer = 1").select("t_ms", "up_kbps")) == [(0, -1), (1000, 24), (2000, 0), (3000, -1), (4000, 24)]


def test_jitter_and_latency(spark, limit):
    data = [("s", 1, 1, -1.0, -1, 0.044), ("s", 1, 2, 1.0, 400, 0.044), ("s", 1, 3, -1.0, -1, 0.044), ("s", 1, 4, 1.2, 500, 0.044),
            ("s", 1, 5, 1.0, 500, None)]
    df = samples(spark, data, "session string, peer int, t_ms bigint, jb_delay double, jb_count bigint, rtt_s double")
    got = signals.mouth_to_ear(signals.jitter_buffer_avg(df))
    assert [(t, round(j, 6), m) for t, j, m in rows(got.select("t_ms", "jb_avg_ms", "lat_raw_ms"))] == [
        (1, -1.0, -1), (2, 2.5, 65), (3, -1.0, -1), (4, 2.0, 64), (5, 2.0, -1)]
    assert rows(signals.calibrate_latency(got, 12.0).select("lat_cal_ms"))[-1] == (77,)


def test_energy(spark, limit):
    budget = 400
    data = [("s", 1, 0, 100, None, None), ("s", 1, 1, 200, None, None), ("s", 1, 2, 1000, None, None), ("s", 1, 3, 1001, 0.15, 0.8), ("s", 1, 4, 1002, None, 0.8)]
    df = samples(spark, data, "session string, peer int, t_ms bigint, bytes_sent bigint, forced double, battery double")
    got = signals.node_energy(df, budget)
    assert rows(got.select("t_ms", "energy", "source")) == [(0, 1.0, "virtual"), (1, 0.75, "virtual"), (2, 0.0, "virtual"), (3, 0.15, "forced"), (4, 0.8, "battery")]


def test_last_n(spark):
    df = samples(spark, [("s", t) for t in range(9)] + [("q", 1)], "session string, t bigint")
    assert rows(signals.last_n_reports(df, 2)) == [("q", 1), ("s", 7), ("s", 8)]


def test_phase_timing(spark, limit):
    s = samples(spark, [("r", t * 250, 1 if 4 <= t < 40 else 0) for t in range(80)], "run string, t bigint, peers int")
    phases = spark.createDataFrame([("r", "form", 0, 1, 30000), ("r", "teardown", 8000, 0, 1000), ("r", "reconnect", 16000, 1, 30000)],
                                   "run string, phase string, start bigint, target int, timeout bigint")
    assert rows(signals.phase_timing(s, phases)) == [("r", "form", 1000), ("r", "reconnect", -1), ("r", "teardown", -1)]


def test_stall_and_resume(spark, limit):
    counts = [10, 12, 14, 14, 14, 14, 14, 14, 14, 0, 0, 3, 7]
    s = samples(spark, [("r", t * 400, p) for t, p in enumerate(counts)], "run string, t bigint, pkts bigint")
    out = spark.createDataFrame([("r", 500, 3700), ("none", 1, 1)], "run string, departed bigint, returned bigint")
    # The counter last grew at 800; idle passes 1200 ms at 2400.
    assert rows(signals.packet_stall(s, out)) == [("none", -1), ("r", 800 + 600 - 500)]
    assert rows(signals.packet_resume(s, out)) == [("none", -1), ("r", 4400 - 3700)]
    assert rows(signals.resume_after_return(s, out)) == [("none", -1, "WEDGE"), ("r", 4400 - 3700, "PASS")]
    assert rows(signals.packet_resume(s, out, timeout_ms=100)) == [("none", -1), ("r", -1)]


def test_validity(spark):
    df = spark.createDataFrame([(20, 2400, 9000), (-1, 5, 9000), (12001, 5, 9000), (None, 1, 1)], "stop_ms int, resume_ms int, absence_ms int")
    assert [(r.total_ms, r.valid) for r in signals.silence_validity(df).collect()] == [(2420, True), (-1, False), (12006, False), (-1, False)]


def test_verdicts(spark):
    s = samples(spark, [("a", 1, 7000, "connected", 5), ("a", 1, 8500, "failed", 0), ("b", 1, 100, "new", 0), ("c", 1, 1, "connected", 0), ("d", 1, 9000, "connected", 4)],
                "run string, peer int, t_ms bigint, state string, packets_received bigint")
    assert rows(signals.classify_wedge(s)) == [("a", "clean"), ("b", "never-connected"), ("c", "silent"), ("d", "never-connected")]
    sessions = spark.createDataFrame([("g", 100, 1), ("h", 100, 0), ("h", 30000, 1), ("l", 1, 2)], "session string, t bigint, peers int")
    live = spark.createDataFrame([("l",)], "session string")
    assert rows(signals.ghost_peers(sessions, live)) == [("g", 1)]


# Links


LIFE = [("s", 1, t, s) for t, s in [
    (5, "connected"), (1000, "detected"), (1200, "connecting"), (1300, "detected"), (1850, "connected"), (1900, "failed"),
    (2000, "detected"), (2400, "failed"), (2600, "connected"), (3000, "detected"), (3400, "failed"), (3500, "closed"), (4000, "detected")]]
RECORDS = [("s", 1, 1, 1000, 1850, 850, False), ("s", 1, 2, 2000, 2600, 600, False), ("s", 1, 3, 3000, -1, -1, True), ("s", 1, 4, 4000, -1, -1, False)]


@pytest.mark.parametrize("cut", [10**6, 3])
def test_lifecycle(spark, cut):
    df = samples(spark, list(LIFE), "session string, peer int, t_ms bigint, state string")
    assert rows(states.link_lifecycle(df, limit=cut)) == RECORDS


@pytest.mark.parametrize("cut", [10**6, 3])
def test_lifecycle_with_samples(spark, cut):
    df = samples(spark, list(LIFE), "session string, peer int, t_ms bigint, state string")
    data = [("s", 1, 900, "host", 5, 50), ("s", 1, 1850, "host", 40, 78), ("s", 1, 1950, "", -1, 80), ("s", 1, 2000, "relay", 90, -1), ("s", 1, 9000, "srflx", 7, 60)]
    measured = samples(spark, data, "session string, peer int, t_ms bigint, candidate_type string, rtt_ms int, lat_raw_ms int")
    got = states.link_lifecycle(df, limit=cut, samples=measured)
    assert rows(got.select("incarnation", "candidate_type", "rtt_ms", "lat_raw_ms")) == [
        (1, "host", 40, 80), (2, "relay", 90, -1), (3, "", -1, -1), (4, "srflx", 7, 60)]
    assert rows(got.drop("candidate_type", "rtt_ms", "lat_raw_ms")) == RECORDS
    rollup = marts.link_kpi_rollup(got.withColumns({"lat_cal_ms": F.lit(-1), "glare": F.lit(0)})).first()
    assert (rollup.links, rollup.ice_attempts, rollup.relay_pct, rollup.setup_median_ms) == (2, 3, 50, 600)


def test_glare_and_watchdog(spark):
    offers = spark.createDataFrame([("s", 1, 20, 10, True, "stable"), ("s", 1, 20, 10, False, "stable"), ("s", 1, 10, 20, True, "x")],
                                   "session string, peer int, my_nonce int, remote_nonce int, making_offer boolean, state string")
    assert rows(states.glare_count(offers)) == [("s", 1, 1)]
    assert rows(states.never_connected_timeout(watch(spark))) == WATCHED


WATCH = "session string, peer int, born_ms bigint, t_ms bigint, ever_connected boolean, signaling string, ice string, my_nonce int, remote_nonce int"
WATCHED = [("s", 1, 0, 3500, "restart"), ("s", 1, 0, 8500, "recreate"), ("s", 2, 0, 8500, "recreate")]


def watch(spark):
    data = [("s", p, 0, t, p == 3, "stable", "new", 9, 1 if p != 2 else 99) for p in (1, 2, 3) for t in range(0, 11000, 500)]
    return samples(spark, data, WATCH)


# Voice activity


def levels(seed=1, streams=3, n=400):
    rng = random.Random(seed)
    data = []
    for s in range(streams):
        level = 0.0
        for i in range(n):
            if rng.random() < 0.12:
                level = rng.choice([0.0, 0.02, 0.04, 0.07, 0.2])
            data.append((s, i * 50, level))
    return data


def vad_by_hand(data, open_polls=3, close_polls=14):
    out = []
    for s in sorted({d[0] for d in data}):
        active, hi, lo = False, 0, 0
        for _, t, rms in sorted(d for d in data if d[0] == s):
            if not active:
                hi = hi + 1 if rms >= 0.06 else 0
                if hi >= open_polls:
                    active, lo = True, 0
                    out.append((s, t, "open"))
            else:
                lo = lo + 1 if rms < 0.035 else 0
                if lo >= close_polls:
                    active, hi = False, 0
                    out.append((s, t, "close"))
    return sorted(out, key=repr)


@pytest.mark.parametrize("cut", [10**6, 37])
def test_vad(spark, cut):
    data = levels()
    df = samples(spark, list(data), "stream int, t_ms bigint, rms double")
    got = states.vad_edges(df, limit=cut)
    assert rows(got) == vad_by_hand(data) and got.count() > 6
    spans = states.speech_intervals(got)
    assert spans.count() == got.where("edge = 'open'").count()


@pytest.mark.parametrize("levels_, edges", [
    ([0.1], []), ([0.1] * 4, ["open"]), ([0.1] * 4 + [0.0] + [0.1] * 3, ["open"]), ([0.1] * 4 + [0.0] * 15, ["open", "close"])])
def test_vad_vectors(spark, levels_, edges):
    df = spark.createDataFrame([("s", i * 50, v) for i, v in enumerate(levels_)], "stream string, t_ms bigint, rms double")
    assert [r.edge for r in states.vad_edges(df).orderBy("t_ms").collect()] == edges


# Grace


def ticks(seed=5, n=120):
    rng = random.Random(seed)
    near, data = set(), []
    for i in range(n):
        for p in (1, 2, 3):
            if rng.random() < 0.25:
                near ^= {p}
        data.append((7, i * 500 + rng.randint(0, 200), sorted(near)))
    return data


def grace_by_hand(data, w):
    live, count, out = {}, {}, []
    for node, t, near in sorted(data):
        for p in [p for p in live if p not in near]:
            if live[p][1] is None:
                live[p][1] = t + max(w, 0)
            if t >= live[p][1]:
                out.append((node, p, count[p], live[p][0], t, t - live[p][0]))
                del live[p]
        for p in near:
            if p not in live:
                count[p] = count.get(p, 0) + 1
                live[p] = [t, None]
            live[p][1] = None
    out += [(node, p, count[p], live[p][0], None, None) for p in live]
    return sorted(out, key=repr)


@pytest.mark.parametrize("w", [0, 700, 2000])
@pytest.mark.parametrize("cut", [10**6, 11])
def test_grace(spark, w, cut):
    data = ticks()
    df = samples(spark, list(data), "node int, t_ms bigint, in_range array<int>")
    assert rows(states.grace_window(df, w, cut)) == grace_by_hand(data, w)


# Suppression


def reading(index=1, state="connected", rtt=40.0, loss=0.0):
    return index, state, rtt, loss


@pytest.mark.parametrize("pos, links, kind", [
    ((6, 0), [reading()], "move"), ((3, 2), [reading()], None), ((0, 0), [], "topology"),
    ((0, 0), [reading(2)], "topology"), ((0, 0), [reading(state="failed")], "link"),
    ((0, 0), [reading(rtt=90.0)], "link"), ((0, 0), [reading(rtt=48.0)], None), ((0, 0), [reading(loss=3.0)], "link")])
def test_event_rules(pos, links, kind):
    samples = [(50_000, None, 0, 0, [reading()]), (52_000, None, *pos, links)]
    first = [0, len(samples[0][4]), len(samples[0][4]) + len(samples[1][4])]
    track = Track(*(list(c) for c in zip(*(d[:4] for d in samples))), first, *([r[k] for d in samples for r in d[4]] for k in range(4)))
    said = {at: (why, note) for at, why, note, _ in track.reports(Heard(), 0, 2, Thresholds())}
    assert said[0] == ("move", "first position fix") and said.get(1, (None,))[0] == kind


def node_rows(seed=11, sessions=2, n=300):
    rng = random.Random(seed)
    data = []
    for s in range(sessions):
        t, x, y, links = 100_000, 0, 0, [reading(i) for i in range(2)]
        for _ in range(n):
            t += rng.choice([500, 2000, 2000, 2000, 40_000] if rng.random() < 0.2 else [2000])
            forced = rng.choice(["link", "speech-start", "node-sleep"]) if rng.random() < 0.06 else None
            if rng.random() < 0.3:
                x, y = x + rng.randint(-4, 4), y + rng.randint(-4, 4)
            if rng.random() < 0.15:
                links = [reading(rng.randint(0, 3), rng.choice(["connected", "failed"]), float(rng.randint(-1, 120)), rng.choice([0.0, 0.5, 4.0])) for _ in range(rng.randint(0, 2))]
            data.append((s, t, forced, x if rng.random() < 0.9 else None, y, links))
    return data


def cause(known, t, forced, pos, links):
    """The rules for one sample, as a list of those that apply; the first one counts."""
    told, found = known["links"], []
    if forced:
        found.append((forced, ""))
    if pos and not known["pos"]:
        found.append(("move", "first position fix"))
    elif pos and math.dist(pos, known["pos"]) >= 6:
        found.append(("move", f"moved {math.floor(math.dist(pos, known['pos']) + 0.5)} tiles"))
    if len(links) != len(told):
        found.append(("topology", f"{len(told)} → {len(links)} neighbors"))
    for peer, state, rtt, loss in links:
        if peer not in told:
            found.append(("topology", f"peer {peer} replaced a neighbor"))
            continue
        was = told[peer]
        if state != was[1]:
            found.append(("link", f"peer {peer} {was[1]} → {state}"))
        if min(rtt, was[2]) >= 0 and abs(rtt - was[2]) >= max(20, was[2] / 2):
            found.append(("link", f"peer {peer} RTT {was[2]:g} → {rtt:g} ms"))
        if min(loss, was[3]) >= 0 and loss - was[3] >= 2:
            found.append(("link", f"peer {peer} loss {was[3]:g} → {loss:g}%"))
    if t - known["t"] >= 30_000:
        found.append(("heartbeat", ""))
    return found[0] if found else (None, "")


def suppress_by_hand(data):
    out = []
    for s in sorted({d[0] for d in data}):
        known = {"t": 0, "pos": None, "links": {}}
        for _, t, forced, x, y, links in sorted((d for d in data if d[0] == s), key=lambda d: d[1]):
            pos = None if x is None or y is None else (x, y)
            kind, note = cause(known, t, forced, pos, links)
            if kind:
                asleep = kind == "node-sleep"
                known = {"t": t, "pos": None if asleep else pos, "links": {} if asleep else {r[0]: r for r in links}}
            out.append((s, t, kind, note, kind is None))
    return sorted(out, key=repr)


NODE = "session int, t_ms bigint, forced_kind string, x int, y int, links " + READING


@pytest.mark.parametrize("cut", [10**6, 40, 3])
def test_suppression(spark, cut):
    data = node_rows()
    got = states.event_suppression(samples(spark, list(data), NODE), limit=cut)
    expected = suppress_by_hand(data)
    assert rows(got) == expected
    assert {"heartbeat", "move", "topology", "link", None} <= {r[2] for r in expected}
    per_node = marts.suppression_by_node(got).collect()
    assert all(0 < r.suppressed_pct < 100 for r in per_node)
    assert states.session_reset(got).count() > 0 and states.heartbeat_due(got).count() > 0


def tied_rows():
    """Samples in pairs of one millisecond, some of them alike, and a start without any report."""
    rng, data = random.Random(4), []
    quiet = [(0, t, None, None, None, []) for t in range(0, 3000, 100)]
    for k, row in enumerate(node_rows(seed=21, sessions=2, n=200)):
        data.append((row[0] + 1, row[1] // 4000 * 4000, *row[2:]))
        if k % 9 == 0:
            data.append(data[-1])
        if rng.random() < 0.05:
            data.append((*data[-1][:2], "link", *data[-1][3:]))
    return quiet + data


def test_suppression_does_not_depend_on_size_or_order_of_arrival(spark, tmp_path):
    data = tied_rows()
    assert len({d[:2] for d in data}) < 0.7 * len(data)
    plain = rows(states.event_suppression(spark.createDataFrame(data, NODE), limit=10**6))
    for cut in (200, 40, 7, 2):
        for turned in (data, data[::-1]):
            assert rows(states.event_suppression(spark.createDataFrame(turned, NODE), limit=cut)) == plain
    # a stream cuts ties between micro-batches, so there the order of arrival has to be given
    df = spark.createDataFrame([(*d, k) for k, d in enumerate(data)], NODE + ", seq int")
    streamed = machines.stream_event_suppression(stream_of(spark, tmp_path, df, ["t_ms", "seq"]), order=["seq"])
    assert rows(drain(streamed, "tied")) == rows(states.event_suppression(df, order=["seq"], limit=40))


def test_order_of_arrival_decides_ties(spark):
    data = [(1, 50_000, None, 0, 0, [], 1), (1, 50_000, None, 30, 0, [], 2), (1, 50_000, None, 0, 0, [], 3)]
    got = states.event_suppression(spark.createDataFrame(data, NODE + ", seq int"), order=["seq"])
    assert sorted(r.note for r in got.collect()) == ["first position fix", "moved 30 tiles", "moved 30 tiles"]
    got = states.event_suppression(spark.createDataFrame([(*d[:6], -d[6] if d[6] == 2 else d[6]) for d in data], NODE + ", seq int"), order=["seq"])
    assert sorted(str(r.note) for r in got.collect()) == ["", "first position fix", "moved 30 tiles"]


# Meshes


def test_neighbor_sets(spark):
    known = spark.createDataFrame([(1, 2), (1, 3), (2, 9), (3, 4)], "node int, peer int")
    now = spark.createDataFrame([(1, 3), (1, 4), (2, 9), (2, 8), (3, 4)], "node int, peer int")
    assert rows(meshes.neighbor_delta(known, now)) == [(1, 2, "departed"), (1, 4, "arrived"), (2, 8, "arrived")]
    assert rows(meshes.topology_change(known, now)) == [(1, "topology", "peer 4 replaced a neighbor"), (2, "topology", "1 → 2 neighbors")]


@pytest.mark.parametrize("crowd", [10**6, 3])
def test_proximity(spark, crowd):
    rng = random.Random(2)
    data = [(rng.randint(0, 1), n, rng.randint(-20, 60), rng.randint(-20, 60)) for n in range(120)]
    data += [(5, n, 1, 1) for n in range(12)]
    got = meshes.proximity_pairs(spark.createDataFrame(data, "t int, node int, x int, y int"), 15, crowd=crowd)
    expected = sorted((t, a, b) for t, a, ax, ay in data for t2, b, bx, by in data
                      if t == t2 and a < b and (ax - bx) ** 2 + (ay - by) ** 2 <= 225)
    assert sorted((r.t, r.a, r.b) for r in got.collect()) == expected


# Streams


def stream_of(spark, tmp_path, df, order, parts=4):
    """Feed a frame as files in time order, one micro-batch each."""
    folder = str(tmp_path / "in")
    data = df.orderBy(order).collect()
    size = -(-len(data) // parts)
    for i in range(parts):
        chunk = spark.createDataFrame(data[i * size:(i + 1) * size], df.schema).coalesce(1)
        chunk.write.mode("append").parquet(folder)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def drain(df, name):
    query = df.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return df.sparkSession.table(name)


def test_stream_vad(spark, tmp_path):
    df = spark.createDataFrame(levels(n=150), "stream int, t_ms bigint, rms double")
    got = drain(machines.stream_vad_edges(stream_of(spark, tmp_path, df, "t_ms")), "vad")
    assert rows(got) == rows(states.vad_edges(df))


def test_stream_lifecycle(spark, tmp_path):
    df = spark.createDataFrame(LIFE, "session string, peer int, t_ms bigint, state string")
    got = drain(machines.stream_link_lifecycle(stream_of(spark, tmp_path, df, "t_ms")), "life").collect()
    assert sorted({(r.session, r.peer, r.incarnation): tuple(r) for r in got}.values()) == RECORDS


def test_stream_suppression(spark, tmp_path):
    data = node_rows(n=80)
    df = spark.createDataFrame(data, NODE)
    got = drain(machines.stream_event_suppression(stream_of(spark, tmp_path, df, "t_ms")), "sup")
    assert rows(got) == suppress_by_hand(data)


def test_stream_grace_and_watchdog(spark, tmp_path):
    df = spark.createDataFrame(ticks(), "node int, t_ms bigint, in_range array<int>")
    got = drain(machines.stream_grace_window(stream_of(spark, tmp_path / "g", df, "t_ms"), 700), "grace")
    assert rows(got) == rows(states.grace_window(df, 700).where("end_ms is not null"))
    got = drain(machines.stream_never_connected_timeout(stream_of(spark, tmp_path / "w", watch(spark), "t_ms")), "watch")
    assert rows(got) == WATCHED


def test_stream_watchdog_keeps_a_sessions_peers_apart(spark, tmp_path):
    """One state per session; peers, one of them unnamed, and reborn ones are told apart across micro-batches."""
    data = [(s, p, born, born + t, p == 3, "stable", "new", 9, 1 if p != 2 else 99)
            for s in ("s", "u") for born in (0, 40_000) for p in (1, 2, 3, None) for t in range(0, 11000, 500)]
    df = samples(spark, data, WATCH)
    stream = machines.stream_never_connected_timeout(stream_of(spark, tmp_path / "p", df, "t_ms"))
    query = stream.writeStream.format("memory").queryName("peers").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows(spark.table("peers")) == rows(states.never_connected_timeout(df))
    assert stream.schema["peer"].dataType == df.schema["peer"].dataType
    held = [json.loads(p.json)["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(held) == 2
