"""Time-outs by the stream's clock, tables that batches change in place, the keyed log."""

import json
import random
import shutil

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkloom.operators import reshape
from linkloom.sources import reports
from linkloom.streaming import reports as streams
from linkloom.streaming import tables, timers

AT = "2026-01-01T00:00:00Z"
TICK = "session string, peer int, born_ms bigint, t_ms bigint, ever_connected boolean, signaling string, ice string, my_nonce bigint, remote_nonce bigint"
BORN = 1_000_000


def tick(peer, age, connected=False, able=True, born=BORN):
    return ("s", peer, born, born + age, connected, "stable", "new", 5 if able else 1, 3)


FIRST = [tick(1, 100), tick(2, 200, able=False), tick(3, 300, connected=True), tick(4, 3001), tick(5, 100), tick(7, 100, able=False), tick(8, 50)]
SECOND = [tick(2, 3500), tick(4, 3000, able=False), tick(5, 8001, connected=True), tick(7, 8001), tick(8, 8002, connected=True), tick(6, 20000, born=BORN + 500)]
CLOCK = [tick(9, 0, connected=True, born=BORN + 90_000)]
WANT = [
    (1, 3001, "restart"), (1, 8001, "recreate"), (2, 3500, "restart"), (2, 8001, "recreate"), (4, 3001, "restart"), (4, 8001, "recreate"),
    (5, 3001, "restart"), (7, 8001, "recreate"), (7, 8001, "restart"), (8, 3001, "restart"), (8, 8001, "recreate"),
]


def progress(query):
    return [json.loads(p.json) for p in query.recentProgress]


def test_deadlines_pass_without_a_further_row(spark, tmp_path):
    source, out, offsets = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def arrive(rows):
        spark.createDataFrame(rows, TICK).coalesce(1).write.mode("append").parquet(source)
        ticks = spark.readStream.schema(TICK).option("maxFilesPerTrigger", 1).parquet(source)
        # 5 s of disorder: the second batch's rows are behind the first one's latest
        query = streams.land_to(timers.stream_never_connected_deadlines(ticks, delay_ms=5000), out, offsets)
        query.awaitTermination()
        return [s["numRowsTotal"] for p in progress(query) for s in p["stateOperators"]]

    arrive(FIRST)
    assert spark.read.schema("at_ms long").parquet(out).count() == 0
    held = arrive(SECOND)
    assert max(held) >= 6
    got = sorted((r.peer, r.at_ms - BORN, r.action) for r in spark.read.parquet(out).collect())
    assert got == WANT
    assert arrive(CLOCK)[-1] <= 1  # only the peer born last is still watched
    batch = timers.never_connected_deadlines(spark.createDataFrame(FIRST + SECOND + CLOCK, TICK).repartition(3))
    assert sorted((r.peer, r.at_ms - BORN, r.action) for r in batch.collect()) == WANT


class Kept:
    """A peer's state and timers as the engine would keep them; every call counts."""

    def __init__(self):
        self.value, self.timers, self.calls = None, [], 0

    def getValueState(self, name, schema):
        return self

    def registerTimer(self, at):
        self.calls += 1
        self.timers.append(at)

    def exists(self):
        self.calls += 1
        return self.value is not None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value


class Clock:
    def getCurrentWatermarkInMs(self):
        return 0


@pytest.mark.parametrize(("ticks", "timers_at", "calls"), [
    ([(100, False, False), (3500, False, False)], [8001], 3),  # cannot restart: only its last deadline is waited for
    ([(100, True, True)], [8001], 3),  # connected before any deadline
    ([(100, False, True), (3001, False, False), (5000, False, True)], [8001, 5000], 4),
    ([(100, False, True), (9000, True, False)], [8001, 3001], 4),
    ([(9000, False, True)], [], 1),  # behind the last deadline
])
def test_a_peer_waits_only_for_deadlines_it_can_act_on(ticks, timers_at, calls):
    watchdog, kept = timers._watchdog(3000, 8000)(), Kept()
    watchdog.init(kept)
    rows = pd.DataFrame(ticks, columns=["t_ms", "connected", "could_restart"])
    assert list(watchdog.handleInputRows(("s", 1, 0), iter([rows]), Clock())) == []
    assert (kept.timers, kept.calls) == (timers_at, calls)
    # a copy of the ticks changes nothing and is not written
    assert list(watchdog.handleInputRows(("s", 1, 0), iter([rows]), Clock())) == []
    assert (kept.timers, kept.calls) == (timers_at, calls + 1)


def test_deadlines_that_are_not_due(spark):
    rows = [tick(1, 100), tick(2, 8001, connected=True)]
    got = lambda more: sorted((r.peer, r.at_ms - BORN, r.action) for r in timers.never_connected_deadlines(spark.createDataFrame(more, TICK)).collect())
    assert got(rows) == [(1, 3001, "restart")]  # the clock stands at the deadline, not behind it
    assert got([*rows, tick(2, 8002)]) == [(1, 3001, "restart"), (1, 8001, "recreate")]
    assert got([]) == []
    assert got([("s", 1, None, 5, None, None, None, None, None), ("s", 1, BORN, None, None, None, None, None, None)]) == []


def body(sid, ts, peers=0, cond="c"):
    return json.dumps({"cond": cond, "sid": sid, "ts": ts, "peers": peers})


def records(spark, rows):
    """(key, value, partition, offset) as a broker's source gives them."""
    return spark.createDataFrame([(k.encode(), v.encode(), p, o) for k, v, p, o in rows], "key binary, value binary, partition int, offset bigint")


def newest(lines):
    return sorted(map(tuple, reshape.parsed_reports(lines).select("sid", "r.peers").collect()))


def test_ties_fall_to_the_later_offset(spark, tmp_path):
    rows = [("x", body("x", 7, p), 0, o) for o, p in [(5, 1), (9, 2), (7, 3)]] + [("y", body("y", 1, 4), 1, 2), ("y", body("y", 1, 5), 1, 1), ("z", " ", 0, 11)]
    random.Random(1).shuffle(rows)
    want = [("x", 2), ("y", 4)]
    assert newest(streams.land_log(records(spark, rows), AT)) == want
    source, table = str(tmp_path / "log"), str(tmp_path / "table")
    for row in rows:  # a batch per record, in an order of its own
        records(spark, [row]).write.mode("append").parquet(source)
    log = spark.readStream.schema("key binary, value binary, partition int, offset bigint").option("maxFilesPerTrigger", 1).parquet(source)
    tables.stream_upsert_latest(streams.land_log(log, AT), table, str(tmp_path / "cp"), slots=4).awaitTermination()
    assert newest(tables.latest_lines(spark, table)) == want


def test_published_log_keeps_a_key_in_order(spark, tmp_path):
    path = str(tmp_path / "log")
    lines = lambda ts: spark.createDataFrame([(body(f"s{k % 5}", t),) for k, t in enumerate(ts)], "payload string").repartition(4)
    reports.publish_log(reports.frame_events(lines(range(100, 200))), path, partitions=3)
    reports.publish_log(reports.frame_events(lines(range(50, 100))), path, partitions=3)
    got = spark.read.schema(reports.LOG_RECORD).parquet(path).collect()
    assert len(got) == 150 and len({(r.partition, r.offset) for r in got}) == 150
    assert all(len({r.partition for r in got if r.key == key}) == 1 for key in {r.key for r in got})
    times = lambda key, rows: [json.loads(r.value)["ts"] for r in sorted(rows, key=lambda r: r.offset) if r.key == key]
    for key in {r.key for r in got}:
        found = times(key, got)
        assert found == sorted(found[:20]) + sorted(found[20:]) and found[:20] == sorted(t for t in found if t >= 100)


def lines_of(spark, rows):
    """Lines as landing prepares them from (sid, ts, peers, row number)."""
    return streams.land_log(records(spark, [(str(sid), body(sid, ts, peers), 0, at) for sid, ts, peers, at in rows]), AT)


def test_upsert_rewrites_touched_slots_only(spark, tmp_path):
    table = tables.Slots(spark, str(tmp_path / "t"))
    assert newest(tables.latest_lines(spark, table.path)) == []
    first = lines_of(spark, [(f"s{k}", 10, k, k) for k in range(40)])
    assert len(tables.upsert_newest(first, 0, table, slots=16)) > 8
    before = table.state()[1]
    second = lines_of(spark, [("s3", 11, 99, 100), ("s4", 9, 98, 101)])
    slot_of = {r.sid: r.slot for r in first.select("sid", tables._slot(["cond", "sid"], 16)).collect()}
    assert tables.upsert_newest(second, 1, table, slots=16) == {slot_of["s3"], slot_of["s4"]}
    after = table.state()[1]
    assert {s for s in after if after[s] != before.get(s)} == {slot_of["s3"], slot_of["s4"]}
    want = sorted([(f"s{k}", k) for k in range(40) if k != 3] + [("s3", 99)])
    assert newest(tables.latest_lines(spark, table.path)) == want
    # replayed batches change nothing
    assert tables.upsert_newest(second, 1, table, slots=16) == set() and tables.upsert_newest(first, 0, table, slots=16) == set()
    # a batch that failed before its commit is written anew
    (tmp_path / "t" / "batch=2" / "slot=0").mkdir(parents=True)
    (tmp_path / "t" / "batch=2" / "slot=0" / "part-x.parquet").write_bytes(b"half")
    tables.upsert_newest(lines_of(spark, [("s5", 12, 77, 200)]), 2, table, slots=16)
    assert dict(newest(tables.latest_lines(spark, table.path)))["s5"] == 77
    table.vacuum(keep=1)
    assert dict(newest(tables.latest_lines(spark, table.path)))["s3"] == 99
    assert len(list((tmp_path / "t").glob("batch=*/slot=*"))) == len(table.state()[1])


@pytest.mark.parametrize("bits", [1 << 20, 64])
def test_copies_of_any_age_are_dropped(spark, tmp_path, monkeypatch, bits):
    """With filters of 64 bits nearly every key is a hit, and only the exact comparison keeps it."""
    monkeypatch.setattr(tables, "FILTER_BITS", bits)
    landed = tables.LandedOnce(spark, str(tmp_path / "t"), parts=3)
    assert landed.read() is None
    rows = [(f"s{k}", 1, k, k) for k in range(60)]
    days = ["2026-01-01", "2026-01-02", "2026-03-05"]
    sent = [rows[:30], rows[20:45], rows[:60]]
    for batch, (day, part) in enumerate(zip(days, sent, strict=True)):
        lines = lines_of(spark, part + part[:3]).withColumn("arrived", F.to_timestamp(F.lit(day)))
        landed.land(lines, batch)
        landed.land(lines, batch)
        assert landed.read().count() == len({r[0] for p in sent[:batch + 1] for r in p})
    assert sorted(r.sid for r in landed.read().collect()) == sorted(r[0] for r in rows)
    assert len({s.rsplit("-", 1)[0] for s in landed.filters.state()[1]}) == 3 if bits > 64 else True
    # lines without keys are told apart by their text
    loose = streams.land_log(records(spark, [("u", '{"a": 1}', 0, 500), ("u", '{"a": 2}', 0, 501), ("u", '{"a": 1}', 0, 502)]), AT)
    landed.land(loose, 3)
    landed.land(loose, 4)
    assert landed.read().where("sid is null").count() == 2
    # a batch written but not committed is not read, and written anew when it comes again
    shutil.copytree(tmp_path / "t" / "rows" / "batch=2", tmp_path / "t" / "rows" / "batch=5")
    shutil.copytree(tmp_path / "t" / "keys" / "batch=2", tmp_path / "t" / "keys" / "batch=5")
    assert landed.read().count() == 62
    landed.land(lines_of(spark, [("new", 1, 1, 900), ("s1", 1, 1, 901)]), 5)
    assert landed.read().count() == 63


def test_filters_grow_with_their_keys():
    """Keys that never came are not taken for landed ones, however many a slot holds; those that came always are."""
    hashed = np.random.default_rng(1).integers(-2**63, 2**63 - 1, 700_000)
    keys = lambda part: pa.table({"slot": pa.array(["20260101-0"] * len(part)), "_hash": part})
    filters = pa.table({"slot": ["20260101-0"], "bits": pa.array([bytes(8)], pa.binary()), "held": pa.array([None], pa.int64())})
    for at in range(0, 400_000, 50_000):
        filters = tables._filled(keys(hashed[at:at + 50_000]), filters)
    assert len(filters) <= 6 and sum(filters.column("held").to_pylist()) == 400_000 + 4
    assert sum(map(len, filters.column("bits").to_pylist())) <= 400_000 * 8
    assert len(tables._probe(keys(hashed[:400_000]), filters)) == 400_000
    assert len(tables._probe(keys(hashed[400_000:]), filters)) < 900
