"""Published results, recomputed from a folder of raw exports named by TELEMETRY_DIR."""

import os

import pytest

from linkloom.operators import marts, reshape
from linkloom.plans import refresh
from linkloom.sources import exports
from linkloom.sources.layers import read_layer, read_mart

ROOT = os.environ.get("TELEMETRY_DIR", "")
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="TELEMETRY_DIR names no folder")

KPI = {  # n: clients' average peers, links, set-up, p95, ICE, m2e, glare, uplink, suppressed
    2: (1.0, 2, 476.5, 476.5, 100.0, 73.5, 0, 24.0, 87.0),
    3: (2.0, 5, 548.0, 548.0, 100.0, 63.333, 2, 19.0, 79.333),
    4: (3.0, 12, 594.0, 596.5, 100.0, 67.5, 6, 24.75, 87.0),
    5: (4.0, 18, 213.0, 633.0, 100.0, 66.0, 8, None, 85.4),
    6: (3.3, 9, 364.0, 17926.5, 100.0, 65.75, 7, None, None),
    8: (4.0, 16, 769.0, 20933.0, 100.0, 76.2, 5, None, None),
}
GRACE = {
    (6000, 0): (7, 2117.0, 1912, 9884, 1.0, None), (6000, 1000): (3, 203.0, 202, 302, 9.0, None),
    (6000, 2000): (4, 202.5, 101, 204, 15.0, 0.0), (6000, 5000): (3, 303.0, 303, 305, 6.0, None),
    (6000, 10000): (6, 152.0, 101, 203, 110.5, 0.1), (12000, 0): (3, 2617.0, 2616, 2923, 0.0, None),
    (12000, 1000): (2, 206.0, 203, 209, 54.5, None), (12000, 2000): (2, 303.5, 303, 304, 55.5, None),
    (12000, 5000): (3, 208.0, 204, 305, 46.5, None), (12000, 8000): (2, 303.5, 303, 304, 113.5, None),
    (12000, 15000): (2, 152.0, 102, 202, 103.0, 0.1),
}
MIX = {
    "idle": {"heartbeat": 2.0, "link": 0.4},
    "walk": {"heartbeat": 1.0, "link": 5.33, "move": 15.83, "topology": 1.0},
    "conv": {"heartbeat": 0.83, "link": 0.5, "node-sleep": 0.83, "speech-start": 17.17, "speech-stop": 16.67},
    "churn": {"link": 12.67, "move": 7.67, "topology": 4.83},
}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    gates = refresh.refresh(spark, ROOT, root, "2026-01-01T00:00:00Z")
    assert {r.gate: r.ok for r in gates.collect()} == {"quality": True, "parity": True, "quarantine": True}
    return root


def mart(spark, lake, name):
    return read_mart(spark, lake + "/gold", name)


def near(value):
    return None if value is None else pytest.approx(value, abs=1e-3)


def test_kpi(spark, lake):
    rows = mart(spark, lake, "kpi_vs_n").collect()
    got = {r.n_peers: (r.avg_peers, r.conn_links, r.setup_median_ms_raw, r.setup_p95_ms_raw, r.ice_success_pct_raw, r.m2e_ms_raw,
                       r.glare_total, r.uplink_kbps_raw, r.suppressed_pct_raw) for r in rows}
    assert got == {n: tuple(map(near, v)) for n, v in KPI.items()}
    assert all(r.relay_pct == 0 for r in rows)


def test_mobility_and_gap(spark, lake):
    m = mart(spark, lake, "mobility_cycles").first()
    assert (m.complete_cycles, m.form_median_ms_raw, m.form_min_ms, m.form_max_ms) == (4, 1951.0, 1717, 1982)
    assert (m.teardown_median_ms_raw, m.teardown_min_ms, m.teardown_max_ms) == (5115.5, 5092, 5429)
    assert (m.reconnect_median_ms_raw, m.reconnect_min_ms, m.reconnect_max_ms) == (2433.0, 2375, 2688)
    a = mart(spark, lake, "audiogap").first()
    assert (a.valid_runs, a.stop_median_ms_raw, a.reconnect_median_ms_raw, a.total_silence_median_ms_raw) == (10, 20.0, 2517.5, 12729.0)
    silver = lake + "/silver"
    assert marts.mobility_skipped(read_layer(spark, silver, "mobility")).first()[0] == 2
    assert marts.audiogap_skipped(read_layer(spark, silver, "audiogap")).first()[0] == 35


def test_sensing(spark, lake):
    got = {r.scenario: (r.trials, r.suppression_median_pct_raw) for r in mart(spark, lake, "sensing_suppression").collect()}
    assert got == {"idle": (5, 91.0), "walk": (6, 63.0), "conv": (6, 53.0), "churn": (6, 61.5)}
    raw = read_layer(spark, lake + "/bronze", "raw_json")
    mix = {}
    for r in marts.sensing_report_mix(raw).collect():
        mix.setdefault(r.scenario, {})[r.kind] = round(r.reports_per_run, 2)
    assert mix == MIX
    reports = reshape.explode_sense_reports(raw)
    kinds = {r.kind: r["count"] for r in reports.groupBy("kind").count().collect()}
    assert kinds == {"link": 194, "move": 163, "speech-start": 103, "speech-stop": 100, "topology": 35, "heartbeat": 21, "node-sleep": 5}
    assert reshape.explode_link_readings(reports).where("index is not null").count() == 478


def test_grace_and_dtx(spark, lake):
    got = {(r.absence_ms, r.grace_ms): (r.n, r.gap_median_ms_raw, r.gap_min_ms, r.gap_max_ms, r.stop_median_ms_raw, r.hold_median_kbps_raw)
           for r in mart(spark, lake, "gracegap_series").collect()}
    assert got == {k: tuple(map(near, v)) for k, v in GRACE.items()}
    got = {(r.source, r.dtx): (r.n, r.uplink_median_kbps_raw) for r in mart(spark, lake, "dtx_uplink").collect()}
    assert got == {("speech", False): (3, 23.4), ("speech", True): (3, 18.1), ("tone", False): (3, 31.4), ("tone", True): (3, 31.4)}


def test_files(spark):
    assert exports.discover_exports(spark, ROOT).count() == 133
