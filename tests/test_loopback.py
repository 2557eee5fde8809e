"""Loopback latency against known delays, plain loops and split recordings."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkloom.operators import loopback as L
from linkloom.operators import marts

FS = 8000.0
FRAMES = "recording_id int, frame bigint, ref float, mic float"


def frames(spark, recordings):
    parts = []
    for rec, (ref, mic) in recordings.items():
        parts.append(pd.DataFrame({"recording_id": rec, "frame": np.arange(len(ref)), "ref": ref.astype(np.float32), "mic": mic.astype(np.float32)}))
    return spark.createDataFrame(pd.concat(parts), FRAMES).repartition(4)


def clicks(delay_ms, n=6, every=2.0, noise=0.03, seed=1):
    """A click train and its delayed, attenuated, noisy echo."""
    rng = np.random.default_rng(seed)
    size = int((n + 0.5) * every * FS)
    ref = np.zeros(size)
    t = np.arange(int(0.02 * FS)) / FS
    burst = np.sin(2 * np.pi * 2000 * t) * np.hanning(len(t))
    for i in range(n):
        at = int((0.75 + i * every) * FS)
        ref[at:at + len(burst)] += burst
    shift = int(delay_ms / 1000 * FS)
    mic = noise * rng.standard_normal(size) / 3
    mic[shift:] += 0.5 * ref[:-shift]
    return ref, mic


def biquad(x, fs, f0, q):
    w = 2 * np.pi * f0 / fs
    alpha = np.sin(w) / (2 * q)
    b, a1, a2 = alpha / (1 + alpha), -2 * np.cos(w) / (1 + alpha), (1 - alpha) / (1 + alpha)
    y = np.zeros(len(x))
    for i in range(len(x)):
        x2 = x[i - 2] if i > 1 else 0
        y[i] = b * x[i] - b * x2 - a1 * (y[i - 1] if i else 0) - a2 * (y[i - 2] if i > 1 else 0)
    return y


def column(df, name, rec=1):
    got = df.where(F.col("recording_id") == rec).orderBy("frame").toPandas()
    assert (got["frame"].to_numpy() == np.arange(len(got))).all()
    return got[name].to_numpy(float)


@pytest.mark.parametrize("stretch", [1 << 18, 700])
def test_filters_match_the_recurrences(spark, stretch):
    rng = np.random.default_rng(4)
    x = rng.standard_normal(9000)
    df = frames(spark, {1: (x, x[::-1])})
    expected = biquad(x.astype(np.float32).astype(float), FS, 2000, 4)
    passed = L.bandpass_filter(df, FS, stretch=stretch)
    np.testing.assert_allclose(column(passed, "ref"), expected, atol=1e-6)
    k, e, out = 1 - np.exp(-1 / (0.002 * FS)), 0.0, []
    for v in np.abs(expected.astype(np.float32)):
        e += k * (v - e)
        out.append(e)
    np.testing.assert_allclose(column(L.envelope(passed, FS, stretch=stretch), "ref"), out, atol=1e-6)
    np.testing.assert_allclose(column(L.filtered_envelope(df, FS, stretch=stretch), "ref"), out, atol=1e-6)


def test_filters_that_outlast_their_stretches(spark):
    """Q of 200 and a slow envelope ring for thousands of frames; stretches of 700 are chained by their states."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal(6000).astype(np.float32).astype(float)
    df = frames(spark, {1: (x, x[::-1]), 2: (x[:650], x[:650])})
    passed = L.bandpass_filter(df, FS, q=200, stretch=700)
    for rec, channel, signal in ((1, "ref", x), (1, "mic", x[::-1]), (2, "ref", x[:650])):
        np.testing.assert_allclose(column(passed, channel, rec), biquad(signal, FS, 2000, 200), atol=1e-6)
    k, e, out = 1 - np.exp(-1 / (0.5 * FS)), 0.0, []
    for v in np.abs(x):
        e += k * (v - e)
        out.append(e)
    np.testing.assert_allclose(column(L.envelope(df, FS, tau_ms=500, stretch=700), "ref"), out, atol=1e-6)
    both = L.envelope(passed, FS, tau_ms=500, stretch=700)
    np.testing.assert_allclose(column(L.filtered_envelope(df, FS, q=200, tau_ms=500, stretch=700), "mic"), column(both, "mic"), atol=1e-6)
    # a gap of whole stretches is silence
    gap = df.where("recording_id = 1 and (frame < 900 or frame >= 3700)")
    quiet = np.where((np.arange(6000) < 900) | (np.arange(6000) >= 3700), x, 0)
    got = L.bandpass_filter(gap, FS, q=200, stretch=700).orderBy("frame").toPandas()
    np.testing.assert_allclose(got["ref"].to_numpy(float), biquad(quiet, FS, 2000, 200)[got["frame"].to_numpy()], atol=1e-6)


@pytest.mark.parametrize("size", [1, 2, 16, 512, 700])
def test_many_stretches_are_filtered_as_one_array(size):
    """All stretches of a task take one call, and the states of all recordings are put in order together."""
    rng = np.random.default_rng(size)
    x = {rec: rng.standard_normal(n * size) for rec, n in ((0, 5), (1, 1), (2, 9))}
    sharp = L.bandpass(FS, 2000, 200)
    stretches = np.concatenate([np.arange(len(v) // size) for v in x.values()])
    dense = np.concatenate(list(x.values())).reshape(-1, size)
    left = sharp.run(dense, np.zeros((len(dense), 2)))[1]
    entered = sharp.entered(stretches, stretches, left[:, None], size)
    y, _ = sharp.run(dense, entered[:, 0])
    np.testing.assert_allclose(y.ravel(), np.concatenate([biquad(v, FS, 2000, 200) for v in x.values()]), atol=1e-9)


def test_sorted_rows_are_cut_at_whole_groups():
    keys = [None, None, "a", "a", "a", "b", "c", "c", "d"]
    rows = pa.RecordBatch.from_pydict({"k": pa.array(keys, pa.string()), "n": pa.array(range(9))})
    for step in (1, 2, 4, 9):
        got = []
        for piece, group, starts in L._whole(iter([rows.slice(i, step) for i in range(0, 9, step)]), ["k"], 2):
            assert len(starts) <= 2 and (group == np.repeat(np.arange(len(starts)), np.diff([*starts, len(group)]))).all()
            got += [piece.column("n").to_pylist()[a:b] for a, b in zip(starts, [*starts[1:], len(group)], strict=True)]
        assert got == [[0, 1], [2, 3, 4], [5], [6, 7], [8]]


def test_short_stretches_keep_unknown_frames_and_recordings_apart(spark):
    """A frame without a value leaves its stretch and those behind it unknown, in its own recording only."""
    x = np.random.default_rng(3).standard_normal(100).astype(np.float32).astype(float)
    df = frames(spark, {1: (x, x), 2: (x, x)}).withColumn("ref", F.expr("CASE WHEN recording_id = 1 AND frame = 40 THEN NULL ELSE ref END"))
    got = L.bandpass_filter(df, FS, q=200, stretch=16)
    assert sorted(r.frame for r in got.where("ref IS NULL").collect()) == list(range(32, 100))
    np.testing.assert_allclose(column(got, "ref", 2), biquad(x, FS, 2000, 200), atol=1e-6)
    np.testing.assert_allclose(column(got, "mic", 1), biquad(x, FS, 2000, 200), atol=1e-6)


@pytest.mark.parametrize(("width", "lags"), [(5, 40), (200, 1500), (130, 1)])
def test_correlations_equal_the_direct_form(width, lags):
    rng = np.random.default_rng(width)
    ref = rng.standard_normal((6, width)) + 100
    mic = rng.standard_normal((6, width + lags + 3)) + 1e3
    ref[1], mic[2, :width + 5], mic[3] = 0.1, 7.25, 0.1
    mic[4, width + 1:] = 1e3 + 1e-6 * rng.standard_normal(lags + 2)
    got = L._correlations(ref, mic, lags)
    for row in range(6):
        for lag in range(lags):
            a, b = ref[row], mic[row, lag:lag + width]
            still = (a == a[0]).all() or (b == b[0]).all()
            p, q = a - a.mean(), b - b.mean()
            want = 0.0 if still else (p @ q) / np.sqrt((p @ p) * (q @ q))
            assert got[row, lag] == pytest.approx(want, abs=1e-9 if row != 4 else 1e-6)


def test_band_passes_its_centre(spark):
    t = np.arange(8000) / FS
    df = frames(spark, {1: (np.sin(2 * np.pi * 2000 * t), np.sin(2 * np.pi * 200 * t))})
    got = L.bandpass_filter(df, FS)
    inside, outside = (np.sqrt(np.mean(column(got, c) ** 2)) for c in ("ref", "mic"))
    assert inside > 0.6 and outside < 0.1 * inside


def test_decimate(spark):
    df = frames(spark, {1: (np.arange(8), np.arange(8))})
    assert column(L.decimate(df, 4), "ref").tolist() == [0, 4]


def picks_by_hand(v, bar, gap):
    out, i = [], 0
    while i < len(v):
        if v[i] >= bar:
            best = j = i
            while j < min(len(v), i + gap) and v[j] >= bar * 0.5:
                best = j if v[j] > v[best] else best
                j += 1
            out.append(best)
            i = best + gap
        else:
            i += 1
    return out


@pytest.mark.parametrize("limit", [10**6, 50])
def test_find_clicks(spark, limit):
    rng = np.random.default_rng(9)
    loud = np.clip(np.convolve(rng.standard_normal(4000), np.ones(9) / 9, "same"), 0, None).astype(np.float32)
    df = frames(spark, {1: (loud, loud), 2: (loud[::-1], loud)})
    got = L.find_clicks(df, fs=1000.0, thr=0.5, max_lag_ms=20, limit=limit)
    for rec, v in ((1, loud), (2, loud[::-1])):
        v = v.astype(float)
        expected = picks_by_hand(v, 0.5 * v.max(), 31)
        mine = got.where(f"recording_id = {rec}").orderBy("click").toPandas()
        assert mine["frame"].tolist() == expected and len(expected) > 20
        assert mine["click"].tolist() == list(range(1, len(expected) + 1))


def test_correlation_values(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal(400)
    mic = np.concatenate([np.zeros(7), x])[:400]
    df = frames(spark, {1: (x, mic), 2: (np.ones(400), mic)})
    at = spark.createDataFrame([(1, 1, 100), (1, 2, 380), (2, 1, 50)], "recording_id int, click bigint, frame bigint")
    ncc = L.window_ncc(df, at, 1000.0, win_ms=30, pre_ms=5, max_lag_ms=60)
    best = {(r.recording_id, r.click): r for r in L.best_lag(ncc).collect()}
    assert set(best) == {(1, 1), (2, 1)}  # the window of click 2 leaves the recording
    assert best[1, 1].lag == 7 and best[1, 1].ncc == pytest.approx(1.0)
    assert best[2, 1].ncc == 0.0 and best[2, 1].lag == 0
    assert ncc.where("recording_id = 1 and lag = 0").first().ncc < 0.99
    near = {(r.recording_id, r.click): r for r in L.strongest_lag(df, at, 1000.0, win_ms=30, pre_ms=5, max_lag_ms=60).collect()}
    assert near == best
    assert ncc.where("recording_id = 1").count() == 61


def test_known_delays(spark):
    df = frames(spark, {r: clicks(d, seed=r) for r, d in {1: 85, 2: 40}.items()})
    bursts = L.measure_bursts(df, FS, max_lag_ms=500).cache()
    for rec, delay in {1: 85, 2: 40}.items():
        mine = bursts.where(f"recording_id = {rec} and kept")
        assert mine.count() == 6
        stats = marts.burst_statistics(mine).first()
        assert abs(stats.p50 - delay) <= 1000 / (FS / L.DECIMATION)
        assert stats.min_ms <= stats.mean_ms <= stats.max_ms
    shifted = L.calibrate_bursts(bursts, 60.0)
    assert marts.burst_statistics(shifted).where("recording_id = 1").first().p50 == pytest.approx(60.0)
    assert bursts.agg(F.min("quality_db")).first()[0] >= 6
    assert marts.latency_histogram(bursts, "latency_ms", 10.0).agg(F.sum("n")).first()[0] == 12


@pytest.mark.parametrize("limit", [10**6, 3])
def test_resample_and_flatten(spark, limit):
    df = spark.createDataFrame([("s", i, float(v)) for i, v in enumerate([0, 1, 2, 3])], "stream string, i bigint, v double")
    two = L.resample_linear(df, 2, 1, limit)
    assert [r.v for r in two.orderBy("i").collect()] == [0, 2]
    x = np.random.default_rng(0).standard_normal(50)
    line = spark.createDataFrame([("s", i, float(v)) for i, v in enumerate(x)], "stream string, i bigint, v double")
    got = [r.v for r in L.resample_linear(line, 48000, 16000 * 1.1, limit).orderBy("i").collect()]
    ratio = 48000 / (16000 * 1.1)
    at = np.arange(int(50 // ratio)) * ratio
    np.testing.assert_allclose(got, np.interp(at, np.arange(50), x))
    chunks = spark.createDataFrame([("s", 0, [1.0, 2.0]), ("s", 1, []), ("s", 2, [3.0]), ("t", 0, [9.0])], "stream string, chunk int, samples array<double>")
    flat = L.flatten_chunks(chunks, limit).where("stream = 's'").orderBy("i").collect()
    assert [(r.i, r.v) for r in flat] == [(0, 1.0), (1, 2.0), (2, 3.0)]


def test_levels(spark):
    df = spark.createDataFrame([("a", 3.0), ("a", -4.0), ("b", None)], "k string, v double")
    assert [tuple(r) for r in L.rms_level(df, ["k"], "v").orderBy("k").collect()] == [("a", pytest.approx(12.5**0.5)), ("b", 0.0)]
    assert [tuple(r) for r in L.peak_amplitude(df, ["k"], "v").orderBy("k").collect()] == [("a", 4.0), ("b", 0.0)]


def test_noise_floor(spark):
    mic = np.concatenate([np.full(10, 0.5), np.zeros(30)])
    got = L.noise_floor(frames(spark, {1: (mic, mic)}), fs=1000.0).first()
    assert got.noise_floor == pytest.approx(0.5)
