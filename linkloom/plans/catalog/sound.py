"""Loopback latency and sample streams, with vectors as recordings."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkloom.operators import loopback as L
from linkloom.plans import stand_ins as T
from linkloom.plans.catalog import query
from linkloom.plans.catalog.results import rounded

with_sql = T.with_sql
FS = 1000.0
WINDOW = dict(win_ms=8, pre_ms=2, min_lag_ms=0, max_lag_ms=20)

# Two-pole band-pass at 100 Hz, Q 4, as the recurrence itself.
BAND = """walk AS (
  SELECT recording_id, -1::BIGINT AS frame, 0::DOUBLE AS x1, 0::DOUBLE AS x2, 0::DOUBLE AS y1, 0::DOUBLE AS y2 FROM (SELECT DISTINCT recording_id FROM frame)
  UNION ALL SELECT w.recording_id, f.frame, f.ref, w.x1, (alpha * f.ref - alpha * w.x2 + 2 * cos(w0) * w.y1 - (1 - alpha) * w.y2) / (1 + alpha), w.y1
  FROM walk w JOIN frame f ON f.recording_id = w.recording_id AND f.frame = w.frame + 1, (SELECT 2 * pi() * 100 / 1000 AS w0, sin(2 * pi() * 100 / 1000) / 8 AS alpha))"""


@query("bandpass_filter", with_sql("frame", recursive=BAND, body="SELECT recording_id, frame, round(CAST(CAST(y1 AS FLOAT) AS DOUBLE), 5) AS ref FROM walk WHERE frame >= 0"))
def bandpass_filter(spark, sf_dir):
    passed = L.bandpass_filter(T.frames(spark, sf_dir), FS, freq=100.0).withColumn("ref", F.col("ref").cast("double"))
    return rounded(passed, "ref", digits=5).select("recording_id", "frame", "ref")


@query("bandpass_scan", with_sql("frame", recursive=BAND.replace("/ 8 AS alpha", "/ 400 AS alpha"), body="SELECT recording_id, frame, round(CAST(CAST(y1 AS FLOAT) AS DOUBLE), 5) AS ref FROM walk WHERE frame >= 0"))
def bandpass_scan(spark, sf_dir):
    """A filter that rings far beyond the stretches it is computed in."""
    passed = L.bandpass_filter(T.frames(spark, sf_dir), FS, freq=100.0, q=200.0, stretch=16).withColumn("ref", F.col("ref").cast("double"))
    return rounded(passed, "ref", digits=5).select("recording_id", "frame", "ref")


SMOOTH = """walk AS (
  SELECT recording_id, -1::BIGINT AS frame, 0::DOUBLE AS e FROM (SELECT DISTINCT recording_id FROM frame)
  UNION ALL SELECT w.recording_id, f.frame, w.e + (1 - exp(-0.5::DOUBLE)) * (abs(f.ref) - w.e)
  FROM walk w JOIN frame f ON f.recording_id = w.recording_id AND f.frame = w.frame + 1)"""


@query("envelope", with_sql("frame", recursive=SMOOTH, body="SELECT recording_id, frame, round(CAST(CAST(e AS FLOAT) AS DOUBLE), 5) AS ref FROM walk WHERE frame >= 0"))
def envelope(spark, sf_dir):
    smooth = L.envelope(T.frames(spark, sf_dir), FS).withColumn("ref", F.col("ref").cast("double"))
    return rounded(smooth, "ref", digits=5).select("recording_id", "frame", "ref")


@query("decimate", with_sql("frame", body="SELECT recording_id, frame // 4 AS frame, round(ref, 6) AS ref FROM frame WHERE frame % 4 = 0"))
def decimate(spark, sf_dir):
    kept = L.decimate(T.frames(spark, sf_dir), 4).withColumn("ref", F.col("ref").cast("double"))
    return rounded(kept, "ref").select("recording_id", "frame", "ref")


# Picks need the one before: onsets and their best frame are tabled first, then walked.
PICKS = """lv AS MATERIALIZED (SELECT recording_id, frame, abs(ref) AS v, 0.3::DOUBLE * max(abs(ref)) OVER (PARTITION BY recording_id) AS bar FROM frame),
  onset AS MATERIALIZED (SELECT o.recording_id, o.frame, coalesce(min(b.frame), o.frame + 7) AS stop FROM lv o
    LEFT JOIN lv b ON b.recording_id = o.recording_id AND b.frame > o.frame AND b.frame < o.frame + 7 AND b.v < b.bar * 0.5 WHERE o.v >= o.bar GROUP BY o.recording_id, o.frame),
  best AS MATERIALIZED (SELECT o.recording_id, o.frame, arg_max(l.frame, (l.v, -l.frame)) AS pick FROM onset o
    JOIN lv l ON l.recording_id = o.recording_id AND l.frame >= o.frame AND l.frame < o.stop GROUP BY ALL),
  nxt AS MATERIALIZED (SELECT l.recording_id, l.frame AS eligible, min(o.frame) AS onset FROM lv l JOIN onset o ON o.recording_id = l.recording_id AND o.frame >= l.frame GROUP BY ALL),
  walk AS (SELECT recording_id, 0::BIGINT AS click, -7::BIGINT AS pick FROM (SELECT DISTINCT recording_id FROM frame)
    UNION ALL SELECT w.recording_id, w.click + 1, b.pick FROM walk w JOIN nxt n ON n.recording_id = w.recording_id AND n.eligible = w.pick + 7
      JOIN best b ON b.recording_id = n.recording_id AND b.frame = n.onset)"""


@query("find_clicks", with_sql("frame", recursive=PICKS, body="SELECT recording_id, click, pick AS frame FROM walk WHERE click > 0"))
def find_clicks(spark, sf_dir):
    level = T.frames(spark, sf_dir).withColumn("ref", F.abs("ref"))
    return L.find_clicks(level, FS, max_lag_ms=4)


@query("noise_floor", with_sql("frame", body="SELECT recording_id, round(sqrt(avg(mic * mic)), 6) AS noise_floor FROM frame WHERE frame < 16 GROUP BY 1"))
def noise_floor(spark, sf_dir):
    return rounded(L.noise_floor(T.frames(spark, sf_dir), FS), "noise_floor")


def clicks(spark, sf_dir):
    """Two marks per recording."""
    at = F.array(*[F.struct(F.lit(n).cast("bigint").alias("click"), (F.col("vec_id") % 10 + 8 + (n - 1) * 20).alias("frame")) for n in (1, 2)])
    return T.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("recording_id"), F.inline(at))


T.SQL["ncc"] = """SELECT recording_id, click, lag, any_value(st) AS st,
    CASE WHEN sum(a * a) - sum(a) * sum(a) / 8 > 0 AND sum(b * b) - sum(b) * sum(b) / 8 > 0 THEN (sum(a * b) - sum(a) * sum(b) / 8)
      / sqrt((sum(a * a) - sum(a) * sum(a) / 8) * (sum(b * b) - sum(b) * sum(b) / 8)) ELSE 0 END::DOUBLE AS ncc
  FROM (SELECT c.recording_id, c.click, c.st, l.lag, r.ref AS a, m.mic AS b FROM (
      SELECT vec_id AS recording_id, n AS click, vec_id % 10 + 6 + (n - 1) * 20 AS st FROM embeddings, (VALUES (1::BIGINT), (2)) k(n)) c,
    (SELECT unnest(generate_series(0, 20)) AS lag) l, (SELECT unnest(generate_series(0, 7)) AS j) w, frame r, frame m
    WHERE l.lag <= 64 - c.st - 8 AND r.recording_id = c.recording_id AND r.frame = c.st + w.j AND m.recording_id = c.recording_id AND m.frame = c.st + l.lag + w.j)
  GROUP BY ALL"""
T.SQL["best"] = """SELECT n.*, m.mic AS echo FROM (SELECT *, lag(ncc) OVER p AS y0, lead(ncc) OVER p AS y2, count(*) OVER (PARTITION BY recording_id, click) AS lags
    FROM ncc WINDOW p AS (PARTITION BY recording_id, click ORDER BY lag)) n JOIN frame m ON m.recording_id = n.recording_id AND m.frame = least(st + lag + 2, 63)
  QUALIFY row_number() OVER (PARTITION BY n.recording_id, n.click ORDER BY ncc DESC, lag) = 1"""
T.SQL["burst"] = """SELECT *, quality_db >= 6 AND ncc >= 0.5 AS kept FROM (SELECT b.recording_id, b.click, b.ncc, 20 * log10(greatest(b.echo, 1e-9) / greatest(f.nf, 1e-9)) AS quality_db,
    (b.lag + CASE WHEN y0 IS NULL OR y2 IS NULL OR abs(2 * (y0 - 2 * ncc + y2)) < 1e-12 THEN 0 ELSE (y0 - y2) / (2 * (y0 - 2 * ncc + y2)) END)::DOUBLE AS latency_ms
  FROM best b JOIN (SELECT recording_id, sqrt(avg(mic * mic)) AS nf FROM frame WHERE frame < 16 GROUP BY 1) f USING (recording_id))"""


def correlated(spark, sf_dir):
    return L.window_ncc(T.frames(spark, sf_dir), clicks(spark, sf_dir), FS, **WINDOW)


@query("window_ncc", with_sql("frame", "ncc", body="SELECT recording_id, click, lag, round(ncc, 6) AS ncc FROM ncc"))
def window_ncc(spark, sf_dir):
    return rounded(correlated(spark, sf_dir), "ncc").select("recording_id", "click", "lag", "ncc")


@query("best_lag", with_sql("frame", "ncc", "best", body="SELECT recording_id, click, lag, round(ncc, 6) AS ncc FROM best"))
def best_lag(spark, sf_dir):
    return rounded(L.best_lag(correlated(spark, sf_dir)), "ncc").select("recording_id", "click", "lag", "ncc")


@query("strongest_lag", with_sql("frame", "ncc", "best", body="SELECT recording_id, click, lag, round(ncc, 6) AS ncc FROM best"))
def strongest_lag(spark, sf_dir):
    found = L.strongest_lag(T.frames(spark, sf_dir), clicks(spark, sf_dir), FS, **WINDOW)
    return rounded(found, "ncc").select("recording_id", "click", "lag", "ncc")


def refined(spark, sf_dir):
    return L.parabolic_refine(L.best_lag(correlated(spark, sf_dir)), FS)


def gated(spark, sf_dir):
    return L.quality_gates(refined(spark, sf_dir).join(L.noise_floor(T.frames(spark, sf_dir), FS), "recording_id"))


BURST = ("frame", "ncc", "best", "burst")
query("parabolic_refine", with_sql(*BURST, body="SELECT recording_id, click, round(latency_ms, 5) AS latency_ms FROM burst"))(
    lambda spark, sf_dir: rounded(refined(spark, sf_dir), "latency_ms", digits=5).select("recording_id", "click", "latency_ms"))
query("quality_gates", with_sql(*BURST, body="SELECT recording_id, click, round(quality_db, 5) AS quality_db, kept FROM burst"))(
    lambda spark, sf_dir: rounded(gated(spark, sf_dir), "quality_db", digits=5).select("recording_id", "click", "quality_db", "kept"))
query("calibrate_bursts", with_sql(*BURST, body="""SELECT recording_id, click, round(latency_ms + coalesce(60 - med, 0), 5) AS latency_ms FROM burst LEFT JOIN (
  SELECT recording_id, quantile_cont(latency_ms, 0.5) AS med FROM burst WHERE kept GROUP BY 1) USING (recording_id)"""))(
    lambda spark, sf_dir: rounded(L.calibrate_bursts(gated(spark, sf_dir), 60.0), "latency_ms", digits=5).select("recording_id", "click", "latency_ms"))


@query("measure_bursts")
def measure_bursts(spark, sf_dir):
    """From raw frames to gated bursts; tested against known delays rather than SQL."""
    return L.measure_bursts(T.frames(spark, sf_dir), FS, d=2, max_lag_ms=12, win_ms=8, pre_ms=2, freq=100.0)


@query("resample_linear", with_sql("frame", body="""SELECT a.recording_id AS stream, o AS i, round(a.ref * (1 - (place - floor(place))) + coalesce(b.ref, a.ref) * (place - floor(place)), 6) AS v
  FROM (SELECT o, o * (48000 / 20000) AS place FROM (SELECT unnest(generate_series(0, 25)) AS o)) s
  JOIN frame a ON a.frame = floor(s.place) LEFT JOIN frame b ON b.recording_id = a.recording_id AND b.frame = a.frame + 1"""))
def resample_linear(spark, sf_dir):
    line = T.frames(spark, sf_dir).select(F.col("recording_id").alias("stream"), F.col("frame").alias("i"), F.col("ref").cast("double").alias("v"))
    return rounded(L.resample_linear(line, 48000, 20000), "v")


@query("flatten_chunks", """SELECT conv_id AS stream, base + pos - 1 AS i, len(words[pos])::INTEGER AS v FROM (SELECT *, unnest(generate_series(1, len(words))) AS pos FROM (
  SELECT conv_id, turn, string_split(text, ' ') AS words, coalesce(sum(len(string_split(text, ' '))) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS base FROM conversations))""")
def flatten_chunks(spark, sf_dir):
    """Turns as captured chunks, word lengths as samples."""
    samples = F.transform(F.split("text", " "), F.length)
    chunks = T.table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("stream"), F.col("turn").alias("chunk"), samples.alias("samples"))
    return L.flatten_chunks(chunks)
