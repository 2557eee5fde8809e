"""The parity gate: marts against a second reduction that starts from the raw payloads.

The references read single JSON fields with their own paths and share neither the
read schemas nor the silver tables with the marts, and compare unrounded values.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.scalars import access_of, round_half_even
from linkloom.operators.history import broadcast_if_small, settled
from linkloom.operators.reshape import voice_runs
from linkloom.session import at_once

TOLERANCE = 1

# Fixed bands of the published figures: mart, key, metric, low, high.
BANDS = [
    ("kpi_vs_n", None, "m2e_ms", 60.0, 80.0),
    ("kpi_vs_n", "2", "ice_success_pct", 100.0, 100.0),
    ("kpi_vs_n", "3", "ice_success_pct", 100.0, 100.0),
    ("kpi_vs_n", "4", "ice_success_pct", 100.0, 100.0),
    ("mobility_cycles", None, "reconnect_median_ms", 2000.0, 2700.0),
    ("audiogap", None, "reconnect_median_ms", 2300.0, 3200.0),
]


def compare_within_tolerance(a, b, tol: float = TOLERANCE) -> Column:
    """Both missing agree, one missing does not, else the difference decides."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    return F.when(a.isNull() & b.isNull(), True).otherwise(F.coalesce(F.abs(a - b) <= tol, F.lit(False)))


def _json(path: str, kind: str) -> Column:
    return F.get_json_object("payload", path).try_cast(kind)


def _fields(df: DataFrame, **paths: str) -> DataFrame:
    """Top-level fields of the payload as texts, from one reading of it; a filter on one reads no payload again."""
    return df.select("*", F.json_tuple("payload", *paths.values()).alias(*paths))


def _as(kind: str, *names: str) -> dict[str, Column]:
    return {n: F.col(n).try_cast(kind) for n in names}


def _phases(raw_json: DataFrame, **phases: str) -> DataFrame:
    """Times of the phases of mobility runs, from one reading; read as texts, so that a quoted number is cast as any other."""
    schema = "phases struct<" + ", ".join(f"{p}:struct<ms:string>" for p in phases.values()) + ">"
    read = F.from_json("payload", schema, {"allowUnquotedControlChars": "true"})
    runs = _of(raw_json, "mobility").select(F.explode(F.array(read)).alias("r"))
    return runs.select(*[F.col(f"r.phases.{p}.ms").try_cast("double").alias(n) for n, p in phases.items()])


def _median(value: Column) -> Column:
    return F.percentile(value, 0.5)


def _of(raw_json: DataFrame, record_type: str) -> DataFrame:
    return raw_json.where(F.col("record_type") == record_type)


def _keyed(df: DataFrame, *keys: str) -> DataFrame:
    """Keys as one text column, so that every comparison has the same shape."""
    text = [F.coalesce(F.col(k).cast("string"), F.lit("∅")) for k in keys]
    return df.withColumn("key", F.concat_ws("/", *text)) if keys else df.withColumn("key", F.lit("all"))


def _dtx_runs(raw_json: DataFrame) -> DataFrame:
    read = _fields(_of(raw_json, "dtx"), source="source", dtx="dtx", v="uplinkKbps")
    runs = read.select("source", F.coalesce(F.col("dtx").try_cast("boolean"), F.lit(False)).alias("dtx"), F.col("v").try_cast("double").alias("v"))
    return runs.where("v >= 0")


def reference_dtx(raw_json: DataFrame) -> DataFrame:
    cells = _dtx_runs(raw_json).groupBy("source", "dtx").agg(_median(F.col("v")).alias("expected"))
    return _keyed(cells, "source", "dtx").select("key", "expected")


def reference_sensing(raw_json: DataFrame) -> DataFrame:
    runs = _fields(_of(raw_json, "sensing"), scenario="scenario", clients="clients").where("scenario <> ''")
    clients = runs.select("scenario", F.explode_outer(F.from_json("clients", "map<string,string>")).alias("c", "body"))
    share = F.get_json_object("body", "$.stats.suppressedPct").try_cast("double")
    cells = clients.groupBy("scenario").agg(_median(share).alias("expected"))
    return cells.where("expected is not null").select(F.col("scenario").alias("key"), "expected")


def reference_gracegap(raw_json: DataFrame) -> DataFrame:
    read = _fields(_of(raw_json, "gracegap"), d="absenceMs", w="graceMs", v="reconnectGapMs")
    runs = read.withColumns(_as("int", "d", "w") | _as("double", "v")).where("v >= 0")
    return _keyed(runs.groupBy("d", "w").agg(_median(F.col("v")).alias("expected")), "d", "w").select("key", "expected")


def reference_mobility(raw_json: DataFrame) -> DataFrame:
    runs = _phases(raw_json, a="initialForm", b="teardown", v="reconnect").na.fill(-1.0).where("least(a, b, v) >= 0")
    return _keyed(runs.agg(_median(F.col("v")).alias("expected"))).select("key", "expected")


def reference_audiogap(raw_json: DataFrame) -> DataFrame:
    runs = _fields(_of(raw_json, "audiogap"), valid="valid", v="reconnectAudioGapMs").where(F.col("valid").try_cast("boolean"))
    return _keyed(runs.agg(_median(F.col("v").try_cast("double")).alias("expected"))).select("key", "expected")


def sized(raw_json: DataFrame) -> DataFrame:
    """Voice runs with their cluster size as ``_n``."""
    return _of(raw_json, "voice").withColumn("_n", _json("$.N", "int"))


def sized_with_clients(raw_json: DataFrame) -> DataFrame:
    """Voice runs with their cluster size as ``_n``, NULL without a client.

    One reading gives the size and whether clients are there; where it finds none, their own path decides.
    """
    read = F.from_json("payload", "N string, perClient array<struct<client:string>>", {"allowUnquotedControlChars": "true"})
    counted = F.coalesce(F.json_array_length(F.get_json_object("payload", "$.perClient")), F.lit(0))
    size = F.when((F.size("_r.perClient") > 0) | (counted > 0), F.col("_r.N").try_cast("int"))
    return _of(raw_json, "voice").withColumn("_r", F.explode(F.array(read))).withColumn("_n", size).drop("_r")


def _newest_files(runs: DataFrame) -> DataFrame:
    """The newest file of each cluster size (_n, _file), from runs (_n, source_file)."""
    return broadcast_if_small(settled(runs.groupBy("_n").agg(F.max("source_file").alias("_file"))))


def _bodies(raw_json: DataFrame, newest: DataFrame, explode) -> DataFrame:
    """Clients (n_peers, source_file, body) of the newest files, which are picked by name before a client is read."""
    named = raw_json.where(F.col("source_file").isin(newest.select("_file")))
    return named.select(
        _json("$.N", "int").alias("n_peers"), "source_file",
        explode(F.from_json(F.get_json_object("payload", "$.perClient"), "array<string>")).alias("body"),
    )


def reference_kpi_vs_n(raw_json: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """Set-up median of the newest run per N; ``runs`` gives ``sized`` and its files where they cost less to read."""
    voice = _of(raw_json, "voice")
    newest = _newest_files((sized(raw_json) if runs is None else runs).select("_n", "source_file"))
    setup = F.get_json_object("body", "$.kpis.setupMedianMs").try_cast("double")
    runs = _bodies(voice, newest, F.explode_outer).groupBy("n_peers", "source_file").agg(_median(F.when(setup >= 0, setup)).alias("expected"))
    same = newest["_n"].eqNullSafe(runs["n_peers"]) & (newest["_file"] == runs["source_file"])
    return newest.join(runs, same, "left").select(F.col("_n").cast("string").alias("key"), "expected")


def _newest_links(raw_stream: DataFrame) -> DataFrame:
    """The links (condition, body) of each session's newest report; a report without links keeps one row."""
    read = _fields(raw_stream.select("payload", "line"), condition="cond", s="sid", ts="ts", links="links").where("condition <> ''")
    lines = read.select("condition", "s", F.coalesce(F.col("ts").try_cast("bigint"), F.lit(0)).alias("at"), "line", "links")
    newest = lines.groupBy("condition", "s").agg(F.max_by("links", F.struct("at", "line")).alias("links"))
    return newest.select("condition", F.explode_outer(F.from_json("links", "array<string>")).alias("body"))


def reference_realnet(raw_stream: DataFrame) -> DataFrame:
    """Set-up median per condition over the links of each session's newest report."""
    link = _newest_links(raw_stream)
    setup = F.get_json_object("body", "$.setupMs").try_cast("double")
    cells = link.groupBy(F.col("condition").alias("k")).agg(_median(F.when(setup >= 0, setup)).alias("expected"))
    return cells.select(F.col("k").alias("key"), "expected")


def join_expected_actual(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Every expected group with the mart's value, NULL where the mart lacks it.

    Both sides hold one row per group, so one aggregate over their union pairs
    them: a single shuffle, and missing keys match missing keys.
    """
    sides = expected.select(*keys, "expected", F.lit(True).alias("_due")).unionByName(
        actual.select(*keys, "actual"), allowMissingColumns=True
    )
    paired = sides.groupBy(*keys).agg(
        F.max("expected").alias("expected"), F.max("actual").alias("actual"), F.max("_due").alias("_due")
    )
    return paired.where(F.col("_due")).drop("_due")


# Per mart: reference, which raw table it reads, mart keys, compared column.
MART_REFERENCES = {
    "dtx_uplink": (reference_dtx, "raw_json", ["source", "dtx"], "uplink_median_kbps_raw"),
    "sensing_suppression": (reference_sensing, "raw_json", ["scenario"], "suppression_median_pct_raw"),
    "gracegap_series": (reference_gracegap, "raw_json", ["absence_ms", "grace_ms"], "gap_median_ms_raw"),
    "mobility_cycles": (reference_mobility, "raw_json", [], "reconnect_median_ms_raw"),
    "audiogap": (reference_audiogap, "raw_json", [], "reconnect_median_ms_raw"),
    "kpi_vs_n": (reference_kpi_vs_n, "raw_json", ["n_peers"], "setup_median_ms_raw"),
    "realnet_conditions": (reference_realnet, "raw_stream", ["condition"], "setup_median_ms_raw"),
}


def compare_mart(name: str, expected: DataFrame, mart: DataFrame, tol: float = TOLERANCE) -> DataFrame:
    _, _, keys, column = MART_REFERENCES[name]
    actual = _keyed(mart, *keys).select("key", F.col(column).alias("actual"))
    joined = join_expected_actual(expected, actual, ["key"])
    return joined.select(
        F.concat(F.lit(name + "["), "key", F.lit("]")).alias("check"),
        F.col("expected").cast("string").alias("expected"),
        F.col("actual").cast("double").alias("actual"),
        compare_within_tolerance("expected", "actual", tol).alias("ok"),
    )


# All columns of a mart


def _figures(value: Column, name: str, spread: bool = True, rate: bool = False) -> list[Column]:
    """Median, as it is and rounded, with the least and largest value; ``rate`` marks means."""
    middle = F.avg(value) if rate else _median(value)
    made = [F.round(middle).alias(name), middle.alias(name + "_raw")]
    return made + ([F.min(value).alias(name.replace("_median_", "_min_")), F.max(value).alias(name.replace("_median_", "_max_"))] if spread else [])


def _known(value: Column) -> Column:
    return F.when(value >= 0, value)


def _dtx_columns(raw_json: DataFrame) -> DataFrame:
    return _dtx_runs(raw_json).groupBy("source", "dtx").agg(F.count(F.lit(1)).alias("n"), *_figures(F.col("v"), "uplink_median_kbps", spread=False))


def _sensing_columns(raw_json: DataFrame) -> DataFrame:
    runs = _fields(_of(raw_json, "sensing"), scenario="scenario", clients="clients").where("scenario <> ''")
    clients = runs.select("scenario", "source_file", F.explode(F.from_json("clients", "map<string,string>")).alias("c", "body"))
    share = F.get_json_object("body", "$.stats.suppressedPct").try_cast("double")
    # runs and shares are counted side by side, so that clients are read once and no median is kept per run
    sides = clients.select("scenario", "source_file", share.alias("share")).select("scenario", F.inline(F.array(
        F.struct(F.lit(True).alias("run"), "source_file", F.lit(None).cast("double").alias("share")),
        F.struct(F.lit(False).alias("run"), F.lit(None).cast("string").alias("source_file"), "share"))))
    counted = sides.groupBy("scenario", "run", "source_file", "share").agg(F.count(F.lit(1)).alias("n"))
    middle = F.percentile("share", 0.5, F.col("n"))
    return counted.groupBy("scenario").agg(
        F.count_if("run").alias("trials"), F.round(middle).alias("suppression_median_pct"), middle.alias("suppression_median_pct_raw"))


def _gracegap_columns(raw_json: DataFrame) -> DataFrame:
    read = _fields(_of(raw_json, "gracegap"), absence_ms="absenceMs", grace_ms="graceMs", v="reconnectGapMs", stop="stopAfterOutMs", hold="holdKbps")
    runs = read.withColumns(_as("int", "absence_ms", "grace_ms") | _as("double", "v", "stop", "hold"))
    return runs.where("v >= 0").groupBy("absence_ms", "grace_ms").agg(
        F.count(F.lit(1)).alias("n"), *_figures(F.col("v"), "gap_median_ms"),
        *_figures(_known(F.col("stop")), "stop_median_ms", spread=False), *_figures(_known(F.col("hold")), "hold_median_kbps", spread=False))


def _mobility_columns(raw_json: DataFrame) -> DataFrame:
    phases = {"form": "initialForm", "teardown": "teardown", "reconnect": "reconnect"}
    whole = _phases(raw_json, **phases).where("form >= 0 and teardown >= 0 and reconnect >= 0")
    return whole.agg(F.count(F.lit(1)).alias("complete_cycles"), *[c for name in phases for c in _figures(F.col(name), f"{name}_median_ms")])


def _audiogap_columns(raw_json: DataFrame) -> DataFrame:
    phases = {"stop": "audioStopAfterOutMs", "reconnect": "reconnectAudioGapMs", "total_silence": "totalSilenceMs"}
    read = _fields(_of(raw_json, "audiogap"), valid="valid", **phases).where(F.col("valid").try_cast("boolean"))
    runs = read.select(*[c.alias(n) for n, c in _as("double", *phases).items()])
    return runs.agg(F.count(F.lit(1)).alias("valid_runs"), *[c for name in phases for c in _figures(F.col(name), f"{name}_median_ms")])


def _kpi_columns(raw_json: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """``runs`` gives ``sized_with_clients`` and its files where they cost less to read."""
    voice = _of(raw_json, "voice")
    newest = _newest_files((sized_with_clients(raw_json) if runs is None else runs).select("_n", "source_file"))
    clients = _bodies(voice, newest, F.explode)
    of = lambda path: F.get_json_object("body", f"$.{path}").try_cast("double")
    fields = {"setup_median_ms": "kpis.setupMedianMs", "setup_p95_ms": "kpis.setupP95Ms", "ice_success_pct": "kpis.iceSuccessPct", "relay_pct": "kpis.relayPct",
              "m2e_ms": "kpis.latRawMedianMs", "uplink_kbps": "meanUpKbps", "suppressed_pct": "sense.suppressedPct"}
    known = {n: of(p) if n in ("uplink_kbps", "suppressed_pct") else _known(of(p)) for n, p in fields.items()}
    figures = [c for n, v in known.items() for c in _figures(v, n, spread=False, rate=not n.startswith("setup"))]
    same = (clients["n_peers"] == newest["_n"]) & (clients["source_file"] == newest["_file"])
    return clients.join(newest, same, "left_semi").groupBy("n_peers").agg(
        F.round(F.avg(of("peers")), 1).alias("avg_peers"), F.sum(F.greatest(of("kpis.links"), F.lit(0.0))).alias("conn_links"),
        *figures, F.sum(of("kpis.glareTotal")).alias("glare_total"))


def _realnet_columns(raw_stream: DataFrame) -> DataFrame:
    names = ["setupMs", "rttMs", "candidateType", "glare"]
    link = _newest_links(raw_stream).select("condition", F.json_tuple("body", *names).alias(*names))
    setup, rtt = (_known(F.col(name).try_cast("double")) for name in ("setupMs", "rttMs"))
    relayed = F.coalesce(F.bool_or(F.col("candidateType") == "relay"), F.lit(False))
    return link.groupBy("condition").agg(
        F.when(relayed, "relay").otherwise("direct").alias("path"), F.count(setup).alias("links"),
        *_figures(setup, "setup_median_ms", spread=False), *_figures(rtt, "rtt_median_ms", spread=False), F.sum(F.col("glare").try_cast("double")).alias("glare_total"),
    ).withColumn("access", access_of("condition"))


FULL_REFERENCES = {
    "dtx_uplink": _dtx_columns, "sensing_suppression": _sensing_columns, "gracegap_series": _gracegap_columns, "mobility_cycles": _mobility_columns,
    "audiogap": _audiogap_columns, "kpi_vs_n": _kpi_columns, "realnet_conditions": _realnet_columns,
}
# Columns are summed by key in so many buckets; only buckets whose sums differ are compared row by row.
BUCKETS = 64


def _canonical(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """key, bucket and the columns as text: numbers to six decimals, so that equal figures of other types agree."""
    kinds = dict(df.dtypes)
    number = lambda c: kinds[c] not in ("string", "boolean")
    shown = [F.format_string("%.6f", F.col(c).cast("double") + F.lit(0.0)) if number(c) else F.col(c).cast("string") for c in columns]
    made = _keyed(df, *keys).select("key", *[F.when(F.col(c).isNotNull(), v).alias(c) for c, v in zip(columns, shown, strict=True)])
    return made.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int"))


def compare_columns(name: str, expected: DataFrame, actual: DataFrame, keys: list[str], tol: float = TOLERANCE) -> DataFrame:
    """Every column of two tables with a row per key: (check, rows, differing, buckets, key, expected, actual, ok).

    One aggregate over both sides sums the rows' hashes per bucket and column, the
    second side with the opposite sign, so equal columns come to nothing. Rows are joined
    only in buckets that do not: there numbers may differ by ``tol``, and a key that one
    side lacks differs in all columns. ``buckets`` names the buckets that were compared,
    key the first one that differs.
    """
    columns = sorted(c for c in expected.columns if c not in keys)
    missing = set(columns) - set(actual.columns) | set(keys) - set(actual.columns)
    if missing:
        raise ValueError(f"{name} has no columns {sorted(missing)}")
    sides = [_canonical(df, keys, columns) for df in (expected, actual)]
    signed = [df.withColumn("_sign", F.lit(sign)) for df, sign in zip(sides, (1, -1), strict=True)]
    hashed = lambda c: F.sum(F.xxhash64("key", F.coalesce(F.col(c), F.lit("∅"))).cast("decimal(20,0)") * F.col("_sign"))
    sums = signed[0].unionByName(signed[1]).groupBy("bucket").agg(
        F.count_if(F.col("_sign") == 1).alias("_rows"), *[(hashed(c) != 0).alias(c) for c in columns])
    found = sums.collect()  # BUCKETS rows at most
    total = sum(r["_rows"] for r in found)
    differing = {c: sorted(r["bucket"] for r in found if r[c]) for c in columns}
    open_buckets = sorted({b for bs in differing.values() for b in bs})
    rows = [(f"{name}.{c}", total, differing[c]) for c in columns]
    spark = expected.sparkSession
    base = spark.createDataFrame(rows, "check string, rows long, buckets array<int>")
    nothing = "check string, differing long, key string, expected string, actual string"
    told = spark.createDataFrame([], nothing)
    if open_buckets:
        one, other = (df.where(F.col("bucket").isin(open_buckets)).drop("bucket") for df in sides)
        pairs = one.select("key", F.lit(True).alias("_one"), *[F.col(c).alias("e_" + c) for c in columns]).join(
            other.select("key", F.lit(True).alias("_other"), *[F.col(c).alias("a_" + c) for c in columns]), "key", "full_outer")
        cells = F.explode(F.array(*[
            F.struct(F.lit(f"{name}.{c}").alias("check"), F.col("e_" + c).alias("expected"), F.col("a_" + c).alias("actual")) for c in columns])).alias("_c")
        numbers = [F.col(side).try_cast("double") for side in ("expected", "actual")]
        same = F.col("expected").eqNullSafe(F.col("actual")) | F.coalesce(F.abs(numbers[0] - numbers[1]) <= tol, F.lit(False))
        apart = pairs.select("key", "_one", "_other", cells).select("key", "_one", "_other", "_c.*").where(~same | F.col("_one").isNull() | F.col("_other").isNull())
        first = F.min(F.struct("key", "expected", "actual")).alias("_first")
        told = apart.groupBy("check").agg(F.count(F.lit(1)).alias("differing"), first).select("check", "differing", "_first.*")
    report = base.join(told, "check", "left")
    return report.select(
        "check", "rows", F.coalesce("differing", F.lit(0)).alias("differing"), "buckets", "key", "expected", "actual", F.col("differing").isNull().alias("ok"))


def newest_by_both_sizes(sizes: DataFrame) -> DataFrame:
    """The newest file per pair of sizes, as the mart (n_peers) and as the reference (_n) read it from the same payload.

    The newest file of either size is the newest of its pairs, so payloads are made once for both.
    """
    return settled(voice_runs(sizes, "_n").groupBy("n_peers", "_n").agg(F.max("source_file").alias("source_file")))


# A mart, or what makes it; ``Runs`` makes the ``runs`` of ``reference_kpi_vs_n``.
Mart = DataFrame | Callable[[], DataFrame]
Runs = Callable[[], DataFrame] | None


def _side_by_side(raw: dict[str, DataFrame], made: dict[str, Callable], marts: dict[str, Mart], compare: Callable, runs: Runs) -> list[DataFrame]:
    """Every mart compared to its reference; each pair is made and compared in a step of its own."""

    def step(name: str) -> DataFrame:
        more = [runs()] if name == "kpi_vs_n" and runs else []
        expected = made[name](raw[MART_REFERENCES[name][1]], *more)
        return compare(name, expected, marts[name]() if callable(marts[name]) else marts[name])

    return list(at_once(next(iter(raw.values())).sparkSession, {name: partial(step, name) for name in made}).values())


def compare_all(raw: dict[str, DataFrame], marts: dict[str, Mart], tol: float = TOLERANCE, runs: Runs = None) -> list[DataFrame]:
    """The compared column of all marts against their references."""
    made = {name: reference for name, (reference, _, _, _) in MART_REFERENCES.items()}
    return _side_by_side(raw, made, marts, partial(compare_mart, tol=tol), runs)


def compare_all_columns(raw: dict[str, DataFrame], marts: dict[str, Mart], tol: float = TOLERANCE, runs: Runs = None) -> DataFrame:
    """All columns of all marts against their second reduction."""
    compare = lambda name, expected, actual: compare_columns(name, expected, actual, MART_REFERENCES[name][2], tol)
    return reduce(DataFrame.unionByName, _side_by_side(raw, FULL_REFERENCES, marts, compare, runs))


def reference_rounded(reference: DataFrame) -> DataFrame:
    """The reducer's printed form of a reference: whole numbers, ties to even."""
    return reference.withColumn("expected", round_half_even("expected"))


def check_bands(metrics: DataFrame, bands: DataFrame) -> DataFrame:
    """Metrics (mart, key, metric, value) against bands; a band without a key holds for all."""
    joined = metrics.alias("m").join(
        F.broadcast(bands).alias("b"),  # the fixed list above
        (F.col("m.mart") == F.col("b.mart"))
        & (F.col("m.metric") == F.col("b.metric"))
        & F.coalesce(F.col("b.key") == F.col("m.key"), F.lit(True)),
    )
    inside = F.coalesce(F.col("value").between(F.col("low"), F.col("high")), F.lit(False))
    return joined.select(
        F.concat(F.col("m.mart"), F.lit("["), F.col("m.key"), F.lit("]."), F.col("m.metric")).alias("check"),
        F.concat(F.lit("["), F.col("low").cast("string"), F.lit(","), F.col("high").cast("string"), F.lit("]")).alias("expected"),
        F.col("value").alias("actual"),
        inside.alias("ok"),
    )


def band_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BANDS, "mart string, key string, metric string, low double, high double")


def mart_metrics(marts: dict[str, DataFrame]) -> DataFrame:
    """The banded columns of the marts, unpivoted."""
    parts = []
    for mart, df in marts.items():
        columns = sorted({b[2] for b in BANDS if b[0] == mart})
        if columns:
            keyed = _keyed(df, *MART_REFERENCES[mart][2]).select("key", *[F.col(c).cast("double") for c in columns])
            parts.append(keyed.unpivot("key", columns, "metric", "value").withColumn("mart", F.lit(mart)))
    return reduce(DataFrame.unionByName, parts)


def parity_report(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def parity_ok(report: DataFrame) -> DataFrame:
    return report.agg(F.coalesce(F.bool_and("ok"), F.lit(True)).alias("ok"))
