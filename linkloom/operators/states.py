"""Lifecycles and state machines over ordered events.

Link lifecycles, voice activity and grace windows look stateful but reduce to
windows over history; the reason is given with each. Only event suppression needs
a walk, because each decision depends on the one before it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from linkloom import session as settings
from linkloom.functions.scalars import ignores_offer
from linkloom.functions.sensing import (
    HEARTBEAT_MS,
    LOSS_DELTA_PCT,
    MOVE_TILES,
    RTT_DELTA_MS,
    RTT_DELTA_SHARE,
    Heard,
    Thresholds,
    Track,
    exit_states,
)
from linkloom.operators.chains import FRESH, chunk_entries, compact, map_schema
from linkloom.operators.history import (
    CHUNK,
    History,
    broadcast_if_small,
    first_at_or_after,
    has_hot_keys,
    same_keys,
    spread,
)

SETTLING = ("connected", "failed", "closed")


# Links


MEASURES = {"candidate_type": "string", "rtt_ms": "bigint", "lat_raw_ms": "bigint"}


def link_lifecycle(
    events: DataFrame,
    order: list[str] | None = None,
    limit: int | None = None,
    samples: DataFrame | None = None,
) -> DataFrame:
    """Fold state changes into one record per (session, peer, incarnation).

    A detection opens a record unless the open one is still pending. Right after
    any detection the record is pending, whether new or kept; so a detection opens
    a new one exactly if the event before it, among detections and settling
    events, is not itself a detection. That is one look back and one running count.

    With ``samples`` (session, peer, t_ms and the measures) each record also gets
    the last measured candidate type, round trip and latency of its time.
    """
    order = order or ["t_ms"]
    line = events.where(F.col("state").isin("detected", *SETTLING))
    if samples is not None:
        # At equal times a change comes first, so a sample belongs to what it opened.
        measures = [F.col(m).cast(kind).alias(m) for m, kind in MEASURES.items()]
        sampled = samples.select("session", "peer", *order, *measures, F.lit(1).alias("_turn"))
        line = line.withColumn("_turn", F.lit(0)).unionByName(sampled, allowMissingColumns=True)
        order = [*order, "_turn"]
    history = History(line, ["session", "peer"], order, limit)
    history = history.running(_prior=("last", F.col("state"), False))
    opens = (F.col("state") == "detected") & (F.coalesce("_prior", F.lit("")) != "detected")
    history = history.with_columns(_opens=F.coalesce(opens, F.lit(False)).cast("int"))
    numbered = history.running(incarnation=("sum", F.col("_opens"))).where(F.col("incarnation") > 0)

    at = lambda state: F.min(F.when(F.col("state") == state, F.col("t_ms")))
    found = {
        "detected_ms": at("detected"),
        "_connected": at("connected"),
        "_failures": F.count_if(F.col("state").isin("failed", "closed")),
    }
    if samples is not None:
        measured = {
            "candidate_type": F.col("candidate_type") != "",
            "rtt_ms": F.col("rtt_ms") >= 0,
            "lat_raw_ms": F.col("lat_raw_ms") >= 0,
        }
        found |= {m: F.max_by(m, F.when(ok, F.col("t_ms"))) for m, ok in measured.items()}
    records = numbered.rows().groupBy("session", "peer", "incarnation").agg(
        *[c.alias(n) for n, c in found.items()]
    )
    setup = F.floor(F.col("_connected") - F.col("detected_ms") + F.lit(0.5))
    unmeasured = {"candidate_type": "", "rtt_ms": -1, "lat_raw_ms": -1}
    return records.select(
        "session", "peer", "incarnation", "detected_ms",
        F.coalesce("_connected", F.lit(-1)).alias("connected_ms"),
        F.coalesce(setup, F.lit(-1)).cast("bigint").alias("setup_ms"),
        (F.col("_connected").isNull() & (F.col("_failures") > 0)).alias("failed"),
        *[F.coalesce(m, F.lit(unmeasured[m])).alias(m) for m in MEASURES if samples is not None],
    )


def glare_count(offers: DataFrame) -> DataFrame:
    """Ignored colliding offers per link."""
    ignored = ignores_offer("my_nonce", "remote_nonce", "making_offer", "state")
    return offers.groupBy("session", "peer").agg(F.count_if(ignored).alias("glare"))


def never_connected_timeout(
    ticks: DataFrame, restart_ms: int = 3000, recreate_ms: int = 8000
) -> DataFrame:
    """Watchdog actions on peers that never connected, from one row per peer and tick.

    A restart is asked once, by the impolite side of a stable negotiation whose
    transport never started; a recreate ends the peer, so nothing follows it.
    """
    age = F.col("t_ms") - F.col("born_ms")
    stuck = ~F.col("ever_connected")
    idle = (F.col("signaling") == "stable") & (F.col("ice") == "new")
    impolite = (F.col("remote_nonce") >= 0) & (F.col("my_nonce") > F.col("remote_nonce"))
    when = lambda rule: F.min(F.when(rule, F.col("t_ms")))
    first = ticks.groupBy("session", "peer", "born_ms").agg(
        when(stuck & (age > restart_ms) & idle & impolite).alias("restart"),
        when(stuck & (age > recreate_ms)).alias("recreate"),
    )
    in_time = F.col("recreate").isNull() | (F.col("restart") <= F.col("recreate"))
    acts = first.withColumn("restart", F.when(in_time, F.col("restart"))).unpivot(
        ["session", "peer", "born_ms"], ["restart", "recreate"], "action", "t_ms"
    )
    return acts.where(F.col("t_ms").isNotNull()).select("session", "peer", "born_ms", "t_ms", "action")


# Voice activity


def _streaks(history: History, **conditions: Column) -> History:
    """Add, per condition, the length of the unbroken run of rows meeting it, up to this row."""
    broken = {n: ("max", F.when(~c, F.col("_n"))) for n, c in conditions.items()}
    return history.running(**broken).with_columns(
        **{n: F.col("_n") - F.coalesce(F.col(n), F.lit(0)) for n in conditions}
    )


def vad_edges(
    levels: DataFrame,
    open_rms: float = 0.06,
    close_rms: float = 0.035,
    open_ms: int = 120,
    hang_ms: int = 700,
    poll_ms: int = 50,
    limit: int | None = None,
) -> DataFrame:
    """Open and close edges of speech per stream.

    A loud streak long enough to open cannot span a close (the row that closes is
    quiet), nor a quiet one an open. So streaks need no knowledge of the state,
    and an edge is a full streak whose kind differs from the last full one.
    """
    history = History(levels, ["stream"], ["t_ms"], limit).running(_n=("sum", F.lit(1)))
    history = _streaks(
        history,
        _loud=F.coalesce(F.col("rms") >= open_rms, F.lit(False)),
        _quiet=F.coalesce(F.col("rms") < close_rms, F.lit(False)),
    )
    full = F.when(F.col("_loud") >= math.ceil(open_ms / poll_ms), "open").when(
        F.col("_quiet") >= math.ceil(hang_ms / poll_ms), "close"
    )
    history = history.with_columns(edge=full).running(_state=("last", F.col("edge"), False))
    crossed = F.col("edge") != F.coalesce("_state", F.lit("close"))
    return history.rows().where(crossed).select("stream", "t_ms", "edge")


def speech_intervals(edges: DataFrame) -> DataFrame:
    """One row per open..close span; the end is NULL while speech goes on."""
    ended = History(edges.withColumn("_back", -F.col("t_ms")), ["stream"], ["_back"]).previous(
        end_ms=F.col("t_ms")
    )
    return ended.rows().where("edge = 'open'").select("stream", F.col("t_ms").alias("start_ms"), "end_ms")


# Grace windows


def grace_window(ticks: DataFrame, w_ms: int, limit: int | None = None) -> DataFrame:
    """Links per (node, peer) when an absence shorter than ``w_ms`` keeps a link warm.

    An absence starts at the node's first tick without the peer and ends the link
    at its first tick at least ``w_ms`` later, unless the peer is back by then. A
    return therefore finds the link gone exactly if the tick before it is that late.
    """
    # A node's ticks, sightings and links together bound every step below.
    hot = has_hot_keys(ticks, ["node"], limit, F.size("in_range") + 2)
    line = ticks.withColumn("_back", -F.col("t_ms"))
    ahead = History(line, ["node"], ["_back"], limit, hot).previous(_next=F.col("t_ms")).rows()
    around = History(ahead, ["node"], ["t_ms"], limit, hot).previous(_prev=F.col("t_ms")).rows()
    seen = around.select("node", F.explode("in_range").alias("peer"), "t_ms", "_prev", "_next")
    history = History(seen, ["node", "peer"], ["t_ms"], limit, hot).previous(
        _seen=F.col("t_ms"), _left=F.col("_next")
    )
    away = F.col("_prev") > F.col("_seen")
    late = F.lit(True) if w_ms <= 0 else F.col("_prev") >= F.col("_left") + w_ms
    fresh = F.col("_seen").isNull() | (away & late)
    links = history.with_columns(_fresh=fresh.cast("int")).running(link=("sum", F.col("_fresh")))
    spans = links.rows().groupBy("node", "peer", "link").agg(
        F.min("t_ms").alias("start_ms"),
        (F.max_by("_next", "t_ms") + max(w_ms, 0)).alias("_deadline"),
    )
    closed = first_at_or_after(spans, ticks, ["node"], "_deadline", "t_ms", "end_ms", limit, hot)
    return closed.select(
        "node", "peer", "link", "start_ms", "end_ms",
        (F.col("end_ms") - F.col("start_ms")).alias("held_ms"),
    )


# Event suppression


_READING = ["index", "state", "rttMs", "lossPct"]


def node_columns(samples: DataFrame, order: list[str] | None = None) -> DataFrame:
    """What the decision reads, with the link structs as parallel arrays, which reach Python fast.

    Samples of one time are put in the order of ``order`` (a sequence of arrival) and
    then of their content, so the order is total whatever order they arrive in; samples
    alike in all of it are interchangeable.
    """
    arrays = [F.coalesce(F.col(f"links.{f}"), F.array()).alias(f"link_{f}") for f in _READING]
    content = F.xxhash64("forced_kind", "x", "y", *[F.col(f"links.{f}") for f in _READING])
    return samples.select("session", "t_ms", *(order or []), "forced_kind", "x", "y", *arrays, content.alias("_content"))


def track_of(batch: pa.RecordBatch | pa.Table | pd.DataFrame) -> Track:
    """Samples of ``node_columns`` as columns of plain values; lists are read where they lie, not row by row."""
    if isinstance(batch, pd.DataFrame):
        batch = pa.Table.from_pandas(batch[["t_ms", "forced_kind", "x", "y", *[f"link_{f}" for f in _READING]]], preserve_index=False)
    whole = lambda name: batch.column(name).combine_chunks() if isinstance(batch, pa.Table) else batch.column(name)
    plain = lambda column: column.to_numpy(zero_copy_only=False).astype(float).tolist()
    peers = whole("link_index")
    offsets = peers.offsets.to_numpy()
    flat = [whole(f"link_{f}").flatten() for f in _READING]
    return Track(
        whole("t_ms").to_pylist(), whole("forced_kind").to_pylist(), plain(whole("x")), plain(whole("y")), (offsets - offsets[0]).tolist(),
        flat[0].to_pylist(), flat[1].to_pylist(), plain(flat[2]), plain(flat[3]),
    )


_VERDICT = "t_ms bigint, kind string, note string, suppressed boolean"


def _decided(session: pa.Array, t: pa.Array, said: dict[int, tuple[str, str]], size: int) -> list[pa.Array]:
    kind, note = [None] * size, [""] * size
    for at, (of, why) in said.items():
        kind[at], note[at] = of, why
    return [session, t, pa.array(kind, pa.string()), pa.array(note, pa.string()), pa.array([k is None for k in kind], pa.bool_())]


def event_suppression(
    samples: DataFrame,
    move: float = MOVE_TILES,
    rtt_ms: float = RTT_DELTA_MS,
    rtt_frac: float = RTT_DELTA_SHARE,
    loss: float = LOSS_DELTA_PCT,
    heartbeat_ms: int = HEARTBEAT_MS,
    limit: int | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Per sample: the report it causes (kind, note) or that it is suppressed.

    Input: session, t_ms, forced_kind, x, y, links[{index, state, rttMs, lossPct}], and
    the columns named in ``order``, which tell samples of one millisecond apart.
    Forced kinds always report; ``node-sleep`` reports and then forgets the node.
    Sorted sessions stream through a task in batches, with only the last report
    kept. A session too long for one task is cut into chunks: a chunk can only be
    entered with a last report from the heartbeat span before it, so its exit is
    found for each of those, the exits are chained, and the chunks decided apart.
    """
    limits = Thresholds(move, rtt_ms, rtt_frac, loss, heartbeat_ms)
    bound = limit or min(200_000, settings.hot_rows(samples.sparkSession))
    total = ["t_ms", *(order or []), "_content"]
    history = History(node_columns(samples, order), ["session"], total, bound)
    schema = StructType([samples.schema["session"], *StructType.fromDDL(_VERDICT).fields])
    if history.chunked:
        return _suppress_chunked(history, limits, schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, Heard()
        for batch in batches:
            if not batch.num_rows:
                continue
            track, session, said = track_of(batch), batch.column("session"), {}
            runs = pc.run_end_encode(session)
            ends = runs.run_ends.to_pylist()
            for start, stop, name in zip([0, *ends[:-1]], ends, runs.values.to_pylist(), strict=True):
                if start or last is None or name != last[0]:
                    known = Heard()
                for at, kind, note, known in track.reports(known, start, stop, limits):
                    said[at] = kind, note
                last = (name,)
            yield pa.RecordBatch.from_arrays(_decided(session, batch.column("t_ms"), said, len(track)), names=schema.names)

    ordered = spread(history.df, "session").sortWithinPartitions("session", *total)
    return ordered.mapInArrow(scan, schema)


def _suppress_chunked(history: History, limits: Thresholds, schema: StructType) -> DataFrame:
    keys = ["session", CHUNK]
    # a sample's number in its session names the last report, where times may repeat
    rows = history.running(_number=("sum", F.lit(1))).df
    across = Window.partitionBy("session").orderBy(CHUNK)
    soon = Window.partitionBy("session").orderBy("_end").rangeBetween(0, limits.heartbeat_ms)
    ends = rows.groupBy(*keys).agg(F.max("t_ms").alias("_end")).withColumn("_next", F.lead(CHUNK).over(across))
    # The chunks a row may still matter to: mostly the next one, more only where chunks are shorter
    # than the heartbeat. Only chunks a session crosses the end of are kept: at most one row per chunk.
    reach = F.collect_list(F.struct(F.col("_next").alias("chunk"), F.col("_end").alias("end"))).over(soon)
    ends = broadcast_if_small(
        ends.withColumn("_reach", reach).where(F.col("_next").isNotNull())
        .select(*[F.col(k).alias("_b_" + k) for k in keys], "_reach")
    )
    near = rows.join(ends, same_keys(rows, ends, keys, "_b_")).withColumn("_to", F.explode("_reach"))
    # chunks that end at one time reach each other, so only later ones are meant
    near = near.where((F.col("_to.chunk") > F.col(CHUNK)) & (F.col("t_ms") > F.col("_to.end") - limits.heartbeat_ms))
    before = near.withColumn(CHUNK, F.col("_to.chunk")).select(*rows.columns)
    pieces = before.withColumn("_own", F.lit(False)).unionByName(rows.withColumn("_own", F.lit(True)))

    def ordered(piece: pd.DataFrame) -> tuple[pd.DataFrame, int]:
        piece = piece.sort_values(["_own", "_number"], ignore_index=True)
        return piece, int((~piece["_own"]).sum())

    def exits(piece: pd.DataFrame) -> pd.DataFrame:
        piece, own = ordered(piece)
        entries, leads_to = compact(exit_states(track_of(piece), piece["_number"].to_numpy(), own, limits, FRESH))
        return piece[keys].iloc[:1].assign(entries=[entries], exits=[leads_to])

    maps = spread(pieces, *keys).groupBy(*keys).applyInPandas(exits, map_schema(pieces, keys))
    entries = chunk_entries(maps, ["session"]).select(
        F.col("session").alias("_e_session"), F.col(CHUNK).alias("_e_" + CHUNK), "entry"
    )
    entered = pieces.join(entries, same_keys(pieces, entries, keys, "_e_"))
    entered = entered.drop("_e_session", "_e_" + CHUNK)

    def decide(piece: pd.DataFrame) -> pd.DataFrame:
        piece, own = ordered(piece)
        track, entry = track_of(piece), int(piece["entry"].iloc[0])
        last = np.flatnonzero(piece["_number"].to_numpy()[:own] == entry)
        known = track.heard(int(last[0])) if len(last) else Heard()
        said = {at - own: (kind, note) for at, kind, note, _ in track.reports(known, own, len(track), limits)}
        out = piece[["session", "t_ms"]].iloc[own:].copy()
        verdicts = [said.get(k, (None, "")) for k in range(len(out))]
        return out.assign(kind=[kind for kind, _ in verdicts], note=[note for _, note in verdicts], suppressed=[kind is None for kind, _ in verdicts])

    return spread(entered, *keys).groupBy(*keys).applyInPandas(decide, schema)


def heartbeat_due(decisions: DataFrame) -> DataFrame:
    """The reports sent only because the node had been quiet too long."""
    return decisions.where(F.col("kind") == "heartbeat")


def session_reset(decisions: DataFrame) -> DataFrame:
    """Final reports of nodes going to sleep, after which their state starts afresh."""
    return decisions.where(F.col("kind") == "node-sleep")
