"""Measures that need the order of samples: rates, latency, phases, stalls, verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkloom.functions.scalars import (
    DEVICE_CONST_MS,
    VIRTUAL_BUDGET_BYTES,
    calibrated_ms,
    mouth_to_ear_ms,
    up_kbps,
)
from linkloom.operators.history import History, first_at_or_after, has_hot_keys

LINK = ["session", "peer"]


# Counters


def _byte_deltas(samples: DataFrame, hot: bool | None = None) -> History:
    """Byte and time deltas to the link's previous sample; a falling counter was reset."""
    history = History(samples, LINK, ["t_ms"], hot=hot).previous(
        _bytes=F.col("bytes_sent"), _t=F.col("t_ms")
    )
    delta = F.col("bytes_sent") - F.col("_bytes")
    return history.with_columns(
        bytes_delta=F.when(delta >= 0, delta), ms_delta=F.col("t_ms") - F.col("_t")
    )


def uplink_rate(samples: DataFrame) -> DataFrame:
    """Add ``up_kbps`` since the previous sample; -1 the first time or after a reset."""
    rated = _byte_deltas(samples).with_columns(up_kbps=up_kbps("bytes_delta", "ms_delta"))
    return rated.rows().drop("_bytes", "_t", "bytes_delta", "ms_delta")


def jitter_buffer_avg(samples: DataFrame) -> DataFrame:
    """Add the recent mean jitter-buffer delay in ms.

    The counters accumulate, so their deltas give the recent mean. The first
    populated read and a reset fall back to the lifetime mean; -1 before that.
    The base is the last *populated* read, not merely the previous row.
    """
    delay, count = F.col("jb_delay"), F.col("jb_count")
    populated = (delay >= 0) & (count > 0)
    read = F.when(populated, F.struct(delay.alias("delay"), count.alias("count")))
    history = History(samples, LINK, ["t_ms"]).running(_base=("last", read, False))
    more = (count > F.col("_base.count")) & (delay >= F.col("_base.delay"))
    recent = (delay - F.col("_base.delay")) / F.nullif(count - F.col("_base.count"), F.lit(0))
    mean = F.when(more, recent).otherwise(delay / F.nullif(count, F.lit(0))) * 1000
    average = F.coalesce(F.when(populated, mean), F.lit(-1.0))
    return history.with_columns(jb_avg_ms=average).rows().drop("_base")


def mouth_to_ear(samples: DataFrame, device_ms: float = DEVICE_CONST_MS) -> DataFrame:
    """Add ``lat_raw_ms``; -1 where either part is unmeasured."""
    measured = (F.col("rtt_s") >= 0) & (F.col("jb_avg_ms") >= 0)
    estimate = F.when(measured, mouth_to_ear_ms("rtt_s", "jb_avg_ms", device_ms))
    return samples.withColumn("lat_raw_ms", F.coalesce(estimate, F.lit(-1)))


def calibrate_latency(samples: DataFrame, offset: float) -> DataFrame:
    return samples.withColumn("lat_cal_ms", calibrated_ms("lat_raw_ms", F.lit(offset)))


def residual_energy(
    samples: DataFrame, budget: int = VIRTUAL_BUDGET_BYTES, hot: bool | None = None
) -> DataFrame:
    """Add energy 0..1 and where it comes from: forced, battery, or bytes charged to a budget."""
    spent = History(samples, ["session"], ["t_ms"], hot=hot).running(
        _spent=("sum", F.coalesce(F.col("bytes_delta"), F.lit(0)))
    )
    virtual = F.greatest(F.lit(0.0), 1 - F.col("_spent") / F.lit(budget))
    source = (
        F.when(F.col("forced").isNotNull(), "forced")
        .when(F.col("battery").isNotNull(), "battery")
        .otherwise("virtual")
    )
    return spent.with_columns(
        energy=F.coalesce("forced", "battery", virtual), source=source
    ).rows().drop("_spent")


def node_energy(samples: DataFrame, budget: int = VIRTUAL_BUDGET_BYTES) -> DataFrame:
    """Residual energy straight from link counters, debiting every forward byte delta."""
    hot = has_hot_keys(samples, ["session"])  # no link has more rows than its session
    deltas = _byte_deltas(samples, hot).rows()
    return residual_energy(deltas, budget, hot).drop("_bytes", "_t", "ms_delta")


def last_n_reports(reports: DataFrame, n: int = 500, tiebreak: list[str] | None = None) -> DataFrame:
    """The newest ``n`` reports per session.

    Spark applies a rank limit before the shuffle too (for ``n`` up to its
    windowGroupLimitThreshold, 1000 unless set), so a session sends at most ``n``
    rows from each task, however long its history.
    """
    newest = Window.partitionBy("session").orderBy(
        F.col("t").desc(), *[F.col(c).desc() for c in tiebreak or []]
    )
    return reports.withColumn("_rank", F.row_number().over(newest)).where(
        F.col("_rank") <= n
    ).drop("_rank")


# Phases


def phase_timing(samples: DataFrame, phases: DataFrame) -> DataFrame:
    """Per run and phase: ms from its start until the peer count hits the target, -1 on timeout."""
    wanted = phases.withColumnRenamed("target", "peers")
    reached = first_at_or_after(wanted, samples, ["run", "peers"], "start", "t", "_hit")
    ms = F.col("_hit") - F.col("start")
    return reached.select(
        "run", "phase",
        F.coalesce(F.when(ms < F.col("timeout"), ms), F.lit(-1)).cast("bigint").alias("ms"),
    )


# Packet streams around an absence


def _marked(samples: DataFrame, marks: DataFrame, mark: str) -> DataFrame:
    """Samples and a run's mark on one time line; a sample at the mark comes before it."""
    return samples.select(
        "run", "t", "pkts", F.lit(None).cast("bigint").alias("_mark"), F.lit(0).alias("_side")
    ).unionByName(
        marks.select(
            "run", F.col(mark).alias("t"), F.lit(None).cast("bigint").alias("pkts"),
            F.col(mark).cast("bigint").alias("_mark"), F.lit(1).alias("_side"),
        )
    )


def packet_stall(samples: DataFrame, marks: DataFrame, stall_ms: int = 1200) -> DataFrame:
    """Per run: ms from departure until the packet stream stopped, -1 if it never did.

    A stop is seen at the first sample more than ``stall_ms`` after the last
    growth of the counter, and dated half of that after the growth.
    """
    line = History(_marked(samples, marks, "departed"), ["run"], ["t", "_side"]).running(
        departed=("last", F.col("_mark")), base=("last", F.col("pkts"))
    )
    # At departure the count so far is the level to beat; nothing was seen before a first sample.
    level = F.when(F.col("_side") == 1, F.coalesce(F.col("base"), F.lit(-1))).otherwise(
        F.when(F.col("t") > F.col("departed"), F.col("pkts"))
    )
    after = line.with_columns(_level=level).where(F.col("departed").isNotNull())
    after = after.running(_top=("max", F.col("_level"), False))
    change = F.when((F.col("_side") == 1) | (F.col("_level") > F.col("_top")), F.col("t"))
    after = after.with_columns(_change=change).running(_last=("max", F.col("_change")))
    idle = (F.col("_side") == 0) & (F.col("t") - F.col("_last") > stall_ms)
    first = F.min_by(F.col("_last"), F.when(idle, F.col("t")))
    stopped = after.rows().groupBy("run").agg(first.alias("_at"), F.max("departed").alias("_out"))
    stop = F.col("_at") + stall_ms // 2 - F.col("_out")
    return stopped.select("run", F.coalesce(stop, F.lit(-1)).cast("bigint").alias("stop_ms"))


def _after_return(samples: DataFrame, marks: DataFrame) -> History:
    """Samples since the return, each with the count at the sample before it."""
    line = History(_marked(samples, marks, "returned"), ["run"], ["t", "_side"]).running(
        returned=("last", F.col("_mark")), _before=("last", F.col("pkts"), False)
    )
    return line.where(F.col("returned").isNotNull())


def _first_hit(after: History, hit: Column, timeout_ms: int) -> DataFrame:
    in_time = F.col("t") - F.col("returned") <= timeout_ms
    ms = F.min(F.when(hit & in_time & (F.col("_side") == 0), F.col("t") - F.col("returned")))
    return after.rows().groupBy("run").agg(F.coalesce(ms, F.lit(-1)).cast("bigint").alias("resume_ms"))


def packet_resume(
    samples: DataFrame, marks: DataFrame, min_gain: int = 2, timeout_ms: int = 30000
) -> DataFrame:
    """Per run: ms from return to the first sample gaining more than ``min_gain`` packets, or -1."""
    gain = F.col("pkts") - F.col("_before")
    return _first_hit(_after_return(samples, marks), gain > min_gain, timeout_ms)


def resume_after_return(samples: DataFrame, marks: DataFrame, timeout_ms: int = 40000) -> DataFrame:
    """Per run: PASS when a non-zero packet count changes in time after the return, else WEDGE.

    The first sample after the return only sets the level.
    """
    after = _after_return(samples, marks)
    seen = F.when((F.col("_side") == 0) & (F.col("t") > F.col("returned")), F.col("pkts"))
    after = after.with_columns(_seen=seen).running(_level=("last", F.col("_seen"), False))
    changed = (F.col("_seen") > 0) & (F.col("_seen") != F.col("_level"))
    return _first_hit(after, changed, timeout_ms).withColumn(
        "verdict", F.when(F.col("resume_ms") >= 0, "PASS").otherwise("WEDGE")
    )


def silence_validity(runs: DataFrame) -> DataFrame:
    """Add total silence and whether both instants were caught close to the absence."""
    stop, resume = F.col("stop_ms"), F.col("resume_ms")
    valid = (stop > 0) & (resume > 0) & (stop < F.col("absence_ms") + 3000)
    return runs.withColumns(
        {
            "total_ms": F.when((stop >= 0) & (resume >= 0), stop + resume).otherwise(F.lit(-1)),
            "valid": F.coalesce(valid, F.lit(False)),
        }
    )


# Verdicts


def classify_wedge(samples: DataFrame, at_ms: int = 8000) -> DataFrame:
    """Per run, from each peer's state at the mark: silent, never-connected or clean.

    ``samples`` holds (run, peer, t_ms since boot, state, packets_received); a run
    whose peers appear only after the mark had no link at it.
    """
    due = F.when(F.col("t_ms") <= at_ms, F.col("t_ms"))
    peers = samples.groupBy("run", "peer").agg(
        F.max_by(F.struct("state", "packets_received"), due).alias("at")
    )
    linked = F.col("at.state") == "connected"
    silent = F.count_if(linked & (F.col("at.packets_received") <= 0)) > 0
    pending = (F.count_if(~linked) > 0) | (F.count("at") == 0)
    verdict = F.when(silent, "silent").when(pending, "never-connected").otherwise("clean")
    return peers.groupBy("run").agg(verdict.alias("class"))


def ghost_peers(sessions: DataFrame, live: DataFrame, watch_ms: int = 20000) -> DataFrame:
    """Sessions that saw a peer during the watch although no live counterpart exists."""
    seen = sessions.groupBy("session").agg(
        F.max(F.when(F.col("t") <= watch_ms, F.col("peers"))).alias("peers_seen")
    ).where(F.col("peers_seen") >= 1)
    return seen.join(live.select("session").distinct(), "session", "left_anti")
