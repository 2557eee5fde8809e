"""Time-outs that fire by the stream's clock, without waiting for another row of their key.

The watchdog of links that never connect: three seconds after a peer was born the
impolite side of a stable negotiation whose transport never started asks for a restart,
after eight the peer is recreated. Both are deadlines of event time. A key (one
incarnation of a peer) keeps a handful of numbers that do not depend on the order of its
rows, an event-time timer wakes it when the watermark has passed a deadline, and its
state goes with the last one, so the state holds the peers of the last eight seconds.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

KEY = ["session", "peer", "born_ms"]
# Decisions fall on the first millisecond at which the age exceeds the limit.
OUT = "session {session}, peer {peer}, born_ms bigint, at_ms bigint, action string"
STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_timers(spark: SparkSession) -> None:
    """Timers and lists of state need the store that keeps them on disk."""
    spark.conf.set(STORE_CONF, ROCKSDB)


def _could_restart() -> Column:
    """The impolite side of a stable negotiation whose transport never started."""
    idle = (F.col("signaling") == "stable") & (F.col("ice") == "new")
    impolite = (F.col("remote_nonce") >= 0) & (F.col("my_nonce") > F.col("remote_nonce"))
    return F.coalesce(idle & impolite, F.lit(False))


def told(ticks: DataFrame) -> DataFrame:
    """What the watchdog reads of a tick: the key, t_ms, connected, could_restart."""
    return ticks.select(
        "session", "peer", F.col("born_ms").cast("bigint").alias("born_ms"), F.col("t_ms").cast("bigint").alias("t_ms"),
        F.coalesce("ever_connected", F.lit(False)).alias("connected"), _could_restart().alias("could_restart"),
    )


def watched(ticks: DataFrame) -> DataFrame:
    """Ticks with both their times."""
    return told(ticks).where("born_ms is not null and t_ms is not null")


def never_connected_deadlines(ticks: DataFrame, restart_ms: int = 3000, recreate_ms: int = 8000, delay_ms: int = 0) -> DataFrame:
    """The watchdog's actions at their deadlines, over a finished log: session, peer, born_ms, at_ms, action.

    A peer that is not connected by its deadline is recreated then, whether or not a tick
    follows. A restart falls on the restart deadline if the peer's last tick up to it
    could restart, else on its first later tick that can, while the peer is neither
    connected nor recreated. Deadlines the log's clock (its latest tick, less
    ``delay_ms``) is not behind yet are not due. Ticks of one millisecond count as able to
    restart if one of them is. Rows without born_ms or t_ms are left out.
    """
    rows = watched(ticks)
    born, t = F.col("born_ms"), F.col("t_ms")
    first, last = born + restart_ms + 1, born + recreate_ms + 1
    told = rows.where(t <= last).groupBy(*KEY).agg(
        F.min(F.when(F.col("connected"), t)).alias("_connected"),
        F.max(F.when(t <= first, F.struct("t_ms", "could_restart"))).alias("_before"),
        F.min(F.when((t > first) & F.col("could_restart"), t)).alias("_after"),
    )
    # one row: the clock
    clock = rows.agg((F.max("t_ms") - delay_ms).alias("_clock"))
    open_at = lambda at: F.col("_connected").isNull() | (F.col("_connected") > at)
    restart = F.when(F.col("_before.could_restart"), first).otherwise(F.col("_after"))
    acts = told.crossJoin(F.broadcast(clock)).select(*KEY, "_clock", F.explode(F.array(
        F.struct(F.when(open_at(restart) & (restart <= last), restart).alias("at_ms"), F.lit("restart").alias("action")),
        F.struct(F.when(open_at(last), last).alias("at_ms"), F.lit("recreate").alias("action")),
    )).alias("_act"))
    return acts.select(*KEY, "_act.*", "_clock").where("at_ms < _clock").drop("_clock")


def _watchdog(restart_ms: int, recreate_ms: int) -> type[StatefulProcessor]:
    class Watchdog(StatefulProcessor):
        """State: first connection, last tick up to the restart deadline and whether it could restart, first later one that could."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.peer = handle.getValueState("peer", "connected bigint, before_ms bigint, before_can boolean, after_ms bigint, restarted boolean")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            born = int(key[2])
            first, last = born + restart_ms + 1, born + recreate_ms + 1
            if timerValues.getCurrentWatermarkInMs() > last:
                return  # decided; late rows open no new state
            known = self.peer.get()
            connected, before, can, after, restarted = known or (None, None, False, None, False)
            met = False
            for batch in rows:
                t, joined, able = (batch[c].to_numpy() for c in ("t_ms", "connected", "could_restart"))
                own = t <= last
                if not own.any():
                    continue
                met, t, joined, able = True, t[own], joined[own], able[own]
                if joined.any():
                    connected = min(int(t[joined].min()), connected if connected is not None else last)
                early = t <= first
                if early.any():
                    at = int(t[early].max())
                    now_can = bool(able[t == at].any())
                    if before is None or at > before:
                        before, can = at, now_can
                    elif at == before:
                        can = can or now_can
                later = t[able & ~early]
                if len(later):
                    after = min(int(later.min()), after if after is not None else last)
            if not met:
                return
            now = connected, before, can, after, restarted
            if known is None:
                self.handle.registerTimer(last)
            # a restart is due at one of these, unless the peer connects first; without it nothing happens there
            for at, had in ((first if can else None, first if known and known[2] else None), (after, known[3] if known else None)):
                if at is not None and at != had and (connected is None or connected > at):
                    self.handle.registerTimer(at)
            if known is None or now != tuple(known):
                self.peer.update(now)
            return
            yield

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            known = self.peer.get()
            if known is None:
                return
            born, now = int(key[2]), int(expiredTimerInfo.getExpiryTimeInMs())
            first, last = born + restart_ms + 1, born + recreate_ms + 1
            connected, before, can, after, restarted = known
            acts = []
            at = first if can else after
            if not restarted and at is not None and at <= now and at <= last and (connected is None or connected > at):
                restarted = True
                acts.append((at, "restart"))
            if now >= last:
                if connected is None or connected > last:
                    acts.append((last, "recreate"))
                self.peer.clear()
            else:
                self.peer.update((connected, before, can, after, restarted))
            if acts:
                yield pd.DataFrame([(*key, at, action) for at, action in acts], columns=[*KEY, "at_ms", "action"])

        def close(self) -> None:
            pass

    return Watchdog


def stream_never_connected_deadlines(ticks: DataFrame, restart_ms: int = 3000, recreate_ms: int = 8000, delay_ms: int = 0) -> DataFrame:
    """Streaming ``never_connected_deadlines``: an action comes out once the watermark has passed its deadline.

    The watermark trails the latest tick by ``delay_ms``, the disorder the log may have;
    within it rows may come in any order and any batches with the same result.
    """
    use_state_timers(ticks.sparkSession)
    rows = watched(ticks).withColumn("at", F.timestamp_millis("t_ms")).withWatermark("at", f"{delay_ms} milliseconds")
    # Ticks behind a peer's last deadline move the clock only; as a filter on the clock's column it stays behind the clock.
    rows = rows.where(F.unix_millis("at") <= F.col("born_ms") + (recreate_ms + 1))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = StructType.fromDDL(OUT.format(**kinds))
    return rows.groupBy(*KEY).transformWithStateInPandas(
        statefulProcessor=_watchdog(restart_ms, recreate_ms)(), outputStructType=schema, outputMode="Append", timeMode="EventTime")
