"""Streaming twins of the ordered operators: one small machine per key.

A key's state is a few numbers kept by Structured Streaming between micro-batches.
Within a batch its rows are put in time order; across batches the log keeps the
order per key (see ``publish_keyed_events``).
"""

from __future__ import annotations

import functools
import json
import math
from collections import namedtuple
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from linkloom.functions.sensing import Heard, Thresholds
from linkloom.operators.states import node_columns, track_of
from linkloom.streaming.timers import told


class Machine:
    """Consumes the rows of one key in order; ``memory`` must survive JSON."""

    def __init__(self, memory: dict[str, Any] | None = None):
        self.memory = memory or self.fresh()

    def fresh(self) -> dict[str, Any]:
        raise NotImplementedError

    def step(self, row: Any) -> list[tuple]:
        raise NotImplementedError

    def walk(self, rows: pd.DataFrame) -> list[tuple]:
        """All that a key's ordered rows emit."""
        make = _row(tuple(rows.columns))._make
        return [said for row in map(make, zip(*(rows[c].tolist() for c in rows.columns))) for said in self.step(row)]


@functools.cache
def _row(columns: tuple[str, ...]) -> type:
    """Made once per worker; a key's rows cost less than the class."""
    return namedtuple("Row", columns)


def _ordered(batches: list[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    """A key's rows in order; those that came in order are left as they are."""
    rows = batches[0] if len(batches) == 1 else pd.concat(batches, ignore_index=True)
    if len(rows) < 2:
        return rows
    first = rows[order[0]].to_numpy()
    if first.dtype.kind in "if" and (first[1:] > first[:-1]).all():
        return rows
    return rows.sort_values(order, kind="stable", ignore_index=True)


def run_machine(
    df: DataFrame, keys: list[str], order: list[str], make: type[Machine], emits: str
) -> DataFrame:
    """Feed each key's rows to its machine; the output is the keys plus what it emits."""
    schema = StructType([df.schema[k] for k in keys] + StructType.fromDDL(emits).fields)
    names = schema.names

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState):
        rows = _ordered(list(batches), order)
        machine = make(json.loads(state.get[0]) if state.exists else None)
        out = [key + said for said in machine.walk(rows)]
        state.update((json.dumps(machine.memory),))
        if out:
            yield pd.DataFrame(out, columns=names)

    return df.groupBy(*keys).applyInPandasWithState(
        advance, schema, "memory string", "append", GroupStateTimeout.NoTimeout
    )


class LinkLifecycle(Machine):
    """Emits a link's record whenever it changes; the last one per incarnation stands."""

    def fresh(self):
        return {"n": 0, "detected": -1, "connected": -1, "failed": False}

    def step(self, row):
        m = self.memory
        settled = m["n"] == 0 or m["connected"] >= 0 or m["failed"]
        if row.state == "detected":
            if not settled:
                return []
            m.update(n=m["n"] + 1, detected=int(row.t_ms), connected=-1, failed=False)
        elif m["n"] == 0 or m["connected"] >= 0:
            return []
        elif row.state == "connected":
            m.update(connected=int(row.t_ms), failed=False)
        elif row.state in ("failed", "closed"):
            m["failed"] = True
        else:
            return []
        setup = m["connected"] - m["detected"] if m["connected"] >= 0 else -1
        return [(m["n"], m["detected"], m["connected"], setup, m["failed"])]


def stream_link_lifecycle(events: DataFrame) -> DataFrame:
    emits = "incarnation bigint, detected_ms bigint, connected_ms bigint, setup_ms bigint, failed boolean"
    return run_machine(events, ["session", "peer"], ["t_ms"], LinkLifecycle, emits)


def vad_machine(open_rms: float, close_rms: float, open_polls: int, close_polls: int) -> type[Machine]:
    class VoiceActivity(Machine):
        """Counts the streak that could end the present state."""

        def fresh(self):
            return {"active": False, "streak": 0}

        def step(self, row):
            m = self.memory
            counts = row.rms < close_rms if m["active"] else row.rms >= open_rms
            m["streak"] = m["streak"] + 1 if counts else 0
            if m["streak"] < (close_polls if m["active"] else open_polls):
                return []
            m.update(active=not m["active"], streak=0)
            return [(int(row.t_ms), "open" if m["active"] else "close")]

    return VoiceActivity


def stream_vad_edges(
    levels: DataFrame, open_rms: float = 0.06, close_rms: float = 0.035,
    open_ms: int = 120, hang_ms: int = 700, poll_ms: int = 50,
) -> DataFrame:
    machine = vad_machine(
        open_rms, close_rms, math.ceil(open_ms / poll_ms), math.ceil(hang_ms / poll_ms)
    )
    return run_machine(levels, ["stream"], ["t_ms"], machine, "t_ms bigint, edge string")


def _unknown(value: float | None) -> float:
    return math.nan if value is None else value


def suppression_machine(limits: Thresholds) -> type[Machine]:
    class Suppression(Machine):
        """Keeps what the sink last heard; a micro-batch of samples is searched at once."""

        def fresh(self):
            return {"t": 0, "place": None, "links": [[], [], [], []]}

        def walk(self, rows):
            m, said = self.memory, {}
            links = {int(peer): (state, *map(_unknown, (rtt, loss))) for peer, state, rtt, loss in zip(*m["links"], strict=True)}
            known = Heard(m["t"], *(m["place"] or (math.nan, math.nan)), links)
            for at, kind, note, known in track_of(rows).reports(known, 0, len(rows), limits):
                said[at] = kind, note
            place = None if math.isnan(known.x) else (known.x, known.y)
            m.update(t=known.t, place=place, links=[c.tolist() for c in known.columns()])
            verdicts = [said.get(k, (None, "")) for k in range(len(rows))]
            return [(int(t), kind, note, kind is None) for t, (kind, note) in zip(rows["t_ms"], verdicts, strict=True)]

    return Suppression


def stream_event_suppression(
    samples: DataFrame, limits: Thresholds | None = None, order: list[str] | None = None
) -> DataFrame:
    """Streaming ``event_suppression``; ``order`` tells samples of one millisecond apart, as there."""
    emits = "t_ms bigint, kind string, note string, suppressed boolean"
    columns = node_columns(samples, order)
    machine = suppression_machine(limits or Thresholds())
    return run_machine(columns, ["session"], ["t_ms", *(order or []), "_content"], machine, emits)


def grace_machine(w_ms: int) -> type[Machine]:
    class Grace(Machine):
        """Holds absent peers until their deadline passes at a tick; emits links that ended."""

        def fresh(self):
            return {"links": {}, "count": {}}

        def step(self, row):
            links, count, t = self.memory["links"], self.memory["count"], int(row.t_ms)
            near = {str(int(p)) for p in (row.in_range if row.in_range is not None else [])}
            ended = []
            for peer in [p for p in links if p not in near]:
                start, deadline = links[peer]
                deadline = t + max(w_ms, 0) if deadline is None else deadline
                links[peer] = [start, deadline]
                if t >= deadline:
                    del links[peer]
                    ended.append((int(peer), count[peer], start, t, t - start))
            for peer in near:
                if peer not in links:
                    count[peer] = count.get(peer, 0) + 1
                links[peer] = [links[peer][0] if peer in links else t, None]
            return ended

    return Grace


def stream_grace_window(ticks: DataFrame, w_ms: int) -> DataFrame:
    emits = "peer int, link bigint, start_ms bigint, end_ms bigint, held_ms bigint"
    return run_machine(ticks, ["node"], ["t_ms"], grace_machine(w_ms), emits)


def watchdog_machine(restart_ms: int, recreate_ms: int) -> type[Machine]:
    class Watchdog(Machine):
        """Keeps a few numbers for each peer of a session."""

        def fresh(self):
            return {}

        def step(self, row):
            m = self.memory.setdefault("" if row.peer is None else "p" + row.peer, {"born": None, "restarted": False, "gone_at": None})
            born, t = int(row.born_ms), int(row.t_ms)
            if m["born"] != born:
                m.update(born=born, restarted=False, gone_at=None)
            gone = m["gone_at"] is not None
            if row.connected or (gone and t > m["gone_at"]):
                return []
            acts = []
            if not m["restarted"] and t - born > restart_ms and row.could_restart:
                m["restarted"] = True
                acts.append((row.peer, born, t, "restart"))
            if not gone and t - born > recreate_ms:
                m["gone_at"] = t
                acts.append((row.peer, born, t, "recreate"))
            return acts

    return Watchdog


def stream_never_connected_timeout(
    ticks: DataFrame, restart_ms: int = 3000, recreate_ms: int = 8000
) -> DataFrame:
    """A session's peers share a state: a call into Python costs far more than the few ticks of a peer."""
    machine = watchdog_machine(restart_ms, recreate_ms)
    rows = told(ticks).withColumn("peer", F.col("peer").cast("string"))
    acts = run_machine(rows, ["session"], ["t_ms"], machine, "peer string, born_ms bigint, t_ms bigint, action string")
    return acts.withColumn("peer", F.col("peer").cast(ticks.schema["peer"].dataType))
