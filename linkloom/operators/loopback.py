"""Loopback latency over recordings held as frame tables (recording_id, frame, ref, mic).

The unit of work is a stretch of frames, not a recording, so one very long
recording spreads like many short ones. The filters are linear. Where their impulse
response fades soon, each stretch is computed with the frames before it that still
matter, down to 2**-60 of full scale, below the rounding of a double. Where it outlasts a
stretch (a sharp filter, a slow envelope), a stretch is an affine map of the filter's
state: the maps' constants are found apart, composed in order to the state each stretch
is entered with, and the stretches are then filtered apart from these states.
"""

from __future__ import annotations

import cmath
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from linkloom import session as settings
from linkloom.functions.percentiles import exact_percentiles
from linkloom.operators.chains import FRESH, chunk_entries, compact, map_schema
from linkloom.operators.history import (
    History,
    broadcast_if_small,
    has_hot_keys,
    join_hot_safe,
    settled,
    spread,
)

# Fixed defaults of the rig.
FREQ_HZ, Q = 2000.0, 4.0
ENVELOPE_MS, DECIMATION = 2.0, 16
CLICK_SHARE, MAX_LAG_MS, MIN_LAG_MS = 0.30, 1000.0, 0.0
WINDOW_MS, PRE_ROLL_MS = 30.0, 5.0
MIN_DB, MIN_CORR = 6.0, 0.5

REC = "recording_id"
STRETCH = 1 << 18
FADE = 2.0**-60


# Filters


def bandpass_response(fs: float, freq: float, q: float) -> np.ndarray:
    """Impulse response of the two-pole band-pass until it has faded."""
    turn = 2 * math.pi * freq / fs
    alpha = math.sin(turn) / (2 * q)
    gain, poles = alpha / (1 + alpha), np.roots([1 + alpha, -2 * math.cos(turn), 1 - alpha])
    length = max(3, math.ceil(math.log(FADE) / math.log(max(abs(poles)))) + 1)
    n = np.arange(length)
    p, r = complex(poles[0]), complex(poles[1])
    # Partial fractions of 1 / ((1 - p z)(1 - r z)); the numerator is 1 - z**2.
    core = (p ** (n + 1) - r ** (n + 1)) / (p - r) if not cmath.isclose(p, r) else (n + 1) * p**n
    lagged = np.concatenate([[0, 0], core[:-2]])
    return gain * np.real(core - lagged)


def smoothing_response(fs: float, tau_ms: float) -> np.ndarray:
    """Impulse response of the one-pole low-pass until it has faded."""
    keep = math.exp(-1.0 / (tau_ms / 1000.0 * fs))
    length = max(1, math.ceil(math.log(FADE) / math.log(keep)) + 1)
    return (1 - keep) * keep ** np.arange(length)


def _convolved(signal: np.ndarray, response: np.ndarray) -> np.ndarray:
    size = len(signal) + len(response) - 1
    if min(len(signal), len(response)) < 64:
        return np.convolve(signal, response)[: len(signal)]
    fft = 1 << (size - 1).bit_length()
    spectrum = np.fft.rfft(signal, fft) * np.fft.rfft(response, fft)
    return np.fft.irfft(spectrum, fft)[: len(signal)]


def _by_stretch(
    df: DataFrame, warmup: int, work: Callable[[np.ndarray], np.ndarray], stretch: int
) -> DataFrame:
    """Apply ``work`` to each channel, stretch by stretch, after ``warmup`` frames of lead-in."""
    stretch = max(stretch, 4 * warmup)
    channels = [c for c in ("ref", "mic") if c in df.columns]
    own = F.floor(F.col("frame") / stretch)
    lead_in = F.when(F.col("frame") >= (own + 1) * stretch - warmup, own + 1)
    pieces = df.select(REC, "frame", *channels).withColumn(
        "_stretch", F.explode(F.array_compact(F.array(own, lead_in)))
    )

    def run(key: tuple, piece: pd.DataFrame) -> pd.DataFrame:
        start = key[1] * stretch
        if (piece["frame"] < start).all():
            return piece.iloc[:0].drop(columns="_stretch")
        first = int(piece["frame"].min())
        at = (piece["frame"] - first).to_numpy()
        out = {REC: piece[REC], "frame": piece["frame"]}
        for channel in channels:
            dense = np.zeros(int(at.max()) + 1)
            dense[at] = piece[channel].to_numpy(dtype=float)
            out[channel] = work(dense)[at].astype(np.float32)
        return pd.DataFrame(out)[piece["frame"] >= start]

    schema = StructType([df.schema[REC], df.schema["frame"]])
    for channel in channels:
        schema = schema.add(channel, "float")
    return spread(pieces, REC, "_stretch").groupBy(REC, "_stretch").applyInPandas(run, schema)


class Recurrence:
    """y[n] = b0 x[n] + b1 x[n-1] + b2 x[n-2] - a1 y[n-1] - a2 y[n-2], with two numbers of state.

    ``run`` works in blocks: all blocks are convolved at once as if entered at rest, then
    the state is carried from block to block and its free response added. No response
    has to fade, so it is exact for any poles inside the unit circle.
    """

    BLOCK = 512

    def __init__(self, b: tuple[float, float, float], a: tuple[float, float]):
        self.b, self.a = b, a
        self.move = np.array([[-a[0], 1.0], [-a[1], 0.0]])  # the state after one frame of silence
        # what each state contributes to the following outputs, and the response to one frame
        free, step = np.empty((self.BLOCK, 2)), np.eye(2)
        for n in range(self.BLOCK):
            free[n] = step[0]
            step = self.move @ step
        self.free, self.over_block = free, step
        kick = np.array([b[1] - a[0] * b[0], b[2] - a[1] * b[0]])
        self.response = np.concatenate([[b[0]], free[:-1] @ kick])

    def run(self, x: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Outputs of signals of one length (a row each) from the given states, and the states behind them."""
        rows, length = x.shape
        width = min(self.BLOCK, length)
        blocks = np.zeros((rows, -(-length // width), width))
        blocks.reshape(rows, -1)[:, :length] = x
        y = np.fft.irfft(np.fft.rfft(blocks, 2 * width) * np.fft.rfft(self.response[:width], 2 * width), 2 * width)[:, :, :width]
        over = self.over_block if width == self.BLOCK else np.linalg.matrix_power(self.move, width)
        entered = np.empty((rows, blocks.shape[1], 2))
        for k in range(blocks.shape[1]):
            entered[:, k] = state
            state = state @ over.T + self._left(blocks[:, k], y[:, k])
        y = (y + entered @ self.free[:width].T).reshape(rows, -1)[:, :length]
        if length == 1:
            return y, self._left(x, y) + np.stack([entered[:, 0, 1], np.zeros(rows)], axis=1)
        return y, self._behind(x, y)

    def _left(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The states that signals entered at rest leave."""
        if x.shape[1] == 1:
            x, y = (np.pad(v, ((0, 0), (1, 0))) for v in (x, y))
        return self._behind(x, y)

    def _behind(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        second = lambda k: self.b[2] * x[:, k] - self.a[1] * y[:, k]
        return np.stack([self.b[1] * x[:, -1] - self.a[0] * y[:, -1] + second(-2), second(-1)], axis=1)

    def entered(self, place: np.ndarray, stretches: np.ndarray, left: np.ndarray, size: int) -> np.ndarray:
        """For stretches in order, and the states they leave when entered at rest, the states they are entered with.

        ``place`` numbers the stretches of a recording from 0; all recordings take a step at a time.
        States are rows x channels x 2.
        """
        found = np.zeros_like(left)
        over = np.linalg.matrix_power(self.move, size)
        gap = np.diff(stretches, prepend=0) - 1
        order = np.argsort(place, kind="stable")
        ends = np.searchsorted(place[order], np.arange(1, place.max() + 2))
        for begin, end in zip(ends[:-1], ends[1:], strict=True):
            at = order[begin:end]
            found[at] = found[at - 1] @ over.T + left[at - 1]
            silent = at[gap[at] > 0]  # stretches without frames are silent
            for n in np.unique(gap[silent]).tolist():
                own = silent[gap[silent] == n]
                found[own] = found[own] @ np.linalg.matrix_power(over, n).T
        return found


def bandpass(fs: float, freq: float, q: float) -> Recurrence:
    turn = 2 * math.pi * freq / fs
    alpha = math.sin(turn) / (2 * q)
    gain = alpha / (1 + alpha)
    return Recurrence((gain, 0.0, -gain), (-2 * math.cos(turn) / (1 + alpha), (1 - alpha) / (1 + alpha)))


def smoothing(fs: float, tau_ms: float) -> Recurrence:
    keep = math.exp(-1.0 / (tau_ms / 1000.0 * fs))
    return Recurrence((1 - keep, 0.0, 0.0), (-keep, 0.0))


def _whole(batches: Iterator[pa.RecordBatch], keys: list[str], most: int) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Rows sorted by keys as tables of whole groups, at most ``most`` of them: rows, each row's group, the groups' first rows."""

    def fresh(rows: pa.Table | pa.RecordBatch) -> np.ndarray:
        """Whether a row's keys differ from those of the row before."""
        first = np.zeros(max(0, rows.num_rows - 1), bool)
        for key in keys:
            column = rows.column(key)
            column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
            first |= np.diff(column.dictionary_encode("encode").indices.to_numpy()) != 0
        return first

    def parts(held: list[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
        rows = pa.Table.from_batches(held).combine_chunks()
        starts = np.concatenate([[0], np.flatnonzero(fresh(rows)) + 1])
        ends = np.append(starts[1:], rows.num_rows)
        for at in range(0, len(starts), most):
            own, until = starts[at:at + most], ends[at:at + most]
            yield rows.slice(int(own[0]), int(until[-1] - own[0])), np.repeat(np.arange(len(own)), until - own), own - own[0]

    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        cuts = np.flatnonzero(fresh(batch)) + 1
        if held and tuple(batch.column(k)[0].as_py() for k in keys) != last:
            cuts = np.concatenate([[0], cuts])
        if len(cuts):  # the last group may go on in the next batch
            done = [*held, *([batch.slice(0, int(cuts[-1]))] if cuts[-1] else [])]
            if done:
                yield from parts(done)
            held = []
        held.append(batch.slice(int(cuts[-1]) if len(cuts) else 0))
        last = tuple(batch.column(k)[batch.num_rows - 1].as_py() for k in keys)
    if held:
        yield from parts(held)


# Frames that are filtered together.
TOGETHER = 1 << 20


def _scanned(df: DataFrame, filter_: Recurrence, prepare: Callable[[np.ndarray], np.ndarray], stretch: int) -> DataFrame:
    """Apply the filter to each channel, stretch by stretch, each entered with the state the ones before it leave.

    Two passes over the frames; between them one small row per stretch, which one task
    per recording puts in order. A task filters many stretches at once, as rows of one
    array, so short stretches cost little more than their frames.
    """
    channels = [c for c in ("ref", "mic") if c in df.columns]
    keys, many = [REC, "_stretch"], max(1, TOGETHER // stretch)
    own = F.floor(F.col("frame") / stretch)
    rows = df.select(REC, own.alias("_stretch"), (F.col("frame") - own * stretch).alias("_at"), "frame", *channels)

    def dense(piece: pa.Table, channel: str, group: np.ndarray, groups: int) -> np.ndarray:
        out = np.zeros((groups, stretch))
        out[group, piece.column("_at").to_numpy()] = piece.column(channel).to_numpy().astype(float)
        return prepare(out)

    def states_of(places: pa.Table, found: np.ndarray) -> pa.RecordBatch:
        """Rows of keys with their states, channel by channel in one list."""
        size = 2 * len(channels)
        lists = pa.ListArray.from_arrays(np.arange(0, len(found) * size + 1, size, dtype=np.int32), found.reshape(-1))
        return pa.RecordBatch.from_arrays([*(places.column(k).combine_chunks() for k in keys), lists], names=state.names)

    def told(states: pa.ChunkedArray) -> np.ndarray:
        return states.combine_chunks().flatten().to_numpy().reshape(len(states), len(channels), 2)

    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, group, starts in _whole(batches, keys, many):
            rest = np.zeros((len(starts), 2))
            left = [filter_.run(dense(piece, c, group, len(starts)), rest)[1] for c in channels]
            yield states_of(piece.select(keys).take(pa.array(starts)), np.stack(left, axis=1))

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, group, starts in _whole(batches, [REC], TOGETHER):
            place = np.arange(len(group)) - starts[group]
            yield states_of(piece, filter_.entered(place, piece.column("_stretch").to_numpy(), told(piece.column("_states")), stretch))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, group, starts in _whole(batches, keys, many):
            entered = told(piece.column("_states").take(pa.array(starts)))
            frames = np.ones(len(group), bool)
            frames[starts] = False  # a stretch's state comes ahead of its frames
            piece, group = piece.filter(pa.array(frames)), group[frames]
            out = [piece.column(c).combine_chunks() for c in (REC, "frame")]
            for c, channel in enumerate(channels):
                y, _ = filter_.run(dense(piece, channel, group, len(starts)), entered[:, c])
                y = y[group, piece.column("_at").to_numpy()].astype(np.float32)
                out.append(pa.array(y, mask=np.isnan(y)))
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    state = StructType([df.schema[REC]]).add("_stretch", "long").add("_states", ArrayType(DoubleType()))
    schema = StructType([df.schema[REC], df.schema["frame"]])
    for channel in channels:
        schema = schema.add(channel, "float")
    left = spread(rows, *keys).sortWithinPartitions(*keys).mapInArrow(leave, state)
    entered = spread(left, REC).sortWithinPartitions(*keys).mapInArrow(chain, state)
    both = rows.unionByName(entered, allowMissingColumns=True)
    return spread(both, *keys).sortWithinPartitions(*keys, F.col("_states").isNull()).mapInArrow(finish, schema)


def _outlasts(response_frames: float, stretch: int) -> bool:
    """Whether a lead-in would be longer than a quarter of a stretch."""
    return response_frames > stretch / 4


def _fade(pole: float) -> float:
    """Frames until a pole's response has faded."""
    return math.inf if pole >= 1 else math.log(FADE) / math.log(pole) if pole > 0 else 1.0


def bandpass_filter(
    df: DataFrame, fs: float, freq: float = FREQ_HZ, q: float = Q, stretch: int = STRETCH
) -> DataFrame:
    """Band-pass both channels; the same filter on both keeps its delay out of the result."""
    sharp = bandpass(fs, freq, q)
    if _outlasts(_fade(math.sqrt(sharp.a[1])), stretch):
        return _scanned(df, sharp, lambda x: x, stretch)
    response = bandpass_response(fs, freq, q)
    return _by_stretch(df, len(response), lambda x: _convolved(x, response), stretch)


def envelope(df: DataFrame, fs: float, tau_ms: float = ENVELOPE_MS, stretch: int = STRETCH) -> DataFrame:
    """Rectify and smooth both channels."""
    slow = smoothing(fs, tau_ms)
    if _outlasts(_fade(-slow.a[0]), stretch):
        return _scanned(df, slow, np.abs, stretch)
    response = smoothing_response(fs, tau_ms)
    return _by_stretch(df, len(response), lambda x: _convolved(np.abs(x), response), stretch)


def filtered_envelope(
    df: DataFrame, fs: float, freq: float = FREQ_HZ, q: float = Q,
    tau_ms: float = ENVELOPE_MS, stretch: int = STRETCH,
) -> DataFrame:
    """Band-pass and envelope in one pass over the frames, with both lead-ins; one after the other where one outlasts a stretch."""
    if _outlasts(_fade(math.sqrt(bandpass(fs, freq, q).a[1])) + _fade(-smoothing(fs, tau_ms).a[0]), stretch):
        return envelope(bandpass_filter(df, fs, freq, q, stretch), fs, tau_ms, stretch)
    band, smooth = bandpass_response(fs, freq, q), smoothing_response(fs, tau_ms)

    def work(x: np.ndarray) -> np.ndarray:
        passed = _convolved(x, band).astype(np.float32)
        return _convolved(np.abs(passed.astype(float)), smooth)

    return _by_stretch(df, len(band) + len(smooth), work, stretch)


def decimate(df: DataFrame, d: int = DECIMATION) -> DataFrame:
    """Every d-th frame, renumbered."""
    d = max(1, d)
    return df.where(F.col("frame") % d == 0).withColumn("frame", F.floor(F.col("frame") / d))


# Clicks


def _pick(frames: np.ndarray, level: np.ndarray, start: int, gap: int) -> int:
    """Loudest frame of the unbroken stretch from ``start`` on, within the dead time."""
    end = int(np.searchsorted(frames, frames[start] + gap))
    breaks = np.flatnonzero(np.diff(frames[start:end]) != 1)
    end = start + int(breaks[0]) + 1 if len(breaks) else end
    return int(frames[start + int(np.argmax(level[start:end]))])


def _picks(
    frames: np.ndarray, level: np.ndarray, onsets: np.ndarray, eligible: int, stop: int, gap: int
) -> list[int]:
    """Greedy picks from ``eligible`` on; ``onsets`` places the frames a pick may start at."""
    picks, starts = [], frames[onsets]
    while True:
        i = int(np.searchsorted(starts, eligible))
        if i == len(onsets) or starts[i] >= stop:
            return picks
        picks.append(_pick(frames, level, int(onsets[i]), gap))
        eligible = picks[-1] + gap


def find_clicks(
    df: DataFrame, fs: float, thr: float = CLICK_SHARE, max_lag_ms: float = MAX_LAG_MS,
    limit: int | None = None,
) -> DataFrame:
    """Clicks (recording_id, click, frame) in the reference envelope.

    A click is the loudest frame of a stretch that starts at a share of the
    recording's peak and stays above half of it; the next one may start only after
    a dead time, so picks depend on picks. Only frames above half the bar matter,
    a small part of a recording. If they are still many, the recording is walked
    in chunks of many dead times, chained by the frame from which a pick may start.
    """
    gap = int(max_lag_ms / 1000.0 * fs * 1.5 + 1)
    limit = limit or settings.hot_rows(df.sparkSession)
    peaks = settled(df.groupBy(REC).agg((F.max("ref").cast("double") * thr).alias("bar")))
    level = F.col("ref").cast("double")
    loud = join_hot_safe(df.select(REC, "frame", "ref"), peaks, [REC], "inner", limit).where(
        level >= F.col("bar") * 0.5
    ).select(REC, F.col("frame").cast("bigint").alias("frame"), level.alias("level"), "bar")
    schema = StructType([df.schema[REC]]).add("frame", "long")

    def arrays(piece: pd.DataFrame):
        piece = piece.sort_values("frame")
        loudness = piece["level"].to_numpy()
        return piece["frame"].to_numpy(), loudness, np.flatnonzero(loudness >= piece["bar"].iloc[0])

    def table(piece: pd.DataFrame, picks: list[int]) -> pd.DataFrame:
        return pd.DataFrame({REC: [piece[REC].iloc[0]] * len(picks), "frame": picks})

    if not has_hot_keys(loud, [REC], limit):
        picks = spread(loud, REC).groupBy(REC).applyInPandas(
            lambda piece: table(piece, _picks(*arrays(piece), FRESH, 2**62, gap)), schema
        )
    else:
        picks = _clicks_chunked(loud, gap, max(limit, 8 * gap), schema, arrays, table)
    # Picks lie at least a dead time apart: far fewer than frames, whatever the recording.
    numbered = History(picks, [REC], ["frame"], hot=False).running(click=("sum", F.lit(1)))
    return numbered.rows().select(REC, F.col("click").cast("bigint").alias("click"), "frame")


def _clicks_chunked(loud: DataFrame, gap: int, span: int, schema: StructType, arrays, table) -> DataFrame:
    """``span`` frames per chunk, each with one dead time of frames after it."""
    own = F.floor(F.col("frame") / span)
    ahead = F.when(F.col("frame") < own * span + gap, own - 1)
    pieces = loud.withColumn("_chunk", F.explode(F.array_compact(F.array(own, ahead)))).where("_chunk >= 0")
    keys = [REC, "_chunk"]

    def exits(key: tuple, piece: pd.DataFrame) -> pd.DataFrame:
        frames, level, onsets = arrays(piece)
        stop = (key[1] + 1) * span
        near = key[1] * span + 2 * gap  # no earlier chunk can reach further
        after, moves = {}, {}
        for place in onsets.tolist():
            start = int(frames[place])
            if start >= stop:
                break
            first = _pick(frames, level, place, gap)
            if first not in after:
                after[first] = _picks(frames, level, onsets, start, stop, gap)[-1] + gap
            moves[start] = after[first]
            if start >= near:
                break
        entries, leads_to = compact(moves)
        return pd.DataFrame({REC: [key[0]], "_chunk": [key[1]], "entries": [entries], "exits": [leads_to]})

    maps = spread(pieces, *keys).groupBy(*keys).applyInPandas(exits, map_schema(pieces, keys))
    entries = chunk_entries(maps, [REC])

    def choose(key: tuple, piece: pd.DataFrame) -> pd.DataFrame:
        eligible, stop = int(piece["entry"].iloc[0]), (key[1] + 1) * span
        return table(piece, _picks(*arrays(piece), eligible, stop, gap))

    return spread(pieces.join(entries, keys), *keys).groupBy(*keys).applyInPandas(choose, schema)


def noise_floor(df: DataFrame, fs: float) -> DataFrame:
    """RMS of each recording's first half second (at most a quarter of it)."""
    head = int(0.5 * fs)
    sizes = df.groupBy(REC).agg((F.max("frame") + 1).alias("_n"))
    early = df.where(F.col("frame") < head).select(REC, "frame", "mic").join(sizes, REC)
    quiet = F.when(F.col("frame") < F.floor(F.col("_n") / 4), F.col("mic").cast("double") ** 2)
    return early.groupBy(REC).agg(F.coalesce(F.sqrt(F.avg(quiet)), F.lit(1e-9)).alias("noise_floor"))


# Correlation


# Window length from which the products are formed in the frequency domain.
FFT_WINDOW = 128


def _products(a: np.ndarray, mic: np.ndarray, lags: int) -> np.ndarray:
    """sum(a[i] * mic[lag + i]) per row and lag; long windows by overlap-save."""
    width = a.shape[1]
    if width < FFT_WINDOW:
        return np.einsum("gw,glw->gl", a, np.lib.stride_tricks.sliding_window_view(mic, width, axis=1)[:, :lags])
    size = 4 << (width - 1).bit_length()
    step = size - width + 1
    turned = np.conj(np.fft.rfft(a, size))
    out = np.empty((len(a), lags))
    for start in range(0, lags, step):
        part = np.fft.irfft(np.fft.rfft(mic[:, start:start + size], size) * turned, size)
        out[:, start:start + step] = part[:, : min(step, lags - start)]
    return out


def _correlations(ref: np.ndarray, mic: np.ndarray, lags: int) -> np.ndarray:
    """Normalized correlation of each row's window with each shift; 0 where either is constant.

    The window's mean is taken off once. Sums and powers of the shifts come from running
    sums; a shift whose power is lost in their rounding is summed by itself.
    """
    width = ref.shape[1]
    a = ref - ref.mean(axis=1, keepdims=True)
    flat = (ref == ref[:, :1]).all(axis=1)
    level = mic - mic.mean(axis=1, keepdims=True)
    running = lambda x: np.concatenate([np.zeros((len(x), 1)), np.cumsum(x, axis=1)], axis=1)
    over = lambda x: x[:, width:width + lags] - x[:, :lags]
    total, squares = running(level), running(level**2)
    power = over(squares) - over(total) ** 2 / width
    # a shift without a change inside is constant
    changes = running((np.diff(mic, axis=1) != 0).astype(np.int64))
    still = changes[:, width - 1:width - 1 + lags] == changes[:, :lags]
    for row, lag in np.argwhere(~still & (power <= 1e-6 * squares[:, -1:])).tolist():
        own = mic[row, lag:lag + width]
        power[row, lag] = ((own - own.mean()) ** 2).sum()
    both = np.einsum("gw,gw->g", a, a)[:, None] * power
    good = ~still & ~flat[:, None] & (both > 0)
    return np.divide(_products(a, level, lags), np.sqrt(np.where(good, both, 1.0)), out=np.zeros((len(ref), lags)), where=good)


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Rows (recording, click, _at, ref, mic) in order as clicks of equal length: their keys, ref and mic with a row per click."""
    held: pa.Table | None = None

    def cut(rows: pa.Table, ends: np.ndarray) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
        starts = np.concatenate([[0], ends[:-1]])
        ref, mic = (rows.column(c).to_numpy().astype(float) for c in ("ref", "mic"))
        keys = rows.select([REC, "click"])
        for size in np.unique(ends - starts).tolist():
            own = starts[ends - starts == size]
            for part in np.array_split(own, max(1, len(own) * size >> 20)):
                place = part[:, None] + np.arange(size)
                yield keys.take(pa.array(part)), ref[place], mic[place]

    def ends_of(rows: pa.Table) -> np.ndarray:
        names = [rows.column(c).combine_chunks().dictionary_encode().indices.to_numpy() for c in (REC, "click")]
        return np.append(np.flatnonzero((np.diff(names[0]) != 0) | (np.diff(names[1]) != 0)) + 1, len(rows))

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        if not len(held):
            continue
        ends = ends_of(held)
        if len(ends) > 1:  # the last click may go on in the next batch
            yield from cut(held, ends[:-1])
            held = held.slice(int(ends[-2])).combine_chunks()
    if held is not None and len(held):
        yield from cut(held, ends_of(held))


def _searched(
    df: DataFrame, clicks: DataFrame, fs: float, win_ms: float, pre_ms: float, min_lag_ms: float, max_lag_ms: float, best: bool
) -> DataFrame:
    """Rows (recording, click, lag, ncc, ncc_before, ncc_after, echo_level) of all lags of each click, or of the best one."""
    frames_in = lambda ms: int(ms / 1000.0 * fs)
    win, pre, low, high = map(frames_in, (win_ms, pre_ms, min_lag_ms, max_lag_ms))
    span = win + high + pre + 1
    start = F.greatest(F.col("frame") - pre, F.lit(0))
    wanted = clicks.select(REC, "click", start.alias("_start")).withColumn(
        "_bucket",
        F.explode(F.sequence(F.floor(F.col("_start") / span), F.floor((F.col("_start") + span - 1) / span))),
    )
    near = df.withColumn("_bucket", F.floor(F.col("frame") / span))
    near = near.join(broadcast_if_small(wanted), [REC, "_bucket"])
    at = F.col("frame") - F.col("_start")
    near = near.where((at >= 0) & (at < span)).select(REC, F.col("click").cast("long"), at.cast("int").alias("_at"), "ref", "mic")
    schema = StructType([df.schema[REC]])
    for name, kind in (
        ("click", "long"), ("lag", "long"), ("ncc", "double"), ("ncc_before", "double"),
        ("ncc_after", "double"), ("echo_level", "double"),
    ):
        schema = schema.add(name, kind)

    def correlate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, ref, mic in _spans(batches):
            last = min(high, mic.shape[1] - win)
            if win < 1 or last < low:
                continue
            ncc = _correlations(ref[:, :win], mic, last + 1)
            lags = np.arange(low, last + 1)
            if best:
                lags = low + ncc[:, low:].argmax(axis=1)[:, None]
            else:
                lags = np.broadcast_to(lags, (len(ncc), len(lags)))
            row = np.arange(len(ncc))[:, None]
            inner = (lags > 0) & (lags < last)
            beside = lambda k: pa.array(ncc[row, np.clip(lags + k, 0, last)].ravel(), mask=~inner.ravel())
            which = pa.array(np.repeat(np.arange(len(ncc)), lags.shape[1]))
            own = keys.take(which).combine_chunks()
            yield pa.RecordBatch.from_arrays([
                own.column(0).combine_chunks(), own.column(1).combine_chunks(), pa.array(lags.ravel()), pa.array(ncc[row, lags].ravel()),
                beside(-1), beside(1), pa.array(mic[row, np.minimum(lags + pre, mic.shape[1] - 1)].ravel()),
            ], names=schema.names)

    ordered = spread(near, REC, "click").sortWithinPartitions(REC, "click", "_at")
    return ordered.mapInArrow(correlate, schema)


def window_ncc(
    df: DataFrame, clicks: DataFrame, fs: float, win_ms: float = WINDOW_MS,
    pre_ms: float = PRE_ROLL_MS, min_lag_ms: float = MIN_LAG_MS, max_lag_ms: float = MAX_LAG_MS,
) -> DataFrame:
    """Correlation per (recording, click, lag) of the click's window with the microphone.

    ``df`` and ``clicks`` count frames at the same rate ``fs``. Frames meet clicks
    through buckets as wide as a search span, so a frame is copied to the one or
    two clicks near it; clicks of equal length are correlated together. Each row also
    carries its neighbours on the lag axis (NULL at its ends) and the level at the echo's onset.
    """
    return _searched(df, clicks, fs, win_ms, pre_ms, min_lag_ms, max_lag_ms, best=False)


def strongest_lag(
    df: DataFrame, clicks: DataFrame, fs: float, win_ms: float = WINDOW_MS,
    pre_ms: float = PRE_ROLL_MS, min_lag_ms: float = MIN_LAG_MS, max_lag_ms: float = MAX_LAG_MS,
) -> DataFrame:
    """``best_lag`` of ``window_ncc`` found where the lags are, so that one row per click leaves the search."""
    return _searched(df, clicks, fs, win_ms, pre_ms, min_lag_ms, max_lag_ms, best=True)


def best_lag(ncc: DataFrame) -> DataFrame:
    """The first lag of highest correlation per click."""
    row = F.struct("lag", "ncc", "ncc_before", "ncc_after", "echo_level")
    best = ncc.groupBy(REC, "click").agg(
        F.max_by(row, F.struct(F.col("ncc"), -F.col("lag"))).alias("_best")
    )
    return best.select(REC, "click", "_best.*")


def parabolic_refine(best: DataFrame, fs: float) -> DataFrame:
    """Add ``latency_ms`` from the vertex of the parabola through a peak and its neighbours."""
    left, right = F.col("ncc_before"), F.col("ncc_after")
    bend = 2.0 * (left - 2.0 * F.col("ncc") + right)
    flat = bend.isNull() | (F.abs(bend) < 1e-12)
    shift = F.when(flat, F.lit(0.0)).otherwise((left - right) / F.when(~flat, bend))
    return best.withColumn("latency_ms", (F.col("lag") + shift) / fs * 1000.0)


def quality_gates(bursts: DataFrame, min_db: float = MIN_DB, min_corr: float = MIN_CORR) -> DataFrame:
    """Add the echo's level over the noise floor in dB, and whether both gates pass."""
    floor = lambda c: F.greatest(F.col(c), F.lit(1e-9))
    db = 20.0 * F.log10(floor("echo_level") / floor("noise_floor"))
    kept = (F.col("quality_db") >= min_db) & (F.col("ncc") >= min_corr)
    return bursts.withColumn("quality_db", db).withColumn("kept", kept)


def calibrate_bursts(bursts: DataFrame, target_median: float) -> DataFrame:
    """Shift every recording so that the median of its kept bursts meets the target.

    Bursts are one row per click and cost a search each, so they are kept before
    they are read for both the medians and the shift.
    """
    bursts = settled(bursts)
    medians = exact_percentiles(bursts.where("kept"), [REC], "latency_ms", {"_median": 0.5})
    shifted = bursts.join(medians.select(REC, "_median"), REC, "left")
    offset = F.coalesce(F.lit(target_median) - F.col("_median"), F.lit(0.0))
    return shifted.withColumn("latency_ms", F.col("latency_ms") + offset).drop("_median")


def measure_bursts(
    frames: DataFrame, fs: float, d: int = DECIMATION, thr: float = CLICK_SHARE,
    max_lag_ms: float = MAX_LAG_MS, min_lag_ms: float = MIN_LAG_MS, win_ms: float = WINDOW_MS,
    pre_ms: float = PRE_ROLL_MS, freq: float = FREQ_HZ, q: float = Q, tau_ms: float = ENVELOPE_MS,
    min_db: float = MIN_DB, min_corr: float = MIN_CORR, limit: int | None = None,
) -> DataFrame:
    """From raw frames to one gated row per click.

    The envelope is read by the click search, the correlation and the noise floor,
    so it is computed once and kept in the checkpoint folder.
    """
    level = settled(filtered_envelope(frames, fs, freq, q, tau_ms))
    clicks = settled(find_clicks(level, fs, thr, max_lag_ms, limit))
    coarse, rate = decimate(level, d), fs / d
    starts = clicks.withColumn("frame", F.floor(F.col("frame") / d))
    best = strongest_lag(coarse, starts, rate, win_ms, pre_ms, min_lag_ms, max_lag_ms)
    refined = parabolic_refine(best, rate)
    gated = quality_gates(refined.join(noise_floor(coarse, rate), REC), min_db, min_corr)
    timed = gated.join(clicks, [REC, "click"])
    return timed.select(
        REC, "click", (F.col("frame") / fs).alias("t_ref_s"), "latency_ms",
        F.col("ncc").alias("corr_peak"), "quality_db", "kept",
    )


# Sample streams


def resample_linear(df: DataFrame, in_rate: float, out_rate: float, limit: int | None = None) -> DataFrame:
    """Interpolate a stream (stream, i, v) to another rate; each output is made where it falls."""
    if in_rate == out_rate:
        return df
    ratio = in_rate / out_rate
    line = History(df.withColumn("_back", -F.col("i")), ["stream"], ["_back"], limit)
    line = line.previous(_next=F.col("v")).running(_last=("max", F.col("i")))
    i, step = F.col("i"), F.lit(ratio)
    # An output index belongs to the frame it falls on; one to spare on each side, then checked.
    first, last = F.greatest(F.floor(i / step) - 1, F.lit(0)), F.floor((i + 1) / step) + 1
    size = F.floor((F.col("_last") + 1) / step)
    here = F.filter(F.sequence(first, last), lambda o: (F.floor(o * step) == i) & (o < size))
    made = line.rows().withColumn("o", F.explode(here))
    place = F.col("o") * step
    share = place - i
    value = F.col("v") * (1 - share) + F.coalesce("_next", "v") * share
    return made.select("stream", F.col("o").alias("i"), value.alias("v"))


def flatten_chunks(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Concatenate captured chunks (stream, chunk, samples) in order to (stream, i, v)."""
    line = History(df, ["stream"], ["chunk"], limit).running(
        _offset=("sum", F.size("samples").cast("bigint"), False)
    )
    return line.rows().select(
        "stream", F.coalesce("_offset", F.lit(0)).alias("_offset"), F.posexplode("samples").alias("_at", "v")
    ).select("stream", (F.col("_offset") + F.col("_at")).alias("i"), "v")


def rms_level(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """RMS of a sample table per group."""
    return df.groupBy(*keys).agg(
        F.coalesce(F.sqrt(F.avg(F.col(value) * F.col(value))), F.lit(0.0)).alias("rms")
    )


def peak_amplitude(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Largest absolute sample per group."""
    return df.groupBy(*keys).agg(F.coalesce(F.max(F.abs(F.col(value))), F.lit(0.0)).alias("peak"))
