"""Column expressions: sentinels, rounding families, link and sensing arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the measurement: capture-to-playout constant, virtual energy
# budget, and the filename grammar of the exports.
DEVICE_CONST_MS = 40
VIRTUAL_BUDGET_BYTES = 50 * 1024 * 1024
RECORD_TYPES = {
    "audiogap": "audiogap",
    "dtx": "dtx",
    "gracegap": "gracegap",
    "mobility": "mobility",
    "remote": "realnet",
    "sensing": "sensing",
    "voice": "voice",
}
PREFIX_PATTERN = r"^wsn-([a-z]+)"
PEER_COUNT_PATTERN = r"-N(\d+)"
TRIAL_PATTERN = r"^wsn-voice-(.+)-trial\d+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Sentinels and defaults


def sentinel_to_null(c) -> Column:
    """A negative reading means not measured."""
    c = _col(c)
    return F.when(c >= 0, c)


null_if_negative = sentinel_to_null


def coalesce_default(c, default) -> Column:
    return F.coalesce(_col(c), F.lit(default))


def greatest_zero(c) -> Column:
    """Negative and missing counts add nothing."""
    return F.greatest(_col(c), F.lit(0))


# Rounding


def round_half_up(c, digits: int = 0) -> Column:
    """Ties away from zero, as the marts round."""
    return F.round(_col(c), digits)


def round_half_even(c, digits: int = 0) -> Column:
    """Ties to the even neighbour, as the independent reducer rounds."""
    return F.bround(_col(c), digits)


def round_half_ceiling(c) -> Column:
    """Ties toward plus infinity, as the client rounds; differs from half-up below zero."""
    return F.floor(_col(c) + F.lit(0.5))


# Text


def regex_extract(c, pattern: str, group: int = 1) -> Column:
    """The group, or NULL where the pattern does not match."""
    return F.nullif(F.regexp_extract(_col(c), pattern, group), F.lit(""))


def like_prefix(c, prefix: str) -> Column:
    return _col(c).startswith(prefix)


def peer_count(source_file) -> Column:
    return regex_extract(source_file, PEER_COUNT_PATTERN).cast("int")


def record_type(source_file) -> Column:
    """The type a filename announces; NULL for names outside the grammar."""
    known = F.create_map(*[F.lit(v) for pair in RECORD_TYPES.items() for v in pair])
    return F.try_element_at(known, F.coalesce(regex_extract(source_file, PREFIX_PATTERN), F.lit("")))


def ms_to_seconds_label(c) -> Column:
    return F.concat(F.floor(_col(c) / 1000).cast("string"), F.lit("s absence"))


def access_of(condition) -> Column:
    return (
        F.when(like_prefix(condition, "cellular"), "cellular")
        .when(like_prefix(condition, "homeNAT"), "home")
        .otherwise("other")
    )


# Candidates


def normalize_candidate_mix(mix: Column) -> Column:
    """Highest tier in use; host also stands for an all-zero or missing mix."""
    return F.when(mix["relay"] > 0, "relay").when(mix["srflx"] > 0, "srflx").otherwise("host")


def candidate_known(mix: Column) -> Column:
    """Whether the mix counted anything, so that a defaulted host can be told apart."""
    counts = [F.coalesce(mix[k], F.lit(0)) for k in ("host", "srflx", "relay")]
    return counts[0] + counts[1] + counts[2] > 0


def normalize_candidate_type(c) -> Column:
    c = _col(c)
    return F.when(c == "prflx", "srflx").otherwise(c)


# Links


def loss_pct(lost, received) -> Column:
    """Cumulative loss with one decimal; -1 when nothing arrived."""
    lost, received = _col(lost), _col(received)
    total = lost + received
    share = round_half_ceiling(lost * 1000 / F.when(total > 0, total)) / 10
    return F.coalesce(share, F.lit(-1.0))


def up_kbps(bytes_delta, ms_delta) -> Column:
    """Bits per millisecond are kbit/s; -1 where either delta is undefined or backward."""
    bytes_delta, ms_delta = _col(bytes_delta), _col(ms_delta)
    rate = F.when(
        (bytes_delta >= 0) & (ms_delta > 0),
        round_half_ceiling(bytes_delta * 8 / F.when(ms_delta > 0, ms_delta)),
    )
    return F.coalesce(rate, F.lit(-1)).cast("bigint")


def suppressed_pct(samples, suppressed) -> Column:
    samples, suppressed = _col(samples), _col(suppressed)
    share = round_half_ceiling(suppressed * 100 / F.when(samples > 0, samples))
    return F.coalesce(share, F.lit(0)).cast("bigint")


def mouth_to_ear_ms(rtt_s, jitter_ms, device_ms: float = DEVICE_CONST_MS) -> Column:
    """Half the round trip, plus the jitter buffer, plus the device constant."""
    return round_half_ceiling(_col(rtt_s) * 1000 / 2 + _col(jitter_ms) + device_ms).cast("bigint")


def calibrated_ms(lat_raw_ms, offset) -> Column:
    raw = _col(lat_raw_ms)
    return F.when(raw >= 0, round_half_ceiling(raw + _col(offset)).cast("bigint")).otherwise(F.lit(-1))


def ignores_offer(my_nonce, remote_nonce, making_offer, state) -> Column:
    """The impolite side (nonce not lower) drops an offer that collides with its own."""
    impolite = _col(my_nonce) >= _col(remote_nonce)
    return impolite & (_col(making_offer) | (_col(state) != "stable"))


# Positions


def tile_distance_sq(ax, ay, bx, by) -> Column:
    dx, dy = _col(ax) - _col(bx), _col(ay) - _col(by)
    return dx * dx + dy * dy


def tile_distance(ax, ay, bx, by) -> Column:
    return F.hypot(_col(ax) - _col(bx), _col(ay) - _col(by))


# Samples


def rms_of_bytes(samples) -> Column:
    """RMS of an array of unsigned bytes centred at 128; 0 when empty."""
    samples = _col(samples)
    power = F.aggregate(
        samples, F.lit(0.0), lambda acc, b: acc + ((b - 128) / 128.0) * ((b - 128) / 128.0)
    )
    return F.coalesce(F.sqrt(power / F.nullif(F.size(samples), F.lit(0))), F.lit(0.0))


def peak_of(samples) -> Column:
    """Largest absolute value of an array; 0 when empty."""
    return F.coalesce(F.array_max(F.transform(_col(samples), F.abs)), F.lit(0.0))
