"""Collocations: phrases whose words occur together more often than apart, per language.

Only longest windows are counted. A piece's words stand beside their successors in
lead-window columns w1, w2, ... (padded with nulls at the piece's end), one row per word.
Every occurrence of a shorter phrase begins exactly one window, so Spark's ROLLUP over
w1, w2, ... sums the windows' counts over successively shorter prefixes, and the counts
of all phrases, of single words and of the language come out of one aggregation, without
an explosion per phrase length.

Most windows are rare. Before the rollup, a window seen fewer times than a candidate must
be gives its count to its prefix, and prefixes do so in turn, unless a longer window that
stays has the same prefix; no count of a phrase seen often enough changes by that, and the
rollup's input shrinks to what can matter. The sums this takes are dealt by the whole
window, after each task has added up its own, so that no word or pair gathers in one
task; keys travel in packed blocks, which take a fifth of the room of rows.

Parts of a phrase are looked up by the whole phrase; the report per language is cut in
slices before it is ordered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm import common

UNKNOWN = "und"
# A-Z folded, every break a line feed, tabs spaces; in UTF-8 these bytes never occur inside another character.
FLAT = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))
SCALE = 1_000_000
# Slices a language's candidates are ranked in before the slices' first rows are ranked together.
SLICES = 64
# Bytes of text whose windows are made together, windows a task adds up before it sends them, and characters of text per receiving partition.
STRETCH = 1 << 19
HELD = 1 << 18
PARTITION_CHARS = 1 << 23


@dataclass(frozen=True)
class Rule:
    """Phrases of 2 to ``words`` words seen ``least`` times; a longer phrase with ``covers`` percent of one's count replaces it."""

    words: int = 3
    least: int = 10
    covers: int = 50


@dataclass(frozen=True)
class Counted:
    """Keys (words joined by spaces) with n, their count, and kept, the count of longer windows with this prefix that stay."""

    key: pa.LargeBinaryArray
    n: np.ndarray
    kept: np.ndarray

    def __len__(self) -> int:
        return len(self.n)

    def bytes(self) -> tuple[np.ndarray, np.ndarray]:
        """Where keys begin and end (one more than there are keys), and all their bytes."""
        offsets = np.frombuffer(self.key.buffers()[1], np.int64)[self.key.offset:self.key.offset + len(self.key) + 1]
        held = self.key.buffers()[2]
        data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.empty(0, np.uint8)
        return offsets - offsets[0], data[offsets[0]:offsets[-1]]

    def take(self, at: np.ndarray) -> Counted:
        return Counted(self.key.take(pa.array(at)), self.n[at], self.kept[at])


def _keys(offsets: np.ndarray, data: bytes) -> pa.LargeBinaryArray:
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])


def _joined(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> bytes:
    """Stretches of ``data`` one after another, copied a few megabytes at a time."""
    ends = np.cumsum(lengths)
    cuts = np.unique(np.searchsorted(ends, np.arange(0, ends[-1] if len(ends) else 0, 1 << 21))).tolist()
    made = []
    for a, b in zip(cuts, [*cuts[1:], len(starts)]):
        n = lengths[a:b]
        first = np.cumsum(n) - n
        made.append(data[np.arange(int(n.sum())) + np.repeat(starts[a:b] - first, n)].tobytes())
    return b"".join(made)


def added(parts: list[Counted]) -> Counted:
    """Sums over equal keys; doubles hold sums up to 2^53 exactly."""
    coded = pa.concat_arrays([p.key for p in parts]).dictionary_encode()
    place, size = coded.indices.to_numpy(), len(coded.dictionary)
    sums = [np.bincount(place, np.concatenate(of), size).astype(np.int64) for of in ([p.n for p in parts], [p.kept for p in parts])]
    return Counted(coded.dictionary, *sums)


def shortened(rows: Counted, size: int, least: int) -> Counted:
    """Rows of ``size`` words that are too rare give their count to their prefix; the others are announced to it."""
    offsets, data = rows.bytes()
    spaces = np.flatnonzero(data == 32)
    before = np.searchsorted(spaces, offsets)
    words = np.diff(before) + (np.diff(offsets) > 0)
    whole = np.flatnonzero(words == size)
    often = (rows.n + rows.kept >= least)[whole]
    stay = np.ones(len(rows), bool)
    stay[whole[~often]] = False
    starts = offsets[:-1][whole]
    lengths = (spaces[before[1:][whole] - 1] if size > 1 else starts) - starts
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    given = np.where(often, 0, rows.n[whole])
    prefixes = Counted(_keys(ends, _joined(data, starts, lengths)), given, np.where(often, (rows.n + rows.kept)[whole], 0))
    kept = rows.take(np.flatnonzero(stay))
    own = np.isin(np.flatnonzero(stay), whole)
    return added([Counted(kept.key, kept.n, np.where(own, 0, kept.kept)), prefixes])


def _buckets(rows: Counted, parts: int) -> np.ndarray:
    """The receiving partition of each key, from its length and the eight bytes at its start, middle and end."""
    offsets, data = rows.bytes()
    starts, lengths = offsets[:-1], np.diff(offsets)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    spare = np.maximum(lengths - 8, 0)
    short = (np.uint64(8) * (8 - np.minimum(lengths, 8)).astype(np.uint64))
    first = np.where(lengths > 0, (eight[starts] << short), 0)  # without bytes of the next key
    mixed = common.mix(first + lengths.astype(np.uint64))
    for at in (spare // 2, spare):
        mixed = common.mix(mixed + np.where(spare > 0, eight[starts + at], 0))
    return (mixed % np.uint64(parts)).astype(np.int32)


def _packed(rows: Counted) -> bytes:
    """Number of keys, lengths, the two sums and the keys' bytes, compressed; the size before it leads."""
    offsets, data = rows.bytes()
    numbers = np.concatenate([[len(rows)], np.diff(offsets), rows.n, rows.kept]).astype("<i8")
    flat = numbers.tobytes() + data.tobytes()
    return len(flat).to_bytes(8, "little") + pa.Codec("zstd").compress(flat, asbytes=True)


def _unpacked(block: bytes) -> Counted:
    flat = pa.Codec("zstd").decompress(block[8:], int.from_bytes(block[:8], "little"), asbytes=True)
    rows = int.from_bytes(flat[:8], "little")
    lengths, n, kept = (np.frombuffer(flat, "<i8", rows, 8 + 8 * rows * k) for k in range(3))
    return Counted(_keys(np.concatenate([[0], np.cumsum(lengths)]), flat[8 + 24 * rows:]), n, kept)


def _blocks(lang: str, parts: list[Counted], receivers: int) -> pa.RecordBatch:
    """A language's keys, added up, a block per receiving partition."""
    rows = added(parts)
    bucket = _buckets(rows, receivers)
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows.take(order), bucket[order]
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(starts[1:], len(bucket))
    made = [_packed(Counted(rows.key.slice(a, b - a), rows.n[a:b], rows.kept[a:b])) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    pa.default_memory_pool().release_unused()
    return pa.RecordBatch.from_arrays([pa.array(bucket[starts]), pa.array([lang] * len(made), pa.string()), pa.array(made, pa.binary())], ["bucket", "lang", "block"])


def longest_windows(flat: bytes, size: int) -> pa.LargeBinaryArray:
    """The longest window from every word of a flat text on: the columns w1, w2, ... side by side, shorter at a piece's end."""
    buf = np.frombuffer(b"\n" + flat + b"\n", np.uint8)
    apart = (buf == 32) | (buf == 10)
    starts, ends = (np.flatnonzero(edge) + 1 for edge in (apart[:-1] & ~apart[1:], ~apart[:-1] & apart[1:]))
    piece = np.cumsum(buf == 10)[starts]
    last = np.minimum(np.arange(len(starts)) + size - 1, np.searchsorted(piece, piece, side="right") - 1)
    # the words one space apart, so that a window is one stretch of bytes
    keep = ~apart
    keep[ends] = True
    words = buf[keep]
    at = np.concatenate([[0], np.cumsum(ends - starts + 1)])
    words[at[1:] - 1] = 32
    lengths = at[1:][last] - 1 - at[:-1]
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    return _keys(offsets, _joined(words, at[:-1], lengths))


def _stretches(flat: bytes, size: int) -> Iterator[tuple[bytes, int]]:
    """A long text in stretches, each with the number of words that follow it and begin no window of their own."""
    start = 0
    while len(flat) - start > 2 * STRETCH:
        cut = flat.rfind(b"\n", start, start + STRETCH)
        if cut > start:
            yield flat[start:cut], 0
            start = cut
            continue
        # no break: cut in front of a word, and read on for the words its windows reach
        cut = flat.find(b" ", start + STRETCH)
        if cut < 0:
            break
        ahead = re.compile(rb"(?: *[^ \n]+){0,%d}" % (size - 1)).match(flat, cut).group()
        yield flat[start:cut] + ahead, len(ahead.split())
        start = cut
    yield flat[start:], 0


def _ones(keys: pa.LargeBinaryArray) -> Counted:
    return Counted(keys, np.ones(len(keys), np.int64), np.zeros(len(keys), np.int64))


def _count(size: int, receivers: int):
    """Texts (lang, text) to blocks of their longest windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[str, list[bytes]] = {}
        held: dict[str, list[Counted]] = {}
        waiting = count = 0

        def make() -> int:
            made = 0
            for lang, parts in texts.items():
                keys = longest_windows(b"\n".join(parts), size)
                held.setdefault(lang, []).append(_ones(keys))
                made += len(keys)
            texts.clear()
            return made

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not text.is_valid:
                    continue
                flat = text.as_py().encode("utf-8", "surrogatepass").translate(FLAT)
                for part, borrowed in _stretches(flat, size):
                    if borrowed:
                        keys = longest_windows(part, size)
                        held.setdefault(lang, []).append(_ones(keys.slice(0, len(keys) - borrowed)))
                        count += len(keys)
                    else:
                        texts.setdefault(lang, []).append(part)
                        waiting += len(part) + 64
                    if waiting >= STRETCH:
                        count, waiting = count + make(), 0
                    if count >= HELD:
                        yield from (_blocks(name, parts, receivers) for name, parts in held.items())
                        held, count = {}, 0
        make()
        yield from (_blocks(name, parts, receivers) for name, parts in held.items())

    return run


def _received(batches: Iterator[pa.RecordBatch]) -> dict[str, Counted]:
    """A partition's sums by language."""
    held: dict[str, list[Counted]] = {}
    fresh: dict[str, int] = {}
    for batch in batches:
        for lang, block in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
            own = held.setdefault(lang, [])
            own.append(_unpacked(block.as_py()))
            fresh[lang] = fresh.get(lang, 0) + len(own[-1])
            # added up whenever as many rows have come as are held
            if fresh[lang] >= max(HELD, len(own[0])):
                held[lang], fresh[lang] = [added(own)], 0
    return {lang: added(own) for lang, own in held.items()}


def _shorten(size: int, least: int, receivers: int):
    """Blocks to blocks, with windows of ``size`` words cut back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, rows in _received(batches).items():
            yield _blocks(lang, [shortened(rows, size, least)], receivers)

    return run


def _rows(least: int):
    """Blocks to rows (lang, phrase, n), with single words cut back to the language itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, rows in _received(batches).items():
            rows = shortened(rows, 1, least)
            rows = rows.take(np.flatnonzero(rows.n > 0))
            langs = pa.array([lang] * len(rows), pa.string())
            yield pa.RecordBatch.from_arrays([langs, rows.key.cast(pa.large_string()).cast(pa.string()), pa.array(rows.n)], ["lang", "phrase", "n"])

    return run


def frequent_windows(docs: DataFrame, rule: Rule) -> DataFrame:
    """lang, w1 ... wN, n: windows cut back to the longest prefix that is seen often enough, or to none."""
    names = [f"w{k}" for k in range(1, rule.words + 1)]
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("string").alias("text"))
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    receivers = common.partitions_for(docs.sparkSession, -(-chars // PARTITION_CHARS))
    sent = "bucket int, lang string, block binary"
    blocks = texts.mapInArrow(_count(rule.words, receivers), sent).repartition(receivers, "bucket")
    for size in range(rule.words, 1, -1):
        blocks = blocks.mapInArrow(_shorten(size, rule.least, receivers), sent).repartition(receivers, "bucket")
    rows = blocks.mapInArrow(_rows(rule.least), "lang string, phrase string, n long")
    words = F.split(F.nullif("phrase", F.lit("")), " ")
    return rows.select("lang", *[F.get(words, F.lit(k)).alias(name) for k, name in enumerate(names)], "n")


def phrase_counts(docs: DataFrame, rule: Rule) -> DataFrame:
    """lang, size, phrase (words joined by spaces), f: all phrases of up to N words seen often enough.

    Size 0 is the language itself with its number of words.
    """
    names = [f"w{k}" for k in range(1, rule.words + 1)]
    summed = docs.sparkSession.sql(
        f"SELECT lang, {', '.join(names)}, sum(n) AS f, grouping_id() AS _level FROM {{windows}} GROUP BY lang, ROLLUP ({', '.join(names)})",
        windows=frequent_windows(docs, rule),
    )
    # every column rolled up sets a bit
    size = F.lit(rule.words) - F.bit_count("_level").cast("int")
    whole = [F.when(size < k, True).otherwise(F.col(name).isNotNull()) for k, name in enumerate(names, 1)]
    for test in whole:  # a prefix that reaches behind the end of a window is no phrase
        summed = summed.where(test)
    phrase = F.concat_ws(" ", *names)  # columns rolled up are null
    return summed.select("lang", size.alias("size"), phrase.alias("phrase"), "f").where((F.col("size") == 0) | (F.col("f") >= rule.least))


def _part(words: Column, start: int, length: int) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def _score(a: str, left: str, right: str) -> Column:
    """floor(SCALE * a * a / (left * right)), in decimals of 38 digits throughout."""
    wide = lambda name: F.col(name).cast("decimal(19,0)")
    top = (wide(a) * wide(a)).cast("decimal(32,0)") * F.lit(SCALE).cast("decimal(7,0)")
    return F.call_function("div", top.cast("decimal(38,0)"), (wide(left) * wide(right)).cast("decimal(38,0)"))


def candidates(counts: DataFrame, rule: Rule) -> DataFrame:
    """lang, size, phrase, a, l, r, score of every phrase of two words and more, by its lowest-scoring cut."""
    known = counts.select("lang", F.col("phrase").alias("_part"), F.col("f").alias("_f"))
    phrases = counts.where("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"))
    words = F.split("phrase", " ")
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("*", _part(words, 1, F.col("k")).alias("_left"), _part(words, F.col("k") + 1, F.col("size") - F.col("k")).alias("_right"))
    # a part is seen at least as often as the phrase, so it is among the counts kept
    for end, side in (("l", "_left"), ("r", "_right")):
        held = known.select("lang", F.col("_part").alias(side), F.col("_f").alias(end))
        cuts = cuts.join(held, ["lang", side])
    scored = cuts.select("lang", "size", "phrase", "a", F.struct(_score("a", "l", "r").alias("score"), "k", "l", "r").alias("_cut"))
    best = scored.groupBy("lang", "size", "phrase", "a").agg(F.min("_cut").alias("_cut"))
    return best.select("lang", "size", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")


def covered(counts: DataFrame, rule: Rule) -> DataFrame:
    """lang, phrase, longest: the largest count of a longer phrase that holds the phrase."""
    longer = counts.where("size > 2").select("lang", "size", F.col("f").alias("_f"), F.split("phrase", " ").alias("_words"))
    inside = longer.select(
        "lang", "_f", "_words", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("_n")
    ).select("lang", "_f", "_words", "_n", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("_n") + 1)).alias("_at"))
    return inside.groupBy("lang", _part(F.col("_words"), F.col("_at"), F.col("_n")).alias("phrase")).agg(F.max("_f").alias("longest"))


def mine(docs: DataFrame, top: int = 2000, rule: Rule = Rule()) -> DataFrame:
    """The first ``top`` collocations of each language in ``docs(text, lang)``.

    Returns lang, rank, phrase, a, l, r, n, score, by score and a descending, then phrase
    in UTF-8 byte order. Null and empty texts have no words; rows repeat as often as they
    stand in the table; ids and other columns play no part. A language without candidates
    has no rows, and an empty table gives none.
    """
    counts = common.stored(phrase_counts(docs, rule), "phrases")
    found = candidates(counts, rule).join(covered(counts, rule), ["lang", "phrase"], "left")
    found = found.where(F.col("longest").isNull() | (F.col("longest").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(38,0)") * rule.covers))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    sliced = found.withColumn("_slice", F.pmod(F.xxhash64("phrase"), F.lit(SLICES)))
    first = sliced.withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_slice").orderBy(*order))).where(F.col("_rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
