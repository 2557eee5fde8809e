"""Token ids in directly addressable codes (DAC): random access without decoding blocks.

An id is split into chunks of eight bits, the lowest first. Level k holds chunk k
of every id that reaches it, one byte each, and a bitmap that marks the ids going
on to level k + 1. A rank directory (ones before every 512 bits) turns a place in
level k into the place in level k + 1 by one look-up and the ones of at most eight
words, so token i costs at most four such steps and nothing around it is decoded.

A shard is one file:

    magic "DACTOK1\\n" | levels, documents, tokens (3 x uint64)
    document ids (int64), null flags (uint8), starts (uint64, one more than documents)
    per level: n (uint64), chunks (n bytes), and but for the last level
               bitmap ((n + 63) // 64 + 1 words of uint64), directory (n // 512 + 1 x uint64)

Shards follow each other in ascending document id, so the shards' tokens in order
are one stream. A manifest with the shards' sizes gives each shard its base in it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm import common, tokens

MAGIC = b"DACTOK1\n"
END_ID = 0
# Tokens after which a task begins its next shard; a document is never cut.
SHARD_TOKENS = 4_000_000
# Documents of a range at most, so that ranges grow in number and not in size.
PARTITION_DOCS = 100_000

_MANIFEST = T.StructType([
    T.StructField("part", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("path", T.StringType()),
    T.StructField("n_docs", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_bytes", T.LongType()),
])


class Shard:
    """A shard's bytes with random access to tokens and documents."""

    def __init__(self, buffer):
        view = memoryview(buffer)
        if bytes(view[:8]) != MAGIC:
            raise ValueError("not a DAC token shard")
        levels, n_docs, self.n_tokens = (int(x) for x in np.frombuffer(view, "<u8", 3, 8))
        self._at = 32
        take = lambda kind, n: self._take(view, kind, n)
        self.doc_ids, self.null_ids = take("<i8", n_docs), take("u1", n_docs)
        self.starts = take("<u8", n_docs + 1).astype(np.int64)
        self.levels = []
        for level in range(levels):
            n = int(take("<u8", 1)[0])
            chunks = take("u1", n)
            last = level == levels - 1
            bits = None if last else take("<u8", (n + 63) // 64 + 1)
            ranks = None if last else take("<u8", n // 512 + 1)
            self.levels.append((chunks, bits, ranks))

    def _take(self, view, kind: str, n: int) -> np.ndarray:
        found = np.frombuffer(view, kind, n, self._at)
        self._at += found.nbytes
        return found

    @staticmethod
    def _rank(bits: np.ndarray, ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ones before each place: the directory's count and the ones of the words since."""
        total = ranks[at // 512].astype(np.int64)
        word, first = at // 64, at // 512 * 8
        for k in range(8):
            whole = first + k < word
            if whole.any():
                total[whole] += np.bitwise_count(bits[first[whole] + k])
        rest = bits[word] & ((np.uint64(1) << (at % 64).astype(np.uint64)) - np.uint64(1))
        return total + np.bitwise_count(rest)

    def tokens(self, at) -> np.ndarray:
        """The ids at the given places, in that order."""
        at = np.asarray(at, np.int64)
        found = np.zeros(len(at), np.uint32)
        where = np.arange(len(at))
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            found[where] |= chunks[at].astype(np.uint32) << np.uint32(8 * level)
            if bits is None or not len(where):
                break
            on = (bits[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1) == 1
            where, at = where[on], self._rank(bits, ranks, at[on])
        return found

    def run(self, start: int, end: int) -> np.ndarray:
        """The ids from start up to end: one rank per level, then the levels' stretches as they lie."""
        found = np.zeros(end - start, np.uint32)
        where = None
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            part = chunks[start:end].astype(np.uint32) << np.uint32(8 * level)
            if where is None:
                found |= part
            else:
                found[where] |= part
            if bits is None or start == end:
                break
            words = bits[start // 64:(end + 63) // 64]
            on = np.unpackbits(words.view(np.uint8), bitorder="little")[start % 64:start % 64 + end - start].view(bool)
            where = np.flatnonzero(on) if where is None else where[on]
            start = int(self._rank(bits, ranks, np.array([start]))[0])
            end = start + int(on.sum())
        return found


def encode_shard(doc_ids: list[int | None], starts: list[int], ids: np.ndarray) -> list[bytes]:
    """The parts of a shard's file; ``starts`` has one more entry than there are documents."""
    levels = []
    rest = ids.astype(np.uint32)
    while True:
        chunks, rest = (rest & 0xFF).astype(np.uint8), rest >> np.uint32(8)
        goes_on = rest > 0
        if not goes_on.any():
            levels.append([np.uint64([len(chunks)]).tobytes(), chunks.tobytes()])
            break
        size = (len(chunks) + 63) // 64 + 1
        bits = np.zeros(size * 8, np.uint8)
        packed = np.packbits(goes_on, bitorder="little")
        bits[: len(packed)] = packed
        bits = bits.view("<u8")
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.uint64)])
        ranks = ones[np.arange(len(chunks) // 512 + 1) * 8].astype("<u8")
        levels.append([np.uint64([len(chunks)]).tobytes(), chunks.tobytes(), bits.tobytes(), ranks.tobytes()])
        rest = rest[goes_on]
    head = [
        MAGIC, np.array([len(levels), len(doc_ids), len(ids)], "<u8").tobytes(),
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], "u1").tobytes(), np.array(starts, "<u8").tobytes(),
    ]
    return head + [part for level in levels for part in level]


def write_shards(docs: DataFrame, definition: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS, literal: bool = True) -> DataFrame:
    """Tokenize ``docs(doc_id, text)`` and write them as shards in ascending id; returns the manifest.

    The range shuffle moves each text once; its range's task tokenizes, encodes and
    writes. Equal ids keep all their rows, ordered by their texts' hash; null ids
    come first. Null texts count as empty and hold the end id alone. ``literal``: see tokens.
    """
    spark = docs.sparkSession
    folder = common.shared_folder(spark, "dac")
    parts = common.partitions_for(spark, -(-docs.count() // PARTITION_DOCS))
    tie = F.xxhash64("text")

    def write(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        encoder, part = tokens.encoder(definition, literal), context.partitionId()
        end = np.uint32([end_id]).tobytes()
        doc_ids, starts, held, made = [], [0], [], []

        def flush() -> None:
            ids = np.frombuffer(b"".join(held), "<u4")
            path = f"{folder}/shard-{part:06d}-{len(made):04d}-{context.taskAttemptId()}.dac"
            size = common.write_file(path, encode_shard(doc_ids, starts, ids))
            made.append((part, len(made), path, len(doc_ids), len(ids), size))
            doc_ids.clear(), held.clear(), starts.clear(), starts.append(0)

        for batch in rows:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoder.ids(text) + end
                doc_ids.append(doc_id), held.append(ids), starts.append(starts[-1] + len(ids) // 4)
                if starts[-1] >= shard_tokens:
                    flush()
        if doc_ids:
            flush()
        for row in made:
            yield pa.RecordBatch.from_pylist([dict(zip(_MANIFEST.names, row, strict=True))], _schema(_MANIFEST))

    ordered = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        .repartitionByRange(parts, "doc_id", tie).sortWithinPartitions("doc_id", tie)
    )
    manifest = common.stored(ordered.mapInArrow(write, _MANIFEST), "dac-manifest")
    # One row per shard: the running sum over them is far smaller than any partition of the corpus.
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _schema(schema: T.StructType) -> pa.Schema:
    kinds = {T.LongType(): pa.int64(), T.StringType(): pa.string(), T.BinaryType(): pa.binary(), T.IntegerType(): pa.int32()}
    return pa.schema([(f.name, kinds[f.dataType]) for f in schema])


def read_documents(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """Read the shards back: a row per document, in shards' order within each file.

    start and n_tokens place the document in the whole stream; ids_crc32 covers its
    ids as little-endian unsigned 32-bit integers. ``with_ids`` adds them.
    """
    out = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    ] + [T.StructField("ids", T.BinaryType())] * with_ids)

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = Shard(common.read_file(path))

                def documents(shard=shard, base=base):
                    # all of a shard's documents are wanted, so it is decoded once and cut
                    whole = memoryview(shard.run(0, shard.n_tokens).astype("<u4", copy=False)).cast("B")
                    starts = shard.starts.tolist()
                    for k, doc_id in enumerate(shard.doc_ids.tolist()):
                        start, end = starts[k], starts[k + 1]
                        ids = bytes(whole[4 * start:4 * end])
                        row = {"doc_id": None if shard.null_ids[k] else doc_id, "start": base + start,
                               "n_tokens": end - start, "ids_crc32": zlib.crc32(ids)}
                        yield row | {"ids": ids} if with_ids else row

                yield from common.batches(documents(), _schema(out))

    spread = manifest.select("path", "base").repartition(common.partitions_for(manifest.sparkSession))
    return spread.mapInArrow(read, out)


def look_up(manifest: DataFrame, places: DataFrame) -> DataFrame:
    """Tokens at given places of the whole stream: ``places(place)`` -> place, token.

    Places are matched to shards by their base (a shard's range holds them), and each
    shard answers its places from its rank directories. Places outside the stream and
    null ones are left out; repeated places answer once each.
    """
    out = T.StructType([T.StructField("place", T.LongType()), T.StructField("token", T.LongType())])

    def answer(key, rows: pa.Table) -> pa.Table:
        places = rows.column("place").to_numpy()
        shard = Shard(common.read_file(key[0].as_py()))
        found = shard.tokens(places - rows.column("base")[0].as_py())
        return pa.table({"place": places, "token": found.astype(np.int64)})

    shards = manifest.select("path", "base", (F.col("base") + F.col("n_tokens")).alias("_end"))
    held = places.select("place").join(
        F.broadcast(shards) if shards.count() <= 100_000 else shards,
        (F.col("place") >= F.col("base")) & (F.col("place") < F.col("_end")),
    )
    return held.groupBy("path", F.spark_partition_id().alias("_slice")).applyInArrow(
        lambda key, rows: answer(key, rows), out
    )
