"""Sum-of-squares packing of documents into sequences.

Every open sequence has a gap, the tokens it still takes; N(g) counts the open ones
with gap g. A document goes where the sum of N(g)^2 over all gaps becomes smallest:
into a new sequence, or into one whose gap is not below its length. Opening adds
one to N(capacity - length), filling moves a sequence from gap g to g - length, so
each choice's change of the sum follows from the counts alone. Keeping the counts
small and even keeps some fitting gap at hand for every later length.

Documents longer than a sequence are cut into full pieces; only the last is packed.

Pieces are dealt by hash over groups whose number follows from the counted tokens,
and each group is packed by one task, longest pieces first. What a group leaves in
sequences that are not full goes into a second round over far fewer groups, so that
only a handful of sequences stays unfilled however large the input is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm import common, tokens

CAPACITY = 4096
END_ID = 1
# What one task packs: 16 bytes a row beside a table of gaps, so a group needs a few ten MB.
GROUP_TOKENS = 24_000_000
GROUP_PIECES = 400_000
# A sequence short of full by no more than this is left as it is.
SLACK = 64

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(docs: DataFrame, definition: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False,
        literal: bool = True) -> DataFrame:
    """Token pieces of ``docs(doc_id, text)``: ids and the end id, cut at ``capacity``.

    Null texts count as empty. Rows that repeat a doc_id are documents of their own:
    row_key tells them apart. ``with_ids`` adds the ids as little-endian uint32.
    ``literal``: see tokens.
    """
    schema = pa.schema(
        [("row_key", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
        + [("ids", pa.binary())] * with_ids
    )

    def encode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(definition, literal)
        end = np.uint32([end_id]).tobytes()

        def pieces():
            for batch in rows:
                for key, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    ids = encoder.ids(text) + end
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at:at + 4 * capacity]
                        row = {"row_key": key, "doc_id": doc_id, "piece": piece, "start": at // 4, "length": len(part) // 4, "ids_crc32": zlib.crc32(part)}
                        yield row | {"ids": part} if with_ids else row

        yield from common.batches(pieces(), schema)

    rows = docs.select(F.monotonically_increasing_id().alias("row_key"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(encode, "row_key long, " + PIECES + ", ids binary" * with_ids)


def stored_pieces(docs: DataFrame, definition: str, **options) -> DataFrame:
    """The pieces, written once: row keys stay fixed and nothing is tokenized twice."""
    return common.stored(cut(docs, definition, **options), "pieces")


def pack_lengths(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length, placed one after another by least sum of squares.

    Of equal choices a filled sequence is better than a touched one, and that better
    than a new one; among gaps the smaller, among sequences of one gap the newest.
    """
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    count = np.zeros(capacity + 1, np.int64)
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    opened = 0
    for k, length in enumerate(lengths.tolist()):
        gaps = count[length:capacity]  # N(length) .. N(capacity - 1)
        gap, change = capacity, (2 * int(count[capacity - length]) + 1 if length < capacity else 0)
        if gaps.any():
            # moving a sequence from g to g - length changes the sum by 2 (N(g - length) - N(g)) + 2
            delta = 2 * (count[:capacity - length] - gaps) + 2
            delta[0] = 1 - 2 * gaps[0]  # filled ones leave the sum
            delta[gaps == 0] = np.iinfo(np.int64).max
            best = int(delta.argmin())
            if delta[best] <= change:
                gap = length + best
        if gap == capacity:
            place, opened = opened, opened + 1
        else:
            place = open_by_gap[gap].pop()
            count[gap] -= 1
        left = gap - length
        sequence[k], offset[k] = place, capacity - gap
        if left:
            open_by_gap[left].append(place)
            count[left] += 1
    return sequence, offset


def _pack_groups(pieces: DataFrame, groups: int, capacity: int, round_: int) -> DataFrame:
    """A round: pieces get their sequence, their offset in it, and how full it is."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "row_key", "piece"], ascending=[False, True, True], kind="stable")
        sequence, offset = pack_lengths(rows["length"].to_numpy(), capacity)
        fill = np.bincount(sequence, weights=rows["length"].to_numpy()).astype(np.int64)
        group = int(rows["_group"].iloc[0])
        return rows.drop(columns="_group").assign(
            sequence_id=(round_ << 60 | group << 36) + sequence, offset=offset, _fill=fill[sequence]
        )

    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("row_key", "piece"), F.lit(groups)))
    kept = T.StructType(list(pieces.schema.fields)).add("sequence_id", T.LongType()).add("offset", T.LongType()).add("_fill", T.LongType())
    return dealt.groupBy("_group").applyInPandas(pack, kept)


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_tokens: int = GROUP_TOKENS, group_pieces: int = GROUP_PIECES, slack: int = SLACK) -> DataFrame:
    """Place pieces of 1 to ``capacity`` tokens: adds sequence_id and offset, gapless from 0.

    ``pieces`` needs row_key, piece and length, which tell its rows apart; other
    columns are carried along. The second round takes the sequences that the first
    left with a gap over ``slack``. No pieces give no rows.
    """

    def groups(df: DataFrame) -> int:
        n, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
        return max(1, -(-total // group_tokens), -(-n // group_pieces))

    first = common.stored(_pack_groups(pieces, groups(pieces), capacity, 0), "packed")
    wide = F.col("_fill") < capacity - slack
    left = first.where(wide).select(*pieces.columns)
    second = _pack_groups(left, groups(left), capacity, 1)
    return first.where(~wide).unionByName(second).drop("_fill")


def assemble(packed: DataFrame) -> DataFrame:
    """Sequences from packed pieces that carry ``ids``: sequence_id, n_tokens, ids, doc_ids in order.

    A group is one sequence, so it holds at most as many pieces as a sequence has tokens.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("_parts")).select(
        "sequence_id", "n_tokens",
        F.aggregate("_parts", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
        F.col("_parts.doc_id").alias("doc_ids"),
    )
