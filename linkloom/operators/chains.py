"""Walks whose next step depends on the last one, split over chunks of a key.

Some rules cannot be told from a window: whether a sample is reported depends on
the last *reported* one. Their state is a single number (the time or frame of the
last pick), so a chunk acts as a map from the states it may be entered with to
the state it leaves. The maps are found for all chunks in parallel, chained per
key in one pass over a table that has one row per chunk, and the chunks are then
walked again, each from its true entry.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StructType

# The state before a key's first row.
FRESH = -(2**62)


def map_schema(pieces: DataFrame, keys: list[str]) -> StructType:
    """Schema of a chunk map: the keys, then where each entry state leads."""
    states = ArrayType(LongType())
    return StructType([pieces.schema[k] for k in keys]).add("entries", states).add("exits", states)


def compact(moves: dict[int, int]) -> tuple[list[int], list[int]]:
    """Entries and exits in order, keeping only the last entry of a run that leads to the same exit."""
    ordered = sorted(moves.items())
    last = [i for i, (_, x) in enumerate(ordered) if i + 1 == len(ordered) or ordered[i + 1][1] != x]
    return [ordered[i][0] for i in last], [ordered[i][1] for i in last]


def chunk_entries(maps: DataFrame, keys: list[str], chunk: str = "_chunk") -> DataFrame:
    """From (keys, chunk, entries[], exits[]) give each chunk's true entry state.

    A state uses the move with the smallest entry not below it; without one it
    passes through the chunk unchanged.
    """

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = None, FRESH
        for batch in batches:
            starts = []
            for key, entries, exits in zip(
                batch[keys].itertuples(index=False, name=None), batch["entries"], batch["exits"]
            ):
                if key != at:
                    at, state = key, FRESH
                starts.append(state)
                state = min(
                    ((e, x) for e, x in zip(entries, exits) if e >= state), default=(0, state)
                )[1]
            yield batch[keys + [chunk]].assign(entry=starts)

    schema = maps.select(*keys, chunk).schema.add("entry", "long")
    return maps.repartition(*keys).sortWithinPartitions(*keys, chunk).mapInPandas(walk, schema)
