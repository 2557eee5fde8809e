"""Exact top-k by inner product over a pivot-distance index.

Components become integers, floor(256 x). One more coordinate, sqrt(M - |v|^2) with M
the largest squared norm, turns the largest inner product with a query (whose extra
coordinate is 0) into the smallest Euclidean distance, where the triangle inequality
holds: |d(q, p) - d(p, v)| <= d(q, v) for any pivot p.

Index: every vector is keyed by its nearest pivot and its distance to it. In that
order vectors are cut into annuli, blocks of at most 1024 vectors of one pivot with
the range of their distances; equal vectors are ordered by id, so a hot one fills
several annuli. Pivots are centres of a bounded sample: they only decide how tight
the bounds are, never the result.

Search: a batch of queries first visits a few annuli nearest to it, which gives each
query a lower bound for its k-th score and so a radius. It then expands to exactly
those annuli that the bound cannot exclude, for some of its queries; inside an
annulus, queries are excluded one by one. Distances only ever exclude, with a margin
for rounding; scores are whole numbers computed exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm import common
from linkloom.operators import history

SCALE = 256
PIVOTS = 64
SAMPLE = 4096
BLOCK_VECTORS = 1024
BATCH_QUERIES = 256
FIRST_BLOCKS = 4
# Queries that meet a block in one task at most.
SLICE_QUERIES = 16_384
_BOUNDED = 2.0**53



def integers(vectors: DataFrame) -> DataFrame:
    """vec_id and floor(256 x) of each component. Vectors that are null, or hold a null or non-finite
    component, and rows without an id are left out; values beyond a long are its limits."""
    kept = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("_x"))
    finite = F.forall("_x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return kept.where("vec_id is not null and _x is not null").where(finite).select("vec_id", F.transform("_x", lambda x: F.floor(x * SCALE)).alias("vector"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column; shorter vectors count as zero in the components they lack."""
    made = np.zeros((len(column), width), np.int64)
    ends = np.asarray(column.offsets)
    values = column.values.to_numpy(zero_copy_only=False)
    if len(column) and width and (np.diff(ends) == width).all():
        return values[ends[0]:ends[-1]].reshape(len(column), width).astype(np.int64)
    for k in range(len(column)):
        row = values[ends[k]:ends[k + 1]]
        made[k, :len(row)] = row
    return made


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def _raised(x: np.ndarray, largest: float) -> np.ndarray:
    x = x.astype(np.float64)
    return np.hstack([x, np.sqrt(np.maximum(largest - (x**2).sum(axis=1), 0))[:, None]])


def choose_pivots(sample: np.ndarray, count: int = PIVOTS, rounds: int = 8) -> np.ndarray:
    """Centres of a sample in the raised space (Lloyd's rounds from evenly picked points)."""
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    centres = np.unique(sample[np.linspace(0, len(sample) - 1, min(count, len(sample))).astype(int)], axis=0)
    for _ in range(rounds):
        near = _distances(sample, centres).argmin(axis=1)
        centres = np.stack([sample[near == k].mean(axis=0) if (near == k).any() else centres[k] for k in range(len(centres))])
    return centres


class Index:
    """Blocks of all vectors by pivot and distance, in the shared folder, and what queries need of them."""

    def __init__(self, vectors: DataFrame):
        rows = common.stored(integers(vectors), "vectors")
        spark = rows.sparkSession
        square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
        n, width, largest, top = rows.agg(
            F.count(F.lit(1)), F.max(F.size("vector")), F.max(square), F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x.cast("double"))))),
        ).first()
        self.n, self.width, self.largest = n, int(width or 0), float(largest or 0.0)
        # whole numbers below 2^53 add up exactly in doubles
        self.exact = self.width * float(top or 0.0) ** 2 < _BOUNDED
        # by hash of the id, so that the sample does not depend on the input's order
        sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow().column("vector").combine_chunks()
        self.pivots = choose_pivots(_raised(_matrix(sample, self.width), self.largest) if n else np.zeros((0, self.width + 1)))
        self.rows = rows
        width, largest, pivots = self.width, self.largest, self.pivots

        def key(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in rows:
                values = _matrix(batch.column(1), width)
                far = _distances(_raised(values, largest), pivots)
                near = far.argmin(axis=1) if len(far) else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array(near.astype(np.int32)), pa.array(far[np.arange(len(far)), near]), pa.array([v.tobytes() for v in values], pa.binary()),
                ], ["vec_id", "pivot", "distance", "vector"])

        def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[tuple] = []

            def block() -> pa.RecordBatch:
                ids, pivot, far, values = zip(*held, strict=True)
                return pa.RecordBatch.from_pydict({
                    "pivot": pa.array([pivot[0]], pa.int32()), "low": [min(far)], "high": [max(far)],
                    "ids": [np.array(ids, np.int64).tobytes()], "vectors": [b"".join(values)],
                })

            for batch in rows:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if held and (row[1] != held[0][1] or len(held) == BLOCK_VECTORS):
                        yield block()
                        held.clear()
                    held.append(row)
            if held:
                yield block()

        keyed = rows.mapInArrow(key, "vec_id long, pivot int, distance double, vector binary")
        parts = max(spark.sparkContext.defaultParallelism, -(-n // 50_000))
        ordered = keyed.repartitionByRange(parts, "pivot", "distance", "vec_id").sortWithinPartitions("pivot", "distance", "vec_id")
        blocks = ordered.mapInArrow(cut, "pivot int, low double, high double, ids binary, vectors binary")
        self.blocks = common.stored(blocks.withColumn("block", F.monotonically_increasing_id()), "annuli")
        self.directory = self.blocks.select("block", "pivot", "low", "high")


def _batches(index: Index, queries: DataFrame) -> DataFrame:
    """Queries in batches that lie close together, with their distances to all pivots."""
    width, pivots = index.width, index.pivots

    def key(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            values = _matrix(batch.column(1), width)
            far = _distances(np.hstack([values, np.zeros((len(values), 1))]), pivots)
            near = far.argmin(axis=1) if len(far) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(near.astype(np.int32)), pa.array(far[np.arange(len(far)), near]),
                pa.array([v.tobytes() for v in values], pa.binary()), pa.array([d.tobytes() for d in far], pa.binary()),
            ], ["vec_id", "home", "distance", "vector", "distances"])

    def gather(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for start in range(0, batch.num_rows, BATCH_QUERIES):
                part = batch.slice(start, BATCH_QUERIES)
                yield pa.RecordBatch.from_pydict({
                    "home": part.column(1).slice(0, 1), "ids": [part.column(0).to_numpy().tobytes()],
                    "vectors": [b"".join(part.column(3).to_pylist())], "distances": [b"".join(part.column(4).to_pylist())],
                })

    keyed = queries.mapInArrow(key, "vec_id long, home int, distance double, vector binary, distances binary")
    parts = max(1, -(-queries.count() // (8 * BATCH_QUERIES)))
    ordered = keyed.repartitionByRange(parts, "home", "distance", "vec_id").sortWithinPartitions("home", "distance", "vec_id")
    made = ordered.mapInArrow(gather, "home int, ids binary, vectors binary, distances binary")
    return common.stored(made.withColumn("batch", F.monotonically_increasing_id()), "queries")


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        bar = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= bar)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def _visit(index: Index, batches: DataFrame, pairs: DataFrame, k: int, bounds: str | None) -> DataFrame:
    """Best k of each visited (batch, block): query_id, vec_id, score.

    A block travels once per slice with a batch that visits it, a batch once per block it visits.
    ``bounds`` names the batches' binary column of the queries' least useful scores.
    """
    width, exact, largest = index.width, index.exact, index.largest
    slices = max(1, -(-batches.count() * BATCH_QUERIES // SLICE_QUERIES))
    deal = F.pmod(F.xxhash64("batch"), F.lit(slices)).cast("int")
    pairs = common.stored(pairs.select("batch", "block").withColumn("slice", deal), "visits")
    asked = pairs.join(batches, "batch")
    asked = asked.select(F.col("block").alias("_at"), F.col("slice").alias("_slice"), "ids", "vectors", "distances", *([F.col(bounds).alias("least")] if bounds else []))
    given = index.blocks.join(history.broadcast_if_small(common.stored(pairs.select("block", "slice").distinct(), "visited")), "block")

    def search(block: pa.Table, batches: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for held in block.to_pylist() if batches.num_rows else []:
            ids = np.frombuffer(held["ids"], np.int64)
            values = np.frombuffer(held["vectors"], np.int64).reshape(len(ids), width)
            target = values.astype(np.float64).T if exact else values.astype(object).T
            for row in batches.to_pylist():
                own = np.frombuffer(row["ids"], np.int64)
                queries = np.frombuffer(row["vectors"], np.int64).reshape(len(own), width)
                least = np.frombuffer(row["least"], np.float64) if bounds else np.full(len(own), -np.inf)
                far = np.frombuffer(row["distances"], np.float64).reshape(len(own), -1)[:, held["pivot"]]
                reach = _radius(queries, least, largest)
                near = np.flatnonzero((far - reach <= held["high"]) & (far + reach >= held["low"]))
                if not len(near):
                    continue
                scores = (queries[near].astype(np.float64) if exact else queries[near].astype(object)) @ target
                scores = scores.astype(np.int64) if exact else np.clip(scores, -(2**63), 2**63 - 1).astype(np.int64)
                for j, query in enumerate(near.tolist()):
                    others = np.flatnonzero((ids != own[query]) & (scores[j] >= least[query]))
                    places = others[_best(scores[j][others], ids[others], k)]
                    found.append((np.full(len(places), own[query]), ids[places], scores[j][places]))
        columns = [np.concatenate([f[c] for f in found]) if found else np.empty(0, np.int64) for c in range(3)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    return given.groupBy("block", "slice").cogroup(asked.groupBy("_at", "_slice")).applyInArrow(search, "query_id long, vec_id long, score long")


def _radius(queries: np.ndarray, least: np.ndarray, largest: float) -> np.ndarray:
    """How far a vector with at least that score may lie, with a margin for rounding."""
    square = (queries.astype(np.float64) ** 2).sum(axis=1) + largest
    return np.sqrt(np.maximum(square - 2 * least, 0) + 1e-9 * (square + np.where(np.isfinite(least), np.abs(least), 0))) + 1e-6


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """The k best other vectors of each query: query_id, rank from 1, vec_id, score.

    ``vectors(vec_id, embedding)``; ``is_query`` tells by vec_id which rows ask. Fewer
    than k other vectors give all of them. A row that repeats a vec_id counts as that
    vector again, so ids are expected to be distinct; a query never finds its own id.
    """
    index = Index(vectors)
    batches = _batches(index, index.rows.where(is_query))
    width, largest, n_pivots = index.width, index.largest, len(index.pivots)

    # Round one: a few annuli of the home pivot, the nearest to the batch's middle distance.
    def middle(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in batch.to_pylist():
                far = np.frombuffer(row["distances"], np.float64).reshape(-1, n_pivots)[:, row["home"]]
                yield pa.RecordBatch.from_pydict({"batch": [row["batch"]], "pivot": pa.array([row["home"]], pa.int32()), "at": [float(np.median(far))]})

    homes = batches.select("batch", "home", "distances").mapInArrow(middle, "batch long, pivot int, at double")
    gap = F.greatest(F.col("low") - F.col("at"), F.col("at") - F.col("high"), F.lit(0.0))
    near = Window.partitionBy("batch").orderBy(gap, "block")
    first = homes.join(index.directory, "pivot").withColumn("_n", F.row_number().over(near)).where(F.col("_n") <= FIRST_BLOCKS)
    best = _ranked(_visit(index, batches, first, k, None), k)
    # the k-th score, or no bound where fewer were found
    bars = common.stored(best.groupBy("query_id").agg(F.min("score").alias("bar"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k).select("query_id", "bar"), "bars")

    # Round two: all annuli that the bounds leave.
    members = batches.select("batch", "ids").mapInArrow(_members, "batch long, query_id long, place int")
    lists = members.join(bars, "query_id").groupBy("batch").agg(F.collect_list(F.struct("place", "bar")).alias("bars"))
    known = batches.join(lists, "batch", "left")

    def bound(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in batch.to_pylist():
                least = np.full(len(row["ids"]) // 8, -np.inf)
                for bar in row["bars"] or []:
                    least[bar["place"]] = bar["bar"]
                queries = np.frombuffer(row["vectors"], np.int64).reshape(len(least), width)
                far = np.frombuffer(row["distances"], np.float64).reshape(len(least), n_pivots)
                reach = _radius(queries, least, largest)[:, None]
                yield pa.RecordBatch.from_pydict({
                    "batch": [row["batch"]], "least": [least.tobytes()],
                    "reaches": pa.array([[{"pivot": p, "from": float(a), "to": float(b)} for p, (a, b) in enumerate(zip((far - reach).min(axis=0), (far + reach).max(axis=0), strict=True))]],
                                        pa.list_(pa.struct([("pivot", pa.int32()), ("from", pa.float64()), ("to", pa.float64())]))),
                })

    reached = common.stored(known.select("batch", "ids", "vectors", "distances", "bars").mapInArrow(
        bound, "batch long, least binary, reaches array<struct<pivot:int,from:double,to:double>>"), "reaches")
    wanted = reached.select("batch", F.explode("reaches").alias("r")).select("batch", "r.*")
    left = wanted.join(index.directory, "pivot").where((F.col("low") <= F.col("to")) & (F.col("high") >= F.col("from")))
    asked = batches.join(reached.select("batch", "least"), "batch")
    return _ranked(_visit(index, asked, left, k, "least"), k).select("query_id", "rank", "vec_id", "score")


def _members(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for row in batch.to_pylist():
            ids = np.frombuffer(row["ids"], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([row["batch"]] * len(ids), pa.int64()), pa.array(ids), pa.array(np.arange(len(ids), dtype=np.int32))], ["batch", "query_id", "place"])
