"""Ordered history per key that survives a key holding a third of all rows.

A plain window sends every row of a key to one task. ``History`` first counts
rows per key (one narrow job, map-side combined). If no key is hot it uses plain
windows, which share one shuffle. If one is, the rows of hot keys are range
partitioned on (key, order) so that each spreads over many chunks, and every result
is computed inside the chunk and completed with a carry from the chunks before it;
rows of cold keys stay as they are, one chunk a key. A carry exists only where a key
straddles a chunk border, so the carry table has at most one row per chunk; it is
broadcast after it was counted. Both ways give equal results.

Rows that agree in their order are put in the order of their content (a hash of all
columns but maps), so results do not depend on the order of arrival. Callers whose
ties have a meaning name a sequence of arrival in ``order``.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType
from pyspark.sql.window import Window

from linkloom import session as settings

CHUNK = "_chunk"
TIE = "_tie"
# Chunks per core of the cluster at most, so that a driver can keep track of them.
CHUNKS_PER_CORE = 100


def _holds_map(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_holds_map(f.dataType) for f in kind)
    return _holds_map(kind.elementType) if isinstance(kind, ArrayType) else isinstance(kind, MapType)


def same_keys(left: DataFrame, right: DataFrame, keys: list[str], prefix: str = "") -> Column:
    """Null-safe equality on keys; ``prefix`` marks the right side's copies."""
    return reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(right[prefix + k]) for k in keys]
    )


def oversized_keys(
    df: DataFrame, keys: list[str], limit: int, weight: Column | None = None
) -> DataFrame:
    """Keys with more rows than one task should walk; ``weight`` counts a row as several."""
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(*keys).agg(rows.alias("_rows")).where(F.col("_rows") > limit)


def has_hot_keys(
    df: DataFrame, keys: list[str], limit: int | None = None, weight: Column | None = None
) -> bool:
    """Asked once where several steps share a key, so that nothing upstream runs again for it."""
    limit = limit or settings.hot_rows(df.sparkSession)
    return not oversized_keys(df, keys, limit, weight).isEmpty()


def settled(df: DataFrame) -> DataFrame:
    """Keep a small, costly result that several steps read, in the shared checkpoint folder."""
    settings.use_checkpoints(df.sparkSession)
    return df.checkpoint()


def chunked_by_range(df: DataFrame, keys: list[str], order: list[str], limit: int) -> DataFrame:
    """Cut the frame into ordered ranges of about ``limit`` rows, numbered in order.

    The number is the partition a row landed in, so it is fixed by a reliable
    checkpoint before anything depends on it.
    """
    rows = df.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    most = CHUNKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
    parts = max(2, min(math.ceil(rows / limit), most))
    ranged = df.repartitionByRange(parts, *keys, *order)
    return settled(ranged.withColumn(CHUNK, F.spark_partition_id()))


def is_small(df: DataFrame, max_rows: int | None = None) -> bool:
    """Whether a side was counted to stay within what is broadcast by hand."""
    bound = settings.broadcast_rows(df.sparkSession) if max_rows is None else max_rows
    return df.limit(bound + 1).count() <= bound


def broadcast_if_small(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Hint a broadcast only after counting the side; beyond the bound Spark shuffles it."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Partition by keys for work that costs more CPU than bytes.

    A fixed count keeps adaptive execution from merging partitions that look small.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def join_hot_safe(
    big: DataFrame, small: DataFrame, keys: list[str], how: str = "left", limit: int | None = None
) -> DataFrame:
    """Join a fact side whose keys may be hot to a side with few rows per key.

    A counted, small enough side is broadcast, which leaves the facts where they
    are. Otherwise cold keys take the ordinary shuffled join; hot ones number at
    most rows/limit, so just the rows of ``small`` they need are counted and broadcast.
    """
    if is_small(small):
        return big.join(F.broadcast(small), keys, how)
    if not has_hot_keys(big, keys, limit):
        return big.join(small, keys, how)
    limit = limit or settings.hot_rows(big.sparkSession)
    hot = oversized_keys(big, keys, limit).select(*[F.col(k).alias("_h_" + k) for k in keys])
    hot = broadcast_if_small(settled(hot))
    hot_big = big.join(hot, same_keys(big, hot, keys, "_h_"), "left_semi")
    hot_small = small.join(hot, same_keys(small, hot, keys, "_h_"), "left_semi")
    cold_big = big.join(hot, same_keys(big, hot, keys, "_h_"), "left_anti")
    return cold_big.join(small, keys, how).unionByName(
        hot_big.join(broadcast_if_small(settled(hot_small)), keys, how)
    )


class History:
    """Rows of a frame in total order per key."""

    def __init__(
        self,
        df: DataFrame,
        keys: list[str],
        order: list[str],
        limit: int | None = None,
        hot: bool | None = None,
    ):
        """``hot`` skips the count where the answer is known already."""
        self.keys, self.order = list(keys), [*order, TIE]
        limit = limit or settings.hot_rows(df.sparkSession)
        if hot is None:
            hot = has_hot_keys(df, self.keys, limit)
        df = df.withColumn(TIE, F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if not _holds_map(f.dataType)]))
        if hot:
            large = oversized_keys(df, self.keys, limit).select(*[F.col(k).alias("_h_" + k) for k in self.keys])
            large = broadcast_if_small(settled(large))
            among = same_keys(df, large, self.keys, "_h_")
            hot_rows = chunked_by_range(df.join(large, among, "left_semi"), self.keys, self.order, limit)
            cold_rows = df.join(large, among, "left_anti").withColumn(CHUNK, F.lit(-1))
            df = cold_rows.unionByName(hot_rows)
        self.df = df

    @property
    def chunked(self) -> bool:
        return CHUNK in self.df.columns

    @property
    def spark(self) -> SparkSession:
        return self.df.sparkSession

    def _over(self, df: DataFrame) -> History:
        twin = object.__new__(History)
        twin.keys, twin.order, twin.df = self.keys, self.order, df
        return twin

    def with_columns(self, **columns: Column) -> History:
        return self._over(self.df.withColumns(columns))

    def where(self, condition: Column) -> History:
        return self._over(self.df.where(condition))

    def rows(self) -> DataFrame:
        return self.df.drop(CHUNK, TIE)

    def _window(self):
        parts = self.keys + ([CHUNK] if self.chunked else [])
        return Window.partitionBy(*parts).orderBy(*self.order)

    def _with_carry(self, totals: DataFrame, carries: dict[str, Column]) -> DataFrame:
        """Join per-chunk carries (null where a key starts in the chunk)."""
        known = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in carries])
        carry = totals.withColumns(carries).where(known)
        border = self.keys + [CHUNK]
        carry = broadcast_if_small(
            carry.select(*[F.col(k).alias("_b_" + k) for k in border], *carries)
        )
        joined = self.df.join(carry, same_keys(self.df, carry, border, "_b_"), "left")
        return joined.drop(*["_b_" + k for k in border])

    def previous(self, **columns: Column) -> History:
        """Add, per name, the value the expression had on the key's previous row."""
        window = self._window()
        if not self.chunked:
            return self.with_columns(**{n: F.lag(c).over(window) for n, c in columns.items()})
        tail = F.struct(*[c.alias(n) for n, c in columns.items()])
        tails = self.df.groupBy(*self.keys, CHUNK).agg(
            F.max_by(tail, F.struct(*self.order)).alias("_tail")
        )
        across = Window.partitionBy(*self.keys).orderBy(CHUNK)
        df = self._with_carry(tails, {"_before": F.lag("_tail").over(across)})
        first = F.row_number().over(window) == 1
        return self._over(
            df.withColumns(
                {
                    n: F.when(first, F.col("_before")[n]).otherwise(F.lag(c).over(window))
                    for n, c in columns.items()
                }
            ).drop("_before")
        )

    def running(self, **specs: tuple) -> History:
        """Add running results per key; each spec is (how, column[, inclusive=True]).

        ``how`` is one of sum, max, min, last (the latest non-null value).
        """
        fold = {
            "sum": F.sum,
            "max": F.max,
            "min": F.min,
            "last": lambda c: F.last(c, ignorenulls=True),
        }
        join = {
            "sum": lambda a, b: F.when(a.isNull(), b).otherwise(a + F.coalesce(b, F.lit(0))),
            "max": F.greatest,
            "min": F.least,
            "last": F.coalesce,
        }
        window = self._window()

        def inside(spec):
            end = 0 if len(spec) < 3 or spec[2] else -1
            return fold[spec[0]](spec[1]).over(window.rowsBetween(Window.unboundedPreceding, end))

        if not self.chunked:
            return self.with_columns(**{n: inside(s) for n, s in specs.items()})

        def total(how, column):
            if how == "last":
                at = F.when(column.isNotNull(), F.struct(*self.order))
                return F.max_by(column, at)
            return fold[how](column)

        totals = self.df.groupBy(*self.keys, CHUNK).agg(
            *[total(s[0], s[1]).alias("_t_" + n) for n, s in specs.items()]
        )
        across = (
            Window.partitionBy(*self.keys)
            .orderBy(CHUNK)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        carries = {"_c_" + n: fold[s[0]](F.col("_t_" + n)).over(across) for n, s in specs.items()}
        df = self._with_carry(totals, carries)
        return self._over(
            df.withColumns(
                {n: join[s[0]](inside(s), F.col("_c_" + n)) for n, s in specs.items()}
            ).drop(*carries)
        )


def first_at_or_after(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_time: str,
    right_time: str,
    name: str,
    limit: int | None = None,
    hot: bool | None = None,
) -> DataFrame:
    """Add to each left row the earliest right time not before its own, per key.

    An as-of join as one ordered pass: both sides share the key's time line, read
    backwards, and the last right time seen is the answer. No pair is ever formed.
    """
    line = left.select(
        *keys, (-F.col(left_time)).alias("_back"), F.lit(1).alias("_side"),
        F.lit(None).cast("bigint").alias("_hit"), *[F.col(c).alias("_l_" + c) for c in left.columns],
    ).unionByName(
        right.select(
            *keys, (-F.col(right_time)).alias("_back"), F.lit(0).alias("_side"),
            F.col(right_time).cast("bigint").alias("_hit"),
        ),
        allowMissingColumns=True,
    )
    found = History(line, keys, ["_back", "_side"], limit, hot).running(**{name: ("last", F.col("_hit"))})
    return found.rows().where(F.col("_side") == 1).select(*[F.col("_l_" + c).alias(c) for c in left.columns], name)
