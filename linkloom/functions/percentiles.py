"""The three percentile definitions in use, and an exact form for unbounded domains.

``percentile_interpolated`` and ``percentile_nearest_rank`` are built-in exact
aggregates. Both keep one counter per distinct value of a group, so they fit
readings on a bounded grid (milliseconds, percent, counts), whatever the number
of rows. ``exact_percentiles`` is for values without such a grid: it counts equal
values, ranks the counts with a running sum and picks the two order statistics,
so no task ever holds a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkloom import session as settings
from linkloom.operators.history import History, broadcast_if_small, has_hot_keys, settled


def percentile_interpolated(c: Column | str, p: float) -> Column:
    """Linear interpolation between order statistics; NULLs are skipped."""
    return F.percentile(c, p)


def median(c: Column | str) -> Column:
    return F.percentile(c, 0.5)


def percentile_nearest_rank(expression: str, p: float, empty: int = -1) -> Column:
    """The ceil(p*n)-th smallest value of a SQL expression, rounded; ``empty`` if none."""
    rank = F.expr(f"percentile_disc({p}) within group (order by {expression})")
    return F.coalesce(F.floor(rank + F.lit(0.5)).cast("bigint"), F.lit(empty))


def percentile_approximate(c: Column | str, p: float, accuracy: int = 10_000) -> Column:
    """A bounded sketch, for callers that ask for it; never a default."""
    return F.percentile_approx(c, p, accuracy)


def exact_percentiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    ps: dict[str, float],
    limit: int | None = None,
    spread: bool = False,
) -> DataFrame:
    """One row per group with its size and an interpolated percentile per name.

    ``spread`` adds mean_ms, min_ms and max_ms from the same counted values.

    The rows are read once: values are counted and kept, and the counts tell whether a
    group has too many distinct values for one task. That picks the way, not the result.
    """
    limit = limit or settings.hot_rows(df.sparkSession)
    measured = df.where(F.col(value).isNotNull())
    counts = settled(measured.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")))
    hot = has_hot_keys(counts, keys, limit)
    ranked = History(counts, keys, [value], limit, hot).running(_upto=("sum", F.col("_n")))
    if ranked.chunked:
        sizes = counts.groupBy(*keys).agg(F.sum("_n").alias("_size"))
        sized = ranked.rows().join(broadcast_if_small(sizes), keys)
    else:
        whole = Window.partitionBy(*keys)
        sized = ranked.rows().withColumn("_size", F.sum("_n").over(whole))

    def at(rank: Column) -> Column:
        """The value whose run of equals covers a zero-based rank."""
        return F.max(F.when((F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto")), F.col(value)))

    picks = {}
    for name, p in ps.items():
        position = F.lit(p) * (F.col("_size") - 1)
        picks[f"_lo_{name}"] = at(F.floor(position))
        picks[f"_hi_{name}"] = at(F.ceil(position))
    if spread:
        picks["mean_ms"] = F.sum(F.col(value) * F.col("_n")) / F.first("_size")
        picks["min_ms"], picks["max_ms"] = F.min(value), F.max(value)
    picked = sized.groupBy(*keys, F.col("_size").alias("n")).agg(
        *[c.alias(k) for k, c in picks.items()]
    )
    out = [F.col(k) for k in keys] + [F.col("n")]
    for name, p in ps.items():
        position = F.lit(p) * (F.col("n") - 1)
        share = position - F.floor(position)
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append((low + (high - low) * share).alias(name))
    return picked.select(*out, *(["mean_ms", "min_ms", "max_ms"] if spread else []))
