"""Data-quality suites as column aggregates: all checks of a table in one pass."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    name: str
    violations: Callable[[], Column] | None = None  # row predicate; NULL values pass
    unique: str | None = None  # needs a count per value instead


def expect_not_null(column: str) -> Check:
    return Check(f"{column} not null", lambda: F.col(column).isNull())


def expect_unique(column: str) -> Check:
    return Check(f"{column} unique", unique=column)


def expect_in_set(column: str, values: list) -> Check:
    return Check(f"{column} in set", lambda: ~F.col(column).isin(*values))


def expect_between(column: str, low: float | None = None, high: float | None = None) -> Check:
    def outside() -> Column:
        value = F.col(column)
        below = value < low if low is not None else F.lit(False)
        above = value > high if high is not None else F.lit(False)
        return below | above

    return Check(f"{column} between", outside)


def _repeats(df: DataFrame, check: Check) -> DataFrame:
    """Rows whose value occurs more than once; counted per value, so no group is gathered."""
    per_value = df.where(F.col(check.unique).isNotNull()).groupBy(check.unique).agg(
        F.count(F.lit(1)).alias("n")
    )
    repeated = F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))
    return per_value.agg(repeated.alias("bad_rows")).select(F.lit(check.name).alias("check"), "bad_rows")


def run_suite(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per check: (check, ok, bad_rows). Row checks share a single aggregate."""
    by_row = [c for c in checks if c.violations is not None]
    parts = []
    if by_row:
        counted = df.agg(*[F.count_if(c.violations()).alias(f"c{i}") for i, c in enumerate(by_row)])
        rows = [
            F.struct(F.lit(c.name).alias("check"), F.col(f"c{i}").alias("bad_rows"))
            for i, c in enumerate(by_row)
        ]
        parts.append(counted.select(F.inline(F.array(*rows))))
    parts += [_repeats(df, c) for c in checks if c.unique]
    results = reduce(DataFrame.unionByName, parts)
    return results.select("check", (F.col("bad_rows") == 0).alias("ok"), "bad_rows")


class Observed:
    """A suite counted while its table is written: row checks cost no scan of their own.

    ``df`` is to be written instead of the table; once it is, ``results`` gives what
    ``run_suite`` would. Counts are taken in the tasks that write and add up over them.
    Checks of uniqueness need a count per value and read the written table's column.
    """

    def __init__(self, df: DataFrame, checks: list[Check]):
        self.checks = checks
        self.by_row = [c for c in checks if c.violations is not None]
        self.counts = Observation()
        counted = [F.count_if(c.violations()).alias(f"c{i}") for i, c in enumerate(self.by_row)]
        self.df = df.observe(self.counts, *counted) if counted else df

    def results(self, written: DataFrame) -> DataFrame:
        found = self.counts.get if self.by_row else {}
        rows = [(c.name, int(found[f"c{i}"])) for i, c in enumerate(self.by_row)]
        parts = [written.sparkSession.createDataFrame(rows, "check string, bad_rows long")] if rows else []
        parts += [_repeats(written, c) for c in self.checks if c.unique]
        results = reduce(DataFrame.unionByName, parts)
        return results.select("check", (F.col("bad_rows") == 0).alias("ok"), "bad_rows")


def write_checked(df: DataFrame, name: str, checks: list[Check], write: Callable[[DataFrame], None], read: Callable[[], DataFrame]) -> DataFrame:
    """Write a table with its suite counted on the way: (table, check, ok, bad_rows)."""
    observed = Observed(df, checks)
    write(observed.df)
    return observed.results(read()).select(F.lit(name).alias("table"), "check", "ok", "bad_rows")


def run_checkpoint(suites: dict[str, tuple[DataFrame, list[Check]]]) -> DataFrame:
    """All suites together: (table, check, ok, bad_rows)."""
    results = [
        run_suite(df, checks).select(F.lit(name).alias("table"), "check", "ok", "bad_rows")
        for name, (df, checks) in suites.items()
    ]
    return reduce(DataFrame.unionByName, results)


def checkpoint_summary(results: DataFrame) -> DataFrame:
    """Success per table, and overall as the row without a table."""
    return results.rollup("table").agg(F.bool_and("ok").alias("ok"))


def assert_rows_empty(df: DataFrame) -> DataFrame:
    """A query that must return nothing: (n, ok)."""
    return df.agg(F.count(F.lit(1)).alias("n")).select("n", (F.col("n") == 0).alias("ok"))


# Fixed value sets and ranges of the tables.
LINK_FACT_CHECKS = [
    expect_not_null("source_file"),
    expect_in_set("record_type", ["voice", "realnet"]),
    expect_in_set("candidate_type", ["host", "srflx", "relay"]),
    expect_between("n_peers", 0),
    expect_between("glare", 0),
]
MART_CHECKS = {
    "kpi_vs_n": [
        expect_not_null("n_peers"),
        expect_unique("n_peers"),
        expect_between("ice_success_pct", 0, 100),
        expect_between("m2e_ms", 0, 1000),
        expect_between("setup_median_ms", 0),
    ],
    "sensing_suppression": [
        expect_not_null("scenario"),
        expect_in_set("scenario", ["idle", "walk", "conv", "churn"]),
        expect_between("suppression_median_pct", 0, 100),
    ],
    "realnet_conditions": [
        expect_in_set("path", ["direct", "relay"]),
        expect_in_set("access", ["cellular", "home", "other"]),
        expect_between("rtt_median_ms", 0, 5000),
    ],
    "mobility_cycles": [
        expect_not_null("complete_cycles"),
        expect_between("form_median_ms", 0),
        expect_between("teardown_median_ms", 0),
        expect_between("reconnect_median_ms", 0),
    ],
    "audiogap": [expect_not_null("valid_runs")],
    "dtx_uplink": [expect_in_set("source", ["tone", "speech"])],
    "gracegap_series": [expect_not_null("absence_ms")],
}
