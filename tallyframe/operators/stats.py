"""Exact column statistics that complement the sketch profile.

These are the exact twins of sketch fields (distinct counts, frequent
values, histograms, PMFs, describe).  Each is a plain aggregate; where an
exact answer needs per-value state (distinct, top values) the state is a
shuffle on (column, value), never a list held by one task.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyframe.operators.profile import ProfileOptions, numeric_view, quote, spread_input


def _unpivot_text(df: DataFrame, columns) -> DataFrame:
    """(column, value) pairs, values as text, nulls dropped."""
    return (df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(quote(c)).cast("string").alias("value"))
        for c in columns])).alias("kv"))
        .select("kv.column", "kv.value").filter(F.col("value").isNotNull()))


def value_counts(df: DataFrame, columns) -> DataFrame:
    """Exact (column, value, count) over the given columns.

    Partial aggregation on the map side collapses repeated values before
    the shuffle; a value holding a third of the rows is one row per task.
    """
    df, _ = spread_input(df.select(*[F.col(quote(c)) for c in columns]), ProfileOptions())
    return _unpivot_text(df, columns).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("count"))


def exact_distinct(df: DataFrame, columns) -> DataFrame:
    """Exact number of distinct non-null values per column (compared as text)."""
    return (value_counts(df, columns).groupBy("column")
            .agg(F.count(F.lit(1)).cast("bigint").alias("distinct_count")))


def top_values(df: DataFrame, columns, k: int = 10) -> DataFrame:
    """Exact k most frequent values per column; ties by smaller value.

    Per column: one grouped count (a scan that reads only that column) and
    one bounded ``orderBy().limit(k)`` (take-ordered, k rows per task),
    instead of a window that would put every distinct value of a column in
    one task.
    """
    parts = []
    for c in columns:
        v = F.col(quote(c)).cast("string")
        counts = (df.select(v.alias("value")).filter(F.col("value").isNotNull())
                  .groupBy("value").agg(F.count(F.lit(1)).alias("count")))
        parts.append(counts.orderBy(F.desc("count"), F.asc("value")).limit(k)
                     .select(F.lit(c).alias("column"), "value", "count"))
    out = reduce(DataFrame.unionByName, parts)
    # At most k rows per column reach this window.
    w_rank = F.row_number().over(
        Window.partitionBy("column").orderBy(F.desc("count"), F.asc("value")))
    return out.select("column", "value", "count", w_rank.alias("rank"))


def min_max(df: DataFrame, column: str) -> tuple[float | None, float | None]:
    """Two scalars to the driver (bounded): the range of a column's finite values."""
    x = numeric_view(F.col(quote(column)))
    finite = F.when(F.abs(x) < float("inf"), x)
    r = df.agg(F.min(finite).alias("lo"), F.max(finite).alias("hi")).first()
    return r["lo"], r["hi"]


def bin_width(lo: float, hi: float, bins: int) -> float:
    return (hi - lo) / bins if math.isfinite(hi - lo) else hi / bins - lo / bins


def equal_width_bin(x: Column, lo: float, hi: float, bins: int) -> Column:
    """Bin index in [0, bins-1]; the top edge belongs to the last bin, values outside to the end bins."""
    width = bin_width(lo, hi, bins)
    if width == 0:
        inner = F.lit(0)
    elif math.isfinite(hi - lo):
        inner = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1))
    else:      # the difference of two values may overflow
        inner = F.least(F.floor(x / F.lit(width) - F.lit(lo / width)), F.lit(bins - 1))
    return F.when(x > F.lit(hi), F.lit(bins - 1)).when(x < F.lit(lo), F.lit(0)).otherwise(inner).cast("bigint")


def equal_width_histogram(df: DataFrame, column: str, bins: int = 30,
                          lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Exact equal-width histogram: (column, bin, lower_edge, count).

    The range comes from the profile when known and finite, else from one min/max
    aggregate over the finite values (two scalars).  Infinite values count in the end bins.
    """
    if lo is None or hi is None or not (math.isfinite(lo) and math.isfinite(hi)):
        lo, hi = min_max(df, column)
    x = numeric_view(F.col(quote(column)))
    if lo is None or hi is None:     # no finite values: no range
        lo = hi = 0.0
    width = bin_width(lo, hi, bins)
    b = equal_width_bin(x, lo, hi, bins)
    return (df.filter(x.isNotNull()).select(b.alias("bin"))
            .groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
            .select(F.lit(column).alias("column"), "bin",
                    (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower_edge"), "count"))


def pmf_cells(df: DataFrame, column: str, points) -> DataFrame:
    """Exact PMF at split points: cell i holds points[i-1] <= x < points[i].

    m points give m+1 cells; cell = number of points <= x.  Written as a
    sum of comparisons so it stays inside generated code.
    """
    x = numeric_view(F.col(quote(column)))
    cell = reduce(lambda a, b: a + b, [F.when(x >= F.lit(float(p)), 1).otherwise(0)
                                       for p in points], F.lit(0))
    counts = df.filter(x.isNotNull()).groupBy(cell.alias("cell")).agg(
        F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy(F.lit(1)))
    # At most m+1 rows: the window over one partition is bounded.
    return counts.select(F.lit(column).alias("column"), "cell", "count",
                         (F.col("count") / total).alias("pmf"))


def describe_numeric(df: DataFrame, columns, exact: bool = True,
                     quantiles=(0.25, 0.5, 0.75), accuracy: int = 10000) -> DataFrame:
    """count, mean, std, min, quartiles, max per column (pandas ``describe``).

    Moments come from one aggregate over all columns.  Quartiles are exact
    and interpolated like Spark's ``percentile`` (``exact``: range-narrowing
    order statistics, a few filtered passes, no group held in one task) or
    ``percentile_approx`` (one pass, bounded sketch).
    """
    from tallyframe.operators.quantiles import exact_quantiles_columns
    aggs = []
    for i, c in enumerate(columns):
        x = numeric_view(F.col(quote(c)))
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"),
                 F.max(x).alias(f"hi{i}")]
        if not exact:
            aggs.append(F.percentile_approx(x, list(quantiles), accuracy).alias(f"q{i}"))
    wide = df.agg(*aggs)
    qnames = [f"p{int(q * 100)}" for q in quantiles]
    structs = []
    for i, c in enumerate(columns):
        fields = [F.lit(c).alias("column"), F.col(f"n{i}").alias("count"),
                  F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"),
                  F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max")]
        if not exact:
            fields += [F.col(f"q{i}")[j].cast("double").alias(n) for j, n in enumerate(qnames)]
        structs.append(F.struct(*fields))
    moments = wide.select(F.inline(F.array(*structs)))
    if not exact:
        return moments
    qs = exact_quantiles_columns(df, columns, quantiles).select(
        "column", *[F.col(f"q{j}").alias(n) for j, n in enumerate(qnames)])
    return moments.join(qs, "column")


def describe_text(df: DataFrame, columns) -> DataFrame:
    """count, unique, top, freq per text column; ties for top go to the smaller value."""
    counts = value_counts(df, columns)
    return counts.groupBy("column").agg(
        F.sum("count").cast("bigint").alias("count"),
        F.count(F.lit(1)).cast("bigint").alias("unique"),
        F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("top"),
        F.max("count").cast("bigint").alias("freq"))


def group_counts(df: DataFrame, key: str) -> DataFrame:
    """Non-null count of every other column per value of ``key``."""
    return df.groupBy(key).agg(*[F.count(quote(c)).alias(c) for c in df.columns if c != key])
