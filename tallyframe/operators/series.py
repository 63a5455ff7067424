"""Time-series views of profile tables (the data behind the charts).

Each view is a projection of profile rows ordered by dataset timestamp;
drawing is not part of this package.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.summary import distinct_estimate, kll_quantiles

# Quantiles shown by the distribution view (own choice; the reference names none).
SERIES_QUANTILES = (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0)


def quantile_names(quantiles=SERIES_QUANTILES) -> list[str]:
    return [f"q{int(round(q * 100))}" for q in quantiles]


def distribution(profiles: DataFrame, column: str, quantiles=SERIES_QUANTILES) -> DataFrame:
    """Quantiles per timestamp from each profile's KLL sketch."""
    qs = kll_quantiles(quantiles)
    names = quantile_names(quantiles)
    p = profiles.filter(F.col("column") == column)
    return p.select("dataset_timestamp", "column", *[qs[i].alias(n) for i, n in enumerate(names)])


def distribution_exact(df: DataFrame, *, time_expr, column: str,
                       quantiles=SERIES_QUANTILES) -> DataFrame:
    """Exact twin: interpolated quantiles per time bucket from the data
    (range-narrowing order statistics; no bucket is held in one task)."""
    from tallyframe.operators.quantiles import exact_quantiles
    d = df.select(time_expr.alias("dataset_timestamp"), F.col(column))
    g = exact_quantiles(d, column, list(quantiles), by=["dataset_timestamp"])
    return g.select("dataset_timestamp", F.lit(column).alias("column"),
                    *[F.col(f"q{i}").alias(n) for i, n in enumerate(quantile_names(quantiles))])


def types(profiles: DataFrame) -> DataFrame:
    return profiles.select("dataset_timestamp", "column", "type_integral", "type_fractional",
                           "type_boolean", "type_string", "type_unknown",
                           F.col("null_count").alias("type_null"))


def uniqueness(profiles: DataFrame, lg_k: int = 12) -> DataFrame:
    est, lo, hi = distinct_estimate(F.col("theta"), lg_k)
    return profiles.select("dataset_timestamp", "column", est.alias("unique_count"),
                           (est / F.col("count")).alias("unique_ratio"))


def missing(profiles: DataFrame) -> DataFrame:
    return profiles.select("dataset_timestamp", "column", "null_count", "count",
                           (F.col("null_count") / F.col("count")).alias("missing_ratio"))


def labels(profiles: DataFrame, fmt: str = "HH:mm:ss") -> DataFrame:
    """Axis labels of the timestamps (``ts_format='%H:%M:%S'``)."""
    return profiles.select("dataset_timestamp").distinct().select(
        "dataset_timestamp", F.date_format("dataset_timestamp", fmt).alias("label"))
