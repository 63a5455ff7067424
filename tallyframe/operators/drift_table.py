"""Drift of whole profile tables: every column and segment against its previous time bucket, in one job.

The rows of a (stored) profile table are put beside their predecessor of the same name, tags and
column by one window; edges are columns computed per row from the two ranges, shares come from the
two sketches (``ranks``).  The driver sees no edges, columns or segments, and the raw rows are not read again.

Cells are ``n_bins`` of equal width over the joint finite range, closed on the left; infinite values lie in the end cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyframe.operators.drift import EPSILON
from tallyframe.operators.ranks import finite_ends, quantile_grid, rows_below

SERIES = ("name", "tags", "column")


def inner_edges(lo: Column, hi: Column, n_bins: int) -> Column:
    """The n_bins - 1 edges between the cells; all of them ``lo`` if the range is one value."""
    width = hi / n_bins - lo / n_bins
    return F.transform(F.sequence(F.lit(1), F.lit(n_bins - 1)), lambda j: lo + j * width)


def shares(cum: Column) -> Column:
    """Cell shares of the cumulative shares at the inner edges."""
    every = F.concat(F.array(F.lit(0.0)), cum, F.array(F.lit(1.0)))
    return F.zip_with(F.slice(every, F.lit(2), F.size(cum) + 1), F.slice(every, F.lit(1), F.size(cum) + 1), lambda b, a: b - a)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def distances(cum_p: Column, cum_q: Column) -> dict[str, Column]:
    """Distances of target shares q from reference shares p, both given cumulatively at the inner edges.

    ``ks``: largest difference of cumulative shares; ``intersection``: sum of min(p, q); ``kl``, ``psi`` floor
    shares as ``drift.metrics`` does; ``js``: Jensen-Shannon divergence (natural logarithm, at most
    ln 2); ``hellinger``: sqrt(1 - sum of sqrt(p q)).
    """
    p, q, eps = shares(cum_p), shares(cum_q), F.lit(EPSILON)
    cells = lambda f: _total(F.zip_with(p, q, f))
    part = lambda a, b: F.when(a > 0, a / 2 * F.ln(2 * a / (a + b))).otherwise(0.0)
    return {
        "ks": F.coalesce(F.array_max(F.zip_with(cum_p, cum_q, lambda a, b: F.abs(a - b))), F.lit(0.0)),
        "intersection": cells(lambda a, b: F.least(a, b)),
        "kl": cells(lambda a, b: F.when(a > 0, a * F.ln(a / F.greatest(b, eps))).otherwise(0.0)),
        "psi": cells(lambda a, b: (a - b) * F.ln(F.greatest(a, eps) / F.greatest(b, eps))),
        "js": cells(lambda a, b: part(a, b) + part(b, a)),
        "hellinger": F.sqrt(F.greatest(1 - cells(lambda a, b: F.sqrt(a * b)), F.lit(0.0))),
    }


def consecutive_drift(profiles: DataFrame, n_bins: int = 20, order: str = "dataset_timestamp", by=SERIES) -> DataFrame:
    """One row per profile row with values that has a predecessor in its series.

    Returns ``by``, ``order``, ``reference`` (the predecessor's ``order``), ``n_reference``, ``n``, ``lo``, ``hi``
    (joint finite range), ``cum_reference``, ``cum`` (shares below the inner edges) and ``distances``.
    Rows without values or sketch, or without a time, take no part; a predecessor is the last row that does.
    Rows of one series at one time must be merged first, else the earlier of them in unstated order counts as predecessor.
    """
    by = list(by)
    rows = (profiles.filter((F.col("n") > 0) & F.col("kll").isNotNull() & F.col(order).isNotNull())
            .select(*by, order, "n", F.col("min").cast("double").alias("min"), F.col("max").cast("double").alias("max"), "kll"))
    before = F.lag(F.struct(F.col(order).alias("at"), "n", "min", "max", "kll")).over(Window.partitionBy(*by).orderBy(order))
    pairs = (rows.withColumn("r", before).filter(F.col("r").isNotNull())
             .withColumn("g", quantile_grid(F.col("kll"))).withColumn("rg", quantile_grid(F.col("r.kll"))))
    lo, hi = finite_ends(F.array_sort(F.concat("g", "rg")), F.least("min", "r.min"), F.greatest("max", "r.max"))
    pairs = pairs.withColumn("lo", lo).withColumn("hi", hi).withColumn("e", inner_edges(F.col("lo"), F.col("hi"), n_bins))
    cum = lambda g, n: F.transform("e", lambda x: rows_below(F.col(g), F.col(n), x) / F.col(n))
    pairs = pairs.withColumn("cum_reference", cum("rg", "r.n")).withColumn("cum", cum("g", "n"))
    return pairs.select(*by, order, F.col("r.at").alias("reference"), F.col("r.n").alias("n_reference"), "n", "lo", "hi",
                        "cum_reference", "cum", *[d.alias(k) for k, d in distances(F.col("cum_reference"), F.col("cum")).items()])
