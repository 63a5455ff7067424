"""Drift queries (D1-D7, J2, J3) and profile windows (W1, W2), baselines (K9)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallyframe.operators import drift as D
from tallyframe.operators import drift_table as T
from tallyframe.operators.merge import trailing_merge
from tallyframe.operators.profile import ProfileOptions, profile
from tallyframe.operators.ranks import RANK_ERROR
from tallyframe.operators.summary import distinct_estimate, exact_view, kll_quantiles, stddev_col
from tallyframe.plans.registry import register
from tallyframe.plans.sqlgen import kinds, profile_sql
from tallyframe.sources import baselines
from tallyframe.session import scratch_path
from tallyframe.sources.tables import table

EXACT = ProfileOptions(sketches=False)
SPLIT = "1998-01-01"
N_BINS = 60
VAR = "l_extendedprice"
SIDE_SQL = f"CASE WHEN l_shipdate < TIMESTAMP '{SPLIT} 00:00:00' THEN 'reference' ELSE 'target' END"


def _side():
    return F.when(F.col("l_shipdate") < F.lit(dt.datetime.fromisoformat(SPLIT)), "reference") \
        .otherwise("target")


def _two_sided(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return D.two_sided(li, VAR, _side(), N_BINS)


# SQL twin of the dense two-sided cell table.
CELLS_SQL = f"""
WITH r AS (SELECT min({VAR}) AS lo, max({VAR}) AS hi FROM lineitem),
b AS (SELECT lo, hi, CAST(trunc((hi - lo) / {N_BINS}) AS BIGINT) AS step,
        CAST(trunc(lo) AS BIGINT) AS e0, CAST(trunc(hi) AS BIGINT) AS e1 FROM r),
m AS (SELECT *, CAST(len(range(e0, e1, step)) - 1 AS INTEGER) AS npts FROM b),
c AS (SELECT {SIDE_SQL} AS side,
        CAST(CASE WHEN {VAR} < e0 THEN 0 ELSE least(floor(({VAR} - e0) / step) + 1, npts) END AS INTEGER) AS cell
      FROM lineitem, m),
grid AS (SELECT CAST(unnest(range(0, npts + 1)) AS INTEGER) AS cell FROM m),
counts AS (SELECT cell, count(*) FILTER (WHERE side = 'reference') AS na,
             count(*) FILTER (WHERE side = 'target') AS nb FROM c GROUP BY cell),
dense AS (SELECT g.cell, CAST(coalesce(na, 0) AS BIGINT) AS na, CAST(coalesce(nb, 0) AS BIGINT) AS nb
          FROM grid g LEFT JOIN counts USING (cell)),
cells AS (SELECT cell, na, nb, na / sum(na) OVER () AS p, nb / sum(nb) OVER () AS q FROM dense),
cum AS (SELECT *, sum(p) OVER (ORDER BY cell ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp,
          sum(q) OVER (ORDER BY cell ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cq FROM cells)"""

MI_SQL = """
joint AS (SELECT na, nb, count(*) AS nij FROM cells GROUP BY na, nb),
mi AS (SELECT sum(nij / N * ln(N * nij / (ai * bj))) AS mutual_info FROM (
  SELECT nij, sum(nij) OVER () AS N, sum(nij) OVER (PARTITION BY na) AS ai,
         sum(nij) OVER (PARTITION BY nb) AS bj FROM joint))"""


def _metric(name: str, digits: int = 9):
    def build(spark, sf_dir):
        _, cells = _two_sided(spark, sf_dir)
        m = D.metrics(cells, N_BINS)
        return m.select(F.lit(VAR).alias("column"), F.round(name, digits).alias(name))
    return build


@register("drift_range", sql=f"""{CELLS_SQL}
SELECT '{VAR}' AS "column", lo, hi, CAST(step AS DOUBLE) AS step, npts AS n_points,
  CAST(e0 AS DOUBLE) AS first_point, CAST(e0 + (npts - 1) * step AS DOUBLE) AS last_point FROM m""")
def drift_range(spark, sf_dir):
    """Shared range of two summaries and the integer bins."""
    bins, _ = _two_sided(spark, sf_dir)
    return spark.createDataFrame(
        [(VAR, bins.lo, bins.hi, bins.step, len(bins.points), bins.points[0], bins.points[-1])],
        "column string, lo double, hi double, step double, n_points int, "
        "first_point double, last_point double")


@register("drift_pmf", sql=f"""{CELLS_SQL}
SELECT 'reference' AS side, cell, na AS "count", round(p, 9) AS pmf FROM cells
UNION ALL SELECT 'target', cell, nb, round(q, 9) FROM cells""")
def drift_pmf(spark, sf_dir):
    """PMF of both sides on the shared cells (dense, zeros kept)."""
    li = table(spark, sf_dir, "lineitem")
    lo, hi = D.range_of(li, VAR, _side())
    bins = D.shared_bins(lo, hi, N_BINS)
    long = D.cell_table(li, VAR, _side(), bins, ("reference", "target"))
    return long.select("side", "cell", "count", F.round("pmf", 9).alias("pmf"))


register("drift_kl", sql=f"""{CELLS_SQL}
SELECT '{VAR}' AS "column", round(sum(CASE WHEN p > 0 THEN p * ln(p / greatest(q, {D.EPSILON})) END), 9) AS kl
FROM cells""")(_metric("kl"))
register("drift_mutual_info", sql=f"""{CELLS_SQL},{MI_SQL}
SELECT '{VAR}' AS "column", round(mutual_info, 9) AS mutual_info FROM mi""")(_metric("mutual_info"))
register("drift_intersection", sql=f"""{CELLS_SQL}
SELECT '{VAR}' AS "column", round(sum(least(p, q)), 9) AS intersection FROM cells""")(
    _metric("intersection"))
register("drift_intersection_ref", sql=f"""{CELLS_SQL}
SELECT '{VAR}' AS "column", round(sum(least(p, q)) FILTER (WHERE cell < {N_BINS}), 9) AS intersection_ref
FROM cells""")(_metric("intersection_ref"))
register("drift_psi", sql=f"""{CELLS_SQL}
SELECT '{VAR}' AS "column",
  round(sum((p - q) * ln(greatest(p, {D.EPSILON}) / greatest(q, {D.EPSILON}))), 9) AS psi FROM cells""")(
    _metric("psi"))
register("drift_ks", sql=f"""{CELLS_SQL}
SELECT '{VAR}' AS "column", round(max(abs(cp - cq)), 9) AS ks FROM cum""")(_metric("ks"))


# --- D6: N-profile overlay ---------------------------------------------------------

@register("pmf_overlay", sql="""
WITH r AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
b AS (SELECT CAST(trunc(lo) AS BIGINT) AS a, CAST(trunc(hi) AS BIGINT) AS z,
        greatest(CAST(trunc((hi - lo) / 10) AS BIGINT), 2) AS num FROM r),
s AS (SELECT a, num, (z - a) / (num - 1) AS step, CAST(num - 1 AS INTEGER) AS npts FROM b),
c AS (SELECT event_type AS side,
        CAST(CASE WHEN value < a THEN 0 ELSE least(floor((value - a) / step) + 1, npts) END AS INTEGER) AS cell
      FROM events, s),
grid AS (SELECT t.side, CAST(unnest(range(0, npts + 1)) AS INTEGER) AS cell
         FROM s, (SELECT DISTINCT event_type AS side FROM events) t),
counts AS (SELECT side, cell, count(*) AS n FROM c GROUP BY side, cell)
SELECT g.side, g.cell, CAST(coalesce(n, 0) AS BIGINT) AS "count",
  round(coalesce(n, 0) / sum(coalesce(n, 0)) OVER (PARTITION BY g.side), 9) AS pmf
FROM grid g LEFT JOIN counts USING (side, cell)""")
def pmf_overlay(spark, sf_dir):
    """Overlay of N profiles (one per event type) on linspace points."""
    e = table(spark, sf_dir, "events")
    side = F.col("event_type")
    lo, hi = D.range_of(e, "value", side)
    bins = D.linspace_bins(lo, hi, 10)
    long = D.cell_table(e, "value", side, bins)
    return long.select("side", "cell", "count", F.round("pmf", 9).alias("pmf"))


@register("binned_scatter", sql="""
WITH s AS (SELECT min(l_quantity) AS xlo, max(l_quantity) AS xhi, min(l_extendedprice) AS ylo,
             max(l_extendedprice) AS yhi FROM lineitem)
SELECT CAST(least(floor((l_quantity - xlo) / ((xhi - xlo) / 20)), 19) AS BIGINT) AS bin_x,
  CAST(least(floor((l_extendedprice - ylo) / ((yhi - ylo) / 20)), 19) AS BIGINT) AS bin_y,
  CAST(count(*) AS BIGINT) AS "count"
FROM lineitem, s GROUP BY 1, 2""")
def binned_scatter(spark, sf_dir):
    """Two-variable relation as 2-D binned counts."""
    return D.binned_scatter(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", 20)


# --- W1, W2 ------------------------------------------------------------------------

@register("running_range", sql="""
WITH d AS (SELECT date_trunc('day', ts) AS dataset_timestamp, min(value) AS mn, max(value) AS mx
           FROM events GROUP BY 1)
SELECT dataset_timestamp, 'value' AS "column",
  min(mn) OVER (ORDER BY dataset_timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_min,
  max(mx) OVER (ORDER BY dataset_timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_max
FROM d""")
def running_range(spark, sf_dir):
    """Running min / max across an ordered list of profiles."""
    from pyspark.sql.window import Window
    e = table(spark, sf_dir, "events").select("ts", "value")
    p = profile(e, "events", time_column="ts", grain="day", options=EXACT)
    # One row per (column, profile); the running frame keeps O(1) state.
    w = (Window.partitionBy("column").orderBy("dataset_timestamp")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return p.select(F.col("dataset_timestamp").cast("timestamp").alias("dataset_timestamp"),
                    "column", F.min("min").over(w).alias("running_min"),
                    F.max("max").over(w).alias("running_max"))


TRAIL_DAYS = 7


@register("baseline_trailing", sql=f"""
WITH b AS (SELECT e.value, k.k, date_trunc('day', e.ts) + k.k * INTERVAL 1 DAY AS day, date_trunc('day', e.ts) AS own
           FROM events e, (SELECT unnest(range(1, {TRAIL_DAYS} + 1)) AS k) k)
SELECT day AS dataset_timestamp, 'value' AS "column", CAST(count(*) AS BIGINT) AS baseline_count,
  CAST(count(*) - count(value) AS BIGINT) AS baseline_nulls,
  min(value) AS baseline_min, max(value) AS baseline_max, round(sum(value), 2) AS baseline_total,
  round(stddev_samp(value), 4) AS baseline_stddev, CAST(count(DISTINCT own) AS BIGINT) AS baseline_profiles,
  true AS median_in_bound, true AS distinct_in_bound
FROM b WHERE day IN (SELECT date_trunc('day', ts) FROM events) GROUP BY day""")
def baseline_trailing(spark, sf_dir):
    """Trailing-window baseline: the stored whole profiles of the previous N days merged, with all
    fields; the merged sketches' median and distinct count are held against the raw window."""
    e = table(spark, sf_dir, "events").select("ts", "value")
    path = scratch_path(spark, "daily")
    profile(e, "events", time_column="ts", grain="day").write.parquet(path)
    base = trailing_merge(spark.read.parquet(path), TRAIL_DAYS)
    day = F.col("dataset_timestamp").cast("timestamp").alias("dataset_timestamp")
    est, low, high = distinct_estimate()
    base = base.select(day, "column", F.col("count").alias("baseline_count"), F.col("null_count").alias("baseline_nulls"),
                       F.col("min").alias("baseline_min"), F.col("max").alias("baseline_max"),
                       F.round(F.col("mean") * F.col("n"), 2).alias("baseline_total"), F.round(stddev_col(), 4).alias("baseline_stddev"),
                       F.col("profiles").alias("baseline_profiles"), kll_quantiles([0.5])[0].alias("median"), low.alias("low"), high.alias("high"))
    raw = e.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(TRAIL_DAYS)))).select(
        (F.date_trunc("day", "ts") + F.make_interval(days=F.col("k"))).cast("timestamp").alias("dataset_timestamp"), "value")
    seen = raw.join(base.select("dataset_timestamp", "median"), "dataset_timestamp")
    held = (seen.groupBy("dataset_timestamp", "value").agg(F.count(F.lit(1)).alias("c"), F.first("median").alias("median"))
            .filter(F.col("value").isNotNull()).groupBy("dataset_timestamp").agg(
                F.sum("c").alias("n"), F.count(F.lit(1)).alias("distinct"), F.sum(F.when(F.col("value") < F.col("median"), F.col("c")).otherwise(0)).alias("below"),
                F.sum(F.when(F.col("value") <= F.col("median"), F.col("c")).otherwise(0)).alias("upto")))
    return base.join(held, "dataset_timestamp").select(
        *[c for c in base.columns if c not in ("median", "low", "high")],
        ((F.col("below") / F.col("n") <= 0.5 + 0.0133) & (F.col("upto") / F.col("n") >= 0.5 - 0.0133)).alias("median_in_bound"),
        F.col("distinct").between(F.col("low"), F.col("high")).alias("distinct_in_bound"))


# --- drift over a profile table ------------------------------------------------------

TABLE_BINS = 10
TABLE_COLUMNS = ("value", "user_id")
_UNION = "\nUNION ALL\n".join(
    f"SELECT date_trunc('day', ts) AS day, '{c}' AS col, CAST({c} AS DOUBLE) AS x FROM events WHERE {c} IS NOT NULL" for c in TABLE_COLUMNS)


_CELL = " + ".join(f"CAST(v.x >= p.lo + {j} * (p.hi / {TABLE_BINS} - p.lo / {TABLE_BINS}) AS INTEGER)" for j in range(1, TABLE_BINS))


@register("drift_over_time", sql=f"""
WITH v AS ({_UNION}),
d AS (SELECT col, day, min(x) AS mn, max(x) AS mx FROM v GROUP BY 1, 2),
pairs AS (SELECT *, least(mn, rmn) AS lo, greatest(mx, rmx) AS hi FROM (
  SELECT col, day, mn, mx, lag(day) OVER w AS ref, lag(mn) OVER w AS rmn, lag(mx) OVER w AS rmx FROM d
  WINDOW w AS (PARTITION BY col ORDER BY day)) WHERE ref IS NOT NULL),
c AS (SELECT p.col, p.day, p.ref, v.day = p.day AS own,
        {_CELL} AS cell
      FROM v JOIN pairs p ON v.col = p.col AND (v.day = p.day OR v.day = p.ref)),
n AS (SELECT col, day, ref, cell, count(*) FILTER (WHERE NOT own) AS a, count(*) FILTER (WHERE own) AS b FROM c GROUP BY 1, 2, 3, 4),
s AS (SELECT *, a / sum(a) OVER g AS p, b / sum(b) OVER g AS q, sum(a) OVER o / sum(a) OVER g AS cp, sum(b) OVER o / sum(b) OVER g AS cq
      FROM n WINDOW g AS (PARTITION BY col, day), o AS (PARTITION BY col, day ORDER BY cell))
SELECT col AS "column", day AS dataset_timestamp, ref AS reference, CAST(sum(a) AS BIGINT) AS n_reference, CAST(sum(b) AS BIGINT) AS n,
  round(max(abs(cp - cq)), 6) AS ks, round(sum(least(p, q)), 6) AS intersection,
  round(sum((p - q) * ln(greatest(p, 1e-9) / greatest(q, 1e-9))), 6) AS psi,
  round(sum(CASE WHEN p > 0 THEN p / 2 * ln(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q / 2 * ln(2 * q / (p + q)) ELSE 0 END), 6) AS js,
  round(sqrt(greatest(1 - sum(sqrt(p * q)), 0)), 6) AS hellinger, true AS ranks_in_bound, true AS distances_follow
FROM s GROUP BY 1, 2, 3""")
def drift_over_time(spark, sf_dir):
    """D1-D6 over a stored profile table: every column's day against the day before, in one job.

    The exact distances at the same edges are returned (one pass over the events); beside them, whether the
    stored sketches' shares lie within their rank error at every edge, and whether the distances read from
    the profiles differ from the exact ones by no more than those share errors allow."""
    e = table(spark, sf_dir, "events").select("ts", *TABLE_COLUMNS)
    path = scratch_path(spark, "daily")
    profile(e, "events", time_column="ts", grain="day").write.parquet(path)
    got = T.consecutive_drift(spark.read.parquet(path), TABLE_BINS).select(
        "column", F.col("dataset_timestamp").cast("timestamp").alias("dataset_timestamp"), F.col("reference").cast("timestamp").alias("reference"),
        "lo", "hi", "cum_reference", "cum", "ks", "intersection")
    long = e.select(F.date_trunc("day", "ts").alias("at"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in TABLE_COLUMNS])).alias("v")).select("at", "v.*").filter("x IS NOT NULL")
    pairs = got.select("column", "dataset_timestamp", "lo", "hi", F.explode(F.array(
        F.struct(F.col("reference").alias("at"), F.lit(False).alias("own")), F.struct(F.col("dataset_timestamp").alias("at"), F.lit(True).alias("own")))).alias("s")) \
        .select("column", "dataset_timestamp", "lo", "hi", "s.*")
    at = lambda j: F.col("x") < F.element_at(T.inner_edges(F.col("lo"), F.col("hi"), TABLE_BINS), j)
    sides = {"a": ~F.col("own"), "b": F.col("own")}
    exact = long.join(pairs, ["column", "at"]).groupBy("column", "dataset_timestamp").agg(
        *[F.count_if(f).alias(f"n{s}") for s, f in sides.items()],
        *[F.count_if(f & at(j)).alias(f"{s}{j}") for s, f in sides.items() for j in range(1, TABLE_BINS)])
    cum = {s: F.array(*[F.col(f"{s}{j}") / F.col(f"n{s}") for j in range(1, TABLE_BINS)]) for s in sides}
    both = got.join(exact.select("column", "dataset_timestamp", "na", "nb", cum["a"].alias("ca"), cum["b"].alias("cb")), ["column", "dataset_timestamp"])
    off = F.concat(F.zip_with("ca", "cum_reference", lambda x, y: F.abs(x - y)), F.zip_with("cb", "cum", lambda x, y: F.abs(x - y)))
    d = T.distances(F.col("ca"), F.col("cb"))
    summed = F.aggregate(off, F.lit(1e-9), lambda s, x: s + x)
    return both.select(
        "column", "dataset_timestamp", "reference", F.col("na").alias("n_reference"), F.col("nb").alias("n"),
        *[F.round(d[k], 6).alias(k) for k in ("ks", "intersection", "psi", "js", "hellinger")],
        (F.array_max(off) <= RANK_ERROR).alias("ranks_in_bound"),
        ((F.abs(d["ks"] - F.col("ks")) <= 2 * F.array_max(off) + 1e-9)
         & (F.abs(d["intersection"] - F.col("intersection")) <= summed)).alias("distances_follow"))


# --- K9: named reference profiles ------------------------------------------------------

REF_EPOCH_MS = 1893456000000  # 2030-01-01 UTC, a fixed registration time


@register("baseline_lookup", sql=f"""
SELECT 'training' AS alias, CAST({REF_EPOCH_MS} AS BIGINT) AS dataset_epoch_ms, p.* FROM (
{profile_sql("orders", kinds("orders"), where="o_orderdate < TIMESTAMP '1998-01-01 00:00:00'")}) p""")
def baseline_lookup(spark, sf_dir):
    """K9: register profiles under aliases in a baselines table; look one up by alias."""
    o = table(spark, sf_dir, "orders")
    cut = F.lit(dt.datetime.fromisoformat(SPLIT))
    path = baselines.new_table(spark)
    baselines.register(profile(o.filter(F.col("o_orderdate") < cut), "orders"),
                       "training", REF_EPOCH_MS, path)
    baselines.register(profile(o.filter(F.col("o_orderdate") >= cut), "orders"),
                       "recent", REF_EPOCH_MS + 86_400_000, path)
    ref = baselines.lookup(spark, path, "training")
    return exact_view(ref, extra_keys=["alias", "dataset_epoch_ms"])


@register("drift_profiles", sql="""
SELECT metric, true AS within_bound FROM (VALUES ('intersection'), ('ks'), ('cells')) AS t(metric)""")
def drift_profiles(spark, sf_dir):
    """Drift read from two stored profiles agrees with the exact metrics within sketch error."""
    from tallyframe.operators.profile import ProfileOptions, profile
    li = table(spark, sf_dir, "lineitem").select("l_extendedprice", "l_shipdate")
    early = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp")
    opts = ProfileOptions(columns_per_pass=1)
    a, b = (profile(li.filter(f).select("l_extendedprice"), n, options=opts)
            for n, f in (("reference", early), ("target", ~early)))
    bins, got = D.compare(a, b, "l_extendedprice", 10)
    side = F.when(early, "reference").otherwise("target")
    _, cells = D.two_sided(li, "l_extendedprice", side, 10)
    g, w = (m.select("intersection", "ks", F.col("cells").cast("double").alias("cells")) for m in (got, D.metrics(cells, 10)))
    both = g.select(F.struct("*").alias("g")).withColumn("k", F.lit(1)).join(
        w.select(F.struct("*").alias("w")).withColumn("k", F.lit(1)), "k")
    # rank error 1.33 % per edge: a cell's share is off by twice that at most
    bound = {"intersection": bins.cells * 0.027, "ks": 0.027, "cells": 0.0}
    return both.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), (F.abs(F.col(f"g.{m}") - F.col(f"w.{m}")) <= F.lit(t)).alias("within_bound"))
        for m, t in bound.items()])))
