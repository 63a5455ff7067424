"""Sketch-path checks (oracle kind B): sketch answers stated as within-bound rows.

The Spark side computes the sketch answer and the exact answer and emits
whether the sketch lies within its published error bound; the SQL twin
states the same rows.  KLL at k=200: normalized rank error 0.0133 for a
single rank, 0.0165 for a PMF cell (DataSketches documentation figures).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tallyframe.operators import drift as D
from tallyframe.operators import stats
from tallyframe.operators.profile import profile
from tallyframe.operators.series import SERIES_QUANTILES
from tallyframe.operators.summary import frequent_strings_table, kll_quantiles, whole_texts
from tallyframe.plans.registry import register
from tallyframe.sources.tables import table

RANK_EPS = 0.0133
PMF_EPS = 0.0165
POINTS = [10, 20, 30, 40]


@register("pmf_sketch", sql="""
SELECT DISTINCT (CASE WHEN l_quantity >= 10 THEN 1 ELSE 0 END) + (CASE WHEN l_quantity >= 20 THEN 1 ELSE 0 END)
  + (CASE WHEN l_quantity >= 30 THEN 1 ELSE 0 END) + (CASE WHEN l_quantity >= 40 THEN 1 ELSE 0 END) AS cell,
  true AS within_bound FROM lineitem""")
def pmf_sketch(spark, sf_dir):
    """A11 sketch path: PMF from the KLL sketch vs the exact PMF, per cell.

    KLL ranks count x <= p; on this integer column the sketch reads the
    points just below each edge (p - 0.5) to get the exact twin's cells.
    """
    li = table(spark, sf_dir, "lineitem").select("l_quantity")
    sk = D.sketch_pmf(profile(li, "li"), [p - 0.5 for p in POINTS]) \
        .select("cell", F.col("pmf").alias("sketch"))
    ex = stats.pmf_cells(li, "l_quantity", POINTS).select("cell", F.col("pmf").alias("exact"))
    return ex.join(sk, "cell").select(
        "cell", (F.abs(F.col("sketch") - F.col("exact")) <= PMF_EPS).alias("within_bound"))


Q_VALUES = ", ".join(f"({q})" for q in SERIES_QUANTILES)


@register("quantile_sketch", sql=f"""
SELECT CAST(q AS DOUBLE) AS q, true AS within_bound
FROM (VALUES {Q_VALUES}) v(q), (SELECT count(*) AS n FROM lineitem) t WHERE t.n > 0""")
def quantile_sketch(spark, sf_dir):
    """V1 / A7 sketch path: each KLL quantile's exact rank lies within q +- 0.0133."""
    li = table(spark, sf_dir, "lineitem").select("l_extendedprice")
    qs = list(SERIES_QUANTILES)
    got = profile(li, "li").select(kll_quantiles(qs).alias("v")).first()["v"]
    # Exact ranks of the sketch's answers in one aggregate over the data.
    x = F.col("l_extendedprice")
    ranks = li.agg(*[F.avg((x < F.lit(v)).cast("double")).alias(f"lo{i}") for i, v in enumerate(got)],
                   *[F.avg((x <= F.lit(v)).cast("double")).alias(f"hi{i}") for i, v in enumerate(got)])
    rows = [F.struct(F.lit(float(q)).alias("q"),
                     ((F.col(f"lo{i}") <= q + RANK_EPS) & (F.col(f"hi{i}") >= q - RANK_EPS))
                     .alias("within_bound")) for i, q in enumerate(qs)]
    return ranks.select(F.inline(F.array(*rows)))


HIST_EPS = 0.02   # two-sided rank error of a bin plus the 1/1000 quantile grid


@register("histogram_sketch", sql="""
WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
SELECT DISTINCT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 30)), 29) AS INTEGER) AS bin,
  true AS within_bound FROM lineitem, s""")
def histogram_sketch(spark, sf_dir):
    """A10 sketch path: the flat summary's KLL histogram vs the exact one, per bin."""
    from tallyframe.operators.summary import histogram_table
    li = table(spark, sf_dir, "lineitem").select("l_extendedprice")
    p = profile(li, "li")
    sk = histogram_table(p, bins=30).select(
        "n", F.posexplode("counts").alias("bin", "sketch"))
    ex = stats.equal_width_histogram(li, "l_extendedprice", 30).select(
        F.col("bin").cast("int").alias("bin"), F.col("count").alias("exact"))
    return ex.join(sk, "bin").select(
        "bin", (F.abs(F.col("sketch") - F.col("exact")) <= F.col("n") * HIST_EPS)
        .alias("within_bound"))


# counts above twice the sketch's error are always among its frequent items
ITEM_SLOTS = 256


@register("frequent_texts", sql=f"""
WITH v AS (SELECT 'text' AS "column", text AS value FROM documents UNION ALL SELECT 'lang', lang FROM documents
  UNION ALL SELECT 'source', source FROM documents),
n AS (SELECT "column", count(value) AS filled, count(DISTINCT value) AS kinds FROM v GROUP BY 1),
c AS (SELECT "column", value, CAST(count(*) AS BIGINT) AS n FROM v WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT c."column", md5(value) AS digest, CAST(length(value) AS INTEGER) AS length, n, true AS within_bound FROM c JOIN n ON c."column" = n."column"
WHERE n > CASE WHEN kinds <= 128 THEN 0 ELSE 2 * floor(filled * 3.5 / {ITEM_SLOTS}) END""")
def frequent_texts(spark, sf_dir):
    """A9 sketch path over whole documents: every value over twice the sketch's error is among its frequent items, its
    text is fetched whole, and its exact count lies between count_low and count."""
    d = table(spark, sf_dir, "documents").select("text", "lang", "source")
    p = profile(d, "documents")
    got = whole_texts(frequent_strings_table(p, top=128), d).select("column", F.md5(F.col("value").cast("binary")).alias("digest"), "count", "count_low")
    exact = reduce(lambda a, b: a.unionByName(b), [
        d.filter(F.col(c).isNotNull()).groupBy(F.md5(F.col(c).cast("binary")).alias("digest"), F.length(c).alias("length"))
        .agg(F.count(F.lit(1)).alias("n")).withColumn("column", F.lit(c)) for c in d.columns])
    sizes = exact.groupBy("column").agg(F.sum("n").alias("filled"), F.count(F.lit(1)).alias("kinds"))
    sure = F.when(F.col("kinds") <= 128, F.lit(0)).otherwise(2 * F.floor(F.col("filled") * 3.5 / ITEM_SLOTS))
    return (exact.join(sizes, "column").filter(F.col("n") > sure).join(got, ["column", "digest"], "left")
            .select("column", "digest", "length", "n",
                    F.coalesce((F.col("n") <= F.col("count")) & (F.col("n") >= F.col("count_low")), F.lit(False)).alias("within_bound")))
