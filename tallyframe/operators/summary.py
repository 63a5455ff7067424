"""Read profiles: flat summary (summary / hist / frequent strings), lookups.

Every function here maps profile rows to rows; nothing is collected.  The
histogram of the flat summary is read from the KLL sketch (ranks at
equal-width edges), so it needs no second pass over the data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import typeclass as tc
from tallyframe.operators.profile import ITEM_MARK, PROFILE_KEYS, ProfileOptions, extreme_text, quote, tracked_item
from tallyframe.operators.ranks import finite_ends, quantile_grid, rows_below

# Quantiles reported by the flat summary (own choice).
SUMMARY_QUANTILES = (0.0, 0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0)


def stddev_col(n: Column | None = None, m2: Column | None = None) -> Column:
    """Sample standard deviation from the moment pair."""
    n = F.col("n") if n is None else n
    m2 = F.col("m2") if m2 is None else m2
    return F.when(n > 1, F.sqrt(m2 / (n - 1)))


def inferred_dtype_col() -> Column:
    counts = {name: F.col(f"type_{name}") for name in tc.TYPE_CLASSES}
    return tc.inferred_type(counts)


def dtype_fraction_col() -> Column:
    inferred = inferred_dtype_col()
    num = F.coalesce(*[F.when(inferred == name, F.col(f"type_{name}")) for name in tc.TYPE_CLASSES],
                     F.col("null_count"))
    return F.when(F.col("count") > 0, num / F.col("count"))


def distinct_estimate(theta: Column | None = None, lg_k: int = 12):
    """(estimate, lower, upper) of the theta sketch.

    Theta sketches are exact while they hold fewer than 2^lg_k entries; past
    that we report a three-standard-error band (relative error 1/sqrt(k)).
    The band is our own choice; Spark exposes no bound function.
    """
    theta = F.col("theta") if theta is None else theta
    est = F.call_function("theta_sketch_estimate", theta)
    k = 2 ** lg_k
    exact = est < k
    rel = 3.0 / math.sqrt(k)
    lower = F.when(exact, est.cast("double")).otherwise(F.floor(est * (1 - rel)).cast("double"))
    upper = F.when(exact, est.cast("double")).otherwise(F.ceil(est * (1 + rel)).cast("double"))
    return est, lower, upper


def kll_quantiles(qs=SUMMARY_QUANTILES, kll: Column | None = None) -> Column:
    kll = F.col("kll") if kll is None else kll
    arr = F.array(*[F.lit(float(q)) for q in qs])
    return F.when(F.call_function("kll_sketch_get_n_double", kll) > 0,
                  F.call_function("kll_sketch_get_quantile_double", kll, arr))


def summary_table(profiles: DataFrame, options: ProfileOptions = ProfileOptions(),
                  quantiles=SUMMARY_QUANTILES, top: int = 5) -> DataFrame:
    keys = [k for k in profiles.columns if k in PROFILE_KEYS or k in ("session_id",)]
    est, lo, hi = distinct_estimate(F.col("theta"), options.theta_lg_k)
    q = kll_quantiles(quantiles)
    cols = [*keys, "column", "count", "null_count",
            F.col("null_count").alias("type_null_count"),
            F.col("type_integral").alias("type_integral_count"),
            F.col("type_fractional").alias("type_fractional_count"),
            F.col("type_boolean").alias("type_boolean_count"),
            F.col("type_string").alias("type_string_count"),
            F.col("type_unknown").alias("type_unknown_count"),
            inferred_dtype_col().alias("inferred_dtype"),
            dtype_fraction_col().alias("dtype_fraction"),
            "min", "max", extreme_text(F.col("low")).alias("min_value"), extreme_text(F.col("high")).alias("max_value"),
            "mean", stddev_col().alias("stddev"),
            est.alias("nunique_str"), lo.alias("nunique_str_lower"), hi.alias("nunique_str_upper")]
    for i, qq in enumerate(quantiles):
        cols.append(q[i].alias(f"quantile_{qq:g}".replace(".", "_")))
    cols.append(F.when(F.col("topk").isNotNull(),
                       F.call_function("approx_top_k_estimate", F.col("topk"), F.lit(top)))
                .alias("most_common"))
    return profiles.select(*cols)


def histogram_table(profiles: DataFrame, bins: int = 30) -> DataFrame:
    """Equal-width histogram per numeric column, read from the KLL sketch.

    The counts are the sketch's rank estimates between the bin edges (``ranks.rows_below``) and sum to
    n.  A bin is off by at most about 1.65 % of n (the sketch's error at k = 200, 99 % of the time);
    the bins of min and max never show 0.  Equal values lie in the first bin.  If an end is infinite,
    the edges span the finite values and infinite ones count in the end bins.
    For exact tails use ``stats.equal_width_histogram``.
    """
    keys = [k for k in profiles.columns if k in PROFILE_KEYS]
    p = profiles.filter(F.col("n") > 0).filter(F.col("kll").isNotNull()).withColumn("__grid", quantile_grid(F.col("kll")))
    lo, hi = finite_ends(F.col("__grid"), F.col("min").cast("double"), F.col("max").cast("double"))
    p = p.withColumn("__lo", lo).withColumn("__hi", hi)
    lo, hi, n = F.col("__lo"), F.col("__hi"), F.col("n")
    width = hi / bins - lo / bins
    edges = F.transform(F.sequence(F.lit(0), F.lit(bins)),
                        lambda j: F.when(j == bins, hi).otherwise(lo + j * width))
    spread = F.col("min") < F.col("max")   # then min lies below every inner edge, and max above

    def below(edge: Column) -> Column:
        rows = rows_below(F.col("__grid"), n, edge, width == 0)
        return F.when(spread, F.least(F.greatest(rows, F.lit(1)), n - 1)).otherwise(n)

    inner = F.transform(F.slice("bin_edges", F.lit(2), F.lit(bins - 1)), below) if bins > 1 else F.array().cast("array<bigint>")
    cum = F.concat(F.array(F.lit(0).cast("bigint")), inner, F.array(n))
    counts = F.transform(F.sequence(F.lit(1), F.lit(bins)), lambda j: F.element_at("__cum", j + 1) - F.element_at("__cum", j))
    return (p.withColumn("bin_edges", edges).withColumn("__cum", cum)
            .select(*keys, "column", "n", "bin_edges", counts.alias("counts")))


def item_error(options: ProfileOptions = ProfileOptions()) -> Column:
    """By how much a frequent item's count may be too high: 0 while the sketch holds every value, else 3.5 / slots of the rows.

    The sketch has a power of two of slots, three quarters of which hold items; until the distinct values exceed
    ``top_k_items`` nothing is purged from it and counts are exact.  The share is the sketch's documented error.
    """
    slots = 8
    while slots * 0.75 < options.top_k_items:
        slots *= 2
    filled = F.col("count") - F.col("null_count")
    purged = F.coalesce(F.call_function("theta_sketch_estimate", F.col("theta")) > options.top_k_items, F.lit(True))
    return F.when(purged, F.floor(filled * (3.5 / slots))).otherwise(0).cast("bigint")


def frequent_strings_table(profiles: DataFrame, top: int = 10, options: ProfileOptions = ProfileOptions()) -> DataFrame:
    """Up to ``top`` frequent items a column: value, digest, count and count_low.

    The true count lies between ``count_low`` and ``count``.  Only values surely more frequent than the
    sketch's error are given.  Texts over 64 characters show their first 24 and the MD5 as ``digest`` (null for whole
    values); ``whole_texts`` fetches them.  ``options`` are those the profile was made with.
    """
    keys = [k for k in profiles.columns if k in PROFILE_KEYS]
    est = F.call_function("approx_top_k_estimate", F.col("topk"), F.lit(top))
    item, n = F.col("item")["item"], F.col("item")["count"]
    cut = item.startswith(ITEM_MARK)
    return (profiles.filter(F.col("topk").isNotNull())
            .select(*keys, "column", item_error(options).alias("__error"), F.posexplode(est).alias("rank", "item"))
            .select(*keys, "column", (F.col("rank") + 1).alias("rank"),
                    F.when(cut, F.substring(item, 34, 2**31 - 1)).otherwise(item).alias("value"),
                    F.when(cut, F.substring(item, 2, 32)).alias("digest"),
                    n.alias("count"), F.greatest(n - F.col("__error"), F.lit(1)).alias("count_low")))


WINNERS = 100_000      # winners up to this counted number are broadcast


def whole_texts(frequent: DataFrame, df: DataFrame) -> DataFrame:
    """The rows of ``frequent_strings_table`` with whole texts as ``value``: one more pass over ``df``.

    Rows of ``df`` are matched by column and MD5, and each winner's copies are reduced to one before they
    move.  Winners whose text ``df`` does not hold keep their first characters.
    """
    cut = frequent.filter(F.col("digest").isNotNull())
    names = [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "varchar", "char")]
    if not names:
        return frequent
    wanted = cut.select(F.col("column").alias("__column"), F.col("digest").alias("__digest")).distinct()
    if wanted.count() <= WINNERS:
        wanted = F.broadcast(wanted)
    entries = [F.when(tracked_item(F.col(quote(c))).startswith(ITEM_MARK),
                      F.struct(F.lit(c).alias("__column"), F.md5(F.col(quote(c)).cast("binary")).alias("__digest"),
                               F.col(quote(c)).alias("__text"))) for c in names]
    rows = df.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("__e")).select("__e.*")
    texts = rows.join(wanted, ["__column", "__digest"], "left_semi").groupBy("__column", "__digest").agg(F.max("__text").alias("__text"))
    same = (F.col("column") == F.col("__column")) & (F.col("digest") == F.col("__digest"))
    return frequent.join(texts, same, "left").withColumn("value", F.coalesce("__text", "value")).select(*frequent.columns)


def flat_summary(profiles: DataFrame, options: ProfileOptions = ProfileOptions(),
                 bins: int = 30, top: int = 10) -> dict[str, DataFrame]:
    """The three flat tables: ``summary`` (one row per column), ``hist``, ``frequent_strings``."""
    return {
        "summary": summary_table(profiles, options),
        "hist": histogram_table(profiles, bins),
        "frequent_strings": frequent_strings_table(profiles, top, options),
    }


def exact_view(profiles: DataFrame, extra_keys=(), sd_digits: int = 4) -> DataFrame:
    """Exact profile fields in the form the SQL twins use.

    The mean is reported as the column total ``mean * n`` rounded to cents:
    means of decimal data are rationals that often sit exactly on a rounding
    tie, where the last bits of two summation orders decide the digit; a
    total of cent values never does.
    """
    return profiles.select(
        *extra_keys, "column", "count", "null_count", "type_integral", "type_fractional",
        "type_boolean", "type_string", "type_unknown", "n", "min", "max",
        F.round(F.col("mean") * F.col("n"), 2).alias("total"),
        F.round(stddev_col(), sd_digits).alias("stddev"))


def lookup(summary: DataFrame, column: str, fields) -> DataFrame:
    """Fields of one profiled column (``summary[summary.column == c][fields]``)."""
    return summary.filter(F.col("column") == column).select(*fields)


def transpose(long: DataFrame, row_key: str, col_key: str, value: str, values=None) -> DataFrame:
    """Pivot a long table: one row per ``row_key``, one column per ``col_key`` value.

    Pass ``values`` when known so Spark skips the extra distinct job.
    """
    return long.groupBy(row_key).pivot(col_key, values).agg(F.first(value))
