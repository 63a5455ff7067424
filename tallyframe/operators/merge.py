"""Merge profiles: union + regroup.

Counts add, min/max fold, sketches merge with Spark's own union
aggregates, and the moment triple (n, mean, m2) is merged with Chan's
parallel formula.  Chan's formula needs the pooled mean of a group before
it can add the per-profile terms, so the merge runs in two mergeable
aggregations (pooled mean first, then the centred second moments) joined
on the group key; no group is ever collected into one list, so a key that
holds most of the profile rows still merges with bounded memory.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyframe.operators.profile import STAT_FIELDS, TOPK_TYPE, ProfileOptions

DEFAULT_BY = ("name", "session_id", "session_timestamp", "dataset_timestamp", "tags", "column")


def _join_on_keys(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Null-safe equi-join on ``keys``; the right side's copies are dropped."""
    ren = right.select(*[F.col(k).alias(f"__r_{i}") for i, k in enumerate(keys)],
                       *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(f"__r_{i}")) for i, k in enumerate(keys)])
    return left.join(ren, cond).drop(*[f"__r_{i}" for i in range(len(keys))])


_empty: dict[int, Column] = {}


def _empty_topk(spark, items: int) -> Column:
    """The frequent-item state of no rows, as Spark makes it: its combine takes no null states."""
    if items not in _empty:
        row = spark.sql(f"SELECT approx_top_k_accumulate(CAST(x AS STRING), {items}) FILTER (WHERE x = 'b') AS s "
                        "FROM VALUES ('a') AS t(x)").first()["s"]
        _empty[items] = F.struct(*[F.lit(bytes(v) if isinstance(v, bytearray) else v).cast(f.dataType).alias(f.name)
                                   for v, f in zip(row, TOPK_TYPE)])
    return _empty[items]


def _simple_aggs(spark, stats, options: ProfileOptions) -> list[Column]:
    aggs: list[Column] = []
    for n in stats:
        c = F.col(n)
        if n in ("count", "null_count", "n") or n.startswith("type_"):
            aggs.append(F.sum(c).cast("bigint").alias(n))
        elif n == "min":
            aggs.append(F.min(c).alias(n))
        elif n == "max":
            aggs.append(F.max(c).alias(n))
        elif n == "mean":
            aggs.append((F.sum(F.when(F.col("n") > 0, F.col("n") * c))
                         / F.sum(F.when(F.col("n") > 0, F.col("n")))).alias("mean"))
        elif n in ("low", "high"):
            end = F.min if n == "low" else F.max
            number = end(F.when(c["integer"].isNotNull(), F.struct(c["integer"].alias("integer"), c["fraction"].alias("fraction"))))
            aggs.append(F.when(F.count(c) > 0, F.struct(
                number["integer"].alias("integer"), number["fraction"].alias("fraction"),
                *[end(c[f]).alias(f) for f in ("time", "date", "text")])).alias(n))
        elif n == "kll":
            aggs.append(F.expr("kll_merge_agg_double(kll)").alias("kll"))
        elif n == "theta":
            aggs.append(F.expr(f"theta_union_agg(theta, {options.theta_lg_k})").alias("theta"))
        elif n == "topk":
            aggs.append(F.when(F.count(c) > 0, F.call_function(
                "approx_top_k_combine", F.coalesce(c, _empty_topk(spark, options.top_k_items)),
                F.lit(options.top_k_items))).alias("topk"))
    return aggs


def merge_bounded(profiles: DataFrame, by, options: ProfileOptions = ProfileOptions()) -> DataFrame:
    """One-pass merge for inputs with a small, bounded number of rows per key
    (the partial profiles of a tree aggregation: at most ``fanout`` per key).

    The pooled mean comes from a window over the key (bounded rows), and the
    aggregate on the same key reuses that partitioning: one shuffle, one
    read of the input.
    """
    by = list(by)
    present = {f.name for f in profiles.schema.fields}
    stats = [n for n, _ in STAT_FIELDS if n in present]
    w = Window.partitionBy(*by)
    pooled = (F.sum(F.when(F.col("n") > 0, F.col("n") * F.col("mean"))).over(w)
              / F.sum(F.when(F.col("n") > 0, F.col("n"))).over(w))
    p = profiles.withColumn("__pooled", pooled)
    aggs = [a for a in _simple_aggs(profiles.sparkSession, [n for n in stats if n != "m2"], options)]
    if "m2" in stats:
        aggs.append(F.sum(F.when(F.col("n") > 0, F.col("m2") + F.col("n")
                                 * (F.col("mean") - F.col("__pooled")) ** 2)).alias("m2"))
    out = p.groupBy(*by).agg(*aggs)
    ordered = [c for c in profiles.columns if c in set(by) | set(stats)]
    return out.select(*ordered)


def merge_profiles(profiles: DataFrame, by=DEFAULT_BY, options: ProfileOptions = ProfileOptions(),
                   key_exprs: dict[str, Column] | None = None) -> DataFrame:
    """Merge all profile rows that share ``by``.

    ``key_exprs`` may re-define key columns before grouping, e.g.
    ``{"dataset_timestamp": date_trunc('day', ...)}`` for a day roll-up.
    """
    by = list(by)
    p = profiles
    for k, e in (key_exprs or {}).items():
        p = p.withColumn(k, e)
    present = {f.name for f in p.schema.fields}
    stats = [n for n, _ in STAT_FIELDS if n in present]
    first = p.groupBy(*by).agg(*_simple_aggs(p.sparkSession, stats, options))
    if "m2" not in stats:
        return first
    # Pass two: centred second moments around the pooled mean of each group.
    pooled = first.select(*by, F.col("mean").alias("__pooled"))
    joined = _join_on_keys(p.select(*by, "n", "mean", "m2"), pooled, by)
    term = F.when(F.col("n") > 0,
                  F.col("m2") + F.col("n") * (F.col("mean") - F.col("__pooled")) ** 2)
    second = joined.groupBy(*by).agg(F.sum(term).alias("m2"))
    out = _join_on_keys(first, second, by)
    ordered = [c for c in p.columns if c in set(by) | set(stats)]
    return out.select(*ordered)


def trailing_merge(profiles: DataFrame, days: int, time: str = "dataset_timestamp", by=DEFAULT_BY,
                   options: ProfileOptions = ProfileOptions()) -> DataFrame:
    """For each profile row with a time: the whole rows of its series in the ``days`` days before it, merged.

    Every field merges (counts, extremes, moments, KLL, theta, frequent items); ``profiles`` says how many
    rows went in.  A row is copied to the days whose baseline it belongs to, so the range becomes an
    equality and the merge its usual grouping.  Times must be day buckets.  Rows with an empty baseline are left out.
    """
    by = [k for k in by if k in profiles.columns]
    rows = profiles.filter(F.col(time).isNotNull())
    targets = rows.select(*by).distinct()
    copies = rows.withColumn("__k", F.explode(F.sequence(F.lit(1), F.lit(days)))).withColumn(
        time, F.col(time) + F.make_interval(days=F.col("__k"))).drop("__k")
    wanted = _join_on_keys(copies, targets, by)
    merged = merge_profiles(wanted, by=by, options=options)
    return _join_on_keys(merged, wanted.groupBy(*by).agg(F.count(F.lit(1)).alias("profiles")), by)
