"""Profile core queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyframe.operators import stats
from tallyframe.operators.merge import merge_profiles
from tallyframe.operators.profile import ProfileOptions, profile, profiling_session, segment_label
from tallyframe.operators.summary import (distinct_estimate, dtype_fraction_col, exact_view, flat_summary,
                                          inferred_dtype_col, summary_table, transpose)
from tallyframe.plans.registry import register
from tallyframe.plans.sqlgen import inferred_sql, kinds, month_range, profile_sql
from tallyframe.session import scratch_path
from tallyframe.sources import files
from tallyframe.sources.tables import table

EXACT = ProfileOptions(sketches=False)
SPLIT_DATE = "1998-01-01"
SPLIT_TS = f"TIMESTAMP '{SPLIT_DATE} 00:00:00'"


def _ts_key(col="dataset_timestamp"):
    return F.col(col).cast("timestamp").alias("dataset_timestamp")


# --- A1 -----------------------------------------------------------------

@register("profile_lineitem", sql=profile_sql("lineitem", kinds("lineitem")))
def profile_lineitem(spark, sf_dir):
    """A1: whole-table profile of lineitem, exact fields."""
    return exact_view(profile(table(spark, sf_dir, "lineitem"), "lineitem"))


@register("profile_documents", sql=profile_sql("documents", kinds("documents")))
def profile_documents(spark, sf_dir):
    """A1 on whole texts: type classes, counts and lengths of the documents table."""
    return exact_view(profile(table(spark, sf_dir, "documents"), "documents"))


@register("profile_pages", sql=profile_sql("pages", kinds("pages")))
def profile_pages(spark, sf_dir):
    """A1 on raw web pages (whole html texts)."""
    return exact_view(profile(table(spark, sf_dir, "pages"), "pages"))


@register("profile_embeddings", sql=profile_sql("embeddings", kinds("embeddings")))
def profile_embeddings(spark, sf_dir):
    """A1 with an array column: arrays keep count and null count only."""
    return exact_view(profile(table(spark, sf_dir, "embeddings"), "embeddings"))


@register("profile_conversations", sql=profile_sql(
    "conversations", kinds("conversations", exclude=("role",)),
    keys=[("'role=' || role", "segment")]))
def profile_conversations(spark, sf_dir):
    """A2 with a tag only: conversation turns profiled per role."""
    c = table(spark, sf_dir, "conversations")
    p = profile(c, "conversations", tags=["role"])
    return exact_view(p, extra_keys=[segment_label().alias("segment")])


# --- A5: counts with nulls made by a stated predicate ----------------------

NULLED_SQL = ("(SELECT l_orderkey, nullif(l_discount, 0.05) AS l_discount, "
              "nullif(l_returnflag, 'N') AS l_returnflag, l_shipdate FROM lineitem) t")


def _nulled_lineitem(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", F.expr("nullif(l_discount, 0.05)").alias("l_discount"),
                     F.expr("nullif(l_returnflag, 'N')").alias("l_returnflag"), "l_shipdate")


@register("profile_counts", sql=f"""
SELECT "column", "count", null_count FROM (
{profile_sql(NULLED_SQL, [("l_orderkey", "int"), ("l_discount", "float"),
                          ("l_returnflag", "text"), ("l_shipdate", "other")])}) p""")
def profile_counts(spark, sf_dir):
    """A5: count (all rows) and null count per column."""
    p = profile(_nulled_lineitem(spark, sf_dir), "lineitem_nulls", options=EXACT)
    return p.select("column", "count", "null_count")


# --- A6: per-value type counts on text forms -------------------------------

TYPES_SRC = """(SELECT CAST(l_quantity AS VARCHAR) AS q_text, CAST(l_orderkey AS VARCHAR) AS k_text,
  CASE l_linenumber WHEN 1 THEN 'true' WHEN 2 THEN 'FALSE' WHEN 3 THEN CAST(l_partkey AS VARCHAR)
    WHEN 4 THEN CAST(l_tax AS VARCHAR) WHEN 5 THEN l_returnflag ELSE NULL END AS mixed,
  l_returnflag AS flag FROM lineitem) t"""
TYPES_COLS = [("q_text", "text"), ("k_text", "text"), ("mixed", "text"), ("flag", "text")]


@register("profile_types", sql=f"""
SELECT "column", type_integral, type_fractional, type_boolean, type_string, type_unknown,
  null_count, n, "min", "max", {inferred_sql()} AS inferred_dtype,
  round(CASE {inferred_sql()} WHEN 'integral' THEN type_integral WHEN 'fractional' THEN type_fractional
    WHEN 'boolean' THEN type_boolean WHEN 'string' THEN type_string WHEN 'unknown' THEN type_unknown
    ELSE null_count END / "count", 6) AS dtype_fraction
FROM ({profile_sql(TYPES_SRC, TYPES_COLS)}) p""")
def profile_types(spark, sf_dir):
    """Type counts, inferred type and its share on mixed text columns."""
    li = table(spark, sf_dir, "lineitem")
    df = li.select(
        F.col("l_quantity").cast("string").alias("q_text"),
        F.col("l_orderkey").cast("string").alias("k_text"),
        F.expr("CASE l_linenumber WHEN 1 THEN 'true' WHEN 2 THEN 'FALSE' "
               "WHEN 3 THEN CAST(l_partkey AS STRING) WHEN 4 THEN CAST(l_tax AS STRING) "
               "WHEN 5 THEN l_returnflag ELSE NULL END").alias("mixed"),
        F.col("l_returnflag").alias("flag"))
    p = profile(df, "types", options=EXACT)
    return p.select("column", "type_integral", "type_fractional", "type_boolean", "type_string",
                    "type_unknown", "null_count", "n", "min", "max",
                    inferred_dtype_col().alias("inferred_dtype"),
                    F.round(dtype_fraction_col(), 6).alias("dtype_fraction"))


# --- A7: numeric summary ----------------------------------------------------

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("profile_numeric", sql="\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", CAST(min({c}) AS DOUBLE) AS "min", CAST(max({c}) AS DOUBLE) AS "max",
  round(stddev_samp({c}), 4) AS stddev, round(sum({c}), 2) AS total
FROM lineitem""" for c in NUMERIC))
def profile_numeric(spark, sf_dir):
    """Min, max, mean, standard deviation and total of the numeric columns."""
    p = profile(table(spark, sf_dir, "lineitem").select(*NUMERIC), "numeric", options=EXACT)
    return exact_view(p).select("column", "min", "max", "stddev", "total")


# --- A8: distinct estimates ------------------------------------------------

UNIQUE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
               "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus"]


@register("profile_unique", sql="\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", CAST(count(DISTINCT CAST({c} AS VARCHAR)) AS BIGINT) AS distinct_count,
  true AS within_bound FROM lineitem""" for c in UNIQUE_COLS))
def profile_unique(spark, sf_dir):
    """Theta estimate with bounds; row states whether the exact count lies inside."""
    li = table(spark, sf_dir, "lineitem").select(*UNIQUE_COLS)
    p = profile(li, "unique")
    est, lo, hi = distinct_estimate(F.col("theta"), ProfileOptions().theta_lg_k)
    sk = p.select("column", est.alias("est"), lo.alias("lo"), hi.alias("hi"))
    ex = stats.exact_distinct(li, UNIQUE_COLS)
    return ex.join(sk, "column").select(
        "column", "distinct_count",
        ((F.col("distinct_count") >= F.col("lo")) & (F.col("distinct_count") <= F.col("hi")))
        .alias("within_bound"))


@register("profile_unique_exact", sql="\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", CAST(count(DISTINCT CAST({c} AS VARCHAR)) AS BIGINT) AS distinct_count
FROM orders""" for c in ["o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice"]))
def profile_unique_exact(spark, sf_dir):
    """A8 exact twin: distinct values per column."""
    cols = ["o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice"]
    return stats.exact_distinct(table(spark, sf_dir, "orders"), cols)


# --- A9: frequent strings ---------------------------------------------------

@register("frequent_strings", sql="""
SELECT 'o_orderpriority' AS "column", o_orderpriority AS value, CAST(count(*) AS BIGINT) AS "count"
FROM orders GROUP BY o_orderpriority
UNION ALL
SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, CAST(count(*) AS BIGINT) AS "count"
FROM orders GROUP BY o_orderstatus""")
def frequent_strings(spark, sf_dir):
    """A9 sketch path: frequent items from the profile's top-k sketch.

    With fewer distinct values than tracked items the sketch counts are exact.
    """
    from tallyframe.operators.summary import frequent_strings_table
    o = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderstatus")
    return frequent_strings_table(profile(o, "orders"), top=10).select("column", "value", "count")


@register("frequent_strings_exact", sql="""
SELECT "column", value, "count", CAST(row_number() OVER (PARTITION BY "column"
  ORDER BY "count" DESC, value) AS INTEGER) AS rank FROM (
  SELECT 'o_custkey' AS "column", CAST(o_custkey AS VARCHAR) AS value, CAST(count(*) AS BIGINT) AS "count"
  FROM orders GROUP BY o_custkey
  UNION ALL
  SELECT 'o_orderpriority', o_orderpriority, CAST(count(*) AS BIGINT) FROM orders GROUP BY o_orderpriority)
QUALIFY rank <= 10""")
def frequent_strings_exact(spark, sf_dir):
    """A9 / L2 exact path: top 10 values per column by count, ties by value."""
    o = table(spark, sf_dir, "orders")
    return stats.top_values(o, ["o_custkey", "o_orderpriority"], k=10)


# --- A10 / A11 ---------------------------------------------------------------

@register("histogram", sql="""
WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
SELECT 'l_extendedprice' AS "column", CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 30)), 29) AS BIGINT) AS bin,
  round(min(lo) + CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 30)), 29) AS BIGINT) * min((hi - lo) / 30), 6) AS lower_edge,
  CAST(count(*) AS BIGINT) AS "count"
FROM lineitem, s GROUP BY 2""")
def histogram(spark, sf_dir):
    """A10: exact 30-bin equal-width histogram of l_extendedprice."""
    h = stats.equal_width_histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 30)
    return h.withColumn("lower_edge", F.round("lower_edge", 6))


@register("pmf", sql="""
SELECT 'l_quantity' AS "column", cell, "count", round("count" / sum("count") OVER (), 9) AS pmf FROM (
  SELECT (CASE WHEN l_quantity >= 10 THEN 1 ELSE 0 END) + (CASE WHEN l_quantity >= 20 THEN 1 ELSE 0 END)
       + (CASE WHEN l_quantity >= 30 THEN 1 ELSE 0 END) + (CASE WHEN l_quantity >= 40 THEN 1 ELSE 0 END) AS cell,
       CAST(count(*) AS BIGINT) AS "count"
  FROM lineitem GROUP BY 1) c""")
def pmf(spark, sf_dir):
    """PMF of l_quantity at split points 10, 20, 30, 40 (5 cells)."""
    return stats.pmf_cells(table(spark, sf_dir, "lineitem"), "l_quantity", [10, 20, 30, 40]) \
        .withColumn("pmf", F.round("pmf", 9))


# --- A2-A4, P1-P3, P14 -------------------------------------------------------

ORDER_KINDS = kinds("orders")


@register("profile_grouped", sql=profile_sql(
    "orders", kinds("orders", exclude=("o_orderdate", "o_orderstatus")),
    keys=[("date_trunc('month', o_orderdate)", "dataset_timestamp"),
          ("'o_orderstatus=' || o_orderstatus", "segment")]))
def profile_grouped(spark, sf_dir):
    """A2: orders profiled by month and order status."""
    o = table(spark, sf_dir, "orders")
    p = (profiling_session(o, "orders").with_time_column("o_orderdate", "month")
         .group_by("o_orderstatus").agg_profiles())
    return exact_view(p, extra_keys=[_ts_key(), segment_label().alias("segment")])


@register("profile_by_day", sql=profile_sql(
    "events", kinds("events", exclude=("ts",)),
    keys=[("date_trunc('day', ts)", "dataset_timestamp")]))
def profile_by_day(spark, sf_dir):
    """A3: events profiled per day (time column only)."""
    e = table(spark, sf_dir, "events")
    p = profiling_session(e, "events").with_time_column("ts", "day").agg_profiles()
    return exact_view(p, extra_keys=[_ts_key()])


@register("profile_by_year", sql=profile_sql(
    "orders", kinds("orders", exclude=("o_orderdate",)),
    keys=[("date_trunc('year', o_orderdate)", "dataset_timestamp")]))
def profile_by_year(spark, sf_dir):
    """One profile per calendar year (UTC)."""
    o = table(spark, sf_dir, "orders")
    p = profile(o, "orders", time_column="o_orderdate", grain="year")
    return exact_view(p, extra_keys=[_ts_key()])


@register("profile_by_month", sql=profile_sql(
    "orders", kinds("orders", exclude=("o_orderdate",)),
    keys=[("date_trunc('month', o_orderdate)", "dataset_timestamp")]))
def profile_by_month(spark, sf_dir):
    """The per-month loop as one grouped job."""
    o = table(spark, sf_dir, "orders")
    p = profile(o, "orders", time_column="o_orderdate", grain="month")
    return exact_view(p, extra_keys=[_ts_key()])


def month_filter(col: str, month: str):
    """Equality on the month value, written as a range so parquet can skip row groups."""
    start = dt.datetime.fromisoformat(month)
    end = (start.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    return (F.col(col) >= F.lit(start)) & (F.col(col) < F.lit(end))


@register("filter_month", sql=profile_sql("orders", ORDER_KINDS,
                                          where=month_range("o_orderdate", "1998-01-01")))
def filter_month(spark, sf_dir):
    """Profile of the January 1998 orders."""
    o = table(spark, sf_dir, "orders")
    return exact_view(profile(o.filter(month_filter("o_orderdate", "1998-01-01")), "jan98"))


@register("split_by_date", sql=profile_sql(
    "orders", kinds("orders", exclude=("o_orderdate",)),
    keys=[(f"CASE WHEN o_orderdate < {SPLIT_TS} THEN 'side=before' ELSE 'side=after' END", "segment")]))
def split_by_date(spark, sf_dir):
    """Split at a date threshold (< and >=), one profile per side."""
    o = table(spark, sf_dir, "orders")
    side = F.when(F.col("o_orderdate") < F.lit(dt.datetime.fromisoformat(SPLIT_DATE)), "before") \
        .otherwise("after")
    p = profile(o.withColumn("side", side).drop("o_orderdate"), "orders", tags=["side"],
                options=EXACT)
    return exact_view(p, extra_keys=[segment_label().alias("segment")])


# --- A12-A14, U1 ------------------------------------------------------------

@register("profile_merge", sql=profile_sql("lineitem", kinds("lineitem")))
def profile_merge(spark, sf_dir):
    """Merge of the profiles of two halves equals the whole-table profile."""
    li = table(spark, sf_dir, "lineitem")
    cut = F.lit(dt.datetime.fromisoformat(SPLIT_DATE))
    a = profile(li.filter(F.col("l_shipdate") < cut), "lineitem")
    b = profile(li.filter(F.col("l_shipdate") >= cut), "lineitem")
    return exact_view(merge_profiles(a.unionByName(b)))


def _stored(spark, profiles, label):
    """Profiles written to the shared folder and read back (a stored profile table)."""
    path = scratch_path(spark, label)
    profiles.write.parquet(path)
    return spark.read.parquet(path)


@register("profile_merge_all", sql=profile_sql("lineitem", kinds("lineitem")))
def profile_merge_all(spark, sf_dir):
    """N-way merge of stored monthly profiles back to one profile."""
    li = table(spark, sf_dir, "lineitem").withColumn("month", F.date_trunc("month", "l_shipdate"))
    monthly = profile(li, "lineitem", time_column="month", grain=None, tags=[],
                      columns=[c for c in li.columns if c != "month"])
    # l_shipdate is profiled too; merge over every stored month.
    merged = merge_profiles(_stored(spark, monthly, "monthly-profiles"), by=("name", "column"))
    return exact_view(merged)


@register("profile_rollup_day", sql=profile_sql(
    "events", kinds("events", exclude=("ts",)),
    keys=[("date_trunc('day', ts)", "dataset_timestamp")]))
def profile_rollup_day(spark, sf_dir):
    """Hourly profiles rolled up to one profile per day."""
    e = table(spark, sf_dir, "events")
    hourly = _stored(spark, profile(e, "events", time_column="ts", grain="hour"), "hourly-profiles")
    daily = merge_profiles(hourly, key_exprs={
        "dataset_timestamp": F.date_trunc("day", F.col("dataset_timestamp"))})
    return exact_view(daily, extra_keys=[_ts_key()])


@register("profile_union", sql=(
    profile_sql("orders", ORDER_KINDS, keys=[("'before'", "part")], where=f"o_orderdate < {SPLIT_TS}")
    + "\nUNION ALL\n"
    + profile_sql("orders", ORDER_KINDS, keys=[("'after'", "part")], where=f"o_orderdate >= {SPLIT_TS}")))
def profile_union(spark, sf_dir):
    """A profile table built by appending profiles."""
    o = table(spark, sf_dir, "orders")
    cut = F.lit(dt.datetime.fromisoformat(SPLIT_DATE))
    a = profile(o.filter(F.col("o_orderdate") < cut), "before")
    b = profile(o.filter(F.col("o_orderdate") >= cut), "after")
    return exact_view(a.unionByName(b), extra_keys=[F.col("name").alias("part")])


# --- A15, A16, A20 ----------------------------------------------------------

DESCRIBE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("describe_numeric", sql="\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS "count", round(avg({c}), 8) AS mean,
  round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS "min",
  round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
  round(quantile_cont({c}, 0.75), 6) AS p75, CAST(max({c}) AS DOUBLE) AS "max" FROM lineitem"""
    for c in DESCRIBE_COLS))
def describe_numeric(spark, sf_dir):
    """Count, mean, std, min, quartiles (interpolated), max."""
    d = stats.describe_numeric(table(spark, sf_dir, "lineitem"), DESCRIBE_COLS)
    # 8 digits: with n = 60,000 or 600,000 cent values no mean sits on an
    # 8-digit rounding tie (k / 6e6 and k / 6e7 have thirds, never halves).
    return d.select("column", "count", F.round("mean", 8).alias("mean"),
                    F.round("std", 4).alias("std"), "min",
                    *[F.round(c, 6).alias(c) for c in ("p25", "p50", "p75")], "max")


@register("describe_text", sql="\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", CAST(sum(n) AS BIGINT) AS "count", CAST(count(*) AS BIGINT) AS "unique",
  arg_min(v, (-n, v)) AS top, CAST(max(n) AS BIGINT) AS freq
FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM orders WHERE {c} IS NOT NULL GROUP BY 1) g"""
    for c in ["o_orderstatus", "o_orderpriority", "o_custkey"]))
def describe_text(spark, sf_dir):
    """A15 text: count, unique, top, freq."""
    return stats.describe_text(table(spark, sf_dir, "orders"),
                               ["o_orderstatus", "o_orderpriority", "o_custkey"])


@register("group_counts", sql="""
SELECT l_returnflag, CAST(count(l_orderkey) AS BIGINT) AS l_orderkey,
  CAST(count(l_discount) AS BIGINT) AS l_discount, CAST(count(l_shipdate) AS BIGINT) AS l_shipdate
FROM (SELECT l_orderkey, nullif(l_discount, 0.05) AS l_discount, l_returnflag,
  CASE WHEN l_quantity > 45 THEN NULL ELSE l_shipdate END AS l_shipdate FROM lineitem) t
GROUP BY l_returnflag""")
def group_counts(spark, sf_dir):
    """Non-null count of every column per group."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.expr("nullif(l_discount, 0.05)").alias("l_discount"), "l_returnflag",
        F.expr("CASE WHEN l_quantity > 45 THEN NULL ELSE l_shipdate END").alias("l_shipdate"))
    return stats.group_counts(li, "l_returnflag")


@register("count_transpose", sql="""
SELECT "column", "F", "O", "P" FROM (
  SELECT 'o_orderkey' AS "column", count(o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS "F",
    count(o_orderkey) FILTER (WHERE o_orderstatus = 'O') AS "O", count(o_orderkey) FILTER (WHERE o_orderstatus = 'P') AS "P" FROM orders
  UNION ALL
  SELECT 'o_totalprice', count(o_totalprice) FILTER (WHERE o_orderstatus = 'F'),
    count(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), count(o_totalprice) FILTER (WHERE o_orderstatus = 'P') FROM orders
  UNION ALL
  SELECT 'o_orderpriority', count(o_orderpriority) FILTER (WHERE o_orderstatus = 'F'),
    count(o_orderpriority) FILTER (WHERE o_orderstatus = 'O'), count(o_orderpriority) FILTER (WHERE o_orderstatus = 'P') FROM orders)""")
def count_transpose(spark, sf_dir):
    """P5: grouped counts transposed (one row per column, one column per group)."""
    o = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey", "o_totalprice",
                                              "o_orderpriority")
    g = stats.group_counts(o, "o_orderstatus")
    long = g.unpivot("o_orderstatus", ["o_orderkey", "o_totalprice", "o_orderpriority"],
                     "column", "n")
    return transpose(long, "column", "o_orderstatus", "n", values=["F", "O", "P"])


@register("group_total", sql="""
SELECT CAST(count(DISTINCT date_trunc('year', l_shipdate)) AS BIGINT) AS profiles FROM lineitem""")
def group_total(spark, sf_dir):
    """Number of per-year profiles."""
    li = table(spark, sf_dir, "lineitem")
    p = profile(li.select("l_shipdate", "l_quantity"), "li", time_column="l_shipdate",
                grain="year", options=EXACT)
    return p.agg(F.count_distinct("dataset_timestamp").cast("bigint").alias("profiles"))


# --- P4, P6 -------------------------------------------------------------------

@register("summary_lookup", sql="""
SELECT CAST(count(*) AS BIGINT) AS "count", CAST(min(o_totalprice) AS DOUBLE) AS "min",
  CAST(max(o_totalprice) AS DOUBLE) AS "max", round(stddev_samp(o_totalprice), 4) AS stddev,
  'fractional' AS inferred_dtype FROM orders""")
def summary_lookup(spark, sf_dir):
    """Fields of one column from the flat summary."""
    s = summary_table(profile(table(spark, sf_dir, "orders"), "orders"))
    return (s.filter(F.col("column") == "o_totalprice")
            .select("count", "min", "max", F.round("stddev", 4).alias("stddev"), "inferred_dtype"))


@register("profile_columns", sql="""
SELECT column_name AS "column", CAST(count(*) OVER () AS BIGINT) AS n_columns
FROM (DESCRIBE lineitem)""")
def profile_columns(spark, sf_dir):
    """Names of the profiled columns and their number."""
    p = profile(table(spark, sf_dir, "lineitem"), "lineitem", options=EXACT)
    cols = p.select("column").distinct()
    return cols.select("column", F.count(F.lit(1)).over(
        Window.partitionBy(F.lit(0))).cast("bigint").alias("n_columns"))


# --- S10-S12, K5 --------------------------------------------------------------

@register("profile_roundtrip", sql=profile_sql("lineitem", kinds("lineitem")))
def profile_roundtrip(spark, sf_dir):
    """Profile written as parquet and read back."""
    p = profile(table(spark, sf_dir, "lineitem"), "lineitem")
    path = scratch_path(spark, "profile")
    p.write.mode("overwrite").parquet(path)
    return exact_view(spark.read.parquet(path))


@register("latest_profile", sql=profile_sql(
    "orders", kinds("orders", exclude=("o_orderdate",)),
    keys=[("date_trunc('month', o_orderdate)", "dataset_timestamp")],
    where="date_trunc('month', o_orderdate) = (SELECT max(date_trunc('month', o_orderdate)) FROM orders)"))
def latest_profile(spark, sf_dir):
    """Most recent stored profile per column (max_by over the timestamp)."""
    o = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "monthly")
    profile(o, "orders", time_column="o_orderdate", grain="month").write.parquet(path)
    stored = files.read_profiles(spark, path, name="orders")
    return exact_view(files.latest(stored), extra_keys=[_ts_key()])


# --- P15, P16 -------------------------------------------------------------------

EPOCH = 1609459200  # 2021-01-01 00:00:00 UTC


@register("epoch_constant", sql=f"""
SELECT make_timestamp(CAST({EPOCH} AS BIGINT) * 1000000) AS dataset_timestamp, "column", "count", n
FROM ({profile_sql("customer", kinds("customer"))}) p""")
def epoch_constant(spark, sf_dir):
    """Constant dataset timestamp from epoch seconds."""
    c = table(spark, sf_dir, "customer")
    p = profile(c, "customer", dataset_timestamp=F.timestamp_seconds(F.lit(EPOCH)), options=EXACT)
    return p.select(_ts_key(), "column", "count", "n")


REF_TS = "2024-02-01 00:00:00"


@register("backdate_batches", sql=f"""
WITH b AS (SELECT *, CAST(datediff('day', (SELECT min(date_trunc('day', ts)) FROM events),
                                   date_trunc('day', ts)) AS INTEGER) AS batch FROM events)
SELECT batch, TIMESTAMP '{REF_TS}' - batch * INTERVAL 1 DAY AS dataset_timestamp,
  CAST(count(*) AS BIGINT) AS "count", round(sum(value), 2) AS total
FROM b GROUP BY batch""")
def backdate_batches(spark, sf_dir):
    """Batch i gets dataset timestamp ref_ts - i days (ref_ts is a parameter)."""
    e = table(spark, sf_dir, "events")
    day = F.date_trunc("day", "ts")
    first = e.agg(F.min(day).alias("d0")).first()["d0"]
    batch = F.datediff(day, F.lit(first)).alias("batch")
    ref = F.lit(dt.datetime.fromisoformat(REF_TS))
    ts = (ref - F.make_interval(days=F.col("batch"))).cast("timestamp")
    p = profile(e.select(batch, "value"), "events", tags=["batch"],
                dataset_timestamp=None, options=EXACT)
    return (p.select(F.col("tags")[0]["value"].cast("int").alias("batch"), "count",
                     F.round(F.col("mean") * F.col("n"), 2).alias("total"))
            .select("batch", ts.alias("dataset_timestamp"), "count", "total"))


# --- P12, P13 -------------------------------------------------------------------

@register("parse_date", sql="""
SELECT o_orderkey, strftime(o_orderdate, '%m/%d/%Y') AS call_date,
  CAST(strptime(strftime(o_orderdate, '%m/%d/%Y'), '%m/%d/%Y') AS TIMESTAMP) AS parsed
FROM orders""")
def parse_date(spark, sf_dir):
    """Text MM/dd/yyyy to timestamp (yyyy, not week-year YYYY)."""
    o = table(spark, sf_dir, "orders")
    text = F.date_format("o_orderdate", "MM/dd/yyyy")
    return o.select("o_orderkey", text.alias("call_date"),
                    F.try_to_timestamp(text, F.lit("MM/dd/yyyy")).cast("timestamp").alias("parsed"))


@register("parse_month", sql="""
SELECT o_orderkey, strftime(o_orderdate, '%b-%Y') AS issue_d,
  CAST(strptime('01-' || strftime(o_orderdate, '%b-%Y'), '%d-%b-%Y') AS TIMESTAMP) AS issue_ts
FROM orders""")
def parse_month(spark, sf_dir):
    """Month text such as Jan-2017 to a timestamp."""
    o = table(spark, sf_dir, "orders")
    text = F.date_format("o_orderdate", "MMM-yyyy")
    return o.select("o_orderkey", text.alias("issue_d"),
                    F.try_to_timestamp(F.concat(F.lit("01-"), text), F.lit("dd-MMM-yyyy"))
                    .cast("timestamp").alias("issue_ts"))


EXTREMES = {  # column: (Spark, DuckDB) of a value that a double would round or that is no number
    "key": "o_orderkey + 9007199254740993", "price": "CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DECIMAL(30, 20)) - 250000.00000000000000000001", "ordered": "o_orderdate",
    "day": "CAST(o_orderdate AS DATE)", "priority": "o_orderpriority"}


@register("profile_extremes", sql="\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", rtrim(CAST(min({e}) AS VARCHAR), '{"0." if c == "price" else ""}') AS min_value,
  rtrim(CAST(max({e}) AS VARCHAR), '{"0." if c == "price" else ""}') AS max_value FROM orders""" for c, e in EXTREMES.items()))
def profile_extremes(spark, sf_dir):
    """Smallest and largest value in its own type, of three profiles merged: integers past 2^53,
    decimals, times, dates and texts as they are."""
    o = table(spark, sf_dir, "orders")
    rows = o.select("o_orderkey", *[F.expr(e).alias(c) for c, e in EXTREMES.items()])
    parts = [profile(rows.filter(F.col("o_orderkey") % 3 == i).drop("o_orderkey"), "orders") for i in range(3)]
    merged = merge_profiles(parts[0].unionByName(parts[1]).unionByName(parts[2]), by=("name", "column"))
    return flat_summary(merged)["summary"].select("column", "min_value", "max_value")
