"""Row shaping and sampling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators import shaping as S
from tallyframe.plans.registry import register
from tallyframe.sources.tables import table

LI_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
LI_KEY_SQL = ", ".join(LI_KEY)
SEED = 123
HASH_SQL = f"md5(concat_ws('|', {LI_KEY_SQL}, '{SEED}'))"


@register("head_n", sql="SELECT * FROM orders ORDER BY o_orderkey LIMIT 100")
def head_n(spark, sf_dir):
    """First 100 rows in key order."""
    return S.head(table(spark, sf_dir, "orders"), ["o_orderkey"], 100)


@register("slice_rows", sql=f"""
SELECT {LI_KEY_SQL}, CASE WHEN pos <= 200 THEN 0 WHEN pos <= 231 THEN 1 WHEN pos <= 262 THEN 2 ELSE 3 END AS slice
FROM (SELECT {LI_KEY_SQL}, row_number() OVER (ORDER BY {LI_KEY_SQL}) AS pos FROM lineitem)""")
def slice_rows(spark, sf_dir):
    """Positional slices [:200] [200:231] [231:262] [262:]."""
    li = table(spark, sf_dir, "lineitem").select(*LI_KEY)
    return S.slices(li, LI_KEY, (200, 231, 262))


@register("sample_exact", sql=f"""
SELECT {LI_KEY_SQL}, l_extendedprice FROM lineitem
ORDER BY {HASH_SQL} LIMIT (SELECT CAST(floor(count(*) * 0.8) AS BIGINT) FROM lineitem)""")
def sample_exact(spark, sf_dir):
    """Exact-size (80%) seeded sample without replacement."""
    li = table(spark, sf_dir, "lineitem").select(*LI_KEY, "l_extendedprice")
    return S.exact_sample(li, LI_KEY, fraction=0.8, seed=SEED).rows


@register("sample_complement", sql=f"""
SELECT {LI_KEY_SQL}, l_extendedprice FROM lineitem
EXCEPT ALL
(SELECT {LI_KEY_SQL}, l_extendedprice FROM lineitem
 ORDER BY {HASH_SQL} LIMIT (SELECT CAST(floor(count(*) * 0.8) AS BIGINT) FROM lineitem))""")
def sample_complement(spark, sf_dir):
    """Rows not in the sample (anti join by row identity)."""
    li = table(spark, sf_dir, "lineitem").select(*LI_KEY, "l_extendedprice")
    s = S.exact_sample(li, LI_KEY, fraction=0.8, seed=SEED)
    return S.anti_complement(li, s.rows, LI_KEY)


@register("train_test_split", sql=f"""
SELECT {LI_KEY_SQL}, CASE WHEN substr({HASH_SQL}, 1, 8) < 'c0000000' THEN 'train' ELSE 'test' END AS split
FROM lineitem""")
def train_test_split(spark, sf_dir):
    """Repeatable 75/25 split by row hash."""
    li = table(spark, sf_dir, "lineitem").select(*LI_KEY)
    return S.hash_split(li, LI_KEY, 0.75, SEED)


@register("random_batches", sql=f"""
SELECT {LI_KEY_SQL}, l_quantity, CAST(batch AS INTEGER) AS batch FROM (
  SELECT l.*, b.batch, row_number() OVER (PARTITION BY b.batch
    ORDER BY md5(concat_ws('|', {LI_KEY_SQL}, '{SEED}', CAST(b.batch AS VARCHAR)))) AS rn
  FROM lineitem l, (SELECT range AS batch FROM range(20)) b)
WHERE rn <= 5""")
def random_batches(spark, sf_dir):
    """20 batches of 5 rows; no repeats inside a batch."""
    li = table(spark, sf_dir, "lineitem").select(*LI_KEY, "l_quantity")
    return S.random_batches(li, LI_KEY, 20, 5, SEED)


@register("row_positions", sql=f"""
SELECT {LI_KEY_SQL}, row_number() OVER (ORDER BY {LI_KEY_SQL}) AS pos FROM lineitem""")
def row_positions(spark, sf_dir):
    """Global row position in key order."""
    li = table(spark, sf_dir, "lineitem").select(*LI_KEY)
    return S.row_positions(li, LI_KEY)


@register("drop_split", sql="SELECT * EXCLUDE (l_returnflag) FROM lineitem")
def drop_split(spark, sf_dir):
    """Features without the target column."""
    features, _ = S.features_target(table(spark, sf_dir, "lineitem"), "l_returnflag")
    return features


@register("impute_median", sql=f"""
WITH t AS (SELECT {LI_KEY_SQL}, nullif(l_discount, 0.05) AS l_discount, nullif(l_tax, 0.0) AS l_tax FROM lineitem),
m AS (SELECT quantile_cont(l_discount, 0.5) AS md, quantile_cont(l_tax, 0.5) AS mt FROM t)
SELECT {LI_KEY_SQL}, coalesce(l_discount, md) AS l_discount, coalesce(l_tax, mt) AS l_tax FROM t, m""")
def impute_median(spark, sf_dir):
    """Missing codes to null, then nulls filled with the column median."""
    li = table(spark, sf_dir, "lineitem").select(
        *LI_KEY, F.nullif("l_discount", F.lit(0.05)).alias("l_discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"))
    return S.impute_median(li, ["l_discount", "l_tax"])


@register("cast_float", sql=f"""
SELECT {LI_KEY_SQL}, CAST(l_quantity AS FLOAT) AS l_quantity, CAST(l_extendedprice AS FLOAT) AS l_extendedprice,
  CAST(l_discount AS FLOAT) AS l_discount, CAST(l_tax AS FLOAT) AS l_tax FROM lineitem""")
def cast_float(spark, sf_dir):
    """Numeric columns to float32."""
    li = table(spark, sf_dir, "lineitem").select(*LI_KEY, "l_quantity", "l_extendedprice",
                                                 "l_discount", "l_tax")
    return S.cast_all(li, "float", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
