"""Scoring and run-log queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallyframe.operators import scoring as M
from tallyframe.operators import shaping as S
from tallyframe.operators.profile import ProfileOptions, profile
from tallyframe.operators.summary import exact_view
from tallyframe.plans.registry import register
from tallyframe.plans.shape_plans import LI_KEY, LI_KEY_SQL, SEED
from tallyframe.plans.sqlgen import profile_sql
from tallyframe.session import scratch_path
from tallyframe.sources.runs import RunTable
from tallyframe.sources.tables import table

EXACT = ProfileOptions(sketches=False)
FEATURES = ["l_quantity", "l_discount", "l_tax"]
RUN_START = dt.datetime(2024, 2, 1)
EXPERIMENT = "lineitem-price"
PRICE_PER_UNIT = 1500.0

BATCHES_SQL = f"""
(SELECT {LI_KEY_SQL}, l_quantity, l_extendedprice, CAST(batch AS INTEGER) AS batch FROM (
  SELECT l.*, b.batch, row_number() OVER (PARTITION BY b.batch
    ORDER BY md5(concat_ws('|', {LI_KEY_SQL}, '{SEED}', CAST(b.batch AS VARCHAR)))) AS rn
  FROM lineitem l, (SELECT range AS batch FROM range(20)) b) WHERE rn <= 5)"""


def _batches(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(*LI_KEY, "l_quantity", "l_extendedprice")
    return S.random_batches(li, LI_KEY, 20, 5, SEED) \
        .withColumn("prediction", F.lit(PRICE_PER_UNIT) * F.col("l_quantity"))


@register("batch_mae", sql=f"""
SELECT batch, round(avg(abs(l_extendedprice - {PRICE_PER_UNIT} * l_quantity)), 6) AS mae,
  CAST(count(*) AS BIGINT) AS n FROM {BATCHES_SQL} GROUP BY batch""")
def batch_mae(spark, sf_dir):
    """Mean absolute error per batch (fixed formula predictor)."""
    m = M.mae_by(_batches(spark, sf_dir), "l_extendedprice", "prediction", ["batch"])
    return m.select("batch", F.round("mae", 6).alias("mae"), "n")


@register("mean_by_week", sql="""
SELECT date_trunc('week', o_orderdate) AS week, CAST(count(*) AS BIGINT) AS n,
  round(sum(o_totalprice), 2) AS total, round(stddev_samp(o_totalprice), 4) AS stddev,
  round(1.96 * stddev_samp(o_totalprice) / sqrt(count(*)), 4) AS ci_half
FROM orders GROUP BY 1""")
def mean_by_week(spark, sf_dir):
    """Data behind a line plot: per x value the mean (as total / n) and its interval."""
    o = table(spark, sf_dir, "orders")
    g = o.groupBy(F.date_trunc("week", "o_orderdate").alias("week")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"),
        F.stddev_samp("o_totalprice").alias("sd"))
    return g.select(F.col("week").cast("timestamp").alias("week"), "n",
                    F.round("total", 2).alias("total"), F.round("sd", 4).alias("stddev"),
                    F.round(M.ci_half_width(F.col("sd"), F.col("n")), 4).alias("ci_half"))


def _runs(spark, sf_dir):
    b = _batches(spark, sf_dir)
    m = M.mae_by(b, "l_extendedprice", "prediction", ["batch"])
    runs = M.run_rows(m, "batch", EXPERIMENT, M.ELASTIC_NET_PARAMS, RUN_START)
    return b, runs


@register("run_log", sql=f"""
SELECT printf('run-%02d', batch) AS run_id, '{EXPERIMENT}' AS experiment, CAST(1.0 AS DOUBLE) AS reg_param,
  CAST(0.7 AS DOUBLE) AS elastic_net_param, round(avg(abs(l_extendedprice - {PRICE_PER_UNIT} * l_quantity)), 6) AS mae,
  TIMESTAMP '2024-02-01 00:00:00' + batch * INTERVAL 1 MINUTE AS start_time
FROM {BATCHES_SQL} GROUP BY batch""")
def run_log(spark, sf_dir):
    """M3: one logged run per batch: params, metric, start time."""
    _, runs = _runs(spark, sf_dir)
    return runs.select("run_id", "experiment",
                       F.col("params")["regParam"].cast("double").alias("reg_param"),
                       F.col("params")["elasticNetParam"].cast("double").alias("elastic_net_param"),
                       F.round("mae", 6).alias("mae"), "start_time")


RUN_COLUMNS = [*[(c, "int") for c in LI_KEY], ("l_quantity", "float"), ("l_extendedprice", "float"), ("prediction", "float")]


@register("run_profiles", sql=f"""
SELECT run_id, mae, p.* EXCLUDE (run_id) FROM (
{profile_sql("runs_batches", RUN_COLUMNS, keys=[("printf('run-%02d', batch)", "run_id")])}) p
JOIN (SELECT printf('run-%02d', batch) AS run_id, round(avg(abs(l_extendedprice - prediction)), 6) AS mae
      FROM runs_batches GROUP BY 1) r USING (run_id)""".replace("runs_batches", f"(SELECT *, {PRICE_PER_UNIT} * l_quantity AS prediction FROM {BATCHES_SQL} b) rb"))
def run_profiles(spark, sf_dir):
    """Runs and the profiles of their batches (every input column and the prediction) appended to
    a run table, one half of the runs after the other, a second experiment and a replayed half too; then
    the profiles of the first experiment are fetched by its name and matched to its runs."""
    b, runs = _runs(spark, sf_dir)
    run_id = F.format_string("run-%02d", F.col("tags")[0]["value"].cast("int"))
    profs = profile(b, "batch", tags=["batch"]).withColumn("run_id", run_id).withColumn("experiment", F.lit(EXPERIMENT))
    scratch = scratch_path(spark, "runs")
    profs.write.parquet(scratch + "/p")
    runs.write.parquet(scratch + "/r")
    profs, runs = spark.read.parquet(scratch + "/p"), spark.read.parquet(scratch + "/r")
    table_ = RunTable(scratch + "/table")
    first, second = F.col("run_id") < "run-10", F.col("run_id") >= "run-10"
    for part in (first, second, first):      # the third is a replay
        table_.log(runs.filter(part), profs.filter(part))
    table_.log(*[rows.filter(first).withColumn("experiment", F.lit("another")) for rows in (runs, profs)])
    mine = table_.runs(spark, EXPERIMENT).select("run_id", F.round("mae", 6).alias("mae"))
    return exact_view(table_.profiles(spark, EXPERIMENT).join(mine, "run_id"), extra_keys=["run_id", "mae"])


@register("series_metric", sql=f"""
SELECT TIMESTAMP '2024-02-01 00:00:00' + batch * INTERVAL 1 MINUTE AS start_time,
  printf('run-%02d', batch) AS run_id, round(avg(abs(l_extendedprice - {PRICE_PER_UNIT} * l_quantity)), 6) AS mae
FROM {BATCHES_SQL} GROUP BY batch""")
def series_metric(spark, sf_dir):
    """V5: metric over run start time."""
    _, runs = _runs(spark, sf_dir)
    return runs.select("start_time", "run_id", F.round("mae", 6).alias("mae")).orderBy("start_time")


@register("score_batches")
def score_batches(spark, sf_dir):
    """M1: forest trained on a 2,000-row sample, whole table scored, per-batch
    profile of inputs + prediction with back-dated timestamps (rows-only check)."""
    li = table(spark, sf_dir, "lineitem").select(*LI_KEY, *FEATURES, "l_returnflag",
                                                 "l_shipdate")
    train = S.exact_sample(li, LI_KEY, size=2000, seed=SEED).rows
    scored = M.score(M.random_forest(train, FEATURES, "l_returnflag"), li)
    last = 2001
    p = profile(scored.select(F.year("l_shipdate").alias("batch"), *FEATURES, "prediction"), "scored",
                tags=["batch"], options=EXACT)
    # a batch is a year, which fixes its timestamp: no second pass over the table
    back = F.make_interval(days=F.lit(last) - F.col("batch").cast("int"))
    return exact_view(p, extra_keys=[F.col("tags")[0]["value"].alias("batch")]) \
        .select("batch", "column", "count", "type_string", "n", "min", "max") \
        .filter(F.col("batch").isNotNull()) \
        .withColumn("dataset_timestamp", (F.lit(RUN_START) - back).cast("timestamp"))


@register("elastic_net_mae")
def elastic_net_mae(spark, sf_dir):
    """M2: elastic-net regression on the train split, MAE per batch of the test split."""
    li = table(spark, sf_dir, "lineitem").select(*LI_KEY, *FEATURES, "l_extendedprice",
                                                 "l_linenumber")
    split = S.hash_split(li, LI_KEY, 0.75, SEED)
    model = M.elastic_net(split.filter(F.col("split") == "train"), FEATURES, "l_extendedprice")
    test = M.predict(model, split.filter(F.col("split") == "test"))
    return M.mae_by(test, "l_extendedprice", "prediction", ["l_linenumber"]) \
        .withColumnRenamed("l_linenumber", "batch")
