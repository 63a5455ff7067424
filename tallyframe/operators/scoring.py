"""Model scoring and run logs as table jobs (MLlib, Spark tables).

Models train on a bounded sample and score the whole table in parallel;
runs and their per-batch profiles are rows of two tables joined on
``run_id``.
"""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.operators.profile import ProfileOptions, quote, spread_input
from tallyframe.session import scratch_path

# Model parameters of the reference's examples.
FOREST_PARAMS = {"numTrees": 40, "maxDepth": 16, "featureSubsetStrategy": "all", "seed": 1095}
ELASTIC_NET_PARAMS = {"regParam": 1.0, "elasticNetParam": 0.7}
CELLS = 1 << 17     # most cells between the split points of a forest whose classes are kept as a table


def random_forest(train: DataFrame, features, label: str):
    """Classifier pipeline; ``predict`` column holds the predicted label text.

    The training rows are kept while the trees are grown: a sample is drawn once, not once per pass of the fit.
    """
    idx = StringIndexer(inputCol=label, outputCol="__label", handleInvalid="keep")
    vec = VectorAssembler(inputCols=list(features), outputCol="__features", handleInvalid="keep")
    rf = RandomForestClassifier(featuresCol="__features", labelCol="__label",
                                predictionCol="__pred", probabilityCol="__prob",
                                rawPredictionCol="__raw", **FOREST_PARAMS)
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = Pipeline(stages=[idx, vec, rf]).fit(train)
    finally:
        train.unpersist()
    back = IndexToString(inputCol="__pred", outputCol="prediction",
                         labels=model.stages[0].labels)
    return model, back


def forest_nodes(forest) -> list[tuple[np.ndarray, ...]] | None:
    """Per tree (feature, threshold, children, votes, depth), read from the saved model; None if a split has categories.

    ``children`` holds the right and the left child of each node side by side; a leaf is its own child.
    """
    spark = SparkSession.active()
    path = scratch_path(spark, "forest")
    forest.write().save(path)
    rows = spark.read.parquet(path + "/data").select("treeID", "nodeData.*").toPandas()
    trees = []
    for _, t in sorted(rows.groupby("treeID")):
        t = t.sort_values("id")
        inner = t["leftChild"].to_numpy() >= 0
        if any(x["numCategories"] != -1 for x in t["split"][inner]):
            return None
        at = {n: i for i, n in enumerate(t["id"])}
        feature, threshold = np.zeros(len(t), np.int64), np.full(len(t), np.inf)
        children = np.repeat(np.arange(len(t)), 2).reshape(-1, 2)
        feature[inner] = [x["featureIndex"] for x in t["split"][inner]]
        threshold[inner] = [x["leftCategoriesOrThreshold"][0] for x in t["split"][inner]]
        children[inner, 0] = [at[x] for x in t["rightChild"][inner]]
        children[inner, 1] = [at[x] for x in t["leftChild"][inner]]
        votes = np.array([list(x) for x in t["impurityStats"]])
        total = votes.sum(axis=1, keepdims=True)
        votes = np.divide(votes, total, out=np.zeros_like(votes), where=total != 0)
        depth, level = 0, np.zeros(1, np.int64)
        while inner[level].any():
            level, depth = children[level[inner[level]]].ravel(), depth + 1
        trees.append((feature, threshold, children.ravel(), votes, depth))
    return trees


def forest_votes(trees, x: np.ndarray) -> np.ndarray:
    """Summed votes (rows, classes) of all trees for features ``x`` (features, rows); missing values go right."""
    n = x.shape[1]
    flat, row, out = x.ravel(), np.arange(n), np.zeros((n, trees[0][3].shape[1]))
    for feature, threshold, children, votes, depth in trees:
        start, node = feature * n, np.zeros(n, np.int64)
        for _ in range(depth):
            left = flat.take(start.take(node) + row) <= threshold.take(node)
            node = children.take(2 * node + left)
        out += votes.take(node, axis=0)
    return out


def forest_cells(trees, n_features: int) -> tuple[list[np.ndarray], np.ndarray] | None:
    """The split points of each feature and the class of every cell between them; None beyond CELLS cells.

    A forest only compares features with its split points, so that all values of one cell take the same way
    through every tree: the trees are walked once a cell instead of once a row.
    """
    inner = [t[2][::2] != np.arange(len(t[0])) for t in trees]
    points = [np.unique(np.concatenate([t[1][i & (t[0] == f)] for t, i in zip(trees, inner)])) for f in range(n_features)]
    shape = [len(p) + 1 for p in points]
    if math.prod(shape) > CELLS:
        return None
    # a cell ends at its split point, which goes left; the last cell lies above all, as missing values do
    at = np.indices(shape).reshape(n_features, -1)
    x = np.stack([np.append(p, np.nan)[i] for p, i in zip(points, at)])
    return points, forest_votes(trees, x).argmax(axis=1).astype(np.float64)


def cell_classes(cells, x: np.ndarray) -> np.ndarray:
    """The class of each row of features ``x`` (features, rows), by its cell."""
    points, classes = cells
    cell = np.zeros(x.shape[1], np.int64)
    for p, values in zip(points, x):
        cell *= len(p) + 1
        cell += np.searchsorted(p, values)
    return classes.take(cell)


def score(model_and_back, df: DataFrame) -> DataFrame:
    """Append the prediction to the inputs (``output['pred'] = model.predict(X)``).

    Rows find their class by their cell between the forest's split points; with too many cells the trees are walked
    level by level for a whole Arrow batch; features or splits that are no plain
    numbers go through the fitted model row by row.  Inputs of few partitions are spread to all cores first.
    """
    model, back = model_and_back
    features = model.stages[1].getInputCols()
    kinds = {f.name: f.dataType for f in df.schema.fields}
    plain = all(isinstance(kinds.get(f), (T.NumericType, T.BooleanType)) for f in features)
    trees = forest_nodes(model.stages[2]) if plain else None
    df, _ = spread_input(df, ProfileOptions())
    if trees is None:
        out = back.transform(model.transform(df))
        return out.drop("__label", "__features", "__pred", "__prob", "__raw")
    cells = forest_cells(trees, len(features))
    shared = df.sparkSession.sparkContext.broadcast(cells or trees)
    by_cell = cells is not None

    @F.pandas_udf("double")
    def predicted(*columns: pd.Series) -> pd.Series:
        x = np.stack([c.to_numpy(dtype=np.float64, na_value=np.nan) for c in columns])
        if by_cell:
            return pd.Series(cell_classes(shared.value, x))
        return pd.Series(forest_votes(shared.value, x).argmax(axis=1).astype(np.float64))

    inputs = [F.col(quote(f)).cast("double") for f in features]
    return back.transform(df.withColumn("__pred", predicted(*inputs))).drop("__pred")


def elastic_net(train: DataFrame, features, label: str):
    vec = VectorAssembler(inputCols=list(features), outputCol="__features")
    lr = LinearRegression(featuresCol="__features", labelCol=label, predictionCol="prediction",
                          **ELASTIC_NET_PARAMS)
    return Pipeline(stages=[vec, lr]).fit(train)


def predict(model, df: DataFrame) -> DataFrame:
    return model.transform(df).drop("__features")


def mae_by(df: DataFrame, y: str, p: str, by) -> DataFrame:
    """Mean absolute error per batch."""
    return df.groupBy(*by).agg(F.avg(F.abs(F.col(y) - F.col(p))).alias("mae"),
                               F.count(F.lit(1)).alias("n"))


def run_rows(metrics: DataFrame, batch_col: str, experiment: str, params: dict[str, str],
             start: dt.datetime, step: dt.timedelta = dt.timedelta(minutes=1)) -> DataFrame:
    """One run per batch: run_id, experiment, params map, metric, start time.

    Start times are ``start + batch * step``: a parameter, never the wall
    clock, so the log is repeatable.
    """
    pm = F.create_map(*[x for k, v in params.items() for x in (F.lit(k), F.lit(str(v)))])
    b = F.col(batch_col)
    return metrics.select(
        F.format_string("run-%02d", b).alias("run_id"), F.lit(experiment).alias("experiment"),
        pm.alias("params"), "mae",
        (F.lit(start) + F.make_interval(mins=b * int(step.total_seconds() // 60))).cast("timestamp")
        .alias("start_time"), b.alias("batch"))


def ci_half_width(sd: Column, n: Column, z: float = 1.96) -> Column:
    """Half width of the normal interval around a mean (own choice of 1.96)."""
    return F.when(n > 1, F.lit(z) * sd / F.sqrt(n))
