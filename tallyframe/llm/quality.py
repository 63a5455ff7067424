"""Quality classifier: hashed word and character n-gram embeddings, averaged, with a softmax.

Every word (split at ASCII white space) gives one word feature and its byte
n-grams of 3 and 4 bytes, word ends included; all are hashed into one table
of learned vectors.  A document is the mean of its features' vectors, scored by a
two-class softmax, trained by stochastic gradient descent in numpy.  The
softmax of a mean is linear in the vectors, so scoring needs one number
per hash bucket.  Features are taken from blocks of many documents at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 18
DIM = 8
BLOCK = 1 << 20            # bytes of text whose features are computed at a time
GRAMS = (3, 4)
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _bucket(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h ^ np.uint64(salt * 0xD6E8FEB86659FD93 & (1 << 64) - 1)) * np.uint64(0xFF51AFD7ED558CCD)
    return (h >> np.uint64(46)).astype(np.int32)


def block_features(texts: list[bytes]):
    """(document index, bucket) arrays of every feature of the texts, one pair per kind."""
    raw = np.frombuffer(b" " + b" ".join(texts) + b" ", dtype=np.uint8)
    starts = np.cumsum([1] + [len(t) + 1 for t in texts])
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    x = np.where(space, np.uint8(32), raw).astype(np.uint64)
    # words: polynomial hashes from one running sum
    edge = np.flatnonzero(np.diff(space.astype(np.int8)))
    first, last = edge[0::2] + 1, edge[1::2] + 1
    run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * _powers(_ODD, len(x)), dtype=np.uint64)))
    word = (run[last] - run[first]) * _powers(_INVERSE, len(x))[first]
    yield np.searchsorted(starts, first, "right") - 1, _bucket(word, 1)
    for n in GRAMS:
        if len(x) < n:
            continue
        m = len(x) - n + 1
        h = np.zeros(m, np.uint64)
        inner = np.zeros(m, bool)
        for j in range(n):
            h |= x[j:j + m] << np.uint64(8 * j)
            if 0 < j < n - 1:
                inner |= space[j:j + m]
        at = np.flatnonzero(~inner)
        yield np.searchsorted(starts, at + 1, "right") - 1, _bucket(h[at] * np.uint64(_ODD), n)


def _blocks(texts: list[bytes]):
    """(first index, texts) of up to BLOCK bytes; a longer text is cut at white space where it has any."""
    group, size, start = [], 0, 0
    for i, t in enumerate(texts):
        if group and size + len(t) > BLOCK:
            yield start, group
            group, size = [], 0
        if not group:
            start = i
        while len(t) > BLOCK:
            cut = max(t.rfind(b" ", 0, BLOCK), t.rfind(b"\n", 0, BLOCK))
            cut = cut if cut > 0 else BLOCK
            yield i, [t[:cut]]
            t = t[cut:]
            start = i
        group.append(t)
        size += len(t)
    if group:
        yield start, group


def train(texts: list[bytes], labels: np.ndarray, epochs: int = 4, rate: float = 0.5, seed: int = 5):
    """(number per bucket, bias): the log-odds of label 1 is their mean over a text's features plus bias."""
    rng = np.random.default_rng(seed)
    vec = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out = np.zeros((2, DIM), np.float32)
    bias = np.zeros(2, np.float32)
    bags = []
    for t in texts:
        ids = [b for _, g in _blocks([t]) for _, b in block_features(g)]
        u, c = np.unique(np.concatenate(ids), return_counts=True) if ids else (np.empty(0, int), np.empty(0, int))
        bags.append((u, (c / max(1, c.sum())).astype(np.float32)))
    steps, step = epochs * len(texts), 0
    for _ in range(epochs):
        for i in rng.permutation(len(texts)):
            lr = rate * (1 - step / steps)
            step += 1
            u, share = bags[i]
            v = vec[u]
            mean = share @ v
            z = out @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = p @ out
            out -= lr * np.outer(p, mean)
            bias -= lr * p
            # each feature's vector takes its share, scaled up as a mean of thousands is flat
            vec[u] = v - lr * (50 * share[:, None]) * back
    odds = vec @ (out[1] - out[0])
    return odds.astype(np.float32), float(bias[1] - bias[0])


def score(texts: list[bytes], odds: np.ndarray, bias: float) -> np.ndarray:
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for start, group in _blocks(texts):
        for doc, bucket in block_features(group):
            total[start:start + len(group)] += np.bincount(doc, odds[bucket], minlength=len(group))
            count[start:start + len(group)] += np.bincount(doc, minlength=len(group))
    z = total / np.maximum(count, 1) + bias
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _fit(batches):
    ids, texts, labels = [], [], []
    for b in batches:
        ids += b.column("_id").to_pylist()
        texts += [t or b"" for t in b.column("_text").cast(pa.binary()).to_pylist()]
        labels += b.column("_y").to_pylist()
    if texts:
        order = sorted(range(len(texts)), key=lambda i: (ids[i], texts[i]))
        odds, bias = train([texts[i] for i in order], np.array([labels[i] for i in order]))
        yield pa.RecordBatch.from_arrays([pa.array([odds.tobytes()]), pa.array([bias])], names=["odds", "bias"])


def held_out(id_col: str, folds: int = 5):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", fit_rows: int = 8000) -> tuple[np.ndarray, float]:
    """Train on at most about ``fit_rows`` labelled rows outside the held-out fold.

    The rows are those with the smallest hashes of all such labels, so the choice
    depends on ids alone; the bound fixes the memory and time of the one
    training task.  No usable labels give a model that scores 0.5.
    """
    usable = (labels.where(~held_out(id_col) & F.col(label_col).isin(0, 1))
              .groupBy(F.col(id_col).alias("_lid")).agg(F.max(label_col).cast("int").alias("_y")))
    share = min(1.0, fit_rows / max(1, usable.count()))
    cut = int((share * 2 - 1) * (1 << 62)) * 2 if share < 1 else (1 << 63) - 1
    chosen = usable.where(F.xxhash64("_lid", F.lit(11)) <= F.lit(cut))
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
            .join(F.broadcast(chosen), F.col("_id") == F.col("_lid")).select("_id", "_text", "_y"))
    got = rows.repartition(1).mapInArrow(_fit, "odds binary, bias double").collect()
    if not got:
        return np.zeros(BUCKETS, np.float32), 0.0
    return np.frombuffer(got[0]["odds"], np.float32), got[0]["bias"]


def quality_scores(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id",
                   text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` with score (probability of label 1) and predicted (1 from the threshold on).

    Whole texts of any length are scored; null and empty texts have no features and get
    the model's bias.  Only the text enters a score.  Repeated rows score alike, an
    empty table gives no rows.  Columns named score or predicted are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def prob(texts):
        import pandas as pd
        odds, bias = shared.value
        return pd.Series(score([t.encode("utf-8") if t else b"" for t in texts], odds, bias))

    return (docs.withColumn("score", prob(F.col(text_col).cast("string")))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
