"""Row shaping: head, positional slices, repeatable samples, splits, imputation.

Positional and sampling operators are written so that no step puts the
whole table (or an unbounded group) through one task:

* ``head`` / ``slices`` use take-ordered (k rows per task) for the bounded
  prefixes and a broadcast anti-join (k rows, a proven bound) for the rest;
* ``exact_sample`` finds the k-th smallest row hash by a few rounds of
  prefix counting (each round a small aggregate of at most 16^4 rows) and
  then keeps ``hash <= threshold`` with a plain filter; a sample that is a
  small part of the table is drawn from its lowest hashes, written by one pass;
* ``row_positions`` numbers rows through a range partitioning whose
  per-partition counts (one row per partition) give the offsets.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyframe.operators.profile import ProfileOptions, quote, spread_input
from tallyframe.session import scratch_path


def head(df: DataFrame, order_by, n: int) -> DataFrame:
    """First n rows in key order (a repeatable ``head``)."""
    return df.orderBy(*order_by).limit(n)


def _row_order(df: DataFrame) -> Column:
    """Tie-break over the whole row: only identical rows share it."""
    return F.xxhash64(*[F.col(quote(c)).cast("string") for c in df.columns])


def slices(df: DataFrame, order_by, cuts=(200, 231, 262), label: str = "slice") -> DataFrame:
    """Label rows by positional slice: [:c0] -> 0, [c0:c1] -> 1, ..., [c_last:] -> len(cuts).

    The bounded prefix (``max(cuts)`` rows) is taken ordered and numbered
    inside that small set; every other row is in the open tail slice.  Nulls
    order first; rows of one key are ordered by a hash of the whole row, so
    every row gets exactly one slice whatever repeats.
    """
    if not all(isinstance(c, str) for c in order_by):
        raise ValueError("slices needs column names as the order key")
    k = max(cuts)
    if k == 0:      # every row lies behind all cuts
        return df.withColumn(label, F.lit(len(cuts)))
    keyed = df.withColumn("__tie", _row_order(df))
    keys = [*order_by, "__tie"]
    prefix = keyed.orderBy(*[F.col(quote(c)).asc_nulls_first() for c in keys]).limit(k)
    # At most k rows reach this window.
    pos = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*[F.col(quote(c)).asc_nulls_first() for c in keys]))
    slice_id = reduce(lambda acc, ic: F.when(F.col("__pos") <= ic[1], F.lit(ic[0])).otherwise(acc),
                      reversed(list(enumerate(cuts))), F.lit(len(cuts)))
    head_part = prefix.withColumn("__pos", pos)
    last = head_part.orderBy(F.desc("__pos")).select(*keys).first()
    if last is None:
        return df.withColumn(label, F.lit(len(cuts))).limit(0)
    after, equal = F.lit(False), F.lit(True)
    for c in keys:
        x, bound = F.col(quote(c)), F.lit(last[c])
        beyond = x.isNotNull() if last[c] is None else F.coalesce(x > bound, F.lit(False))
        after = after | (equal & beyond)
        equal = equal & x.eqNullSafe(bound)
    tail = keyed.filter(after)
    # rows identical to the last one of the prefix: as many as are left over
    extra = keyed.filter(equal).count() - prefix.filter(equal).count()
    if extra > 0:
        tail = tail.unionByName(keyed.filter(equal).limit(extra))
    return (head_part.withColumn(label, slice_id).drop("__pos", "__tie")
            .unionByName(tail.withColumn(label, F.lit(len(cuts))).drop("__tie")))


def row_hash(keys, seed) -> Column:
    """md5 of the row key and a seed: the order of a repeatable random draw."""
    return F.md5(F.concat_ws("|", *[F.col(quote(k)).cast("string") for k in keys],
                             F.lit(str(seed))))


@dataclass
class Sample:
    rows: DataFrame
    complement: DataFrame
    threshold: str | None
    size: int


def kth_smallest_hash(hashed: DataFrame, k, col: str = "__h",
                      step: int = 4, small: int = 100_000) -> str | None:
    """Exact k-th smallest hex hash (1-based) by prefix refinement.

    Each round counts rows per next ``step`` hex digits inside the current
    prefix (at most 16^step groups back to the driver), keeps the bucket
    holding rank k, and stops once that bucket has at most ``small`` rows,
    which are ordered to pick the exact value.  ``k`` may be a function of
    the row count; the first round's bucket counts give that count, so no
    separate counting pass is needed.
    """
    prefix, rank = "", None
    while True:
        plen = len(prefix) + step
        sub = hashed.filter(F.col(col).startswith(prefix)) if prefix else hashed
        buckets = (sub.groupBy(F.substring(col, 1, plen).alias("b"))
                   .agg(F.count(F.lit(1)).alias("n")).orderBy("b").collect())
        if rank is None:
            rank = k(sum(b["n"] for b in buckets)) if callable(k) else k
            if rank <= 0:
                return None
        seen = 0
        chosen = None
        for b in buckets:
            if seen + b["n"] >= rank:
                chosen = b
                break
            seen += b["n"]
        if chosen is None:
            return None
        prefix, rank = chosen["b"], rank - seen
        if chosen["n"] <= small or plen >= 32:
            row = (hashed.filter(F.col(col).startswith(prefix)).select(col)
                   .orderBy(col).offset(rank - 1).limit(1).first())
            return row[0]


def _lowest_hashes(hashed: DataFrame, size: int, oversample: int = 10, most: float = 0.25) -> DataFrame:
    """All rows up to some hash, at least ``size`` of them, written by one pass that hashes every row.

    Aims at ``oversample * size`` rows and widens until there are enough; ``hashed`` itself where that passes
    the share ``most`` of the table or where files cannot hold its columns.
    """
    columns = {c.lower() for c in hashed.columns}
    if len(columns) < len(hashed.columns) or any(t in hashed.schema.simpleString() for t in ("void", "interval")):
        return hashed
    spark = hashed.sparkSession
    share = oversample * size / max(hashed.count(), 1)
    while share <= most:
        last = format(int(share * 16 ** 8), "08x") + "f" * 24
        path = scratch_path(spark, "sample")
        hashed.filter(F.col("__h") <= F.lit(last)).write.parquet(path)
        lowest = spark.read.schema(hashed.schema).parquet(path)
        if lowest.count() >= size:
            return lowest
        share *= 4
    return hashed


def exact_sample(df: DataFrame, keys, fraction: float | None = None, size: int | None = None,
                 seed=123) -> Sample:
    """Exact-size sample without replacement, repeatable by seed.

    The rows with the ``size`` smallest md5(key, seed) values; ``size``
    defaults to ``int(count * fraction)``; all rows if there are fewer.  Rows
    of a repeated key are ordered by the whole row.  The complement is the rest.
    """
    hashed = df.withColumn("__h", row_hash(keys, seed))
    sizes = []

    def want(n: int) -> int:
        sizes.append(size if size is not None else int(n * fraction))
        return sizes[-1]

    # all rows up to the threshold are among the lowest
    lowest = _lowest_hashes(hashed, size) if size else hashed
    thr = kth_smallest_hash(lowest.select("__h"), want)
    wanted = sizes[-1] if sizes else 0
    if thr is None:
        # nothing wanted, or at least as many rows as there are
        rows, rest = (hashed, hashed.limit(0)) if wanted > 0 else (hashed.limit(0), hashed)
        return Sample(rows.drop("__h"), rest.drop("__h"), None, wanted)
    below, above = F.col("__h") < F.lit(thr), F.col("__h") > F.lit(thr)
    n = lowest.agg(F.count_if(below).alias("below"), F.count_if(F.col("__h") == F.lit(thr)).alias("tied")).first()
    take = wanted - n["below"]
    if take == n["tied"]:
        rows, rest = lowest.filter(~above), hashed.filter(above)
    else:
        # the key repeats at the cut: order its rows by a second hash, of the whole row
        tied = lowest.filter(F.col("__h") == F.lit(thr)).withColumn("__r", F.md5(_row_order(df).cast("string")))
        cut = kth_smallest_hash(tied.select("__r"), take, "__r")
        m = tied.agg(F.count_if(F.col("__r") < F.lit(cut)).alias("below"),
                     F.count_if(F.col("__r") == F.lit(cut)).alias("same")).first()
        same = tied.filter(F.col("__r") == F.lit(cut))          # identical rows: any will do
        left = take - m["below"]
        rows = lowest.filter(below).unionByName(
            tied.filter(F.col("__r") < F.lit(cut)).unionByName(same.limit(left)).drop("__r"))
        rest = hashed.filter(above).unionByName(
            tied.filter(F.col("__r") > F.lit(cut)).unionByName(same.limit(m["same"] - left)).drop("__r"))
    return Sample(rows.drop("__h"), rest.drop("__h"), thr, wanted)


def anti_complement(df: DataFrame, sample: DataFrame, keys) -> DataFrame:
    """Rows of ``df`` not in ``sample`` by row identity (left anti join)."""
    return df.join(sample.select(*keys), list(keys), "left_anti")


def hash_split(df: DataFrame, keys, share: float = 0.75, seed=123,
               labels=("train", "test"), label: str = "split") -> DataFrame:
    """Repeatable random split: first 8 hex digits of the row hash vs share * 16^8."""
    if share >= 1:
        return df.withColumn(label, F.lit(labels[0]))
    cut = format(int(max(share, 0) * 16 ** 8), "08x")
    h = F.substring(row_hash(keys, seed), 1, 8)
    return df.withColumn(label, F.when(h < F.lit(cut), labels[0]).otherwise(labels[1]))


def random_batches(df: DataFrame, keys, batches: int = 20, size: int = 5,
                   seed=123, oversample: int = 10) -> DataFrame:
    """``batches`` draws of ``size`` rows each: no repeat inside a batch,
    repeats across batches allowed.  Draw b = the ``size`` rows with the
    smallest md5(key, seed, b).

    One pass computes every row's ``batches`` hashes and keeps only rows
    whose hash for some batch falls under a threshold sized for about
    ``oversample * size`` candidates per batch; the picked rows, ``size`` a
    batch at most, are written to the shared scratch folder, so that the
    hashes are not computed again wherever the batches are read.  All rows
    with a smaller hash are candidates, so a full batch is exact; the
    threshold is widened until every batch is (no cross join, no per-batch
    scan of the table).
    """
    spark = df.sparkSession
    n = df.count()
    # the hashes cost far more than the move of the rows to all cores
    spread, _ = spread_input(df, ProfileOptions())
    cols = [F.col(quote(k)).cast("string") for k in keys]
    # the batch's number ends the hashed text: all before it is put together once a row
    draws = (spread.withColumn("__key", F.concat_ws("|", *cols, F.lit(str(seed)), F.lit("")))
             .withColumn("batch", F.explode(F.array(*[F.lit(b) for b in range(batches)])))
             .withColumn("__h", F.md5(F.concat("__key", F.col("batch").cast("string")))))
    # only candidates reach the window, and of each task's no more than ``size`` a batch
    rank = F.row_number().over(Window.partitionBy("batch").orderBy("__h"))
    need = min(size, n)
    share = min(1.0, oversample * size / max(n, 1))
    while True:
        last = None if share >= 1.0 else format(min(int(share * 16 ** 8), 16 ** 8 - 1), "08x") + "f" * 24
        found = draws if last is None else draws.filter(F.col("__h") <= F.lit(last))
        picked = found.withColumn("__rn", rank).filter(F.col("__rn") <= size).drop("__rn", "__h", "__key")
        path = scratch_path(spark, "batches")
        picked.write.parquet(path)
        picked = spark.read.schema(picked.schema).parquet(path)
        if last is None:
            return picked
        counts = {r["batch"]: r["n"] for r in picked.groupBy("batch").agg(F.count(F.lit(1)).alias("n")).collect()}
        if all(counts.get(b, 0) >= need for b in range(batches)):
            return picked
        share = min(1.0, share * 4)


def row_positions(df: DataFrame, order_by, partitions: int | None = None,
                  label: str = "pos") -> DataFrame:
    """1-based global position of every row in key order (``reset_index``).

    Range-partition on the key, number rows inside each partition, add the
    row counts of all earlier partitions.  The numbered table is
    checkpointed (shared checkpoint folder) so that both uses see the same
    range boundaries even if tasks are re-run.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*order_by, _row_order(df)]   # ties of the key spread over partitions
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    mono = F.monotonically_increasing_id()
    numbered = ranged.select("*", F.spark_partition_id().alias("__pid"),
                             (mono.bitwiseAND(F.lit((1 << 33) - 1))).alias("__local"))
    numbered = numbered.checkpoint(eager=True)
    counts = numbered.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition: small, broadcast.
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    return (numbered.join(F.broadcast(offsets), "__pid")
            .withColumn(label, F.col("__off") + F.col("__local") + 1)
            .drop("__pid", "__local", "__off"))


def nulls_from_codes(df: DataFrame, code: str = "?", columns=None) -> DataFrame:
    """Missing-value code to null (``replace('?', nan)``)."""
    cols = columns or df.columns
    return df.select(*[F.nullif(F.col(quote(c)).cast("string"), F.lit(code)).alias(c)
                       if c in cols else F.col(quote(c)) for c in df.columns])


def impute_median(df: DataFrame, columns, exact: bool = True, accuracy: int = 100000) -> DataFrame:
    """Fill nulls with the column median (interpolated, as pandas ``median``).

    ``exact`` finds the median by range-narrowing order statistics (bounded
    memory, a few filtered passes); ``exact=False`` uses one
    ``percentile_approx`` pass.  The medians are a handful of scalars,
    taken to the driver and folded in as literals.
    """
    from tallyframe.operators.quantiles import exact_quantiles_columns
    med = {}
    if exact:
        for r in exact_quantiles_columns(df, columns, [0.5]).collect():   # one row per column
            med[r["column"]] = r["q0"]
    else:
        aggs = [F.percentile_approx(F.col(quote(c)), 0.5, accuracy).alias(c) for c in columns]
        med = df.agg(*aggs).first().asDict()
    # an even count's median lies between two values: integer columns become double
    filled = {c: F.coalesce(F.col(quote(c)).cast("double"), F.lit(float(v))).alias(c)
              for c, v in med.items() if v is not None}
    return df.select(*[filled.get(c, F.col(quote(c))) for c in df.columns])


def cast_all(df: DataFrame, dtype: str = "float", columns=None) -> DataFrame:
    cols = set(columns or df.columns)
    return df.select(*[F.col(quote(c)).cast(dtype).alias(c) if c in cols else F.col(quote(c))
                       for c in df.columns])


def features_target(df: DataFrame, target: str):
    """Split a frame into features (all but target) and the target column."""
    return df.drop(target), df.select(target)
