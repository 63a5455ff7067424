"""Exact quantiles without gathering a group into one task.

Spark's ``percentile`` keeps a map of every distinct value of a group and
merges all of them in one task, so a group's memory grows with its data.
Here an exact order statistic is found by radix selection on the order-preserving
64-bit image of the double, 16 bits a round:

* round 1: per group, a histogram of the first 16 bits (sign, exponent and
  four bits more: a small aggregate);
* each wanted rank picks the cell that holds it; its range shrinks to the
  actual [min, max] of the values in that cell;
* up to three later rounds repeat inside the chosen range only, with the next 16 bits (rows outside it are
  filtered out before the shuffle).  After four rounds a cell is one value, whatever the values are:
  infinite, subnormal, of both signs.  A range with few values, or with
  one distinct value, ends earlier.

Every round is a filtered scan plus a partial aggregate; the per-target
table (one row per group and wanted rank) is checkpointed to the shared
folder between rounds.  Interpolation follows Spark's ``percentile``:
position (n - 1) * q between the two neighbouring order statistics;
between -inf and +inf that is NaN.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyframe.operators.profile import numeric_view, quote

BROADCAST_ROWS = 100_000   # a target table below this size is broadcast (counted first)
# A range known (from the previous round's counts) to hold at most this many
# values is finished by sorting those values inside one aggregate.
SMALL_RANGE = 20_000
SHIFTS = (48, 32, 16, 0)


def _join_keys(big: DataFrame, small: DataFrame, keys, small_rows: int) -> DataFrame:
    """Equi-join on group keys; the small side is broadcast only under a counted bound."""
    s = small.select(*[F.col(k).alias(f"__g{i}") for i, k in enumerate(keys)],
                     *[c for c in small.columns if c not in keys])
    if small_rows <= BROADCAST_ROWS:
        s = F.broadcast(s)
    cond = reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(f"__g{i}")) for i, k in enumerate(keys)])
    return big.join(s, cond).drop(*[f"__g{i}" for i in range(len(keys))])


def ordered_image(x: Column) -> Column:
    """A long whose order is that of the double: the sign and magnitude of its 64 bits as one number.

    Powers of two scale exactly, so plain arithmetic finds exponent and mantissa; -0.0 counts as 0.0.
    """
    a = F.abs(x)
    least = F.lit(2.0 ** -1022)
    guess = F.floor(F.log2(a))           # off by one at most
    e = guess + F.when(a >= F.pow(F.lit(2.0), guess + 1), 1).when(a < F.pow(F.lit(2.0), guess), -1).otherwise(0)
    mantissa = ((a * F.pow(F.lit(2.0), -e) - 1) * F.lit(2.0 ** 52)).cast("long")
    image = (F.when(a < least, (a * F.lit(2.0 ** 537) * F.lit(2.0 ** 537)).cast("long"))
             .when(a == F.lit(float("inf")), F.lit(2047 << 52))
             .otherwise((e + 1023) * F.lit(1 << 52) + mantissa))
    return F.when(x < 0, -image).otherwise(image)


def _digit(shift: int) -> Column:
    """Sixteen bits of a value's ordered image; the first digit keeps the sign."""
    d = F.shiftright(ordered_image(F.col("__x")), shift)
    return d if shift == SHIFTS[0] else d.bitwiseAND(F.lit(0xFFFF))


def _cells(rows: DataFrame, keys, shift: int) -> DataFrame:
    """Counts and ends of each cell, and the counts up to it: at most 65,536 cells of a key in one window."""
    cells = (rows.groupBy(*keys, _digit(shift).alias("cell"))
             .agg(F.count(F.lit(1)).alias("cnt"), F.min("__x").alias("cmin"), F.max("__x").alias("cmax")))
    w = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    return cells.withColumn("upto", F.sum("cnt").over(w))


HOLDS = "upto - cnt <= r and r < upto"


def order_statistics(data: DataFrame, by, targets: DataFrame, small_range: int = SMALL_RANGE) -> DataFrame:
    """Exact values at 0-based ranks, after the first round: three more rounds at most.

    ``data``: (by..., __x) non-null doubles.  ``targets``: (by..., tid, r,
    lo, hi, cnt) with r the rank inside [lo, hi] and cnt the number of
    values there, which share the first digit.  Returns (tid, value).
    """
    by = list(by)
    t = targets.withColumn("done", F.col("lo") == F.col("hi")) \
        .withColumn("value", F.when(F.col("done"), F.col("lo")))
    for shift in SHIFTS[1:]:      # each round fixes 16 more bits of every open range; after the last all are one value
        t = t.checkpoint(eager=True)
        active = t.filter(~F.col("done"))
        n_active = active.count()
        if n_active == 0:
            break
        a = active.select(*by, "tid", "r", "lo", "hi", "cnt")
        j = _join_keys(data, a, by, n_active)
        inside = j.filter((F.col("__x") >= F.col("lo")) & (F.col("__x") <= F.col("hi")))
        # Ranges with few values (bounded by the counted ``cnt``): sort and pick.
        few = (inside.filter(F.col("cnt") <= small_range)
               .groupBy("tid").agg(F.sort_array(F.collect_list("__x")).alias("vals"),
                                   F.first("r").alias("r"))
               .select("tid", F.element_at("vals", (F.col("r") + 1).cast("int")).alias("v")))
        finished = active.filter(F.col("cnt") <= small_range).join(few, "tid").select(
            *by, "tid", "r", "lo", "hi", "cnt", F.lit(True).alias("done"), F.col("v").alias("value"))
        cum = _cells(inside.filter(F.col("cnt") > small_range), ["tid"], shift)
        ranks = a.select("tid", "r")
        if n_active <= BROADCAST_ROWS:
            ranks = F.broadcast(ranks)
        pick = (cum.join(ranks, "tid").filter(HOLDS)
                .select("tid", F.expr("r - (upto - cnt)").alias("r2"),
                        F.col("cmin").alias("lo2"), F.col("cmax").alias("hi2"),
                        F.col("cnt").alias("cnt2")))
        nxt = active.filter(F.col("cnt") > small_range).join(pick, "tid").select(
            *by, "tid", F.col("r2").alias("r"), F.col("lo2").alias("lo"), F.col("hi2").alias("hi"),
            F.col("cnt2").alias("cnt"), (F.col("lo2") == F.col("hi2")).alias("done"),
            F.when(F.col("lo2") == F.col("hi2"), F.col("lo2")).alias("value"))
        t = t.filter(F.col("done")).unionByName(finished).unionByName(nxt)
    return t.select("tid", "value")


def _first_round(data: DataFrame, by, targets: DataFrame) -> DataFrame:
    """Round one for all ranks of a group at once: one histogram per group, without a join of the data."""
    cum = _cells(data, list(by), SHIFTS[0])
    t = targets.select(*[F.col(k).alias(f"__t{i}") for i, k in enumerate(by)], "tid", "r")
    cond = reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(f"__t{i}")) for i, k in enumerate(by)])
    return (cum.join(t, cond).filter(HOLDS)
            .select(*by, "tid", F.expr("r - (upto - cnt)").alias("r"),
                    F.col("cmin").alias("lo"), F.col("cmax").alias("hi"), "cnt"))


def exact_quantiles(df: DataFrame, column: str, quantiles, by=(), small_range: int = SMALL_RANGE) -> DataFrame:
    """Interpolated quantiles per group, equal to Spark's ``percentile``.

    Returns (by..., n, q0, q1, ...) - one row per group.  With no ``by``
    the column name (from an unpivot) is the group key, so the joins stay
    equi-joins on a data column.
    """
    from tallyframe.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    by = list(by)
    if not by:
        return exact_quantiles_columns(df, [column], quantiles, small_range).drop("column")
    x = numeric_view(F.col(quote(column)))
    keys = by
    data = df.select(*[F.col(quote(k)) for k in by], x.alias("__x")).filter(F.col("__x").isNotNull())
    groups = data.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
    gid = F.sha2(F.to_json(F.struct(*[F.col(quote(k)) for k in keys])), 256)
    rows = []
    for qi, q in enumerate(quantiles):
        pos = (F.col("n") - 1).cast("double") * F.lit(float(q))
        for side, fn in (("lo", F.floor), ("hi", F.ceil)):
            rows.append(groups.select(*keys, "n", pos.alias("pos"),
                                      F.concat_ws("|", gid, F.lit(f"{qi}{side}")).alias("tid"),
                                      fn(pos).cast("bigint").alias("r"),
                                      F.lit(qi).alias("qi"), F.lit(side).alias("side")))
    targets = reduce(DataFrame.unionByName, rows).checkpoint(eager=True)
    narrowed = _first_round(data, keys, targets)
    stats = order_statistics(data, keys, narrowed, small_range)
    vals = targets.join(stats, "tid")
    lower = F.max(F.when(F.col("side") == "lo", F.col("value")))
    upper = F.max(F.when(F.col("side") == "hi", F.col("value")))
    pos = F.first("pos")
    fl, ce = F.floor(pos), F.ceil(pos)
    interp = F.when(fl == ce, lower).otherwise((ce - pos) * lower + (pos - fl) * upper)
    per_q = vals.groupBy(*keys, "n", "qi").agg(interp.alias("v"))
    out = per_q.groupBy(*keys, "n").agg(*[F.max(F.when(F.col("qi") == i, F.col("v"))).alias(f"q{i}")
                                          for i in range(len(quantiles))])
    return out


def exact_quantiles_columns(df: DataFrame, columns, quantiles, small_range: int = SMALL_RANGE) -> DataFrame:
    """Exact quantiles of several columns in one search: (column, n, q0, q1, ...).

    The columns are unpivoted to (column, value) and searched as groups, so
    all of them share the same few passes.
    """
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(quote(c)).cast("double").alias("value"))
        for c in columns])).alias("kv")).select("kv.column", "kv.value")
    return exact_quantiles(long, "value", quantiles, by=["column"], small_range=small_range)
