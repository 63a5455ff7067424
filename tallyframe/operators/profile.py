"""Profile a DataFrame: one wide aggregate, stored in long form.

A profile row describes one column of one (dataset, time bucket, tags)
group.  All per-column statistics of a table are computed in a single
aggregation (Spark plans one scan, partial aggregation on the map side
and one exchange); the wide result is turned into long form with
``inline`` afterwards, which is far cheaper than unpivoting the data
first.

Counts, per-type counts, min/max and the moment triple (n, mean, m2) are
exact and mergeable.  Quantiles, distinct counts and frequent items use
Spark's built-in mergeable sketches (KLL, theta, approx top-k), which
hold bounded state per group no matter how many rows a group has: a hot
group that holds a third of the table still reduces to one sketch per
map task before the shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions import typeclass as tc

TAGS_TYPE = T.ArrayType(T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
]))
TOPK_TYPE = T.StructType([
    T.StructField("sketch", T.BinaryType()),
    T.StructField("maxItemsTracked", T.IntegerType()),
    T.StructField("itemDataType", T.StringType()),
    T.StructField("itemDataTypeDDL", T.StringType()),
])

# Smallest or largest value in its own type, where a double would lose digits: a number as its floor and
# the part above it (up to 37 decimals), a point in time, a date, or the first characters of a text.
EXTREME_TYPE = T.StructType([
    T.StructField("integer", T.DecimalType(38, 0)),
    T.StructField("fraction", T.DecimalType(38, 37)),
    T.StructField("time", T.TimestampType()),
    T.StructField("date", T.DateType()),
    T.StructField("text", T.StringType()),
])
EXTREME_TEXT = 64                    # characters kept of a text, so that a row's size is bounded

# Frequent items: a longer text (or one that begins with the mark) is tracked by its first characters and its
# MD5, so that the bytes of a sketch do not grow with the texts.
ITEM_TEXT = 64
ITEM_HEAD = 24
ITEM_MARK = "\u0001"

# Key columns of a profile row (one profile = one value of these).
PROFILE_KEYS = ("name", "dataset_timestamp", "tags")

# Per-column statistics of a profile row, in output order.
STAT_FIELDS = (
    ("count", T.LongType()),
    ("null_count", T.LongType()),
    ("type_integral", T.LongType()),
    ("type_fractional", T.LongType()),
    ("type_boolean", T.LongType()),
    ("type_string", T.LongType()),
    ("type_unknown", T.LongType()),
    ("n", T.LongType()),
    ("min", T.DoubleType()),
    ("max", T.DoubleType()),
    ("mean", T.DoubleType()),
    ("m2", T.DoubleType()),
    ("kll", T.BinaryType()),
    ("theta", T.BinaryType()),
    ("topk", TOPK_TYPE),
    ("low", EXTREME_TYPE),
    ("high", EXTREME_TYPE),
)
EXACT_FIELDS = tuple(n for n, _ in STAT_FIELDS if n not in ("kll", "theta", "topk", "low", "high"))


@dataclass(frozen=True)
class ProfileOptions:
    """Knobs of the profile aggregate (all own choices)."""

    kll_k: int = 200                 # KLL accuracy (~1.3% rank error at 200)
    theta_lg_k: int = 12             # theta nominal entries 2^12: exact below 4096
    top_k_items: int = 128           # frequent-item sketch capacity
    # Frequent items are kept for text, boolean and date/time columns; with
    # ``top_k_numeric`` also for numbers (costly: every value becomes text).
    top_k_numeric: bool = False
    sketches: bool = True            # False: exact fields only
    columns_per_pass: int = 50       # split very wide tables into passes
    # Two-level (tree) aggregation.  With one global group every map task
    # ships its partial sketches to a single reducer; past ``tree_threshold``
    # input partitions the partials are first merged by ``partition_id %
    # fanout`` and then once more per group.  0 = choose from the input.
    tree_fanout: int = 0
    tree_threshold: int = 256
    # Inputs with very few partitions (a single row group, one gzip file)
    # are spread round-robin first so that the partial aggregation runs on
    # many cores: below ``spread_below`` partitions, to
    # min(default parallelism, ``min_partitions`` or 256) partitions.  Larger
    # inputs are aggregated where they are read (no extra shuffle).
    min_partitions: int = 0
    spread_below: int = 32


THETA_NATIVE = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.StringType)


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def numeric_view(c: Column) -> Column:
    """A column as double; NaN, the missing marker of many sources, counts as null."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def _typed_null(dtype: T.DataType) -> Column:
    return F.lit(None).cast(dtype)


def _exact_view(c: Column, dt: T.DataType, opts: ProfileOptions) -> Column | None:
    """What the typed extremes of a column are taken of; None where min and max as doubles say it all.

    Texts only beside the sketches: their aggregate has no fixed size, which makes plain aggregates sort.
    """
    if isinstance(dt, tc.INTEGRAL_TYPES):
        return c.cast("bigint")
    if isinstance(dt, T.StringType):
        return F.substring(c, 1, EXTREME_TEXT) if opts.sketches else None
    return c if isinstance(dt, (T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)) else None


def _extreme(v: Column, dt: T.DataType) -> Column:
    number = isinstance(dt, (*tc.INTEGRAL_TYPES, T.DecimalType))
    parts = {"integer": F.floor(v) if number else None,
             "fraction": (F.pmod(v, F.lit(1)) if isinstance(dt, T.DecimalType) and dt.scale else F.lit(0) + v * 0) if number else None,
             "time": v if isinstance(dt, (T.TimestampType, T.TimestampNTZType)) else None,
             "date": v if isinstance(dt, T.DateType) else None, "text": v if isinstance(dt, T.StringType) else None}
    return F.struct(*[(parts[f.name] if parts[f.name] is not None else F.lit(None)).cast(f.dataType).alias(f.name) for f in EXTREME_TYPE])


def extreme_text(x: Column) -> Column:
    """A typed extreme as text: a number without needless zeros, an ISO date or time, or the text itself; null without values."""
    integer, fraction = x["integer"], x["fraction"]
    below = (integer < 0) & (fraction > 0)       # -1.5 is kept as -2 and 0.5
    whole = F.when(below, F.concat(F.lit("-"), (-(integer + 1)).cast("string"))).otherwise(integer.cast("string"))
    rest = F.when(below, F.lit(1).cast("decimal(38,37)") - fraction).otherwise(fraction)
    digits = F.rtrim(F.substring_index(rest.cast("decimal(38,37)").cast("string"), ".", -1), F.lit("0"))
    number = F.when(fraction > 0, F.concat(whole, F.lit("."), digits)).otherwise(whole)
    return F.coalesce(number, x["time"].cast("string"), x["date"].cast("string"), x["text"])


def tracked_item(text: Column) -> Column:
    """What the frequent-item sketch tracks of a text: short texts whole, others as mark, MD5 and first characters."""
    long = (F.length(text) > ITEM_TEXT) | text.startswith(ITEM_MARK)
    return F.when(long, F.concat(F.lit(ITEM_MARK), F.md5(text.cast("binary")), F.substring(text, 1, ITEM_HEAD))).otherwise(text)


def _column_aggs(i: int, fld: T.StructField, opts: ProfileOptions):
    """Per-column derived values, aggregate expressions and a builder of its stat struct.

    Derived values (regex class flags, the numeric view) are projected once
    per row before the aggregate: sketch aggregates run in the
    (non-codegen) ObjectHashAggregate, which would otherwise evaluate the
    same regex once per aggregate function.
    """
    c = F.col(quote(fld.name))
    dt = fld.dataType
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        c = F.nanvl(c, F.lit(None).cast(dt))
    p = f"__c{i}_"
    is_text = isinstance(dt, T.StringType)
    has_num = tc.numeric_value(c, dt) is not None
    stage1: list[Column] = []
    stage2: list[Column] = []
    if is_text:
        stage1 += [tc.is_integral_text(c).alias(p + "isint"),
                   c.rlike(tc.FRACTIONAL_RE).alias(p + "isnum"),
                   tc.is_boolean_text(c).alias(p + "isbool")]
        stage2.append(F.when(F.col(p + "isnum"), c.try_cast("double")).alias(p + "x"))
        if opts.sketches:
            stage1.append(tracked_item(c).alias(p + "item"))
    elif has_num:
        stage1.append(c.cast("double").alias(p + "x"))
    num = F.col(p + "x") if has_num else None
    aggs: list[Column] = [F.count_if(c.isNull()).alias(p + "nulls")]
    if is_text:
        aggs += [
            F.count_if(F.col(p + "isint")).alias(p + "ti"),
            F.count_if(F.col(p + "isnum") & ~F.col(p + "isint")).alias(p + "tf"),
            F.count_if(F.col(p + "isbool")).alias(p + "tb"),
        ]
    if num is not None:
        aggs += [
            F.count(num).alias(p + "n"),
            F.min(num).alias(p + "min"),
            F.max(num).alias(p + "max"),
            F.avg(num).alias(p + "mean"),
            F.var_pop(num).alias(p + "var"),
        ]
    exact = _exact_view(c, dt, opts)
    if exact is not None:
        aggs += [F.min(exact).alias(p + "low"), F.max(exact).alias(p + "high")]
    sketchable = not isinstance(dt, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))
    if opts.sketches and num is not None:
        aggs.append(F.call_function("kll_sketch_agg_double", num, F.lit(opts.kll_k))
                    .alias(p + "kll"))
    keep_topk = sketchable and (opts.top_k_numeric or num is None or is_text)
    q = quote(fld.name)
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        q = f"nanvl({q}, null)"
    if opts.sketches and sketchable:
        # Theta hashes numbers natively; other types go through their text form.
        tv = c if isinstance(dt, THETA_NATIVE) else c.cast("string")
        aggs.append(F.call_function("theta_sketch_agg", tv, F.lit(opts.theta_lg_k))
                    .alias(p + "theta"))
    if opts.sketches and keep_topk:
        item = p + "item" if is_text else q
        aggs.append(F.expr(
            f"approx_top_k_accumulate(CAST({item} AS STRING), {opts.top_k_items}) "
            f"FILTER (WHERE {item} IS NOT NULL)").alias(p + "topk"))

    def build(rows: Column) -> Column:
        g = lambda s: F.col(p + s)
        nulls = g("nulls")
        nonnull = rows - nulls
        zero = F.lit(0).cast("bigint")
        ti = tf = tb = ts = tu = zero
        if is_text:
            ti, tf, tb = g("ti"), g("tf"), g("tb")
            ts = nonnull - ti - tf - tb
        elif isinstance(dt, tc.INTEGRAL_TYPES):
            ti = nonnull
        elif isinstance(dt, tc.NUMERIC_TYPES):
            tf = nonnull
        elif isinstance(dt, T.BooleanType):
            tb = nonnull
        else:
            tu = nonnull
        vals = {
            "count": rows, "null_count": nulls,
            "type_integral": ti, "type_fractional": tf, "type_boolean": tb,
            "type_string": ts, "type_unknown": tu,
        }
        if num is not None:
            n = g("n")
            vals.update({"n": n, "min": g("min"), "max": g("max"),
                         "mean": g("mean"),
                         "m2": F.when(n > 0, g("var") * n)})
        else:
            vals["n"] = zero
        if exact is not None:
            vals.update({"low": _extreme(g("low"), dt), "high": _extreme(g("high"), dt)})
        if opts.sketches and num is not None:
            vals["kll"] = g("kll")
        if opts.sketches and sketchable:
            vals["theta"] = g("theta")
        if opts.sketches and keep_topk:
            vals["topk"] = g("topk")
        parts = [F.lit(fld.name).alias("column")]
        for name, ftype in STAT_FIELDS:
            v = vals.get(name)
            parts.append((v.cast(ftype) if v is not None else _typed_null(ftype)).alias(name))
        return F.struct(*parts)

    return stage1, stage2, aggs, build


@dataclass
class WidePlan:
    """How a set of columns becomes profile rows.

    ``derive(df)`` adds the per-row derived values, ``aggs`` go into one
    ``agg`` (batch or streaming), ``to_long`` is an ``inline`` generator
    over the wide row that yields one profile struct per column.
    """

    stage1: list
    stage2: list
    aggs: list
    to_long: Column

    def derive(self, df: DataFrame) -> DataFrame:
        out = df.select("*", *self.stage1) if self.stage1 else df
        return out.select("*", *self.stage2) if self.stage2 else out


def wide_plan(fields, options: ProfileOptions = ProfileOptions(), first_index: int = 0) -> WidePlan:
    s1, s2, aggs, builders = [], [], [F.count(F.lit(1)).alias("__rows")], []
    for i, fld in enumerate(fields, start=first_index):
        a1, a2, a, b = _column_aggs(i, fld, options)
        s1 += a1
        s2 += a2
        aggs += a
        builders.append(b)
    rows = F.col("__rows")
    return WidePlan(s1, s2, aggs, F.inline(F.array(*[b(rows) for b in builders])))


def _tags_column(tag_cols: dict[str, Column], static_tags: dict[str, str] | None) -> Column:
    entries = {k: F.lit(str(v)) for k, v in (static_tags or {}).items()}
    for t, c in tag_cols.items():
        entries[t] = c.cast("string")
    if not entries:
        return F.array().cast(TAGS_TYPE)
    return F.array(*[F.struct(F.lit(k).alias("key"), entries[k].alias("value"))
                     for k in sorted(entries)]).cast(TAGS_TYPE)


def _scan_partitions(df: DataFrame) -> int | None:
    """About how many tasks a plain file scan has; None for any other plan.

    Read from the plan alone: no job runs, and no shuffle stage of ``df``.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    nodes = [line.strip(" +-:") for line in plan.toString().splitlines() if line.strip()]
    if not nodes or not all(n.startswith(("Project", "Filter", "Relation")) for n in nodes):
        return None
    files = len(df.inputFiles())
    if not files:
        return None
    split = df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return max(files, int(str(plan.stats().sizeInBytes())) // split)


def _even_scan(df: DataFrame, target: int) -> bool:
    """Whether the tasks of a plain file scan hold about the same rows, so that ``target`` cores are busy as it is.

    Small splits of a file are empty if its row groups are large.  The rows per task come from the files' footers:
    no column is read.
    """
    if "Filter" in df._jdf.queryExecution().optimizedPlan().toString():
        return False
    rows = df.select(F.spark_partition_id().alias("p")).groupBy("p").count().agg(F.sum("count"), F.max("count")).first()
    return rows[0] is not None and rows[1] * target <= 2 * rows[0]


def spread_input(df: DataFrame, opts: ProfileOptions) -> tuple[DataFrame, int]:
    parts = _scan_partitions(df)
    if parts is None:
        return df, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    target = min(df.sparkSession.sparkContext.defaultParallelism, opts.min_partitions or 256)
    if parts < opts.spread_below and parts < target:
        return (df, target) if _even_scan(df, target) else (df.repartition(target), target)
    return df, parts


def _fanout(parts: int, opts: ProfileOptions) -> int:
    if opts.tree_fanout:
        return opts.tree_fanout
    if parts <= opts.tree_threshold:
        return 1
    return max(2, int(math.sqrt(parts)))


def profile(df: DataFrame, name: str = "dataset", *,
            dataset_timestamp=None,
            time_column: str | None = None,
            grain: str | None = "day",
            tags: list[str] | tuple[str, ...] = (),
            static_tags: dict[str, str] | None = None,
            columns: list[str] | None = None,
            options: ProfileOptions = ProfileOptions(),
            session_id: str | None = None,
            session_timestamp=None) -> DataFrame:
    """Profile ``df`` into the long profile table.

    ``dataset_timestamp`` is a constant (anything ``F.lit`` accepts or a
    Column); ``time_column`` + ``grain`` instead split the data into time
    buckets (``date_trunc(grain, time_column)``; grain None keeps the raw
    value).  ``tags`` are columns whose values split and label the
    profiles; ``static_tags`` are constant labels.  Time and tag columns
    are not profiled themselves.
    """
    tags = list(tags)
    if time_column is not None:
        tcol = F.col(quote(time_column))
        ts = F.date_trunc(grain, tcol) if grain else tcol
    elif isinstance(dataset_timestamp, Column):
        ts = dataset_timestamp
    elif dataset_timestamp is not None:
        ts = F.lit(dataset_timestamp).cast("timestamp")
    else:
        ts = _typed_null(T.TimestampType())
    excluded = set(tags) | ({time_column} if time_column else set())
    fields = [f for f in df.schema.fields
              if f.name not in excluded and (columns is None or f.name in columns)]
    if columns is not None:
        order = {c: k for k, c in enumerate(columns)}
        fields.sort(key=lambda f: order[f.name])

    df, parts = spread_input(df, options)
    fanout = _fanout(parts, options)
    # rows are grouped by the tags' texts, which hash faster than arrays; the array of tags is made once a group
    tag_cols = {t: f"__tag{i}" for i, t in enumerate(tags)}
    base = df.select(ts.alias("__ts"), *[F.col(quote(t)).cast("string").alias(c) for t, c in tag_cols.items()],
                     *[F.col(quote(f.name)) for f in fields])
    keys = ["__ts", *tag_cols.values()]
    if fanout > 1:
        base = base.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(fanout)))
        keys.append("__salt")

    header = [F.lit(name).alias("name"),
              F.lit(session_id).cast("string").alias("session_id"),
              (F.lit(session_timestamp) if session_timestamp is not None
               else _typed_null(T.TimestampType())).cast("timestamp").alias("session_timestamp"),
              F.col("__ts").alias("dataset_timestamp"),
              _tags_column({t: F.col(c) for t, c in tag_cols.items()}, static_tags).alias("tags")]
    if fanout > 1:
        header.append(F.col("__salt"))

    step = max(1, options.columns_per_pass)
    out = None
    for start in range(0, len(fields), step):
        plan = wide_plan(fields[start:start + step], options, first_index=start)
        if time_column is None and not tags and fanout == 1 and not isinstance(dataset_timestamp, Column):
            # one profile whatever the input: an empty frame has rows with count 0
            wide = plan.derive(base.drop(*keys)).agg(*plan.aggs).select("*", ts.alias("__ts"))
        else:
            wide = plan.derive(base).groupBy(*keys).agg(*plan.aggs)
        long = wide.select(*header, plan.to_long)
        if time_column is None and not tags and fanout > 1 and not isinstance(dataset_timestamp, Column):
            # the profile of no rows beside the partial ones: an empty frame has rows with count 0 here too
            nothing = plan.derive(base.drop(*keys).filter(F.lit(False))).agg(*plan.aggs).select(
                "*", ts.alias("__ts"), F.lit(0).alias("__salt"))
            long = long.unionByName(nothing.select(*header, plan.to_long))
        out = long if out is None else out.unionByName(long)
    if out is None:
        raise ValueError("no columns to profile")
    if fanout > 1:
        # At most ``fanout`` partial rows per key: the one-pass bounded merge.
        from tallyframe.operators.merge import merge_bounded
        out = merge_bounded(out.drop("__salt"), by=("name", "session_id", "session_timestamp",
                                                    "dataset_timestamp", "tags", "column"),
                            options=options)
    return out


@dataclass
class ProfilingSession:
    """Builder mirroring ``newProfilingSession(name).withTimeColumn(c).groupBy(..).aggProfiles()``."""

    df: DataFrame
    name: str
    time_column: str | None = None
    grain: str | None = "day"
    group_columns: tuple[str, ...] = ()
    static_tags: dict[str, str] = field(default_factory=dict)
    options: ProfileOptions = ProfileOptions()
    dataset_timestamp: object = None

    def with_time_column(self, column: str, grain: str | None = "day") -> "ProfilingSession":
        return replace(self, time_column=column, grain=grain)

    def group_by(self, *columns: str) -> "ProfilingSession":
        return replace(self, group_columns=tuple(columns))

    def with_tags(self, **tags: str) -> "ProfilingSession":
        return replace(self, static_tags={**self.static_tags, **tags})

    def with_options(self, **kw) -> "ProfilingSession":
        return replace(self, options=replace(self.options, **kw))

    def agg_profiles(self) -> DataFrame:
        return profile(self.df, self.name, time_column=self.time_column, grain=self.grain,
                       tags=self.group_columns, static_tags=self.static_tags,
                       options=self.options, dataset_timestamp=self.dataset_timestamp)


def profiling_session(df: DataFrame, name: str, **kw) -> ProfilingSession:
    return ProfilingSession(df=df, name=name, **kw)


def segment_label(tags: Column | None = None) -> Column:
    """Tags as one ``k=v,k2=v2`` string (keys sorted), for display and SQL twins."""
    tags = F.col("tags") if tags is None else tags
    return F.array_join(F.transform(tags, lambda t: F.concat(t["key"], F.lit("="), t["value"])), ",")
