"""Data-quality constraints: value and summary checks.

A constraints document is small JSON parsed once on the driver into
Catalyst predicates; all checking of data runs as Spark aggregates:

* value constraints: every non-null value of a column compared with a
  literal; all of them are counted in ONE aggregate pass over the data;
* summary constraints: a field of the column summary (min, max, mean,
  stddev, count, null_count, ...) compared with a literal or with a second
  field of the same summary; evaluated on profile rows.

Document shape::

    {"valueConstraints": {col: {"constraints": [{name?, value, op, verbose?}]}},
     "summaryConstraints": {col: {"constraints": [{first_field|firstField, op,
                                                   value | second_field, name?}]}}}

The op decides the check; ``name`` is only a label.  Nulls are skipped by
value constraints; a null summary field fails its constraint (own choices).
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.operators.profile import TAGS_TYPE, quote

# Comparison operators of the constraint documents.
OPS = ("LT", "LE", "EQ", "NE", "GE", "GT")

REPORT_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("op", T.StringType()),
])


def compare(left: Column, op: str, right: Column) -> Column:
    op = op.upper()
    if op == "LT":
        return left < right
    if op == "LE":
        return left <= right
    if op == "EQ":
        return left == right
    if op == "NE":
        return left != right
    if op == "GE":
        return left >= right
    if op == "GT":
        return left > right
    raise ValueError(f"unknown op {op!r}; expected one of {OPS}")


@dataclass(frozen=True)
class Constraint:
    kind: str                      # "value" or "summary"
    column: str
    op: str
    value: float | str | None = None
    name: str | None = None
    verbose: bool = False
    first_field: str | None = None
    second_field: str | None = None

    @property
    def label(self) -> str:
        if self.name:
            return self.name
        if self.kind == "value":
            return f"value {self.op} {self.value}"
        rhs = self.second_field if self.second_field else self.value
        return f"summary {self.first_field} {self.op} {rhs}"


def parse_constraints(doc) -> list[Constraint]:
    """Parse a constraints document (dict, JSON text or file path)."""
    if isinstance(doc, str):
        text = doc
        if not doc.lstrip().startswith("{"):
            with open(doc) as fh:
                text = fh.read()
        doc = json.loads(text)
    out: list[Constraint] = []
    for column, spec in (doc.get("valueConstraints") or {}).items():
        for c in spec.get("constraints", []):
            out.append(Constraint("value", column, c["op"].upper(), c.get("value"),
                                  c.get("name"), bool(c.get("verbose", False))))
    for column, spec in (doc.get("summaryConstraints") or {}).items():
        for c in spec.get("constraints", []):
            first = c.get("first_field", c.get("firstField"))
            second = c.get("second_field", c.get("secondField"))
            out.append(Constraint("summary", column, c["op"].upper(), c.get("value"),
                                  c.get("name"), bool(c.get("verbose", False)), first, second))
    return out


def _checked_value(df: DataFrame, c: Constraint) -> Column | None:
    """The value a constraint compares: the numeric view of a text column for a number
    (other text there is skipped, like nulls), text for a text value; None if the column is missing."""
    if c.column not in df.columns:
        return None
    col = F.col(quote(c.column))
    kind = df.schema[c.column].dataType
    if isinstance(c.value, str):
        return col.cast("string")
    return col.try_cast("double") if isinstance(kind, T.StringType) else col


def _not_comparable(df: DataFrame, c: Constraint, x: Column) -> Column:
    """Whether a value is there that the constraint cannot compare (text that is no number)."""
    return F.col(quote(c.column)).isNotNull() & x.isNull()


def _check_counts(df: DataFrame, c: Constraint) -> tuple[Column, Column, Column]:
    """Aggregates of a value constraint: values compared, failures, values that cannot be compared."""
    x = _checked_value(df, c)
    if x is None:
        return (F.count_if(F.lit(False)),) * 3
    return (F.count(x), F.count_if(x.isNotNull() & ~compare(x, c.op, F.lit(c.value))), F.count_if(_not_comparable(df, c, x)))


def value_report(df: DataFrame, constraints: list[Constraint]) -> DataFrame:
    """One row per value constraint: total checked, failures, not_comparable, passed.

    All constraints are counted in a single aggregate over ``df``.  A
    constraint passes if it checked some value and none failed, so a missing
    column and a column without values fail.  ``value`` is null for text values.  ``not_comparable``
    counts values that are no number where a number is asked for; they decide nothing.
    """
    vcs = [c for c in constraints if c.kind == "value"]
    if not vcs:
        return _empty_value_report(df.sparkSession)
    aggs = [a.alias(f"{p}{i}") for i, c in enumerate(vcs) for p, a in zip("tfu", _check_counts(df, c))]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c.label).alias("name"), F.lit(c.column).alias("column"),
                     F.lit(c.op).alias("op"),
                     F.lit(None if isinstance(c.value, str) else float(c.value)).cast("double").alias("value"),
                     F.col(f"t{i}").cast("bigint").alias("total"),
                     F.col(f"f{i}").cast("bigint").alias("failures"),
                     F.col(f"u{i}").cast("bigint").alias("not_comparable"))
            for i, c in enumerate(vcs)]
    return wide.select(F.inline(F.array(*rows))).withColumn(
        "passed", (F.col("total") > 0) & (F.col("failures") == 0))


def _empty_value_report(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "name string, column string, op string, value double, "
                                     "total bigint, failures bigint, not_comparable bigint, passed boolean")


def summary_fields(profile_rows: DataFrame) -> DataFrame:
    """The fields summary constraints may name, one row per profiled column."""
    from tallyframe.operators.summary import stddev_col
    keys = [k for k in ("dataset_timestamp", "tags") if k in profile_rows.columns]
    return profile_rows.select(
        "column", *keys,
        F.struct(
            F.col("count").cast("double").alias("count"),
            F.col("null_count").cast("double").alias("null_count"),
            F.col("n").cast("double").alias("n"),
            F.col("min").alias("min"), F.col("max").alias("max"),
            F.col("mean").alias("mean"), stddev_col().alias("stddev"),
            F.col("type_integral").cast("double").alias("type_integral_count"),
            F.col("type_fractional").cast("double").alias("type_fractional_count"),
            F.col("type_string").cast("double").alias("type_string_count"),
            F.col("type_boolean").cast("double").alias("type_boolean_count"),
        ).alias("f"))


def summary_report(profile_rows: DataFrame, constraints: list[Constraint]) -> DataFrame:
    """One row per summary constraint and profile of its column, with that profile's time and tags.

    A constraint on a column that no profile has gives one failed row.
    """
    scs = [c for c in constraints if c.kind == "summary"]
    spark = profile_rows.sparkSession
    if not scs:
        return spark.createDataFrame([], "name string, column string, first_field string, "
                                         "op string, value double, second_field string, "
                                         "actual double, other double, passed boolean, "
                                         "dataset_timestamp timestamp, tags " + TAGS_TYPE.simpleString())
    spec = spark.createDataFrame(
        [(c.label, c.column, c.first_field, c.op,
          None if c.value is None else float(c.value), c.second_field) for c in scs],
        "name string, column string, first_field string, op string, value double, "
        "second_field string")
    fields = summary_fields(profile_rows)
    for k, t in (("dataset_timestamp", T.TimestampType()), ("tags", TAGS_TYPE)):
        if k not in fields.columns:
            fields = fields.withColumn(k, F.lit(None).cast(t))
    j = spec.join(fields, "column", "left")
    names = [f.name for f in fields.schema["f"].dataType.fields]

    def pick(field: Column) -> Column:
        return reduce(lambda acc, n: F.when(field == n, F.col("f")[n]).otherwise(acc),
                      names, F.lit(None).cast("double"))

    actual = pick(F.col("first_field"))
    other = F.when(F.col("second_field").isNotNull(), pick(F.col("second_field"))) \
        .otherwise(F.col("value"))
    by_op = reduce(lambda acc, op: F.when(F.col("op") == op, compare(actual, op, other))
                   .otherwise(acc), OPS, F.lit(None).cast("boolean"))
    return j.select("name", "column", "first_field", "op", "value", "second_field",
                    actual.alias("actual"), other.alias("other"),
                    F.coalesce(by_op, F.lit(False)).alias("passed"), "dataset_timestamp", "tags")


def failures(df: DataFrame, constraints: list[Constraint], key_columns=(),
             only_verbose: bool = True, limit: int | None = None) -> DataFrame:
    """Failing values of (verbose) value constraints: (name, column, value, keys...).

    The whole failure set is a distributed DataFrame; ``limit`` is an
    optional cap for logging only.
    """
    vcs = [c for c in constraints if c.kind == "value" and (c.verbose or not only_verbose)]
    found = []
    for c in vcs:
        x = _checked_value(df, c)
        if x is not None:
            found.append(F.when(x.isNotNull() & ~compare(x, c.op, F.lit(c.value)), F.struct(
                F.lit(c.label).alias("name"), F.lit(c.column).alias("column"),
                F.col(quote(c.column)).cast("string").alias("value"))))
    if not found:
        return df.sparkSession.createDataFrame([], "name string, column string, value string")
    # one scan: each row's failed checks, filtered inside the array
    out = (df.select(*key_columns, F.explode(F.filter(F.array(*found), lambda f: f.isNotNull())).alias("__f"))
           .select("__f.*", *key_columns))
    return out.limit(limit) if limit else out


def failure_messages(failures_df: DataFrame) -> DataFrame:
    """Log lines, one per failing value."""
    return failures_df.select(F.concat(F.col("column"), F.lit(": "), F.col("value"), F.lit(" fails "),
                                       F.col("name")).alias("message"))


def report(df: DataFrame, profile_rows: DataFrame, constraints: list[Constraint]) -> DataFrame:
    """Value and summary checks in one table: (kind, name, column, op, passed, dataset_timestamp, tags)."""
    v = value_report(df, constraints).select(
        F.lit("value").alias("kind"), "name", "column", "op", "passed",
        F.lit(None).cast("timestamp").alias("dataset_timestamp"), F.lit(None).cast(TAGS_TYPE).alias("tags"))
    s = summary_report(profile_rows, constraints).select(
        F.lit("summary").alias("kind"), "name", "column", "op", "passed", "dataset_timestamp", "tags")
    return v.unionByName(s)


def verdict(report_df: DataFrame, expect_failure: bool = False) -> DataFrame:
    """Overall result; with ``expect_failure`` the action succeeds when a check fails."""
    passed = F.coalesce(F.bool_and("passed"), F.lit(True))   # no constraints: nothing fails
    return report_df.agg(passed.alias("passed")).select(
        "passed", F.lit(expect_failure).alias("expect_failure"),
        (F.col("passed") != F.lit(expect_failure)).alias("action_ok"))


def observe_failures(df: DataFrame, constraints: list[Constraint], name: str = "constraints"):
    """Inline check while writing: returns (observed df, Observation).

    The counts, one per ``<column>: <label>``, arrive with the first action on the
    returned DataFrame (e.g. its write), with no extra pass over the data.
    """
    from pyspark.sql import Observation
    obs = Observation(name)
    exprs = []
    for c in (c for c in constraints if c.kind == "value"):
        x = _checked_value(df, c)
        bad = F.count_if(F.lit(False)) if x is None else F.count_if(x.isNotNull() & ~compare(x, c.op, F.lit(c.value)))
        exprs.append(bad.alias(f"{c.column}: {c.label}"))
    return df.observe(obs, *exprs), obs


def observe_checks(df: DataFrame, constraints: list[Constraint], name: str = "constraints"):
    """Inline value checks: (observed df, read).  ``read()`` after the first action on the returned DataFrame
    gives one tuple per value constraint: name, column, op, number, text, rows, total, failures, not_comparable."""
    from pyspark.sql import Observation
    vcs = [c for c in constraints if c.kind == "value"]
    obs = Observation(name)
    counts = [a.alias(f"{p}{i}") for i, c in enumerate(vcs) for p, a in zip("tfu", _check_counts(df, c))]

    def read():
        got = obs.get
        return [(c.label, c.column, c.op, None if isinstance(c.value, str) else float(c.value), c.value if isinstance(c.value, str) else None,
                 got["rows"], got[f"t{i}"], got[f"f{i}"], got[f"u{i}"]) for i, c in enumerate(vcs)]

    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *counts), read
