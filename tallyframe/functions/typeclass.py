"""Per-value type classes for mixed-type (text) columns.

A text column may carry integers, decimals, booleans and free text at the
same time (CSV read without inference, JSON props, ...).  Classes are
decided with strict regular expressions evaluated JVM-side: casts are
too lenient (``'1d'`` and ``' 12 '`` cast to numbers) to serve as a
classifier.  The rules are our own choice; the fixed values below must
stay identical in the Spark code and in any SQL twin.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Classifier patterns and class names (own choice).
# Java patterns end in \z (end of input): Java's ``$`` would also match
# before a final newline.  The SQL twins use RE2, where ``$`` means the same.
INTEGRAL_RE = r"^[+-]?[0-9]+\z"
FRACTIONAL_RE = r"^[+-]?([0-9]+\.[0-9]*|\.[0-9]+|[0-9]+)([eE][+-]?[0-9]+)?\z"
INTEGRAL_RE_SQL = r"^[+-]?[0-9]+$"
FRACTIONAL_RE_SQL = r"^[+-]?([0-9]+\.[0-9]*|\.[0-9]+|[0-9]+)([eE][+-]?[0-9]+)?$"
BOOLEAN_WORDS = ("true", "false")
TYPE_CLASSES = ("integral", "fractional", "boolean", "string", "unknown")

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)
INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def is_integral_text(c: Column) -> Column:
    return c.rlike(INTEGRAL_RE)


def is_fractional_text(c: Column) -> Column:
    return c.rlike(FRACTIONAL_RE) & ~c.rlike(INTEGRAL_RE)


def is_boolean_text(c: Column) -> Column:
    # Length guard first: long texts are never lower-cased in full.
    return (F.length(c) <= max(len(w) for w in BOOLEAN_WORDS)) & F.lower(c).isin(*BOOLEAN_WORDS)


def type_class(c: Column, dtype: T.DataType) -> Column:
    """Class name of each value of ``c`` (null for null values)."""
    if isinstance(dtype, INTEGRAL_TYPES):
        cls = F.lit("integral")
    elif isinstance(dtype, NUMERIC_TYPES):
        cls = F.lit("fractional")
    elif isinstance(dtype, T.BooleanType):
        cls = F.lit("boolean")
    elif isinstance(dtype, T.StringType):
        cls = (F.when(is_integral_text(c), "integral")
               .when(is_fractional_text(c), "fractional")
               .when(is_boolean_text(c), "boolean")
               .otherwise("string"))
    else:
        cls = F.lit("unknown")
    return F.when(c.isNotNull(), cls)


def numeric_value(c: Column, dtype: T.DataType) -> Column | None:
    """Double view of the numeric values of ``c``; None if the type has none.

    Text columns contribute the values the classifier calls integral or
    fractional, so an all-string CSV gets the same numeric summary as the
    typed read.
    """
    if isinstance(dtype, NUMERIC_TYPES):
        return c.cast("double")
    if isinstance(dtype, T.StringType):
        return F.when(c.rlike(FRACTIONAL_RE), c.try_cast("double"))
    return None


def inferred_type(counts: dict[str, Column]) -> Column:
    """Largest non-null class; ties go to the earlier class in TYPE_CLASSES.

    ``greatest`` over (count, priority, name) structs compares
    lexicographically, so the count decides and the priority breaks ties.
    """
    k = len(TYPE_CLASSES)
    best = F.greatest(*[
        F.struct(counts[name].alias("n"), F.lit(k - i).alias("p"), F.lit(name).alias("t"))
        for i, name in enumerate(TYPE_CLASSES)])
    return F.when(best["n"] > 0, best["t"]).otherwise(F.lit("null"))
