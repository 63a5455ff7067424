"""Feature transforms: named Column -> Column functions applied before profiling.

A transform is a callable with a name; the profiled column is named after
it.  Array transforms stay JVM-side (higher-order functions); image pixel
features use one Arrow-batched pandas UDF per image batch.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Feature:
    name: str
    fn: Callable[[Column], Column]

    def __call__(self, c: Column) -> Column:
        return self.fn(c)


REGISTRY: dict[str, Feature] = {}


def register_feature(name: str, fn: Callable[[Column], Column]) -> Feature:
    f = Feature(name, fn)
    REGISTRY[name] = f
    return f


def compose(*features: Feature) -> Feature:
    """Apply in order: compose(a, b)(x) = b(a(x)); named after the last one."""
    def run(c: Column) -> Column:
        for f in features:
            c = f(c)
        return c
    return Feature(features[-1].name, run)


def apply_features(df: DataFrame, source: str, features, keep=()) -> DataFrame:
    """One column per feature, named after it (plus ``keep`` columns)."""
    return df.select(*keep, *[f(F.col(source)).alias(f.name) for f in features])


def avg_value(c: Column) -> Column:
    """Mean over all values of the array (the overall mean, not per channel)."""
    total = F.aggregate(c, F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double"))
    return F.when(F.size(c) > 0, total / F.size(c))


def channel(offset: int, channels: int = 3) -> Callable[[Column], Column]:
    """Values of one interleaved channel (offset 0 of BGR bytes = blue)."""
    return lambda c: F.filter(c, lambda x, i: i % channels == offset)


AvgValue = register_feature("AvgValue", avg_value)
MyBlue = register_feature("MyBlue", channel(0, 3))
