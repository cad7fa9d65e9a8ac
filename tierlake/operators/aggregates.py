"""Grouped aggregates, orderings and shapes.

All aggregates are algebraic (avg, count), so Spark plans them as a partial
HashAggregate before the shuffle and a final one after: a hot group is combined
map-side and only one row per group and task crosses the network.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.functions.scores import positive
from tierlake.spec import YEAR_COL
from tierlake.widening import fitted, widened_schema


def mean_by_group(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    digits: int = 2,
    name: Callable[[str], str] = lambda c: f"mean_{c}",
) -> DataFrame:
    """Rounded mean of each measure per group (NULLs skipped, zeros counted)."""
    return df.groupBy(*keys).agg(*[F.round(F.avg(c), digits).alias(name(c)) for c in measures])


def count_by_group(df: DataFrame, keys: Sequence[str], name: str = "total") -> DataFrame:
    """Rows per group; a NULL key is its own group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def rank_by_mean(
    df: DataFrame,
    year_col: str,
    place: str,
    score: str,
    mean_name: str,
    count_name: str,
    digits: int = 2,
) -> DataFrame:
    """Mean and count of a score over rows where it is > 0, per (year, place),
    ordered by year, mean descending; place breaks ties so the order is total."""
    return (
        df.where(positive(score))
        .groupBy(year_col, place)
        .agg(F.round(F.avg(score), digits).alias(mean_name), F.count(F.lit(1)).alias(count_name))
        .orderBy(F.col(year_col), F.col(mean_name).desc(), F.col(place))
    )


def value_counts(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    """Frequency of each non-NULL value, most frequent first."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.col(name).desc(), F.col(column))
    )


def table_shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and number of columns."""
    return df.select(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"))


def preview(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in a stated order (TakeOrderedAndProject: top-n per task,
    then a merge of n x tasks rows), so the preview is deterministic."""
    return df.orderBy(*order_by).limit(n)


def union_years(frames: Mapping[int, DataFrame] | Sequence[DataFrame], year_col: str = YEAR_COL, widen: bool = False) -> DataFrame:
    """Concatenate yearly tables by column name; a column one year lacks is NULL. With
    ``widen``, a column whose type drifts takes the widest of its types (``widening``).

    With a mapping, each frame is tagged with its year first. Positional union is
    never used: two years with the same column count but other names would
    silently misalign.
    """
    if isinstance(frames, Mapping):
        parts = [f.withColumn(year_col, F.lit(int(y))) for y, f in sorted(frames.items())]
    else:
        parts = list(frames)
    if not parts:
        raise ValueError("union_years needs at least one frame")
    if widen:
        schema = widened_schema(p.schema for p in parts)
        parts = [fitted(p, schema) for p in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
