"""The analyses the source's documentation asks for (D1-D8), as grouped jobs.

Each returns plot- or report-ready rows; none collects data to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.functions.scores import bin_of
from tierlake.operators.joins import join_dimension, join_null_safe, unique_keys
from tierlake.operators.median import exact_medians


def mean_median_by_group(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    digits: int = 2,
    mean_prefix: str = "media_",
    median_prefix: str = "mediana_",
) -> DataFrame:
    """Central tendency per group: rounded mean and exact median per measure.

    Means are one aggregate, all medians one range-sort (``exact_medians``); both have
    one row per group and are merged by a last aggregate, which also holds without keys
    and for groups whose measures are all NULL (median NULL there)."""
    keys = list(keys)
    means = df.groupBy(*keys).agg(*[F.round(F.avg(m), digits).alias(f"{mean_prefix}{m}") for m in measures])
    medians = exact_medians(df, keys, {f"{median_prefix}{m}": m for m in measures})
    medians = medians.select(*keys, *[F.round(f"{median_prefix}{m}", digits).alias(f"{median_prefix}{m}") for m in measures])
    both = means.unionByName(medians, allowMissingColumns=True)
    return both.groupBy(*keys).agg(*[F.max(c).alias(c) for c in both.columns if c not in keys])


def top_groups(df: DataFrame, key: str, measure: str, k: int = 5, digits: int = 2, name: str | None = None) -> DataFrame:
    """The k groups with the highest rounded mean; key breaks ties."""
    name = name or f"media_{measure}"
    return (
        df.groupBy(key)
        .agg(F.round(F.avg(measure), digits).alias(name))
        .orderBy(F.col(name).desc_nulls_last(), F.col(key))
        .limit(k)
    )


def region_compare(
    facts: DataFrame,
    place_key: str,
    measure: str,
    places: DataFrame,
    dim_key: str,
    region_col: str,
    focus: str,
    rest_label: str = "OUTRAS",
    digits: int = 2,
) -> DataFrame:
    """D3: roll places up to regions through a small dimension and compare one region
    with all others: rounded mean and row count per side. Facts without a place, or with
    one that the dimension lacks, count among the others; a place that the dimension has
    twice is an error, since its facts would count twice."""
    dim = places.select(F.col(dim_key).alias(place_key), F.col(region_col).alias("_region"))
    rolled = join_dimension(facts.select(place_key, measure), unique_keys(dim, place_key), on=place_key, how="left")
    label = F.when(F.col("_region") == F.lit(focus), F.lit(focus)).otherwise(F.lit(rest_label))
    return rolled.groupBy(label.alias("grupo")).agg(
        F.round(F.avg(measure), digits).alias(f"media_{measure}"),
        F.count(F.lit(1)).alias("total"),
    )


def corr_external(
    left: DataFrame,
    left_key: str,
    left_measure: str,
    right: DataFrame,
    right_key: str,
    right_measure: str,
    digits: int = 6,
) -> DataFrame:
    """Pearson correlation, across places, of the place mean of one table with a
    place-level measure from another (both sides are first reduced to one row per
    place, so the join is between two small aggregates)."""
    a = left.groupBy(F.col(left_key).alias("_k")).agg(F.avg(left_measure).alias("_x"))
    b = right.groupBy(F.col(right_key).alias("_k")).agg(F.avg(right_measure).alias("_y"))
    return a.join(b, on="_k").agg(F.round(F.corr("_x", "_y"), digits).alias("corr"))


def histogram_by_group(df: DataFrame, group: str, value: str, width: float, name: str = "total") -> DataFrame:
    """Counts per (group, fixed-width bin). NULL values are left out; NaN and infinite
    ones count in the group's NULL bin."""
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(group, bin_of(value, width).alias("bin"))
        .agg(F.count(F.lit(1)).alias(name))
    )


def density_by_group(df: DataFrame, group: str, value: str, width: float, digits: int = 6) -> DataFrame:
    """Histogram plus each bin's share of its group.

    Group totals come from a second aggregate of the histogram (one row per group)
    joined back on the group, rather than a window partitioned by group, which
    would put every bin of a group into one task."""
    hist = histogram_by_group(df, group, value, width, "total")
    totals = hist.groupBy(group).agg(F.sum("total").alias("_group_total"))
    return join_null_safe(hist, totals, [group], how="inner").select(
        group, "bin", "total", F.round(F.col("total") / F.col("_group_total"), digits).alias("share")
    )


def compare_flag(df: DataFrame, flag: str, scores: Sequence[str], digits: int = 4) -> DataFrame:
    """Per flag value, mean and sample standard deviation of each score over the
    rows where it is > 0 (absentees and unparsable values out)."""
    aggs = []
    for s in scores:
        kept = F.when(F.col(s) > 0, F.col(s))
        aggs.append(F.round(F.avg(kept), digits).alias(f"media_{s}"))
        aggs.append(F.round(F.stddev_samp(kept), digits).alias(f"desvio_{s}"))
    return df.groupBy(flag).agg(*aggs)


def abstention_rate(df: DataFrame, keys: Sequence[str], score: str, digits: int = 4, name: str = "taxa_abstencao") -> DataFrame:
    """Share of rows whose score is exactly zero, per demographic cut."""
    zero = (F.col(score) == 0).cast("double")
    return df.groupBy(*keys).agg(F.round(F.avg(zero), digits).alias(name))


__all__ = [
    "mean_median_by_group",
    "top_groups",
    "region_compare",
    "corr_external",
    "histogram_by_group",
    "density_by_group",
    "compare_flag",
    "abstention_rate",
]
