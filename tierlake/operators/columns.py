"""Projection, cleaning and predicate operators.

Each is a plain DataFrame -> DataFrame function. Column lists are resolved against
``df.columns`` on the driver (schema only, no job).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.functions.scores import parse_score, positive
from tierlake.spec import YEAR_COL


def present(df: DataFrame, cols: Iterable[str]) -> list[str]:
    """Columns of ``cols`` that ``df`` has, in ``cols`` order, exact-case match."""
    have = set(df.columns)
    return [c for c in cols if c in have]


def select_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Tolerant projection: the allow-list intersected with the columns present."""
    return df.select(*present(df, cols))


def fill_scores(df: DataFrame, scores: Sequence[str], value: float = 0.0) -> DataFrame:
    """Cast each present score to double, absent (NULL) raw value -> ``value``.

    One ``withColumns`` so the plan keeps a single Project.
    """
    cols = present(df, scores)
    if not cols:
        return df
    return df.withColumns({c: parse_score(c, value) for c in cols})


def present_only(df: DataFrame, score: str) -> DataFrame:
    """Rows whose score is > 0: drops absentees (0.0) and unparsable (NULL) values.
    The predicate reaches the Parquet scan as a pushed filter."""
    return df.where(positive(score))


def with_year(df: DataFrame, year: int, name: str = YEAR_COL) -> DataFrame:
    """Tag every row with a constant year (an int column)."""
    return df.withColumn(name, F.lit(int(year)))


def years_having(presence: Mapping[int, Iterable[str]], cols: Iterable[str], need: str = "all") -> list[int]:
    """Years whose raw schema had all (or any) of ``cols``.

    ``presence`` maps year -> columns that year's bronze leaf had; it is built from
    file footers, one entry per year, so it is small.
    """
    cols = list(cols)
    test = all if need == "all" else any
    return sorted(y for y, have in presence.items() if test(c in set(have) for c in cols))


def restrict_years(df: DataFrame, years: Sequence[int], year_col: str = YEAR_COL) -> DataFrame:
    """Keep the given years; on a partitioned layer this becomes partition pruning."""
    return df.where(F.col(year_col).isin([int(y) for y in years]))
