"""Joins to small dimensions, broadcast only behind a checked size bound."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_ROWS = 200_000
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20


def bounded(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows, and at most ``max_bytes`` counting
    the bytes of its strings and eight for any other value. One aggregate over the
    dimension: each task sends one row of sums, never data rows."""
    sizes = [F.coalesce(F.octet_length(f.name), F.lit(0)) if f.dataType.typeName() in ("string", "binary") else F.lit(8) for f in df.schema.fields]
    size = sum(sizes, F.lit(0)).cast("long")
    probe = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    return probe["n"] <= max_rows and probe["bytes"] <= max_bytes


def unique_keys(dim: DataFrame, key: str) -> DataFrame:
    """``dim``, or an error that names some keys which it has more than once."""
    twice = dim.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) & F.col(key).isNotNull()).limit(5)
    found = [r[0] for r in twice.collect()]
    if found:
        raise ValueError(f"dimension key {key} repeats: {found}")
    return dim


def broadcast_if_small(
    df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES
) -> DataFrame:
    """Mark ``df`` for broadcast only if it is proven small in rows and bytes;
    otherwise leave the choice to the planner (sort-merge, or AQE's own runtime
    size-checked conversion)."""
    return F.broadcast(df) if bounded(df, max_rows, max_bytes) else df


def join_dimension(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str] | str,
    how: str = "inner",
    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Equi-join facts to a dimension, which is broadcast if its size is bounded."""
    return facts.join(broadcast_if_small(dim, max_rows, max_bytes), on=on, how=how)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL matches NULL (NULL is its own group in a groupBy)."""
    keys = list(keys)
    if not keys:
        raise ValueError("join_null_safe needs at least one key")
    lhs, rhs = left.alias("_l"), right.alias("_r")
    cond = [F.col(f"_l.{k}").eqNullSafe(F.col(f"_r.{k}")) for k in keys]
    rest = [c for c in right.columns if c not in keys]
    return lhs.join(rhs, on=cond, how=how).select(
        *[F.col(f"_l.{c}") for c in left.columns], *[F.col(f"_r.{c}") for c in rest]
    )
