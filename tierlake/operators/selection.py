"""D9 with model selection: the forest's settings chosen on rows that it was not fitted on.

Rows are split in three by a digest of their ids, the same in every engine: settings are
fitted on the first part and judged on the second by the area under the curve of precision
over recall (average precision, which a rare target does not flatter); the best is fitted
again on both and answers for the third, which took no part in the choice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierlake.operators.models import classify_top
from tierlake.session import run_dir, unsorted_leaves

TEST, VALID = 30, 20


@dataclass(frozen=True)
class Selection:
    """The held-out rows with label, prediction and p_positive; the settings chosen; the
    average precision of every candidate, in the grid's order."""

    scored: DataFrame
    settings: Mapping[str, int]
    precision: tuple[float, ...]


def part_of(id_cols: Sequence[str], test: int = TEST, valid: int = VALID) -> Column:
    """test, valid or train: a fixed share of the rows each."""
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in id_cols]))
    place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100
    return F.when(place < test, "test").when(place < test + valid, "valid").otherwise("train")


def average_precision(scored: DataFrame) -> float:
    """Exact area under precision over recall of (label, p_positive): rows of one probability
    count together. 0 without positives. The forest's probabilities are few, so the running
    sums are over few rows."""
    one = F.col("label") == 1.0
    by_p = scored.groupBy("p_positive").agg(F.count(F.when(one, 1)).alias("pos"), F.count(F.lit(1)).alias("n"))
    above = Window.orderBy(F.desc("p_positive")).rowsBetween(Window.unboundedPreceding, 0)
    steps = by_p.select("pos", F.sum("pos").over(above).alias("tp"), F.sum("n").over(above).alias("taken"))
    row = steps.agg(F.sum(F.col("pos") * F.col("tp") / F.col("taken")).alias("won"), F.sum("pos").alias("pos")).first()
    return float(row.won / row.pos) if row.pos else 0.0


def select_classifier(
    df: DataFrame, id_cols: Sequence[str], features: Sequence[str], label: Column, grid: Sequence[Mapping[str, int]], test: int = TEST, valid: int = VALID, seed: int = 42
) -> Selection:
    """Choose among ``grid`` (settings of ``classify_top``) and score the held-out rows; of
    equal candidates the first wins."""
    if not grid:
        raise ValueError("the grid is empty")
    # Every fit and every judgement goes over the rows several times: their parts and labels
    # are found once, and the rows of each part lie apart, so that a pass reads those it is of.
    spark, path = df.sparkSession, run_dir(df.sparkSession, "selection")
    own = list(dict.fromkeys([*id_cols, *features]))
    rows = df.select(*own, label.cast("double").alias("_label"), part_of(id_cols, test, valid).alias("_part"))
    with unsorted_leaves(spark):
        rows.write.partitionBy("_part").parquet(path)
    rows = spark.read.schema(StructType([*rows.schema.fields])).parquet(path)
    part, target = F.col("_part"), F.col("_label")
    found = []
    for settings in grid:
        scored = classify_top(rows, [*id_cols, "_part"], features, target, train=part == "train", seed=seed, **settings)
        found.append(average_precision(scored.where(part == "valid")))
    best = max(range(len(grid)), key=lambda i: (found[i], -i))
    final = classify_top(rows, [*id_cols, "_part"], features, target, train=part != "test", seed=seed, **grid[best])
    return Selection(final.where(part == "test").drop("_part"), dict(grid[best]), tuple(found))


def confusion(scored: DataFrame) -> DataFrame:
    """(label, prediction, rows)."""
    return scored.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("rows"))


__all__ = ["Selection", "average_precision", "confusion", "part_of", "select_classifier"]
