"""K5: a history of write reports, and a gate that stops gold when a year turns bad.

Every silver run adds a row for each (run, year, score) to a history table: rows, and how many
raw values were filled, malformed or NaN. The gate compares a run's years with what the history
says about the others: a share that is above its usual level by more than ``factor`` times and
``margin`` (of all rows) is a breach. A run with a breach leaves gold, and the history that
later runs are judged by, as they were.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.functions.scores import is_malformed, is_nan
from tierlake.operators.columns import years_having
from tierlake.plans.gold import build_gold
from tierlake.plans.silver import build_silver, silver_frame, with_numbers
from tierlake.sinks.parquet import WriteReport
from tierlake.sinks.versions import VersionedTables
from tierlake.spec import LakeSpec

HISTORY = "history"
KINDS = ("filled", "malformed", "nan")


@dataclass(frozen=True)
class GateRule:
    """A share may be ``margin`` above ``factor`` times its usual level; the usual level is
    the median over the other years, 0 if there are fewer than ``least_years`` of them (then
    ``first_margin`` holds)."""

    factor: float = 2.0
    margin: float = 0.05
    first_margin: float = 0.5
    least_years: int = 1


def quality_by_year(spark: SparkSession, bronze_root: str, spec: LakeSpec, years=None) -> DataFrame:
    """(year, score, rows, filled, malformed, nan) of the raw values: one aggregate over
    the bronze layer, a row for each year and score that the year has."""
    bronze, presence, _ = silver_frame(spark, bronze_root, spec, years)
    y = spec.year_col
    scores = [s for s in spec.scores if years_having(presence, [s])]
    if not scores:
        return spark.createDataFrame([], f"{y} int, score string, rows long, filled long, malformed long, nan long")
    count = lambda c: F.count(F.when(c, F.lit(1)))
    bronze, numbers = with_numbers(bronze, presence, spec)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for s in scores:
        n = numbers[s]
        aggs += [count(F.col(s).isNull()).alias(f"filled_{s}"), count(is_malformed(s, n)).alias(f"malformed_{s}"), count(is_nan(s, n)).alias(f"nan_{s}")]
    wide = bronze.groupBy(y).agg(*aggs)
    each = F.array(*[F.struct(F.lit(s).alias("score"), F.col(y).isin(years_having(presence, [s])).alias("has"), *[F.col(f"{k}_{s}").alias(k) for k in KINDS]) for s in scores])
    return wide.select(y, "rows", F.explode(each).alias("e")).where("e.has").select(y, "e.score", "rows", *[f"e.{k}" for k in KINDS])


def breaches(history: DataFrame, now: DataFrame, spec: LakeSpec, rule: GateRule = GateRule()) -> DataFrame:
    """(year, score, kind, share, usual) of the shares in ``now`` that break the rule, judged
    by the history's other years. Both are a row for each year and score."""
    y = spec.year_col

    def shares(df: DataFrame) -> DataFrame:
        each = F.array(*[F.struct(F.lit(k).alias("kind"), (F.col(k) / F.col("rows")).alias("share")) for k in KINDS])
        return df.where("rows > 0").select(y, "score", F.explode(each).alias("e")).select(y, "score", "e.kind", "e.share")

    new, old = shares(now), shares(history).select(F.col(y).alias("_y"), F.col("score").alias("_s"), F.col("kind").alias("_k"), F.col("share").alias("_share"))
    both = new.join(old, (F.col("score") == F.col("_s")) & (F.col("kind") == F.col("_k")) & (F.col(y) != F.col("_y")), "left")
    usual = both.groupBy(y, "score", "kind", "share").agg(F.median("_share").alias("usual"), F.count("_share").alias("_n"))
    known = F.col("_n") >= max(1, rule.least_years)
    limit = F.when(known, F.col("usual") * rule.factor + rule.margin).otherwise(F.lit(rule.first_margin))
    return usual.where(F.col("share") > limit).select(y, "score", "kind", "share", F.when(known, F.col("usual")).alias("usual"))


class QualityGate:
    """Silver and gold behind a gate; the history lies under ``history_root``."""

    def __init__(self, spark: SparkSession, history_root: str, spec: LakeSpec, rule: GateRule = GateRule()):
        self.spark, self.spec, self.rule = spark, spec, rule
        self.store = VersionedTables(spark, history_root, spec.year_col)

    def history(self) -> DataFrame:
        """(year, score, rows, filled, malformed, nan): the last accepted run of every year."""
        if HISTORY in self.store.tables():
            return self.store.read(HISTORY)
        return self.spark.createDataFrame([], f"{self.spec.year_col} int, score string, rows long, filled long, malformed long, nan long")

    def run(self, bronze_root: str, silver_root: str, gold_root: str, **gold) -> tuple[list[WriteReport], list[tuple]]:
        """Build silver, then, if no share of its years breaks the rule, gold and the history.
        Returns the reports and the breaches (a row for each year, score and kind)."""
        y = self.spec.year_col
        reports = [build_silver(self.spark, bronze_root, silver_root, self.spec, years=[])]
        now = quality_by_year(self.spark, bronze_root, self.spec)
        old = self.history()
        # Years as accepted before were judged then; those that differ are judged now.
        changed = now.join(old, now.columns, "left_anti")
        judges = old.join(changed.select(y).distinct(), y, "left_anti")
        # With no accepted year to go by, the run's years judge one another.
        judges = judges.unionByName(now.join(judges.select("score").distinct(), "score", "left_anti").select(*judges.columns))
        found = [tuple(r) for r in breaches(judges, changed, self.spec, self.rule).orderBy(y, "score", "kind").collect()]
        if not found:
            reports += build_gold(self.spark, silver_root, gold_root, self.spec, years=[], **gold)
            self.store.write(now, HISTORY)
        return reports, found


__all__ = ["GateRule", "QualityGate", "breaches", "quality_by_year"]
