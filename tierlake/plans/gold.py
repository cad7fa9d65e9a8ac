"""L3: silver -> the three gold tables.

* mean table: rounded mean of every score per (year, place), absentees' 0.0
  included, unparsable values skipped; years without the place column or without
  any score are left out; a score a year lacked gives NULL for that year.
* profile table: row count per (year, profile keys), for years with at least one
  profile column.
* ranking table: rounded mean and count of the rank score over rows where it is
  > 0, per (year, place), ordered by year then mean descending (place breaks ties).

The mean and ranking tables share their keys, so both come out of one aggregate
(one scan, one shuffle): the ranking mean is ``avg(when(score > 0, score))`` and its
count ``count(when(score > 0, 1))``, and a group with no positive row is not ranked.
That aggregate has one row per (year, place), so it is cached for the two writes.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.functions.scores import positive
from tierlake.operators.aggregates import count_by_group
from tierlake.operators.columns import restrict_years, years_having
from tierlake.plans.silver import load_presence, record_path
from tierlake.sinks.parquet import WriteReport, write_table
from tierlake.sinks.versions import VersionedTables, is_versioned
from tierlake.sources.fs import delete, exists, read_years, write_years
from tierlake.sources.layers import read_layer
from tierlake.spec import LakeSpec


@dataclass
class GoldPlan:
    """Gold tables by name: sorted (to write), unsorted plus sort order (to merge),
    and the cached shared aggregate to release after the writes."""

    tables: dict[str, DataFrame]
    cached: list[DataFrame] = field(default_factory=list)
    unsorted: dict[str, DataFrame] = field(default_factory=dict)
    orders: dict[str, list] = field(default_factory=dict)

    def add(self, name: str, df: DataFrame, order: list) -> None:
        self.unsorted[name] = df
        self.orders[name] = order
        self.tables[name] = df.orderBy(*order)

    def release(self) -> None:
        for df in self.cached:
            df.unpersist()


def gold_tables(silver: DataFrame, presence: dict[int, list[str]], spec: LakeSpec, cache_shared: bool = False) -> GoldPlan:
    """The gold tables of ``silver`` as lazy DataFrames (sorted and unsorted), for
    the years and columns that ``presence`` says each table may use."""
    y, place, rank = spec.year_col, spec.place, spec.rank_score
    d = spec.digits
    scores_any = [s for s in spec.scores if years_having(presence, [s])]
    mean_years = [
        yr for yr in years_having(presence, [place]) if any(s in presence[yr] for s in spec.scores)
    ]
    rank_years = years_having(presence, [place, rank])
    profile_any = [c for c in spec.profile if years_having(presence, [c])]
    profile_years = years_having(presence, spec.profile, need="any")

    plan = GoldPlan({})
    if mean_years and scores_any:
        aggs = [F.round(F.avg(s), d).alias(spec.mean_name(s)) for s in scores_any]
        has_rank = bool(rank_years) and rank in scores_any
        if has_rank:
            hit = positive(rank) if set(rank_years) == set(mean_years) else positive(rank) & F.col(y).isin(rank_years)
            aggs += [
                F.round(F.avg(F.when(hit, F.col(rank))), d).alias("_rank_mean"),
                F.count(F.when(hit, F.lit(1))).alias("_rank_n"),
            ]
        shared = restrict_years(silver, mean_years, y).groupBy(y, place).agg(*aggs)
        if cache_shared:
            shared = shared.persist(StorageLevel.MEMORY_AND_DISK)
            plan.cached.append(shared)
        means = shared.select(y, place, *[spec.mean_name(s) for s in scores_any])
        plan.add(spec.mean_table, means, [F.col(y), F.col(place)])
        if has_rank:
            mean_col = spec.mean_name(rank)
            ranking = shared.where(F.col("_rank_n") > 0).select(
                y, place, F.col("_rank_mean").alias(mean_col), F.col("_rank_n").alias(spec.rank_count_name)
            )
            plan.add(spec.rank_table, ranking, [F.col(y), F.col(mean_col).desc(), F.col(place)])
    if profile_years and profile_any:
        keys = [y, *profile_any]
        counts = count_by_group(restrict_years(silver, profile_years, y), keys, spec.count_name)
        plan.add(spec.profile_table, counts, [F.col(k) for k in keys])
    return plan


def gold_path(gold_root: str, table: str) -> str:
    return f"{gold_root.rstrip('/')}/{table}"


def read_gold(spark: SparkSession, gold_root: str, table: str) -> DataFrame:
    """A gold table, whether it is kept by commits or as a plain folder."""
    if is_versioned(spark, gold_root):
        return VersionedTables(spark, gold_root).read(table)
    return spark.read.parquet(gold_path(gold_root, table))


class PlainGold:
    """Gold as one folder for each table, swapped one by one; the years' versions beside."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def has(self, name: str) -> bool:
        return exists(self.spark, gold_path(self.root, name))

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(gold_path(self.root, name))

    def record(self) -> dict[int, object]:
        return read_years(self.spark, record_path(self.root)) or {}

    def begin(self, kept: dict[int, object]) -> None:
        write_years(self.spark, record_path(self.root), kept)

    def write(self, df: DataFrame, name: str) -> WriteReport:
        return write_table(df, gold_path(self.root, name), table=name)

    def finish(self, reports: list[WriteReport], stale: list[str], versions: dict[int, object]) -> None:
        for name in stale:
            delete(self.spark, gold_path(self.root, name))
        write_years(self.spark, record_path(self.root), versions)


class CommittedGold:
    """Gold whose tables and years' versions change together, by one commit."""

    def __init__(self, spark: SparkSession, root: str):
        self.store = VersionedTables(spark, root)
        self.base = self.store.current()

    def has(self, name: str) -> bool:
        return self.base is not None and name in self.base.tables

    def read(self, name: str) -> DataFrame:
        return self.store.read(name, self.base.version)

    def record(self) -> dict[int, object]:
        return {int(y): v for y, v in (self.base.meta.get("years", {}) if self.base else {}).items()}

    def begin(self, kept: dict[int, object]) -> None:
        pass  # until the commit nothing of the current version changes

    def write(self, df: DataFrame, name: str) -> WriteReport:
        return self.store.stage(df, name)

    def finish(self, reports: list[WriteReport], stale: list[str], versions: dict[int, object]) -> None:
        self.store.commit(reports, self.base, drop=stale, meta={"years": {str(y): v for y, v in versions.items()}})
        self.store.clean()
        for r in reports:
            r.action = "written"


def build_gold(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    spec: LakeSpec,
    persist_silver: bool = False,
    years=None,
    versioned: bool = False,
) -> list[WriteReport]:
    """Compute and overwrite the gold tables. ``persist_silver`` caches the projected
    silver columns across the writes (helps when silver is re-read from slow
    storage; otherwise pruned Parquet scans are cheaper than a cache of the layer).

    With ``years`` (also an empty list) only those years are recomputed, and besides all
    that gold lacks in silver's version; silver is read with partition pruning, and each
    table keeps its rows of the other years that silver still has. If a table is missing,
    everything is recomputed. The result equals a full rebuild: a table's columns are
    those that all years call for, years whose rows or keys are gone lose theirs, and a
    table that no year supports any more is removed.

    Tables are written beside the old ones and swapped in one by one; with ``versioned``
    all three become visible by one commit (``read_gold`` reads either), so readers never
    find a table missing or tables of two runs. A gold folder is kept the one way or the
    other; one with commits goes on with them."""
    everything = load_presence(spark, silver_root, spec.year_col)
    versions = read_years(spark, record_path(silver_root)) or {}
    store = CommittedGold(spark, gold_root) if versioned or is_versioned(spark, gold_root) else PlainGold(spark, gold_root)
    record = store.record()
    layer = read_layer(spark, silver_root, year_col=spec.year_col)
    whole = gold_tables(layer, everything, spec, cache_shared=not persist_silver)
    missing = [n for n in whole.tables if not store.has(n)]
    if years is None or missing or not record:
        years, presence = None, everything
    else:
        todo = {int(v) for v in years} | {y for y in everything if record.get(y) != versions.get(y)}
        presence = {y: cols for y, cols in everything.items() if y in todo}
    names = (spec.mean_table, spec.rank_table, spec.profile_table)
    stale = [n for n in names if n not in whole.tables and store.has(n)]
    if years is not None and not presence and not stale and set(record) == set(everything):
        whole.release()
        return [WriteReport(n, gold_path(gold_root, n), "skipped") for n in whole.tables]
    store.begin({y: v for y, v in record.items() if years is not None and y not in presence})
    silver = layer if years is None else read_layer(spark, silver_root, years=sorted(presence), year_col=spec.year_col)
    cached = []
    if persist_silver:
        need = [c for c in dict.fromkeys([spec.year_col, spec.place, *spec.scores, *spec.profile]) if c in silver.columns]
        silver = silver.select(*need).persist(StorageLevel.MEMORY_AND_DISK)
        cached.append(silver)
    plan = whole
    if years is not None or persist_silver:
        whole.release()
        plan = gold_tables(silver, presence, spec, cache_shared=True)
    kept_years = sorted(set(everything) - set(presence))

    def write_one(name: str) -> WriteReport:
        if years is None:
            return store.write(plan.tables[name], name)
        merged = store.read(name).where(F.col(spec.year_col).isin(kept_years))
        if name in plan.unsorted:
            merged = merged.unionByName(plan.unsorted[name], allowMissingColumns=True)
        wanted = [
            F.col(f.name) if f.name in merged.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in whole.unsorted[name].schema.fields
        ]
        return store.write(merged.select(*wanted).orderBy(*whole.orders[name]), name)

    def write(chain: list[str]) -> list[WriteReport]:
        return [write_one(n) for n in chain if n in whole.tables]

    # Two independent chains run side by side: the means table fills the cached
    # shared aggregate that the ranking then reads; the profile table is separate.
    chains = [[spec.mean_table, spec.rank_table], [spec.profile_table]]
    try:
        with ThreadPoolExecutor(max_workers=len(chains)) as pool:
            reports = [r for chain in pool.map(write, chains) for r in chain]
        store.finish(reports, stale, {y: versions.get(y) for y in everything})
        return reports
    finally:
        plan.release()
        for df in cached:
            df.unpersist()
