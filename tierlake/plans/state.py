"""L3 from stored partial states: gold that a new file of a year adds to without a rescan.

``update_state`` keeps, beside the names of the bronze files that they cover, what the gold
tables add up: per (year, place) the sum and count of every score and of the ranked one where
it is positive, and a quantile sketch; per (year, profile) the row count. Files that no state
covers are read alone, cleaned as silver cleans them, and their partial states merged with the
old ones by one aggregate over a row for each group. A year of which a covered file is gone
(it was ingested again) is read anew, alone. States and file names change together by one
commit, so a run that ends early leaves the old pair and the next one reads the same files
again: every file counts once.

``state_gold`` turns states into the same tables as ``gold_tables`` over the whole silver
layer; means of scores are sums over counts, so they differ from a rebuild's by the order of
additions only, before rounding.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tierlake.functions.scores import positive
from tierlake.operators.columns import restrict_years, years_having
from tierlake.operators.sketches import merged, quantile_of, sketch
from tierlake.plans.gold import GoldPlan
from tierlake.plans.silver import clean_columns, kept_presence
from tierlake.sinks.parquet import WriteReport
from tierlake.sinks.versions import VersionedTables
from tierlake.sources.fs import data_files, exists
from tierlake.sources.layers import STREAM_LOG, leaf_path, leaf_versions, leaf_years, stream_files, union_schema
from tierlake.spec import LakeSpec

FILES, SCORES, PROFILES = "files", "score_states", "profile_states"
#: Sketch size of the stored states.
STATE_K = 1024


def layer_files(spark: SparkSession, root: str, year_col: str) -> DataFrame:
    """(year, name) of a layer's committed data files, whose names are of one write each:
    from the stream's own log if a stream wrote it, else from the listing of its committed
    leaves."""
    root = root.rstrip("/")
    if exists(spark, f"{root}/{STREAM_LOG}"):
        rows = stream_files(spark, root, year_col)
    else:
        leaf_versions(spark, root, year_col)  # raises for a leaf that was not committed
        rows = [(y, name) for y in leaf_years(spark, root, year_col) for name, _ in data_files(spark, leaf_path(root, y, year_col))]
    return spark.createDataFrame(rows, StructType([StructField(year_col, IntegerType()), StructField("name", StringType())]))


def score_states(silver: DataFrame, presence: dict[int, list[str]], spec: LakeSpec) -> DataFrame | None:
    """(year, place, sum_, n_ and sketch_ of each score, rank_sum, rank_n)."""
    y, place, rank = spec.year_col, spec.place, spec.rank_score
    years = [v for v in years_having(presence, [place]) if any(s in presence[v] for s in spec.scores)]
    if not years:
        return None
    aggs = []
    for s in spec.scores:
        value = F.col(s) if s in silver.columns else F.lit(None).cast("double")
        aggs += [F.sum(value).alias(f"sum_{s}"), F.count(value).alias(f"n_{s}"), sketch(value, STATE_K).alias(f"sketch_{s}")]
    ranked = F.when(positive(rank), F.col(rank)) if rank in silver.columns else F.lit(None).cast("double")
    aggs += [F.sum(ranked).alias("rank_sum"), F.count(ranked).alias("rank_n")]
    return restrict_years(silver, years, y).groupBy(y, place).agg(*aggs)


def profile_states(silver: DataFrame, presence: dict[int, list[str]], spec: LakeSpec) -> DataFrame | None:
    """(year, profile columns, rows); columns that a year lacks are NULL in it."""
    years = years_having(presence, spec.profile, need="any")
    if not years:
        return None
    columns = [F.col(c) if c in silver.columns else F.lit(None).cast("string").alias(c) for c in spec.profile]
    rows = restrict_years(silver, years, spec.year_col).select(spec.year_col, *columns)
    return rows.groupBy(spec.year_col, *spec.profile).agg(F.count(F.lit(1)).alias("rows"))


def _merge_scores(states: DataFrame, spec: LakeSpec) -> DataFrame:
    adds = [F.sum(c).alias(c) for s in spec.scores for c in (f"sum_{s}", f"n_{s}")]
    adds += [merged(f"sketch_{s}").alias(f"sketch_{s}") for s in spec.scores]
    return states.groupBy(spec.year_col, spec.place).agg(*adds, F.sum("rank_sum").alias("rank_sum"), F.sum("rank_n").alias("rank_n"))


def _merge_profiles(states: DataFrame, spec: LakeSpec) -> DataFrame:
    return states.groupBy(spec.year_col, *spec.profile).agg(F.sum("rows").alias("rows"))


def update_state(spark: SparkSession, bronze_root: str, state_root: str, spec: LakeSpec) -> WriteReport:
    """Bring the states up to the bronze layer. The report's metrics are the files read and
    the years of them that were read anew; its rows the records that the states then cover."""
    y = spec.year_col
    bronze_root = bronze_root.rstrip("/")
    store = VersionedTables(spark, state_root, y)
    base = store.current()
    now = layer_files(spark, bronze_root, y)
    key = [y, "name"]
    if base is None:
        again, todo = [], now
    else:
        known = store.read(FILES, base.version)
        again = sorted(r[0] for r in known.join(now, key, "left_anti").select(y).distinct().collect())
        todo = now.join(known, key, "left_anti")
        if again:
            todo = todo.unionByName(restrict_years(now, again, y)).distinct()
    # The names of the files to read, as any read of them needs on the driver.
    by_year: dict[int, list[str]] = {}
    for year, name in todo.select(y, "name").collect():
        by_year.setdefault(year, []).append(f"{leaf_path(bronze_root, year, y)}/{name}")
    paths = [p for of_year in by_year.values() for p in of_year]
    report = WriteReport(f"{spec.name}:state", state_root, "skipped", rows=0, metrics={"files": len(paths), "years_again": len(again)})
    if not paths and not again:
        return report
    # One footer for each year that has new files; what the others hold is known.
    schemas = {v: spark.read.option("mergeSchema", "false").parquet(of_year[0]).schema for v, of_year in by_year.items()}
    found = kept_presence({v: s.fieldNames() for v, s in schemas.items()}, spec)
    known_presence = {int(v): cols for v, cols in (base.meta["presence"] if base else {}).items() if int(v) not in again}
    presence = {v: [c for c in spec.keep if c in {*known_presence.get(v, []), *found.get(v, [])}] for v in {*known_presence, *found}}
    staged = []
    kept = lambda name: store.read(name, base.version).where(~F.col(y).isin(again)) if base and name in base.tables else None
    fresh = {}
    if paths:
        bronze = spark.read.schema(union_schema(schemas.values(), y)).option("basePath", bronze_root).parquet(*paths)
        silver = bronze.select(*clean_columns(bronze, found, spec), F.col(y))
        fresh = {SCORES: score_states(silver, found, spec), PROFILES: profile_states(silver, found, spec)}
    for name, merge in ((SCORES, _merge_scores), (PROFILES, _merge_profiles)):
        parts = [p for p in (kept(name), fresh.get(name)) if p is not None]
        if parts:
            whole = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
            metrics = {"records": F.sum("rows")} if name == PROFILES else None
            staged.append(store.stage(merge(whole, spec), name, metrics))
    staged.append(store.stage(now, FILES))
    meta = {"presence": {str(v): cols for v, cols in presence.items()}}
    store.commit(staged, base, meta=meta)
    store.clean()
    report.action = "written"
    report.rows = sum(int(r.metrics["records"] or 0) for r in staged if "records" in r.metrics)
    return report


def state_gold(spark: SparkSession, state_root: str, spec: LakeSpec) -> GoldPlan:
    """The gold tables from the states."""
    y, place, rank, d = spec.year_col, spec.place, spec.rank_score, spec.digits
    store = VersionedTables(spark, state_root, y)
    now = store.current()
    if now is None:
        raise FileNotFoundError(f"no states under {state_root}")
    presence = {int(v): cols for v, cols in now.meta["presence"].items()}
    plan = GoldPlan({})
    scores_any = [s for s in spec.scores if years_having(presence, [s])]
    if SCORES in now.tables and scores_any:
        states = store.read(SCORES, now.version)
        mean = lambda total, n: F.round(F.when(F.col(n) > 0, F.col(total) / F.col(n)), d)
        plan.add(spec.mean_table, states.select(y, place, *[mean(f"sum_{s}", f"n_{s}").alias(spec.mean_name(s)) for s in scores_any]), [F.col(y), F.col(place)])
        if years_having(presence, [place, rank]):
            mean_col = spec.mean_name(rank)
            ranking = states.where(F.col("rank_n") > 0).select(y, place, mean("rank_sum", "rank_n").alias(mean_col), F.col("rank_n").alias(spec.rank_count_name))
            plan.add(spec.rank_table, ranking, [F.col(y), F.col(mean_col).desc(), F.col(place)])
    profile = [c for c in spec.profile if years_having(presence, [c])]
    if PROFILES in now.tables and profile:
        counts = store.read(PROFILES, now.version).groupBy(y, *profile).agg(F.sum("rows").alias(spec.count_name))
        plan.add(spec.profile_table, counts, [F.col(c) for c in (y, *profile)])
    return plan


def state_medians(spark: SparkSession, state_root: str, spec: LakeSpec, keys: Sequence[str] | None = None, prefix: str = "mediana_") -> DataFrame:
    """Sketched medians of every score by (year, place), or by coarser ``keys`` of these:
    years and places merge without a look at the data."""
    keys = list(keys) if keys is not None else [spec.year_col, spec.place]
    states = VersionedTables(spark, state_root, spec.year_col).read(SCORES)
    whole = states.groupBy(*keys).agg(*[merged(f"sketch_{s}").alias(f"sketch_{s}") for s in spec.scores])
    return whole.select(*keys, *[quantile_of(f"sketch_{s}").alias(f"{prefix}{s}") for s in spec.scores])


__all__ = ["layer_files", "state_gold", "state_medians", "update_state"]
