"""All stages in order over one lake layout: ``<lake>/<layer>/<spec.name>``.

The raw layer is either yearly CSV folders (``raw_format="csv"``) or yearly zip
archives (``raw_format="zip"``, read without unpacking).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from tierlake.plans.archives import build_bronze_from_archives
from tierlake.plans.bronze import build_bronze
from tierlake.plans.gold import build_gold
from tierlake.plans.silver import build_silver
from tierlake.sinks.parquet import WriteReport
from tierlake.spec import LakeSpec

STAGES = ("bronze", "silver", "gold")


def layer_path(lake_root: str, layer: str, spec: LakeSpec) -> str:
    return f"{lake_root.rstrip('/')}/{layer}/{spec.name}"


def build_lake(
    spark: SparkSession,
    raw_root: str,
    lake_root: str,
    spec: LakeSpec,
    stages: Sequence[str] = STAGES,
    mode: str = "skip",
    raw_format: str = "csv",
    incremental: bool = False,
    versioned: bool = False,
) -> dict[str, list[WriteReport]]:
    """Run the chosen stages in bronze -> silver -> gold order; returns each stage's
    write reports. ``mode`` applies to bronze (skip finished years or overwrite).

    With ``incremental``, silver and gold are recomputed only for the years that they
    lack in the version of the layer below, whether bronze wrote them in this run or in
    an earlier one that ended early; other years' rows are kept. Layers that are up to
    date report "skipped". With ``versioned``, gold's tables change together by commits."""
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages {sorted(unknown)}; choose from {STAGES}")
    bronze, silver, gold = (layer_path(lake_root, layer, spec) for layer in STAGES)
    out: dict[str, list[WriteReport]] = {}
    years = [] if incremental else None
    if "bronze" in stages:
        ingest = build_bronze_from_archives if raw_format == "zip" else build_bronze
        out["bronze"] = ingest(spark, raw_root, bronze, spec, mode=mode)
    if "silver" in stages:
        out["silver"] = [build_silver(spark, bronze, silver, spec, years=years)]
    if "gold" in stages:
        out["gold"] = build_gold(spark, silver, gold, spec, years=years, versioned=versioned)
    return out
