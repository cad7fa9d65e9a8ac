"""L2: bronze -> silver in one read and one write.

Silver keeps the spec's allow-list, casts scores to double and fills absent scores
with the fill value. Years may differ in their columns; a merged read of the bronze
root shows every column in every year, with NULLs where a year lacked it, and a
naive fill would turn "column absent that year" into a mean of 0. So the fill is
guarded by a presence map read from each year's Parquet footer: a score is parsed
and filled only in years that had it, and stays NULL elsewhere. The map is kept
beside silver (``<silver>_presence.json``, a small metadata file written by the
driver) for the gold stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierlake.functions.scores import is_malformed, is_nan, number, parse_score
from tierlake.operators.columns import years_having
from tierlake.sinks.parquet import WriteReport, write_partitioned
from tierlake.sources.fs import delete, exists, read_years, write_years
from tierlake.sources.layers import leaf_path, leaf_schemas, leaf_versions, leaf_years, read_layer
from tierlake.spec import LakeSpec, YEAR_COL


def presence_path(silver_root: str) -> str:
    return silver_root.rstrip("/") + "_presence.json"


def kept_presence(cols_by_year: Mapping[int, Sequence[str]], spec: LakeSpec) -> dict[int, list[str]]:
    return {int(y): [c for c in spec.keep if c in set(cols)] for y, cols in cols_by_year.items()}


def with_numbers(df: DataFrame, presence: Mapping[int, Sequence[str]], spec: LakeSpec) -> tuple[DataFrame, dict[str, Column]]:
    """The raw frame with the number of each score's text beside it, cast once for all that
    ask for it, and those columns by score."""
    names = {c: f"_number_{c}" for c in spec.scores if years_having(presence, [c])}
    return df.withColumns({n: number(c) for c, n in names.items()}) if names else df, {c: F.col(n) for c, n in names.items()}


def clean_columns(df: DataFrame, presence: Mapping[int, Sequence[str]], spec: LakeSpec, numbers: Mapping[str, Column] | None = None) -> list[Column]:
    """Silver column expressions over a merged raw frame: allow-list order, scores
    parsed and filled only in the years that had them. ``numbers`` are those of
    ``with_numbers``, if ``df`` has them."""
    numbers = numbers or {}
    y = spec.year_col
    all_years = set(presence)
    out = []
    for c in spec.keep:
        having = years_having(presence, [c])
        if not having or c not in df.columns:
            continue
        if c in spec.scores:
            e = parse_score(c, spec.fill_value, numbers.get(c))
            if set(having) != all_years:
                # Absent that year: the union read gives NULL, which must stay NULL.
                e = F.when(F.col(y).isin(having), e)
        else:
            e = F.col(c)  # absent years already read as NULL
        out.append(e.alias(c))
    return out


def quality_metrics(presence: Mapping[int, Sequence[str]], spec: LakeSpec, numbers: Mapping[str, Column] | None = None) -> dict[str, Column]:
    """Per score: raw NULLs filled, raw text that is not a number, NaN text."""
    y, numbers = spec.year_col, numbers or {}
    out = {}
    for c in spec.scores:
        having = years_having(presence, [c])
        if not having:
            continue
        everywhere = set(having) == set(presence)
        among = (lambda e: e) if everywhere else (lambda e, h=having: F.col(y).isin(h) & e)
        out[f"filled_{c}"] = F.sum(among(F.col(c).isNull()).cast("long"))
        out[f"malformed_{c}"] = F.sum(among(is_malformed(c, numbers.get(c))).cast("long"))
        out[f"nan_{c}"] = F.sum(among(is_nan(c, numbers.get(c))).cast("long"))
    return out


def silver_frame(
    spark: SparkSession, bronze_root: str, spec: LakeSpec, years: Sequence[int] | None = None
) -> tuple[DataFrame, dict[int, list[str]], dict[str, Column]]:
    """(silver DataFrame, presence map, quality metrics over the raw columns)."""
    schemas = leaf_schemas(spark, bronze_root, spec.year_col)
    subset = None  # no filter when every year is read
    if years is not None and set(int(v) for v in years) != set(schemas):
        schemas = {y: s for y, s in schemas.items() if y in set(int(v) for v in years)}
        subset = sorted(schemas)
    if not schemas:
        raise FileNotFoundError(f"no bronze years under {bronze_root}")
    presence = kept_presence({y: s.fieldNames() for y, s in schemas.items()}, spec)
    bronze = read_layer(spark, bronze_root, years=subset, year_col=spec.year_col, schemas=schemas)
    return bronze, presence, quality_metrics(presence, spec)


def record_path(root: str) -> str:
    """Which version of each year a layer was built from; written last."""
    return root.rstrip("/") + "_years.json"


def build_silver(
    spark: SparkSession, bronze_root: str, silver_root: str, spec: LakeSpec, years: Sequence[int] | None = None
) -> WriteReport:
    """Write silver partitioned by year and its presence map. Returns the write report
    with the quality counts.

    Without ``years`` every committed bronze year is written. With ``years`` (also an
    empty list) those are, and besides all that silver lacks in bronze's version: years
    of a run that ended early, years ingested again. In either case years that bronze no
    longer has, or that came without rows, leave silver."""
    versions = leaf_versions(spark, bronze_root, spec.year_col)
    record = read_years(spark, record_path(silver_root)) if exists(spark, silver_root) else None
    if years is None or record is None:
        todo = set(versions)
    else:
        todo = {y for y in versions if y in set(int(v) for v in years) or record.get(y) != versions[y]}
    done = {y: v for y, v in (record or {}).items() if y in versions and y not in todo}
    old = load_presence(spark, silver_root, spec.year_col) if done else {}
    # From here on a crash leaves these years marked as not built.
    write_years(spark, record_path(silver_root), done)
    report = WriteReport(f"{spec.name}:silver", silver_root, "skipped", rows=0)
    presence: dict[int, list[str]] = {}
    if todo:
        bronze, presence, _ = silver_frame(spark, bronze_root, spec, sorted(todo))
        bronze, numbers = with_numbers(bronze, presence, spec)
        metrics = quality_metrics(presence, spec, numbers)
        quality = Observation(f"{spec.name}:silver-quality")
        raw = bronze.observe(quality, *[e.alias(k) for k, e in metrics.items()]) if metrics else bronze
        silver = raw.select(*clean_columns(bronze, presence, spec, numbers), F.col(spec.year_col))
        report = write_partitioned(silver, silver_root, spec.year_col, table=f"{spec.name}:silver", years=sorted(todo))
        if metrics:
            report.metrics.update({k: int(v or 0) for k, v in quality.get.items()})
    for y in leaf_years(spark, silver_root, spec.year_col):
        if y not in versions:
            delete(spark, leaf_path(silver_root, y, spec.year_col))
    presence = {**{y: cols for y, cols in old.items() if y in done}, **presence}
    write_years(spark, presence_path(silver_root), presence)
    write_years(spark, record_path(silver_root), {**done, **{y: versions[y] for y in todo}})
    return report


def load_presence(spark: SparkSession, silver_root: str, year_col: str = YEAR_COL) -> dict[int, list[str]]:
    """The presence map (years x kept columns: small by construction)."""
    found = read_years(spark, presence_path(silver_root))
    if found is None:
        raise FileNotFoundError(f"no presence map beside {silver_root}")
    return {y: list(cols) for y, cols in found.items()}
