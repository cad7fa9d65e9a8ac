"""

Every query reads the driver's tables under ``sf_dir`` (whole tables, every row)
and runs the library's operator path; the lake queries first write the table as a
yearly raw lake into a fresh folder under the session's shared checkpoint folder
and then run the real stages over it. Each oracle restates the same semantics in
DuckDB SQL over the raw tables.
"""

from __future__ import annotations

import json
import sys
import threading
from collections.abc import Callable
from importlib.util import find_spec
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tierlake import fixtures as fx  # noqa: E402
from tierlake.functions.scores import year_of  # noqa: E402
from tierlake.operators import (  # noqa: E402
    abstention_rate,
    compare_flag,
    corr_external,
    count_by_group,
    density_by_group,
    fill_scores,
    histogram_by_group,
    join_dimension,
    mean_by_group,
    mean_median_by_group,
    median_sketch_by_group,
    merge_by_group,
    present_only,
    preview,
    quantile_of,
    rank_bounds,
    rank_by_mean,
    rank_error,
    region_compare,
    select_present,
    sketches_by_group,
    table_shape,
    top_groups,
    union_years,
    value_counts,
    with_year,
)
from tierlake.operators.models import classify_top, cluster_scores, evaluate_clusters, evaluate_top  # noqa: E402
from tierlake.operators.selection import select_classifier  # noqa: E402
from tierlake.plans.gate import QualityGate  # noqa: E402
from tierlake.plans import (  # noqa: E402
    build_bronze,
    build_bronze_from_archives,
    build_lake,
    build_gold,
    build_silver,
    gold_path,
    ingest_rescued,
    load_archives,
    load_archives_typed,
    read_gold,
    read_quarantine,
    state_gold,
    update_state,
)
from tierlake.session import run_dir  # noqa: E402
from tierlake.sinks import VersionedTables, write_leaf, write_partitioned, write_table  # noqa: E402
from tierlake.sources import discover_years, layer_years, leaf_path, read_layer, read_year_csv  # noqa: E402
from tierlake.sources.footers import footers, order_report, sorted_within  # noqa: E402
from tierlake.sources.fs import create_small_text, delete, list_dir, rename, write_small_text  # noqa: E402
from tierlake.spec import DOCUMENTS_SPEC, EXAM_SPEC, LINEITEM_SPEC  # noqa: E402
from tierlake.specfile import read_spec, to_json  # noqa: E402
from tierlake.streaming import ingest_archives_stream, ingest_stream  # noqa: E402



def _has_llm() -> bool:
    """Whether the training-data operators, an optional part, are there. If they are, a
    module that they lack is an error of its own."""
    try:
        return find_spec("tierlake.llm.queries") is not None and find_spec("corpus_pipeline") is not None
    except ModuleNotFoundError:
        return False


llm = corpus_pipeline = None
if _has_llm():
    import corpus_pipeline
    from tierlake.llm import queries as llm

SMOKE_DIR = "/root/testdata/sf0.001"
LI = LINEITEM_SPEC
DOC = DOCUMENTS_SPEC
DRIFT = {1997: ["l_discount"]}
EMPTIED, KEYLESS = 1997, 1996


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lineitem_years(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem").withColumn("ano", year_of("l_shipdate"))


# ---------------------------------------------------------------- lakes (memoised)
# Building a lake writes files; queries over the same lake share one build per
# process. Keys include the input folder, so a new scale builds a new lake.
_LAKES: dict[tuple, str] = {}
_LOCK = threading.Lock()


def _memo(key: tuple, build: Callable[[], str]) -> str:
    with _LOCK:
        if key not in _LAKES:
            _LAKES[key] = build()
        return _LAKES[key]


def lineitem_lake(spark: SparkSession, sf_dir: str, drift: bool = False) -> str:
    """raw CSV -> bronze -> silver -> gold for the whole lineitem table."""

    def build() -> str:
        d = run_dir(spark, "lineitem-lake")
        raw = fx.lineitem_raw(_t(spark, sf_dir, "lineitem"))
        fx.write_raw_csv(spark, raw, f"{d}/raw", LI, "lineitem", drop=DRIFT if drift else None)
        build_bronze(spark, f"{d}/raw", f"{d}/bronze", LI)
        build_silver(spark, f"{d}/bronze", f"{d}/silver", LI)
        build_gold(spark, f"{d}/silver", f"{d}/gold", LI)
        return d

    return _memo(("lineitem", sf_dir, drift, spark.sparkContext.applicationId), build)


def exam_lake(spark: SparkSession, sf_dir: str) -> str:
    """The exam source's own spec, end to end over the whole lineitem table."""

    def build() -> str:
        d = run_dir(spark, "exam-lake")
        fx.write_raw_csv(spark, fx.exam_raw(_t(spark, sf_dir, "lineitem")), f"{d}/raw", EXAM_SPEC, "survey")
        build_lake(spark, f"{d}/raw", f"{d}/lake", EXAM_SPEC)
        return f"{d}/lake"

    return _memo(("exam", sf_dir, spark.sparkContext.applicationId), build)


def _exam_gold(spark, sf_dir):
    return f"{exam_lake(spark, sf_dir)}/gold/{EXAM_SPEC.name}"


def _exam_silver(spark, sf_dir):
    return read_layer(spark, f"{exam_lake(spark, sf_dir)}/silver/{EXAM_SPEC.name}")


def documents_raw_lake(spark: SparkSession, sf_dir: str) -> str:
    def build() -> str:
        d = run_dir(spark, "documents-raw")
        raw = fx.documents_raw(_t(spark, sf_dir, "documents"))
        fx.write_raw_csv(spark, raw, f"{d}/raw", DOC, "docs", max_records_per_file=5000)
        return d

    return _memo(("documents-raw", sf_dir, spark.sparkContext.applicationId), build)


def orders_layer(spark: SparkSession, sf_dir: str) -> str:
    def build() -> str:
        d = run_dir(spark, "orders-layer")
        orders = _t(spark, sf_dir, "orders").withColumn("ano", year_of("o_orderdate"))
        write_partitioned(orders, f"{d}/orders", "ano", table="orders")
        return f"{d}/orders"

    return _memo(("orders-layer", sf_dir, spark.sparkContext.applicationId), build)


# ---------------------------------------------------------------- queries
def q_mean_by_group(spark, sf_dir):
    li = _lineitem_years(spark, sf_dir)
    return mean_by_group(li, ["ano", LI.place], LI.scores, LI.digits, LI.mean_name).orderBy("ano", LI.place)


def q_count_by_group(spark, sf_dir):
    li = _lineitem_years(spark, sf_dir)
    return count_by_group(li, ["ano", *LI.profile], LI.count_name).orderBy("ano", *LI.profile)


def q_rank_by_mean(spark, sf_dir):
    li = _lineitem_years(spark, sf_dir)
    return rank_by_mean(li, "ano", LI.place, LI.rank_score, LI.mean_name(LI.rank_score), LI.rank_count_name)


def q_fill_scores(spark, sf_dir):
    raw = fx.lineitem_raw(_t(spark, sf_dir, "lineitem"))
    return fill_scores(raw, LI.scores, LI.fill_value)


def q_value_counts(spark, sf_dir):
    return value_counts(_lineitem_years(spark, sf_dir), "ano")


def q_union_years(spark, sf_dir):
    cust = _t(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("mktsegment"),
    )
    supp = _t(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"),
        F.col("s_acctbal").alias("acctbal"),
    )
    return union_years({2022: cust, 2023: supp})


def q_mean_median_by_group(spark, sf_dir):
    return mean_median_by_group(_t(spark, sf_dir, "orders"), ["o_orderpriority"], ["o_totalprice"])


def q_mean_median_by_group_sorted(spark, sf_dir):
    """D1 over several measures of one sort, some with NaN and NULL, without keys."""
    li = _t(spark, sf_dir, "lineitem").withColumn("l_quantity", F.when(F.col("l_linenumber") != 7, F.col("l_quantity")))
    return mean_median_by_group(li, [], ["l_quantity", "l_extendedprice", "l_linenumber"])


def q_histogram_unplaced(spark, sf_dir):
    """D5 with NaN measures: their own NULL bin, so the totals are all rows."""
    li = _t(spark, sf_dir, "lineitem").withColumn("l_tax", F.when(F.col("l_linenumber") == 7, F.lit(float("nan"))).otherwise(F.col("l_tax") * 1e14))
    return histogram_by_group(li, "l_returnflag", "l_tax", 1e3)


def q_density_unplaced(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").withColumn("l_tax", F.when(F.col("l_linenumber") == 7, F.lit(float("nan"))).otherwise(F.col("l_tax")))
    return density_by_group(li, "l_returnflag", "l_tax", 0.02)


def q_region_compare_unmatched(spark, sf_dir):
    """D3 with facts whose place is absent or unknown: they count among the others."""
    key = F.when(F.col("c_custkey") % 5 == 0, F.lit(None)).when(F.col("c_custkey") % 5 == 1, F.lit(-1)).otherwise(F.col("c_nationkey"))
    places = join_dimension(
        _t(spark, sf_dir, "nation"),
        _t(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey"),
        on="n_regionkey",
    )
    facts = _t(spark, sf_dir, "customer").withColumn("place", key)
    return region_compare(facts, "place", "c_acctbal", places, "n_nationkey", "r_name", "ASIA")


def q_top_groups(spark, sf_dir):
    return top_groups(_t(spark, sf_dir, "customer"), "c_nationkey", "c_acctbal", k=5)


def q_histogram_by_group(spark, sf_dir):
    return histogram_by_group(_t(spark, sf_dir, "orders"), "o_orderstatus", "o_totalprice", 50000)


def q_density_by_group(spark, sf_dir):
    return density_by_group(_t(spark, sf_dir, "orders"), "o_orderstatus", "o_totalprice", 50000)


def q_abstention_rate(spark, sf_dir):
    return abstention_rate(_t(spark, sf_dir, "lineitem"), [LI.place], "l_tax")


def q_corr_external(spark, sf_dir):
    return corr_external(
        _t(spark, sf_dir, "customer"), "c_nationkey", "c_acctbal", _t(spark, sf_dir, "supplier"), "s_nationkey", "s_acctbal"
    )


def q_region_compare(spark, sf_dir):
    places = join_dimension(
        _t(spark, sf_dir, "nation"),
        _t(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey"),
        on="n_regionkey",
    )
    return region_compare(_t(spark, sf_dir, "customer"), "c_nationkey", "c_acctbal", places, "n_nationkey", "r_name", "ASIA")


def q_compare_flag(spark, sf_dir):
    return compare_flag(_t(spark, sf_dir, "lineitem"), "l_linestatus", LI.scores)


def q_select_present(spark, sf_dir):
    allow = ["o_orderkey", "O_CUSTKEY", "o_orderstatus", "o_totalprice", "o_comment", "o_orderpriority"]
    return select_present(_t(spark, sf_dir, "orders"), allow)


def q_filter_present(spark, sf_dir):
    return present_only(_t(spark, sf_dir, "lineitem"), "l_tax").select("l_orderkey", "l_linenumber", "l_tax")


def q_with_year(spark, sf_dir):
    return with_year(_t(spark, sf_dir, "supplier"), 2024)


def q_preview(spark, sf_dir):
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    return preview(_t(spark, sf_dir, "orders").select(*cols), ["o_orderkey"], 5)


def q_table_shape(spark, sf_dir):
    return table_shape(_t(spark, sf_dir, "orders"))


_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "ano"]


def q_scan_year(spark, sf_dir):
    return read_layer(spark, orders_layer(spark, sf_dir), years=[1995]).select(*_ORDER_COLS)


def q_scan_all(spark, sf_dir):
    return read_layer(spark, orders_layer(spark, sf_dir)).select(*_ORDER_COLS)


def q_layer_years(spark, sf_dir):
    return layer_years(spark, orders_layer(spark, sf_dir))


def q_sink_partitioned(spark, sf_dir):
    d = run_dir(spark, "sink-partitioned")
    li = _lineitem_years(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_quantity", "ano")
    write_partitioned(li, f"{d}/t", "ano", table="lineitem")
    # Rewrite one year with dynamic partition overwrite: the others must stay intact
    # and that year must not double.
    write_partitioned(li.where(F.col("ano") == 1997), f"{d}/t", "ano", table="lineitem")
    return read_layer(spark, f"{d}/t")


def q_sink_table(spark, sf_dir):
    d = run_dir(spark, "sink-table")
    write_table(q_mean_by_group(spark, sf_dir), f"{d}/means", table="means")
    return spark.read.parquet(f"{d}/means")


def q_write_metrics(spark, sf_dir):
    d = lineitem_lake(spark, sf_dir)
    rep = build_silver(spark, f"{d}/bronze", f"{d}/silver-again", LI)
    row = {"rows": rep.rows, **rep.metrics}
    cols = list(row)
    return spark.createDataFrame([tuple(int(row[c]) for c in cols)], ", ".join(f"{c} long" for c in cols))


def _yearly_csv_union(spark, raw_root):
    return union_years({y: read_year_csv(spark, p, DOC.dialect) for y, p in discover_years(spark, raw_root, DOC)})


def q_src_csv(spark, sf_dir):
    return _yearly_csv_union(spark, f"{documents_raw_lake(spark, sf_dir)}/raw")


def q_bronze_roundtrip(spark, sf_dir):
    d = run_dir(spark, "bronze-roundtrip")
    build_bronze(spark, f"{documents_raw_lake(spark, sf_dir)}/raw", f"{d}/bronze", DOC)
    return read_layer(spark, f"{d}/bronze")


def q_ingest_skip(spark, sf_dir):
    """Years arrive in two batches; the second run ingests only the new years."""
    d = run_dir(spark, "ingest-skip")
    raw = fx.documents_raw(_t(spark, sf_dir, "documents"))
    years = sorted(int(r[0]) for r in raw.select("ano").distinct().collect())
    first, second = years[: len(years) // 2], years[len(years) // 2 :]
    fx.write_raw_csv(spark, raw, f"{d}/raw", DOC, "docs", years=first, max_records_per_file=5000)
    build_bronze(spark, f"{d}/raw", f"{d}/bronze", DOC)
    fx.write_raw_csv(spark, raw, f"{d}/raw2", DOC, "docs", years=second, max_records_per_file=5000)
    for e in list_dir(spark, f"{d}/raw2"):
        rename(spark, e.path, f"{d}/raw/{e.name}")
    reports = build_bronze(spark, f"{d}/raw", f"{d}/bronze", DOC, mode="skip")
    skipped = sorted(r.year for r in reports if r.action == "skipped")
    if skipped != first:
        raise AssertionError(f"expected years {first} to be skipped, got {skipped}")
    return read_layer(spark, f"{d}/bronze")


def q_src_zip(spark, sf_dir):
    d = run_dir(spark, "src-zip")
    raw = fx.documents_raw(_t(spark, sf_dir, "documents"))
    fx.write_raw_zips(raw, f"{d}/zips", DOC, "docs").collect()
    return load_archives(spark, f"{d}/zips", DOC)


def q_src_zip_typed(spark, sf_dir):
    """Raw survey archives cleaned as silver: scores parsed and filled."""
    d = run_dir(spark, "src-zip-typed")
    fx.write_raw_zips(fx.lineitem_raw(_t(spark, sf_dir, "lineitem")), f"{d}/zips", LI, "lineitem").collect()
    return load_archives_typed(spark, f"{d}/zips", LI)


def q_src_zip_year(spark, sf_dir):
    """A filter on the year opens that year's archives only."""
    d = run_dir(spark, "src-zip-year")
    fx.write_raw_zips(fx.lineitem_raw(_t(spark, sf_dir, "lineitem")), f"{d}/zips", LI, "lineitem").collect()
    return load_archives(spark, f"{d}/zips", LI).where(F.col("ano") == 1996)


def q_bronze_from_zip(spark, sf_dir):
    """Raw zip archives straight to bronze, year by year, then read back."""
    d = run_dir(spark, "bronze-from-zip")
    raw = fx.documents_raw(_t(spark, sf_dir, "documents"))
    fx.write_raw_zips(raw, f"{d}/zips", DOC, "docs").collect()
    build_bronze_from_archives(spark, f"{d}/zips", f"{d}/bronze", DOC)
    reports = build_bronze_from_archives(spark, f"{d}/zips", f"{d}/bronze", DOC)
    if any(r.action != "skipped" for r in reports):
        raise AssertionError("second run must skip every committed year")
    return read_layer(spark, f"{d}/bronze")


def q_stream_ingest(spark, sf_dir):
    d = run_dir(spark, "stream-ingest")
    raw = fx.lineitem_raw(_t(spark, sf_dir, "lineitem"))
    years = sorted(int(r[0]) for r in raw.select("ano").distinct().collect())
    half = years[: len(years) // 2]
    # First run sees half the years; the second run must add only the rest.
    fx.write_raw_csv(spark, raw, f"{d}/raw", LI, "lineitem", years=half)
    ingest_stream(spark, f"{d}/raw", f"{d}/bronze", f"{d}/_checkpoint", LI)
    fx.write_raw_csv(spark, raw, f"{d}/raw2", LI, "lineitem", years=[y for y in years if y not in half])
    for e in list_dir(spark, f"{d}/raw2"):
        rename(spark, e.path, f"{d}/raw/{e.name}")
    ingest_stream(spark, f"{d}/raw", f"{d}/bronze", f"{d}/_checkpoint", LI)
    return spark.read.parquet(f"{d}/bronze")


def changed_lake(spark: SparkSession, sf_dir: str) -> str:
    """A lake over the whole lineitem table that grew and changed by incremental runs:
    half of the years, then the rest with a run that ended after bronze, then a gold
    table lost, then one year emptied and one without its place column."""

    def build() -> str:
        d = run_dir(spark, "changed-lake")
        raw = fx.lineitem_raw(_t(spark, sf_dir, "lineitem"))
        years = sorted(int(r[0]) for r in raw.select("ano").distinct().collect())
        half = years[: len(years) // 2]
        fx.write_raw_csv(spark, raw, f"{d}/raw", LI, "lineitem", years=half)
        build_lake(spark, f"{d}/raw", f"{d}/lake", LI, incremental=True)
        rest = [y for y in years if y not in half]
        fx.write_raw_csv(spark, raw, f"{d}/more", LI, "lineitem", years=rest)
        for e in list_dir(spark, f"{d}/more"):
            rename(spark, e.path, f"{d}/raw/{e.name}")
        build_lake(spark, f"{d}/raw", f"{d}/lake", LI, stages=["bronze"])
        build_lake(spark, f"{d}/raw", f"{d}/lake", LI, incremental=True)
        delete(spark, gold_path(f"{d}/lake/gold/{LI.name}", LI.profile_table))
        fx.write_raw_csv(spark, raw.where(F.col("ano") != EMPTIED), f"{d}/new", LI, "lineitem", years=[KEYLESS], drop={KEYLESS: [LI.place]})
        for y in (EMPTIED, KEYLESS):
            delete(spark, f"{d}/raw/lineitem_{y}")
            delete(spark, leaf_path(f"{d}/lake/bronze/{LI.name}", y, LI.year_col))
        rename(spark, f"{d}/new/lineitem_{KEYLESS}", f"{d}/raw/lineitem_{KEYLESS}")
        header = LI.dialect.sep.join(c for c in raw.columns if c != "ano")
        write_small_text(spark, LI.raw_files(f"{d}/raw/lineitem_{EMPTIED}", EMPTIED)[0], header + "\n")
        build_lake(spark, f"{d}/raw", f"{d}/lake", LI, incremental=True)
        return f"{d}/lake"

    return _memo(("changed", sf_dir, spark.sparkContext.applicationId), build)


def _changed_gold(spark, sf_dir, table):
    return spark.read.parquet(gold_path(f"{changed_lake(spark, sf_dir)}/gold/{LI.name}", table))


def q_incremental_gold(spark, sf_dir):
    return _changed_gold(spark, sf_dir, LI.mean_table)


def q_incremental_profile(spark, sf_dir):
    return _changed_gold(spark, sf_dir, LI.profile_table)


def q_incremental_ranking(spark, sf_dir):
    return _changed_gold(spark, sf_dir, LI.rank_table)


def q_incremental_silver(spark, sf_dir):
    return read_layer(spark, f"{changed_lake(spark, sf_dir)}/silver/{LI.name}")


def q_silver_layer(spark, sf_dir):
    return read_layer(spark, f"{lineitem_lake(spark, sf_dir)}/silver")


def q_gold_means(spark, sf_dir):
    return spark.read.parquet(gold_path(f"{lineitem_lake(spark, sf_dir)}/gold", LI.mean_table))


def q_gold_profile(spark, sf_dir):
    return spark.read.parquet(gold_path(f"{lineitem_lake(spark, sf_dir)}/gold", LI.profile_table))


def q_gold_ranking(spark, sf_dir):
    return spark.read.parquet(gold_path(f"{lineitem_lake(spark, sf_dir)}/gold", LI.rank_table))


def q_drift_gold(spark, sf_dir):
    return spark.read.parquet(gold_path(f"{lineitem_lake(spark, sf_dir, drift=True)}/gold", LI.mean_table))


def q_drift_silver(spark, sf_dir):
    return read_layer(spark, f"{lineitem_lake(spark, sf_dir, drift=True)}/silver")


def q_exam_gold_means(spark, sf_dir):
    return spark.read.parquet(gold_path(_exam_gold(spark, sf_dir), EXAM_SPEC.mean_table))


def q_exam_gold_profile(spark, sf_dir):
    return spark.read.parquet(gold_path(_exam_gold(spark, sf_dir), EXAM_SPEC.profile_table))


def q_exam_gold_ranking(spark, sf_dir):
    return spark.read.parquet(gold_path(_exam_gold(spark, sf_dir), EXAM_SPEC.rank_table))


def q_exam_abstention_by_sex(spark, sf_dir):
    """D8 over the exam lake's silver layer: share of zero essays per sex."""
    return abstention_rate(_exam_silver(spark, sf_dir), ["TP_SEXO"], "NU_NOTA_REDACAO")


def q_exam_mean_median_by_age(spark, sf_dir):
    """D1 over the exam lake's silver layer: mean and exact median per age band."""
    return mean_median_by_group(_exam_silver(spark, sf_dir), ["TP_FAIXA_ETARIA"], ["NU_NOTA_CN"])


def q_exam_mean_median_by_school(spark, sf_dir):
    """D1 over two scores of one sort: the gap between the kinds of school."""
    return mean_median_by_group(_exam_silver(spark, sf_dir), ["TP_ESCOLA"], ["NU_NOTA_MT", "NU_NOTA_REDACAO"])


def q_exam_histogram_by_race(spark, sf_dir):
    return histogram_by_group(_exam_silver(spark, sf_dir), "TP_COR_RACA", "NU_NOTA_CN", 10)


def q_exam_density_by_marital(spark, sf_dir):
    return density_by_group(_exam_silver(spark, sf_dir), "TP_ESTADO_CIVIL", "NU_NOTA_CN", 10)


def q_exam_trial_takers(spark, sf_dir):
    """Trial takers against the others, all five scores."""
    return compare_flag(_exam_silver(spark, sf_dir), "IN_TREINEIRO", EXAM_SPEC.scores)


def q_exam_region_compare(spark, sf_dir):
    """D3: one place's region against all others; one place is not in the dimension."""
    silver = _exam_silver(spark, sf_dir)
    places = silver.where("SG_UF_PROVA != 'N'").select(F.col("SG_UF_PROVA").alias("uf"), F.concat(F.lit("R-"), "SG_UF_PROVA").alias("region")).distinct()
    return region_compare(silver, "SG_UF_PROVA", "NU_NOTA_MT", places, "uf", "region", "R-A")


def q_ml_classify_eval(spark, sf_dir):
    """D9 judged on rows it was not fitted on: which rows lack a readable tax."""
    silver = read_layer(spark, f"{lineitem_lake(spark, sf_dir)}/silver")
    return evaluate_top(silver, ["l_orderkey", "l_linenumber"], [LI.place, "l_linestatus", "l_linenumber"], F.col("l_tax").isNull())


def q_ml_cluster_eval(spark, sf_dir):
    silver = read_layer(spark, f"{lineitem_lake(spark, sf_dir)}/silver")
    return evaluate_clusters(silver, ["l_orderkey", "l_linenumber"], LI.scores, k=4)


def q_ml_model_selection(spark, sf_dir):
    """D9 with settings chosen by average precision: the answer for every held-out row. The
    target follows from the profile, so a right model answers as the rows themselves do."""
    silver = read_layer(spark, f"{lineitem_lake(spark, sf_dir)}/silver")
    grid = [{"num_trees": 1, "max_depth": 0}, {"num_trees": 5, "max_depth": 4}]
    found = select_classifier(silver, ["l_orderkey", "l_linenumber"], [LI.place, "l_linestatus", "l_linenumber"], F.col("l_tax").isNull(), grid)
    return found.scored.select("l_orderkey", "l_linenumber", F.col("prediction").cast("int").alias("predicted"))


def q_ml_classify(spark, sf_dir):
    silver = read_layer(spark, f"{lineitem_lake(spark, sf_dir)}/silver")
    return classify_top(
        silver,
        ["l_orderkey", "l_linenumber"],
        [LI.place, "l_linestatus", "l_linenumber"],
        (F.col("l_tax") >= 0.08),
    )


def q_ml_cluster(spark, sf_dir):
    silver = read_layer(spark, f"{lineitem_lake(spark, sf_dir)}/silver")
    return cluster_scores(silver, ["l_orderkey", "l_linenumber"], LI.scores, k=4)


def q_sink_versioned(spark, sf_dir):
    """K2 by commits: the table as committed, after writes that stopped at each step."""
    store = VersionedTables(spark, run_dir(spark, "sink-versioned"))
    li = _lineitem_years(spark, sf_dir)
    store.write(mean_by_group(li.where("l_quantity < 10"), ["ano", LI.place], LI.scores, LI.digits, LI.mean_name), "means")
    store.write(q_mean_by_group(spark, sf_dir), "means")
    store.stage(li.groupBy("ano").count(), "means")  # stopped before its commit
    half = store.current().to_json().replace('"version": 2', '"version": 3')[:-20]
    create_small_text(spark, f"{store.root}/_commits/0000000003.json", half)  # stopped within it
    return store.read("means")


def q_sink_versioned_years(spark, sf_dir):
    """K1 by commits: every year, one of them written again, one staged and not committed."""
    store = VersionedTables(spark, run_dir(spark, "sink-versioned-years"))
    li = _lineitem_years(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_quantity", "ano")
    years = sorted(int(r[0]) for r in li.select("ano").distinct().collect())
    store.write_years(li.withColumn("l_quantity", -F.col("l_quantity")), years)
    store.write_years(li, years[1:])
    store.write_years(li, years[:1])
    store.stage_years(li.where("l_quantity > 40"), years)
    return store.read_years()


def q_versioned_gold(spark, sf_dir):
    """L3 by one commit for all tables, after an incremental run that ended between them."""
    d = run_dir(spark, "versioned-gold")
    silver = f"{lineitem_lake(spark, sf_dir)}/silver"
    build_gold(spark, silver, f"{d}/gold", LI, versioned=True)
    VersionedTables(spark, f"{d}/gold").stage(read_layer(spark, silver).limit(1), LI.rank_table)
    years = sorted(r[0] for r in layer_years(spark, silver).collect())
    build_gold(spark, silver, f"{d}/gold", LI, years=years[-1:])
    return read_gold(spark, f"{d}/gold", LI.rank_table)


def q_median_sketch_by_group(spark, sf_dir):
    """D1's sketch option judged by exact ranks: sketches of each year, kept as a table, and
    the same merged over the years; is each median's rank within the bound?"""
    d = run_dir(spark, "median-sketch")
    li, k = _lineitem_years(spark, sf_dir), 1024
    sketches_by_group(li, ["ano", LI.place], {"s": "l_extendedprice"}, k).write.parquet(f"{d}/sketches")
    stored = spark.read.parquet(f"{d}/sketches")
    by_year = stored.select("ano", LI.place, quantile_of("s").alias("m"))
    over_years = merge_by_group(stored, [LI.place], ["s"]).select(LI.place, quantile_of("s").alias("m"))
    one_pass = median_sketch_by_group(li, [LI.place], ["l_extendedprice"], k).withColumnRenamed("mediana_l_extendedprice", "m")
    within = (F.col("below") <= F.col("n") * (0.5 + rank_error(k))) & (F.col("upto") >= F.col("n") * (0.5 - rank_error(k)))
    out = []
    for kind, keys, found in (("year", ["ano", LI.place], by_year), ("merged", [LI.place], over_years), ("one pass", [LI.place], one_pass)):
        bounds = rank_bounds(li, keys, "l_extendedprice", found, "m")
        year = F.col("ano") if "ano" in keys else F.lit(0)
        out.append(bounds.select(F.lit(kind).alias("kind"), year.alias("ano"), LI.place, "n", within.cast("int").alias("within")))
    return out[0].unionByName(out[1]).unionByName(out[2])


def state_lake(spark: SparkSession, sf_dir: str) -> str:
    """Partial states of a bronze layer that a stream filled in two batches: the first half
    of every year's orders, then the other half as new files of the same years."""

    def build() -> str:
        d = run_dir(spark, "state-lake")
        raw = fx.lineitem_raw(_t(spark, sf_dir, "lineitem"))
        half = F.col("l_orderkey").cast("long") % 2
        for i in (0, 1):
            fx.write_raw_csv(spark, raw.where(half == i), f"{d}/new{i}", LI, "lineitem")
            for e in list_dir(spark, f"{d}/new{i}"):
                year = int(e.name[-4:])
                target = LI.raw_files(f"{d}/raw/{e.name}", year)[0]
                for f in list_dir(spark, LI.raw_files(e.path, year)[0]):
                    if f.name.endswith(".csv"):
                        rename(spark, f.path, f"{target}/{f.name}")
            ingest_stream(spark, f"{d}/raw", f"{d}/bronze", f"{d}/_checkpoint", LI)
            report = update_state(spark, f"{d}/bronze", f"{d}/state", LI)
            if report.metrics["years_again"]:
                raise AssertionError("new files of a year must add to its states")
        return f"{d}/state"

    return _memo(("state", sf_dir, spark.sparkContext.applicationId), build)


def q_gold_from_state(spark, sf_dir):
    return state_gold(spark, state_lake(spark, sf_dir), LI).tables[LI.mean_table]


def q_profile_from_state(spark, sf_dir):
    return state_gold(spark, state_lake(spark, sf_dir), LI).tables[LI.profile_table]


def q_ranking_from_state(spark, sf_dir):
    return state_gold(spark, state_lake(spark, sf_dir), LI).tables[LI.rank_table]


def q_src_csv_rescued(spark, sf_dir):
    """S1 with quarantine: kept records, as lines again, and quarantined ones with their
    reason; together they are the raw lines."""
    d = run_dir(spark, "src-csv-rescued")
    raw = fx.lineitem_raw(_t(spark, sf_dir, "lineitem"))
    header = [c for c in raw.columns if c != LI.year_col]
    fx.write_raw_lines(spark, fx.broken_lines(raw, LI), header, f"{d}/raw", LI, "lineitem")
    ingest_rescued(spark, f"{d}/raw", f"{d}/bronze", f"{d}/side", LI)
    kept = read_layer(spark, f"{d}/bronze")
    line = F.concat_ws(LI.dialect.sep, *[F.coalesce(F.col(c), F.lit("")) for c in header])
    side = read_quarantine(spark, f"{d}/side", LI.year_col)
    return kept.select("ano", F.lit("kept").alias("outcome"), line.alias("line")).unionByName(
        side.select("ano", F.col("reason").alias("outcome"), F.col("text").alias("line"))
    )


def q_src_zip_absent_year(spark, sf_dir):
    """A filter on a year that no archive is of gives no rows."""
    d = run_dir(spark, "src-zip-absent")
    fx.write_raw_zips(fx.lineitem_raw(_t(spark, sf_dir, "lineitem")), f"{d}/zips", LI, "lineitem").collect()
    rows = load_archives(spark, f"{d}/zips", LI)
    both = rows.where(F.col("ano") == 2999).unionByName(rows.where(F.col("ano").isin(2999, 1995)))
    return both.groupBy("ano").agg(F.count(F.lit(1)).alias("total"))


def q_stream_archives(spark, sf_dir):
    """Archives that arrive over time: half of the years, then the others, then a restart."""
    d = run_dir(spark, "stream-archives")
    raw = fx.lineitem_raw(_t(spark, sf_dir, "lineitem"))
    years = sorted(int(r[0]) for r in raw.select("ano").distinct().collect())
    late = years[::2]
    fx.write_raw_zips(raw.where(~F.col("ano").isin(late)), f"{d}/zips", LI, "lineitem").collect()
    ingest_archives_stream(spark, f"{d}/zips", f"{d}/bronze", f"{d}/_checkpoint", LI)
    fx.write_raw_zips(raw.where(F.col("ano").isin(late)), f"{d}/zips", LI, "late").collect()
    for _ in range(2):
        ingest_archives_stream(spark, f"{d}/zips", f"{d}/bronze", f"{d}/_checkpoint", LI)
    return spark.read.parquet(f"{d}/bronze")


def q_union_years_widened(spark, sf_dir):
    """U2 with type drift: a value that is an int, a double and a text in three years, through
    a layer of those years."""
    d = run_dir(spark, "widened")
    cust, supp, orders = (_t(spark, sf_dir, n) for n in ("customer", "supplier", "orders"))
    frames = {
        2021: cust.select(F.col("c_custkey").cast("int").alias("key"), F.col("c_nationkey").alias("value")),
        2022: supp.select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("value"), F.col("s_name").alias("name")),
        2023: orders.select(F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("value")),
    }
    for y, df in frames.items():
        write_leaf(df, f"{d}/layer", y)
    stored, direct = read_layer(spark, f"{d}/layer", widen=True), union_years(frames, widen=True)
    if sorted(stored.dtypes) != sorted(direct.dtypes):
        raise AssertionError(f"{stored.dtypes} and {direct.dtypes} must be alike")
    return stored


def q_gold_file_order(spark, sf_dir):
    """O1-O3 by footers and rows: each gold table's files hold its rows in order."""
    gold, out = f"{lineitem_lake(spark, sf_dir)}/gold", []
    mean = LI.mean_name(LI.rank_score)
    orders = {
        LI.mean_table: [("ano", False), (LI.place, False)],
        LI.rank_table: [("ano", False), (mean, True), (LI.place, False)],
        LI.profile_table: [(c, False) for c in ("ano", *LI.profile)],
    }
    for table, order in orders.items():
        path = gold_path(gold, table)
        by_footer = order_report(footers(spark, path), order[0][0]).select("rows", "ordered")
        breaks = sorted_within(spark, path, order).select(F.col("rows").alias("_n"), "breaks")
        same = by_footer.join(breaks, F.col("rows") == F.col("_n"))
        out.append(same.select(F.lit(table).alias("table_name"), "rows", "ordered", "breaks"))
    return out[0].unionByName(out[1]).unionByName(out[2])


def q_codec_report(spark, sf_dir):
    """K4 by footers: the codec of every column chunk of the silver layer."""
    found = footers(spark, f"{lineitem_lake(spark, sf_dir)}/silver")
    columns = F.countDistinct("column")
    return found.groupBy("codec").agg(columns.alias("columns"), (F.sum("rows") / columns).cast("long").alias("rows"))


def q_quality_gate(spark, sf_dir):
    """K5: a year ingested again with unreadable scores does not reach gold."""
    d = run_dir(spark, "quality-gate")
    raw = fx.lineitem_raw(_t(spark, sf_dir, "lineitem"))
    fx.write_raw_csv(spark, raw, f"{d}/raw", LI, "lineitem")
    build_bronze(spark, f"{d}/raw", f"{d}/bronze", LI)
    gate = QualityGate(spark, f"{d}/history", LI)
    layers = (f"{d}/bronze", f"{d}/silver", f"{d}/gold")
    if gate.run(*layers)[1]:
        raise AssertionError("the whole lake must pass its gate")
    bad = raw.where(F.col("ano") == KEYLESS).withColumn("l_tax", F.lit("n/a"))
    fx.write_raw_csv(spark, bad, f"{d}/new", LI, "lineitem")
    delete(spark, f"{d}/raw/lineitem_{KEYLESS}")
    rename(spark, f"{d}/new/lineitem_{KEYLESS}", f"{d}/raw/lineitem_{KEYLESS}")
    delete(spark, leaf_path(f"{d}/bronze", KEYLESS, LI.year_col))
    build_bronze(spark, f"{d}/raw", f"{d}/bronze", LI)
    found = gate.run(*layers)[1]
    if [b[:3] for b in found] != [(KEYLESS, "l_tax", "malformed")]:
        raise AssertionError(f"the bad year must be a breach: {found}")
    return spark.read.parquet(gold_path(f"{d}/gold", LI.rank_table))


def q_spec_file_gold(spark, sf_dir):
    """A source that is given by a file alone, through all stages."""
    d = run_dir(spark, "spec-file")
    body = {"base": "exam", **{k: v for k, v in json.loads(to_json(LI)).items() if v != json.loads(to_json(EXAM_SPEC))[k]}, "name": "from_file"}
    write_small_text(spark, f"{d}/source.json", json.dumps(body))
    spec = read_spec(spark, f"{d}/source.json")
    fx.write_raw_csv(spark, fx.lineitem_raw(_t(spark, sf_dir, "lineitem")), f"{d}/raw", spec, "lineitem")
    build_lake(spark, f"{d}/raw", f"{d}/lake", spec)
    return spark.read.parquet(gold_path(f"{d}/lake/gold/from_file", spec.mean_table))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: rounded score means per (year, place) over sf0.001 lineitem."""
    return q_mean_by_group(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    more = {**llm.queries(), "pipeline": corpus_pipeline.run} if llm else {}
    return {
        **more,
        "mean_by_group": q_mean_by_group,
        "count_by_group": q_count_by_group,
        "rank_by_mean": q_rank_by_mean,
        "fill_scores": q_fill_scores,
        "value_counts": q_value_counts,
        "union_years": q_union_years,
        "mean_median_by_group": q_mean_median_by_group,
        "mean_median_by_group_sorted": q_mean_median_by_group_sorted,
        "top_groups": q_top_groups,
        "histogram_by_group": q_histogram_by_group,
        "density_by_group": q_density_by_group,
        "abstention_rate": q_abstention_rate,
        "corr_external": q_corr_external,
        "region_compare": q_region_compare,
        "compare_flag": q_compare_flag,
        "select_present": q_select_present,
        "filter_present": q_filter_present,
        "with_year": q_with_year,
        "preview": q_preview,
        "table_shape": q_table_shape,
        "scan_year": q_scan_year,
        "scan_all": q_scan_all,
        "layer_years": q_layer_years,
        "sink_partitioned": q_sink_partitioned,
        "sink_table": q_sink_table,
        "write_metrics": q_write_metrics,
        "src_csv": q_src_csv,
        "bronze_roundtrip": q_bronze_roundtrip,
        "ingest_skip": q_ingest_skip,
        "src_zip": q_src_zip,
        "bronze_from_zip": q_bronze_from_zip,
        "stream_ingest": q_stream_ingest,
        "silver_layer": q_silver_layer,
        "gold_means": q_gold_means,
        "gold_profile": q_gold_profile,
        "gold_ranking": q_gold_ranking,
        "drift_silver": q_drift_silver,
        "drift_gold": q_drift_gold,
        "exam_gold_means": q_exam_gold_means,
        "exam_gold_profile": q_exam_gold_profile,
        "exam_gold_ranking": q_exam_gold_ranking,
        "exam_abstention_by_sex": q_exam_abstention_by_sex,
        "exam_mean_median_by_age": q_exam_mean_median_by_age,
        "histogram_unplaced": q_histogram_unplaced,
        "density_unplaced": q_density_unplaced,
        "region_compare_unmatched": q_region_compare_unmatched,
        "src_zip_typed": q_src_zip_typed,
        "src_zip_year": q_src_zip_year,
        "incremental_gold": q_incremental_gold,
        "incremental_profile": q_incremental_profile,
        "incremental_ranking": q_incremental_ranking,
        "incremental_silver": q_incremental_silver,
        "exam_mean_median_by_school": q_exam_mean_median_by_school,
        "exam_histogram_by_race": q_exam_histogram_by_race,
        "exam_density_by_marital": q_exam_density_by_marital,
        "exam_trial_takers": q_exam_trial_takers,
        "exam_region_compare": q_exam_region_compare,
        "ml_classify_eval": q_ml_classify_eval,
        "ml_cluster_eval": q_ml_cluster_eval,
        "sink_versioned": q_sink_versioned,
        "sink_versioned_years": q_sink_versioned_years,
        "versioned_gold": q_versioned_gold,
        "median_sketch_by_group": q_median_sketch_by_group,
        "gold_from_state": q_gold_from_state,
        "profile_from_state": q_profile_from_state,
        "ranking_from_state": q_ranking_from_state,
        "src_csv_rescued": q_src_csv_rescued,
        "src_zip_absent_year": q_src_zip_absent_year,
        "stream_archives": q_stream_archives,
        "union_years_widened": q_union_years_widened,
        "gold_file_order": q_gold_file_order,
        "codec_report": q_codec_report,
        "quality_gate": q_quality_gate,
        "spec_file_gold": q_spec_file_gold,
        "ml_model_selection": q_ml_model_selection,
        "ml_classify": q_ml_classify,
        "ml_cluster": q_ml_cluster,
    }


# ---------------------------------------------------------------- oracles
_YEAR_LI = "cast(year(l_shipdate) as int)"


def _raw_score(c: str) -> str:
    return f"case when l_linenumber = 7 then 'x' when {c} <> 0 then cast({c} as varchar) end as {c}"


_LI_RAW = f"""
  select {_YEAR_LI} as ano,
         cast(l_orderkey as varchar) as l_orderkey,
         cast(l_linenumber as varchar) as l_linenumber,
         l_returnflag, l_linestatus,
         {_raw_score('l_quantity')}, {_raw_score('l_extendedprice')},
         {_raw_score('l_discount')}, {_raw_score('l_tax')}
  from lineitem"""


def _fill(c: str, absent_year: int | None = None) -> str:
    rule = f"case when {c} is null then 0.0::double else try_cast({c} as double) end"
    if absent_year is not None:
        rule = f"case when ano = {absent_year} then null else {rule} end"
    return f"{rule} as {c}"


def _silver_sql(drift: bool = False) -> str:
    dy = 1997 if drift else None
    return f"""
  with raw as ({_LI_RAW})
  select l_orderkey, l_linenumber, l_returnflag, l_linestatus,
         {_fill('l_quantity')}, {_fill('l_extendedprice')},
         {_fill('l_discount', dy)}, {_fill('l_tax')}, ano
  from raw"""


_MEANS = ", ".join(
    f"round(avg({c}), 2) as media_{c[2:]}" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
)

_DOCS_RAW = r"""
  select cast(doc_id as varchar) as doc_id, text, lang, source, cast(n_chars as varchar) as n_chars,
         2000 + cast(regexp_extract(source, '(\d+)$', 1) as int) as ano
  from documents"""

_EXAM_SILVER = f"""
  select {_YEAR_LI} as ano, l_returnflag as SG_UF_PROVA, cast(l_suppkey % 5 as varchar) as TP_ESTADO_CIVIL,
         cast(l_partkey % 6 as varchar) as TP_COR_RACA, cast(l_suppkey % 3 as varchar) as TP_ESCOLA,
         cast(l_orderkey % 2 as varchar) as IN_TREINEIRO, cast(l_linenumber as varchar) as TP_FAIXA_ETARIA, l_linestatus as TP_SEXO,
         {', '.join(f"case when l_linenumber <> 7 then {e} end as NU_NOTA_{n}" for n, e in (("CN", "l_quantity"), ("CH", "l_extendedprice"), ("LC", "l_discount"), ("MT", "round(l_discount * 100, 0)"), ("REDACAO", "l_tax")))}
  from lineitem"""

_QUALITY = ", ".join(
    f"sum(case when {c} is null then 1 else 0 end)::bigint as filled_{c}, "
    f"sum(case when {c} is not null and try_cast({c} as double) is null then 1 else 0 end)::bigint as malformed_{c}, "
    f"sum(case when isnan(try_cast({c} as double)) then 1 else 0 end)::bigint as nan_{c}"
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
)

_ORDERS_LAYER = "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, cast(year(o_orderdate) as int) as ano from orders"


def oracle_sql() -> dict[str, str]:
    more = {**llm.oracle_sql(), "pipeline": corpus_pipeline.ORACLE_SQL} if llm else {}
    li_means = f"select {_YEAR_LI} as ano, l_returnflag, {_MEANS} from lineitem group by all"
    return {
        **{name: sql for name, sql in more.items() if sql},
        "mean_by_group": li_means,
        "count_by_group": f"select {_YEAR_LI} as ano, l_returnflag, l_linestatus, l_linenumber, count(*) as total from lineitem group by all",
        "rank_by_mean": f"select {_YEAR_LI} as ano, l_returnflag, round(avg(l_tax), 2) as media_tax, count(*) as total from lineitem where l_tax > 0 group by all",
        "fill_scores": f"with raw as ({_LI_RAW}) select ano, l_orderkey, l_linenumber, l_returnflag, l_linestatus, "
        f"{_fill('l_quantity')}, {_fill('l_extendedprice')}, {_fill('l_discount')}, {_fill('l_tax')} from raw",
        "value_counts": f'select {_YEAR_LI} as ano, count(*) as "count" from lineitem group by all',
        "union_years": """
            select 2022 as ano, c_custkey as key, c_name as name, c_nationkey as nationkey, c_acctbal as acctbal, c_mktsegment as mktsegment from customer
            union all by name
            select 2023 as ano, s_suppkey as key, s_name as name, s_nationkey as nationkey, s_acctbal as acctbal from supplier""",
        "mean_median_by_group": "select o_orderpriority, round(avg(o_totalprice), 2) as media_o_totalprice, "
        "round(median(o_totalprice), 2) as mediana_o_totalprice from orders group by all",
        "mean_median_by_group_sorted": """
            with s as (select case when l_linenumber <> 7 then l_quantity end as l_quantity, l_extendedprice, l_linenumber from lineitem)
            select """
        + ", ".join(
            f"round(avg({c}), 2) as media_{c}, round(median({c}::double), 2) as mediana_{c}"
            for c in ("l_quantity", "l_extendedprice", "l_linenumber")
        )
        + " from s",
        "histogram_unplaced": """
            with s as (select l_returnflag, case when l_linenumber <> 7 then cast(floor(l_tax * 1e14 / 1e3) as bigint) end as bin from lineitem)
            select l_returnflag, bin, count(*) as total from s group by all""",
        "density_unplaced": """
            with s as (select l_returnflag, case when l_linenumber <> 7 then cast(floor(l_tax / 0.02) as bigint) end as bin from lineitem),
                 h as (select l_returnflag, bin, count(*) as total from s group by all)
            select l_returnflag, bin, total, round(total / sum(total) over (partition by l_returnflag), 6) as share from h""",
        "region_compare_unmatched": """
            with f as (select case when c_custkey % 5 = 0 then null when c_custkey % 5 = 1 then -1 else c_nationkey end as place, c_acctbal from customer),
                 d as (select n_nationkey, r_name from nation join region on n_regionkey = r_regionkey)
            select case when r_name = 'ASIA' then 'ASIA' else 'OUTRAS' end as grupo, round(avg(c_acctbal), 2) as media_c_acctbal, count(*) as total
            from f left join d on place = n_nationkey group by all""",
        "src_zip_typed": _silver_sql(),
        "src_zip_year": f"select * from ({_LI_RAW}) where ano = 1996",
        "incremental_gold": f"select ano, l_returnflag, {_MEANS} from ({_silver_sql()}) where ano not in ({EMPTIED}, {KEYLESS}) group by all",
        "incremental_profile": f"""select ano, case when ano <> {KEYLESS} then l_returnflag end as l_returnflag, l_linestatus, l_linenumber, count(*) as total
            from ({_silver_sql()}) where ano <> {EMPTIED} group by all""",
        "incremental_ranking": f"""select ano, l_returnflag, round(avg(l_tax), 2) as media_tax, count(*) as total
            from ({_silver_sql()}) where l_tax > 0 and ano not in ({EMPTIED}, {KEYLESS}) group by all""",
        "incremental_silver": f"select * replace (case when ano <> {KEYLESS} then l_returnflag end as l_returnflag) from ({_silver_sql()}) where ano <> {EMPTIED}",
        "exam_mean_median_by_school": f"""with s as ({_EXAM_SILVER}) select TP_ESCOLA, round(avg(NU_NOTA_MT), 2) as media_NU_NOTA_MT,
                round(median(NU_NOTA_MT), 2) as mediana_NU_NOTA_MT, round(avg(NU_NOTA_REDACAO), 2) as media_NU_NOTA_REDACAO,
                round(median(NU_NOTA_REDACAO), 2) as mediana_NU_NOTA_REDACAO from s group by all""",
        "exam_histogram_by_race": f"with s as ({_EXAM_SILVER}) select TP_COR_RACA, cast(floor(NU_NOTA_CN / 10) as bigint) as bin, count(*) as total from s where NU_NOTA_CN is not null group by all",
        "exam_density_by_marital": f"""with s as ({_EXAM_SILVER}),
                 h as (select TP_ESTADO_CIVIL, cast(floor(NU_NOTA_CN / 10) as bigint) as bin, count(*) as total from s where NU_NOTA_CN is not null group by all)
            select TP_ESTADO_CIVIL, bin, total, round(total / sum(total) over (partition by TP_ESTADO_CIVIL), 6) as share from h""",
        "exam_trial_takers": f"with s as ({_EXAM_SILVER}) select IN_TREINEIRO, "
        + ", ".join(
            f"round(avg({c}) filter (where {c} > 0), 4) as media_{c}, round(stddev_samp({c}) filter (where {c} > 0), 4) as desvio_{c}"
            for c in EXAM_SPEC.scores
        )
        + " from s group by all",
        "exam_region_compare": f"""with s as ({_EXAM_SILVER}) select case when SG_UF_PROVA = 'A' then 'R-A' else 'OUTRAS' end as grupo,
            round(avg(NU_NOTA_MT), 2) as media_NU_NOTA_MT, count(*) as total from s group by all""",
        "ml_classify_eval": f"""with s as ({_silver_sql()}),
                 h as (select * from s where ('0x' || substr(md5(l_orderkey || '|' || l_linenumber), 1, 8))::bigint % 100 < 30)
            select count(*) as rows, count(*) filter (where l_tax is null) as positives, true as adds_up, true as beats_majority from h""",
        "ml_model_selection": f"""with s as ({_silver_sql()})
            select l_orderkey, l_linenumber, cast(l_tax is null as int) as predicted from s
            where ('0x' || substr(md5(l_orderkey || '|' || l_linenumber), 1, 8))::bigint % 100 < 30""",
        "ml_cluster_eval": f"""with s as ({_silver_sql()})
            select count(*) as rows, count(*) filter (where l_quantity + l_extendedprice + l_discount + l_tax is not null) as placed,
                   4::bigint as clusters, 0::bigint as misplaced from s""",
        "sink_versioned": li_means,
        "sink_versioned_years": f"select l_orderkey, l_linenumber, l_quantity, {_YEAR_LI} as ano from lineitem",
        "versioned_gold": f"with s as ({_silver_sql()}) select ano, l_returnflag, round(avg(l_tax), 2) as media_tax, count(*) as total from s where l_tax > 0 group by all",
        "median_sketch_by_group": f"""
            select 'year' as kind, {_YEAR_LI} as ano, l_returnflag, count(*) as n, 1 as within from lineitem group by all
            union all select k, 0, l_returnflag, n, 1
            from (select unnest(['merged', 'one pass']) as k, * from (select l_returnflag, count(*) as n from lineitem group by all))""",
        "gold_from_state": f"with s as ({_silver_sql()}) select ano, l_returnflag, {_MEANS} from s group by all",
        "profile_from_state": f"with s as ({_silver_sql()}) select ano, l_returnflag, l_linestatus, l_linenumber, count(*) as total from s group by all",
        "ranking_from_state": f"with s as ({_silver_sql()}) select ano, l_returnflag, round(avg(l_tax), 2) as media_tax, count(*) as total from s where l_tax > 0 group by all",
        "src_csv_rescued": f"""
            with r as ({_LI_RAW}),
                 t as (select *, concat_ws(';', l_orderkey, l_linenumber, l_returnflag, l_linestatus) as head,
                              concat_ws(';', coalesce(l_quantity, ''), coalesce(l_extendedprice, ''), coalesce(l_discount, ''), coalesce(l_tax, '')) as tail from r)
            select ano, case l_linenumber when '6' then 'short' when '5' then 'long' else 'kept' end as outcome,
                   case l_linenumber when '6' then head when '5' then head || ';' || tail || ';more;' else head || ';' || tail end as line
            from t""",
        "src_zip_absent_year": f"select {_YEAR_LI} as ano, count(*) as total from lineitem where year(l_shipdate) = 1995 group by all",
        "stream_archives": _LI_RAW,
        "union_years_widened": r"""
            select cast(c_custkey as bigint) as key, cast(c_nationkey as varchar) as value, null::varchar as name, 2021 as ano from customer
            union all select s_suppkey, regexp_replace(cast(s_acctbal as varchar), '\.0$', ''), s_name, 2022 from supplier
            union all select o_orderkey, o_orderpriority, null, 2023 from orders""",
        "gold_file_order": f"""
            with s as ({_silver_sql()})
            select '{LI.mean_table}' as table_name, count(*) as rows, 1 as ordered, 0::bigint as breaks from (select distinct ano, l_returnflag from s)
            union all select '{LI.rank_table}', count(*), 1, 0 from (select distinct ano, l_returnflag from s where l_tax > 0)
            union all select '{LI.profile_table}', count(*), 1, 0 from (select distinct ano, l_returnflag, l_linestatus, l_linenumber from s)""",
        "codec_report": "select 'SNAPPY' as codec, 8::bigint as columns, count(*) as rows from lineitem",
        "quality_gate": f"with s as ({_silver_sql()}) select ano, l_returnflag, round(avg(l_tax), 2) as media_tax, count(*) as total from s where l_tax > 0 group by all",
        "spec_file_gold": f"with s as ({_silver_sql()}) select ano, l_returnflag, {_MEANS} from s group by all",
        "top_groups": "select c_nationkey, round(avg(c_acctbal), 2) as media_c_acctbal from customer group by all "
        "order by media_c_acctbal desc, c_nationkey limit 5",
        "histogram_by_group": "select o_orderstatus, cast(floor(o_totalprice / 50000) as bigint) as bin, count(*) as total from orders group by all",
        "density_by_group": """
            with h as (select o_orderstatus, cast(floor(o_totalprice / 50000) as bigint) as bin, count(*) as total from orders group by all)
            select o_orderstatus, bin, total, round(total / sum(total) over (partition by o_orderstatus), 6) as share from h""",
        "abstention_rate": "select l_returnflag, round(avg(cast(l_tax = 0 as double)), 4) as taxa_abstencao from lineitem group by all",
        "corr_external": """
            with a as (select c_nationkey as k, avg(c_acctbal) as x from customer group by all),
                 b as (select s_nationkey as k, avg(s_acctbal) as y from supplier group by all)
            select round(corr(x, y), 6) as corr from a join b using (k)""",
        "region_compare": """
            select case when r.r_name = 'ASIA' then 'ASIA' else 'OUTRAS' end as grupo,
                   round(avg(c.c_acctbal), 2) as media_c_acctbal, count(*) as total
            from customer c join nation n on c.c_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey
            group by all""",
        "compare_flag": "select l_linestatus, "
        + ", ".join(
            f"round(avg({c}) filter (where {c} > 0), 4) as media_{c}, round(stddev_samp({c}) filter (where {c} > 0), 4) as desvio_{c}"
            for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
        )
        + " from lineitem group by all",
        "select_present": "select o_orderkey, o_orderstatus, o_totalprice, o_orderpriority from orders",
        "filter_present": "select l_orderkey, l_linenumber, l_tax from lineitem where l_tax > 0",
        "with_year": "select *, 2024 as ano from supplier",
        "preview": "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders order by o_orderkey limit 5",
        "table_shape": "select count(*) as rows, 6 as columns from orders",
        "scan_year": f"select * from ({_ORDERS_LAYER}) where ano = 1995",
        "scan_all": _ORDERS_LAYER,
        "layer_years": "select distinct cast(year(o_orderdate) as int) as ano from orders",
        "sink_partitioned": f"select l_orderkey, l_linenumber, l_quantity, {_YEAR_LI} as ano from lineitem",
        "sink_table": li_means,
        "write_metrics": f"with raw as ({_LI_RAW}) select count(*) as rows, {_QUALITY} from raw",
        "src_csv": _DOCS_RAW,
        "bronze_roundtrip": _DOCS_RAW,
        "ingest_skip": _DOCS_RAW,
        "src_zip": _DOCS_RAW,
        "bronze_from_zip": _DOCS_RAW,
        "stream_ingest": _LI_RAW,
        "silver_layer": _silver_sql(),
        "gold_means": f"with s as ({_silver_sql()}) select ano, l_returnflag, {_MEANS} from s group by all",
        "gold_profile": f"with s as ({_silver_sql()}) select ano, l_returnflag, l_linestatus, l_linenumber, count(*) as total from s group by all",
        "gold_ranking": f"with s as ({_silver_sql()}) select ano, l_returnflag, round(avg(l_tax), 2) as media_tax, count(*) as total from s where l_tax > 0 group by all",
        "drift_silver": _silver_sql(drift=True),
        "drift_gold": f"with s as ({_silver_sql(drift=True)}) select ano, l_returnflag, {_MEANS} from s group by all",
        "exam_gold_means": f"""with s as ({_EXAM_SILVER})
            select ano, SG_UF_PROVA, round(avg(NU_NOTA_CN), 2) as MEDIA_CN, round(avg(NU_NOTA_CH), 2) as MEDIA_CH,
                   round(avg(NU_NOTA_LC), 2) as MEDIA_LC, round(avg(NU_NOTA_MT), 2) as MEDIA_MT, round(avg(NU_NOTA_REDACAO), 2) as MEDIA_REDACAO
            from s group by all""",
        "exam_gold_profile": f"""with s as ({_EXAM_SILVER})
            select ano, TP_FAIXA_ETARIA, TP_SEXO, TP_COR_RACA, count(*) as TOTAL_CANDIDATOS from s group by all""",
        "exam_gold_ranking": f"""with s as ({_silver_sql()})
            select ano, l_returnflag as SG_UF_PROVA, round(avg(l_tax), 2) as MEDIA_REDACAO, count(*) as TOTAL_PARTICIPANTES
            from s where l_tax > 0 group by all""",
        "exam_abstention_by_sex": f"""with s as ({_silver_sql()})
            select l_linestatus as TP_SEXO, round(avg(cast(l_tax = 0 as double)), 4) as taxa_abstencao
            from s group by all""",
        "exam_mean_median_by_age": f"""with s as ({_silver_sql()})
            select l_linenumber as TP_FAIXA_ETARIA, round(avg(l_quantity), 2) as media_NU_NOTA_CN,
                   round(median(l_quantity), 2) as mediana_NU_NOTA_CN
            from s group by all""",
    }
