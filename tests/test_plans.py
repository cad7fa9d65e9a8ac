"""Physical plan checks: pushdown, pruning, one shared aggregate, no Python."""

from tierlake import fixtures as fx
from tierlake.plans import build_bronze, build_silver, gold_tables, load_presence, silver_frame
from tierlake.sources import read_layer
from tierlake.spec import LINEITEM_SPEC as LI

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def lake(spark, workdir):
    raw = fx.lineitem_raw(spark.read.parquet(f"{SF}/lineitem.parquet"))
    fx.write_raw_csv(spark, raw, f"{workdir}/raw", LI, "lineitem")
    build_bronze(spark, f"{workdir}/raw", f"{workdir}/bronze", LI)
    build_silver(spark, f"{workdir}/bronze", f"{workdir}/silver", LI)


def test_positive_filter_pushed_and_year_pruned(spark, workdir):
    lake(spark, workdir)
    df = read_layer(spark, f"{workdir}/silver", years=[1996]).where("l_tax > 0").select("l_returnflag", "l_tax")
    p = plan_of(df)
    assert "PushedFilters: [IsNotNull(l_tax), GreaterThan(l_tax,0.0)]" in p
    assert "PartitionFilters: [isnotnull(ano" in p and "1996" in p
    assert "ReadSchema: struct<l_returnflag:string,l_tax:double>" in p


def test_gold_is_jvm_only_and_shares_one_aggregate(spark, workdir):
    lake(spark, workdir)
    silver = read_layer(spark, f"{workdir}/silver")
    plan = gold_tables(silver, load_presence(spark, f"{workdir}/silver"), LI)
    for df in plan.tables.values():
        p = plan_of(df)
        assert "Python" not in p and "ArrowEval" not in p
    means, ranks = plan.tables[LI.mean_table], plan.tables[LI.rank_table]
    # The ranking table is a projection of the same aggregate as the means.
    assert ranks._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
    assert means._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1


def test_silver_reads_bronze_once_and_never_shuffles(spark, workdir):
    from pyspark.sql import functions as F

    from tierlake.plans.silver import clean_columns

    lake(spark, workdir)
    bronze, presence, _ = silver_frame(spark, f"{workdir}/bronze", LI)
    silver_in = bronze.select(*clean_columns(bronze, presence, LI), F.col(LI.year_col))
    p = plan_of(silver_in)
    assert p.count("FileScan parquet") == 1
    assert "Python" not in p
    assert "Exchange" not in p  # no shuffle by year: a whole year never lands in one task
    assert "*(1) Project" in p  # parse and fill run inside whole-stage codegen
