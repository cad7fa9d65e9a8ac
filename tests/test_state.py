"""Gold from stored partial states equals a rebuild, and reads new files alone."""

import glob
import os
import shutil

import pytest
from conftest import write_text

from tierlake.operators import mean_median_by_group
from tierlake.operators.sketches import median_sketch_by_group, merge_by_group, quantile_of, rank_bounds, rank_error, sketches_by_group
from tierlake.plans import build_bronze, build_silver, gold_tables, load_presence
from tierlake.plans.state import state_gold, state_medians, update_state
from tierlake.sinks import VersionedTables
from tierlake.sources import read_layer
from tierlake.spec import EXAM_SPEC as S
from tierlake.streaming import ingest_stream
from pyspark.sql import functions as F

HEADER = "SG_UF_PROVA;TP_SEXO;NU_NOTA_CN;NU_NOTA_REDACAO"


def year(raw, y, rows, name=None, header=HEADER):
    path = f"{raw}/survey_{y}/DADOS/MICRODADOS_ENEM_{y}.csv"
    write_text(f"{path}/{name}" if name else path, header + "\n" + "".join(r + "\n" for r in rows))


def equals_rebuild(spark, workdir, bronze, state):
    fresh = f"{workdir}/silver-{len(os.listdir(workdir))}"
    build_silver(spark, bronze, fresh, S)
    want = gold_tables(read_layer(spark, fresh), load_presence(spark, fresh), S).tables
    got = state_gold(spark, state, S).tables
    assert set(got) == set(want)
    for name in want:
        assert got[name].columns == want[name].columns, name
        assert list(map(repr, got[name].collect())) == list(map(repr, want[name].collect())), name


def test_new_files_of_a_year_add_to_its_states(spark, workdir):
    raw, bronze, state = f"{workdir}/raw", f"{workdir}/bronze", f"{workdir}/state"
    year(raw, 2020, ["SP;F;10;500", "RJ;M;;0", "SP;F;x;", "BA;F;NaN;3"], "a.csv")
    year(raw, 2021, ["SP;M;30;700"], "a.csv")
    ingest_stream(spark, raw, bronze, f"{workdir}/ckpt", S)
    first = update_state(spark, bronze, state, S)
    assert first.action == "written" and first.rows == 5
    equals_rebuild(spark, workdir, bronze, state)
    year(raw, 2020, ["SP;F;20;100", "AC;M;7;8"], "b.csv")
    year(raw, 2022, [";F;1;2"], "a.csv")
    ingest_stream(spark, raw, bronze, f"{workdir}/ckpt", S)
    # The old data is unreadable now: a rescan would fail.
    old = [f for f in glob.glob(f"{bronze}/ano=2021/*.parquet")]
    text = open(old[0], "rb").read()
    with open(old[0], "wb") as f:
        f.write(b"x" * len(text))
    os.path.exists(c := f"{os.path.dirname(old[0])}/.{os.path.basename(old[0])}.crc") and os.remove(c)
    try:
        report = update_state(spark, bronze, state, S)
    finally:
        with open(old[0], "wb") as f:
            f.write(text)
    assert report.metrics == {"files": 2, "years_again": 0} and report.rows == 8
    equals_rebuild(spark, workdir, bronze, state)
    assert update_state(spark, bronze, state, S).action == "skipped"


def test_a_run_that_ends_early_counts_no_file_twice(spark, workdir):
    raw, bronze, state = f"{workdir}/raw", f"{workdir}/bronze", f"{workdir}/state"
    year(raw, 2020, ["SP;F;10;500"], "a.csv")
    ingest_stream(spark, raw, bronze, f"{workdir}/ckpt", S)
    update_state(spark, bronze, state, S)
    year(raw, 2020, ["SP;F;30;100"], "b.csv")
    ingest_stream(spark, raw, bronze, f"{workdir}/ckpt", S)
    store = VersionedTables(spark, state)
    store.stage(store.read("score_states").withColumn("rank_n", F.lit(9).cast("long")), "score_states")  # never committed
    update_state(spark, bronze, state, S)
    equals_rebuild(spark, workdir, bronze, state)
    assert [r.TOTAL_PARTICIPANTES for r in state_gold(spark, state, S).tables[S.rank_table].collect()] == [2]


def test_years_ingested_again_dropped_and_drifted(spark, workdir):
    raw, bronze, state = f"{workdir}/raw", f"{workdir}/bronze", f"{workdir}/state"
    year(raw, 2020, ["SP;F;10;500", "RJ;M;;0"])
    year(raw, 2021, ["SP;5"], header="SG_UF_PROVA;NU_NOTA_MT")
    year(raw, 2022, ["F;5"], header="TP_SEXO;NU_NOTA_CN")
    build_bronze(spark, raw, bronze, S)
    update_state(spark, bronze, state, S)
    equals_rebuild(spark, workdir, bronze, state)
    year(raw, 2020, ["SP;F;11;400"])
    shutil.rmtree(f"{bronze}/ano=2020")
    shutil.rmtree(f"{bronze}/ano=2021")
    shutil.rmtree(f"{raw}/survey_2021")
    build_bronze(spark, raw, bronze, S)
    report = update_state(spark, bronze, state, S)
    assert report.metrics == {"files": 1, "years_again": 2}
    equals_rebuild(spark, workdir, bronze, state)
    with pytest.raises(FileNotFoundError):
        state_gold(spark, f"{workdir}/none", S)


def test_state_medians_merge_over_years(spark, workdir):
    raw, bronze, state = f"{workdir}/raw", f"{workdir}/bronze", f"{workdir}/state"
    for y in (2020, 2021):
        year(raw, y, [f"{'SP' if i % 3 else 'RJ'};F;{i * (y - 2019)};{i}" for i in range(1, 400)])
    build_bronze(spark, raw, bronze, S)
    update_state(spark, bronze, state, S)
    build_silver(spark, bronze, f"{workdir}/silver", S)
    silver = read_layer(spark, f"{workdir}/silver")
    for keys in (["ano", "SG_UF_PROVA"], ["SG_UF_PROVA"], []):
        found = state_medians(spark, state, S, keys)
        for r in rank_bounds(silver, keys, "NU_NOTA_CN", found, "mediana_NU_NOTA_CN").collect():
            assert r.below <= (0.5 + rank_error(1024)) * r.n and r.upto >= (0.5 - rank_error(1024)) * r.n


def test_sketch_medians_within_their_bound(spark):
    df = spark.range(60_000).select(
        (F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 5 == 0, 0.0).when(F.col("id") % 7 == 0, None).when(F.col("id") % 11 == 0, float("nan")).otherwise(F.rand(3)).alias("v"),
        F.lit(None).cast("double").alias("none"),
    ).withColumn("year", F.col("g") + F.floor(F.rand(4) * 4))
    found = median_sketch_by_group(df, ["g"], ["v", "none"], k=200)
    assert [r.mediana_none for r in found.collect()] == [None] * 3
    whole = sketches_by_group(df, ["g"], {"s": "v"}, 200)
    parts = merge_by_group(sketches_by_group(df, ["g", "year"], {"s": "v"}, 200), ["g"], ["s"])
    for each in (found.withColumnRenamed("mediana_v", "m"), whole.select("g", quantile_of("s").alias("m")), parts.select("g", quantile_of("s").alias("m"))):
        rows = rank_bounds(df, ["g"], "v", each, "m").collect()
        assert len(rows) == 3
        for r in rows:
            assert r.below <= (0.5 + rank_error(200)) * r.n and r.upto >= (0.5 - rank_error(200)) * r.n


def test_small_groups_are_exact(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", 9.0), (None, 4.0), ("b", None)], "g string, v double")
    exact = {r.g: r.mediana_v for r in mean_median_by_group(df, ["g"], ["v"]).collect()}
    assert {r.g: r.mediana_v for r in median_sketch_by_group(df, ["g"], ["v"]).collect()} == exact
    assert median_sketch_by_group(df.limit(0), ["g"], ["v"]).count() == 0
    assert median_sketch_by_group(df.limit(0), [], ["v"]).collect()[0][0] is None
