"""Rows kept, outputs well-formed, and seeded runs repeat exactly."""

import pytest
from pyspark.sql import functions as F

from tierlake import fixtures as fx
from tierlake.operators import fill_scores
from tierlake.operators.models import classify_top, cluster_scores, evaluate_clusters, evaluate_top, in_holdout
from tierlake.spec import LINEITEM_SPEC as LI

SF = "/root/testdata/sf0.001"


def silver_like(spark):
    raw = fx.lineitem_raw(spark.read.parquet(f"{SF}/lineitem.parquet"), LI.year_col)
    return fill_scores(raw, LI.scores, LI.fill_value)


def test_classifier_is_seeded_and_keeps_every_row(spark):
    df = silver_like(spark)
    label = F.col("l_tax") >= 0.08
    a = classify_top(df, ["l_orderkey", "l_linenumber"], [LI.place, "l_linestatus", "l_linenumber"], label, num_trees=5)
    b = classify_top(df, ["l_orderkey", "l_linenumber"], [LI.place, "l_linestatus", "l_linenumber"], label, num_trees=5)
    rows_a = sorted(tuple(r) for r in a.collect())
    assert len(rows_a) == df.count()
    assert rows_a == sorted(tuple(r) for r in b.collect())
    assert all(0.0 <= r[-1] <= 1.0 and r[-2] in (0.0, 1.0) for r in rows_a)


def test_classifier_takes_many_categories_and_bounds_them(spark):
    df = spark.range(2000).select("id", (F.col("id") % 41).cast("string").alias("c"), (F.col("id") % 41 == 7).alias("y"))
    got = classify_top(df, ["id"], ["c"], F.col("y"), num_trees=5)
    assert got.where("label = prediction").count() == 2000
    with pytest.raises(ValueError, match="categories"):
        classify_top(df, ["id"], ["id"], F.col("y"), max_categories=100)


def test_evaluation_on_rows_that_were_not_fitted(spark):
    df = spark.range(2000).select("id", (F.col("id") % 41).cast("string").alias("c"), (F.col("id") % 41 == 7).alias("y"))
    (r,) = evaluate_top(df, ["id"], ["c"], F.col("y"), num_trees=5).collect()
    held = df.where(in_holdout(["id"]))
    assert (r["rows"], r["positives"]) == (held.count(), held.where("y").count()) and r["adds_up"] and r["beats_majority"]
    assert 450 < r["rows"] < 750


def test_clusters_hold_their_nearest_rows(spark):
    df = silver_like(spark)
    (r,) = evaluate_clusters(df, ["l_orderkey", "l_linenumber"], LI.scores, k=3).collect()
    assert r["rows"] == df.count() and 0 < r["placed"] < r["rows"] and (r["clusters"], r["misplaced"]) == (3, 0)


def test_kmeans_is_seeded_and_keeps_rows_it_cannot_place(spark):
    df = silver_like(spark)
    a = cluster_scores(df, ["l_orderkey", "l_linenumber"], LI.scores, k=3)
    b = cluster_scores(df, ["l_orderkey", "l_linenumber"], LI.scores, k=3)
    complete = df.where(" and ".join(f"{c} is not null" for c in LI.scores)).count()
    rows_a = sorted(map(repr, a.collect()))
    assert a.where("cluster is not null").count() == complete < df.count() == len(rows_a)  # malformed scores (line 7)
    assert rows_a == sorted(map(repr, b.collect()))
    assert {r["cluster"] for r in a.collect()} <= {0, 1, 2, None}


def test_training_rows_come_in_bounded_parts(spark):
    from tierlake.operators.models import training_parts

    same = spark.range(0, 4000, 1, 1).select(F.lit(1.0).alias("x"))  # equal rows, one part
    with training_parts(same, 4000, most=250) as rows:
        sizes = [r[0] for r in rows.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert sum(sizes) == 4000 and max(sizes) <= 500 and len(sizes) >= 12
    with training_parts(same, 4000) as rows:
        assert rows is same
