"""Model selection: exact average precision, the right choice, and a label that cannot be learned."""

import random

import pytest
from pyspark.sql import functions as F

from tierlake.operators.selection import average_precision, confusion, part_of, select_classifier

GRID = [{"num_trees": 1, "max_depth": 0}, {"num_trees": 3, "max_depth": 3}]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    out = [(i, rng.choice("abcdef"), rng.choice("xy"), rng.random() < 0.2) for i in range(1500)]
    return spark.createDataFrame([(i, a, b, int(a == "c" and b == "x"), int(noise)) for i, a, b, noise in out], "id int, a string, b string, rare int, noise int")


def test_average_precision_is_exact(spark):
    rng = random.Random(3)
    pairs = [(float(rng.random() < 0.3), rng.choice([0.1, 0.2, 0.5, 0.9])) for _ in range(200)]
    want, tp, taken = 0.0, 0, 0
    for p in sorted({p for _, p in pairs}, reverse=True):
        pos = sum(y == 1 for y, q in pairs if q == p)
        tp, taken = tp + pos, taken + sum(q == p for _, q in pairs)
        want += pos * tp / taken
    want /= sum(y == 1 for y, _ in pairs)
    df = spark.createDataFrame(pairs, "label double, p_positive double")
    assert average_precision(df) == pytest.approx(want, abs=1e-12)
    assert average_precision(df.where("label = 0")) == 0.0


def test_the_learning_candidate_is_chosen_and_right(rows):
    found = select_classifier(rows, ["id"], ["a", "b"], F.col("rare") == 1, GRID)
    assert found.settings == GRID[1] and found.precision[1] == 1.0 > found.precision[0]
    counts = {(r.label, r.prediction): r.rows for r in confusion(found.scored).collect()}
    assert set(counts) == {(0.0, 0.0), (1.0, 1.0)}
    held = rows.where(part_of(["id"]) == "test")
    assert sum(counts.values()) == held.count() and counts[1.0, 1.0] == held.where("rare = 1").count()


def test_a_shuffled_label_fails(rows):
    found = select_classifier(rows, ["id"], ["a", "b"], F.col("noise") == 1, GRID)
    assert max(found.precision) < 0.5
    assert found.scored.where("label != prediction").count() > 20


def test_equal_candidates_and_an_empty_grid(rows):
    assert select_classifier(rows, ["id"], ["a"], F.lit(False), GRID).settings == GRID[0]
    with pytest.raises(ValueError):
        select_classifier(rows, ["id"], ["a"], F.lit(False), [])


def test_parts_are_found_once(spark):
    df = spark.range(400).select("id", F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("f"))
    found = select_classifier(df, ["id"], ["f"], F.col("f") == "a", [{"num_trees": 1, "max_depth": 1}])
    assert found.scored.columns == ["id", "label", "prediction", "p_positive"]
    assert "md5" not in found.scored._jdf.queryExecution().executedPlan().toString()
    assert found.scored.count() == df.where(part_of(["id"]) == "test").count()
    assert found.scored.where("label != prediction").count() == 0
