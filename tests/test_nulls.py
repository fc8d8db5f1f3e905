"""Rows without keys or order values stay, names may hold anything, ids may be strings."""

import pytest
from pyspark.sql import functions as F

from foliospark.functions.scores import split_hash
from foliospark.operators import evaluate, model, runs, stats, versions
from foliospark.plans.ordering import exact_median, running_totals


@pytest.mark.parametrize("ranges", [1, 2, 8, 200])
def test_running_totals_keep_nulls_last(spark, ranges):
    rows = [(k, x, 1) for k in ("a", None) for x in (3, 1, None, 2)]
    df = spark.createDataFrame(rows, "k string, x int, n int")
    out = running_totals(df, ["x"], {"upto": F.col("n")}, ["k"], ranges).collect()
    assert sorted((r.k or "", r.upto, r.x) for r in out) == [
        (k, *pair) for k in ("", "a") for pair in ((1, 1), (2, 2), (3, 3), (4, None))
    ]


def test_null_groups_stay(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0), ("a", None)], "k string, v double")
    assert {r.k: r.median for r in exact_median(df, "v", ["k"]).collect()} == {None: 2.0, "a": 5.0}
    named = spark.createDataFrame([(None, 1), (None, 2), ("m", 1)], "name string, registered int")
    got = sorted((r.name or "", r.version) for r in versions.number_versions(named).collect())
    assert got == [("", 1), ("", 2), ("m", 1)]
    scored = spark.createDataFrame(
        [(c, s, p) for c in ("x", None) for s, p in ((0.1, False), (0.9, True))],
        "class string, score double, is_class boolean",
    )
    assert {r["class"]: r.auc for r in evaluate.class_auc(scored).collect()} == {"x": 1.0, None: 1.0}


def test_folds_of_string_keys_and_null_labels(spark):
    df = spark.createDataFrame([(f"2101.{i:05}", "a" if i % 2 else None) for i in range(40)], "id string, label string")
    out = model.with_folds(df, "id", "label", 4).collect()
    assert len(out) == 40
    for label in ("a", None):
        sizes = [sum(r.fold == f and r.label == label for r in out) for f in range(4)]
        assert sizes == [5] * 4
    train, test = model.train_test_split(df, "id")
    assert train.count() + test.count() == 40
    assert 0 <= df.select(F.min(split_hash("id"))).first()[0] < 1


def test_string_run_ids(spark):
    df = spark.createDataFrame(
        [("b1", "x", 0.5), ("a9", "y", 0.5), ("c0", "z", None)], "run_id string, run_name string, test_accuracy double"
    )
    assert runs.best_by_metric(df, "test_accuracy").first().run_id == "a9"
    assert stats.project_summary(df).first().best_model == "y"


def test_names_with_dots_and_spaces(spark):
    df = spark.createDataFrame(
        [("a", 0.2, 0.9, "1"), ("b", 0.8, 0.7, "2"), ("c", 0.9, None, "1")],
        "run_id string, `metric_val.acc` double, `metric_Test Metrics_accuracy` double, `param_a.b` string",
    )
    assert [r.run_id for r in runs.by_thresholds(df, {"val.acc": (0.5, ">=")}).collect()] == ["b", "c"]
    ordered = runs.by_expression(df, order_by=["metrics.`Test Metrics_accuracy` DESC"])
    assert [r.run_id for r in ordered.collect()] == ["a", "b", "c"]
    assert [r.run_id for r in runs.by_param(df, "a.b", "2").collect()] == ["b"]


def test_thresholds_put_the_best_first(spark):
    df = spark.createDataFrame([("a", 0.6), ("b", 0.9), ("c", 0.1)], "run_id string, metric_test_accuracy double")
    assert [r.run_id for r in runs.by_thresholds(df, {"test_accuracy": (0.5, ">")}).collect()] == ["b", "a"]


def test_union_of_named_algorithms_repeats(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "run_id int, algorithm string")
    got = sorted(tuple(r) for r in runs.union_algorithms(df, ["x", "y", "x"]).collect())
    assert got == [(0, 1), (1, 2), (2, 1)]
