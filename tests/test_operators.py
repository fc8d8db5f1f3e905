"""Operators on small literal tables, against definitions and brute force."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from foliospark.operators import evaluate, features, model, monitor, profile, publications, runs, stats
from foliospark.operators import tables, versions, vocabulary
from foliospark.operators.vocabulary import TermTable
from foliospark.plans.ordering import exact_median, running_totals


def test_running_totals_with_one_hot_key(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.7 else f"k{rng.randrange(5)}", i, rng.randrange(10)) for i in range(3000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, i int, v int").repartition(7)
    got = {
        (r["k"], r["i"]): r["t"]
        for r in running_totals(df, ["i"], {"t": F.col("v").cast("bigint")}, ["k"], ranges=9).collect()
    }
    sums, expected = {}, {}
    for k, i, v in sorted(rows, key=lambda r: r[1]):
        sums[k] = sums.get(k, 0) + v
        expected[(k, i)] = sums[k]
    assert got == expected


def test_running_totals_on_one_value_and_on_nothing(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "a int, b int")
    got = running_totals(df, ["a", "b"], {"n": F.lit(1).cast("bigint")})
    assert sorted(r["n"] for r in got.collect()) == [1, 2]
    assert running_totals(df.where("a > 5"), ["a", "b"], {"n": F.lit(1).cast("bigint")}).count() == 0


@pytest.mark.parametrize("n", [1, 2, 5, 100, 101])
def test_exact_median(spark, n):
    rng = random.Random(n)
    values = [float(rng.randrange(20)) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    assert exact_median(df, "v").first()["median"] == statistics.median(values)


def test_auc_against_all_pairs(spark):
    rng = random.Random(3)
    rows = [(c, rng.randrange(12) / 11, rng.random() < 0.3) for c in ("a", "b", "c") for _ in range(80)]
    got = {r["class"]: r["auc"] for r in evaluate.class_auc(spark.createDataFrame(rows, "class string, score double, is_class boolean")).collect()}
    for c in ("a", "b", "c"):
        pos = [s for k, s, h in rows if k == c and h]
        neg = [s for k, s, h in rows if k == c and not h]
        won = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
        assert got[c] == pytest.approx(won / (len(pos) * len(neg)))


def test_auc_needs_three_classes(spark):
    rows = [("a", 0.1, True), ("a", 0.2, False), ("b", 0.1, True), ("b", 0.3, False)]
    df = spark.createDataFrame(rows, "class string, score double, is_class boolean")
    assert evaluate.roc_auc_ovr(df).first()["roc_auc"] is None


def test_class_report_with_a_class_never_predicted(spark):
    matrix = spark.createDataFrame([(0, 0, 3), (1, 0, 2), (2, 2, 1)], "label int, prediction int, n bigint")
    report = {r["class"]: r for r in evaluate.class_report(matrix).collect()}
    assert report[1]["precision"] == 0 and report[1]["f1_score"] == 0 and report[1]["support"] == 2
    assert report[0]["precision"] == pytest.approx(0.6)
    total = evaluate.weighted_scores(matrix).first()
    assert total["accuracy"] == total["recall"] == pytest.approx(4 / 6)


def test_thresholds(spark):
    df = spark.createDataFrame([("a", 0.5), ("b", None), ("c", 0.2)], "run_id string, metric_x double")
    assert [r[0] for r in runs.by_thresholds(df, {"x": (0.2, ">")}).collect()] == ["a"]
    with pytest.raises(ValueError):
        runs.by_thresholds(df, {"x": (0.2, "!=")})


def test_compare_runs_keeps_order_and_skips_unknown(spark):
    df = spark.createDataFrame(
        [("a", None, "ok", 0.1, 0.9), ("b", "B", "ok", None, 0.4)],
        "run_id string, run_name string, status string, metric_test_accuracy double, metric_accuracy double",
    )
    got = runs.compare_runs(df, runs.ids_in_order(spark, ["b", "zzz", "a", "b"])).collect()
    assert [r["run_id"] for r in got] == ["b", "a", "b"]
    assert [r["accuracy"] for r in got] == [0.4, 0.1, 0.4]
    assert got[1]["run_name"] == "Unknown" and got[0]["algorithm"] == "Unknown"


def test_best_run_and_ties(spark):
    df = spark.createDataFrame([(2, "x", 0.5), (1, "y", 0.5), (3, "z", None)], "run_id int, run_name string, m double")
    assert runs.best_run(df, "m").first()["run_id"] == 1
    assert runs.best_run(df.where("m is null"), "m").count() == 0
    assert runs.best_by_metric(df, "m").first()["run_id"] == 1
    assert runs.best_by_metric(df.where("m is null"), "m").first()["best_value"] == 0
    assert runs.best_by_metric(df.where("run_id > 9"), "m").count() == 0


def test_final_metric_is_the_last_report(spark):
    rows = [("r", "m", 1, 10, 0.1), ("r", "m", 2, 5, 0.2), ("r", "m", 2, 6, 0.3), ("r", "n", 1, 1, 1.0)]
    df = spark.createDataFrame(rows, "run_id string, key string, step int, ts bigint, value double")
    assert {(r.key, r.value) for r in runs.final_metrics(df).collect()} == {("m", 0.3), ("n", 1.0)}


def test_assembly_leaves_missing_null_and_drops_system_tags(spark):
    base = spark.createDataFrame([("a", "A"), ("b", "B")], "run_id string, run_name string")
    metrics = spark.createDataFrame([("a", "acc", 1, 1, 0.5)], "run_id string, key string, step int, ts bigint, value double")
    params = spark.createDataFrame([("b", "depth", "3")], "run_id string, key string, value string")
    tags = spark.createDataFrame([("a", "mlflow.user", "u"), ("a", "team", "t")], "run_id string, key string, value string")
    got = {r["run_id"]: r.asDict() for r in runs.assemble_runs(base, metrics, params, tags).collect()}
    assert got["a"] == {"run_id": "a", "run_name": "A", "metric_acc": 0.5, "param_depth": None, "tag_team": "t"}
    assert got["b"]["metric_acc"] is None and got["b"]["param_depth"] == "3"


def test_expression_filter_has_no_hidden_cap(spark):
    df = spark.range(1500).selectExpr("id as run_id", "id / 1500 as metric_acc", "'RF' as param_algorithm")
    found = runs.by_expression(df, 'metrics.acc >= 0 AND params.algorithm = "RF"')
    assert found.count() == 1500
    top = runs.by_expression(df, None, ["metric_acc DESC"], max_results=2).collect()
    assert [r["run_id"] for r in top] == [1499, 1498]


def test_minmax_of_a_constant(spark):
    long = spark.createDataFrame([("a", "k", 1.0), ("b", "k", 1.0)], "run_id string, key string, value double")
    assert [r["scaled"] for r in stats.minmax_long(long).collect()] == [None, None]
    wide = spark.createDataFrame([("a", 1.0, None), ("b", 1.0, 4.0)], "run_id string, x double, y double")
    got = {r["run_id"]: (r["x"], r["y"]) for r in stats.minmax_wide(wide, ["x", "y"]).collect()}
    assert got == {"a": (0.0, 0.0), "b": (0.0, 1.0)}


def test_histogram_of_equal_and_few_values(spark):
    same = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    got = stats.histogram(same, "v").orderBy("bin").collect()
    assert [(r["bin"], r["n"]) for r in got] == [(0, 0), (1, 2)]
    assert got[0]["low_edge"] == 1.5 and got[1]["high_edge"] == 2.5
    assert stats.histogram(same.where("v > 5"), "v").count() == 0


def test_spread_of_one_row(spark):
    df = spark.createDataFrame([("a", 0.5)], "g string, v double")
    row = stats.algorithm_spread(df, "v", F.col("g")).first()
    assert row["std"] is None and row["mean"] == 0.5


def test_status_counts_of_nothing(spark):
    empty = spark.createDataFrame([], "status string")
    row = monitor.status_counts(empty).first()
    assert row["total_tasks"] == 0 and row["success_rate"] == 0.0


def test_alerts(spark):
    rows = [(90.0, 1), (50.0, 9)]
    got = monitor.alerts(spark.createDataFrame(rows, "success_rate double, running bigint")).collect()
    assert sorted(r[0] for r in got) == ["low success rate", "many tasks running at once", "system is healthy"]


def test_stage_transitions(spark):
    rows = [
        ("m", 1, "Production", 1, False), ("m", 2, "Production", 2, True), ("m", 3, "Staging", 3, False),
        ("m", 4, "Staging", 4, False), ("n", 1, "Production", 1, False),
    ]
    df = spark.createDataFrame(rows, "name string, version int, stage string, ts int, archive_existing boolean")
    got = {(r["name"], r["version"]): r["stage"] for r in versions.stage_after_events(df).collect()}
    assert got == {
        ("m", 1): "Archived", ("m", 2): "Production", ("m", 3): "Staging", ("m", 4): "Staging", ("n", 1): "Production",
    }


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "", 4.0)], "i int, s string, d double")
    assert profile.completeness_ratio(df).first()["completeness"] == pytest.approx(5 / 6)
    assert profile.completeness_truthy(df, ["s"]).first()["s"] == 1
    row = profile.frame_profile(df).first()
    assert row["missing_values"] == 1 and row["mean_of_means"] == pytest.approx((1.5 + 4.0) / 2)
    assert row["mean_of_stds"] == pytest.approx(statistics.stdev([1, 2]))
    assert profile.frame_profile(df.where("i > 9")).first()["missing_percentage"] is None


def test_incomplete_rows(spark):
    df = spark.createDataFrame([("t", "a", "d"), (None, "a", "d"), ("t", "a", None)], "title string, abstract string, doi string")
    assert publications.drop_incomplete(df).count() == 1
    assert publications.removed_counts(df).first().asDict() == {"rows_before": 3, "rows_kept": 1, "rows_removed": 2}
    enough, rejected = publications.split_by_text_length(df, "abstract", 2)
    assert enough.count() == 0 and rejected.count() == 3


def test_accuracy_column():
    assert tables.accuracy_column(["cv_accuracy", "accuracy_std", "test_accuracy"]) == "test_accuracy"
    assert tables.accuracy_column(["loss"]) is None


def test_timeouts(spark):
    rows = [("a", dt.datetime(2024, 1, 1), None), ("b", dt.datetime(2024, 1, 2), None), ("c", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "run_id string, created timestamp_ntz, completed timestamp_ntz")
    now = F.lit("2024-01-02 01:30:00").cast("timestamp_ntz")
    assert [r["run_id"] for r in monitor.timeouts(df, now, 24).collect()] == ["a"]


def test_encodings(spark):
    df = spark.createDataFrame([("b", 1.0, 7.0), ("a", 3.0, 7.0), (None, None, 7.0)], "c string, x double, k double")
    coded = features.one_hot(df, "c", features.column_levels(df, "c")).select("c_a", "c_b").collect()
    assert [tuple(r) for r in coded] == [(0, 1), (1, 0), (0, 0)]
    scaled = features.standard_scale(df, ["x", "k"]).collect()
    assert [r["x_scaled"] for r in scaled] == [-1.0, 1.0, None]
    assert [r["k_scaled"] for r in scaled] == [0.0, 0.0, 0.0]


DOCS = [
    (1, "red fish blue fish"), (2, "blue fish swim"), (3, "red dogs run"), (4, "dogs swim and run"), (5, ""),
]


def test_vector_and_table_tfidf_agree(spark):
    df = spark.createDataFrame(DOCS, "id int, body string")
    grams = features.with_grams(df, ["body"], (1, 2))
    n_docs = features.document_count(df)
    known = TermTable(vocabulary.fit_vocabulary(grams, n_docs), n_docs)
    table = {(r["id"], r["term"]): r["tfidf"] for r in features.tfidf(grams, known, "id").collect()}
    vectorizer = features.TextVectorizer.fit(grams)
    vectors = {
        (r["id"], vectorizer.terms[i]): v
        for r in vectorizer.transform(grams).collect()
        for i, v in zip(r["text"].indices, r["text"].values)
    }
    assert table.keys() == vectors.keys() and table
    assert all(table[k] == pytest.approx(vectors[k], abs=1e-9) for k in table)


def test_split_and_folds_do_not_depend_on_partitions(spark):
    df = spark.range(400).selectExpr("id", "if(id % 3 = 0, 'a', 'b') as label")
    results = []
    for parts in (1, 8):
        train, test = model.train_test_split(df.repartition(parts), "id")
        folds = model.with_folds(df.repartition(parts), "id", "label")
        results.append(
            (
                sorted(r["id"] for r in test.collect()),
                sorted((r["id"], r["fold"]) for r in folds.collect()),
            )
        )
    assert results[0] == results[1]
    sizes = {}
    for i, fold in results[0][1]:
        sizes[(i % 3 == 0, fold)] = sizes.get((i % 3 == 0, fold), 0) + 1
    for label in (True, False):
        per_fold = [sizes[(label, f)] for f in range(5)]
        assert max(per_fold) - min(per_fold) <= 1


def test_configs_are_independent_and_complete():
    configs = model.sweep_configs()
    assert len(configs) == 17
    assert configs[0].params["n_estimators"] == 100 and configs[1].params["n_estimators"] == 200
    assert len({id(c.params) for c in configs}) == 17


def test_target_is_no_input():
    with pytest.raises(ValueError):
        model.Inputs("id", "lang", ["lang"])


def test_sweep_learns_and_reports_failures(spark):
    rows = [(i, "red apple tart sweet" if i % 2 else "blue whale ocean deep", "f" if i % 2 else "s") for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, body string, kind string")
    configs = [
        model.TrainConfig("lr", model.LOGISTIC, {"solver": "lbfgs", "max_iter": 20}, 50, (1, 1)),
        model.TrainConfig("kernel", model.SVM, {"kernel": "rbf"}, 50, (1, 1)),
        model.TrainConfig("odd", "Perceptron", {}, 50, (1, 1)),
    ]
    got = {r["experiment_name"]: r for r in model.sweep(df, model.Inputs("id", "kind", ["body"]), configs, folds=3).collect()}
    assert got["lr"]["status"] == "success" and got["lr"]["test_accuracy"] == 1.0
    assert got["lr"]["training_samples"] + got["lr"]["test_samples"] == 60
    assert got["kernel"]["status"] == "failed" and "kernel" in got["kernel"]["error"]
    assert got["odd"]["status"] == "failed"


def test_probabilities_sum_to_one(spark):
    rows = [(i, ["red apple", "blue whale", "green leaf"][i % 3], "abc"[i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, body string, kind string")
    prepared = model.prepare(df, model.Inputs("id", "kind", ["body"]), 50, (1, 1), folds=3)
    fitted = model.fit(prepared, model.TrainConfig("lr", model.LOGISTIC, {"max_iter": 20}))
    predicted = model.predict(fitted, prepared.test)
    assert all(sum(r["probability"]) == pytest.approx(1) for r in predicted.collect())
    assert model.test_scores(predicted, 3)["roc_auc"] == 1.0
    prepared.release()
