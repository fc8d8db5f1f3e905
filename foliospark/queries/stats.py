"""Queries over run statistics and classification scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliospark.functions import scores
from foliospark.operators import evaluate, stats
from foliospark.queries import views
from foliospark.queries.registry import query
from foliospark.queries.runs import _FAMILY_SQL, final_metrics, wide_runs
from foliospark.queries.views import table, with_views

# Sums of doubles differ in their last digits between engines, so averages and
# deviations are compared at PLACES decimals. Runtimes in minutes reach millions,
# where a double has fewer decimals to compare.
PLACES = 9
RUNTIME_PLACES = 6


def _rounded(df, *columns, places=PLACES):
    return df.withColumns({c: F.round(c, places) for c in columns})


def _round_sql(expression: str, places: int = PLACES) -> str:
    return f"round({expression}, {places})"


@query(
    "algo_stats",
    with_views(
        "sweep_results",
        f"SELECT algorithm, count(*) AS n, {_round_sql('avg(test_accuracy)')} AS mean_accuracy, "
        f"max(test_accuracy) AS best_accuracy, {_round_sql('avg(test_f1_score)')} AS mean_f1_score, "
        "max(test_f1_score) AS best_f1_score FROM sweep_results WHERE status = 'success' GROUP BY 1",
    ),
)
def _(spark, folder):
    return _rounded(
        stats.algorithm_stats(views.sweep_results(spark, folder)), "mean_accuracy", "mean_f1_score"
    )


@query(
    "algo_spread",
    with_views(
        "runs",
        f"SELECT {_FAMILY_SQL} AS family, {_round_sql('avg(test_accuracy)')} AS mean, "
        f"{_round_sql('stddev_samp(test_accuracy)')} AS std, min(test_accuracy) AS min, "
        "max(test_accuracy) AS max FROM runs GROUP BY 1",
    ),
)
def _(spark, folder):
    spread = stats.algorithm_spread(
        views.runs(spark, folder), "test_accuracy", scores.algorithm_family("run_name")
    )
    return _rounded(spread, "mean", "std")


@query(
    "metric_summary",
    with_views(
        "final_metrics",
        f"SELECT key, {_round_sql('avg(value)')} AS mean, {_round_sql('stddev_pop(value)')} AS std, "
        "min(value) AS min, max(value) AS max, count(value) AS n FROM final_metrics GROUP BY 1",
    ),
)
def _(spark, folder):
    return _rounded(stats.metric_summary(final_metrics(spark, folder)), "mean", "std")


@query(
    "sweep_counts",
    with_views(
        "sweep_results",
        "SELECT count(*) AS total, count(*) FILTER (status = 'success') AS successful, "
        "count(*) FILTER (status <> 'success') AS failed FROM sweep_results",
    ),
)
def _(spark, folder):
    return stats.sweep_counts(views.sweep_results(spark, folder))


@query(
    "avg_runtime",
    with_views("runs", f"SELECT {_round_sql('avg(nullif(runtime_min, 0))', RUNTIME_PLACES)} AS average_runtime_min FROM runs"),
)
def _(spark, folder):
    return _rounded(stats.average_runtime(views.runs(spark, folder)), "average_runtime_min", places=RUNTIME_PLACES)


@query(
    "runtime_stats",
    with_views(
        "runs",
        f"SELECT {_round_sql('avg(runtime_min)', RUNTIME_PLACES)} AS mean_runtime, median(runtime_min) AS median_runtime FROM runs",
    ),
)
def _(spark, folder):
    return _rounded(stats.runtime_stats(views.runs(spark, folder)), "mean_runtime", places=RUNTIME_PLACES)


@query(
    "metric_median",
    with_views("run_metrics", "SELECT key, median(value) AS median FROM run_metrics GROUP BY 1"),
)
def _(spark, folder):
    return stats.exact_median(views.run_metrics(spark, folder), "value", ["key"])


@query(
    "runtime_histogram",
    with_views(
        "runs",
        """, s AS (SELECT min(runtime_min) AS lo, max(runtime_min) AS hi, least(count(*), 10) AS bins
                FROM runs WHERE runtime_min IS NOT NULL),
           c AS (SELECT least(floor((runtime_min - lo) / (hi - lo) * bins), bins - 1)::INT AS bin, count(*) AS n
                 FROM runs, s WHERE runtime_min IS NOT NULL GROUP BY 1)
           SELECT b.bin, lo + (hi - lo) / bins * b.bin AS low_edge,
                  lo + (hi - lo) / bins * (b.bin + 1) AS high_edge, coalesce(c.n, 0) AS n
           FROM s, (SELECT unnest(range(10))::INT AS bin) b LEFT JOIN c ON c.bin = b.bin
           WHERE b.bin < bins""",
    ),
)
def _(spark, folder):
    return stats.histogram(views.runs(spark, folder), "runtime_min")


@query(
    "running_best",
    with_views(
        "sweep_results",
        "SELECT run_id, successes FROM (SELECT run_id, (count(*) FILTER (status = 'success') "
        "OVER (ORDER BY run_id)) AS successes FROM sweep_results) WHERE run_id % 5 = 0",
    ),
)
def _(spark, folder):
    return stats.running_successes(views.sweep_results(spark, folder), "run_id", every=5)


@query(
    "project_summary",
    with_views(
        "runs",
        f"SELECT count(*) AS models, {_round_sql('avg(test_accuracy)')} AS mean_accuracy, "
        "(SELECT run_name FROM runs ORDER BY test_accuracy DESC, run_id LIMIT 1) AS best_model, "
        "max(test_accuracy) AS best_accuracy FROM runs",
    ),
)
def _(spark, folder):
    return _rounded(stats.project_summary(views.runs(spark, folder)), "mean_accuracy")


@query(
    "metric_correlation",
    with_views(
        "wide_runs",
        "SELECT round(corr(metric_test_accuracy, metric_test_f1_score), 6) AS accuracy_vs_f1, "
        "round(corr(metric_cv_mean_accuracy, metric_test_accuracy), 6) AS cv_vs_test FROM wide_runs",
    ),
)
def _(spark, folder):
    wide = wide_runs(spark, folder).selectExpr(
        "metric_test_accuracy as accuracy", "metric_test_f1_score as f1", "metric_cv_mean_accuracy as cv"
    )
    correlated = stats.metric_correlation(wide, [("accuracy", "f1"), ("cv", "accuracy")])
    return correlated.select(
        F.round("accuracy_vs_f1", 6).alias("accuracy_vs_f1"), F.round("cv_vs_accuracy", 6).alias("cv_vs_test")
    )


@query(
    "efficiency_ratio",
    with_views(
        "runs",
        "SELECT run_id, test_accuracy / nullif(runtime_min, 0) AS efficiency, "
        "runtime_min * 100 / max(runtime_min) OVER () AS time_share FROM runs",
    ),
)
def _(spark, folder):
    rated = stats.efficiency(views.runs(spark, folder), "test_accuracy", "runtime_min")
    return rated.select("run_id", "efficiency", "time_share")


# ---- classification scores --------------------------------------------------


def rule_predictions(spark, folder):
    """Labelled documents with a rule as classifier: long texts count as good quality."""
    return views.labelled(spark, folder).selectExpr(
        "doc_id", "quality as label", "if(n_chars > 2000, 1, 0) as prediction"
    )


_PREDICTIONS_SQL = "SELECT quality AS label, CASE WHEN n_chars > 2000 THEN 1 ELSE 0 END AS prediction FROM labelled"
_REPORT_SQL = f"""SELECT class, coalesce(hit / nullif(predicted, 0), 0) AS precision,
    coalesce(hit / nullif(support, 0), 0) AS recall,
    coalesce(2e0 * hit / nullif(predicted + support, 0), 0) AS f1_score, support FROM (
      SELECT c.class, count(*) FILTER (label = c.class AND prediction = c.class) AS hit,
             count(*) FILTER (prediction = c.class) AS predicted, count(*) FILTER (label = c.class) AS support
      FROM ({_PREDICTIONS_SQL}) p, (SELECT DISTINCT quality AS class FROM labelled) c GROUP BY 1)"""


@query(
    "confusion_matrix",
    with_views("labelled", f"SELECT label, prediction, count(*) AS n FROM ({_PREDICTIONS_SQL}) GROUP BY ALL"),
)
def _(spark, folder):
    return evaluate.confusion_matrix(rule_predictions(spark, folder))


@query("class_report", with_views("labelled", _REPORT_SQL))
def _(spark, folder):
    return evaluate.class_report(evaluate.confusion_matrix(rule_predictions(spark, folder)))


@query(
    "weighted_scores",
    with_views(
        "labelled",
        f"SELECT {_round_sql('sum(recall * support) / sum(support)')} AS accuracy, "
        f"{_round_sql('sum(precision * support) / sum(support)')} AS precision, "
        f"{_round_sql('sum(recall * support) / sum(support)')} AS recall, "
        f"{_round_sql('sum(f1_score * support) / sum(support)')} AS f1_score FROM ({_REPORT_SQL})",
    ),
)
def _(spark, folder):
    scored = evaluate.weighted_scores(evaluate.confusion_matrix(rule_predictions(spark, folder)))
    return _rounded(scored, "accuracy", "precision", "recall", "f1_score")


_LANGUAGES = ["de", "en", "es", "fr"]


def class_scores(spark, folder):
    """A score per document and language; deterministic and with many ties."""
    offers = F.array(
        *[
            F.struct(
                F.lit(lang).alias("class"),
                ((F.col("n_chars") * (7 + i) + F.col("doc_id") * i) % 97 / 97).alias("score"),
                (F.col("lang") == lang).alias("is_class"),
            )
            for i, lang in enumerate(_LANGUAGES)
        ]
    )
    return table(spark, folder, "documents").select(F.inline(offers))


_CLASS_SCORES_SQL = " UNION ALL ".join(
    f"SELECT '{lang}' AS class, (n_chars * {7 + i} + doc_id * {i}) % 97 / 97e0 AS score, lang = '{lang}' AS is_class "
    "FROM documents"
    for i, lang in enumerate(_LANGUAGES)
)
_CLASS_AUC_SQL = f"""SELECT class, (sum(avg_rank) FILTER (is_class) - any_value(p) * (any_value(p) + 1) / 2e0)
       / (any_value(p) * any_value(q)) AS auc, any_value(p) AS support FROM (
    SELECT class, is_class,
           rank() OVER (PARTITION BY class ORDER BY score)
             + (count(*) OVER (PARTITION BY class, score) - 1) / 2e0 AS avg_rank,
           count(*) FILTER (is_class) OVER (PARTITION BY class) AS p,
           count(*) FILTER (NOT is_class) OVER (PARTITION BY class) AS q
    FROM ({_CLASS_SCORES_SQL})) GROUP BY class"""


@query("class_auc", f"SELECT class, round(auc, {PLACES}) AS auc, support FROM ({_CLASS_AUC_SQL})")
def _(spark, folder):
    return _rounded(evaluate.class_auc(class_scores(spark, folder)), "auc")


@query(
    "roc_auc_ovr",
    f"SELECT round(sum(auc * support) / sum(support), {PLACES}) AS roc_auc FROM ({_CLASS_AUC_SQL})",
)
def _(spark, folder):
    return _rounded(evaluate.roc_auc_ovr(class_scores(spark, folder)), "roc_auc")
