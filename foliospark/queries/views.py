"""Input tables for the registered queries, derived from the given Parquet tables.

Each view exists twice, as DataFrame code for Spark and as SQL text for the
check, so the two sides share nothing but the given tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions.scores import runtime_minutes

AS_OF_YEAR = 2026

# Names the line numbers of an order stand for as metric keys.
METRIC_KEYS = [
    "test_accuracy", "test_f1_score", "test_precision", "test_recall",
    "cv_mean_accuracy", "cv_std", "loss",
]
PARAM_KEYS = ["algorithm", "random_state", "test_size"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def publications(spark: SparkSession, folder: str, more: tuple[str, ...] = ()) -> DataFrame:
    """Documents as publication records: title is the first line, abstract the whole text.

    `more` names further columns of documents to take along in the same scan.
    """
    documents = table(spark, folder, "documents")
    return documents.selectExpr(
        "doc_id",
        "cast(doc_id as string) as arxiv_id",
        "split_part(text, '\n', 1) as title",
        "text as abstract",
        "replace(split_part(text, '.', 1), ' ', ', ') as authors",
        "concat(lang, ',, ', source, ', ', lang) as keywords",
        "concat(lang, ', ', source) as arxiv_categories",
        """case doc_id % 5 when 0 then 'Nature Methods' when 1 then 'IEEE TMI'
                when 2 then 'Clinical Radiology'
                when 3 then concat('arXiv:', cast(doc_id as string)) end as journal""",
        "cast(2018 + doc_id % 9 as int) as year",
        "n_chars % 260 as cited_by",
        "case when doc_id % 17 <> 0 then concat('10.0/', cast(doc_id as string)) end as doi",
        "date'2018-01-01' + cast(doc_id % 3000 as int) as published_date",
        *more,
    )


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as runs; a run ends at its latest later shipment, if any.

    The latest shipment is reduced per order before the join.
    """
    orders = table(spark, folder, "orders")
    shipped = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.max("l_shipdate").alias("last_ship"))
    )
    return orders.join(shipped, F.col("l_orderkey") == F.col("o_orderkey"), "left").selectExpr(
        "o_orderkey as run_id",
        "o_custkey % 10 as experiment_id",
        """concat(case when o_custkey % 10 = 0 then '_' else '' end, 'exp_',
                  cast(o_custkey % 10 as string)) as experiment_name""",
        """concat(case o_orderkey % 3 when 0 then 'RF_' when 1 then 'SVM_' else 'LR_' end,
                  cast(o_orderkey as string)) as run_name""",
        "o_orderpriority as algorithm",
        """case o_orderstatus when 'F' then 'completed' when 'O' then 'running'
                else 'failed' end as status""",
        "o_orderdate as created",
        "case when last_ship > o_orderdate then last_ship end as completed",
        "o_totalprice / 500000e0 as test_accuracy",
        "case when o_custkey % 7 <> 0 then o_totalprice / 600000e0 end as test_f1_score",
        "o_custkey as baseline_id",
    ).withColumn("runtime_min", runtime_minutes("created", "completed"))


def run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as a metric series: keys repeat, so final values need their order."""
    key = F.element_at(F.array(*[F.lit(k) for k in METRIC_KEYS]), F.col("l_linenumber"))
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("run_id"),
        key.alias("key"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_partkey").alias("step"),
        (F.col("l_extendedprice") / F.lit(110000.0)).alias("value"),
    )


def run_params(spark: SparkSession, folder: str) -> DataFrame:
    pairs = """inline(array(
        named_struct('key', 'algorithm', 'value', o_orderpriority),
        named_struct('key', 'random_state', 'value', cast(o_custkey % 100 as string)),
        named_struct('key', 'test_size',
                     'value', if(o_custkey % 5 = 0, '0.3', '0.2'))))"""
    return table(spark, folder, "orders").selectExpr("o_orderkey as run_id", pairs)


def run_tags(spark: SparkSession, folder: str) -> DataFrame:
    pairs = """inline(array(
        named_struct('key', 'mlflow.runName', 'value', concat('run_', cast(o_orderkey as string))),
        named_struct('key', 'owner', 'value', concat('c', cast(o_custkey as string)))))"""
    return table(spark, folder, "orders").selectExpr("o_orderkey as run_id", pairs)


def statuses(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(
        "event_id",
        "ts",
        "user_id",
        """case event_type when 'purchase' then 'completed' when 'error' then 'failed'
                when 'view' then 'running' when 'click' then 'stopped' else 'queued' end as status""",
    )


def sweep_results(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as sweep results: failed ones have no scores."""
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey as run_id",
        "concat('run_', cast(o_orderkey as string)) as run_name",
        "o_orderpriority as algorithm",
        "case when o_orderstatus = 'P' then 'failed' else 'success' end as status",
        "case when o_orderstatus <> 'P' then o_totalprice / 500000e0 end as test_accuracy",
        "case when o_orderstatus <> 'P' then (o_totalprice % 1000e0) / 1000e0 end as test_f1_score",
    )


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels")
    return table(spark, folder, "documents").join(labels, "doc_id")


def model_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as versions of one model per customer."""
    return table(spark, folder, "orders").selectExpr(
        "concat('model_', cast(o_custkey as string)) as name",
        "o_orderkey as version",
        """case o_orderstatus when 'F' then 'Production' when 'O' then 'Staging'
                else 'None' end as stage""",
        "o_totalprice / 500000e0 as accuracy",
        "case when o_custkey % 7 <> 0 then o_totalprice / 600000e0 end as f1_score",
    )


# The same views as SQL text.
VIEW_SQL = {
    "publications": """
        SELECT doc_id, CAST(doc_id AS VARCHAR) AS arxiv_id,
               split_part(text, chr(10), 1) AS title, text AS abstract,
               replace(split_part(text, '.', 1), ' ', ', ') AS authors,
               concat(lang, ',, ', source, ', ', lang) AS keywords,
               concat(lang, ', ', source) AS arxiv_categories,
               CASE doc_id % 5 WHEN 0 THEN 'Nature Methods' WHEN 1 THEN 'IEEE TMI'
                    WHEN 2 THEN 'Clinical Radiology'
                    WHEN 3 THEN concat('arXiv:', CAST(doc_id AS VARCHAR)) END AS journal,
               CAST(2018 + doc_id % 9 AS INT) AS year,
               n_chars % 260 AS cited_by,
               CASE WHEN doc_id % 17 <> 0 THEN concat('10.0/', CAST(doc_id AS VARCHAR)) END AS doi,
               DATE '2018-01-01' + CAST(doc_id % 3000 AS INT) AS published_date
        FROM documents""",
    "runs": """
        SELECT o_orderkey AS run_id, o_custkey % 10 AS experiment_id,
               concat(CASE WHEN o_custkey % 10 = 0 THEN '_' ELSE '' END, 'exp_',
                      CAST(o_custkey % 10 AS VARCHAR)) AS experiment_name,
               concat(CASE o_orderkey % 3 WHEN 0 THEN 'RF_' WHEN 1 THEN 'SVM_' ELSE 'LR_' END,
                      CAST(o_orderkey AS VARCHAR)) AS run_name,
               o_orderpriority AS algorithm,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'running'
                    ELSE 'failed' END AS status,
               o_orderdate AS created, s.completed,
               o_totalprice / 500000e0 AS test_accuracy,
               CASE WHEN o_custkey % 7 <> 0 THEN o_totalprice / 600000e0 END AS test_f1_score,
               o_custkey AS baseline_id,
               epoch_us(s.completed - o_orderdate) / 6e7 AS runtime_min
        FROM orders LEFT JOIN (
          SELECT o2.o_orderkey AS k, max(l_shipdate) AS completed
          FROM orders o2 JOIN lineitem ON l_orderkey = o2.o_orderkey
                                      AND l_shipdate > o2.o_orderdate
          GROUP BY o2.o_orderkey) s ON s.k = o_orderkey""",
    "run_metrics": """
        SELECT l_orderkey AS run_id,
               CASE l_linenumber WHEN 1 THEN 'test_accuracy' WHEN 2 THEN 'test_f1_score'
                    WHEN 3 THEN 'test_precision' WHEN 4 THEN 'test_recall'
                    WHEN 5 THEN 'cv_mean_accuracy' WHEN 6 THEN 'cv_std' WHEN 7 THEN 'loss' END AS key,
               l_shipdate AS ts, l_partkey AS step, l_extendedprice / 110000e0 AS value
        FROM lineitem""",
    "final_metrics": """
        SELECT run_id, key, value FROM run_metrics
        QUALIFY row_number() OVER (PARTITION BY run_id, key
                                   ORDER BY step DESC, ts DESC, value DESC) = 1""",
    "run_params": """
        SELECT o_orderkey AS run_id, 'algorithm' AS key, o_orderpriority AS value FROM orders
        UNION ALL SELECT o_orderkey, 'random_state', CAST(o_custkey % 100 AS VARCHAR) FROM orders
        UNION ALL SELECT o_orderkey, 'test_size',
                         CASE WHEN o_custkey % 5 = 0 THEN '0.3' ELSE '0.2' END FROM orders""",
    "wide_runs": """
        SELECT r.*, m.*  EXCLUDE (rid),
               r.algorithm AS param_algorithm, p.random_state AS param_random_state,
               p.test_size AS param_test_size
        FROM runs r
        LEFT JOIN (SELECT run_id AS rid,
             max(CASE WHEN key = 'test_accuracy' THEN value END) AS metric_test_accuracy,
             max(CASE WHEN key = 'test_f1_score' THEN value END) AS metric_test_f1_score,
             max(CASE WHEN key = 'test_precision' THEN value END) AS metric_test_precision,
             max(CASE WHEN key = 'test_recall' THEN value END) AS metric_test_recall,
             max(CASE WHEN key = 'cv_mean_accuracy' THEN value END) AS metric_cv_mean_accuracy,
             max(CASE WHEN key = 'cv_std' THEN value END) AS metric_cv_std,
             max(CASE WHEN key = 'loss' THEN value END) AS metric_loss
           FROM final_metrics GROUP BY run_id) m ON m.rid = r.run_id
        LEFT JOIN (SELECT run_id AS pid,
             max(CASE WHEN key = 'random_state' THEN value END) AS random_state,
             max(CASE WHEN key = 'test_size' THEN value END) AS test_size
           FROM run_params GROUP BY run_id) p ON p.pid = r.run_id""",
    "statuses": """
        SELECT event_id, ts, user_id,
               CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed'
                    WHEN 'view' THEN 'running' WHEN 'click' THEN 'stopped'
                    ELSE 'queued' END AS status
        FROM events""",
    "sweep_results": """
        SELECT o_orderkey AS run_id, concat('run_', CAST(o_orderkey AS VARCHAR)) AS run_name,
               o_orderpriority AS algorithm,
               CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'success' END AS status,
               CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 500000e0 END AS test_accuracy,
               CASE WHEN o_orderstatus <> 'P' THEN (o_totalprice % 1000e0) / 1000e0 END AS test_f1_score
        FROM orders""",
    "labelled": """
        SELECT d.*, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "model_versions": """
        SELECT concat('model_', CAST(o_custkey AS VARCHAR)) AS name, o_orderkey AS version,
               CASE o_orderstatus WHEN 'F' THEN 'Production' WHEN 'O' THEN 'Staging'
                    ELSE 'None' END AS stage,
               o_totalprice / 500000e0 AS accuracy,
               CASE WHEN o_custkey % 7 <> 0 THEN o_totalprice / 600000e0 END AS f1_score
        FROM orders""",
    "status_windows": """
        SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS w,
               count(*) FILTER (status IN ('completed', 'failed', 'running', 'stopped')) AS total_tasks,
               count(*) FILTER (status = 'completed') AS completed,
               count(*) FILTER (status = 'failed') AS failed,
               count(*) FILTER (status = 'running') AS running,
               count(*) FILTER (status = 'stopped') AS stopped,
               coalesce(round_even(count(*) FILTER (status = 'completed') * 1e0 / nullif(count(*)
                 FILTER (status IN ('completed', 'failed', 'running', 'stopped')), 0) * 100, 2), 0e0)
                 AS success_rate
        FROM statuses GROUP BY 1""",
}

_NEEDS = {
    "final_metrics": ["run_metrics"],
    "wide_runs": ["runs", "final_metrics", "run_params"],
    "status_windows": ["statuses"],
}


def with_views(names: str, body: str) -> str:
    """`body` with the named views (space separated) defined in front of it."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in _NEEDS.get(name, []):
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in ordered) + "\n" + body
