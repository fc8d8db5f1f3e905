"""Queries that write a table in a source's format and read it back.

The files go to the shared folder of the session, one new path per run.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.operators import profile
from foliospark.plans.scratch import new_path
from foliospark.queries import views
from foliospark.queries.registry import query
from foliospark.queries.views import table, with_views
from foliospark.schemas import struct
from foliospark.sources import feed, manifest, results, run_store, tabular

# Line breaks inside an XML element and outer space are normalised by the reader,
# so both sides see the words of the text.
_URL = "concat('http://arxiv.org/abs/', cast(doc_id as string))"


def feed_entries(spark, folder):
    """Documents as feed entries; every eleventh lacks its summary and must be rejected."""
    return table(spark, folder, "documents").selectExpr(
        f"{_URL} as id",
        "concat('Document ', cast(doc_id as string), ' of ', source) as title",
        "case when doc_id % 11 <> 0 then text end as summary",
        "concat(cast(date'2015-01-01' + cast(doc_id % 3000 as int) as string), 'T10:00:00Z') as published",
        "concat(cast(date'2016-01-01' + cast(doc_id % 3000 as int) as string), 'T10:00:00Z') as updated",
        "array(named_struct('name', source), named_struct('name', concat(lang, ' ', source))) as author",
        "array(named_struct('_term', lang), named_struct('_term', source)) as category",
        f"array(named_struct('_href', {_URL}, '_title', 'html'), "
        f"named_struct('_href', concat({_URL}, '.pdf'), '_title', 'pdf')) as link",
        "case when doc_id % 3 = 0 then concat('Journal of ', source) end as `arxiv:journal_ref`",
        "case when doc_id % 4 = 0 then concat('10.1/', cast(doc_id as string)) end as `arxiv:doi`",
    )


_URL_SQL = "concat('http://arxiv.org/abs/', CAST(doc_id AS VARCHAR))"
_STRIPPED = r"regexp_replace(text, '^[\t-\r\x{1C}-\x{20}\x{85}\p{Z}]+|[\t-\r\x{1C}-\x{20}\x{85}\p{Z}]+$', '', 'g')"
_PUBLICATION_SQL = f"""
    SELECT concat('Document ', CAST(doc_id AS VARCHAR), ' of ', source) AS title,
           concat(source, ', ', lang, ' ', source) AS authors,
           CASE WHEN doc_id % 3 = 0 THEN concat('Journal of ', source)
                ELSE concat('arXiv:', CAST(doc_id AS VARCHAR)) END AS journal,
           year(DATE '2015-01-01' + CAST(doc_id % 3000 AS INT))::INT AS year,
           CASE WHEN doc_id % 4 = 0 THEN concat('10.1/', CAST(doc_id AS VARCHAR)) ELSE {_URL_SQL} END AS doi,
           replace({_STRIPPED}, chr(10), ' ') AS abstract,
           concat(lang, ', ', source) AS keywords, 0::BIGINT AS cited_by,
           concat(lang, ', ', source) AS methodology, 'N/A' AS dataset_used,
           CAST(doc_id AS VARCHAR) AS arxiv_id, concat(lang, ', ', source) AS arxiv_categories,
           DATE '2015-01-01' + CAST(doc_id % 3000 AS INT) AS published_date,
           DATE '2016-01-01' + CAST(doc_id % 3000 AS INT) AS updated_date,
           concat({_URL_SQL}, '.pdf') AS pdf_url, {_URL_SQL} AS arxiv_url
    FROM documents WHERE doc_id % 11 <> 0 AND {_STRIPPED} <> ''"""


def written_feed(spark, folder) -> str:
    """The entries as XML files, without the two prefixed parts an XML writer refuses."""
    path = new_path(spark, "feed")
    entries = feed_entries(spark, folder).drop("arxiv:journal_ref", "arxiv:doi")
    entries.write.format("xml").option("rootTag", "feed").option("rowTag", feed.ROW_TAG).save(path)
    return path


PLAIN_FEED_SQL = (
    f"SELECT * REPLACE (concat('arXiv:', arxiv_id) AS journal, arxiv_url AS doi) FROM ({_PUBLICATION_SQL})"
)


@query("feed_projection", _PUBLICATION_SQL)
def _(spark, folder):
    return feed.publications_from_entries(feed_entries(spark, folder))


@query("src_feed_xml", PLAIN_FEED_SQL)
def _(spark, folder):
    return feed.publications_from_entries(feed.read_feed(spark, written_feed(spark, folder)))


def written_broken_feed(spark, folder) -> str:
    """Feed files with all parts, in which some entries are malformed and some lack parts."""
    path = new_path(spark, "broken_feed")
    entries = feed_entries(spark, folder)
    plain = F.struct(*[c for c in entries.columns if not c.startswith("arxiv:")])
    prefixed = F.concat(
        *[
            F.coalesce(F.concat(F.lit(f"<{c}>"), F.col(f"`{c}`"), F.lit(f"</{c}>")), F.lit(""))
            for c in ("arxiv:journal_ref", "arxiv:doi")
        ]
    )
    end = F.lit("</entry>")
    whole = F.replace(F.to_xml(plain, {"rowTag": "entry"}), end, F.concat(prefixed, end))
    number = F.substring_index("id", "/", -1).cast("long")
    broken = (
        F.when(number % 13 == 0, F.replace(whole, F.lit("</title>"), F.lit("</titel>")))
        .when(number % 17 == 0, F.replace(whole, F.lit("</author>"), F.lit("")))
        .when(number % 19 == 0, F.replace(whole, end, F.lit("")))
        .otherwise(whole)
    )
    entries.select(broken.alias("value")).write.text(path)
    return path


_BROKEN_SQL = "(doc_id % 13 = 0 OR doc_id % 17 = 0 OR doc_id % 19 = 0)"


@query(
    "src_feed_bad_rows",
    f"""SELECT {_URL_SQL} AS id, {_BROKEN_SQL} AS malformed FROM documents
        WHERE {_BROKEN_SQL} OR doc_id % 11 = 0 OR coalesce({_STRIPPED}, '') = ''""",
)
def _(spark, folder):
    _, rejects = feed.split_entries(feed.read_feed(spark, written_broken_feed(spark, folder)))
    return rejects.select(feed.rejected_id().alias("id"), F.col(feed.CORRUPT).isNotNull().alias("malformed"))


@query("src_feed_recovered", f"{_PUBLICATION_SQL} AND NOT {_BROKEN_SQL}")
def _(spark, folder):
    return feed.publications_from_entries(feed.read_feed(spark, written_broken_feed(spark, folder)))


@query(
    "src_feed_page_order",
    with_views(
        "publications",
        "SELECT arxiv_id, published_date FROM publications ORDER BY published_date DESC, arxiv_id LIMIT 100",
    ),
)
def _(spark, folder):
    return feed.newest_first(
        views.publications(spark, folder).select("arxiv_id", "published_date"), 100
    )


def _part(name: str, sql_column: str, column):
    """The single columns of a feed entry, each under its own name."""

    @query(name, f"SELECT arxiv_id, {sql_column} AS value FROM ({_PUBLICATION_SQL})")
    def _(spark, folder):
        made = feed.publications_from_entries(feed_entries(spark, folder))
        return made.select("arxiv_id", column().alias("value"))


_part("feed_ids", "concat(arxiv_id, '|', title, '|', abstract)", lambda: F.concat_ws("|", "arxiv_id", "title", "abstract"))
_part("feed_lists", "concat(authors, '|', arxiv_categories)", lambda: F.concat_ws("|", "authors", "arxiv_categories"))
_part("feed_pdf_link", "pdf_url", lambda: F.col("pdf_url"))
_part("feed_fallbacks", "concat(journal, '|', doi)", lambda: F.concat_ws("|", "journal", "doi"))
_part(
    "feed_dates",
    "concat(CAST(published_date AS VARCHAR), '|', CAST(updated_date AS VARCHAR), '|', CAST(year AS VARCHAR))",
    lambda: F.concat_ws("|", F.col("published_date").cast("string"), F.col("updated_date").cast("string"), F.col("year").cast("string")),
)
_part(
    "feed_constants",
    "concat(CAST(cited_by AS VARCHAR), '|', dataset_used, '|', methodology)",
    lambda: F.concat_ws("|", F.col("cited_by").cast("string"), "dataset_used", "methodology"),
)


# ---- CSV, JSON --------------------------------------------------------------


@query("src_csv", f"SELECT * REPLACE (NULL::VARCHAR AS dataset_used) FROM ({_PUBLICATION_SQL})")
def _(spark, folder):
    path = new_path(spark, "csv")
    tabular.write_csv(feed.publications_from_entries(feed_entries(spark, folder)), path)
    return tabular.read_csv(spark, path)


_SINK_SCHEMA = struct(
    arxiv_id=T.StringType(), keywords_list=T.StringType(), cited_by=T.LongType(), title=T.StringType()
)


@query(
    "sink_csv",
    with_views(
        "publications",
        """SELECT arxiv_id, concat('["', lang, '","', source, '"]') AS keywords_list, cited_by, title
           FROM publications JOIN documents USING (doc_id)""",
    ),
)
def _(spark, folder):
    path = new_path(spark, "csv")
    pubs = views.publications(spark, folder).withColumn("keywords_list", F.split("arxiv_categories", ", "))
    tabular.write_csv(pubs, path, ["arxiv_id", "keywords_list", "cited_by", "title"])
    return tabular.read_csv(spark, path, _SINK_SCHEMA)


@query(
    "sink_json",
    with_views("runs", "SELECT run_id, run_name, test_accuracy, test_f1_score, completed FROM runs"),
)
def _(spark, folder):
    path = new_path(spark, "json")
    runs = views.runs(spark, folder).select("run_id", "run_name", "test_accuracy", "test_f1_score", "completed")
    tabular.write_json(runs, path)
    return tabular.read_json(spark, path, runs.schema)


@query(
    "sink_profile",
    with_views(
        "publications",
        "SELECT count(*) AS total_papers, min(year) AS min_year, max(year) AS max_year FROM publications",
    ),
)
def _(spark, folder):
    path = new_path(spark, "profile")
    found = profile.dataset_profile(views.publications(spark, folder))
    tabular.write_profile(found, path)
    return tabular.read_json(spark, path, found.schema)


# ---- run store and result files ---------------------------------------------


def run_files(spark, folder):
    """Orders as the files of a run store: one row per file, as the reader lists them."""
    return table(spark, folder, "orders").selectExpr(
        """inline(array(
             named_struct('path', concat('/store/', cast(o_custkey % 10 as string), '/r', cast(o_orderkey as string),
                                         '/meta.yaml'),
               'content', concat('artifact_uri: /a\nend_time: ', cast(o_orderkey * 1000 + 1500 as string),
                                 '\nexperiment_id: \\'', cast(o_custkey % 10 as string), '\\'',
                                 '\nlifecycle_stage: active\nrun_id: r', cast(o_orderkey as string),
                                 '\nrun_name: run_', cast(o_orderkey as string),
                                 '\nstart_time: ', cast(o_orderkey * 1000 as string), '\nstatus: 3\n')),
             named_struct('path', concat('/store/', cast(o_custkey % 10 as string), '/r', cast(o_orderkey as string),
                                         '/params/algorithm'), 'content', o_orderpriority),
             named_struct('path', concat('/store/', cast(o_custkey % 10 as string), '/r', cast(o_orderkey as string),
                                         '/tags/mlflow.runName'), 'content', concat('run_', cast(o_orderkey as string))),
             named_struct('path', concat('/store/', cast(o_custkey % 10 as string), '/r', cast(o_orderkey as string),
                                         '/metrics/test_accuracy'),
               'content', concat(cast(o_orderkey as string), ' 0.25 0\n', cast(o_orderkey + 5 as string), ' ',
                                 cast(o_custkey as string), '.5 1\n'))))"""
    )


@query(
    "src_run_store",
    """SELECT concat('r', CAST(o_orderkey AS VARCHAR)) AS run_id, CAST(o_custkey % 10 AS VARCHAR) AS experiment_id,
              concat('run_', CAST(o_orderkey AS VARCHAR)) AS run_name, 3 AS status, o_orderkey * 1000 AS start_time,
              o_orderkey * 1000 + 1500 AS end_time, 'active' AS lifecycle_stage, 1.5e0 AS runtime_sec FROM orders""",
)
def _(spark, folder):
    return run_store.runtime_seconds(run_store.runs(run_files(spark, folder)))


@query(
    "src_run_store_keys",
    """SELECT 'metric' AS kind, concat('r', CAST(o_orderkey AS VARCHAR)) AS run_id, 'test_accuracy' AS key,
              o_orderkey AS ts, 0.25e0 AS number, NULL AS word, 0 AS step FROM orders
       UNION ALL SELECT 'metric', concat('r', CAST(o_orderkey AS VARCHAR)), 'test_accuracy', o_orderkey + 5,
              o_custkey + 0.5e0, NULL, 1 FROM orders
       UNION ALL SELECT 'param', concat('r', CAST(o_orderkey AS VARCHAR)), 'algorithm', NULL, NULL, o_orderpriority,
              NULL FROM orders
       UNION ALL SELECT 'tag', concat('r', CAST(o_orderkey AS VARCHAR)), 'mlflow.runName', NULL, NULL,
              concat('run_', CAST(o_orderkey AS VARCHAR)), NULL FROM orders""",
)
def _(spark, folder):
    files = run_files(spark, folder)
    metrics = run_store.metrics(files).withColumnRenamed("value", "number").withColumn("kind", F.lit("metric"))
    words = [
        rows.withColumnRenamed("value", "word").withColumn("kind", F.lit(kind))
        for kind, rows in (("param", run_store.params(files)), ("tag", run_store.tags(files)))
    ]
    out = metrics
    for rows in words:
        out = out.unionByName(rows, allowMissingColumns=True)
    return out


def result_files(spark, folder):
    """Orders as result and metadata files, one row per file."""
    return table(spark, folder, "orders").selectExpr(
        """inline(array(
             named_struct('path', concat('/experiments/e', cast(o_orderkey as string), '/metrics.json'),
               'content', to_json(named_struct(
                  'cross_validation', named_struct('mean_score', o_totalprice, 'std_score', 0.5e0,
                                                   'scores', array(0.25e0, 0.75e0)),
                  'test_metrics', named_struct('accuracy', o_totalprice / 500000e0, 'f1_score', 0.5e0),
                  'model_info', named_struct('algorithm', o_orderpriority, 'classes', o_custkey % 10),
                  'training_date', cast(o_orderdate as string)))),
             named_struct('path', concat('/experiments/e', cast(o_orderkey as string), '/model_metadata.yaml'),
               'content', concat('name: model_', cast(o_custkey as string), '\nparams:\n  depth: 3\nversion: \\'1.0\\'\n'))))"""
    )


@query(
    "src_result_json",
    """SELECT concat('e', CAST(o_orderkey AS VARCHAR)) AS run_name, o_totalprice AS metric_cv_mean_score,
              o_totalprice / 500000e0 AS metric_test_accuracy, 0.5e0 AS metric_test_f1_score,
              NULL::DOUBLE AS metric_test_roc_auc, o_orderpriority AS algorithm, (o_custkey % 10)::INT AS classes
       FROM orders""",
)
def _(spark, folder):
    return results.results(result_files(spark, folder)).select(
        "run_name", "metric_cv_mean_score", "metric_test_accuracy", "metric_test_f1_score",
        "metric_test_roc_auc", "algorithm", "classes",
    )


@query(
    "src_result_meta",
    """SELECT concat('e', CAST(o_orderkey AS VARCHAR)) AS run_name, 'name' AS key,
              concat('model_', CAST(o_custkey AS VARCHAR)) AS value FROM orders
       UNION ALL SELECT concat('e', CAST(o_orderkey AS VARCHAR)), 'version', '1.0' FROM orders""",
)
def _(spark, folder):
    return results.metadata(result_files(spark, folder))




def _tree(spark, folder, changed: bool):
    """Suppliers as a tree of run and result files; in the changed one every seventh has other values."""
    suppliers = table(spark, folder, "supplier").where("s_suppkey % 7 = 0" if changed else "true")
    now = "cast(s_suppkey % 5 + 10 as string)" if changed else "cast(s_suppkey % 5 as string)"
    return suppliers.selectExpr(
        f"""inline(array(
             named_struct('path', concat(cast(s_nationkey as string), '/r', cast(s_suppkey as string), '/meta.yaml'),
               'content', concat('experiment_id: ', cast(s_nationkey as string), '\nrun_id: r',
                                 cast(s_suppkey as string), '\nstart_time: 1000\nstatus: ', {now}, '\n')),
             named_struct('path', concat(cast(s_nationkey as string), '/r', cast(s_suppkey as string), '/metrics/acc'),
               'content', concat('1 0.5 0\n2 ', {now}, '.25 1\n')),
             named_struct('path', concat('results/e', cast(s_suppkey as string), '/metrics.json'),
               'content', concat('{{"test_metrics": {{"accuracy": ', {now}, '.5}}}}')),
             named_struct('path', concat('results/e', cast(s_suppkey as string), '/model_metadata.yaml'),
               'content', concat('name: model_', {now}, '\nnested:\n  depth: 3\n'))))"""
    )


def _read_twice(spark, folder, parse):
    """Both reads of a real tree that changes in between, stacked: `(read, ...)`."""
    root = new_path(spark, "tree")
    files = manifest.Folder(spark, root, new_path(spark, "manifest"))
    out, reads = new_path(spark, "parsed"), []
    for k in (1, 2):
        manifest.write_files(_tree(spark, folder, changed=k == 2), root)
        rows, _ = files.read(parse, out)
        reads.append(rows.select(F.lit(k).alias("read"), *rows.columns))
    return reads[0].union(reads[1])


_TWICE_SQL = """reads AS (SELECT 1 AS read, s_suppkey, s_nationkey, s_suppkey % 5 AS now FROM supplier
    UNION ALL SELECT 2, s_suppkey, s_nationkey, s_suppkey % 5 + 10 FROM supplier WHERE s_suppkey % 7 = 0)"""


@query(
    "src_run_store_changes",
    f"""WITH {_TWICE_SQL}
        SELECT read, concat('r', s_suppkey) AS run_id, s_nationkey::VARCHAR AS experiment_id, now::INT AS status
        FROM reads""",
)
def _(spark, folder):
    """Run files read twice; the second time only those that changed."""

    def parse(spark, paths):
        return run_store.runs(run_store.read_files(spark, paths)).select("run_id", "experiment_id", "status")

    return _read_twice(spark, folder, parse)


@query(
    "src_result_changes",
    f"""WITH {_TWICE_SQL}
        SELECT read, concat('e', s_suppkey) AS run_name, now + 0.5e0 AS accuracy, concat('model_', now) AS model
        FROM reads""",
)
def _(spark, folder):
    """Result and metadata files read twice; the second time only those that changed."""

    def parse(spark, paths):
        files = results.read_files(spark, paths)
        scores = results.results(files).select("run_name", F.col("metric_test_accuracy").alias("accuracy"))
        names = results.metadata(files).where("key = 'name'").select("run_name", F.col("value").alias("model"))
        return scores.join(names, "run_name")

    return _read_twice(spark, folder, parse)
