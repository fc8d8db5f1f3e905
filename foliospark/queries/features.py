"""Queries over text features, encodings and splits."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from foliospark.functions.scores import ABSTRACT_BINS, JOURNAL_GROUPS, JOURNAL_OTHER, split_hash
from foliospark.functions.stopwords import english_stop_words
from foliospark.operators import dictionary, features, model, vocabulary
from foliospark.operators.publications import derive_publications
from foliospark.operators.vocabulary import TermTable
from foliospark.queries import views
from foliospark.queries.publications import _DERIVED_SQL
from foliospark.queries.registry import query
from foliospark.queries.views import AS_OF_YEAR, table, with_views

TEXT_COLUMNS = ["title", "abstract", "keywords"]
MAX_FEATURES = 5000

_STOP_SQL = ", ".join("'" + w.replace("'", "''") + "'" for w in english_stop_words())
_JOINED_SQL = "concat(coalesce(title, ''), ' ', coalesce(abstract, ''), ' ', coalesce(keywords, ''))"
_TOKENS_SQL = (
    "list_filter(string_split(regexp_replace(lower(" + _JOINED_SQL + r"), '[^\p{L}\p{N}_]+', ' ', 'g'), ' '), "
    f"lambda w: len(w) >= 2 AND w NOT IN ({_STOP_SQL}))"
)
_PAIRS_SQL = "list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1]))"
_TRIPLES_SQL = "list_transform(range(1, len(w) - 1), lambda i: concat(w[i], ' ', w[i + 1], ' ', w[i + 2]))"


def _text_sql(body: str) -> str:
    """`body` over: words(doc_id, w), grams(doc_id, term), tf, nd(n), vocabulary."""
    return with_views(
        "publications",
        f""", words AS (SELECT doc_id, {_TOKENS_SQL} AS w FROM publications),
             grams AS (SELECT doc_id, unnest(list_concat(w, {_PAIRS_SQL})) AS term FROM words),
             tf AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY ALL),
             nd AS (SELECT count(*) AS n FROM publications),
             vocabulary AS (SELECT term, sum(tf)::BIGINT AS total, count(*) AS df FROM tf GROUP BY 1
                            HAVING count(*) >= 2 AND count(*) <= (SELECT n FROM nd) * 0.95e0
                            ORDER BY total DESC, term LIMIT {MAX_FEATURES})
        """ + body,
    )


def gram_table(spark, folder, ngram_range=(1, 2)):
    return features.with_grams(views.publications(spark, folder), TEXT_COLUMNS, ngram_range)


def _grams_and_vocabulary(spark, folder):
    grams = features.stored_grams(views.publications(spark, folder), ["doc_id"], TEXT_COLUMNS, words="_words")
    n_docs = features.document_count(views.publications(spark, folder))
    return grams, vocabulary.fit_word_vocabulary(grams, n_docs, "_words", (1, 2), max_features=MAX_FEATURES), n_docs


@query(
    "tokenize",
    _text_sql("SELECT doc_id, len(w)::INT AS n_tokens, array_to_string(w, ' ') AS tokens FROM words"),
)
def _(spark, folder):
    words = gram_table(spark, folder, (1, 1))
    return words.select(
        "doc_id", F.size("grams").alias("n_tokens"), F.array_join("grams", " ").alias("tokens")
    )


@query(
    "ngrams",
    _text_sql(
        f"SELECT doc_id, array_to_string(list_concat(w, list_concat({_PAIRS_SQL}, {_TRIPLES_SQL})), '|') AS grams "
        "FROM words"
    ),
)
def _(spark, folder):
    return gram_table(spark, folder, (1, 3)).select("doc_id", F.array_join("grams", "|").alias("grams"))


@query("term_counts", _text_sql("SELECT doc_id, term, tf::INT AS tf FROM tf"))
def _(spark, folder):
    return features.term_counts(gram_table(spark, folder), "doc_id")


@query("vocab_prune", _text_sql("SELECT * FROM vocabulary"))
def _(spark, folder):
    return _grams_and_vocabulary(spark, folder)[1]


@query("vocab_join", _text_sql("SELECT doc_id, term, tf::INT AS tf FROM tf JOIN vocabulary USING (term)"))
def _(spark, folder):
    grams, terms, n_docs = _grams_and_vocabulary(spark, folder)
    return features.vocab_join(grams, TermTable(terms, n_docs), "doc_id")


@query(
    "tfidf",
    _text_sql(
        """, w AS (SELECT doc_id, term, tf.tf * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS w
                   FROM tf JOIN vocabulary USING (term), nd)
           SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS tfidf FROM w"""
    ),
)
def _(spark, folder):
    grams, terms, n_docs = _grams_and_vocabulary(spark, folder)
    weights = features.tfidf(grams, TermTable(terms, n_docs), "doc_id")
    return weights.withColumn("tfidf", F.round("tfidf", 6))


@query(
    "numeric_features",
    with_views(
        "runs",
        "SELECT run_id, coalesce(test_accuracy, 0) AS test_accuracy, coalesce(test_f1_score, 0) AS test_f1_score "
        "FROM runs",
    ),
)
def _(spark, folder):
    measured = views.runs(spark, folder).select("run_id", "test_accuracy", "test_f1_score")
    return features.numeric_features(measured, ["test_accuracy", "test_f1_score"])


_JOURNALS = [*[name for name, _ in JOURNAL_GROUPS], JOURNAL_OTHER]


@query(
    "one_hot",
    with_views(
        "publications",
        "SELECT doc_id, "
        + ", ".join(
            f"coalesce((journal_category = '{j}')::INT, 0) AS journal_category_{j}" for j in _JOURNALS
        )
        + ", "
        + ", ".join(
            f"coalesce((abstract_category = '{b}')::INT, 0) AS abstract_category_{b}" for b in ABSTRACT_BINS[1]
        )
        + f" FROM ({_DERIVED_SQL})",
    ),
)
def _(spark, folder):
    derived = derive_publications(views.publications(spark, folder), AS_OF_YEAR).na.drop(
        subset=["title", "abstract", "doi"]
    )
    coded = features.one_hot(
        derived.select("doc_id", "journal_category", "abstract_category"), "journal_category", _JOURNALS
    )
    coded = features.one_hot(coded, "abstract_category", ABSTRACT_BINS[1])
    return coded.drop("journal_category", "abstract_category")


@query(
    "label_encode",
    with_views(
        "publications",
        "SELECT doc_id, arxiv_categories, (SELECT count(DISTINCT p.arxiv_categories) FROM publications p "
        "WHERE p.arxiv_categories < q.arxiv_categories)::INT AS label FROM publications q",
    ),
)
def _(spark, folder):
    labelled = views.publications(spark, folder).select("doc_id", "arxiv_categories")
    coded = features.label_encode(labelled, "arxiv_categories")
    return coded.withColumn("label", F.col("label").cast("int"))


@query(
    "one_hot_sparse",
    """WITH levels AS (SELECT l_partkey AS level, row_number() OVER (ORDER BY l_partkey) - 1 AS i
                       FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY 1)
       SELECT l_orderkey, l_linenumber, (SELECT count(*) FROM levels) AS size, i AS level_index, 1e0 AS value
       FROM lineitem JOIN levels ON level = l_partkey""",
)
def _(spark, folder):
    """A column of many levels: every line's part."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    coded = dictionary.one_hot_sparse(lines, dictionary.fit_dictionary(lines, "l_partkey"), "l_partkey", "v")
    return coded.select(
        "l_orderkey", "l_linenumber", "v.size", F.get("v.indices", F.lit(0)).alias("level_index"),
        F.get("v.values", F.lit(0)).alias("value"),
    )


@query(
    "standard_scale",
    with_views(
        "publications",
        "SELECT doc_id, round((year - avg(year) OVER ()) / stddev_pop(year) OVER (), 6) AS year_scaled, "
        "round((cited_by - avg(cited_by) OVER ()) / stddev_pop(cited_by) OVER (), 6) AS cited_by_scaled "
        "FROM publications",
    ),
)
def _(spark, folder):
    numbers = views.publications(spark, folder).select("doc_id", "year", "cited_by")
    scaled = features.standard_scale(numbers, ["year", "cited_by"])
    return scaled.select(
        "doc_id",
        F.round("year_scaled", 6).alias("year_scaled"),
        F.round("cited_by_scaled", 6).alias("cited_by_scaled"),
    )


def _hash_sql(seed: int = 42) -> str:
    return f"CAST('0x' || md5(CAST(doc_id AS VARCHAR) || '|{seed}')[1:13] AS BIGINT) / 4503599627370496e0"


@query(
    "train_test_split",
    f"SELECT doc_id, CASE WHEN {_hash_sql()} < 0.8e0 THEN 'train' ELSE 'test' END AS part FROM documents",
)
def _(spark, folder):
    train, test = model.train_test_split(table(spark, folder, "documents").select("doc_id"), "doc_id")
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


@query(
    "stratified_folds",
    f"""SELECT doc_id, lang, ((row_number() OVER (PARTITION BY lang ORDER BY {_hash_sql()}, doc_id) - 1) % 5)::INT
               AS fold FROM documents""",
)
def _(spark, folder):
    return model.with_folds(table(spark, folder, "documents").select("doc_id", "lang"), "doc_id", "lang")


@query(
    "split_fraction",
    f"SELECT floor({_hash_sql(7)} * 10)::BIGINT AS decile, count(*) AS n FROM documents GROUP BY 1",
)
def _(spark, folder):
    decile = F.floor(split_hash("doc_id", 7) * 10)
    return table(spark, folder, "documents").groupBy(decile.alias("decile")).agg(F.count("*").alias("n"))


@query(
    "assemble",
    _text_sql(
        f""", ordered AS (SELECT term, df, row_number() OVER (ORDER BY total DESC, term) - 1 AS i FROM vocabulary),
             width AS (SELECT count(*) AS k FROM vocabulary)
           SELECT i::INT AS feature, df::BIGINT AS non_zero FROM ordered
           UNION ALL SELECT (SELECT k FROM width)::INT, count(*) FILTER (year <> 0) FROM publications
           UNION ALL SELECT (SELECT k FROM width)::INT + 1, count(*) FILTER (cited_by <> 0) FROM publications"""
    ),
)
def _(spark, folder):
    grams = features.stored_grams(views.publications(spark, folder), ["year", "cited_by"], TEXT_COLUMNS)
    vectorizer = features.TextVectorizer.fit(grams, max_features=MAX_FEATURES)
    vectors = features.assemble(vectorizer.transform(grams), ["text", "year", "cited_by"])
    counts = vectors.select(Summarizer.numNonZeros(F.col("features")).alias("c"))
    return counts.select(F.posexplode(vector_to_array("c")).alias("feature", "non_zero")).select(
        "feature", F.col("non_zero").cast("bigint").alias("non_zero")
    )
