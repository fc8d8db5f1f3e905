"""Queries over publications: scalar columns, filters and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliospark.functions import scores, text
from foliospark.operators import profile, publications as pubs
from foliospark.queries.registry import query
from foliospark.queries.views import AS_OF_YEAR, publications, table, with_views

_NON_WORD = r"[^\p{L}\p{N}_\t-\r\x{1C}-\x{20}\x{85}\p{Z}]"
_SPACE = r"[\t-\r\x{1C}-\x{20}\x{85}\p{Z}]+"
_STRIP = rf"^{_SPACE}|{_SPACE}$"


def _clean_sql(c: str) -> str:
    spaced = f"regexp_replace(lower({c}), '{_NON_WORD}', ' ', 'g')"
    return f"coalesce(trim(regexp_replace({spaced}, '{_SPACE}', ' ', 'g')), '')"


def _cut_sql(c: str, edges, labels) -> str:
    whens = " ".join(
        f"WHEN {c} > {low} AND {c} <= {high} THEN '{label}'"
        for low, high, label in zip(edges, edges[1:], labels)
    )
    return f"CASE {whens} WHEN {c} > {edges[-1]} THEN '{labels[-1]}' END"


def _journal_sql(c: str) -> str:
    return (
        f"CASE WHEN regexp_matches(lower({c}), 'nature|science|cell') THEN 'top_tier' "
        f"WHEN regexp_matches(lower({c}), 'ieee|acm|springer') THEN 'technical' "
        f"WHEN regexp_matches(lower({c}), 'medical|medicine|clinical') THEN 'medical' "
        "ELSE 'other' END"
    )


def _keywords_sql(c: str) -> str:
    return (
        f"list_filter(list_transform(string_split({c}, ','), "
        f"lambda x: regexp_replace(x, '{_STRIP}', '', 'g')), lambda x: x <> '')"
    )


_IMPACT_SQL = (
    "round_even(ln(1 + cited_by / greatest(1, {y} - year)::DOUBLE) "
    "/ sqrt(greatest(1, {y} - year)), 3)".format(y=AS_OF_YEAR)
)
_AUTHORS_SQL = "len(authors) - len(replace(authors, ',', '')) + 1"


def _words_sql(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '{_SPACE}'), lambda x: x <> '')"


@query("clean_text", with_views("publications", f"SELECT doc_id, {_clean_sql('abstract')} AS cleaned FROM publications"))
def _(spark, folder):
    return publications(spark, folder).select("doc_id", text.clean_text("abstract").alias("cleaned"))


_BARE_SQL = (
    r"regexp_replace(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), "
    r"'\$[^$]+\$', '', 'g'), '\\[a-zA-Z]+\{[^}]*\}', '', 'g')"
)


@query("clean_text_markup", f"SELECT page_id, {_clean_sql(_BARE_SQL)} AS cleaned FROM pages")
def _(spark, folder):
    return table(spark, folder, "pages").select("page_id", text.clean_text_markup("html").alias("cleaned"))


@query(
    "title_abstract_cleaned",
    with_views(
        "publications",
        f"SELECT doc_id, {_clean_sql('title')} AS title_cleaned, "
        f"{_clean_sql('abstract')} AS abstract_cleaned FROM publications",
    ),
)
def _(spark, folder):
    return publications(spark, folder).select(
        "doc_id",
        text.clean_text("title").alias("title_cleaned"),
        text.clean_text("abstract").alias("abstract_cleaned"),
    )


@query(
    "keywords_list",
    with_views(
        "publications",
        f"SELECT doc_id, array_to_string({_keywords_sql('keywords')}, '|') AS keywords, "
        f"array_to_string({_keywords_sql('authors')}, '|') AS authors FROM publications",
    ),
)
def _(spark, folder):
    return publications(spark, folder).select(
        "doc_id",
        F.array_join(text.keywords_list("keywords"), "|").alias("keywords"),
        F.array_join(text.keywords_list("authors"), "|").alias("authors"),
    )


@query(
    "num_keywords",
    with_views(
        "publications",
        f"SELECT doc_id, len({_keywords_sql('keywords')})::INT AS num_keywords FROM publications",
    ),
)
def _(spark, folder):
    return publications(spark, folder).select(
        "doc_id", F.size(text.keywords_list("keywords")).alias("num_keywords")
    )


@query(
    "journal_category",
    with_views("publications", f"SELECT doc_id, {_journal_sql('journal')} AS journal_category FROM publications"),
)
def _(spark, folder):
    return publications(spark, folder).select(
        "doc_id", scores.journal_category("journal").alias("journal_category")
    )


@query(
    "impact_score",
    with_views("publications", f"SELECT doc_id, {_IMPACT_SQL} AS impact_score FROM publications"),
)
def _(spark, folder):
    return publications(spark, folder).select(
        "doc_id", scores.impact_score("cited_by", "year", AS_OF_YEAR).alias("impact_score")
    )


@query(
    "text_length",
    with_views(
        "publications",
        "SELECT doc_id, len(title)::INT AS title_length, len(abstract)::INT AS abstract_length FROM publications",
    ),
)
def _(spark, folder):
    return publications(spark, folder).select(
        "doc_id", F.length("title").alias("title_length"), F.length("abstract").alias("abstract_length")
    )


@query(
    "author_count",
    with_views("publications", f"SELECT doc_id, ({_AUTHORS_SQL})::INT AS author_count FROM publications"),
)
def _(spark, folder):
    return publications(spark, folder).select("doc_id", text.separator_count("authors").alias("author_count"))


def _register_bin(name: str, column, sql_column: str, bins) -> None:
    edges, labels = bins

    @query(name, with_views("publications", f"SELECT doc_id, {_cut_sql(sql_column, edges, labels)} AS bin FROM publications"))
    def _(spark, folder):
        return publications(spark, folder).select("doc_id", scores.cut(column(), edges, labels).alias("bin"))


_register_bin("bin_abstract", lambda: F.length("abstract"), "len(abstract)", scores.ABSTRACT_BINS)
_register_bin("bin_citation", lambda: F.col("cited_by"), "cited_by", scores.CITATION_BINS)
_register_bin("bin_year", lambda: F.col("year"), "year", scores.YEAR_BINS)
_register_bin("bin_author_count", lambda: text.separator_count("authors"), f"({_AUTHORS_SQL})", scores.AUTHOR_BINS)

_PRICE_BINS = ([0.0, 50000.0, 150000.0, 400000.0], ["small", "middle", "large", "huge"])


@query(
    "bin_generic",
    f"""SELECT bin, bin_index, count(*) AS n FROM (
          SELECT {_cut_sql('o_totalprice', *_PRICE_BINS)} AS bin,
                 CASE WHEN o_totalprice > 400000 THEN 3 WHEN o_totalprice > 150000 THEN 2
                      WHEN o_totalprice > 50000 THEN 1 WHEN o_totalprice > 0 THEN 0 END AS bin_index
          FROM orders) GROUP BY ALL""",
)
def _(spark, folder):
    binned = table(spark, folder, "orders").select(
        scores.cut("o_totalprice", *_PRICE_BINS).alias("bin"),
        scores.cut_index("o_totalprice", _PRICE_BINS[0]).alias("bin_index"),
    )
    return binned.groupBy("bin", "bin_index").agg(F.count("*").alias("n"))


@query(
    "concat_text_cols",
    with_views(
        "publications",
        "SELECT doc_id, concat(coalesce(title, ''), ' ', coalesce(journal, ''), ' ', "
        "coalesce(keywords, '')) AS joined FROM publications",
    ),
)
def _(spark, folder):
    return publications(spark, folder).select(
        "doc_id", text.concat_text("title", "journal", "keywords").alias("joined")
    )


@query(
    "word_counts",
    with_views(
        "publications",
        f"SELECT doc_id, len({_words_sql('title')})::INT AS title_words, "
        f"len({_words_sql('abstract')})::INT AS abstract_words FROM publications",
    ),
)
def _(spark, folder):
    return publications(spark, folder).select(
        "doc_id",
        text.word_count("title").alias("title_words"),
        text.word_count("abstract").alias("abstract_words"),
    )


@query(
    "list_counts",
    with_views(
        "publications",
        "SELECT doc_id, len(string_split(authors, ','))::INT AS authors, "
        "len(string_split(arxiv_categories, ','))::INT AS categories FROM publications",
    ),
)
def _(spark, folder):
    return publications(spark, folder).select(
        "doc_id",
        text.list_count("authors").alias("authors"),
        text.list_count("arxiv_categories").alias("categories"),
    )


@query(
    "date_parts",
    with_views(
        "publications",
        "SELECT doc_id, year(published_date)::INT AS y, month(published_date)::INT AS m, "
        "(isodow(published_date) - 1)::INT AS dow FROM publications",
    ),
)
def _(spark, folder):
    return publications(spark, folder).select(
        "doc_id",
        F.year("published_date").alias("y"),
        F.month("published_date").alias("m"),
        F.weekday("published_date").alias("dow"),
    )


@query(
    "primary_category",
    with_views(
        "publications",
        f"SELECT doc_id, coalesce({_words_sql('arxiv_categories')}[1], 'unknown') AS category FROM publications",
    ),
)
def _(spark, folder):
    return publications(spark, folder).select(
        "doc_id", text.primary_category("arxiv_categories").alias("category")
    )


@query(
    "metadata_features",
    with_views(
        "publications",
        f"""SELECT doc_id, len(title)::INT AS title_length,
                   len({_words_sql('title')})::INT AS title_word_count,
                   len(abstract)::INT AS abstract_length,
                   len({_words_sql('abstract')})::INT AS abstract_word_count,
                   len(string_split(authors, ','))::INT AS author_count,
                   len({_words_sql('arxiv_categories')})::INT AS category_count,
                   year(published_date)::INT AS publication_year,
                   month(published_date)::INT AS publication_month,
                   (isodow(published_date) - 1)::INT AS publication_dow FROM publications""",
    ),
)
def _(spark, folder):
    return pubs.metadata_features(publications(spark, folder)).select(
        "doc_id", "title_length", "title_word_count", "abstract_length", "abstract_word_count",
        "author_count", "category_count", "publication_year", "publication_month", "publication_dow",
    )


_DERIVED_SQL = f"""
    SELECT *, {_clean_sql('title')} AS title_cleaned, {_clean_sql('abstract')} AS abstract_cleaned,
           {_keywords_sql('keywords')} AS keywords_list, {_journal_sql('journal')} AS journal_category,
           {_IMPACT_SQL} AS impact_score, len(title)::INT AS title_length,
           len(abstract)::INT AS abstract_length, ({_AUTHORS_SQL})::INT AS author_count,
           len({_keywords_sql('keywords')})::INT AS num_keywords,
           {_cut_sql('len(abstract)', *scores.ABSTRACT_BINS)} AS abstract_category,
           {_cut_sql('cited_by', *scores.CITATION_BINS)} AS citation_category,
           {_cut_sql('year', *scores.YEAR_BINS)} AS year_category,
           {_cut_sql(f'({_AUTHORS_SQL})', *scores.AUTHOR_BINS)} AS author_count_category
    FROM publications WHERE title IS NOT NULL AND abstract IS NOT NULL AND doi IS NOT NULL"""


@query(
    "publications_processed",
    with_views(
        "publications",
        f"SELECT * EXCLUDE (keywords_list), array_to_string(keywords_list, '|') AS keywords_list "
        f"FROM ({_DERIVED_SQL})",
    ),
)
def _(spark, folder):
    derived = pubs.drop_incomplete(pubs.derive_publications(publications(spark, folder), AS_OF_YEAR))
    return derived.withColumn("keywords_list", F.array_join("keywords_list", "|"))


def length_by_bin(spark, folder):
    """Count, mean length and mean score per abstract bin of the complete publications."""
    derived = pubs.derive_publications(publications(spark, folder), AS_OF_YEAR)
    return (
        pubs.drop_incomplete(derived)
        .groupBy("abstract_category")
        .agg(
            F.count("*").alias("n"),
            F.round(F.avg("abstract_length"), 6).alias("mean_length"),
            F.sum("num_keywords").alias("keywords"),
            F.sum(F.length("abstract_cleaned")).alias("cleaned_chars"),
        )
    )


query(
    "length_by_bin",
    with_views(
        "publications",
        f"SELECT abstract_category, count(*) AS n, round(avg(abstract_length), 6) AS mean_length, "
        f"sum(num_keywords)::BIGINT AS keywords, sum(len(abstract_cleaned))::BIGINT AS cleaned_chars "
        f"FROM ({_DERIVED_SQL}) GROUP BY 1",
    ),
)(length_by_bin)


# ---- filters ----------------------------------------------------------------


@query(
    "drop_incomplete",
    with_views(
        "publications",
        "SELECT count(*) AS rows_before, "
        "count(*) FILTER (title IS NOT NULL AND abstract IS NOT NULL AND doi IS NOT NULL) AS rows_kept, "
        "count(*) FILTER (title IS NULL OR abstract IS NULL OR doi IS NULL) AS rows_removed FROM publications",
    ),
)
def _(spark, folder):
    return pubs.removed_counts(publications(spark, folder))


@query(
    "min_text_length",
    with_views(
        "publications",
        f"""SELECT doc_id, CASE WHEN len(regexp_replace(title, '{_STRIP}', '', 'g')) >= 50 THEN NULL
                   ELSE 'title too short' END AS reason FROM publications""",
    ),
)
def _(spark, folder):
    enough, rejected = pubs.split_by_text_length(publications(spark, folder), "title", 50)
    return enough.select("doc_id", F.lit(None).cast("string").alias("reason")).unionByName(
        rejected.select("doc_id", "reason")
    )


# ---- profiles ---------------------------------------------------------------


@query(
    "dataset_profile",
    with_views(
        "publications",
        "SELECT count(*) AS total_papers, min(year) AS min_year, max(year) AS max_year FROM publications",
    ),
)
def _(spark, folder):
    return profile.dataset_profile(publications(spark, folder))


_CATEGORY_SQL = (
    "SELECT c AS category, count(*) AS n FROM (SELECT unnest(string_split(arxiv_categories, ', ')) AS c "
    "FROM publications WHERE arxiv_categories <> '') GROUP BY 1"
)


@query("category_top10", with_views("publications", f"{_CATEGORY_SQL} ORDER BY n DESC, category LIMIT 10"))
def _(spark, folder):
    return profile.top_categories(publications(spark, folder))


@query(
    "category_total",
    with_views("publications", f"SELECT count(*) AS total_categories FROM ({_CATEGORY_SQL})"),
)
def _(spark, folder):
    return profile.category_counts(publications(spark, folder)).agg(F.count("*").alias("total_categories"))


_TRUTHY = ["title", "abstract", "authors", "arxiv_categories", "journal"]


@query(
    "completeness_truthy",
    with_views(
        "publications",
        "SELECT " + ", ".join(f"count(*) FILTER ({c} IS NOT NULL AND {c} <> '') AS {c}" for c in _TRUTHY)
        + " FROM publications",
    ),
)
def _(spark, folder):
    return profile.completeness_truthy(publications(spark, folder), _TRUTHY)


_PUB_COLUMNS = (
    "doc_id arxiv_id title abstract authors keywords arxiv_categories journal year cited_by doi published_date"
).split()


@query(
    "completeness_ratio",
    with_views(
        "publications",
        f"SELECT count(*) AS n_rows, {len(_PUB_COLUMNS)}::INT AS n_columns, "
        f"({' + '.join(f'count({c})' for c in _PUB_COLUMNS)}) / (count(*) * {len(_PUB_COLUMNS)})::DOUBLE "
        "AS completeness FROM publications",
    ),
)
def _(spark, folder):
    return profile.completeness_ratio(publications(spark, folder).select(*_PUB_COLUMNS))


_ORDER_NUMBERS = ["o_orderkey", "o_custkey", "o_totalprice"]


@query(
    "frame_profile",
    f"""SELECT count(*) AS n_rows, 6::INT AS n_columns,
               ({' + '.join(f"(count(*) - count({c}))" for c in _ORDER_NUMBERS + ['o_orderstatus', 'o_orderdate', 'o_orderpriority'])})::BIGINT AS missing_values,
               0e0 AS missing_percentage, 3::INT AS numeric_columns,
               round(({' + '.join(f'avg({c})' for c in _ORDER_NUMBERS)}) / 3, 4) AS mean_of_means,
               round(({' + '.join(f'stddev_samp({c})' for c in _ORDER_NUMBERS)}) / 3, 4) AS mean_of_stds
        FROM orders""",
)
def _(spark, folder):
    profiled = profile.frame_profile(table(spark, folder, "orders"))
    return profiled.withColumns(
        {c: F.round(c, 4) for c in ("missing_percentage", "mean_of_means", "mean_of_stds")}
    )


@query(
    "training_profile",
    with_views(
        "publications",
        f"SELECT count(*) AS samples, {len(_PUB_COLUMNS) - 1}::INT AS features, "
        "count(DISTINCT arxiv_categories) AS classes, "
        f"({' + '.join(f'(count(*) - count({c}))' for c in _PUB_COLUMNS)})::BIGINT AS missing_values FROM publications",
    ),
)
def _(spark, folder):
    return profile.training_profile(publications(spark, folder).select(*_PUB_COLUMNS), "arxiv_categories")


@query(
    "target_distribution",
    with_views("publications", "SELECT arxiv_categories AS target, count(*) AS n FROM publications GROUP BY 1"),
)
def _(spark, folder):
    return profile.target_distribution(publications(spark, folder), "arxiv_categories")


_LINE_NUMBERS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax",
]


@query(
    "numeric_columns",
    "SELECT " + ", ".join(f"max({c}) AS {c}" for c in _LINE_NUMBERS) + " FROM lineitem",
)
def _(spark, folder):
    lines = table(spark, folder, "lineitem")
    return lines.agg(*[F.max(c).alias(c) for c in profile.numeric_columns(lines)])
