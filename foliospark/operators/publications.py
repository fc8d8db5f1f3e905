"""Publication table: derived columns, required columns, text rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.functions import scores, text

# Columns a publication must have to be kept.
REQUIRED = ["title", "abstract", "doi"]


def derive_publications(df: DataFrame, as_of_year: int) -> DataFrame:
    """Add the thirteen derived columns; one narrow pass, no shuffle."""
    measured = df.withColumns(
        {
            "title_cleaned": text.clean_text("title"),
            "abstract_cleaned": text.clean_text("abstract"),
            "keywords_list": text.keywords_list("keywords"),
            "journal_category": scores.journal_category("journal"),
            "impact_score": scores.impact_score("cited_by", "year", as_of_year),
            "title_length": F.length("title"),
            "abstract_length": F.length("abstract"),
            "author_count": text.separator_count("authors"),
        }
    )
    return measured.withColumns(
        {
            "num_keywords": F.size("keywords_list"),
            "abstract_category": scores.cut("abstract_length", *scores.ABSTRACT_BINS),
            "citation_category": scores.cut("cited_by", *scores.CITATION_BINS),
            "year_category": scores.cut("year", *scores.YEAR_BINS),
            "author_count_category": scores.cut("author_count", *scores.AUTHOR_BINS),
        }
    )


def drop_incomplete(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    return df.na.drop(subset=required or REQUIRED)


def removed_counts(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Rows before, kept and removed by `drop_incomplete`, in one pass."""
    kept = F.lit(True)
    for c in required or REQUIRED:
        kept = kept & F.col(c).isNotNull()
    return df.agg(
        F.count("*").alias("rows_before"),
        F.count_if(kept).alias("rows_kept"),
        F.count_if(~kept).alias("rows_removed"),
    )


def split_by_text_length(
    df: DataFrame, column: str = "abstract", minimum: int = 50
) -> tuple[DataFrame, DataFrame]:
    """Rows whose stripped text is long enough, and the rest with a reason."""
    enough = F.coalesce(F.length(text.strip_whitespace(column)) >= minimum, F.lit(False))
    rejected = df.where(~enough).withColumn("reason", F.lit(f"{column} too short"))
    return df.where(enough), rejected


def metadata_features(df: DataFrame) -> DataFrame:
    """Documented extra features: lengths, word counts, list counts, date parts."""
    return df.withColumns(
        {
            "title_length": F.length("title"),
            "title_word_count": text.word_count("title"),
            "abstract_length": F.length("abstract"),
            "abstract_word_count": text.word_count("abstract"),
            "author_count": text.list_count("authors"),
            "category_count": text.word_count("arxiv_categories"),
            "publication_year": F.year("published_date"),
            "publication_month": F.month("published_date"),
            "publication_dow": F.weekday("published_date"),
        }
    )
