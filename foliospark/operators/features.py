"""Text and table features, as long tables for SQL and as vectors for MLlib."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    Normalizer,
    OneHotEncoder,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions import text
from foliospark.functions.stopwords import english_stop_words
from foliospark.operators import dictionary, vocabulary
from foliospark.operators.vocabulary import TermTable
from foliospark.plans.scratch import written


def with_grams(
    df: DataFrame,
    text_columns: Sequence[str],
    ngram_range: tuple[int, int] = (1, 2),
    stop_words: list[str] | None = None,
    lowercase: bool = True,
    output: str = "grams",
) -> DataFrame:
    """Add the n-gram array of the joined text columns; stop words go first."""
    stop = english_stop_words() if stop_words is None else stop_words
    words = df.withColumn("_words", text.tokens(text.concat_text(*text_columns), stop, lowercase))
    return words.withColumn(output, text.ngrams("_words", *ngram_range)).drop("_words")


def stored_grams(
    df: DataFrame,
    keep: Sequence[str],
    text_columns: Sequence[str],
    ngram_range: tuple[int, int] = (1, 2),
    output: str = "grams",
    words: str | None = None,
) -> DataFrame:
    """The columns `keep` and the n-gram array, for several passes: the words are cut once and stored.

    Cutting texts into words costs more than all else that is done with n-grams. `words` names
    a column that the words stay in.
    """
    held = words or "_words"
    cut = text.tokens(text.concat_text(*text_columns), english_stop_words())
    stored = written(df.select(*keep, cut.alias(held)), "words")
    grams = stored.withColumn(output, text.ngrams(held, *ngram_range))
    return grams if words else grams.drop(held)


def term_counts(df: DataFrame, id_column: str, grams: str = "grams") -> DataFrame:
    """Rows `(id, term, tf)`. The counting happens inside each row, without a shuffle.

    The outer form of explode keeps the optimizer from adding a second
    evaluation of the whole array as a not-empty filter.
    """
    runs = vocabulary.run_counts(df, grams, [id_column])
    pairs = runs.select(id_column, F.explode_outer("runs").alias("_pair"))
    return pairs.where(F.col("_pair").isNotNull()).select(
        id_column, F.col("_pair.item").alias("term"), F.col("_pair.n").alias("tf")
    )


def document_count(df: DataFrame) -> Column:
    """Number of rows as a scalar subquery."""
    return df.agg(F.count("*")).scalar()


def vocab_join(df: DataFrame, table: TermTable, id_column: str, grams: str = "grams") -> DataFrame:
    """Rows `(id, term, tf)` of the vocabulary's terms only, looked up beside the row."""
    return vocabulary.known_counts(df, table, id_column, grams).withColumnRenamed("value", "tf")


def tfidf(df: DataFrame, table: TermTable, id_column: str, grams: str = "grams") -> DataFrame:
    """Rows `(id, term, tfidf)` with unit length per document.

    One scan: terms are looked up, counted, weighted and scaled batch by batch, and
    only those of the vocabulary become rows. Nothing is exchanged.
    """
    weights = vocabulary.known_counts(df, table, id_column, grams, unit=True)
    return weights.withColumnRenamed("value", "tfidf")


def numeric_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.fill(0, subset=list(columns))


def one_hot(df: DataFrame, column: str, levels: Sequence[str], prefix: str | None = None) -> DataFrame:
    """One 0/1 column per level; all zero for null. In-row, no pivot."""
    prefix = prefix or column
    return df.withColumns(
        {
            f"{prefix}_{level}": F.coalesce((F.col(column) == level).cast("int"), F.lit(0))
            for level in levels
        }
    )


def column_levels(df: DataFrame, column: str) -> list[str]:
    """Sorted distinct values of a column that is to become columns; `dictionary` takes any number."""
    return [r["level"] for r in dictionary.fit_dictionary(df, column).orderBy("index").collect()]


def fit_label_encoder(df: DataFrame, column: str, output: str = "label") -> StringIndexerModel:
    """Classes of a model to 0..k-1 in sorted order, for MLlib; the model is of that size anyway."""
    return StringIndexer(
        inputCol=column, outputCol=output, stringOrderType="alphabetAsc", handleInvalid="keep"
    ).fit(df)


def label_encode(df: DataFrame, column: str, output: str = "label") -> DataFrame:
    """Values to 0..k-1 in sorted order, null for null, for any number of values."""
    return dictionary.encode(df, dictionary.fit_dictionary(df, column), column, output)


def standard_scale(df: DataFrame, columns: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """Zero mean and unit population variance; a constant column becomes 0."""
    stats = df.agg(
        F.struct(
            *[F.avg(c).alias(f"mean_{c}") for c in columns],
            *[F.stddev_pop(c).alias(f"std_{c}") for c in columns],
        )
    ).scalar()
    scaled = {}
    for c in columns:
        centred = F.col(c) - stats[f"mean_{c}"]
        spread = stats[f"std_{c}"]
        scaled[c + suffix] = F.when(spread == 0, F.lit(0.0) * centred).otherwise(
            F.try_divide(centred, spread)
        )
    return df.withColumns(scaled)


def fit_levels(df: DataFrame, column: str) -> tuple[list[Transformer], str, list[str]]:
    """Level lookup and sparse one-hot vector of a column, its name, and the sorted levels.

    A value that was not there when fitting, and null, are all zero.
    """
    index, vector = f"_{column}_index", f"_{column}_levels"
    lookup = StringIndexer(
        inputCol=column, outputCol=index, stringOrderType="alphabetAsc", handleInvalid="keep"
    ).fit(df)
    spread = OneHotEncoder(inputCol=index, outputCol=vector, dropLast=True).fit(lookup.transform(df))
    return [lookup, spread], vector, list(lookup.labels)


class TextVectorizer:
    """Fitted vocabulary and idf weights as a chain of MLlib transformers."""

    def __init__(self, terms: list[str], idf: list[float], grams: str = "grams", output: str = "text"):
        self.terms, self.idf, self.grams = terms, idf, grams
        self.output = output
        counter = CountVectorizerModel.from_vocabulary(terms, inputCol=grams, outputCol="_tf")
        weigher = ElementwiseProduct(
            scalingVec=Vectors.dense(idf), inputCol="_tf", outputCol="_tfidf"
        )
        scaler = Normalizer(p=2.0, inputCol="_tfidf", outputCol=output)
        self.stages: list[Transformer] = [counter, weigher, scaler]

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        grams: str = "grams",
        min_df: int = 2,
        max_df: float = 0.95,
        max_features: int = 5000,
        words: str | None = None,
        ngram_range: tuple[int, int] = (1, 2),
    ) -> "TextVectorizer":
        """Fit on `df`. The vocabulary, at most `max_features` rows, reaches the driver.

        Where `words` names the words that the n-grams of `ngram_range` were made of, they are
        counted instead, which gives the same.
        """
        n_docs = document_count(df)
        if words is None:
            terms = vocabulary.fit_vocabulary(df, n_docs, grams, min_df, max_df, max_features)
        else:
            terms = vocabulary.fit_word_vocabulary(df, n_docs, words, ngram_range, min_df, max_df, max_features)
        rows = (
            terms.select("term", "total", vocabulary.inverse_document_frequency("df", n_docs).alias("idf"))
            .orderBy(F.desc("total"), "term")
            .collect()
        )
        if not rows:
            raise ValueError("no term is left within the document limits")
        return cls([r["term"] for r in rows], [r["idf"] for r in rows], grams)

    def first(self, size: int) -> "TextVectorizer":
        """The vectoriser of the `size` most frequent terms."""
        return TextVectorizer(self.terms[:size], self.idf[:size], self.grams, self.output)

    def transform(self, df: DataFrame) -> DataFrame:
        for stage in self.stages:
            df = stage.transform(df)
        return df.drop("_tf", "_tfidf")


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Text vector, numbers and one-hot columns side by side, sparse."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="keep").transform(df)
