"""Column rules on literal edge rows."""

import math
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from foliospark.functions import scores, text


def one(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression).collect()]


def python_clean(value):
    if value is None:
        return ""
    value = re.sub(r"[^\w\s]", " ", value.lower())
    return re.sub(r"\s+", " ", value).strip()


def test_clean_text_matches_python(spark):
    values = [
        None, "", "N/A", "Größe: 5µm!", "étude", "a b c", "  x_y -- z ", "10³ + ½", "日本語、テスト",
        "tab\tnew\nline\r", "\u001c\u0085", "naïve (café)", "_", "...",
    ]
    assert one(spark, values, text.clean_text("c")) == [python_clean(v) for v in values]


def test_clean_text_is_idempotent(spark):
    values = ["A--b  C", "ÄÖ!ü", "x y"]
    once = one(spark, values, text.clean_text("c"))
    assert once == one(spark, once, text.clean_text("c"))


def test_clean_markup(spark):
    values = ["<p>Hi <b>there</b></p> $x^2$ \\cite{abc} ok", None]
    assert one(spark, values, text.clean_text_markup("c")) == ["hi there ok", ""]


def test_keywords(spark):
    values = ["a, ,b,b,", None, "", " x  , y z "]
    assert one(spark, values, text.keywords_list("c")) == [["a", "b", "b"], [], [], ["x", "y z"]]


def test_missing_tokens(spark):
    values = ["N/A", "nan", "", "value", "na", None]
    assert one(spark, values, text.missing_to_null("c")) == [None, None, None, "value", "na", None]


def test_counts(spark):
    values = ["a,b", "a", "", None, "one two  three"]
    assert one(spark, values, text.separator_count("c")) == [2, 1, 1, None, 1]
    assert one(spark, values, text.word_count("c")) == [1, 1, 0, None, 3]
    assert one(spark, values, text.primary_category("c")) == ["a,b", "a", "unknown", "unknown", "one"]


def test_bins_are_left_open(spark):
    values = [0, 1, 50, 51, 100, 101, 200, 201, -1, None]
    expected = [None, "low", "low", "medium", "medium", "high", "high", "very_high", None, None]
    assert one(spark, values, scores.cut("c", *scores.CITATION_BINS), "int") == expected
    index = one(spark, values, scores.cut_index("c", scores.CITATION_BINS[0]), "int")
    assert index == [None, 0, 0, 1, 1, 2, 2, 3, None, None]


def test_journal(spark):
    values = ["Nature", "IEEE Cell", "Acm", "Clinical Medicine", "arXiv:1", None]
    assert one(spark, values, scores.journal_category("c")) == [
        "top_tier", "top_tier", "technical", "medical", "other", "other",
    ]


@pytest.mark.parametrize("year,cited", [(2030, 5), (2026, 5), (2020, 100), (2016, 0)])
def test_impact_score(spark, year, cited):
    row = spark.createDataFrame([(year, cited)], "y int, n bigint")
    age = max(1, 2026 - year)
    expected = round(math.log1p(cited / age) / math.sqrt(age), 3)
    assert row.select(scores.impact_score("n", "y", 2026)).first()[0] == pytest.approx(expected)


def test_round_even(spark):
    values = [0.0005, 0.0015, 0.0025, 1.0005, None]
    assert one(spark, values, scores.round_even("c", 3), "double") == [0.0, 0.002, 0.002, 1.0, None]


def test_labels(spark):
    assert one(spark, ["abcdef", "abc", None], scores.short_label("c", 3)) == ["abc...", "abc", None]
    assert one(spark, ["RF_1", "SVM_x", "other"], scores.algorithm_family("c")) == [
        "Random Forest", "SVM", "Logistic Regression",
    ]
    assert one(spark, [0.95, 0.85, 0.1], scores.quality_tier("c"), "double") == [
        "high_quality", "medium_quality", "low_quality",
    ]
    assert one(spark, ["Test Metrics_test_f1", "metric_x"], scores.metric_name_clean("c")) == ["f1", "x"]


def test_performance_tags_of_a_bare_model(spark):
    row = spark.createDataFrame([(None, None, None)], "a string, s double, v int")
    tags = row.select(scores.performance_tags("a", "s", "v")).first()[0]
    assert tags == ["algorithm_unknown", "v1", "low_quality"]


def test_tokens_and_ngrams(spark):
    words = text.tokens("c", ["the"])
    assert one(spark, ["The cat, a DOG x", "", None], words) == [["cat", "dog"], [], []]
    assert one(spark, ["big red dog", "one"], text.ngrams(text.tokens("c"), 1, 3)) == [
        ["big", "red", "dog", "big red", "red dog", "big red dog"],
        ["one"],
    ]
    assert one(spark, ["big red dog", "one", ""], text.ngrams(text.tokens("c"), 2, 2)) == [
        ["big red", "red dog"], [], [],
    ]


def test_split_hash_mixes_small_keys(spark):
    share = spark.range(10_000).select(F.avg((scores.split_hash("id", 42) < 0.8).cast("int"))).first()[0]
    assert 0.78 < share < 0.82
    small = spark.range(50).select(F.avg((scores.split_hash("id", 42) < 0.5).cast("int"))).first()[0]
    assert 0.2 < small < 0.8


def test_split_hash_takes_large_and_negative_keys(spark):
    rows = spark.createDataFrame([(2**62,), (-5,), (0,)], "id bigint").select(scores.split_hash("id"))
    assert all(0 <= r[0] < 1 for r in rows.collect())


def test_unicode_word_classes_agree_with_python(spark):
    marks = [chr(c) for c in range(0x21, 0x870) if unicodedata.category(chr(c)) not in ("Cs", "Cn")]
    values = [f"a{m}b" for m in marks]
    ours = one(spark, values, text.clean_text("c"))
    differing = [v for v, o in zip(values, ours) if o != python_clean(v)]
    assert differing in ([], ["aİb"])
