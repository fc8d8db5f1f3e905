"""Bins, ratings, rounding and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliospark.functions.text import _col

# Bin edges (left-open, right-closed; the last bin has no upper
# edge) and their labels.
ABSTRACT_BINS = ([0, 100, 300, 500], ["short", "medium", "long", "very_long"])
CITATION_BINS = ([0, 50, 100, 200], ["low", "medium", "high", "very_high"])
YEAR_BINS = ([0, 2020, 2022, 2024], ["old", "recent", "very_recent", "latest"])
AUTHOR_BINS = ([0, 3, 6, 10], ["few", "several", "many", "very_many"])

# Journal groups by words inside the name, first group wins.
JOURNAL_GROUPS = [
    ("top_tier", ["nature", "science", "cell"]),
    ("technical", ["ieee", "acm", "springer"]),
    ("medical", ["medical", "medicine", "clinical"]),
]
JOURNAL_OTHER = "other"

# Run-name prefixes of the algorithm families.
FAMILY_PREFIXES = [("RF", "Random Forest"), ("SVM", "SVM")]
FAMILY_OTHER = "Logistic Regression"

# Words that mark a metric as a performance metric.
PERFORMANCE_WORDS = ["accuracy", "f1", "precision", "recall"]


def round_even(c: Column | str, places: int) -> Column:
    """Round as NumPy does: scale, nearest integer with halves to even, scale back."""
    factor = float(10**places)
    return F.rint(_col(c) * factor) / factor


def cut(c: Column | str, edges: list[float], labels: list[str]) -> Column:
    """Label of the left-open, right-closed bin; null at or below the first edge."""
    c = _col(c)
    binned = F.when(c <= edges[0], F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels):
        binned = binned.when(c <= upper, label)
    return binned.when(c > edges[-1], labels[-1])


def cut_index(c: Column | str, edges: list[float]) -> Column:
    """Position of the bin `cut` names, for ordering; null where `cut` is null."""
    c = _col(c)
    passed = sum(((c > edge).cast("int") for edge in edges[1:]), F.lit(0))
    return F.when(c > edges[0], passed)


def journal_category(c: Column | str) -> Column:
    """Journal group by the first list with a word inside the name; null is other."""
    name = F.lower(_col(c))
    group = None
    for label, words in JOURNAL_GROUPS:
        found = name.rlike("|".join(words))
        group = F.when(found, label) if group is None else group.when(found, label)
    return group.otherwise(JOURNAL_OTHER)


def impact_score(cited_by: Column | str, year: Column | str, as_of_year: int) -> Column:
    """Log of citations per year, damped by the square root of the age, 3 places."""
    age = F.greatest(F.lit(1), F.lit(as_of_year) - _col(year))
    return round_even(F.log1p(_col(cited_by) / age) / F.sqrt(age), 3)


def runtime_minutes(start: Column | str, end: Column | str) -> Column:
    """Minutes between two timestamps; null when either is missing.

    Goes through the interval between them, so timestamps without a zone are
    never shifted by the session's daylight saving.
    """
    span = _col(end) - _col(start)
    part = {unit: F.extract(F.lit(unit), span) for unit in ("DAY", "HOUR", "MINUTE", "SECOND")}
    minutes = part["DAY"] * F.lit(1440) + part["HOUR"] * F.lit(60) + part["MINUTE"]
    micros = minutes.cast("bigint") * F.lit(60_000_000) + (part["SECOND"] * 1_000_000).cast("bigint")
    return micros / F.lit(60_000_000)


def short_label(c: Column | str, width: int) -> Column:
    """The first `width` characters and '...' when the text is longer."""
    c = _col(c)
    return F.when(F.length(c) > width, F.concat(F.substring(c, 1, width), F.lit("..."))).otherwise(c)


def minute_stamp(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd HH:mm")


def algorithm_family(run_name: Column | str, algorithm: Column | str | None = None) -> Column:
    """The algorithm parameter when given, else the family by run-name prefix."""
    name = _col(run_name)
    family = None
    for prefix, label in FAMILY_PREFIXES:
        hit = name.startswith(prefix)
        family = F.when(hit, label) if family is None else family.when(hit, label)
    family = family.otherwise(FAMILY_OTHER)
    return family if algorithm is None else F.coalesce(_col(algorithm), family)


def metric_key(title: Column | str, series: Column | str) -> Column:
    """`title_series`, or just the series when both are the same word."""
    title, series = _col(title), _col(series)
    return F.when(title == series, series).otherwise(F.concat_ws("_", title, series))


def metric_name_clean(c: Column | str) -> Column:
    """Metric name without its report prefixes."""
    # Prefixes that reports hide.
    for prefix in ("Test Metrics_", "test_", "metric_"):
        c = F.replace(_col(c), F.lit(prefix), F.lit(""))
    return c


def is_performance_metric(key: Column | str) -> Column:
    return F.lower(_col(key)).rlike("|".join(PERFORMANCE_WORDS))


def is_plain_accuracy(key: Column | str) -> Column:
    """An accuracy metric that is neither a fold score nor a spread."""
    name = F.lower(_col(key))
    return name.contains("accuracy") & ~name.contains("cv") & ~name.contains("std")


def quality_tier(accuracy: Column | str) -> Column:
    # Tier edges.
    a = _col(accuracy)
    return F.when(a >= 0.9, "high_quality").when(a >= 0.8, "medium_quality").otherwise("low_quality")


def performance_tags(algorithm: Column | str, accuracy: Column | str, version: Column | str) -> Column:
    """Registration tags of a model, in a fixed order, absent ones left out."""
    a = F.coalesce(_col(accuracy), F.lit(0.0))
    return F.array_compact(
        F.array(
            F.when(a >= 0.9, "high_performance"),
            F.concat(F.lit("algorithm_"), F.coalesce(_col(algorithm), F.lit("unknown"))),
            F.when(a > 0, F.concat(F.lit("accuracy_"), F.format_string("%.3f", a))),
            F.concat(F.lit("v"), F.coalesce(_col(version), F.lit(1)).cast("string")),
            quality_tier(a),
        )
    )


def threshold_flags(accuracy: Column | str, f1: Column | str, threshold: float = 0.7) -> list[Column]:
    """Pass flags for accuracy and F1 and the overall verdict; a missing metric fails."""
    passed = [F.coalesce(_col(m), F.lit(0.0)) > threshold for m in (accuracy, f1)]
    return [
        passed[0].alias("accuracy_passed"),
        passed[1].alias("f1_passed"),
        F.when(passed[0] & passed[1], "good").otherwise("needs_improvement").alias("overall_quality"),
    ]


def split_hash(key: Column | str, seed: int = 42) -> Column:
    """Fraction in [0, 1) from a key of any type: stable under any repartitioning.

    The first 52 bits of a digest of the key's text and the seed, so it follows no
    pattern in the keys and every SQL engine agrees on it. A null key counts as ''.
    """
    text = F.concat(F.coalesce(_col(key).cast("string"), F.lit("")), F.lit(f"|{seed}"))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint")
    return bits / F.lit(float(2**52))
