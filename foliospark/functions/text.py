"""Text, list and token expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode classes that match Python's notion of a word
# character and of white space (Java's own \w and \s are ASCII or differ).
NON_WORD_RUN = r"[^\p{L}\p{N}_]+"
# a-z is also in \p{L}; named first, it is found without looking a letter's class up
LONG_WORD = r"[a-z\p{L}\p{N}_][a-z\p{L}\p{N}_]+"
WHITESPACE_RUN = r"[\t-\r\x{1C}-\x{20}\x{85}\p{Z}]+"
OUTER_WHITESPACE = rf"^{WHITESPACE_RUN}|{WHITESPACE_RUN}$"
MARKUP_TAG = r"<[^>]+>"
INLINE_FORMULA = r"\$[^$]+\$"
FORMULA_COMMAND = r"\\[a-zA-Z]+\{[^}]*\}"

# The spellings pandas reads as a missing value in a CSV file.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_whitespace(c: Column | str) -> Column:
    """Remove leading and trailing Unicode white space (SQL trim only knows the space)."""
    return F.regexp_replace(_col(c), OUTER_WHITESPACE, "")


def clean_text(c: Column | str) -> Column:
    """Lower-case words joined by single spaces; null becomes ''.

    Punctuation and white space both end up as one space, so one pass over the
    text replaces every run of non-word characters.
    """
    words = F.regexp_replace(F.lower(_col(c)), NON_WORD_RUN, " ")
    return F.coalesce(F.trim(words), F.lit(""))


def clean_text_markup(c: Column | str) -> Column:
    """`clean_text` after dropping tags, `$formulas$` and `\\command{...}`."""
    bare = _col(c)
    for pattern in (MARKUP_TAG, INLINE_FORMULA, FORMULA_COMMAND):
        bare = F.regexp_replace(bare, pattern, "")
    return clean_text(bare)


def missing_to_null(c: Column | str) -> Column:
    """Null out the spellings that stand for a missing value in a CSV file."""
    return F.when(~_col(c).isin(MISSING_TOKENS), _col(c))


def keywords_list(c: Column | str) -> Column:
    """Comma list to array: parts stripped, empty parts dropped, order and repeats kept."""
    parts = F.transform(F.split(_col(c), ","), strip_whitespace)
    return F.coalesce(F.filter(parts, lambda part: part != ""), F.array().cast("array<string>"))


def word_count(c: Column | str) -> Column:
    """Number of white-space separated words; null stays null."""
    words = F.filter(F.split(_col(c), WHITESPACE_RUN), lambda word: word != "")
    return F.when(_col(c).isNotNull(), F.size(words))


def list_count(c: Column | str, separator: str = ",") -> Column:
    """Number of parts of a separated list; null stays null."""
    return F.when(_col(c).isNotNull(), F.size(F.split(_col(c), separator)))


def separator_count(c: Column | str, separator: str = ",") -> Column:
    """Separators plus one, as an author count; null stays null."""
    return F.regexp_count(_col(c), F.lit(separator)) + F.lit(1)


def primary_category(c: Column | str) -> Column:
    """First white-space separated word, or 'unknown'."""
    words = F.filter(F.split(_col(c), WHITESPACE_RUN), lambda word: word != "")
    return F.coalesce(F.get(words, F.lit(0)), F.lit("unknown"))


def concat_text(*cols: Column | str) -> Column:
    """Columns joined by a space, a null counting as ''."""
    return F.concat_ws(" ", *[F.coalesce(_col(c), F.lit("")) for c in cols])


def tokens(c: Column | str, stop_words: list[str] | None = None, lowercase: bool = True) -> Column:
    """Words of two or more word characters, minus the stop words, in order."""
    text = F.lower(_col(c)) if lowercase else _col(c)
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(LONG_WORD), 0)
    return F.filter(words, lambda w: ~w.isin(stop_words)) if stop_words else words


def ngrams(words: Column | str, low: int, high: int) -> Column:
    """All n-grams of an array of words for low <= n <= high, shortest first.

    Each length extends the one before it by the word that follows, pairing two
    arrays. No lambda looks at a whole array, so the cost stays linear even
    where the optimizer copies the expression into a filter.
    """
    words = _col(words)
    by_length = [words]
    for n in range(2, high + 1):
        shorter = by_length[-1]
        room = F.greatest(F.size(words) - (n - 1), F.lit(0))
        by_length.append(
            F.zip_with(
                F.slice(shorter, F.lit(1), room),
                F.slice(words, F.lit(n), room),
                lambda gram, word: F.concat(gram, F.lit(" "), word),
            )
        )
    grams = by_length[low - 1 :]
    return grams[0] if len(grams) == 1 else F.concat(*grams)


def run_starts(items: Column | str) -> Column:
    """Sorted array of items to array of `struct(item, at)`: where each new item starts."""
    items = _col(items)
    before = F.concat(F.array(F.lit(None)), items)
    placed = F.zip_with(
        F.transform(items, lambda item, i: F.struct(item.alias("item"), i.alias("at"))),
        F.slice(before, F.lit(1), F.size(items)),
        lambda place, previous: F.when(~place["item"].eqNullSafe(previous), place),
    )
    return F.array_compact(placed)


def run_lengths(starts: Column | str, length: Column) -> Column:
    """Array of `struct(item, n)` from run starts: a run ends where the next one starts."""
    starts = _col(starts)
    later = F.slice(starts["at"], F.lit(2), F.greatest(F.size(starts), F.lit(1)))
    ends = F.slice(F.concat(later, F.array(length)), F.lit(1), F.size(starts))
    return F.zip_with(
        starts, ends, lambda start, end: F.struct(start["item"].alias("item"), (end - start["at"]).alias("n"))
    )
