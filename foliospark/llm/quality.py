"""Quality rules whose last word is about the host: bad hosts lose their good-looking pages too.

Rule failures are counted per document in built-in expressions, added up per host,
and every host's rate is shrunk towards what hosts are like in general by a beta
prior fitted to all hosts. Verdicts are joined back to the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.tables import narrow
from foliospark.plans.scratch import written

SPACE = "[\\x20\\x09-\\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: A document fails a method rule beyond these; a host fails beyond MAX_HOST_RATE.
MAX_SYMBOLS_PER_WORD = 2.0
MAX_DUP_LINE_SHARE = 0.5
MIN_WORD_CHARS, MAX_WORD_CHARS = 1.5, 25.0
MAX_HOST_RATE = 0.5
RULES = ["few_words", "repeats", "symbols", "dup_lines", "word_size"]


def _with_counts(docs: DataFrame, text: str, keep: list[Column]) -> DataFrame:
    """The counts of each text; later steps read arrays only as columns, so cost stays linear."""
    value = F.coalesce(F.col(text), F.lit(""))
    first = docs.select(
        *keep,
        value.alias("_text"),
        F.filter(F.split(value, SPACE + "+"), lambda w: w != "").alias("_words"),
        F.filter(
            F.split(value, "\n"), lambda s: F.trim(s, F.lit(" \t\n\x0b\x0c\r")) != ""
        ).alias("_lines"),
    )
    names = [c for c in first.columns if not c.startswith("_")]
    hashed = first.select(
        *names,
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.char_length("_text") - F.char_length(F.translate("_text", SYMBOLS, "")))
        .cast("long")
        .alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    h = F.col("_hashes")
    windows = hashed.select(
        *names,
        *counts,
        F.when(
            F.size("_hashes") >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size("_hashes") - WINDOW),
                lambda i: F.xxhash64(*[h[i + j] for j in range(WINDOW)]),
            ),
        ).alias("_windows"),
    )
    some = F.size(F.array_distinct("_windows")) < F.size("_windows")
    ordered = windows.select(
        *names,
        *counts,
        F.when(
            some,
            F.array_sort(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))),
        ).alias("_sorted"),
    )
    s = F.col("_sorted")
    last = F.size("_sorted") - 1
    twice = ordered.select(
        *names,
        *counts,
        F.array_sort(
            F.transform(
                F.filter(
                    "_sorted",
                    lambda x, k: ((k > 0) & (F.get(s, k - 1)["w"] == x["w"]))
                    | ((k < last) & (F.get(s, k + 1)["w"] == x["w"])),
                ),
                lambda x: x["i"],
            )
        ).alias("_starts"),
    )
    p = F.col("_starts")
    covered = F.aggregate(
        F.transform(
            "_starts",
            lambda x, k: F.coalesce(F.least(F.get(p, k + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)),
        ),
        F.lit(0),
        lambda a, x: a + x,
    )
    return twice.select(
        *names, *counts, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")
    )


def _failures() -> dict[str, Column]:
    n = F.col("n_words")
    return {
        "few_words": n < 10,
        "repeats": 100 * F.col("n_repeat_words") > 20 * n,
        "symbols": F.col("n_symbols") > MAX_SYMBOLS_PER_WORD * n,
        "dup_lines": F.col("n_dup_lines") > MAX_DUP_LINE_SHARE * F.col("n_lines"),
        "word_size": (n > 0)
        & ~F.col("word_chars").between(MIN_WORD_CHARS * n, MAX_WORD_CHARS * n),
    }


def host_verdicts(failed: DataFrame, host: str, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per host: its size, each rule's shrunk rate, and whether the host passes.

    The beta prior of a rule has the mean of the hosts' rates, and the weight at
    which the spread of rates between hosts, less what chance alone brings, is
    explained (method of moments). Without such spread, or with one host, the weight
    is that of one hundred documents.
    """
    hosts = narrow(
        failed.groupBy(host).agg(
            F.count("*").alias("_n"),
            *[F.sum(F.col(f"_f_{r}").cast("long")).alias(f"_k_{r}") for r in RULES],
        ),
        "hosts",
    )
    prior = hosts.agg(
        F.avg(1 / F.col("_n")).alias("_inv"),
        *[F.avg(F.col(f"_k_{r}") / F.col("_n")).alias(f"_m_{r}") for r in RULES],
        *[F.var_pop(F.col(f"_k_{r}") / F.col("_n")).alias(f"_v_{r}") for r in RULES],
    )
    rated = hosts.withColumn("_prior", prior.select(F.struct("*")).scalar())
    rates = {}
    for r in RULES:
        mean, var = F.col(f"_prior._m_{r}"), F.col(f"_prior._v_{r}")
        chance = mean * (1 - mean)
        between = var - chance * F.col("_prior._inv")
        weight = F.when((between > 0) & (chance > between), chance / between - 1).otherwise(100.0)
        rates[r] = (F.col(f"_k_{r}") + mean * weight) / (F.col("_n") + weight)
    worst = F.greatest(*rates.values())
    return rated.select(
        host,
        F.col("_n").alias("host_docs"),
        *[v.alias(f"host_{r}_rate") for r, v in rates.items()],
        (worst <= max_rate).alias("host_passed"),
    )


def rate_quality(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    keys: list[str] | None = None,
    max_rate: float = MAX_HOST_RATE,
) -> DataFrame:
    """Counts, base verdict and final verdict of every row of `docs`.

    Returns the `keys` columns (doc_id), the counts, `base_failed`, one boolean
    `failed_<rule>` each, `host_passed` and `kept`. Null text counts as no words. Rows
    without a host form one host. An empty table gives an empty table; repeated
    rows stay repeated and count each time.
    """
    keys = keys or ["doc_id"]
    own = [F.col(c) for c in keys] + [F.col(host).alias("host__")]
    counted = _with_counts(docs, text, own)
    rows = written(
        counted.select("*", *[v.alias(f"_f_{k}") for k, v in _failures().items()]), "doc_rules"
    )
    hosts = narrow(host_verdicts(rows, "host__", max_rate), "host_rules")
    hosts = hosts.withColumnRenamed("host__", "host_of_rule__")
    joined = rows.join(hosts, F.col("host__").eqNullSafe(F.col("host_of_rule__")), "left")
    base = F.col("_f_few_words") | F.col("_f_repeats")
    return joined.select(
        *keys,
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"),
        (~base & F.col("host_passed")).alias("kept"),
        *[F.col(f"_f_{r}").alias(f"failed_{r}") for r in RULES],
        "host_passed", "host_docs",
    )
