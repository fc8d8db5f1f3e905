"""Lines that many documents share are dropped from all of them.

Levelled sorted runs of line hashes say how many documents hold a line. A batch
is first merge-anti-joined with the lines that are already known to be common,
the rest becomes a sorted run of the lowest level, and as soon as a level has
`fanout` runs they are merged into one run of the next level. All of it is
DataFrame code.

All batches of a call are cut into lines and counted in one pass over the texts,
each batch by itself; they then enter the runs one after the other. A batch is a
share of the texts by their hash, so equal texts are in one batch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.tables import few_files, narrow, numbered_column, numbered_columns, own_columns
from foliospark.plans.scratch import new_path, written

EDGES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEY = ["_h1", "_h2"]
_TEXT = ["_t1", "_t2"]
_ADDED = ["kept_text", "n_lines", "n_dropped"]


def lowered(text: Column) -> Column:
    """A-Z in lower case and nothing else; texts of ASCII take Spark's faster way."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def line_keys(text: Column) -> Column:
    """The key of every line, in order: both ends stripped, A-Z in lower case."""
    return F.transform(F.split(lowered(text), "\n"), lambda line: F.trim(line, F.lit(EDGES)))


def _hashed(value: Column, names: list[str]) -> Column:
    """128 bits of a value: two hashes with different seeds."""
    return F.struct(
        F.xxhash64(value).alias(names[0]), F.xxhash64(F.lit(1), value).alias(names[1])
    )


def _together(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


class LineRuns:
    """How many documents hold each line, kept as levels of sorted runs in the shared folder.

    `settled` holds the lines that have reached `min_docs`; they are never counted
    again. Every other line is in some runs with a part of its count.
    """

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 3):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[DataFrame]] = []
        self.settled: list[DataFrame] = []

    def _sorted(self, rows: DataFrame, label: str) -> DataFrame:
        return written(rows.repartitionByRange(*_KEY).sortWithinPartitions(*_KEY), label)

    def _without_settled(self, rows: DataFrame) -> DataFrame:
        if not self.settled:
            return rows
        return rows.join(_together(self.settled).hint("merge"), _KEY, "left_anti")

    def add(self, counts: DataFrame, level: int = 0) -> None:
        """Take in a batch: one row (_h1, _h2, n) for each of its lines."""
        run = self._sorted(self._without_settled(counts), f"run{level}")
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            self._compact(level)

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        return _together(runs).groupBy(*_KEY).agg(F.sum("n").alias("n"))

    def _compact(self, level: int) -> None:
        merged = written(self._merged(self.levels[level]), f"merged{level}")
        self.levels[level] = []
        self.settled.append(self._sorted(merged.where(F.col("n") >= self.min_docs).select(*_KEY), "settled"))
        self.add(merged.where(F.col("n") < self.min_docs), level + 1)

    def common(self) -> DataFrame:
        """The keys of all lines that at least `min_docs` documents hold, each once."""
        runs = [run for level in self.levels for run in level]
        found = list(self.settled)
        if runs:
            rest = self._without_settled(self._merged(runs))
            found.append(rest.where(F.col("n") >= self.min_docs).select(*_KEY))
        return narrow(_together(found), "common_lines")


def _batched_counts(docs: DataFrame, text: str, batches: int) -> str:
    """Per batch, the lines and the number of documents with each; the path they are at."""
    value = F.coalesce(F.col(text), F.lit(""))
    lines = docs.select(
        F.pmod(F.xxhash64(value), F.lit(batches)).cast("int").alias("_batch"),
        F.explode(
            F.array_distinct(
                F.transform(
                    F.filter(line_keys(value), lambda key: key != ""),
                    lambda key: _hashed(key, _KEY),
                )
            )
        ).alias("_k"),
    ).select("_batch", "_k.*")
    path = new_path(docs.sparkSession, "line_batches")
    counts = lines.groupBy("_batch", *_KEY).agg(F.count("*").alias("n"))
    few_files(counts).write.partitionBy("_batch").parquet(path)
    return path


def dedup_lines(
    docs: DataFrame,
    min_docs: int = 10,
    text: str = "text",
    batches: int = 12,
    fanout: int = 3,
) -> DataFrame:
    """Drop each line whose key at least `min_docs` rows hold; `docs` with three more columns.

    Adds `kept_text` (the other lines joined by newlines), `n_lines` and `n_dropped`
    (long); columns of these names are replaced, all others keep their values. Every
    row is a document, repeated rows too. A null or empty text is one empty line; empty keys are never dropped;
    a null text stays null. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    given, text = docs, numbered_column(docs, text)
    docs = numbered_columns(docs)
    path = _batched_counts(docs, text, batches)
    counted = spark.read.schema("_h1 long, _h2 long, n long, _batch int").parquet(path)
    runs = LineRuns(spark, min_docs, fanout)
    for batch in range(batches):
        runs.add(counted.where(F.col("_batch") == batch).drop("_batch"))
    common = runs.common()

    value = F.coalesce(F.col(text), F.lit(""))
    # What is dropped depends on the text alone, so equal texts share one answer.
    places = (
        docs.select(
            _hashed(value, _TEXT).alias("_t"), F.posexplode(line_keys(value)).alias("_at", "_key")
        )
        .where(F.col("_key") != "")
        .select("_t.*", "_at", _hashed(F.col("_key"), _KEY).alias("_k"))
        .select(*_TEXT, "_at", "_k.*")
    )
    dropped = narrow(
        places.join(common, _KEY, "left_semi")
        .groupBy(*_TEXT)
        .agg(F.collect_set("_at").alias("_dropped")),
        "dropped_lines",
    )
    split = (
        docs.select("*", _hashed(value, _TEXT).alias("_t"))
        .select(*docs.columns, F.col("_t._t1").alias("_t1"), F.col("_t._t2").alias("_t2"))
        .join(dropped, _TEXT, "left")
        .select(*docs.columns, "_dropped", F.split(value, "\n").alias("_lines"))
    )
    n = F.size("_lines")
    kept = F.array_except(F.sequence(F.lit(0), n - 1), F.col("_dropped"))
    joined = F.array_join(F.transform(kept, lambda i: F.col("_lines")[i]), "\n")
    done = split.select(
        *docs.columns,
        F.when(F.col("_dropped").isNull(), F.col(text)).otherwise(joined).alias("kept_text"),
        n.cast("long").alias("n_lines"),
        F.coalesce(F.array_size("_dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )
    return own_columns(done, given, _ADDED)
