"""Narrow tables in few files, and columns under names of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.plans.scratch import written


def few_files(df: DataFrame) -> DataFrame:
    """Deal narrow rows out to as many tasks, and files, as there are cores.

    Rows of numbers come out of a shuffle in hundreds of tiny partitions; each file
    costs more than its rows. They are dealt out anew rather than coalesced: a task
    that does the work of many partitions keeps the memory of all of them. Not for
    texts, whose partitions are worth a file.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def numbered_columns(docs: DataFrame) -> DataFrame:
    """`docs` with its columns named in0, in1, ...: no name of an operator can meet one of theirs.

    An operator's own columns never start with `in`; `own_columns` gives the names back.
    """
    return docs.toDF(*[f"in{i}" for i in range(len(docs.columns))])


def numbered_column(docs: DataFrame, name: str) -> str:
    """What `numbered_columns` calls the column `name`."""
    return f"in{docs.columns.index(name)}"


def own_columns(rows: DataFrame, docs: DataFrame, added: list[str]) -> DataFrame:
    """`rows` of numbered columns under the names of `docs` again, and the `added` ones, which replace."""
    kept = [F.col(f"in{i}").alias(c) for i, c in enumerate(docs.columns) if c not in added]
    return rows.select(*kept, *added)


def narrow(df: DataFrame, label: str) -> DataFrame:
    """`written` for narrow rows."""
    return written(few_files(df), label)


#: Narrow rows that may be sent to every executor, some tens of MB.
MAX_BROADCAST = 1_000_000


def sized(df: DataFrame, rows: int = MAX_BROADCAST) -> DataFrame:
    """A stored table of narrow rows, broadcast if it has at most `rows` and left to Spark beyond."""
    return F.broadcast(df) if df.count() <= rows else df
