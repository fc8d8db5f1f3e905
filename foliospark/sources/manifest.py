"""Which files of a folder have changed since they were last read, so that only those are parsed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.plans.scratch import written

_SCHEMA = "path string, size long, modified timestamp"


_FOUND = f"folder boolean, {_SCHEMA}"
#: Files whose contents a task hands on at once; paths worth a task, and tasks for each core.
_FILES_AT_ONCE, _TASK_PATHS, _TASKS_PER_CORE = 256, 64, 4


def by_tasks(root: str) -> bool:
    """Whether tasks can open the folder's store themselves."""
    try:
        fs.FileSystem.from_uri(root)
    except (pa.ArrowException, OSError, ImportError):
        return False
    return True


def _spread(paths: DataFrame, n: int) -> DataFrame:
    """`n` paths dealt out to as many tasks as they are worth."""
    most = _TASKS_PER_CORE * paths.sparkSession.sparkContext.defaultParallelism
    return paths.repartition(min(most, 1 + n // _TASK_PATHS), "path")


def _skipped(name: str) -> bool:
    """Names that Spark's readers do not list either."""
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies in each folder of a batch, without what lies in folders below."""
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            store, base = fs.FileSystem.from_uri(_uri(folder))
            start = "file:" if isinstance(store, fs.LocalFileSystem) else folder.removesuffix(base)
            found = [i for i in store.get_file_info(fs.FileSelector(base)) if not _skipped(i.base_name)]
            none = dt.datetime.fromtimestamp(0, dt.UTC)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i.type == fs.FileType.Directory for i in found], pa.bool_()),
                    pa.array([start + i.path for i in found], pa.string()),
                    pa.array([i.size or 0 for i in found], pa.int64()),
                    pa.array([i.mtime or none for i in found], pa.timestamp("us", "UTC")),
                ],
                ["folder", "path", "size", "modified"],
            )


def _uri(path: str) -> str:
    """A path as listings give it, as one that Arrow opens; names may hold any characters."""
    return path.removeprefix("file://").removeprefix("file:") if path.startswith("file:") else path


def listing(spark: SparkSession, root: str) -> DataFrame:
    """Rows `(path, size, modified)` of all files under a folder; contents are not read.

    The folders of each depth are listed by the tasks and stored: no path passes through
    the driver. A store that only Spark can open is listed by its reader.
    """
    if not by_tasks(root):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    folders, files = spark.createDataFrame([(root,)], "path string"), []
    while n := folders.count():
        found = written(_spread(folders, n).mapInArrow(_list, _FOUND), "listing")
        files.append(found.where("not folder").drop("folder"))
        folders = found.where("folder").select("path")
    return reduce(DataFrame.union, files)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = batch.column(0).to_pylist()
        for a in range(0, len(paths), _FILES_AT_ONCE):
            some, contents = paths[a : a + _FILES_AT_ONCE], []
            for path in some:
                store, base = fs.FileSystem.from_uri(_uri(path))
                with store.open_input_stream(base) as file:
                    contents.append(file.read().decode(errors="replace"))
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array(contents, pa.string())], ["path", "content"])


def contents(paths: DataFrame) -> DataFrame:
    """Rows `(path, content)` of the files that a table names, read by the tasks."""
    return _spread(paths.select("path"), paths.count()).mapInArrow(_read, "path string, content string")


def changed(now: DataFrame, last: DataFrame) -> DataFrame:
    """Files that are new, or of another size or time than in the last listing."""
    return now.join(last, ["path", "size", "modified"], "left_anti")


def removed(now: DataFrame, last: DataFrame) -> DataFrame:
    """Paths that the last listing had and this one has not."""
    return last.select("path").join(now, "path", "left_anti")


class Folder:
    """A folder that is read again and again.

    The listing of the last read lies in `manifest`, one numbered table a read; a read
    that fails before it is confirmed leaves the last one in force.
    """

    def __init__(self, spark: SparkSession, root: str, manifest: str):
        self.spark, self.root, self.manifest = spark, root, manifest.rstrip("/")

    def _reads(self) -> DataFrame:
        schema = f"{_SCHEMA}, read int"
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(self.manifest)

    def last(self) -> tuple[int, DataFrame]:
        """Number and listing of the last read; 0 and nothing before the first."""
        self.spark.createDataFrame([], f"{_SCHEMA}, read int").write.mode("append").parquet(f"{self.manifest}/read=0")
        reads = self._reads()
        n = reads.agg(F.max("read")).first()[0] or 0
        return n, reads.where(F.col("read") == n).drop("read")

    def read(
        self, parse: Callable[[SparkSession, DataFrame | list[str]], DataFrame], out: str
    ) -> tuple[DataFrame, DataFrame]:
        """Parse the changed files into a table under `out`; that table, and the paths that are gone.

        `parse` gets the paths of changed files as a table, for `contents`; only in a store that
        tasks cannot open, where the driver lists the folder, as a list. The listing counts as read only when the table is written.
        """
        n, last = self.last()
        now = listing(self.spark, self.root)
        paths = changed(now, last).select("path")
        gone = removed(now, last)
        target = f"{out.rstrip('/')}/read={n + 1}"
        if by_tasks(self.root):
            rows = parse(self.spark, written(paths, "changed"))
        elif not paths.isEmpty():
            rows = parse(self.spark, [r["path"] for r in paths.collect()])
        else:
            rows = parse(self.spark, [r["path"] for r in now.limit(1).collect()]).limit(0)
        rows.write.mode("overwrite").parquet(target)
        now.withColumn("read", F.lit(n + 1)).write.mode("overwrite").parquet(f"{self.manifest}/read={n + 1}")
        return self.spark.read.schema(rows.schema).parquet(target), gone


def write_files(files: DataFrame, root: str) -> int:
    """Write rows `(path, content)` as files below a shared folder, by the tasks; the number of files.

    A file that is there is replaced, so a task that runs again does no harm.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for path, content in zip(*[c.to_pylist() for c in batch.columns]):
                whole = f"{base}/{path.lstrip('/')}"
                target.create_dir(whole.rpartition("/")[0], recursive=True)
                with target.open_output_stream(whole) as out:
                    out.write((content or "").encode())
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)], pa.int64())], ["n"])

    written = files.select("path", "content").mapInArrow(write, "n long")
    return written.agg(F.sum("n")).first()[0] or 0
