"""Vocabulary of n-grams: rare ones are dropped before the shuffle, lookups stay in the row.

Most n-grams of prose occur once and never enter a vocabulary. A count-min sketch of
each partition is merged and sent back as a bitmap, and only n-grams whose estimate
reaches the least document frequency are counted by term. An estimate is never below
the true count, so the vocabulary is exact.

Arrays of n-grams are counted in Arrow batches, a bounded number of n-grams at a time:
equal ones get one number and pairs of a row and a number are sorted. What is counted for
a vocabulary is added up in the task before it is shuffled.

Where the words are at hand (`fit_word_vocabulary`), n-grams are 64-bit keys until a sketch
of their totals tells how often a term of the vocabulary must occur; only those that may
reach it become text, so that what is shuffled does not grow with the n-grams.

The fitted vocabulary, whose size is bounded by the caller, goes to the tasks. Looking
its terms up needs no join and no exchange.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from foliospark.functions import text
from foliospark.plans.scratch import written

#: Rows of the sketch, and counters in each as a power of two. A counter is one byte.
ROWS, BITS = 2, 22
_CHUNK_BITS = 16
_FULL = 255

#: Rows of an Arrow batch at most, and items of arrays that are counted at once.
BATCH_ROWS, SLICE_ITEMS = 500, 1 << 19
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Counters in each row of the sketch of totals as a power of two, and the most they hold.
TOTAL_BITS, _MOST = 20, (1 << 32) - 1
_ODD = np.uint64(0x9E3779B97F4A7C15)


def small_batches(spark: SparkSession) -> None:
    """Hand arrays to Python in batches of at most BATCH_ROWS rows: a row is a whole text."""
    rows = int(spark.conf.get(_BATCH))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(_BATCH, BATCH_ROWS)


def _slices(lists: pa.ListArray) -> Iterator[tuple[int, pa.ListArray]]:
    """Runs of rows with at most SLICE_ITEMS items, or a single row, and where they begin."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(lists):
        held = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, held + SLICE_ITEMS, "right")))
        yield at, lists.slice(at, to - at)
        at = to


def _counted(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct items, and of each row's distinct items the row, the item's number and the count.

    Null items do not count.
    """
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    rows, items = np.repeat(np.arange(len(lists)), lengths), lists.flatten()
    if items.null_count:
        rows, items = rows[items.is_valid().to_numpy(zero_copy_only=False)], items.drop_null()
    coded = items.dictionary_encode()
    different = max(1, len(coded.dictionary))
    pairs, n = np.unique(rows * different + coded.indices.to_numpy(), return_counts=True)
    return coded.dictionary, pairs // different, pairs % different, n


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows `(term, total, df)` of some rows at a time."""
    for batch in batches:
        for _, lists in _slices(batch.column(0)):
            terms, _, term, n = _counted(lists)
            total = np.bincount(term, n, minlength=len(terms)).astype(np.int64)
            df = np.bincount(term, minlength=len(terms)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([terms, pa.array(total), pa.array(df)], ["term", "total", "df"])


def _bucket(key: Column, row: int) -> Column:
    """Counter of a 64-bit key in a row of the sketch: a bit field of its own."""
    return F.shiftrightunsigned(key, row * BITS).bitwiseAND((1 << BITS) - 1)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One sketch of the whole partition, in chunks without the empty ones."""
    counters = np.zeros((ROWS, 1 << BITS), np.uint8)
    for batch in batches:
        keys = batch.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        for row in range(ROWS):
            at = (keys >> np.uint64(row * BITS)) & np.uint64((1 << BITS) - 1)
            place, n = np.unique(at, return_counts=True)
            counters[row, place] = np.minimum(counters[row, place] + n, _FULL)
    chunks = counters.reshape(ROWS, -1, 1 << _CHUNK_BITS)
    used = np.argwhere(chunks.any(axis=2))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(used[:, 0].astype(np.int32)),
            pa.array(used[:, 1].astype(np.int32)),
            pa.array([chunks[r, c].tobytes() for r, c in used], pa.binary()),
        ],
        ["row", "chunk", "counters"],
    )


def _merge(least: int):
    """A function from chunks of sketches to the bits of the counters that reach `least`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for row, chunk, counters in zip(*[c.to_pylist() for c in batch.columns]):
                more = np.frombuffer(counters, np.uint8).astype(np.uint16)
                known = sums.get((row, chunk))
                sums[row, chunk] = more if known is None else np.minimum(known + more, _FULL)
        bits = [np.packbits(s >= least, bitorder="little").view(np.int64) for s in sums.values()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r for r, _ in sums], pa.int32()),
                pa.array([c for _, c in sums], pa.int32()),
                pa.array([b.tolist() for b in bits], pa.list_(pa.int64())),
            ],
            ["row", "chunk", "words"],
        )

    return run


def frequent_buckets(df: DataFrame, grams: str, least: int) -> DataFrame:
    """One row `bits`: for each row and chunk of the sketch, its bitmap of counters >= `least`.

    A megabyte at any size of the input. Counters stop at 255, which only lets more
    n-grams pass when `least` is higher still.
    """
    small_batches(df.sparkSession)
    hashed = df.select(F.transform(grams, lambda g: F.xxhash64(g)).alias("keys"))
    chunks = hashed.mapInArrow(_sketch, "row int, chunk int, counters binary")
    merged = chunks.repartition("row", "chunk").mapInArrow(
        _merge(min(least, _FULL)), "row int, chunk int, words array<long>"
    )
    n_chunks = 1 << (BITS - _CHUNK_BITS)
    none = F.array_repeat(F.lit(0).cast("long"), 1 << (_CHUNK_BITS - 6))
    all_chunks = df.sparkSession.range(ROWS * n_chunks, numPartitions=1).select(
        F.expr(f"cast(id div {n_chunks} as int)").alias("row"), (F.col("id") % n_chunks).cast("int").alias("chunk")
    )
    whole = all_chunks.join(merged, ["row", "chunk"], "left").select(
        F.struct("row", "chunk", F.coalesce("words", none).alias("words")).alias("part")
    )
    return written(whole.agg(F.sort_array(F.collect_list("part"))["words"].alias("bits")), "buckets")


def may_be_frequent(gram: Column, bits: Column) -> Column:
    """Whether all counters of the n-gram reach the least count."""
    key = F.xxhash64(gram)
    tests = []
    for row in range(ROWS):
        at = _bucket(key, row)
        chunk = F.shiftright(at, _CHUNK_BITS).cast("int") + F.lit(row << (BITS - _CHUNK_BITS))
        word = F.shiftright(at, 6).bitwiseAND((1 << (_CHUNK_BITS - 6)) - 1).cast("int")
        tests.append(F.getbit(F.get(F.get(bits, chunk), word), at.bitwiseAND(63).cast("int")) == 1)
    found = tests[0]
    for test in tests[1:]:
        found = found & test
    return found


def run_counts(df: DataFrame, items: str, keep: list[str], output: str = "runs") -> DataFrame:
    """Distinct items of an array with their counts, inside the row: `output` array of struct(item, n)."""
    ordered = df.select(*keep, F.sort_array(items).alias("_sorted"))
    starts = ordered.select(*keep, text.run_starts("_sorted").alias("_starts"), F.size("_sorted").alias("_size"))
    return starts.select(*keep, text.run_lengths("_starts", F.col("_size")).alias(output))


def fit_vocabulary(
    df: DataFrame,
    n_docs: Column,
    grams: str = "grams",
    min_df: int = 2,
    max_df: float = 0.95,
    max_features: int = 5000,
    sketched: bool = True,
) -> DataFrame:
    """Rows `(term, total, df)`: the most frequent terms within the document limits.

    With `sketched`, n-grams that cannot reach `min_df` stop at the map side; the rows
    are the same without. At most `max_features` rows, written once.
    """
    small_batches(df.sparkSession)
    counts = df.select(grams).mapInArrow(_partial_counts, "term string, total long, df long")
    if sketched and min_df > 1:
        bits = frequent_buckets(df, grams, min_df).scalar()
        counts = counts.where(may_be_frequent(F.col("term"), bits))
    return _most_frequent(counts, n_docs, min_df, max_df, max_features)


def _most_frequent(counts: DataFrame, n_docs: Column, min_df: int, max_df: float, max_features: int) -> DataFrame:
    """The most frequent terms within the document limits, from partial counts; written once."""
    terms = counts.groupBy("term").agg(F.sum("total").alias("total"), F.sum("df").alias("df"))
    kept = terms.where((F.col("df") >= min_df) & (F.col("df") <= n_docs * F.lit(max_df)))
    return written(kept.orderBy(F.desc("total"), "term").limit(max_features), "vocabulary")


def _gram_places(
    lists: pa.ListArray, low: int, high: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each length of n-grams: the length, their places among all words, their rows and keys."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    rows, words = np.repeat(np.arange(len(lists)), lengths), lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(rows))
    keys = words.copy()
    for n in range(1, high + 1):
        at = np.flatnonzero(left >= n)
        if n > 1:
            mixed = (keys[at] ^ (keys[at] >> np.uint64(29))) * _ODD + words[at + n - 1]
            keys[at] = mixed ^ (mixed >> np.uint64(32))
        if n >= low:
            yield n, at, rows[at], keys[at]


def _totals(rows: np.ndarray, item: np.ndarray, different: int) -> tuple[pa.Array, pa.Array]:
    """How often each of `different` numbers occurs, and in how many rows."""
    held = np.unique(rows * max(1, different) + item) % max(1, different)
    return pa.array(np.bincount(item, minlength=different)), pa.array(np.bincount(held, minlength=different))


def _places(keys: np.ndarray, row: int) -> np.ndarray:
    """Counters of keys in a row of the sketch of totals: a bit field of its own."""
    return ((keys >> np.uint64(row * TOTAL_BITS)) & np.uint64((1 << TOTAL_BITS) - 1)).astype(np.int64)


def _total_sketch(low: int, high: int):
    """A function from arrays of word keys to one sketch of the n-grams' totals, in chunks without the empty ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros((ROWS, 1 << TOTAL_BITS), np.int64)
        for batch in batches:
            for _, lists in _slices(batch.column(0)):
                keys = np.concatenate([k for *_, k in _gram_places(lists, low, high)])
                for row in range(ROWS):
                    counters[row] += np.bincount(_places(keys, row), minlength=1 << TOTAL_BITS)
        chunks = np.minimum(counters, _MOST).astype(np.uint32).reshape(-1, 1 << _CHUNK_BITS)
        used = np.flatnonzero(chunks.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array([chunks[c].tobytes() for c in used], pa.binary())],
            ["chunk", "counters"],
        )

    return run


def _added_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of equal chunks."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counters in zip(*[c.to_pylist() for c in batch.columns]):
            more = np.frombuffer(counters, np.uint32)
            sums[chunk] = np.minimum(sums.get(chunk, np.int64(0)) + more.astype(np.int64), _MOST)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([c.astype(np.uint32).tobytes() for c in sums.values()], pa.binary())],
        ["chunk", "counters"],
    )


def _total_counters(keys: DataFrame, low: int, high: int) -> np.ndarray:
    """The sketch of totals: rows of counters, eight megabytes at any size of the input."""
    shape = "chunk int, counters binary"
    chunks = keys.mapInArrow(_total_sketch(low, high), shape)
    out = np.zeros((ROWS << (TOTAL_BITS - _CHUNK_BITS), 1 << _CHUNK_BITS), np.uint32)
    for r in chunks.repartition("chunk").mapInArrow(_added_totals, shape).toArrow().to_pylist():
        out[r["chunk"]] = np.frombuffer(r["counters"], np.uint32)
    return out.reshape(ROWS, -1)


def _likely_least(counters: np.ndarray, size: int) -> int:
    """What the total of the `size`-th term is likely to reach: of the counters in that place, less twice the mean one."""
    if size >= counters.shape[1]:
        return 0
    place = np.partition(counters, -size, axis=1)[:, -size].min()
    return max(0, int(0.9 * place - 2 * counters.mean()))


def _key_terms(low: int, high: int, chosen):
    """A function from arrays of words and of their keys to rows `(term, total, df)` of the n-grams whose counters are all chosen.

    Equal keys do not make equal terms: those are told apart by the numbers of their words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = chosen.value
        for batch in batches:
            words, keys = batch.columns
            for start, lists in _slices(keys):
                coded = words.slice(start, len(lists)).flatten().dictionary_encode()
                code, names = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
                for n, at, rows, key in _gram_places(lists, low, high):
                    held = np.flatnonzero(np.logical_and.reduce([wanted[r][_places(key, r)] for r in range(ROWS)]))
                    if not len(held):
                        continue
                    at, rows = at[held], rows[held]
                    item = code[at]
                    for i in range(1, n):
                        _, item = np.unique(item * len(names) + code[at + i], return_inverse=True)
                    _, first, item = np.unique(item, return_index=True, return_inverse=True)
                    term = names.take(pa.array(code[at[first]]))
                    for i in range(1, n):
                        term = pc.binary_join_element_wise(term, names.take(pa.array(code[at[first] + i])), " ")
                    yield pa.RecordBatch.from_arrays([term, *_totals(rows, item, len(first))], ["term", "total", "df"])

    return run


def fit_word_vocabulary(
    df: DataFrame,
    n_docs: Column,
    words: str,
    ngram_range: tuple[int, int],
    min_df: int = 2,
    max_df: float = 0.95,
    max_features: int = 5000,
) -> DataFrame:
    """`fit_vocabulary` over the n-grams of an array of words, none of them null.

    A counter of the sketch is never below the total of a term in it. It is guessed from them
    which total the last term of the vocabulary reaches; n-grams with smaller counters are no
    candidates, the others are counted by term. When `max_features` terms do reach the guess,
    they are the vocabulary; if fewer do, the guess is lowered, at last to `min_df`.
    """
    spark = df.sparkSession
    small_batches(spark)
    low, high = ngram_range
    hashed = F.transform(words, lambda w: F.xxhash64(w)).alias("keys")
    counters = _total_counters(df.select(hashed), low, high)
    least = _likely_least(counters, max_features)
    while True:
        least = least if least > min_df else 0
        chosen = spark.sparkContext.broadcast(counters >= min(max(least, min_df), _MOST))
        found = df.select(words, hashed).mapInArrow(_key_terms(low, high, chosen), "term string, total long, df long")
        terms = _most_frequent(found, n_docs, min_df, max_df, max_features)
        chosen.destroy()
        if not least or terms.where(F.col("total") >= least).count() >= max_features:
            return terms
        least //= 4


class _Steps(NamedTuple):
    """The beginnings of a vocabulary's terms: which word leads from one to the next, and which are terms."""

    words: list[str]
    keys: list[np.ndarray]  # for each length beyond one, sorted: a beginning and the word that follows
    terms: list[np.ndarray]  # for each length, the place of each beginning in the vocabulary, or -1


def _steps(terms: list[str], high: int) -> _Steps:
    parts = [t.split(" ") for t in terms]
    words = sorted({w for p in parts for w in p})
    number = {w: i for i, w in enumerate(words)}
    state = [number[p[0]] for p in parts]
    keys, places = [], []
    for n in range(1, high + 1):
        if n > 1:
            long = [i for i, p in enumerate(parts) if len(p) >= n]
            step = np.array([state[i] * len(words) + number[parts[i][n - 1]] for i in long], np.int64)
            key, at = np.unique(step, return_inverse=True)
            keys.append(key)
            for i, a in zip(long, at.tolist()):
                state[i] = a
        place = np.full(len(words) if n == 1 else len(keys[-1]), -1, np.int64)
        for i, p in enumerate(parts):
            if len(p) == n:
                place[state[i]] = i
        places.append(place)
    return _Steps(words, keys, places)


def _known_places(lists: pa.ListArray, words: pa.Array, steps: _Steps, low: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and places in the vocabulary of all n-grams that are in it, row by row."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    coded = lists.flatten().dictionary_encode()
    number = pc.fill_null(pc.index_in(coded.dictionary, value_set=words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    word = number[coded.indices.to_numpy(zero_copy_only=False)]
    rows = np.repeat(np.arange(len(lists)), lengths)
    ends = np.repeat(np.cumsum(lengths), lengths)
    at = np.flatnonzero(word >= 0)
    state = word[at]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for n, places in enumerate(steps.terms, 1):
        if n > 1:
            on = np.flatnonzero(at + n <= ends[at])
            at, state = at[on], state[on]
            following, keys = word[at + n - 1], steps.keys[n - 2]
            key = state * len(steps.words) + following
            state = np.searchsorted(keys, key)
            same = np.flatnonzero((following >= 0) & (np.append(keys, -1)[state] == key))
            at, state = at[same], state[same]
        if n >= low:
            place = places[state]
            held = place >= 0
            found.append((rows[at[held]], place[held]))
    row, place = map(np.concatenate, zip(*found))
    order = np.argsort(row, kind="stable")
    return row[order], place[order]


def _with_known(terms: list[str], ngram_range: tuple[int, int]):
    """A function from rows with an array of words in the last column to rows with their known n-grams there."""
    low, high = ngram_range
    steps = _steps(terms, high)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, known = pa.array(steps.words, pa.string()), pa.array(terms, pa.string())
        for batch in batches:
            for start, lists in _slices(batch.column(batch.num_columns - 1)):
                row, place = _known_places(lists, words, steps, low)
                ends = np.searchsorted(row, np.arange(len(lists) + 1)).astype(np.int32)
                grams = pa.ListArray.from_arrays(pa.array(ends), known.take(pa.array(place)))
                rest = batch.slice(start, len(lists)).columns[:-1]
                yield pa.RecordBatch.from_arrays([*rest, grams], batch.schema.names)

    return run


def known_grams(
    df: DataFrame, terms: list[str], words: str, ngram_range: tuple[int, int], keep: list[str], output: str = "grams"
) -> DataFrame:
    """The columns `keep` and, with repeats, those n-grams of an array of words that are among `terms`.

    The words of a term are separated by spaces and hold none. Words become numbers, and a table of
    a beginning and the next word tells which n-grams are known, so that no others are ever made.
    """
    small_batches(df.sparkSession)
    rows = df.select(*keep, F.col(words).alias(output))
    shape = StructType([*rows.schema.fields[:-1], StructField(output, ArrayType(StringType()))])
    return rows.mapInArrow(_with_known(terms, ngram_range), shape)


class _Table(NamedTuple):
    steps: np.ndarray
    slots: np.ndarray  # of each key
    size: int


def _mixed_parts(keys: np.ndarray, size: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, start and stride of 64-bit keys, as `TermTable.slot` computes them."""
    keys = keys.view(np.uint64)
    bucket = keys & np.uint64(buckets - 1)
    start = (keys >> np.uint64(20)) & np.uint64(size - 1)
    stride = ((keys >> np.uint64(42)) & np.uint64(size - 1)) | np.uint64(1)
    return bucket.astype(np.int64), start.astype(np.int64), stride.astype(np.int64)


def _displaced(keys: np.ndarray) -> _Table:
    """Perfect hashing: buckets of keys, largest first, get the first step that finds only free slots."""
    size = 1 << max(4, int(2 * len(keys)).bit_length())
    buckets = max(1, size // 8)
    bucket, start, stride = _mixed_parts(keys, size, buckets)
    steps, slots, free = np.zeros(buckets, np.int64), np.zeros(len(keys), np.int64), np.ones(size, bool)
    order = np.argsort(bucket, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], bucket[order][1:] != bucket[order][:-1]])) if len(keys) else []
    groups = sorted(np.split(order, starts[1:]) if len(keys) else [], key=len, reverse=True)
    for group in groups:
        for step in range(1 << 20):
            at = (start[group] + step * stride[group]) & (size - 1)
            if free[at].all() and len(np.unique(at)) == len(at):
                break
        else:
            raise ValueError("two terms of the vocabulary cannot be told apart by their hash")
        free[at] = False
        steps[bucket[group[0]]], slots[group] = step, at
    return _Table(steps, slots, size)


def inverse_document_frequency(df: Column | str, n_docs: Column) -> Column:
    """Smoothed idf plus one."""
    df = F.col(df) if isinstance(df, str) else df
    return F.log((F.lit(1) + n_docs) / (F.lit(1) + df)) + F.lit(1)


def _constant(values: list, kind: str) -> Column:
    """An array that the optimizer folds to one constant; a lambda may use it, unlike a subquery."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


class TermTable:
    """A vocabulary as a perfect hash table of constants, looked up inside other rows.

    Holds as many terms, with their inverse document frequency, as the vocabulary was
    fitted for.
    """

    def __init__(self, vocabulary: DataFrame, n_docs: Column):
        idf = inverse_document_frequency("df", n_docs)
        rows = vocabulary.select("term", idf.alias("idf"), F.xxhash64("term").alias("key")).toArrow()
        self.terms, self.weights = rows["term"].to_pylist(), rows["idf"].to_pylist()
        table = _displaced(rows["key"].to_numpy())
        self.size, self.buckets = table.size, len(table.steps)
        terms, weights = [None] * table.size, [None] * table.size
        for slot, term, weight in zip(table.slots, self.terms, self.weights):
            terms[slot], weights[slot] = term, weight
        self._steps = _constant(table.steps.tolist(), "bigint")
        self._terms, self._idf = _constant(terms, "string"), _constant(weights, "double")

    def slot(self, term: Column) -> Column:
        """Where the term stands, null if it is not in the vocabulary."""
        key = F.xxhash64(term)
        step = F.get(self._steps, key.bitwiseAND(self.buckets - 1).cast("int"))
        start = F.shiftrightunsigned(key, 20).bitwiseAND(self.size - 1)
        stride = F.shiftrightunsigned(key, 42).bitwiseAND(self.size - 1).bitwiseOR(F.lit(1).cast("long"))
        at = (start + step * stride).bitwiseAND(self.size - 1).cast("int")
        return F.when(F.get(self._terms, at) == term, at)

    def term(self, slot: Column) -> Column:
        return F.get(self._terms, slot)

    def idf(self, slot: Column) -> Column:
        return F.get(self._idf, slot)


def _known(terms: list[str], weights: list[float], unit: bool):
    """A function from rows `(id, items)` to rows `(id, term, n)`, or with `unit` `(id, term, weight)` of unit length."""
    idf = np.array(weights, float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(terms, pa.string())
        for batch in batches:
            for start, lists in _slices(batch.column(1)):
                found, row, item, n = _counted(lists)
                place = pc.fill_null(pc.index_in(found, value_set=known), -1).to_numpy(zero_copy_only=False)[item]
                held = place >= 0
                row, place, n = row[held], place[held], n[held]
                order = np.lexsort((place, row))
                row, place, n = row[order], place[order], n[order]
                value = pa.array(n, pa.int32())
                if unit:
                    w = n * idf[place]
                    length = np.sqrt(np.bincount(row, w * w, minlength=len(lists)))[row]
                    none = length == 0
                    value = pa.array(w / np.where(none, 1.0, length), pa.float64(), mask=none)
                ids = batch.column(0).take(pa.array(row + start))
                yield pa.RecordBatch.from_arrays([ids, known.take(pa.array(place)), value], ["id", "term", "value"])

    return run


def known_counts(
    df: DataFrame, table: TermTable, id_column: str, grams: str = "grams", unit: bool = False
) -> DataFrame:
    """Rows `(id, term, value)`: the vocabulary's terms of each row with their counts.

    With `unit` the value is the weight, count times inverse document frequency, scaled so
    that a row's weights have length one.
    """
    small_batches(df.sparkSession)
    id_type = df.schema[id_column].dataType.simpleString()
    rows = df.select(F.col(id_column).alias("id"), F.col(grams).alias("items"))
    found = rows.mapInArrow(
        _known(table.terms, table.weights, unit), f"id {id_type}, term string, value {'double' if unit else 'int'}"
    )
    return found.withColumnRenamed("id", id_column)
