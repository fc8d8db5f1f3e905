"""Ranked lexical search over impact vectors, by buckets of norm.

A document is a vector of term impacts, an item a vector of term counts, and the
score their inner product. Vectors are sorted by norm and searched in buckets of
similar norm: Cauchy-Schwarz drops a bucket for an item, bounds per coordinate choose
the focus terms of which a candidate must hold one, partial products with bounds on
the rest drop candidates, and the survivors are scored exactly in integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm import texts
from foliospark.plans.scratch import written

#: (item, term) pairs that the driver and a task hold at once; more items are searched in turns.
BLOCK_PAIRS = 1 << 20
#: Vectors of a bucket.
BUCKET = 4096
#: Share of the longest vectors that are searched first, for the bounds of the rest.
LONGEST = 1 / 16
#: Room for rounding when a bound in doubles meets a score in integers.
SLACK = 1 + 1e-9

_NO_KEY = np.iinfo(np.int64).max


class Items(NamedTuple):
    """A block of items as rows of a sparse matrix over their own vocabulary."""

    rows: np.ndarray  # numbers of the items
    first: np.ndarray  # item i has the entries first[i] to first[i + 1]
    terms: np.ndarray  # positions in the vocabulary
    counts: np.ndarray
    hashes: np.ndarray  # vocabulary, sorted
    lengths: np.ndarray  # bytes of each term

    @classmethod
    def of(cls, rows: list) -> "Items":
        rows = sorted(rows, key=lambda r: r["row"])
        sizes = [len(r["hashes"]) for r in rows]
        hashes = np.array([h for r in rows for h in r["hashes"]], np.int64)
        lengths = np.array([n for r in rows for n in r["lengths"]], np.int64)
        counts = np.array([n for r in rows for n in r["counts"]], np.int64)
        known, at, terms = np.unique(hashes, return_index=True, return_inverse=True)
        first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        return cls(np.array([r["row"] for r in rows], np.int64), first, terms, counts, known, lengths[at])


def _lists(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First position and length of each run of equal values."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return starts, np.diff(np.append(starts, len(keys)))


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct terms of each item: hash, byte length and count."""
    for batch in batches:
        at = 0
        for part in texts.slices(batch.column("text")):
            found = texts.words(part, texts.ALNUM)
            owner = np.repeat(np.arange(len(part)), np.diff(found.first))
            hashes = found.hashes.view(np.int64)
            order = np.lexsort((hashes, owner))
            owner, hashes = owner[order], hashes[order]
            new = np.ones(len(order), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
            starts = np.flatnonzero(new)
            counts = np.diff(np.append(starts, len(order)))
            lengths = (found.ends - found.starts)[order][starts]
            offsets = np.searchsorted(owner[starts], np.arange(len(part) + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").slice(at, len(part)),
                    _lists(offsets, hashes[starts], pa.int64()),
                    _lists(offsets, lengths, pa.int32()),
                    _lists(offsets, counts, pa.int32()),
                ],
                ["row", "hashes", "lengths", "counts"],
            )
            at += len(part)


def _count_terms(items: Items):
    """A function from texts to their number of terms and the counts of the vocabulary's terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, size = items.hashes, max(len(items.hashes), 1)
        for batch in batches:
            at = 0
            for part in texts.slices(batch.column("text")):
                found = texts.words(part, texts.ALNUM)
                n = np.diff(found.first)
                hashes = found.hashes.view(np.int64)
                place = np.minimum(np.searchsorted(known, hashes), size - 1)
                hit = np.zeros(len(hashes), bool)
                if len(known):
                    hit = (known[place] == hashes) & (items.lengths[place] == found.ends - found.starts)
                owner = np.repeat(np.arange(len(part)), n)[hit]
                pairs = np.sort(owner * size + place[hit])
                starts, tf = _runs(pairs)
                offsets = np.searchsorted(pairs[starts] // size, np.arange(len(part) + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(at, len(part)),
                        pa.array(n.astype(np.int64)),
                        _lists(offsets, pairs[starts] % size, pa.int32()),
                        _lists(offsets, tf, pa.int32()),
                    ],
                    ["key", "n", "terms", "tf"],
                )
                at += len(part)

    return run


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the offsets of each list."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)
    return values[offsets[0] : offsets[-1]].astype(np.int64), offsets - offsets[0]


def _impacts(weights: np.ndarray, n_docs: int, n_terms: int):
    """A function from counts to impact vectors and their norms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, offsets = _flat(batch.column("terms"))
            tf, _ = _flat(batch.column("tf"))
            n = batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
            length = 100 - 75 + (75 * n * n_docs) // n_terms
            per_entry = np.repeat(length, np.diff(offsets))
            impact = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * per_entry))
            norm, some = np.zeros(len(n)), np.diff(offsets) > 0
            if len(impact):
                norm[some] = np.add.reduceat(impact.astype(np.float64) ** 2, offsets[:-1][some])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"), batch.column("terms"),
                    _lists(offsets, impact, pa.int64()), pa.array(np.sqrt(norm)),
                ],
                ["key", "terms", "impact", "norm"],
            )

    return run


class Best:
    """The k best (score, key) of each item so far, and the score to reach."""

    def __init__(self, floor: np.ndarray, k: int):
        self.k = k
        self.floor = floor.copy()
        self.found: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, item: int, scores: np.ndarray, keys: np.ndarray) -> None:
        if item in self.found:
            held = self.found[item]
            scores, keys = np.concatenate([held[0], scores]), np.concatenate([held[1], keys])
        order = np.lexsort((keys, -scores))[: self.k]
        self.found[item] = scores[order], keys[order]
        if len(order) == self.k:
            self.floor[item] = max(self.floor[item], scores[order[-1]])


class Bucket:
    """Vectors of similar norm, by document and by term."""

    def __init__(self, keys, terms, offsets, impact, norm, size: int):
        self.keys, self.terms, self.offsets, self.impact, self.norm = keys, terms, offsets, impact, norm
        order = np.argsort(terms, kind="stable")
        self.owner = np.repeat(np.arange(len(keys)), np.diff(offsets))[order]
        self.posted = impact[order].astype(np.float64)
        self.first = np.searchsorted(terms[order], np.arange(size + 1))
        self.most = np.zeros(size)  # largest impact of each term
        held = np.flatnonzero(np.diff(self.first))
        if len(held):
            self.most[held] = np.maximum.reduceat(self.posted, self.first[held])

    def survivors(self, terms: np.ndarray, counts: np.ndarray, floor: float) -> np.ndarray:
        """Documents whose score may reach the floor."""
        most = counts * self.most[terms]
        order = np.argsort(-most, kind="stable")
        terms, counts, most = terms[order], counts[order].astype(np.float64), most[order]
        rest = np.append(np.cumsum(most[::-1])[::-1], 0.0)  # bound on what terms[j:] can add
        focus = int(np.searchsorted(-rest * SLACK, -floor, "right"))  # terms[focus:] alone cannot reach it
        if not focus:
            return np.zeros(0, np.int64)
        focus = min(focus, len(terms))
        spans = [(self.first[t], self.first[t + 1]) for t in terms[:focus]]
        owner = np.concatenate([self.owner[a:b] for a, b in spans])
        value = np.concatenate([self.posted[a:b] for a, b in spans])
        times = np.repeat(counts[:focus], [b - a for a, b in spans])
        partial = np.bincount(owner, value * times, len(self.keys))
        seen = np.bincount(owner, value * value, len(self.keys))
        among = np.flatnonzero(partial > 0)
        left = np.sqrt(np.maximum(self.norm[among] ** 2 * SLACK - seen[among], 0.0))
        bound = np.minimum(rest[focus], left * math.sqrt(float(np.sum(counts[focus:] ** 2))))
        return among[(partial[among] + bound) * SLACK >= floor]

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores; `weights` is the item over the whole vocabulary."""
        counts = self.offsets[docs + 1] - self.offsets[docs]
        ends = np.cumsum(counts)
        at = np.repeat(self.offsets[docs] - ends + counts, counts) + np.arange(ends[-1])
        return np.add.reduceat(weights[self.terms[at]] * self.impact[at], ends - counts)


def _search(items: Items, floor: np.ndarray, k: int):
    """A function from vectors, sorted by norm, to the best k for each item of what it has read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, size = Best(floor, k), len(items.hashes)
        spans = list(zip(items.first[:-1], items.first[1:]))
        lengths = np.sqrt(np.add.reduceat(items.counts.astype(np.float64) ** 2, items.first[:-1]))
        weights = np.zeros(size, np.int64)
        for bucket in _buckets(batches, size):
            reach = lengths * bucket.norm.max() * SLACK >= best.floor
            for i in np.flatnonzero(reach):
                a, b = spans[i]
                terms, counts = items.terms[a:b], items.counts[a:b]
                docs = bucket.survivors(terms, counts, best.floor[i])
                if not len(docs):
                    continue
                weights[terms] = counts
                scores = bucket.scores(docs, weights)
                weights[terms] = 0
                good = scores >= max(best.floor[i], 1)
                if good.any():
                    best.add(i, scores[good], bucket.keys[docs[good]])
        for i, (scores, keys) in best.found.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(keys), items.rows[i])),
                    pa.array(keys, mask=keys == _NO_KEY),
                    pa.array(scores),
                ],
                ["row", "key", "score"],
            )

    return run


def _buckets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Bucket]:
    def made(held: list[pa.RecordBatch]) -> Bucket:
        table = pa.Table.from_batches(held).combine_chunks()
        key = table["key"].chunk(0)
        keys = np.where(key.is_null().to_numpy(zero_copy_only=False), _NO_KEY, key.fill_null(0).to_numpy())
        terms, offsets = _flat(table["terms"].chunk(0))
        impact, _ = _flat(table["impact"].chunk(0))
        return Bucket(keys, terms, offsets, impact, table["norm"].to_numpy(), size)

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows >= BUCKET:
            yield made(held)
            held, rows = [], 0
    if rows:
        yield made(held)


def _blocks(rows: DataFrame) -> Iterator[Items]:
    """The items in blocks of at most BLOCK_PAIRS terms, or one item with more."""
    held, pairs = [], 0
    for row in rows.toLocalIterator():
        if held and pairs + len(row["hashes"]) > BLOCK_PAIRS:
            yield Items.of(held)
            held, pairs = [], 0
        held.append(row)
        pairs += len(row["hashes"])
    if held:
        yield Items.of(held)


def _best_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.col("key").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def rank(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
) -> DataFrame:
    """The k best documents with a score above 0 for each row of `items`.

    Terms are runs of ASCII digits, ASCII letters and anything beyond ASCII, with A-Z
    in lower case, told apart by 64 bits and their length. Returns item_key, rank
    (from 1), key and score; equal scores by ascending key, which is a whole number,
    null keys last. Items without terms or matches have no rows. A repeated document
    is ranked as often as it stands there, a repeated item answered as often. Null
    texts have no terms. Other columns are not read. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    texts.small_batches(spark)
    numbered = items.select(
        F.monotonically_increasing_id().alias("row"), F.col(item_key).alias("item"),
        F.col(item_text).alias("text"),
    )
    numbered = written(numbered, "items")
    named = "row long, hashes array<long>, lengths array<int>, counts array<int>"
    asked = numbered.select("row", "text").mapInArrow(_item_terms, named)
    asked = written(asked.where(F.size("hashes") > 0), "item_terms")
    source = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))

    found: DataFrame = spark.createDataFrame([], "row long, key long, score long, rank int")
    for block in _blocks(asked):
        sent = spark.sparkContext.broadcast(block)
        counted = written(
            source.mapInArrow(
                lambda b, sent=sent: _count_terms(sent.value)(b), "key long, n long, terms array<int>, tf array<int>"
            ),
            "counted",
        )
        n_docs, n_terms = counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        if not n_docs:
            break
        seen = counted.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
        df = np.zeros(len(block.hashes), np.int64)
        df[seen["term"].to_numpy()] = seen["count"].to_numpy()
        weights = np.array(
            [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64
        )
        vectors = counted.where(F.size("terms") > 0).mapInArrow(
            _impacts(weights, n_docs, n_terms), "key long, terms array<int>, impact array<long>, norm double"
        )
        # equal vectors have equal norms; the hash deals them out
        order = [F.desc("norm"), F.xxhash64("key")]
        vectors = written(vectors, "vectors")
        vectors = written(vectors.repartitionByRange(*order).sortWithinPartitions(*order), "by_norm")
        cut = (vectors.approxQuantile("norm", [1 - LONGEST], LONGEST / 4) or [0.0])[0]
        shape = "row long, key long, score long"

        def best(part: DataFrame, floor: np.ndarray, sent=sent) -> DataFrame:
            some = part.mapInArrow(lambda b: _search(sent.value, floor, k)(b), shape)
            return written(_best_of(some, k), "best")

        longest = best(vectors.where(F.col("norm") >= cut), np.zeros(len(block.rows), np.int64))
        reached = longest.where(F.col("rank") == k).select("row", "score").toArrow()
        floor = np.zeros(len(block.rows), np.int64)
        floor[np.searchsorted(block.rows, reached["row"].to_numpy())] = reached["score"].to_numpy()
        others = best(vectors.where(F.col("norm") < cut), floor)
        found = found.union(_best_of(longest.union(others).drop("rank"), k))
    return found.join(numbered.select("row", "item"), "row").select(
        F.col("item").alias(item_key), "rank", F.col("key").alias(key), "score"
    )
