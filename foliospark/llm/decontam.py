"""Benchmark passages inside documents, found by spaced seeds and verified token by token.

A seed is a fixed mask over consecutive tokens of which some positions are ignored,
so a passage is still hit when tokens at ignored positions were replaced. Seeds of
the test items and of the documents are joined on their hashes; every hit names a
diagonal (place in the document less place in the item) along which the two are
then compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from foliospark.llm.texts import ALNUM, Words, mixed, slices, small_batches, words
from foliospark.llm.tables import few_files, narrow
from foliospark.plans.scratch import written

# The masks; 1 is a position that must agree.
# Together they hit 13 words of which any two were replaced.
MASKS = ["111011101", "1101100111", "10110101011", "11001110101", "11010110111"]
#: Further masks of items whose words are fewer, so that any 80 percent of them are hit.
SHORT_MASKS = {
    9: ["10110111", "101011011"],
    10: ["111101", "10100111"],
    11: ["1111011", "1100010111"],
    12: ["11010011011", "101001110011"],
}
#: Items of fewer words are not searched; those shorter than a mask get one without gaps.
MIN_WORDS = 1
SHORTEST = min(map(len, MASKS))
#: Documents' seeds go through a bitmap of this fixed size before the join.
FILTER_BITS = 23
_LOW = np.uint64((1 << FILTER_BITS) - 1)
_HALF = np.uint64(32)


def masks_of(n: int) -> list[str]:
    """The masks by which an item of n words is found."""
    if n < SHORTEST:
        return ["1" * n] if n >= MIN_WORDS else []
    return MASKS + SHORT_MASKS.get(n, [])


def _seeds(found: Words, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash and word position of every place of the mask; none spans two texts."""
    n = np.diff(found.first)
    counts = np.maximum(n - len(mask) + 1, 0)
    before = np.cumsum(counts) - counts
    at = np.repeat(found.first[:-1] - before, counts) + np.arange(counts.sum())
    out = np.full(len(at), int(mask + "1", 2), np.uint64)
    for j, used in enumerate(mask):
        if used == "1":
            out = out * np.uint64(0x9FB21C651E98DF25) + found.hashes[at + j]
    return mixed(out), at


def _item_seeds(items: DataFrame) -> DataFrame:
    """Per item its token hashes and its seeds; short items get one mask as long as they are."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in slices(batch.column("text")):
                found = words(part, ALNUM)
                n = np.diff(found.first)
                seeds: list[list[int]] = [[] for _ in n]
                places: list[list[int]] = [[] for _ in n]
                masks = {x: masks_of(x) for x in set(n.tolist())}
                for mask in sorted({m for own in masks.values() for m in own}):
                    hashes, at = _seeds(found, mask)
                    own = np.searchsorted(found.first, at, "right") - 1
                    for h, p, i in zip(hashes.view(np.int64), at, own, strict=True):
                        if mask in masks[n[i]]:
                            seeds[i].append(int(h))
                            places[i].append(int(p - found.first[i]))
                tokens = [
                    found.hashes[a:b].tobytes()
                    for a, b in zip(found.first[:-1], found.first[1:], strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(done, len(part)),
                        pa.array(tokens, pa.binary()),
                        pa.array(seeds, pa.list_(pa.int64())),
                        pa.array(places, pa.list_(pa.int64())),
                    ],
                    ["row", "tokens", "seeds", "places"],
                )
                done += len(part)

    return items.mapInArrow(
        cut, "row long, tokens binary, seeds array<long>, places array<long>"
    )


def _candidates(docs: DataFrame, bits, lengths: list[int]) -> DataFrame:
    """Documents with seeds that pass the bitmap: token hashes, these seeds and their places."""
    masks = sorted({m for n in lengths for m in masks_of(n)}) or MASKS
    carried = [c for c in docs.columns if c != "text"]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(np.frombuffer(bits.value, np.uint8)).view(bool)
        for batch in batches:
            done = 0
            for part in slices(batch.column("text")):
                found = words(part, ALNUM)
                seeds, places = [], []
                for mask in masks:
                    hashes, at = _seeds(found, mask)
                    hit = np.flatnonzero(known[hashes & _LOW])
                    hit = hit[known[(hashes[hit] >> _HALF) & _LOW]]
                    if len(mask) < SHORTEST and "0" not in mask:
                        # a short item agrees whole, so a text's first place of it is the best
                        text_of = np.searchsorted(found.first, at[hit], "right")
                        order = np.lexsort((hit, hashes[hit], text_of))
                        t, h = text_of[order], hashes[hit][order]
                        hit = hit[order[np.append(True, (t[1:] != t[:-1]) | (h[1:] != h[:-1]))[: len(order)]]]
                    seeds.append(hashes[hit])
                    places.append(at[hit])
                hashes, at = np.concatenate(seeds), np.concatenate(places)
                own = np.searchsorted(found.first, at, "right") - 1
                order = np.argsort(own, kind="stable")
                hashes, at, own = hashes[order].view(np.int64), at[order], own[order]
                rows, begin = np.unique(own, return_index=True)
                end = np.append(begin[1:], len(own))
                if len(rows):
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(batch.column(c).take(pa.array(rows + done)) for c in carried),
                            pa.array(
                                [found.hashes[found.first[i] : found.first[i + 1]].tobytes() for i in rows],
                                pa.binary(),
                            ),
                            pa.array([hashes[a:b] for a, b in zip(begin, end, strict=True)], pa.list_(pa.int64())),
                            pa.array(
                                [at[a:b] - found.first[i] for a, b, i in zip(begin, end, rows, strict=True)],
                                pa.list_(pa.int64()),
                            ),
                        ],
                        [*carried, "tokens", "seeds", "places"],
                    )
                done += len(part)

    longs = ArrayType(LongType())
    more = [("tokens", BinaryType()), ("seeds", longs), ("places", longs)]
    kind = [docs.schema[c] for c in carried] + [StructField(*x) for x in more]
    return docs.mapInArrow(look, StructType(kind))


def _bitmap(seeds: DataFrame) -> bytes:
    """A bitmap of fixed size that holds every seed twice."""
    low, half = (1 << FILTER_BITS) - 1, 32
    bits = np.zeros(1 << FILTER_BITS, bool)
    probes = F.array(
        F.col("h").bitwiseAND(low), F.shiftrightunsigned("h", half).bitwiseAND(low)
    )
    marked = seeds.select(F.explode(probes).alias("b")).distinct().toArrow()
    bits[marked.column("b").to_numpy()] = True
    return np.packbits(bits).tobytes()


def best_overlap(
    doc: np.ndarray, item: np.ndarray, diagonals: list[int], window: int, percent: int
) -> tuple[int, int, int] | None:
    """The stretch with most agreeing tokens on any diagonal: (agreeing, length, place in doc).

    A stretch counts if each of its tokens lies in a window of `window` tokens (or
    the whole item) of which `percent` agree; items shorter than a mask must agree whole.
    """
    size = min(window, len(item))
    percent = 100 if len(item) < SHORTEST else percent
    best = None
    for d in diagonals:
        lo, hi = max(0, -d), min(len(item), len(doc) - d)
        if hi - lo < size:
            continue
        same = doc[lo + d : hi + d] == item[lo:hi]
        sums = np.concatenate([[0], np.cumsum(same)])
        good = np.flatnonzero(100 * (sums[size:] - sums[:-size]) >= percent * size)
        if not len(good):
            continue
        breaks = np.flatnonzero(np.diff(good) > size)
        for a, b in zip(good[np.append(0, breaks + 1)], good[np.append(breaks, len(good) - 1)] + size, strict=True):
            found = (int(sums[b] - sums[a]), int(b - a), int(a + lo + d))
            if best is None or (found[0], -found[1], -found[2]) > (best[0], -best[1], -best[2]):
                best = found
    return best


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
    window: int = 13,
    percent: int = 80,
) -> DataFrame:
    """One row for each document and item of which the document holds a passage.

    Tokens are runs of ASCII letters and digits and characters beyond ASCII, A-Z in
    lower case. A passage is a stretch of at least `window` tokens (or the whole of
    a shorter item) of which `percent` agree in place; items shorter than the shortest
    mask must agree whole. Null or empty texts are never reported. Repeated rows are
    reported each; null keys stay null; empty tables give an empty table. The masks
    find every such passage of the default `window` and `percent`.

    Returns key, item_key, text_key (a hash of the document's text), n_agree, n_span
    and at_word (the place in the document).
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = F.monotonically_increasing_id().alias("row")
    items = written(
        benchmark.select(rows, F.col(item_key).alias("item"), F.col(item_text).alias("text")),
        "items",
    )
    cut = written(_item_seeds(items.select("row", "text")), "item_seeds")
    zipped = F.explode(F.arrays_zip("seeds", "places")).alias("s")
    seeds = narrow(
        cut.select(F.col("row").alias("irow"), zipped).select(
            "irow", F.col("s.seeds").alias("h"), F.col("s.places").alias("ip")
        ),
        "seeds",
    )
    sized = (F.octet_length("tokens") / 8).cast("int")
    # Beyond the longest that has masks of its own all items have the same ones.
    most = max(SHORT_MASKS) + 1
    lengths = [r.n for r in cut.select(F.least(sized, F.lit(most)).alias("n")).distinct().collect()]
    bits = spark.sparkContext.broadcast(_bitmap(seeds))

    # The row number is written with what it numbers, so later reads agree on it.
    keyed = docs.select(
        rows, F.col(key).alias("doc"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text")
    )
    found = written(_candidates(keyed, bits, lengths), "candidates")
    hits = (
        found.select("row", zipped)
        .select("row", F.col("s.seeds").alias("h"), F.col("s.places").alias("dp"))
        .join(seeds, "h")
        .select("row", "irow", (F.col("dp") - F.col("ip")).alias("d"))
        .distinct()
        .groupBy("row", "irow")
        .agg(F.collect_list("d").alias("diagonals"))
    )

    @F.arrow_udf("struct<n_agree: long, n_span: long, at_word: long>")
    def verified(doc: pa.Array, item: pa.Array, diagonals: pa.Array) -> pa.Array:
        best = [
            best_overlap(
                np.frombuffer(d.as_buffer(), np.uint64), np.frombuffer(i.as_buffer(), np.uint64),
                x.as_py(), window, percent,
            )
            for d, i, x in zip(doc, item, diagonals, strict=True)
        ]
        names = ["n_agree", "n_span", "at_word"]
        return pa.array(
            [b and dict(zip(names, b, strict=True)) for b in best],
            pa.struct([(n, pa.int64()) for n in names]),
        )

    named = cut.select(F.col("row").alias("irow"), F.col("tokens").alias("itokens")).join(
        items.select(F.col("row").alias("irow"), "item"), "irow"
    )
    return few_files(
        hits.join(found.select("row", "doc", "text_key", "tokens"), "row")
        .join(named, "irow")
        .select("doc", "item", "text_key", verified.asNondeterministic()("tokens", "itokens", "diagonals").alias("v"))
        .where(F.col("v").isNotNull())
        .select(F.col("doc").alias(key), F.col("item").alias(item_key), "text_key", "v.*")
    )

