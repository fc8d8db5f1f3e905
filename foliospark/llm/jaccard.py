"""All pairs of documents whose sets of word n-grams are alike, as classes of linked documents.

The pairs are the large entries of the product of the document by n-gram incidence
matrix with its transpose. Only a block of that product is ever computed: of each
document the few n-grams that any partner must share one of (the rarest ones, as
many as its size demands). Overlaps within that block are added up per pair, and a
pair is discarded when the sum stays below what its two sizes demand. The rest is
verified on whole sets.

Groups of many copies do not become all their pairs: equal sets are one node, and
links are first sought to one hub per n-gram; pairs inside a found component are
never formed. What remains between components is compared in full, so no link that
could join two components is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from foliospark.llm.graph import components
from foliospark.llm.tables import few_files, narrow, sized
from foliospark.llm.texts import SPACED, mixed, shingles, slices, small_batches, words
from foliospark.plans.scratch import written

#: At most so many n-grams are known to be frequent: 8 bytes each reach every executor.
MAX_FREQUENT = 1 << 19
LEAST_POWER = 2
FLUSH = 2 << 20
#: Pairs are held against a demand of up to so many shared n-grams.
SHARED = 2
_SALT = np.uint64(0xC2B2AE3D27D4EB4F)
_BITS = np.uint64((1 << 20) - 1)


def _sets(texts: pa.Array, size: int) -> Iterator[list[np.ndarray]]:
    """Per slice, each text's distinct shingles in ascending order."""
    for part in slices(texts):
        grams, at = shingles(words(part, SPACED), size)
        yield [np.unique(grams[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


def _frequent(docs: DataFrame, text: str, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-grams of many documents, ascending, the binary logarithm of how many, and their low bits.

    Counted over all documents, though not those that a task meets only once: they
    decide the order of n-grams, hence speed, and never the result. The threshold is
    the least power of two that at most MAX_FREQUENT reach.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0

        def flush() -> pa.RecordBatch:
            grams, counts = np.unique(np.concatenate(held), return_counts=True)
            many = counts > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(grams[many].view(np.int64)), pa.array(counts[many].astype(np.int64))],
                ["g", "c"],
            )

        for batch in batches:
            for part in _sets(batch.column(0), size):
                held += part
                n += sum(map(len, part))
                if n >= FLUSH:
                    yield flush()
                    n, held = 0, []
        if held:
            yield flush()

    counted = narrow(
        docs.select(text).mapInArrow(count, "g long, c long").groupBy("g").agg(F.sum("c").alias("c")),
        "gram_counts",
    )
    powers = counted.groupBy(F.floor(F.log2("c")).alias("p")).count().collect()
    sizes = {row["p"]: row["count"] for row in powers}
    power, n = 64, 0
    while power > LEAST_POWER and n + sizes.get(power - 1, 0) <= MAX_FREQUENT:
        power -= 1
        n += sizes.get(power, 0)
    found = counted.where(F.col("c") >= float(2**power)).toArrow()
    grams = found.column("g").to_numpy().view(np.uint64)
    order = np.argsort(grams)
    levels = np.floor(np.log2(np.maximum(found.column("c").to_numpy()[order], 1)))
    bits = np.zeros(1 << 20, bool)
    bits[grams & _BITS] = True
    return grams[order], levels.astype(np.uint8), bits


def _signature(size: int, percent: int, frequent):
    """Of a text: key and size of its set, and the n-grams of which any partner has one."""

    def levels_of(grams: np.ndarray) -> np.ndarray:
        known, level, bits = frequent.value
        out = np.zeros(len(grams), np.uint8)
        if len(known):
            maybe = np.flatnonzero(bits[grams & _BITS])
            at = np.minimum(np.searchsorted(known, grams[maybe]), len(known) - 1)
            out[maybe] = np.where(known[at] == grams[maybe], level[at], 0)
        return out

    def prefix(grams: np.ndarray, level: np.ndarray) -> np.ndarray:
        length = len(grams) - (percent * len(grams) + 99) // 100 + 1
        first = grams[level == 0][:length]
        if len(first) < length:
            rest = np.flatnonzero(level)
            rest = rest[np.lexsort((grams[rest], level[rest]))][: length - len(first)]
            first = np.concatenate([first, grams[rest]])
        return first.view(np.int64)

    @F.arrow_udf("struct<k: long, n: long, prefix: array<long>>")
    def signature(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        seen: set[int] = set()  # a task tells the n-grams of equal sets once
        for texts in batches:
            keys, sizes, prefixes = [], [], []
            for part in _sets(texts, size):
                level = levels_of(np.concatenate(part))
                at = 0
                for grams in part:
                    key = set_key(grams)
                    new = key is not None and key not in seen
                    keys.append(key)
                    sizes.append(len(grams))
                    prefixes.append(prefix(grams, level[at : at + len(grams)]) if new else None)
                    at += len(grams)
                    seen.add(key)
            yield pa.StructArray.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                ],
                ["k", "n", "prefix"],
            )

    return signature.asNondeterministic()  # it remembers, so it must run once for each row


def set_key(grams: np.ndarray) -> int | None:
    """A 64-bit key of a set of n-grams; none for the empty set."""
    if not len(grams):
        return None
    total = np.add.reduce(mixed(grams ^ _SALT)) + np.uint64(len(grams))
    return int(mixed(np.array([total], np.uint64)).view(np.int64)[0])


def _whole_sets(texts: DataFrame, size: int) -> DataFrame:
    """Rows (k, grams): the sets of some texts; a task tells each set once."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int | None] = {None}
        for batch in batches:
            found = {}
            for part in _sets(batch.column(0), size):
                for grams in part:
                    key = set_key(grams)
                    if key not in seen:
                        seen.add(key)
                        found[key] = grams.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.int64()), pa.array(found.values(), pa.binary())],
                ["k", "grams"],
            )

    return texts.mapInArrow(whole, "k long, grams binary")


@F.arrow_udf(LongType())
def _overlap(a: pa.Array, b: pa.Array) -> pa.Array:
    def common(x, y) -> int:
        both = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)])
        both.sort(kind="stable")
        return int(np.count_nonzero(both[1:] == both[:-1]))

    return pa.array([common(x, y) for x, y in zip(a, b, strict=True)], pa.int64())


def _least_overlap(n1: Column, n2: Column, percent: int) -> Column:
    """The smallest overlap that links sets of these sizes."""
    return F.ceil(percent * (n1 + n2) / (100 + percent))


def _least_shared(n1: Column, n2: Column, percent: int) -> Column:
    """How many n-grams the prefixes of linked sets of these sizes share at least, up to SHARED.

    Sets with an overlap of o share l n-grams among the first n1 - o + l and n2 - o + l;
    as many of them stand in a prefix as that of the larger set admits.
    """
    room = _least_overlap(n1, n2, percent) + 1 - F.ceil(percent * F.greatest(n1, n2) / 100)
    return F.least(F.lit(SHARED), room)


def _counts(n1: Column, i1: Column, n2: Column, i2: Column, percent: int) -> Column:
    """Whether a shared n-gram at these places is one of those that `_least_shared` tells of."""
    spare = _least_shared(n1, n2, percent) - _least_overlap(n1, n2, percent)
    sized = 100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)
    return sized & (i1 < n1 + spare) & (i2 < n2 + spare)


def _possible(pairs: DataFrame, percent: int) -> DataFrame:
    """Add up shared n-grams per pair; discard pairs with fewer than their sizes demand."""
    first = F.col("k1") < F.col("k2")
    summed = (
        pairs.select(
            F.least("k1", "k2").alias("a"), F.greatest("k1", "k2").alias("b"),
            F.when(first, F.col("n1")).otherwise(F.col("n2")).alias("na"),
            F.when(first, F.col("n2")).otherwise(F.col("n1")).alias("nb"),
        )
        .groupBy("a", "b", "na", "nb")
        .agg(F.count("*").alias("shared"))
    )
    return summed.where(F.col("shared") >= _least_shared(F.col("na"), F.col("nb"), percent))


def _sets_of(pairs: DataFrame, docs: DataFrame, carriers: DataFrame, size: int) -> DataFrame:
    """The whole sets of the nodes of some pairs, from one text of each."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("k")).distinct()
    texts = narrow(ends.join(carriers, "k").select("t"), "texts")
    chosen = docs.join(sized(texts), "t", "left_semi").select("text")
    return written(_whole_sets(chosen, size).dropDuplicates(["k"]), "gram_sets")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    joined = (
        pairs.join(sets.select(F.col("k").alias("a"), F.col("grams").alias("ga")), "a")
        .join(sets.select(F.col("k").alias("b"), F.col("grams").alias("gb")), "b")
        .select("a", "b", "na", "nb", _overlap.asNondeterministic()("ga", "gb").alias("both"))
    )
    union = F.col("na") + F.col("nb") - F.col("both")
    return narrow(joined.where(100 * F.col("both") >= percent * union).select("a", "b"), "verified")


def _between(lists: DataFrame, links: DataFrame) -> DataFrame:
    """Postings with the components found so far; n-grams of one component only are left out."""
    roots = components(links)
    marked = lists.drop("c").join(roots.withColumnRenamed("node", "k"), "k", "left")
    marked = marked.select("g", "k", "n", "i", F.coalesce("root", "k").alias("c"))
    spans = marked.groupBy("g").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi")
    return written(marked.join(spans.select("g"), "g", "left_semi"), "open_postings")


def _hub_pairs(lists: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each node with the hub that it shares the most n-grams with.

    The hub of an n-gram and a size class is the node with the fewest rarer n-grams
    before it, since of many copies the least altered one is like most others (ties by
    a hash of the turn). Nodes look at the hubs of their own and the next smaller class.
    Only the n-grams of a hub count, so a pair may be passed over; it is then among
    those compared between components.
    """
    width = -np.log(percent / 100) if percent < 100 else 1e-9
    classed = lists.withColumn("s", F.floor(F.log("n") / float(width)))
    hub = F.min(F.struct("i", F.xxhash64("k", F.lit(turn)).alias("h"), "k", "n", "c"))
    hubs = classed.groupBy("g", "s").agg(hub.alias("hub")).select(
        "g", F.explode(F.array("s", F.col("s") + 1)).alias("s"), "hub"
    )
    pairs = classed.join(hubs, ["g", "s"]).where(F.col("c") != F.col("hub.c")).select(
        F.col("k").alias("k1"), F.col("n").alias("n1"), F.col("i").alias("i1"),
        F.col("hub.k").alias("k2"), F.col("hub.n").alias("n2"), F.col("hub.i").alias("i2"),
    )
    n1, n2, i1, i2 = (F.col(x) for x in ("n1", "n2", "i1", "i2"))
    possible = _possible(pairs.where(_counts(n1, i1, n2, i2, percent)), percent)
    ends = F.array(F.struct(F.col("a").alias("k")), F.struct(F.col("b").alias("k")))
    best = (
        possible.withColumn("end", F.explode(ends))
        .groupBy("end.k")
        .agg(F.max(F.struct("shared", "a", "b", "na", "nb")).alias("p"))
    )
    return best.select("p.a", "p.b", "p.na", "p.nb").distinct()


def _cross_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """All possible pairs of nodes of different components that share an n-gram.

    One side leaves out the n-gram's largest component, so a component of any
    size is never paired with itself.
    """
    sizes = lists.groupBy("g", "c").agg(F.count("*").alias("m"))
    largest = sizes.groupBy("g").agg(F.max(F.struct("m", "c")).alias("top")).select(
        "g", F.col("top.c").alias("top")
    )
    marked = lists.join(largest, "g").withColumn("in_top", F.col("c") == F.col("top"))
    left = marked.where(~F.col("in_top")).select(
        "g", F.col("k").alias("k1"), F.col("n").alias("n1"), F.col("i").alias("i1"),
        F.col("c").alias("c1"),
    )
    right = marked.select(
        "g", F.col("k").alias("k2"), F.col("n").alias("n2"), F.col("i").alias("i2"),
        F.col("c").alias("c2"), "in_top",
    )
    n1, n2, i1, i2 = (F.col(x) for x in ("n1", "n2", "i1", "i2"))
    pairs = left.join(right, "g").where(
        (F.col("c1") != F.col("c2"))
        & (F.col("in_top") | (F.col("k1") < F.col("k2")))
        & _counts(n1, i1, n2, i2, percent)
    )
    return _possible(pairs, percent).select("a", "b", "na", "nb")


def link_similar(
    docs: DataFrame,
    size: int = 4,
    percent: int = 85,
    text: str = "text",
    key: str = "doc_id",
    hub_turns: int = 2,
) -> DataFrame:
    """The class of every row of `docs` under links of Jaccard similarity >= percent / 100.

    Words are runs of anything but ASCII white space with A-Z in lower case; a set
    holds the distinct shingles of `size` words, or the whole sequence of a shorter
    text. Two sets link when 100 * intersection >= percent * union.

    Returns key, text_key (a hash of the text), n_shingles, class_key (the same for
    linked rows, null for texts without words, which link with nothing) and
    component_id, the smallest key of the class (the row's own without words).
    Null keys are never the smallest unless alone. Repeated rows stay repeated. An
    empty table gives an empty table.
    """
    spark = docs.sparkSession
    small_batches(spark)
    frequent = spark.sparkContext.broadcast(_frequent(docs, text, size))
    signed = docs.select(
        F.col(key).alias("doc"), F.xxhash64(text).alias("t"),
        _signature(size, percent, frequent)(F.col(text)).alias("x"),
    ).select("doc", "t", "x.*")
    signed = written(signed, "signatures")
    reps = signed.where(F.col("prefix").isNotNull()).dropDuplicates(["k"])
    reps = written(reps.select("k", "n", "prefix"), "representatives")
    postings = reps.select("k", "n", F.posexplode("prefix").alias("i", "g"))
    shared = postings.groupBy("g").agg(F.count("*").alias("m")).where("m > 1").select("g")
    lists = written(postings.join(shared, "g", "left_semi"), "shared_postings")
    carriers = signed.where(F.col("k").isNotNull()).groupBy("k").agg(F.min("t").alias("t"))
    hashed = docs.select(F.col(text).alias("text"), F.xxhash64(text).alias("t"))

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = narrow(pairs, "pairs")
        return _verified(pairs, _sets_of(pairs, hashed, carriers, size), percent)

    lists = lists.select("g", "k", "n", "i", F.col("k").alias("c"))
    links = spark.range(0).select(F.col("id").alias("a"), F.col("id").alias("b"))
    for turn in range(hub_turns):
        links = links.union(verified(_hub_pairs(lists, turn, percent)))
        lists = _between(lists, links)
    links = links.union(verified(_cross_pairs(lists, percent)))

    roots = components(links).withColumnRenamed("node", "k")
    classed = signed.join(roots, "k", "left").select(
        "doc", "t", "n", F.coalesce("root", "k").alias("class")
    )
    classed = narrow(classed, "classed")
    smallest = classed.where(F.col("class").isNotNull()).groupBy("class").agg(
        F.min("doc").alias("smallest")
    )
    return few_files(classed.join(smallest, "class", "left")).select(
        F.col("doc").alias(key),
        F.col("t").alias("text_key"),
        F.col("n").alias("n_shingles"),
        F.col("class").alias("class_key"),
        F.when(F.col("class").isNull(), F.col("doc")).otherwise(F.col("smallest")).alias("component_id"),
    )
