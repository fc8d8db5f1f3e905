"""Documents dealt to a fixed number of shards of near equal bytes, equal texts together.

Groups of equal texts enter, largest first, the shard with the least remaining
capacity that still holds them. Groups of the same bytes are interchangeable, so the
plan needs only how many groups there are of each: every group is placed, whatever
its part of the whole. Groups of n different bytes hold at least n * n / 2 bytes, so
there are at most as many rows of that histogram as the square root of twice the
corpus. The driver sees them and never a group or a document; Spark then deals the
plan's places to the groups.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.numbering import numbered
from foliospark.llm.tables import few_files, narrow
from foliospark.plans.scratch import written

SHARDS = 16
_KEY = ["_h1", "_h2"]


class _Node(NamedTuple):
    """A subtree of bins in the order of (remaining capacity, shard)."""

    height: int
    bin: tuple[int, int]
    left: _Node | None
    right: _Node | None


def _height(node: _Node | None) -> int:
    return node.height if node else 0


def _joined(bin: tuple[int, int], left: _Node | None, right: _Node | None) -> _Node:
    """A subtree whose sides differ by one in height, from sides that differ by two at most."""
    if _height(left) > _height(right) + 1:
        if _height(left.left) < _height(left.right):
            inner = left.right
            return _joined(inner.bin, _joined(left.bin, left.left, inner.left), _joined(bin, inner.right, right))
        return _joined(left.bin, left.left, _joined(bin, left.right, right))
    if _height(right) > _height(left) + 1:
        if _height(right.right) < _height(right.left):
            inner = right.left
            return _joined(inner.bin, _joined(bin, left, inner.left), _joined(right.bin, inner.right, right.right))
        return _joined(right.bin, _joined(bin, left, right.left), right.right)
    return _Node(1 + max(_height(left), _height(right)), bin, left, right)


def inserted(node: _Node | None, bin: tuple[int, int]) -> _Node:
    if node is None:
        return _Node(1, bin, None, None)
    if bin < node.bin:
        return _joined(node.bin, inserted(node.left, bin), node.right)
    return _joined(node.bin, node.left, inserted(node.right, bin))


def removed(node: _Node, bin: tuple[int, int]) -> _Node | None:
    if bin < node.bin:
        return _joined(node.bin, removed(node.left, bin), node.right)
    if bin > node.bin:
        return _joined(node.bin, node.left, removed(node.right, bin))
    if node.left is None or node.right is None:
        return node.left or node.right
    after = node.right
    while after.left:
        after = after.left
    return _joined(after.bin, node.left, removed(node.right, after.bin))


def tightest(node: _Node | None, size: int) -> tuple[int, int] | None:
    """The bin with the least remaining capacity that holds `size`."""
    best = None
    while node:
        if node.bin[0] >= size:
            best, node = node.bin, node.left
        else:
            node = node.right
    return best


#: (bytes of a group, number of groups, shard)
Place = tuple[int, int, int]


def fitted(counts: list[tuple[int, int]], shards: range, capacity: int) -> list[Place] | None:
    """Best fit into shards of a capacity, counts largest first; None if a group finds no room.

    A shard that takes a group stays the tightest one as long as it holds another of
    the same bytes, so it takes as many of them at once as it holds.
    """
    bins: _Node | None = None
    for shard in shards:
        bins = inserted(bins, (capacity, shard))
    out = []
    for size, left in counts:
        while left:
            found = tightest(bins, size)
            if found is None:
                return None
            room, shard = found
            taken = min(left, room // size)
            bins = inserted(removed(bins, found), (room - taken * size, shard))
            out.append((size, taken, shard))
            left -= taken
    return out


def place(counts: dict[int, int], shards: int = SHARDS) -> list[Place]:
    """Shards for `counts[bytes]` groups of each number of bytes, in the least capacity that holds all.

    A group of more than the mean of what is left has a shard for itself. For the rest
    the capacity starts from the mean; one that is too small grows by doubled steps
    and is then bisected.
    """
    order = sorted(((size, n) for size, n in counts.items() if n), reverse=True)
    total, alone = sum(size * n for size, n in order), []
    while order and len(alone) < shards - 1 and order[0][0] * (shards - len(alone)) > total:
        size, n = order.pop(0)
        alone.append((size, 1, len(alone)))
        total -= size
        if n > 1:
            order.insert(0, (size, n - 1))
    if not order:
        return alone
    others = range(len(alone), shards)
    least = most = -(-total // len(others))
    step, found = 1, fitted(order, others, least)
    while found is None:
        least, most, step = most, most + step, 2 * step
        found = fitted(order, others, most)
    while most - least > 1:
        middle = (least + most) // 2
        tried = fitted(order, others, middle)
        if tried is None:
            least = middle
        else:
            most, found = middle, tried
    return alone + found


def _hashes(text: Column) -> Column:
    return F.struct(F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit(1), text).alias("_h2"))


def _ranges(places: list[Place]) -> pa.Table:
    """Which ranks among the groups of the same bytes go to which shard."""
    used: dict[int, int] = {}
    rows = []
    for size, n, shard in places:
        first = used.get(size, 0)
        used[size] = first + n
        rows.append((size, first, first + n, shard))
    names = ["bytes", "first", "end", "shard"]
    columns = np.array(rows, np.int64).reshape(-1, len(names)).T
    return pa.Table.from_arrays([pa.array(c) for c in columns], names)


def shard(docs: DataFrame, shards: int = SHARDS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Shard and place of every row of `docs`; rows with equal texts share a shard.

    Returns key, size (UTF-8 bytes and 1), text_crc32, shard and slot (0, 1, ... within
    the shard). A null text is an empty one. Shards can only be as equal as groups of
    equal texts allow. Which of the groups of the same bytes goes to which shard is
    arbitrary, and so is the order of slots. Repeated rows each take a place. An empty
    table gives an empty table.
    """
    spark = docs.sparkSession
    value = F.coalesce(F.col(text), F.lit(""))
    rows = written(
        docs.select(
            F.monotonically_increasing_id().alias("_row"),
            F.col(key).alias("_doc"),
            (F.octet_length(value) + F.lit(1)).cast("long").alias("size"),
            F.crc32(value.cast("binary")).alias("text_crc32"),
            _hashes(value).alias("_h"),
        ).select("_row", "_doc", "size", "text_crc32", "_h.*"),
        "sizes",
    )
    summed = few_files(rows.groupBy(*_KEY).agg(F.sum("size").alias("bytes")))
    groups = written(summed.withColumn("_group", F.monotonically_increasing_id()), "groups")
    counts = groups.groupBy("bytes").agg(F.count("*").alias("n")).toArrow()
    sizes = dict(zip(counts["bytes"].to_pylist(), counts["n"].to_pylist(), strict=True))
    dealt = spark.createDataFrame(_ranges(place(sizes, shards)))
    ranked = numbered(groups, "bytes", "_group", "rank")
    inside = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end"))
    homes = ranked.join(dealt, "bytes").where(inside).select(*_KEY, F.col("shard").cast("int").alias("shard"))
    placed = narrow(
        rows.join(homes, _KEY).select("_row", "_doc", "size", "text_crc32", "shard"), "placed"
    )
    return few_files(numbered(placed, "shard", "_row", "slot")).select(
        F.col("_doc").alias(key), "size", "text_crc32", "shard", "slot"
    )
