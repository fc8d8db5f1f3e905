"""Merkle manifest of a table: a persistent path-copying tree over aligned blocks of leaves.

The rows of a group are the leaves of a tree of fan-out three, in the order of their
key. A block of 3^7 consecutive leaves is a subtree that one task builds; the tops of
the blocks are the leaves of the blocks above, until one block holds all. Inside a
block nodes never change: an amended leaf makes a version of the subtree that copies
the leaf's ancestors and shares every other node. Above the block a version goes on
as a row of its own, folded with the siblings that all leaves of the block share.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.plans.scratch import written

FANOUT = 3
DEPTH = 7
BLOCK = FANOUT**DEPTH
_RUN_BITS = 12

_STEP = "struct<left: binary, right: binary>"
_MADE = f"version binary, copied int, top binary, path array<{_STEP}>"


class Arena:
    """Nodes that never change. A version is the number of a root; versions share nodes."""

    def __init__(self):
        self.children: list[tuple[int, ...]] = []
        self.digests: list[bytes] = []  # hex text

    def add(self, digest: bytes) -> int:
        self.children.append(())
        self.digests.append(digest)
        return len(self.digests) - 1

    def parent(self, children: tuple[int, ...]) -> int:
        text = b"".join([self.digests[c] for c in children])
        self.children.append(children)
        self.digests.append(sha256(text).hexdigest().encode())
        return len(self.digests) - 1

    def grow(self, leaves: Sequence[bytes], levels: int) -> int:
        """The root over the leaves; a last run of one has a parent, too."""
        row = [self.add(x) for x in leaves]
        for _ in range(levels):
            row = [self.parent(tuple(row[i : i + FANOUT])) for i in range(0, len(row), FANOUT)]
        return row[0]

    def descent(self, root: int, levels: int, at: int) -> list[tuple[tuple[int, ...], int]]:
        """(children, which of them) from the root down to leaf `at`."""
        out, node = [], root
        for below in range(levels - 1, -1, -1):
            which = at // FANOUT**below % FANOUT
            out.append((self.children[node], which))
            node = self.children[node][which]
        return out

    def path(self, descent: Sequence[tuple[tuple[int, ...], int]]) -> list[tuple[bytes, bytes]]:
        """Digests left and right of the way, from the leaf up."""
        d = self.digests
        return [
            (b"".join([d[c] for c in kids[:i]]), b"".join([d[c] for c in kids[i + 1 :]]))
            for kids, i in reversed(descent)
        ]

    def amend(self, descent: Sequence[tuple[tuple[int, ...], int]], leaf: bytes) -> int:
        """The root of a version with another leaf: new ancestors, all else shared."""
        node = self.add(leaf)
        for kids, i in reversed(descent):
            node = self.parent((*kids[:i], node, *kids[i + 1 :]))
        return node


def _levels(n: int) -> int:
    """Levels inside a block of a tree of n leaves."""
    levels = 0
    while FANOUT**levels < min(n, BLOCK):
        levels += 1
    return levels


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Table]]:
    """The blocks of a sorted partition, those that an input batch completes at a time."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
        if not len(table):
            continue
        block = pc.divide(table["pos"], BLOCK)
        new = pc.or_(
            pc.not_equal(table["tree"][1:], table["tree"][:-1]), pc.not_equal(block[1:], block[:-1])
        )
        cuts = np.flatnonzero(new.to_numpy(zero_copy_only=False)) + 1 if len(table) > 1 else []
        bounds = [0, *map(int, cuts), len(table)]
        yield [table.slice(a, b - a) for a, b in zip(bounds[:-2], bounds[1:-1])]
        held = table.slice(bounds[-2])
    if held is not None:
        yield [held]


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each leaf's way up through its block, the block's top, and the top of the leaf's version."""
    binary = bytes.fromhex
    for blocks in _blocks(batches):
        tops, versions, copied, sides, steps = [], [], [], ([], []), [0]
        for block in blocks:
            arena, levels = Arena(), _levels(block["n"][0].as_py())
            root = arena.grow([x.hex().encode() for x in block["digest"].to_pylist()], levels)
            top = binary(arena.digests[root].decode())
            for at, amended in enumerate(block["amended"].to_pylist()):
                descent = arena.descent(root, levels, at)
                for left, right in arena.path(descent):
                    sides[0].append(binary(left.decode()))
                    sides[1].append(binary(right.decode()))
                steps.append(len(sides[0]))
                tops.append(top)
                before = len(arena.digests)
                version = root if amended is None else arena.amend(descent, amended.hex().encode())
                versions.append(binary(arena.digests[version].decode()))
                copied.append(len(arena.digests) - before)
        if not tops:
            continue
        columns = pa.concat_tables(blocks).combine_chunks()
        names = [c for c in columns.column_names if c != "amended"]
        path = pa.StructArray.from_arrays(
            [pa.array(s, pa.binary()) for s in sides], ["left", "right"]
        )
        yield pa.RecordBatch.from_arrays(
            [
                *[columns[c].chunk(0) for c in names],
                pa.array(versions, pa.binary()),
                pa.array(copied, pa.int32()),
                pa.array(tops, pa.binary()),
                pa.ListArray.from_arrays(pa.array(steps, pa.int32()), path),
            ],
            [*names, "version", "copied", "top", "path"],
        )


def _placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add `pos` (0, 1, ... within the tree, in the order given) and `n`, the tree's leaves.

    Rows are sorted by ranges; runs of consecutive rows are numbered on their own
    and start from the counts of the runs before, so no task holds a tree.
    """
    by = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    ordered = written(
        rows.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("row", F.monotonically_increasing_id()),
        "ordered",
    )
    runs = ordered.withColumn("run", F.shiftright("row", _RUN_BITS))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        runs.groupBy("tree", "run")
        .agg(F.count("*").alias("k"))
        .select(
            "tree", "run", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("start"),
            F.sum("k").over(tree).alias("n"),
        )
    )
    inside = Window.partitionBy("tree", "run").orderBy("row")
    return (
        runs.withColumn("at", F.row_number().over(inside) - 1)
        .join(starts, ["tree", "run"])
        .select(*rows.columns, (F.col("start") + F.col("at")).alias("pos"), "n")
    )


def _grown(rows: DataFrame, label: str) -> DataFrame:
    """Rows (tree, pos, n, digest, amended, ...) through their blocks, written."""
    dealt = rows.repartition("tree", F.col("pos") - F.col("pos") % BLOCK)
    kept = ", ".join(f"{c} {kind}" for c, kind in rows.dtypes if c != "amended")
    return written(dealt.sortWithinPartitions("tree", "pos").mapInArrow(_grow, f"{kept}, {_MADE}"), label)


_BLOCK_OF = f"pos div {BLOCK}"


def _above(grown: DataFrame) -> DataFrame:
    """Rows (tree, block, top, path): the way from each block's top to the tree's root, and the root."""
    tops = grown.where(F.col("pos") % BLOCK == 0).select(
        "tree", F.expr(_BLOCK_OF).alias("block"), "n", "top", F.array().cast(f"array<{_STEP}>").alias("path")
    )
    inner = written(tops.where(F.col("n") > BLOCK), "tops")
    whole = tops.where(F.col("n") <= BLOCK).select("tree", "block", "top", "path")
    if inner.isEmpty():
        return whole
    upper = _grown(
        inner.select(
            "tree", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"),
            F.col("top").alias("digest"), F.lit(None).cast("binary").alias("amended"),
        ),
        "upper",
    )
    further = _above(upper).withColumnsRenamed({"path": "rest", "top": "root", "block": "over"})
    onward = upper.select("tree", "pos", "path", F.expr(_BLOCK_OF).alias("over")).join(further, ["tree", "over"])
    return whole.union(
        onward.select(
            "tree", F.col("pos").alias("block"), F.col("root").alias("top"),
            F.concat("path", "rest").alias("path"),
        )
    )


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _fold(digest: Column, path: str) -> Column:
    """The digest reached from `digest` along the path, as hex text."""
    return F.aggregate(
        path, digest,
        lambda at, step: F.sha2(F.concat(_hex(step["left"]), at, _hex(step["right"])).cast("binary"), 256),
    )


def leaf_digest(columns: Sequence[Column]) -> Column:
    """Hex digest of a row: `-` for null, else byte count, colon and value of each column."""
    texts = [c.cast("string") for c in columns]
    parts = [
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def manifest(
    docs: DataFrame,
    amended: Mapping[str, Column],
    when: Column,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    key: str = "doc_id",
    group: str = "source",
) -> DataFrame:
    """Leaf, proof and check of every row; rows with `when` are checked with amended columns.

    Each value of `group` is a tree over its rows by ascending `key`, and the trees'
    roots, by ascending group, are the leaves of a last tree. Returns key, leaf,
    subroot, root and proof_sha256 of the rows as they are; folded_root, reached from
    the amended (else the original) leaf along the original siblings; verified,
    whether that is the root; and n_copied, the nodes that the row's version does not
    share with the original tree (0 where the leaf did not change).

    A null group is a tree of its own and stands first, like null keys in a tree. Rows
    with equal keys are ordered by their leaf; repeated rows each are a leaf. A null
    `when` is false. Other columns are not read. An empty table gives an empty table.
    """
    changed = [amended.get(c, F.col(c)) for c in columns]
    group_text = F.col(group).cast("string")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), group_text), F.lit("")).alias("tree"),
        F.col(key).alias("key"),
        F.unhex(leaf_digest([F.col(c) for c in columns])).alias("digest"),
        F.when(when, F.unhex(leaf_digest(changed))).alias("other"),
    )
    same = F.col("other").eqNullSafe(F.col("digest"))
    leaves = leaves.withColumn("other", F.when(~same, F.col("other")))
    placed = _placed(written(leaves, "leaves"), ["key", "digest", "other"])
    grown = _grown(placed.withColumnRenamed("other", "amended"), "blocks")

    above = written(_above(grown), "above")
    subroots = above.where("block = 0").select("tree", F.col("top").alias("digest"))
    order = _placed(
        subroots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest"), ["group"]
    )
    order = written(order.withColumn("amended", F.lit(None).cast("binary")), "order")
    last = _grown(order, "groups")
    ends = last.select("tree", "pos", F.expr(_BLOCK_OF).alias("block"), F.col("path").alias("low")).join(
        _above(last).select("tree", "block", F.col("top").alias("root"), "path"), ["tree", "block"]
    )
    ends = order.select("pos", F.col("group").alias("tree")).join(
        ends.select("pos", "root", F.concat("low", "path").alias("rest")), "pos"
    )
    ways = above.join(ends.select("tree", "rest", "root"), "tree").select(
        "tree", "block", F.col("top").alias("subroot"), F.concat("path", "rest").alias("rest"), "root"
    )
    ways = written(ways, "ways")

    rows = grown.withColumn("block", F.expr(_BLOCK_OF)).join(ways, ["tree", "block"])
    steps = F.concat("path", "rest")
    sides = F.transform(steps, lambda s: F.concat(_hex(s["left"]), _hex(s["right"])))
    return rows.select(
        F.col("key").alias(key),
        _hex(F.col("digest")).alias("leaf"),
        _hex(F.col("subroot")).alias("subroot"),
        _hex(F.col("root")).alias("root"),
        F.sha2(F.concat_ws("", sides).cast("binary"), 256).alias("proof_sha256"),
        _fold(_hex(F.col("version")), "rest").alias("folded_root"),
        F.when(F.col("copied") > 0, F.col("copied") + F.size("rest")).otherwise(0).alias("n_copied"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
