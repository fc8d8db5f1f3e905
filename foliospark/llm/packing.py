"""Tokenised documents packed into as few fixed-length sequences as can be.

Only the number of pieces of each length matters for the packing, and lengths are
bounded by the sequence, so the instance has at most `capacity` rows however large
the corpus is. Small sets that provably dominate every alternative for their largest
member (Martello and Toth) are fixed first, all equal ones at once; the rest goes to
the best fit, longest first. Spark then deals the plan's places to the pieces.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right
from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from foliospark.llm.numbering import numbered
from foliospark.llm.tables import few_files
from foliospark.llm.texts import plain, small_batches
from foliospark.plans.scratch import written

CAPACITY = 2048
END = 0  # the id that closes every document

#: (number of sequences, [(length, pieces of it in each), ...])
Pattern = tuple[int, list[tuple[int, int]]]


def _largest_pair(lengths: list[int], counts: dict[int, int], room: int) -> int:
    """The largest sum of two pieces that fit into `room`."""
    best, lo, hi = 0, 0, bisect_right(lengths, room) - 1
    while lo <= hi:
        total = lengths[lo] + lengths[hi]
        if total > room or (lo == hi and counts[lengths[lo]] < 2):
            hi -= 1
        else:
            best, lo = max(best, total), lo + 1
    return best


def dominant(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Fix sets that dominate all others with the same longest piece; takes them out of `counts`.

    A piece alone dominates when nothing else fits beside it. With the longest piece
    that fits, it dominates when the two fill the sequence, when no third piece can
    fit, or when no fourth can and no two pieces together outweigh that one.
    """
    fixed: list[Pattern] = []
    changed = True
    while changed:
        changed = False
        for length in sorted(counts, reverse=True):
            while counts.get(length):
                rest = dict(counts)
                rest[length] -= 1
                lengths = sorted(x for x, n in rest.items() if n)
                room = capacity - length
                fit = bisect_right(lengths, room)
                if not fit:
                    fixed.append((counts[length], [(length, 1)]))
                    del counts[length]
                    changed = True
                    break
                small = [x for x in lengths[:3] for _ in range(min(3, rest[x]))][:3]
                beside = lengths[fit - 1]
                sure = beside == room or len(small) < 2 or small[0] + small[1] > room
                if not sure and (len(small) < 3 or sum(small) > room):
                    sure = beside >= _largest_pair(lengths, rest, room)
                if not sure:
                    break
                if beside == length:
                    times = counts[length] // 2
                    fixed.append((times, [(length, 2)]))
                    counts[length] -= 2 * times
                else:
                    times = min(counts[length], counts[beside])
                    fixed.append((times, [(length, 1), (beside, 1)]))
                    counts[length] -= times
                    counts[beside] -= times
                changed = True
    return fixed


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best fit, longest first, for all pieces of a length at once.

    The fullest sequence with room takes as many as fit before the next one is
    touched, because it stays the fullest.
    """
    open_at: list[list[Pattern]] = [[] for _ in range(capacity + 1)]
    for length in sorted((x for x, n in counts.items() if n), reverse=True):
        left, room = counts[length], length
        while left:
            while room <= capacity and not open_at[room]:
                room += 1
            if room > capacity:
                times, items, free = left, [], capacity  # as many new ones as it takes
            else:
                times, items = open_at[room].pop()
                free = room
            each = free // length
            full, more = divmod(min(left, times * each), each)
            if full:
                open_at[free - each * length].append((full, [*items, (length, each)]))
            if more:
                open_at[free - more * length].append((1, [*items, (length, more)]))
            untouched = times - full - bool(more)
            if items and untouched:
                open_at[free].append((untouched, items))
            left -= full * each + more
    return [p for row in open_at for p in row]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    rest = {x: n for x, n in counts.items() if n}
    return dominant(rest, capacity) + best_fit(rest, capacity)


_encoders: dict[str, Callable[[str], np.ndarray]] = {}


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable bytes stand for themselves, the others for characters from 256 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """A function from a text to the ids that the tokenizer file gives it; kept by the worker.

    A byte-level BPE whose merges are ranked by id can be read as ranks, which
    tiktoken merges several times faster to the same ids. Texts that name a special
    token, and files of another kind, go through tokenizers.
    """
    if path not in _encoders:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = [t["content"] for t in spec["added_tokens"]]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        vocab = spec["model"]["vocab"]
        before = spec["pre_tokenizer"]
        ranked = (
            spec["normalizer"] is None
            and before["type"] == "ByteLevel"
            and before["use_regex"]
            and not before["add_prefix_space"]
            and all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(merges))
        )

        whole: list[Tokenizer] = []  # only loaded if a text needs it

        def slow(text: str) -> np.ndarray:
            if not whole:
                whole.append(Tokenizer.from_file(path))
            return np.array(whole[0].encode(text, add_special_tokens=False).ids, np.uint32)

        def fast(text: str) -> np.ndarray:
            if any(s in text for s in special):
                return slow(text)
            return ranks.encode_to_numpy(text, disallowed_special=())

        if ranked:
            byte = byte_characters()
            known = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in special}
            ranks = tiktoken.Encoding(
                path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={}
            )
        _encoders[path] = fast if ranked else slow
    return _encoders[path]


def tokenized(path: str, capacity: int) -> Column:
    """Pieces of a text: number, first id, length and checksum of the ids."""

    @F.arrow_udf("array<struct<piece: int, start: long, length: long, ids_crc32: long>>")
    def cut(texts: pa.Array) -> pa.Array:
        encode, out = encoder(path), []
        for text in plain(texts):
            ids = np.append(encode(text.as_py()), END).astype("<u4")
            first = len(ids) % capacity or capacity
            begins = [0, *range(first, len(ids), capacity)]
            out.append(
                [
                    {"piece": i, "start": a, "length": b - a, "ids_crc32": zlib.crc32(ids[a:b].tobytes())}
                    for i, (a, b) in enumerate(zip(begins, [*begins[1:], len(ids)], strict=True))
                ]
            )
        kind = pa.struct(
            [("piece", pa.int32()), *((n, pa.int64()) for n in ("start", "length", "ids_crc32"))]
        )
        return pa.array(out, pa.list_(kind))

    return cut


def places(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int, int]]:
    """For each length, ranges of piece numbers and where they go.

    Rows (length, first, end, sequence, each, offset): piece number p of the length in
    [first, end) goes to sequence + (p - first) // each, at offset + (p - first) % each
    times the length.
    """
    used: dict[int, int] = {}
    out, sequence = [], 0
    for times, items in patterns:
        offset = 0
        for length, each in items:
            first = used.get(length, 0)
            used[length] = first + times * each
            out.append((length, first, first + times * each, sequence, each, offset))
            offset += length * each
        sequence += times
    return out


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """One row for each piece of each row of `docs`, with its sequence and place there.

    A document is its ids and an id 0; null and empty texts are that id alone. Only
    longer ones than `capacity` are cut, and only their first piece is shorter.
    Returns key, piece, start, length, ids_crc32, sequence_id, offset. Repeated rows
    are packed each. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    small_batches(spark)
    cut = docs.select(F.col(key).alias("doc"), F.explode(tokenized(tokenizer, capacity)(F.col(text))).alias("p"))
    pieces = written(cut.select(F.monotonically_increasing_id().alias("row"), "doc", "p.*"), "pieces")
    sizes = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()  # capacity rows at most
    planned = places(plan({r.length: r.n for r in sizes}, capacity))
    names = ["length", "first", "end", "sequence", "each", "place"]
    columns = np.array(planned, np.int64).reshape(-1, len(names)).T
    dealt = spark.createDataFrame(pa.Table.from_arrays(list(map(pa.array, columns)), names))
    ranked = numbered(pieces, "length", "row", "rank")
    step = F.col("rank") - F.col("first")
    return few_files(ranked.join(dealt, "length")).where((step >= 0) & (F.col("rank") < F.col("end"))).select(
        F.col("doc").alias(key), "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.floor(step / F.col("each"))).alias("sequence_id"),
        (F.col("place") + step % F.col("each") * F.col("length")).alias("offset"),
    )
