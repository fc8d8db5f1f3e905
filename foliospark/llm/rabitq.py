"""Nearest vectors by randomly rotated one-bit codes.

Vectors are assigned to the nearest of some centroids. The direction from the centroid
to a vector, turned by a random rotation, is kept as the signs of its coordinates, with
two correction scalars: the distance to the centroid, and the inner product of the
direction with its own code. A query estimates its inner product with every code of a
cell that it cannot rule out by the triangle inequality; the error bound of the
estimate decides which vectors are measured exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.tables import narrow
from foliospark.plans.scratch import written

#: The centroids are fitted on at most SAMPLE vectors a centroid, for at most CENTROIDS of them.
SAMPLE = 64
CENTROIDS = 512
#: Bits of a code for each dimension, rounded up to whole 64s; the rotation pads with zeros.
BITS = 2
#: The estimate is off by more than this many of its standard errors about once in a thousand times.
ERRORS = 3.0
#: Vectors and queries that are matched at once.
VECTORS, QUERIES = 1024, 128
#: A task bundles about this many times VECTORS vectors of a cell.
SPLIT = 16
SEED = 11

_KEY = ["h1", "h2"]


class Index(NamedTuple):
    """What every task needs: centroids and the rotation."""

    centroids: np.ndarray
    rotation: np.ndarray  # dimensions by bits, with orthonormal rows
    splits: np.ndarray  # tasks among which the vectors of a cell are dealt

    def salt(self, cell: np.ndarray, ids: np.ndarray) -> np.ndarray:
        spread = (ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        return (spread % self.splits[cell].astype(np.uint64)).astype(np.int32)


def fit_index(sample: np.ndarray, n_rows: int, seed: int = SEED) -> Index:
    """Centroids by Lloyd's method and a random rotation. A few hundred rows are enough."""
    rng = np.random.default_rng(seed)
    dims = sample.shape[1]
    k = max(1, min(CENTROIDS, len(sample), round(math.sqrt(n_rows) / 2)))
    centroids = sample[rng.choice(len(sample), k, replace=False)].copy()
    for _ in range(10):
        nearest = _nearest(sample, centroids)
        sizes = np.bincount(nearest, minlength=k)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
    bits = -(-BITS * dims // 64) * 64
    turned, _ = np.linalg.qr(rng.standard_normal((bits, dims)))
    share = np.bincount(_nearest(sample, centroids), minlength=k) / len(sample)
    splits = np.ceil(share * n_rows / (SPLIT * VECTORS)).clip(1).astype(np.int64)
    return Index(centroids, np.ascontiguousarray(turned.T), splits)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all rows of y, up to rounding."""
    found = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * x @ y.T
    return np.maximum(found, 0.0)


def _nearest(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    step = 4096
    return np.concatenate(
        [_squares(rows[i : i + step], centroids).argmin(1) for i in range(0, len(rows), step)]
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column of one length as a matrix of doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _encode(index: Index):
    """A function from vectors to cell, radius, correction and packed signs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = index.rotation.shape[1]
        for batch in batches:
            if not len(batch):
                continue
            rows = _matrix(batch.column("vector"))
            cell = _nearest(rows, index.centroids)
            away = rows - index.centroids[cell]
            radius = np.sqrt((away * away).sum(1))
            turned = (away / np.where(radius > 0, radius, 1.0)[:, None]) @ index.rotation
            fit = np.abs(turned).sum(1) / math.sqrt(bits)  # inner product of direction and code
            codes = np.packbits(turned >= 0, axis=1)
            kept = [c for c in batch.schema.names if c != "vector"]
            ids = batch.column(kept[0]).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in kept],
                    pa.array(cell.astype(np.int32)),
                    pa.array(index.salt(cell, ids)),
                    pa.array(radius),
                    pa.array(np.where(radius > 0, fit, 1.0)),
                    pa.array([c.tobytes() for c in codes], pa.binary()),
                    pa.array([r.tobytes() for r in rows], pa.binary()),
                ],
                [*kept, "cell", "salt", "radius", "fit", "code", "vector"],
            )

    return run


def _pack(size: int, columns: list[str]):
    """A function from sorted rows to rows that hold up to `size` rows of one cell as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        made = TaskContext.get().partitionId() << 32

        def packed(parts: list[pa.Table]) -> pa.RecordBatch:
            nonlocal made
            out: dict[str, list] = {c: [] for c in ["cell", "part", "size", "reach", *columns]}
            for part in parts:
                out["cell"].append(part["cell"][0].as_py())
                out["part"].append(made)
                out["size"].append(len(part))
                out["reach"].append(float(part["radius"].to_numpy().max()) if "radius" in part.column_names else 0.0)
                made += 1
                for c in columns:
                    values = part[c]
                    whole = b"".join(values.to_pylist()) if pa.types.is_binary(values.type) else values.to_numpy().tobytes()
                    out[c].append(whole)
            kinds = {"cell": pa.int32(), "part": pa.int64(), "size": pa.int32(), "reach": pa.float64()}
            return pa.RecordBatch.from_arrays(
                [pa.array(v, kinds.get(c, pa.binary())) for c, v in out.items()], list(out)
            )

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
            cells = table["cell"].to_numpy()
            cuts = np.flatnonzero(cells[1:] != cells[:-1]) + 1
            bounds = [
                x
                for a, b in zip([0, *cuts], [*cuts, len(table)])
                for x in range(int(a), int(b), size)
            ]
            parts = [table.slice(a, b - a) for a, b in zip(bounds[:-1], bounds[1:])]
            if parts:
                yield packed(parts)
            held = table.slice(bounds[-1]) if bounds else None
        if held is not None and len(held):
            yield packed([held])

    return run


def _distances(rows: np.ndarray, queries: np.ndarray, at: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Distances of rows[at] to queries[of], the squares added up in the order of the coordinates."""
    out = np.zeros(len(at))
    for row, query in zip(np.ascontiguousarray(rows.T), np.ascontiguousarray(queries.T)):
        step = row[at] - query[of]
        out += step * step
    return np.sqrt(out)


def _scan(index: Index, k: int):
    """A function from (queries, vectors) of a cell to the exact distances that can matter."""

    def matched(row: dict) -> pa.RecordBatch:
        dims, bits = index.rotation.shape
        centroid = index.centroids[row["cell"]]
        n = row["size"]
        ids = np.frombuffer(row["vec_id"], np.int64)
        vectors = np.frombuffer(row["vector"], np.float64).reshape(n, dims)
        radius, fit = np.frombuffer(row["radius"]), np.frombuffer(row["fit"])
        codes = np.frombuffer(row["code"], np.uint8).reshape(n, -1)
        signs = np.unpackbits(codes, axis=1)[:, :bits].astype(np.float32) * 2 - 1
        queries = np.frombuffer(row["q_vector"], np.float64).reshape(-1, dims)
        limits = np.frombuffer(row["q_limit"])
        keys = np.frombuffer(row["h1"], np.int64), np.frombuffer(row["h2"], np.int64)

        away = queries - centroid
        far = np.sqrt((away * away).sum(1))
        turned = (away / np.where(far > 0, far, 1.0)[:, None]) @ index.rotation
        along = (signs @ turned.T.astype(np.float32)).astype(np.float64) / math.sqrt(bits)
        along /= fit[:, None]
        wrong = ERRORS * np.sqrt(np.maximum(1 - fit * fit, 0.0)) / fit / math.sqrt(max(bits - 1, 1)) + 1e-5
        middle = radius[:, None] ** 2 + far[None, :] ** 2 - 2 * radius[:, None] * far[None, :] * along
        room = 2 * radius[:, None] * far[None, :] * wrong[:, None]
        least = np.sqrt(np.maximum(middle - room, 0.0))
        if n >= k:  # k vectors are no further than this
            most = np.sqrt(np.maximum(np.partition(middle + room, k - 1, axis=0)[k - 1], 0.0))
            limits = np.minimum(limits, most)
        limits = limits * (1 + 1e-9)
        of, at = np.nonzero((least <= limits).T)
        exact = _distances(vectors, queries, at, of)
        order = np.lexsort((ids[at], exact, of))
        order = order[exact[order] <= limits[of[order]]]
        of, at, exact = of[order], at[order], exact[order]
        best = np.arange(len(of)) - np.searchsorted(of, of) < k
        of, at, exact = of[best], at[best], exact[best]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys[0][of]), pa.array(keys[1][of]), pa.array(ids[at]), pa.array(exact)],
            [*_KEY, "vec_id", "score"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                yield matched({c: batch.column(c)[row].as_py() for c in batch.schema.names})

    return run


def _visits(index: Index, cells: np.ndarray, reaches: np.ndarray):
    """A function from queries with limits to the further cells that may hold a vector within them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            dims = index.centroids.shape[1]
            rows = np.frombuffer(b"".join(batch.column("q_vector").to_pylist()), np.float64).reshape(-1, dims)
            far = np.sqrt(_squares(rows, index.centroids[cells]))
            limit = batch.column("q_limit").to_numpy()
            own = batch.column("cell").to_numpy()
            near = far - reaches <= limit[:, None] * (1 + 1e-6) + 1e-6
            query, cell = np.nonzero(near & (cells != own[:, None]))
            taken = batch.take(pa.array(query))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cells[cell].astype(np.int32)),
                    pa.array(index.salt(cells[cell], taken.column("h1").to_numpy())),
                    *[taken.column(c) for c in ("h1", "h2", "q_vector", "q_limit")],
                ],
                ["cell", "salt", *_KEY, "q_vector", "q_limit"],
            )

    return run


def _packed(rows: DataFrame, size: int, columns: list[str]) -> DataFrame:
    """Rows of a cell in bundles, those of a large cell made by several tasks."""
    kinds = ", ".join(f"{c} binary" for c in columns)
    dealt = rows.repartition("cell", "salt").sortWithinPartitions("cell")
    return dealt.mapInArrow(_pack(size, columns), f"cell int, part long, size int, reach double, {kinds}")


def _best_of(found: DataFrame, k: int, by: list[str]) -> DataFrame:
    order = Window.partitionBy(*by).orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _usable(vector: str) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def _search(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """Rows (h1, h2, vec_id, score): the k + 1 nearest of each distinct query vector, itself included."""
    # of equal vectors only those with the k + 1 smallest ids can be among the nearest of any query
    equal = Window.partitionBy(*_KEY).orderBy("vec_id")
    candidates = vectors.withColumn("copy", F.dense_rank().over(equal)).where(F.col("copy") <= k + 1)
    candidates = written(candidates.dropDuplicates([*_KEY, "vec_id"]).drop("copy"), "candidates")

    n = candidates.count()
    wanted = SAMPLE * max(1, min(CENTROIDS, round(math.sqrt(n) / 2)))
    share = min(1.0, 1.2 * wanted / max(n, 1))
    drawn = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) <= F.lit(int(share * (1 << 20)))
    sample = candidates.where(drawn).select("vector").limit(2 * SAMPLE * CENTROIDS).toArrow()
    index = fit_index(_matrix(sample["vector"].combine_chunks()), n)

    encoded = "{} long, cell int, salt int, radius double, fit double, code binary, vector binary"
    vector_rows = candidates.select("vec_id", "vector").mapInArrow(_encode(index), encoded.format("vec_id"))
    parts = ["vec_id", "radius", "fit", "code", "vector"]
    blocks = written(_packed(vector_rows, VECTORS, parts), "blocks")
    reaches = blocks.groupBy("cell").agg(F.max("reach").alias("reach")).toArrow()

    queries = vectors.where(is_query).select(*_KEY, "vector").dropDuplicates(_KEY)
    queries = queries.mapInArrow(_encode(index), encoded.format("h1 long, h2"))
    queries = queries.select(*_KEY, "cell", "salt", F.col("vector").alias("q_vector"))
    queries = written(queries, "queries")

    def scanned(visits: DataFrame) -> DataFrame:
        bundles = _packed(visits, QUERIES, [*_KEY, "q_vector", "q_limit"])
        pairs = bundles.drop("part", "size", "reach").join(blocks, "cell")
        found = pairs.mapInArrow(_scan(index, k + 1), "h1 long, h2 long, vec_id long, score double")
        return written(_best_of(found, k + 1, _KEY), "found")

    near = scanned(queries.withColumn("q_limit", F.lit(float("inf"))))
    limits = near.where(F.col("rank") == k + 1).select(*_KEY, F.col("score").alias("q_limit"))
    bounded = queries.join(limits, _KEY, "left").withColumn(
        "q_limit", F.coalesce("q_limit", F.lit(float("inf")))
    )
    further = bounded.mapInArrow(
        _visits(index, reaches["cell"].to_numpy(), reaches["reach"].to_numpy()),
        "cell int, salt int, h1 long, h2 long, q_vector binary, q_limit double",
    )
    return _best_of(near.union(scanned(further)).drop("rank"), k + 1, _KEY).drop("rank")


def nearest(
    table: DataFrame,
    is_query: Column,
    k: int = 10,
    vector: str = "embedding",
    key: str = "vec_id",
) -> DataFrame:
    """The k rows nearest to each row of `table` where `is_query` holds, by Euclidean distance.

    Returns query_id, rank (from 1), vec_id and score, the distance in double precision
    on the vectors as given; ties go to the smaller id. Every row but those with the
    query's own id is a candidate. Rows without an id, and vectors that are null, empty
    or zero or hold a null or an infinite or undefined number, take no part. Repeated
    rows count once. Vectors of one length are searched among themselves; there should
    be few lengths. `is_query` may only use the columns of `table`. Other columns are
    not read. An empty table gives an empty table.

    A vector can only be missed when an estimate is off by more than ERRORS times its
    standard error.
    """
    spark = table.sparkSession
    values = F.col(vector)
    rows = table.where(F.col(key).isNotNull() & values.isNotNull()).select(
        F.col(key).cast("long").alias("vec_id"), values.alias("vector"), is_query.alias("asked"),
        F.xxhash64(values).alias("h1"), F.xxhash64(F.lit(1), values).alias("h2"),
    )
    rows = written(rows.where(_usable("vector")), "vectors")
    asked = narrow(rows.where("asked").select(F.col("vec_id").alias("query_id"), *_KEY).distinct(), "asked")
    out: DataFrame = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for (dims,) in rows.select(F.size("vector")).distinct().collect():
        found = _search(rows.where(F.size("vector") == dims), F.col("asked"), k)
        others = asked.join(found, _KEY).where("vec_id <> query_id")
        best = _best_of(others, k, ["query_id", *_KEY])
        out = out.union(best.select("query_id", "rank", "vec_id", "score"))
    return out
