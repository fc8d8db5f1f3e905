"""Merkle manifest, one-bit neighbours and ranked search against brute force."""

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.llm import impact, merkle, rabitq
from tests.llm import edge


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def up(nodes):
    """Root of a row of digests, and each one's siblings level by level as (left, right)."""
    paths, places, row = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(row) > 1:
        for i, p in enumerate(places):
            a = p - p % 3
            paths[i].append(("".join(row[a:p]), "".join(row[p + 1 : a + 3])))
            places[i] = p // 3
        row = [digest(*row[i : i + 3]) for i in range(0, len(row), 3)]
    return row[0], paths


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def brute_manifest(rows):
    def key(row):
        return (row["doc_id"] is not None, row["doc_id"] or 0, leaf(row, row["text"]))

    trees = {}
    for row in rows:
        trees.setdefault(row["source"], []).append(row)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: up([leaf(r, r["text"]) for r in sorted(trees[s], key=key)]) for s in order}
    root, ends = up([built[s][0] for s in order])
    out = []
    for s, end in zip(order, ends):
        for row, path in zip(sorted(trees[s], key=key), built[s][1]):
            text, way = row["text"], path + end
            tampered = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0
            at = leaf(row, text.replace("\n", "") if tampered and text is not None else text)
            changed = at != leaf(row, text)
            for left, right in way:
                at = digest(left, at, right)
            proof = digest(*[a + b for a, b in way])
            out.append((row["doc_id"], leaf(row, text), built[s][0], root, proof, at, at == root, len(way) + 1 if changed else 0))
    return sorted(out, key=repr)


def ours(docs):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    found = merkle.manifest(docs, {"text": F.replace("text", F.lit("\n"), F.lit(""))}, tampered)
    names = "doc_id leaf subroot root proof_sha256 folded_root verified n_copied".split()
    return sorted([tuple(r[n] for n in names) for r in found.collect()], key=repr)


def test_manifest_equals_brute_force_on_edge_rows(spark):
    docs = edge.frame(spark).repartition(3)
    assert ours(docs) == brute_manifest([r.asDict() for r in docs.collect()])
    assert ours(edge.frame(spark, empty=True)) == []


def test_manifest_over_several_blocks(spark):
    n = 2 * merkle.BLOCK + 5
    rows = [(i, f"text\n{i}", "en", "hot", i) for i in range(n)]
    rows += [(n + i, None if i % 2 else f"\n{i}", None, f"s{i:02d}", 1) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = ours(docs.repartition(5))
    assert got == brute_manifest([r.asDict() for r in docs.collect()])
    assert {r[6] for r in got} == {True, False}


def test_versions_share_all_but_the_ancestors():
    arena = merkle.Arena()
    root = arena.grow([digest(str(i)).encode() for i in range(50)], 4)
    before = len(arena.digests)
    way = arena.descent(root, 4, 31)
    version = arena.amend(way, digest("new").encode())
    assert len(arena.digests) - before == 5
    old, new = set(), set()
    for seen, top in ((old, root), (new, version)):
        todo = [top]
        while todo:
            node = todo.pop()
            seen.add(node)
            todo += arena.children[node]
    assert len(new - old) == 5 and arena.digests[root] != arena.digests[version]
    assert arena.path(arena.descent(version, 4, 31)) == arena.path(way)


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute_rank(docs, items, k=10):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c in counts:
            score, n = 0, c.total()
            for t, q in Counter(terms(text)).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += q * w * ((10**9 * c[t]) // (1000 * c[t] + 8 * (25 + 75 * n * n_docs // n_terms)))
            if score > 0:
                found.append((-score, d is None, d or 0))
        out += [(item, i + 1, None if no else d, -s) for i, (s, no, d) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def ranked(spark, docs, items):
    found = impact.rank(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    return sorted([tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect()], key=repr)


def test_ranked_search_equals_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(20000)]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([1, 5, 60, 300])))) for i in range(700)]
    docs += [(1000 + i, docs[3][1]) for i in range(300)]  # many copies, equal scores
    docs += [(2000, " ".join(words)), (None, docs[5][1])] + [(r[0], r[1]) for r in edge.rows()]
    items = [(i, " ".join(rng.choices(words, k=20))) for i in range(12)]
    items += [(50, docs[3][1]), (51, "w1 w1 w1"), (52, "absent"), (53, ""), (54, None), (None, "w2 W3"), (0, items[0][1])]
    assert ranked(spark, docs, items) == brute_rank(docs, items)


def test_ranked_search_of_empty_tables(spark):
    assert ranked(spark, [], [(1, "a b")]) == [] == ranked(spark, [(1, "a b")], [])
    assert ranked(spark, [(1, None), (2, "..")], [(1, "a b")]) == []


def test_buckets_and_coordinates_prune():
    """A floor above what a bucket's rare terms can reach leaves no candidates."""
    terms_, offsets = np.array([0, 1, 0, 2]), np.array([0, 2, 4])
    values = np.array([5, 1, 2, 9])
    norm = np.array([math.sqrt(26), math.sqrt(85)])
    bucket = impact.Bucket(np.array([7, 8]), terms_, offsets, values, norm, 3)
    asked, counts = np.array([0, 1]), np.array([1, 1])
    assert list(bucket.survivors(asked, counts, 0)) == [0, 1]
    assert list(bucket.survivors(asked, counts, 6)) == [0]
    assert list(bucket.survivors(asked, counts, 7)) == []
    assert list(bucket.scores(np.array([0, 1]), np.array([1, 1, 0]))) == [6, 2]


def brute_nearest(rows, k=10):
    usable = {
        (i, tuple(map(float, v)))
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    out = []
    for q, v in usable:
        if q % 100:
            continue
        found = sorted(
            (math.sqrt(sum((a - b) ** 2 for a, b in zip(v, w))), c)
            for c, w in usable if c != q and len(w) == len(v)
        )
        out += [(q, i + 1, c, s) for i, (s, c) in enumerate(found[:k])]
    return sorted(out)


def searched(spark, rows, kind="float"):
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(4)
    found = rabitq.nearest(table, F.col("vec_id") % 100 == 0)
    return sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect())


def recall(got, wanted):
    pairs = {(q, c) for q, _, c, _ in wanted}
    return len(pairs & {(q, c) for q, _, c, _ in got}) / len(pairs)


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(2)
    middles = rng.normal(size=(8, 24)) * 2
    rows = [(i, [float(np.float32(x)) for x in middles[i % 8] + rng.normal(size=24)]) for i in range(3000)]
    got, wanted = searched(spark, rows), brute_nearest(rows)
    assert recall(got, wanted) >= 0.99
    assert all(a[3] == pytest.approx(b[3], rel=1e-12) for a, b in zip(got, wanted) if a[:3] == b[:3])


def test_neighbours_on_edge_rows(spark):
    rows = edge.vector_rows()
    got, wanted = searched(spark, rows, "double"), brute_nearest(rows)
    assert [g[:3] for g in got] == [w[:3] for w in wanted]
    assert searched(spark, [], "float") == [] == searched(spark, [(100, None), (200, [0.0])])


def test_bound_of_the_estimate_holds():
    """Nearly no estimate is further off than its bound."""
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(4000, 48))
    index = rabitq.fit_index(rows, 4000)
    bits = index.rotation.shape[1]
    assert np.allclose(index.rotation @ index.rotation.T, np.eye(48))
    unit = rows / np.linalg.norm(rows, axis=1)[:, None]
    turned = unit @ index.rotation
    signs, fit = np.where(turned >= 0, 1, -1), np.abs(turned).sum(1) / math.sqrt(bits)
    guess = (signs @ turned[0]) / math.sqrt(bits) / fit
    bound = rabitq.ERRORS * np.sqrt(1 - fit**2) / fit / math.sqrt(bits - 1)
    assert np.mean(np.abs(guess - unit @ unit[0]) > bound) < 0.01
