"""Decontamination against brute force, and the pipeline stage by stage."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from foliospark.llm import decontam, texts
from foliospark.llm.jaccard import link_similar
from tests.llm import edge
from tests.llm.test_texts import check_packing


def hashes(strings):
    found = texts.words(texts.plain(pa.array(strings)), texts.ALNUM)
    return [found.hashes[a:b] for a, b in zip(found.first[:-1], found.first[1:])]


def brute(docs, items):
    """Pairs with a good stretch on any diagonal."""
    out = set()
    for (d, dt), dh in zip(docs, hashes([t or "" for _, t in docs])):
        for (i, _), ih in zip(items, hashes([t or "" for _, t in items])):
            if len(ih) >= decontam.MIN_WORDS and len(dh):
                diagonals = list(range(-len(ih) + 1, len(dh)))
                if decontam.best_overlap(dh, ih, diagonals, 13, 80):
                    out.add((d, i))
    return out


@pytest.fixture(scope="module")
def items():
    return [(i, edge.prose(900 + i, n)) for i, n in enumerate([14, 20, 36, 59, 5, 8, 3])] + [(None, None), (9, "")]


def planted(items):
    rng = random.Random(3)
    docs = []
    for n, (item, text) in enumerate(items[:6] * 4):
        passage = text.split()
        for at in range(rng.randint(0, 5), len(passage), 9):  # one word in nine replaced at most
            passage[at] = "other"
        docs.append((n, f"{edge.prose(n, 30)} {' '.join(passage).upper()}, {edge.prose(n + 50, 30)}"))
    docs.append((500, edge.prose(77, 10) + " " + " ".join(items[3][1].split()[20:40])))  # a part of an item
    return docs + [(600 + i, edge.prose(300 + i, 200)) for i in range(10)]


def test_leaks_equal_brute_force(spark, items):
    docs = planted(items) + [(r[0], r[1]) for r in edge.rows()]
    got = decontam.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(docs, items)
    assert {r.doc_id for r in got} >= {n for n in range(24) if n % 6 < 4} | {500}
    assert all(r.n_agree <= r.n_span for r in got)


def test_masks_reach_all_that_verification_accepts():
    for n in range(decontam.SHORTEST, 15):
        size = min(n, 13)
        for lost in itertools.chain.from_iterable(itertools.combinations(range(n), k) for k in range(4)):
            same = np.array([i not in lost for i in range(n)])
            sums = np.concatenate([[0], np.cumsum(same)])
            if (100 * (sums[size:] - sums[:-size]) < 80 * size).all():
                continue
            assert any(
                all(same[at + j] for j, used in enumerate(mask) if used == "1")
                for mask in decontam.masks_of(n)
                for at in range(n - len(mask) + 1)
            ), (n, lost)


def test_short_items_are_found(spark):
    items = [(n, edge.prose(700 + n, n)) for n in range(1, 13)]
    docs = []
    for n, text in items:
        for lost in itertools.combinations(range(n), n // 5 if n >= decontam.SHORTEST else 0):
            passage = ["other" if i in lost else w for i, w in enumerate(text.split())]
            docs.append((len(docs), f"{edge.prose(n, 30)} {' '.join(passage)} zzz {text if not lost else ''}"))
    got = decontam.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(docs, items)
    assert {r.doc_id for r in got} == {d for d, _ in docs} and {r.item_id for r in got} == set(range(1, 13))
    assert all(r.at_word <= 30 for r in got if r.item_id == r.doc_id + 1)


def test_leaks_of_empty_tables(spark, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontam.find_leaks(edge.frame(spark, empty=True), bench).count() == 0
    assert decontam.find_leaks(edge.frame(spark), bench.limit(0)).count() == 0


def test_stages_on_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder).cache()
        assert kept.columns == columns and 0.6 * n < kept.count() <= docs.count(), name
        if name == "n-gram Jaccard join":
            linked = link_similar(docs.select("doc_id", "text"))
            first = {r.component_id for r in linked.select("component_id").distinct().collect()}
            assert {r.doc_id for r in kept.collect()} == first
        if name == "benchmark decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
            leaked = {d for d, _ in brute([(r.doc_id, r.text) for r in docs.collect()], items)}
            assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()} == leaked
        docs = kept
    pieces = pipeline.STAGES[-1][1](spark, docs, folder).collect()
    check_packing(pieces, [(r.doc_id, r.text) for r in docs.collect()])


def test_near_duplicates_link_from_four_fifths(spark):
    base = edge.prose(40, 400)
    rows = [(0, base), (1, f"{base} {edge.prose(41, 82)}"), (2, f"{base} {edge.prose(42, 120)}")]
    grams = [set(zip(*(t.split()[i:] for i in range(5)))) for _, t in rows]
    near, far = (len(grams[0] & g) / len(grams[0] | g) for g in grams[1:])
    assert 0.8 < near < 0.85 and far < 0.8
    kept = pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert {r.doc_id for r in kept.collect()} == {0, 2}


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_edge_rows(spark, folder, empty):
    docs = edge.frame(spark, empty)
    for _, stage in pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns
        docs = kept.cache()
        docs.count()
    texts_left = [r.text for r in docs.collect()]
    assert len(texts_left) == len(set(texts_left))  # copies are gone
    assert (len(texts_left) == 0) == empty
    out = pipeline.STAGES[-1][1](spark, docs, folder)
    assert (out.count() == 0) == empty


#: Names that stages and operators use for columns of their own, taken by the input.
TAKEN = [
    "score", "gain", "lang_pred", "languages", "shares", "kept_text", "n_lines", "n_dropped", "own", "read", "doc",
    "key", "more", "text_key", "rows", "f", "_text", "_found", "_t", "_t1", "_t2", "_dropped", "_lines", "_doc",
    "_key", "_more", "_text_key", "class_key", "component_id", "a.b", "item",
]


def test_stages_keep_the_values_of_all_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(60)
    docs = docs.select("*", *[F.concat(F.lit(f"{c} "), "doc_id").alias(c) for c in TAKEN])
    for name, stage in pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns
        rows = kept.collect()
        assert rows, name
        for row in rows:
            assert [row[c] for c in TAKEN] == [f"{c} {row['doc_id']}" for c in TAKEN], name


def test_language_stage_keeps_mixtures_of_known_languages(spark):
    known = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    words_of = {
        k: " ".join(r.text for r in known.where(f"lang = '{k}'").orderBy("doc_id").limit(20).collect()).split()
        for k in ("en", "de", "fr", "es")
    }
    more = [
        (10**9, " ".join(w for ws in words_of.values() for w in ws[:150])),
        (10**9 + 1, " ".join(w for k in ("en", "de", "fr") for w in words_of[k][:150])),
        (10**9 + 2, "Он сказал, что сегодня вечером придёт домой поздно и просил не ждать его к ужину " * 5),
        (10**9 + 3, "今天晚上他说会很晚回家让我们不要等他吃晚饭因为他还有很多工作要做 " * 5),
    ]
    rows = known.select("doc_id", "text", "lang").unionByName(
        spark.createDataFrame([(*r, None) for r in more], "doc_id long, text string, lang string")
    )
    kept = {r.doc_id for r in pipeline.language_id(spark, rows, "").select("doc_id").collect()}
    assert {d for d in kept if d >= 10**9} == {10**9, 10**9 + 1}
    assert len([d for d in kept if d < 10**9]) == known.where("text rlike '[A-Za-z]'").count()


def test_pipeline_learns_without_held_out_rows(spark):
    rows = spark.createDataFrame([(i,) for i in range(50)], "doc_id long")
    got = {r.doc_id for r in rows.where(pipeline._learnable()).collect()}
    assert got == {i for i in range(50) if zlib.crc32(str(i).encode()) % 4 != 2}
    assert np.all([isinstance(name, str) for name, _ in pipeline.STAGES])
