"""Sketched vocabularies, lookups in the row, dictionaries and large tops against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foliospark.functions import text
from foliospark.operators import dictionary, features, model, runs, vocabulary
from foliospark.operators.vocabulary import TermTable
from foliospark.plans.scratch import written


@pytest.fixture(scope="module")
def grams(spark):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        words = [f"w{int(rng.paretovariate(0.5)) % 5000}" for _ in range(rng.choice([0, 3, 40, 200]))]
        rows.append((i, words))
    rows.append((None, None))
    return written(spark.createDataFrame(rows, "id int, grams array<string>").repartition(4), "grams")


def brute_vocabulary(grams, min_df, max_features):
    docs = [r["grams"] or [] for r in grams.collect()]
    df, total = Counter(g for d in docs for g in set(d)), Counter(g for d in docs for g in d)
    kept = [(g, total[g], n) for g, n in df.items() if min_df <= n <= 0.95 * len(docs)]
    return sorted(kept, key=lambda t: (-t[1], t[0]))[:max_features]


@pytest.mark.parametrize("min_df", [1, 2, 7, 300])
def test_sketched_vocabulary_is_exact(grams, min_df):
    n_docs = features.document_count(grams)
    wanted = sorted(brute_vocabulary(grams, min_df, 400))
    for sketched in (True, False):
        found = vocabulary.fit_vocabulary(grams, n_docs, min_df=min_df, max_features=400, sketched=sketched)
        assert sorted(tuple(r) for r in found.collect()) == wanted


def test_sketch_lets_few_rare_grams_pass(spark, grams):
    bits = vocabulary.frequent_buckets(grams, "grams", 2).scalar()
    pairs = features.term_counts(grams, "id").select("term")
    passed = pairs.where(vocabulary.may_be_frequent(F.col("term"), bits)).count()
    total = Counter(g for r in grams.collect() for g in r["grams"] or [])
    surely = pairs.where(F.col("term").isin([g for g, n in total.items() if n >= 2])).count()
    assert surely <= passed <= surely + 5 < pairs.count()


def test_no_rows_have_no_vocabulary(spark):
    none = spark.createDataFrame([], "id int, grams array<string>")
    n_docs = features.document_count(none)
    found = vocabulary.fit_vocabulary(none, n_docs)
    assert found.collect() == []
    assert features.tfidf(none, TermTable(found, n_docs), "id").collect() == []


def test_tfidf_in_the_row(grams):
    n_docs = features.document_count(grams)
    found = vocabulary.fit_vocabulary(grams, n_docs, max_features=300)
    weights = features.tfidf(grams, TermTable(found, n_docs), "id")
    assert "Exchange" not in weights._jdf.queryExecution().executedPlan().toString()
    known = {t: n for t, _, n in brute_vocabulary(grams, 2, 300)}
    n = grams.count()
    wanted = {}
    for r in grams.collect():
        w = {t: c * (math.log((1 + n) / (1 + known[t])) + 1) for t, c in Counter(r["grams"] or []).items() if t in known}
        length = math.sqrt(sum(x * x for x in w.values()))
        wanted |= {(r["id"], t): x / length for t, x in w.items()}
    got = {(r["id"], r["term"]): r["tfidf"] for r in weights.collect()}
    assert got.keys() == wanted.keys() and all(got[k] == pytest.approx(v, abs=1e-12) for k, v in wanted.items())


def test_perfect_hash_of_a_large_vocabulary(spark):
    keys = np.random.default_rng(3).integers(-(2**63), 2**63, 50_000)
    table = vocabulary._displaced(keys)
    assert len(np.unique(table.slots)) == len(keys) and table.size <= 4 * len(keys)
    bucket, start, stride = vocabulary._mixed_parts(keys, table.size, len(table.steps))
    assert ((start + table.steps[bucket] * stride) & (table.size - 1) == table.slots).all()


def test_dictionary_numbers_sorted_levels(spark):
    values = [f"é{i % 700}" if i % 3 else None for i in range(5000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, c string").repartition(5)
    known = dictionary.fit_dictionary(df, "c")
    levels = sorted({v for v in values if v is not None})
    assert sorted((r["level"], r["index"]) for r in known.collect()) == list(zip(levels, range(len(levels))))
    more = df.union(spark.createDataFrame([(9999, "unseen")], df.schema))
    coded = {r["id"]: r["v"] for r in dictionary.one_hot_sparse(more, known, "c", "v").collect()}
    assert all(
        coded[i]["size"] == len(levels) and list(coded[i]["indices"]) == ([levels.index(v)] if v else [])
        for i, v in enumerate(values)
    )
    assert coded[9999]["values"] == [] and dictionary.fit_dictionary(df.limit(0), "c").count() == 0


@pytest.mark.parametrize("n", [10, 1500])
def test_top_of_a_hot_group(spark, n):
    rng = random.Random(7)
    rows = [("hot", float(int(rng.gauss(0, 300))), i) for i in range(9000)]
    rows += [("nan", float("nan"), i) for i in range(20)] + [("hot", float("nan"), -1), ("hot", None, -2)]
    rows += [(None, 1.0, i) for i in range(1600)] + [("nulls", None, i) for i in range(1700)] + [("few", 2.0, 1)]
    df = spark.createDataFrame(rows, "g string, v double, id int").repartition(6)
    order = lambda r: (r[1] is None, not (r[1] is not None and math.isnan(r[1])), -(r[1] or 0.0) if r[1] == r[1] else 0, r[2])
    wanted = []
    for g in {r[0] for r in rows}:
        own = sorted([r for r in rows if r[0] == g], key=order)[:n]
        wanted += [(g, r[2], i + 1) for i, r in enumerate(own)]
    got = runs.top_per_group(df, "g", "v", "id", n).collect()
    assert sorted([(r["g"], r["id"], r["rank"]) for r in got], key=repr) == sorted(wanted, key=repr)
    if n > 1000:
        assert runs.at_least_nth(df, "g", "v", n).where("g = 'hot'").count() < 3000


def test_counting_is_cut_into_bounded_pieces(monkeypatch):
    """what a worker holds at once does not grow with the rows of a batch."""
    lists = pa.array([["b", "a", "b", None], None, [], ["c"] * 9, ["a", "d"]], pa.list_(pa.string()))
    monkeypatch.setattr(vocabulary, "SLICE_ITEMS", 5)
    pieces = list(vocabulary._slices(lists))
    assert [at for at, _ in pieces] == [0, 3, 4]
    assert all(len(x.flatten()) <= 5 or len(x) == 1 for _, x in pieces)
    batch = pa.RecordBatch.from_arrays([lists], ["grams"])
    total, df = Counter(), Counter()
    for part in vocabulary._partial_counts(iter([batch])):
        for r in part.to_pylist():
            total[r["term"]] += r["total"]
            df[r["term"]] += r["df"]
    assert total == {"a": 2, "b": 2, "c": 9, "d": 1} and df == {"a": 2, "b": 1, "c": 1, "d": 1}


def test_arrays_come_to_python_in_small_batches(spark, grams):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    vocabulary.fit_vocabulary(grams, features.document_count(grams))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= vocabulary.BATCH_ROWS


def test_texts_are_cut_into_words_once(spark):
    """F7, F8, F13: n-grams for several passes come from stored words, equal to those made in place."""
    df = spark.createDataFrame([(1, "Red fish, blue fish"), (2, None), (3, "")], "id int, body string")
    stored = features.stored_grams(df, ["id"], ["body"], (1, 2))
    assert "regexp_replace" not in stored._jdf.queryExecution().executedPlan().toString().lower()
    made = features.with_grams(df, ["body"], (1, 2)).select("id", "grams")
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, made.collect()))


@pytest.fixture(scope="module")
def worded(spark):
    rng = random.Random(2)
    docs = [[f"w{int(rng.paretovariate(0.8)) % 300}" for _ in range(rng.choice([0, 1, 2, 30, 90]))] for _ in range(200)]
    rows = [(i, w) for i, w in enumerate([*docs, ["é", "é", "é"], ["a b", "c"], None, docs[7]])]
    return written(spark.createDataFrame(rows, "id int, words array<string>").repartition(4), "words")


@pytest.mark.parametrize("low, high, min_df, size", [(1, 1, 2, 50), (1, 2, 1, 90), (2, 4, 2, 400), (1, 2, 2, 10**6)])
def test_vocabulary_of_words_is_that_of_their_ngrams(spark, worded, monkeypatch, low, high, min_df, size):
    grams = worded.select(text.ngrams("words", low, high).alias("grams"))
    n_docs = features.document_count(worded)
    wanted = sorted(brute_vocabulary(grams, min_df, size))
    monkeypatch.setattr(vocabulary, "SLICE_ITEMS", 500)
    assert wanted == sorted(
        tuple(r) for r in vocabulary.fit_word_vocabulary(worded, n_docs, "words", (low, high), min_df, max_features=size).collect()
    )
    monkeypatch.setattr(vocabulary, "_likely_least", lambda *_: 10**7)  # a bad guess is found out
    assert wanted == sorted(
        tuple(r) for r in vocabulary.fit_word_vocabulary(worded, n_docs, "words", (low, high), min_df, max_features=size).collect()
    )


def test_terms_of_one_key_stay_apart(spark):
    words = pa.array([["a", "b"], ["c"], None, ["b", "b", "a"]], pa.list_(pa.string()))
    keys = pa.array([[5, 5], [5], None, [5, 5, 5]], pa.list_(pa.int64()))  # all words have the same key
    wanted = type("Sent", (), {"value": np.ones((vocabulary.ROWS, 1 << vocabulary.TOTAL_BITS), bool)})
    parts = vocabulary._key_terms(1, 1, wanted)(iter([pa.RecordBatch.from_arrays([words, keys], ["w", "k"])]))
    got = {r["term"]: (r["total"], r["df"]) for p in parts for r in p.to_pylist()}
    assert got == {"a": (2, 2), "b": (3, 2), "c": (1, 1)}


def test_fitting_on_words_makes_no_ngrams(spark, worded, monkeypatch):
    monkeypatch.setattr(vocabulary, "fit_vocabulary", None)
    monkeypatch.setattr(vocabulary.text, "ngrams", None)
    fitted = features.TextVectorizer.fit(worded, max_features=40, words="words", ngram_range=(1, 2))
    assert len(fitted.terms) == 40


@pytest.mark.parametrize("low, high", [(1, 1), (1, 2), (1, 3), (2, 3), (2, 2)])
def test_known_grams_are_those_of_the_vocabulary(spark, grams, low, high, monkeypatch):
    """All other n-grams are left out, whatever the rows a batch holds; words run on into no other row."""
    monkeypatch.setattr(vocabulary, "SLICE_ITEMS", 150)
    words = grams.withColumn("place", F.when(F.col("id") % 3 == 0, F.col("id").cast("double")))
    made = {}
    for r in words.collect():
        w = r["grams"] or []
        made[r["id"]] = [" ".join(w[i : i + n]) for n in range(low, high + 1) for i in range(len(w) - n + 1)]
    total = Counter(g for d in made.values() for g in d)
    terms = [g for g, n in total.items() if n >= 3][:500] + [" ".join(["w1", "w0", "w2"][:high])]
    terms = list(dict.fromkeys(terms))
    found = vocabulary.known_grams(words, terms, "grams", (low, high), ["place", "id"], "known")
    rows = found.collect()
    assert found.columns == ["place", "id", "known"] and len(rows) == len(made)
    assert sum(len(r["known"]) for r in rows) > 50
    for r in rows:
        assert sorted(r["known"]) == sorted(g for g in made[r["id"]] if g in set(terms))
        assert r["place"] == (r["id"] if r["id"] is not None and r["id"] % 3 == 0 else None)


def test_prepared_vectors_are_those_of_the_whole_chain(spark):
    """Rows counted from known n-grams have the vectors that the fitted chain gives to all n-grams."""
    rng = random.Random(3)
    rows = [
        (i, rng.choice(["a", "b"]), " ".join(f"w{rng.randrange(30)}" for _ in range(rng.choice([0, 1, 2, 40]))),
         None if i % 7 == 0 else float(i % 5), rng.choice(["x", "y", None]))
        for i in range(120)
    ]
    df = spark.createDataFrame(rows, "id long, kind string, body string, size double, place string").repartition(3)
    inputs = model.Inputs("id", "kind", ["body"], ["size"], ["place"])
    prepared = model.prepare(df, inputs, max_features=90)
    table = features.numeric_features(features.with_grams(df, ["body"]), ["size"])
    wanted = {r["id"]: r["features"] for r in prepared.chain.transform(table).select("id", "features").collect()}
    found = [r for part in (prepared.train, prepared.test) for r in part.collect()]
    assert sorted(r["id"] for r in found) == list(range(120))
    assert all(r["features"] == wanted[r["id"]] for r in found)
    prepared.release()


def test_words_of_odd_texts(spark):
    odd = ["", None, "a bb _ __ c1", "Ünï\u0308x ß\u00e9 \U0001d400\U0001d401x x\U0001d400", "\u4e2d \u4e2d\u6587,\u6587", "1 22\n\t the THE", "a\U0001d400" * 9000]
    df = spark.createDataFrame([(t,) for t in odd], "t string")
    for stop in (None, ["the", "bb"]):
        for lower in (True, False):
            cased = [(t or "").lower() if lower else t or "" for t in odd]
            wanted = [[w for w in re.split(r"[^\w]+", t) if len(w) > 1 and w not in (stop or [])] for t in cased]
            wanted[3] = [w for p in re.split(r"[^\w]+", cased[3].replace("\u0308", " ")) for w in [p] if len(w) > 1]
            assert [r[0] for r in df.select(text.tokens("t", stop, lower)).collect()] == wanted


def test_registered_vocabulary_comes_from_words(spark, tmp_path, monkeypatch):
    """the query counts keys of stored words and shuffles no partial count of an n-gram as text."""
    from foliospark.queries import features as queries

    bodies = ["Red fish.\nThe red fish eat", "red fish, blue whale", None, "", "blue whale", "fish red"]
    rows = [(i, b, "en" if i % 2 else None, "web", len(b or "")) for i, b in enumerate(bodies)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    monkeypatch.setattr(vocabulary, "fit_vocabulary", None)
    grams, terms, n_docs = queries._grams_and_vocabulary(spark, str(tmp_path))
    counts = [Counter(r["grams"]) for r in grams.collect()]
    total, df = sum(counts, Counter()), Counter(t for c in counts for t in c)
    wanted = sorted((t, total[t], n) for t, n in df.items() if 2 <= n <= 0.95 * len(bodies))
    assert len(wanted) > 4 and sorted(map(tuple, terms.collect())) == wanted
    known = features.vocab_join(grams, TermTable(terms, n_docs), "doc_id").collect()
    assert sum(r["tf"] for r in known) == sum(n for _, n, _ in wanted)
