"""License scan, tokens, packing, shards, languages and toxicity on edge rows and brute force."""

import re
import zlib
import time
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from foliospark.llm import langid, licenses, packing, sharding, texts, tokencount, toxicity
from foliospark.llm.queries import LLM, held_out
from tests.llm import edge

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ALPHABET = st.sampled_from(list("ab c'stremdlv019.,!?\n\t éßÉñ中Σ²½ ") + ["'re", "'s", "<|endoftext|>"])
STRINGS = st.lists(st.lists(ALPHABET, max_size=40).map("".join), min_size=1, max_size=8)
WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
BYTE_FILE = public_tokenizers.path("byte_bpe_50k.json")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@settings(max_examples=60, deadline=None)
@given(STRINGS)
def test_words_and_shingles_equal_python(strings):
    found = texts.words(texts.plain(pa.array(strings)), texts.ALNUM)
    spelled = [bytes(found.data[a:b]).decode() for a, b in zip(found.starts, found.ends)]
    expected = [WORDS.findall(lower(s)) for s in strings]
    assert spelled == [w for ws in expected for w in ws]
    assert np.diff(found.first).tolist() == [len(ws) for ws in expected]
    by_hash = defaultdict(set)
    for w, h in zip(spelled, found.hashes.tolist()):
        by_hash[h].add(w)
    assert all(len(v) == 1 for v in by_hash.values())
    _, at = texts.shingles(found, 3)
    assert np.diff(at).tolist() == [len(w) - 2 if len(w) >= 3 else min(len(w), 1) for w in expected]


@settings(max_examples=150, deadline=None)
@given(STRINGS)
def test_token_counts_equal_library(strings):
    whole = Tokenizer.from_file(WORD_FILE)
    expected = [len(whole.encode(s, add_special_tokens=False).ids) for s in strings]
    assert tokencount.count_tokens(strings, WORD_FILE) == expected


@settings(max_examples=150, deadline=None)
@given(STRINGS)
def test_ids_equal_library(strings):
    whole, encode = Tokenizer.from_file(BYTE_FILE), packing.encoder(BYTE_FILE)
    for s in strings:
        assert encode(s).tolist() == whole.encode(s, add_special_tokens=False).ids


def test_counts_of_documents_equal_library(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    out = tokencount.with_token_counts(docs.unionByName(edge.frame(spark).select("doc_id", "text")), WORD_FILE)
    whole = Tokenizer.from_file(WORD_FILE)
    for r in out.collect():
        n = len(whole.encode(r.text or "", add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len((r.text or "").encode()), n > 2048)
    assert tokencount.with_token_counts(edge.frame(spark, empty=True), WORD_FILE).count() == 0


def test_a_small_cache_changes_nothing(monkeypatch):
    strings = [edge.prose(i, 80) for i in range(20)]
    expected = tokencount.count_tokens(strings, WORD_FILE)
    monkeypatch.setattr(tokencount, "STATES", 50)
    monkeypatch.setattr(tokencount, "WORDS", 50)
    tokencount._transducers.clear()
    assert [tokencount.count_tokens([s], WORD_FILE)[0] for s in strings] == expected


def test_license_base_columns_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(edge.frame(spark).select("doc_id", "text"))
    for r in licenses.scan_licenses(docs).collect():
        found = WORDS.findall(lower(r.text))
        places = [
            (i, label) for phrase, label in licenses.BASE.items() for i in range(len(found))
            if found[i : i + len(phrase.split())] == phrase.split()
        ]
        starts = [i for i, _ in places]
        assert (r.n_words, r.n_base) == (len(found), len(places))
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert {x for _, x in places} <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_license_scan_keeps_columns(spark):
    out = licenses.scan_licenses(edge.frame(spark)).collect()
    assert edge.kept_columns(out, ["score", "n_words"]) == edge.kept_rows(["score", "n_words"])


def test_license_rules_and_suppression():
    ruled = licenses.rules()
    assert len(ruled) > 300 and [r.priority for r in ruled] == sorted(r.priority for r in ruled)

    def labels(text):
        return sorted(licenses.scan(text.lower().encode(), ruled)[2])

    assert labels("Licensed under the Apache License, Version 2.0.") == ["apache", "apache-2.0"]
    assert labels("GNU Lesser General Public License v2.1") == ["lgpl-2.1"]
    assert labels("CC BY-NC-SA 4.0") == ["cc-by", "cc-by-nc-sa-4.0"]
    assert labels("SPDX-License-Identifier: BSD-3-Clause") == ["bsd-3-clause"]
    assert labels("He was admitted without a licence") == []
    assert len(set(licenses._named())) == len(licenses._named())
    assert licenses.detections(b"", ruled) == []


def test_license_identifiers_and_bare_names():
    ruled = licenses.rules()

    def labels(text):
        return sorted(licenses.scan(text.lower().encode(), ruled)[2])

    for name, label in [
        ("MIT", "mit"), ("MIT-0", "mit-0"), ("Apache-2.0", "apache-2.0"), ("ISC", "isc"), ("Zlib", "zlib"),
        ("EPL-2.0", "epl-2.0"), ("BSL-1.0", "boost-1.0"), ("0BSD", "bsd-0-clause"), ("GPL-2.0-or-later", "gpl-2.0"),
        ("LGPL-2.1-only", "lgpl-2.1"), ("CC-BY-SA-4.0", "cc-by-sa-4.0"), ("BSD-3-Clause-Clear", "bsd-3-clause-clear"),
    ]:
        assert set(labels(f"// SPDX-License-Identifier: {name}; int main")) - {"cc-by"} == {label}, name
    both = "SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 OR MIT AND (Apache-2.0)"
    assert labels(both) == ["apache-2.0", "gpl-2.0", "mit"]
    assert labels("SPDX-License-Identifier: MIT; import zlib") == ["mit"]
    for name, label in [
        ("Mozilla Public License", "mpl"), ("the Eclipse Public License", "epl"), ("LGPL", "lgpl"), ("GPL", "gpl"),
        ("GNU Lesser General Public License", "lgpl"), ("GNU Affero General Public License", "agpl"),
    ]:
        assert labels(f"It comes under {name} as a whole") == [label], name
    assert labels("under the terms of the Mozilla Public License 2.0") == ["mpl-2.0"]


def test_license_short_forms():
    ruled = licenses.rules()

    def labels(text):
        return sorted(licenses.scan(text.lower().encode(), ruled)[2])

    for name, label in [
        ("GPLv3", "gpl-3.0"), ("GPLv2+", "gpl-2.0"), ("GPL-2.0", "gpl-2.0"), ("GPL v3", "gpl-3.0"), ("LGPLv3", "lgpl-3.0"),
        ("LGPLv2.1", "lgpl-2.1"), ("AGPLv3", "agpl-3.0"), ("GNU GPL version 3", "gpl-3.0"), ("EUPL v1.2", "eupl-1.2"),
        ("Apache 2.0", "apache-2.0"), ("ASL 2.0", "apache-2.0"), ("MPLv2", "mpl-2.0"), ("EPL 2.0", "epl-2.0"),
        ("CDDL 1.1", "cddl-1.1"), ("GFDL 1.3", "gfdl-1.3"), ("OFL 1.1", "ofl-1.1"), ("ODbL 1.0", "odbl-1.0"),
    ]:
        assert labels(f"It comes under {name}, as a whole") == [label], name
    for clean in ["the apache helicopter", "Apache 2.4 server", "he won the EPL in 2 seasons", "an osl of 11", "gplan"]:
        assert labels(clean) == [], clean


def slow_detections(joined, ruled):
    """All rules without gates, each detection compared with all that are kept."""
    found = []
    for rule in ruled:
        for m in rule.pattern.finditer(joined):
            found.append((rule.priority, m.start(m.lastindex or 0), m.end(), rule.label, rule.confidence))
    kept = []
    for _, start, end, label, confidence in sorted(found, key=lambda d: (d[0], d[1] - d[2], d[1])):
        if not any(a <= start and end <= b for a, b, _, _ in kept):
            kept.append((start, end, label, confidence))
    return sorted(kept)


PHRASES = st.sampled_from(
    ["mit license", "licensed under the", "terms of the", "apache license", "version 2 0", "gnu", "lesser", "gplv3",
     "general public license", "gpl", "2", "0", "spdx license identifier", "mit", "or", "apache 2 0", "word", "cc by",
     "sa", "4 0", "published by the free software foundation", "distributed under the boost software license",
     "bsd 3 clause", "license", "public domain", "dedicated to the", "all rights reserved"]
)


@settings(max_examples=60, deadline=None)
@given(st.lists(PHRASES, max_size=25))
def test_suppression_equals_all_pairs(phrases):
    ruled = licenses._ready()[0]
    joined = " ".join(phrases).encode()
    assert licenses.detections(joined, ruled) == slow_detections(joined, ruled)


def test_long_text_full_of_licenses():
    ruled = licenses._ready()[0]
    begin = time.perf_counter()
    starts, _, labels, _ = licenses.scan(b"mit license " * 170_000, ruled)
    assert len(starts) == 170_000 and starts[-1] == 339_998 and "mit" in labels
    assert time.perf_counter() - begin < 15


def test_gates_let_all_detections_through():
    ruled, gates = licenses._ready()
    for rule in ruled:
        assert any(set(g) <= set(rule.keywords) for g in gates)


def exhaustive(lengths, capacity):
    """The least number of bins, by trying."""
    best = [len(lengths)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for j in {b: j for j, b in enumerate(bins)}.values():
            if bins[j] + lengths[i] <= capacity:
                go(i + 1, bins[:j] + [bins[j] + lengths[i]] + bins[j + 1 :])
        go(i + 1, bins + [lengths[i]])

    go(0, [])
    return best[0]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_dominance_keeps_the_optimum(lengths):
    counts = Counter(lengths)
    fixed = packing.dominant(dict(counts), 20)
    rest = dict(counts)
    packing.dominant(rest, 20)
    left = sorted((x for x, n in rest.items() for _ in range(n)), reverse=True)
    taken = sum(times for times, _ in fixed)
    assert taken + exhaustive(left, 20) == exhaustive(sorted(lengths, reverse=True), 20)
    used = Counter()
    for times, items in packing.plan(dict(counts), 20):
        assert sum(x * n for x, n in items) <= 20
        for x, n in items:
            used[x] += times * n
    assert used == counts


def check_packing(rows, docs):
    whole = Tokenizer.from_file(BYTE_FILE)
    expected = Counter()
    for key, text in docs:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 2048 or 2048
        begins = [0, *range(first, len(ids), 2048)]
        for i, (a, b) in enumerate(zip(begins, [*begins[1:], len(ids)])):
            expected[key, i, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in rows)
    assert len(sequences) <= 1.01 * total / 2048 + 1


def test_packing_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    check_packing(LLM["op5_best_fit_packing"].run(spark, folder).collect(), [tuple(r) for r in docs.collect()])


def test_packing_of_edge_rows(spark):
    rows = packing.pack(edge.frame(spark), BYTE_FILE).collect()
    check_packing(rows, [(r[0], r[1]) for r in edge.rows()])
    assert packing.pack(edge.frame(spark, empty=True), BYTE_FILE).count() == 0


def check_shards(rows, docs, largest):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in docs
    )
    bytes_of, slots, home = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        bytes_of[r.shard] += r.size
        slots[r.shard].append(r.slot)
        home[r.text_crc32, r.size].add(r.shard)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in home.values()) and set(bytes_of) <= set(range(16))
    assert max(bytes_of.values()) <= max(1.03 * sum(bytes_of.values()) / 16 + 1, largest)


def test_shards(spark, folder):
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    check_shards(LLM["op8_best_fit_sharding"].run(spark, folder).collect(), docs, 0)
    rows = [(r[0], r[1]) for r in edge.rows()]
    largest = max(Counter({t: 0 for _, t in rows} | {}).keys(), key=lambda t: len(t or ""))
    check_shards(sharding.shard(edge.frame(spark)).collect(), rows, 2 * len(largest.encode()))
    assert len({r.shard for r in sharding.shard(edge.frame(spark)).collect()}) == 16
    assert sharding.shard(edge.frame(spark, empty=True)).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60), st.integers(1, 6), st.integers(50, 400))
def test_fitting_equals_one_by_one(sizes, shards, capacity):
    bins = [(capacity, s) for s in range(shards)]
    for size in sorted(sizes, reverse=True):
        able = [b for b in bins if b[0] >= size]
        if not able:
            bins = None
            break
        room, s = min(able)
        bins[s] = (room - size, s)
    found = sharding.fitted(sorted(Counter(sizes).items(), reverse=True), range(shards), capacity)
    assert (found is None) == (bins is None)
    if found is not None:
        taken = Counter()
        for size, n, s in found:
            taken[s] += size * n
        assert [capacity - taken[s] for s in range(shards)] == [room for room, _ in bins]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=8), st.integers(1, 4))
def test_placing_against_all_ways(sizes, shards):
    placed = sharding.place(dict(Counter(sizes)), shards)
    loads, counts = Counter(), Counter()
    for size, n, s in placed:
        loads[s] += size * n
        counts[size] += n
    assert counts == Counter(sizes) and set(loads) <= set(range(shards))
    least = min(max(np.bincount(way, sizes, shards)) for way in product(range(shards), repeat=len(sizes))) if sizes else 0
    assert max(loads.values(), default=0) <= 1.25 * least


def test_placing_apart_from_a_giant():
    placed = sharding.place({5000: 1, 300: 2, **dict.fromkeys(range(1, 60), 3)}, 8)
    loads = Counter()
    for size, n, s in placed:
        loads[s] += size * n
    others = sorted(loads.values())[:-1]
    assert loads[0] == 5000 and len(loads) == 8 and max(others) - min(others) <= 10


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.booleans()), max_size=80))
def test_tree_of_bins(steps):
    tree, held = None, []
    for i, (room, out) in enumerate(steps):
        if out and held:
            tree = sharding.removed(tree, held.pop(room % len(held)))
        else:
            held.append((room, i))
            tree = sharding.inserted(tree, held[-1])
        assert all(sharding.tightest(tree, s) == min((b for b in held if b[0] >= s), default=None) for s in range(32))
        assert (tree.height if tree else 0) <= 1.45 * np.log2(len(held) + 2)


def test_languages_held_out(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    found = LLM["op3_language_id"].run(spark, folder).where("held_out").join(docs, "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.97


def test_language_mixture_and_edges(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = langid.fit(docs)
    texts_of = {k: " ".join(r.text for r in docs.where(F.col("lang") == k).limit(4).collect()) for k in ("en", "fr")}
    mixed = " ".join(texts_of["en"].split()[:300] + texts_of["fr"].split()[:150])
    (lead, share, members, shares), = langid.mixtures(texts.plain(pa.array([mixed])), model)
    assert lead == "en" and set(members) == {"en", "fr"} and abs(shares[0] - 2 / 3) < 0.1
    out = langid.identify(edge.frame(spark), model).collect()
    assert len(out) == len(edge.rows())
    assert edge.kept_columns(out, ["score", "gain"]) == edge.kept_rows(["score", "gain"])
    for r in out:
        letters = any(map(str.isalpha, r.text or ""))
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
    assert langid.identify(edge.frame(spark, empty=True), model).count() == 0
    nothing = langid.fit(edge.frame(spark, empty=True))
    assert {r.lang_pred for r in langid.identify(edge.frame(spark), nothing).collect()} == {"und"}


def test_language_sets_have_no_limit(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    words_of = {
        k: " ".join(r.text for r in docs.where(F.col("lang") == k).orderBy("doc_id").limit(150).collect()).split()
        for k in model.languages
    }
    assert len(words_of) == 4
    equal = " ".join(w for ws in words_of.values() for w in ws[:150])
    lots = words_of["en"] * (1 + 19800 // len(words_of["en"]))
    trace = " ".join(lots[:19800] + words_of["fr"][:200])
    alone = " ".join(words_of["en"][:300])
    found = langid.mixtures(texts.plain(pa.array([equal, trace, alone])), model)
    assert set(found[0][2]) == set(words_of) and set(found[1][2]) >= {"en", "fr"} and found[2][2] == ["en"]
    assert abs(dict(zip(found[1][2], found[1][3]))["fr"] - 0.01) < 0.005
    assert all(abs(x - 0.25) < 0.08 for x in found[0][3])


def test_gradients_equal_differences():
    strings = ["idiot sad words here", "other kind words of prose are here", ""]
    found = toxicity.Inputs(texts.words(texts.plain(pa.array(strings)), texts.ALNUM))
    odds = {
        "word_keys": np.sort(found.words), "gram_keys": np.unique(found.grams),
        "word_odds": np.linspace(-1, 1, len(found.words) + 1).astype(np.float32),
        "gram_odds": np.linspace(1, -1, len(np.unique(found.grams)) + 1).astype(np.float32),
    }
    rng = np.random.default_rng(1)
    model = {k: v.astype(np.float64) if k not in toxicity.FIXED else v for k, v in (toxicity._fresh(rng, odds) | odds).items()}
    index, own = found.windows()
    labels = np.array([1.0, 0.0])

    def loss():
        z = toxicity._forward(model, found.vectors(model), index)
        return float(np.mean(np.log1p(np.exp(z)) - labels * z))

    grads = toxicity._gradients(model, found, index, labels)
    for name in ("in_on", "again_back", "bias_on", "attend", "out", "word", "gram", "base"):
        flat, g = model[name].reshape(-1), grads[name].reshape(-1)
        for i in np.argsort(-np.abs(g))[:3]:
            old = flat[i]
            flat[i] = old + 1e-2
            up = loss()
            flat[i] = old - 1e-2
            down = loss()
            flat[i] = old
            assert (up - down) / 2e-2 == pytest.approx(g[i], rel=0.05, abs=2e-3)


def test_windows_cover_whole_texts():
    long = edge.prose(8, 1000)
    found = toxicity.Inputs(texts.words(texts.plain(pa.array([long, "", "one"])), texts.ALNUM))
    index, own = found.windows()
    assert set(own.tolist()) == {0, 2} and (own == 2).sum() == 1
    assert set(found.codes[:1000].tolist()) <= set(index[own == 0].ravel().tolist())
    assert (own == 0).sum() == -(-(1000 - toxicity.WINDOW) // toxicity.STRIDE) + 1


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    out = LLM["op2_toxicity"].run(spark, folder).where("held_out").join(labels, "doc_id").collect()
    toxic = [r.predicted for r in out if r.toxic]
    clean = [r.predicted for r in out if not r.toxic]
    assert np.mean(toxic) > 0.9 and np.mean(clean) < 0.05


def test_rare_telling_words_stay_known(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_KNOWN", 40)
    rows = [(f"{edge.prose(i % 30, 40)}{' vilest' if i < 10 else ''}", int(i < 60)) for i in range(600)]
    odds = toxicity.count_odds(spark.createDataFrame(rows, "text string, toxic int"), "text", "toxic")
    wanted = toxicity.Inputs(texts.words(texts.plain(pa.array(["vilest"])), texts.ALNUM))
    row = toxicity._rows(odds["word_keys"], wanted.words)[0]
    assert row > 0 and odds["word_odds"][row] == odds["word_odds"].max() > 0.5
    assert len(odds["word_keys"]) == 40 and len(odds["gram_keys"]) == 40


def test_toxicity_edges(spark):
    one = spark.createDataFrame([("good words", 0), (None, 1), ("fine", None)], "text string, toxic int")
    model = toxicity.fit(one)
    out = toxicity.score_toxicity(edge.frame(spark), model).collect()
    assert len(out) == len(edge.rows()) and all(r.predicted == 0 for r in out)
    assert toxicity.score_toxicity(edge.frame(spark, empty=True), model).count() == 0


def test_held_out_rows(spark):
    rows = spark.createDataFrame([(7,), (None,)], "doc_id long").select("doc_id", held_out().alias("h"))
    assert [r.h for r in rows.collect()] == [zlib.crc32(b"7") % 4 == 2, False]
