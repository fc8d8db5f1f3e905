"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters as an embedding of itself, the mean embedding of its character
n-grams, and how much likelier the word, and the likeliest of its n-grams, is in
toxic documents than in others. The network reads a window of words both ways, weighs its places by
attention and gives the window a score; a document has the highest score of all
its overlapping windows. Training is NumPy on a bounded sample on the driver,
scoring is NumPy on whole texts in the executors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.texts import ALNUM, Words, slices, small_batches, words
from foliospark.plans.scratch import written

WINDOW, STRIDE = 40, 20
GRAM = 5  # characters of an n-gram
EMBED, HIDDEN = 8, 8  # of each kind of trained input; in each direction
INPUTS = 2 * EMBED + 2
#: Odds start from so many documents of the usual mix for each toxic one, within limits, and are cut.
SHRINK, LEAST_SHRINK, MOST_SHRINK = 0.03, 4.0, 50.0
LEAST_ODDS, MOST_ODDS = -1.0, 4.0
#: Words and n-grams of fewer documents are unknown, else they would be learned by heart; of more
#: than MAX_KNOWN of either the most telling are known, by the size of their odds times their documents.
LEAST_KNOWN, MAX_KNOWN = 8, 1 << 17
FLUSH = 1 << 20
#: Training takes about so many toxic documents, three times as many others, and so many windows of each.
FIT_DOCS, FIT_WINDOWS = 800, 16
EPOCHS, LEAST_STEPS, BATCH, RATE, DECAY = 4, 200, 256, 0.01, 0.002
THRESHOLD = 0.3

Model = dict[str, np.ndarray]
FIXED = ("word_keys", "gram_keys", "word_odds", "gram_odds")  # counted, not trained


class Inputs:
    """The distinct words of a slice of texts, and which of them stands at each place."""

    def __init__(self, found: Words):
        codes, distinct = pd.factorize(found.hashes)
        at = np.zeros(len(distinct), np.int64)
        at[codes[::-1]] = np.arange(len(codes))[::-1]
        self.codes, self.first, self.words = codes, found.first, distinct
        # n-grams of a word between two spaces, from the first on; a shorter word is one
        starts, lengths = found.starts[at], (found.ends - found.starts)[at]
        self.counts = np.maximum(lengths + 3 - GRAM, 1)
        self.begin = np.cumsum(self.counts) - self.counts
        place = np.repeat(starts - 1 - self.begin, self.counts) + np.arange(self.counts.sum())
        data = np.concatenate([found.data, np.full(GRAM + 1, 0x20, np.uint8)]).astype(np.uint64)
        head, tail = np.repeat(starts, self.counts), np.repeat(starts + lengths, self.counts)
        gram = np.zeros(len(place), np.uint64)
        for j in range(GRAM):
            at_j = place + j
            inside = (at_j >= head) & (at_j < tail)
            gram = gram << np.uint64(8) | np.where(inside, data[at_j], np.uint64(0x20))
        self.grams = gram  # the bytes themselves

    def known(self, model: Model) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the model's tables for each distinct word and each n-gram; 0 is unknown."""
        return _rows(model["word_keys"], self.words), _rows(model["gram_keys"], self.grams)

    def vectors(self, model: Model) -> np.ndarray:
        """A row per distinct word."""
        if not len(self.words):
            return np.zeros((0, INPUTS), np.float32)
        rows, grams = self.known(model)
        mean = np.add.reduceat(model["gram"][grams], self.begin, axis=0) / self.counts[:, None]
        odds = np.maximum.reduceat(model["gram_odds"][grams], self.begin)
        odds = np.stack([model["word_odds"][rows], odds], axis=1)
        return np.concatenate([model["word"][rows], mean, odds], axis=1).astype(np.float32)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """All windows as rows of word numbers (their number where a text ends), and their texts.

        Every text has the windows from each STRIDE words on until one reaches its end.
        """
        n = np.diff(self.first)
        each = np.where(n > 0, np.maximum(-(-(n - WINDOW) // STRIDE), 0) + 1, 0)
        own = np.repeat(np.arange(len(n)), each)
        start = (np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)) * STRIDE
        inside = start[:, None] + np.arange(WINDOW)
        codes = np.append(self.codes, len(self.words))
        at = np.where(inside < n[own][:, None], inside + self.first[own][:, None], len(self.codes))
        return codes[at], own


def _rows(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Of each key its place in the ascending keys, from 1 on; 0 if it is none of them."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at + 1, 0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _read(model: Model, side: str, vectors: np.ndarray, index: np.ndarray, keep: list | None) -> np.ndarray:
    """States after each step in one direction; at missing words the state stays."""
    gates = vectors @ model[f"in_{side}"] + model[f"bias_{side}"]
    missing = np.zeros((1, 3 * HIDDEN), np.float32)
    missing[0, :HIDDEN] = 40
    gates = np.concatenate([gates, missing])
    state = np.zeros((len(index), HIDDEN), np.float32)
    out = np.empty((index.shape[1], len(index), HIDDEN), np.float32)
    again = model[f"again_{side}"]
    for t in range(index.shape[1]) if side == "on" else reversed(range(index.shape[1])):
        a, u = gates[index[:, t]], state @ again
        zr = _sigmoid(a[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        n = np.tanh(a[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
        if keep is not None:
            keep.append((t, state, z, r, n, u[:, 2 * HIDDEN :]))
        state = n + z * (state - n)
        out[t] = state
    return out


def _forward(model: Model, vectors: np.ndarray, index: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """The logit of each window."""
    kept = {side: [] if keep is not None else None for side in ("on", "back")}
    states = np.concatenate([_read(model, s, vectors, index, kept[s]) for s in ("on", "back")], axis=2)
    weights = states @ model["attend"]
    weights[(index == len(vectors)).T] = -1e9
    weights = np.exp(weights - weights.max(axis=0))
    weights /= weights.sum(axis=0)
    pooled = np.einsum("tb,tbh->bh", weights, states)
    if keep is not None:
        keep.update(kept, states=states, weights=weights, pooled=pooled)
    return pooled @ model["out"] + model["base"][0]


def _gradients(model: Model, inputs: Inputs, index: np.ndarray, labels: np.ndarray) -> Model:
    """Of the mean cross-entropy, by backpropagation through time."""
    vectors, keep = inputs.vectors(model), {}
    error = ((_sigmoid(_forward(model, vectors, index, keep)) - labels) / len(labels)).astype(np.float32)
    states, weights = keep["states"], keep["weights"]
    grads = {k: np.zeros_like(v) for k, v in model.items() if k not in FIXED}
    grads["base"][0], grads["out"] = error.sum(), keep["pooled"].T @ error
    into = error[:, None] * model["out"]
    aimed = np.einsum("tbh,bh->tb", states, into)
    aimed = weights * (aimed - (weights * aimed).sum(axis=0))
    grads["attend"] = np.einsum("tb,tbh->h", aimed, states)
    d_states = weights[:, :, None] * into + aimed[:, :, None] * model["attend"]
    d_vectors = np.zeros((len(vectors) + 1, INPUTS), np.float32)
    for i, side in enumerate(("on", "back")):
        again, d_state = model[f"again_{side}"], np.zeros((len(index), HIDDEN), np.float32)
        d_gates = np.zeros((len(vectors) + 1, 3 * HIDDEN), np.float32)
        for t, before, z, r, n, u in reversed(keep[side]):
            d = d_state + d_states[t][:, i * HIDDEN : (i + 1) * HIDDEN]
            dn = d * (1 - z) * (1 - n * n)
            dz, dr = d * (before - n) * z * (1 - z), dn * u * r * (1 - r)
            du = np.concatenate([dz, dr, dn * r], axis=1)
            grads[f"again_{side}"] += before.T @ du
            d_state = d * z + du @ again.T
            np.add.at(d_gates, index[:, t], np.concatenate([dz, dr, dn], axis=1))
        d_gates = d_gates[:-1]
        grads[f"bias_{side}"] = d_gates.sum(axis=0)
        grads[f"in_{side}"] = vectors.T @ d_gates
        d_vectors[:-1] += d_gates @ model[f"in_{side}"].T
    d_vectors = d_vectors[:-1]
    rows, grams = inputs.known(model)
    np.add.at(grads["word"], rows, d_vectors[:, :EMBED])
    mean = d_vectors[:, EMBED : 2 * EMBED] / inputs.counts[:, None]
    np.add.at(grads["gram"], grams, np.repeat(mean, inputs.counts, axis=0))
    return grads


def _fresh(rng: np.random.Generator, odds: Model) -> Model:
    shapes = {kind: (len(odds[f"{kind}_odds"]), EMBED) for kind in ("word", "gram")}
    shapes |= {"attend": (2 * HIDDEN,), "out": (2 * HIDDEN,), "base": (1,)}
    for side in ("on", "back"):
        shapes |= {f"in_{side}": (INPUTS, 3 * HIDDEN), f"again_{side}": (HIDDEN, 3 * HIDDEN), f"bias_{side}": (3 * HIDDEN,)}
    scale = {"word": 0.02, "gram": 0.02, "attend": 0.3, "out": 0.3, "base": 0.0, "bias_on": 0.0, "bias_back": 0.0}
    return {k: (rng.standard_normal(s) * scale.get(k, 0.4)).astype(np.float32) for k, s in shapes.items()}


def train(texts: list[str], labels: np.ndarray, owners: np.ndarray, odds: Model) -> Model:
    """Fit to windows that carry the label of their document.

    A toxic document has harmless windows too, so only those windows of it teach
    toxicity that come near its best: in the odds of a single word at first, and in
    the network's own score after half of the rounds.
    """
    rng = np.random.default_rng(7)
    model = _fresh(rng, odds) | odds
    model["word"][0] = model["gram"][0] = 0
    if not len(texts) or labels.min() == labels.max():
        model["out"][:] = 0
        model["base"][0] = 6.0 if len(texts) and labels.max() == 1 else -6.0
        return model
    column = pa.array(texts, pa.large_string())
    first, second = ({k: np.zeros_like(v) for k, v in model.items() if k not in FIXED} for _ in range(2))
    step = 0
    epochs = max(EPOCHS, -(-LEAST_STEPS * BATCH // len(texts)))
    for epoch in range(epochs):
        scores = score_texts(column, model) if epoch >= epochs // 2 else np.maximum(_evidence(column, model), 0)
        best = np.zeros(owners.max() + 1)
        np.maximum.at(best, owners, scores)
        use = np.flatnonzero((labels == 0) | (scores >= 0.7 * best[owners]))
        order = rng.permutation(use)
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            inputs = Inputs(words(column.take(pa.array(chosen)), ALNUM))
            index, own = inputs.windows()
            grads = _gradients(model, inputs, index, labels[chosen][own].astype(np.float32))
            step += 1
            rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                model[k] -= rate * first[k] / (np.sqrt(second[k]) + 1e-6)
            for kind in ("word", "gram"):
                model[kind] *= 1 - DECAY
                model[kind][0] = 0
    return model


def _evidence(texts: pa.Array, model: Model) -> np.ndarray:
    """The highest odds of any word of each text."""
    out = []
    for part in slices(texts):
        inputs = Inputs(words(part, ALNUM))
        best = np.full(len(part), LEAST_ODDS)
        own = np.repeat(np.arange(len(part)), np.diff(inputs.first))
        np.maximum.at(best, own, inputs.vectors(model)[:, -2:].max(axis=1, initial=LEAST_ODDS)[inputs.codes])
        out.append(best)
    return np.concatenate(out)


def score_texts(texts: pa.Array, model: Model) -> np.ndarray:
    """The highest score of any window of each text; 0 for a text without words."""
    out = []
    for part in slices(texts):
        inputs = Inputs(words(part, ALNUM))
        index, own = inputs.windows()
        scores = np.zeros(len(part))
        if len(index):
            logits = _forward(model, inputs.vectors(model), index)
            np.maximum.at(scores, own, _sigmoid(logits.astype(np.float64)))
        out.append(scores)
    return np.concatenate(out) if out else np.zeros(0)


def count_odds(docs: DataFrame, text: str, label: str) -> Model:
    """Words and n-grams, and logarithms of how much likelier they are in toxic documents.

    Counted over all labelled documents; row 0 stands for all unknown ones.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[list[np.ndarray]] = [[], []]
        toxic: list[list[np.ndarray]] = [[], []]

        def flush(kind: int) -> pa.RecordBatch:
            found = np.concatenate(keys[kind])
            order = np.argsort(found, kind="stable")
            found, marked = found[order], np.concatenate(toxic[kind])[order]
            begin = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
            keys[kind], toxic[kind] = [], []
            n = np.diff(np.append(begin, len(found)))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(n), kind)),
                    pa.array(found[begin].view(np.int64)),
                    pa.array(n),
                    pa.array(np.add.reduceat(marked, begin)),
                ],
                ["kind", "key", "n", "toxic"],
            )

        size = 0
        for batch in batches:
            names, done = batch.column(1).to_numpy(), 0
            for part in slices(batch.column(0)):
                for i in range(len(part)):
                    inputs = Inputs(words(part.slice(i, 1), ALNUM))
                    for kind, found in enumerate((inputs.words, np.unique(inputs.grams))):
                        if len(found):
                            keys[kind].append(found)
                            toxic[kind].append(np.full(len(found), names[done + i]))
                            size += len(found)
                done += len(part)
                if size >= FLUSH:
                    yield from (flush(kind) for kind in (0, 1))
                    size = 0
        if size:
            yield from (flush(kind) for kind in (0, 1))

    sizes = {r[label]: r["n"] for r in docs.groupBy(label).agg(F.count("*").alias("n")).collect()}
    counted = written(
        docs.select(text, F.col(label).cast("long").alias(label))
        .mapInArrow(count, "kind long, key long, n long, toxic long")
        .groupBy("kind", "key")
        .agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")),
        "toxic_counts",
    )
    share = min(max(sizes.get(1, 0) / max(sum(sizes.values()), 1), 0.01), 0.99)
    shrink = min(max(SHRINK * sizes.get(1, 0), LEAST_SHRINK), MOST_SHRINK)
    usual = np.log(share / (1 - share))
    # the same value in the table of counts
    rest = F.col("n") - F.col("toxic") + shrink * (1 - share)
    value = F.log((F.col("toxic") + shrink * share) / rest) - float(usual)
    power = F.abs(F.greatest(F.least(value, F.lit(MOST_ODDS)), F.lit(LEAST_ODDS))) * F.col("n")
    odds: Model = {}
    for i, name in enumerate(("word", "gram")):
        known = counted.where((F.col("kind") == i) & (F.col("n") >= LEAST_KNOWN))
        if known.count() > MAX_KNOWN:
            known = known.orderBy(power.desc(), "key").limit(MAX_KNOWN)
        found = known.toArrow()
        keys = found.column("key").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        toxic, n = (found.column(c).to_numpy()[order] for c in ("toxic", "n"))
        value = np.log((toxic + shrink * share) / (n - toxic + shrink * (1 - share))) - usual
        odds[f"{name}_keys"] = keys[order]
        odds[f"{name}_odds"] = np.append(0, np.clip(value, LEAST_ODDS, MOST_ODDS)).astype(np.float32)
    return odds


def fit(docs: DataFrame, text: str = "text", label: str = "toxic", rows: int = FIT_DOCS) -> Model:
    """Train on about `rows` documents of each label, and FIT_WINDOWS windows of each: half of them those with the most telling words, the rest by hashes.

    The odds of words and n-grams are counted over all documents, whole texts.

    Rows without a label or text are left out. One label only gives a constant score.
    """
    small_batches(docs.sparkSession)
    docs = docs.where(F.col(label).isin(0, 1) & F.col(text).isNotNull()).select(text, label)
    odds = count_odds(docs, text, label)
    sizes = {r[label]: r["n"] for r in docs.groupBy(label).agg(F.count("*").alias("n")).collect()}
    share = F.lit(1.0)
    for k, n in sizes.items():
        most = rows if k else 3 * rows
        share = F.when(F.col(label) == k, min(1.0, most / n)).otherwise(share)
    blank = {k: np.zeros((len(odds[f"{k}_odds"]), EMBED), np.float32) for k in ("word", "gram")}
    counted = docs.sparkSession.sparkContext.broadcast(odds | blank)
    drawn = docs.where(F.pmod(F.xxhash64(text, F.lit(11)), F.lit(1 << 20)) < share * float(1 << 20))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in slices(batch.column(0)):
                found = words(part, ALNUM)
                whole = found.data.tobytes()
                inputs = Inputs(found)
                telling = inputs.vectors(counted.value)[:, -2:].max(axis=1, initial=LEAST_ODDS)[inputs.codes]
                pieces, owners = [], []
                for i, (a, b) in enumerate(zip(found.first[:-1], found.first[1:], strict=True)):
                    begins = np.arange(a, b, WINDOW)
                    if not len(begins):
                        continue
                    likely = np.argsort(-np.maximum.reduceat(telling[a:b], begins - a), kind="stable")
                    drawn = np.argsort(found.hashes[begins])
                    half = FIT_WINDOWS // 2
                    for s in begins[pd.unique(np.concatenate([likely[:half], drawn]))[:FIT_WINDOWS]]:
                        e = min(s + WINDOW, b)
                        pieces.append(b" ".join(whole[x:y] for x, y in zip(found.starts[s:e], found.ends[s:e], strict=True)).decode("utf-8", "replace"))
                        owners.append(i)
                text_keys = [hash_of(found, i) for i in owners]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(pieces, pa.string()),
                        batch.column(1).take(pa.array(np.array(owners, np.int64) + done)).cast(pa.int64()),
                        pa.array(text_keys, pa.int64()),
                    ],
                    ["window", "label", "owner"],
                )
                done += len(part)

    sample = drawn.mapInArrow(cut, "window string, label long, owner long").toArrow().to_pandas()
    sample = sample.sort_values(["owner", "window"], ignore_index=True)  # whatever the partitions
    owners, _ = pd.factorize(sample["owner"])
    return train(sample["window"].tolist(), sample["label"].to_numpy(), owners, odds)


def hash_of(found: Words, i: int) -> int:
    """A key of text i that only depends on its words."""
    own = found.hashes[found.first[i] : found.first[i + 1]]
    return int(np.add.reduce(own * np.uint64(0x9E3779B97F4A7C15)).view(np.int64))


def score_toxicity(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with score (0 to 1) and predicted (1 from `threshold` on); such columns are replaced.

    Null texts, and those without words, have score 0. Rows are never dropped or merged.
    """
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(score_texts(texts, held.value), pa.float64())

    own = [c for c in docs.columns if c not in ("score", "predicted")]
    return docs.select(*own, scored(F.col(text)).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
