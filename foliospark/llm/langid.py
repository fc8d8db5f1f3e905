"""The languages of a document as a mixture, fitted to it by expectation-maximisation.

Every word gets its likelihood under each known language from that language's
character n-grams. A document's language shares are those under which its words
are likeliest; the set of languages is the one whose likelihood, less a penalty
for each member, is highest,
grown from the likeliest language by one language at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.tables import numbered_column, numbered_columns, own_columns
from foliospark.llm.texts import ALNUM, flat, slices, small_batches

BUCKETS = 1 << 15
#: Documents per language that the n-gram counts are taken from, about; the model's one bound.
FIT_ROWS = 2000
ROUNDS = 12
PENALTY = 2.0
UNKNOWN = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_FOLD[~ALNUM] = 0x20
_FOLD[ord("0") : ord("9") + 1] = 0x20


class Model(NamedTuple):
    languages: list[str]
    log_likelihood: np.ndarray  # float32, a row per n-gram bucket, a column per language


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-gram buckets of all letters, where each word's begin, and each text's first word."""
    data, offsets = flat(texts)
    folded = _FOLD[data]
    # capitals of the Latin-1 block: second bytes 80 to 9E behind C3, but for the times sign
    upper = (folded[1:] >= 0x80) & (folded[1:] <= 0x9E) & (folded[1:] != 0x97) & (folded[:-1] == 0xC3)
    folded[1:][upper] += 32
    inside = folded != 0x20
    edges = offsets[1:-1][(offsets[1:-1] < len(data)) & (offsets[1:-1] > 0)]
    before, after = np.full_like(folded, 0x20), np.full_like(folded, 0x20)
    before[1:], after[:-1] = folded[:-1], folded[1:]
    before[edges], after[edges - 1] = 0x20, 0x20
    code = before.astype(np.uint32) << 16 | folded.astype(np.uint32) << 8 | after
    bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(17)
    starts = np.flatnonzero(inside & (before == 0x20))
    letters = np.flatnonzero(inside)
    return bucket[letters], np.searchsorted(letters, starts), np.searchsorted(starts, offsets)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", rows: int = FIT_ROWS) -> Model:
    """Count the n-grams of about `rows` documents of each language, chosen by a hash of the text.

    Rows without a language or text are left out. No rows give a model without languages.
    """
    small_batches(docs.sparkSession)
    docs = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[lang]: r["n"] for r in docs.groupBy(lang).agg(F.count("*").alias("n")).collect()}
    known = sorted(sizes)
    if not known:
        return Model([], np.zeros((BUCKETS, 0), np.float32))
    share = F.create_map(*[F.lit(x) for k in known for x in (k, min(1.0, rows / sizes[k]))])
    drawn = F.pmod(F.xxhash64(text, F.lit(7)), F.lit(1 << 20)) < share[F.col(lang)] * float(1 << 20)
    index = {k: i for i, k in enumerate(known)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(known), BUCKETS), np.int64)
        for batch in batches:
            names = np.array([index[x] for x in batch.column(1).to_pylist()], np.int64)
            done = 0
            for part in slices(batch.column(0)):
                grams, starts, first = _grams(part)
                per_text = np.diff(np.append(starts, len(grams))[first])
                own = np.repeat(names[done : done + len(part)], per_text)
                sums += np.bincount(own * BUCKETS + grams, minlength=sums.size).reshape(sums.shape)
                done += len(part)
        at, bucket = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(bucket), pa.array(sums[at, bucket])], ["l", "b", "c"]
        )

    counted = (
        docs.where(drawn)
        .select(text, lang)
        .mapInArrow(count, "l long, b long, c long")
        .groupBy("l", "b")
        .agg(F.sum("c").alias("c"))
        .toArrow()
    )
    sums = np.full((BUCKETS, len(known)), 0.5)
    sums[counted.column("b").to_numpy(), counted.column("l").to_numpy()] += counted.column("c").to_numpy()
    return Model(known, np.log(sums / sums.sum(axis=0)).astype(np.float32))


def _mixture(likely: np.ndarray, at: np.ndarray, own: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares and log-likelihood of each document by expectation-maximisation.

    likely: words by languages; at: each document's first word; own: each word's
    document; allowed: documents by languages.
    """
    shares = allowed / allowed.sum(axis=1, keepdims=True)
    n = np.diff(np.append(at, len(likely)))[:, None]
    for _ in range(ROUNDS):
        weighted = shares[own] * likely
        total = np.maximum(weighted.sum(axis=1, keepdims=True), 1e-30)
        shares = np.add.reduceat(weighted / total, at, axis=0) / n
    total = np.maximum((shares[own] * likely).sum(axis=1), 1e-30)
    return shares, np.add.reduceat(np.log(total), at)


def _places(at: np.ndarray, n: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of some documents, where each one's begin among them, and whose each is."""
    begin = np.cumsum(n[docs]) - n[docs]
    part = np.repeat(np.arange(len(docs)), n[docs])
    return np.arange(len(part)) + (at[docs] - begin)[part], begin, part


def _can_gain(
    logs: np.ndarray, likely: np.ndarray, at: np.ndarray, n: np.ndarray, docs: np.ndarray,
    shares: np.ndarray, value: np.ndarray, j: int, penalty: np.ndarray,
) -> np.ndarray:
    """Whether language j could gain a document more than the penalty.

    No mixture of a set is likelier than the best of its members at every word.
    """
    if not len(docs):
        return np.zeros(0, bool)
    chosen, begin, part = _places(at, n, docs)
    allowed = shares[docs] > 0
    allowed[:, j] = True
    bound = np.add.reduceat(np.where(allowed[part], logs[chosen], -np.inf).max(axis=1), begin)
    return bound - value[docs] > penalty[docs]


def mixtures(texts: pa.Array, model: Model) -> list[tuple[str, float, list[str], list[float]]]:
    """Of each text: language, its share, the languages chosen, and their shares."""
    return [row[:4] for row in explained(texts, model)]


def explained(texts: pa.Array, model: Model) -> list[tuple[str, float, list[str], list[float], float]]:
    """As `mixtures`, and how much likelier than under the background model an n-gram is, as a logarithm.

    The background model gives all n-gram buckets the same likelihood.
    """
    grams, starts, first = _grams(texts)
    out = [(UNKNOWN, 0.0, [], [], 0.0) for _ in range(len(texts))]
    n = np.diff(first)
    some = np.flatnonzero(n)
    if not len(some) or not model.languages:
        return out
    logs = np.add.reduceat(model.log_likelihood[grams], starts, axis=0)
    highest = logs.max(axis=1)
    logs -= highest[:, None]
    likely = np.exp(np.maximum(logs, -60)).astype(np.float32)
    own = np.repeat(np.arange(len(some)), n[some])
    at = first[some]
    k = len(model.languages)
    full, _ = _mixture(likely, at, own, np.ones((len(some), k), np.float32))
    order = np.argsort(-full, axis=1, kind="stable")
    top = order[:, 0]
    shares = np.zeros_like(full)
    shares[np.arange(len(some)), top] = 1
    penalty = PENALTY * np.log(n[some] + 1.0)
    logs = np.maximum(logs, -60)
    value = np.add.reduceat(logs[np.arange(len(own)), top[own]], at)
    going = np.arange(len(some))
    for m in range(2, k + 1):
        # One more language for each document whose set has just grown: the best that pays.
        least, best, grown = value[going] + penalty[going], value[going].copy(), shares[going]
        paid = np.zeros(len(going), bool)
        for j in range(k):
            trial = np.flatnonzero(shares[going, j] == 0)
            trial = trial[_can_gain(logs, likely, at, n[some], going[trial], shares, value, j, penalty)]
            if not len(trial):
                continue
            docs = going[trial]
            chosen, begin, part = _places(at, n[some], docs)
            allowed = (shares[docs] > 0).astype(np.float32)
            allowed[:, j] = 1
            columns = np.argsort(-allowed, axis=1, kind="stable")[:, :m]
            found, total = _mixture(
                np.take_along_axis(likely[chosen], columns[part], axis=1), begin, part, np.ones((len(docs), m), np.float32)
            )
            better = (total > least[trial]) & (total > best[trial])
            paid[trial[better]], best[trial[better]] = True, total[better]
            wide = np.zeros((len(docs), k), np.float32)
            np.put_along_axis(wide, columns, found, axis=1)
            grown[trial[better]] = wide[better]
        going, best, grown = going[paid], best[paid], grown[paid]
        shares[going], value[going] = grown, best
        if not len(going):
            break
    per_word = np.diff(np.append(starts, len(grams)))
    above = (value + np.add.reduceat(highest, at, dtype=np.float64)) / np.add.reduceat(per_word, at) + np.log(BUCKETS)
    for i, row in enumerate(some):
        members = [j for j in np.argsort(-shares[i], kind="stable") if shares[i, j] > 0]
        lead = members[0]
        out[row] = (
            model.languages[lead],
            float(min(1.0, max(0.0, full[i, lead]))),
            [model.languages[j] for j in members],
            [float(shares[i, j]) for j in members],
            float(above[i]),
        )
    return out


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with lang_pred, score, languages, shares and gain; columns of these names are replaced.

    score is the share of lang_pred in the mixture of all known languages; languages
    and shares are those of the chosen set; gain is the logarithm of how much likelier
    an n-gram is under that set than under a background model of equally likely
    n-grams, so a text of no known language has a gain below 0. A text that is null or has no letter, and
    every text if no language was learned, is `und` with score 0. Rows are never
    dropped or merged.
    """
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = ["lang_pred", "score", "languages", "shares", "gain"]

    @F.arrow_udf("struct<lang_pred: string, score: double, languages: array<string>, shares: array<double>, gain: double>")
    def found(texts: pa.Array) -> pa.Array:
        rows = []
        for part in slices(texts):
            letters = (any(map(str.isalpha, t)) for t in part.to_pylist())
            mixed = explained(part, held.value)
            rows += [r if has else (UNKNOWN, 0.0, [], [], 0.0) for r, has in zip(mixed, letters, strict=True)]
        kinds = [pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.float64()), pa.float64()]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        return pa.StructArray.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names,
        )

    plain = numbered_columns(docs)
    scored = plain.select("*", found(F.col(numbered_column(docs, text))).alias("found"))
    return own_columns(scored.select(*plain.columns, "found.*"), docs, names)
