"""Token counts of a word-level BPE tokenizer by a cascade of two deterministic transducers.

The first reads a text's characters and marks where the pre-tokenizer's words begin.
It has a handful of states, so a chunk of text is a map from the state before to the
state after; chunks are read side by side, their maps are composed by a parallel
prefix scan, and then each chunk is read once more from its true first state.

The second reads the symbols of a word, and each of its transitions carries the
number of tokens it adds. Its states come from the merges: the BPE of a text is the
only split into tokens of which every neighbouring pair stays as it is when merged
by itself, so after each symbol the last token is known from the last tokens at the
places where a token could still begin. States and transitions are compiled when a
text first needs them.
"""

from __future__ import annotations

import json
import unicodedata
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.packing import byte_characters
from foliospark.llm.texts import run_hashes, slices, small_batches

CHUNK = 64
#: Words whose counts, and states with their transitions, that a Python worker remembers at most.
WORDS, STATES = 300_000, 250_000

# Classes of characters: the letters of contractions apart, upper case never occurs.
SPACE, LETTER, NUMBER, OTHER, QUOTE = range(5)
SINGLE, R, V, L_, E = range(5, 10)  # s t m d; then r, v, l, e
CLASSES = 10
# States of the first transducer.
FREE, IN_LETTERS, IN_OTHER, AFTER_QUOTE, QUOTE_R, QUOTE_V, QUOTE_L = range(7)
STATES_1 = 7
# What a transition says about word starts: here, and at the character before.
HERE, BEFORE = 1, 2


def _segmenter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and starts by state and class, for the fixed pattern of the tokenizer.

    's|'t|'re|'ve|'m|'ll|'d|letters|one number|others: a contraction only counts where
    a word begins, and text goes on as if freshly begun behind it and behind a number.
    """
    to = np.zeros((STATES_1, CLASSES), np.uint8)
    says = np.zeros((STATES_1, CLASSES), np.uint8)
    letters = [LETTER, SINGLE, R, V, L_, E]
    for state in range(STATES_1):
        for c in range(CLASSES):
            if c == SPACE:
                to[state, c] = FREE
            elif c == NUMBER:
                to[state, c], says[state, c] = FREE, HERE
            elif c in letters:
                to[state, c] = IN_LETTERS
                says[state, c] = 0 if state == IN_LETTERS else HERE
            else:  # a quote goes on with other characters or begins a word
                to[state, c] = IN_OTHER
                says[state, c] = 0 if state in (IN_OTHER, AFTER_QUOTE) else HERE
                if c == QUOTE and says[state, c]:
                    to[state, c] = AFTER_QUOTE
    to[AFTER_QUOTE, SINGLE], says[AFTER_QUOTE, SINGLE] = FREE, 0
    for c, state in ((R, QUOTE_R), (V, QUOTE_V), (L_, QUOTE_L)):
        to[AFTER_QUOTE, c], says[AFTER_QUOTE, c] = state, 0
    for state, last in ((QUOTE_R, E), (QUOTE_V, E), (QUOTE_L, L_)):
        # no contraction after all: the letter before began a word
        for c in range(CLASSES):
            if c == last:
                to[state, c], says[state, c] = FREE, 0
            elif c in letters:
                to[state, c], says[state, c] = IN_LETTERS, BEFORE
            else:
                says[state, c] = says[FREE, c] | BEFORE
                to[state, c] = to[FREE, c]
    return to, says


_TO, _SAYS = _segmenter()
_class_of: list[np.ndarray] = []


def _classes() -> np.ndarray:
    """The class of every code point, built once."""
    if not _class_of:
        kinds = {"L": LETTER, "N": NUMBER}
        table = np.array(
            [kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8
        )
        # White space as Unicode has it.
        spaces = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
        table[[*spaces, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
        table[[ord(c) for c in "stmd"]] = SINGLE
        for c, kind in (("'", QUOTE), ("r", R), ("v", V), ("l", L_), ("e", E)):
            table[ord(c)] = kind
        _class_of.append(table)
    return _class_of[0]


def word_spans(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of the pre-tokenizer begin and end in an array of code points."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kinds = np.full(-(-n // CHUNK) * CHUNK, SPACE, np.uint8)
    kinds[:n] = _classes()[points]
    columns = np.ascontiguousarray(kinds.reshape(-1, CHUNK).T)
    # Each chunk's map: the state after it for every state before it.
    maps = np.tile(np.arange(STATES_1, dtype=np.uint8), (columns.shape[1], 1))
    to, says = _TO.ravel(), _SAYS.ravel()
    for column in columns:
        maps = to[maps * np.uint8(CLASSES) + column[:, None]]
    # Prefix scan: after the step of width w, a map covers its chunk and 2 w - 1 before.
    width = 1
    while width < len(maps):
        maps[width:] = np.take_along_axis(maps[width:], maps[:-width].copy(), axis=1)
        width *= 2
    state = np.zeros(len(maps), np.uint8)
    state[1:] = maps[:-1, FREE]
    told = np.empty_like(columns)
    for i, column in enumerate(columns):
        step = state * np.uint8(CLASSES) + column
        told[i] = says[step]
        state = to[step]
    told = told.T.ravel()
    begins = (told & HERE).astype(bool)
    begins[:-1] |= (told[1:] & BEFORE).astype(bool)
    starts = np.flatnonzero(begins[:n])
    spaces = np.append(np.flatnonzero(kinds[:n] == SPACE), n)
    return starts, np.minimum(np.append(starts[1:], n), spaces[np.searchsorted(spaces, starts)])


class _Merges(NamedTuple):
    rank: dict[int, int]  # of the merge of two ids, at first * 2^20 + second
    halves: dict[int, tuple[int, int]]  # the two ids that an id is merged from
    born: dict[int, int]  # the rank of that merge; symbols have -1
    child: dict[int, int]  # trie of the tokens: node * 512 + symbol
    token: dict[int, int]  # node: id
    inner: set[int]  # nodes from which a longer token can be reached


def _merges(path: str) -> _Merges:
    """Symbols are the 256 bytes, and 256 more for bytes at the end of a word."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    vocab, suffix = model["vocab"], model["end_of_word_suffix"]
    byte = byte_characters()
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    rank, halves, born = {}, {}, dict.fromkeys(vocab.values(), -1)
    for i, (a, b) in enumerate(pairs):
        rank[vocab[a] << 20 | vocab[b]] = i
        halves[vocab[a + b]] = vocab[a], vocab[b]
        born[vocab[a + b]] = i
    child: dict[int, int] = {}
    token: dict[int, int] = {}
    for text, i in vocab.items():
        symbols = [byte[c] for c in text.removesuffix(suffix)]
        if text.endswith(suffix) and symbols:
            symbols[-1] += 256
        node = 0
        for s in symbols:
            node = child.setdefault(node * 512 + s, len(child) + 1)
        token[node] = i
    return _Merges(rank, halves, born, child, token, {key >> 9 for key in child})


class Transducer:
    """Counts the tokens of words by transitions compiled on demand.

    A state lists the places where a longer token could have begun, as (node of the
    trie reached from there, last token before it, tokens before it less all so far).
    """

    def __init__(self, path: str):
        self.merges = _merges(path)
        self.edges: dict[int, tuple[list, list]] = {}
        self.words: dict[int, int] = {}
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[tuple, int] = {((0, -1, 0),): 0}
        self.states: list[tuple] = [((0, -1, 0),)]
        self.steps: dict[int, int] = {}  # state * 512 + symbol: next state * 64 + tokens added + 32
        self.pairs: dict[int, bool] = {}

    def _edges(self, token: int) -> tuple[list, list]:
        """What stands at the right and the left edge while the token is merged, and until which rank."""
        known = self.edges.get(token)
        if known is None:
            known = self.edges[token] = [], []
            for side, out in zip((1, 0), known, strict=True):
                part, until = token, 1 << 30
                while part is not None:
                    out.append((part, until))
                    until = self.merges.born[part]
                    part = self.merges.halves[part][side] if part in self.merges.halves else None
        return known

    def _neighbours(self, a: int, b: int) -> bool:
        """Whether the two tokens stay apart when their text is merged by itself.

        A merge across the border happens if its rank comes up while both of its
        sides stand at the border; of equal ranks the left one goes first.
        """
        if a < 0:
            return True
        key = a << 20 | b
        known = self.pairs.get(key)
        if known is None:
            rank, left = self.merges.rank, self._edges(b)[1]
            known = self.pairs[key] = not any(
                (r := rank.get(u << 20 | v, 1 << 30)) < u_until and r <= v_until
                for u, u_until in self._edges(a)[0]
                for v, v_until in left
                if u << 20 | v in rank
            )
        return known

    def _compile(self, state: int, symbol: int) -> int:
        child, token, inner = self.merges.child, self.merges.token, self.merges.inner
        alive, last = [], []
        for node, before, count in self.states[state]:
            at = child.get(node * 512 + symbol)
            if at is not None:
                if at in inner:
                    alive.append((at, before, count))
                if at in token and self._neighbours(before, token[at]):
                    last.append((token[at], count + 1))
        if len(last) != 1:
            raise ValueError("the tokenizer's merges are no proper BPE")
        found, adds = last[0]
        after = (*((at, before, count - adds) for at, before, count in alive), (0, found, 0))
        number = self.numbers.setdefault(after, len(self.states))
        if number == len(self.states):
            self.states.append(after)
        step = self.steps[state * 512 + symbol] = number * 64 + adds + 32
        return step

    def count(self, word: str) -> int:
        """Tokens of a word: the sum of what the transitions add."""
        if len(self.states) > STATES:
            self._forget()
        symbols = [*word.encode("utf-8", "replace")]
        symbols[-1] += 256
        state, total, steps = 0, -32 * len(symbols), self.steps
        for s in symbols:
            step = steps.get(state * 512 + s)
            if step is None:
                step = self._compile(state, s)
            state = step >> 6
            total += step & 63
        return total


_transducers: dict[str, tuple[Transducer, list[str]]] = {}


def _normal(text: str) -> str:
    """As the tokenizer does: composed, then lower case, character by character.

    Kinds of white space need no step of their own, as white space only separates.
    """
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def count_tokens(texts: list[str], path: str) -> list[int]:
    """The number of tokens of each text, special strings being one token each."""
    if path not in _transducers:
        with open(path, encoding="utf-8") as file:
            special = [t["content"] for t in json.load(file)["added_tokens"]]
        _transducers[path] = Transducer(path), special
    machine, special = _transducers[path]
    counts = [0] * len(texts)
    parts: list[str] = []
    owner: list[int] = []
    for i, text in enumerate(texts):
        pieces = [text]
        for s in special:
            if s in text:
                pieces = [x for p in pieces for x in p.split(s)]
        counts[i] += len(pieces) - 1
        parts += map(_normal, pieces)
        owner += [i] * len(pieces)
    joined = "\n".join(parts)  # a line feed keeps the words of two parts apart
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts, ends = word_spans(points)
    part = np.searchsorted(np.cumsum([len(p) + 1 for p in parts]), starts, "right")
    codes, distinct = pd.factorize(run_hashes(points, starts, ends))
    at = np.zeros(len(distinct), np.int64)
    at[codes[::-1]] = np.arange(len(codes))[::-1]  # where each distinct word stands first
    if len(machine.words) > WORDS:
        machine.words.clear()
    words, each = machine.words, []
    for key, a, b in zip(distinct.tolist(), starts[at].tolist(), ends[at].tolist(), strict=True):
        n = words.get(key)
        if n is None:
            n = words[key] = machine.count(joined[a:b])
        each.append(n)
    totals = np.bincount(part, np.array(each, np.int64)[codes], minlength=len(parts))
    for i, n in zip(owner, totals.astype(np.int64).tolist(), strict=True):
        counts[i] += n
    return counts


def with_token_counts(docs: DataFrame, tokenizer: str, text: str = "text", limit: int = 2048) -> DataFrame:
    """`docs` with n_bytes, n_tokens (long) and over_limit; columns of these names are replaced.

    Counts are those of the tokenizer file without added tokens at the ends; a null
    text is an empty one, with no tokens. Rows are never dropped or merged.
    """
    small_batches(docs.sparkSession)

    @F.arrow_udf("long")
    def counted(texts: pa.Array) -> pa.Array:
        out: list[int] = []
        for part in slices(texts):
            out += count_tokens(part.to_pylist(), tokenizer)
        return pa.array(out, pa.int64())

    own = [c for c in docs.columns if c not in ("n_bytes", "n_tokens", "over_limit")]
    return docs.select(
        *own,
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        counted(F.col(text)).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
