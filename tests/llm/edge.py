"""Rows that every operator must take: nulls, empty and long texts, repeats, clashing names."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names the operators use for their own columns
    "score double, row long, k long, n_words long, kept_text string, _text string, piece int, "
    "_t string, _t1 string, _found string, _dropped string, _lines string, _key string, _at int, "
    "found string, gain double, n_lines long, in0 string"
)


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def rows() -> list[tuple]:
    base = prose(1, 60)
    texts = [
        None, "", " \t\n ", "\n\n", "123 456", "one two", "Straße ÉCOLE naïve 中文", base, base,
        base.replace(base.split()[5], "changed"), base.upper(), prose(2, 60), prose(3, 6000),
        "same line\n" + prose(4, 20), " SAME LINE \n" + prose(5, 20) + "\n\nend",
        "a b c d e f g a b c d e f g a b c d e", "x <|endoftext|> y", "İ Σ ς \x1c\x85 z",
        "under the GNU General Public License version 3 or the MIT license, CC-BY 4.0",
    ]
    out = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    out += [out[7], out[7], (None, base, None, None, None), (None, None, None, None, None), out[0]]
    out += [(100 + i, f"same line\n{prose(50 + i, 30)}", "de", "hot", 1) for i in range(12)]
    extra = ("t", "t1", "found", "dropped", "lines", "key", 5, "found it", 0.25, 6, "in")
    return [(*r, 0.5, 7, 8, 9, "mine", "mine", 3, *extra) for r in out]


def kept_columns(out, replaced):
    """The rows of all columns but the replaced ones, to be compared with `kept_rows`."""
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    return sorted(repr([r[n] for n in names if n not in replaced]) for r in out)


def kept_rows(replaced):
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    return sorted(repr([v for n, v in zip(names, r, strict=True) if n not in replaced]) for r in rows())


def frame(spark, empty: bool = False):
    return spark.createDataFrame([] if empty else rows(), SCHEMA)


def vector_rows() -> list[tuple]:
    """Copies by the dozen, ties, unusable vectors, another length, repeated rows."""
    rng = random.Random(8)
    out = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(120)]
    out += [(1000 + i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(40)]
    out += [(2000 + i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0 + 0.5 * (-1) ** i]) for i in range(40)]
    out += [(5000, [0.0] * 6), (5100, None), (5200, []), (5300, [1.0, None, 0.0, 0.0, 0.0, 0.0])]
    out += [(5400, [float("nan")] * 6), (5500, [float("inf")] + [0.0] * 5), (None, [1.0] * 6)]
    out += [(6000, [1.0, 2.0]), (6001, [1.0, 2.5]), (6002, [-0.0, 1.0]), out[0], out[0], out[125]]
    return out


def vectors(spark, empty: bool = False):
    rows = [] if empty else [(i, v, 1) for i, v in vector_rows()]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")


def items(spark, empty: bool = False):
    texts = [None, "", "same line", prose(1, 60), "GNU General Public License", "x", prose(1, 60), "straße É"]
    rows = [] if empty else [(i, t, 1.0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "item_id long, text string, score double")
