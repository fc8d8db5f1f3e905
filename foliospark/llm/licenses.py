"""Licence mentions by ordered signature rules.

A rule has a priority, a label, keywords and a regular expression over the text's
words joined by single spaces. Keywords are looked for first, so that the
expressions run on few texts only. A detection inside the interval of one of a
better priority is suppressed. Base phrases are rules that nothing suppresses.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.tables import numbered_column, numbered_columns, own_columns
from foliospark.llm.texts import ALNUM, slices, small_batches, words


class Rule(NamedTuple):
    priority: int
    label: str
    confidence: float
    keywords: tuple[bytes, ...]
    pattern: re.Pattern


# Phrases of consecutive words, and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_V = "(?: ?v| version| v version)?"
#: Names: label, keywords, expression of the name; {n} stands for each of the versions.
_NAMES: list[tuple[str, str, str, list[str]]] = [
    ("apache-{}", "apache", f"apache(?: software)? license{_V} ?{{n}}", ["1.0", "1.1", "2.0"]),
    ("mit", "mit", "(?:mit|expat) licen[cs]e", []),
    ("mit-0", "mit", "mit no attribution(?: licen[cs]e)?", []),
    ("x11", "x11", "x11 licen[cs]e", []),
    ("bsd-{}-clause", "bsd", "(?:bsd {n} clause|{n} clause bsd)(?: licen[cs]e)?", ["0", "1", "2", "3", "4"]),
    ("bsd", "bsd", "(?:new |modified |simplified |original )?bsd licen[cs]e", []),
    ("isc", "isc", "isc licen[cs]e", []),
    ("gpl-{}", "gnu", f"gnu general public licen[cs]e{_V} ?{{n}}", ["1.0", "2.0", "3.0"]),
    ("gpl-{}", "gpl", f"gpl(?: licen[cs]e)?{_V} ?{{n}}", ["1.0", "2.0", "3.0"]),
    ("lgpl-{}", "gnu", f"gnu (?:lesser|library) general public licen[cs]e{_V} ?{{n}}", ["2.0", "2.1", "3.0"]),
    ("lgpl-{}", "lgpl", f"lgpl{_V} ?{{n}}", ["2.0", "2.1", "3.0"]),
    ("agpl-{}", "affero", f"(?:gnu )?affero general public licen[cs]e{_V} ?{{n}}", ["1.0", "3.0"]),
    ("agpl-{}", "agpl", f"agpl{_V} ?{{n}}", ["1.0", "3.0"]),
    ("gfdl-{}", "documentation", f"gnu free documentation licen[cs]e{_V} ?{{n}}", ["1.1", "1.2", "1.3"]),
    ("mpl-{}", "mozilla", f"mozilla public licen[cs]e{_V} ?{{n}}", ["1.0", "1.1", "2.0"]),
    ("mpl-{}", "mpl", f"mpl{_V} ?{{n}}", ["1.0", "1.1", "2.0"]),
    ("epl-{}", "eclipse", f"eclipse public licen[cs]e{_V} ?{{n}}", ["1.0", "2.0"]),
    ("eupl-{}", "european", f"european union public licen[cs]e{_V} ?{{n}}", ["1.0", "1.1", "1.2"]),
    ("cddl-{}", "common", f"common development and distribution licen[cs]e{_V} ?{{n}}", ["1.0", "1.1"]),
    ("cpl-1.0", "common", "common public licen[cs]e", []),
    ("artistic-{}", "artistic", f"artistic licen[cs]e{_V} ?{{n}}", ["1.0", "2.0"]),
    ("afl-{}", "academic", f"academic free licen[cs]e{_V} ?{{n}}", ["1.1", "2.0", "2.1", "3.0"]),
    ("osl-{}", "open", f"open software licen[cs]e{_V} ?{{n}}", ["1.0", "2.0", "2.1", "3.0"]),
    ("ofl-{}", "sil", f"sil open font licen[cs]e{_V} ?{{n}}", ["1.0", "1.1"]),
    ("odbl-1.0", "open", "open (?:data commons open )?database licen[cs]e", []),
    ("odc-by-1.0", "commons", "open data commons attribution licen[cs]e", []),
    ("pddl-1.0", "commons", "open data commons public domain dedication and licen[cs]e", []),
    ("boost-1.0", "boost", "boost software licen[cs]e", []),
    ("zlib", "zlib", "zlib(?: libpng)? licen[cs]e", []),
    ("unlicense", "unlicense", "(?:the )?unlicense", []),
    ("wtfpl", "what", "do what the [a-z]+ you want to public licen[cs]e", []),
    ("cc0-1.0", "cc0", f"cc0{_V}(?: 1 0)?(?: universal)?", []),
    ("cc0-1.0", "commons", "creative commons zero", []),
    ("psf-2.0", "python", "(?:python software foundation|psf) licen[cs]e", []),
    ("ruby", "ruby", "ruby licen[cs]e", []),
    ("php-3.0", "php", "php licen[cs]e", []),
    ("openssl", "openssl", "openssl licen[cs]e", []),
    ("postgresql", "postgresql", "postgresql licen[cs]e", []),
    ("ms-pl", "microsoft", "microsoft public licen[cs]e", []),
    ("ms-rl", "microsoft", "microsoft reciprocal licen[cs]e", []),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)? licen[cs]e", []),
    ("w3c", "w3c", "w3c software(?: notice and)? licen[cs]e", []),
    ("vim", "vim", "vim licen[cs]e", []),
    ("sleepycat", "sleepycat", "sleepycat licen[cs]e", []),
    ("qpl-1.0", "public", "q public licen[cs]e", []),
    ("public-domain", "domain", "(?:in|into|to) the public domain", []),
]
#: Short forms, only with a version: label, keywords, expression of the name, versions.
_SHORT: list[tuple[str, str, str, list[str]]] = [
    ("apache-{}", "apache", f"apache(?: software)?{_V} ?{{n}}", ["1.1", "2.0"]),
    ("apache-{}", "asl", f"asl{_V} ?{{n}}", ["1.1", "2.0"]),
    ("gpl-{}", "gnu", f"gnu gpl{_V} ?{{n}}", ["1.0", "2.0", "3.0"]),
    ("gfdl-{}", "gfdl", f"gfdl{_V} ?{{n}}", ["1.1", "1.2", "1.3"]),
    ("epl-{}", "epl", f"epl{_V} ?{{n}}", ["1.0", "2.0"]),
    ("eupl-{}", "eupl", f"eupl{_V} ?{{n}}", ["1.0", "1.1", "1.2"]),
    ("cddl-{}", "cddl", f"cddl{_V} ?{{n}}", ["1.0", "1.1"]),
    ("osl-{}", "osl", f"osl{_V} ?{{n}}", ["1.0", "2.0", "2.1", "3.0"]),
    ("ofl-{}", "ofl", f"ofl{_V} ?{{n}}", ["1.0", "1.1"]),
    ("odbl-{}", "odbl", f"odbl{_V} ?{{n}}", ["1.0"]),
    ("boost-{}", "bsl", f"bsl{_V} ?{{n}}", ["1.0"]),
]
_CC = {"by": "attribution", "by-sa": "attribution share ?alike", "by-nd": "attribution no ?deriv(?:ative)?s(?: works)?",
       "by-nc": "attribution non ?commercial", "by-nc-sa": "attribution non ?commercial share ?alike",
       "by-nc-nd": "attribution non ?commercial no ?deriv(?:ative)?s(?: works)?"}
_CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
#: Sentences of the licences themselves: label, keywords, expression. All keywords stand in the
#: expression, but for `apache`: other licences have its sentence too.
_TEXTS = [
    ("mit", "permission granted", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission purpose", "permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution binary", "redistribution and use in source and binary forms with or without modification"),
    ("bsd-3-clause", "endorse contributors", "neither the name of .{1,80}? nor the names of its contributors may be used to endorse"),
    ("bsd-4-clause", "advertising features", "all advertising materials mentioning features or use of this software"),
    ("apache-2.0", "apache compliance", "you may not use this file except in compliance with the licen[cs]e"),
    ("gpl", "redistribute gnu", "you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
    ("lgpl", "redistribute lesser", "you can redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e"),
    ("agpl", "redistribute affero", "you can redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e"),
    ("gpl", "free foundation", "published by the free software foundation"),
    ("mpl-2.0", "mozilla subject", "this source code form is subject to the terms of the mozilla public licen[cs]e"),
    ("unlicense", "unencumbered domain", "this is free and unencumbered software released into the public domain"),
    ("zlib", "altered plainly", "altered source versions must be plainly marked as such"),
    ("boost-1.0", "boost distributed", "distributed under the boost software licen[cs]e"),
    ("public-domain", "domain dedicated", "dedicated to the public domain"),
    ("proprietary", "rights reserved", "all rights reserved"),
    ("proprietary", "proprietary confidential", "proprietary and confidential"),
]
#: SPDX identifiers: those that are not their label, labels that are none, and those of no name above.
_SPDX = {"bsd-0-clause": "0bsd", "boost-1.0": "bsl-1.0"}
_NO_SPDX = {"bsd", "public-domain"}
_MORE_SPDX = """
    aal apsl-2.0 beerware blueoak-1.0.0 bsd-2-clause-patent bsd-3-clause-clear bsd-4-clause-uc busl-1.1
    bzip2-1.0.6 cc-pddc cecill-2.1 cecill-b cecill-c curl ecl-2.0 elastic-2.0 ftl hpnd ijg info-zip ipl-1.0 json
    libpng libpng-2.0 lppl-1.3c mit-cmu mpl-2.0-no-copyleft-exception mulanpsl-2.0 ntp php-3.01 python-2.0
    rpl-1.5 sspl-1.0 tcl unicode-3.0 unicode-dfs-2016 upl-1.0 zpl-2.1
""".split()
_WITH = "(?: with (?:linux syscall note|(?:[a-z0-9]+ ){1,5}?exception(?: [0-9]+)*))?"
#: Ways to name a licence, best first: confidence, keywords, what stands before the name.
_FORMS = [
    (0.9, "under", "(?:licen[cs]ed|released|distributed|available|provided|published|made available) under (?:the )?(?:terms of )?(?:the )?"),
    (0.8, "terms", "(?:subject to|under) the (?:terms|conditions)(?: and conditions)? of (?:the )?"),
    (0.6, "", ""),
]


_OPTIONAL = re.compile(r"\(\?:[^()]*\)\?")


def _rule(priority: int, label: str, confidence: float, keywords: str, pattern: str) -> Rule:
    if "licen" in _OPTIONAL.sub("", pattern):
        keywords += " licen"
    found = re.compile(rb"(?<!\S)(?:" + pattern.encode() + rb")(?!\S)")
    return Rule(priority, label, confidence, tuple(k.encode() for k in keywords.split()), found)


def _named() -> list[tuple[str, str, str]]:
    """Label, keywords and expression of every name in every version; longer names first."""
    out = []
    for label, keywords, pattern, versions in _NAMES:
        for v in versions:
            digits = v.replace(".0", r"(?: 0)?(?! \d)").replace(".", " ")
            out.append((label.format(v), keywords, pattern.replace("{n}", digits)))
        bare = pattern.removesuffix(f"{_V} ?{{n}}")
        if not versions or bare != pattern:
            out.append((label.removesuffix("-{}"), keywords, bare))
    for label, keywords, pattern, versions in _SHORT:
        for v in versions:
            out.append((label.format(v), keywords, pattern.replace("{n}", v.replace(".", " ") + r"(?! \d)")))
    for code, name in reversed(_CC.items()):
        short = f"cc {code.replace('-', ' ')}"
        for v in _CC_VERSIONS:
            digits = v.replace(".", " ")
            out.append((f"cc-{code}-{v}", "cc by", f"{short}(?: v)? ?{digits}"))
            out.append((f"cc-{code}-{v}", "commons", f"creative commons {name}(?: {digits}| [a-z ]{{0,40}}{digits})"))
        if code != "by":
            out.append((f"cc-{code}", "cc by", short))
        out.append((f"cc-{code}", "commons", f"creative commons {name}"))
    return out


def _identified() -> list[tuple[str, str]]:
    """Label and expression of every SPDX identifier in an expression of several; longer ones first.

    A detection begins with the identifier itself, so no part of the expression hides another.
    """
    versioned = {label for label, _, _ in _named() if re.search(r"\d\.\d|clause", label)}
    plain = {label for label, _, _, versions in _NAMES if not versions} - _NO_SPDX
    ids = {label: _SPDX.get(label, label) for label in versioned | plain} | {x: x for x in _MORE_SPDX}
    spelled = {label: re.sub("[-.]", " ", x) + "(?: only| or later)?" for label, x in ids.items()}
    order = sorted(spelled, key=lambda label: (-len(spelled[label]), label))
    some = "(?:" + "|".join(spelled[label] for label in order) + ")" + _WITH
    return [(label, f"spdx licen[cs]e identifier (?:{some} (?:or|and) )*?({spelled[label]})") for label in order]


def rules() -> list[Rule]:
    """All rules in the order of their priority."""
    out = [_rule(0, label, 0.95, keys, pattern) for label, keys, pattern in _TEXTS]
    for label, pattern in _identified():
        out.append(_rule(len(out), label, 1.0, "spdx identifier", pattern))
    for confidence, more, before in _FORMS:
        for label, keys, name in _named():
            out.append((_rule(len(out), label, confidence, f"{keys} {more}".strip(), before + name)))
    return out


def detections(joined: bytes, ruled: list[Rule]) -> list[tuple[int, int, str, float]]:
    """What the rules find in joined words, less what lies inside a detection of better priority.

    A detection inside a suppressed one lies inside what suppressed that, so all detections
    of better priority count, kept or not. Of equal intervals of one priority the first rule's stays.
    """
    by_priority: dict[int, list[tuple[int, int, str, float]]] = {}
    for rule in ruled:
        if all(k in joined for k in rule.keywords):
            for m in rule.pattern.finditer(joined):
                one = (m.start(m.lastindex or 0), m.end(), rule.label, rule.confidence)
                by_priority.setdefault(rule.priority, []).append(one)
    kept: list[tuple[int, int, str, float]] = []
    # Starts of all detections of better priority, in order, and the furthest end up to each.
    begins, reach = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for priority in sorted(by_priority):
        group = sorted(by_priority[priority], key=lambda d: (d[0], -d[1]))
        starts, ends = np.array([d[:2] for d in group], np.int64).T
        at = np.searchsorted(begins, starts, side="right")
        covered = np.append(reach, -1)[at - 1] if len(begins) else np.full(len(group), -1)
        covered[at == 0] = -1
        # The longer ones of the same priority stand before those inside them.
        covered[1:] = np.maximum(covered[1:], np.maximum.accumulate(ends)[:-1])
        kept += [d for d, inside in zip(group, covered >= ends, strict=True) if not inside]
        begins, reach = np.append(begins, starts), np.append(reach, ends)
        order = np.argsort(begins, kind="stable")
        begins, reach = begins[order], np.maximum.accumulate(reach[order])
    return sorted(kept)


def scan(text: bytes, ruled: list[Rule]) -> tuple[list[int], set[str], set[str], float]:
    """Starts of the base phrases (in words), base labels, all labels, and the score."""
    joined = b" ".join(_WORD.findall(text))
    starts, base, score = [], set(), 0.0
    for label, pattern in _BASE_RULES:
        at = before = 0
        for m in pattern.finditer(joined):
            before += joined.count(b" ", at, m.start())
            at = m.start()
            starts.append(before)
            base.add(label)
            score = 0.6
    kept = detections(joined, ruled)
    labels = base | {d[2] for d in kept}
    return starts, base, labels, max([score, *(d[3] for d in kept)])


_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_BASE_RULES = [
    (label, re.compile(rb"(?<!\S)" + phrase.encode() + rb"(?!\S)")) for phrase, label in BASE.items()
]
_compiled: list[tuple[list[Rule], list[tuple[bytes, ...]]]] = []


def _ready() -> tuple[list[Rule], list[tuple[bytes, ...]]]:
    """The rules and the distinct sets of keywords that let a text through."""
    if not _compiled:
        ruled = rules()
        gates = {r.keywords for r in ruled} | {tuple(p.encode().split(b" ")) for p in BASE}
        # a set that contains another one lets nothing more through
        least = [g for g in gates if not any(set(o) < set(g) for o in gates)]
        _compiled.append((ruled, sorted(least, key=lambda g: (len(g), g))))
    return _compiled[0]


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with what the rules find in each whole text; columns of these names are replaced,
    all others keep their values.

    Adds n_words, n_base (places of base phrases), first_word, last_word (their
    smallest and largest start, null without any), base_labels, labels (distinct,
    sorted, joined by commas, empty without any) and score (0 to 1, the best
    confidence). A null text has no words. Rows are never dropped or merged; an empty
    table gives an empty table.
    """
    small_batches(docs.sparkSession)
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    @F.arrow_udf(
        "struct<n_words: long, n_base: long, first_word: long, last_word: long, "
        "base_labels: string, labels: string, score: double>"
    )
    def found(texts: pa.Array) -> pa.Array:
        ruled, gates = _ready()
        columns: list[list] = [[] for _ in names]
        for part in slices(texts):
            cut = words(part, ALNUM)
            lengths = pc.binary_length(part).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            raw = cut.data.tobytes()
            for n, a, b in zip(np.diff(cut.first).tolist(), (ends - lengths).tolist(), ends.tolist(), strict=True):
                own = raw[a:b]
                row = (n, 0, None, None, "", "", 0.0)
                if any(all(k in own for k in gate) for gate in gates):
                    starts, base, labels, score = scan(own, ruled)
                    edge = (min(starts), max(starts)) if starts else (None, None)
                    row = (n, len(starts), *edge, ",".join(sorted(base)), ",".join(sorted(labels)), score)
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        return pa.StructArray.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
        )

    plain = numbered_columns(docs)
    scored = plain.select("*", found(F.col(numbered_column(docs, text))).alias("found"))
    return own_columns(scored.select(*plain.columns, "found.*"), docs, names)
