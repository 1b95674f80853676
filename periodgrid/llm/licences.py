"""Licence scan by ordered signature rules (operator 6).

Rules are regexes over lower-cased text, several hundred of them, written as families of licences
times the forms in which texts name a licence, and their SPDX short names. A rule runs only on texts
that hold its keyword, the longest run of words that its pattern cannot do without; all keywords
are looked for in one pass, over the text with one blank for whatever stands between its words. Detections are then ordered by priority and length, and
one that lies within the interval of a better one is suppressed. The phrases of the base find all
their places and are never suppressed.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORDS = re.compile(f"{WORD}+")
_GAPS = re.compile(GAP)

# Base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Families as label, pattern of the name, versions (none: the name says all).
FAMILIES = [
    ("mit", "mit(?: expat)?", ""),
    ("apache", "apache(?: software)?", "1.0 1.1 2.0"),
    ("gpl", "(?:gnu )?general public", "1 2 3"),
    ("gpl", "(?:gnu )?gpl", "1 2 3"),
    ("lgpl", "(?:gnu )?(?:lesser|library) general public", "2 2.1 3"),
    ("lgpl", "(?:gnu )?lgpl", "2 2.1 3"),
    ("agpl", "(?:gnu )?affero general public", "1 3"),
    ("agpl", "(?:gnu )?agpl", "1 3"),
    ("bsd", "bsd(?: (?:2|3|4|two|three|four) clause)?", ""),
    ("mpl", "mozilla public", "1.0 1.1 2.0"),
    ("epl", "eclipse public", "1.0 2.0"),
    ("cddl", "cddl", "1.0 1.1"),
    ("cddl", "common development and distribution", "1.0 1.1"),
    ("cc-by", "creative commons(?: attribution)?(?: (?:noncommercial|non commercial|sharealike|share alike|noderivatives))*", "1.0 2.0 2.5 3.0 4.0"),
    ("cc0", "cc0", "1.0"),
    ("isc", "isc", ""),
    ("zlib", "zlib", ""),
    ("boost", "boost software", "1.0"),
    ("artistic", "artistic", "1.0 2.0"),
    ("unlicense", "unlicense", ""),
    ("wtfpl", "wtfpl", "1 2"),
    ("osl", "open software", "1.0 2.0 2.1 3.0"),
    ("afl", "academic free", "1.2 2.0 2.1 3.0"),
    ("eupl", "european union public", "1.0 1.1 1.2"),
    ("ofl", "(?:sil )?open font", "1.0 1.1"),
    ("psf", "python software foundation", "2"),
    ("postgresql", "postgresql", ""),
    ("openssl", "openssl", ""),
    ("ms-pl", "microsoft public", ""),
    ("ms-rl", "microsoft reciprocal", ""),
    ("odbl", "open database", "1.0"),
    ("upl", "universal permissive", "1.0"),
    ("fdl", "(?:gnu )?free documentation", "1.1 1.2 1.3"),
    ("w3c", "w3c(?: software)?", ""),
    ("ncsa", "(?:university of illinois )?ncsa", ""),
    ("blueoak", "blue oak model", "1.0.0"),
]

# SPDX short names that differ from the name of the family, as label, short name,
# versions (a short name with versions is an identifier only with one of them).
SPDX = [
    ("bsd", "0bsd", ""),
    ("bsd", "bsd [1-4] clause", ""),
    ("mpl", "mpl", "1.0 1.1 2.0"),
    ("epl", "epl", "1.0 2.0"),
    ("cc-by", "cc by(?: (?:nc|sa|nd))*", "1.0 2.0 2.5 3.0 4.0"),
    ("boost", "bsl", "1.0"),
    ("osl", "osl", "1.0 1.1 2.0 2.1 3.0"),
    ("afl", "afl", "1.1 1.2 2.0 2.1 3.0"),
    ("eupl", "eupl", "1.0 1.1 1.2"),
    ("ofl", "ofl", "1.0 1.1"),
    ("psf", "psf", "2.0"),
    ("psf", "python", "2.0"),
    ("ms-pl", "ms pl", ""),
    ("ms-rl", "ms rl", ""),
    ("odbl", "odbl", "1.0"),
    ("upl", "upl", "1.0"),
    ("fdl", "gfdl", "1.1 1.2 1.3"),
    ("blueoak", "blueoak", "1.0.0"),
]

# Forms as name, priority (lower goes first), weight, pattern around NAME and VERSION.
FORMS = [
    ("identifier", 0, 0.99, "spdx license identifier NAME(?: VERSION)?(?: (?:only|or later))?"),
    ("grant", 1, 0.95, "licen[sc]ed (?:to you )?under (?:the )?(?:terms of the )?NAME(?: public)?(?: licen[sc]e)?(?: (?:version )?VERSION)?"),
    ("terms", 2, 0.9, "(?:released|distributed|available|published|redistributed) under (?:the )?(?:terms of )?(?:the )?NAME(?: licen[sc]e)?(?: (?:version )?VERSION)?"),
    ("version", 3, 0.8, "NAME(?: licen[sc]e)?(?: version)? VERSION"),
    ("title", 4, 0.7, "NAME licen[sc]e"),
    ("file", 5, 0.5, "(?:see|read) (?:the )?(?:accompanying )?(?:file )?(?:copying|licen[sc]e)(?: file)? for (?:the )?NAME"),
]

# Sentences of licence texts, as label, weight, pattern.
SENTENCES = [
    ("mit", 0.95, "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", 0.9, "permission is hereby granted free of charge"),
    ("bsd", 0.9, "redistribution and use in source and binary forms with or without modification"),
    ("bsd", 0.8, "neither the name of .{1,80}? nor the names of its contributors"),
    ("gpl", 0.8, "this program is free software you can redistribute it and or modify it"),
    ("apache", 0.9, "www apache org licenses license 2 0"),
    ("gpl", 0.8, "www gnu org licenses"),
    ("cc-by", 0.9, "creativecommons org licenses [a-z]+(?: [a-z]+)*"),
    ("public-domain", 0.6, "(?:placed|dedicated|released) (?:in|to|into) the public domain"),
    ("proprietary", 0.3, "all rights reserved"),
    ("no-warranty", 0.2, "without warranty of any kind"),
]


@dataclass(frozen=True)
class Rule:
    label: str
    form: str
    priority: int
    weight: float
    keyword: str
    pattern: re.Pattern


def _pattern(words: str) -> re.Pattern:
    """Words of the rule stand apart by any run of other characters."""
    return re.compile(rf"(?<!{WORD})(?:{words.replace(' ', GAP)})(?!{WORD})", re.DOTALL)


def _number(version: str) -> str:
    return " ".join(re.escape(part) for part in version.removesuffix(".0").split(".")) + "(?: 0)*"


def _keyword(words: str) -> str:
    """The longest run of characters, blanks between words, that every match of ``words`` holds."""
    while True:  # from the inside out: what may be missing goes, of alternatives none is sure
        less = re.sub(r"\(\?:[^()]*\)[?*]?", "\n", words)
        if less == words:
            break
        words = less
    words = re.sub(r"\.\{\d+,\d+\}\??|\[[^\]]*\][+*?]?", "\n", words)
    words = re.sub(r"\\?.[?*]", "\n", words.replace("\\.", "."))
    return max((part.strip() for part in words.split("\n")), key=len)


def rules() -> tuple[Rule, ...]:
    """All rules in their order: forms by priority, each for every family and version, then sentences."""
    made = []
    for form, priority, weight, shape in FORMS:
        for label, name, versions in FAMILIES:
            for version in [None, *versions.split()]:
                if version is None and form == "version":
                    continue
                text = shape
                if version is None:
                    text = re.sub(r"\(\?: \(\?:version \)\?VERSION\)\?|\(\?: VERSION\)\?", "", text)
                else:
                    text = text.replace("(?: VERSION)?", " VERSION").replace("(?: (?:version )?VERSION)?", " (?:version )?VERSION")
                    if text == shape and "VERSION" not in shape:
                        continue  # this form names no version
                    text = text.replace("VERSION", f"v?{_number(version)}")
                own = label if version is None else f"{label}-{version}"
                made.append(Rule(own, form, 2 * priority + (version is None), weight, _keyword(name), _pattern(text.replace("NAME", f"(?:{name})"))))
    form, priority, weight, shape = FORMS[0]
    for label, name, versions in SPDX:
        for version in versions.split() or [None]:
            text = shape.replace("(?: VERSION)?", "" if version is None else f" {_number(version)}")
            own = label if version is None else f"{label}-{version}"
            made.append(Rule(own, form, 2 * priority + (version is None), weight, _keyword(shape.split("NAME")[0]), _pattern(text.replace("NAME", f"(?:{name})"))))
    for label, weight, words in SENTENCES:
        made.append(Rule(label, "sentence", 2 * len(FORMS), weight, _keyword(words), _pattern(words)))
    return tuple(made)


def suppress(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Detections that lie in no better one: better is a lower priority number, then longer, then earlier."""
    kept: list[tuple[int, int, Rule]] = []
    starts: list[int] = []
    reach: list[int] = []  # kept intervals by start, with the furthest end up to each
    for start, end, rule in sorted(found, key=lambda x: (x[2].priority, x[0] - x[1], x[0], x[2].label)):
        at = bisect_right(starts, start)
        if at and reach[at - 1] >= end:
            continue
        kept.append((start, end, rule))
        starts.insert(at, start)
        reach.insert(at, max(end, reach[at - 1] if at else 0))
        for k in range(at + 1, len(reach)):
            if reach[k] >= end:
                break
            reach[k] = end
    return sorted(kept, key=lambda x: (x[0], -x[1], x[2].label))


class Scanner:
    """All rules made ready, and the automaton of their keywords."""

    def __init__(self) -> None:
        self.base = [(label, _pattern(phrase)) for phrase, label in BASE.items()]
        self.by_word: dict[str, list[Rule]] = {}
        for rule in rules():
            self.by_word.setdefault(rule.keyword, []).append(rule)
        self.automaton = ahocorasick.Automaton()
        for word in self.by_word:
            self.automaton.add_word(word, word)
        self.automaton.make_automaton()

    def scan(self, lowered: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, Rule]]]:
        """Base places and kept detections of one lower-cased text, as character intervals."""
        base = [(m.start(), m.end(), label) for label, pattern in self.base for m in pattern.finditer(lowered)]
        present = {word for _, word in self.automaton.iter(_GAPS.sub(" ", lowered))}
        found = [(m.start(), m.end(), rule) for word in present for rule in self.by_word[word] for m in rule.pattern.finditer(lowered)]
        return base, suppress(found)


#: A text with none of these holds no base phrase and no keyword of a rule.
_GATE = "|".join(re.escape(g).replace("\\ ", GAP) for g in sorted({"licen", *(rule.keyword for rule in rules())}))


def _word_counts(lowered: pa.Array) -> np.ndarray:
    """Words per text, from the bytes of the whole batch at once."""
    _, ends, data = lowered.buffers()
    wide = np.int64 if pa.types.is_large_string(lowered.type) else np.int32
    ends = np.frombuffer(ends, wide)[lowered.offset:lowered.offset + len(lowered) + 1].astype(np.int64)
    inside = np.ones(256, bool)
    inside[0x00:0x30] = inside[0x3A:0x61] = inside[0x7B:0x80] = False
    held = inside[np.frombuffer(data, np.uint8)[ends[0]:ends[-1]]] if data and ends[-1] > ends[0] else np.zeros(0, bool)
    begins = held.copy()
    begins[1:] &= ~held[:-1]
    edges = ends[:-1][ends[:-1] < ends[-1]] - ends[0]
    begins[edges] = held[edges]
    total = np.append(0, np.cumsum(begins, dtype=np.int64))
    return total[ends[1:] - ends[0]] - total[ends[:-1] - ends[0]]


def scan_licences(documents: DataFrame) -> DataFrame:
    """Per document its words, base places and labels.

    Output: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections
    (label, form, start, end in characters of the text, after suppression). A null or empty text
    has no words and no labels, score 0. Repeated rows and null ids give one row each. Other
    columns are not read. Whole texts are scanned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            lowered = pc.ascii_lower(batch.column("text"))
            rows = [(0, None, None, "", "", 0.0, [])] * batch.num_rows
            for k in np.flatnonzero(pc.match_substring_regex(lowered, _GATE).to_numpy(zero_copy_only=False)):
                text = lowered[int(k)].as_py()
                base, kept = scanner.scan(text)
                if not base and not kept:
                    continue
                first = last = None
                if base:
                    starts = [m.start() for m in _WORDS.finditer(text)]
                    first, last = (bisect_right(starts, f(b[0] for b in base)) - 1 for f in (min, max))
                own = {b[2] for b in base}
                doubt = float(np.prod([1 - rule.weight for _, _, rule in kept])) * (0.3 if base else 1.0)
                spans = [{"label": r.label, "form": r.form, "start": s, "end": e} for s, e, r in kept]
                rows[int(k)] = (len(base), first, last, ",".join(sorted(own)), ",".join(sorted(own | {r.label for _, _, r in kept})), 1 - doubt, spans)
            columns = list(zip(*rows))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), DETECTIONS]
            cells = [pa.array(list(c), t) for c, t in zip(columns, kinds)]
            names = ["n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]
            yield pa.record_batch([batch.column("doc_id"), pa.array(_word_counts(lowered)), *cells], ["doc_id", "n_words", *names])

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
                                 "labels string, score double, detections array<struct<label: string, form: string, start: long, end: long>>")


DETECTIONS = pa.list_(pa.struct([("label", pa.string()), ("form", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
