"""Operator 2: license phrases and short notices, also with small errors.

A text is reduced to words (A-Z lower-cased, joined by single spaces). Base phrases are
counted exactly. Each notice may have k errors (characters inserted, deleted or
replaced), k growing with its length. Cut into k + 1 seeds, one of which must then
occur unharmed, it is found by one pass of an Aho-Corasick automaton over the seeds of
all notices; around each seed the regex library's bounded-error matching confirms the
notice, with its best alignment, or rejects it. Every candidate is confirmed, in a window
of its own; of matches that overlap the one with fewest errors is taken.

Null texts count as empty. Rows are independent: repeated or null doc_ids are kept.
Other columns are ignored.
"""

from __future__ import annotations

import bisect
import functools
import heapq
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .shared import ascii_lower, received_ids, sent_ids, text_of

# What a word is, and the base phrases with their labels.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

NOTICES = {
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "licensed under the apache license version 2 0": "apache",
    "apache license version": "apache",
    "licensed under the mit license": "mit",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "licensed under cc by": "cc-by",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "proprietary",
}
#: One error for so many characters.
CHARS_PER_ERROR = 10

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels array<string>, labels array<string>, score double, "
    "spans array<struct<label:string,start:long,end:long,errors:int>>"
)


def allowed_errors(notice: str) -> int:
    return max(1, len(notice) // CHARS_PER_ERROR)


@functools.lru_cache(maxsize=1)
def _search():
    """The automaton over all seeds, and for each notice its pattern."""
    import ahocorasick
    import regex

    automaton, seeds, patterns = ahocorasick.Automaton(), {}, {}
    for notice in NOTICES:
        k = allowed_errors(notice)
        edges = [len(notice) * i // (k + 1) for i in range(k + 2)]
        for a, b in zip(edges, edges[1:]):
            seeds.setdefault(notice[a:b], []).append((notice, a))
        patterns[notice] = regex.compile(f"(?b)(?:{regex.escape(notice)}){{e<={k}}}")
    for seed, places in seeds.items():
        automaton.add_word(seed, (len(seed), places))
    automaton.make_automaton()
    return automaton, patterns


def _places(line: str, pattern, least: int, windows: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, errors) of disjoint matches, fewest errors first. What a window has
    left of a taken match and right of it is searched again, if a match (``least``
    characters or more) still fits there."""
    taken: list[tuple[int, int, int]] = []
    heap: list[tuple[int, int, int, int, int]] = []

    def search(lo: int, hi: int) -> None:
        if hi - lo >= least and (m := pattern.search(line, lo, hi)):
            heapq.heappush(heap, (sum(m.fuzzy_counts), m.start(), m.end(), lo, hi))

    for lo, hi in windows:
        search(lo, hi)
    while heap:
        errors, start, end, lo, hi = heapq.heappop(heap)
        at = bisect.bisect(taken, (start,))
        near = [t for t in taken[max(at - 1, 0) : at + 1] if t[0] < end and start < t[1]]
        if not near:
            near = [(start, end, errors)]
            taken.insert(at, near[0])
        search(lo, near[0][0])
        search(near[0][1], hi)
    return taken


def notices(line: str) -> list[tuple[str, int, int, int]]:
    """(notice, start, end, errors) in the reduced text, each place once."""
    automaton, patterns = _search()
    candidates: dict[str, set[int]] = {}
    for end, (length, places) in automaton.iter(line):
        for notice, at in places:
            candidates.setdefault(notice, set()).add(end - length + 1 - at)
    found = []
    for notice, starts in candidates.items():
        k = allowed_errors(notice)
        # Seeds of one place, shifted by its errors, share a window; two places never fit.
        groups: list[list[int]] = []
        for start in sorted(starts):
            if groups and start - groups[-1][0] <= 2 * k:
                groups[-1][1] = start
            else:
                groups.append([start, start])
        windows = [(max(0, a - k), min(len(line), b + len(notice) + k)) for a, b in groups]
        found += [(notice, *x) for x in _places(line, patterns[notice], len(notice) - k, windows)]
    return sorted(found, key=lambda f: (f[1], f[2], f[0]))


def scan(text: str) -> tuple:
    """Everything after doc_id in SCHEMA; ``text`` is lower-cased."""
    words = WORD.findall(text)
    line = " ".join(words)
    padded = f" {line} "
    base: list[tuple[int, int, str]] = []  # first word, last word, label
    for phrase, label in PHRASES.items():
        target, at = f" {phrase} ", padded.find(f" {phrase} ")
        seen = word = 0
        while at >= 0:
            word += padded.count(" ", seen, at)
            seen = at
            base.append((word, word + phrase.count(" "), label))
            at = padded.find(target, at + 1)
    near = notices(line)
    if not base and not near:
        return len(words), 0, None, None, [], [], 0.0, []
    place = [(m.start(), m.end()) for m in WORD.finditer(text)]
    spans = [{"label": x, "start": place[a][0], "end": place[b][1], "errors": 0} for a, b, x in base]
    best = 1.0 if base else 0.0
    for notice, start, end, errors in near:
        while end > start and line[end - 1] == " ":
            end -= 1
        while start < end and line[start] == " ":
            start += 1
        a = line.count(" ", 0, start)
        b = a + line.count(" ", start, end)
        spans.append(
            {"label": NOTICES[notice], "start": place[a][0], "end": place[b][1], "errors": errors}
        )
        best = max(best, 1 - errors / len(notice))
    starts = [a for a, _, _ in base]
    return (
        len(words),
        len(base),
        min(starts, default=None),
        max(starts, default=None),
        sorted({x for _, _, x in base}),
        sorted({s["label"] for s in spans}),
        best,
        sorted(spans, key=lambda s: (s["start"], s["end"], s["label"], s["errors"])),
    )


def scan_licenses(docs: DataFrame) -> DataFrame:
    """A row for each document, see SCHEMA: counts and places of base phrases (words
    from 0), labels, the best match's likeness as score (1 for an exact one, 0 for
    none), and spans in code points, end exclusive."""
    names = [c.split()[0] for c in SCHEMA.split(", ")][1:]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame([scan(t) for t in batch["text"]], columns=names)
            out.insert(0, "doc_id", received_ids(batch))
            yield out.astype({"first_word": "Int64", "last_word": "Int64"})

    rows = docs.select(*sent_ids(docs["doc_id"]), ascii_lower(text_of(docs)).alias("text"))
    return rows.mapInPandas(run, SCHEMA.replace(", spans", ", spans"))
