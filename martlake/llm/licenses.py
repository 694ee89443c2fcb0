"""License scans by template-markup matching.

A license is a template: its mandatory wording, ``<<beginOptional>> ...
<<endOptional>>`` regions and ``<<var;words=a..b>>`` regions that any a to b words
may fill. All templates are compiled into one position automaton over words
(Glushkov; a set of positions is an integer). A stretch of a text is accepted when
its words spell the mandatory wording exactly, whatever stands in the other
regions.

Words are looked at in place: hashes of the first words that a template can
begin with name the candidate starts, and only from those the automaton runs over
the words themselves, whose bytes are compared, until no position is left. A run
is no longer than the longest template, so the work follows the text.

A span is the longest stretch that a template accepts from one start; every start
gives its own span, so places that overlap are all found.

Defined cases: null text = empty = no words; ties and repeated rows are scanned
each; a null doc_id stays null; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.llm.text import ALNUM, LOWER, U64, blocks, gram_hashes, texts, word_hashes, word_spans

LEAD = 3  # words by which candidate starts are found
CHANCE = 0.75  # how likely a further word of a wording is to stand there by chance

# Phrases that name a license, and the wording of public licenses and
# of their usual notices.
PHRASES = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}
TEMPLATES = {
    "mit-grant": """<<beginOptional>>this <<var;words=1..3>> is<<endOptional>> released under the
        <<beginOptional>>terms of the<<endOptional>> MIT license""",
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice <<beginOptional>>(including the next
        paragraph)<<endOptional>> shall be included in all copies or substantial portions of the Software.""",
    "isc-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "bsd-text": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must
        retain the above copyright notice, this list of conditions and the following disclaimer.
        <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution.""",
    "bsd-no-endorsement": """Neither the name of <<var;words=1..12>> nor the names of <<var;words=1..4>> may be used to
        endorse or promote products derived from this software without specific prior written permission.""",
    "apache-2-grant": """licensed under the <<var;words=0..2>> Apache license <<beginOptional>>version<<endOptional>> 2
        <<beginOptional>>0<<endOptional>>""",
    "apache-2-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
        <<beginOptional>>this file<<endOptional>> <<var;words=0..6>> except in compliance with the License.""",
    "gpl-named": """under the <<beginOptional>>terms of the<<endOptional>> GNU <<beginOptional>>lesser<<endOptional>>
        general public license <<beginOptional>>version <<var;words=1..1>><<endOptional>>""",
    "gpl-notice": """This program is free software<<var;words=0..1>> you can redistribute it and/or modify it under the
        terms of the GNU General Public License as published by the Free Software Foundation, either version
        <<var;words=1..2>> of the License, or (at your option) any later version.""",
    "cc-grant": """licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> CC by
        <<beginOptional>>nc<<endOptional>> <<beginOptional>>sa<<endOptional>> <<beginOptional>>nd<<endOptional>>
        <<beginOptional>><<var;words=1..1>> 0<<endOptional>>""",
    "cc-named": """licensed under a Creative Commons Attribution <<var;words=0..4>> <<var;words=1..1>> 0
        <<beginOptional>>international<<endOptional>> license""",
    "no-warranty": """the software is provided "as is" <<beginOptional>>without warranty of any kind express or
        implied<<endOptional>>""",
}

_MARK = re.compile(r"<<(beginOptional|endOptional|var;words=(\d+)\.\.(\d+))>>")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_UPPER = {c: c + 32 for c in range(65, 91)}


def parse(markup: str) -> list:
    """Template as a list of words (str), optional regions (list) and replaceable
    regions (pairs: fewest, most words)."""
    stack: list[list] = [[]]
    at = 0
    for m in _MARK.finditer(markup):
        stack[-1] += _WORD.findall(markup[at: m.start()].translate(_UPPER))
        at = m.end()
        if m[1] == "beginOptional":
            stack.append([])
        elif m[1] == "endOptional":
            if len(stack) == 1:
                raise ValueError("endOptional without beginOptional")
            inner = stack.pop()
            stack[-1].append(inner)
        else:
            stack[-1].append((int(m[2]), int(m[3])))
    stack[-1] += _WORD.findall(markup[at:].translate(_UPPER))
    if len(stack) > 1:
        raise ValueError("beginOptional without endOptional")
    return stack[0]


def mandatory(tree: list) -> int:
    """Words that every accepted text holds."""
    return sum(1 for x in tree if isinstance(x, str))


class Automaton:
    """Position automaton of all templates together. ``step`` and the accepted
    templates of a set of positions are worked out once and remembered."""

    REMEMBERED = 200_000

    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        self.symbol: list[str | None] = []  # by position; None: any word
        self.follow: list[int] = []
        self.first, self.last = 0, []
        self.size = []
        for name, markup in templates.items():
            tree = parse(markup)
            empty, first, last = self._seq(tree)
            if empty or not mandatory(tree):
                raise ValueError(f"{name}: a template needs mandatory wording")
            self.first |= first
            self.last.append(last)
            self.size.append(mandatory(tree))
        self.any = sum(1 << p for p, s in enumerate(self.symbol) if s is None)
        self.of: dict[bytes, int] = {}
        for p, s in enumerate(self.symbol):
            if s is not None:
                self.of[s.encode()] = self.of.get(s.encode(), 0) | 1 << p
        if self.first & self.any:
            raise ValueError("a template can't begin with a replaceable region")
        self._steps: dict[tuple[int, int], tuple[int, list[int]]] = {}

    def _position(self, word: str | None) -> tuple[bool, int, int]:
        self.symbol.append(word)
        self.follow.append(0)
        bit = 1 << (len(self.symbol) - 1)
        return False, bit, bit

    def _seq(self, tree: list) -> tuple[bool, int, int]:
        """(can be empty, first positions, last positions)"""
        empty, first, last = True, 0, 0
        for x in tree:
            if isinstance(x, str):
                e, f, z = self._position(x)
            elif isinstance(x, list):
                _, f, z = self._seq(x)
                e = True
            else:
                e, f, z = self._filler(*x)
            for p in _bits(last):
                self.follow[p] |= f
            first |= f if empty else 0
            last = z | (last if e else 0)
            empty = empty and e
        return empty, first, last

    def _filler(self, least: int, most: int) -> tuple[bool, int, int]:
        row = [self._position(None)[1] for _ in range(most)]
        for a, b in zip(row, row[1:], strict=False):
            self.follow[a.bit_length() - 1] |= b
        return least == 0, row[0] if row else 0, sum(row[max(0, least - 1):])

    def step(self, state: int, word: bytes) -> tuple[int, list[int]]:
        """(positions after one more word, templates that end there); state -1: the start."""
        fits = self.of.get(word, 0)
        got = self._steps.get((state, fits))
        if got is None:
            reach = self.first
            if state >= 0:
                reach = 0
                for p in _bits(state):
                    reach |= self.follow[p]
            to = reach & (fits | self.any)
            got = to, [i for i, z in enumerate(self.last) if to & z]
            if len(self._steps) >= self.REMEMBERED:
                self._steps.clear()
            self._steps[state, fits] = got
        return got

    def leads(self) -> list[tuple[str, ...]]:
        """The word sequences that accepted texts begin with: ``LEAD`` words, or fewer
        in front of a replaceable region or when the text ends before."""
        ends = 0
        for z in self.last:
            ends |= z
        out, open_ = set(), [((), p) for p in _bits(self.first)]
        while open_:
            words, p = open_.pop()
            words = (*words, self.symbol[p])
            if len(words) == LEAD or ends >> p & 1 or self.follow[p] & self.any:
                out.add(words)
            else:
                open_ += [(words, q) for q in _bits(self.follow[p])]
        return sorted(out)


def _bits(mask: int) -> list[int]:
    out = []
    while mask:
        low = mask & -mask
        out.append(low.bit_length() - 1)
        mask ^= low
    return out


def _hashes(words: tuple[str, ...]) -> np.ndarray:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(r) for r in raw])
    return word_hashes(np.frombuffer(b"".join(raw), np.uint8), ends - np.array([len(r) for r in raw]), ends)


class Scanner:
    """Spans of all templates in blocks of texts."""

    SLOTS = 1 << 16

    def __init__(self, templates: dict[str, str]):
        self.auto = Automaton(templates)
        by_size: dict[int, list[int]] = {}
        for lead in self.auto.leads():
            by_size.setdefault(len(lead), []).append(int(gram_hashes(_hashes(lead), len(lead))[0]))
        self.leads = {}
        for n, found in by_size.items():
            exact = np.array(sorted(found), U64)
            slot = np.zeros(self.SLOTS, bool)
            slot[(exact & U64(self.SLOTS - 1)).astype(np.int64)] = True
            self.leads[n] = exact, slot

    def starts(self, hashes: np.ndarray) -> np.ndarray:
        """Words at which a template may begin, ascending."""
        found = []
        for n, (exact, slot) in self.leads.items():
            grams = gram_hashes(hashes, n)
            at = np.flatnonzero(slot[(grams & U64(self.SLOTS - 1)).astype(np.int64)])
            found.append(at[np.isin(grams[at], exact)])
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)

    def spans(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, list[list[tuple[int, int, int]]]]:
        """(words by document, its (template, first word, last word) spans by start)."""
        data = LOWER[data]
        starts, ends, first = word_spans(data, off, ALNUM)
        out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(off) - 1)]
        where = self.starts(word_hashes(data, starts, ends))
        raw = data.tobytes() if len(where) else b""
        doc = np.searchsorted(first, where, "right") - 1
        for i, d in zip(where.tolist(), doc.tolist(), strict=True):
            state, at, stop, longest = -1, i, int(first[d + 1]), {}
            while at < stop:
                state, done = self.auto.step(state, raw[starts[at]: ends[at]])
                if not state:
                    break
                for t in done:
                    longest[t] = at
                at += 1
            out[d] += [(t, i - int(first[d]), z - int(first[d])) for t, z in sorted(longest.items())]
        return np.diff(first), out


SPAN = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("wording", pa.int32())])


def scan(df: DataFrame, templates: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, spans) of every row of ``df``; a span is (label, first word,
    last word, words of mandatory wording). ``templates``: label -> markup."""
    ddl = "doc_id long, n_words long, spans array<struct<label: string, first: long, last: long, wording: int>>"

    def run(it):
        scanner = Scanner(templates)
        names, size = scanner.auto.names, scanner.auto.size
        for b in it:
            for lo, hi, data, off in blocks(b.column(1)):
                n, found = scanner.spans(data, off)
                rows = [[(names[t], i, z, size[t]) for t, i, z in f] for f in found]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()),
                                                  pa.array(rows, pa.list_(SPAN))], ["doc_id", "n_words", "spans"])
    return texts(df, id_col, text_col).mapInArrow(run, ddl)


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def strength(wording: int) -> float:
    """How sure a wording of so many words makes us, 0 to 1."""
    return round(1.0 - CHANCE ** wording, 6)


def license_digest(df: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score):
    base phrases and templates of every row. The score follows the longest
    mandatory wording found (``strength``), 0 without any."""
    spans = scan(df, {**PHRASES, **TEMPLATES})
    base = F.filter("spans", lambda s: s["label"].isin(*PHRASES))
    starts = F.transform(base, lambda s: s["first"])
    sizes = sorted({mandatory(parse(m)) for m in [*PHRASES.values(), *TEMPLATES.values()]})
    longest = F.coalesce(F.array_max(F.transform("spans", lambda s: s["wording"])), F.lit(0))
    score = F.lit(0.0)
    for n in sizes:
        score = F.when(longest >= n, F.lit(strength(n))).otherwise(score)
    return spans.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
                        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                        _joined(F.transform(base, lambda s: s["label"])).alias("base_labels"),
                        _joined(F.transform("spans", lambda s: s["label"])).alias("labels"), score.alias("score"))


# --- the same result in SQL ---------------------------------------------------

def pattern(markup: str) -> str:
    """Regular expression of a template over words that each follow a space."""
    def of(tree: list) -> str:
        return "".join(f" {x}" if isinstance(x, str) else f"(?:{of(x)})?" if isinstance(x, list)
                       else f"(?: [^ ]+){{{x[0]},{x[1]}}}" for x in tree)
    return of(parse(markup)) + " "


def license_sql() -> str:
    """DuckDB SQL of ``license_digest``: phrases by comparison at every word, templates
    as regular expressions over the words joined by spaces."""
    phrases = [(label, " ".join(parse(m)), mandatory(parse(m))) for label, m in PHRASES.items()]
    places = " || ".join(f"list_filter(range(1, greatest(len(w) - {n} + 2, 1)), lambda i: array_to_string(w[i:i + {n - 1}], ' ') = '{p}')"
                         for _, p, n in phrases)
    named = [(label, pattern(m), mandatory(parse(m))) for label, m in {**PHRASES, **TEMPLATES}.items()]

    def labels(found) -> str:
        return "array_to_string(list_sort(list_filter([" + ", ".join(
            f"CASE WHEN regexp_matches(t, '{p}') THEN '{label}' END" for label, p, _ in found) + "], lambda x: x IS NOT NULL)), ',')"
    score = "greatest(" + ", ".join(f"CASE WHEN regexp_matches(t, '{p}') THEN CAST({strength(n)} AS DOUBLE) ELSE 0 END" for _, p, n in named) + ")"
    return rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS t, {places} AS found FROM d)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(found) AS BIGINT) AS n_base,
  CAST(list_min(found) - 1 AS BIGINT) AS first_word, CAST(list_max(found) - 1 AS BIGINT) AS last_word,
  {labels(named[:len(PHRASES)])} AS base_labels, {labels(named)} AS labels, {score} AS score
FROM p
"""
