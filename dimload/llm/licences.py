"""Licence scans with a generalised suffix automaton of licence words.

One automaton holds all suffixes of all templates' words. A text's words are streamed through it:
the matching statistics give, for each word, the longest run of words ending there that occurs in
some template. Runs of ``LEAST`` words or more that can't be extended are chained by dynamic programming
over all their places in a template: matches that follow each other in the text, within ``GAP`` words,
and in the template cover a span of it. Words of the span that add nothing are subtracted from the
covered ones, and words of the template that a chain leaves out aren't covered. A template of which ``COVER`` is
left gives its label to the text, unless its span overlaps that of a template with more words left
(or as many, and a larger share). Base phrases are found wherever their words stand consecutively.

Templates are whole licence texts (``licence_texts``, one file for each label) and notices:
``TEMPLATES`` and the variants of the GNU and Creative Commons families. ``scan`` takes any other
table of (label, text). No body of AGPL, EPL or Creative Commons licences but CC0 is at hand: these
are known by their notices.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. Only runs of words that the
templates use are streamed, since no match can leave such a run. A null or empty text has no words,
empty labels and score 0. Repeated rows get a row each; an empty table gives no rows; other columns
are not looked at. The longest text needs memory in proportion to its words only.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import cache
from importlib.resources import files
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimload.llm.textbatch import NON_ALNUM, Words, byte_table, slices

LEAST, GAP, COVER = 3, 30, 0.8
# The base phrases of the contract, and opening or notice sentences of public licences,
# which stand in files without the licence's text.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("epl-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0"),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("cc0-1.0", "This work is licensed under CC0 1.0 Universal"),
    ("cc0-1.0", "This work is marked with CC0 1.0 Universal"),
]
_GNU = {"gpl": ("", ["1", "2", "3"]), "lgpl": ("Lesser ", ["2.1", "3"]), "agpl": ("Affero ", ["3"])}
_CC = {"by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nc": "Attribution-NonCommercial", "by-nd": "Attribution-NoDerivatives"}
_CC |= {"by-nc-sa": "Attribution-NonCommercial-ShareAlike", "by-nc-nd": "Attribution-NonCommercial-NoDerivatives"}
_CC_FORMS = {"2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}


def notices() -> list[tuple[str, str]]:
    """Notices of the GNU and Creative Commons licences in all versions."""
    out = []
    for family, (word, versions) in {**_GNU, "lgpl-2.0": ("Library ", ["2"])}.items():
        free = [f"This {x} is free software: you can redistribute it and/or modify it under the terms of the GNU {word}General Public License" for x in ("program", "library")]
        out += [(family, x) for x in free]
        for v in versions:
            label = f"{family.split('-')[0]}-{v if '.' in v else v + '.0'}"
            out += [(label, f"This {x} is licensed under the GNU {word}General Public License, version {v}") for x in ("work", "program", "library")]
            out += [(label, f"licensed under the GNU {word}General Public License v{v}")]
            out += [(label, f"{x} as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version") for x in free]
            out += [(label, f"{x} version {v} as published by the Free Software Foundation") for x in free]
    for kind, name in _CC.items():
        for v, form in _CC_FORMS.items():
            names = {name, name.replace("NoDerivatives", "NoDerivs")}
            out += [(f"cc-{kind}-{v}", f"This work is licensed under {x} Creative Commons {n} {v} {form} License") for n in sorted(names) for x in ("a", "the")]
            out += [(f"cc-{kind}-{v}", f"Licensed under CC {kind} {v}"), (f"cc-{kind}-{v}", f"creativecommons.org/licenses/{kind}/{v}")]
    return out


def default_templates() -> list[tuple[str, str]]:
    """Whole licence texts, named by label, and all notices."""
    texts = sorted(files("dimload.llm").joinpath("licence_texts").iterdir(), key=lambda f: f.name)
    bodies = [(f.name.removesuffix(".txt"), f.read_text("utf-8", "replace")) for f in texts if f.name.endswith(".txt")]
    return [*bodies, *TEMPLATES, *notices()]


_TABLE = byte_table(NON_ALNUM, lower=True)
_SPAN = "array<struct<label:string,first:long,last:long,cover:double>>"
_ROW = f"doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans {_SPAN}"


def words_of(text: str) -> list[str]:
    words = Words(pa.array([text]), _TABLE)
    vocabulary = words.vocabulary.to_pylist()
    return [vocabulary[c] for c in words.codes]


class SuffixAutomaton:
    """Of several word sequences. State 0 is the root; ``places[v]`` lists the (sequence, end)
    positions of the runs that lead to state ``v``."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        own: list[list[tuple[int, int]]] = [[]]
        for number, sequence in enumerate(sequences):
            last = 0
            for end, word in enumerate(sequence):
                last = self._extended(last, word, own)
                own[last].append((number, end))
        self.places: list[list[tuple[int, int]]] = [list(p) for p in own]
        for v in sorted(range(1, len(self.next)), key=lambda v: -self.length[v]):
            self.places[self.link[v]].extend(self.places[v])
        self.places = [sorted(set(p)) for p in self.places]
        self.grouped: dict[int, dict[int, list[int]]] = {}

    def _state(self, length: int, link: int, after: dict[int, int], own: list) -> int:
        self.next.append(dict(after))
        self.link.append(link)
        self.length.append(length)
        own.append([])
        return len(self.next) - 1

    def _split(self, v: int, word: int, target: int, own: list) -> int:
        """The state for the longest run from ``v`` by ``word``: cut off ``target`` if that is longer."""
        if self.length[target] == self.length[v] + 1:
            return target
        clone = self._state(self.length[v] + 1, self.link[target], self.next[target], own)
        self.link[target] = clone
        while v >= 0 and self.next[v].get(word) == target:
            self.next[v][word] = clone
            v = self.link[v]
        return clone

    def _extended(self, last: int, word: int, own: list) -> int:
        if word in self.next[last]:
            return self._split(last, word, self.next[last][word], own)
        new = self._state(self.length[last] + 1, 0, {}, own)
        v = last
        while v >= 0 and word not in self.next[v]:
            self.next[v][word] = new
            v = self.link[v]
        if v >= 0:
            self.link[new] = self._split(v, word, self.next[v][word], own)
        return new

    def by_template(self, state: int) -> dict[int, list[int]]:
        """The places of a state by sequence."""
        if state not in self.grouped:
            self.grouped[state] = {n: [end for _, end in some] for n, some in groupby(self.places[state], key=itemgetter(0))}
        return self.grouped[state]

    def matches(self, run: list[int], least: int) -> Iterator[tuple[int, int, int]]:
        """(end, length, state) of runs of ``least`` words or more that the next word doesn't extend."""
        state = size = 0
        for i, word in enumerate(run):
            before = (state, size)
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.next[state]:
                state, size = self.next[state][word], size + 1
            else:
                size = 0
            if before[1] >= least and size <= before[1]:
                yield i - 1, before[1], before[0]
        if size >= least:
            yield len(run) - 1, size, state


@cache
def _templates(templates: tuple[tuple[str, str], ...] | None = None) -> tuple[dict[str, int], list[tuple[str, int]], SuffixAutomaton, list[tuple[str, list[int]]]]:
    """The templates' words by number, labels with lengths, the automaton, and base phrases."""
    numbers: dict[str, int] = {}
    table = default_templates() if templates is None else templates
    sequences = [[numbers.setdefault(w, len(numbers)) for w in words_of(text)] for _, text in table]
    phrases = [(label, [numbers.setdefault(w, len(numbers)) for w in words_of(text)]) for text, label in PHRASES.items()]
    return numbers, [(label, len(s)) for (label, _), s in zip(table, sequences, strict=True)], SuffixAutomaton(sequences), phrases


def best_chains(matches: list[tuple[int, int, int, list[int]]]) -> Iterator[tuple[int, int, int]]:
    """(covered, first word, last word) of the best chain that ends in each place of each match.

    ``matches`` are a template's (start, end, size, places of the end in the template), by their ends. A
    chain goes from match to match, at most ``GAP`` words further in the text and to a later place in the
    template; it covers the template words that its matches add, less the text's words that add none. A
    jump ahead in the template costs the words that it leaves out, so the chain through a stray match
    loses to the one that passes it by.
    """
    done: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []  # end, places, covered, first words
    for start, end, size, ends_at in matches:
        places = np.array(ends_at, np.int64)
        covered, first = np.full(len(places), size, np.int64), np.full(len(places), start, np.int64)
        for before, theirs, so_far, began in reversed(done):
            if start - before > GAP + 1:
                break
            step = end - before
            ahead = places[:, None] - theirs
            value = np.where(ahead > 0, so_far + 2 * np.minimum(ahead, min(size, step)) - step, -1)
            at = value.argmax(axis=1)
            value = value[np.arange(len(at)), at]
            better = (value > covered) | (value == covered) & (began[at] > first)
            covered, first = np.where(better, value, covered), np.where(better, began[at], first)
        done.append((end, places, covered, first))
        for value, began in zip(covered.tolist(), first.tolist(), strict=True):
            yield value, began, end


def spans(codes: np.ndarray, templates: tuple[tuple[str, str], ...] | None = None) -> tuple[list[tuple[str, int, int, float]], float]:
    """Covered template spans (label, first and last word, share) of one text's template-word
    numbers (-1: another word), and the largest share of any template."""
    _, labels, automaton, _ = _templates(templates)
    inside = np.flatnonzero(codes >= 0)
    if len(inside) < LEAST:
        return [], 0.0
    cut = np.flatnonzero(np.diff(inside) > 1) + 1
    first, stop = inside[np.r_[0, cut]], inside[np.r_[cut - 1, len(inside) - 1]] + 1
    of_template: dict[int, list[tuple[int, int, int, list[int]]]] = {}
    for a, b in zip(first.tolist(), stop.tolist(), strict=True):
        if b - a < LEAST:
            continue
        for end, size, state in automaton.matches(codes[a:b].tolist(), LEAST):
            for number, places in automaton.by_template(state).items():
                of_template.setdefault(number, []).append((a + end - size + 1, a + end, size, places))
    found, best = [], 0.0
    most = {number: sum(m[2] for m in matches) / labels[number][1] for number, matches in of_template.items()}
    for number in sorted(most, key=lambda n: (-most[n], n)):
        label, size = labels[number]
        if most[number] < COVER and most[number] <= best:
            break  # none of the rest is covered, or the best
        for covered, start, end in best_chains(of_template[number]):
            best = max(best, covered / size)
            if covered >= COVER * size:
                found.append((covered, covered / size, label, start, end))
    out: list[tuple[str, int, int, float]] = []  # disjoint spans in the order of the text
    for _, share, label, start, end in sorted(found, key=lambda x: (-x[0], -x[1], *x[2:])):
        at = bisect_left(out, start, key=lambda x: x[2])  # the first span that ends there or later
        if at == len(out) or out[at][1] > end:
            out.insert(at, (label, start, end, share))
    return out, best


def _scanned(batches: Iterator[pa.RecordBatch], templates: tuple[tuple[str, str], ...] | None = None) -> Iterator[pa.RecordBatch]:
    numbers, _, _, phrases = _templates(templates)
    for batch in slices(batches):
        words = Words(batch.column("text"), _TABLE)
        of_word = np.fromiter((numbers.get(w, -1) for w in words.vocabulary.to_pylist()), np.int64, len(words.vocabulary))
        codes = of_word[words.codes]
        owner = words.owners()
        rows = len(words.counts)
        n_base, low, high = np.zeros(rows, np.int64), np.full(rows, 1 << 60), np.full(rows, -1)
        found: list[set[str]] = [set() for _ in range(rows)]
        for label, phrase in phrases:
            size = len(codes) - len(phrase) + 1
            if size <= 0:
                continue
            at = np.logical_and.reduce([codes[k : k + size] == w for k, w in enumerate(phrase)])
            at = np.flatnonzero(at & (owner[:size] == owner[len(phrase) - 1 :]))
            doc, place = owner[at], at - words.bounds[owner[at]]
            n_base += np.bincount(doc, minlength=rows)
            np.minimum.at(low, doc, place)
            np.maximum.at(high, doc, place)
            for d in np.unique(doc):
                found[d].add(label)
        out = []
        for d, doc_id in enumerate(batch.column("doc_id").to_pylist()):
            covered, share = spans(codes[words.bounds[d] : words.bounds[d + 1]], templates)
            hit = n_base[d] > 0
            out.append(
                {
                    "doc_id": doc_id,
                    "n_words": int(words.counts[d]),
                    "n_base": int(n_base[d]),
                    "first_word": int(low[d]) if hit else None,
                    "last_word": int(high[d]) if hit else None,
                    "base_labels": ",".join(sorted(found[d])),
                    "labels": ",".join(sorted(found[d] | {x[0] for x in covered})),
                    "score": 1.0 if hit else min(1.0, share),
                    "spans": [dict(zip(("label", "first", "last", "cover"), x, strict=True)) for x in covered],
                }
            )
        yield pa.RecordBatch.from_pylist(out, schema=_ARROW)


_ARROW = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "n_words", "n_base", "first_word", "last_word")]
    + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
    + [("spans", pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("cover", pa.float64())])))]
)


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """n_words, base phrases' places, labels, score and covered spans of all ``docs``.

    ``templates`` are (label, text) in place of ``default_templates()``.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    table = None if templates is None else tuple(map(tuple, templates))
    return rows.mapInArrow(lambda batches: _scanned(batches, table), _ROW)
