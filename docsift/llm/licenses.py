"""Licence scans with a generalised suffix automaton of licence tokens.

The automaton accepts every run of words of every template. A file's words are streamed through it, which gives at each
word the longest run ending there that some template holds: the matching statistics. Runs that cannot be extended are
chained where they follow each other closely in the file and in order in a template; a chain that covers enough of its
template is a span. The phrases of the base rule are templates too, found wherever one of them ends a run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docsift.llm.common import id_and_text, utf8

# The phrases of the base rule and their labels.
PHRASES = {
    "the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Licence notices and the opening clauses of licence texts.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "to the extent possible under law the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide"),
    ("gpl-2", "this work is licensed under the gnu general public license version 2"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "licensed under the bsd 3 clause license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "all rights reserved"),
]

# Runs of fewer words are not chained.
SHORTEST_RUN = 3
# Words of the file, and of the template, that may lie between two runs of a chain.
LONGEST_GAP = 6
# Of its template's words a chain must cover this share, or this many words.
LEAST_SHARE = 0.75
LEAST_WORDS = 30

_BLANKED = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters (lower-cased), digits and characters beyond ASCII."""
    return text.translate(_BLANKED).split()


@dataclass
class Automaton:
    """A suffix automaton over several word lists; state 0 is the start."""

    step: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    length: list[int] = field(default_factory=lambda: [0])
    link: list[int] = field(default_factory=lambda: [-1])
    # Per state the templates and the places in them where its runs end.
    ends: list[list[tuple[int, int]]] = field(default_factory=lambda: [[]])
    # Per state the phrases that end every run of at least their length there: number and length.
    phrases: list[list[tuple[int, int]]] = field(default_factory=list)

    def _state(self, length: int, step: dict[bytes, int], link: int) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(link)
        self.ends.append([])
        return len(self.step) - 1

    def _split(self, last: int, word: bytes, target: int) -> int:
        """A copy of ``target`` for its runs that are no longer than one word after ``last``."""
        copy = self._state(self.length[last] + 1, dict(self.step[target]), self.link[target])
        self.link[target] = copy
        while last >= 0 and self.step[last].get(word) == target:
            self.step[last][word] = copy
            last = self.link[last]
        return copy

    def extend(self, last: int, word: bytes) -> int:
        known = self.step[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        new = self._state(self.length[last] + 1, {}, 0)
        at = last
        while at >= 0 and word not in self.step[at]:
            self.step[at][word] = new
            at = self.link[at]
        if at >= 0:
            target = self.step[at][word]
            self.link[new] = target if self.length[target] == self.length[at] + 1 else self._split(at, word, target)
        return new

    @classmethod
    def of(cls, templates: list[list[bytes]], phrases: list[list[bytes]]) -> Automaton:
        made = cls()
        for template in templates + phrases:
            last = 0
            for word in template:
                last = made.extend(last, word)
        direct: list[list[tuple[int, int]]] = [[] for _ in made.step]
        for number, template in enumerate(templates):
            state = 0
            for place, word in enumerate(template):
                state = made.step[state][word]
                made.ends[state].append((number, place + 1))
        for number, phrase in enumerate(phrases):
            state = 0
            for word in phrase:
                state = made.step[state][word]
            direct[state].append((number, len(phrase)))
        order = sorted(range(1, len(made.step)), key=lambda s: made.length[s])
        made.phrases = [[] for _ in made.step]
        for state in order:
            made.phrases[state] = direct[state] + made.phrases[made.link[state]]
        for state in reversed(order):
            made.ends[made.link[state]].extend(made.ends[state])
        made.ends = [sorted(set(e)) if i else [] for i, e in enumerate(made.ends)]
        return made


@dataclass
class Chain:
    start: int
    end: int
    place: int
    covered: int


class Scanner:
    """Finds phrases and template spans in the words of one text after the other."""

    def __init__(self, phrases: dict[str, str], templates: list[tuple[str, str]]):
        self.phrases = [(p.encode().split(), label) for p, label in phrases.items()]
        # Phrases are templates as well, so that the automaton knows their runs.
        self.templates = [(text.encode().split(), label) for label, text in templates] + self.phrases
        self.automaton = Automaton.of([t for t, _ in self.templates], [p for p, _ in self.phrases])
        self.known = {w for t, _ in self.templates for w in t}
        self.shortest = min([SHORTEST_RUN, *(len(p) for p, _ in self.phrases)])

    def statistics(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """``place, state, length`` of the longest run ending at each word that may belong to a long enough run."""
        known = np.fromiter(map(self.known.__contains__, words), dtype=bool, count=len(words))
        edges = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
        step, length_of, link = self.automaton.step, self.automaton.length, self.automaton.link
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if end - start < self.shortest:
                continue
            state, length = 0, 0
            for i in range(start, end):
                word = words[i]
                while state and word not in step[state]:
                    state = link[state]
                    length = length_of[state]
                state = step[state].get(word, 0)
                length = length + 1 if state else 0
                yield i, state, length

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, float]]]:
        """Phrases as ``start, number``, and spans as ``start, end, template, share``; all chains count as spans."""
        found: list[tuple[int, int]] = []
        runs: list[tuple[int, int, int]] = []  # end, state, length
        before = (-2, 0, 0)
        for place, state, length in self.statistics(words):
            found += [(place - n + 1, number) for number, n in self.automaton.phrases[state] if n <= length]
            if before[2] >= SHORTEST_RUN and (place != before[0] + 1 or length <= before[2]):
                runs.append((before[0] + 1, before[1], before[2]))
            before = (place, state, length)
        if before[2] >= SHORTEST_RUN:
            runs.append((before[0] + 1, before[1], before[2]))
        open_: dict[int, Chain] = {}
        spans = []

        def close(template: int) -> None:
            chain = open_.pop(template)
            spans.append((chain.start, chain.end, template, chain.covered / len(self.templates[template][0])))

        for end, state, length in runs:
            hits: dict[int, list[int]] = {}
            for template, place in self.automaton.ends[state]:
                hits.setdefault(template, []).append(place)
            for template, places in hits.items():
                chain = open_.get(template)
                if chain is not None:
                    # The first place after the chain's own; what overlaps in file or template counts once.
                    later = [p for p in places if p > chain.place]
                    if later and end - length - chain.end <= LONGEST_GAP and later[0] - length - chain.place <= LONGEST_GAP:
                        chain.covered += min(length, end - chain.end, later[0] - chain.place)
                        chain.end, chain.place = end, later[0]
                        continue
                    close(template)
                open_[template] = Chain(end - length, end, places[0], length)
        for template in list(open_):
            close(template)
        return found, spans

    def accepted(self, share: float, template: int) -> bool:
        return share >= LEAST_SHARE or share * len(self.templates[template][0]) >= LEAST_WORDS


_SPAN = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("share", pa.float64())])
_COLUMNS = {
    "doc_id": pa.int64(),
    "n_words": pa.int64(),
    "n_base": pa.int64(),
    "first_word": pa.int64(),
    "last_word": pa.int64(),
    "base_labels": pa.string(),
    "labels": pa.string(),
    "score": pa.float64(),
    "spans": pa.list_(_SPAN),
}


def license_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: dict[str, str] | None = None,
    templates: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """One row per document: words, places of the base phrases, labels, score and the spans covered by templates.

    ``n_base`` counts all places of phrases, overlapping ones too; ``first_word`` and ``last_word`` are their smallest
    and largest start, null if there is none. ``base_labels`` and ``labels`` are distinct, sorted and joined by commas,
    empty if there is none. ``score`` is the largest share of a template that a chain covers, 1 for a phrase. A null or
    empty text has no words. Ids may be null or repeated; rows are scanned each. Other columns are ignored. The automaton
    has at most two states per word of the templates, whatever the corpus; files are read in one pass and never split.
    """
    scanner = Scanner(PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                words = words_of(text)
                found, spans = scanner.scan(words)
                base = {scanner.phrases[number][1] for _, number in found}
                good = [
                    {"label": scanner.templates[t][1], "start": a, "end": b, "share": min(1.0, share)}
                    for a, b, t, share in sorted(spans)
                    if scanner.accepted(share, t)
                ]
                starts = [start for start, _ in found]
                labels = sorted(base | {s["label"] for s in good})
                score = 1.0 if found else min(1.0, max((share for *_, share in spans), default=0.0))
                ends = (min(starts), max(starts)) if starts else (None, None)
                rows.append((doc_id, len(words), len(found), *ends, ",".join(sorted(base)), ",".join(labels), score, good))
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(_COLUMNS)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _COLUMNS.values(), strict=True)], names=list(_COLUMNS))

    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "spans array<struct<label: string, start: long, end: long, share: double>>"
    )
    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)
