"""Licence scans: a generalised suffix automaton over the words of licence templates.

All templates go into one automaton. A text is streamed through it: after each word the automaton's state and length
are the longest suffix read so far that stands in some template (matching statistics), and the states on the way to
the root give the longest such suffix for every other template. Runs that stay on one diagonal (same distance between
text and template) are the long matches; long matches of a template that follow each other in both are chained, and
the share of the template's words that a chain covers is its coverage.

Only places where two neighbouring words stand side by side in a template can be part of a match of two words or
more. Each slice of a partition finds them by array look-ups, and only those runs go through the automaton.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenlake.llm.terms import coded_words, row_slices

#: Phrases that label a text wherever their words stand side by side (fixed values).
PHRASES = [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]

#: Notices and opening words of common licences (fixed values).
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc-4.0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa-4.0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0-1.0", "cc0 1 0 universal public domain dedication"),
    ("gpl-2.0", "licensed under the gnu general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("gpl-header", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]

#: The automaton is sent to every task, so the words of all templates and phrases together are bounded.
MOST_WORDS = 200_000


class SuffixAutomaton:
    """Generalised suffix automaton of word id sequences with the places where each state's words end."""

    def __init__(self, sequences: Sequence[Sequence[int]]):
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[list[tuple[int, int]]] = [[]]
        for number, words in enumerate(sequences):
            state = 0
            for place, word in enumerate(words):
                state = self._extend(state, word)
                while len(ends) < len(self.length):
                    ends.append([])
                ends[state].append((number, place))
        #: state -> (sequence, last place) of the prefixes that end in this very state
        self.prefixes = ends
        #: state -> (sequence, last place) of every place where its words end
        self.ends: list[list[tuple[int, int]]] = [list(e) for e in ends]
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.ends[self.link[state]].extend(self.ends[state])

    def _new(self, length: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, state: int, word: int) -> int:
        """The state for exactly the words of ``state`` and then ``word``: the one there, or a copy of that length."""
        target, length = self.step[state][word], self.length[state] + 1
        if self.length[target] == length:
            return target
        copy = self._new(length, dict(self.step[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.step[state].get(word) == target:
            self.step[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, state: int, word: int) -> int:
        if word in self.step[state]:
            return self._split(state, word)
        fresh = self._new(self.length[state] + 1, {}, 0)
        while state >= 0 and word not in self.step[state]:
            self.step[state][word] = fresh
            state = self.link[state]
        if state >= 0:
            self.link[fresh] = self._split(state, word)
        return fresh

    def read(self, words: Sequence[int]) -> Iterator[tuple[int, int]]:
        """Matching statistics: (state, length) of the longest suffix of the words so far, after each word."""
        step, link, lengths = self.step, self.link, self.length
        state = length = 0
        for word in words:
            while state and word not in step[state]:
                state = link[state]
                length = lengths[state]
            following = step[state].get(word)
            if following is not None:
                state, length = following, length + 1
            yield state, length


class Scanner:
    """Templates and phrases, ready to scan coded texts."""

    def __init__(self, templates: Sequence[tuple[str, str]], phrases: Sequence[tuple[str, str]], least: int, gap: int):
        cut = lambda text: [w.as_py() for w in pa.array(coded_words(pa.array([text]))[1]).take(pa.array(coded_words(pa.array([text]))[0]))]
        self.least, self.gap = least, gap
        listed = [(label, cut(text)) for label, text in templates]
        self.templates = [(label, words) for label, words in listed if len(words) >= least]
        self.phrases = [(label, words) for label, words in ((label, cut(text)) for label, text in phrases) if words]
        sequences = [words for _, words in self.templates + self.phrases]
        if sum(map(len, sequences)) > MOST_WORDS:
            raise ValueError(f"the templates have more than {MOST_WORDS} words together")
        ids = {word: i + 1 for i, word in enumerate(sorted({w for words in sequences for w in words}))}
        self.vocabulary = pa.array(list(ids), pa.binary())  # ids from 1, in this order
        numbered = [[ids[w] for w in words] for words in sequences]
        self.automaton = SuffixAutomaton(numbered)
        self.pairs = np.unique(np.array([a * (len(ids) + 1) + b for words in numbered for a, b in zip(words, words[1:])], np.int64))
        self.single = sorted({words[0] for words in numbered[len(self.templates) :] if len(words) == 1})
        #: state -> phrases that its words end with, and the length each needs
        self.outputs: dict[int, list[tuple[int, int]]] = defaultdict(list)
        home = {}
        for p, words in enumerate(numbered[len(self.templates) :]):
            *_, (state, _) = self.automaton.read(words)
            home.setdefault(state, []).append((p, len(words)))
        for state in range(len(self.automaton.length)):
            above = state
            while above > 0:
                self.outputs[state] += home.get(above, [])
                above = self.automaton.link[above]
        self.outputs = {state: found for state, found in self.outputs.items() if found}

    def segments(self, ids: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(text, start, stop) of the runs of words whose neighbours stand side by side in a template."""
        if len(ids) == 0:
            return
        base = len(self.vocabulary) + 1
        pairs = ids[:-1].astype(np.int64) * base + ids[1:]
        at = np.minimum(np.searchsorted(self.pairs, pairs), max(len(self.pairs) - 1, 0))
        joined = np.zeros(len(ids) + 1, bool)  # word i and word i - 1 may be in one match
        if len(self.pairs):
            joined[1:-1] = self.pairs[at] == pairs
        joined[offsets] = False  # not over the end of a text
        wanted = joined[:-1] | joined[1:]
        if self.single:
            wanted |= np.isin(ids, self.single)
        starts = np.flatnonzero(wanted & ~joined[:-1])
        stops = np.flatnonzero(wanted & ~joined[1:]) + 1
        texts = np.searchsorted(offsets, starts, "right") - 1
        yield from zip(texts.tolist(), starts.tolist(), stops.tolist())

    def matches(self, ids: Sequence[int], start: int) -> tuple[dict[tuple[int, int, int], int], list[tuple[int, int]]]:
        """Long matches {(template, text place - template place, first word): last word} and phrase places (first word, phrase)."""
        automaton, least = self.automaton, self.least
        link, lengths, ends, outputs = automaton.link, automaton.length, automaton.ends, self.outputs
        n_templates = len(self.templates)
        found: dict[tuple[int, int, int], int] = {}
        places = []
        for place, (state, length) in enumerate(automaton.read(ids), start):
            for phrase, size in outputs.get(state, ()):
                if size <= length:
                    places.append((place - size + 1, phrase))
            seen: set[tuple[int, int]] = set()
            while length >= least:
                for template, end in ends[state]:
                    if template < n_templates and (template, end) not in seen:
                        seen.add((template, end))
                        found[template, place - end, place - length + 1] = place
                state = link[state]
                length = lengths[state]
        return found, places

    def chains(self, matches: dict[tuple[int, int, int], int]) -> list[tuple[int, int, int, float]]:
        """(template, first word, last word, coverage) of the best chains, best first, that do not share most of their words.

        Matches of a template are linked if both text and template go forward and at most ``gap`` words of the text
        lie between; shared words count once.
        """
        by_template = defaultdict(list)
        for (template, shift, first), last in matches.items():
            by_template[template].append((first, last, shift))
        spans = []
        for template, anchors in by_template.items():
            anchors.sort()
            best: list[tuple[int, int]] = []  # (covered words, first word of the chain) of the best chain that ends here
            oldest = 0
            for i, (first, last, shift) in enumerate(anchors):
                covered, begin = last - first + 1, first
                while anchors[oldest][0] + len(self.templates[template][1]) + self.gap < first:
                    oldest += 1
                for j in range(oldest, i):
                    other_first, other_last, other_shift = anchors[j]
                    if other_last >= last or first - other_last - 1 > self.gap or other_last - other_shift >= last - shift or other_first - other_shift >= first - shift:
                        continue
                    shared = max(0, other_last - first + 1, other_last - other_shift - (first - shift) + 1)
                    gained = best[j][0] + last - first + 1 - shared
                    if gained > covered:
                        covered, begin = gained, best[j][1]
                best.append((covered, begin))
                spans.append((covered / len(self.templates[template][1]), covered, template, begin, last))
        spans.sort(key=lambda s: (-s[1], -s[0], s[3], s[2]))
        kept: list[tuple[int, int, int, float]] = []
        taken: set[int] = set()
        for coverage, _, template, begin, last in spans:
            words = range(begin, last + 1)
            if 2 * sum(w in taken for w in words) < len(words):
                taken.update(words)
                kept.append((template, begin, last, coverage))
        return kept


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = tuple(TEMPLATES),
    phrases: Sequence[tuple[str, str]] = tuple(PHRASES),
    least: int = 3,
    gap: int = 6,
    coverage: float = 0.75,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, n_words, n_base, first_word, last_word, base_labels, labels, score, spans), one row per row of ``docs``.

    ``n_base`` counts the places where a phrase's words stand side by side, ``first_word`` and ``last_word`` are the
    smallest and largest start of those (null without any). ``spans`` lists (label, first_word, last_word, coverage)
    of the chains of matches of ``least`` words or more that cover ``coverage`` or more of a template; of chains that
    share half of their words or more, the one that covers more words stands. ``labels`` are those of phrases and
    spans, ``score`` is the highest coverage of any chain, 1 where a phrase stands.

    A null text counts as empty and has no words: zeros, nulls, empty labels, no spans. Repeated rows give a row
    each, null keys stay null, an empty table gives no rows. Very long texts are streamed; a slice holds whole rows.
    """
    frame = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    scanner = Scanner(templates, phrases, least, gap)
    span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("coverage", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_slices(batches, "text"):
            codes, dictionary, offsets = coded_words(part.column(1))
            numbers = pc.fill_null(pc.add(pc.index_in(dictionary, value_set=scanner.vocabulary), 1), 0).to_numpy(zero_copy_only=False)
            ids = numbers[codes] if len(codes) else np.zeros(0, np.int32)
            matched: dict[int, dict] = defaultdict(dict)
            base: dict[int, list] = defaultdict(list)
            for row, start, stop in scanner.segments(ids, offsets):
                found, places = scanner.matches(ids[start:stop].tolist(), start - int(offsets[row]))
                if found:
                    matched[row].update(found)
                if places:
                    base[row] += places
            out = []
            for row in range(part.num_rows):
                places, chains = base.get(row, []), scanner.chains(matched[row]) if row in matched else []
                spans = sorted((begin, last, scanner.templates[t][0], share) for t, begin, last, share in chains if share >= coverage)
                known = {scanner.phrases[p][0] for _, p in places}
                labels = known | {label for _, _, label, _ in spans}
                first, last = (min(places)[0], max(places)[0]) if places else (None, None)
                score = 1.0 if places else max((share for *_, share in chains), default=0.0)
                shown = [{"label": label, "first_word": b, "last_word": e, "coverage": share} for b, e, label, share in spans]
                out.append((len(places), first, last, ",".join(sorted(known)), ",".join(sorted(labels)), score, shown))
            columns = list(zip(*out))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(span)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(offsets), pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["key", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
            )

    kind = frame.schema["key"].dataType.simpleString()
    schema = (
        f"key {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "spans array<struct<label: string, first_word: bigint, last_word: bigint, coverage: double>>"
    )
    return frame.mapInArrow(run, schema).withColumnRenamed("key", key)
