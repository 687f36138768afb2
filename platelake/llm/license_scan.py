"""License scans by template markup.

A template is license wording with two kinds of regions, after the public matching guidelines for license templates:

    <<beginOptional>> ... <<endOptional>>          wording that may be left out; may be nested
    <<var;name=N;match=one two|three>>             one of the given wordings
    <<var;name=N;words=a-b>>                       from a to b words of any kind

It is compiled to an automaton over words. A text is accepted where the automaton runs from a place to its end: the mandatory
wording then stands there exactly, apart from case, punctuation and white space, which are not words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platelake.llm.shared import LOWER, byte_column

#: Words of lower-cased text.
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
_IS_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])

#: Base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

_OPEN = '<<beginOptional>><<var;name=subject;match=this work|this software|this program|this project|this file|this document>> <<beginOptional>>is<<endOptional>><<endOptional>>'
_VERB = "<<var;name=verb;match=licensed|released|distributed|available|provided>>"

#: Templates by the label that they give.
TEMPLATES = {
    "notice:mit": f"{_OPEN} {_VERB} under <<beginOptional>>the terms of<<endOptional>> <<beginOptional>>the<<endOptional>> MIT License",
    "notice:apache-2.0": f"{_OPEN} {_VERB} under <<beginOptional>>the terms of<<endOptional>> the Apache License <<beginOptional>>Version<<endOptional>> <<var;name=version;match=2.0|2>>",
    "notice:gpl": f"{_OPEN} {_VERB} under <<beginOptional>>the terms of<<endOptional>> the GNU <<beginOptional>><<var;name=kind;match=lesser|affero|library>><<endOptional>> General Public License <<beginOptional>>as published by the Free Software Foundation<<endOptional>> <<beginOptional>>either<<endOptional>> <<beginOptional>>version <<var;name=version;words=1-2>><<endOptional>>",
    "notice:cc-by": f"{_OPEN} {_VERB} under <<beginOptional>><<var;name=article;match=a|the>><<endOptional>> <<var;name=name;match=cc|creative commons>> <<var;name=by;match=by|attribution>> <<beginOptional>><<var;name=nc;match=nc|noncommercial|sa|sharealike|nd|noderivatives|nc sa|nc nd>><<endOptional>> <<var;name=version;match=1.0|2.0|2.5|3.0|4.0>> <<beginOptional>><<var;name=scope;match=international|unported|generic>><<endOptional>> <<beginOptional>>license<<endOptional>>",
    "text:mit": "<<beginOptional>>MIT License<<endOptional>> <<beginOptional>>Copyright <<var;name=holder;words=0-24>><<endOptional>> Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions of the Software.",
    "text:isc": "<<beginOptional>>ISC License<<endOptional>> <<beginOptional>>Copyright <<var;name=holder;words=0-24>><<endOptional>> Permission to use, copy, modify, <<var;name=and;match=and or|and>> distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "notice:bsd": f"{_OPEN} {_VERB} under <<beginOptional>>the terms of<<endOptional>> <<beginOptional>><<var;name=article;match=a|the>><<endOptional>> <<beginOptional>><<var;name=kind;match=2 clause|3 clause|two clause|three clause|new|simplified|modified>><<endOptional>> BSD <<beginOptional>><<var;name=style;match=2 clause|3 clause|style>><<endOptional>> License",
    "notice:mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, <<var;name=v;match=v|version>> 2.0. If a copy of the MPL was not distributed with this file, you can obtain one at <<var;name=scheme;match=http|https>> mozilla.org/MPL/2.0",
    "text:bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: <<beginOptional>>1<<endOptional>> Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. <<beginOptional>>2<<endOptional>> Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. <<beginOptional>><<beginOptional>>3<<endOptional>> Neither the name of <<var;name=holder;words=1-24>> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.<<endOptional>>",
    "text:unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}


def words_of(text: str | bytes) -> list[bytes]:
    """Words of a text, A-Z lower-cased."""
    return _WORDS.findall((text.encode() if isinstance(text, str) else text).translate(LOWER))


@dataclass
class Automaton:
    """States with moves on a word, on any word (None) and on nothing (skips); state 0 starts, the last one accepts."""

    moves: list[dict[bytes | None, set[int]]] = field(default_factory=list)
    skips: list[set[int]] = field(default_factory=list)

    def state(self) -> int:
        self.moves.append({})
        self.skips.append(set())
        return len(self.moves) - 1

    def chain(self, at: int, words: list[bytes | None]) -> int:
        for w in words:
            to = self.state()
            self.moves[at].setdefault(w, set()).add(to)
            at = to
        return at

    def closure(self, states: set[int]) -> frozenset[int]:
        todo, found = list(states), set(states)
        while todo:
            for s in self.skips[todo.pop()]:
                if s not in found:
                    found.add(s)
                    todo.append(s)
        return frozenset(found)


def compile_template(markup: str) -> Automaton:
    """The automaton of a template; raises ValueError on markup that does not close."""
    a = Automaton()
    at, open_ = a.state(), []
    for part in re.split(r"(<<.*?>>)", markup, flags=re.S):
        if part == "<<beginOptional>>":
            open_.append(at)
        elif part == "<<endOptional>>":
            if not open_:
                raise ValueError("endOptional without beginOptional")
            end = a.state()
            a.skips[at].add(end)
            a.skips[open_.pop()].add(end)
            at = end
        elif part.startswith("<<var;"):
            named = dict(x.split("=", 1) for x in part[6:-2].split(";"))
            end = a.state()
            if "match" in named:
                for choice in named["match"].split("|"):
                    a.skips[a.chain(at, list(words_of(choice)))].add(end)
            else:
                least, most = map(int, named["words"].split("-"))
                at = a.chain(at, [None] * least)
                a.skips[at].add(end)
                for _ in range(most - least):
                    at = a.chain(at, [None])
                    a.skips[at].add(end)
            at = end
        elif part.startswith("<<"):
            raise ValueError(f"unknown markup {part}")
        else:
            at = a.chain(at, list(words_of(part)))
    if open_:
        raise ValueError("beginOptional without endOptional")
    last = a.state()
    a.skips[at].add(last)
    return a


class Scanner:
    """Finds where templates are accepted; subset states are made as texts need them."""

    def __init__(self, templates: dict[str, str]):
        self.automata = {label: compile_template(t) for label, t in templates.items()}
        self.starts = {label: a.closure({0}) for label, a in self.automata.items()}
        self.steps: dict[tuple[str, frozenset[int], bytes], frozenset[int]] = {}
        self.first: dict[bytes, list[str]] = {}
        for label, a in self.automata.items():
            if None in (firsts := {w for s in self.starts[label] for w in a.moves[s]}) or len(a.moves) - 1 in self.starts[label]:
                raise ValueError(f"template {label} must start with a word of its own")
            for w in firsts:
                self.first.setdefault(w, []).append(label)
        # A template without its optional regions: some word that every accepted text holds, the longest; it rules texts out early.
        self.anchors = {label: self._anchor(a) for label, a in self.automata.items()}

    def _anchor(self, a: Automaton) -> bytes:
        def reachable(banned: bytes | None) -> bool:
            now = todo = {0}
            while todo:
                new = set()
                for s in todo:
                    new |= a.skips[s] | {t for w, ts in a.moves[s].items() if w is None or w != banned for t in ts}
                todo = new - now
                now = now | new
            return len(a.moves) - 1 in now

        held = {w for m in a.moves for w in m if w is not None}
        return max((w for w in held if not reachable(w)), key=lambda w: (len(w), w), default=b"")

    def step(self, label: str, states: frozenset[int], word: bytes) -> frozenset[int]:
        key = (label, states, word)
        found = self.steps.get(key)
        if found is None:
            a = self.automata[label]
            found = a.closure({t for s in states for w in (word, None) for t in a.moves[s].get(w, ())})
            if len(self.steps) > 100_000:
                self.steps.clear()
            self.steps[key] = found
        return found

    def spans(self, text: bytes, words: list[bytes]) -> list[tuple[str, int, int]]:
        """(label, first word, word after the last) of the longest acceptance at each place, of lower-cased text."""
        able = {label for label, w in self.anchors.items() if w in text}
        found = []
        if able:
            for i, w in enumerate(words):
                for label in self.first.get(w, ()):
                    if label in able:
                        states, j, end, last = self.starts[label], i, 0, len(self.automata[label].moves) - 1
                        while states and j < len(words):
                            states = self.step(label, states, words[j])
                            j += 1
                            if last in states:
                                end = j
                        if end:
                            found.append((label, i, end))
        return found


def scan_licenses(docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    n_base counts the places of the base phrases, first_word and last_word are the least and greatest start (null without any).
    labels also has those of accepted templates; spans lists label:first-end of each acceptance. score is 0 without a label,
    0.5 with base phrases alone, and from 0.75 up to 1 with accepted templates, by the share of the words that they cover.
    Null and empty texts have no words and the score 0; texts of any length are scanned whole; repeated rows and null identifiers
    are rows like others; other columns are not read. An empty input gives an empty result.
    """
    phrases = PHRASES if phrases is None else phrases
    templates = TEMPLATES if templates is None else templates
    between = rb"[^0-9a-z\x80-\xff]+"
    looks = [(re.compile(rb"(?<![0-9a-z\x80-\xff])" + between.join(words_of(p)) + rb"(?![0-9a-z\x80-\xff])"), words_of(p), label) for p, label in phrases.items()]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        hints = sorted({max(words_of(p), key=len) for p in phrases} | set(scanner.anchors.values()))
        hint = re.compile(b"|".join(map(re.escape, hints)))
        for b in parts:
            for k in range(0, b.num_rows, 512):
                some = b.slice(k, 512)
                raw, at = byte_column(some.column(1))
                whole = raw.tobytes().translate(LOWER)
                is_word = _IS_WORD[np.frombuffer(whole, np.uint8)]
                new = is_word.copy()
                new[1:] &= ~is_word[:-1]
                heads = at[:-1][at[:-1] < len(new)]
                new[heads] = is_word[heads]
                counts = np.diff(np.searchsorted(np.flatnonzero(new), at))
                rows = []
                ends = at.tolist()
                for n, x, y in zip(counts.tolist(), ends, ends[1:]):
                    text = whole[x:y]
                    rows.append(one(scanner, text, n) if hint.search(text) else (n, 0, None, None, "", "", 0.0, []))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([some.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows), kinds))], names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    def one(scanner: Scanner, text: bytes, n: int) -> tuple:
        words = _WORDS.findall(text)
        places, base = [], set()
        for look, parts, label in looks:
            if look.search(text):
                base.add(label)
                places += [i for i in range(len(words) - len(parts) + 1) if words[i] == parts[0] and words[i : i + len(parts)] == parts]
        spans = scanner.spans(text, words)
        covered = set().union(*(range(a, z) for _, a, z in spans)) if spans else ()
        score = 0.75 + 0.25 * len(covered) / n if spans else 0.5 if base else 0.0
        labels = sorted(base | {label for label, *_ in spans})
        return n, len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(labels), score, [f"{label}:{a}-{z}" for label, a, z in spans]

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<string>"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
