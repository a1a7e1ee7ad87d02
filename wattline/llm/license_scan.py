"""License scans by template matching.

A template is a text with markup: ``<<optional>>...<<end>>`` may be missing, ``<<any:N>>`` stands for
up to N words of any kind. Each template is compiled into an automaton over words; a place matches
if all mandatory words follow each other there exactly, in order. An automaton is started only at its
first mandatory words, so texts without them cost one search.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import DataFrame

from wattline.llm.common import map_rows, texts

#: Fixed values of the base scan: phrase and label.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: The templates of the method: label and markup. Words are compared in lower case without punctuation.
TEMPLATES = (
    ("mit", "<<optional>>this <<any:3>> is<<end>> <<optional>>released under<<end>> <<optional>>the<<end>> mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this <<any:6>> and associated documentation files"),
    ("apache-2.0", "<<optional>>licensed under<<end>> <<optional>>the<<end>> apache license <<optional>>version<<end>> 2 0"),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use <<any:4>> except in compliance with the license"),
    ("gpl-3.0", "gnu general public license <<optional>>as published by the free software foundation either<<end>> version 3"),
    ("gpl-2.0", "gnu general public license <<optional>>as published by the free software foundation either<<end>> version 2"),
    ("lgpl", "gnu <<any:1>> lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("cc-by", "licensed under <<optional>>a<<end>> <<optional>>creative commons<<end>> cc by <<optional>>international<<end>> 4 0"),
    ("cc-by-sa", "licensed under <<optional>>a<<end>> <<optional>>creative commons<<end>> cc by sa <<optional>>international<<end>> 4 0"),
    ("cc-by-nc", "licensed under <<optional>>a<<end>> <<optional>>creative commons<<end>> cc by nc <<optional>>international<<end>> 4 0"),
    ("cc-by", "creative commons attribution <<optional>>4 0<<end>> <<optional>>international<<end>> license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "bsd <<any:2>> license"),
    ("mpl-2.0", "mozilla public license <<optional>>v<<end>> <<optional>>version<<end>> 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("rights-reserved", "all rights reserved"),
)

#: Bytes that end a word become spaces, A-Z become a-z; all others, non-ASCII ones too, are word bytes.
WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words: runs of letters, digits and non-ASCII characters."""
    return text.translate(WORDS).split()


@dataclass
class Automaton:
    """States of one template; ``arcs[s]`` maps a word to the next state, ``free[s]`` are states reached without a word."""

    label: str
    mandatory: list[bytes] = field(default_factory=list)
    arcs: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    wild: dict[int, int] = field(default_factory=dict)
    free: dict[int, list[int]] = field(default_factory=dict)

    def add(self, state: int, word: bytes) -> int:
        self.arcs.append({})
        self.arcs[state][word] = len(self.arcs) - 1
        return len(self.arcs) - 1

    def close(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for target in self.free.get(todo.pop(), ()):
                if target not in states:
                    states.add(target)
                    todo.append(target)
        return states

    def firsts(self) -> set[bytes]:
        return {word for state in self.close({0}) for word in self.arcs[state]}

    def match(self, words: list[bytes], at: int) -> int | None:
        """The end of the shortest match that begins at ``at``."""
        states, last = self.close({0}), len(self.arcs) - 1
        for i in range(at, len(words)):
            stepped = {self.arcs[s][words[i]] for s in states if words[i] in self.arcs[s]}
            stepped |= {self.wild[s] for s in states if s in self.wild}
            states = self.close(stepped)
            if last in states:
                return i + 1
            if not states:
                return None
        return None


def compiled(label: str, markup: str) -> Automaton:
    """The automaton of a template. Optional regions and replaceable ones get arcs that use up no word."""
    automaton, state, opened = Automaton(label), 0, []
    for token in re.findall(r"<<[^>]*>>|[^<\s]+", markup):
        if token == "<<optional>>":
            opened.append(state)
        elif token == "<<end>>":
            automaton.free.setdefault(opened.pop(), []).append(state)
        elif token.startswith("<<any:"):
            before = [state]
            for _ in range(int(token[6:-2])):
                automaton.arcs.append({})
                automaton.wild[state] = state = len(automaton.arcs) - 1
                before.append(state)
            for skipped in before[:-1]:
                automaton.free.setdefault(skipped, []).append(state)
        else:
            state = automaton.add(state, token.encode())
            if not opened:
                automaton.mandatory.append(token.encode())
    return automaton


@dataclass
class Scanner:
    automata: list[Automaton]
    base: list[tuple[list[bytes], str]]

    def __post_init__(self) -> None:
        self.starts: dict[bytes, list[Automaton]] = {}
        for automaton in self.automata:
            for word in automaton.firsts():
                self.starts.setdefault(word, []).append(automaton)
        self.ends: dict[bytes, list[tuple[list[bytes], str]]] = {}
        for phrase, label in self.base:
            self.ends.setdefault(phrase[-1], []).append((phrase, label))
        #: The longest mandatory word of each template and phrase; texts with none of them cannot match.
        wordings = [a.mandatory for a in self.automata] + [phrase for phrase, _ in self.base]
        self.needed = {max(words, key=len) for words in wordings}

    def spans(self, words: list[bytes]) -> Iterator[tuple[int, int, str, str, int]]:
        """All places: first word, end, label, ``base`` or ``template``, and the mandatory words."""
        if self.needed.isdisjoint(words):
            return
        for i, word in enumerate(words):
            for phrase, label in self.ends.get(word, ()):
                begin = i + 1 - len(phrase)
                if begin >= 0 and words[begin : i + 1] == phrase:
                    yield begin, i + 1, label, "base", len(phrase)
            for automaton in self.starts.get(word, ()):
                if (end := automaton.match(words, i)) is not None:
                    yield i, end, automaton.label, "template", len(automaton.mandatory)


@cache
def scanner(templates: tuple, base: tuple) -> Scanner:
    return Scanner([compiled(*t) for t in templates], [(p.encode().split(), label) for p, label in base])


def scan(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    templates: tuple = TEMPLATES,
    base: tuple = BASE,
) -> DataFrame:
    """One row per input row with the places found in its whole text.

    ``n_words``; ``spans`` (begin, end, label, kind and mandatory words of each place, as text);
    ``n_base, first_word, last_word`` of the base phrases; ``base_labels`` and ``labels``, distinct,
    sorted and joined by commas; ``score``, the share of certainty: 0 without a place, else
    m / (m + 2) for the longest place with m mandatory words. Null and empty texts have no words.
    Every row is judged by itself, so rows without a number and repeated rows stay as they are.
    Other columns are not looked at; an empty table gives no rows.
    """

    def each():
        spans_of = scanner(templates, base).spans

        def row(doc_id: int | None, text: bytes) -> Iterator[tuple]:
            words = words_of(text)
            found = list(spans_of(words))
            places = [s for s in found if s[3] == "base"]
            longest = max((s[4] for s in found), default=0)
            yield (
                doc_id,
                len(words),
                [f"{begin}-{end} {label} {kind}" for begin, end, label, kind, _ in found],
                len(places),
                min((s[0] for s in places), default=None),
                max((s[0] for s in places), default=None),
                ",".join(sorted({s[2] for s in places})),
                ",".join(sorted({s[2] for s in found})),
                longest / (longest + 2),
            )

        return row

    schema = (
        "doc_id long, n_words long, spans array<string>, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double"
    )
    return map_rows(texts(df, id_column, text_column), schema, each)
