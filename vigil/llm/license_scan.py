"""Licence texts in documents by a generalised suffix automaton of licence words.

The automaton holds every word sequence of all phrases and templates.  A text streams through it word by word; at
each word the state and the length of the longest match that ends there are its matching statistics.  A phrase ends
where its state, or one whose suffix it is, is reached with enough length.  Matches that cannot be extended and have
``MIN_MATCH`` words or more are chained per template, in order in both, with gaps of at most ``MAX_GAP`` words; a
chain that covers ``MIN_COVER`` of a template gives a span and the template's label.  Licences of one family share
nearly all their words; a span counts only if just the words that tell its licence from its relatives stand in it or
within ``MARGIN`` words of it.  Of spans that overlap, the one that covers the most words is kept.  Words outside
the vocabulary reset the state, so only runs of known words are walked.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.  A text is taken in blocks with the state
carried over, so its length is no matter.  Null counts as empty: no words, no label, score 0.  A text with a phrase has
score 1, any other the best coverage of a template that no such word speaks against.  Rows are treated one by one; an
empty table gives none.  Other columns are ignored.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from vigil.llm.licenses import FAMILIES, PHRASES, SYNONYMS, TEMPLATES
from vigil.llm.shared import whole_text

MIN_MATCH = 6
MAX_GAP = 40
MIN_COVER = 0.5
MARGIN = 4
BLOCK = 1 << 20

_KEEP = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 32 for c in range(256)
)
_SCANNERS: dict[str, Scanner] = {}


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_KEEP).split()


def _blocks(data: bytes) -> Iterator[list[bytes]]:
    start = 0
    while start < len(data):
        end = start + BLOCK
        if end < len(data):
            cut = data.rfind(b" ", start, end)
            if cut <= start:
                cut = data.find(b" ", end)
            end = len(data) if cut < 0 else cut + 1
        yield data[start:end].split()
        start = end


class Automaton:
    """Suffix automaton of several sequences."""

    def __init__(self) -> None:
        self.steps: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]  # (sequence, position of the last element)

    def _state(self, length: int, steps: dict[int, int], link: int) -> int:
        self.steps.append(steps)
        self.length.append(length)
        self.link.append(link)
        self.ends.append(set())
        return len(self.link) - 1

    def _split(self, state: int, element: int) -> int:
        """The state for the extension of ``state``'s longest string, parted from longer ones if need be."""
        target = self.steps[state][element]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(self.length[state] + 1, dict(self.steps[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.steps[state].get(element) == target:
            self.steps[state][element] = copy
            state = self.link[state]
        return copy

    def add(self, number: int, sequence: list[int]) -> None:
        last = 0
        for position, element in enumerate(sequence):
            if element in self.steps[last]:
                last = self._split(last, element)
            else:
                new, state = self._state(self.length[last] + 1, {}, 0), last
                while state >= 0 and element not in self.steps[state]:
                    self.steps[state][element] = new
                    state = self.link[state]
                if state >= 0:
                    self.link[new] = self._split(state, element)
                last = new
            self.ends[last].add((number, position))

    def close(self) -> None:
        """Every state gets the ends of the states it is a suffix of."""
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                self.ends[self.link[state]] |= self.ends[state]


class Scanner:
    def __init__(self, phrases: dict[str, str], templates: dict[str, list[str]]):
        self.phrases = [(words(p), label) for p, label in phrases.items()]
        self.templates = [(words(t), label) for label, texts in templates.items() for t in texts]
        self.number: dict[bytes, int] = {}
        self.automaton = Automaton()
        for i, (sequence, _) in enumerate(self.phrases + self.templates):
            self.automaton.add(i, [self.number.setdefault(w, len(self.number)) for w in sequence])
        self.automaton.close()
        self.shortest = min(len(p) for p, _ in self.phrases)
        #: For each licence of a family, the family's telling words and its own; and the words by their number.
        self.own: dict[str, tuple[set[str], set[str]]] = {}
        for members in FAMILIES.values():
            every = set().union(*members.values())
            self.own |= {label: (every, words) for label, words in members.items()}
        telling = {w: w for every, _ in self.own.values() for w in every} | SYNONYMS
        self.meaning = {self.number.setdefault(w.encode(), len(self.number)): x for w, x in telling.items()}
        self.tells = np.zeros(len(self.number) + 1, dtype=bool)  # the last place is that of unknown words, -1
        self.tells[list(self.meaning)] = True
        n = len(self.phrases)
        # Phrases that end in a state: those whose last word is among its ends and whose length it can have.
        self.phrase_at: list[list[tuple[int, int]]] = []
        self.template_at: list[list[tuple[int, int]]] = []
        for ends in self.automaton.ends:
            self.phrase_at.append([(i, len(self.phrases[i][0])) for i, e in sorted(ends) if i < n and e == len(self.phrases[i][0]) - 1])
            self.template_at.append([(i - n, e) for i, e in sorted(ends) if i >= n])
        # A phrase may also end inside a template: there its words end in states of the template alone.
        for state, ends in enumerate(self.automaton.ends):
            known = {i for i, _ in self.phrase_at[state]}
            for i, (phrase, _) in enumerate(self.phrases):
                if i not in known and self.automaton.length[state] >= len(phrase):
                    for j, e in ends:
                        sequence = (self.phrases + self.templates)[j][0]
                        if sequence[e - len(phrase) + 1 : e + 1] == phrase:
                            self.phrase_at[state].append((i, len(phrase)))
                            break

    def scan(self, text: str) -> tuple[int, list[tuple[int, str]], list[tuple[int, int, str, float]], float]:
        """Number of words, places of phrases, covered spans (first word, end, label, coverage), best coverage."""
        data = text.encode("utf-8", "surrogatepass").translate(_KEEP)
        steps, link, lengths = self.automaton.steps, self.automaton.link, self.automaton.length
        get = self.number.get
        total, state, matched = 0, 0, 0
        places: list[tuple[int, str]] = []
        maximal: list[tuple[int, int, int]] = []  # end, words, state
        told: list[tuple[int, str]] = []  # place and meaning of telling words
        for block in _blocks(data):
            known = np.fromiter([get(w, -1) for w in block], dtype=np.int32, count=len(block))
            told += [(total + i, self.meaning[int(known[i])]) for i in np.flatnonzero(self.tells[known]).tolist()]
            if len(block) and known[0] < 0:
                self._leave(maximal, total - 1, state, matched)
                state = matched = 0
            edge = np.flatnonzero(np.diff((known >= 0).astype(np.int8), prepend=0, append=0))
            for first, end in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                if first > 0 and end - first < self.shortest and end < len(block):
                    continue
                for i in range(first, end):
                    element = int(known[i])
                    if element not in steps[state]:
                        self._leave(maximal, total + i - 1, state, matched)
                        while state > 0 and element not in steps[state]:
                            state = link[state]
                            matched = lengths[state]
                    if element in steps[state]:
                        state = steps[state][element]
                        matched += 1
                    for phrase, size in self.phrase_at[state]:
                        if matched >= size:
                            places.append((total + i - size + 1, self.phrases[phrase][1]))
                if end < len(block):
                    self._leave(maximal, total + end - 1, state, matched)
                    state = matched = 0
            total += len(block)
        self._leave(maximal, total - 1, state, matched)
        spans, best = self._chosen(self._chains(maximal), told)
        return total, places, spans, best

    @staticmethod
    def _leave(maximal: list, end: int, state: int, matched: int) -> None:
        if matched >= MIN_MATCH and (not maximal or maximal[-1] != (end, matched, state)):
            maximal.append((end, matched, state))

    def _chains(self, maximal: list[tuple[int, int, int]]) -> list[tuple[int, int, str, float]]:
        """First word, end, label, coverage and covered words of every chain."""
        chains = []
        open_: dict[int, list] = {}  # template: first word, end in text, end in template, covered words

        def close(template: int) -> None:
            first, end, _, covered = open_.pop(template)
            chains.append((first, end, self.templates[template][1], min(1.0, covered / len(self.templates[template][0])), covered))

        for end, size, state in maximal:
            at: dict[int, list[int]] = {}
            for template, e in self.template_at[state]:
                at.setdefault(template, []).append(e)
            for template, ends in at.items():
                chain = open_.get(template)
                start = end - size + 1
                if chain:
                    later = [e for e in ends if e > chain[2]]
                    if later and start - chain[1] <= MAX_GAP:
                        e = later[0]
                        chain[3] += min(size, e - chain[2], end + 1 - chain[1])
                        chain[1], chain[2] = end + 1, e
                        continue
                    close(template)
                open_[template] = [start, end + 1, ends[0], size]
        for template in list(open_):
            close(template)
        return chains

    def _refuted(self, first: int, end: int, label: str, told: list[tuple[int, str]]) -> bool:
        """Whether a relative of the licence is meant: other telling words stand there than its own."""
        if label not in self.own:
            return False
        every, own = self.own[label]
        left, right = bisect.bisect_left(told, (first - MARGIN, "")), bisect.bisect_left(told, (end + MARGIN, ""))
        return {word for _, word in told[left:right]} & every != own

    def _chosen(self, chains: list, told: list[tuple[int, str]]) -> tuple[list[tuple[int, int, str, float]], float]:
        meant = [c for c in chains if not self._refuted(*c[:3], told)]
        kept: list[tuple[int, int, str, float]] = []  # in order, none overlaps another
        for first, end, label, share, _ in sorted((c for c in meant if c[3] >= MIN_COVER), key=lambda c: (-c[4], -c[3], c)):
            at = bisect.bisect_left(kept, (first, end, label, share))
            if (at == 0 or kept[at - 1][1] <= first) and (at == len(kept) or end <= kept[at][0]):
                kept.insert(at, (first, end, label, share))
        return kept, max((c[3] for c in meant), default=0.0)


def scanner() -> Scanner:
    if "default" not in _SCANNERS:
        _SCANNERS["default"] = Scanner(PHRASES, TEMPLATES)
    return _SCANNERS["default"]


_RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double,"
    " spans array<struct<first:long,end:long,label:string,coverage:double>>"
)


def found(text: Column) -> Column:
    """Struct of counts, labels, score and covered spans for a text column."""

    @F.pandas_udf(_RESULT)
    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            n, places, spans, best = scanner().scan(text)
            starts = [p for p, _ in places]
            base = {label for _, label in places}
            labels = base | {s[2] for s in spans}
            rows.append(
                (n, len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)),
                 1.0 if base else best, [dict(zip(("first", "end", "label", "coverage"), s, strict=True)) for s in spans])
            )
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
        return pd.DataFrame(rows, columns=names).astype({"first_word": "Int64", "last_word": "Int64"})

    return scan(F.coalesce(text, F.lit("")))


def scan_licenses(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", found(whole_text()).alias("r")).select("doc_id", "r.*")
