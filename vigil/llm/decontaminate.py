"""Benchmark decontamination by latent semantic retrieval with exact checks of what it finds.

Document frequencies of hashed words are counted over all documents.  The latent space comes from a randomised SVD of the
TF-IDF matrix of passages: one job multiplies a sparse random test matrix by the matrix and its transpose, and partial
sums are added block by block.  It is fitted on the passages of all documents and all items, whose hashed words are
written once; every document is searched.

Search: words are mapped to their latent vectors and summed over windows about as long as an item (classes
``SPANS``), stepping ``STEP`` words; items of more than 96 words are looked for by parts of 64 words.  Windows whose
cosine with an item reaches ``MIN_COSINE`` are candidates.  Around
them the longest common subsequence of words with the item is taken (bit-parallel), which survives words put in, left
out and replaced.  A candidate is a match if the subsequence holds ``MIN_COVER`` of the item's words within a
stretch at most ``MAX_STRETCH`` times as long, and the answer check passes: a third of the answer's words are among the
common ones.  The answer is what stands behind an answer mark, or else the rarest quarter of the item's words.

Tasks project the items into the space, ``ITEM_BLOCK`` in a file of the shared folder; every task that searches
reads these files one after the other, so a benchmark of any size takes bounded memory.  The space is broadcast once; its
size does not depend on the data.

Items of fewer than ``MIN_WORDS`` words must stand in a text as they are: runs of as many words are compared by hash, then
word by word (cosine and cover 1); half of so few words is no evidence.  In scripts without spaces every character
counts as a word.

Null text and item text count as empty and match nothing, as do items without a word.  Texts of any length are
searched whole.  Repeated rows and repeated items are each searched.  An empty table of documents or items
gives no matches.  Other columns pass through or are ignored.
"""

from __future__ import annotations

import pickle
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from vigil.llm.shared import shared_folder, store, stored, whole_file

FEATURE_BITS = 15
FEATURES = 1 << FEATURE_BITS
RANK = 88
#: Columns of the random test matrix.
SKETCH = 96
SEED = 20_240_501
SPANS = (16, 32, 64)
STEP = 8
MIN_COSINE = 0.45
MIN_WORDS = 8
MIN_COVER = 0.5
MAX_STRETCH = 1.6
ANSWER_PART = 4
ANSWER_SHARE = 1 / 3
ITEM_BLOCK = 4_096
KEPT_BLOCKS = 8
#: Feature rows that a partial product sends as one block, passages multiplied at a time, products added at a time, and
#: coded words from which a further task is worth the product that it sends (four times its bytes).
ROWS = 4_096
PASSAGES = 64
ADDED = 32
TASK_WORDS = 4 * FEATURES * SKETCH * 4 // 2
#: Words searched at a time, and bytes hashed at a time.
BATCH = 1 << 14
BLOCK = 1 << 18

# Bytes that part words: what is not a letter or digit in ASCII.
_KEEP = bytes(c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256))
_ANSWER = re.compile(r"(?is).*(?:\banswer\s*:|\?)\s*(.+)")


#: Kinds of characters: white space, punctuation and symbols part words, format characters go, and those of scripts
#: without spaces (Thai, Lao, Myanmar, Khmer, Tai, Javanese, kana, Han and the like) are words of their own.
PARTS, GOES, ALONE = 1, 2, 3
SPACELESS = [
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x3005, 0x3007), (0x3040, 0x312F),
    (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA980, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF),
    (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF),
]

_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # of _BASE, and of its inverse, modulo 2 ** 64


def _kinds() -> np.ndarray:
    """For each code point beyond ASCII: whether it stays, parts words, goes or is a word."""
    kinds = np.zeros(0x110000, dtype=np.uint8)
    for first, last in SPACELESS:
        kinds[first : last + 1] = ALONE
    for code in range(0x80, 0x20000):
        category = unicodedata.category(chr(code))
        if category[0] in "ZPS" or category == "Cc" or code == 0x200B:
            kinds[code] = PARTS
        elif category == "Cf":  # soft hyphens, joiners and direction marks stand inside words
            kinds[code] = GOES
    return kinds


KINDS = _kinds()


def cleaned(text: str) -> bytes:
    """Lower-cased UTF-8 in which single or several spaces part the words."""
    text = text.lower()
    if not text.isascii():
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = KINDS[codes]
        if kinds.any():
            codes, kinds = np.where(kinds == PARTS, np.uint32(32), codes)[kinds != GOES], kinds[kinds != GOES]
            alone = kinds == ALONE
            if alone.any():
                alone[1:] |= kinds[:-1] == ALONE
                codes = np.insert(codes, np.flatnonzero(alone), 32)
            text = codes.tobytes().decode("utf-32-le", "surrogatepass")
    return text.encode("utf-8", "surrogatepass").translate(_KEEP)


def words(text: str) -> list[bytes]:
    return cleaned(text).split()


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS


def hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words of cleaned text, in order: polynomials of their bytes, from one running sum a block."""
    parts, start = [], 0
    while start < len(data):
        end = start + BLOCK
        if end < len(data):
            end = data.find(b" ", end) + 1 or len(data)
        letters = np.frombuffer(b" " + data[start:end] + b" ", dtype=np.uint8)
        inside = letters != 32
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        up, down = _powers(len(letters))
        sums = np.cumsum(letters * up[: len(letters)], dtype=np.uint64)
        first, last = edge[::2], edge[1::2]
        number = (sums[last] - sums[first]) * down[first]
        number ^= number >> np.uint64(29)
        number *= np.uint64(0xBF58476D1CE4E5B9)
        parts.append(number)
        start = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def features(data: bytes) -> np.ndarray:
    """Hashed words of cleaned text, in order, as columns of the space."""
    return _columns(hashes(data))


def _columns(numbers: np.ndarray) -> np.ndarray:
    return (numbers >> np.uint64(64 - FEATURE_BITS)).astype(np.int32)


def _runs(numbers: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words from those of the words."""
    last = max(len(numbers) - n + 1, 0)
    joined = numbers[:last].copy()
    for i in range(1, n):
        joined = joined * np.uint64(_BASE) + numbers[i : last + i]
    return joined


def _coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        codes = [features(cleaned(text)).astype(np.uint16).tobytes() for text in batch["text"]]
        yield pd.DataFrame({"codes": codes, "item": batch["item"]})


def coded(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Hashed words of all documents and items (``item`` tells which), two bytes a word, written once for all passes."""
    text = F.coalesce("text", F.lit("")).alias("text")
    both = docs.select(text, F.lit(False).alias("item")).union(benchmark.select(text, F.lit(True).alias("item")))
    return stored(both.mapInPandas(_coded, "codes binary, item boolean"), "latent-codes")


def _frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents that hold each feature; behind them, the documents and the words of all rows."""
    counts = np.zeros(FEATURES + 2, dtype=np.int64)
    for batch in batches:
        found = [np.frombuffer(codes, np.uint16) for codes in batch["codes"]]
        counts[FEATURES + 1] += sum(map(len, found))
        found = [x for x, item in zip(found, batch["item"], strict=True) if not item]
        counts[FEATURES] += len(found)
        for start in range(0, len(found), 1 << 16):
            part = found[start : start + (1 << 16)]
            key = np.repeat(np.arange(len(part), dtype=np.uint32) << np.uint32(FEATURE_BITS), list(map(len, part)))
            key |= np.concatenate([np.zeros(0, np.uint16), *part])
            key.sort()
            once = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
            counts[:FEATURES] += np.bincount(once & np.uint32(FEATURES - 1), minlength=FEATURES)
    used = np.flatnonzero(counts)
    yield pd.DataFrame({"feature": used, "n": counts[used]})


def idf(codes: DataFrame) -> tuple[np.ndarray, int]:
    """Inverse document frequencies of all features over all documents, and the number of coded words."""
    counted = codes.mapInPandas(_frequencies, "feature int, n long")
    table = counted.groupBy("feature").agg(F.sum("n").alias("n")).toPandas()  # at most FEATURES + 2 rows
    n = np.zeros(FEATURES + 2)
    n[table["feature"]] = table["n"]
    return np.log((n[FEATURES] + 1) / (n[:FEATURES] + 1)).astype(np.float32) + np.float32(0.05), int(n[FEATURES + 1])


def _passages(found: list[np.ndarray], weights: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Normalised TF-IDF rows of the passages of texts, about ``PASSAGES`` at a time: row, feature and value of every
    entry, by row and feature."""
    rows = [np.arange(len(codes)) // SPANS[1] for codes in found]
    offsets = np.cumsum([0, *(-(-len(codes) // SPANS[1]) for codes in found)])
    key = np.concatenate([np.zeros(0, np.int64), *(x + at for x, at in zip(rows, offsets, strict=False))]) << FEATURE_BITS
    key |= np.concatenate([np.zeros(0, np.uint16), *found])
    key.sort()
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    times = np.diff(np.append(starts, len(key)))
    row, feature = key[starts] >> FEATURE_BITS, key[starts] & (FEATURES - 1)
    value = weights[feature] * times
    value /= np.maximum(np.sqrt(np.bincount(row, value * value, minlength=offsets[-1])), 1e-9)[row]
    bounds = np.searchsorted(row, np.arange(0, offsets[-1] + PASSAGES, PASSAGES))
    for number, (left, right) in enumerate(zip(bounds, bounds[1:], strict=False)):
        if left < right:
            yield row[left:right] - number * PASSAGES, feature[left:right], value[left:right]


def _test_matrix() -> tuple[np.ndarray, np.ndarray]:
    """The random test matrix, one entry of 1 or -1 in each of its FEATURES rows: its columns, and its signs."""
    random = np.random.default_rng(SEED)
    return random.integers(0, SKETCH, FEATURES), random.choice([-1.0, 1.0], FEATURES)


def _sketch(weights) -> "callable":
    """Partial sums of A^T (A test matrix) over passages, in blocks of feature rows."""

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((FEATURES, SKETCH), dtype=np.float64)
        recent = np.zeros((FEATURES, SKETCH), dtype=np.float32)
        column, sign = _test_matrix()
        places = np.zeros(FEATURES, dtype=np.int64)
        for number, batch in enumerate(batches, 1):
            for row, feature, value in _passages([np.frombuffer(x, np.uint16) for x in batch["codes"]], weights.value):
                size = int(row[-1]) + 1
                drawn = np.bincount(row * SKETCH + column[feature], value * sign[feature], minlength=size * SKETCH)
                used = np.flatnonzero(np.bincount(feature, minlength=FEATURES))
                places[used] = np.arange(len(used))
                turned = np.bincount(places[feature] * size + row, value, minlength=len(used) * size)
                recent[used] += turned.reshape(-1, size).astype(np.float32) @ drawn.reshape(size, SKETCH).astype(np.float32)
            if number % 16 == 0:  # single precision holds the sums of some batches
                total += recent
                recent[:] = 0
        total += recent
        group = TaskContext.get().partitionId() // ADDED
        for start in range(0, FEATURES, ROWS):
            block = total[start : start + ROWS]
            if block.any():
                yield pd.DataFrame({"block": [start], "part": [group], "sums": [block.astype(np.float32).tobytes()]})

    return multiply


def _added(group: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in group["sums"])
    return pd.DataFrame({"block": [group["block"].iloc[0]], "part": [group["part"].iloc[0] // ADDED], "sums": [total.astype(np.float32).tobytes()]})


def latent_space(codes: DataFrame, weights: np.ndarray, n_words: int, rank: int = RANK) -> np.ndarray:
    """Leading right singular vectors (features by rank) of the TF-IDF passages of all coded texts, by randomised SVD,
    each divided by its singular value, so that what all passages of a language share doesn't decide every cosine.

    The test matrix is sparse and one pass is enough: from Y = A^T A T the factor Y (T^T Y)^(-1/2), whose singular
    vectors and values approximate those of A.
    """
    # A task sends as much as TASK_WORDS coded words take; at most ADDED of their sums are added at a time.
    context = codes.sparkSession.sparkContext
    tasks = max(context.defaultParallelism, n_words // TASK_WORDS, 1)
    sums = "block int, part int, sums binary"
    parts, left = codes.select("codes").coalesce(tasks).mapInPandas(_sketch(context.broadcast(weights)), sums), tasks
    while left > 1:
        parts, left = parts.groupBy("block", "part").applyInPandas(_added, sums), -(-left // ADDED)
    product = np.zeros((FEATURES, SKETCH))
    for row in parts.toLocalIterator():
        product[row.block : row.block + ROWS] += np.frombuffer(row.sums, np.float32).reshape(-1, SKETCH)
    column, sign = _test_matrix()
    small = np.stack([np.bincount(column, sign * product[:, i], minlength=SKETCH) for i in range(SKETCH)], axis=1)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    sound = values > 1e-9 * max(values.max(), 1e-9)
    left, scale, _ = np.linalg.svd(product @ (turn[:, sound] / np.sqrt(values[sound])), full_matrices=False)
    return (left[:, :rank] / np.maximum(scale[:rank], 1e-3 * max([*scale, 1e-9]))).astype(np.float32)


class Space(NamedTuple):
    """Weighted latent vectors of all features, with a row of zeros behind them for padding, and the weights."""

    vectors: np.ndarray
    weights: np.ndarray

    @staticmethod
    def of(space: np.ndarray, weights: np.ndarray) -> Space:
        return Space(np.vstack([space * weights[:, None], np.zeros((1, space.shape[1]), np.float32)]).astype(np.float32), weights)


class Text:
    """A text's cleaned bytes, the hashes of its words, and its words when they are asked for."""

    def __init__(self, text: str):
        self.data = cleaned(text)
        self.numbers = hashes(self.data)
        self._words: list[bytes] | None = None

    def words(self) -> list[bytes]:
        if self._words is None:
            self._words = self.data.split()
        return self._words


class Windows(NamedTuple):
    """Windows of one span: the text and first word of each, its vector and that vector's norm, and whether it is one
    (not cut off by the end of a text that has a whole window)."""

    text: np.ndarray
    word: np.ndarray
    vectors: np.ndarray
    norm: np.ndarray
    whole: np.ndarray


def windows(texts: list[Text], space: Space) -> Iterator[dict[int, Windows]]:
    """Windows of many texts at a time, by span.

    A window is as long as its span; of a shorter text, all of it.  Long texts go in pieces that overlap by the longest
    span.
    """
    waiting, size = [], 0
    for number, text in enumerate(texts):
        codes = _columns(text.numbers)
        if len(codes) < MIN_WORDS // 2:
            continue
        for start in range(0, len(codes), BATCH):
            piece = codes[start : start + BATCH + SPANS[-1]]
            waiting.append((number, start, piece))
            size += len(piece)
            if size >= BATCH:
                yield _windows(waiting, space)
                waiting, size = [], 0
    if waiting:
        yield _windows(waiting, space)


def _windows(pieces: list[tuple[int, int, np.ndarray]], space: Space) -> dict[int, Windows]:
    steps = np.array([-(-len(codes) // STEP) for *_, codes in pieces])
    ends = np.cumsum(steps)
    padded = np.full(ends[-1] * STEP, FEATURES, np.int32)
    for end, step, (*_, codes) in zip(ends.tolist(), steps.tolist(), pieces, strict=True):
        padded[(end - step) * STEP : (end - step) * STEP + len(codes)] = codes
    sums = np.empty((len(padded) // STEP, space.vectors.shape[1]), np.float32)
    for start in range(0, len(sums), 512):  # so that what is gathered stays in the cache
        part = space.vectors.take(padded[start * STEP : (start + 512) * STEP], axis=0)
        sums[start : start + 512] = part.reshape(-1, STEP, part.shape[1]).sum(axis=1)
    left = np.repeat(ends, steps) - np.arange(len(sums))  # steps to the piece's end
    text = np.repeat([number for number, *_ in pieces], steps)
    begin = np.repeat(ends - steps, steps)
    word = (np.arange(len(sums)) - begin) * STEP + np.repeat([start for _, start, _ in pieces], steps)
    found, width = {}, 1
    for span in SPANS:
        while width * STEP < span:  # windows of twice the width from neighbours
            longer = sums.copy()
            longer[:-width] += sums[width:]
            alone = np.flatnonzero(left <= width)
            longer[alone] = sums[alone]
            sums, width = longer, 2 * width
        norm = np.maximum(np.sqrt(np.einsum("ij,ij->i", sums, sums)), 1e-9)
        found[span] = Windows(text, word, sums, norm, (left >= width) | (np.arange(len(sums)) == begin))
    return found


class Items:
    """A block of benchmark items with their vectors, words and answers."""

    def __init__(self, rows: list[tuple[int | None, str]], space: Space):
        self.ids, self.words, self.answers = [], [], []
        #: Items of fewer than MIN_WORDS words: by number of words, the hash of all of them.
        self.short: dict[int, dict[int, list[tuple[int, list[bytes]]]]] = {}
        self.short_items: list[int | None] = []
        parts: dict[int, list[tuple[int, int, np.ndarray]]] = {}
        for item_id, text in rows:
            found = words(text)
            if len(found) < MIN_WORDS:
                if found:
                    number = int(_runs(hashes(b" ".join(found)), len(found))[0])
                    self.short.setdefault(len(found), {}).setdefault(number, []).append((len(self.short_items), found))
                    self.short_items.append(item_id)
                continue
            item = len(self.ids)
            self.ids.append(item_id)
            self.words.append(found)
            codes = features(b" ".join(found))
            behind = _ANSWER.match(text)
            answer = words(behind[1]) if behind else []
            if not answer:
                answer = [found[i] for i in sorted(range(len(found)), key=lambda i, c=codes: (-space.weights[c[i]], i))[: -(-len(found) // ANSWER_PART)]]
            self.answers.append(set(answer))
            # An item much longer than the longest window is looked for by its parts.
            starts, size = [0], len(codes)
            if len(codes) > 1.5 * SPANS[-1]:
                starts, size = [*range(0, len(codes) - SPANS[-1], SPANS[-1]), len(codes) - SPANS[-1]], SPANS[-1]
            span = min(SPANS, key=lambda s, n=size: abs(s - n))
            for start in starts:
                parts.setdefault(span, []).append((item, start, space.vectors[codes[start : start + size]].sum(axis=0)))
        self.counts = [dict(Counter(x)) for x in self.words]
        self.sets = list(map(frozenset, self.words))
        self.short_keys = {n: np.array(sorted(table), dtype=np.uint64) for n, table in self.short.items()}
        self.by_span = {}
        for span, found in parts.items():
            matrix = np.array([v for *_, v in found], dtype=np.float32)
            unit = matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-9)
            self.by_span[span] = np.array([i for i, *_ in found]), np.array([s for _, s, _ in found]), unit

    def search(self, texts: list[Text], space: Space) -> list[list[tuple[int | None, float, float, int]]]:
        """Matches in each text: item, cosine, share of the item's words, first word; the best of each item."""
        best: list[dict[int, tuple]] = [{} for _ in texts]
        for text, item, cosine, at in self._candidates(texts, space):
            cover, first = self._verified(item, texts[text].words(), at)
            if cover >= MIN_COVER and (item not in best[text] or cover > best[text][item][2]):
                best[text][item] = (self.ids[item], cosine, cover, first)
        return [[*found.values(), *self._short(text)] for text, found in zip(texts, best, strict=True)]

    def _short(self, text: Text) -> list[tuple[int | None, float, float, int]]:
        """Matches of the short items, whose words must stand together as they are, each at its first place."""
        best: dict[int, tuple] = {}
        for n, table in self.short.items():
            runs, keys = _runs(text.numbers, n), self.short_keys[n]
            near = np.searchsorted(keys, runs)
            for at in np.flatnonzero(keys[np.minimum(near, len(keys) - 1)] == runs).tolist():
                for item, wanted in table[int(runs[at])]:
                    if item not in best and text.words()[at : at + n] == wanted:
                        best[item] = (self.short_items[item], 1.0, 1.0, at)
        return list(best.values())

    def _candidates(self, texts: list[Text], space: Space) -> Iterator[tuple[int, int, float, int]]:
        """Text, item, cosine and the word at which the item may begin."""
        if not self.ids:
            return
        for found in windows(texts, space):
            for span, (which, part, matrix) in self.by_span.items():
                text, word, vectors, norm, whole = found[span]
                similar = vectors @ matrix.T
                at, column = np.divmod(np.flatnonzero(similar >= MIN_COSINE * norm[:, None]), len(which))
                at, column = at[whole[at]], column[whole[at]]
                if not len(at):
                    continue
                # A run of overlapping windows is one candidate, at its best window.
                cosine = lambda place, other, s=similar, n=norm: s[place, other] / n[place]
                peak, before, behind = cosine(at, column), np.maximum(at - 1, 0), np.minimum(at + 1, len(norm) - 1)
                below = (before < at) & whole[before] & (text[before] == text[at]) & (cosine(before, column) >= peak)
                below |= (behind > at) & whole[behind] & (text[behind] == text[at]) & (cosine(behind, column) > peak)
                at, column, peak = at[~below], column[~below], peak[~below]
                yield from zip(text[at].tolist(), which[column].tolist(), peak.tolist(), (word[at] - part[column]).tolist(), strict=True)

    def _verified(self, item: int, found: list[bytes], at: int) -> tuple[float, int]:
        """Share of the item's words in the longest common subsequence near a place, 0 if a check fails."""
        wanted = self.words[item]
        n = len(wanted)
        start = max(0, at - n // 2 - STEP)
        stop = min(len(found), max(at, 0) + 2 * n + 2 * STEP)
        near = found[start:stop]
        # Of n words, as many can be common as occur at all: repeats of a word count as often as the item has them.
        counts = self.counts[item]
        if sum([counts[w] for w in self.sets[item].intersection(near)]) < MIN_COVER * n or lcs_length(wanted, near) < MIN_COVER * n:
            return 0.0, 0
        common = lcs_places(wanted, near)
        longest = int(MAX_STRETCH * n)
        # The stretch of at most that length with the most common words.
        cover, first, left = 0, 0, 0
        for right in range(len(common)):
            while common[right] - common[left] >= longest:
                left += 1
            if right - left + 1 > cover:
                cover, first = right - left + 1, left
        held = {near[p] for p in common[first : first + cover]}
        if cover < MIN_COVER * n or len(self.answers[item] & held) < ANSWER_SHARE * len(self.answers[item]):
            return 0.0, 0
        return cover / n, start + common[first]


def lcs_length(a: list, b: list) -> int:
    """Length of the longest common subsequence, bit-parallel: a bit for each element of ``a``."""
    masks: dict[bytes, int] = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        mask = masks.get(x)
        if mask:
            hit = row & mask
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def lcs_places(a: list, b: list) -> list[int]:
    """Places in ``b`` of one longest common subsequence, from the rows of the bit-parallel computation."""
    masks: dict[bytes, int] = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    rows = [full]
    for x in b:
        row, mask = rows[-1], masks.get(x, 0)
        hit = row & mask
        rows.append(((row + hit) | (row - hit)) & full)
    length = lambda j, i: i - (rows[j] & ((1 << i) - 1)).bit_count()  # of a[:i] and b[:j]
    places, i, j = [], len(a), len(b)
    while i and j:
        now = length(j, i)
        if length(j - 1, i) == now:
            j -= 1
        elif length(j, i - 1) == now:
            i -= 1
        else:
            places.append(j - 1)
            i, j = i - 1, j - 1
    return places[::-1]


MATCHES = "array<struct<item_id:long,cosine:double,cover:double,first_word:long>>"


_OPENED: dict[str, Items] = {}


def _opened(uri: str) -> Items:
    """A block of items from its file; a worker keeps the last ``KEPT_BLOCKS``."""
    if uri not in _OPENED:
        while len(_OPENED) >= KEPT_BLOCKS:
            del _OPENED[next(iter(_OPENED))]
        fs, path = store(uri)
        with fs.open_input_stream(path, compression=None) as file:
            _OPENED[uri] = pickle.loads(file.read())
    return _OPENED[uri]


def item_blocks(benchmark: DataFrame, space) -> list[str]:
    """Files of the benchmark's items, ``ITEM_BLOCK`` in each, projected into the broadcast space by tasks."""
    spark = benchmark.sparkSession
    blocks, folder = -(-benchmark.count() // ITEM_BLOCK), shared_folder(spark, "item-blocks")

    def build(group: pd.DataFrame) -> pd.DataFrame:
        uri = f"{folder}/block-{group['block'].iloc[0]:06d}.pickle"
        ids = [None if pd.isna(x) else int(x) for x in group["item_id"]]
        with whole_file(uri) as file:
            file.write(pickle.dumps(Items(list(zip(ids, group["text"], strict=True)), space.value)))
        return pd.DataFrame({"uri": [uri]})

    if not blocks:
        return []
    numbered = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).alias("block"),
    )
    built = stored(numbered.groupBy("block").applyInPandas(build, "uri string"), "item-blocks")
    return sorted(r.uri for r in built.collect())  # a name for every ITEM_BLOCK items


def all_matches(docs: DataFrame, benchmark: DataFrame, text: Column | None = None) -> Column:
    """Array column of all matches of a text column, over all blocks of items."""
    text = F.col("text") if text is None else text
    codes = coded(docs, benchmark)
    weights, n_words = idf(codes)
    shared = docs.sparkSession.sparkContext.broadcast(Space.of(latent_space(codes, weights, n_words), weights))
    blocks = item_blocks(benchmark, shared)
    if not blocks:
        return F.expr(f"cast(array() AS {MATCHES})")

    @F.pandas_udf(MATCHES)
    def search(texts: pd.Series) -> pd.Series:
        read = [Text(x) for x in texts]
        found: list[list[tuple]] = [[] for _ in read]
        for uri in blocks:
            for known, more in zip(found, _opened(uri).search(read, shared.value), strict=True):
                known.extend(more)
        names = ("item_id", "cosine", "cover", "first_word")
        order = lambda m: (m[0] is not None, m[0] or 0, m[3])
        return pd.Series([[dict(zip(names, m, strict=True)) for m in sorted(x, key=order)] for x in found])

    return search(F.coalesce(text, F.lit("")))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, cosine, cover, first_word``: a row per document and item it holds."""
    return docs.select("doc_id", F.explode(all_matches(docs, benchmark)).alias("m")).select("doc_id", "m.*")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    return docs.where(F.size(all_matches(docs, benchmark)) == 0)
