"""Removal of passages that an earlier document has, by longest-previous-factor arrays.

A byte of a document goes if a string of ``WINDOW`` bytes that covers it also starts in a document with a smaller
doc_id.  For a suffix of a document the longest previous factor is its longest prefix that a document with a
smaller id contains; in suffix order it is found at the previous and the next suffix of a smaller document.  A byte
goes if it lies in the first ``WINDOW`` bytes of a suffix whose longest previous factor is at least that long, so
suffixes are ordered by that many bytes and no more.

One suffix array for a whole corpus fits no task, so suffixes are dealt out by content.  The least hashed ``GRAM``
bytes of a window are its anchor; equal windows have equal anchors wherever they stand.  Consecutive windows with one
anchor form a stretch of a few dozen bytes.

1. Documents are dealt into chunks, row by row whatever they hold, and written to the shared folder, one folder a chunk.
2. Every chunk names its anchors; those that occur in one document only are settled: nothing else holds their windows.
3. The chunk's distinct stretches of the other anchors, with the smallest doc_id that has each, go to the anchor's
   bucket.  There the suffixes of all distinct stretches are sorted and their longest previous factors found.
4. Each chunk gets the answers for its stretches and marks all their places.

A stretch goes to its bucket once per chunk however many documents of the chunk share it, so copies and passages of
any number of documents are no hot key.  Anchors of very many chunks (frequent words with differing surroundings) have
their stretches split by the longer strings that half of their windows share.  Halves that very many chunks have (a
frequent passage with differing surroundings) are split into single windows, each dealt by all its bytes; windows
that are equal are one entry a chunk, and others no longer meet.

Texts are UTF-8 bytes, null counts as empty.  Documents shorter than the window lose nothing; texts of any length are
searched whole, a very long one in a chunk of its size.  Rows that share doc_id are separate documents and none is
earlier than the other.  A null doc_id is earlier than any other.  An empty table gives no rows.  Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow.dataset as ds
from pyspark.sql import DataFrame, functions as F

from vigil.llm.shared import GROUP_BYTES, shared_folder, store, stored, whole_text

WINDOW = 50
GRAM = 20
#: Bytes around an anchor that the windows of one half of its stretch share.
HALF = GRAM + (WINDOW - GRAM) // 2
#: Chunks with an anchor beyond which its stretches are split in halves.
FREQUENT = 256
#: Buckets of anchors for each chunk.
BUCKETS = 4
#: Partitions for each chunk, so that few tasks get several chunks.
SPREAD = 4
#: One run of windows in an answer: stretch, first and last window, smallest document.
RUN = np.dtype([("place", "<i4"), ("first", "u1"), ("last", "u1"), ("owner", "<i8")])
BLOCK = 1 << 16
NO_ID = np.iinfo(np.int64).min

_POSITION = np.uint64(0xFFFFFFF)
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _words(data: bytes, positions: np.ndarray | int, n: int | None = None) -> np.ndarray:
    """Eight bytes at consecutive or given positions as integers; ``data`` is padded beyond its text."""
    every = np.ndarray((len(data) - 7,), np.dtype("<u8"), buffer=data, strides=(1,))
    return every[positions : positions + n] if n is not None else every[positions]


def _grams(data: bytes, at: np.ndarray | int, length: int, n: int | None = None) -> np.ndarray:
    """Hashes of ``length`` bytes at consecutive (from ``at``, ``n`` of them) or given positions."""
    offsets = sorted({*range(0, length - 7, 8), length - 8})
    mixed = _words(data, at, n) * _MIX[0]
    mixed ^= mixed >> np.uint64(29)
    for offset in offsets[1:]:
        mixed += _words(data, at + offset, n)
        mixed *= _MIX[1]
        mixed ^= mixed >> np.uint64(31)
    mixed *= _MIX[2]
    mixed ^= mixed >> np.uint64(32)
    return mixed


class Chunk:
    """Documents of one chunk, in a fixed order, as one run of bytes."""

    def __init__(self, ids: list[int | None], texts: list[bytes]):
        self.ids, self.texts = ids, texts
        self.order = np.array([NO_ID if x is None else x for x in ids], dtype=np.int64)
        self.ends = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)))
        self.size = int(self.ends[-1]) if len(texts) else 0
        self.data = b"".join(texts) + bytes(WINDOW + 8)

    @classmethod
    def read(cls, folder: str, chunk: int) -> Chunk:
        fs, path = store(f"{folder}/chunk={chunk}")
        table = ds.dataset(path, filesystem=fs, format="parquet").to_table(columns=["doc_id", "text"])
        rows = sorted(
            ((x is not None, x or 0, t) for x, t in zip(table["doc_id"].to_pylist(), (t.as_py().encode() for t in table["text"]), strict=True))
        )
        return cls([x if known else None for known, x, _ in rows], [t for _, _, t in rows])

    def stretches(self) -> tuple[np.ndarray, ...]:
        """Anchor hash, anchor position, first and last window, and document, of every stretch."""
        windows = self.size - WINDOW + 1
        inside = np.ones(max(windows, 0), dtype=bool)
        for end in self.ends.tolist():
            inside[max(0, end - WINDOW + 1) : end] = False
        found: list[list[np.ndarray]] = [[], [], [], []]
        for start in range(0, max(windows, 0), BLOCK):
            n = min(BLOCK, windows - start)
            hashes = _grams(self.data, start, GRAM, n + WINDOW - GRAM)
            least = (hashes & ~_POSITION) | np.arange(len(hashes), dtype=np.uint64)
            width, span = WINDOW - GRAM + 1, 1
            while span * 2 <= width:
                least = np.minimum(least[:-span], least[span:])
                span *= 2
            if span < width:
                least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
            anchor = (least[:n] & _POSITION).astype(np.int64)
            valid = inside[start : start + n]
            change = np.ones(n, dtype=bool)
            change[1:] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])
            first = np.flatnonzero(change)
            last = np.append(first[1:], n) - 1
            use = valid[first]
            first, last = first[use], last[use]
            for to, values in zip(found, (hashes[anchor[first]], anchor[first] + start, first + start, last + start), strict=True):
                to.append(values)
        key, anchor, first, last = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)
        return key.astype(np.uint64), anchor, first, last, np.searchsorted(self.ends, first, side="right")

    def halves(self, frequent: np.ndarray) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
        """Key, first and last window and document of both halves of the stretches of frequent anchors."""
        key, anchor, first, last, doc = self.stretches()
        split = _among(key, frequent)
        cut = anchor - (HALF - GRAM)  # windows up to here hold the bytes before the anchor, the others those behind it
        left, right = split & (first <= cut), split & (last > cut)
        return (
            (_grams(self.data, cut[left], HALF), first[left], np.minimum(last, cut)[left], doc[left]),
            (_grams(self.data, anchor[right], HALF) + np.uint64(1), np.maximum(first, cut + 1)[right], last[right], doc[right]),
        )

    def shared_stretches(self, repeated: np.ndarray, frequent: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, ...]:
        """Key, first and last window and document of the stretches of repeated anchors; those of frequent anchors in
        halves, and hot halves window by window."""
        key, _, first, last, doc = self.stretches()
        use = _among(key, repeated)
        key, first, last, doc = (x[use] for x in (key, first, last, doc))
        if not len(frequent):
            return key, first, last, doc
        whole = ~_among(key, frequent)
        parts = [(key[whole], first[whole], last[whole], doc[whole])]
        for half in self.halves(frequent):
            many = _among(half[0], hot)
            parts.append(tuple(x[~many] for x in half))
            _, first, last, doc = (x[many] for x in half)
            count = last - first + 1
            single = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
            parts.append((_grams(self.data, single, WINDOW) + np.uint64(2), single, single, np.repeat(doc, count)))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def distinct(self, repeated: np.ndarray, frequent: np.ndarray, hot: np.ndarray):
        """Distinct stretches (key, smallest and largest document, bytes) and, per place, first window, document, stretch."""
        key, first, last, doc = self.shared_stretches(repeated, frequent, hot)
        numbers: dict[bytes, int] = {}
        data = self.data
        which = np.fromiter(
            (numbers.setdefault(data[s:e], len(numbers)) for s, e in zip(first.tolist(), (last + WINDOW).tolist(), strict=True)),
            dtype=np.int64,
            count=len(first),
        )
        owner = self.order[doc] if len(doc) else np.zeros(0, np.int64)
        least, most = np.full(len(numbers), np.iinfo(np.int64).max), np.full(len(numbers), NO_ID)
        np.minimum.at(least, which, owner)
        np.maximum.at(most, which, owner)
        keys = np.zeros(len(numbers), dtype=np.uint64)
        keys[which] = key
        return keys, least, most, list(numbers), first, doc, which


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among the sorted known ones."""
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _nearest_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the nearest earlier place of a smaller value, or -1, by following the links found so far."""
    near = np.arange(-1, len(values) - 1)
    open_ = np.flatnonzero(near >= 0)
    while len(open_):
        # All values between a place and its link are at least as large as the place's own.
        open_ = open_[values[near[open_]] >= values[open_]]
        near[open_] = near[near[open_]]
        open_ = open_[near[open_] >= 0]
    return near


def _common(windows: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Length of the common prefix of pairs of windows; 0 where the other place is -1."""
    lengths = np.zeros(len(one), dtype=np.int64)
    letters = windows.view(np.uint8).reshape(len(windows), -1) if len(windows) else np.zeros((0, WINDOW), np.uint8)
    for start in range(0, len(one), BLOCK):
        part = slice(start, start + BLOCK)
        some = other[part] >= 0
        differ = letters[one[part][some]] != letters[other[part][some]]
        found = np.where(differ.any(axis=1), differ.argmax(axis=1), WINDOW)
        lengths[part][some] = found
    return lengths


class Factors(NamedTuple):
    """Longest previous factors of suffixes: their lengths, up to ``WINDOW``, and the suffix at which each is found
    (the suffix itself where there is none)."""

    length: np.ndarray
    source: np.ndarray


def longest_previous_factors(windows: np.ndarray, owners: np.ndarray, lengths: bool = True) -> Factors:
    """For suffixes, given by their first ``WINDOW`` bytes, and the documents that own them.

    In suffix order the suffix of a smaller owner that shares the longest prefix is the previous or the next one with a
    smaller owner: whatever lies further shares no more.  Without ``lengths``, only factors of a whole window are told
    from others (length 0).
    """
    order = np.argsort(windows, kind="stable")
    ranked, owned = windows[order], owners[order]
    before = _nearest_smaller(owned)
    after = len(order) - 1 - _nearest_smaller(owned[::-1])[::-1]
    after[after == len(order)] = -1
    place = np.arange(len(order))
    if lengths:
        left, right = _common(ranked, place, before), _common(ranked, place, after)
    else:
        interval = np.cumsum(np.append(True, ranked[1:] != ranked[:-1]))[: len(order)]
        left, right = (WINDOW * ((x >= 0) & (interval[x] == interval)) for x in (before, after))
    best = np.maximum(left, right)
    source = np.where(best == 0, place, np.where(left >= right, before, after))
    length, found = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    length[order], found[order] = best, order[source]
    return Factors(length, found)


def previous_factors(windows: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """For suffixes, given by their first ``WINDOW`` bytes, the smallest owner among those that begin alike.

    From a suffix whose longest previous factor is a whole window the way leads to the factor's source, which has a
    smaller owner, and on from there; it ends at the smallest.
    """
    factors = longest_previous_factors(windows, owners, lengths=False)
    source = np.where(factors.length >= WINDOW, factors.source, np.arange(len(owners)))
    while len(source) and (further := source[source]).tobytes() != source.tobytes():
        source = further
    return owners[source]


def _bucket_answers(keys: np.ndarray, owners: np.ndarray, stretches: list[bytes]) -> list[np.ndarray]:
    """For distinct stretches with their smallest owners: per window the smallest owner of an equal window."""
    answers: list[np.ndarray | None] = [None] * len(stretches)
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    alone = np.ones(len(order), dtype=bool)
    if len(order) > 1:
        same = ranked[1:] == ranked[:-1]
        alone[1:] &= ~same
        alone[:-1] &= ~same
    for i in order[alone].tolist():
        answers[i] = np.full(len(stretches[i]) - WINDOW + 1, owners[i])
    several = order[~alone]
    # Slices of whole keys keep the suffix arrays small.
    at = 0
    while at < len(several):
        size, to = 0, at
        while to < len(several) and (size < 4 << 20 or keys[several[to]] == keys[several[to - 1]]):
            size += len(stretches[several[to]])
            to += 1
        part = several[at:to].tolist()
        counts = np.array([len(stretches[i]) - WINDOW + 1 for i in part])
        data = np.frombuffer(b"".join([stretches[i] for i in part]), dtype=np.uint8)
        inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        base = np.cumsum(counts + WINDOW - 1) - counts - WINDOW + 1
        starts = np.repeat(base, counts) + inner
        suffixes = np.ndarray((len(data) - WINDOW + 1,), np.dtype(f"S{WINDOW}"), buffer=data, strides=(1,))[starts]
        found = previous_factors(suffixes, np.repeat(owners[part], counts))
        for i, values in zip(part, np.split(found, np.cumsum(counts)[:-1]), strict=True):
            answers[i] = values
        at = to
    return answers  # type: ignore[return-value]


def _dealt(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Positions of the keys by bucket."""
    to = (keys >> np.uint64(7)) % np.uint64(buckets)
    order = np.argsort(to, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(to[order])) + 1) if len(order) else []:
        yield int(to[part[0]]), part


def _ints(blob: bytes, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(blob, dtype=kind)


class _Job:
    """The steps' functions over groups of rows."""

    def __init__(self, folder: str, buckets: int, with_text: bool):
        self.folder, self.buckets, self.with_text, self.frequent = folder, buckets, with_text, FREQUENT

    def anchors(self, group: pd.DataFrame) -> pd.DataFrame:
        """A chunk's distinct anchors by bucket, and which of them several of its documents have."""
        chunk = int(group["chunk"].iloc[0])
        key, _, _, _, doc = Chunk.read(self.folder, chunk).stretches()
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        several = doc[first] != doc[np.append(first[1:], len(doc)) - 1] if len(key) else np.zeros(0, bool)
        names = key[first]
        return pd.DataFrame(
            [(b, chunk, names[p].tobytes(), several[p].tobytes()) for b, p in _dealt(names, self.buckets)],
            columns=["bucket", "chunk", "keys", "several"],
        )

    def repeated(self, group: pd.DataFrame) -> pd.DataFrame:
        """Back to each chunk: its anchors that more than one document has, and those of very many chunks."""
        lists = [_ints(x, np.uint64) for x in group["keys"]]
        keys = np.concatenate(lists)
        several = np.concatenate([_ints(x, np.bool_) for x in group["several"]])
        _, place, count = np.unique(keys, return_inverse=True, return_counts=True)
        shared = np.bincount(place, several).astype(bool) | (count > 1)
        rows, at = [], 0
        for chunk, own in zip(group["chunk"], lists, strict=True):
            mine = place[at : at + len(own)]
            at += len(own)
            rows.append((chunk, own[shared[mine]].tobytes(), own[count[mine] > self.frequent].tobytes()))
        return pd.DataFrame(rows, columns=["chunk", "repeated", "frequent"])

    def halves(self, group: pd.DataFrame) -> pd.DataFrame:
        """A chunk's distinct halves of frequent anchors by bucket."""
        chunk = int(group["chunk"].iloc[0])
        found = Chunk.read(self.folder, chunk).halves(self._known(group)[1])
        names = np.unique(np.concatenate([key for key, *_ in found]))
        return pd.DataFrame([(b, chunk, names[p].tobytes()) for b, p in _dealt(names, self.buckets)], columns=["bucket", "chunk", "keys"])

    def hot(self, group: pd.DataFrame) -> pd.DataFrame:
        """Back to each chunk: its halves that very many chunks have."""
        lists = [_ints(x, np.uint64) for x in group["keys"]]
        names, count = np.unique(np.concatenate(lists), return_counts=True)
        many = names[count > self.frequent]
        return pd.DataFrame([(c, own[_among(own, many)].tobytes()) for c, own in zip(group["chunk"], lists, strict=True)], columns=["chunk", "hot"])

    def _known(self, group: pd.DataFrame) -> tuple[np.ndarray, ...]:
        """Repeated anchors, frequent ones and hot halves of a chunk."""
        return tuple(
            np.sort(np.concatenate([np.zeros(0, np.uint64), *(_ints(x, np.uint64) for x in group[c] if x is not None)]))
            for c in ("repeated", "frequent", "hot")
            if c in group
        )

    def sent(self, group: pd.DataFrame) -> pd.DataFrame:
        """A chunk's distinct stretches by bucket."""
        chunk = int(group["chunk"].iloc[0])
        keys, least, most, stretches, _, _, _ = Chunk.read(self.folder, chunk).distinct(*self._known(group))
        lengths = np.fromiter(map(len, stretches), dtype=np.int32, count=len(stretches))
        rows = [
            (b, chunk, keys[p].tobytes(), least[p].tobytes(), most[p].tobytes(), lengths[p].tobytes(), b"".join([stretches[i] for i in p.tolist()]))
            for b, p in _dealt(keys, self.buckets)
        ]
        return pd.DataFrame(rows, columns=["bucket", "chunk", "keys", "least", "most", "lengths", "data"])

    def answers(self, group: pd.DataFrame) -> pd.DataFrame:
        """Per chunk: runs of windows of its stretches that some document before its last one has."""
        numbers: dict[bytes, int] = {}
        keys, owners, members = [], [], []
        for row in group.itertuples():
            own = []
            ends = np.cumsum(_ints(row.lengths, np.int32)).tolist()
            for key, least, start, end in zip(_ints(row.keys, np.uint64).tolist(), _ints(row.least).tolist(), [0, *ends[:-1]], ends, strict=True):
                stretch = row.data[start:end]
                i = numbers.get(stretch)
                if i is None:
                    i = numbers[stretch] = len(keys)
                    keys.append(key)
                    owners.append(least)
                elif least < owners[i]:
                    owners[i] = least
                own.append(i)
            members.append(own)
        found = _bucket_answers(np.array(keys, np.uint64), np.array(owners, np.int64), list(numbers))
        runs: list[list[tuple[int, int, int]]] = []
        for values in found:
            first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
            runs.append(list(zip(first.tolist(), (np.append(first[1:], len(values)) - 1).tolist(), values[first].tolist(), strict=True)))
        rows = []
        for row, own in zip(group.itertuples(), members, strict=True):
            found = [
                (place, f, e, o)
                for place, (i, most) in enumerate(zip(own, _ints(row.most).tolist(), strict=True))
                for f, e, o in runs[i]
                if o < most
            ]
            rows.append((row.chunk, row.bucket, np.array(found, dtype=RUN).tobytes()))
        return pd.DataFrame(rows, columns=["chunk", "bucket", "runs"])

    def removed(self, group: pd.DataFrame) -> pd.DataFrame:
        """The chunk's documents without the bytes that go."""
        chunk = Chunk.read(self.folder, int(group["chunk"].iloc[0]))
        keys, _, _, _, first, doc, which = chunk.distinct(*self._known(group))
        change = np.zeros(chunk.size + 1, dtype=np.int16)  # a byte lies in at most WINDOW windows
        answers = {int(r.bucket): r.runs for r in group.itertuples() if r.runs is not None and not pd.isna(r.bucket)}
        by_stretch: list[np.ndarray] = [np.zeros(0, RUN)]
        for bucket, places in _dealt(keys, self.buckets):
            if bucket in answers:
                runs = np.frombuffer(answers[bucket], RUN).copy()
                runs["place"] = places[runs["place"]]
                by_stretch.append(runs)
        runs = np.concatenate(by_stretch)
        runs = runs[np.argsort(runs["place"], kind="stable")]
        begin, end = np.searchsorted(runs["place"], which, "left"), np.searchsorted(runs["place"], which, "right")
        count = end - begin
        at = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())  # the runs of each place
        place = np.repeat(np.arange(len(which)), count)
        goes = runs["owner"][at] < chunk.order[doc[place]] if len(at) else np.zeros(0, bool)
        at, place = at[goes], place[goes]
        np.add.at(change, first[place] + runs["first"][at], 1)
        np.add.at(change, first[place] + runs["last"][at] + WINDOW, -1)
        gone = np.cumsum(change[:-1], dtype=np.int16) > 0
        rows, start = [], 0
        for doc_id, text, stop in zip(chunk.ids, chunk.texts, chunk.ends.tolist(), strict=True):
            mask = gone[start:stop]
            start = stop
            lost = int(mask.sum())
            kept = text if not lost else np.frombuffer(text, np.uint8)[~mask].tobytes()
            spans = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum()) if lost else 0
            rows.append((doc_id, len(text), lost, spans, hashlib.sha256(kept).hexdigest(), *([kept] * self.with_text)))
        return pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] * self.with_text)]).astype({"doc_id": "Int64"})


def without_later_copies(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document, and with ``with_text`` the bytes ``kept``."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-total // GROUP_BYTES))
    folder = shared_folder(spark, "suffix-chunks")
    # By row, so that equal rows are spread as well.
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(chunks)))
    dealt.repartition(chunks, "chunk").write.partitionBy("chunk").option("compression", "zstd").parquet(folder)
    job = _Job(folder, chunks * BUCKETS, with_text)
    present = spark.read.schema("doc_id long, text string, chunk long").parquet(folder).select("chunk").distinct()
    anchors = present.repartition(chunks * SPREAD, "chunk").groupBy("chunk").applyInPandas(lambda g: job.anchors(g), "bucket long, chunk long, keys binary, several binary")
    flags = stored(anchors.groupBy("bucket").applyInPandas(lambda g: job.repeated(g), "chunk long, repeated binary, frequent binary"), "suffix-anchors")
    split = flags.where("length(frequent) > 0").select("chunk", "repeated", "frequent")
    halves = split.groupBy("chunk").applyInPandas(lambda g: job.halves(g), "bucket long, chunk long, keys binary")
    hot = stored(halves.groupBy("bucket").applyInPandas(lambda g: job.hot(g), "chunk long, hot binary"), "suffix-halves")
    flags = flags.unionByName(hot, allowMissingColumns=True)
    sent = flags.repartition(chunks * SPREAD, "chunk").groupBy("chunk").applyInPandas(
        lambda g: job.sent(g), "bucket long, chunk long, keys binary, least binary, most binary, lengths binary, data binary"
    )
    answers = stored(
        sent.groupBy("bucket").applyInPandas(lambda g: job.answers(g), "chunk long, bucket long, runs binary"),
        "suffix-answers",
    )
    gathered = flags.unionByName(answers, allowMissingColumns=True).unionByName(present, allowMissingColumns=True)
    result = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return gathered.repartition(chunks * SPREAD, "chunk").groupBy("chunk").applyInPandas(lambda g: job.removed(g), result)
