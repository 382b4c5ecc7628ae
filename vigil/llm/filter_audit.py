"""What each filter of a cleaning pipeline removes, alone and in every order, with duplicates found in radix tries.

Filters A to D judge a text by itself; E fails a text that equals the text of a document with a smaller id.  A document's
failures are one mask of five bits.  Masks are counted for each part (language), and all orders and steps follow from
these counts, at most 32 a part.

Duplicates: every task inserts whole texts into a compressed radix trie whose terminals hold the smallest id, flushed at
``TRIE_BYTES``; a flush passes each distinct text on once, as an entry, whatever number of rows have it.  Entries are dealt
by ranges of a text prefix, adaptively: a prefix starts with ``PREFIX`` characters and becomes four times as long
wherever its texts together exceed the share of one partition (at most ``TRIE_BYTES``), until it is light or no
text goes on behind it.  The tasks of the second pass insert the entries, one prefix after the other, into tries whose terminals
give the smallest id of the whole table.  Equal texts meet as one entry a flush; a trie holds each of them once.

Null text counts as empty, null language as the part ``''``.  A null id is neither smaller nor larger than another: its
row never fails E and makes no other fail.  Rows that share id and text do not make each other fail.  Labels of an id count
as 1 if any of its label rows says so.  Words are parted by ASCII white space.  A text of any length is one path in
a trie.  An empty table has no parts and gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from vigil.llm.shared import shuffle_partitions, stored, whole_text

FILTERS = "ABCDE"
#: Text bytes that a trie holds at most, but for texts of a single prefix that all end there.
TRIE_BYTES = 16 << 20
#: Characters of the shortest prefix, and bytes that a text counts for besides its own.
PREFIX = 16
NODE_BYTES = 128

MIN_WORDS = 200
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_SYMBOLS = b"#$%&*|"
_CONTINUED = bytes(range(0x80, 0xC0))

ROWS = "entry long, doc_id long, part string, mask int, least long, text string"


class Node:
    """Node of a compressed trie: the bytes that lead to it, and the smallest id and the entries of texts ending here."""

    __slots__ = ("label", "children", "least", "entries")

    def __init__(self, label: bytes):
        self.label, self.children, self.least, self.entries = label, {}, None, None


class RadixTrie:
    def __init__(self):
        self.root = Node(b"")
        self.size = 0

    def terminal(self, text: bytes) -> Node:
        """The node at which a text ends; made if need be."""
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                self.size += len(text) - at + NODE_BYTES
                return child
            if not text.startswith(child.label, at):
                child = self._split(node, child, text, at)
            node, at = child, at + len(child.label)
        return node

    def _split(self, node: Node, child: Node, text: bytes, at: int) -> Node:
        """Part a child's label behind what the text shares with it."""
        low, high = 1, len(child.label)  # the first byte is shared, the whole label is not
        while high - low > 1:
            middle = (low + high) // 2
            if text.startswith(child.label[:middle], at):
                low = middle
            else:
                high = middle
        upper = Node(child.label[:low])
        node.children[text[at]] = upper
        child.label = child.label[low:]
        upper.children[child.label[0]] = child
        self.size += NODE_BYTES
        return upper

    def add(self, text: bytes, least: int | None, entry: int) -> int:
        """Lower the minimum at the text's terminal; ``entry`` names a new terminal, an old one keeps its first."""
        end = self.terminal(text)
        if end.entries is None:
            end.entries = []
        end.entries.append(entry)
        if least is not None and (end.least is None or least < end.least):
            end.least = least
        return end.entries[0]

    def traverse(self, texts: bool) -> Iterator[tuple[bytes | None, Node]]:
        """Nodes at which texts end, with the texts if asked for."""
        stack = [(self.root, ())]
        while stack:
            node, above = stack.pop()
            path = (above, node.label) if texts else ()
            if node.entries is not None:
                yield (_joined(path) if texts else None), node
            stack.extend((child, path) for child in node.children.values())


def _joined(path: tuple) -> bytes:
    labels = []
    while path:
        path, label = path
        labels.append(label)
    return b"".join(reversed(labels))


def failures(text: bytes) -> int:
    """Mask of the filters A to D that a text fails."""
    words = text.split()  # bytes part at ASCII white space only
    characters = len(text.translate(None, _CONTINUED))
    capitals = len(text) - len(text.translate(None, _UPPER))
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < 50 * len(words)) << 1
        | (100 * capitals > 3 * characters) << 2
        | (len(text.translate(None, _SYMBOLS)) < len(text)) << 3
    )


_SCHEMA = pa.schema([("entry", pa.int64()), ("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("least", pa.int64()), ("text", pa.string())])


def _local_tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every document with the entry of its text, and a row for every entry with its smallest id and text."""
    number = TaskContext.get().partitionId() << 33
    trie = RadixTrie()

    def flushed():
        rows, size = [], 0
        for text, node in trie.traverse(texts=True):
            rows.append({"entry": node.entries[0], "least": node.least, "text": text.decode()})
            size += len(text)
            if size > 1 << 20:
                yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _SCHEMA)

    for batch in batches:
        ids, parts = batch.column("doc_id").to_pylist(), batch.column("part").to_pylist()
        found = []
        for doc_id, part, text in zip(ids, parts, batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
            end = trie.terminal(text)
            if end.entries is None:
                end.entries, number = [number], number + 1
            if doc_id is not None and (end.least is None or doc_id < end.least):
                end.least = doc_id
            found.append({"entry": end.entries[0], "doc_id": doc_id, "part": part, "mask": failures(text)})
        yield pa.RecordBatch.from_pylist(found, _SCHEMA)
        if trie.size > TRIE_BYTES:
            yield from flushed()
            trie = RadixTrie()
    yield from flushed()


def _merged_tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``entry, first``: the smallest id of an entry's text in the whole table.  Rows come prefix by prefix."""
    schema = pa.schema([("entry", pa.int64()), ("first", pa.int64())])
    trie, current = RadixTrie(), None

    def flushed():
        rows = [(entry, node.least) for _, node in trie.traverse(texts=False) for entry in node.entries]
        entries, first = zip(*rows, strict=True) if rows else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(entries, pa.int64()), pa.array(first, pa.int64())], schema=schema)

    for batch in batches:
        columns = batch.column("prefix").to_pylist(), batch.column("entry").to_pylist(), batch.column("least").to_pylist()
        for prefix, entry, least, text in zip(*columns, batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
            if prefix != current:
                if trie.size > TRIE_BYTES // 8:  # light prefixes share a trie
                    yield from flushed()
                    trie = RadixTrie()
                current = prefix
            trie.add(text, least, entry)
    yield from flushed()


def _with_prefix(entries: DataFrame) -> DataFrame:
    """Entries with the ``prefix`` they are dealt by: as long as its texts need to spread."""
    weight = F.octet_length("text") + NODE_BYTES
    total = entries.agg(F.sum(weight)).first()[0] or 0
    share = min(TRIE_BYTES, max(1, total // shuffle_partitions(entries.sparkSession)))
    length, open_rows, cells = PREFIX, entries, []
    while True:
        cut = F.substring("text", 1, length)
        heavy = (
            open_rows.groupBy(cut.alias("start"))
            .agg(F.sum(weight).alias("bytes"), F.max(F.length("text")).alias("longest"))
            .where((F.col("bytes") > share) & (F.col("longest") > length))
            .select("start")
        )
        heavy = stored(heavy, "heavy-prefixes")
        if not heavy.head(1):
            break
        cells.append((length, heavy))
        open_rows = open_rows.join(heavy, cut == F.col("start"), "left_semi")
        length *= 4
    # Heavy prefixes are at most as many as partitions or tries; where one is heavy, the next length decides.
    rows, prefix = entries, F.substring("text", 1, PREFIX)
    for number, (length, heavy) in enumerate(cells):
        name = f"start_{number}"
        rows = rows.join(heavy.withColumnRenamed("start", name), F.substring("text", 1, length) == F.col(name), "left")
        prefix = F.when(F.col(name).isNotNull(), F.substring("text", 1, 4 * length)).otherwise(prefix)
    return rows.select("entry", "least", "text", prefix.alias("prefix"))


def failed_masks(docs: DataFrame) -> DataFrame:
    """``doc_id, part, mask`` of every document; bit i of the mask is set where the document fails filter i."""
    columns = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), whole_text().alias("text"))
    rows = stored(columns.mapInArrow(_local_tries, ROWS), "local-tries")
    entries = _with_prefix(rows.where("text IS NOT NULL").select("entry", "least", "text"))
    ranged = entries.repartitionByRange("prefix").sortWithinPartitions("prefix")
    firsts = ranged.mapInArrow(_merged_tries, "entry long, first long")
    seen = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return (
        rows.where("text IS NULL")
        .join(firsts, "entry")
        .select("doc_id", "part", F.col("mask").bitwiseOR(F.when(seen, 1 << 4).otherwise(0)).alias("mask"))
    )


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents, those of quality 1, and toxic ones."""
    known = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    same = masks.groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n"))  # an id of many rows meets its label once
    counted = lambda c: F.coalesce(F.sum(F.when(F.col(c), F.col("n"))), F.lit(0)).alias(c)
    return same.join(known, "doc_id", "left").groupBy("part", "mask").agg(F.sum("n").alias("n"), counted("good"), counted("toxic"))


def _bit(letter: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), F.ascii(letter) - ord("A"))


def interactions(counts: DataFrame) -> DataFrame:
    """One row per part, order and step from the counts of masks."""
    orders = F.split(F.lit(",".join("".join(p) for p in permutations(FILTERS))), ",")
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    steps = (
        parts.withColumn("filter_order", F.explode(orders))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
        .withColumn("letter", _bit(F.substr("filter_order", F.col("step"), F.lit(1))))
        .withColumn(
            "before",
            F.aggregate(
                F.sequence(F.lit(0), F.col("step") - 1),
                F.lit(0),
                lambda known, i: known.bitwiseOR(F.when(i > 0, _bit(F.substr("filter_order", i, F.lit(1)))).otherwise(0)),
            ),
        )
    )
    letter, before = F.col("letter"), F.col("before")

    def total(name: str, holds, share=lambda m: F.lit(1)) -> Column:
        kept = F.filter("masks", lambda m: holds(m["mask"]))
        return F.aggregate(kept, F.lit(0).cast("long"), lambda s, m: (s + m[name] * share(m["mask"])).cast("long"))

    fails = lambda m: m.bitwiseAND(letter) != 0
    passed_before = lambda m: m.bitwiseAND(before) == 0
    removed = lambda m: fails(m) & passed_before(m)
    # Of all orders, a failing filter comes first in the same number as each other that the document fails.
    first = lambda m: F.call_function("div", F.lit(len(list(permutations(FILTERS)))), F.bit_count(m))
    return steps.select(
        "part",
        "filter_order",
        F.col("step").cast("int").alias("step"),
        total("n", lambda m: m.bitwiseAND(letter.bitwiseOR(before)) == 0).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda m: fails(m) & ~passed_before(m)).alias("redundant"),
        total("n", lambda m: m == letter).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        total("n", fails, first).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return interactions(stored(mask_counts(failed_masks(docs), labels), "mask-counts"))
