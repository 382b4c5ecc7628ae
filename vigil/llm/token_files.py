"""Token ids in Arrow stream files with fixed-size-list batches.

A corpus is a folder of pairs of files.  ``part-N.tokens.arrow`` is an Arrow stream whose record batches hold
``ids`` (fixed-size lists of ``LENGTH`` unsigned integers, 16 bits wide where the vocabulary allows) and ``mask``
(fixed-size lists of booleans, a bit each: true for a token, false for padding).  Documents are packed one after the other, in ascending doc_id
order, across list and batch borders; only a file's last list is padded.  Every batch but a file's last has
``LISTS`` lists, so list k lies in batch ``k // LISTS`` and is read from the mapped file without a copy.
``part-N.docs.arrow`` has a row per document: doc_id, its first position in the file and its number of tokens.

Tasks encode, write and read; files are named by partition and renamed when whole, so a repeated task puts the
same file in place.  ``manifest`` (Parquet) lists the files of the finished job with their totals.

Null text counts as empty: such a document has its end id alone.  A null doc_id comes first.  Rows that share
doc_id are separate documents, in the order of their texts.  Texts of any length are encoded whole.  An empty
table makes no files.  Other columns are
ignored.
"""

from __future__ import annotations

import contextlib
import json
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from vigil.llm.shared import shared_folder, store, whole_file, whole_text

LENGTH = 2048
LISTS = 64
#: Characters of a text that tell ranges of rows with one id apart.
SPLIT_LENGTH = 64
#: Distinct words that a worker remembers, and the longest that it does.
WORDS = 400_000
WORD_LENGTH = 48
#: Marks at the end of a word that are encoded apart from it where the library does so.
MARKS = ".,;:!?"

#: Byte-level vocabularies write a byte as a printable character: itself, or those from 256 on in turn.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*_PRINTED}))}

_ENCODERS: dict[str, WordEncoder] = {}


class WordEncoder(dict):
    """Ids of white-space separated words, as bytes, by the ``tokenizers`` library.

    For vocabularies whose normalizer and pre-tokenizer never look across white space (``word_bpe``): a text's ids
    are then those of its words, and frequent words are encoded once per worker.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.specials = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as file:
            kinds = (lambda x: json.dumps([x.get("normalizer"), x.get("pre_tokenizer")]))(json.load(file))
        #: Whether words may be split and lower-cased before they reach the library.
        self.by_word = all(x in kinds for x in ('"Lowercase"', r"[\\p{L}]+", '"invert": true'))
        self.before: dict[str, bytes] = {}
        self.apart: dict[str, bool] = {}

    def _marks_apart(self, letter: str) -> bool:
        """Whether every mark behind the letter is a pre-token of its own.

        Some letters are normalized to a letter and a combining character, which joins the mark behind it.
        """
        answer = self.apart.get(letter)
        if answer is None:
            normal, parts = self.tokenizer.normalizer.normalize_str, self.tokenizer.pre_tokenizer.pre_tokenize_str
            answer = self.apart[letter] = all(parts(normal(letter + x))[-1][0] == x for x in MARKS)
        return answer

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = self._ids(word)
        if len(word) <= WORD_LENGTH:
            if len(self) >= WORDS:  # the older half goes, what is used again comes back
                self.before = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def _ids(self, word: str) -> bytes:
        if word.isalpha() and max(word) <= "ÿ":  # one pre-token; composed letters, so only the case changes
            low = word.lower()
            if low != word:
                return self[low]
            return array(self.code, [t.id for t in self.model.tokenize(low.encode().decode("latin-1").translate(BYTE_LETTERS))]).tobytes()
        if len(word) > 1 and word[-1] in MARKS and word[:-1].isalpha() and self._marks_apart(word[-2]):
            return self[word[:-1]] + self[word[-1]]
        return array(self.code, self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str) -> bytes:
        if not self.by_word or any(x in text for x in self.specials if " " in x):
            return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        # Only characters that are white space under every definition divide words here.
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join(map(self.__getitem__, filter(None, words)))


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


class _Packer:
    """Lists of one file, written as their tokens arrive."""

    def __init__(self, sink, dtype: np.dtype, length: int, lists: int):
        self.length, self.lists, self.dtype = length, lists, dtype
        kind = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.writer = pa.ipc.new_stream(sink, self.schema)
        self.waiting: list[bytes] = []
        self.bytes, self.n = 0, 0

    def add(self, ids: bytes) -> None:
        self.waiting.append(ids)
        self.bytes += len(ids)
        self.n += len(ids) // self.dtype.itemsize
        if self.bytes >= self.length * self.lists * self.dtype.itemsize:
            self._flush()

    def _flush(self, last: bool = False) -> None:
        ids = np.frombuffer(b"".join(self.waiting), self.dtype)
        step = self.length * self.lists
        whole = len(ids) if last else len(ids) // step * step
        for start in range(0, whole, step):
            part = ids[start : min(start + step, whole)]
            padded = np.zeros(-(-len(part) // self.length) * self.length, self.dtype)
            padded[: len(part)] = part
            mask = np.arange(len(padded)) < len(part)
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (padded, mask)]
            self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        rest = ids[whole:].tobytes()
        self.waiting, self.bytes = [rest], len(rest)

    def close(self) -> None:
        self._flush(last=True)
        self.writer.close()


class TokenFile:
    """Random access to the lists of one file, and to its documents' tokens."""

    def __init__(self, uri: str):
        fs, path = store(uri)
        source = pa.memory_map(path) if fs.type_name == "local" else fs.open_input_file(path)
        reader = pa.ipc.open_stream(source)
        self.batches = list(reader)
        self.length = reader.schema.field("ids").type.list_size
        self.lists = len(self.batches[0]) if self.batches else 0
        self.ids = [b.column(0).flatten().to_numpy(zero_copy_only=True) for b in self.batches]
        self.mask = [b.column(1).flatten() for b in self.batches]

    def __len__(self) -> int:
        return sum(map(len, self.batches))

    def __getitem__(self, k: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of list ``k``: views of the mapped file, the mask as an Arrow array of bits."""
        batch, at = divmod(k, self.lists)
        part = slice(at * self.length, (at + 1) * self.length)
        return self.ids[batch][part], self.mask[batch][part]

    def tokens(self, start: int, n: int) -> np.ndarray:
        """``n`` tokens from position ``start``; a view where they lie in one batch."""
        step, parts = self.lists * self.length, []
        while n > 0:
            batch, at = divmod(start, step)
            part = self.ids[batch][at : at + n]
            parts.append(part)
            start, n = start + len(part), n - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint16)


DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
MANIFEST = "part int, tokens string, docs string, n_docs long, n_tokens long"


def _writer(folder: str, path: str, end: int, length: int, lists: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = encoder(path), TaskContext.get().partitionId()
        mark = np.array([end], words.dtype).tobytes()
        names = [f"{folder}/part-{part:06d}.{x}.arrow" for x in ("tokens", "docs")]
        ids, starts, sizes = [], [], []
        with contextlib.ExitStack() as files:
            packer = None
            for batch in batches:
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                    if packer is None:  # an empty partition makes no file
                        packer = _Packer(files.enter_context(whole_file(names[0])), words.dtype, length, lists)
                    encoded = words.ids(text.as_py()) + mark
                    ids.append(doc_id)
                    starts.append(packer.n)
                    sizes.append(len(encoded) // words.dtype.itemsize)
                    packer.add(encoded)
            if packer is None:
                return
            packer.close()
        with whole_file(names[1]) as file, pa.ipc.new_stream(file, DOCS) as out:
            out.write_table(pa.table([ids, starts, sizes], schema=DOCS))
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "tokens": [names[0]], "docs": [names[1]], "n_docs": [len(ids)], "n_tokens": [packer.n]}
        )

    return write


def write_tokens(
    docs: DataFrame, tokenizer: str, end: int, folder: str | None = None, length: int = LENGTH, lists: int = LISTS
) -> str:
    """Encode ``docs`` with the tokenizer file and write them, ``end`` after each, in doc_id order; returns the folder."""
    folder = folder or shared_folder(docs.sparkSession, "tokens")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), F.monotonically_increasing_id().alias("row")
    )
    # Rows that share an id, or id and text, are still spread over ranges; equal rows may change places.
    ordered = (
        rows.repartitionByRange("doc_id", F.substring("text", 1, SPLIT_LENGTH), "row")
        .sortWithinPartitions("doc_id", "text")
        .select("doc_id", "text")
    )
    ordered.mapInArrow(_writer(f"{folder}/files", tokenizer, end, length, lists), MANIFEST).write.parquet(f"{folder}/manifest")
    return folder


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Files in order, each with the number of tokens in the files before it."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").withColumn(
        "base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))
    )


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, file`` of every document, read back from the files."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                file = TokenFile(row.tokens)
                fs, path = store(row.docs)
                with fs.open_input_stream(path, compression=None) as source:
                    docs = pa.ipc.open_stream(source.read()).read_all().to_pandas(integer_object_nulls=True)
                sums = [
                    zlib.crc32(file.tokens(s, n).astype("<u4").tobytes())
                    for s, n in zip(docs["start"], docs["n_tokens"], strict=True)
                ]
                yield pd.DataFrame(
                    {"doc_id": docs["doc_id"], "start": docs["start"] + row.base, "n_tokens": docs["n_tokens"], "ids_crc32": sums, "file": row.tokens}
                )

    files = manifest(spark, folder)
    dealt = files.repartition(max(1, min(files.count(), 4 * spark.sparkContext.defaultParallelism)), "part")
    return dealt.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long, file string")


def token_documents(docs: DataFrame, tokenizer: str, end: int, **layout) -> DataFrame:
    """Write and read back."""
    return read_documents(docs.sparkSession, write_tokens(docs, tokenizer, end, **layout))
