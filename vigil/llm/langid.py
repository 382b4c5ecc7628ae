"""Language of texts by multinomial naive Bayes over hashed character n-grams.

Training sums, per language, the hashed n-grams of every labelled text (no sample).  The matrix of log
probabilities has ``BUCKETS`` rows and a column per language, so what is broadcast is bounded by these two
numbers and checked.  Scoring is sparse and in batches: the rows of a block's n-grams are gathered and summed per
text in numpy.

A text that is null or has no letter gets ``und`` and score 0.  Without any labelled text every prediction is
``und``.  Ties go to the language that sorts first.  Rows, repeated or not, are scored one by one, texts of any length
whole; an empty table gives no rows.  All columns of the input pass through.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
MAX_LANGUAGES = 256
#: Characters that are hashed at a time; longer texts are taken in pieces that overlap.
BLOCK = 1 << 17
UNDETERMINED = "und"

_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _pieces(texts: Iterable[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of code points, with the end of each piece, its text's number, and how many n-grams may begin in it."""
    chars: list[np.ndarray] = []
    rows: list[tuple[int, int]] = []
    size = 0
    for row, text in enumerate(texts):
        codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        for start in range(0, len(codes), BLOCK):
            piece = codes[start : start + BLOCK + max(ORDERS) - 1]
            chars.append(piece)
            rows.append((row, min(BLOCK, len(codes) - start)))
            size += len(piece)
            if size >= BLOCK:
                yield _joined(chars, rows)
                chars, rows, size = [], [], 0
    if chars:
        yield _joined(chars, rows)


def _joined(chars: list[np.ndarray], rows: list[tuple[int, int]]):
    lengths = np.fromiter(map(len, chars), dtype=np.int64)
    return np.concatenate(chars), lengths, np.array(rows, dtype=np.int64)


def _hashed(texts: Iterable[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per block and order: buckets of the n-grams by position (``BUCKETS`` where none begins), starts, texts."""
    for codes, lengths, rows in _pieces(texts):
        ends = np.cumsum(lengths)
        starts = ends - lengths
        for n in ORDERS:
            begin = np.minimum(rows[:, 1], np.maximum(lengths - n + 1, 0))
            mixed = np.full(len(codes), n * 0x27D4EB2F, dtype=np.uint32)
            for i in range(n):
                mixed[: len(codes) - i] += codes[i:] * _MIX[i]
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0x2C1B3C6D)
            buckets = (mixed >> np.uint32(16)).astype(np.int64)
            inside = np.zeros(len(codes) + 1, dtype=np.int32)
            np.add.at(inside, starts, 1)
            np.add.at(inside, starts + begin, -1)
            buckets[np.cumsum(inside[:-1]) == 0] = BUCKETS
            yield buckets, starts, rows[:, 0]


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    grams: dict[str, np.ndarray] = {}
    documents: dict[str, int] = {}
    for batch in batches:
        for lang, texts in batch.groupby("lang", sort=True)["text"]:
            total = grams.setdefault(lang, np.zeros(BUCKETS + 1, dtype=np.int64))
            documents[lang] = documents.get(lang, 0) + len(texts)
            for buckets, _, _ in _hashed(texts):
                total += np.bincount(buckets, minlength=BUCKETS + 1)
    for lang, total in grams.items():
        total[BUCKETS] = documents[lang]
        used = np.flatnonzero(total)
        yield pd.DataFrame({"lang": lang, "bucket": used, "n": total[used]})


def _vector(group: pd.DataFrame) -> pd.DataFrame:
    """A language's counts as one array."""
    counts = np.zeros(BUCKETS + 1, dtype=np.int64)
    counts[group["bucket"]] = group["n"]
    return pd.DataFrame({"lang": [group["lang"].iloc[0]], "counts": [counts.tobytes()]})


class Model:
    """Languages and their log probabilities; the last row of the matrix is for places without an n-gram."""

    def __init__(self, languages: list[str], weights: np.ndarray, prior: np.ndarray):
        self.languages, self.weights, self.prior = languages, weights, prior

    def predict(self, texts: Iterable[str | None]) -> tuple[list[str], np.ndarray]:
        texts = ["" if x is None else x for x in texts]
        sums = np.tile(self.prior, (len(texts), 1))
        if self.languages:
            for buckets, starts, rows in _hashed(texts):
                np.add.at(sums, rows, np.add.reduceat(self.weights[buckets], starts, axis=0))
            best = sums.argmax(axis=1)
            score = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
        found = [bool(self.languages) and has_letter(x) for x in texts]
        names = [self.languages[best[i]] if ok else UNDETERMINED for i, ok in enumerate(found)]
        return names, np.array([score[i] if ok else 0.0 for i, ok in enumerate(found)])


def train(labelled: DataFrame) -> Model:
    """Model from ``text`` and ``lang``; rows without either are left out."""
    rows = labelled.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    summed = rows.mapInPandas(_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    if len(labelled.select("lang").where("lang IS NOT NULL").distinct().limit(MAX_LANGUAGES + 1).collect()) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    found = summed.groupBy("lang").applyInPandas(_vector, "lang string, counts binary")  # at most BUCKETS + 1 rows a language
    table = {r.lang: np.frombuffer(r.counts, np.int64) for r in found.toLocalIterator()}  # half a MB for each language
    languages = sorted(table)
    counts = np.zeros((BUCKETS + 1, len(languages)))
    for i, lang in enumerate(languages):
        counts[:, i] = table[lang]
    grams, documents = counts[:BUCKETS], counts[BUCKETS]
    weights = np.zeros_like(counts)
    weights[:BUCKETS] = np.log((grams + 1) / (grams.sum(axis=0) + BUCKETS)) if languages else 0
    return Model(languages, weights, np.log(documents / documents.sum()) if languages else documents)


def predicted(spark: SparkSession, model: Model, text: Column) -> Column:
    """Struct of ``lang_pred`` and ``score`` for a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        names, scores = shared.value.predict(texts)
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return predict(text)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for documents that never train: crc32 of the id as text is divisible by ``folds`` (null: empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == 0


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: a model from the documents that train, applied to every document."""
    spark = docs.sparkSession
    model = train(docs.where(~held_out(F.col("doc_id"))))
    return docs.select("doc_id", "text").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), predicted(spark, model, F.col("text")).alias("p")
    ).select("doc_id", "held_out", "p.lang_pred", "p.score")
