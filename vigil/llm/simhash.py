"""SimHash near-duplicates through Golay codes.

Fingerprint: of the 64-bit hashes of all word shingles, a bit is 1 if it is set in over half of them.

Search, for at most ``DISTANCE`` = 2 differing bits, over distinct fingerprints.  A fingerprint is cut into three
segments of at most 23 bits.  By the pigeonhole principle one segment of a linked pair has no error.  The next
segment has at most two; it is decoded with the perfect (23, 12) Golay code: the code word indices of all words within
one bit of it, six or one of them.  Two words up to two bits apart have a word between them that is within one bit of
both, so they share an index.  A key is the error-free segment with one index of the next: about 16 keys a
fingerprint, each over 33 bits long.  Fingerprints that share a key are joined and verified by their distance.

Keys that more than ``BUCKET`` fingerprints share (many near copies) are not paired.  Their fingerprints are
linked through the words within one bit of them instead: two fingerprints are at most two bits apart exactly if
they have such a word in common, and at most 65 fingerprints can share one.  That way is exact and linear too.

Null text and text without words have fingerprint zero and are linked like any other.  Repeated rows and rows
that share doc_id are each returned.  A null doc_id is never the id of a component unless all its ids are null.
Texts of any length are hashed whole.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from vigil.llm.components import components
from vigil.llm.shared import fresh, stored, whole_text

SHINGLE = 3
DISTANCE = 2
SEED = 42
#: Fingerprints of one key that are paired; keys with more go the other exact way.
BUCKET = 48
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and width
#: Generator polynomial of the binary Golay code (fixed value).
GENERATOR = 0xC75

_HASHES = 1 << 14
_INDEX: list[np.ndarray] = []


def fingerprint(text: str, size: int = SHINGLE) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    totals = np.zeros(64, dtype=np.int64)
    for start in range(0, n, _HASHES):
        part = words[start : start + _HASHES + size - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(size)), strict=False)) if len(words) > size else [b" ".join(words)]
        hashes = np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in shingles), dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        totals += bits.sum(axis=0, dtype=np.int32)
    return sum(1 << i for i in np.flatnonzero(2 * totals > n).tolist())


def fingerprints(text: Column, size: int = SHINGLE) -> Column:
    """Fingerprint of a text column as a long (the 64 bits, signed)."""

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(x, size) for x in texts], dtype=np.uint64).view(np.int64))

    return prints(F.coalesce(text, F.lit("")))


def golay_indices() -> np.ndarray:
    """Index (the upper 12 bits) of the code word nearest to every 23-bit word."""
    if not _INDEX:
        patterns = np.array([0, *(1 << i for i in range(23)), *(1 << i | 1 << j for i in range(23) for j in range(i)),
                             *(1 << i | 1 << j | 1 << k for i in range(23) for j in range(i) for k in range(j))], dtype=np.uint32)
        error = np.zeros(1 << 11, dtype=np.uint32)
        error[_remainder(patterns.copy())] = patterns  # a perfect code: every remainder has one pattern of up to 3 bits
        table = np.empty(1 << 23, dtype=np.uint16)
        for start in range(0, len(table), 1 << 18):
            words = np.arange(start, start + (1 << 18), dtype=np.uint32)
            table[start : start + (1 << 18)] = (words ^ error[_remainder(words.copy())]) >> np.uint32(11)
        _INDEX.append(table)
    return _INDEX[0]


def _remainder(words: np.ndarray) -> np.ndarray:
    for bit in range(22, 10, -1):
        words ^= (words >> np.uint32(bit) & np.uint32(1)) * np.uint32(GENERATOR << (bit - 11))
    return words


def search_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of unsigned fingerprints: (position, key) pairs."""
    index = golay_indices()
    near = np.array([0, *(1 << i for i in range(23))], dtype=np.uint32)
    parts = [(prints >> np.uint64(first) & np.uint64((1 << width) - 1)) for first, width in SEGMENTS]
    positions, keys = [], []
    for i, exact in enumerate(parts):
        following = parts[(i + 1) % len(parts)].astype(np.uint32)
        indices = np.sort(index[following[:, None] ^ near], axis=1).astype(np.uint64)
        new = np.ones(indices.shape, dtype=bool)
        new[:, 1:] = indices[:, 1:] != indices[:, :-1]
        at, column = np.nonzero(new)
        positions.append(at)
        keys.append(np.uint64(i) << np.uint64(40) | exact[at] << np.uint64(12) | indices[at, column])
    return np.concatenate(positions), np.concatenate(keys)


def _keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        prints = batch["fp"].to_numpy(np.int64)
        at, keys = search_keys(prints.view(np.uint64))
        yield pd.DataFrame({"key": keys.view(np.int64), "fp": prints[at]})


def links(distinct: DataFrame) -> DataFrame:
    """Edges ``u, v`` between distinct fingerprints (column ``fp``), enough of them to join all that are linked."""
    keyed = stored(distinct.select("fp").mapInPandas(_keyed, "key long, fp long"), "golay-keys")
    sizes = keyed.groupBy("key").count().where("count > 1")
    shared = stored(keyed.join(sizes, "key"), "golay-buckets")
    small = shared.where(F.col("count") <= BUCKET).select("key", "fp")
    pairs = (
        small.withColumnRenamed("fp", "u")
        .join(small.withColumnRenamed("fp", "v"), "key")
        .where(F.col("u") < F.col("v"))
        .where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= DISTANCE)
        .select("u", "v")
    )
    flips = F.array(F.lit(0).cast("long"), *[F.lit(np.int64(np.uint64(1 << i).astype(np.int64)).item()) for i in range(64)])
    crowded = shared.where(F.col("count") > BUCKET).select("fp").distinct()
    between = crowded.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("word"))
    least = between.groupBy("word").agg(F.min("fp").alias("v"), F.collect_set("fp").alias("all")).where(F.size("all") > 1)
    return pairs.union(least.select(F.explode("all").alias("u"), "v").where("u != v")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id`` of every document; the smallest doc_id that can be reached names a component.

    Beside them ``root``, a fingerprint that stands for the component, and ``text_hash``.
    """
    text = whole_text()
    prints = stored(docs.select("doc_id", fingerprints(text).alias("fp"), F.xxhash64(text).alias("text_hash")), "simhash")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(links(distinct))
    named = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = named.join(smallest, "root").select("fp", "root", "component_id")
    return prints.join(ids, "fp").select("doc_id", "fp", "component_id", "root", "text_hash")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest doc_id.

    Of rows that share that doc_id the smallest text hash stays, of equal rows one.
    """
    names = {n: fresh(n, docs.columns) for n in ("no_id", "id", "hash", "number")}
    on = [names[n] for n in ("no_id", "id", "hash")]
    row = lambda text_hash: [
        F.col("doc_id").isNull().alias(on[0]), F.coalesce("doc_id", F.lit(0)).cast("long").alias(on[1]), text_hash.alias(on[2])
    ]
    found = near_duplicates(docs).select("root", F.struct(*row(F.col("text_hash"))).alias("row"))
    keep = found.groupBy("root").agg(F.min("row").alias("row")).select("row.*")
    stay = docs.select("*", *row(F.xxhash64(whole_text()))).join(keep, on, "left_semi")
    first = F.row_number().over(Window.partitionBy(*on).orderBy(*on[:1]))
    return stay.withColumn(names["number"], first).where(F.col(names["number"]) == 1).select(*docs.columns)
