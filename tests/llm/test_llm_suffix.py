"""Longest previous factors against plain ones; hot passages and hot rows at small limits; odd tables."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.llm import suffix_dedup

COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
SCHEMA = "doc_id long, text string"


def _windows(letters, number, seed):
    rng = np.random.default_rng(seed)
    width = suffix_dedup.WINDOW
    rows = [bytes(rng.choice(list(letters), rng.integers(1, 7)).tolist()) for _ in range(number)]
    return np.array([(r * width)[: rng.choice([3, 10, width])].ljust(width, b"z") for r in rows], dtype=f"S{width}"), rng.integers(0, 40, number)


def _common(a, b):
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=True)) if x != y), len(a))


@pytest.mark.parametrize("letters", [b"a", b"ab", b"abcd"])
def test_factors_equal_plain_ones(letters):
    windows, owners = _windows(letters, 300, len(letters))
    found = suffix_dedup.longest_previous_factors(windows, owners)
    for i, (window, owner) in enumerate(zip(windows, owners, strict=True)):
        want = max((_common(window, windows[j]) for j in range(len(windows)) if owners[j] < owner), default=0)
        assert found.length[i] == want
        assert (owners[found.source[i]] < owner and _common(window, windows[found.source[i]]) == want) if want else found.source[i] == i
    short = suffix_dedup.longest_previous_factors(windows, owners, lengths=False)
    assert ((short.length == suffix_dedup.WINDOW) == (found.length == suffix_dedup.WINDOW)).all()
    assert suffix_dedup.previous_factors(windows, owners).tolist() == [min(o for w, o in zip(windows, owners, strict=True) if w == x) for x in windows]


@pytest.mark.parametrize("values", [[], [3], list(range(50)), list(range(50, 0, -1)), [7] * 60, random.Random(1).choices(range(9), k=500)])
def test_nearest_smaller(values):
    found = suffix_dedup._nearest_smaller(np.array(values, dtype=np.int64)).tolist()
    assert found == [next((j for j in range(i - 1, -1, -1) if values[j] < v), -1) for i, v in enumerate(values)]


def _check(spark, plain, rows):
    found = plain(suffix_dedup.without_later_copies(spark.createDataFrame(rows, SCHEMA).repartition(6)), *COLUMNS)
    assert found == sorted(brute.later_copies(rows), key=str)
    return found


@pytest.mark.parametrize("frequent", [1, 3, 256])
def test_a_passage_in_a_third_of_all_documents(spark, plain, monkeypatch, frequent):
    """Thirty-five bytes that no window covers, and sixty that are covered, with differing text on both sides."""
    monkeypatch.setattr(suffix_dedup, "FREQUENT", frequent)
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", 12_000)
    rng = random.Random(frequent)
    other = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    hot, covered = other(35), other(60)
    rows = [(n, other(60) + (hot if n % 3 == 0 else covered if n % 3 == 1 else "") + other(60)) for n in range(2_000)]
    found = _check(spark, plain, rows)
    lost = {r[0]: r[2] for r in found}
    assert all(lost[n] == 0 for n in range(2_000) if n % 3 == 0) and sum(lost[n] >= 60 for n in range(2_000)) > 600


def test_thousands_of_equal_rows_are_spread(spark, plain, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "FREQUENT", 4)
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", 20_000)
    text = "one and the same row stands here as often as anybody likes to have it"
    rows = [(5, text)] * 4_000 + [(None, "")] * 1_000 + [(6, text), (4, text[:60]), (7, None)]
    seen = []
    write = suffix_dedup._Job

    class Watched(write):
        def __init__(self, folder, *more):
            seen.append(folder)
            super().__init__(folder, *more)

    monkeypatch.setattr(suffix_dedup, "_Job", Watched)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    total = suffix_dedup.without_later_copies(frame).groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("n_removed").alias("lost")).collect()
    assert {r.doc_id: (r.n, r.lost) for r in total} == {5: (4_000, 60 * 4_000), None: (1_000, 0), 6: (1, len(text)), 4: (1, 0), 7: (1, 0)}
    sizes = [r.n for r in spark.read.parquet(seen[0]).groupBy("chunk").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 10 and max(sizes) < 2 * sum(sizes) / len(sizes)


def test_clashing_columns(odd, plain):
    docs = odd
    for name in ("chunk", "bucket", "keys", "hot", "repeated", "n_bytes"):
        docs = docs.withColumn(name, F.lit("z"))
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert plain(suffix_dedup.without_later_copies(docs), *COLUMNS) == sorted(brute.later_copies(rows), key=str)
