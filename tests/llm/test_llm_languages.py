"""Hashed n-grams against plain hashing; a table of many languages."""

from collections import Counter

import numpy as np
from conftest import ODD

from vigil.llm import langid

MIX = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def plain_buckets(text):
    padded, found = f" {text.lower()} ", Counter()
    for n in (1, 2, 3):
        for at in range(len(padded) - n + 1):
            number = n * 0x27D4EB2F
            for i in range(n):
                number += ord(padded[at + i]) * MIX[i]
            number &= 0xFFFFFFFF
            number ^= number >> 15
            found[(number * 0x2C1B3C6D & 0xFFFFFFFF) >> 16] += 1
    return found


def test_grams_equal_plain_ones(small):
    texts = [t or "" for _, t in ODD if len(t or "") < 5_000] + [r.text for r in small("documents").limit(40).collect()]
    for text in texts:
        found = Counter()
        for buckets, _, _ in langid._hashed([text]):
            found.update(buckets[buckets < langid.BUCKETS].tolist())
        assert found == plain_buckets(text)


def test_many_languages(spark):
    rows = [(n, f"{chr(0x4E00 + 40 * (n % 120))}{chr(0x4E01 + 40 * (n % 120))} a", f"l{n % 120:03d}") for n in range(1_200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(found) > 100 and np.mean([r.lang_pred == r.lang for r in found]) > 0.95
