import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[2]), str(Path(__file__).resolve().parent)]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small(spark):
    from vigil.llm.shared import ship

    return lambda name: ship(spark).read.parquet(f"{SMALL}/{name}.parquet")


LONG = "un mot " * 30_000
PASSAGE = "the quick brown fox jumps over the lazy dog while nobody in the whole village is looking at it"

#: Rows that every operator must bear: nulls, empty and very long texts, ties, repeated rows, markup of the formats.
ODD = [
    (1, "plain words that stand in one document only, with nothing odd about them"),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, "x"),
    (6, LONG),
    (7, "a" * 20_000),
    (8, "9" * 20_000 + " 1.2.3.4.5.6.7.8 4111 1111 1111 1111"),
    (9, f"{PASSAGE}. first"),
    (10, f"second {PASSAGE}"),
    (11, f"{PASSAGE}. first"),
    (11, f"{PASSAGE}. first"),
    (12, "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 3),
    (13, "Licensed under the MIT License. CC-BY-NC! Apache License, Version 2.0 under the mit license"),
    (14, "mail a@b.c..d@e.f.g, x+y@z-1.example.com_q@r.st or +1 (234) 555-0199, +44 20 7946 0958; 999.1.1.1 255.255.255.0"),
    (15, "É́ naïve Straße ΟΔΟΣ 日本語 𐍈 ▁▁ \0 <|endoftext|> don't WE'RE \x1c\x85\xa0"),
    (16, "word " * 60),
    (17, "word " * 61),
    (None, "the row without an id has words as well"),
    (None, None),
    (18, "a@" + "b." * 9_000 + "c"),
    (19, "+" + "1" * 8 + "(" * 9_000 + "+1-234-567-8901"),
]


@pytest.fixture(scope="session")
def odd(spark, small):
    """Odd rows with columns whose names operators use inside."""
    rows = [(i, t, "fr" if i == 6 else "en" if i and i % 2 else None, 7, "k", None, 1.5) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, run int, digest string, fp long, score double").repartition(3)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def plain():
    """Rows of a result or table as sorted tuples."""

    def rows(frame, *columns):
        return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)

    return rows
