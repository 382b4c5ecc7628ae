"""Quality by weak supervision: rules vote or abstain, and the posterior of all votes decides instead of each rule.

A rule speaks for one class only: most know one sign of bad text, some a sign of good text, and where the sign is
missing a rule abstains.  A document's votes are one pattern of bits; patterns are counted over all documents, at most
``2 ** rules`` rows whatever the size of the corpus.  On these counts expectation-maximisation estimates the share of good
documents and how probable each rule's vote is in good and in bad ones, and with that the rule's accuracy (Dawid and
Skene; abstaining may depend on the class).  A vote may not count against its side, which keeps the two classes from
changing places.  A document stays if its pattern's posterior of being good reaches ``KEEP``; it fails whatever its
votes if it fails a base rule: under ``MIN_WORDS`` words, or more than ``MAX_REPEATED`` percent of its words in repeated
windows.

Null text counts as empty, and an empty text fails a base rule.  Repeated rows and rows without an id are judged each for
itself.  Texts of any length are judged whole.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vigil.llm.shared import fresh, stored, whole_text

MIN_WORDS = 50
#: Percent of words in repeated windows that a text may have, and words of a window.
MAX_REPEATED = 50
WINDOW = 3

#: Change of a belief at which expectation-maximisation has converged, and rounds at most.
TOLERANCE = 1e-6
ROUNDS = 10_000
#: Posterior of being good from which a document stays.
KEEP = 0.5

BAD, GOOD = -1, 1

_CONTINUED = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
_LETTER = re.compile(rb"[A-Za-z\x80-\xff]")
_ENDS = (b".", b"!", b"?", b'"', b"'", b")", b"\xe3\x80\x82", b"\xe2\x80\x9d", b"\xc2\xbb")


def _repeated(words: list[bytes]) -> int:
    """Words that stand in a window found twice or more."""
    if len(words) <= WINDOW:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    windows = np.zeros(len(ids) - WINDOW + 1, np.int64)
    for i in range(WINDOW):
        # Numbers of the windows so far, by rank: products of two ranks stay far below 2 ** 63.
        _, windows = np.unique(windows * len(known) + ids[i : i + len(windows)], return_inverse=True)
    again = np.bincount(windows)[windows] > 1
    covered = np.zeros(len(ids) + 1, np.int64)
    starts = np.flatnonzero(again)
    np.add.at(covered, starts, 1)
    np.add.at(covered, np.minimum(starts + WINDOW, len(ids)), -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


MEASURES = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
    "n_lines": "long", "n_ended_lines": "long", "n_distinct": "long", "n_lettered": "long", "n_capitals": "long", "n_digits": "long",
}


def measures(text: bytes) -> tuple[int, ...]:
    """Counts of a text in the order of ``MEASURES``; words are parted at ASCII white space, lines at line feeds."""
    words = text.split()
    joined = b"".join(words)
    lines = [x for x in text.split(b"\n") if x.split()]
    bare = [x.rstrip() for x in lines]
    distinct = set(words)
    lettered = {w for w in distinct if _LETTER.search(w)}
    return (
        len(words),
        len(joined.translate(None, _CONTINUED)),
        len(text) - len(text.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated(words),
        len(lines),
        sum(x.endswith(_ENDS) for x in bare),
        len(distinct),
        sum(w in lettered for w in words) if len(lettered) < len(distinct) else len(words),
        len(joined) - len(joined.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
        len(joined) - len(joined.translate(None, b"0123456789")),
    )


class Rule(NamedTuple):
    """Votes ``vote`` where it applies, else abstains."""

    name: str
    vote: int
    applies: Column


def rules() -> list[Rule]:
    """Most rules know one sign of bad text and say nothing of the rest; two speak for a text."""
    c = F.col
    words, lines = c("n_words"), c("n_lines")
    over = lambda name, percent, of=words: 100 * c(name) > percent * of
    prose = (words >= MIN_WORDS) & ~over("n_symbols", 1) & ~over("n_capitals", 8, c("word_chars"))
    return [
        Rule("short", BAD, words < MIN_WORDS),
        Rule("word length", BAD, (c("word_chars") < 3 * words) | over("word_chars", 1_000)),
        Rule("symbols", BAD, over("n_symbols", 10)),
        Rule("repeated lines", BAD, over("n_dup_lines", 30, lines)),
        Rule("repeated words", BAD, over("n_repeat_words", 20)),
        Rule("vocabulary", BAD, (words >= 100) & (words <= 2_000) & ~over("n_distinct", 15)),
        Rule("letters", BAD, ~over("n_lettered", 80)),
        Rule("capitals", BAD, over("n_capitals", 20, c("word_chars"))),
        Rule("open lines", BAD, (lines >= 5) & ~over("n_ended_lines", 10, lines)),
        Rule("prose", GOOD, prose & over("n_lettered", 95) & over("n_ended_lines", 50, lines)),
        Rule("varied words", GOOD, (words >= MIN_WORDS) & over("n_distinct", 35) & ~over("n_repeat_words", 5)),
    ]


def pattern(votes: list[Rule]) -> Column:
    """The rules that vote, a bit each, the first rule's lowest."""
    return sum((F.when(r.applies, 1 << i).otherwise(0) for i, r in enumerate(votes)), F.lit(0)).cast("int")


def _cast(patterns: np.ndarray, number: int) -> np.ndarray:
    """``[pattern, rule]``: 1 where the rule votes."""
    return (patterns[:, None] >> np.arange(number) & 1).astype(np.float64)


class Model(NamedTuple):
    """Share of good documents, and for each rule how probable its vote is in bad and in good documents."""

    prior: float
    chance: np.ndarray  # [class, rule], classes bad and good
    sides: np.ndarray  # +1 for rules that vote good, -1 for the others

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of being good, from the votes cast and those withheld."""
        cast = _cast(patterns, len(self.sides))
        bad, good = (cast @ np.log(c) + (1 - cast) @ np.log1p(-c) for c in self.chance)
        return 1 / (1 + np.exp(np.clip(np.log1p(-self.prior) + bad - np.log(self.prior) - good, -700, 700)))

    def accuracy(self) -> np.ndarray:
        """For each rule the probability that a vote of its agrees with the class."""
        cast = self.chance * np.array([1 - self.prior, self.prior])[:, None]
        return np.where(self.sides > 0, cast[1], cast[0]) / cast.sum(axis=0)


def estimate(patterns: np.ndarray, counts: np.ndarray, sides: np.ndarray) -> Model:
    """Expectation-maximisation over counted patterns of votes, begun at the majority of votes."""
    cast, weight = _cast(patterns, len(sides)), counts.astype(np.float64)
    belief = 0.5 + 0.4 * np.sign(cast @ sides)
    for _ in range(ROUNDS):
        of_class = np.stack([weight * (1 - belief), weight * belief])
        # One vote and one abstention are added in each class, which keeps chances off zero and one.
        cast_in, size = of_class @ cast + 1, of_class.sum(axis=1)[:, None] + 2
        chance = cast_in / size
        # A vote may not count against its side: where it would, both classes get what they have together.
        against = (chance[1] - chance[0]) * sides < 0
        chance[:, against] = (cast_in.sum(axis=0) / size.sum())[against]
        model = Model(float(size[1, 0] / size.sum()), chance, sides)
        before, belief = belief, model.posterior(patterns)
        if len(belief) == 0 or np.abs(belief - before).max() < TOLERANCE:
            break
    return model


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of every document."""

    @F.pandas_udf(", ".join(f"{n} {t}" for n, t in MEASURES.items()))
    def counts(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measures(t) for t in texts], columns=list(MEASURES))

    found = fresh("counts", docs.columns)
    return docs.select("doc_id", counts(whole_text().cast("binary")).alias(found)).select("doc_id", f"{found}.*")


def train(rows: DataFrame, votes: list[Rule]) -> tuple[Model, pd.DataFrame]:
    """The model of all measured documents, and the counted patterns it comes from (at most ``2 ** rules`` rows)."""
    counted = rows.groupBy(pattern(votes).alias("pattern")).agg(F.count("*").alias("n")).orderBy("pattern").toPandas()
    return estimate(counted["pattern"].to_numpy(np.int64), counted["n"].to_numpy(), np.array([r.vote for r in votes])), counted


def judged(docs: DataFrame) -> DataFrame:
    """Every document with its counts, ``base_failed``, ``posterior`` and ``kept``."""
    spark: SparkSession = docs.sparkSession
    votes = rules()
    rows = stored(measured(docs).withColumn("pattern", pattern(votes)), "measures")
    model, counted = train(rows, votes)
    table = [(int(p), float(x)) for p, x in zip(counted["pattern"], model.posterior(counted["pattern"].to_numpy(np.int64)), strict=True)]
    posteriors = spark.createDataFrame(table, "pattern int, posterior double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return (
        rows.join(F.broadcast(posteriors), "pattern")  # at most 2 ** rules rows
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= KEEP))
        .select("doc_id", *MEASURES, "base_failed", "kept", "posterior", "pattern")
    )
