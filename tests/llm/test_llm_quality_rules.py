"""Quality rules: counts against a plain restatement, the estimate against known votes, the verdicts against labels."""

import math
import re
from collections import Counter

import numpy as np
from conftest import ODD
from pyspark.sql import functions as F

from vigil.llm import quality_rules

BASE = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def plain_counts(doc_id, text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    earlier, same = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            same += line in earlier
            earlier.add(line)
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return (doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), same, len(repeated), failed)


def test_counts_equal_plain_ones(small, plain):
    docs = small("documents")
    found = quality_rules.judged(docs)
    assert plain(found, *BASE) == sorted((plain_counts(r.doc_id, r.text) for r in docs.collect()), key=str)
    assert found.where("kept AND base_failed").count() == 0


def test_odd_rows_and_clashing_columns(odd, plain):
    docs = odd
    for name in ("pattern", "posterior", "kept", "n_words", "counts"):
        docs = docs.withColumn(name, F.lit("z"))
    assert plain(quality_rules.judged(docs), *BASE) == sorted((plain_counts(*r) for r in ODD), key=str)


def test_empty_table(nothing):
    assert quality_rules.judged(nothing).collect() == []


def plain_posteriors(casts, sides):
    """The same estimate, document by document."""
    belief = [0.5 + 0.4 * np.sign(sum(s for s, c in zip(sides, cast, strict=True) if c)) for cast in casts]
    for _ in range(10_000):
        size = {k: sum(b if k else 1 - b for b in belief) + 2 for k in (0, 1)}
        chance = {}
        for r, side in enumerate(sides):
            number = {k: sum(b if k else 1 - b for b, cast in zip(belief, casts, strict=True) if cast[r]) + 1 for k in (0, 1)}
            for k in (0, 1):
                chance[k, r] = number[k] / size[k]
            if (chance[1, r] - chance[0, r]) * side < 0:
                chance[0, r] = chance[1, r] = (number[0] + number[1]) / (size[0] + size[1])
        after = []
        for cast in casts:
            odds = math.log(size[1] / size[0])
            for r, c in enumerate(cast):
                good, bad = chance[1, r], chance[0, r]
                odds += math.log(good / bad) if c else math.log((1 - good) / (1 - bad))
            after.append(1 / (1 + math.exp(-odds)))
        moved = max(abs(x - y) for x, y in zip(after, belief, strict=True))
        belief = after
        if moved < 1e-6:
            break
    return belief


def test_verdicts_equal_a_plain_estimate(small):
    rows = quality_rules.judged(small("documents")).collect()
    sides = [r.vote for r in quality_rules.rules()]
    casts = [[r.pattern >> i & 1 for i in range(len(sides))] for r in rows]
    for row, want in zip(rows, plain_posteriors(casts, sides), strict=True):
        assert abs(row.posterior - want) < 1e-3
        assert row.kept == (not row.base_failed and row.posterior >= 0.5)


def _votes(number, prior, chance, seed=3):
    rng = np.random.default_rng(seed)
    good = rng.random(number) < prior
    cast = rng.random((number, chance.shape[1])) < chance[good.astype(int)]
    patterns, at, counts = np.unique(cast @ (1 << np.arange(chance.shape[1])), return_inverse=True, return_counts=True)
    return good, patterns, at, counts


def test_estimate_finds_the_accuracies_that_made_the_votes():
    chance = np.array([[0.6, 0.5, 0.3, 0.4, 0.1, 0.2], [0.02, 0.05, 0.01, 0.1, 0.8, 0.7]])
    sides = np.array([-1, -1, -1, -1, 1, 1])
    good, patterns, at, counts = _votes(60_000, 0.85, chance)
    model = quality_rules.estimate(patterns, counts, sides)
    assert abs(model.prior - 0.85) < 0.02 and np.abs(model.chance - chance).max() < 0.04
    share = chance * np.array([0.15, 0.85])[:, None]
    right = np.where(sides > 0, share[1], share[0]) / share.sum(axis=0)
    assert np.abs(model.accuracy() - right).max() < 0.05
    kept = model.posterior(patterns)[at] >= 0.5
    silent = (patterns[at] & 0b1111) == 0  # what all-must-pass would keep
    assert (kept == good).mean() > 0.95 and (kept == good).mean() > (silent == good).mean() + 0.05


def test_a_rule_that_misleads_counts_for_nothing():
    chance = np.array([[0.7, 0.6, 0.5, 0.05], [0.02, 0.02, 0.02, 0.3]])
    good, patterns, at, counts = _votes(20_000, 0.7, chance)
    model = quality_rules.estimate(patterns, counts, np.array([-1, -1, -1, -1]))
    assert abs(model.chance[0, 3] - model.chance[1, 3]) < 1e-12
    assert ((model.posterior(patterns)[at] >= 0.5) == good).mean() > 0.93


def test_verdicts_agree_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    judged = quality_rules.judged(spark.read.parquet(f"{folder}/documents.parquet")).where("NOT base_failed")
    rows = judged.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").select("kept", "quality").collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.1 * len(bad)
