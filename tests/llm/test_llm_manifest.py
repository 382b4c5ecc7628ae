"""Merkle manifest against a plain tree, with blocks of every size, odd rows, an empty table and tampered rows."""

import hashlib
import zlib

import pytest
from conftest import ODD
from pyspark.sql import functions as F

from vigil.llm import manifest

SHA = lambda s: hashlib.sha256(s.encode()).hexdigest()


def _leaf(values):
    return SHA("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _tree(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([SHA("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def _path(levels, at):
    found = []
    for level in levels[:-1]:
        run = at // 3 * 3
        found.append(("".join(level[run:at]), "".join(level[at + 1 : run + 3])))
        at //= 3
    return found


def plain_manifest(rows):
    """Rows of (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for doc_id, source, lang, size, text in rows:
        later = text
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
            later = text.replace("\n", "")
        entry = (doc_id is not None, doc_id or 0, _leaf((doc_id, source, lang, size, text)), _leaf((doc_id, source, lang, size, later)))
        groups.setdefault(source, []).append(entry)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: _tree([e[2] for e in sorted(groups[s])]) for s in order}
    top = _tree([trees[s][-1][0] for s in order])
    found = []
    for number, source in enumerate(order):
        for at, (has_id, doc_id, leaf, later) in enumerate(sorted(groups[source])):
            path, node = _path(trees[source], at) + _path(top, number), later
            for before, after in path:
                node = SHA(before + node + after)
            proof = SHA("".join(b + a for b, a in path))
            found.append((doc_id if has_id else None, leaf, trees[source][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(found, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
ODD_ROWS = [(i, [None, "", "é", "z", "Z"][n % 5], "fr" if n % 3 else None, n if n % 2 else None, t and t + "\nend") for n, (i, t) in enumerate(ODD)]
SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"


def _input(docs):
    return [tuple(r) for r in docs.select(*manifest.FIELDS).collect()]


@pytest.mark.parametrize("steps", [1, 2, 5])
def test_equals_plain_tree(small, plain, monkeypatch, steps):
    monkeypatch.setattr(manifest, "STEPS", steps)
    monkeypatch.setattr(manifest, "BLOCK", manifest.FAN**steps)
    docs = small("documents")
    found = plain(manifest.verified(docs), *COLUMNS)
    assert found == plain_manifest(_input(docs))
    assert {r[-1] for r in found} == {True, False}


def test_one_source_with_most_rows_and_many_with_one(spark, plain):
    rows = [(n, "hot", "en", 1, f"a\nb {n}") for n in range(900)] + [(n, f"s{n}", "en", 1, "x") for n in range(900, 1300)]
    assert plain(manifest.verified(spark.createDataFrame(rows, SCHEMA).repartition(7)), *COLUMNS) == plain_manifest(rows)


def test_equal_rows_are_spread(spark, plain, monkeypatch):
    rows = [(7, "hot", "en", 1, "the same row")] * 2_000 + [(n, "hot", "en", 1, f"x{n}") for n in range(200)]
    docs, seen, stored = spark.createDataFrame(rows, SCHEMA).repartition(4), [], manifest.stored
    monkeypatch.setattr(manifest, "stored", lambda frame, purpose: seen.append((purpose, stored(frame, purpose))) or seen[-1][1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = plain(manifest.verified(docs), *COLUMNS)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == plain_manifest(rows)
    ranged = next(frame for purpose, frame in seen if purpose == "ranged" and frame.count() == len(rows))
    sizes = [r["count"] for r in ranged.groupBy(F.expr("number >> 33").alias("part")).count().collect()]
    assert max(sizes) < 0.6 * len(rows)


def test_odd_rows_and_clashing_columns(spark, plain):
    docs = spark.createDataFrame(ODD_ROWS, SCHEMA).repartition(3)
    for name in ("lot", "place", "hash", "path", "block", "n", "part", "root", "seen"):
        docs = docs.withColumn(name, F.lit(3))
    assert plain(manifest.verified(docs), *COLUMNS) == plain_manifest(ODD_ROWS)


@pytest.mark.parametrize("number", [1, 2, 3, 4])
def test_few_leaves(spark, plain, number):
    rows = [(n, "a", None, n, f"{n}\n") for n in range(number)]
    assert plain(manifest.verified(spark.createDataFrame(rows, SCHEMA)), *COLUMNS) == plain_manifest(rows)


def test_empty_table(spark):
    assert manifest.verified(spark.createDataFrame([], SCHEMA)).collect() == []


def test_any_change_of_a_field_is_found(spark, plain):
    rows = [(n, "ab"[n % 2], "en", n, f"text {n}") for n in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    changed = lambda text: F.when(F.col("doc_id") == 7, F.concat(text, F.lit(" "))).otherwise(text)
    assert [r for r, ok in plain(manifest.verified(docs, changed), "doc_id", "verified") if not ok] == [7]
    untouched = manifest.manifest(manifest.document_leaves(docs))
    assert untouched.where(manifest.fold(F.col("hash"), F.col("path")) != F.col("root")).count() == 0
