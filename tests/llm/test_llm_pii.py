"""Loose spans of personal data: labels, precision and recall on planted spans, and the generators against plain ones."""

import random
import re

import pytest
from pyspark.sql import functions as F

from vigil.llm import pii

FILLER = "the of and a in to it is was that he for on are with his they at be this from have or by one had not but what all were".split()
IBANS = ["DE89370400440532013000", "GB82WEST12345698765432", "FR1420041010050500013M02606", "NL91ABNA0417164300", "ES9121000418450200051332"]


def check_digits(text):
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def planted(number, seed):
    """Documents with one span each, real or of the same shape but not personal, and the spans expected."""
    rng, rows, real = random.Random(seed), [], {}
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    word = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    makers = {
        "phone": (lambda: f"{rng.randint(2, 9)}{digits(2)}-{rng.randint(2, 9)}{digits(2)}-{digits(4)}", ["call my phone", "mobile"], ["order number", "version"]),
        "ssn": (lambda: f"{rng.randint(100, 665)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}", ["social security", "her ssn is"], ["invoice", "item"]),
        "iban": (lambda: rng.choice(IBANS), ["bank account", "iban"], None),
        "secret": (lambda: "".join(rng.choices("0123456789abcdef", k=40)), ['token = "', "password: "], None),
        "email": (lambda: f"{word(6)} at {word(7)} dot com", ["write to", "mail"], None),
    }
    for n in range(number):
        kind = rng.choice(list(makers))
        make, yes, no = makers[kind]
        text, truth = make(), rng.random() < 0.6
        lead = rng.choice(yes) if truth else rng.choice(no or ["he said"])
        if not truth and kind == "iban":
            text = f"{text[:2]}{(int(text[2:4]) + 1) % 100:02d}{text[4:]}"
        if not truth and kind == "secret":
            text = word(rng.randint(22, 40))
        if not truth and kind == "email":
            text, lead = f"{word(6)} at {word(7)} dot matrix", "he looked"
        before = " ".join(rng.choices(FILLER, k=rng.randint(5, 20))) + f" {lead}" + ("" if lead.endswith(('"', " ")) else " ")
        after = ('"' if lead.endswith('"') else "") + " " + " ".join(rng.choices(FILLER, k=rng.randint(3, 10)))
        rows.append((n, before + text + after))
        if truth:
            real[n] = f"{kind}:{len(before)}:{len(before) + len(text)}"
    return rows, real


def test_precision_and_recall_on_planted_spans(spark):
    rows, real = planted(3_000, 5)
    found = {r.doc_id: {x for x in r.spans.split(",") if x} for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    kinds = {"phone", "ssn", "iban", "secret", "email"}
    said = {(n, x) for n, spans in found.items() for x in spans if x.partition(":")[0] in kinds}
    true = set(real.items())
    assert len(said & true) >= 0.9 * len(true)
    assert len(said & true) >= 0.9 * len(said)
    for kind in kinds:
        mine = {x for x in true if x[1].startswith(kind)}
        assert len(said & mine) >= 0.8 * len(mine), kind


def test_labels_and_features_share_nothing(spark):
    """A candidate's label changes with its characters, its features don't; its features change with its context."""
    rows = [("iban", IBANS[0], "my iban "), ("iban", "DE88370400440532013000", "my iban "), ("iban", IBANS[0], "so he said "), ("ssn", "123-45-6789", "ssn "), ("ssn", "000-45-6789", "ssn ")]
    frame = spark.createDataFrame([(*r, " ") for r in rows], "kind string, hit string, before string, after string")
    got = frame.select(pii.valid().alias("label"), *[c.alias(n) for n, c in pii.features().items()]).collect()
    assert [r.label for r in got] == [1.0, 0.0, 1.0, 1.0, 0.0]
    assert got[0][1:] == got[1][1:] and got[3][1:] == got[4][1:] and got[0][1:] != got[2][1:]


@pytest.mark.parametrize("text", [*IBANS, "DE88370400440532013000", "GB82 WEST 1234 5698 7654 32", "XX00000000000000"])
def test_check_digits_of_accounts(spark, text):
    frame = spark.createDataFrame([("iban", text, "")], "kind string, hit string, before string")
    assert frame.select(pii.valid().alias("v")).first().v == float(check_digits(text.replace(" ", "")))


def test_loose_spans_are_generator_matches_clear_of_base_spans(small):
    """Every span beyond the base is a match of its kind's generator, and overlaps no base span of its kind."""
    docs = {r.doc_id: r.text or "" for r in small("documents").collect()}
    rows, spans = pii.spans(small("documents"))
    ids = dict(map(tuple, rows.select("row", "doc_id").collect()))
    found = spans.collect()
    base = {(r.row, r.kind, i) for r in found if r.base for i in range(r.start, r.end)}
    for r in found:
        if not r.base:
            text, pattern = docs[ids[r.row]], pii.LOOSE[r.kind].replace("\\z", "\\Z")
            assert (r.start, r.end) in {m.span() for m in re.finditer(pattern, text)}
            assert not any((r.row, r.kind, i) in base for i in range(r.start, r.end))


def test_long_runs_and_empty_tables(spark):
    rows = [(1, "a" * 50_000), (2, "x1" * 30_000 + "="), (3, None), (4, "-" * 40_000), (5, "1 " * 20_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert pii.report(frame).count() == 5 and pii.report(frame.limit(0)).count() == 0
    assert pii.report(frame.withColumn("kind", F.lit(1)).withColumn("row", F.lit(2)).withColumn("spans", F.lit(3))).count() == 5
