"""Licences among their relatives, labels and coverage against plain searches, odd texts."""

import difflib

import pytest
from pyspark.sql import functions as F

from vigil.llm import license_scan
from vigil.llm.licenses import FAMILIES, TEMPLATES

FILLER = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua "


def labels(text):
    _, places, spans, _ = license_scan.scanner().scan(text)
    return {s[2] for s in spans}


ALL = [(label, n, text) for label, texts in TEMPLATES.items() for n, text in enumerate(texts)]


@pytest.mark.parametrize("label,number,text", ALL, ids=[f"{x}-{n}" for x, n, _ in ALL])
def test_confusion_table_has_no_wrong_entry(label, number, text):
    """Every template in prose, in lines of code comments, in capitals and with a tenth of its words changed."""
    assert labels(f"{FILLER}{text} {FILLER}") == {label}
    assert labels("\n".join(f"# {line}" for line in text.split("\n"))) == {label}
    assert labels(text.upper()) == {label}
    words = text.split()
    if len(words) > 40:
        telling = set().union(*(w for f in FAMILIES.values() for w in f.values()))
        changed = [w if i % 11 or any(t in w.lower() for t in telling) else "xyzzy" for i, w in enumerate(words)]
        assert labels(" ".join(changed)) == {label}


def test_two_licences_in_one_text():
    for one in ("mit", "agpl", "cc-by-nc-sa", "bsd-3"):
        for two in ("gpl", "cc-by", "apache-2", "isc"):
            assert labels(f"{TEMPLATES[one][-1]} {FILLER} {TEMPLATES[two][-1]}") == {one, two}


def test_wordings_in_use():
    assert labels("Creative Commons Attribution-NonCommercial-NoDerivs 4.0 International License. This work is licensed under a") == set()
    assert labels("This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivs 4.0 International License.") == {"cc-by-nc-nd"}
    assert labels("the library of the faculty endorses noncommercial use of affero software") == set()


def plain_coverage(words, template):
    """Words of the template in runs of six or more that a text has in the same order."""
    blocks = difflib.SequenceMatcher(None, words, template, autojunk=False).get_matching_blocks()
    return sum(b.size for b in blocks if b.size >= license_scan.MIN_MATCH) / len(template)


def test_score_equals_a_plain_search_on_documents(small):
    """Labels and score of documents against plain matching of every template; documents with a licence line and others."""
    templates = [(license_scan.words(t), label) for label, texts in TEMPLATES.items() for t in texts]
    rows = {r.doc_id: r for r in license_scan.scan_licenses(small("documents")).collect()}
    for doc in small("documents").collect():
        words, row = license_scan.words(doc.text or ""), rows[doc.doc_id]
        text = b" ".join(words)
        near = [(t, x) for t, x in templates if any(b" ".join(t[i : i + 6]) in text for i in range(len(t) - 5))]
        covered = [(plain_coverage(words, t), x) for t, x in near]
        assert set(filter(None, row.labels.split(","))) - set(row.base_labels.split(",")) <= {x for c, x in covered if c >= license_scan.MIN_COVER}
        if not row.base_labels:
            assert row.score <= max((c for c, _ in covered), default=0.0) + 1e-9


def test_odd_rows_and_clashing_columns(odd, nothing):
    docs = odd.withColumn("r", F.lit("z")).withColumn("spans", F.lit("z")).withColumn("labels", F.lit("z"))
    rows = license_scan.scan_licenses(docs).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert license_scan.scan_licenses(nothing).count() == 0
