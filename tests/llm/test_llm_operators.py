"""Operators against brute force, on the smallest data and on odd rows; empty tables; their formats."""

import zlib

import brute
import numpy as np
import pytest
from conftest import ODD, PASSAGE
from pyspark.sql import functions as F

from vigil.llm import components, decontaminate, exact_dedup, langid, license_scan, pii, queries, sentencepiece_bpe, simhash, suffix_dedup, token_files, warc

WORD, PIECE = queries.vocabulary(queries.WORD_BPE), queries.vocabulary(queries.PIECE_BPE)


def fingerprints(docs):
    return simhash.near_duplicates(docs).withColumn("fingerprint", F.lpad(F.lower(F.hex("fp")), 16, "0"))


CASES = {
    "tokens": (lambda d: token_files.token_documents(d, WORD, 2), ["doc_id", "start", "n_tokens", "ids_crc32"], brute.token_files),
    "simhash": (fingerprints, ["doc_id", "fingerprint", "component_id"], brute.simhash),
    "pieces": (lambda d: sentencepiece_bpe.digests(d, PIECE), ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"], brute.sentencepiece_ids),
    "licenses": (license_scan.scan_licenses, ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"], brute.licenses),
    "personal": (pii.report, ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"], brute.personal),
    "suffix": (suffix_dedup.without_later_copies, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], brute.later_copies),
}


@pytest.mark.parametrize("name", CASES)
def test_equals_brute_force(small, plain, name):
    operator, columns, check = CASES[name]
    docs = small("documents")
    assert plain(operator(docs), *columns) == sorted(check([(r.doc_id, r.text) for r in docs.collect()]), key=str)


@pytest.mark.parametrize("name", CASES)
def test_odd_rows(odd, plain, name):
    operator, columns, check = CASES[name]
    assert plain(operator(odd), *columns) == sorted(check(ODD), key=str)


@pytest.mark.parametrize("name", CASES)
def test_empty_table(nothing, name):
    operator, columns, _ = CASES[name]
    assert operator(nothing).select(*columns).collect() == []


# Exact copies


def test_exact_groups_on_odd_rows(odd):
    found = exact_dedup.exact_groups(odd, keep="largest").collect()
    assert len(found) == len(ODD)
    by_text = {}
    for doc_id, text in ODD:
        by_text.setdefault(text or "", []).append(doc_id)
    sizes = sorted(r.group_size for r in found)
    assert sizes == sorted(len(by_text[t or ""]) for _, t in ODD)
    assert sum(r.kept for r in found) == len(by_text)
    for row in found:
        assert not row.kept or row.doc_id == row.keep_id
    assert {r.keep_id for r in found if r.doc_id in (9, 11)} == {11}
    assert {r.keep_id for r in found if r.doc_id in (2, 3)} == {3}


def test_without_copies_keeps_columns_and_one_row_of_each_text(odd, nothing):
    kept = exact_dedup.without_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(t or "" for t in (r.text for r in kept.collect())) == sorted({t or "" for _, t in ODD})
    assert exact_dedup.without_copies(nothing).count() == 0


def test_exact_groups_smallest(odd):
    assert {r.keep_id for r in exact_dedup.exact_groups(odd, keep="smallest").where("doc_id IN (9, 11)").collect()} == {9}


def test_exact_dedup_plan_is_native(odd):
    text = exact_dedup.exact_groups(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Pandas" not in text and "Cartesian" not in text


# SimHash


def test_golay_decodes_every_word_within_three_bits():
    index = simhash.golay_indices()
    words = np.arange(0, 1 << 23, 4099, dtype=np.uint32)
    codes = index[words].astype(np.uint32) << np.uint32(11)
    codes |= simhash._remainder(codes.copy())
    assert max(int(x).bit_count() for x in words ^ codes) <= 3
    counts = np.bincount(index, minlength=1 << 12)
    assert (counts == 1 << 11).all()


def test_keys_meet_for_every_pair_within_two_bits():
    rng = np.random.default_rng(5)
    prints = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    for flips in range(3):
        others = prints.copy()
        for i in range(len(others)):
            for b in rng.choice(64, flips, replace=False):
                others[i] ^= np.uint64(1) << np.uint64(b)
        a, b = (set(zip(*(x.tolist() for x in simhash.search_keys(p)), strict=True)) for p in (prints, others))
        assert {i for i, _ in a & b} == set(range(300))


def test_crowded_keys_link_like_pairs(spark, monkeypatch):
    rng = np.random.default_rng(6)
    centre = int(rng.integers(0, 1 << 62))
    prints = sorted({centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (150, 2))} | {int(x) for x in rng.integers(0, 1 << 62, 50)})
    signed = [p - (1 << 64) if p >= 1 << 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    roots = {}
    for size in (2, 10_000):
        monkeypatch.setattr(simhash, "BUCKET", size)
        roots[size] = sorted(map(tuple, components.components(simhash.links(frame)).collect()))
    assert roots[2] == roots[10_000] and len(roots[2]) > 100


def test_one_of_each_keeps_columns(odd, nothing):
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    expected = {c for _, _, c in brute.simhash(ODD)}
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, expected))
    assert simhash.one_of_each(nothing).count() == 0


def test_rows_that_share_an_id_or_have_none_are_not_lost(spark):
    rows = [(5, "alpha beta gamma delta"), (5, "one two three four five six"), (None, "red green blue"), (None, "cat dog bird"), (None, "cat dog bird")]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.text for r in kept.collect()) == sorted({t for _, t in rows})


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 200)] + [(5, i) for i in range(300, 400)] + [(7, 7)]
    found = dict(map(tuple, components.components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert {found[i] for i in range(100, 201)} == {100} and {found[i] for i in (5, *range(300, 400))} == {5}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


# Token files


def test_lists_are_equal_and_views(odd, tmp_path):
    folder = token_files.write_tokens(odd, WORD, 2, folder=str(tmp_path / "t"), length=16, lists=4)
    files = odd.sparkSession.read.parquet(f"{folder}/manifest").collect()
    total = 0
    for row in files:
        file = token_files.TokenFile(row.tokens)
        lists = [file[k] for k in range(len(file))]
        assert all(len(ids) == len(mask) == 16 for ids, mask in lists)
        assert all(not ids.flags.owndata for ids, _ in lists)
        assert sum(mask.true_count for _, mask in lists) == row.n_tokens
        assert all(mask.false_count == 0 for _, mask in lists[:-1])
        total += row.n_docs
    assert total == len(ODD)


def test_every_task_reads_its_own_file(odd, tmp_path):
    folder = token_files.write_tokens(odd, WORD, 2, folder=str(tmp_path / "t"), length=8, lists=2)
    found = {(r.doc_id, r.start): r.ids_crc32 for r in token_files.read_documents(odd.sparkSession, folder).collect()}
    assert found == {(d, s): c for d, s, _, c in brute.token_files(ODD)}


# SentencePiece


def test_decodes_any_ids():
    library = sentencepiece_bpe.codec(PIECE).probe
    rng = np.random.default_rng(7)
    for _ in range(500):
        ids = [int(x) for x in rng.choice([*rng.integers(3, 259, 4), *rng.integers(1, 32_000, 6)], rng.integers(0, 12))]
        assert sentencepiece_bpe.codec(PIECE).decode(ids) == library.decode(ids)


def test_encodes_random_texts_like_the_library():
    library = sentencepiece_bpe.codec(PIECE).probe
    rng = np.random.default_rng(8)
    letters = list("aábcdeéfghijklmnñopqrstuvwxyzABC  \n.,-0123日▁<>/s")
    for _ in range(400):
        text = "".join(rng.choice(letters, rng.integers(1, 80)))
        assert sentencepiece_bpe.codec(PIECE).encode(text) == library.encode(text)


def test_columns_of_ids_and_texts(odd):
    rows = odd.where("text IS NOT NULL").select("text", sentencepiece_bpe.encoded(PIECE, odd["text"]).alias("ids"))
    for row in rows.select("text", sentencepiece_bpe.decoded(PIECE, rows["ids"]).alias("back")).collect():
        assert row.back == row.text.replace("▁", " ")


# Languages


def test_language_of_held_out_documents(small):
    docs = small("documents")
    found = langid.identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) > 20
    assert sum(r.lang_pred == r.lang for r in found) >= 0.97 * len(found)
    for row in langid.identify(docs).select("doc_id", "held_out").collect():
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)


def test_language_equals_plain_bayes(small):
    docs = small("documents")
    train = [(r.text, r.lang) for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 != 0 and r.lang]
    languages = sorted({x for _, x in train})
    counts = np.zeros((len(languages), langid.BUCKETS + 1))
    for text, lang in train:
        for buckets, _, _ in langid._hashed([text]):
            counts[languages.index(lang)] += np.bincount(buckets, minlength=langid.BUCKETS + 1)
    grams = counts[:, : langid.BUCKETS]
    logs = np.log((grams + 1) / (grams.sum(axis=1, keepdims=True) + langid.BUCKETS))
    prior = np.log([sum(x == lang for _, x in train) / len(train) for lang in languages])
    for row in langid.identify(docs).join(docs.select("doc_id", "text"), "doc_id").collect():
        score = prior.copy()
        for buckets, _, _ in langid._hashed([row.text]):
            score += logs[:, buckets[buckets < langid.BUCKETS]].sum(axis=1)
        assert row.lang_pred == languages[int(score.argmax())] or not langid.has_letter(row.text)
        assert 0 <= row.score <= 1


def test_grams_of_long_texts_are_all_counted(monkeypatch):
    text = "abc def ghi " * 40
    whole = sum(np.bincount(b, minlength=langid.BUCKETS + 1) for b, _, _ in langid._hashed([text]))
    monkeypatch.setattr(langid, "BLOCK", 7)
    pieces = sum(np.bincount(b, minlength=langid.BUCKETS + 1) for b, _, _ in langid._hashed([text]))
    assert (whole[: langid.BUCKETS] == pieces[: langid.BUCKETS]).all()


def test_language_of_odd_rows(odd, nothing):
    found = {r.doc_id: r for r in langid.identify(odd).where("doc_id IS NOT NULL").collect()}
    for doc_id, text in ODD:
        if doc_id is not None and not any(map(str.isalpha, text or "")):
            assert (found[doc_id].lang_pred, found[doc_id].score) == ("und", 0.0)
    assert found[6].lang_pred in ("fr", "en")
    assert langid.identify(nothing).count() == 0
    assert {r.lang_pred for r in langid.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


# Licences


def test_templates_are_found_whole_and_in_parts():
    scanner = license_scan.scanner()
    for label, texts in license_scan.TEMPLATES.items():
        for text in texts:
            n, places, spans, best = scanner.scan(f"some words before. {text} and some words behind")
            assert best == 1.0 and label in {s[2] for s in spans} | {x for _, x in places}, label
    words = license_scan.TEMPLATES["mit"][0].split()
    changed = " ".join(w if i % 12 else "xyzzy" for i, w in enumerate(words))
    _, _, spans, best = scanner.scan(changed)
    assert [s[2] for s in spans] == ["mit"] and 0.7 < best < 1
    assert scanner.scan(" ".join(words[:20]))[2] == []
    assert scanner.scan("the rights to use and the public domain of any kind")[2:] == ([], 0.0)


def test_blocks_carry_the_state(monkeypatch):
    text = "aa bb " * 9 + license_scan.TEMPLATES["isc"][0] + " under the mit license zz" * 3
    whole = license_scan.scanner().scan(text)
    for size in (11, 37, 64):
        monkeypatch.setattr(license_scan, "BLOCK", size)
        assert license_scan.scanner().scan(text) == whole


# Personal data


def test_loose_candidates_become_spans_with_their_context(spark):
    rows = []
    for i in range(400):
        number = f"{200 + i % 700}-555-{1000 + i * 7 % 9000}"
        rows.append((i, f"call my phone {number} today" if i % 2 else f"order number {number} today"))
        rows.append((1000 + i, f"pay 4111 1111 1111 {1111 + i} now"))
    found = {r.doc_id: r.spans for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    called = [found[i] for i in range(400) if i % 2]
    ordered = [found[i] for i in range(400) if not i % 2]
    assert sum("phone:14:26" in s for s in called) > 180 and sum("phone" in s for s in ordered) < 20


def test_rare_loose_candidates_are_judged_among_many_base_ones(spark):
    rows = [(i, " ".join(f"a{i}.{j}@example{j}.org" for j in range(20)) + f" in {1900 + i % 100} and {i} others") for i in range(600)]
    for i in range(60):
        rows.append((1000 + i, f"my social security {100 + i}-45-{6000 + i}"))
        rows.append((2000 + i, f"order item {100 + i}-45-{7000 + i}"))
        rows.append((3000 + i, f"call my phone {200 + i}-555-{1000 + i}"))
    found = {r.doc_id: r.spans for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all("ssn:19:30" in found[1000 + i] and "phone:14:26" in found[3000 + i] for i in range(60))
    assert not any("ssn" in found[2000 + i] for i in range(60))


def test_base_spans_are_in_spans(small):
    docs = {r.doc_id: r.text for r in small("documents").collect()}
    base = {r[0]: sum(r[1:5]) for r in brute.personal(docs.items())}
    for row in pii.report(small("documents")).collect():
        assert len([x for x in row.spans.split(",") if x]) >= base[row.doc_id]


def test_personal_data_plan_is_native(small):
    text = pii.report(small("documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Pandas" not in text and "Cartesian" not in text


# Suffixes


def test_frequent_anchors_are_split_without_a_change(odd, plain, monkeypatch):
    columns = CASES["suffix"][1]
    monkeypatch.setattr(suffix_dedup, "FREQUENT", 0)
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", 20_000)
    assert plain(suffix_dedup.without_later_copies(odd), *columns) == sorted(brute.later_copies(ODD), key=str)


def test_previous_factors_are_the_smallest_owner_of_equal_windows():
    rng = np.random.default_rng(9)
    windows = np.array([bytes(x) for x in rng.integers(97, 100, (500, 5), dtype=np.uint8)], dtype=f"S{suffix_dedup.WINDOW}")
    owners = rng.integers(0, 50, 500)
    found = suffix_dedup.previous_factors(windows, owners)
    assert found.tolist() == [min(o for w, o in zip(windows, owners, strict=True) if w == x) for x in windows]


def test_kept_bytes(odd):
    kept = {r.doc_id: bytes(r.kept) for r in suffix_dedup.without_later_copies(odd, with_text=True).where("doc_id IN (9, 10)").collect()}
    assert kept[9].decode() == f"{PASSAGE}. first" and kept[10] == b"second "


# WARC


@pytest.fixture(scope="module")
def pages(spark, small):
    inner = warc.record(77, "http://inside", b"<p>inside</p>" * 20, "0" * 64, None).decode()
    odd_pages = [(900 + i, f"http://odd/{i}\r\n", t) for i, (_, t) in enumerate(ODD)]
    odd_pages += [(5000, None, inner * 4), (5001, "u", inner * 4), (None, "u", "n" * 200), (4999, "u", "n" * 200), (5002, "u", "n" * 200), (6000, "u", "s" * 50), (6001, "u", "s" * 50)]
    frame = spark.createDataFrame(odd_pages, "page_id long, url string, html string")
    return small("pages").select("page_id", "url", "html").union(frame).repartition(3)


@pytest.mark.parametrize("compress", [True, False])
def test_archives_equal_brute_force(spark, pages, plain, tmp_path, compress):
    folder = warc.write_archives(pages, str(tmp_path / "w"), compress=compress, file_bytes=60_000)
    found = warc.read_archives(spark, folder, split=5_000)
    want = brute.archives([(r.page_id, r.html) for r in pages.collect()])
    assert plain(found, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(want, key=str)


def test_candidates_inside_payloads_are_rejected(spark, pages, tmp_path):
    import pandas as pd

    folder = warc.write_archives(pages, str(tmp_path / "w"), compress=False)
    files = spark.read.parquet(f"{folder}/manifest").collect()
    batch = pd.DataFrame([(f.file, 0, 0, f.length) for f in files], columns=["file", "split", "start", "end"])
    # A payload whose inner records carry a right digest is a candidate like any other.
    assert sum(map(len, warc._candidates(iter([batch])))) >= pages.count()


def test_no_pages(spark, pages):
    assert warc.archive(pages.limit(0)).count() == 0


# Decontamination


def test_leaks_against_brute_force(small):
    docs, items = small("documents"), small("benchmark")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    want = brute.leaks([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert len(found & want) >= 0.9 * len(want) and len(want) > 0
    assert len(found - want) <= 0.1 * len(found)


def test_paraphrases_are_found_and_others_left(spark, small):
    items = small("benchmark").orderBy("item_id").limit(20).collect()
    rng = np.random.default_rng(10)
    filler = [r.text for r in small("documents").where("lang = 'en'").orderBy("doc_id").limit(20).collect()]
    rows = []
    for i, item in enumerate(items):
        words = item.text.split()
        changed = [w if rng.random() > 0.15 else "replaced" for w in words]
        rows.append((i, f"{filler[i % len(filler)][:400]} {' '.join(changed)} {filler[(i + 1) % len(filler)][:400]}"))
        rows.append((100 + i, filler[i % len(filler)][:1500]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").union(small("documents").selectExpr("doc_id + 1000", "text"))
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, small("benchmark")).where("doc_id < 1000").collect()}
    hit = sum((i, item.item_id) in found for i, item in enumerate(items))
    assert hit >= 0.9 * len(items)


def test_latent_space_is_fitted_on_all_documents_and_items(spark):
    text = lambda kind, i: " ".join(f"{kind}{i}x{j}" for j in range(10))
    docs = spark.createDataFrame([(i, text("doc", i)) for i in range(600)], "doc_id long, text string")
    items = spark.createDataFrame([(i, text("item", i)) for i in range(1_200)], "item_id long, text string")
    codes = decontaminate.coded(docs, items)
    weights, n_words = decontaminate.idf(codes)
    space = decontaminate.latent_space(codes, weights, n_words)
    assert n_words == 18_000
    for kind, n in (("doc", 600), ("item", 1_200)):
        seen = decontaminate.features(decontaminate.cleaned(" ".join(text(kind, i) for i in range(n))))
        assert space[seen].any(axis=1).all()


def test_unicode_spaces_and_marks_part_words(spark, small):
    item = small("benchmark").orderBy("item_id").first()
    parts = ["\u00a0", "\u202f", "\u3000", "\u2028", "\u2022", "\uff0c", " \u00ad"]
    docs = [(i, part.join(item.text.split())) for i, part in enumerate(parts)]
    found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), small("benchmark"))
    assert {r.doc_id for r in found.collect() if r.item_id == item.item_id} == set(range(len(parts)))
    assert decontaminate.words("com\u00adputer na\u00efve e\u0301t\u00e9") == ["computer".encode(), "na\u00efve".encode(), "e\u0301t\u00e9".encode()]


def test_short_items_and_scripts_without_spaces(spark, small):
    chinese = "\u6c34\u7684\u5316\u5b66\u5f0f\u662f\u4ec0\u4e48\u5e76\u4e14\u5b83\u7531\u54ea\u4e9b\u5143\u7d20\u7ec4\u6210"
    thai = "\u0e19\u0e49\u0e33\u0e04\u0e37\u0e2d"
    items = [(1, "What is the capital of Peru?"), (2, "Lima, Peru"), (3, chinese), (4, thai), (5, "?!"), (6, None), (2, "lima peru"), (7, "zebra")]
    rows = [
        (1, "one asks: what is THE capital -- of Peru, and nobody answers"),
        (2, "the capital of Peru is what they ask in Lima; Peru has one"),
        (3, f"\u6211\u4eec{chinese}\u5462\u3002"),
        (4, f"abc{thai}def"),
        (5, "lima in peru, zebras"),
        (6, None),
        (7, "zebra"),
    ]
    want = [(1, 1), (2, 2), (2, 2), (3, 3), (4, 4), (7, 7)]
    others = small("documents").selectExpr("doc_id + 1000", "text")  # enough passages for a latent space
    docs = spark.createDataFrame(rows, "doc_id long, text string").union(others)
    asked = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(docs, asked).where("doc_id < 1000").collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == want
    assert sorted(r.doc_id for r in decontaminate.clean(docs, asked).where("doc_id < 1000").collect()) == [5, 6]


def test_odd_rows_match_nothing(odd, nothing, small):
    assert decontaminate.contaminated(odd, small("benchmark")).count() == 0
    assert decontaminate.contaminated(nothing, small("benchmark")).count() == 0
    clean = decontaminate.clean(odd, small("benchmark").limit(0))
    assert clean.columns == odd.columns and clean.count() == len(ODD)


def test_lcs_places_have_its_length():
    rng = np.random.default_rng(11)
    for _ in range(100):
        a, b = (list(map(str, rng.integers(0, 6, rng.integers(1, 30)))) for _ in range(2))
        places = decontaminate.lcs_places(a, b)
        assert len(places) == decontaminate.lcs_length(a, b) == brute.lcs(a, b)
        common, at = [b[p] for p in places], 0
        for x in a:
            at += at < len(common) and x == common[at]
        assert at == len(common) and places == sorted(set(places))


# Registered queries and the pipeline


def test_registered_queries_equal_sql(spark, small):
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from check import differences, duck

    folder = "/root/testdata/sf0.001"
    connection = duck(folder)
    for name, statement in queries.SQL.items():
        assert differences(queries.QUERIES[name](spark, folder), connection, statement) == []


def test_pipeline_stages(spark, small):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = small("documents")
    columns = docs.columns
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        rows = out.collect()
        if number < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
            assert {r.doc_id for r in rows} <= {r.doc_id for r in docs.collect()}
            docs = spark.createDataFrame(rows, out.schema)
    assert len(rows) == docs.count()
    kept = [(r.doc_id, r.text) for r in docs.collect()]
    prints = [c for _, _, c in brute.simhash(kept)]
    assert len(set(prints)) == len(prints) == len({t for _, t in kept})
    items = [(r.item_id, r.text) for r in small("benchmark").collect()]
    assert not brute.leaks(kept, items)
    want = {d: s for d, _, s, _ in brute.sentencepiece_ids(kept)}
    assert {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, folder).collect()} == want


def test_pipeline_on_odd_rows(spark, odd, nothing):
    import corpus_pipeline

    for docs in (odd, nothing):
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            rows = stage(spark, docs, "/root/testdata/sf0.001")
            out = spark.createDataFrame(rows.collect(), rows.schema)
            docs = out if number < len(corpus_pipeline.STAGES) - 1 else docs
