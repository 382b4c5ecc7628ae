"""Token ids and decoded texts against the libraries themselves, letter by letter and on random texts."""

import hashlib
import random
import sys
import unicodedata
from array import array

import pytest
import sentencepiece
import tokenizers

from vigil.llm import queries, sentencepiece_bpe, token_files

WORD, PIECE = queries.vocabulary(queries.WORD_BPE), queries.vocabulary(queries.PIECE_BPE)
LETTERS = [chr(i) for i in range(sys.maxunicode + 1) if unicodedata.category(chr(i))[0] == "L"]
LIKELY = "aàÀßSTİıéΣσςфЙقषक़য়ਸ਼ଡ଼가각ﬁｗ日ーǅ .,;:!?'\"-()0１²\n\t ́̇​\x85▁�"


def _ids(encoder, text):
    return list(array(encoder.code, encoder.ids(text)))


def _random_texts(number, seed):
    rng = random.Random(seed)
    for _ in range(number):
        some = rng.choices(LIKELY, k=rng.randint(1, 6)) + rng.choices(LETTERS, k=2)
        yield "".join(rng.choices(some, k=rng.randint(1, 24)))


def test_every_letter_before_every_mark():
    library, encoder = tokenizers.Tokenizer.from_file(WORD), token_files.WordEncoder(WORD)
    texts = [" ".join(f"{x}{m} a{x}{m}" for m in token_files.MARKS) for x in LETTERS]
    wrong = [x for x, t, e in zip(LETTERS, texts, library.encode_batch(texts, add_special_tokens=False), strict=True) if _ids(encoder, t) != e.ids]
    assert wrong == []


def test_letters_that_become_a_letter_and_a_mark():
    library, encoder = tokenizers.Tokenizer.from_file(WORD), token_files.WordEncoder(WORD)
    assert not encoder._marks_apart("İ") and not encoder._marks_apart("क़") and encoder._marks_apart("é")
    for text in ("TAKSİ.", "taksi. TAKSİ, İ!", "क़. य़;"):
        assert _ids(encoder, text) == library.encode(text, add_special_tokens=False).ids


def test_random_texts_equal_the_library():
    library, encoder = tokenizers.Tokenizer.from_file(WORD), token_files.WordEncoder(WORD)
    texts = list(_random_texts(100_000, 11))
    wrong = [t for t, e in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True) if _ids(encoder, t) != e.ids]
    assert wrong == []


def test_rows_of_one_id_spread_over_files(spark):
    rows = [(None if n % 3 else 7, f"row {n % 50} of the same id") for n in range(3_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        folder = token_files.write_tokens(docs, WORD, 2)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [r.n_docs for r in token_files.manifest(spark, folder).collect()]
    assert sum(files) == 3_000 and len(files) > 2 and max(files) < 2_000
    found = token_files.read_documents(spark, folder).orderBy("start").collect()
    assert [r.doc_id for r in found] == sorted((i for i, _ in rows), key=lambda i: i is not None)
    assert found[-1].start + found[-1].n_tokens == sum(r.n_tokens for r in found)


def test_pieces_and_decoded_texts_equal_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    for text in ["", " ", "a  b ", "\x00\n\t", "￿￿", *_random_texts(30_000, 12)]:
        ids, joined, back = sentencepiece_bpe.round_trip(PIECE, text)
        want = library.encode(text)
        assert ids == want and joined == ",".join(map(str, want)) and back == library.decode(want)


def test_long_words_equal_the_library():
    library, coder = sentencepiece.SentencePieceProcessor(model_file=PIECE), sentencepiece_bpe.codec(PIECE)
    rng = random.Random(13)
    for letters in ("ab", "aeiou", "thein", "ー日a", "█é"):
        text = "".join(rng.choices(letters, k=3_000))
        assert coder.encode(text) == library.encode(text) and coder.decode(coder.encode(text)) == text


@pytest.mark.parametrize("fault", ["x", ""])
def test_the_round_trip_depends_on_decoding(monkeypatch, fault):
    decode = sentencepiece_bpe.Codec.decode
    monkeypatch.setattr(sentencepiece_bpe.Codec, "decode", lambda self, ids: decode(self, ids[:-1]) + fault)
    text = "the decoded text comes from ids"
    assert hashlib.sha256(sentencepiece_bpe.round_trip(PIECE, text)[2].encode()).digest() != hashlib.sha256(text.encode()).digest()


def test_bytes_in_any_order_decode_like_the_library():
    library, coder = sentencepiece.SentencePieceProcessor(model_file=PIECE), sentencepiece_bpe.codec(PIECE)
    rng = random.Random(14)
    for _ in range(5_000):
        ids = [rng.choice([rng.randint(3, 258), rng.randint(259, 31_999), rng.choice(list(coder.bytes.values()))]) for _ in range(rng.randint(0, 9))]
        assert coder.decode(ids) == library.decode(ids)
