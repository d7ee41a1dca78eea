"""SentencePiece pieces: the agenda against the library and against a plain search for the best pair, and whole round trips."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rivulet.llm import pieces

SF = "/root/testdata/sf0.001"
PARTS = [
    "word", "Word,", "it's", "É", "ß", "naïve...", "12", "3.14", "!!", "", " ", "  ", "   ", " " * 17, "\n", "\t", "\r\n", "\x00", "▁", "▁▁a",
    "日本語", "𝄞", "🎉", "é", "​", "﻿", "<s>", "</s>", "<unk>", "<0x41>", "aaaaaaaaaaaa", "----------------", " ", "İ", "ﬁ", "=" * 40, "ababab",
]


@pytest.fixture(scope="module")
def codes():
    return pieces.PieceCodes(pieces.model_path())


def expected(codes, text):
    ids = codes.library.encode(text or "")
    return ids, codes.library.decode(ids)


@pytest.mark.parametrize("seed", range(5))
def test_agenda_gives_the_ids_of_the_library(codes, seed):
    rng = random.Random(seed)
    for _ in range(1500):
        text = "".join(rng.choice(PARTS) + rng.choice(["", " ", ""]) for _ in range(rng.randrange(14)))
        assert codes.encode(text) == codes.library.encode(text), repr(text)


def test_every_character_of_the_basic_plane(codes):
    for start in range(0, 0x10000, 256):
        some = [chr(c) for c in range(start, start + 256) if not 0xD800 <= c < 0xE000]
        for text in ("".join(some), " ".join(some), *some[::17]):
            assert codes.encode(text) == codes.library.encode(text)


def plain_merge(word, scores):
    """Merge the best pair, the leftmost of equals, until there is none."""
    symbols = list(word)
    while True:
        pairs = [(scores[a + b], k) for k, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in scores]
        if not pairs:
            return symbols
        k = min(pairs)[1]
        symbols[k : k + 2] = ["".join(symbols[k : k + 2])]


def test_agenda_equals_a_search_for_the_best_pair():
    rng = random.Random(2)
    for _ in range(300):
        scores = {"".join(rng.choice("ab") for _ in range(rng.randrange(2, 5))): float(rng.randrange(4)) for _ in range(8)}
        word = "".join(rng.choice("abc") for _ in range(rng.randrange(12)))
        assert pieces.merged(word, scores) == plain_merge(word, scores)


def test_words_in_one_piece_give_the_same_ids(codes, monkeypatch):
    monkeypatch.setattr(codes, "words", None)
    for text in ("two words", " a  b ", "", "x, y\nz", "▁"):
        assert codes.encode(text) == codes.library.encode(text)
        assert all(agrees for *_, agrees in codes.encode_all([text]))


def test_signs_stand_beside_letters_in_no_piece(codes):
    assert set(".,;:!?()\n") <= set(codes.signs)
    for piece in codes.ids:
        for a, b in zip(piece, piece[1:]):
            assert b != "▁" or a == "▁"
            assert a == "▁" or (a in codes.signs) == (b in codes.signs)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 5)
    monkeypatch.setattr(pieces, "SLICE_CHARS", 10)
    codes = pieces.PieceCodes(pieces.model_path())
    texts = PARTS * 3 + [" ".join(PARTS)]
    assert [ids.tolist() for ids, _, _ in codes.encode_all(texts)] == [codes.library.encode(t) for t in texts]
    assert len(codes.number) < 100


def test_what_differs_from_the_library_is_told():
    codes = pieces.PieceCodes(pieces.model_path())
    del codes.scores["▁word"]
    texts = ["a b", "a word here", "", "word"]
    assert [agrees for *_, agrees in codes.encode_all(texts)] == [True, False, True, False]
    assert [agrees for *_, agrees in codes.encode_all(texts)] == [True, False, True, False]


def test_long_words(codes):
    rng = random.Random(5)
    for text in ("a" * 200_000, "".join(rng.choice("abcdefgh") for _ in range(200_000)), " " * 50_000 + "x"):
        assert codes.encode(text) == codes.library.encode(text)


def digests(codes, text):
    ids, decoded = expected(codes, text)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), True


def test_query_of_pieces(spark, codes):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r[0]: tuple(r[1:]) for r in pieces.pieces_of_documents(spark, SF).collect()}
    assert got == {r["doc_id"]: digests(codes, r["text"]) for r in docs}


def test_pieces_of_awkward_rows(spark, awkward, empty, codes):
    got = pieces.round_trip(awkward).collect()
    assert sorted((str(r["doc_id"]), r["ids"], r["decoded"]) for r in got) == sorted((str(r["doc_id"]), *expected(codes, r["text"])) for r in awkward.collect())
    assert all(r["agrees"] for r in got)
    assert pieces.round_trip(empty).count() == pieces.encode_texts(empty).count() == 0
    assert pieces.decode_ids(pieces.encode_texts(empty)).count() == 0


def test_decoding_alone(spark, awkward):
    whole = pieces.round_trip(awkward)
    apart = pieces.decode_ids(pieces.encode_texts(awkward))
    assert sorted(map(str, whole.select("doc_id", "decoded").collect())) == sorted(map(str, apart.collect()))
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert pieces.decode_ids(none).agg(F.max("decoded")).first()[0] == ""
