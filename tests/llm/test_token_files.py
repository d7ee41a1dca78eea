"""Token files: the coding, the words' ids against direct encoding, and whole round trips."""

import random
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rivulet.llm import tokenids
from rivulet.session import fresh_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def direct():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenids.tokenizer_path())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_coding_round_trip():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 4, 5, 1000):
        for top in (1, 255, 256, 65_535, 65_536, (1 << 24) - 1, 1 << 24, (1 << 32) - 1):
            numbers = (rng.random(n) ** 3 * (top + 1)).astype(np.uint32)
            numbers[: min(n, 2)] = [top, 0][: min(n, 2)]
            control, data = tokenids.pack(numbers)
            assert len(control) == -(-n // 4)
            assert (tokenids.unpack(control, data, n) == numbers).all()


PARTS = [
    "word", "Word,", "it's", "don't.", "É", "é,", "ß", "ÄÖ", "naïve...", "x'", "'s", "'", "''ll", "12", "3.14", "a1b2", "!!", "***", "a.b", "(so)", "é", "́",
    "\x1c", "a\x1db", "<|endoftext|>", "<|EndOfText|>", "<|", "|>", " ", " ", "　", "日本語", "ﬁ", "Å", "İ", "ſ", "𝄞", "-", "_", "`", "~", "​", "﻿", "ὈΔΥΣΣΕΎΣ", "ǅ",
]


@pytest.mark.parametrize("seed", range(10))
def test_words_give_the_ids_of_the_whole_text(direct, seed):
    rng = random.Random(seed)
    codes = tokenids.WordCodes(tokenids.tokenizer_path())
    for _ in range(60):
        texts = ["".join(rng.choice(PARTS) + rng.choice([" ", "", "\n", "\t ", "\r\n"]) for _ in range(rng.randrange(12))) for _ in range(20)]
        texts[3] = None
        ids, counts = codes.encode(pa.array(texts, pa.string()))
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for text, part in zip(texts, parts):
            assert part.tolist() == direct(text), repr(text)


def test_every_character_beside_a_sign():
    codes = tokenids.WordCodes(tokenids.tokenizer_path())
    every = [c for c in map(chr, range(0x110000)) if unicodedata.category(c) not in ("Cn", "Co", "Cs")]
    for form in ("{0}( ({0} {0}", "a{0}, b"):
        texts = [form.format(c) for c in every]
        whole = [e.ids for e in codes.tokenizer.encode_batch(texts, add_special_tokens=False)]
        for start in range(0, len(texts), 4096):
            part = pa.array(texts[start : start + 4096], pa.string())
            ids, counts = codes.encode(part)
            for k, mine in enumerate(np.split(ids, np.cumsum(counts)[:-1]), start):
                assert mine.tolist() == whole[k], repr(texts[k])


def test_letters_that_end_in_a_mark(direct):
    codes = tokenids.WordCodes(tokenids.tokenizer_path())
    for text in ("İ(", "aİ, b", "İ!!", "क़(", "יִ)"):
        assert codes.encode(pa.array([text]))[0].tolist() == direct(text), text


def test_forgetting_and_slices_change_nothing(direct, monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(PARTS[:20]) + str(rng.randrange(50)) * rng.randrange(2) for _ in range(rng.randrange(300))) for _ in range(30)] + [None, ""]
    monkeypatch.setattr(tokenids, "REMEMBERED", 40)
    codes = tokenids.WordCodes(tokenids.tokenizer_path())
    got, carried = [], np.empty(0, np.uint32)
    for part, done in tokenids.slices(pa.array(texts, pa.string()), 300):
        ids, counts = codes.encode(part)
        if not done:
            carried = np.concatenate((carried, ids))
            continue
        pieces = np.split(ids, np.cumsum(counts)[:-1])
        pieces[0] = np.concatenate((carried, pieces[0]))
        carried = np.empty(0, np.uint32)
        got += [p.tolist() for p in pieces]
    assert got == [direct(t) for t in texts]


def expected(rows, direct):
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*direct(text), 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_of_token_files(spark, direct):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = tokenids.token_files_of_documents(spark, SF).orderBy("doc_id").collect()
    assert list(map(tuple, got)) == expected([(r["doc_id"], r["text"]) for r in docs], direct)


def test_files_of_awkward_rows(spark, awkward, direct):
    path = fresh_path(spark, "tokens")
    tokenids.write_token_files(awkward, path)
    got = tokenids.token_digests(spark, path).collect()
    assert len(got) == awkward.count()
    texts = {}
    for r in awkward.collect():
        texts.setdefault(r["doc_id"], set()).add(tuple([*direct(r["text"]), 2]))
    ends = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == ends
        ends += r["n_tokens"]
        assert any(len(ids) == r["n_tokens"] and zlib.crc32(np.array(ids, "<u4").tobytes()) == r["ids_crc32"] for ids in texts[r["doc_id"]])
    order = [r["doc_id"] if r["doc_id"] is not None else -1 for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order)
    read = tokenids.read_token_files(spark, path)
    assert {tuple(r["ids"]) for r in read.filter("doc_id = 9").collect()} == texts[9]
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()
    assert [r["rank"] for r in ranks] == list(range(len(ranks)))
    assert [r["count"] for r in ranks] == sorted((r["count"] for r in ranks), reverse=True)


def test_files_of_an_empty_table(spark, empty):
    path = fresh_path(spark, "tokens")
    tokenids.write_token_files(empty, path)
    assert tokenids.token_digests(spark, path).count() == 0


def test_coded_size_is_below_two_bytes_an_id(spark):
    path = fresh_path(spark, "tokens")
    tokenids.write_token_files(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), path)
    files = spark.read.parquet(f"{path}/documents")
    sizes = files.agg(F.sum(F.octet_length("data") + F.octet_length("control")).alias("bytes"), F.sum("n_tokens").alias("n")).first()
    assert sizes["bytes"] < 2 * sizes["n"]
