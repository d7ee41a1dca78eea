"""Token ids on disk: frequency-ranked, byte-aligned, with separate control bytes.

A text is encoded with a public tokenizer and closed with an end id. Ids are replaced by their rank in
the whole corpus (most frequent first), and a rank takes 1 to 4 bytes: the length less one stands in two
bits of a control byte (four ids each, first in the low bits), the bytes follow one another in ``data``,
low byte first. Reading looks the four lengths of a control byte up in a table.

Files: ``ranks`` (id, count, rank) and ``documents`` (row, doc_id, n_tokens, control, data), Parquet in the shared folder
in ascending doc_id order; ``row`` grows through all files, its upper bits are the number of the file.
Parquet holds the bytes, so any store that Spark writes to will do and a lost task is just run again.

The tokenizer sees each different word of a task once: the library drops white space and never
joins pieces across it, so a text's ids are those of its words. ASCII letters are lower-cased before, as the
library does, and signs at the end of a word are words of their own. Words of letters only are
encoded many at a time and cut after each end-of-word token. Texts for which this might not hold go to the library whole.

Null texts count as empty: they have the end id only. Null ids come first. Repeated rows keep a place
each. Long texts are cut at white space into pieces of bounded size before they are split into words. An empty table gives empty files and no rows.
"""

from __future__ import annotations

import functools
import itertools
import re
import sys
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivulet.llm.registry import query, table
from rivulet.session import fresh_path, materialize

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: Bytes of text that are split into words at a time, and words that a task remembers.
SLICE_BYTES = 1 << 23
REMEMBERED = 800_000
LETTER_WORDS = 256



@functools.cache
def as_a_whole() -> str:
    """The pattern of texts that go to the tokenizer whole: separators that only some libraries take for white space, combining
    marks, the start of a special token, and letters that are no letter alone any more when composed and lower-cased, so that a sign
    behind them may not be split off."""
    letters = (c for c in map(chr, range(0x80, sys.maxunicode + 1)) if c.isalpha())
    split = [c for c in letters if not unicodedata.normalize("NFC", unicodedata.normalize("NFC", c).lower()).isalpha()]
    return "[\\x1c-\\x1f\\x{300}-\\x{36f}" + "".join(f"\\x{{{ord(c):x}}}" for c in split) + r"]|<\|"


#: Signs but the apostrophe, at the end of a word: to the tokenizer a piece of their own.
_TAIL = r"(\pL)([!-&(-/:-@\[-`{-~]+)(\s|$)"


class WordCodes:
    """The ids of words, each encoded once while it is remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # lower-case ASCII letters need none of the tokenizer's normalising and one piece per word
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False, trim_offsets=False)]
        )
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.flat = np.empty(0, self.kind)
        self.ends_at = np.zeros(1, np.int32)

    def _encode(self, texts: list[str], tokenizer=None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has."""
        ids = [e.ids for e in (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(itertools.chain.from_iterable(ids), self.kind), np.fromiter(map(len, ids), np.int64, len(ids))

    def _remember(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        self.number.update(zip(words, range(len(self.number), len(self.number) + len(words))))
        self.ends_at = np.concatenate((self.ends_at, (self.ends_at[-1] + np.cumsum(lengths)).astype(np.int32)))
        self.flat = np.concatenate((self.flat, ids))

    def _learn_letters(self, words: list[str], tokenizer) -> None:
        """Words of letters only, many in one text, cut after each end-of-word token; one by one if that does not add up."""
        groups = [words[i : i + LETTER_WORDS] for i in range(0, len(words), LETTER_WORDS)]
        ids, lengths = self._encode([" ".join(g) for g in groups], tokenizer)
        word_ends = np.flatnonzero(self.ends[ids]) + 1
        found = np.diff(np.searchsorted(word_ends, np.concatenate(([0], np.cumsum(lengths))), side="right"))
        if len(word_ends) == len(words) and (found == [len(g) for g in groups]).all():
            self._remember(words, ids, np.diff(np.concatenate(([0], word_ends))))
        else:
            self._remember(words, *self._encode(words))

    def codes(self, words: list[str]) -> np.ndarray:
        """The numbers of these different words."""
        new = [w for w in words if w not in self.number]
        if len(self.number) + len(new) > REMEMBERED:
            self.forget()
            new = words
        ascii_letters, letters, others = [], [], []
        for word in new:
            (others if not word.isalpha() else ascii_letters if word.isascii() and word.islower() else letters).append(word)
        self._learn_letters(ascii_letters, self.plain)
        self._learn_letters(letters, self.tokenizer)
        self._remember(others, *self._encode(others))
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has; null counts as empty."""
        texts = pc.fill_null(texts, "")
        whole = pc.match_substring_regex(texts, as_a_whole()).to_numpy(zero_copy_only=False)
        if whole.any():
            own = [self._encode([t])[0] if w else self.encode(pa.array([t], texts.type))[0] for t, w in zip(texts.to_pylist(), whole)]
            return np.concatenate(own), np.array([len(i) for i in own], np.int64)
        split = pc.utf8_split_whitespace(pc.replace_substring_regex(pc.ascii_lower(texts), _TAIL, r"\1 \2\3"))
        words = split.flatten().dictionary_encode()
        code = self.codes(words.dictionary.to_pylist())[words.indices.to_numpy()]
        first = self.ends_at[code]
        lengths = self.ends_at[code + 1] - first
        # a slice has far fewer ids than 2^31
        upto = np.concatenate((np.zeros(1, np.int32), np.cumsum(lengths, dtype=np.int32)))
        at = np.repeat(first - upto[:-1], lengths)
        at += np.arange(len(at), dtype=np.int32)
        per_text = np.concatenate(([0], np.cumsum(pc.list_value_length(split).to_numpy())))
        return self.flat[at], np.diff(upto[per_text])


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[pa.Array, int]]:
    """Runs of texts of about ``size`` bytes; a longer text alone, in pieces cut at white space. How many texts end with each."""
    at, held = 0, 0
    for k, n in enumerate(pc.binary_length(pc.fill_null(texts, "")).to_pylist()):
        if k > at and held + n > size:
            yield texts[at:k], k - at
            at, held = k, 0
        held += n
        if n > size:
            parts = list(pieces(texts[k].as_py(), size))
            for part in parts[:-1]:
                yield pa.array([part], texts.type), 0
            yield pa.array(parts[-1:], texts.type), 1
            at, held = k + 1, 0
    if at < len(texts):
        yield texts[at:], len(texts) - at


def pieces(text: str, size: int) -> Iterator[str]:
    """``text`` cut at white space into pieces of about ``size`` characters; a longer word stays whole."""
    at, space = 0, re.compile("[ \t\n\r\x0b\x0c]")
    while at < len(text):
        cut = space.search(text, at + size)
        end = cut.end() if cut else len(text)
        yield text[at:end]
        at = end


@functools.lru_cache(maxsize=2)
def word_codes(path: str) -> WordCodes:
    return WordCodes(path)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# ---- the format


_LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    ranks = ranks.astype(np.uint32)
    extra = (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = extra
    control = codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)
    used = np.arange(4, dtype=np.uint8) <= extra[:, None]
    return control.sum(axis=1, dtype=np.uint8).tobytes(), ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of ``pack``."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    ends = np.cumsum(lengths, dtype=np.int64)
    starts = ends - lengths
    padded = np.zeros(len(data) + 3, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    out = padded[starts].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.nonzero(lengths > k)[0]
        if not len(longer):
            break
        out[longer] |= padded[starts[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


# ---- the jobs


def token_ids(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """doc_id and ``ids`` (little-endian, two bytes each where the largest fits, else four) per row."""

    @F.arrow_udf("n_tokens long, ids binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codes = word_codes(tokenizer_path(tokenizer))
        for texts in batches:
            flat, counts, carried = [], [], 0
            for part, done in slices(texts.cast(pa.string())):
                ids, lengths = codes.encode(part)
                if not done:
                    flat.append(ids)
                    carried += len(ids)
                    continue
                lengths[0] += carried
                carried = 0
                flat.append(ids)
                counts.append(lengths)
            lengths = np.concatenate(counts) if counts else np.empty(0, np.int64)
            ids = np.concatenate(flat) if flat else np.empty(0, codes.kind)
            # the end id goes behind each text's ids
            ids = np.insert(ids, np.cumsum(lengths), end_id).astype(codes.kind)
            borders = np.concatenate(([0], np.cumsum(lengths + 1)))
            offsets = pa.py_buffer((borders * codes.kind.itemsize).astype(np.int32).tobytes())
            packed = pa.Array.from_buffers(pa.binary(), len(lengths), [None, offsets, pa.py_buffer(ids.tobytes())])
            yield pa.StructArray.from_arrays([pa.array(lengths + 1), packed], ["n_tokens", "ids"])

    return docs.select("doc_id", encode("text").alias("encoded")).select("doc_id", "encoded.*")


def _numbers(n: int, ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4")


def id_ranks(encoded: DataFrame) -> DataFrame:
    """id, count, rank (0 for the most frequent; ties by id): one row per id in use, so at most the vocabulary."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for n, ids in zip(batch["n_tokens"], batch["ids"]):
                here = np.bincount(_numbers(n, ids))
                if len(here) > len(total):
                    total = np.concatenate((total, np.zeros(len(here) - len(total), np.int64)))
                total[: len(here)] += here
        used = np.nonzero(total)[0]
        yield pd.DataFrame({"id": used, "count": total[used]})

    counts = encoded.select("n_tokens", "ids").mapInPandas(count, "id long, count long").groupBy("id").agg(F.sum("count").alias("count"))
    return counts.withColumn("rank", F.row_number().over(Window.orderBy(F.col("count").desc(), "id")) - 1)


def write_token_files(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> None:
    """Write the files of ``docs`` below ``path``; runs jobs."""
    spark = docs.sparkSession
    encoded_at = fresh_path(spark, "ids")
    token_ids(docs, tokenizer, end_id).write.option("compression", "zstd").parquet(encoded_at)
    encoded = spark.read.parquet(encoded_at)
    id_ranks(encoded).coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = _rank_table(spark, path)[0]

    @F.pandas_udf("control binary, data binary")
    def to_bytes(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for sizes, ids in batches:
            yield pd.DataFrame([pack(rank_of[_numbers(n, i)]) for n, i in zip(sizes, ids)], columns=["control", "data"])

    (
        encoded.repartitionByRange("doc_id", F.xxhash64("ids"))
        .sortWithinPartitions("doc_id", F.xxhash64("ids"))
        .select("doc_id", "n_tokens", to_bytes("n_tokens", "ids").alias("packed"))
        .select("doc_id", "n_tokens", "packed.*")
        .select(F.monotonically_increasing_id().alias("row"), "*")
        .write.option("compression", "zstd")
        .parquet(f"{path}/documents")
    )


def _rank_table(spark: SparkSession, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Rank by id and id by rank; both as long as the vocabulary at most."""
    rows = spark.read.parquet(f"{path}/ranks").select("id", "rank").collect()
    ids = np.array([r["id"] for r in rows], np.int64)
    ranks = np.array([r["rank"] for r in rows], np.int64)
    rank_of = np.zeros(int(ids.max(initial=-1)) + 1, np.uint32)
    rank_of[ids] = ranks
    id_of = np.zeros(len(rows), np.uint32)
    id_of[ranks] = ids
    return rank_of, id_of


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """row, doc_id, n_tokens and ``ids`` (array of long) from the files."""
    return _decoded(spark, path, lambda ids: ids.astype(np.int64), "ids array<long>")


def _decoded(spark: SparkSession, path: str, of, column: str) -> DataFrame:
    id_of = _rank_table(spark, path)[1]

    @F.pandas_udf(f"n_tokens long, {column}")
    def decode(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for sizes, controls, datas in batches:
            ids = [id_of[unpack(c, d, n)] for n, c, d in zip(sizes, controls, datas)]
            yield pd.DataFrame({"n_tokens": [len(i) for i in ids], column.split()[0]: pd.Series([of(i) for i in ids])})

    packed = spark.read.parquet(f"{path}/documents")
    return packed.select("row", "doc_id", decode("n_tokens", "control", "data").alias("decoded")).select("row", "doc_id", "decoded.*")


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids in all rows before), n_tokens, ids_crc32, as read from the files."""
    rows = _decoded(spark, path, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), "ids_crc32 long")
    file_of = F.shiftright("row", 33)
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = (
        spark.read.parquet(f"{path}/documents")
        .groupBy(file_of.alias("file"))
        .agg(F.sum("n_tokens").alias("in_file"))
        .select("file", F.coalesce(F.sum("in_file").over(before), F.lit(0)).alias("first"))
    )
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("file", file_of)
        .withColumn("upto", F.sum("n_tokens").over(inside))
        .join(materialize(files, "files"), "file")
        .select("doc_id", (F.col("first") + F.col("upto") - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32")
    )


@query("op8_token_files")
def token_files_of_documents(spark, sf_dir):
    path = fresh_path(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), path)
    return token_digests(spark, path)
