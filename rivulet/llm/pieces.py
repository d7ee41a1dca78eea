"""SentencePiece encoding and decoding with merge-type vocabularies.

A normalised text is split into characters. Every adjacent pair of symbols whose concatenation is a piece of the
vocabulary stands in an agenda ordered by the piece's score, then by place. The first entry is taken: the two symbols become one, and
the new pairs with its neighbours enter the agenda; an entry whose symbols have changed since is passed over. What is left when the
agenda is empty are the pieces; characters without a piece become their UTF-8 bytes.

No piece of such a vocabulary has a space mark behind another character, and few signs stand beside a letter in any piece, so no merge crosses
such places: texts are cut there (see ``PieceCodes.cuts``) and the words merged one by one, each once while a task remembers it. A vocabulary
whose pieces do cross the start of space marks gets its texts as one word.

The words that are new in an Arrow batch are also encoded by the sentencepiece library, all in one call, and each text's decoded ids are compared
with its normalised text; ``agrees`` says whether the ids of all its words and its text are the same.
The library gives the vocabulary, the normaliser and the decoder.

Null and empty texts have no ids and decode to the empty text. Null ids of documents are kept, repeated rows come out each. Texts are
encoded whole, however long; a word without spaces takes time in proportion to its length, but for the logarithm of the
agenda. An empty table gives no rows. Results have doc_id and the columns named; other columns of the input are not passed on.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.registry import query, table

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Words that a task remembers.
REMEMBERED = 700_000
#: Characters of text whose words are looked up at a time.
SLICE_CHARS = 1 << 23


class PieceCodes:
    """The ids of words, each merged and checked once while it is remembered."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = library = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(library.get_piece_size())
        normal = [i for i in every if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i))]
        if any(map(library.is_unused, every)):
            raise ValueError("a vocabulary with unused pieces splits them again, which is not provided for")
        self.ids = {library.id_to_piece(i): [i] for i in normal}
        self.scores = {library.id_to_piece(i): -library.get_score(i) for i in normal}
        self.unknown = library.unk_id()
        self.bytes = {int(library.id_to_piece(i)[3:5], 16): i for i in every if library.is_byte(i)}
        self.signs, self.words = self.cuts()
        self.forget()

    def cuts(self) -> tuple[str, re.Pattern | None]:
        """Signs that no piece has beside anything but signs (space marks before them aside), and the pattern of words that may be merged apart."""
        beside = {piece[i : i + 2] for piece in self.ids for i in range(len(piece) - 1)}
        if any(b == SPACE != a for a, b in beside):
            return "", None
        signs = {c for piece in self.ids for c in piece if not c.isalpha()} - {SPACE} | {"\n"}
        while crossing := {c for a, b in beside if a != SPACE and (a in signs) != (b in signs) for c in (a, b)} & signs:
            signs -= crossing
        listed = "".join(map(re.escape, sorted(signs)))
        return "".join(sorted(signs)), re.compile(f"{SPACE}*[^{SPACE}{listed}]+|{SPACE}*[{listed}]+|{SPACE}+")

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.flat = np.empty(0, np.int32)
        self.ends = np.zeros(1, np.int64)
        #: Whether a word's ids are not the library's.
        self.wrong = np.empty(0, bool)

    def _ids_of(self, piece: str) -> list[int]:
        return self.ids.get(piece) or ([self.bytes[b] for b in piece.encode()] if self.bytes else [self.unknown])

    def merge(self, word: str) -> list[int]:
        """The ids of one word."""
        return [i for piece in merged(word, self.scores) for i in self._ids_of(piece)]

    def codes(self, words: list[str]) -> np.ndarray:
        """The numbers of these different words."""
        new = [w for w in words if w not in self.number]
        if len(self.number) + len(new) > REMEMBERED:
            self.forget()
            new = words
        ids = list(map(self.merge, new))
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        self.flat = np.concatenate((self.flat, np.fromiter(itertools.chain.from_iterable(ids), np.int32)))
        self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))))
        self.wrong = np.concatenate((self.wrong, np.fromiter((a != b for a, b in zip(ids, self._library_ids(new))), bool, len(new))))
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def _library_ids(self, words: list[str]) -> Iterator[list[int]]:
        """What the library makes of each word where it stands in a text: behind the space mark that is put before every text, a letter or a line end."""
        before = ["\n" if w == SPACE else SPACE if w.startswith(SPACE) or not self.words else "a" if w[0] in self.signs else "\n" for w in words]
        texts = [(w.removeprefix(SPACE) if b == SPACE else b + w).replace(SPACE, " ") for w, b in zip(words, before)]
        fixed = {b: len(self.library.encode(b)) for b in ("a", "\n")} | {SPACE: 0}
        return (ids[fixed[b] :] for ids, b in zip(self.library.encode(texts, num_threads=1), before))

    def encode(self, text: str) -> list[int]:
        """The ids of a text."""
        return next(iter(self.encode_all([text])))[0].tolist()

    def encode_all(self, texts: list[str]) -> Iterator[tuple[np.ndarray, str, bool]]:
        """Ids, decoded text and whether both are as the library has them, for each text."""
        find = self.words.findall if self.words else lambda text: [text] if text else []
        for part in _slices(texts):
            normal = list(map(self.library.normalize, part))
            words = list(map(find, normal))
            every = pa.array(itertools.chain.from_iterable(words), pa.string()).dictionary_encode()
            code = self.codes(every.dictionary.to_pylist())[every.indices.to_numpy()]
            first, wrong = self.ends[code], self.wrong[code]
            lengths = self.ends[code + 1] - first
            upto = np.concatenate(([0], np.cumsum(lengths)))
            ids = self.flat[np.repeat(first - upto[:-1], lengths) + np.arange(upto[-1])]
            at = 0
            for plain, mine in zip(normal, words):
                to = at + len(mine)
                own = ids[upto[at] : upto[to]]
                decoded = self.library.decode(own.tolist())
                yield own, decoded, not wrong[at:to].any() and decoded == plain.removeprefix(SPACE).replace(SPACE, " ")
                at = to


def _slices(texts: list[str]) -> Iterator[list[str]]:
    """Runs of texts of about ``SLICE_CHARS`` characters."""
    held: list[str] = []
    size = 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= SLICE_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def merged(word: str, scores: dict[str, float]) -> list[str]:
    """The pieces that are left of ``word`` when no two neighbours make a piece any more; ``scores`` are lower for what is merged first."""
    n = len(word)
    symbols = list(word)
    agenda = [(scores[pair], i, i + 1, 2) for i in range(n - 1) if (pair := word[i : i + 2]) in scores]
    if not agenda:
        return symbols
    pop, push, score = heapq.heappop, heapq.heappush, scores.get
    heapq.heapify(agenda)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while agenda:
        _, left, right, size = pop(agenda)
        first, second = symbols[left], symbols[right]
        if not first or not second or len(first) + len(second) != size:
            continue
        symbols[left] = first = first + second
        symbols[right] = ""
        after[left] = right = after[right]
        if right < n:
            before[right] = left
            pair = first + symbols[right]
            if (s := score(pair)) is not None:
                push(agenda, (s, left, right, len(pair)))
        if (left_of := before[left]) >= 0:
            pair = symbols[left_of] + first
            if (s := score(pair)) is not None:
                push(agenda, (s, left_of, left, len(pair)))
    return [s for s in symbols if s]


@functools.lru_cache(maxsize=2)
def piece_codes(path: str) -> PieceCodes:
    return PieceCodes(path)


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def round_trip(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, ids (array of int), decoded (the library's text of these ids) and agrees per row of ``docs``."""

    @F.arrow_udf("ids array<int>, decoded string, agrees boolean")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codes = piece_codes(model_path(model))
        for texts in batches:
            parts, decoded, agrees = [], [], []
            for ids, text, same in codes.encode_all([t or "" for t in texts.to_pylist()]):
                parts.append(ids)
                decoded.append(text)
                agrees.append(same)
            yield pa.StructArray.from_arrays([_lists(parts), pa.array(decoded, pa.string()), pa.array(agrees, pa.bool_())], ["ids", "decoded", "agrees"])

    return docs.select("doc_id", both("text").alias("tokens")).select("doc_id", "tokens.*")


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*parts, np.empty(0, np.int32)])))


def encode_texts(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, ids and agrees per row of ``docs``."""
    return round_trip(docs, model).select("doc_id", "ids", "agrees")


def decode_ids(tokens: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and decoded per row of ``tokens`` (doc_id, ids); null ids count as none."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        library = piece_codes(model_path(model)).library
        for ids in batches:
            yield pa.array([library.decode(i.as_py() or []) for i in ids], pa.string())

    return tokens.select("doc_id", decode("ids").alias("decoded"))


@query("op12_sentencepiece")
def pieces_of_documents(spark, sf_dir):
    return round_trip(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "agrees",
    )
