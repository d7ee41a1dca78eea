"""Benchmark decontamination by spaced-seed hashing.

A seed mask picks some of the words of a window and ignores the others, so a window still hashes alike
when ignored words were replaced. The masks together hit every stretch that counts as a leak, wherever its words were
replaced: LONG_MASKS for stretches of 13 words and more (one of 26 or more has a half that counts itself), SHORT_MASKS
for items of 8 to 12 words, whole windows for items below that. The test items' hashes form a block of bounded size that every task
holds; windows of the training texts are joined to it, and each hit is verified by comparing the item word by
word along the hit's diagonal, all diagonals of an item at once: a leak is a stretch of at least ``LEAST_WORDS`` words (a shorter item: all
of it) of which at least ``ALIKE`` are the same. Texts are read once per block and never shuffled; a larger
benchmark has more blocks, not larger ones.

Words are runs of letters and digits of the lower-cased text, so case, punctuation and line breaks do not
hide a copy. Null and empty texts have no leaks. Items of fewer than ``EXACT`` words match as a whole, word for word
(so an item of one word matches wherever that word stands; ``shortest`` leaves out items below a length, and ``short_items`` lists
them); null ones and those without a word never match. Repeated rows are judged alike, each on its own; null ids
are kept. An empty table gives no rows, an empty benchmark no leaks. Long texts are hashed in one piece
of flat arrays, about 60 bytes per byte of text at most for ``PIECE`` bytes at a time; hits are verified ``HITS`` at a time, so a
word repeated through a text and an item takes time in proportion to the text and the item, and no more memory.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.registry import query, table

LEAST_WORDS = 13
ALIKE = 0.8
#: What a word adds to a stretch, alike and not: a stretch has the asked share exactly if its sum is not negative.
SAME, OTHER = 1, -4
#: Items of fewer words match only as they are.
EXACT = 8
#: Words of the shortest item that can match.
SHORTEST = 1
#: Offsets of the words that a mask looks at, for items of ``LEAST_WORDS`` and more and for shorter ones.
LONG_MASKS = ((0, 1, 2, 3, 5, 6), (0, 1, 3, 7, 10, 11), (0, 1, 2, 6, 8, 9), (0, 1, 2, 3, 4, 5))
SHORT_MASKS = ((0, 1, 2, 4, 5), (0, 1, 3, 6, 7), (0, 1, 2, 3, 4))
MASKS = tuple(dict.fromkeys((*LONG_MASKS, *SHORT_MASKS, *[tuple(range(n)) for n in range(1, EXACT)])))
#: Words of test items that a task holds at a time.
BLOCK_WORDS = 250_000
#: Bytes of text that are hashed at a time; pieces overlap by the longest item of the block.
PIECE = 1 << 20
FILTER_BITS = 20
#: Hits that are looked at together, and words compared together.
HITS, CELLS = 1 << 20, 1 << 22

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[np.frombuffer(b"0123456789abcdefghijklmnopqrstuvwxyz", np.uint8)] = True
_WORD_BYTE[128:] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_ROLES = np.random.default_rng(7).integers(1, 2**63, size=16, dtype=np.uint64) | np.uint64(1)


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i for i < n, modulo 2^64."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up = np.concatenate(([np.uint64(1)], np.full(n - 1, _BASE, np.uint64)))
    down = np.concatenate(([np.uint64(1)], np.full(n - 1, inverse, np.uint64)))
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of every word of lower-cased UTF-8 text."""
    raw = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = _WORD_BYTE[raw]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    size = 1 << max(21, int(len(raw)).bit_length())
    up, down = _powers(size)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
        hashes = (sums[ends] - sums[starts]) * down[starts]
        hashes = (hashes ^ (hashes >> np.uint64(31))) * _MIX
    return hashes ^ (hashes >> np.uint64(29)), starts, ends


def masked_hashes(words: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """The hash of the masked window at every position."""
    n = len(words) - max(mask)
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.full(n, np.uint64(len(mask)))
        for role, at in enumerate(mask):
            total += words[at : at + n] * _ROLES[role]
        total = (total ^ (total >> np.uint64(32))) * _MIX
    return total


def masks_of(n: int) -> tuple[tuple[int, ...], ...]:
    """The masks that serve items of ``n`` words."""
    return LONG_MASKS if n >= LEAST_WORDS else SHORT_MASKS if n >= EXACT else (tuple(range(n)),) if n else ()


def text_words(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return word_hashes((text or "").lower().encode("utf-8", "surrogatepass"))


@dataclass
class SeedBlock:
    """The masked windows of some test items, sorted by hash, with a bit filter before the search."""

    ids: list
    words: list[np.ndarray]
    hashes: list[np.ndarray]
    item: list[np.ndarray]
    position: list[np.ndarray]
    filters: list[np.ndarray]

    @classmethod
    def of(cls, ids: list, texts: list[str]) -> SeedBlock:
        words = [text_words(t)[0] for t in texts]
        block = cls(ids, words, [], [], [], [])
        for mask in MASKS:
            parts = [masked_hashes(w, mask) if mask in masks_of(len(w)) else np.empty(0, np.uint64) for w in words]
            hashes = np.concatenate([*parts, np.empty(0, np.uint64)])
            order = np.argsort(hashes, kind="stable")
            block.hashes.append(hashes[order])
            block.item.append(np.repeat(np.arange(len(parts)), [len(p) for p in parts])[order])
            block.position.append(np.concatenate([*[np.arange(len(p)) for p in parts], np.empty(0, np.int64)])[order])
            bits = np.zeros(1 << FILTER_BITS, bool)
            bits[hashes >> np.uint64(64 - FILTER_BITS)] = True
            block.filters.append(bits)
        return block

    def leaks(self, text: str | None) -> list[tuple]:
        """(item id, first and end byte in the lower-cased text, words, words alike) of every item found, the best place of each."""
        data = (text or "").lower().encode("utf-8", "surrogatepass")
        best: dict[int, tuple] = {}
        overlap = 64 * max((len(w) for w in self.words), default=0)
        at = 0
        while at < len(data):
            end = min(len(data), at + PIECE + overlap)
            cut = [bool(0 < k < len(data) and _WORD_BYTE[data[k - 1]] and _WORD_BYTE[data[k]]) for k in (at, end)]
            for found in self._leaks_of_piece(data[at:end], *cut):
                if found[0] not in best or found[4] > best[found[0]][4]:
                    best[found[0]] = (found[0], found[1] + at, found[2] + at, *found[3:])
            at = len(data) if end == len(data) else at + PIECE
        return [(self.ids[k], *rest) for k, *rest in sorted(best.values())]

    def _leaks_of_piece(self, data: bytes, first_cut: bool = False, last_cut: bool = False) -> Iterator[tuple]:
        """The leaks among whole words: a cut one stands whole in a neighbouring piece."""
        words, starts, ends = (x[first_cut : len(x) - last_cut] for x in word_hashes(data))
        # per item, the text places and item places of each hash that both have
        meeting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for mask, hashes, items, positions, bits in zip(MASKS, self.hashes, self.item, self.position, self.filters):
            if not len(hashes):
                continue
            here = masked_hashes(words, mask)
            near = np.flatnonzero(bits[here >> np.uint64(64 - FILTER_BITS)])
            near = near[np.argsort(here[near], kind="stable")]
            found, first = np.unique(here[near], return_index=True)
            low, high = (np.searchsorted(hashes, found, side) for side in ("left", "right"))
            ends_at = np.append(first, len(near))[1:]
            for k in np.flatnonzero(high > low):
                # a whole item: its first place is as good as any
                places = near[first[k] : ends_at[k] if mask in LONG_MASKS + SHORT_MASKS else first[k] + 1]
                entries = slice(low[k], high[k])
                borders = np.flatnonzero(np.diff(items[entries])) + 1
                for item, its in zip(items[entries][np.append(0, borders)], np.split(positions[entries], borders)):
                    meeting.setdefault(int(item), []).append((places, its))
        for item, met in meeting.items():
            if found := aligned(words, self.words[item], _shifts(met, len(words), len(self.words[item]))):
                first, last, alike = found
                yield item, int(starts[first]), int(ends[last - 1]), last - first, alike


def _shifts(met: list[tuple[np.ndarray, np.ndarray]], n_text: int, n_item: int) -> np.ndarray:
    """The different ways to lay an item so that a text place meets an item place, ascending."""
    if sum(len(t) * len(i) for t, i in met) < 64:
        return np.unique(np.concatenate([(t[:, None] - i).ravel() for t, i in met]))
    marked = np.zeros(n_text + n_item, bool)
    for text_at, item_at in met:
        for some in np.array_split(text_at, -(-len(text_at) * len(item_at) // HITS)):
            marked[(some[:, None] - item_at + n_item).ravel()] = True
    return np.flatnonzero(marked) - n_item


def aligned(words: np.ndarray, item: np.ndarray, shifts: np.ndarray) -> tuple[int, int, int] | None:
    """The best stretch of ``words`` that repeats ``item`` laid at one of ``shifts``, the first of equals: first word, end, words alike."""
    least, n = min(LEAST_WORDS, len(item)), len(item)
    best = None
    for some in np.array_split(shifts, -(-len(shifts) * n // CELLS)):
        place = some[:, None] + np.arange(n)
        inside = (place >= 0) & (place < len(words))
        same = inside & (words[np.where(inside, place, 0)] == item)
        if n < EXACT:
            some, place, inside, same = (x[same.all(axis=1)] for x in (some, place, inside, same))
        if not len(some):
            continue
        # no stretch that counts goes beyond the text
        step = np.where(same, SAME, np.where(inside, OTHER, OTHER * (n + 1)))
        sums = np.concatenate((np.zeros((len(some), 1), np.int64), np.cumsum(step, axis=1)), axis=1)
        gain = sums[:, least:] - np.minimum.accumulate(sums[:, : n + 1 - least], axis=1)
        for row in np.flatnonzero(gain.max(axis=1) >= 0):
            k = int(np.argmax(gain[row]))
            first, last = int(np.argmin(sums[row, : k + 1])), k + least
            alike = int(same[row, first:last].sum())
            if best is None or alike > best[2]:
                best = (int(some[row]) + first, int(some[row]) + last, alike)
            if alike == n:
                return best
    return best


def short_items(benchmark: DataFrame, below: int = EXACT) -> DataFrame:
    """item_id and n_words of the items of fewer than ``below`` words, which match only as they are, wherever they stand."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series([len(text_words(t)[0]) for t in texts], dtype="int64")

    return benchmark.select("item_id", count("text").alias("n_words")).where(F.col("n_words") < below)


def seed_blocks(benchmark: DataFrame, shortest: int = SHORTEST, block_words: int = BLOCK_WORDS) -> Iterator[SeedBlock]:
    """The items of ``benchmark`` (item_id, text) with ``shortest`` words and more, streamed through in blocks of at most ``block_words`` words and one item."""
    ids, texts, total = [], [], 0
    for row in benchmark.select("item_id", "text").filter(F.col("text").isNotNull()).toLocalIterator():
        n = len(text_words(row["text"])[0])
        if n < shortest:
            continue
        if texts and total + n > block_words:
            yield SeedBlock.of(ids, texts)
            ids, texts, total = [], [], 0
        ids.append(row["item_id"])
        texts.append(row["text"])
        total += n
    if texts:
        yield SeedBlock.of(ids, texts)


def leaks_of(block: SeedBlock, docs: DataFrame, benchmark: DataFrame) -> Column:
    """Array of structs (item_id, from_byte, to_byte, words, alike) for the column ``text`` of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    kind = dict(benchmark.dtypes)["item_id"]

    @F.pandas_udf(f"array<struct<item_id: {kind}, from_byte: long, to_byte: long, words: long, alike: long>>")
    def leaks(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ("item_id", "from_byte", "to_byte", "words", "alike")
        for batch in texts:
            yield pd.Series([[dict(zip(names, found)) for found in shared.value.leaks(t)] for t in batch])

    return leaks("text")


def contaminated(docs: DataFrame, benchmark: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """One row per document row and item that it holds: doc_id, item_id, from_byte, to_byte, words, alike."""
    parts = [
        docs.select("doc_id", F.explode(leaks_of(block, docs, benchmark)).alias("leak")).select("doc_id", "leak.*") for block in seed_blocks(benchmark, shortest)
    ]
    if not parts:
        kind = dict(benchmark.dtypes)["item_id"]
        return docs.limit(0).selectExpr("doc_id", f"CAST(NULL AS {kind}) AS item_id", *[f"0L AS {c}" for c in ("from_byte", "to_byte", "words", "alike")])
    return functools.reduce(DataFrame.unionByName, parts)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """The rows of ``docs`` that hold no item of ``benchmark``."""
    for block in seed_blocks(benchmark, shortest):
        docs = docs.filter(F.size(leaks_of(block, docs, benchmark)) == 0)
    return docs


@query("op6_decontamination")
def contaminated_documents(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
