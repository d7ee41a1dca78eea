"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint has 64 bits: bit b is set if it is set in more than half of the XXH64 hashes (UTF-8, seed
42) of the text's 3-word shingles, repeats included. Two fingerprints link at ``radius`` or fewer differing
bits, ``radius`` even. Every distinct fingerprint emits all variants within half the radius (65 of them
at radius 2); two fingerprints are within the radius exactly if they share a variant. Variants are the shuffle
key. The fingerprints that meet at a variant all lie within half the radius of it, so within the radius of
each other: linking each to the next one in order joins them all, and the distance of each such pair is
checked again. A variant has at most as many fingerprints as the ball has points, whatever the data.

Copies are one fingerprint from the start: only distinct fingerprints emit variants. Components of linked
fingerprints are found by large-star and small-star steps whose tables are written to the shared folder.

Words are runs outside space and \\t..\\r; only A-Z are lower-cased. A text of one or two words is one
shingle; null texts and texts without a word get fingerprint 0, which links like any other. Rows with equal
ids count each. An empty table gives no rows. Texts of any length are hashed whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.components import connected_components
from rivulet.llm.registry import query, table
from rivulet.session import materialize

SHINGLE = 3
SEED = 42
RADIUS = 2
#: Shingle hashes that are counted bit by bit at a time.
BLOCK = 1 << 16

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SPACES = bytes([32, *range(9, 14)])
_TO_SPACE = bytes.maketrans(_SPACES, b" " * len(_SPACES))


def shingle_hashes(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """XXH64 of every shingle, as uint64."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).translate(_TO_SPACE).split(b" ")
    words = [w for w in words if w]
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(b" ".join(words), SEED)], np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - width + 1].tolist()
    pieces = map(line.__getitem__, map(slice, starts, ends[width - 1 :].tolist()))
    return np.fromiter((digest(p, SEED) for p in pieces), np.uint64, len(starts))


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """The signed 64-bit SimHash of a text."""
    hashes = shingle_hashes(text, width)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        bits = np.unpackbits(hashes[at : at + BLOCK].view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(majority.view(np.int64)[0])


def with_fingerprint(docs: DataFrame, width: int = SHINGLE, name: str = "fingerprint") -> DataFrame:
    """``docs`` with the signed 64-bit fingerprint of ``text``."""

    @F.pandas_udf("long")
    def simhash(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(t, width) for t in batch], dtype="int64")

    return docs.withColumn(name, simhash("text"))


def ball_masks(radius: int, bits: int = 64) -> list[int]:
    """All bit masks with at most ``radius`` bits set, as signed 64-bit numbers."""
    masks = [sum(1 << b for b in chosen) for n in range(radius + 1) for chosen in combinations(range(bits), n)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def linked_fingerprints(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b), a < b, within ``radius`` that connect all such fingerprints; ``distinct`` has one column, fingerprint.

    Not all pairs come out: those of one ball are chained, which keeps every connection.
    """
    if radius % 2:
        raise ValueError("the ball argument needs an even radius")
    masks = ball_masks(radius // 2)
    variants = distinct.withColumn("variant", F.explode(F.array(*[F.lit(m).cast("long") for m in masks]))).withColumn(
        "variant", F.col("variant").bitwiseXOR(F.col("fingerprint"))
    )
    chain = Window.partitionBy("variant").orderBy("fingerprint")
    return (
        variants.withColumn("a", F.lag("fingerprint").over(chain))
        .filter(F.col("a").isNotNull())
        .select("a", F.col("fingerprint").alias("b"))
        .distinct()
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
    )


def near_duplicate_groups(docs: DataFrame, radius: int = RADIUS, width: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (long), component_id (smallest doc_id reachable) per row of ``docs``."""
    marked = materialize(with_fingerprint(docs.select("doc_id", "text"), width).select("doc_id", "fingerprint"), "simhash")
    rooted = _rooted(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("smallest")), radius)
    smallest = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    of_class = rooted.join(smallest, "root").select("fingerprint", "component_id")
    return marked.join(of_class, "fingerprint").select("doc_id", "fingerprint", "component_id")


def _rooted(classes: DataFrame, radius: int) -> DataFrame:
    """``classes``, one row per fingerprint, with the root of its component."""
    classes = materialize(classes, "simhash-classes")
    roots = connected_components(materialize(linked_fingerprints(classes.select("fingerprint"), radius), "simhash-links"))
    return classes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))


def without_near_duplicates(docs: DataFrame, radius: int = RADIUS, width: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each group left: the first by id (null ids last), source, language and text hash.

    The first row of each group is found on narrow rows. Rows equal to it in id, source, language and text hash are one
    document; one of them stays. Texts move once, for the join; only rows that join are numbered.
    """
    names = ("doc_id", "source", "lang", "__hash")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), *names)
    hashed = docs.select("doc_id", "source", "lang", "text", F.xxhash64("text").alias("__hash"))
    firsts = with_fingerprint(hashed, width).groupBy("fingerprint").agg(F.min(order).alias("first"))
    kept = _rooted(firsts, radius).groupBy("root").agg(F.min("first").alias("first"))
    same = F.sha2(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}), 256)
    keys = kept.select(*[F.col(f"first.{n}").alias(n) for n in names]).select(same.alias("__kept"))
    keyed = docs.withColumn("__hash", F.xxhash64("text")).withColumn("__same", same)
    copies = Window.partitionBy("__same").orderBy("__same")
    return keyed.join(keys, F.col("__same") == F.col("__kept")).withColumn("__nth", F.row_number().over(copies)).filter("__nth = 1").select(*docs.columns)


@query("op4_simhash")
def simhash_of_documents(spark, sf_dir):
    groups = near_duplicate_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
