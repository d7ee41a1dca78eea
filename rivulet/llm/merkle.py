"""Document fingerprints: a Merkle tree over pieces, paragraphs and sections.

Leaves are pieces of a sentence of at most ``PIECE`` characters (shorter ones where a paragraph begins), a paragraph is a line with its line break,
and a section ends before a heading (``#``), after an empty line, or after a paragraph whose hash says so,
so that an edit moves no distant border. A node's digest is the BLAKE2b of its children's digests. The
fingerprint is ``root:tree``: the root in hex, then every leaf as 8 hex digits of its digest and 2 digits of
its length, paragraphs apart by ``/`` and sections by ``|``. Equal roots mean equal texts; below different
roots ``edited_stretches`` finds the stretches of text that differ, section by section and paragraph by paragraph.

``likeness`` is the share of text whose leaves both have: 2 x common length / both lengths, 1 for two empty texts.

Neighbours by id come together without moving a text twice: ids are cut into ranges, each range is a stream sorted
by falling id, and only the first document of every range is sent to the range before it as well.
A stream keeps one text at a time.

Null texts are empty. Null ids come before all others and keep their null. The next document is the one of
the next larger id; of rows that repeat an id the first by text hash stands for it, and all of them have
the same next document. With a single id the next document is that id's own. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.registry import query, table

PIECE = 48
#: A paragraph begins with pieces of this size, for the first PIECE characters, so that short texts have several leaves.
FIRST_PIECE = 12
#: One paragraph in so many ends a section by its hash.
SECTION = 8
#: Rows of a range of ids, and ranges at most: a list of so many ids is what the driver sees.
RANGE_ROWS = 512
RANGES = 200_000
#: Ranges of a task, on average: tasks are bounded by rows, whatever the number of shuffle partitions.
TASK_RANGES = 4

_SENTENCE = re.compile(r"[^.!?]*(?:[.!?]+\s*|$)")
_FIRST = -(1 << 63)


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _paragraph_leaves(paragraph: str) -> tuple[list[str], bytes]:
    names, digests = [], []
    before = 0
    for sentence in _SENTENCE.findall(paragraph):
        at = 0
        while at < len(sentence):
            piece = sentence[at : at + (FIRST_PIECE if before < PIECE else PIECE)]
            at += len(piece)
            before += len(piece)
            digest = _digest(piece.encode("utf-8", "surrogatepass"))
            digests.append(digest)
            names.append(f"{digest[:4].hex()}{len(piece):02d}")
    return names, _digest(b"".join(digests))


def tree(text: str | None) -> tuple[str, list[list[list[str]]]]:
    """The root in hex, and the leaf names by section and paragraph."""
    sections: list[list[list[str]]] = []
    digests: list[list[bytes]] = []
    fresh = True
    for paragraph in (text or "").splitlines(keepends=True):
        names, digest = _paragraph_leaves(paragraph)
        if fresh or paragraph.startswith("#"):
            sections.append([])
            digests.append([])
        sections[-1].append(names)
        digests[-1].append(digest)
        fresh = digest[0] % SECTION == 0 or not paragraph.strip()
    return _digest(b"".join(_digest(b"".join(d)) for d in digests)).hex(), sections


def as_string(root: str, sections: list[list[list[str]]]) -> str:
    return f"{root}:" + "|".join("/".join("".join(p) for p in s) for s in sections)


def fingerprint(text: str | None) -> str:
    return as_string(*tree(text))


def _leaves(sections: list[list[list[str]]]) -> Counter:
    return Counter(name for section in sections for paragraph in section for name in paragraph)


def _alike(a: Counter, b: Counter) -> float:
    if len(a) > len(b):
        a, b = b, a
    common = sum(min(n, b[name]) * int(name[8:]) for name, n in a.items() if name in b)
    both = sum(n * int(name[8:]) for c in (a, b) for name, n in c.items())
    return 2 * common / both if both else 1.0


def parsed(fingerprint: str) -> list[list[list[str]]]:
    """Sections, paragraphs and leaf names of a fingerprint."""
    body = fingerprint.partition(":")[2]
    return [[[p[i : i + 10] for i in range(0, len(p), 10)] for p in s.split("/")] for s in body.split("|")] if body else []


def likeness(a: str, b: str) -> float:
    """0 to 1 from two fingerprints alone."""
    return 1.0 if a.partition(":")[0] == b.partition(":")[0] else _alike(_leaves(parsed(a)), _leaves(parsed(b)))


def edited_stretches(a: str, b: str) -> list[tuple[int, int]]:
    """Stretches of the first text, as (start, end) in characters, under branches the second does not have.

    Roots first; then sections and paragraphs are looked up among the other's by their leaves, and only
    those that one side alone has are opened.
    """
    if a.partition(":")[0] == b.partition(":")[0]:
        return []
    ours, theirs = parsed(a), parsed(b)
    whole = lambda section: "/".join("".join(p) for p in section)
    sections = Counter(map(whole, theirs))
    opened = []  # ours: (known, section)
    for section in ours:
        sections[whole(section)] -= 1
        opened.append((sections[whole(section)] >= 0, section))
    known = Counter(whole(s) for k, s in opened if k)
    paragraphs = Counter("".join(p) for s in theirs if not _take(known, whole(s)) for p in s)
    looked_up = [(k or _take(paragraphs, "".join(p)), p) for k, s in opened for p in s]
    # what is left of their paragraphs has the leaves that ours may share
    leaves = Counter(name[i : i + 10] for name in paragraphs.elements() for i in range(0, len(name), 10))
    at, found = 0, []
    for same, paragraph in looked_up:
        for name in paragraph:
            end = at + int(name[8:])
            if not same and not _take(leaves, name):
                if found and found[-1][1] == at:
                    found[-1] = (found[-1][0], end)
                else:
                    found.append((at, end))
            at = end
    return found


def _take(have: Counter, name: str) -> bool:
    """Use up one ``name`` if there is one."""
    if have[name] <= 0:
        return False
    have[name] -= 1
    return True


# ---- the jobs


def _ranges(keys: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Upper borders of the ranges of ``key``, and the first key of each range that has one; at most RANGES numbers each."""
    rows = keys.count()
    n = min(RANGES, max(1, rows // RANGE_ROWS))
    borders = np.empty(0, np.int64)
    if n > 1:
        cut = keys.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 5 * n)).first()[0]
        borders = np.unique(np.array(cut, np.int64))
    firsts = keys.groupBy(_range_of(borders)("key").alias("range")).agg(F.min("key").alias("first")).collect()
    return borders, np.array(sorted(r["first"] for r in firsts), np.int64)


def _range_of(borders: np.ndarray):
    @F.pandas_udf("long")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(borders, keys.to_numpy(np.int64), side="left"))

    return place


def _places(borders: np.ndarray, firsts: np.ndarray):
    """The ranges that a key's row goes to: its own, and if it is the first of its range the one before (cyclic)."""
    homes = np.searchsorted(borders, firsts, side="left")
    before = dict(zip(firsts.tolist(), np.roll(homes, 1).tolist()))

    @F.pandas_udf("array<struct<range: long, copy: boolean>>")
    def places(keys: pd.Series) -> pd.Series:
        own = np.searchsorted(borders, keys.to_numpy(np.int64), side="left").tolist()
        return pd.Series(
            [[{"range": r, "copy": False}] + ([{"range": before[k], "copy": True}] if k in before else []) for k, r in zip(keys.tolist(), own)]
        )

    return places


def with_next_document(docs: DataFrame, of_pair, schema: str) -> DataFrame:
    """``of_pair(text, next text, state)`` for every row, as the columns of ``schema`` beside doc_id.

    ``of_pair`` returns a tuple for the row; texts are str, never null. Runs small jobs for the ranges of ids.
    """
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST)).alias("key"),
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    borders, firsts = _ranges(keyed.select("key"))
    spread = keyed.withColumn("place", F.explode(_places(borders, firsts)("key"))).select(
        "key", "no_id", "text", "place.*", F.xxhash64("text").alias("tie")
    )
    names = [c.strip().split()[0] for c in schema.split(",")]

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, following, latest, key = None, "", "", None
        for batch in batches:
            out = []
            for r, copy, k, none, text in zip(batch["range"], batch["copy"], batch["key"], batch["no_id"], batch["text"]):
                if r != here:
                    here, key = r, None
                if copy:
                    latest, key = text, ("copy", k)
                    continue
                if key != ("row", k):
                    following, key = latest, ("row", k)
                out.append((k, none, *of_pair(text, following)))
                latest = text
            yield pd.DataFrame(out, columns=["key", "no_id", *names])

    tasks = max(1, len(firsts) // TASK_RANGES)
    falling = spread.repartition(tasks, "range").sortWithinPartitions("range", F.col("copy").desc(), F.col("key").desc(), F.col("tie").desc())
    found = falling.select("range", "copy", "key", "no_id", "text").mapInPandas(stream, f"key long, no_id boolean, {schema}")
    return found.select(F.when(~F.col("no_id"), F.col("key")).alias("doc_id"), *names)


def _edit_row(text: str, following: str, cache: dict = {}) -> tuple:  # noqa: B006  the last text's tree
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]
    root, sections = tree(text)
    leaves = _leaves(sections)
    edited_root, edited_sections = tree(edited)
    near_edited = 1.0 if edited_root == root else _alike(leaves, _leaves(edited_sections))
    if cache.get("text") != following:
        cache["text"], cache["tree"] = following, tree(following)
    next_root, next_sections = cache["tree"]
    near_next = 1.0 if next_root == root else _alike(leaves, _leaves(next_sections))
    cache["text"], cache["tree"] = text, (root, sections)
    return (
        len(text),
        hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
        as_string(root, sections),
        as_string(edited_root, edited_sections),
        near_edited,
        near_next,
    )


@query("op1_fingerprints")
def fingerprints_of_documents(spark, sf_dir):
    schema = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next_document(table(spark, sf_dir, "documents"), _edit_row, schema)
