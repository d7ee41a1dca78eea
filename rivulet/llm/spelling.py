"""Spelling variants: words one insertion, deletion or replacement apart, grouped under their most frequent form.

The words stand in two tries, one read forwards and one backwards, whose nodes are numbered. A word and a place in it give
an integer pair: the node of what is before the place and the node of what is behind it. Each word enters the pair of every
place between its characters (nothing left out) and of every character left out. Two words that share a pair with one
character left out in each differ by a replacement there; a word with one left out that shares a pair with a whole one
is the longer by that character. There are no other ways to be one edit apart, so the neighbours are exact. Of a run of equal
characters only the first one left out counts as a deletion, so no two words meet twice. A pair has one whole word at most and
no more words with one left out than the alphabet has characters, whatever the data; the best partner of each is found by the order of the
pair's rows, so pairs of words are never made.

Numbering: the sorted words are cut into chunks. A prefix of a chunk's last word is named by the first such chunk and its length, which
every task can tell from the list of last words (one per ``CHUNK`` words); any other prefix occurs in one chunk only and is counted there.
A node is looked for once per character of the word, so long words take linear time and space.

Words are the maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` with A-Z lower-cased, less one character where the checksum of id and run says so,
if they have ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` occurrences. Null and empty texts have none, a null id reads ``null``, repeated
rows count each, ties go to the word that comes first by code point. An empty table gives no rows. Occurrences are counted
inside tasks before they are shuffled, so a word that makes up a third of all text moves as little as any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.registry import query, table
from rivulet.session import materialize, release

RUN = "[A-Za-zÀ-ÿ]+"
#: One run in so many, by checksum, loses a character.
ONE_IN = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A form has at least so many times the occurrences of the word.
FORM_TIMES = 2
#: Words that are numbered in one task.
CHUNK = 50_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the words of all texts with their occurrences."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    size = F.length("run")
    ascii_only = F.octet_length("run") == size
    lowered = runs.filter(size >= least_length).withColumn("run", F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", _UPPER, _LOWER)))
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.col("run"))
    place = (F.col("sum") % size).cast("int")
    shorter = F.concat(F.substr("run", F.lit(1), place), F.substr("run", place + 2))
    words = lowered.withColumn("sum", F.crc32(named.cast("binary"))).select(F.when(F.col("sum") % ONE_IN == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") >= least_count) & (F.length("word") >= least_length))


# ---- numbered tries


def shared(a: str, b: str) -> int:
    """Characters that two words have in common from the start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(k for k in range(n) if a[k] != b[k])


def node_paths(words: list[str], chunk: int, borders: list[str]) -> Iterator[list[int]]:
    """For each of the sorted words of a chunk, the numbers of its trie nodes from the root on; ``borders`` are the chunks' last words.

    Nodes on the way to a chunk's last word have negative numbers, by chunk and depth; the others positive ones, by chunk and count.
    """
    path: list[int] = []
    for k in range(chunk if words else 0):
        path += [-(k << 32) - d - 1 for d in range(len(path), shared(borders[k], words[0]) + 1)]
    count = chunk << 32
    before = words[0] if words else ""
    for word in words:
        del path[shared(before, word) + 1 :]
        last = shared(word, borders[chunk])
        path += [-(chunk << 32) - d - 1 for d in range(len(path), last + 1)]
        new = range(count, count + len(word) + 1 - len(path))
        path += new
        count += len(new)
        before = word
        yield list(path)


def numbered_trie(words: DataFrame, chunk_words: int = CHUNK) -> DataFrame:
    """(word, rank, nodes) for the distinct words of ``words``: ``rank`` grows with the word by code point, ``nodes`` holds the
    number of the trie node of each prefix, the empty one first. Runs jobs."""
    chunks = max(1, -(-words.count() // chunk_words))
    cut = materialize(words.select("word").repartitionByRange(chunks, "word").withColumn("chunk", F.spark_partition_id()), "spelling-chunks")
    # chunks without words have no number
    last = {r["chunk"]: r["last"] for r in cut.groupBy("chunk").agg(F.max("word").alias("last")).collect()}
    places = {chunk: k for k, chunk in enumerate(sorted(last))}
    borders = [last[chunk] for chunk in places]

    def number(rows: pd.DataFrame) -> pd.DataFrame:
        mine = sorted(rows["word"])
        chunk = places[int(rows["chunk"].iloc[0])]
        return pd.DataFrame({"word": mine, "rank": range(chunk << 32, (chunk << 32) + len(mine)), "nodes": list(node_paths(mine, chunk, borders))})

    return materialize(cut.groupBy("chunk").applyInPandas(number, "word string, rank long, nodes array<long>"), "spelling-trie")


# ---- neighbours


def place_pairs(ranked: DataFrame, chunk_words: int = CHUNK) -> DataFrame:
    """The pair dictionary of ``ranked`` (word, n, rank, nodes): p, s, rank, n, whole (nothing left out), counts (a deletion here counts). Runs jobs."""
    backwards = numbered_trie(ranked.select(F.reverse("word").alias("word")), chunk_words).select(F.reverse("word").alias("word"), F.col("nodes").alias("suffixes"))
    known = ranked.join(backwards, "word").withColumn("letters", F.split("word", "")).withColumn("size", F.length("word"))

    def pair(at: Column, skipped: int, counts: Column) -> Column:
        return F.struct(
            F.get("nodes", at).alias("p"), F.get("suffixes", F.col("size") - at - skipped).alias("s"), F.lit(not skipped).alias("whole"), counts.alias("counts")
        )

    whole = F.transform(F.sequence(F.lit(0), F.col("size")), lambda at: pair(at, 0, F.lit(False)))
    skipping = F.transform(
        F.sequence(F.lit(0), F.col("size") - 1), lambda at: pair(at, 1, (at == 0) | (F.get("letters", at) != F.get("letters", at - 1)))
    )
    return known.select("rank", "n", F.explode(F.concat(whole, skipping)).alias("pair")).select("pair.*", "rank", "n")


def near_words(pairs: DataFrame) -> DataFrame:
    """(rank, n_near, near_n, near_rank) per word with neighbours: how many, and the most frequent of them, the first of equals."""
    here = Window.partitionBy("p", "s").orderBy("whole", F.desc("n"), "rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    met = pairs.withColumn("me", F.struct("n", (-F.col("rank")).alias("back"))).withColumns(
        {
            "skipping": F.sum((~F.col("whole")).cast("long")).over(here),
            "shorter": F.sum(F.col("counts").cast("long")).over(here),
            "first": F.first("me").over(here),
            "second": F.nth_value("me", 2).over(here),
            "longest": F.max(F.when(F.col("counts"), F.col("me"))).over(here),
            "the_whole": F.max(F.when(F.col("whole"), F.col("me"))).over(here),
        }
    )
    replaced = F.when(F.col("skipping") > 1, F.when(F.col("first") == F.col("me"), F.col("second")).otherwise(F.col("first")))
    inserted = F.when(F.col("counts"), F.col("the_whole"))
    found = met.select(
        "rank",
        F.when(F.col("whole"), F.col("shorter")).otherwise(F.col("skipping") - 1 + inserted.isNotNull().cast("long")).alias("near"),
        F.when(F.col("whole"), F.col("longest")).otherwise(F.greatest(replaced, inserted)).alias("best"),
    ).filter("near > 0")
    return found.groupBy("rank").agg(F.sum("near").alias("n_near"), F.max("best").alias("best")).select(
        "rank", "n_near", F.col("best.n").alias("near_n"), (-F.col("best.back")).alias("near_rank")
    )


def chain_ends(links: DataFrame) -> DataFrame:
    """``links`` (rank, to) with ``to`` followed to its last one. Each round doubles the distance; each is written, the one before removed."""
    ends = materialize(links.withColumn("moved", F.lit(True)), "spelling-ends")
    while ends.filter("moved").limit(1).count():
        before = ends
        further = before.select(F.col("rank").alias("to"), F.col("to").alias("next"))
        stepped = before.join(further, "to", "left").select("rank", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved"))
        ends = materialize(stepped, "spelling-ends")
        release(before)
    return ends.select("rank", "to")


def variants(words: DataFrame, times: int = FORM_TIMES, chunk_words: int = CHUNK) -> DataFrame:
    """word, form, root, n, n_near, form_n for ``words`` (word, n), which is read several times: pass a written table. Runs jobs."""
    ranked = materialize(words.join(numbered_trie(words, chunk_words), "word"), "spelling-ranked")
    near = near_words(place_pairs(ranked, chunk_words))
    larger = F.col("near_n") >= times * F.col("n")
    linked = materialize(
        ranked.join(near, "rank", "left").select(
            "word", "rank", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(larger, F.col("near_n")).alias("form_n"), F.when(larger, F.col("near_rank")).alias("to")
        ),
        "spelling-links",
    )
    ends = chain_ends(linked.filter("to IS NOT NULL").select("rank", "to")).withColumnRenamed("to", "end")
    forms = linked.select(F.col("rank").alias("to"), F.col("word").alias("form"))
    roots = linked.select(F.col("rank").alias("end"), F.col("word").alias("root"))
    named = linked.join(ends, "rank", "left").join(forms, "to", "left").join(roots, "end", "left")
    return named.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants_of_documents(docs: DataFrame) -> DataFrame:
    """``variants`` of the words of ``docs``."""
    return variants(materialize(vocabulary(docs), "spelling-words"))


@query("op11_spelling_variants")
def spelling_of_documents(spark, sf_dir):
    return variants_of_documents(table(spark, sf_dir, "documents"))
