"""Spelling variants: tries against sets of prefixes, neighbours and forms against plain loops, and awkward rows."""

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from rivulet.llm import spelling

SF = "/root/testdata/sf0.001"
UP_TO_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_vocabulary(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UP_TO_LOW)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def plain_variants(counts):
    holes = {}
    for word in counts:
        for k in range(len(word) + 1):
            holes.setdefault((word[:k], word[k:]), set()).add(word)
            if k < len(word):
                holes.setdefault((word[:k], word[k + 1 :]), set()).add(word)
    near = {w: set() for w in counts}
    for group in holes.values():
        for w in group:
            near[w] |= {x for x in group if one_apart(w, x)}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return out


def rows_of(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def test_nodes_are_the_prefixes_of_all_words():
    rng = random.Random(1)
    for _ in range(60):
        words = sorted({"".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(1, 80))})
        cuts = sorted(rng.sample(range(1, len(words)), min(len(words) - 1, rng.randrange(6))))
        chunks = [words[a:b] for a, b in zip([0, *cuts], [*cuts, len(words)])]
        borders = [c[-1] for c in chunks]
        node_of, prefix_of = {}, {}
        for k, chunk in enumerate(chunks):
            for word, path in zip(chunk, spelling.node_paths(chunk, k, borders)):
                assert len(path) == len(word) + 1
                for d, node in enumerate(path):
                    assert node_of.setdefault(word[:d], node) == node
                    assert prefix_of.setdefault(node, word[:d]) == word[:d]


def word_table(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def test_variants_equal_a_plain_search(spark):
    rng = random.Random(6)
    for letters, size in (("ab", 7), ("abcé", 6)):
        counts = {"".join(rng.choice(letters) for _ in range(rng.randrange(1, size))): rng.choice([1, 2, 3, 5, 9, 20, 41, 100, 1000]) for _ in range(150)}
        counts |= {"aaaaaaaaaa": 3, "aaaaaaaaaaa": 7, "aaaaaaaaa": 7, "é" * 4: 1}
        got = spelling.variants(word_table(spark, counts), chunk_words=20)
        assert rows_of(got) == sorted(plain_variants(counts), key=str)


def test_long_chains_and_long_words(spark):
    # each word is near the next only, with twice its count
    counts = {"".join("b" if k < at else "a" for k in range(30)): 2**at for at in range(31)}
    long = "".join(random.Random(3).choice("xyz") for _ in range(30_000))
    counts |= {long: 5, long[:12_345] + long[12_346:]: 50, long + "q": 2}
    assert rows_of(spelling.variants(word_table(spark, counts), chunk_words=7)) == sorted(
        [
            *[(w, v, "b" * 30, n, (at > 0) + (at < 30), 2 * n if v else None) for at, (w, n, v) in enumerate(chain(counts))],
            (long, long[:12_345] + long[12_346:], long[:12_345] + long[12_346:], 5, 2, 50),
            (long[:12_345] + long[12_346:], None, long[:12_345] + long[12_346:], 50, 1, None),
            (long + "q", long, long[:12_345] + long[12_346:], 2, 1, 5),
        ],
        key=str,
    )


def chain(counts):
    words = [w for w in counts if set(w) <= {"a", "b"} and len(w) == 30]
    return [(w, counts[w], v) for w, v in zip(words, [*words[1:], None])]


def test_words_of_awkward_rows(spark, awkward, empty):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    want = plain_vocabulary(rows)
    assert {r["word"]: r["n"] for r in spelling.vocabulary(awkward).collect()} == want
    assert rows_of(spelling.variants_of_documents(awkward)) == sorted(plain_variants(want), key=str)
    assert spelling.variants_of_documents(empty).count() == 0


def test_letters_outside_ascii(spark):
    rows = [(k, t) for k in range(3) for t in ("ÀÉÎõü×÷Zz x", "Ābcdefg ſtrasse", "STRASSE Straße", "aé" * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["word"]: r["n"] for r in spelling.vocabulary(docs).collect()} == plain_vocabulary(rows)


def test_query_of_spelling(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = spelling.spelling_of_documents(spark, SF)
    assert rows_of(got) == sorted(plain_variants(plain_vocabulary(rows)), key=str)
    assert got.agg(F.count("form")).first()[0] > 0
