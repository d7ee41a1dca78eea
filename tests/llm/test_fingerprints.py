"""Merkle fingerprints, SimHash groups and components against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rivulet.llm import merkle, simhash
from rivulet.llm.components import connected_components

SF = "/root/testdata/sf0.001"


def test_equal_roots_only_for_equal_texts():
    rng = random.Random(3)
    texts = {"".join(rng.choice("ab .\n#") for _ in range(rng.randrange(40))) for _ in range(3000)}
    assert len({merkle.fingerprint(t) for t in texts}) == len(texts)
    assert merkle.fingerprint(None) == merkle.fingerprint("")


def test_branches_locate_an_edit():
    text = "\n".join(f"Paragraph {k} says something of its own. And a little more of it." for k in range(40))
    changed = text.replace("Paragraph 17 says", "Paragraph 17 denies")
    spans = merkle.edited_stretches(merkle.fingerprint(text), merkle.fingerprint(changed))
    at = text.index("Paragraph 17")
    assert spans and all(at <= a < b <= at + 80 for a, b in spans)
    assert any(a <= at + 13 < b for a, b in spans)
    assert merkle.edited_stretches(merkle.fingerprint(text), merkle.fingerprint(text)) == []


def test_likeness_bounds():
    a, b = merkle.fingerprint("Some text. " * 30), merkle.fingerprint("Another one! " * 30)
    assert merkle.likeness(a, a) == 1 and merkle.likeness(a, b) == 0
    assert merkle.likeness(merkle.fingerprint(""), a) == 0
    assert merkle.likeness(merkle.fingerprint(""), merkle.fingerprint("")) == 1


def expected_fingerprints(rows):
    """(doc_id, n, sha, near_next) as a sorted list, by brute force."""
    rows = [(i, t or "") for i, t in rows]
    order = sorted({i for i, _ in rows}, key=lambda i: (i is not None, i))
    tie = {}
    for i, t in rows:
        h = int.from_bytes(xxhash.xxh64_digest(t.encode(), seed=42), "big")
        h = h - (1 << 64) if h >= 1 << 63 else h
        tie[i] = min(tie.get(i, (h, t)), (h, t))
    out = []
    for i, t in rows:
        n = tie[order[(order.index(i) + 1) % len(order)]][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + n[:half]
        out.append((str(i), len(t), hashlib.sha256(edited.encode()).hexdigest(), merkle.fingerprint(t), merkle.fingerprint(edited)))
    return sorted(out)


def got_fingerprints(df):
    return sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) for r in df.collect())


SCHEMA = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def test_next_document_of_awkward_rows(awkward, empty, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_ROWS", 5)
    rows = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    df = merkle.with_next_document(awkward, merkle._edit_row, SCHEMA)
    assert got_fingerprints(df) == expected_fingerprints(rows)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in df.collect())
    assert merkle.with_next_document(empty, merkle._edit_row, SCHEMA).count() == 0


def test_one_document_is_its_own_next(spark):
    docs = spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")
    (r,) = merkle.with_next_document(docs, merkle._edit_row, SCHEMA).collect()
    assert r["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest() and r["near_next"] == 1


def test_query_of_fingerprints(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert got_fingerprints(merkle.fingerprints_of_documents(spark, SF)) == expected_fingerprints(rows)


# ---- SimHash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in ids:
        for j in ids:
            if i < j and bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in ids}


def test_query_of_simhash(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {i: plain_fingerprint(t) for i, t in docs.items()}
    roots = plain_components(prints, 2)
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in simhash.simhash_of_documents(spark, SF).collect()}
    assert got == {i: (prints[i], roots[i]) for i in docs}


def test_links_connect_all_pairs_within_the_radius(spark):
    rng = random.Random(5)
    values = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(12):
            base ^= 1 << rng.randrange(64)
            values.add(base ^ (1 << rng.randrange(64)))
    signed = [v - (1 << 64) if v >= 1 << 63 else v for v in values]
    for radius in (0, 2):
        links = simhash.linked_fingerprints(spark.createDataFrame([(v,) for v in signed], "fingerprint long"), radius)
        pairs = links.collect()
        assert all(bin((r["a"] ^ r["b"]) & (1 << 64) - 1).count("1") <= radius for r in pairs)
        roots = {r["node"]: r["root"] for r in connected_components(links).collect()}
        want = plain_components({v: v & (1 << 64) - 1 for v in signed}, radius)
        assert {v: roots.get(v, v) for v in signed} == want
    with pytest.raises(ValueError):
        simhash.linked_fingerprints(links.select(F.col("a").alias("fingerprint")), 3)


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(300)]
    star = [(1000, 1000 + k) for k in range(1, 300)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame([*chain, *star, (5000, 5000)], "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(301)}, **{1000 + k: 1000 for k in range(300)}}


def test_simhash_of_awkward_rows(awkward, empty):
    groups = simhash.near_duplicate_groups(awkward).collect()
    assert len(groups) == awkward.count()
    by_id = {r["doc_id"]: r for r in groups if r["doc_id"] is not None}
    assert {by_id[i]["fingerprint"] for i in (2, 3, 4)} == {0} and {by_id[i]["component_id"] for i in (2, 3, 4)} == {2}
    assert all(by_id[100 + k]["component_id"] == 100 for k in range(40))
    kept = simhash.without_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert ids == sorted({r["component_id"] for r in groups if r["component_id"] is not None})
    assert simhash.near_duplicate_groups(empty).count() == 0 and simhash.without_near_duplicates(empty).count() == 0


def test_long_texts_are_hashed_whole():
    text = " ".join(map(str, range(200_000)))
    hashes = simhash.shingle_hashes(text)
    assert len(hashes) == 199_998
    assert int(hashes[-1]) == xxhash.xxh64_intdigest(b"199997 199998 199999", seed=42)
    bits = ((hashes[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).sum(axis=0)
    assert simhash.fingerprint(text) & (1 << 64) - 1 == sum(1 << b for b in range(64) if 2 * int(bits[b]) > len(hashes))
