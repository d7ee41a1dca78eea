"""Filter audit: SQL, filters applied one after another in Python, and potentials against all orders."""

import random
import re
from itertools import permutations

from pyspark.sql import functions as F

from check import compare, duck
from rivulet.llm import filteraudit

SF = "/root/testdata/sf0.001"
LABELS = "doc_id long, quality long, toxic long, part string, failed string"


def plain_fails(rows):
    """Bits of every (doc_id, text) row."""
    out = []
    for doc_id, text in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        same = [i for i, t in rows if (t or "") == text and i is not None]
        copy = doc_id is not None and any(i < doc_id for i in same)
        fails = [
            len(words) < 50,
            100 * len(set(words)) < 65 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            bool(re.search("[#$%&*|]", text)),
            copy,
        ]
        out.append(sum(1 << k for k, f in enumerate(fails) if f))
    return out


def plain_audit(rows, labels):
    """All steps of (doc_id, text, source) rows, each filter applied to what is left."""
    bits = plain_fails([(i, t) for i, t, _ in rows])
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out = {}
    for part in {s or "" for _, _, s in rows}:
        mine = [(b, i) for b, (i, _, s) in zip(bits, rows) if (s or "") == part]
        sums = dict.fromkeys("ABCDE", 0)
        steps = []
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                bit = 1 << "ABCDE".index(f)
                gone = [x for x in left if x[0] & bit]
                left = [x for x in left if not x[0] & bit]
                sums[f] += len(gone)
                steps.append(
                    (part, "".join(order), step, len(left), len(gone), sum(bool(b & bit) for b, _ in mine) - len(gone), sum(b == bit for b, _ in mine),
                     sum(i in good for _, i in gone), sum(i in toxic for _, i in gone))
                )
        out.update({s[:3]: (*s, sums[s[1][s[2] - 1]]) for s in steps})
    return set(out.values())


def test_audit_equals_its_sql(spark):
    assert compare(spark, duck(SF), SF, filteraudit.audit_of_documents, filteraudit.AUDIT_SQL).startswith("ok")


def test_audit_of_awkward_rows(spark, awkward, empty):
    labels = [(1, 1, 0), (1, 0, 1), (6, 1, None), (7, None, 1), (7, 0, 1), (None, 1, 1), (103, 1, 1), (9999, 1, 1)]
    given = spark.createDataFrame([(*r, "p", "f") for r in labels], LABELS)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in awkward.collect()]
    got = filteraudit.filter_audit(awkward, given).collect()
    assert len(got) == 600 * len({r[2] or "" for r in rows})
    assert set(map(tuple, got)) == plain_audit(rows, labels)
    assert filteraudit.filter_audit(empty, given).count() == 0
    unlabelled = filteraudit.filter_audit(awkward, given.limit(0)).agg(F.sum("good_lost"), F.sum("toxic_lost")).first()
    assert tuple(unlabelled) == (0, 0)


def test_audit_of_texts_at_the_thresholds(spark):
    words = [f"w{k}" for k in range(100)]
    texts = [
        " ".join(words[:50]),
        " ".join(words[:49]),
        " ".join(words[:65] + words[:35]),
        " ".join(words[:64] + words[:36]),
        "A" * 5 + "b" * 95,
        "A" * 6 + "b" * 94,
        "É" * 50,
        " ".join(words[:50]) + " #",
        " ".join(words[:50]),
        "|",
    ]
    rows = [(k // 2 * 2, t, "s" if k % 3 else None) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([], LABELS)
    assert set(map(tuple, filteraudit.filter_audit(docs, labels).collect())) == plain_audit(rows, [])


def test_potentials_give_the_mean_over_all_orders(spark):
    rng = random.Random(4)
    games = [[0, *[rng.randrange(10**12) for _ in range(31)]] for _ in range(20)]
    table = spark.createDataFrame([(g,) for g in games], "worths array<long>")
    shapley, potentials = filteraudit.shapley_values(F.col("worths")), filteraudit.scaled_potentials(F.col("worths"))
    for row in table.select("worths", shapley.alias("s"), potentials.alias("p")).collect():
        sums = [0] * 5
        for order in permutations(range(5)):
            before = 0
            for k in order:
                sums[k] += row["worths"][before | 1 << k] - row["worths"][before]
                before |= 1 << k
        assert row["s"] == sums
        assert sum(sums) == 120 * row["worths"][31]
        for mask in range(1, 32):
            members = [k for k in range(5) if mask >> k & 1]
            assert row["p"][mask] * len(members) == 120 * row["worths"][mask] + sum(row["p"][mask & ~(1 << k)] for k in members)


def test_an_audit_writes_nothing_on_the_way(spark):
    """Each file that a task writes to a local folder starts processes beside the executor."""
    import os

    from rivulet.session import shared_folder

    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "a b", "x"), (3, None, None), (None, "a b", "x")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality long, toxic long")
    audited = filteraudit.audited_documents(docs, labels)
    e = {(r["doc_id"], r["part"]): r["failed"] >> 4 for r in audited.collect()}
    assert e == {(1, "x"): 0, (2, "x"): 1, (3, ""): 0, (None, "x"): 0}
    assert (set(os.listdir(folder)) if os.path.isdir(folder) else set()) == before
