"""Mixing and sharding: SQL, brute force and awkward rows."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from check import compare, duck
from rivulet.llm import mixing, sharding

SF = "/root/testdata/sf0.001"


def test_mixing_equals_its_sql(spark):
    assert compare(spark, duck(SF), SF, mixing.mixing_of_documents, mixing.MIX_SQL).startswith("ok")


def plain_targets(sizes):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, full, left = {}, set(), 1.5 * sum(sizes.values())
    while True:
        rest = [s for s in order if s not in full]
        level = (left - sum(2 * sizes[s] for s in full)) / max(1, sum(weight[s] for s in rest))
        over = [s for s in rest if weight[s] * level > 2 * sizes[s]]
        if not over:
            break
        full.update(over)
    return {s: 2 * sizes[s] if s in full else weight[s] * level for s in order}


def test_mixing_of_awkward_rows(awkward, empty):
    rows = mixing.taken_words(awkward).collect()
    assert len(rows) == awkward.count()
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    want = plain_targets(sizes)
    for source, target in want.items():
        mine = [r for r in rows if r["source"] == source]
        assert all(abs(r["target"] - target) < 1e-6 * max(1, target) and r["source_size"] == sizes[source] for r in mine)
        assert sum(r["taken"] for r in mine) == int(target + 0.5)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert mixing.taken_words(empty).count() == 0


def test_slots_and_pieces_fit_together(awkward):
    sized = mixing.sized_documents(awkward)
    pieces = mixing.mix(sized).filter("slot is not null").collect()
    per_slot = {}
    for r in pieces:
        assert 0 <= r["from_word"] and r["from_word"] + r["words"] <= r["size"]
        per_slot.setdefault(r["slot"], []).append(r)
    assert all(len({(r["sid"], r["rank"]) for r in rows}) == 1 for rows in per_slot.values())
    filled = {(rows[0]["sid"], rows[0]["rank"]): sum(r["words"] for r in rows) for rows in per_slot.values()}
    for sid in {s for s, _ in filled}:
        mine = [filled[k] for k in sorted(filled) if k[0] == sid]
        # no rank is missing, and only the last block is a part
        assert sorted(r for s, r in filled if s == sid) == list(range(len(mine)))
        assert all(n == mixing.BLOCK for n in mine[:-1]) and 0 < mine[-1] <= mixing.BLOCK


def test_points_spread_every_source_evenly(spark):
    sizes = [("a", 40_000), ("b", 9_000), ("c", 2_500), ("d", 700), ("e", 30), (None, 1)]
    sized = spark.createDataFrame([(k, s, n, f"{k:03x}", 1) for k, (s, n) in enumerate(sizes)], "doc_id long, source string, size long, key string, rows long")
    targets = mixing.source_targets(sized)
    rows = mixing.schedule(targets).collect()
    needs = {r["sid"]: r["need"] for r in targets.collect()}
    assert len({r["slot"] for r in rows}) == len(rows) == sum(needs.values())
    for sid, need in needs.items():
        mine = sorted((r["slot"], r["rank"]) for r in rows if r["sid"] == sid)
        assert [r for _, r in mine] == list(range(need))
        # the r-th slot stands near r / need of the way
        assert all(abs(slot / len(rows) * need - rank) < 4 for slot, rank in mine)


def test_mix_without_words_or_rows(spark, empty):
    none = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r["taken"], r["target"]) for r in mixing.taken_words(none).collect()] == [(0, 0.0), (0, 0.0)]
    assert mixing.mixed_documents(empty).count() == 0


def test_mixed_documents_come_as_often_as_taken(awkward):
    mixed = mixing.mixed_documents(awkward)
    assert mixed.columns == awkward.columns
    words = mixed.groupBy("source").agg(F.sum(mixing.words_in(F.col("text"))).alias("n")).collect()
    got = {r["source"]: r["n"] for r in words}
    sizes = {r["source"]: r["n"] for r in awkward.groupBy("source").agg(F.sum(mixing.words_in(F.col("text"))).alias("n")).collect()}
    longest = {r["source"]: r["n"] for r in awkward.groupBy("source").agg(F.max(mixing.words_in(F.col("text"))).alias("n")).collect()}
    for source, target in plain_targets(sizes).items():
        assert abs(got.get(source, 0) - target) <= longest[source]


def test_small_sources_in_a_large_total(spark):
    big = spark.range(1000).selectExpr("id doc_id", "repeat('w ', 100000) text", "'en' lang", "'a big' source")
    small = [(2000 + k, "w " * 12, "en", "b small") for k in range(10)] + [(9000 + k, "w " * 3, "en", "c tiny") for k in range(9)] + [(9999, "w", "en", None)]
    docs = big.unionByName(spark.createDataFrame(small, "doc_id long, text string, lang string, source string"))
    rows = mixing.taken_words(docs).groupBy("source", "source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    targets = plain_targets({"a big": 100_000_000, "b small": 120, "c tiny": 27, None: 1})
    assert {r["source"]: r["taken"] for r in rows} == {s: int(t + 0.5) for s, t in targets.items()}
    words = mixing.mixed_documents(docs).groupBy("source").agg(F.sum(mixing.words_in(F.col("text"))).alias("n")).collect()
    assert {r["source"]: r["n"] for r in words if r["source"] != "a big"} == {"b small": 240, "c tiny": 54, None: 2}


def test_rows_keep_their_own_columns(spark):
    rows = [(1, "same text", "en", "a"), (1, "same text", "de", "a"), (1, "same text", None, "a"), (2, "other", "en", "a"), (2, "other", "en", "a")]
    rows += [(None, f"null {k}", "en", None) for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    mixed = [tuple(r) for r in mixing.mixed_documents(docs).collect()]
    assert set(mixed) <= set(rows)
    assert {r[2] for r in mixed if r[0] == 1} == {"en", "de", None}
    assert all(1 <= mixed.count(r) <= 2 * rows.count(r) for r in rows)


def test_the_mix_has_an_order(spark):
    sources = ["a", "b", "c"]
    docs = spark.createDataFrame([(k, f"{k} " * 300, "en", sources[k % 3]) for k in range(1500)], "doc_id long, text string, lang string, source string")
    mixed = [r["source"] for r in mixing.mixed_documents(docs).collect()]
    shares = {s: mixed.count(s) / len(mixed) for s in sources}
    for at in range(0, len(mixed) - 300, 300):
        assert all(abs(mixed[at : at + 300].count(s) / 300 - shares[s]) < 0.05 for s in sources)


def test_repeated_rows_count_each(spark):
    docs = spark.createDataFrame([(1, "a b c", "en", "x")] * 500 + [(2, "d e", "en", "y")], "doc_id long, text string, lang string, source string")
    rows = mixing.taken_words(docs).collect()
    assert len(rows) == 501
    for source, target in plain_targets({"x": 1500, "y": 2}).items():
        assert sum(r["taken"] for r in rows if r["source"] == source) == int(target + 0.5)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)


# ---- shards


def least_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, n, fill = (low + high) // 2, 1, 0
        for s in sizes:
            n, fill = (n, fill + s) if fill + s <= middle else (n + 1, s)
        low, high = (low, middle) if n <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize("seed, bits, most", [(0, 14, 1 << 14), (1, 3, 40), (2, 2, 8), (3, 5, 1000), (4, 1, 4), (5, 4, 64)])
def test_no_contiguous_partition_of_groups_is_better(spark, seed, bits, most):
    rng = random.Random(seed)
    texts = ["x" * rng.randrange(1, 200) + str(k) for k in range(400)] + ["hot" * 50] * rng.choice([0, 5, 60, 300])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = docs.groupBy(sharding.hash_of(F.col("text")).alias("h")).agg(F.sum(sharding.size_of(F.col("text"))).alias("n")).orderBy("h").collect()
    cuts = sharding.minimax_cuts(docs, sharding.SHARDS, bits, most)
    # few bits leave few places for cuts where the capacity asks for none
    assert cuts == sorted(set(cuts)) and (len(cuts) == 15 if bits == sharding.BIN_BITS else len(cuts) <= 15)
    sums = [0] * 16
    for g in groups:
        sums[sum(c <= g["h"] for c in cuts)] += g["n"]
    assert max(sums) == least_capacity([g["n"] for g in groups], sharding.SHARDS)
    out = sharding.assign_shards(docs).withColumn("n", sharding.size_of(F.col("text"))).groupBy("shard").agg(F.sum("n").alias("n")).collect()
    assert max(r["n"] for r in out) == max(sums) and (len(out) == 16 or bits < sharding.BIN_BITS)


def check_shards(rows):
    by_shard, of_text = {}, {}
    for r in rows:
        assert 0 <= r["shard"] < 16
        by_shard.setdefault(r["shard"], []).append(r["slot"])
        of_text.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert all(len(s) == 1 for s in of_text.values())


def test_query_of_shards(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = sharding.shards_of_documents(spark, SF).collect()
    check_shards(rows)
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in rows} == {(i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in docs.items()}
    sums = {}
    for r in rows:
        sums[r["shard"]] = sums.get(r["shard"], 0) + r["size"]
    assert len(sums) == 16 and max(sums.values()) <= sum(sums.values()) / 16 + max(r["size"] for r in rows)


def test_shards_of_awkward_rows(awkward, empty):
    shards = sharding.assign_shards(awkward)
    rows = [
        {"shard": r["shard"], "slot": r["slot"], "size": len((r["text"] or "").encode()) + 1, "text_crc32": zlib.crc32((r["text"] or "").encode())}
        for r in shards.collect()
    ]
    assert len(rows) == awkward.count()
    check_shards(rows)
    assert sharding.assign_shards(empty).count() == 0


def test_native_plans_have_no_python(awkward):
    for df in (sharding.assign_shards(awkward), mixing.taken_words(awkward), mixing.mixed_documents(awkward)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
