"""Mixing sources to target weights by a low-discrepancy schedule.

Slot i of the mix gets the point frac(i * golden ratio), in 32-bit integers, and the source whose
interval of cumulative target shares holds that point. The slots of a source are ranked, and rank r
takes the r-th block of ``BLOCK`` words of that source, whose documents stand one after another in a
shuffled order (by MD5 of id and text), twice over: the second pass follows the first without a gap. A source has as many
slots as its target, to the nearest word, needs, the last one a part of a block: slots beyond that stay empty, and the few that the points
leave it short of, none of them in doubt as the points are known, come at the end of the mix. So every source meets its target to the word, at any size.

Everything is a DataFrame expression. Positions and ranks are prefix sums over counts of cells plus a
numbering inside a cell, so a source with a third of all rows is spread over ``CELLS`` tasks; rows that agree in id, source and text
are counted before that and stand beside each other. The list
of sources with their sums is the only thing that one task sees whole: one row per source.

Null sources are a source of their own, last. Null and empty texts have size 0 and take 0. Repeated
rows count each time. Ids may be null. An empty table gives no rows; if no document has a word all
targets are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.registry import query, table
from rivulet.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: The mix has this share of all words, and a source at most this many times its own.
SHARE_NUM, SHARE_DEN = 3, 2
PASSES = 2
#: Words of a slot.
BLOCK = 256
#: 2^32 divided by the golden ratio, and 2^32.
GOLDEN, CIRCLE = 2654435769, 1 << 32
#: Points, slots and documents of a source are dealt out in so many cells.
CELLS = 4096


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _order_key(doc_id: Column, text: Column) -> Column:
    """A shuffled order; the text parts rows that share an id or have none."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))).cast("binary"))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per source: ``sid`` (place by code point, null last), size, target, quota (words it takes), need (its slots) and cumulative points.

    Filling to a common level: sources in the order of the level at which they are full; before each one,
    the level is (all - full ones) / (weights left), and the true level is the largest of these.
    """
    everything = Window.partitionBy()
    upwards = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    sums = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    ranked = (
        sums.withColumn("sid", F.row_number().over(upwards) - 1)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * PASSES)
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(SHARE_NUM)) / F.lit(float(SHARE_DEN)))
    )
    levels = ranked.withColumn(
        "level_here",
        (F.col("total") - F.coalesce(F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        / F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing)),
    ).withColumn("level", F.max("level_here").over(everything))
    needs = (
        levels.withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")))
        .withColumn("quota", F.floor(F.col("target") + 0.5))
        .withColumn("need", F.expr(f"(quota + {BLOCK - 1}) div {BLOCK}"))
        .withColumn("slots", F.sum("need").over(everything))
    )
    shares = needs.withColumn("points", F.when(F.col("slots") > 0, F.floor(F.col("need") / F.col("slots") * CIRCLE)).otherwise(0))
    last = F.row_number().over(Window.orderBy(F.col("sid").desc())) == 1
    return (
        shares.withColumn("to", F.sum("points").over(Window.orderBy("sid")))
        .withColumn("from", F.col("to") - F.col("points"))
        .withColumn("to", F.when(last, F.lit(CIRCLE)).otherwise(F.col("to")))
        .select("sid", "source", "source_size", "target", "quota", "need", "from", "to", "slots")
    )


def schedule(targets: DataFrame) -> DataFrame:
    """The slots in order: slot, sid, rank among the source's slots, each source having as many as it needs."""
    width = CIRCLE // CELLS
    slots = (
        targets.agg(F.coalesce(F.max("slots"), F.lit(0)).alias("slots"))
        .filter("slots > 0")
        .select(F.explode(F.sequence(F.lit(0), F.expr(f"(slots - 1) div {CELLS}"))).alias("chunk"), "slots")
        .repartition(F.col("chunk"))
        .select("chunk", F.explode(F.sequence(F.col("chunk") * CELLS, F.least((F.col("chunk") + 1) * CELLS, "slots") - 1)).alias("slot"))
        .withColumn("point", F.col("slot") * GOLDEN % CIRCLE)
        .withColumn("cell", F.expr(f"point div {width}"))
    )
    spans = targets.filter(F.col("to") > F.col("from")).select(
        "sid", "from", "to", F.explode(F.sequence(F.expr(f"`from` div {width}"), F.expr(f"(`to` - 1) div {width}"))).alias("cell")
    )
    taken = materialize(
        slots.join(spans, "cell").filter((F.col("point") >= F.col("from")) & (F.col("point") < F.col("to"))).select("chunk", "slot", "sid"), "taken-slots"
    )
    counts = materialize(taken.groupBy("sid", "chunk").agg(F.count(F.lit(1)).alias("n")), "slot-counts")
    before = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("sid", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("sid", "chunk").orderBy("slot")
    needs = targets.select("sid", "need", "slots")
    ranked = (
        taken.withColumn("nth", F.row_number().over(inside))
        .join(firsts, ["sid", "chunk"])
        .withColumn("rank", F.col("first") + F.col("nth") - 1)
        .join(needs, "sid")
        .filter(F.col("rank") < F.col("need"))
        .select("slot", "sid", "rank")
    )
    # what the points leave a source short of, a few slots at most
    short = (
        needs.join(counts.groupBy("sid").agg(F.sum("n").alias("had")), "sid", "left")
        .withColumn("had", F.coalesce("had", F.lit(0)))
        .withColumn("short", F.greatest(F.col("need") - F.col("had"), F.lit(0)))
        .withColumn("after", F.col("slots") + F.sum("short").over(Window.orderBy("sid")) - F.col("short"))
        .filter("short > 0")
        .select("sid", "had", "after", F.explode(F.sequence(F.lit(0).cast("long"), F.col("short") - 1)).alias("more"))
    )
    return ranked.unionByName(short.select((F.col("after") + F.col("more")).alias("slot"), "sid", (F.col("had") + F.col("more")).alias("rank")))


def place_documents(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``sized``, one row per document, with the columns of ``targets`` (its source there is ``its``), the first word's place in
    the source and a row key (sid, cell, nth, copy)."""
    keyed = sized.join(targets, F.col("source").eqNullSafe(F.col("its"))).drop("its").withColumn("cell", F.conv(F.substring("key", 1, 3), 16, 10).cast("int"))
    words = F.col("size") * F.col("rows")
    inside = Window.partitionBy("sid", "cell").orderBy("key", "size")
    before = Window.partitionBy("sid").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = keyed.groupBy("sid", "cell").agg(F.sum(words).alias("words")).select("sid", "cell", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    return (
        keyed.withColumn("nth", F.row_number().over(inside))
        .withColumn("upto", F.sum(words).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .join(cells, ["sid", "cell"])
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)))
        .withColumn("start", F.col("base") + F.col("upto") - words + F.col("copy") * F.col("size"))
        .drop("base", "upto", "rows")
    )


def sized_documents(docs: DataFrame, *carried: Column) -> DataFrame:
    """doc_id, source, size, key, ``carried`` and the number of rows that agree in all of these."""
    rows = docs.select("doc_id", "source", words_in(F.col("text")).alias("size"), _order_key(F.col("doc_id"), F.col("text")).alias("key"), *carried)
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("rows"))


def mix(sized: DataFrame) -> DataFrame:
    """Every document's share of each slot: the columns of ``place_documents``, pass_, slot, ``from_word``, ``words``.

    ``sized`` has doc_id, source, size, key and rows. A document that no slot takes comes out once with a null
    slot and 0 words. Slots read in order give the mix; ``from_word`` counts from the document's first word.
    """
    targets = materialize(source_targets(sized), "targets")
    slots = materialize(schedule(targets), "slots")
    placed = place_documents(sized, targets.select("sid", F.col("source").alias("its"), "source_size", "target", "quota"))
    passes = (
        placed.withColumn("pass_", F.explode(F.sequence(F.lit(0), F.lit(PASSES - 1))))
        .withColumn("at", F.col("start") + F.col("pass_") * F.col("source_size"))
        .withColumn("end", F.least(F.col("at") + F.col("size"), F.col("quota")))
    )
    blocks = F.when(F.col("at") < F.col("end"), F.sequence(F.expr(f"`at` div {BLOCK}"), F.expr(f"(`end` - 1) div {BLOCK}")))
    pieces = (
        passes.withColumn("rank", F.explode_outer(blocks))
        .filter(F.col("rank").isNotNull() | (F.col("pass_") == 0))
        .withColumn("from_word", F.when(F.col("rank").isNotNull(), F.greatest("at", F.col("rank") * BLOCK) - F.col("at")))
        .withColumn("words", F.when(F.col("rank").isNotNull(), F.least("end", (F.col("rank") + 1) * BLOCK) - F.col("at") - F.col("from_word")).otherwise(0))
        .drop("at", "end", "quota")
    )
    return pieces.join(slots, ["sid", "rank"], "left")


#: What tells a document's row from others of its source.
ROW = ("sid", "cell", "nth", "copy")


def taken_words(docs: DataFrame, *carried: Column) -> DataFrame:
    """One row per document: doc_id, source, key, size, ``carried``, source_size, target, taken."""
    sized = materialize(sized_documents(docs, *carried), "sized")
    columns = [c for c in sized.columns if c != "rows"]
    return mix(sized).groupBy(*ROW, *columns, "source_size", "target").agg(F.sum("words").alias("taken")).drop(*ROW)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents as the mix takes them, in its order: each as many times as its words are taken, to the nearest whole number.

    Only a source's last document is cut by the end of its quota, so only that one is rounded; documents without a word
    are not taken. A document stands where the first of its slots does, and again where its second pass begins. Rows that agree in all
    columns are one row with a count until the end; rows that differ in any keep their own columns.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    row = F.sha2(F.to_json(F.struct(*others, F.md5(F.col("text").cast("binary")).alias("text")), {"ignoreNullFields": "false"}), 256)
    sized = materialize(sized_documents(docs, row.alias("row")), "sized")
    places = (
        mix(sized)
        .groupBy(*ROW, "row", "size", "pass_")
        .agg(F.sum("words").alias("words"), F.min("slot").alias("__slot"))
        .filter((F.col("size") > 0) & (2 * F.col("words") >= F.col("size")))
        .select(F.col("row").alias("__row"), "__slot")
    )
    return (
        docs.withColumn("__row", row)
        .dropDuplicates(["__row"])
        .join(places, "__row")
        .repartitionByRange("__slot", "__row")
        .sortWithinPartitions("__slot", "__row")
        .select(*docs.columns)
    )


#: The same mix in SQL.
MIX_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size, row_number() OVER () AS row_id,
    md5(coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))) AS key FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS sid FROM sized GROUP BY source),
ranked AS (SELECT *, CASE sid % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * {PASSES} AS cap,
    (sum(source_size) OVER ())::BIGINT * {SHARE_NUM}.0::DOUBLE / {SHARE_DEN}.0::DOUBLE AS total FROM sums),
levels AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
    / (sum(weight) OVER (ORDER BY cap / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level_here FROM ranked),
targets AS (SELECT *, floor(target + 0.5)::BIGINT AS quota FROM (SELECT *, least(cap::DOUBLE, weight * level) AS target
    FROM (SELECT *, max(level_here) OVER () AS level FROM levels))),
placed AS (SELECT d.*, s.source_size, s.target, s.quota,
    (sum(size) OVER (PARTITION BY s.sid ORDER BY key, size, row_id ROWS UNBOUNDED PRECEDING))::BIGINT - size AS start
  FROM sized d JOIN targets s ON d.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
  (greatest(least(start + size, quota) - start, 0) + greatest(least(start + source_size + size, quota) - start - source_size, 0))::BIGINT AS taken
FROM placed
"""


@query("op5_mixing", MIX_SQL)
def mixing_of_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return taken_words(docs).select("doc_id", "size", "source_size", "target", "taken")
