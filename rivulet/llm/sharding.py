"""Shards of near equal bytes by a minimax contiguous partition.

Equal texts form an atomic group. Groups are ordered by the hash of their text and never split. The
smallest capacity that lets ``shards`` contiguous runs of groups hold everything is found by binary
search with a greedy check. The cuts are then taken within that capacity, each as near as possible to
an even share of what is left, and never so early that the rest would not fit any more.

The search runs over units, ranges of hashes that hold one or many groups. At first these are ``2 ** BIN_BITS`` bins. Their capacity is an
upper bound of that of the groups, and it less the largest unit in question a lower bound; between these bounds the greedy check can only
cut inside few units. Those are divided further, until all that may be cut are single groups: so the capacity is that of the groups, while no
step holds more than some thousand units, whatever the number of groups.

Everything is a DataFrame or SQL expression; texts are never moved. Numbering inside a shard is dealt by (bin, salt of the id), so a group of copies
with a third of all rows is numbered in many tasks; the first numbers come from prefix sums of counts.

Null and empty texts are one group of size 1 per row. Null ids are allowed and repeated rows each
get their own slot; rows equal in id and text are interchangeable. An empty table gives no rows.
A group larger than an even share gets a shard that is larger than the others: groups never split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.registry import query, table
from rivulet.session import materialize

SHARDS = 16
#: Bits of the hash that name a bin, and units at most that a step adds.
BIN_BITS = 14
MOST_UNITS = 1 << 14
#: Parts of a bin that are numbered apart.
SALTS = 64

_SHARDS_NEEDED = """
aggregate(units, named_struct('n', 1, 'fill', 0L), (s, u) ->
  if(s.fill + u.bytes <= {capacity}, named_struct('n', s.n, 'fill', s.fill + u.bytes),
     named_struct('n', s.n + 1, 'fill', u.bytes))).n
"""

_CAPACITY = """
aggregate(sequence(0, 64), named_struct('low', low, 'high', low + largest), (c, step) ->
  if(c.low >= c.high, c,
     if({needed} <= {shards}, named_struct('low', c.low, 'high', c.low + (c.high - c.low) div 2),
        named_struct('low', c.low + (c.high - c.low) div 2 + 1, 'high', c.high)))).low
"""

# first bins of the shards when they are filled from the end: no shard may start earlier
_EARLIEST = """
aggregate(reverse(units), named_struct('starts', array(CAST(NULL AS BIGINT)), 'at', CAST(NULL AS BIGINT), 'fill', 0L), (s, u) ->
  if(s.fill + u.bytes <= capacity, named_struct('starts', s.starts, 'at', u.first, 'fill', s.fill + u.bytes),
     named_struct('starts', array_append(s.starts, s.at), 'at', u.first, 'fill', u.bytes))).starts
"""

_CUTS = """
aggregate(units, named_struct('cuts', slice(array(0L), 1, 0), 'fill', 0L, 'left', total), (s, u) ->
  if(s.fill > 0 and size(s.cuts) < {last}
     and u.first >= coalesce(try_element_at(earliest, {last} - size(s.cuts) + 1), CAST('-9223372036854775808' AS BIGINT))
     and (s.fill + u.bytes > capacity or (2 * s.fill + u.bytes) * ({shards} - size(s.cuts)) > 2 * s.left),
     named_struct('cuts', array_append(s.cuts, u.first), 'fill', u.bytes, 'left', s.left - s.fill),
     named_struct('cuts', s.cuts, 'fill', s.fill + u.bytes, 'left', s.left))).cuts
"""


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def hash_of(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def prefix(hashed: Column, bits: int) -> Column:
    """The first ``bits`` bits, in the order of the hashes."""
    return F.shiftright(hashed, 64 - bits)


# first units that the greedy check can cut at the soonest: every shard takes whole units up to the lower bound
_SOONEST = """
aggregate(units, named_struct('cuts', slice(array(0), 1, 0), 'fill', 0L, 'i', 0), (s, u) ->
  if(s.fill + u.bytes <= low, named_struct('cuts', s.cuts, 'fill', s.fill + u.bytes, 'i', s.i + 1),
     named_struct('cuts', array_append(s.cuts, s.i), 'fill', u.bytes, 'i', s.i + 1))).cuts
"""

# units before which it has cut at the latest: every shard takes whole units up to the upper bound and the next one
_LATEST = """
aggregate(units, named_struct('cuts', slice(array(0), 1, 0), 'fill', 0L, 'i', 0), (s, u) ->
  if(s.fill + u.bytes <= capacity, named_struct('cuts', s.cuts, 'fill', s.fill + u.bytes, 'i', s.i + 1),
     named_struct('cuts', array_append(s.cuts, s.i + 1), 'fill', 0L, 'i', s.i + 1))).cuts
"""

# units in question: any larger than the lower bound first, else those between the soonest and the latest cut
_IN_QUESTION = """
transform(units, (u, i) -> low < capacity and if(any_larger, u.bytes > low and u.groups > 1,
  exists(sequence(0, {shards} - 2), k -> i >= coalesce(get(soonest, k), size(units)) and i < coalesce(get(latest, k), size(units)))))
"""


def _bounded(groups: DataFrame, units: DataFrame, shards: int) -> DataFrame:
    """One row: units (first, bytes, groups) in order, total, low (no capacity is lower), capacity (that of the units), in_question."""
    largest_group = groups.agg(F.coalesce(F.max("bytes"), F.lit(0))).scalar()
    # each step is written, one row, so that no later expression repeats an earlier one
    row = materialize(
        units.agg(
            F.array_sort(F.collect_list(F.struct("first", "bytes", "groups"))).alias("units"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("total"),
            F.coalesce(F.max("bytes"), F.lit(0)).alias("largest"),
            F.coalesce(F.max(F.when(F.col("groups") > 1, F.col("bytes"))), F.lit(0)).alias("divisible"),
        ).withColumn("least", F.greatest(largest_group, F.expr(f"(total + {shards - 1}) div {shards}"))),
        "shard-units",
    )
    needed = _SHARDS_NEEDED.format(capacity="(c.low + (c.high - c.low) div 2)")
    search = row.withColumn("low", F.greatest("least", "largest"))
    sized = materialize(search.withColumn("capacity", F.expr(_CAPACITY.format(needed=needed, shards=shards))), "shard-capacity")
    # groups that fit a capacity fit as whole units if each shard may take one unit more
    low = sized.withColumn("low", F.greatest("least", F.col("capacity") - F.col("divisible")))
    larger = F.exists("units", lambda u: (u["bytes"] > F.col("low")) & (u["groups"] > 1))
    walked = materialize(low.withColumns({"soonest": F.expr(_SOONEST), "latest": F.expr(_LATEST), "any_larger": larger}), "shard-walks")
    return materialize(walked.withColumn("in_question", F.expr(_IN_QUESTION.format(shards=shards))), "shard-bounds")


def minimax_cuts(docs: DataFrame, shards: int = SHARDS, bits: int = BIN_BITS, most_units: int = MOST_UNITS) -> list[int]:
    """The first hash of every shard but the first; runs jobs, the first of which reads the texts once."""
    groups = materialize(docs.groupBy(hash_of(F.col("text")).alias("hash")).agg(F.sum(size_of(F.col("text"))).alias("bytes")), "shard-groups")
    facts = [F.min("hash").alias("first"), F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("groups")]
    units = groups.groupBy(prefix(F.col("hash"), bits)).agg(*facts).select("first", "bytes", "groups")
    while True:
        bounded = _bounded(groups, units, shards)
        every = bounded.select(F.posexplode("units").alias("i", "u"), "in_question").select("i", "u.*", F.get("in_question", F.col("i")).alias("in_question"))
        open_units = every.filter("in_question AND groups > 1").agg(F.count(F.lit(1)).alias("n"), F.sum("groups").alias("groups")).first()
        if not open_units["n"]:
            break
        # runs of units in question, each from its first hash up to that of the unit after it: a few for every cut
        after = Window.orderBy("i")
        runs = (
            every.withColumn("next", F.lead("first").over(after))
            .withColumn("before", F.coalesce(F.lag("in_question").over(after), F.lit(False)))
            .withColumn("run", F.sum(F.when(F.col("in_question") & ~F.col("before"), 1).otherwise(0)).over(after))
            .filter("in_question")
            .groupBy("run")
            .agg(F.min("first").alias("first"), F.max(F.struct("i", "next"))["next"].alias("end"))
            .collect()
        )
        inside = F.lit(False)
        for run in runs:
            inside = inside | ((F.col("hash") >= run["first"]) & (F.lit(True) if run["end"] is None else F.col("hash") < run["end"]))
        if open_units["groups"] <= most_units:
            bits = 64
        else:
            bits = min(64, bits + max(1, (most_units // open_units["n"]).bit_length() - 1))
        finer = groups.filter(inside).groupBy(prefix(F.col("hash"), bits)).agg(*facts).select("first", "bytes", "groups")
        units = materialize(every.filter(~F.col("in_question")).select("first", "bytes", "groups").unionByName(finer), "shard-finer")
    cut = materialize(bounded.withColumn("earliest", F.expr(_EARLIEST)), "shard-earliest")
    return list(cut.select(F.expr(_CUTS.format(last=shards - 1, shards=shards)).alias("cuts")).first()["cuts"])


def shard_of(hashed: Column, cuts: list[int]) -> Column:
    """The shard that the cuts give a hash; one pass over the at most 15 cuts, no join."""
    return sum(((hashed >= F.lit(c).cast("long")).cast("int") for c in cuts), F.lit(0))


def assign_shards(docs: DataFrame, shards: int = SHARDS, bits: int = BIN_BITS, salts: int = SALTS) -> DataFrame:
    """``docs`` with ``shard`` and ``slot`` (numbered without gaps from 0 in each shard); columns of these names are replaced."""
    cuts = minimax_cuts(docs, shards, bits)
    placed = docs.withColumn("__text", hash_of(F.col("text"))).withColumns(
        {
            "shard": shard_of(F.col("__text"), cuts),
            "__bin": prefix(F.col("__text"), bits),
            "__salt": F.pmod(F.xxhash64("doc_id", F.lit("slot")), F.lit(salts)),
        }
    )
    cell = ["shard", "__bin", "__salt"]
    before = Window.partitionBy("shard").orderBy("__bin", "__salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("rows")).select(*cell, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("__first"))
    inside = Window.partitionBy(*cell).orderBy("__text", "doc_id")
    return (
        placed.withColumn("__nth", F.row_number().over(inside))
        .join(cells, cell)
        .withColumn("slot", F.col("__first") + F.col("__nth") - 1)
        .select(*dict.fromkeys([*docs.columns, "shard", "slot"]))
    )


@query("op9_shards")
def shards_of_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    # the sizes and hashes ride along instead of the text
    narrow = docs.select("doc_id", "text", size_of(F.col("text")).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return assign_shards(narrow).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
