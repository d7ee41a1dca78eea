"""Audit of filters applied in sequence: what each step removes, and each filter's fair share, by Hart-Mas-Colell potentials.

A coalition is a set of filters, written as a bit mask (A is bit 0). Its worth is the number of documents that at least
one of its filters removes. The potential of the empty coalition is 0, and that of any other is
``(worth + sum of the potentials with one member left out) / members``; a filter's Shapley value is the potential of all
filters less that of all but it. Potentials are kept times the number of orders, which makes them whole numbers:
the Shapley value times the orders is what the filter removes summed over all orders. What a step removes is the worth of
the coalition of the steps up to it less that of the steps before it, so no order is ever applied to documents: one
aggregation gives the worths of the 32 coalitions, and the 600 steps of a part are differences of them.

Filters, with words ``[^\\x20\\x09-\\x0D]+``: A fewer than 50 words; B under 65 different words in 100; C over 5 ``[A-Z]``
in 100 code points; D one of ``#$%&*|``; E the same text as a smaller doc_id, wherever in the table.

Null texts are empty ones. A null doc_id is neither smaller nor larger than others, so E never removes such a row; rows of
equal id are no copies of each other. Labels that repeat count if any row says 1. Null sources are the part ''. An empty
table gives no rows. Texts are read whole, for the filters and for the first of each text, and never shuffled; nothing is written
on the way. Copies meet as (id, hash) pairs, so a text with a third of all rows is spread like any other.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.registry import query, table

WORD = r"[^\x20\x09-\x0D]+"
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5
ALL = (1 << len(FILTERS)) - 1
ORDERS = ["".join(p) for p in permutations(FILTERS)]


def failed_filters(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, distinct = F.size(words).cast("long"), F.size(F.array_distinct(words)).cast("long")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    fails = [n < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT * n, 100 * capitals > MOST_CAPITALS * F.length(text), text.rlike("[#$%&*|]")]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))


def audited_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document row: doc_id, part, failed (bits of A to E), good, toxic (0 or 1)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), failed_filters(F.col("text")).alias("failed"), F.sha2(text, 256).alias("hash"))
    first = narrow.groupBy("hash").agg(F.min("doc_id").alias("doc_id")).filter("doc_id IS NOT NULL").withColumn("is_first", F.lit(True))
    marks = labels.groupBy("doc_id").agg(*[F.max((F.coalesce(F.col(c) == 1, F.lit(False))).cast("int")).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))])
    known = narrow.filter("doc_id IS NOT NULL").join(first, ["doc_id", "hash"], "left").join(marks, "doc_id", "left")
    copy = F.when(F.col("is_first").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    return known.select(
        "doc_id", "part", (F.col("failed") + copy).alias("failed"), F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")
    ).unionByName(narrow.filter("doc_id IS NULL").select("doc_id", "part", "failed", F.lit(0).alias("good"), F.lit(0).alias("toxic")))


def coalition_worths(audited: DataFrame) -> DataFrame:
    """part, total and, per game, the worths of all coalitions by mask: removed, good, toxic (arrays of long).

    Rows are first counted by their bits, so at most 32 counts of a part and task are shuffled.
    """
    counts = audited.groupBy("part", "failed").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))

    def worths(of: str) -> Column:
        hit = [F.col("failed").bitwiseAND(F.lit(coalition)) != 0 for coalition in range(ALL + 1)]
        return F.array(*[F.sum(F.when(h, F.col(of)).otherwise(F.lit(0))).cast("long") for h in hit])

    return counts.groupBy("part").agg(
        F.sum("n").alias("total"), worths("n").alias("removed"), worths("good").alias("good"), worths("toxic").alias("toxic")
    )


def scaled_potentials(worths: Column) -> Column:
    """The potentials of all coalitions by mask, times the number of orders; ``worths`` by mask, that of the empty one 0.

    A mask is larger than that of any coalition inside it, so going up by mask finds all that it needs.
    """

    def add(known: Column, mask: Column) -> Column:
        without = [
            F.when(mask.bitwiseAND(F.lit(1 << k)) != 0, F.get(known, mask.bitwiseAND(F.lit(ALL & ~(1 << k))))).otherwise(F.lit(0)) for k in range(len(FILTERS))
        ]
        due = sum(without, F.get(worths, mask) * len(ORDERS))
        return F.array_append(known, F.call_function("div", due, F.bit_count(mask).cast("long")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ALL)), F.array(F.lit(0).cast("long")), add)


def shapley_values(worths: Column) -> Column:
    """Per filter in order, its Shapley value times the number of orders."""
    potentials = scaled_potentials(worths)
    return F.transform(F.array(*[F.lit(ALL & ~(1 << k)) for k in range(len(FILTERS))]), lambda rest: F.get(potentials, F.lit(ALL)) - F.get(potentials, rest))


def filter_steps(worths: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley for every order and step."""
    steps = (
        worths.withColumn("shapleys", shapley_values(F.col("removed")))
        .withColumn("filter_order", F.explode(F.array(*map(F.lit, ORDERS))))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
        .withColumn("place", F.ascii(F.substr("filter_order", F.col("step"), F.lit(1))) - F.lit(ord("A")))
        .withColumn("before", sum((F.when(F.instr("filter_order", f) < F.col("step"), 1 << k).otherwise(0) for k, f in enumerate(FILTERS)), F.lit(0)))
    )
    own = F.element_at(F.array(*[F.lit(1 << k) for k in range(len(FILTERS))]), F.col("place") + 1)

    def lost(game: str) -> Column:
        return F.get(game, F.col("before") + own) - F.get(game, "before")

    removed = lost("removed")
    return steps.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.get("removed", F.col("before") + own)).alias("kept"),
        removed.alias("removed"),
        (F.get("removed", own) - removed).alias("redundant"),
        (F.get("removed", F.lit(ALL)) - F.get("removed", F.lit(ALL) - own)).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        F.get("shapleys", "place").alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The steps of all orders for every part of ``docs``."""
    return filter_steps(coalition_worths(audited_documents(docs, labels)))


#: Every order applied step by step to the counted bits.
AUDIT_SQL = f"""
WITH marks AS (SELECT doc_id, max(coalesce(quality = 1, false)::INT) AS good, max(coalesce(toxic = 1, false)::INT) AS toxic FROM labels GROUP BY doc_id),
texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
fails AS (SELECT doc_id, part, len(words) < {LEAST_WORDS} AS a, 100 * len(list_distinct(words)) < {LEAST_DISTINCT} * len(words) AS b,
    100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > {MOST_CAPITALS} * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e FROM texts),
counts AS (SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS failed, count(*) AS n,
    sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM fails LEFT JOIN marks USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS own),
orders AS (SELECT p.letter || q.letter || r.letter || s.letter || t.letter AS filter_order, [p.own, q.own, r.own, s.own, t.own] AS bits
  FROM letters p, letters q, letters r, letters s, letters t WHERE p.own + q.own + r.own + s.own + t.own = 31 AND (p.own | q.own | r.own | s.own | t.own) = 31),
steps AS (SELECT filter_order, step, bits[step] AS own, list_sum(bits[1:step])::BIGINT - bits[step] AS before FROM orders, (SELECT unnest(range(1, 6)) AS step)),
sums AS (SELECT part, filter_order, step, own,
    sum(CASE WHEN failed & (before | own) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN failed & before = 0 AND failed & own <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN failed & before <> 0 AND failed & own <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN failed = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN failed & before = 0 AND failed & own <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN failed & before = 0 AND failed & own <> 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM sums
"""


@query("op13_filter_audit", AUDIT_SQL)
def audit_of_documents(spark, sf_dir):
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
