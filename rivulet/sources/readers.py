"""Readers for the file shapes the jobs start from. Schemas are always explicit."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def spread(df: DataFrame) -> DataFrame:
    """A scan with at least one partition per core.

    For work that is heavy per row on a source with few splits; a source that already
    has enough is left alone and not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


@dataclass(frozen=True)
class Checked:
    """What a source gave: ``records``, and ``rejects`` with the file, the start of its split, the text and the reason."""

    records: DataFrame
    rejects: DataFrame

    def counts(self) -> DataFrame:
        """One row: kept, rejected."""
        kept = self.records.select(F.lit(1).alias("kept"), F.lit(0).alias("rejected"))
        both = kept.unionAll(self.rejects.select(F.lit(0), F.lit(1)))
        return both.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("kept", "rejected")])


#: Why a line is no record.
NOT_JSON, NO_OBJECT, NO_FIT = "not JSON", "not an object", "a field does not fit its type"


def checked_records(spark: SparkSession, path: str, schema: str, marker: str | None = None) -> Checked:
    """Lines of JSON objects; a line that is none, or has a field of another type, is a reject and never a row of nulls.

    With ``marker`` lines in which it does not occur after the first character are skipped. Blank lines are skipped.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))
    wanted = lines.where(F.trim("value") != "" if marker is None else F.instr("value", marker) > 1)
    fields = T.StructType.fromDDL(schema).add("broken_", T.StringType())
    parsed = wanted.withColumn("record", F.from_json("value", fields, {"columnNameOfCorruptRecord": "broken_"}))
    is_object = F.ltrim("value").startswith("{")
    good = is_object & F.col("record").isNotNull() & F.col("record.broken_").isNull()
    records = parsed.where(good).select(*[F.col("record")[f.name].alias(f.name) for f in fields[:-1]])
    reason = F.when(F.try_parse_json("value").isNull(), NOT_JSON).when(~is_object, NO_OBJECT).otherwise(NO_FIT)
    return Checked(records, parsed.where(~good).select("file", "split", F.col("value").alias("text"), reason.alias("reason")))


def json_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object per line; for lines that are none see ``checked_records``."""
    return checked_records(spark, path, schema).records


def json_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that each hold one JSON array of objects.

    A file cannot be split, so large collections belong in many files or in JSON lines.
    """
    return spark.read.schema(schema).option("multiLine", True).json(path)


def marked_lines(spark: SparkSession, path: str, marker: str, schema: str) -> DataFrame:
    """JSON lines in which ``marker`` occurs after the first character; other lines are skipped, and for marked ones that
    are no record see ``checked_records``."""
    return checked_records(spark, path, schema, marker).records


def csv_table(spark: SparkSession, path: str, schema: str, sep: str = ",", multi_line: bool = False) -> DataFrame:
    """Text with a header line and typed columns; ``sep`` is a tab for TSV.

    Large files are split. Where quoted cells hold line breaks take ``multi_line``, which reads each file in one task.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .csv(path)
    )


def tsv_table(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    return csv_table(spark, path, schema, "\t", multi_line)


def matrix_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A matrix written as text: the header line and the first (row id) column are set aside and
    the rest becomes one vector of doubles per row. Cells that are not numbers become null.

    ``columns`` names the header cells; returns (row_id, vector).
    """
    cells = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    table = spark.read.schema(cells).option("header", True).csv(path)
    first, rest = columns[0], columns[1:]
    numbers = [F.trim(F.col(f"`{c}`")).try_cast("double") for c in rest]
    return table.select(F.trim(F.col(f"`{first}`")).alias("row_id"), F.array(*numbers).alias("vector"))


PAYLOAD = "struct<resultSets: array<struct<headers: array<string>, rowSet: array<array<string>>>>>"


def _result_set(payloads: DataFrame, payload: str, keep: Sequence[str], result: int) -> DataFrame:
    return payloads.select(*keep, payload, F.get(F.from_json(payload, PAYLOAD)["resultSets"], F.lit(result)).alias("rs"))


def _cells(sets: DataFrame, keep: Sequence[str]) -> DataFrame:
    return sets.select(*keep, F.col("rs.headers").alias("headers"), F.explode("rs.rowSet").alias("cells"))


def _cell(name: str) -> Column:
    at = F.array_position("headers", F.lit(name)).cast("int") - 1
    return F.when(at >= 0, F.get("cells", at))


def rowset_table(
    payloads: DataFrame, fields: dict[str, str], payload: str = "payload", keep: Sequence[str] = (), result: int = 0
) -> DataFrame:
    """Rows of a headers + rowSet payload as a table.

    ``fields`` maps header names to types; each cell is found by the position of its name in the
    payload's own header list, so payloads may order their headers differently. A header that is
    missing gives null, and so does a cell that does not fit its type: see ``rowset_rejects``.
    """
    rows = _cells(_result_set(payloads, payload, keep, result), keep)
    return rows.select(*keep, *[_cell(n).try_cast(k).alias(n) for n, k in fields.items()])


def rowset_rejects(
    payloads: DataFrame, fields: dict[str, str], payload: str = "payload", keep: Sequence[str] = (), result: int = 0
) -> DataFrame:
    """What ``rowset_table`` could not take over: (*keep, field, text, reason).

    Payloads that are no JSON or have no such result set come with a null field and their whole text, cells that do not
    fit their type with the field's name. Rows and cells that are null are no rejects.
    """
    sets = _result_set(payloads, payload, keep, result)
    lost = sets.where(F.col(payload).isNotNull() & F.col("rs").isNull()).select(
        *keep, F.lit(None).cast("string").alias("field"), F.col(payload).alias("text"),
        F.when(F.try_parse_json(payload).isNull(), NOT_JSON).otherwise("no such result set").alias("reason"),
    )
    bad = [
        F.when(_cell(n).isNotNull() & _cell(n).try_cast(k).isNull(), F.struct(F.lit(n).alias("field"), _cell(n).alias("text")))
        for n, k in fields.items()
    ]
    cells = _cells(sets, keep).select(*keep, F.explode(F.array_compact(F.array(*bad))).alias("bad"))
    return lost.unionByName(cells.select(*keep, "bad.field", "bad.text", F.lit(NO_FIT).alias("reason")))


def register(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` under ``name`` and return the table read back through the catalog."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
