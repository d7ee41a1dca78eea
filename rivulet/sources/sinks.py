"""Writers. Each task writes its own part file; nothing passes through the driver."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F


def write_json(df: DataFrame, path: str) -> str:
    """One JSON object per line."""
    df.write.option("ignoreNullFields", False).json(path)
    return path


def write_json_document(df: DataFrame, path: str) -> str:
    """One JSON array per part file. Each task frames its own rows as they pass."""

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        started = False
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column(0)
            lines = pc.binary_join_element_wise(pa.scalar(","), rows, "")
            if not started:
                head = pc.binary_join_element_wise(pa.scalar("["), rows.slice(0, 1), "")
                lines = pa.concat_arrays([head, lines.slice(1)])
                started = True
            yield pa.RecordBatch.from_arrays([lines], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["]" if started else "[]"])], ["value"])

    records = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    records.mapInArrow(framed, "value string").write.text(path)
    return path


def write_csv(df: DataFrame, path: str, sep: str = ",") -> str:
    """Text with a header line in every part file; white space at the ends of cells is kept."""
    writer = df.write.option("header", True).option("sep", sep).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def write_tsv(df: DataFrame, path: str) -> str:
    return write_csv(df, path, sep="\t")


def write_text(df: DataFrame, path: str) -> str:
    """The single text column of ``df``, one row per line."""
    df.write.text(path)
    return path
