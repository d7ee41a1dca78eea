"""The newest row per group of a stream, kept in a folder in proportion to the groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rivulet.operators.relational import join_on_same


class KeyedResults:
    """Rows of groups as runs of a stream write them.

    ``rows/run=N`` has the groups that run N changed, ``whole/upto=N`` all groups as of run N. A reader takes the last finished
    ``upto`` and the runs after it. A new one is written when the runs since the last hold as many rows as it, or are many; only
    then is deleted what the one before had already replaced. A run that is repeated writes its folder again, and an ``upto``
    that was not finished is not read and is written anew, so a stop at any point loses and doubles nothing.
    """

    #: Runs that are read one by one at most.
    MOST_RUNS = 16

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str]):
        self.spark, self.folder, self.schema, self.keys = spark, folder, schema, list(keys)
        context = spark.sparkContext
        self._path = context._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(folder).getFileSystem(context._jsc.hadoopConfiguration())

    def store(self, batch: DataFrame, number: int) -> None:
        """Write the groups that a run changed; for ``foreachBatch``."""
        batch.write.mode("overwrite").parquet(f"{self.folder}/rows/run={number}")

    def _finished(self, kind: str) -> list[int]:
        """The numbers of the folders of ``kind`` that are written to the end, in order."""
        top = self._path(f"{self.folder}/{kind}")
        found = [s.getPath() for s in self._files.listStatus(top)] if self._files.exists(top) else []
        return sorted(int(p.getName().split("=")[1]) for p in found if self._files.exists(self._path(p, "_SUCCESS")))

    def _parts(self) -> tuple[list[int], list[int]]:
        """The finished ``upto`` numbers and the runs after the last."""
        whole = self._finished("whole")
        return whole, [n for n in self._finished("rows") if not whole or n > whole[-1]]

    def _read(self, paths: Sequence[tuple[str, int]]) -> DataFrame | None:
        table = None
        for path, number in paths:
            part = self.spark.read.schema(self.schema).parquet(f"{self.folder}/{path}").withColumn("run_", F.lit(number))
            table = part if table is None else table.unionByName(part)
        return table

    def newest(self) -> DataFrame:
        """The newest row of every group."""
        whole, runs = self._parts()
        versions = self._read([(f"whole/upto={n}", n) for n in whole[-1:]] + [(f"rows/run={n}", n) for n in runs])
        if versions is None:
            return self.spark.createDataFrame([], self.schema)
        if not runs:
            return versions.drop("run_")
        last = versions.groupBy(*self.keys).agg(F.max("run_").alias("last_"))
        return join_on_same(versions, last, self.keys).where("run_ = last_").select(*self.schema.names)

    def clear(self) -> None:
        """Write all groups anew if the runs since the last time outweigh them, and delete what that time had replaced."""
        whole, runs = self._parts()
        if not runs:
            return
        changed = self._read([(f"rows/run={n}", n) for n in runs]).count()
        known = self._read([(f"whole/upto={whole[-1]}", 0)]).count() if whole else 0
        if changed < max(known, 1) and len(runs) < self.MOST_RUNS:
            return
        self.newest().write.mode("overwrite").parquet(f"{self.folder}/whole/upto={runs[-1]}")
        for n in whole[:-1]:
            self._files.delete(self._path(f"{self.folder}/whole/upto={n}"), True)
        for n in self._finished("rows"):
            if whole and n <= whole[-1]:
                self._files.delete(self._path(f"{self.folder}/rows/run={n}"), True)
