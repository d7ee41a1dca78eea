"""From raw documents to a sharded mix: the stages, in order, and the job that runs them all.

Each stage gets what the stage before it kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm.decontaminate import without_contaminated
from rivulet.llm.langid import of_known_language
from rivulet.llm.mixing import mixed_documents
from rivulet.llm.registry import table
from rivulet.llm.sharding import assign_shards
from rivulet.llm.simhash import without_near_duplicates
from rivulet.session import materialize, release


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter that are not surely something else than the languages learned: random signs, other alphabets."""
    return of_known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id."""
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: up to twice, or not at all."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of ``documents`` with shard and slot."""
    return assign_shards(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: SQL has no hash, network or tokens of these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's rows are written to the shared folder and read again, and the rows of the stage before
    it are removed then."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
        if before is not None:
            release(before)
        before = docs
    return docs
