"""Quality classifier: a byte convolutional network over overlapping chunks of the whole text.

Chunks of ``CHUNK`` bytes overlap by more than a filter's width, so each filter sees every place of the text.
A filter keeps its largest response in each chunk; the document's features are the largest and the mean of these
over all chunks, and one softmax over the two labels gives the probability of label 1.

The network learns on the driver from at most ``SAMPLE_DOCS`` labelled rows, half per label where there are
enough, chosen by the hash of the id, with at most ``SAMPLE_CHUNKS`` chunks each; as the halves need not be the
true shares, the offset is corrected by the labels' counts. Ids with crc32 mod 5 = 0 are never learned from.
Scoring reads texts only.

Null texts are empty, and an empty text is one chunk of zero bytes with a score of its own. Without a label every
score is 0.5; with one label only, it is that label. Null labels and labels of unknown documents are not used;
a document with two labels counts for both. Repeated rows are judged alike. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.bytecnn import BLOCK, ByteConv, bag_features, train, windows_of
from rivulet.llm.langid import in_fold
from rivulet.llm.registry import query, table

CHUNK, OVERLAP = 256, 8
WIDTHS, FILTERS, DIM = (2, 3, 5), 12, 8
SAMPLE_DOCS, SAMPLE_CHUNKS = 2400, 6
ROUNDS, BATCH, RATE = 8, 32, 0.01
FOLDS, HELD_OUT_FOLD = 5, 0
THRESHOLD = 0.3


def text_bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def _sample_chunks(texts: pd.Series) -> pd.Series:
    """Up to SAMPLE_CHUNKS chunks, evenly spread over each text."""
    out = []
    for text in texts:
        data = text_bytes(text)
        last = max(0, len(data) - CHUNK)
        out.append([data[s : s + CHUNK] for s in sorted({last * k // (SAMPLE_CHUNKS - 1) for k in range(SAMPLE_CHUNKS)})])
    return pd.Series(out)


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_DOCS) -> tuple[list[list[bytes]], list[int], dict[int, int]]:
    """Chunks and label of at most ``most`` rows, and the counts of all labels; runs two jobs.

    The ids are chosen from the labels first, so only as many rows as the sample meet the texts in a join.
    """
    usable = labels.filter(~in_fold(F.col("doc_id"), FOLDS, HELD_OUT_FOLD) & F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int"))
    counts = {r["quality"]: r["n"] for r in usable.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return [], [], {}
    each = most // len(counts)
    share = F.create_map(*[F.lit(x) for label, n in counts.items() for x in (label, min(1.0, 2 * each / n + 20 / n))])
    drawn = usable.withColumn("draw", F.pmod(F.xxhash64(F.col("doc_id"), F.lit("quality")), F.lit(1 << 30)) / float(1 << 30))
    ids = (
        drawn.filter(F.col("draw") < F.element_at(share, F.col("quality")))
        .withColumn("nth", F.row_number().over(Window.partitionBy("quality").orderBy("draw", "doc_id")))
        .filter(F.col("nth") <= each)
        .select("doc_id", "quality")
    )
    # ids: at most `most` rows by construction; repeated documents may still bring more rows, hence the limit
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    rows = texts.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "quality").limit(most)
    chunks = F.pandas_udf(_sample_chunks, "array<binary>")
    found = rows.select("quality", chunks("text").alias("chunks")).collect()
    return [[bytes(c) for c in r["chunks"]] for r in found], [r["quality"] for r in found], counts


def fit(bags: list[list[bytes]], labels: list[int], counts: dict[int, int], rounds: int = ROUNDS, seed: int = 0) -> ByteConv | float:
    """A network, or a plain score where there is nothing to tell apart."""
    if not labels:
        return 0.5
    if len(set(labels)) == 1:
        return float(labels[0])
    model = ByteConv.fresh([0, 1], WIDTHS, FILTERS, DIM, bags=True, seed=seed)
    chunks = [np.concatenate([windows_of(c, CHUNK, CHUNK) for c in bag]) for bag in bags]
    train(model, chunks, np.array(labels), True, rounds, BATCH, RATE, seed)
    for label in (0, 1):
        model.offset[label] += np.log(max(counts.get(label, 0), 1) / labels.count(label))
    return model


def scores(model: ByteConv | float, texts: list[str | None]) -> list[float]:
    if isinstance(model, float):
        return [model] * len(texts)
    features: list[np.ndarray] = []
    waiting, starts, pending = [], [], 0

    def flush() -> None:
        if waiting:
            windows = np.concatenate(waiting)
            responses = np.concatenate([model.responses(windows[at : at + BLOCK]) for at in range(0, len(windows), BLOCK)])
            features.append(bag_features(responses, np.array(starts)))
            waiting.clear()
            starts.clear()

    for text in texts:
        windows = windows_of(text_bytes(text), CHUNK, CHUNK - OVERLAP)
        starts.append(pending)
        waiting.append(windows)
        pending += len(windows)
        if pending >= BLOCK:
            flush()
            pending = 0
    flush()
    return model.head(np.concatenate(features))[:, 1].astype(float).tolist() if features else []


def with_quality(docs: DataFrame, model: ByteConv | float, name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def quality(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(scores(shared.value, batch.tolist()), dtype="float64")

    return docs.withColumn(name, quality("text"))


@query("op7_quality")
def quality_of_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(*labelled_sample(docs, table(spark, sf_dir, "labels")))
    return with_quality(docs, model).select(
        "doc_id",
        in_fold(F.col("doc_id"), FOLDS, HELD_OUT_FOLD).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
