"""Language identification by a byte convolutional network.

Filters of several widths slide over windows of ``WINDOW`` bytes of the lower-cased text, each keeps its
largest response, and a softmax over the languages follows. A text is cut into windows from its first byte
to its last; its probabilities are the mean over them, weighted by the bytes they hold.

The network learns on the driver from a bounded sample: at most ``SAMPLE_DOCS`` rows in all, shared evenly by
the languages, chosen by the hash of the id, and at most ``SAMPLE_WINDOWS`` windows from each. Ids with
crc32 mod 4 = 2 are never learned from. Scoring reads texts only.

For the pipeline the network also learns a class of what is no known language: windows of the sample with their bytes shuffled, of random
signs, and of random letters of other alphabets. A text goes if that class has ``SURELY_OTHER`` of its probability.

``und`` with score 0 stands for null texts, texts without a letter, and all texts where no labelled row is
there to learn from. Null languages are not learned. Null ids count as the empty text in the crc32. Repeated
rows are judged alike. An empty table gives no rows. Other columns stay as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.bytecnn import BLOCK, ByteConv, train, windows_of
from rivulet.llm.registry import query, table

WINDOW = 256
WIDTHS, FILTERS, DIM = (2, 3, 4), 12, 8
SAMPLE_DOCS, SAMPLE_WINDOWS = 4000, 3
ROUNDS, BATCH, RATE = 6, 64, 0.01
FOLDS, HELD_OUT_FOLD = 4, 2
UNKNOWN = "und"
#: The class of what is no known language, and its mean probability from which on the pipeline rejects a text.
OTHER, SURELY_OTHER = "other", 0.8

_LETTER = re.compile(r"[^\W\d_]")


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def text_bytes(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass")


def _sample_windows(texts: pd.Series) -> pd.Series:
    out = []
    for text in texts:
        data = text_bytes(text)
        last = max(0, len(data) - WINDOW)
        starts = sorted({last * k // max(1, SAMPLE_WINDOWS - 1) for k in range(SAMPLE_WINDOWS)})
        out.append([data[s : s + WINDOW] for s in starts])
    return pd.Series(out)


def labelled_sample(docs: DataFrame, most: int = SAMPLE_DOCS) -> tuple[list[bytes], list[str]]:
    """Windows and their languages, from at most ``most`` rows; runs two jobs."""
    usable = docs.filter(~in_fold(F.col("doc_id"), FOLDS, HELD_OUT_FOLD) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").limit(most).collect()}
    if not counts:
        return [], []
    each = max(1, most // len(counts))
    # twice the share that is needed on average, so that the exact choice below sees few rows
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 2 * each / n + 20 / n))])
    drawn = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("languages")), F.lit(1 << 30)) / float(1 << 30)
    windows = F.pandas_udf(_sample_windows, "array<binary>")
    chosen = (
        usable.withColumn("draw", drawn)
        .filter(F.col("draw") < F.element_at(share, F.col("lang")))
        .select("lang", "draw", windows("text").alias("windows"))
        .withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("draw", F.xxhash64("windows"))))
        .filter(F.col("nth") <= each)
        .orderBy("lang", "nth")
    )
    pairs = [(bytes(w), r["lang"]) for r in chosen.select("lang", "windows").collect() for w in r["windows"]]
    return [w for w, _ in pairs], [lang for _, lang in pairs]


def other_windows(windows: list[bytes], seed: int = 0) -> list[bytes]:
    """As many windows that are no language: shuffled bytes, random signs, random letters of one block of code points."""
    rng = np.random.default_rng(seed)
    signs = np.frombuffer(bytes(range(33, 127)), np.uint8)
    out = []
    for k, window in enumerate(windows):
        if k % 3 == 0:
            out.append(rng.permutation(np.frombuffer(window, np.uint8)).tobytes())
            continue
        if k % 3 == 1:
            letters = rng.choice(signs, len(window)).astype(int)
        else:
            # half of them of two bytes a letter, like most alphabets
            start = int(rng.choice(range(0x370, 0x7C0, 64) if rng.random() < 0.5 else [*range(0x800, 0xD700, 64), *range(0xF900, 0xFF00, 64)]))
            letters = start + rng.integers(0, 64, len(window))
        text = "".join(" " if gap < 0.15 else chr(c) for c, gap in zip(letters, rng.random(len(window))))
        out.append(text_bytes(text)[: len(window)])
    return out


def fit(windows: list[bytes], langs: list[str], rounds: int = ROUNDS, seed: int = 0, other: bool = False) -> ByteConv | None:
    """A network over the languages, with ``other`` also over ``OTHER``."""
    if other:
        few = windows[:: max(1, len(set(langs)))]
        windows, langs = [*windows, *other_windows(few, seed)], [*langs, *[OTHER] * len(few)]
    classes = sorted(set(langs))
    if not classes:
        return None
    model = ByteConv.fresh(classes, WIDTHS, FILTERS, DIM, bags=False, seed=seed)
    bags = [windows_of(w, WINDOW, WINDOW) for w in windows]
    labels = np.array([classes.index(lang) for lang in langs])
    return train(model, bags, labels, False, rounds, BATCH, RATE, seed)


def predict(model: ByteConv | None, texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and score of each text; windows of many texts go through the network together."""
    total: list[np.ndarray | None] = [None] * len(texts)
    sizes = [0] * len(texts)
    waiting: list[np.ndarray] = []
    owners: list[tuple[int, int]] = []

    def flush() -> None:
        if waiting:
            probabilities = model.window_probabilities(np.concatenate(waiting))
            at = 0
            for (k, held), windows in zip(owners, waiting):
                part = probabilities[at : at + len(windows)]
                weights = np.full(len(windows), WINDOW, np.float64)
                weights[-1] = held - WINDOW * (len(windows) - 1)
                total[k] = weights @ part + (0 if total[k] is None else total[k])
                at += len(windows)
            waiting.clear()
            owners.clear()

    pending = 0
    for k, text in enumerate(texts):
        if model is None or not isinstance(text, str) or not _LETTER.search(text):
            continue
        data = text_bytes(text)
        sizes[k] = len(data)
        for at in range(0, len(data), WINDOW * BLOCK):
            part = data[at : at + WINDOW * BLOCK]
            waiting.append(windows_of(part, WINDOW, WINDOW))
            owners.append((k, len(part)))
            pending += len(waiting[-1])
            if pending >= BLOCK:
                flush()
                pending = 0
    flush()
    return [(UNKNOWN, 0.0) if t is None else (model.classes[int(t.argmax())], float(min(1.0, t.max() / n))) for t, n in zip(total, sizes)]


def with_language(docs: DataFrame, model: ByteConv | None, name: str = "language") -> DataFrame:
    """``docs`` with a struct of lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def language(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame(predict(shared.value, batch.tolist()), columns=["lang_pred", "score"])

    return docs.withColumn(name, language("text"))


def identify(docs: DataFrame) -> DataFrame:
    """``docs`` with ``language`` (lang_pred, score) by a network learned from the same rows."""
    return with_language(docs, fit(*labelled_sample(docs)))


def of_known_language(docs: DataFrame, surely: float = SURELY_OTHER) -> DataFrame:
    """The rows of ``docs`` with a letter whose text is not surely something else than the languages learned."""
    marked = with_language(docs, fit(*labelled_sample(docs), other=True), "__language")
    lang, score = F.col("__language.lang_pred"), F.col("__language.score")
    return marked.filter((lang != UNKNOWN) & ((lang != OTHER) | (score < surely))).drop("__language")


@query("op3_language_id")
def language_of_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", in_fold(F.col("doc_id"), FOLDS, HELD_OUT_FOLD).alias("held_out"), "language.*")
