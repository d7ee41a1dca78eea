"""Personal data by weak supervision.

Fixed patterns find the certain spans (``base``): emails, addresses of the internet protocol, card
numbers that pass their check digit, phone numbers. Looser patterns add candidates: written-out emails, phone
numbers without a plus sign, and number strings of which the strict test failed. Labelers (patterns, lists of
known parts, words before the span, signs against it) vote yes, no or not at all on every candidate and base span.

Votes are counted per kind and pattern of votes over all documents: a table whose size depends on the number of kinds and
labelers alone. Expectation-maximisation on it estimates how reliable each labeler is and how likely each pattern. A logistic
span classifier then learns these probabilities from votes and the span's shape, on at most ``SAMPLE_SPANS`` spans
chosen by hash. Candidates with a probability of at least ``THRESHOLD`` are added unless they overlap a base span
or an earlier candidate; base spans stay in any case.

Texts are read once; what the labelers saw is written to the shared folder and classified from there.

Positions are code points, ends exclusive. Null and empty texts have no spans. Repeated rows are judged alike; null
ids are kept. An empty table gives no rows. Every pattern takes time linear in the text.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.registry import query, table
from rivulet.session import materialize

KINDS = ("email", "ip", "card", "phone")
THRESHOLD = 0.5
SAMPLE_SPANS = 20_000
CONTEXT = 40

# Fixed patterns of the base spans; runs are possessive, which changes no match.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Looser patterns of candidates.
_SPELLED = re.compile(r"[A-Za-z0-9._%+-]{1,64}[\x20]?[(\[{]?[\x20]?(?:at|AT|@)[\x20]?[)\]}]?[\x20]?[A-Za-z0-9-]{1,63}(?:[\x20]?[(\[{]?[\x20]?(?:dot|DOT)[\x20]?[)\]}]?[\x20]?[A-Za-z0-9-]{2,63})+")
_PLAIN_PHONE = re.compile(r"(?<![0-9+.-])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?:[\x20.-][0-9]{2,4})?(?![0-9.-])")

# Lists of known parts and words.
_ENDINGS = {"com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "it", "nl", "uk", "eu", "ch", "at", "us"}
_ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35")
_WORDS = {
    "email": ("mail", "contact", "write", "schreib", "contacto", "courriel", "correo"),
    "ip": ("ip", "address", "host", "server", "adresse", "addr", "client"),
    "card": ("card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "llama", "appel", "number"),
}
_AGAINST = ("version", "release", "isbn", "order", "invoice", "section", "chapter", "page", "id", "ref", "serial", "v")
_LAST_WORDS = re.compile(r"[^\W\d_]+")

LABELERS = ("strict", "check", "known", "context", "against", "apart")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(span: str) -> str:
    return "".join(c for c in span if c in "0123456789")


def _octet(part: str) -> int:
    """The value of an address part of any length, 256 standing for all that is too large."""
    rest = part.lstrip("0")
    return min(int(rest or "0"), 256) if len(rest) <= 3 else 256


def _emails(text: str) -> list[tuple[int, int]]:
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(_LOCAL))
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            found.append((start, match.end()))
        free = match.end() if match else at + 1
        at = text.find("@", free)
    return found


def matches(text: str) -> dict[str, tuple[list[tuple[int, int]], list[tuple[int, int]]]]:
    """Per kind the base spans, and the other candidates."""
    found = {k: ([], []) for k in KINDS}
    if "@" in text:
        found["email"][0].extend(_emails(text))
    lower = text.lower() if "dot" in text or "DOT" in text else ""
    if "dot" in lower and "at" in lower:
        found["email"][1].extend(m.span() for m in _SPELLED.finditer(text))
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        good = all(_octet(p) <= 255 for p in m.group().split("."))
        found["ip"][not good].append(m.span())
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() and 13 <= len(d := _digits(m.group())) <= 19:
            found["card"][not luhn(d)].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            found["phone"][not 9 <= len(_digits(m.group())) <= 15].append(m.span())
    found["phone"][1].extend(m.span() for m in _PLAIN_PHONE.finditer(text))
    return found


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    return [(k, *span) for k, (base, _) in matches(text or "").items() for span in base]


def votes_on(text: str, kind: str, start: int, end: int, base: bool) -> list[int]:
    """1 for, 0 against, -1 no vote, by each of LABELERS."""
    span, digits = text[start:end], _digits(text[start:end])
    words = [w.lower() for w in _LAST_WORDS.findall(text[max(0, start - CONTEXT) : start])[-4:]]
    strict = 1 if base else -1
    if kind == "email":
        ending = re.split(r"[^A-Za-z0-9-]+", span.rstrip(")]} "))[-1].lower()
        check = 1 if span.count("@") == 1 or re.search(r"[(\[{]", span) else -1
        known = 1 if ending in _ENDINGS else -1 if base else 0
    elif kind == "ip":
        parts = [_octet(p) for p in span.split(".")]
        check = int(len(parts) == 4 and max(parts) <= 255)
        known = 0 if len(parts) == 4 and parts[0] == 0 else -1
    elif kind == "card":
        check, known = int(luhn(digits)), 1 if digits.startswith(_ISSUERS) else 0
    else:
        check = int(9 <= len(digits) <= 15)
        known = 1 if span.startswith("+") and digits[:1] != "0" else -1
    context = 1 if any(w.startswith(_WORDS[kind]) for w in words) else -1
    against = 0 if any(w in _AGAINST for w in words) or len(set(digits)) == 1 else -1
    left, right = text[start - 1 : start], text[end : end + 1]
    apart = 0 if left.isalnum() or right.isalnum() or left in "._/#$=" and left or right in "/%" and right else 1
    return [strict, check, known, context, against, apart]


def shape_of(text: str, start: int, end: int) -> list[float]:
    span = text[start:end]
    n = len(span)
    kinds = (sum(map(str.isdigit, span)), sum(map(str.isalpha, span)), span.count(" "), len(re.findall(r"[.()-]", span)))
    return [min(n, 64) / 32, *[k / n for k in kinds], float(text[max(0, start - 1) : start].isspace() or start == 0)]


#: How a span stands in a row's bytes.
_RECORD = np.dtype([("kind", "i1"), ("base", "?"), ("votes", "i1", 6), ("start", "<i8"), ("stop", "<i8"), ("shape", "<f8", 6)])


def spans_of(text: str) -> np.ndarray:
    """Every base span and candidate with the labelers' votes, by kind, base first."""
    rows = [
        (k, sure, votes_on(text, kind, a, b, sure), a, b, shape_of(text, a, b))
        for k, (kind, found) in enumerate(matches(text).items())
        for spans, sure in zip(found, (True, False))
        for a, b in spans
    ]
    return np.array([(k, sure, tuple(v), a, b, tuple(s)) for k, sure, v, a, b, s in rows], _RECORD)


def labelled_spans(docs: DataFrame) -> DataFrame:
    """doc_id and ``found``: the bytes of ``spans_of``, null where there is no span."""

    @F.pandas_udf("binary")
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            found = [spans_of(t) if isinstance(t, str) else () for t in batch]
            yield pd.Series([f.tobytes() if len(f) else None for f in found], dtype="object")

    return docs.select("doc_id", find("text").alias("found"))


def reliabilities(kinds: np.ndarray, votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expectation-maximisation over patterns of votes: chance of each pattern, of each kind, and P(vote | labeler, truth)."""
    yes, no = (votes == 1).sum(axis=1), (votes == 0).sum(axis=1)
    chance = (yes + 0.5) / (yes + no + 1)
    seen = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
    for _ in range(rounds):
        weight = np.stack(((1 - chance) * counts, chance * counts))
        prior = np.array([(weight[1][kinds == k].sum() + 1) / (counts[kinds == k].sum() + 2) for k in range(len(KINDS))])
        table_ = np.einsum("tp,plv->tlv", weight, seen) + 1
        # a labeler that may only vote one way keeps its direction: a vote never counts against itself
        table_ /= table_.sum(axis=2, keepdims=True)
        table_[1, :, 2] = np.maximum(table_[1, :, 2], table_[0, :, 2])
        table_[0, :, 1] = np.maximum(table_[0, :, 1], table_[1, :, 1])
        logs = np.einsum("plv,tlv->tp", seen, np.log(table_ / table_.sum(axis=2, keepdims=True)))
        odds = np.log(prior[kinds] / (1 - prior[kinds])) + logs[1] - logs[0]
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - chance).max(initial=0) < 1e-9:
            break
        chance = new
    return chance, prior, table_


def span_features(kinds: np.ndarray, votes: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    one = np.eye(len(KINDS))[kinds]
    seen = np.concatenate([votes == 1, votes == 0], axis=1).astype(float)
    return np.concatenate([one, seen, shapes, np.ones((len(kinds), 1))], axis=1)


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30, ridge: float = 1e-2) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = np.maximum(p * (1 - p), 1e-6)
        w += np.linalg.solve(x.T @ (x * curve[:, None]) + ridge * len(x) * np.eye(len(w)), x.T @ (y - p) - ridge * len(x) * w)
    return w


def fit_span_classifier(labelled: DataFrame, most: int = SAMPLE_SPANS) -> np.ndarray | None:
    """Weights of the final classifier; runs two jobs that bring a bounded number of rows to the driver."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spans = np.frombuffer(b"".join(batch["found"]), _RECORD)
            owners = np.repeat(batch["draw"].to_numpy(), [len(f) // _RECORD.itemsize for f in batch["found"]])
            votes = [",".join(map(str, v)) for v in spans["votes"].tolist()]
            yield pd.DataFrame(
                {"draw": owners, "start": spans["start"], "kind": spans["kind"].astype(int), "votes": votes, "shape": list(spans["shape"])}
            )

    spans = (
        labelled.filter(F.col("found").isNotNull())
        .select(F.xxhash64("doc_id").alias("draw"), "found")
        .mapInPandas(unpack, "draw long, start long, kind int, votes string, shape array<double>")
    )
    patterns = spans.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).collect()
    if not patterns:
        return None
    parsed = lambda rows: (np.array([r["kind"] for r in rows]), np.array([[int(v) for v in r["votes"].split(",")] for r in rows]))
    kinds, votes = parsed(patterns)
    chance = reliabilities(kinds, votes, np.array([r["n"] for r in patterns], float))[0]
    known = {(r["kind"], r["votes"]): c for r, c in zip(patterns, chance)}
    order = [F.xxhash64("draw", "start", "kind"), "draw", "start", "kind", "votes"]
    share = min(1.0, 2 * most / sum(r["n"] for r in patterns))
    drawn = spans.filter(F.pmod(order[0], F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = drawn.orderBy(*order).limit(most).select("kind", "votes", "shape").collect()
    x = span_features(*parsed(sample), np.array([r["shape"] for r in sample]))
    return fit_logistic(x, np.array([known[(r["kind"], r["votes"])] for r in sample]))


def chosen_spans(found: np.ndarray, weights: np.ndarray | None) -> list[tuple[str, int, int]]:
    """Base spans and the candidates that the classifier takes, by kind and start."""
    base, more = found[found["base"]], found[~found["base"]]
    taken = [(int(s["kind"]), int(s["start"]), int(s["stop"])) for s in base]
    if len(more) and weights is not None:
        scores = span_features(more["kind"].astype(int), more["votes"], more["shape"]) @ weights
        free = _disjoint([(a, b) for _, a, b in taken])
        for k in np.lexsort((more["start"], -scores)):
            kind, start, stop = (int(more[k][c]) for c in ("kind", "start", "stop"))
            at = bisect.bisect_left(free, (start, stop))
            clear = (at == 0 or free[at - 1][1] <= start) and (at == len(free) or stop <= free[at][0])
            if clear and scores[k] >= np.log(THRESHOLD / (1 - THRESHOLD)):
                taken.append((kind, start, stop))
                free.insert(at, (start, stop))
    return [(KINDS[k], a, b) for k, a, b in sorted(taken)]


def _disjoint(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans in order, those that overlap as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _line(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def personal_spans(docs: DataFrame) -> DataFrame:
    """doc_id, base and spans per row, both as ``kind:start:end`` by kind and start, joined by commas."""
    labelled = materialize(labelled_spans(docs), "pii")
    shared = docs.sparkSession.sparkContext.broadcast(fit_span_classifier(labelled))

    @F.pandas_udf("base string, spans string")
    def choose(founds: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in founds:
            rows = [np.frombuffer(f, _RECORD) if f is not None else None for f in batch]
            yield pd.DataFrame(
                [("", "") if r is None else (_line(chosen_spans(r, None)), _line(chosen_spans(r, shared.value))) for r in rows], columns=["base", "spans"]
            )

    return labelled.select("doc_id", choose("found").alias("chosen")).select("doc_id", "chosen.*")


def span_array(line: Column) -> Column:
    """The spans of such a line as an array of structs."""
    parts = F.filter(F.split(line, ","), lambda s: s != "")
    field = lambda s, k: F.split(s, ":")[k]
    return F.transform(
        parts, lambda s: F.struct(field(s, 0).alias("kind"), field(s, 1).cast("long").alias("start"), field(s, 2).cast("long").alias("stop"))
    )


@query("op10_pii")
def personal_data_of_documents(spark, sf_dir):
    found = personal_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *[F.regexp_count("base", F.lit(f"{k}:")).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2("base", 256).alias("base_sha256"),
        "spans",
    )
