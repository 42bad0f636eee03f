"""Quality classifier: regularised quadratic discriminant over document statistics.

Each text is reduced once to a few transformed statistics. Counts, sums and sums of
products of the labelled documents are aggregated by Spark over all of them; from
these two small rows come class means and covariances, shrunk towards their pooled
form and its diagonal. A score is the logistic of the difference of the classes'
Mahalanobis log densities, with whitening matrices from Cholesky factors that are
computed once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import forget_all, id_remainder, private, row_count_at_most, slices, tidy

FEATURES = (
    "log_words",
    "log_word_length",
    "log_line_words",
    "upper_share",
    "digit_share",
    "symbol_share",
    "stop_share",
    "variety",
    "top_share",
    "repeat_share",
    "log_longest_word",
    "line_variety",
)
#: Weight of the pooled covariance in a class's own, and of the diagonal in that.
TO_POOLED, TO_DIAGONAL = 0.2, 0.05
#: Least variance of a statistic, so that constant ones do no harm.
LEAST = 1e-3
THRESHOLD = 0.7
#: Labels up to this number are broadcast.
BROADCAST_LABELS = 1_000_000

_upper = re.compile(rb"[A-Z]|\xc3[\x80-\x9e]")
_marks = bytes(i for i in range(33, 127) if not chr(i).isalnum() and chr(i) not in ".,")


def _share(part: float, whole: float, usual: float, weight: float) -> float:
    """A share from 0 to 1, drawn to its usual value by ``weight`` where there is little text, and stretched near its ends."""
    return float(np.arcsin(np.sqrt(min(1.0, (part + weight * usual) / (whole + weight)))))


def statistics(text: bytes | None) -> list[float]:
    """The transformed statistics of a whole text; null counts as empty."""
    text = text or b""
    found = text.split()
    n, size = len(found), len(text)
    lines = [x for x in text.split(b"\n") if x.strip()]
    if not n:
        return [0.0] * len(FEATURES)
    lowered = text.lower().split()
    seen: dict[bytes, int] = {}
    for w in lowered:
        seen[w] = seen.get(w, 0) + 1
    top = max(seen.values())
    letters = sum(map(len, found))
    repeated = sum(a == b for a, b in zip(lowered, lowered[1:], strict=False))
    short = sum(len(w) <= 3 for w in found)
    digits = size - len(text.translate(None, b"0123456789"))
    symbols = size - len(text.translate(None, _marks))
    # the exponent of a power law from words to distinct words, drawn to its usual value
    variety = np.log(len(seen) + 20) / np.log(n + 20)
    return [
        float(np.log1p(n)),
        float(np.log((letters + 100) / (n + 20))),
        float(np.log((n + 50) / (len(lines) + 2))),
        _share(len(_upper.findall(text)), letters, 0.02, 100),
        _share(digits, letters, 0.0, 100),
        _share(symbols, letters, 0.0, 100),
        _share(short, n, 0.35, 20),
        float(variety),
        _share(top, n, 0.05, 20),
        _share(repeated, n, 0.0, 20),
        float(np.log(max(map(len, found)) + 10)),
        _share(len(set(lines)), len(lines), 1.0, 2),
    ]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str | None = None) -> DataFrame:
    """``doc_id, x[, keep]``: the statistics of each whole text, one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array([statistics(t.as_py()) for t in batch.column(1)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), x, *batch.columns[2:]], names=names)

    kept = [keep] if keep else []
    names = ["doc_id", "x", *kept]
    kinds = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in kept)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"), *kept)
    return texts.mapInArrow(tidy(run), f"doc_id {docs.schema[id_col].dataType.simpleString()}, x array<double>{kinds}")


@dataclass(frozen=True)
class Discriminant:
    """Of each class: mean, inverse Cholesky factor, log density at the mean plus log prior."""

    means: tuple[np.ndarray, np.ndarray]
    whiten: tuple[np.ndarray, np.ndarray]
    level: tuple[float, float]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of ``x``."""
        part = [self.level[c] - 0.5 * (((x - self.means[c]) @ self.whiten[c].T) ** 2).sum(axis=1) for c in (0, 1)]
        return 1 / (1 + np.exp(np.clip(part[0] - part[1], -500, 500)))


def labelled_statistics(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", bound: int = BROADCAST_LABELS) -> DataFrame:
    """``doc_id, x, label`` of each document with each of its labels.

    Labels other than 0 and 1 are passed over. Up to ``bound`` labels are broadcast, and
    only their texts are read through; of more, the statistics of all texts are shuffled
    to the labels, never the texts.
    """
    label, own = private("label"), private("id")
    picked = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias(own), F.col(label_col).alias(label))
    if row_count_at_most(picked, bound):
        texts = docs.select(id_col, text_col).join(F.broadcast(picked), F.col(id_col) == F.col(own)).drop(own)
        return document_statistics(texts, id_col, text_col, label).withColumnRenamed(label, "label")
    return document_statistics(docs, id_col, text_col).join(picked, F.col("doc_id") == F.col(own)).select("doc_id", "x", F.col(label).alias("label"))


def fit(labelled: DataFrame, to_pooled: float = TO_POOLED, to_diagonal: float = TO_DIAGONAL) -> Discriminant:
    """Fit from all rows of ``labelled (x, label)``; only two rows of sums reach the driver.

    Repeated labels count as often as they occur. A class without rows takes the pooled form.
    """
    p = len(FEATURES)
    sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(p)]
    products = [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"q{i}_{j}") for i in range(p) for j in range(i, p)]
    rows = {r.label: r for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n"), *sums, *products).collect()}
    return solve({c: _moments(rows.get(c), p) for c in (0, 1)}, to_pooled, to_diagonal)


def _moments(row, p: int) -> tuple[int, np.ndarray, np.ndarray]:
    if row is None:
        return 0, np.zeros(p), np.zeros((p, p))
    s = np.array([row[f"s{i}"] for i in range(p)])
    q = np.array([[row[f"q{min(i, j)}_{max(i, j)}"] for j in range(p)] for i in range(p)])
    return row.n, s, q


def solve(moments: dict[int, tuple[int, np.ndarray, np.ndarray]], to_pooled: float, to_diagonal: float) -> Discriminant:
    """Shrunken class covariances from counts, sums and sums of products."""
    p = len(FEATURES)
    total = sum(n for n, _, _ in moments.values())
    scatter = {c: q - np.outer(s, s) / n if n else np.zeros((p, p)) for c, (n, s, q) in moments.items()}
    pooled = sum(scatter.values()) / max(1, total) + np.eye(p) * LEAST
    middle = sum(s for _, s, _ in moments.values()) / max(1, total)
    means, whiten, level = [], [], []
    for c in (0, 1):
        n, s, _ = moments[c]
        own = scatter[c] / n if n else pooled
        cov = (1 - to_pooled) * own + to_pooled * pooled
        cov = (1 - to_diagonal) * cov + to_diagonal * np.diag(np.diag(cov)) + np.eye(p) * LEAST
        factor = np.linalg.cholesky(cov)
        means.append(s / n if n else middle)
        whiten.append(np.linalg.inv(factor))
        level.append(float(-np.log(np.diag(factor)).sum() + np.log((n + 1) / (total + 2))))
    return Discriminant(tuple(means), tuple(whiten), tuple(level))


def probability(model: Discriminant) -> Callable[[Column], Column]:
    """A function of a column of texts: the probability of label 1 of each, where it stands."""

    @F.arrow_udf("double")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for held in texts:
                parts = slices([pa.RecordBatch.from_arrays([held], names=["text"])])
                found = [model.score(np.array([statistics(t.as_py()) for t in part.column(0)])) for part in parts]
                yield pa.array(np.concatenate(found) if found else np.empty(0))
        finally:
            forget_all()

    return lambda text: scored(text.cast("binary"))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", train: str | None = None) -> Discriminant:
    """The model from all ``labels`` of ``docs``; ``train`` is a condition on the ids that are learnt from."""
    return fit(labelled_statistics(docs.where(train) if train else docs, labels, id_col, text_col, label_col))


def held_out(doc_id: str = "doc_id"):
    return id_remainder(F.col(doc_id), 4) == 2


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", train: str | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` of every document, learnt from ``labels``.

    ``train`` names a boolean SQL condition on the id that the label rows learnt from
    must meet. Each row is scored by its own text, so rows that repeat an id, or have
    none, are scored each. Null and empty texts are scored like any other (all
    statistics 0). An empty table gives no rows; only the id and text columns are read.
    """
    score = probability(learn(docs, labels, id_col, text_col, label_col, train))
    found = docs.select(F.col(id_col).alias("doc_id"), score(F.col(text_col)).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", train: str | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with a score of ``threshold`` or more, all columns kept.

    Rows are judged by their own text where they lie, so nothing is joined back: of rows
    that repeat an id only the poor ones go, and rows without id are judged like others.
    """
    score = probability(learn(docs, labels, id_col, text_col, label_col, train))
    return docs.where(score(F.col(text_col)) >= threshold)


TRAIN = "coalesce(crc32(cast(cast(doc_id AS string) AS binary)) % 4, 0) <> 2"


def query(spark, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from the labels that are not held out."""
    found = classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"), train=TRAIN)
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")
