"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each class gets a mean and a covariance of the statistics, shrunk towards the identity after pooled scaling. A score
is the calibrated difference of the two Gaussian log densities, whose Mahalanobis terms use Cholesky factors computed
once and shipped with the model.

The model is fitted on about ``max_rows`` labelled documents at most, picked by a hash of their id; only their texts are
read for it. Scores read whole texts, once, without a shuffle. The statistics of a text never see its id, source, language
or label.

Defined cases: null and empty texts have all statistics zero and get a score like any other; labels that are null
or meet no document are not used, several labels of one document are averaged; with labels of one class only, or none,
every score is that class's share (one half without labels); repeated rows score alike; an empty table gives no rows;
other columns pass through under any name, except ones named as the added columns, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import column, crc_fold, join_small, prefixed, working

_UPPER, _LOWER, _DIGIT = bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58))
_SYMBOLS, _STOPS = b"#*$%&|<>", b".!?"
_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
STATISTICS = (
    "words", "word_bytes", "upper", "symbols", "exclaims", "stops", "punctuation", "digits",
    "non_ascii", "repeats_next", "distinct", "dup_lines", "line_words", "bare_marks",
)


def statistics(text: bytes | None) -> list[float]:
    """Transformed statistics of a UTF-8 text, each of order one; logs and roots tame their tails."""
    words = text.split() if text else []
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    size = len(text)
    count = lambda chars: size - len(text.translate(None, chars))
    upper, lower = count(_UPPER), count(_LOWER)
    lines = [x for x in map(bytes.strip, text.split(b"\n")) if x]
    distinct = len(set(words))
    return [
        np.log(n),
        np.log(sum(map(len, words)) / n),
        (upper / max(1, upper + lower)) ** 0.5,
        (count(_SYMBOLS) / n) ** 0.5,
        (text.count(b"!") / n) ** 0.5,
        (count(_STOPS) / n) ** 0.5,
        (count(_PUNCTUATION) / n) ** 0.5,
        (count(_DIGIT) / size) ** 0.5,
        ((size - len(text.decode("utf-8", "replace"))) / size) ** 0.5,
        (sum(map(eq, words, words[1:])) / n) ** 0.5,
        np.log(distinct) / np.log(n + 1),
        (1 - len(set(lines)) / max(1, len(lines))) ** 0.5,
        np.log(n / max(1, len(lines))),
        (sum(1 for w in words if len(w) == 1 and w in _PUNCTUATION) / n) ** 0.5,
    ]


@dataclass
class Discriminant:
    """Fitted densities; ``factors`` are the inverses of the covariances' Cholesky factors."""

    scale: np.ndarray
    shift: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray
    slope: float
    offset: float

    def log_ratio(self, x: np.ndarray) -> np.ndarray:
        """Log density under label 1 less that under label 0."""
        z = (x - self.shift) / self.scale
        dens = [-0.5 * (((z - m) @ f.T) ** 2).sum(axis=1) - 0.5 * d for m, f, d in zip(self.means, self.factors, self.log_dets, strict=True)]
        return dens[1] - dens[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.log_ratio(x) + self.offset, -30, 30)))


def _calibration(r: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic curve over squashed log ratios, by penalised Newton steps."""
    a, target = np.zeros(2), np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    x = np.stack([r, np.ones_like(r)], axis=1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        gradient = x.T @ (p - target) + 1e-6 * a
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), gradient)
        a -= step * min(1, 1 / max(1e-12, np.abs(step).max()))
    return float(max(a[0], 0.0)), float(a[1])


def fit(x: np.ndarray, y: np.ndarray, shrinkage: float = 0.1) -> Discriminant:
    """Fits both classes; falls back to a constant score when a class has no rows."""
    d = len(STATISTICS)
    counts = [(y == k).sum() for k in (0, 1)]
    if min(counts) == 0:
        share = (counts[1] + 0.5) / (sum(counts) + 1) if sum(counts) == 0 else float(counts[1] > 0)
        offset = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
        return Discriminant(np.ones(d), np.zeros(d), np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2), 0.0, offset)
    shift, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = (x - shift) / scale
    means, factors, log_dets = [], [], []
    for k in (0, 1):
        own = z[y == k]
        centred = own - own.mean(axis=0)
        covariance = (1 - shrinkage) * centred.T @ centred / len(own) + shrinkage * np.eye(d)
        low = np.linalg.cholesky(covariance)
        means.append(own.mean(axis=0))
        factors.append(np.linalg.inv(low))
        log_dets.append(2 * np.log(np.diag(low)).sum())
    model = Discriminant(scale, shift, np.array(means), np.array(factors), np.array(log_dets), 1.0, 0.0)
    model.slope, model.offset = _calibration(np.clip(model.log_ratio(x), -50, 50), y)
    return model


def _statistics_of(column: pa.Array) -> np.ndarray:
    rows = [statistics(t.as_buffer().to_pybytes() if t.is_valid else None) for t in column]
    return np.array(rows, np.float64).reshape(len(rows), len(STATISTICS))


def train(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", max_rows: int = 20_000, shrinkage: float = 0.1, text_col: str = "text") -> Discriminant:
    """Fits on documents (doc_id, text) that have a label and pass ``learn``; about ``max_rows`` at most, by hash of id."""
    labels = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & learn)
    share = F.lit(min(1.0, max_rows / max(1, labels.count())) * 1e6)
    labels = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share)
    labels = labels.groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("_label"))
    texts = docs.select("doc_id", column(text_col).alias("_text"))
    rows = join_small(texts, labels, "doc_id", limit=2 * max_rows).select("doc_id", "_text", "_label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = pa.array(list(_statistics_of(batch.column("_text"))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "_stats": stats, "_label": batch.column("_label")})

    measured = rows.mapInArrow(run, rows.select("doc_id").schema.add("_stats", T.ArrayType(T.DoubleType())).add("_label", "integer"))
    found = measured.orderBy("doc_id", "_stats").limit(2 * max_rows).collect()
    x = np.array([r["_stats"] for r in found], np.float64).reshape(len(found), len(STATISTICS))
    return fit(x, np.array([r["_label"] for r in found], np.int64), shrinkage)


def with_scores(docs: DataFrame, model: Discriminant, threshold: float = 0.7, text_col: str = "text", added: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """``docs`` with the ``added`` columns: the score, and 1 where it reaches the threshold."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in added]
    renamed = docs.select(*[prefixed(c) for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shipped.value.scores(_statistics_of(batch.column(working(text_col))))
            cols = dict(zip(batch.schema.names, batch.columns, strict=True))
            cols |= {"_score": pa.array(scores, pa.float64()), "_predicted": pa.array((scores >= threshold).astype(np.int32))}
            yield pa.RecordBatch.from_pydict(cols)

    out = renamed.mapInArrow(run, T.StructType(list(renamed.schema)).add("_score", "double").add("_predicted", "integer"))
    return out.select(*[F.col(working(c)).alias(c) for c in kept], F.col("_score").alias(added[0]), F.col("_predicted").alias(added[1]))


def held_out(doc_id: Column) -> Column:
    return crc_fold(doc_id, 4) == 2


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The registered query's columns, one row per document."""
    docs = docs.select("doc_id", "text")
    out = with_scores(docs, train(docs, labels, ~held_out(F.col("doc_id"))))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``docs`` without the documents that the classifier, fitted on the labels' learning rows, rejects."""
    model = train(docs, labels, ~held_out(F.col("doc_id")))
    renamed = docs.select(*[prefixed(c, "_own_") for c in docs.columns])
    scored = with_scores(renamed, model, threshold, working("text", "_own_"), ("_score", "_good"))
    return scored.where("_good = 1").select(*[F.col(working(c, "_own_")).alias(c) for c in docs.columns])
