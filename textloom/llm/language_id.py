"""Language identification with a small byte convolutional network, trained in numpy.

Bytes are embedded, filters of several widths slide over fixed-length windows, each filter's greatest response in a
window feeds a softmax layer, and a document's logits are the mean of its windows'. For prediction the embedding and
filters fold into tables by byte and byte pair, which gives the same responses as the convolution.

Every language is learned, from ``max_docs`` documents of each at most, picked by a hash of their id and text and read
whole: all their windows take part. Prediction reads whole texts, the windows of many documents at a time.

Defined cases: null texts and texts without a letter give ``und`` with score 0; null languages are not learned; with
one language learned it is always predicted, with none everything is ``und``; repeated rows get the same answer;
a text of any length counts every byte; other columns pass through :func:`predict` under any name, except the added ones,
which are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import column, crc_fold, join_small, prefixed, working

WINDOW, WIDTHS, FILTERS, EMBED = 256, (2, 3, 4), 16, 8
#: Windows whose responses are computed at a time.
BATCH = 512
#: Text bytes whose windows are asked together.
TOGETHER = 1 << 20
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def windows_of(text: bytes) -> np.ndarray:
    """The whole text as rows of WINDOW bytes, the last one padded with zeros."""
    n = -(-len(text) // WINDOW)
    out = np.zeros(n * WINDOW, np.uint8)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(n, WINDOW)


@dataclass
class ByteConvNet:
    langs: list[str]
    embed: np.ndarray  # (256, EMBED)
    filters: list[np.ndarray]  # by width: (width, EMBED, FILTERS)
    bias: np.ndarray  # (len(WIDTHS) * FILTERS,)
    dense: np.ndarray  # (len(WIDTHS) * FILTERS, languages)
    dense_bias: np.ndarray

    def tables(self) -> list[list[tuple[int, int, np.ndarray]]]:
        """By width: (offset, bytes looked up, table) whose sum is the filter's response at a position."""
        out = []
        for width, f in zip(WIDTHS, self.filters, strict=True):
            by_byte = [(self.embed @ f[j]).astype(np.float32) for j in range(width)]
            parts = []
            for j in range(0, width - 1, 2):
                pair = by_byte[j + 1][None, :, :] + by_byte[j][:, None, :]  # index: first byte * 256 + second
                parts.append((j, 2, pair.reshape(65536, FILTERS)))
            if width % 2:
                parts.append((width - 1, 1, by_byte[-1]))
            out.append(parts)
        return out

    def pooled(self, windows: np.ndarray, tables: list, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Each filter's greatest response in each window, and its position."""
        best, place = [], []
        one = windows.astype(np.intp)
        two = one[:, :-1] * 256 + one[:, 1:]
        for width, parts in zip(WIDTHS, tables, strict=True):
            n = windows.shape[1] - width + 1
            total = None
            for offset, size, table in parts:
                got = np.take(table, (two if size == 2 else one)[:, offset : offset + n], axis=0)
                total = got if total is None else np.add(total, got, out=total)
            best.append(total.max(axis=1))
            if where:
                place.append(total.argmax(axis=1))
        return np.concatenate(best, axis=1) + self.bias, np.concatenate(place, axis=1) if where else None

    def logits(self, windows: np.ndarray, tables: list) -> np.ndarray:
        pools = [np.maximum(self.pooled(windows[i : i + BATCH], tables)[0], 0) for i in range(0, len(windows), BATCH)]
        return np.concatenate(pools) @ self.dense + self.dense_bias


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(windows: np.ndarray, y: np.ndarray, langs: list[str], weight: np.ndarray | None = None, steps: int = 500, batch: int = 64, rate: float = 0.01, seed: int = 7) -> ByteConvNet:
    """Trains by Adam on cross entropy; windows are drawn by ``weight``, and the same rows give the same network.

    More languages take more steps: ``steps`` serve 8 languages.
    """
    rng = np.random.default_rng(seed)
    k = len(WIDTHS) * FILTERS
    net = ByteConvNet(
        langs, rng.normal(0, 0.5, (256, EMBED)), [rng.normal(0, 0.4, (w, EMBED, FILTERS)) for w in WIDTHS],
        np.zeros(k), rng.normal(0, 0.2, (k, len(langs))), np.zeros(len(langs)),
    )
    if len(langs) < 2 or not len(windows):
        return net
    params = [net.embed, *net.filters, net.bias, net.dense, net.dense_bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    upto = np.cumsum(np.ones(len(windows)) if weight is None else weight)
    for step in range(1, steps * max(1, -(-len(langs) // 8)) + 1):
        pick = np.minimum(np.searchsorted(upto, rng.random(batch) * upto[-1]), len(windows) - 1)
        x, rows = windows[pick], np.arange(batch)[:, None]
        raw, place = net.pooled(x, net.tables(), where=True)
        pool = np.maximum(raw, 0)
        error = _softmax(pool @ net.dense + net.dense_bias)
        error[np.arange(batch), y[pick]] -= 1
        error /= batch
        back = (error @ net.dense.T) * (raw > 0)
        grads = [np.zeros_like(net.embed), *[np.zeros_like(f) for f in net.filters], back.sum(axis=0), pool.T @ error, error.sum(axis=0)]
        for i, width in enumerate(WIDTHS):
            own = slice(i * FILTERS, (i + 1) * FILTERS)
            g, at = back[:, own], place[:, own]
            for j in range(width):
                seen = x[rows, at + j]  # the byte under tap j of each filter's best position
                grads[1 + i][j] = np.einsum("nf,nfe->ef", g, net.embed[seen])
                np.add.at(grads[0], seen.ravel(), (g[:, :, None] * net.filters[i][j].T[None]).reshape(-1, EMBED))
        for p, grad, (m, v) in zip(params, grads, moments, strict=True):
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def held_out(doc_id: Column) -> Column:
    return crc_fold(doc_id, 5) == 0


def sample(docs: DataFrame, learn: Column, max_docs: int) -> DataFrame:
    """(text, lang): of each language, the ``max_docs`` rows that pass ``learn`` with the least hashes; all if there are fewer."""
    rows = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & learn)
    rows = rows.select("text", "lang", F.xxhash64("doc_id", "text").alias("_h"))
    shares = rows.groupBy("lang").agg(F.count("*").alias("_n"))
    # four times the wanted share is about sure to hold enough rows, and spares the rank most of them
    near = F.pmod("_h", F.lit(1_000_000)) * F.greatest(F.col("_n"), F.lit(1)) <= F.lit(4e6 * max_docs)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_h", F.xxhash64(F.lit(1), "text")))
    few = join_small(rows, shares, "lang").where((F.col("_n") <= 4 * max_docs) | near)
    return few.select("text", "lang", rank.alias("_k")).where(F.col("_k") <= max_docs).select("text", "lang")


def train(docs: DataFrame, learn: Column, max_docs: int = 400, **options) -> ByteConvNet:
    """Fits on a sample of rows (doc_id, text, lang) that pass ``learn``, bounded by ``max_docs`` for each language."""
    picked = sorted((r["lang"], r["text"].encode()) for r in sample(docs, learn, max_docs).collect())
    langs = sorted({lang for lang, _ in picked})
    pieces = [(windows_of(text), langs.index(lang)) for lang, text in picked if text]
    x = np.concatenate([w for w, _ in pieces]) if pieces else np.zeros((0, WINDOW), np.uint8)
    y = np.repeat([k for _, k in pieces], [len(w) for w, _ in pieces]).astype(np.int64) if pieces else np.zeros(0, np.int64)
    # windows are drawn by document, so that a long text does not outweigh its language
    weight = np.concatenate([np.full(len(w), 1 / len(w)) for w, _ in pieces]) if pieces else np.zeros(0)
    return fit(x, y, langs, weight, **options)


def lettered(raw: bytes) -> bool:
    return bool(_ASCII_LETTER.search(raw)) or any(map(str.isalpha, raw.decode("utf-8", "replace")))


def answers(net: ByteConvNet, tables: list, texts: list[bytes]) -> list[tuple[str, float]]:
    """The language and score of each text; the windows of all texts run through the network together."""
    out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
    asked = [k for k, t in enumerate(texts) if lettered(t)] if net.langs else []
    if not asked:
        return out
    rows = [windows_of(texts[k]) for k in asked]
    first = np.cumsum([0, *(len(r) for r in rows[:-1])])
    weights = np.full(first[-1] + len(rows[-1]), float(WINDOW))
    ends = np.append(first[1:], len(weights)) - 1
    weights[ends] = [len(texts[k]) - WINDOW * (len(r) - 1) for k, r in zip(asked, rows, strict=True)]
    logits = net.logits(np.concatenate(rows), tables) * weights[:, None]
    p = _softmax(np.add.reduceat(logits, first, axis=0) / np.add.reduceat(weights, first)[:, None])
    for k, best, score in zip(asked, p.argmax(axis=1).tolist(), p.max(axis=1).tolist(), strict=True):
        out[k] = net.langs[best], score
    return out


def predict(docs: DataFrame, net: ByteConvNet, text_col: str = "text", added: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the ``added`` columns in place of its text."""
    shipped = docs.sparkSession.sparkContext.broadcast(net)
    kept = [c for c in docs.columns if c != text_col and c not in added]
    renamed = docs.select(column(text_col).alias("_text"), *[prefixed(c) for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shipped.value
        tables = net.tables()
        for batch in batches:
            found, texts, held = [], [], 0
            for text in batch.column("_text"):
                texts.append(text.as_buffer().to_pybytes() if text.is_valid else b"")
                held += len(texts[-1])
                if held >= TOGETHER:
                    found += answers(net, tables, texts)
                    texts, held = [], 0
            found += answers(net, tables, texts)
            cols = {n: batch.column(n) for n in batch.schema.names if n != "_text"}
            cols |= {"_lang": pa.array([x for x, _ in found], pa.string()), "_score": pa.array([x for _, x in found], pa.float64())}
            yield pa.RecordBatch.from_pydict(cols)

    out = renamed.mapInArrow(run, renamed.drop("_text").schema.add("_lang", "string").add("_score", "double"))
    return out.select(*[F.col(working(c)).alias(c) for c in kept], F.col("_lang").alias(added[0]), F.col("_score").alias(added[1]))


def digest(docs: DataFrame) -> DataFrame:
    """The registered query's columns, one row per document."""
    net = train(docs, ~held_out(F.col("doc_id")))
    return predict(docs.select("doc_id", "text"), net).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
