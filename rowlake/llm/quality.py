"""A quality classifier: random-indexing word vectors, pooled per document, and a small network.

Words (runs of letters and digits, or of other signs) fall into a fixed number
of hash buckets. Each bucket has a sparse random index vector; a word's vector
is the sum of the index vectors of its neighbours over **all** documents. Tasks
add up whole numbers for their part, which are added by bucket, so the sum does
not depend on the order. A document is the mean and the spread of the vectors
of its words. A two-layer network in numpy learns from a bounded sample of
labelled documents, each label weighted to the share it has among all labels;
a temperature fitted on a fifth of them that it has not seen, with the same
weights, makes its outputs probabilities.

What the driver holds is fixed in size: ``BUCKETS`` x ``WIDTH`` numbers and the
features of at most ``2 * PER_CLASS`` documents. Inputs of a score are the
words of the text alone. A null text is an empty one, which has a score too.
Without labels of both kinds every score is the share of good labels (0.5
without any). Repeated rows get equal scores; no rows, no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from rowlake.llm.labelled import documents_of, held_out, sample, sigmoid, usable

BUCKETS = 1 << 15
WIDTH = 32
#: Neighbours on either side that make up a word's context.
REACH = 2
#: Labelled documents of either label that are learned from.
PER_CLASS = 8_000
HIDDEN = 24
#: Words at which a document's features count half.
FEW = 8
EPOCHS = 40
SEED = 7
#: Labels of documents with this remainder are never learned from.
FOLDS, HELD = 3, 1
#: Words handled at once.
STEP = 1 << 18
FEATURES = 2 * WIDTH + 3
WORD = re.compile(r"\w+|[^\w\s]+")


@lru_cache(maxsize=1)
def _index() -> np.ndarray:
    """Per bucket the places of its +1 and its -1."""
    rng = np.random.default_rng(SEED)
    plus = rng.integers(0, WIDTH, BUCKETS)
    return np.stack([plus, (plus + rng.integers(1, WIDTH, BUCKETS)) % WIDTH]).astype(np.int64)


_seen: dict[str, int] = {}


def buckets(text: str) -> np.ndarray:
    """The bucket of each word of a text."""
    words = WORD.findall(text)
    if len(_seen) > 1_000_000:
        _seen.clear()
    out = np.empty(len(words), dtype=np.int64)
    known = _seen.get
    for i, w in enumerate(words):
        b = known(w)
        if b is None:
            b = _seen[w] = crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS
        out[i] = b
    return out


def _add_contexts(total: np.ndarray, words: np.ndarray) -> None:
    """Adds to each word's row the index vectors of its neighbours; -1 separates documents."""
    plus, minus = _index()
    for by in range(1, REACH + 1):
        a, b = words[:-by], words[by:]
        ok = (a >= 0) & (b >= 0)
        for k in range(1, by):
            ok &= words[k : len(words) - by + k] >= 0
        a, b = a[ok], b[ok]
        for x, y in ((a, b), (b, a)):
            total += np.bincount(x * WIDTH + plus[y], minlength=total.size)
            total -= np.bincount(x * WIDTH + minus[y], minlength=total.size)


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS * WIDTH, dtype=np.int64)
    held: list[np.ndarray] = []
    size = 0
    end = np.full(1, -1, dtype=np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            held += [buckets(text or ""), end]
            size += len(held[-2]) + 1
            if size >= STEP:
                _add_contexts(total, np.concatenate(held))
                held, size = [], 0
    if held:
        _add_contexts(total, np.concatenate(held))
    yield from _rows(total)


def _rows(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    rows = total.reshape(BUCKETS, WIDTH)
    kept = np.flatnonzero(rows.any(axis=1))
    if len(kept):
        flat = pa.array(rows[kept].ravel())
        sums = pa.ListArray.from_arrays(pa.array(np.arange(0, flat.__len__() + 1, WIDTH), pa.int32()), flat)
        yield pa.RecordBatch.from_arrays([pa.array(kept.astype(np.int32)), sums], ["bucket", "sums"])


def _total_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((BUCKETS, WIDTH), dtype=np.int64)
    for batch in batches:
        sums = batch.column("sums").flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
        np.add.at(total, batch.column("bucket").to_numpy(zero_copy_only=False), sums)
    yield from _rows(total.ravel())


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The vector of every bucket from its contexts in all documents, of length 1 (0 if it never occurs)."""
    schema = "bucket int, sums array<bigint>"
    partial = docs.select("text").mapInArrow(_partial_sums, schema)
    rows = partial.repartition("bucket").mapInArrow(_total_sums, schema).toArrow()
    out = np.zeros((BUCKETS, WIDTH), dtype=np.float64)
    if rows.num_rows:
        sums = rows.column("sums").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
        out[rows.column("bucket").to_numpy()] = sums
    out = np.sign(out) * np.log1p(np.abs(out))
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(text: str, vectors: np.ndarray) -> np.ndarray:
    """The features of a document: mean and spread of its word vectors, how alike neighbours are, its size."""
    words = buckets(text)
    if not len(words):
        return np.zeros(FEATURES)
    one, two, alike = np.zeros(WIDTH), np.zeros(WIDTH), 0.0
    for at in range(0, len(words), STEP):
        part = vectors[words[at : at + STEP]]
        one += part.sum(axis=0, dtype=np.float64)
        two += np.einsum("ij,ij->j", part, part, dtype=np.float64)
        alike += float(np.einsum("ij,ij->", part[1:], part[:-1], dtype=np.float64))
    mean = one / len(words)
    spread = np.sqrt(np.maximum(two / len(words) - mean * mean, 0))
    return np.concatenate([mean, spread, [np.linalg.norm(mean), alike / len(words), np.log1p(len(words)) / 10]])


@dataclass
class Network:
    """Two layers; ``temperature`` divides what the second one says. Without layers, a constant."""

    base: float
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    layers: tuple[np.ndarray, ...] = ()
    temperature: float = 1.0

    def standard(self, x: np.ndarray) -> np.ndarray:
        """Features in units of their spread; those of a few words are drawn to the mean of all."""
        n = np.expm1(10 * x[:, -1:])
        return (x - self.centre) / self.scale * (n / (n + FEW))

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh(self.standard(x) @ w1 + b1) @ w2 + b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.layers:
            return np.full(len(x), self.base)
        return sigmoid(self.logits(x) / self.temperature)


def train(x: np.ndarray, y: np.ndarray, share: float | None = None) -> Network:
    """Fits the layers on four of five rows and the temperature on the rest; rows come in a fixed order.

    ``share`` is that of good labels among all usable ones (None: that of ``y``); rows are
    weighted by it, so that a bound on either label in the sample does not move the scores.
    """
    base = (float(y.mean()) if len(y) else 0.5) if share is None else share
    if len(np.unique(y)) < 2 or len(y) < 10:
        return Network(base)
    rng = np.random.default_rng(SEED)
    apart = np.zeros(len(y), dtype=bool)
    apart[4::5] = True
    weight = np.where(y == 1, base / y.mean(), (1 - base) / (1 - y.mean()))
    fit_x, fit_y, fit_w = x[~apart], y[~apart], weight[~apart]
    centre = np.average(fit_x, axis=0, weights=fit_w)
    net = Network(base, centre, np.sqrt(np.average((fit_x - centre) ** 2, axis=0, weights=fit_w)) + 1e-3)
    size = x.shape[1]
    params = [rng.normal(0, size**-0.5, (size, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    z = net.standard(fit_x)
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(len(z)), max(1, len(z) // 256)):
            a, t, w = z[rows], fit_y[rows], fit_w[rows]
            h = np.tanh(a @ params[0] + params[1])
            d = w * (sigmoid(h @ params[2] + params[3]) - t) / len(rows)
            back = np.outer(d, params[2]) * (1 - h * h)
            grads = [a.T @ back + 1e-4 * params[0], back.sum(axis=0), h.T @ d + 1e-4 * params[2], d.sum(keepdims=True)]
            step += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                params[i] = params[i] - 3e-3 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    net.layers = tuple(params)
    if apart.any():
        said, truth, w = net.logits(x[apart]), y[apart], weight[apart]
        options = np.geomspace(0.25, 8, 61)
        loss = [(w * np.logaddexp(0, np.where(truth == 1, -said, said) / t)).mean() for t in options]
        net.temperature = float(options[int(np.argmin(loss))])
    return net


@dataclass
class Model:
    vectors: np.ndarray
    network: Network

    def scores(self, all_texts: list[str | None]) -> np.ndarray:
        if not all_texts:
            return np.zeros(0)
        return self.network.scores(np.array([pooled(t or "", self.vectors) for t in all_texts]))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Word vectors from all documents, the network from a sample of labelled ones."""
    vectors = word_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [pooled(t, shared.value) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "label", "x"]
            )

    # The sample takes as many as it may of either label; the share is that of all labels of these documents.
    ids = docs.select(F.col("doc_id").try_cast("bigint").alias("doc_id"))
    share = usable(labels, "quality", FOLDS, HELD).join(ids, "doc_id", "left_semi").agg(F.avg("label")).first()[0]
    chosen = documents_of(docs, sample(labels, "quality", FOLDS, HELD, PER_CLASS))
    found = chosen.mapInArrow(features, "doc_id bigint, label int, x array<double>").toArrow()
    order = np.argsort(found.column("doc_id").to_numpy(), kind="stable")
    x = np.array(found.column("x").to_pylist(), dtype=np.float64).reshape(-1, FEATURES)[order]
    return Model(vectors, train(x, found.column("label").to_numpy().astype(np.float64)[order], share))


def _scored(docs: DataFrame, model: Model, kept: bool) -> DataFrame:
    """The rows of ``docs`` under the names ``c0, c1 ...``, and their ``score``; ``kept``: only those at 0.5 or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.scores(batch.column(at).to_pylist())
            out = pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "score"])
            yield out.filter(pa.array(scores >= 0.5)) if kept else out

    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField("score", T.DoubleType())]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    rows = _scored(docs.select("doc_id", "text"), model, kept=False).withColumnRenamed("c0", "doc_id")
    return rows.select("doc_id", held_out(FOLDS, HELD).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows, with all columns, that the model accepts."""
    return _scored(docs, model, kept=True).drop("score").toDF(*docs.columns)
