"""Toxicity by two Kneser-Ney language models, one of toxic and one of ordinary text.

The models are of the letters of a word, each given the word's letters before
it (at most five, and where the word begins), so the stem of an expression
counts in all its forms. Each class has the counts of labelled documents, a
word once per document, with absolute discounts; both back off to one shared
Kneser-Ney model: counts of the words of **all** documents, then continuation
counts of ever shorter histories. What a class has not seen has the shared
probability, so rare expressions weigh little until labels bear them out.

A word's difference is its log-likelihood under the toxic model less that under
the ordinary one. A document is compared by length-normalised differences: the
mean over its words, the mean of what its distinct words have beyond 1, 2 and 3 nats (so that
the many small differences of ordinary words do not hide an expression), and the
best means over windows of 1 and 2 words. A logistic step on these, fitted on
labelled documents that gave no counts, makes the score.

Class counts and the logistic step come from at most ``2 * PER_CLASS`` labelled
documents; the driver holds their n-grams, what the shared model says of these,
and nothing that grows beyond. The shared counts are gathered from every
document: tasks count n-grams, counts are added by n-gram. A null text is an
empty one and has a score; without labels of both kinds each score is the share
of toxic labels (0.5 without any). Repeated rows get equal scores; no rows, no
rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from rowlake.llm.common import cut
from rowlake.llm.labelled import documents_of, held_out, sample, sigmoid

#: Labelled documents of either label that are learned from.
PER_CLASS = 6_000
#: Labels of documents with this remainder are never learned from.
FOLDS, HELD = 4, 2
THRESHOLD = 0.3
#: One in so many sampled documents fits the logistic step and gives no counts.
CALIBRATION = 3
WINDOWS = (1, 2)
#: Nats beyond which differences of words are averaged, and the words added to the length for that.
BEYOND, FEW = (1.0, 2.0, 3.0), 10
FEATURES = len(WINDOWS) + len(BEYOND) + 2
#: Letters of history.
HISTORY = 5
#: Distinct words or n-grams a task holds before it hands them on.
COUNTED = 200_000
#: Words a worker remembers; a bound of memory that does not change results.
REMEMBERED = 1_000_000
#: Letters in lower case; all other signs part words.
WORD = regex.compile(r"\p{L}+")
BEGIN, END = "^", "$"
#: Differences of one word are kept within these.
LEAST, MOST = -4.0, 12.0


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams(word: str) -> list[str]:
    """History and letter of each place of a word, its end included."""
    line = BEGIN + word + END
    return [line[max(0, i - HISTORY) : i + 1] for i in range(1, len(line))]


def _table(counts: dict, names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    keys = zip(*counts, strict=True) if isinstance(next(iter(counts)), tuple) else [list(counts)]
    columns = [*map(list, keys), list(counts.values())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _corpus_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the n-grams of a task's words."""
    names, kinds = ["gram", "n"], [pa.string(), pa.int64()]
    found: Counter[str] = Counter()
    counts: Counter[str] = Counter()

    def spell() -> None:
        for word, n in found.items():
            for g in grams(word):
                counts[g] += n
        found.clear()

    for batch in batches:
        for text in batch.column(0).to_pylist():
            found.update(words(text or ""))
            if len(found) >= COUNTED:
                spell()
                if len(counts) >= 5 * COUNTED:
                    yield _table(counts, names, kinds)
                    counts.clear()
    spell()
    if counts:
        yield _table(counts, names, kinds)


def _class_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (label, n-gram) over a task's documents, each word once per document."""
    names, kinds = ["label", "gram", "n"], [pa.int32(), pa.string(), pa.int64()]
    counts: Counter[tuple[int, str]] = Counter()
    for batch in batches:
        for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
            for word in set(words(text)):
                counts.update([(label, g) for g in grams(word)])
            if len(counts) >= COUNTED:
                yield _table(counts, names, kinds)
                counts.clear()
    if counts:
        yield _table(counts, names, kinds)


def corpus_counts(docs: DataFrame) -> DataFrame:
    """``gram, n`` over the words of all documents."""
    return docs.select("text").mapInArrow(_corpus_grams, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def _discount(once: float, twice: float) -> float:
    """The absolute discount from the numbers of entries seen once and twice."""
    return once / (once + 2 * twice) if once and twice else 0.5


def _found(keys: pa.Array, of: pa.Array, values: np.ndarray, other: float) -> np.ndarray:
    """The value of each key, ``other`` for those that ``of`` does not have."""
    at = pc.index_in(keys, value_set=of)
    known = at.is_valid().to_numpy(zero_copy_only=False)
    out = np.full(len(keys), other)
    out[known] = values[at.drop_null().to_numpy()]
    return out


def _column(rows: pa.Table, name: str) -> pa.Array:
    return pa.concat_arrays(rows.column(name).chunks) if rows.column(name).num_chunks else pa.array([], rows.schema.field(name).type)


def shared_table(docs: DataFrame, wanted: DataFrame) -> tuple[pa.Array, np.ndarray]:
    """Each wanted ``gram``, and the shared probability of its last letter, given the letters before it.

    ``wanted`` is bounded by the sample. Levels: counts of full histories, then
    for each letter fewer the number of distinct longer n-grams that end so.
    The driver holds them as columns; as objects of Python they take ten times the memory.
    """
    shorter = "if(char_length(gram) > 1, substring(gram, 2), gram)"
    history = "left(gram, char_length(gram) - 1)"
    level, asked = cut(corpus_counts(docs)), wanted.select("gram").distinct()
    found = []
    for _ in range(HISTORY + 1):
        rows = level.withColumn("h", F.expr(history))
        histories = rows.groupBy("h").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        here = asked.withColumn("h", F.expr(history)).join(level, "gram", "left").join(histories, "h", "left")
        once, twice, kinds = level.agg(*[F.count_if(F.col("n") == i) for i in (1, 2)], F.count(F.lit(1))).first()
        here = here.na.fill(0).select("gram", F.expr(shorter).alias("shorter"), "n", "total", "kinds")
        found.append((here.toArrow(), _discount(once, twice), kinds))
        asked = asked.select(F.expr(shorter).alias("gram")).distinct()
        level = cut(level.select(F.expr(shorter).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n")))
    names, below = None, None
    while found:  # from the shortest n-grams up, a level at a time
        rows, d, kinds = found.pop()
        n, total, forms = (rows.column(c).to_numpy() for c in ("n", "total", "kinds"))
        lower = np.full(rows.num_rows, 1 / (kinds + 1)) if names is None else _found(_column(rows, "shorter"), names, below, 0.0)
        own = (np.maximum(n - d, 0) + d * forms * lower) / np.maximum(total, 1)
        names, below = _column(rows, "gram"), np.where(total > 0, own, lower)
    return names, below


def shared_model(docs: DataFrame, wanted: DataFrame) -> dict[str, float]:
    """:func:`shared_table` as a dict."""
    names, shares = shared_table(docs, wanted)
    return dict(zip(names.to_pylist(), shares.tolist(), strict=True))


@dataclass
class Model:
    """Log-likelihood differences by n-gram, and by history for other letters; the logistic step.

    The two tables are columns of names and values; what scores words makes dicts of them.
    """

    base: float
    tables: list[tuple[pa.Array, np.ndarray]] = field(default_factory=list, repr=False)
    weights: np.ndarray | None = None
    known: dict[str, float] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {"base": self.base, "tables": self.tables, "weights": self.weights, "known": {}}

    @cached_property
    def seen(self) -> dict[str, float]:
        return self._dict(0)

    @cached_property
    def other(self) -> dict[str, float]:
        return self._dict(1)

    def _dict(self, i: int) -> dict[str, float]:
        return dict(zip(self.tables[i][0].to_pylist(), self.tables[i][1].tolist(), strict=True)) if self.tables else {}

    def difference(self, word: str) -> float:
        total = 0.0
        for g in grams(word):
            d = self.seen.get(g)
            total += self.other.get(g[:-1], 0.0) if d is None else d
        return min(max(total, LEAST), MOST)

    def features(self, text: str) -> list[float]:
        known, found = self.known, words(text)
        if len(known) > REMEMBERED:
            known.clear()
        d = []
        for w in found:
            x = known.get(w)
            if x is None:
                x = known[w] = self.difference(w)
            d.append(x)
        if not d:
            d = [0.0]
        sums = np.concatenate([[0.0], np.cumsum(d)])
        best = [float((sums[min(k, len(d)) :] - sums[: len(sums) - min(k, len(d))]).max() / k) for k in WINDOWS]
        own = np.array([known[w] for w in dict.fromkeys(found)])  # a word once, however often it is repeated
        far = [math.log(2e-3 + float(np.maximum(own - t, 0).sum()) / (len(own) + FEW)) for t in BEYOND]
        return [float(sums[-1] / len(d)), *best, *far, math.log1p(len(own)) / 10]

    def scores(self, all_texts: list[str | None]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(all_texts), self.base)
        x = np.array([self.features(t or "") for t in all_texts]).reshape(len(all_texts), -1)
        return sigmoid(np.column_stack([x, np.ones(len(x))]) @ self.weights)


def class_differences(rows: pa.Table, names: pa.Array, shares: np.ndarray) -> list[tuple[pa.Array, np.ndarray]]:
    """The tables of :class:`Model` from counts of (label, gram, h, n), ``h`` the history, and the shared probabilities."""
    grams_of = rows.select(["gram", "h"]).group_by(["gram", "h"], use_threads=False).aggregate([])
    gram, h, histories = _column(grams_of, "gram"), _column(grams_of, "h"), _column(grams_of, "h").unique()
    shared = _found(gram, names, shares, 0.0)
    likelihoods, rests = [], []
    for label in (1, 0):
        own = rows.filter(pc.equal(rows["label"], label))
        n = own["n"].to_numpy()
        d = _discount(int((n == 1).sum()), int((n == 2).sum()))
        of = own.group_by("h", use_threads=False).aggregate([("n", "sum"), ("n", "count")])
        total, kinds, of_h = of["n_sum"].to_numpy(), of["n_count"].to_numpy(), _column(of, "h")
        rest = d * kinds / total
        share = (n - d) / _found(_column(own, "h"), of_h, total, 1)
        likelihoods.append(_found(gram, _column(own, "gram"), share, 0.0) + _found(h, of_h, rest, 1.0) * shared)
        rests.append(_found(histories, of_h, rest, 1.0))

    def logs(sides: list[np.ndarray]) -> np.ndarray:
        return np.fromiter(map(math.log, (sides[0] / sides[1]).tolist()), np.float64, len(sides[0]))

    return [(gram, logs(likelihoods)), (histories, logs(rests))]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Both models and the logistic step."""
    chosen = sample(labels, "toxic", FOLDS, HELD, PER_CLASS)
    apart = F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(CALIBRATION)) == 0
    counted = documents_of(docs, chosen.where(~apart)).mapInArrow(_class_grams, "label int, gram string, n bigint")
    of_class = cut(counted.groupBy("label", "gram").agg(F.sum("n").alias("n")))
    # The sample takes as many as it may of either label; the share is that of all labels.
    share = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(FOLDS, HELD)).agg(F.avg("toxic")).first()[0]
    model = Model(0.5 if share is None else float(share))
    if of_class.select("label").distinct().count() < 2:
        return model
    counts = of_class.withColumn("h", F.expr("left(gram, char_length(gram) - 1)"))
    names, shares = shared_table(docs, of_class)
    model.tables = class_differences(counts.toArrow(), names, shares)
    del names, shares
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [shared.value.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "label", "x"]
            )

    found = documents_of(docs, chosen.where(apart)).mapInArrow(features, "doc_id bigint, label int, x array<double>").toPandas()
    found = found.sort_values("doc_id")
    y = found["label"].to_numpy(dtype=np.float64)
    if len(set(y)) == 2:
        # Weights give each label the share it has among all labels.
        weight = np.where(y == 1, model.base / y.mean(), (1 - model.base) / (1 - y.mean()))
        model.weights = logistic(np.array(found["x"].tolist()), y, weight)
    return model


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Newton steps with a small penalty; the last weight is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    out = np.zeros(x.shape[1])
    penalty = np.full(len(out), 0.1)
    for _ in range(60):
        p = sigmoid(x @ out)
        slope = x.T @ (weight * (p - y)) + penalty * out
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty), slope)
        out -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return out


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(shared.value.scores(batch.column("text").to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return rows.select("doc_id", held_out(FOLDS, HELD).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
