r"""Ranked lexical search in the manner of LEMP: documents as impact vectors, in buckets by their lengths.

The score of a document for an item is an inner product: weights of the item's
terms times impacts of the document's. One pass over the texts keeps, of each
document, its number of terms and the counts of terms that any item has. From
the counts of the whole corpus follow weights, impacts and the Euclidean length
of every vector. Vectors are dealt by ranges of length, longest first (a hash
of the id splits equal lengths, so copies spread out), and written. Then:

- the longest ``FIRST_SHARE`` of them is searched first; the last of an item's
  best there is its threshold for all others;
- a bucket is passed over for an item where the item's length times the
  longest vector of the bucket is below the threshold (Cauchy-Schwarz);
- inside a bucket, the item's ``FOCUS`` heaviest coordinates give each vector
  the bound *partial product + rest of the item times rest of the vector*;
- vectors that could reach the threshold have their score computed in integers.

Bounds are in doubles with a margin far above their error, and whatever ties
with a threshold is kept, so nothing that ranks is lost. A task hands on at
most ``BEST`` rows per item; these are cut to ``BEST`` in salted groups, then
per item. Items are read in blocks of about ``BLOCK_BYTES`` of text, one search
each, so what tasks and the driver hold of them is bounded however many there are.

Results for odd input: null or empty texts and texts without terms have no
rows; nor have items without terms. Repeated documents are each ranked; rows of
documents without an id come last among equal scores. Item rows that agree in
id and text are one item, others are items of their own. Empty tables give no
rows. Further columns may have any name.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rowlake.llm.common import per_batch, texts, utf8
from rowlake.workspace import new_folder

BEST = 50
FIRST_SHARE = 1 / 64
#: Vectors of a bucket, and coordinates that are looked at before the others.
BUCKET = 4096
FOCUS = 8
BLOCK_BYTES = 4 << 20
#: Groups that one item's rows are cut in before they meet.
SALTS = 32
#: Relative margin of the bounds, which are sums of doubles.
MARGIN = 1e-9

# Impacts are ONE * tf div (SATURATION * tf + LENGTH * m), and m is FLAT plus SLOPE times the relative length.
ONE, SATURATION, LENGTH = 1_000_000_000, 1000, 20
FLAT, SLOPE = 100 - 50, 50

#: Bytes of a term stay, A-Z as a-z; all else is a blank.
_TERM = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERM).split()


def weight(documents: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holders + 1)))


# -- items ---------------------------------------------------------------------


@dataclass(frozen=True)
class Item:
    """One item of a block: its terms by number, heaviest first, with their weights and what bounds need."""

    terms: np.ndarray
    weights: np.ndarray
    length: float
    rest: float  # length without the focus coordinates

    @staticmethod
    def of(numbers: list[int], weights: np.ndarray) -> "Item":
        own = np.array(sorted(numbers, key=lambda t: (-weights[t], t)), dtype=np.int64)
        w = weights[own]
        own, w = own[w > 0], w[w > 0]
        squares = w.astype(np.float64) ** 2
        return Item(own, w, math.sqrt(squares.sum()), math.sqrt(squares[FOCUS:].sum()))


def item_blocks(items: DataFrame) -> Iterator[list[tuple[object, list[bytes]]]]:
    """The items with terms, as (id, distinct terms), in blocks of about ``BLOCK_BYTES`` of text."""
    own = items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    size = own.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    placed = own.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    for block in range(blocks):
        read = placed.where(F.col("block") == block).collect()
        found = [(r.item_id, sorted(set(terms(r.text.encode())))) for r in read]
        if kept := [(i, t) for i, t in found if t]:
            yield kept


# -- vectors -------------------------------------------------------------------


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Where each list begins (and the last one ends), and the values of all."""
    lengths = np.diff(column.offsets.to_numpy())
    return np.concatenate([[0], np.cumsum(lengths)]), column.flatten().to_numpy(zero_copy_only=False)


def _list_array(begins: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(values, pa.int32()))


def counted(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, counts``: how many terms each document has, and the counts of the numbered ones."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        total, begins, numbers, counts = [], [0], [], []
        for text in utf8(batch):
            words = terms(text)
            total.append(len(words))
            for word, n in Counter(words).items():
                if (i := number.get(word)) is not None:
                    numbers.append(i)
                    counts.append(n)
            begins.append(len(numbers))
        columns = [batch.column("doc_id"), pa.array(total, pa.int64()), _list_array(begins, numbers), _list_array(begins, counts)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "counts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(texts(docs), run, f"doc_id {kind}, n bigint, terms array<int>, counts array<int>")


def impacts(counts: np.ndarray, middle: np.ndarray) -> np.ndarray:
    return (ONE * counts) // (SATURATION * counts + LENGTH * middle)


def vectors(known: DataFrame, documents: int, all_terms: int) -> DataFrame:
    """``doc_id, norm, terms, impacts`` of every document that shares a term with an item."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        begins, counts = _lists(batch.column("counts"))
        middle = FLAT + (SLOPE * batch.column("n").to_numpy() * documents) // all_terms
        own = impacts(counts.astype(np.int64), np.repeat(middle, np.diff(begins)))
        squares = np.add.reduceat(own.astype(np.float64) ** 2, begins[:-1])
        columns = [batch.column("doc_id"), pa.array(np.sqrt(squares)), batch.column("terms"), _list_array(begins, own)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "norm", "terms", "impacts"])

    kind = known.schema["doc_id"].dataType.simpleString()
    shared = known.where(F.size("terms") > 0)
    return per_batch(shared, run, f"doc_id {kind}, norm double, terms array<int>, impacts array<int>")


# -- search --------------------------------------------------------------------


class Bucket:
    """Some vectors by coordinate: the places and impacts of each term's entries."""

    def __init__(self, norms: np.ndarray, begins: np.ndarray, numbers: np.ndarray, own: np.ndarray):
        rows = np.repeat(np.arange(len(norms)), np.diff(begins))
        order = np.argsort(numbers, kind="stable")
        self.norms, self.longest = norms, float(norms.max())
        self.rows, self.impacts, numbers = rows[order], own[order].astype(np.int64), numbers[order]
        self.terms, self.starts = np.unique(numbers, return_index=True)
        self.stops = np.append(self.starts[1:], len(numbers))

    def entries(self, wanted: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, impacts and weights of all entries of the wanted terms."""
        at = np.searchsorted(self.terms, wanted)
        at[at == len(self.terms)] = 0
        met = self.terms[at] == wanted
        at, weights = at[met], weights[met]
        if not len(at):
            none = np.zeros(0, dtype=np.int64)
            return none, none, none
        places = np.concatenate([np.arange(self.starts[i], self.stops[i]) for i in at])
        return self.rows[places], self.impacts[places], np.repeat(weights, self.stops[at] - self.starts[at])

    def scores(self, item: Item, threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose score is above 0 and not below the threshold, and their scores."""
        none = np.zeros(0, dtype=np.int64)
        if item.length * self.longest * (1 + MARGIN) < threshold:
            return none, none
        n = len(self.norms)
        rows, own, weights = self.entries(item.terms[:FOCUS], item.weights[:FOCUS])
        own = own.astype(np.float64)
        partial = np.bincount(rows, own * weights, n)
        others = np.sqrt(np.maximum(self.norms**2 * (1 + MARGIN) - np.bincount(rows, own**2, n), 0))
        alive = (partial + item.rest * others) * (1 + MARGIN) + 1 >= threshold
        if not alive.any():
            return none, none
        rows, own, weights = self.entries(item.terms, item.weights)
        kept = alive[rows]
        exact = np.zeros(n, dtype=np.int64)
        np.add.at(exact, rows[kept], own[kept] * weights[kept])
        found = np.flatnonzero((exact > 0) & (exact >= threshold))
        return found, exact[found]


def _ranked(row: tuple) -> tuple:
    score, doc_id = row
    return (-score, doc_id is None, 0 if doc_id is None else doc_id)


def best_of(rows: list[tuple], most: int) -> list[tuple]:
    return sorted(rows, key=_ranked)[:most]


def search(found: DataFrame, items: list[Item], thresholds: list[int], best: int) -> DataFrame:
    """``item, doc_id, score``: the best of each task for each item, none below the item's threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = list(thresholds)
        held: list[list[tuple]] = [[] for _ in items]
        for batch in batches:
            for at in range(0, batch.num_rows, BUCKET):
                part = batch.slice(at, BUCKET)
                begins, numbers = _lists(part.column("terms"))
                bucket = Bucket(part.column("norm").to_numpy(), begins, numbers, _lists(part.column("impacts"))[1])
                ids = part.column("doc_id")
                for i, item in enumerate(items):
                    rows, scores = bucket.scores(item, least[i])
                    if len(rows) > best:  # only what can be among the best of this bucket, ties with all their ids
                        kept = scores >= np.partition(scores, len(scores) - best)[len(scores) - best]
                        rows, scores = rows[kept], scores[kept]
                    if len(rows):
                        own = zip(scores.tolist(), ids.take(pa.array(rows)).to_pylist(), strict=True)
                        held[i] = best_of([*held[i], *own], best)
                        if len(held[i]) == best:
                            least[i] = max(least[i], held[i][-1][0])
        rows = [(i, doc_id, score) for i, own in enumerate(held) for score, doc_id in own]
        if rows:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), ids.type, pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    kind = found.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(run, f"item int, doc_id {kind}, score bigint")


def _cut(rows: DataFrame, best: int) -> DataFrame:
    """``item, rank, doc_id, score``: the best rows of each item."""
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    salted = rows.withColumn("salt", F.spark_partition_id() % SALTS)
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order)))
    whole = some.where(F.col("rank") <= best).drop("salt", "rank")
    return whole.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= best)


def _written(frame: DataFrame, purpose: str) -> DataFrame:
    folder = new_folder(frame.sparkSession, purpose)
    frame.write.parquet(folder)
    return frame.sparkSession.read.parquet(folder)


def _block(docs: DataFrame, block: list[tuple[object, list[bytes]]], best: int) -> DataFrame | None:
    """``item, rank, doc_id, score`` for the items of a block; None if no document has a term."""
    vocabulary = sorted({t for _, own in block for t in own})
    number = {t: i for i, t in enumerate(vocabulary)}
    known = _written(counted(docs, number), "lexical-counts")
    documents, all_terms = known.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not documents:
        return None
    holders = np.zeros(len(vocabulary), dtype=np.int64)
    # At most one row per term of the block.
    for r in known.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        holders[r["term"]] = r["count"]
    weights = np.array([weight(documents, n) for n in holders.tolist()], dtype=np.int64)
    items = [Item.of([number[t] for t in own], weights) for _, own in block]
    dealt = vectors(known, documents, all_terms).withColumn("h", F.xxhash64("doc_id"))
    by_length = dealt.repartitionByRange(F.desc("norm"), "h").sortWithinPartitions(F.desc("norm")).drop("h")
    found = _written(by_length, "lexical-vectors")
    cutoff = found.agg(F.percentile_approx("norm", 1 - FIRST_SHARE, 1000)).first()[0]
    if cutoff is None:
        return None
    first = _written(_cut(search(found.where(F.col("norm") >= cutoff), items, [0] * len(items), best), best), "lexical-first")
    thresholds = [0] * len(items)
    for r in first.where(F.col("rank") == best).select("item", "score").collect():
        thresholds[r.item] = r.score
    others = search(found.where(F.col("norm") < cutoff), items, thresholds, best)
    return _cut(others.unionByName(first.drop("rank")), best)


def rank(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``best`` documents with a score above 0 of every item."""
    spark = docs.sparkSession
    id_type = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score bigint")
    for block in item_blocks(items):
        found = _block(docs, block, best)
        if found is not None:
            names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], f"item int, item_id {id_type}")
            # A row for each item of the block.
            out = out.unionByName(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out


ORACLE_SQL = rf"""
with words as (
  select 'd' as kind, doc_id as id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents
  union all
  select 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') from benchmark),
corpus as (select count(*) filter (len(w) > 0)::bigint as all_docs, sum(len(w))::bigint as all_terms from words where kind = 'd'),
tf as (select id, term, count(*) as tf, any_value(n) as n from (
  select id, len(w) as n, unnest(w) as term from words where kind = 'd') group by id, term),
df as (select term, count(*) as df from tf group by term),
query as (select distinct id as item_id, unnest(w) as term from words where kind = 'b'),
weights as (select term, floor(1000 * ln((2 * all_docs + 2)::double / (2 * df + 1)::double))::bigint as weight from df, corpus),
impacts as (
  select id, term, ({ONE} * tf) // ({SATURATION} * tf + {LENGTH} * ({FLAT} + ({SLOPE} * n * all_docs) // all_terms)) as impact from tf, corpus),
scored as (
  select item_id, id as doc_id, sum(weight * impact)::bigint as score from query join weights using (term) join impacts using (term)
  group by item_id, id)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
from scored where score > 0 qualify rank <= {BEST}
"""
