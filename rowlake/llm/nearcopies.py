"""Groups of near copies: five-word shingles with an exact Jaccard similarity of ``SIMILAR`` or more.

The closest copies meet by SimHash: the fingerprint of the shingles has 64 bits,
and :func:`rowlake.llm.simhash.links` joins those within two bits. Fingerprints of
texts at similarity 0.8 differ in about ten bits (up to 17), for which chains of a
pigeonring are too short to tell texts apart, so these also meet by minima: ``BANDS``
bands of ``ROWS`` minima of the shingles, each under a hash function of its own. A
pair at similarity 0.8 shares no band with a probability of 2e-5, a closer one with
less. All texts of a bucket are linked to its smallest; what is joined by either is a
cluster, and **every** pair of a cluster has its similarity counted in full.

Large clusters are dealt out by pairs of blocks, so that no task holds one. A
pair of blocks hands on a forest of its links, not all of them. Groups are
those of all links. Texts of equal shingles are one node.

Texts do not move to find out which of them are needed: a mask of hashes, sent to
all tasks, tells nearly all rows that are not. What it leaves, one row in sixteen
too many, is joined exactly; beyond the size of the mask it leaves more.

Words are split and lower-cased as in :mod:`rowlake.llm.simhash`; a text of
fewer words is one shingle, and texts without words are equal. No rows: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from rowlake.llm.common import cut, free, per_batch, utf8
from rowlake.llm.components import components
from rowlake.llm.simhash import CHAINS, links, majority

SHINGLE_WORDS = 5
SIMILAR = 0.8
BANDS, ROWS = 36, 6
SEED = 42
#: Nodes of a block, as their hash deals them out.
BLOCK = 128
#: Shingles handled at once.
STEP = 4096
#: Bits of a mask for each row that is looked for, and words of 64 bits that it has at most.
MASK_BITS, MOST_WORDS = 16, 1 << 19


def shingles(text: bytes) -> np.ndarray:
    """The distinct hashes of the shingles, sorted."""
    words = text.lower().split()  # bytes: A-Z only, and exactly the six ASCII blanks
    if not words:
        return np.zeros(0, dtype=np.uint64)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    last = ends[SHINGLE_WORDS - 1 :] if len(words) >= SHINGLE_WORDS else ends[-1:]
    starts = [0, *ends[: len(last) - 1].tolist()]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(line[s : e - 1], SEED) for s, e in zip(starts, last.tolist(), strict=True)], dtype="<u8"))


def _functions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return tuple(rng.integers(0, 1 << 32, (BANDS * ROWS, 1), dtype=np.uint32) for _ in range(2))


def bands(own: np.ndarray) -> np.ndarray:
    """One key per band from the minima of the shingles under each hash function."""
    times, plus = _functions()
    times = times | np.uint32(1)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, dtype=np.uint32)
    short = (own >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), STEP):
        least = np.minimum(least, (short[at : at + STEP] * times + plus).min(axis=1))
    rows = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), i) for i, r in enumerate(rows)], dtype=np.uint64).view(np.int64)


def _node(own: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(own.tobytes(), SEED)).view(np.int64))


def _signed(batch: pa.RecordBatch) -> pa.RecordBatch:
    nodes, fps, keys = [], [], []
    for text in utf8(batch):
        own = shingles(text)  # one at a time: those of a batch take more than its texts
        nodes.append(_node(own))
        fps.append(majority(own))
        keys.append(bands(own))
    prints = pa.array(np.array(fps, dtype=np.uint64).view(np.int64))
    columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(nodes, pa.int64()), prints, pa.array(keys, pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "node", "fp", "bands"])


def _sets(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = pa.array([shingles(x).tobytes() for x in utf8(batch)], pa.binary())
    return pa.RecordBatch.from_arrays([batch.column("node"), sets], ["node", "data"])


def similar(sets: list[np.ndarray]) -> np.ndarray:
    """Whether each two sets have the similarity, by counting what they share."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), sizes)
    met = times[column] > 1
    order = np.argsort(column[met], kind="stable")
    row, column = row[met][order], column[met][order]
    shared = np.zeros((n, n), dtype=np.int64)
    at = 0
    column = np.cumsum(np.concatenate([[0], column[1:] != column[:-1]])) if len(column) else column
    while at < len(column):
        stop = int(np.searchsorted(column, column[at] + STEP))
        part = np.zeros((n, STEP), dtype=np.float32)
        part[row[at:stop], column[at:stop] - column[at]] = 1
        shared += (part @ part.T).astype(np.int64)
        at = stop
    return shared >= SIMILAR * (sizes[:, None] + sizes[None, :] - shared)


def forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Links that join what all links of a matrix join."""
    met, out = np.zeros(len(near), dtype=bool), []
    for root in range(len(near)):
        todo = [] if met[root] else [root]
        met[root] = True
        while todo:
            a = todo.pop()
            fresh = np.flatnonzero(near[a] & ~met).tolist()
            met[fresh] = True
            out += [(a, b) for b in fresh]
            todo += fresh
    return out


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``a, b``: links of each pair of blocks, whose rows come together."""

    def of_blocks(nodes: list[int], blocks: list[int], data: list[bytes]) -> pa.RecordBatch:
        near = similar([np.frombuffer(d, dtype=np.uint64) for d in data])
        if len(set(blocks)) > 1:  # pairs within a block are met where it is alone
            near &= np.not_equal.outer(blocks, blocks)
        found = forest(near)
        return pa.RecordBatch.from_arrays([pa.array([nodes[p[i]] for p in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    key, held = None, ([], [], [])
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("cluster", "lo", "hi", "node", "block", "data")]
        for *own, node, block, data in zip(*columns, strict=True):
            if own != key:
                if len(held[0]) > 1:
                    yield of_blocks(*held)
                key, held = own, ([], [], [])
            for part, x in zip(held, (node, block, data), strict=True):
                part.append(x)
    if len(held[0]) > 1:
        yield of_blocks(*held)


def _parted(rows: DataFrame, wanted: DataFrame, n: int, key: str = "text_key") -> tuple[DataFrame, DataFrame]:
    """The rows that may be among ``wanted`` (``doc_id, text_key``; ``n`` of them), and the rows that are surely not."""
    word, bits = free(rows, "word", "bits")
    words = max(1, min(MOST_WORDS, n * MASK_BITS // 64))

    def place(own: str) -> tuple[Column, Column]:
        at = f"xxhash64(doc_id, {own})"
        return F.expr(f"pmod(shiftright({at}, 6), {words}L)"), F.expr(f"shiftleft(1L, cast({at} & 63 as int))")

    of_wanted, bit = place("text_key")
    mask = wanted.groupBy(of_wanted.alias(word)).agg(F.bit_or(bit).alias(bits))
    of_row, bit = place(key)
    met = rows.withColumn(word, of_row).join(F.broadcast(mask), word, "left")
    hit = F.coalesce(F.col(bits).bitwiseAND(bit) != 0, F.lit(False))
    return met.where(hit).drop(word, bits), met.where(~hit).drop(word, bits)


def _by_fingerprint(prints: DataFrame, most: int | None = None) -> DataFrame:
    """``a, b``: links between nodes whose fingerprints are equal or within the bits of :mod:`rowlake.llm.simhash`."""
    # In as many files as its chains need, which are made from it.
    hubs = cut(prints.groupBy("fp").agg(F.min("node").alias("hub")), None if most is None else CHAINS * most)
    equal = prints.join(hubs, "fp").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    ends = [hubs.select(F.col("fp").alias(end), F.col("hub").alias(f"{end}_hub")) for end in ("a", "b")]
    close = links(hubs.select("fp"), most).join(ends[0], "a").join(ends[1], "b").select(F.col("a_hub").alias("a"), F.col("b_hub").alias("b"))
    return equal.union(close)


def _clusters(prints: DataFrame) -> DataFrame:
    """``node, cluster, blocks``: nodes joined by fingerprints or buckets with others, and the blocks of their cluster."""
    most = prints.count()
    keys = prints.dropDuplicates(["node"]).select("node", F.explode("bands").alias("band"))
    hubs = keys.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("hi")).where("hub <> hi").drop("hi")
    met = keys.join(hubs, "band").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    met = met.union(_by_fingerprint(prints, most))
    nodes = cut(components(met).withColumnRenamed("component", "cluster"), most)
    sizes = nodes.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    return cut(nodes.join(sizes, "cluster"), most)


def _links(rows: DataFrame, prints: DataFrame, clusters: DataFrame, n: int, most: int) -> DataFrame:
    """``a, b``: links between nodes that join all similar ones; one text of each of the ``n`` nodes in a cluster is read.

    There are ``most`` rows, from which the files are counted: few nodes may have many rows.
    """
    first = F.min(F.struct("doc_id", "text_key")).alias("own")
    one = cut(prints.join(clusters, "node").groupBy("node").agg(first).select("node", "own.doc_id", "own.text_key"), most)
    found, _ = _parted(rows, one, n)
    one = one.withColumnsRenamed({"doc_id": "own_id", "text_key": "own_key"})
    met = found["doc_id"].eqNullSafe(one["own_id"]) & (found["text_key"] == one["own_key"])
    texts = found.join(one, met).select("node", "text")
    sets = per_batch(texts, _sets, "node bigint, data binary").dropDuplicates(["node"])
    dealt = sets.join(clusters, "node").withColumn("block", F.expr("cast(pmod(xxhash64(node), blocks) as int)")).select(
        "node", "data", "cluster", "block", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other")
    ).select("cluster", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "node", "block", "data")
    together = dealt.repartition("cluster", "lo", "hi").sortWithinPartitions("cluster", "lo", "hi", "node")
    return together.mapInArrow(_linked, "a bigint, b bigint")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group, that of the smallest id and then text hash; all columns of ``docs``.

    A row without an id is kept only if its whole group has none. Of rows that
    agree in id and text one is kept.
    """
    key, gone_id, gone_key = free(docs, "key", "gone_id", "gone_key")
    keyed = docs.withColumn(key, F.md5(F.coalesce("text", F.lit(""))))
    rows = keyed.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col(key).alias("text_key"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    prints = cut(per_batch(rows, _signed, f"doc_id {id_type}, text_key string, node bigint, fp bigint, bands array<bigint>"))
    clusters, total = _clusters(prints), prints.count()
    # A node meets each block once and adds a link there at most: a forest has fewer links than nodes.
    nodes, most = clusters.agg(F.count(F.lit(1)), F.coalesce(F.sum("blocks"), F.lit(0))).first()
    joined = components(_links(rows, prints, clusters, nodes, total), most).select("node", "component")
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("best")
    of_node = prints.groupBy("node").agg(best).join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    kept = of_node.groupBy("component").agg(F.min("best").alias("best"))
    # What is not kept as it stands: rows that go, and rows that are there more than once.
    each = prints.groupBy("node", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("times"))
    named = each.join(of_node.select("node", "component"), "node").join(kept, "component")
    goes = ~(F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_key") == F.col("best.text_key")))
    other = cut(named.select("doc_id", "text_key", "times", goes.alias("goes")).where("goes or times > 1"), total)
    perhaps, stay = _parted(keyed, other.select("doc_id", "text_key"), other.count(), key)
    gone = other.where("goes").select(F.col("doc_id").alias(gone_id), F.col("text_key").alias(gone_key))
    met = perhaps["doc_id"].eqNullSafe(gone[gone_id]) & (perhaps[key] == gone[gone_key])
    return stay.union(perhaps.join(gone, met, "left_anti").dropDuplicates(["doc_id", key])).drop(key)
