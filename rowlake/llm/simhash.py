"""SimHash near-duplicates through the pigeonring filter.

A fingerprint has 64 bits in a ring of three segments. Two fingerprints within
``2`` bits have a segment from which the differences of one, two and three
consecutive segments stay within 0, 1 and 2 (a third of the budget per
segment). Keys are chains of two segments: the first as it is, the second as it
is or with one zero bit set. A chain that no other fingerprint reaches is
dropped; the rest are met at centres of the third segment and checked in full.

All members of a centre are within 2 bits of one another, so each is linked to
the smallest only. Links are linear in the fingerprints, whatever the size of a
group, and groups are those of all links. Equal fingerprints are one node.

Null or empty text and text without words: fingerprint zero, linked like any
other. Repeated rows stay. A null ``doc_id`` takes part but names no group;
a group of such rows alone has a null ``component_id``. No rows: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from rowlake.llm.common import cut, per_batch, utf8
from rowlake.llm.components import components

SHINGLE_WORDS = 3
SEED = 42
#: First bit and width of the segments of the ring.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Differences allowed over one, two and three consecutive segments.
BUDGETS = (0, 1, 2)
BLOCK = 1 << 16
#: Chains of a fingerprint at most: a rotation has one for the second segment and one for each zero bit of it.
CHAINS = sum(1 + width for _, width in SEGMENTS)


def fingerprint(text: bytes) -> int:
    """The unsigned 64-bit fingerprint of a whole UTF-8 text."""
    words = text.lower().split()  # bytes: A-Z only, and exactly the six ASCII blanks
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    last = ends[SHINGLE_WORDS - 1 :] if len(words) >= SHINGLE_WORDS else ends[-1:]
    starts = [0, *ends[: len(last) - 1].tolist()]
    digest = xxhash.xxh64_intdigest
    return majority(np.array([digest(line[s : e - 1], SEED) for s, e in zip(starts, last.tolist(), strict=True)], dtype="<u8"))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes; none of no hashes."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed long) of every row."""

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(x) for x in utf8(batch)], dtype=np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps)], ["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return per_batch(rows, of, "doc_id bigint, fp bigint")


def _segment(i: int) -> str:
    first, width = SEGMENTS[i % 3]
    return f"(shiftrightunsigned(fp, {first}) & {(1 << width) - 1}L)"


def _chains(nodes: DataFrame) -> DataFrame:
    """``fp, chain, spent, rest``: chains of two segments, the bits spent on the second, the third segment.

    A chain holds the rotation, the first segment as it is and the second one
    as it is (0 spent) or with one of its zero bits set (1 spent).
    """
    return nodes.selectExpr("fp", "inline(array(" + ", ".join(
        f"struct({i} as rotation, {_segment(i)} as first, {_segment(i + 1)} as second, {_segment(i + 2)} as rest)"
        for i in range(3)
    ) + "))").selectExpr(
        "fp", "rest", "shiftleft(first, 26) | shiftleft(second, 4) | rotation as own",
        "filter(sequence(0, if(rotation = 0, 20, if(rotation = 1, 20, 21))), j -> shiftright(second, j) & 1 = 0) as free",
    ).selectExpr(
        "fp", "rest",
        f"inline(concat(array(struct(own as chain, {BUDGETS[0]} as spent)),"
        f" transform(free, j -> struct(own | shiftleft(1L, j + 4) as chain, {BUDGETS[1]} as spent))))",
    )


def _centres(chains: DataFrame) -> DataFrame:
    """``fp, chain, centre``: what is left of the budget, halved between the two sides of a link.

    Links with nothing spent have 2 bits left and meet at a third segment one
    bit from each; links with one spent have one left, which the side that
    spent nothing bridges.
    """
    third = "pmod(cast(chain & 3 as int) + 2, 3)"
    width = f"case {third} when 0 then {SEGMENTS[0][1]} when 1 then {SEGMENTS[1][1]} else {SEGMENTS[2][1]} end"
    return chains.selectExpr(
        "fp", "chain",
        "explode(concat(array(rest), if(spent = 0,"
        f" transform(sequence(0, {width} - 1), j -> rest ^ shiftleft(1L, j)), array()))) as centre",
    )


def links(nodes: DataFrame, most: int | None = None) -> DataFrame:
    """``a, b``: links within the budget that join all linked fingerprints of distinct ``fp``, of which there are ``most`` at most."""
    chains = _chains(nodes)
    reached = chains.groupBy("chain").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi"), F.min("spent").alias("own"))
    shared = reached.where("lo <> hi and own = 0").select("chain")
    alive = cut(chains.join(shared, "chain", "left_semi"), None if most is None else CHAINS * most)
    centres = _centres(alive)
    hubs = centres.groupBy("chain", "centre").agg(F.min("fp").alias("hub"), F.max("fp").alias("hi")).where("hub <> hi")
    met = centres.join(hubs.drop("hi"), ["chain", "centre"]).where("fp <> hub")
    return met.where(f"bit_count(fp ^ hub) <= {BUDGETS[-1]}").select(F.col("fp").alias("a"), F.col("hub").alias("b"))


def _groups(prints: DataFrame) -> DataFrame:
    """``fp, component``: the smallest fingerprint reachable, for every distinct ``fp``."""
    nodes = prints.select("fp").distinct()
    joined = components(links(nodes)).select(F.col("node").alias("fp"), "component")
    return cut(nodes.join(joined, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id`` for every row: the smallest id reachable over links."""
    prints = cut(fingerprints(docs))
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    groups = _groups(prints).join(least, "fp")
    named = groups.groupBy("component").agg(F.min("least").alias("component_id"))
    return prints.join(groups.join(named, "component").select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id"
    )
