"""Token counts that follow edits without encoding a document again.

A document keeps its pre-tokens in blocks under a segment tree, whose nodes
hold the characters and tokens below them. An edit descends by character sums
to the pre-tokens it may change: those it touches and those that end less than
``CONTEXT`` characters before it, as far as the split pattern looks ahead.
From there text is split anew until a border falls on an old one behind the
edit; from such a border on, splitting goes as before. Only these pre-tokens
are encoded; sums are updated from their blocks to the root.

The vocabulary is a file of ranks (base64 bytes and rank per line) and a split
pattern; both are parameters. State between batches is a frame of ``doc_id,
text, chars, tokens`` (lengths and token counts of all pre-tokens).

A null text is an empty one. Edits are taken in order, each on the text the
ones before it left; places beyond the text are moved to its end, a stop before
its start to the start, a null replacement is empty, null places are 0. Without
edits counts stay. Repeated rows are each edited; rows without an id have no
edits of their own in :func:`attach`; no rows, no rows. Other columns are not
read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F

from rowlake.llm.common import per_batch

#: Pre-tokens of a block, and the size at which a grown block has the tree built anew.
BLOCK, GROWN = 16, 256
#: A pre-token's end depends on fewer characters behind it than this.
CONTEXT = 3
#: Distinct pre-tokens a worker remembers; a bound of memory that does not change results.
REMEMBERED = 500_000
EDITS = "array<struct<start:int,stop:int,replacement:string>>"


class Counter:
    """Splits text into pre-tokens and counts their tokens."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("counted", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def split(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def tokens(self, pieces: list[str]) -> list[int]:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for new in {p for p in pieces if p not in known}:
            known[new] = len(self.encoding.encode_ordinary(new))
        return [known[p] for p in pieces]


@lru_cache(maxsize=2)
def counter(path: str, pattern: str) -> Counter:
    return Counter(path, pattern)


class Tree:
    """Blocks of pre-tokens under sums of characters and tokens."""

    def __init__(self, of: Counter, text: str, chars: list[int] | None = None, tokens: list[int] | None = None) -> None:
        self.of, self.text, self.encoded = of, text, 0
        if chars is None or tokens is None:
            pieces = of.split(text)
            chars, tokens = list(map(len, pieces)), of.tokens(pieces)
        self._build(chars, tokens)

    def _build(self, chars: list[int], tokens: list[int]) -> None:
        starts = range(0, max(1, len(chars)), BLOCK)
        self.chars = [chars[i : i + BLOCK] for i in starts]
        self.tokens = [tokens[i : i + BLOCK] for i in starts]
        self.width = 1 << (len(self.chars) - 1).bit_length()
        self.sums = []
        for blocks in (self.chars, self.tokens):
            sums = np.zeros(2 * self.width, dtype=np.int64)
            sums[self.width : self.width + len(blocks)] = [sum(b) for b in blocks]
            at = self.width
            while at > 1:
                sums[at // 2 : at] = sums[at : 2 * at].reshape(-1, 2).sum(axis=1)
                at //= 2
            self.sums.append(sums)

    @property
    def n_tokens(self) -> int:
        return int(self.sums[1][1])

    def pieces(self) -> tuple[list[int], list[int]]:
        return [x for b in self.chars for x in b], [x for b in self.tokens for x in b]

    def _find(self, place: int) -> tuple[int, int, int]:
        """Block, entry and first character of the last pre-token that begins at or before a place."""
        sums, node, first = self.sums[0], 1, 0
        while node < self.width:
            node *= 2
            if first + sums[node] <= place and sums[node + 1]:
                first += int(sums[node])
                node += 1
        block = node - self.width
        entry, sizes = 0, self.chars[block]
        while entry + 1 < len(sizes) and first + sizes[entry] <= place:
            first += sizes[entry]
            entry += 1
        return block, entry, first

    def _update(self, first: int, last: int) -> None:
        """Sums of the blocks and of all nodes above them."""
        for sums, blocks in zip(self.sums, (self.chars, self.tokens), strict=True):
            for i in range(first, last + 1):
                sums[self.width + i] = sum(blocks[i])
            lo, hi = (self.width + first) // 2, (self.width + last) // 2
            while hi >= 1:
                for node in range(lo, hi + 1):
                    sums[node] = sums[2 * node] + sums[2 * node + 1]
                lo, hi = lo // 2, hi // 2

    def edit(self, start: int | None, stop: int | None, replacement: str | None) -> None:
        n = len(self.text)
        start = min(max(start or 0, 0), n)
        stop = min(max(stop or 0, start), n)
        new = replacement or ""
        self.text = self.text[:start] + new + self.text[stop:]
        shift = len(new) - (stop - start)
        block, entry, begin = self._find(max(0, start - CONTEXT))
        # Old borders behind the edit are walked along with the new ones.
        at_block, at_entry, old = block, entry, begin
        pieces, border = [], begin
        matches = self.of.pattern.finditer(self.text, begin)
        while True:
            while at_block < len(self.chars) and (old < stop or old + shift < border):
                if at_entry < len(self.chars[at_block]):
                    old += self.chars[at_block][at_entry]
                    at_entry += 1
                else:
                    at_block, at_entry = at_block + 1, 0
            if old >= stop and old + shift == border:
                break
            found = next(matches)
            pieces.append(found.group())
            border = found.end()
        counts = self.of.tokens(pieces)
        self.encoded += len(pieces)
        last = min(at_block, len(self.chars) - 1)
        tail = at_entry if at_block == last else len(self.chars[last])
        for blocks, fresh in ((self.chars, list(map(len, pieces))), (self.tokens, counts)):
            rest = blocks[last][tail:]
            head = blocks[block][:entry]
            for i in range(block, last + 1):
                blocks[i] = []
            if last == block:
                blocks[block] = head + fresh + rest
            else:
                blocks[block], blocks[last] = head + fresh, rest
        if len(self.chars[block]) > GROWN:
            self._build(*self.pieces())
        else:
            self._update(block, last)


def _schema(frame: DataFrame) -> str:
    return frame.schema["doc_id"].dataType.simpleString()


def build(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, text, chars, tokens``: the pre-tokens of every row."""

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = counter(path, pattern)
        split = [own.split(t) for t in batch.column("text").to_pylist()]
        chars = pa.array([list(map(len, p)) for p in split], pa.list_(pa.int32()))
        tokens = pa.array([own.tokens(p) for p in split], pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([*batch.columns, chars, tokens], ["doc_id", "text", "chars", "tokens"])

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return per_batch(rows, of, f"doc_id {_schema(docs)}, text string, chars array<int>, tokens array<int>")


def attach(state: DataFrame, edits: DataFrame) -> DataFrame:
    """The state with ``edits``, those of each document by ``seq`` (then place and replacement)."""
    ordered = F.transform(
        F.sort_array(F.collect_list(F.struct("seq", "start", "stop", "replacement"))),
        lambda e: F.struct(e["start"].cast("int").alias("start"), e["stop"].cast("int").alias("stop"), e["replacement"].alias("replacement")),
    )
    per_document = edits.where("doc_id is not null").groupBy("doc_id").agg(ordered.alias("edits"))
    return state.join(per_document, "doc_id", "left")


def _edited(tree: Tree, edits: Iterable[dict] | None) -> Tree:
    for e in edits or ():
        if e is not None:
            tree.edit(e["start"], e["stop"], e["replacement"])
    return tree


def update(state: DataFrame, path: str, pattern: str) -> DataFrame:
    """The state after its column ``edits``; nothing but what they touch is encoded."""

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = counter(path, pattern)
        values = [batch.column(c).to_pylist() for c in ("text", "chars", "tokens", "edits")]
        trees = [_edited(Tree(own, *kept), edits) for *kept, edits in zip(*values, strict=True)]
        chars, tokens = zip(*(t.pieces() for t in trees), strict=True)
        columns = [batch.column("doc_id"), pa.array([t.text for t in trees], pa.string()), pa.array(chars, pa.list_(pa.int32())), pa.array(tokens, pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "chars", "tokens"])

    rows = state.select("doc_id", "text", "chars", "tokens", F.col("edits").cast(EDITS).alias("edits"))
    return per_batch(rows, of, f"doc_id {_schema(state)}, text string, chars array<int>, tokens array<int>")


REPORT = ("doc_id", "n_chars", "n_before", "n_tokens", "n_pieces", "n_encoded")


def counts_after_edits(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``REPORT`` of every row: tokens before and after its ``edits``, pre-tokens before, and those encoded for the edits."""

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, out = counter(path, pattern), []
        for text, edits in zip(batch.column("text").to_pylist(), batch.column("edits").to_pylist(), strict=True):
            tree = Tree(own, text)
            before, pieces = tree.n_tokens, sum(map(len, tree.chars))
            _edited(tree, edits)
            out.append((len(tree.text), before, tree.n_tokens, pieces, tree.encoded))
        columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], list(REPORT))

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("edits").cast(EDITS).alias("edits"))
    return per_batch(rows, of, f"doc_id {_schema(docs)}, " + ", ".join(f"{c} bigint" for c in REPORT[1:]))


#: Three edits of a document made of its own text: a passage written again, a deletion, an insertion.
OWN_EDITS = f"""cast(array(
  struct(char_length(t) div 2, char_length(t) div 2 + 20, left(t, 40)),
  struct(char_length(t) div 4, char_length(t) div 4 + 15, ''),
  struct(char_length(t) * 3 div 4, char_length(t) * 3 div 4, concat("'s  ", right(t, 12)))) as {EDITS})"""


def with_own_edits(docs: DataFrame) -> DataFrame:
    return docs.selectExpr("doc_id", "text", OWN_EDITS.replace("(t", "(coalesce(text, '')") + " as edits")
