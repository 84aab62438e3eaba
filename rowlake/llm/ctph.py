"""Document fingerprints by context-triggered piecewise hashing.

A hash rolls over the last seven bytes; where its low bits are all ones, a
piece ends. Each piece (with the six bytes before it) gives one of 64 letters.
The block size is a power of two: the smallest at which a text of evenly spread
triggers has at most 64 pieces, halved while there are fewer than 32. The
signature has the letters at that block size and at twice that size; the last
letter covers all that is left of the text. Two fingerprints are compared at
block sizes both have: likeness is the share of letters that stay under the
fewest insertions and deletions, and 0 where no five letters run in common.

A null text is an empty one; its fingerprint ``1::`` is like no other. Repeated
rows each get a row; the successor of a row is the next one by id (rows without
id last, then by text hash), after the last the first; alone, itself. Other
columns are not read. No rows: no rows. Texts are fingerprinted whole; of one
document, four bytes per byte are held.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rowlake.llm.common import EMIT_ROWS, in_order, per_batch, texts

WINDOW = 7
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
MOST, FEWEST = 64, 32
#: Letters that must run in common (or all of a shorter signature).
RUN = 5
STEP = 1 << 20


def rolled(data: bytes) -> np.ndarray:
    """Per byte, a 32-bit hash of the seven bytes that end there (fewer at the start)."""
    raw = np.frombuffer(data, dtype=np.uint8)
    out = np.empty(len(raw), dtype=np.uint32)
    for at in range(0, len(raw), STEP):
        part = raw[max(0, at - WINDOW + 1) : at + STEP].astype(np.uint32)
        sums = part.copy()
        power = 1
        for back in range(1, WINDOW):
            power = power * 0x01000193 & 0xFFFFFFFF
            sums[back:] += part[:-back] * np.uint32(power)
        sums ^= sums >> np.uint32(15)
        sums *= np.uint32(0x9E3779B1)
        out[at : at + STEP] = (sums >> np.uint32(7))[min(at, WINDOW - 1) :]
    return out


def _letters(data: bytes, ends: np.ndarray) -> str:
    """One letter per piece; ``ends`` are the places of the triggers."""
    stops = [*(ends[: MOST - 1] + 1).tolist()]
    if not stops or stops[-1] < len(data):
        stops.append(len(data))
    start, out = 0, []
    for stop in stops:
        out.append(LETTERS[crc32(data[max(0, start - WINDOW + 1) : stop]) & 63])
        start = stop
    return "".join(out)


def fingerprint(text: str) -> str:
    """``block size:letters:letters at twice the size``."""
    data = text.encode()
    if not data:
        return "1::"
    hashes = rolled(data)
    block = 1
    while block * MOST < len(data):
        block *= 2
    while True:
        ends = np.flatnonzero((hashes & np.uint32(block - 1)) == block - 1)
        if len(ends) >= FEWEST or block == 1:
            break
        block //= 2
    twice = np.uint32(2 * block - 1)
    return f"{block}:{_letters(data, ends)}:{_letters(data, ends[(hashes[ends] & twice) == twice])}"


def _kept(a: str, b: str) -> float:
    """Twice the longest common subsequence over all letters; bit-parallel."""
    run = min(RUN, len(a), len(b))
    if not run or {a[i : i + run] for i in range(len(a) - run + 1)}.isdisjoint(b[i : i + run] for i in range(len(b) - run + 1)):
        return 0.0
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    row = (1 << len(a)) - 1
    for x in b:
        met = row & places.get(x, 0)
        row = (row + met) | (row - met)
    common = len(a) - (row & ((1 << len(a)) - 1)).bit_count()
    return 2 * common / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """0 to 1; 1 for equal fingerprints, 0 where no block size is shared."""
    if a == b:
        return 1.0
    (size_a, one_a, two_a), (size_b, one_b, two_b) = a.split(":"), b.split(":")
    if size_a == size_b:
        return max(_kept(one_a, one_b), _kept(two_a, two_b))
    if int(size_a) == 2 * int(size_b):
        return _kept(one_a, two_b)
    if int(size_b) == 2 * int(size_a):
        return _kept(two_a, one_b)
    return 0.0


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of every row, without a shuffle."""

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = [fingerprint(t) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    return per_batch(texts(docs), of, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last half of the code points, rounded down, replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


FIELDS = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def compare_with_next(docs: DataFrame) -> DataFrame:
    """``FIELDS`` of every row: its fingerprint beside that of its edited text and of the next document."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kind, out = None, None, []
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            columns = [batch.column(c).to_pylist() for c in ("bucket", "ahead", "doc_id")]
            strings = batch.column("text")
            for i, (bucket, ahead, doc_id) in enumerate(zip(*columns, strict=True)):
                if ahead and held is None:
                    continue  # one copy of the next bucket's first row is enough
                text = strings[i].as_py()
                own = fingerprint(text)
                if held is not None:
                    before_id, before, before_print = held
                    changed = edited(before, text)
                    changed_print = fingerprint(changed)
                    out.append((
                        before_id, len(before), sha256(changed.encode()).hexdigest(), before_print, changed_print,
                        likeness(before_print, changed_print), likeness(before_print, own),
                    ))
                held = None if ahead else (doc_id, text, own)
                if len(out) >= EMIT_ROWS:
                    yield _batch(out, kind)
                    out = []
        if out:
            yield _batch(out, kind)

    return in_order(docs).select("bucket", "ahead", "doc_id", "text").mapInArrow(run, schema)


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = (id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], list(FIELDS))
