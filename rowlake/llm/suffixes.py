"""Exact substring removal: 50-byte strings that also start in a document with a smaller id.

Suffixes are compared by prefix polynomial hashes: a binary search over hashed
lengths finds how far two agree, so one comparison costs the logarithm of the
length. A mergesort on these comparisons puts equal strings side by side;
neighbours that the hashes call equal are verified byte by byte.

No task needs all suffixes. Each 50-byte window has one anchor: the leftmost of
its 16-byte grams with the smallest hash (by its upper bits). Equal windows have equal anchors at
equal places, so only windows of one anchor gram are ever compared:

1. Tasks offer the anchors of their documents. Grams that a task has seen in two
   documents are settled there and sent once; the rest meet by gram. What is left
   are anchors whose gram occurs in two documents or more.
2. Around these, documents cut contexts: the bytes of all windows of an anchor.
   A context that a task has twice is settled there; one copy goes on.
3. Contexts meet by gram and are sorted by what follows from the anchor on. Where
   neighbours agree for long enough, and the bytes before the anchor have equal
   hashes, windows are equal; all but those of the smallest id go, once their
   bytes have been compared.
4. Documents drop the union of their spans.

A gram in more than ``HOT`` places does not go to one task: after step 2 its
windows meet one by one, each under its own 50 bytes, with the smallest id of a
task first. Which grams these are is a table that is joined.

A null text is an empty one. Repeated rows, and rows of one id, do not remove
each other's bytes. A null id counts as larger than any other. Texts below 50
bytes lose nothing. Other columns are not read; no rows, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from rowlake.llm.common import cut, dealt
from rowlake.workspace import new_folder

LENGTH = 50
GRAM = 16
#: Grams of a window.
GRAMS = LENGTH - GRAM + 1
#: Members of a gram beyond which its windows are dealt out by their own bytes.
HOT = 200_000
#: Bytes of contexts that a task of step 3 is meant to get.
PART_BYTES = 64 << 20
#: Anchors, and bytes of contexts, that a task settles together before it sends them on.
UNIT, UNIT_BYTES = 500_000, 8 << 20
#: Windows of a document looked at together.
STEP = 1 << 21
#: The low bits of a hash, which give way to a place among the grams of so many windows.
PLACE = np.uint64(2 * STEP - 1)
LAST = np.iinfo(np.int64).max
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, BASE)]), dtype=np.uint64)


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """The hash of the gram at each place; lengths double until they are the gram's."""
    out, size, power = raw.astype(np.uint64) + np.uint64(1), 1, BASE
    while size < GRAM:
        out = out[:-size] * power + out[size:]
        size, power = 2 * size, power * power
    return _mixed(out)


def anchors(data: bytes) -> tuple[np.ndarray, ...]:
    """Per run of windows with one anchor: its gram's hash, its place, the first window, the number of windows."""
    found = [_anchors(data[at : at + STEP + LENGTH - 1], at) for at in range(0, len(data) - LENGTH + 1, STEP)]
    if not found:
        return np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def _anchors(data: bytes, offset: int) -> tuple[np.ndarray, ...]:
    hashes = gram_hashes(np.frombuffer(data, dtype=np.uint8))
    # The place in the low bits, so the minimum of a window is its leftmost gram of the least upper bits.
    least, size = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64), 1
    while size < GRAMS:  # a window's minimum is that of two shorter ones
        by = min(size, GRAMS - size)
        least = np.minimum(least[by:], least[:-by])
        size += by
    firsts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    counts = np.diff(np.concatenate([firsts, [len(least)]]))
    place = (least[firsts] & PLACE).astype(np.int64)
    return hashes[place], place + offset, firsts + offset, counts


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts by the keys (the last first), and where runs of equal keys begin in it."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order[1:]] != key[order[:-1]]
    return order, np.flatnonzero(new)


def _sizes(begins: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.concatenate([begins, [n]]))


def _documents(docs: DataFrame) -> DataFrame:
    """``doc_id, ord, key, data``: whole texts as bytes, the order of ids, a hash of the text."""
    text = F.coalesce("text", F.lit(""))
    order = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(int(LAST)))
    return docs.select("doc_id", order.alias("ord"), F.xxhash64(text).alias("key"), text.cast("binary").alias("data"))


def _part(numbers: np.ndarray, by: np.ndarray) -> np.ndarray:
    return numbers[(by.view(np.uint64) % np.uint64(len(numbers))).astype(np.int64)]


# 1. Anchors whose gram is in two documents.

OPEN, SETTLED, WITNESS = 0, 1, 2


def _offers(numbers: np.ndarray):
    def settle(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        gram, order_id, key, place = (np.concatenate(c) for c in zip(*held, strict=True))
        order, begins = _groups(gram)
        ids = order_id[order]
        least, most = np.minimum.reduceat(ids, begins), np.maximum.reduceat(ids, begins)
        counts = _sizes(begins, len(order))
        shared = np.empty(len(gram), dtype=bool)
        shared[order] = np.repeat(least != most, counts)
        # A gram shared here is sent once, with its count, for the documents of other tasks.
        told = order[begins[least != most]]
        kinds = (
            (OPEN, ~shared, place, gram),
            (SETTLED, shared, place, key),
            (WITNESS, told, None, gram),
        )
        rows = []
        for kind, chosen, p, dealt_by in kinds:
            g, i, k = gram[chosen], order_id[chosen], key[chosen]
            p = counts[least != most] if p is None else p[chosen]
            part = _part(numbers, dealt_by[chosen])
            to, starts = _groups(part)
            for own in np.split(to, starts[1:]) if len(to) else ():
                own.sort()  # in the order of documents, which packs well
                packed = (g[own], i[own], k[own], p[own].astype(np.int32))
                rows.append((int(part[own[0]]), kind, *(x.tobytes() for x in packed)))
        if rows:
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int32(), *[pa.binary()] * 4), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "kind", "gram", "ord", "key", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for order_id, key, data in zip(*(batch.column(c).to_pylist() for c in ("ord", "key", "data")), strict=True):
                gram, place, _, _ = anchors(data)
                if len(gram):
                    held.append((gram, np.full(len(gram), order_id, np.int64), np.full(len(gram), key, np.int64), place))
                    size += len(gram)
                if size >= UNIT:
                    yield from settle(held)
                    held, size = [], 0
        if held:
            yield from settle(held)

    return run


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``gram, ord, key, place`` of anchors whose gram is in two documents; with ``hot`` a gram in more than ``HOT`` places alone."""
    names = ["gram", "ord", "key", "place", "hot"]

    def rows(gram: np.ndarray, order_id: np.ndarray, key: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
        n = len(gram)
        columns = [pa.array(gram.view(np.int64)), pa.array(order_id), pa.array(key), pa.array(place.astype(np.int32))]
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.zeros(n, dtype=bool))], names)

    held = []
    for batch in batches:
        for kind, *packed in zip(*(batch.column(c).to_pylist() for c in ("kind", "gram", "ord", "key", "place")), strict=True):
            gram, ids, keys, places = (np.frombuffer(x, k) for x, k in zip(packed, (np.uint64, np.int64, np.int64, np.int32), strict=True))
            if kind == SETTLED:
                yield rows(gram, ids, keys, places)
            else:
                held.append((np.full(len(ids), kind, np.int8), gram, ids, keys, places))
    if held:
        kind, gram, ids, keys, places = (np.concatenate(c) for c in zip(*held, strict=True))
        order, begins = _groups(gram)
        counts = _sizes(begins, len(order))
        own = ids[order]
        told = kind[order] == WITNESS
        shared = (np.minimum.reduceat(own, begins) != np.maximum.reduceat(own, begins)) | np.logical_or.reduceat(told, begins)
        members = np.add.reduceat(np.where(told, places[order], 1), begins)
        keep = order[np.repeat(shared, counts) & ~told]
        yield rows(gram[keep], ids[keep], keys[keep], places[keep])
        hot = gram[order[begins[shared & (members > HOT)]]]
        if len(hot):
            nothing = [pa.nulls(len(hot), k) for k in (pa.int64(), pa.int64(), pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(hot.view(np.int64)), *nothing, pa.array(np.ones(len(hot), dtype=bool))], names)


# 2. Contexts of these anchors.


CONTEXTS, SPANS = 0, 1
_SPAN = (np.int64,) * 4


def _packed(columns, *more: bytes) -> bytes:
    return zstandard.compress(b"".join([np.array([len(columns[0])], np.int64).tobytes(), *(c.tobytes() for c in columns), *more]), 1)


def _unpacked(payload: bytes, kinds) -> tuple[list[np.ndarray], np.ndarray]:
    """The columns of a payload, and the bytes after them."""
    raw = zstandard.decompress(payload)
    n, at, columns = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    for kind in kinds:
        columns.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return columns, np.frombuffer(raw, np.uint8, -1, at)


def _joined(order_id: np.ndarray, key: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of documents, in order, those that touch as one. Each document's spans are cut where they are long apart."""
    order = np.lexsort((start, key, order_id))
    o, k, a, b = order_id[order], key[order], start[order], stop[order]
    new = np.concatenate([[True], (o[1:] != o[:-1]) | (k[1:] != k[:-1])])
    # The farthest end so far within a document: documents are set apart by more than any place.
    far = np.int64(1) << np.int64(40)
    shift = np.cumsum(new) * far
    reach = np.maximum.accumulate(b + shift)
    fresh = new | np.concatenate([[True], (a + shift)[1:] > reach[:-1]])
    first = np.flatnonzero(fresh)
    last = np.concatenate([first[1:] - 1, [len(order) - 1]])
    return o[first], k[first], a[first], (reach - shift)[last]


def _span_rows(order_id, key, start, stop) -> pa.RecordBatch:
    columns = [pa.array(c) for c in (order_id, key, start, stop)]
    return pa.RecordBatch.from_arrays(columns, ["ord", "key", "start", "stop"])


def _held_contexts(batches: Iterator[pa.RecordBatch], hot: bool) -> Iterator[tuple]:
    """Units of the contexts of hot or of other grams: columns and bytes, which of them go on, and the spans of those
    that the unit also has of a smaller id."""

    def settled(held: list[tuple]) -> tuple:
        kinds = (np.uint64, np.int32, np.int64, np.int64, np.int64)
        gram, at, start, order_id, key = (np.array([x[i] for x in held], dtype=t) for i, t in enumerate(kinds))
        text = [x[5] for x in held]
        same: dict[tuple, int] = {}
        owner = np.array([same.setdefault((x[0], x[1], x[5]), i) for i, x in enumerate(held)])
        best = np.full(len(held), LAST, dtype=np.int64)
        np.minimum.at(best, owner, order_id)
        again = order_id > best[owner]
        sizes = np.array([len(t) for t in text], dtype=np.int32)
        gone = tuple(c[again] for c in (order_id, key, start, start + sizes))
        return (gram, order_id, key, start, at, sizes), text, np.flatnonzero(~again), gone

    held, size = [], 0
    for batch in batches:
        places = batch.column("places")
        for i, (order_id, key, data) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("ord", "key", "data")), strict=True)):
            wanted = places[i].values.to_numpy(zero_copy_only=False)
            wanted = wanted[(wanted & 1) == hot] >> 1
            if not len(wanted):
                continue
            gram, place, first, count = anchors(data)
            mark = np.zeros(max(len(data), int(wanted.max()) + 1), dtype=bool)
            mark[wanted] = True
            chosen = np.flatnonzero(mark[place])
            # Runs of one document with the same anchor stay apart, as their windows do.
            first, stop = first[chosen], first[chosen] + count[chosen] + LENGTH - 1
            own = (a.tolist() for a in (gram[chosen], place[chosen] - first, first, stop))
            held += [(g, a, f, order_id, key, data[f:e]) for g, a, f, e in zip(*own, strict=True)]
            size += int((stop - first).sum())
            if size >= UNIT_BYTES:
                yield settled(held)
                held, size = [], 0
    if held:
        yield settled(held)


def _contexts(numbers: np.ndarray):
    """Contexts by gram and spans by document, many of either in a row."""
    def rows(kind: int, part: np.ndarray, pack) -> pa.RecordBatch | None:
        to, begins = _groups(part)
        out = []
        for own in np.split(to, begins[1:]) if len(to) else ():
            own.sort()
            out.append((int(part[own[0]]), kind, pack(own)))
        if not out:
            return None
        columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary()), strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["part", "kind", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, text, rest, gone in _held_contexts(batches, False):
            kept = [c[rest] for c in columns]
            found = rows(CONTEXTS, _part(numbers, kept[0]), lambda own: _packed([c[own] for c in kept], *(text[i] for i in rest[own])))
            if found:
                yield found
            if len(gone[0]):
                merged = _joined(*gone)
                yield rows(SPANS, _part(numbers, merged[1]), lambda own: _packed([c[own] for c in merged]))

    return run


def _hot_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``ord, key, start, stop, window``: spans that a unit has settled, and each of its other windows of hot grams, with its bytes."""
    names = ["ord", "key", "start", "stop", "window"]

    def rows(columns, window: list[bytes | None]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), pa.array(window, pa.binary())], names)

    for (_, order_id, key, start, _, sizes), text, rest, gone in _held_contexts(batches, True):
        if not len(rest):
            continue
        own = np.array([o for i in rest.tolist() for o in range(sizes[i] - LENGTH + 1)], dtype=np.int64)
        of = np.repeat(rest, sizes[rest] - LENGTH + 1)
        window = [text[i][s : s + LENGTH] for i, s in zip(of.tolist(), own.tolist(), strict=True)]
        number: dict[bytes, int] = {}
        which = np.array([number.setdefault(w, len(number)) for w in window])
        least = np.full(len(number), LAST, dtype=np.int64)
        np.minimum.at(least, which, order_id[of])
        # A window goes on for the smallest id of the unit, at each of its places.
        again = order_id[of] > least[which]
        first = start[of] + own
        columns = (order_id[of], key[of], first, first + LENGTH)
        settled = [np.concatenate([g, c[again]]) for g, c in zip(gone, columns, strict=True)]
        if len(settled[0]):
            merged = _joined(*settled)
            yield rows(merged, [None] * len(merged[0]))
        yield rows([c[~again] for c in columns], [w for w, a in zip(window, again.tolist(), strict=True) if not a])


# 3. Contexts of a gram, sorted by what follows.


class Buffer:
    """Suffixes of a buffer with prefix polynomial hashes, compared as far as each has ``room``."""

    def __init__(self, raw: np.ndarray, at: np.ndarray, room: np.ndarray) -> None:
        self.raw, self.at, self.room = raw, at, room
        # Prefix sums of byte times power, so a string's hash times the power of its place.
        self.place = _powers(len(raw))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.place[: len(raw)], dtype=np.uint64)])

    def hashes(self, begin: np.ndarray, length: int) -> np.ndarray:
        """Hashes of strings of one length, which do not depend on their places."""
        return (self.sums[begin + length] - self.sums[begin]) * self.place[len(self.raw) - begin]

    def same(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the hashes of the first bytes of two suffixes agree, brought to one place by powers."""
        p, q = self.at[a], self.at[b]
        return (self.sums[p + length] - self.sums[p]) * self.place[q] == (self.sums[q + length] - self.sums[q]) * self.place[p]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How far two suffixes agree, as far as both have room, by binary search."""
        high = np.minimum(self.room[a], self.room[b])
        low = np.zeros(len(a), np.int64)
        whole = self.same(a, b, high)
        low[whole] = high[whole]
        live = np.flatnonzero(low < high)
        while live.size:
            middle = (low[live] + high[live] + 1) // 2
            agree = self.same(a[live], b[live], middle)
            low[live] = np.where(agree, middle, low[live])
            high[live] = np.where(agree, high[live], middle - 1)
            live = live[low[live] < high[live]]
        return low

    def less(self, a: np.ndarray, b: np.ndarray, or_equal: bool) -> np.ndarray:
        far = self.common(a, b)
        most = np.minimum(self.room[a], self.room[b])
        at = np.minimum(far, np.maximum(most - 1, 0))
        differ = self.raw[self.at[a] + at] < self.raw[self.at[b] + at]
        # One is the beginning of the other: the shorter is less.
        ends = np.where(self.room[a] == self.room[b], or_equal, self.room[a] < self.room[b])
        return np.where(far == most, ends, differ)

    def sort(self, group: np.ndarray) -> np.ndarray:
        """The numbers of the suffixes, sorted within runs of equal ``group``; all merges of a level at once."""
        out = np.arange(len(group))
        begins = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        sizes = _sizes(begins, len(out))
        begin, stop = np.repeat(begins, sizes), np.repeat(begins + sizes, sizes)
        width = 1
        while width < sizes.max(initial=1):
            # Places whose block of this level has a second run to merge with.
            at = np.arange(len(out))
            run = (at - begin) // width
            left = begin + (run // 2 * 2) * width
            middle, end = np.minimum(left + width, stop), np.minimum(left + 2 * width, stop)
            live = np.flatnonzero(middle < end)
            own = out[live]
            first = run[live] % 2 == 0
            low = np.where(first, middle[live], left[live])
            base, high = low.copy(), np.where(first, end[live], middle[live])
            while (open_ := np.flatnonzero(low < high)).size:
                probe = (low[open_] + high[open_]) // 2
                # Of equal suffixes those of the left run come first.
                other = out[probe]
                before = np.where(first[open_], self.less(other, own[open_], False), self.less(other, own[open_], True))
                low[open_] = np.where(before, probe + 1, low[open_])
                high[open_] = np.where(before, high[open_], probe)
            place = left[live] + (live - np.where(first, left[live], middle[live])) + (low - base)
            merged = out.copy()
            merged[place] = own
            out = merged
            width *= 2
        return out


def repeated(
    raw: np.ndarray, begin: np.ndarray, size: np.ndarray, at: np.ndarray, group: np.ndarray, order_id: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Windows that are equal to one of a smaller id in their group: their contexts, and their places in these.

    A context is ``size`` bytes at ``begin``, its anchor ``at`` bytes behind that; contexts
    come by group. Sorted by what follows from the anchor on, those that agree for
    so many bytes are neighbours, so one sort serves the windows at all places.
    """
    anchor = begin + at
    buffer = Buffer(raw, anchor, np.minimum(size - at, LENGTH).astype(np.int64))
    order = buffer.sort(group)
    far = np.full(len(order), -1, dtype=np.int64)
    far[1:] = np.where(group[order[1:]] == group[order[:-1]], buffer.common(order[:-1], order[1:]), -1)
    view = np.lib.stride_tricks.sliding_window_view(raw, LENGTH)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for before in range(GRAMS):  # bytes of the window before the anchor
        run = np.cumsum(far < LENGTH - before)
        inside = np.flatnonzero((before <= at[order]) & (at[order] - before <= size[order] - LENGTH))
        if len(inside) < 2:
            continue
        run = run[inside]
        # Only those of a run with another one can be equal to it.
        twice = np.concatenate([run[1:] == run[:-1], [False]])
        twice[1:] |= run[1:] == run[:-1]
        inside, run = inside[twice], run[twice]
        if not len(inside):
            continue
        own = order[inside]
        start = anchor[own] - before
        key = _mixed(buffer.hashes(start, before) + run.astype(np.uint64) * MIX) if before else run.astype(np.uint64)
        by = np.lexsort((order_id[own], key))
        own, start, key = own[by], start[by], key[by]
        begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        first = np.repeat(begins, _sizes(begins, len(key)))
        claimed = np.flatnonzero(order_id[own] > order_id[own[first]])
        if not len(claimed):
            continue
        # Verification: what the hashes call equal must be so byte by byte.
        if all((view[start[c]] == view[start[first[c]]]).all() for c in np.split(claimed, range(1 << 17, len(claimed), 1 << 17))):
            gone = claimed
        else:  # a collision: exact strings decide
            best: dict[tuple, int] = {}
            texts = [(int(g), view[x].tobytes()) for g, x in zip(group[own], start, strict=True)]
            for t, i in zip(texts, order_id[own].tolist(), strict=True):
                best[t] = min(best.get(t, i), i)
            gone = np.array([i > best[t] for t, i in zip(texts, order_id[own].tolist(), strict=True)]).nonzero()[0]
        found.append((own[gone], at[own[gone]] - before))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


#: Bytes of contexts sorted together; grams are not split.
SORTED = 4 << 20


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        for kind, payload in zip(*(batch.column(c).to_pylist() for c in ("kind", "payload")), strict=True):
            if kind == SPANS:
                yield _span_rows(*_unpacked(payload, _SPAN)[0])
            else:
                columns, raw = _unpacked(payload, (np.uint64, np.int64, np.int64, np.int64, np.int32, np.int32))
                held.append((*columns, raw))
    if not held:
        return
    gram, order_id, key, start, at, size = (np.concatenate(c) for c in list(zip(*held, strict=True))[:6])
    raw = np.concatenate([h[6] for h in held])
    offset = np.cumsum(size, dtype=np.int64) - size
    order, begins = _groups(gram)
    # A gram of one context has nothing to meet here; its documents' other tasks have settled it.
    alone = np.repeat(_sizes(begins, len(order)) == 1, _sizes(begins, len(order)))
    order = order[~alone]
    begins = np.flatnonzero(np.concatenate([[True], gram[order[1:]] != gram[order[:-1]]])) if len(order) else begins[:0]
    total = np.cumsum(size[order], dtype=np.int64)
    # Whole grams at a time, so that what is sorted together stays bounded.
    cuts, last = [0], 0
    for b in begins[1:].tolist():
        if total[b - 1] - last >= SORTED:
            cuts.append(b)
            last = total[b - 1]
    for lo, hi in zip(cuts, [*cuts[1:], len(order)], strict=True):
        own = order[lo:hi]
        if not len(own):
            continue
        lengths = size[own].astype(np.int64)
        begin = np.cumsum(lengths) - lengths
        bytes_of = np.repeat(offset[own] - begin, lengths) + np.arange(lengths.sum())
        which, place = repeated(raw[bytes_of], begin, lengths, at[own].astype(np.int64), gram[own], order_id[own])
        if len(which):
            of = own[which]
            first = start[of] + place
            yield _span_rows(*_joined(order_id[of], key[of], first, first + LENGTH))


def _copies(docs: DataFrame) -> DataFrame:
    """``ord, key, start, stop``: the whole of every text that a smaller id has letter for letter."""
    rows = _documents(docs).select("ord", "key", F.octet_length("data").alias("n"), F.md5("data").alias("digest"))
    first = rows.groupBy("digest").agg(F.min("ord").alias("first"), F.max("ord").alias("most")).where("first < most")
    copies = rows.where(F.col("n") >= LENGTH).join(first, "digest").where("ord > first")
    return copies.select("ord", "key", F.lit(0).cast("bigint").alias("start"), F.col("n").cast("bigint").alias("stop")).distinct()


def spans(docs: DataFrame) -> DataFrame:
    """``ord, key, start, stop`` of the bytes to remove; spans of a document may overlap."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _documents(docs)
    offers = rows.select("ord", "key", "data").mapInArrow(
        _offers(np.array(dealt(spark, parts), dtype=np.int32)), "part int, kind int, gram binary, ord binary, key binary, place binary"
    )
    folder = new_folder(spark, "anchors")
    offers.repartition(parts, "part").mapInArrow(
        _met, "gram bigint, ord bigint, key bigint, place int, hot boolean"
    ).write.parquet(folder)
    met = spark.read.parquet(folder)
    members, any_hot = met.agg(F.count_if(~F.col("hot")), F.max("hot")).first()
    placed = met.where("not hot")
    if any_hot:
        # Spark broadcasts the table of hot grams only while it is small.
        hot = met.where("hot").select("gram", F.lit(1).alias("is_hot")).distinct()
        placed = placed.join(hot, "gram", "left")
    else:
        placed = placed.withColumn("is_hot", F.lit(0))
    copies = cut(_copies(docs))
    marked = (F.col("place").cast("bigint") * 2 + F.coalesce("is_hot", F.lit(0))).alias("place")
    places = placed.select("ord", "key", marked).groupBy("ord", "key").agg(F.collect_set("place").alias("places"))
    places = places.join(copies.select("ord", "key"), ["ord", "key"], "left_anti")
    # All columns of ``rows`` go along, so that this exchange of texts serves remove() as well.
    chosen = rows.join(places, ["ord", "key"])
    # As many parts as the contexts have bytes for, each around an anchor with half its grams on average.
    parts = max(parts, -(-members * (LENGTH + GRAMS // 2) // PART_BYTES))
    contexts = chosen.mapInArrow(_contexts(np.array(dealt(spark, parts), dtype=np.int32)), "part int, kind int, payload binary")
    out = contexts.repartition(parts, "part").mapInArrow(_spans, "ord bigint, key bigint, start bigint, stop bigint")
    if any_hot:
        windows = chosen.mapInArrow(_hot_windows, "ord bigint, key bigint, start bigint, stop bigint, window binary")
        met_again = windows.where("window is not null")
        least = met_again.groupBy("window").agg(F.min("ord").alias("least"), F.max("ord").alias("most")).where("least <> most")
        out = out.union(windows.where("window is null").drop("window"))
        out = out.union(met_again.join(least.drop("most"), "window").where("ord > least").select("ord", "key", "start", "stop"))
    return out.union(copies)


def remove(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` of every row; ``kept`` are the bytes that stay
    (null without ``keep_text``)."""
    found = spans(docs).groupBy("ord", "key").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    rows = _documents(docs).join(found, ["ord", "key"], "left")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]

    def batch_of(ids: pa.Array, out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        return pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(zip(*out), kinds, strict=True))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, size, out = 0, 0, []
            columns = batch.column("doc_id"), batch.column("data"), batch.column("spans")
            for i in range(batch.num_rows):
                data, own = columns[1][i].as_py(), columns[2][i]
                if own.is_valid:
                    starts, stops = (own.values.field(c).to_numpy().tolist() for c in ("start", "stop"))
                else:
                    starts, stops = [], []
                kept, last, count, removed = [], 0, 0, 0
                for start, stop in zip(starts, stops, strict=True):
                    if start > last or not count:
                        kept.append(data[last:start])
                        count += 1
                        last = start
                    if stop > last:
                        removed += stop - last
                        last = stop
                kept = b"".join([*kept, data[last:]])
                out.append((len(data), removed, count, sha256(kept).hexdigest(), kept if keep_text else None))
                size += len(data)
                if size >= UNIT_BYTES:
                    yield batch_of(columns[0].slice(first, i + 1 - first), out)
                    first, size, out = i + 1, 0, []
            if out:
                yield batch_of(columns[0].slice(first), out)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")


#: The same result for DuckDB, window by window, on hexadecimal text (two characters a byte, cut into blocks).
ORACLE_SQL = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
b as (
  select doc_id, 256 * b as first, substr(h, 512 * b + 1, 610) as t
  from (select *, unnest(range(0, (length(h) // 2 - 50) // 256 + 1)) as b from d where length(h) >= 100)),
w as (
  select doc_id, first + j as i, substr(t, 2 * j + 1, 100) as s
  from (select *, unnest(range(0, least(256, length(t) // 2 - 49))) as j from b)),
f as (select s, min(doc_id) as least from w group by s having count(distinct doc_id) > 1),
gone as (select doc_id, i from w join f using (s) where least < doc_id),
fresh as (select *, coalesce(i > lag(i) over (partition by doc_id order by i) + 50, true) as begins from gone),
runs as (
  select doc_id, min(i) as start, max(i) + 50 as stop
  from (select *, sum(begins::int) over (partition by doc_id order by i) as run from fresh) group by doc_id, run),
placed as (select *, coalesce(lag(stop) over (partition by doc_id order by start), 0) as before from runs),
cut as (
  select doc_id, count(*) as n_spans, sum(stop - start) as n_removed, max(stop) as last,
    string_agg(substr(h, 2 * before + 1, 2 * (start - before)), '' order by start) as kept
  from placed join d using (doc_id) group by doc_id)
select doc_id, length(h) // 2 as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) as kept_sha256
from d left join cut using (doc_id)
"""
