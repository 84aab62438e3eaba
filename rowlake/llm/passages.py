"""Fuzzy passages shared by documents: k-mer seeds, collinear chains, alignment.

Seeds are five-word k-mers at minimizers (of each eight in a row, the smallest
hash), so two texts that agree in twelve words running share a seed. Each seed
is joined to its first occurrence: the document of the smallest id that has it.
So matches are linear in the text, however many documents share a passage. The
matches of a document with a first owner are chained: both orders must rise, and
moving on costs in proportion to the words passed on both sides; a Fenwick tree
of prefix maxima finds each best predecessor in logarithmic time. Chains are
aligned word by word between their seeds, on one-byte codes of the words behind
each seed that travel with it; a word whose code is not known counts as a
mismatch. Chains that touch in a document are one passage, whoever owns them.
Passages have at least ``LEAST_WORDS`` words and ``IDENTITY`` of them aligned.

Phrases of a passage may have been met before, each in another document, which
then owns its seed and hides who else has the whole. So stretches full of
matches that no owner of ``LEAST_WORDS`` explains go on to another round: there
the documents that have them compete again, by runs of two seeds, then of four,
which other documents hardly have met singly.

A document is linked to the owners of its passages, and to the others that have
the same words of an owner: as many of them as overlap it there by
``LEAST_WORDS``, counted from how many begin and end at each place of the
owner's text and never paired off. A pair that two owners link counts for each.

A result names, for each document, its passages that occur before it, the
owners it was aligned to, the number of its links from either side, and the
class: the smallest id reachable over links.

A null text is an empty one. Null ids count as larger than any other and are
not linked to each other; rows of one id are not linked to each other; repeated
rows get equal results. Texts below five words have no seeds. Other columns are
not read; no rows, no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from rowlake.llm.common import cut
from rowlake.llm.components import components

K = 5
#: K-mers of which one is a seed; also the words whose codes follow a seed.
WINDOW = 8
IDENTITY = 0.8
LEAST_WORDS = 32
#: Chains this many words apart in a document make one passage.
JOIN = 10
#: Worth of a seed, and cost of a word passed on either side.
WORTH, GAP = 5.0, 0.1
#: Seeds and words below which a chain is chance.
LEAST_SEEDS, LEAST_CHAIN = 2, 10
#: Seeds of a run that are joined in each round.
RUNS = (1, 2, 4)
#: Words between matches of one stretch, and matches from which a stretch goes on to the next round.
STRETCH, LEAST_MATCHES = 2 * WINDOW, 3
LAST = np.iinfo(np.int64).max
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: What a byte of a text is for its words: itself in lower case, or a blank.
BYTES = bytes(b if WORD.match(bytes([b]).lower()) else 0x20 for b in range(256)).lower()
#: Bytes of texts whose seeds are found together; their arrays stay small.
TOGETHER = 1 << 18


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of the words of all texts, one behind the other, and how many each text has."""
    words = [text.translate(BYTES).split() for text in texts]
    digests = b"".join([d for own in words for d in map(xxhash.xxh64_digest, own)])
    return np.frombuffer(digests, dtype=">u8").astype(np.uint64), np.array([len(own) for own in words], dtype=np.int64)


def _stretches(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places from each start on, as many as its size, and the number of the start of each."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(of)) + (starts - (np.cumsum(sizes) - sizes))[of], of


def seeds_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of the text, hash, place (in words) and the codes of the eight words behind it of each seed.

    The words of all texts lie in one array, with a gap behind each text that no
    k-mer and no window of it reaches beyond.
    """
    hashes, sizes = _word_hashes(texts)
    starts = np.cumsum(sizes + K + WINDOW) - (sizes + K + WINDOW)
    total = int((sizes + K + WINDOW).sum())
    at_words, _ = _stretches(starts, sizes)
    words, codes = np.zeros(total, np.uint64), np.zeros(total, np.uint8)
    words[at_words] = hashes
    codes[at_words] = (hashes >> np.uint64(40)).astype(np.uint8) | np.uint8(1)
    n = max(0, total - K + 1)
    grams = words[:n].copy()
    for i in range(1, K):
        grams *= np.uint64(0x9E3779B97F4A7C15)
        grams += words[i : i + n]
    grams = (grams ^ (grams >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    grams ^= grams >> np.uint64(29)
    # What is no k-mer of one text is never the smaller one; of equal ones the first counts.
    kmers = np.maximum(sizes - K + 1, 0)
    at_grams, _ = _stretches(starts, kmers)
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    least[at_grams] = grams[at_grams]
    where, size = np.arange(n, dtype=np.int32), 1
    while size < WINDOW:
        by = min(size, WINDOW - size)
        later = least[by:] < least[:-by]
        least, where = np.where(later, least[by:], least[:-by]), np.where(later, where[by:], where[:-by])
        size += by
    # A text of fewer k-mers than a window has one window.
    windows, of = _stretches(starts, np.where(kmers > 0, np.maximum(kmers - WINDOW, 0) + 1, 0))
    chosen = where[windows]
    new = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]])[: len(chosen)])
    place, of = chosen[new].astype(np.int64), of[new]
    found = grams[place]
    # In a run of one k-mer, each is told from the next by its number in the run.
    same = np.concatenate([[False], (found[1:] == found[:-1]) & (of[1:] == of[:-1])])[: len(found)]
    at = np.arange(len(found))
    run = at - np.maximum.accumulate(np.where(same, 0, at))
    found = found + run.astype(np.uint64) * np.uint64(0x94D049BB133111EB)
    behind = np.lib.stride_tricks.sliding_window_view(codes, WINDOW)[place + K] if len(place) else np.zeros((0, WINDOW), np.uint8)
    return of, found.view(np.int64), (place - starts[of]).astype(np.int32), np.ascontiguousarray(behind).view(np.int64).ravel()


def seeds(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, place (in words) and the codes of the eight words behind it of each seed."""
    return seeds_of([text])[1:]


def _together(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """First and end of texts that follow each other and have ``TOGETHER`` bytes in sum, the last one aside."""
    first, size = 0, 0
    for i, text in enumerate(texts, 1):
        size += len(text)
        if size >= TOGETHER or i == len(texts):
            yield first, i
            first, size = i, 0


def _seed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # What changes from row to row stands last, which packs well in a shuffle.
    names = ["ord", "key", "place", "gram", "codes"]
    for batch in batches:
        order_ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("ord", "key"))
        data = batch.column("data").to_pylist()
        parts, size = [], 0
        for first, end in _together(data):
            of, gram, place, codes = seeds_of(data[first:end])
            parts.append((order_ids[first:end][of], keys[first:end][of], place, gram, codes))
            size += len(gram)
            if size > 200_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], names)
                parts, size = [], 0
        if size:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], names)


class Fenwick:
    """Prefix maxima with the index that has them."""

    def __init__(self, size: int) -> None:
        self.best = [(-np.inf, -1)] * (size + 1)

    def add(self, at: int, value: float, index: int) -> None:
        at += 1
        while at < len(self.best):
            if value > self.best[at][0]:
                self.best[at] = (value, index)
            at += at & -at

    def before(self, at: int) -> tuple[float, int]:
        """The largest value at places below ``at``."""
        out = (-np.inf, -1)
        while at > 0:
            if self.best[at][0] > out[0]:
                out = self.best[at]
            at -= at & -at
        return out


def chains(x: list[int], y: list[int]) -> list[list[int]]:
    """Chains of matches (places ``x`` sorted, ``y`` in the other text), best first; each match is in one at most."""
    ranks = {v: i for i, v in enumerate(sorted(set(y)))}
    tree = Fenwick(len(ranks))
    score, back = [0.0] * len(x), [-1] * len(x)
    i = 0
    while i < len(x):
        j = i
        while j < len(x) and x[j] == x[i]:  # matches at one place do not follow each other
            value, index = tree.before(ranks[y[j]])
            passed = value - GAP * (x[j] + y[j])
            score[j], back[j] = (WORTH + passed, index) if passed > 0 else (WORTH, -1)
            j += 1
        for m in range(i, j):
            tree.add(ranks[y[m]], score[m] + GAP * (x[m] + y[m]), m)
        i = j
    used, out = [False] * len(x), []
    for end in sorted(range(len(x)), key=lambda m: -score[m]):
        own, at = [], end
        while at >= 0 and not used[at]:
            used[at] = True
            own.append(at)
            at = back[at]
        if len(own) >= LEAST_SEEDS:
            out.append(own[::-1])
    return out


def _known(places: list[int], codes: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Codes of the words from ``start`` to ``stop`` as far as seeds tell them; 0: not known."""
    out = np.zeros(stop - start + K + WINDOW, dtype=np.uint8)
    behind = codes.view(np.uint8).reshape(-1, WINDOW)
    for p, own in zip(places, behind, strict=True):
        out[p - start + K : p - start + K + WINDOW] = own
    return out[: stop - start]


def _aligned(a: np.ndarray, b: np.ndarray) -> int:
    """Words that stay in the best alignment of two short gaps (longest common subsequence of known codes)."""
    if not len(a) or not len(b):
        return 0
    if len(a) == len(b) and (a == b).all() and a.all():
        return len(a)
    row = np.zeros(len(b) + 1, dtype=np.int32)
    for code in a:
        met = np.concatenate([[0], np.where((b == code) & (code != 0), row[:-1] + 1, row[1:])])
        row = np.maximum.accumulate(np.maximum(met, row))
    return int(row[-1])


def align(x: list[int], y: list[int], x_codes: np.ndarray, y_codes: np.ndarray) -> tuple[int, int, int, int, int]:
    """``start, stop`` in both texts and the aligned words of a chain, extended behind its last seed while codes agree."""
    x0, x1, y0, y1 = x[0], x[-1] + K, y[0], y[-1] + K
    known_x, known_y = _known(x, x_codes, x0, x1 + WINDOW), _known(y, y_codes, y0, y1 + WINDOW)
    matched, at_x, at_y = 0, x0, y0
    for px, py in zip(x, y, strict=True):
        if px >= at_x and py >= at_y:
            matched += K + _aligned(known_x[at_x - x0 : px - x0], known_y[at_y - y0 : py - y0])
        else:  # the seed overlaps the one before
            matched += max(0, min(px + K - at_x, py + K - at_y))
        at_x, at_y = max(at_x, px + K), max(at_y, py + K)
    more = 0
    while more < WINDOW and known_x[x1 - x0 + more] and known_x[x1 - x0 + more] == known_y[y1 - y0 + more]:
        more += 1
    return x0, x1 + more, y0, y1 + more, matched + more


Owner = tuple[int, int, int]  # id, first word and end of its words


def passages(rows: list[tuple[int, list[int], list[int], np.ndarray, np.ndarray]]) -> list[tuple[int, int, float, list[Owner]]]:
    """``start, stop, identity, owners`` of a document's passages from its matches with each owner.

    Owners are those who alone have ``LEAST_WORDS`` words of a passage.
    """
    found = []
    for owner, x, y, x_codes, y_codes in rows:
        for chain in chains(x, y):
            own = np.array(chain)
            start, stop, first, last, matched = align([x[m] for m in chain], [y[m] for m in chain], x_codes[own], y_codes[own])
            if stop - start >= LEAST_CHAIN and matched >= IDENTITY * (stop - start):
                found.append((start, stop, matched, owner, first, last))
    found.sort()
    out: list[tuple[int, int, float, list[Owner]]] = []
    group: list[tuple] = []
    end = 0

    def close() -> None:
        start, stop = group[0][0], end
        # Words aligned to several owners count once.
        gone, matched = start, 0.0
        words: dict[int, int] = {}
        places: dict[int, tuple[int, int]] = {}
        for s, e, m, owner, first, last in group:
            fresh = max(0, e - max(s, gone))
            matched += fresh * min(1.0, m / (e - s))
            gone = max(gone, e)
            words[owner] = words.get(owner, 0) + e - s
            low, high = places.get(owner, (first, last))
            places[owner] = min(low, first), max(high, last)
        if stop - start >= LEAST_WORDS and matched >= IDENTITY * (stop - start):
            out.append((start, stop, matched / (stop - start), [(o, *places[o]) for o in sorted(words) if words[o] >= LEAST_WORDS]))

    for c in found:
        if group and c[0] > end + JOIN:
            close()
            group = []
        end = max(end, c[1]) if group else c[1]
        group.append(c)
    if group:
        close()
    return out


def unexplained(places: np.ndarray, found: list[tuple]) -> np.ndarray:
    """Of the sorted, distinct places of matches, those in dense stretches outside passages that have an owner."""
    free = np.ones(len(places), dtype=bool)
    for start, stop, _, owners in found:
        if owners:
            free &= (places < start) | (places >= stop)
    left = np.flatnonzero(free)
    if len(left) < LEAST_MATCHES:
        return left[:0]
    cuts = np.flatnonzero(np.diff(places[left]) > STRETCH) + 1
    kept = [
        own for own in np.split(left, cuts)
        if len(own) >= LEAST_MATCHES and places[own[-1]] - places[own[0]] + K + WINDOW >= LEAST_WORDS
    ]
    return np.concatenate(kept) if kept else left[:0]


_FOUND = (
    "ord bigint, key bigint, passages array<struct<start:int,stop:int,identity:double>>, "
    "links array<struct<owner:bigint,first:int,last:int>>, rest array<struct<place:int,gram:bigint,codes:bigint>>"
)
_KINDS = [
    pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("identity", pa.float64())])),
    pa.list_(pa.struct([("owner", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])),
    pa.list_(pa.struct([("place", pa.int32()), ("gram", pa.int64()), ("codes", pa.int64())])),
]


def _mixed(owner: np.ndarray, place: np.ndarray) -> np.ndarray:
    out = (owner.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    return (out ^ (out >> np.uint64(29))).view(np.int64)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_FOUND`` of each document from its matches, which come sorted by document, owner and place."""
    names = ["ord", "key", "passages", "links", "rest"]
    wanted = ("ord", "key", "owner", "place", "owner_place", "codes", "owner_codes")

    def result(document: tuple[int, int], parts: list[np.ndarray]) -> tuple | None:
        owner, x, y, x_codes, y_codes = (np.concatenate([p[i] for p in parts]) for i in range(5))
        cuts = np.flatnonzero(owner[1:] != owner[:-1]) + 1
        rows = [
            (int(owner[own[0]]), x[own].tolist(), y[own].tolist(), x_codes[own], y_codes[own])
            for own in np.split(np.arange(len(owner)), cuts) if len(own) >= LEAST_SEEDS
        ]
        found = passages(rows)
        places, at = np.unique(x, return_index=True)
        rest = at[unexplained(places, found)]
        if not found and not len(rest):
            return None
        spans = [{"start": s, "stop": e, "identity": i} for s, e, i, _ in found]
        links = [{"owner": o, "first": f, "last": e} for *_, owners in found for o, f, e in owners]
        # Where a seed occurs first says which one it is.
        gram = _mixed(owner[rest], y[rest]).tolist()
        again = [{"place": int(x[i]), "gram": g, "codes": int(x_codes[i])} for i, g in zip(rest.tolist(), gram, strict=True)]
        return (*document, spans, links, again)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS, strict=True)], names)

    document, parts, out = None, [], []
    for batch in batches:
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in wanted]
        new = np.flatnonzero((columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])) + 1
        for lo, hi in zip([0, *new.tolist()], [*new.tolist(), batch.num_rows], strict=True):
            if lo == hi:
                continue
            own = (int(columns[0][lo]), int(columns[1][lo]))
            if own != document:
                if document is not None and (row := result(document, parts)):
                    out.append(row)
                document, parts = own, []
                if len(out) >= 5_000:
                    yield batch_of(out)
                    out = []
            parts.append([c[lo:hi] for c in columns[2:]])
    if document is not None and (row := result(document, parts)):
        out.append(row)
    if out:
        yield batch_of(out)


def _documents(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    order = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(int(LAST)))
    return docs.select("doc_id", order.alias("ord"), F.xxhash64(text).alias("key"), text.cast("binary").alias("data"))


def first_round(docs: DataFrame) -> DataFrame:
    """``_FOUND`` by single seeds."""
    return _matched(_documents(docs).select("ord", "key", "data").mapInArrow(
        _seed_rows, "ord bigint, key bigint, place int, gram bigint, codes bigint"
    ))


def _matched(found: DataFrame) -> DataFrame:
    """``_FOUND`` of documents whose seeds occur under a smaller id."""
    # Grams of one document are dropped by the join below, whose condition only other documents meet.
    first = found.groupBy("gram").agg(F.min(F.struct("ord", "place", "codes")).alias("first")).select(
        F.col("gram").alias("first_gram"), F.col("first.ord").alias("owner"), F.col("first.place").alias("owner_place"),
        F.col("first.codes").alias("owner_codes"),
    )
    matches = found.join(first, (F.col("gram") == F.col("first_gram")) & (F.col("ord") > F.col("owner"))).select(
        "ord", "key", "owner", "place", "owner_place", "codes", "owner_codes"
    )
    dealt = matches.repartition("ord", "key").sortWithinPartitions("ord", "key", "owner", "place", "owner_place")
    return dealt.mapInArrow(_chained, _FOUND)


def _runs(found: DataFrame, apart: int) -> DataFrame:
    """The unexplained seeds of a round, each joined to the one ``apart`` places behind it in its stretch."""
    near = f"element_at(rest, i + {apart + 1}).place - rest[i].place <= {apart * STRETCH}"
    each = (
        f"inline(transform(filter(sequence(0, greatest(size(rest) - {apart + 1}, 0)), i -> i + {apart} < size(rest) and {near}),"
        f" i -> struct(rest[i].place as place, xxhash64(rest[i].gram, element_at(rest, i + {apart + 1}).gram) as gram, rest[i].codes as codes)))"
    )
    return found.where(f"size(rest) > {apart}").selectExpr("ord", "key", each)


def found_passages(docs: DataFrame) -> DataFrame:
    """``ord, key, passages, links`` of the documents that have passages which occur under a smaller id, from all rounds."""
    rounds = [cut(first_round(docs))]
    for before, run in zip(RUNS, RUNS[1:]):
        rounds.append(cut(_matched(_runs(rounds[-1], run - before))))
    every = rounds[0]
    for more in rounds[1:]:
        every = every.union(more)
    # Passages that a later round has found again, or that overlap, are one.
    joined = (
        "aggregate(array_sort(flatten(collect_list(passages))), cast(array() as array<struct<start:int,stop:int,identity:double>>), (a, x) ->"
        " if(size(a) > 0 and x.start < element_at(a, -1).stop, concat(slice(a, 1, size(a) - 1), array(named_struct("
        "'start', element_at(a, -1).start, 'stop', greatest(element_at(a, -1).stop, x.stop), 'identity', greatest(element_at(a, -1).identity, x.identity)))),"
        " concat(a, array(x))))"
    )
    return every.where("size(passages) > 0").groupBy("ord", "key").agg(
        F.expr(joined).alias("passages"), F.array_distinct(F.flatten(F.collect_list("links"))).alias("links")
    )


def link_counts(links: DataFrame) -> DataFrame:
    """``ord, n`` from ``ord, owner, first, last``: how many documents each is linked to, through its owners or as one.

    Two that have words of one owner are linked if these overlap by ``LEAST_WORDS``: all but those that begin
    too late and those that end too early, which are never the same.
    """
    def at(place: str, name: str) -> DataFrame:
        counts = links.groupBy("owner", place).agg(F.count(F.lit(1)).alias("n"))
        return counts.groupBy("owner").agg(F.collect_list(F.struct(F.col(place).alias("at"), "n")).alias(name), F.sum("n").alias(f"{name}_n"))

    # A row per owner, with at most as many places as its text has words.
    owners = at("first", "begins").join(at("last", "ends"), "owner")
    late = f"aggregate(filter(begins, b -> b.at > last - {LEAST_WORDS}), 0L, (a, b) -> a + b.n)"
    early = f"aggregate(filter(ends, b -> b.at < first + {LEAST_WORDS}), 0L, (a, b) -> a + b.n)"
    # The document itself is among them, and its owner is not.
    members = links.join(owners, "owner").selectExpr("ord", f"begins_n - {late} - {early} as n")
    return members.union(owners.selectExpr("owner", "begins_n")).groupBy("ord").agg(F.sum("n").alias("n"))


def shared_passages(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, class_id, n_links, n_passages, n_repeated`` (words), ``passages, owners``.

    A null id has no class and no links.
    """
    found = cut(found_passages(docs))
    links = found.where(F.col("ord") != LAST).select("ord", F.inline("links")).groupBy("ord", "owner").agg(
        F.min("first").alias("first"), F.max("last").alias("last")
    )
    of = components(links.select(F.col("ord").alias("a"), F.col("owner").alias("b"))).select(F.col("node").alias("ord"), "component")
    rows = _documents(docs).select("doc_id", "ord", "key")
    owners = F.array_sort(F.array_distinct(F.col("links.owner")))
    out = rows.join(found, ["ord", "key"], "left").join(link_counts(links), "ord", "left").join(of, "ord", "left")
    return out.select(
        "doc_id", F.coalesce("component", F.col("doc_id").cast("bigint")).alias("class_id"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("passages").isNull(), 0).otherwise(F.size("passages")).cast("bigint").alias("n_passages"),
        F.expr("aggregate(coalesce(passages, array()), 0L, (a, p) -> a + p.stop - p.start)").alias("n_repeated"),
        "passages", owners.alias("owners"),
    )
