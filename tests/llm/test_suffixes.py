import random
from hashlib import sha256

import numpy as np
import pytest

from rowlake.llm import suffixes
from rowlake.llm.common import table


def brute(rows):
    """Every 50-byte string with the smallest id it starts in."""
    first = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    order = [float("inf") if i is None else i for i, _ in data]
    for o, (_, d) in zip(order, data, strict=True):
        for s in range(len(d) - 49):
            w = d[s : s + 50]
            first[w] = min(first.get(w, o), o)
    out = []
    for o, (i, d) in zip(order, data, strict=True):
        gone = np.zeros(len(d), dtype=bool)
        for s in range(len(d) - 49):
            if first[d[s : s + 50]] < o:
                gone[s : s + 50] = True
        kept = bytes(np.frombuffer(d, np.uint8)[~gone])
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(d), int(gone.sum()), runs, sha256(kept).hexdigest(), kept))
    return sorted(out, key=str)


def made(seed):
    rng = random.Random(seed)
    words = ["the", "of", "naïve", "a", "ringer", "x", "日本", "onward"]
    passages = [" ".join(rng.choices(words, k=rng.randint(8, 60))) for _ in range(5)]
    rows = [(i, "".join(rng.choice([" ".join(rng.choices(words, k=rng.randint(1, 30))), rng.choice(passages)]) + rng.choice(["", " ", "!"]) for _ in range(rng.randint(0, 6)))) for i in range(40)]
    rows += [(100 + i, rows[i][1]) for i in range(8)]
    rows += [(200, "ab" * 100), (201, "ab" * 30 + "c" + "ba" * 40), (202, "z" * 49), (203, "z" * 50), (204, "z" * 51), (205, "z" * 300), (205, "z" * 300), (205, "y" * 70)]
    return [*rows, (None, passages[0] * 2), (None, passages[0] * 2), (None, None), (3, ""), (-5, passages[1])]


@pytest.mark.parametrize(("seed", "limits"), [(1, {}), (2, {"UNIT": 30, "UNIT_BYTES": 500, "SORTED": 3000, "STEP": 64, "PART_BYTES": 2000}), (3, {"HOT": 3, "UNIT": 50}), (4, {"HOT": 3, "UNIT": 50, "UNIT_BYTES": 900})])
def test_odd_rows(spark, monkeypatch, seed, limits):
    for name, value in limits.items():
        monkeypatch.setattr(suffixes, name, value)
    rows = made(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as ord", "'k' as key").repartition(3)
    assert sorted(map(tuple, suffixes.remove(docs).collect()), key=str) == brute(rows)
    assert suffixes.remove(docs.limit(0)).count() == 0


def test_whole_table(spark, sf_dir):
    docs = table(spark, sf_dir.replace("0.001", "0.01"), "documents")
    wanted = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sorted(map(tuple, suffixes.remove(docs).collect()), key=str) == wanted
    assert sum(r[2] for r in wanted) > 10_000


def test_sort_within_groups():
    rng = np.random.default_rng(3)
    raw = rng.choice(np.frombuffer(b"ab", np.uint8), 4000)
    starts = rng.permutation(3900)[:1500]
    room = rng.integers(1, 51, 1500)
    group = np.sort(rng.integers(0, 40, 1500))
    got = suffixes.Buffer(raw, starts, room).sort(group)
    for g in range(40):
        own = got[group == g].tolist()
        texts = [raw[starts[i] : starts[i] + room[i]].tobytes() for i in own]
        assert texts == sorted(texts) and sorted(own) == np.flatnonzero(group == g).tolist()


def test_anchors_are_the_leftmost_of_the_least_upper_bits(monkeypatch):
    rng = np.random.default_rng(4)
    # Upper bits of five values, so that many are equal; the low bits, which the place takes, say nothing.
    hashes = (rng.integers(0, 5, 400).astype(np.uint64) << np.uint64(40)) | rng.integers(0, 1 << 20, 400).astype(np.uint64)
    monkeypatch.setattr(suffixes, "gram_hashes", lambda raw: hashes[: len(raw) - suffixes.GRAM + 1])
    gram, place, first, count = suffixes.anchors(bytes(415))
    upper = (hashes >> np.uint64(40)).tolist()
    wanted = [min(range(w, w + suffixes.GRAMS), key=upper.__getitem__) for w in range(400 - suffixes.GRAMS + 1)]
    assert np.repeat(place, count).tolist() == wanted and first.tolist() == (np.cumsum(count) - count).tolist()
    assert (gram == hashes[place]).all() and len(set(place.tolist())) == len(place)


def cases(seed):
    """Contexts of some anchor grams, over few letters, so that windows repeat."""
    rng = random.Random(seed)
    grams = [bytes(rng.choices(b"ab", k=16)) for _ in range(6)]
    sides = [bytes(rng.choices(b"abc", k=34)) for _ in range(4)]
    rows = []
    for _ in range(300):
        g = rng.randrange(6)
        at = rng.randint(0, 34)
        right = rng.randint(34 - at, 34)
        left, after = (bytearray(rng.choice(sides)) for _ in range(2))
        if rng.random() < 0.3:
            left[rng.randrange(34)] = 120
        rows.append((g, (bytes(left)[34 - at :] + grams[g] + bytes(after)[:right]), at, rng.randint(0, 40)))
    return sorted(rows, key=lambda r: r[0])


@pytest.mark.parametrize("collide", [False, True])
def test_equal_windows_of_contexts(monkeypatch, collide):
    if collide:  # with a hash that calls all strings equal, verification still decides
        monkeypatch.setattr(suffixes.Buffer, "same", lambda self, a, b, length: np.ones(len(a), dtype=bool))
        monkeypatch.setattr(suffixes.Buffer, "hashes", lambda self, begin, length: np.zeros(len(begin), dtype=np.uint64))
    for seed in range(5):
        rows = cases(seed)
        size = np.array([len(r[1]) for r in rows])
        begin = np.cumsum(size) - size
        raw = np.frombuffer(b"".join(r[1] for r in rows), np.uint8)
        at, group, ids = (np.array([r[i] for r in rows]) for i in (2, 0, 3))
        which, place = suffixes.repeated(raw, begin, size, at, group, ids)
        best, wanted = {}, set()
        every = [(i, s, (r[0], r[2] - s, r[1][s : s + 50]), r[3]) for i, r in enumerate(rows) for s in range(len(r[1]) - 49)]
        for _, _, k, o in every:
            best[k] = min(best.get(k, o), o)
        wanted = {(i, s) for i, s, k, o in every if o > best[k]}
        assert set(zip(which.tolist(), place.tolist())) == wanted and len(which) == len(wanted) > 20


def test_joined_spans():
    rng = np.random.default_rng(5)
    o, k, a = (rng.integers(0, n, 300) for n in (4, 2, 900))
    b = a + rng.integers(1, 40, 300)
    covered = {(x, y, p) for x, y, s, e in zip(o, k, a, b) for p in range(s, e)}
    got = list(zip(*(c.tolist() for c in suffixes._joined(o, k, a, b))))
    assert {(x, y, p) for x, y, s, e in got for p in range(s, e)} == covered
    assert all(p[:2] != q[:2] or p[3] < q[2] for p, q in zip(got, got[1:]))
