import numpy as np
import pytest
import xxhash

from rowlake.llm import simhash
from rowlake.llm.common import table


def brute_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(ids, prints, budget=2):
    """Smallest id reachable, by comparing every pair."""
    fps = np.array(prints, dtype=np.uint64)
    label = np.array(ids)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= budget
    while True:
        least = np.where(near, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        if (least == label).all():
            return label.tolist()
        label = least


def test_whole_table_against_all_pairs(spark, sf_dir):
    docs = table(spark, sf_dir.replace("0.001", "0.01"), "documents")
    rows = sorted(docs.select("doc_id", "text").collect())
    prints = [brute_print(r.text) for r in rows]
    wanted = brute_groups([r.doc_id for r in rows], prints)
    got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {r.doc_id: (p, c) for r, p, c in zip(rows, prints, wanted, strict=True)}
    assert len(set(wanted)) < len(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_links_join_all_within_budget(spark, seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    fps = {int(b) for b in base}
    for b in base:
        x = int(b)
        for _ in range(25):  # chains of small steps, and steps beyond the budget
            for bit in rng.choice(64, rng.integers(1, 5), replace=False):
                x ^= 1 << int(bit)
            fps.add(x)
    fps = sorted(fps)
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    wanted = brute_groups(signed, fps)
    frame = spark.createDataFrame([(s,) for s in signed], "fp bigint")
    got = {r.fp: r.component for r in simhash._groups(frame).collect()}
    assert [got[s] for s in signed] == wanted
    for r in simhash.links(frame).collect():
        assert (r.a ^ r.b) % 2**64 and bin((r.a ^ r.b) % 2**64).count("1") <= 2


def test_edge_rows(spark):
    long = " ".join(f"w{i % 977}x{i}" for i in range(70_000))
    rows = [
        (1, None, "a"), (2, "", "b"), (3, " \t\n", "c"), (4, "One two", "d"), (5, "one TWO", "e"), (5, "one TWO", "e"),
        (6, long, "f"), (None, "one two", "g"), (None, "lonely words here now", "h"), (7, "É é", "i"), (8, "é é", "j"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp string")
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    of = {r.doc_id: r for r in got if r.doc_id is not None}
    assert [of[i].component_id for i in (1, 2, 3, 4, 5, 6)] == [1, 1, 1, 4, 4, 6]
    assert of[1].fp == 0 and of[6].fp % 2**64 == brute_print(long)
    assert of[7].fp != of[8].fp  # only A-Z are lower-cased
    assert sorted((r.component_id for r in got if r.doc_id is None), key=str) == [4, None]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
