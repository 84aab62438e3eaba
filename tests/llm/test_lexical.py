import math
import random
import re
from collections import Counter

import numpy as np

from rowlake.llm import lexical
from rowlake.llm.common import table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, best):
    """Every document scored for every item."""
    words = [(i, split(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in words), sum(len(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    out = []
    for item_id, text in dict.fromkeys(items):
        scored = []
        for doc_id, w in words:
            counts, score = Counter(w), 0
            for t in set(split(text)):
                if counts[t]:
                    m = 50 + (50 * len(w) * n_docs) // n_terms
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 20 * m))
            if score:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, i + 1, row[3], -row[0]) for i, row in enumerate(sorted(scored)[:best])]
    return sorted(out, key=str)


def got(spark, docs, items, best):
    left = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id bigint, text string, item int, score string")
    right = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id bigint, text string, rank int")
    return sorted((tuple(r) for r in lexical.rank(left, right, best).collect()), key=str)


def corpus(rng, n, vocabulary=60):
    return [(i, " ".join(f"w{int(rng.paretovariate(0.7)) % vocabulary}" for _ in range(rng.choice([0, 1, 3, 20, 200])))) for i in range(n)]


def test_pruned_search_is_exact(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BUCKET", 16)
    monkeypatch.setattr(lexical, "FOCUS", 2)
    rng = random.Random(3)
    docs = corpus(rng, 300)
    docs += [(400 + i, docs[7][1]) for i in range(40)]  # copies tie
    items = [(i, " ".join(f"w{rng.randrange(70)}" for _ in range(rng.randint(1, 12)))) for i in range(25)]
    for best in (1, 5, 50):
        assert got(spark, docs, items, best) == brute(docs, items, best)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 60)
    rng = random.Random(4)
    docs, items = corpus(rng, 60), [(i, f"w{i} w{i + 1} W1 nothing") for i in range(9)]
    assert len(list(lexical.item_blocks(spark.createDataFrame(items, "item_id bigint, text string")))) > 1
    assert got(spark, docs, items, 5) == brute(docs, items, 5)


def test_odd_rows(spark):
    docs = [
        (None, None), (1, ""), (2, " .,;"), (3, "Straße ÉA éa x1"), (3, "Straße ÉA éa x1"), (None, "x1 x1"), (5, "x1 b\x00c [x1] `b`"),
        (6, "b " * 5000), (7, "x1 b"), (9, "😀 x1"),
    ]
    items = [(None, "x1"), (1, None), (2, "!"), (3, "éa ÉA STRAßE B"), (3, "éa ÉA STRAßE B"), (3, "other x1"), (4, "missing"), (5, "b " * 300)]
    assert got(spark, docs, items, 50) == brute(docs, [i for i in items if split(i[1])], 50)
    assert got(spark, [], items, 50) == [] and got(spark, docs, [], 50) == [] and got(spark, docs[:3], items, 50) == []


def test_bounds_hold(spark):
    """No vector that reaches a threshold is passed over, and vectors below it are."""
    rng = np.random.default_rng(1)
    passed = 0
    for _ in range(200):
        n, width = 50, 30
        own = np.where(rng.random((n, width)) < 0.2, rng.integers(1, 10**6, (n, width)), 0)
        own[:, 0] += 1
        begins = np.concatenate([[0], np.cumsum((own > 0).sum(axis=1))])
        rows, columns = np.nonzero(own)
        bucket = lexical.Bucket(np.sqrt((own.astype(float) ** 2).sum(axis=1)), begins, columns, own[rows, columns])
        weights = rng.integers(0, 20000, width)
        numbers = rng.permutation(width)[:15].tolist()
        item = lexical.Item.of(numbers, weights)
        scores = (own[:, numbers] * weights[numbers]).sum(axis=1)
        threshold = int(np.sort(scores)[rng.integers(0, n)])
        found, exact = bucket.scores(item, threshold)
        wanted = np.flatnonzero((scores >= threshold) & (scores > 0))
        assert found.tolist() == wanted.tolist() and exact.tolist() == scores[wanted].tolist()
        passed += len(bucket.scores(item, int(item.length * bucket.longest * 1.01) + 2)[0])
    assert passed == 0


def test_given_tables(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = sorted((tuple(r) for r in lexical.rank(docs, items).collect()), key=str)
    wanted = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 50)
    assert found == wanted and len(found) > 500
