import random
import re

import numpy as np
import pytest
import xxhash

from rowlake.llm import passages as ps
from rowlake.llm.common import table

M = 2**64


def brute_seeds(text):
    words = [xxhash.xxh64_intdigest(w) for w in re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())]
    grams = []
    for i in range(len(words) - 4):
        h = words[i]
        for w in words[i + 1 : i + 5]:
            h = (h * 0x9E3779B97F4A7C15 + w) % M
        h = (h ^ (h >> 31)) * 0xBF58476D1CE4E5B9 % M
        grams.append(h ^ (h >> 29))
    places = sorted({min(range(i, min(i + 8, len(grams))), key=lambda j: (grams[j], j)) for i in range(max(1, len(grams) - 7))} if grams else ())
    out, run = [], 0
    for n, p in enumerate(places):
        run = run + 1 if n and grams[places[n - 1]] == grams[p] else 0
        codes = [(w >> 40) % 256 | 1 for w in words[p + 5 : p + 13]]
        out.append(((grams[p] + run * 0x94D049BB133111EB) % M, p, bytes(codes + [0] * (8 - len(codes)))))
    return out


def brute_chains(x, y):
    """Every predecessor of every match."""
    score, back = [], []
    for j in range(len(x)):
        best = max(((score[i] + ps.GAP * (x[i] + y[i]), -i) for i in range(j) if x[i] < x[j] and y[i] < y[j]), default=(-1e9, 1))
        passed = best[0] - ps.GAP * (x[j] + y[j])
        score.append(ps.WORTH + max(passed, 0) if passed > 0 else ps.WORTH)
        back.append(-best[1] if passed > 0 else -1)
    return score


def brute_found(rows):
    first = {}
    held = [(i, t, brute_seeds(t)) for i, t in sorted(rows, key=lambda r: r[0])]
    for i, _, own in held:
        for g, p, c in own:
            first.setdefault(g, (i, p, c))
    out = {}
    for i, _, own in held:
        by = {}
        for g, p, c in own:
            o, q, d = first[g]
            if o < i:
                by.setdefault(o, []).append((p, q, c, d))
        lists = []
        for o, m in sorted(by.items()):
            m.sort()
            if len(m) >= 2:
                codes = [np.frombuffer(b"".join(x[k] for x in m), np.int64) for k in (2, 3)]
                lists.append((o, [x[0] for x in m], [x[1] for x in m], *codes))
        if found := ps.passages(lists):
            out[i] = found
    return out


def test_seeds():
    rng = random.Random(2)
    for n in (0, 1, 4, 5, 6, 11, 12, 13, 60, 200):
        text = " ".join(rng.choices(["a", "b", "é", "Ding-dong", "x1"], k=n))
        got = [(int(g) % M, int(p), np.int64(c).tobytes()) for g, p, c in zip(*ps.seeds(text.encode()))]
        assert got == brute_seeds(text)


def test_seeds_of_texts_found_together(monkeypatch):
    rng = random.Random(11)
    texts = [" ".join(rng.choices(["a", "b", "é", "Ding-dong", "x1"], k=rng.choice([0, 1, 4, 5, 6, 12, 13, 90]))) for _ in range(200)]
    batch = ps.pa.RecordBatch.from_arrays(
        [ps.pa.array(range(200), ps.pa.int64()), ps.pa.array(range(1000, 1200), ps.pa.int64()), ps.pa.array([t.encode() for t in texts])],
        ["ord", "key", "data"],
    )
    wanted = [(i, 1000 + i, p, g, c) for i, t in enumerate(texts) for g, p, c in brute_seeds(t)]
    found_together, calls = ps.seeds_of, []
    monkeypatch.setattr(ps, "seeds_of", lambda own: calls.append(len(own)) or found_together(own))
    for size, most in ((1 << 18, 1), (500, 199), (1, 200)):
        monkeypatch.setattr(ps, "TOGETHER", size)
        calls.clear()
        got = [tuple(r.values()) for out in ps._seed_rows(iter([batch])) for r in out.to_pylist()]
        assert [(o, k, p, g % M, np.int64(c).tobytes()) for o, k, p, g, c in got] == wanted
        assert sum(calls) == 200 and len(calls) <= most


def test_chains_have_the_best_scores():
    rng = random.Random(3)
    for _ in range(200):
        m = sorted({(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(rng.randint(1, 40))})
        x, y = [a for a, _ in m], [b for _, b in m]
        got = ps.chains(x, y)
        seen = [i for c in got for i in c]
        assert len(seen) == len(set(seen))
        for c in got:
            assert all(x[i] < x[j] and y[i] < y[j] for i, j in zip(c, c[1:]))
        score = brute_chains(x, y)
        if got:
            worth = ps.WORTH * len(got[0]) - ps.GAP * sum(x[j] - x[i] + y[j] - y[i] for i, j in zip(got[0], got[0][1:]))
            assert worth == pytest.approx(max(score))


def test_fuzzy_passages_and_clean_documents(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(4000)]

    def prose(n):
        return rng.choices(vocabulary, k=n)

    shared, other = prose(60), prose(70)
    fuzzy = [w if i % 20 else "changed" for i, w in enumerate(other)]
    rows = [(1, prose(100) + shared + prose(100)), (2, prose(300)), (3, prose(40) + shared + prose(9)), (4, other + prose(50)), (5, prose(30) + fuzzy), (6, prose(200) + shared[:20])]
    rows += [(7, rows[1][1]), (8, ["the"] * 90), (9, ["the"] * 90), (11, shared[:30] + prose(20)), (12, shared[30:] + prose(20))]
    docs = [(i, " ".join(w)) for i, w in rows] + [(10, None), (13, ""), (7, " ".join(rows[1][1])), (None, " ".join(shared)), (None, "nothing here")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 as ord", "2 as owner").repartition(4)
    got = ps.shared_passages(frame).collect()
    assert len(got) == len(docs)
    of = {r.doc_id: r for r in got if r.doc_id is not None}
    assert {i for i, r in of.items() if r.n_passages} == {3, 5, 7, 9}
    assert (of[3].owners, of[5].owners, of[7].owners, of[9].owners) == ([1], [4], [2], [8])
    assert {i: r.class_id for i, r in of.items()} == {1: 1, 2: 2, 3: 1, 4: 4, 5: 4, 6: 6, 7: 2, 8: 8, 9: 8, 10: 10, 11: 11, 12: 12, 13: 13}
    assert of[1].n_links == 1 and of[6].n_links == 0 and of[3].n_repeated >= 50 and of[5].n_repeated >= 55
    assert sorted(r.n_passages for r in got if r.doc_id is None) == [0, 1]
    assert ps.shared_passages(frame.limit(0)).count() == 0


def test_passages_with_two_owners():
    codes = np.zeros(0, np.int64)
    assert ps.passages([]) == [] and ps.chains([], []) == []
    x = list(range(0, 40, 5))
    known = np.frombuffer(b"\x01" * 8 * len(x), np.int64)
    halves = [(1, x[:4], x[:4], known[:4], known[:4]), (2, x[4:], [v + 900 for v in x[4:]], known[:4], known[:4])]
    (start, stop, identity, owners), = ps.passages(halves)
    assert (start, owners) == (0, []) and stop >= 40 and identity == 1.0  # a passage, but neither has enough of it
    whole = [(1, x, [v + 7 for v in x], known, known)]
    (start, stop, identity, ((owner, first, last),)), = ps.passages(whole)
    assert (start, owner, first) == (0, 1, 7) and last - first == stop - start >= 40
    assert ps.passages(halves[:1]) == [] and len(codes) == 0


def test_first_round_of_the_whole_table(spark, sf_dir):
    docs = table(spark, sf_dir.replace("0.001", "0.01"), "documents")
    wanted = brute_found([(r.doc_id, r.text) for r in docs.collect()])
    got = {
        r.ord: ([(p.start, p.stop, p.identity) for p in r.passages], [tuple(o) for o in r.links])
        for r in ps.first_round(docs).collect() if r.passages
    }
    assert got == {i: ([(s, e, d) for s, e, d, _ in f], [o for *_, own in f for o in own]) for i, f in wanted.items()}
    assert len(got) > 50


def frame_of(spark, rows):
    return spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id bigint, text string").repartition(3)


def test_all_that_share_a_passage_are_linked(spark):
    rng = random.Random(12)
    prose = lambda n: [f"w{rng.randrange(9000)}" for _ in range(n)]
    shared = prose(60)
    rows = [(i, prose(70) + shared + prose(40 + i)) for i in range(1, 6)] + [(9, prose(200))]
    got = {r.doc_id: r for r in ps.shared_passages(frame_of(spark, rows)).collect()}
    assert {i: r.n_links for i, r in got.items()} == {1: 4, 2: 4, 3: 4, 4: 4, 5: 4, 9: 0}
    # Words of one owner that do not overlap make no link between those that have them.
    long = prose(200)
    rows = [(1, long), (2, prose(30) + long[:60]), (3, prose(30) + long[120:]), (4, prose(9) + long[20:70])]
    got = {r.doc_id: r for r in ps.shared_passages(frame_of(spark, rows)).collect()}
    assert {i: r.n_links for i, r in got.items()} == {1: 3, 2: 2, 3: 1, 4: 2}
    assert {r.class_id for r in got.values()} == {1}


def test_phrases_met_before_do_not_hide_a_passage(spark):
    rng = random.Random(13)
    prose = lambda n: [f"w{rng.randrange(9000)}" for _ in range(n)]
    shared = prose(60)
    rows = [(i, prose(40) + shared[6 * i : 6 * i + 9] + prose(40)) for i in range(10)]
    rows += [(i, prose(50) + shared + prose(50)) for i in (100, 200, 300)]
    got = {r.doc_id: r for r in ps.shared_passages(frame_of(spark, rows)).collect()}
    assert [got[i].n_links for i in (100, 200, 300)] == [2, 2, 2] and {got[i].class_id for i in (100, 200, 300)} == {100}
    assert all(got[i].n_links == 0 for i in range(10))
    assert got[200].n_passages == 1 and got[200].n_repeated >= 45


def aligned_words(a, b, x, y):
    """The words of a chain of matches that agree, in the best alignment of the words themselves."""
    from difflib import SequenceMatcher

    return sum(m.size for m in SequenceMatcher(None, a[x[0] : x[-1] + 5], b[y[0] : y[-1] + 5], autojunk=False).get_matching_blocks())


def test_recall_against_all_owners(spark, sf_dir):
    """Every pair of documents that share a seed, chained and aligned on its words."""
    docs = table(spark, sf_dir.replace("0.001", "0.01"), "documents")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    words = {i: ps.WORD.findall(t.lower().encode()) for i, t in texts.items()}
    holders, pairs = {}, {}
    for i in sorted(texts):
        for g, p, _ in zip(*ps.seeds(texts[i].encode()), strict=True):
            for j, q in holders.get(int(g), ()):
                if j != i:
                    pairs.setdefault((i, j), []).append((int(p), q))
        for g, p, _ in zip(*ps.seeds(texts[i].encode()), strict=True):
            holders.setdefault(int(g), []).append((i, int(p)))
    links = set()
    for (i, j), met in pairs.items():
        if len(met) < 4:
            continue
        met.sort()
        x, y = [m[0] for m in met], [m[1] for m in met]
        for chain in ps.chains(x, y):
            a, b = [x[m] for m in chain], [y[m] for m in chain]
            span = max(a[-1] - a[0], b[-1] - b[0]) + 5
            if span >= ps.LEAST_WORDS and aligned_words(words[i], words[j], a, b) >= ps.IDENTITY * span:
                links.add((i, j))
                break
    got = {r.doc_id: r for r in ps.shared_passages(docs).collect()}
    found = [p for p in links if got[p[0]].class_id == got[p[1]].class_id and got[p[0]].n_links and got[p[1]].n_links]
    assert len(links) > 100 and len(found) >= 0.9 * len(links)
    per_document = {}
    for i, j in links:
        per_document[i] = per_document.get(i, 0) + 1
        per_document[j] = per_document.get(j, 0) + 1
    counted = sum(min(got[i].n_links, n) for i, n in per_document.items())
    assert counted >= 0.9 * sum(per_document.values())
