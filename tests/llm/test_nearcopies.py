import random

import numpy as np

import corpus_pipeline
from rowlake.llm import nearcopies
from rowlake.llm.common import table


def brute_kept(rows):
    """Smallest id of each group by comparing all pairs of five-word shingle sets."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    empty = [i for i, s in enumerate(sets) if not s]
    for i in empty[1:]:
        label[root(i)] = root(empty[0])
    for i, s in enumerate(sets):
        met = {}
        for x in s:
            for j in holders[x]:
                if j < i:
                    met[j] = met.get(j, 0) + 1
        for j, n in met.items():
            if n >= 0.8 * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(doc_id)
    return sorted(min(g) for g in groups.values())


def stage(spark, rows, sf_dir):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return sorted(r.doc_id for r in dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, docs, sf_dir).collect())


def edited(rng, words, share):
    return [f"x{rng.random()}" if rng.random() < share else w for w in words]


def test_stage_joins_edited_near_copies(spark, sf_dir):
    rng = random.Random(4)
    rows = []
    for i in range(60):
        words = [f"w{rng.randint(0, 5000)}" for _ in range(300)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(edited(rng, words, 0.005 * (i % 8))))]
    wanted = brute_kept(rows)
    assert 60 < len(wanted) < 110
    assert stage(spark, rows, sf_dir) == wanted


def test_whole_table_against_all_pairs(spark, sf_dir):
    docs = table(spark, sf_dir.replace("0.001", "0.01"), "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(r.doc_id for r in nearcopies.keep_one(docs).collect()) == brute_kept(rows)


def test_a_group_of_many_blocks(spark, sf_dir, monkeypatch):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(edited(rng, base, rng.choice([0.01, 0.02, 0.03])))) for i in range(300)]
    monkeypatch.setattr(nearcopies, "BLOCK", 32)
    assert stage(spark, rows, sf_dir) == brute_kept(rows)


def test_similar_counts_in_steps(monkeypatch):
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 40, n).astype(np.uint64)) for n in rng.integers(1, 120, 30)]
    wanted = [[len(set(a) & set(b)) >= 0.8 * len(set(a) | set(b)) for b in sets] for a in sets]
    assert (nearcopies.similar(sets) == wanted).all()
    monkeypatch.setattr(nearcopies, "STEP", 7)
    assert (nearcopies.similar(sets) == wanted).all()


def test_edge_rows(spark, sf_dir):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO"), (5, "one TWO"), (None, "one two"), (7, "É é"), (8, "é é")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(r.doc_id for r in nearcopies.keep_one(docs).collect()) == [1, 4, 7, 8]
    assert nearcopies.keep_one(docs.limit(0)).count() == 0


def test_close_copies_meet_by_fingerprints_alone(spark, sf_dir, monkeypatch):
    rng = random.Random(7)
    base = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join([*base[:-1], f"x{i}"])) for i in range(6)] + [(9, " ".join(rng.sample(base, 300)))]
    prints = nearcopies.per_batch(
        spark.createDataFrame([(i, t, str(i)) for i, t in rows], "doc_id bigint, text string, text_key string"),
        nearcopies._signed, "doc_id bigint, text_key string, node bigint, fp bigint, bands array<bigint>",
    )
    met = nearcopies.components(nearcopies._by_fingerprint(prints))
    assert met.count() == 6 and met.select("component").distinct().count() == 1
    monkeypatch.setattr(nearcopies.F, "explode", lambda _: nearcopies.F.monotonically_increasing_id())  # no band is shared
    assert sorted(r.node for r in nearcopies._clusters(prints).collect()) == sorted(r.node for r in met.collect())


def test_texts_that_are_alone_do_not_move(spark, sf_dir):
    rng = random.Random(9)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(5000)], k=60)) for _ in range(400)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(500, texts[3]), (7, texts[7]), (None, texts[9]), (None, "alone")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("key", nearcopies.F.lit("k"))
    other = spark.createDataFrame([(500, texts[3]), (7, texts[7])], "doc_id bigint, text string")
    marks = [x.withColumn("text_key", nearcopies.F.md5("text")) for x in (docs, other)]
    found, rest = nearcopies._parted(*marks, 2)
    assert {(r.doc_id, r.text) for r in found.collect()} >= {(500, texts[3]), (7, texts[7])}
    assert rest.count() > 200 and found.count() + rest.count() == len(rows)
    kept = nearcopies.keep_one(docs)
    assert kept.columns == ["doc_id", "text", "key"]
    got = sorted((r.doc_id is None, r.doc_id, r.text, r.key) for r in kept.collect())
    assert got == sorted([(False, i, t, "k") for i, t in enumerate(texts)] + [(True, None, "alone", "k")])


def test_a_mask_that_is_too_small_changes_nothing(spark, sf_dir, monkeypatch):
    rng = random.Random(10)
    words = [[f"w{rng.randint(0, 5000)}" for _ in range(100)] for _ in range(40)]
    rows = [(i, " ".join(w)) for i, w in enumerate(words)] + [(100 + i, " ".join(edited(rng, w, 0.01))) for i, w in enumerate(words)]
    rows += [(200 + i % 3, " ".join(w)) for i, w in enumerate(words)] + [(5, " ".join(words[5]))]
    wanted = stage(spark, rows, sf_dir)
    monkeypatch.setattr(nearcopies, "MOST_WORDS", 1)
    assert stage(spark, rows, sf_dir) == wanted == brute_kept(rows)
