import re
from zlib import crc32

import numpy as np

from rowlake.llm import labelled, quality
from rowlake.llm.common import table


def brute_vectors(all_texts):
    plus, minus = quality._index()
    out = np.zeros((quality.BUCKETS, quality.WIDTH))
    for text in all_texts:
        words = [crc32(w.encode()) % quality.BUCKETS for w in re.findall(r"\w+|[^\w\s]+", text or "")]
        for i, w in enumerate(words):
            for j in range(max(0, i - 2), min(len(words), i + 3)):
                if j != i:
                    out[w, plus[words[j]]] += 1
                    out[w, minus[words[j]]] -= 1
    out = np.sign(out) * np.log1p(np.abs(out))
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def test_word_vectors_against_counting(spark, sf_dir, monkeypatch):
    docs = table(spark, sf_dir, "documents").repartition(3)
    wanted = brute_vectors([r.text for r in docs.select("text").collect()])
    assert np.allclose(quality.word_vectors(docs), wanted, atol=1e-6)
    monkeypatch.setattr(quality, "STEP", 50)
    seen = [np.zeros(quality.BUCKETS * quality.WIDTH, dtype=np.int64)]
    quality._add_contexts(seen[0], np.array([3, -1, 3, 4, -1]))
    assert abs(seen[0]).sum() == 4


def test_pooling_by_steps(monkeypatch):
    vectors = np.random.default_rng(1).normal(size=(quality.BUCKETS, quality.WIDTH)).astype(np.float32)
    text = " ".join(f"w{i % 71}!" for i in range(500))
    whole = quality.pooled(text, vectors)
    part = vectors[quality.buckets(text)].astype(np.float64)
    assert np.allclose(whole[: quality.WIDTH], part.mean(axis=0), atol=1e-5)
    assert np.allclose(whole[quality.WIDTH : 2 * quality.WIDTH], part.std(axis=0), atol=1e-5)
    assert not quality.pooled(" \n", vectors).any()


def test_held_out_accuracy(spark, sf_dir):
    folder = sf_dir.replace("0.001", "0.1")
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.fit(docs, labels)
    scored = quality.score(docs, model)
    assert scored.count() == docs.count() and scored.where("score is null or score < 0 or score > 1").count() == 0
    rows = scored.join(labels, "doc_id").toPandas()
    assert (rows.held_out == [crc32(str(i).encode()) % 3 == 1 for i in rows.doc_id]).all()
    assert (rows.predicted == (rows.score >= 0.5)).all()
    apart = rows[rows.held_out]
    assert (apart.predicted == apart.quality).mean() > 0.98
    assert apart.predicted[apart.quality == 1].mean() > 0.99
    assert ((apart.score - apart.quality) ** 2).mean() < 0.02
    again = quality.fit(docs.repartition(5), labels)
    assert np.allclose(model.scores(["The end.", "", "x!! y!! z!!"]), again.scores(["The end.", "", "x!! y!! z!!"]))


def test_odd_rows(spark, sf_dir):
    rows = [(1, None, "a"), (1, "", "b"), (None, "words here", "c"), (2, "same text", "d"), (2, "same text", "e"), (3, "long " * 300_000, "f")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    model = quality.fit(docs, none)
    got = quality.score(docs, model).collect()
    assert [r.score for r in got] == [0.5] * 6 and not any(r.held_out for r in got if r.doc_id is None)
    one = spark.createDataFrame([(2, 1), (3, 1), (3, None), (None, 0), (99, 0)], "doc_id bigint, quality int")
    assert {r.score for r in quality.score(docs, quality.fit(docs, one)).collect()} <= {0.5, 1.0}
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == 6
    assert quality.score(docs.limit(0), quality.fit(docs.limit(0), none)).count() == 0
    twice = spark.createDataFrame([(2, 1), (2, 0), (2, 1)], "doc_id bigint, quality int")
    taken = labelled.sample(twice, "quality", 3, 1, 10).collect()
    assert [(r.doc_id, r.label) for r in taken] in ([(2, 0)], [])
    assert labelled.documents_of(docs, labelled.sample(twice, "quality", 99, 98, 10)).count() == 1


def test_a_bounded_sample_keeps_the_share_of_all_labels():
    rng = np.random.default_rng(3)
    y = (rng.random(12_000) < 0.86).astype(float)
    x = np.zeros((len(y), quality.FEATURES))
    x[:, 0] = rng.normal(size=len(y)) + 1.5 * y
    x[:, -1] = 0.6
    bad = np.flatnonzero(y == 0)
    some = np.sort(np.concatenate([bad, np.flatnonzero(y == 1)[: len(bad)]]))
    whole, bounded = quality.train(x, y), quality.train(x[some], y[some], y.mean())
    assert bounded.base == whole.base
    kept = [(net.scores(x)[y == 1] >= 0.5).mean() for net in (whole, bounded)]
    assert abs(kept[0] - kept[1]) < 0.03
    assert abs(bounded.scores(x).mean() - y.mean()) < 0.03
    assert abs(quality.train(x[some], y[some]).scores(x).mean() - y.mean()) > 0.1


def test_share_of_all_usable_labels(spark, monkeypatch):
    monkeypatch.setattr(quality, "PER_CLASS", 40)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(600)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(1000)] + [(None, 0), (3, None)], "doc_id bigint, quality int")
    wanted = np.mean([i % 4 != 0 for i in range(600) if crc32(str(i).encode()) % 3 != 1])
    assert abs(quality.fit(docs, labels).network.base - wanted) < 1e-12
