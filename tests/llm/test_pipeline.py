from hashlib import sha256

import public_tokenizers
import pytest
import test_decontaminate
import test_nearcopies
import test_secrets
from pyspark.sql import types as T
from tokenizers import Tokenizer

import corpus_pipeline
from rowlake.llm import quality, secrets
from rowlake.llm.common import table


def redacted(text):
    out, last = "", 0
    spans = []
    for s, _, e in test_secrets.brute(text)[1]:
        if spans and s <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], e)
        else:
            spans.append([s, e])
    for s, e in spans:
        out += text[last:s] + secrets.REDACTED
        last = e
    return out + text[last:]


def test_each_stage_and_the_whole_against_brute_force(spark, sf_dir):
    folder = sf_dir.replace("0.001", "0.01")
    frame = table(spark, folder, "documents")
    columns = frame.columns
    docs = [tuple(r) for r in frame.collect()]
    functions = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "bpe_encoding",
    ]

    def stage(name, rows):
        out = functions[name](spark, spark.createDataFrame(rows, frame.schema), folder)
        return out, sorted(tuple(r) for r in out.collect())

    out, good = stage("quality_classifier", docs)
    model = quality.fit(frame, table(spark, folder, "labels"))
    scores = model.scores([d[1] for d in docs])
    assert out.columns == columns and good == sorted(d for d, s in zip(docs, scores, strict=True) if s >= 0.5)
    assert 0.7 * len(docs) < len(good) < len(docs)

    out, single = stage("simhash_near_dedup", good)
    kept = set(test_nearcopies.brute_kept([d[:2] for d in good]))
    assert out.columns == columns and len(kept) < len(good) and single == [d for d in good if d[0] in kept]

    out, clean = stage("benchmark_decontamination", single)
    items = [(r.item_id, r.text) for r in table(spark, folder, "benchmark").collect()]
    hit = {r[0] for r in test_decontaminate.brute([d[:2] for d in single], items) if r[5]}
    assert out.columns == columns and hit and clean == [d for d in single if d[0] not in hit]

    out, masked = stage("secret_scans", clean)
    wanted = [(d[0], redacted(d[1]), d[2], d[3], len(redacted(d[1])) if redacted(d[1]) != d[1] else d[4]) for d in clean]
    assert out.columns == columns and masked == wanted and masked != clean

    _, tokens = stage("bpe_encoding", masked)
    theirs = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = [theirs.encode(d[1], add_special_tokens=False).ids for d in masked]
    assert [(t[0], t[1], list(t[2])) for t in tokens] == [(d[0], len(i), i) for d, i in zip(masked, ids, strict=True)]
    assert [t[3] for t in tokens] == [sha256(theirs.decode(i, skip_special_tokens=False).encode()).hexdigest() for i in ids]
    whole = sorted((r.doc_id, r.n_tokens, list(r.ids), r.decoded_sha256) for r in corpus_pipeline.run(spark, folder).collect())
    assert whole == [(t[0], t[1], list(t[2]), t[3]) for t in tokens]


TOKENS = ["doc_id", "n_tokens", "ids", "decoded_sha256"]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_clashing_columns_and_text_ids(spark, sf_dir, name):
    fields = ["doc_id", "text", "node", "__key", "key", "__score", "score", "_score", "a`b", "c.d", "own_id", "component"]
    text = "A text of some words that a classifier may or may not like, with token=abcdefgh12 in it. "
    rows = [(f"it's {i}", text + f"w{i} " * 30, *(f"{c}{i}" for c in fields[2:])) for i in range(6)] + [("x`y", text + "w5 " * 30, *fields[2:])]
    docs = spark.createDataFrame(rows, T.StructType([T.StructField(c, T.StringType()) for c in fields]))
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, sf_dir)
    if name == "bpe_encoding":
        assert out.columns == TOKENS and out.count() == 7
        return
    kept = {r[0]: tuple(r) for r in out.collect()}
    given = {r[0]: r for r in rows}
    assert out.columns == fields and all(r[2:] == given[i][2:] for i, r in kept.items())
    if name != "quality_classifier":
        assert len(kept) == (6 if name == "simhash_near_dedup" else 7)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_rows(spark, sf_dir, name):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, __extra string"
    rows = [(None, None, None, None, None, "a"), (1, "", "en", "s", 0, "b"), (2, "Some words here.", "en", "s", 16, "c"), (2, "Some words here.", "en", "s", 16, "c")]
    docs = spark.createDataFrame(rows, schema)
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, sf_dir)
    assert out.columns == (docs.columns if name != "bpe_encoding" else TOKENS)
    assert out.count() <= 4
    assert dict(corpus_pipeline.STAGES)[name](spark, docs.limit(0), sf_dir).count() == 0
