import random

import public_tokenizers as public
import pytest

from rowlake.llm import tokencount as tc
from rowlake.llm.common import table

PATH = public.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def own():
    return tc.Counter(PATH, public.PATTERN)


def changed(text, edits):
    for start, stop, new in edits:
        start = min(max(start, 0), len(text))
        stop = min(max(stop, start), len(text))
        text = text[:start] + (new or "") + text[stop:]
    return text


def test_random_edits(own, monkeypatch):
    monkeypatch.setattr(tc, "BLOCK", 3)
    monkeypatch.setattr(tc, "GROWN", 12)
    rng = random.Random(11)
    bits = ["a", "bc", " ", "  ", "\n", "'", "'s", "'ll", "'re", "1", "22", "!?", "é", "日本", "\t \n", "don't", " x"]
    for _ in range(400):
        text = "".join(rng.choices(bits, k=rng.randint(0, 60)))
        tree = tc.Tree(own, text)
        for _ in range(8):
            start = rng.randint(-2, len(text) + 2)
            edit = (start, start + rng.choice([0, 0, 1, 2, 5, 200, -3]), "".join(rng.choices(bits, k=rng.choice([0, 1, 2, 9, 30]))))
            tree.edit(*edit)
            text = changed(text, [edit])
            pieces = own.split(text)
            assert tree.text == text and tree.n_tokens == len(own.encoding.encode_ordinary(text))
            assert tree.pieces() == (list(map(len, pieces)), own.tokens(pieces))
            for sums in tree.sums:
                assert all(sums[i] == sums[2 * i] + sums[2 * i + 1] for i in range(1, tree.width))


def test_whole_table(spark, sf_dir, own):
    docs = table(spark, sf_dir.replace("0.001", "0.01"), "documents")
    edited = tc.with_own_edits(docs)
    got = {r.doc_id: r for r in tc.counts_after_edits(edited, PATH, public.PATTERN).collect()}
    encoded = pieces = 0
    for r in edited.collect():
        after = changed(r.text, [tuple(e) for e in r.edits])
        g = got[r.doc_id]
        assert (g.n_chars, g.n_before, g.n_tokens) == (len(after), *(len(own.encoding.encode_ordinary(t)) for t in (r.text, after)))
        encoded, pieces = encoded + g.n_encoded, pieces + g.n_pieces
    assert encoded < 0.2 * pieces


def test_state_over_batches(spark, own):
    rows = [(1, "Hello world, it's me."), (1, "Hello world, it's me."), (2, None), (None, "no id"), (3, "word " * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as tokens", "'x' as edits")
    edits = spark.createDataFrame(
        [(1, 2, 0, 5, "Bye"), (1, 1, 5, 6, "\n\n"), (2, 1, 0, 99, "new text"), (3, 1, 500_000, 500_004, None), (None, 1, 0, 2, "x"), (9, 1, 0, 0, "y")],
        "doc_id bigint, seq int, start long, stop long, replacement string",
    )
    state = tc.build(docs, PATH, public.PATTERN)
    after = tc.update(tc.attach(state, edits), PATH, public.PATTERN).collect()
    texts = sorted(r.text for r in after)
    assert texts == sorted(["Bye\n\nworld, it's me."] * 2 + ["new text", "no id", "word " * 100_000 + " " + "word " * 99_999])
    for r in after:
        assert sum(r.tokens) == len(own.encoding.encode_ordinary(r.text)) and sum(r.chars) == len(r.text)
    none = tc.counts_after_edits(docs.selectExpr("doc_id", "text", f"cast(null as {tc.EDITS}) as edits"), PATH, public.PATTERN)
    assert all(r.n_before == r.n_tokens and not r.n_encoded for r in none.collect())
    assert tc.build(docs.limit(0), PATH, public.PATTERN).count() == 0
